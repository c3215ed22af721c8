"""Registered queries: each operator over a whole test table, and the SQL that gives the same rows.

The tables have no cards, so cards are synthesised from documents by an expression that both engines can evaluate. Queries whose
operator has no SQL form (scans with look-around, similarity, fixpoints over verdicts) have none here and are tested against
brute force.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracewell.functions import fixed_values as V
from tracewell.functions.expr import noisy_or, py_round, spans
from tracewell.functions.ordered import append_new, stable_argmax
from tracewell.operators import completion, evaluate, fusion, links, predicates, ranking, scan, selection, verdicts
from tracewell.operators import text as T
from tracewell.operators.inherit import inherit
from tracewell.operators.predicates import SNIPPETS
from tracewell.plans.pipeline import link_and_rank, results
from tracewell.sources import fetch, readers, sinks
from tracewell.sources.remote import Retryable

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def register(f: Callable[[SparkSession, str], DataFrame]):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql.replace("{CARD}", CARD_SQL)
        return f

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share. Where the session names none: a temporary one in local mode, else an error."""
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not shared:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        shared = f"file://{tempfile.mkdtemp(prefix='tracewell-')}"
        spark.sparkContext.setCheckpointDir(shared)
    return shared.rstrip("/")


def keeper(spark: SparkSession) -> Callable[[DataFrame], DataFrame]:
    """Writes a table to the shared folder and reads it back."""
    shared = shared_dir(spark)

    def keep(df: DataFrame) -> DataFrame:
        path = f"{shared}/tracewell/kept-{uuid.uuid4().hex}"
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    return keep


#: Hardware of the synthesised cards by doc_id % 7.
CHIPS = ("8 A100 GPUs", "4 MI250 cards with rocm", "a TPU v4 pod using jax", "Ascend 910B NPUs and mindspore", "Gaudi habana cards", "a laptop", "H100 GPUs with cuda and nccl")
_CASES = " ".join(f"WHEN {k} THEN '{c}'" for k, c in enumerate(CHIPS))
CARD_SQL = (
    "(SELECT doc_id, concat('---\\nlibrary_name: ', CASE WHEN doc_id % 11 = 0 THEN 'mlx' ELSE 'none' END, '\\ntags:\\n- tag', cast(doc_id % 5 AS VARCHAR), '\\n---\\n# Model ', cast(doc_id AS VARCHAR), "
    f"'\\n\\n## Training\\nWe trained it on ', CASE doc_id % 7 {_CASES} END, CASE WHEN doc_id % 3 = 0 THEN ' for 20 days' ELSE '' END, '.\\n## Usage\\nDeploy it with vLLM.\\n', text) AS card FROM documents)"
).replace("\\n", "' || chr(10) || '")


def cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, id, card, text) of every document."""
    k = F.col("doc_id")
    chip = F.element_at(F.array(*(F.lit(c) for c in CHIPS)), (k % 7 + 1).cast("int"))
    own = F.concat(
        F.lit("---\nlibrary_name: "), F.when(k % 11 == 0, "mlx").otherwise("none"), F.lit("\ntags:\n- tag"), (k % 5).cast("string"), F.lit("\n---\n# Model "), k.cast("string"),
        F.lit("\n\n## Training\nWe trained it on "), chip, F.when(k % 3 == 0, " for 20 days").otherwise(""), F.lit(".\n## Usage\nDeploy it with vLLM.\n"), F.col("text"),
    )
    return table(spark, sf_dir, "documents").select("doc_id", F.concat(F.lit("org"), (k % 13).cast("string"), F.lit("/model-"), k.cast("string")).alias("id"), own.alias("card"), "text")


# --- selection --------------------------------------------------------------------------------------------------------


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return o.select(F.col("o_orderkey").alias("id"), F.struct((-F.col("o_totalprice")).alias("p"), "o_orderkey").alias("rank"), F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("month"))


@query("SELECT o_orderkey AS id, year(o_orderdate)::INT AS year, month(o_orderdate)::INT AS month FROM orders QUALIFY row_number() OVER (PARTITION BY year(o_orderdate), month(o_orderdate) ORDER BY o_totalprice DESC, o_orderkey) <= 5")
def topn_per_month(spark, sf_dir):
    return selection.top_per_month(_orders(spark, sf_dir), 5).select("id", "year", "month")


@query("SELECT o_orderkey AS id, year(o_orderdate)::INT AS year, quarter(o_orderdate)::INT AS quarter FROM orders WHERE year(o_orderdate) BETWEEN 1996 AND 1998 QUALIFY row_number() OVER (PARTITION BY year(o_orderdate), quarter(o_orderdate) ORDER BY o_totalprice DESC, o_orderkey) <= 7")
def topn_per_quarter(spark, sf_dir):
    return selection.top_per_quarter(_orders(spark, sf_dir), 7, selection.parse_years("1996-1998")).select("id", "year", "quarter")


@query("SELECT o_orderkey AS id FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 100")
def topn_overall(spark, sf_dir):
    return selection.top_overall(_orders(spark, sf_dir), 100).select("id")


@query("SELECT year, count(*)::BIGINT AS n_rows, count(DISTINCT month)::BIGINT AS n_months FROM (SELECT year(o_orderdate)::INT AS year, month(o_orderdate) AS month FROM orders QUALIFY row_number() OVER (PARTITION BY year(o_orderdate), month(o_orderdate) ORDER BY o_totalprice DESC, o_orderkey) <= 5) GROUP BY year")
def bucket_summary(spark, sf_dir):
    return selection.bucket_summary(selection.top_per_month(_orders(spark, sf_dir), 5))


_STEM = ("concat('org', cast(p_partkey % 40 AS VARCHAR), '/', 'Model-', cast(p_size AS VARCHAR), CASE p_partkey % 6 WHEN 0 THEN '-7B-Instruct' WHEN 1 THEN '-14B-Instruct-AWQ' WHEN 2 THEN '-v1.5' WHEN 3 THEN '-0.5B-Base' WHEN 4 THEN '-VL' ELSE '-12Hz' END)")


@query(f"""
WITH p AS (SELECT p_partkey, {_STEM} AS id FROM part),
s AS (SELECT p_partkey, id, regexp_replace(id, '(-7B-Instruct|-14B-Instruct-AWQ|-v1[.]5|-0[.]5B-Base|-12Hz)$', '') AS stem FROM p)
SELECT p_partkey, id, stem FROM s QUALIFY row_number() OVER (PARTITION BY stem ORDER BY p_partkey) = 1""")
def family_dedup(spark, sf_dir):
    rows = table(spark, sf_dir, "part").select("p_partkey", F.expr(_STEM.replace("VARCHAR", "STRING")).alias("id"))
    return selection.dedup_by_family(rows, "id", "p_partkey").select("p_partkey", "id", "stem")


@query("SELECT c_mktsegment, min(c_custkey) AS c_custkey FROM customer GROUP BY c_mktsegment")
def ordered_distinct(spark, sf_dir):
    return selection.ordered_distinct(table(spark, sf_dir, "customer").select("c_mktsegment", "c_custkey"), "c_mktsegment", "c_custkey")


def _two_lists(spark, sf_dir):
    return (table(spark, sf_dir, "customer").filter("c_custkey % 3 > 0").select(F.col("c_custkey").alias("id")), table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("id")).distinct())


@query("SELECT c_custkey AS id FROM customer WHERE c_custkey % 3 > 0 UNION SELECT o_custkey FROM orders")
def union_ids(spark, sf_dir):
    return selection.union_ids(*_two_lists(spark, sf_dir))


@query("WITH a AS (SELECT DISTINCT c_custkey AS id FROM customer WHERE c_custkey % 3 > 0), b AS (SELECT DISTINCT o_custkey AS id FROM orders) SELECT (SELECT count(*) FROM a)::BIGINT AS n_a, (SELECT count(*) FROM b)::BIGINT AS n_b, (SELECT count(*) FROM (SELECT id FROM a UNION SELECT id FROM b))::BIGINT AS n_union, (SELECT count(*) FROM a JOIN b USING (id))::BIGINT AS n_both")
def overlap_ids(spark, sf_dir):
    return selection.overlap(*_two_lists(spark, sf_dir))


@query("SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')")
def id_snapshot(spark, sf_dir):
    ids = table(spark, sf_dir, "customer").filter("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("id"))
    return selection.snapshot(table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"), ids, "o_custkey")


@query("""
WITH t AS (SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN 'None' WHEN 1 THEN '' WHEN 2 THEN '2024-13-01' ELSE strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') END AS a, strftime(o_orderdate, '%Y-%m-%d') AS b FROM orders),
u AS (SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 3 THEN a ELSE b END AS v FROM t)
SELECT o_orderkey, substr(v, 1, 4)::INT AS year, substr(v, 6, 2)::INT AS month, ((substr(v, 6, 2)::INT - 1) // 3 + 1)::INT AS quarter FROM u""")
def year_month_derive(spark, sf_dir):
    k, d = F.col("o_orderkey"), F.col("o_orderdate")
    created = F.when(k % 4 == 0, "None").when(k % 4 == 1, "").when(k % 4 == 2, "2024-13-01").otherwise(F.date_format(d, "yyyy-MM-dd'T'HH:mm:ss"))
    rows = table(spark, sf_dir, "orders").select("o_orderkey", created.alias("a"), F.date_format(d, "yyyy-MM-dd").alias("b"))
    year, month = selection.year_month(F.col("a"), F.col("b"))
    return rows.select("o_orderkey", year.alias("year"), month.alias("month")).withColumn("quarter", selection.quarter(F.col("month")))


# --- links ------------------------------------------------------------------------------------------------------------

_MENTIONS = "concat('Code: https://github.com/org', cast(doc_id % 9 AS VARCHAR), '/repo', cast(doc_id % 4 AS VARCHAR), '.git and (https://github.com/sponsors/me) or https://github.com/a/b/blob/main/x.py, https://github.com/x/y', cast(doc_id % 2 AS VARCHAR), ' https://github.com/x/y0 paper https://arxiv.org/abs/2401.0', cast(1000 + doc_id % 50 AS VARCHAR), 'v2 https://arxiv.org/pdf/2401.0', cast(1000 + doc_id % 7 AS VARCHAR), '.pdf eprint = {2302.0', cast(1000 + doc_id % 3 AS VARCHAR), '} ', text)"


@query(f"""
WITH t AS (SELECT doc_id, {_MENTIONS} AS t FROM documents),
m AS (SELECT doc_id, 'https://github.com/org' || (doc_id % 9) || '/repo' || (doc_id % 4) AS a, 'https://github.com/x/y' || (doc_id % 2) AS b, 'https://github.com/x/y0' AS c FROM t),
p AS (SELECT doc_id, regexp_extract_all(t, 'https?://arxiv[.]org/(?:abs|pdf)/([0-9]+[.][0-9]+)', 1) || regexp_extract_all(t, 'eprint\\s*=\\s*[{{]?\\s*([0-9]{{4}}[.][0-9]{{4,5}})', 1) AS ids FROM t)
SELECT doc_id, CASE WHEN b = c THEN a || ' ' || b ELSE a || ' ' || b || ' ' || c END AS repos, (SELECT string_agg('https://arxiv.org/abs/' || x, ' ' ORDER BY k) FROM (SELECT x, min(k) AS k FROM (SELECT unnest(ids) AS x, generate_subscripts(ids, 1) AS k) GROUP BY x)) AS papers
FROM m JOIN p USING (doc_id)""")
def link_extract(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").select("doc_id", F.expr(_MENTIONS.replace("VARCHAR", "STRING")).alias("t"))
    return rows.select("doc_id", F.array_join(links.repo_links(F.col("t")), " ").alias("repos"), F.array_join(links.paper_links(F.col("t")), " ").alias("papers"))


@query("SELECT page_id, CASE WHEN strpos(u, '/') > 0 THEN substr(u, 1, strpos(u, '/') - 1) ELSE u END AS namespace, lower(u) AS repo FROM (SELECT page_id, 'Owner' || (page_id % 9) || '/Repo' || page_id AS u FROM pages)")
def url_canonical(spark, sf_dir):
    own = F.concat(F.lit("Owner"), (F.col("page_id") % 9).cast("string"), F.lit("/Repo"), F.col("page_id").cast("string"))
    url = F.concat(F.lit("https://GitHub.com/"), own, F.lit("/tree/main"))
    return table(spark, sf_dir, "pages").select("page_id", links.namespace(own).alias("namespace"), links.repo_key(url).alias("repo"))


@query("""
WITH c AS (SELECT DISTINCT l_suppkey AS slug, l_partkey % 40 AS paper FROM lineitem WHERE l_linenumber = 1 AND l_partkey % 40 < l_suppkey % 9),
ok AS (SELECT slug FROM c GROUP BY slug HAVING count(*) BETWEEN 1 AND 5),
m AS (SELECT DISTINCT l_suppkey AS slug, l_orderkey AS model FROM lineitem WHERE l_linenumber > 1)
SELECT model::VARCHAR AS id, string_agg(DISTINCT 'p' || lpad(paper::VARCHAR, 3, '0'), ',' ORDER BY 'p' || lpad(paper::VARCHAR, 3, '0')) AS papers FROM m JOIN ok USING (slug) JOIN c USING (slug) GROUP BY model""")
def collection_propagate(spark, sf_dir):
    l = table(spark, sf_dir, "lineitem")  # noqa: E741
    papers = l.filter("l_linenumber = 1 AND l_partkey % 40 < l_suppkey % 9").select(F.col("l_suppkey").cast("string").alias("slug"), F.lit("paper").alias("item_type"), F.concat(F.lit("p"), F.lpad((F.col("l_partkey") % 40).cast("string"), 3, "0")).alias("item_id")).distinct()
    models = l.filter("l_linenumber > 1").select(F.col("l_suppkey").cast("string").alias("slug"), F.lit("model").alias("item_type"), F.col("l_orderkey").cast("string").alias("item_id")).distinct()
    ids = l.select(F.col("l_orderkey").cast("string").alias("id")).distinct()
    return links.propagate(papers.unionByName(models), ids).select("id", F.array_join("collection_paper_ids", ",").alias("papers"))


@query("WITH t AS (SELECT o_orderkey, o_custkey % 5 AS a, o_custkey % 3 AS b FROM orders) SELECT o_orderkey, CASE WHEN a = b THEN 'u' || a ELSE 'u' || a || ' u' || b END AS merged FROM t")
def merge_links(spark, sf_dir):
    one = lambda n: F.array(F.concat(F.lit("u"), (F.col("o_custkey") % n).cast("string")))
    return table(spark, sf_dir, "orders").select("o_orderkey", F.array_join(append_new(one(5), one(3)), " ").alias("merged"))


# --- text structure ---------------------------------------------------------------------------------------------------


@query(r"""
SELECT page_id, trim(regexp_replace(replace(replace(replace(replace(replace(regexp_replace(html, '<[^>]+>', ' ', 'g'), '&amp;', '&'), '&lt;', '<'), '&gt;', '>'), '&nbsp;', ' '), '&#x27;', ''''), '\s+', ' ', 'g')) AS plain FROM pages""")
def strip_tags(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", T.strip_tags(F.col("html")).alias("plain"))


_KIND = "CASE WHEN contains({0}, 'abstract') THEN 'abstract' WHEN regexp_matches({0}, '" + V.PAPER_TRAINING_HEADING + "') THEN 'training' WHEN regexp_matches({0}, '" + V.PAPER_METHOD_HEADING + "') THEN 'method' WHEN regexp_matches({0}, '" + V.PAPER_RESULTS_HEADING + "') THEN 'results' WHEN regexp_matches({0}, '" + V.PAPER_REFERENCES_HEADING + "') THEN 'references' ELSE 'body' END"
_HEADS = "CASE p_partkey % 8 WHEN 0 THEN '4.1 Training <b>Setup</b>' WHEN 1 THEN 'Our Method' WHEN 2 THEN 'Ablation' WHEN 3 THEN 'References' WHEN 4 THEN 'Abstract' WHEN 5 THEN 'Pre-training data' ELSE p_name END"


@query("SELECT p_partkey, " + _KIND.format("h") + " AS kind FROM (SELECT p_partkey, lower(trim(regexp_replace(regexp_replace(" + _HEADS + r", '<[^>]+>', ' ', 'g'), '\s+', ' ', 'g'))) AS h FROM part)")
def heading_types(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", T.heading_type(F.expr(_HEADS)).alias("kind"))


@query(r"""
WITH h AS (SELECT page_id, regexp_replace(html, '(?is)<h[1-3][^>]*>.*?</h[1-3]>', chr(1), 'g') AS marked, regexp_extract_all(html, '(?is)<h[1-3][^>]*>(.*?)</h[1-3]>', 1) AS heads FROM pages),
s AS (SELECT page_id, string_split(marked, chr(1)) AS bodies, heads FROM h),
r AS (SELECT page_id, unnest(range(len(bodies))) AS k, bodies, heads FROM s),
c AS (SELECT page_id, k, bodies[k + 1] AS body, lower(trim(regexp_replace(regexp_replace(coalesce(heads[k], ''), '<[^>]+>', ' ', 'g'), '\s+', ' ', 'g'))) AS h FROM r)
SELECT page_id, count(*)::BIGINT AS n_sections, sum(least(15000, length(trim(regexp_replace(replace(replace(replace(replace(replace(regexp_replace(body, '<[^>]+>', ' ', 'g'), '&amp;', '&'), '&lt;', '<'), '&gt;', '>'), '&nbsp;', ' '), '&#x27;', ''''), '\s+', ' ', 'g')))))::BIGINT AS n_chars
FROM c WHERE regexp_matches(body, '\S') GROUP BY page_id""")
def html_sections(spark, sf_dir):
    rows = table(spark, sf_dir, "pages").select("page_id", F.explode(T.html_sections(F.col("html"))).alias("s"))
    return rows.groupBy("page_id").agg(F.count("*").alias("n_sections"), F.sum(F.length("s.text")).alias("n_chars"))


@query("""
WITH c AS {CARD}, b AS (SELECT doc_id, substr(card, strpos(substr(card, 4), chr(10) || '---') + 7) AS body FROM c),
l AS (SELECT doc_id, unnest(string_split(body, chr(10))) AS line, generate_subscripts(string_split(body, chr(10)), 1) AS k FROM b),
n AS (SELECT doc_id, line, k, sum(CASE WHEN starts_with(line, '#') THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY k) AS s FROM l),
t AS (SELECT doc_id, s, string_agg(line, chr(10) ORDER BY k) AS text, first(line ORDER BY k) AS head FROM n GROUP BY doc_id, s)
SELECT doc_id, s::INT AS pos, CASE WHEN head = '## Training' THEN 'training' WHEN head = '## Usage' THEN 'compatibility' ELSE 'body' END AS section_type, length(text)::INT AS n_chars FROM t""")
def md_sections(spark, sf_dir):
    body = T.front_matter(F.col("card"))["body"]
    return cards(spark, sf_dir).select("doc_id", F.posexplode(T.card_sections(body)).alias("pos", "s")).select("doc_id", "pos", "s.section_type", F.length("s.text").alias("n_chars"))


@query("WITH c AS {CARD} SELECT doc_id, substr(card, 4, strpos(substr(card, 4), chr(10) || '---') - 1) AS yaml, 'tag' || (doc_id % 5) AS tags FROM c")
def front_matter(spark, sf_dir):
    yaml = T.front_matter(F.col("card"))["yaml"]
    return cards(spark, sf_dir).select("doc_id", yaml.alias("yaml"), F.array_join(F.filter(T.yaml_tags(yaml), lambda t: t != ""), ",").alias("tags"))


@query("WITH c AS {CARD} SELECT doc_id, doc_id % 11 = 0 OR doc_id % 6 < 2 AS is_derivative, CASE WHEN doc_id % 11 = 0 THEN 'mlx' WHEN doc_id % 6 = 0 THEN 'awq' WHEN doc_id % 6 = 1 THEN 'gguf' END AS runtime_library FROM c")
def derivatives(spark, sf_dir):
    front = T.front_matter(F.col("card"))
    name = F.concat("id", F.when(F.col("doc_id") % 6 == 0, "-AWQ").when(F.col("doc_id") % 6 == 1, "-GGUF").otherwise(""))
    rows = cards(spark, sf_dir).select("doc_id", T.derivative(front["yaml"], name, front["body"]).alias("d"))
    return rows.select("doc_id", "d.is_derivative", "d.runtime_library")


_PATHS = "CASE page_id % 9 WHEN 0 THEN 'requirements-dev.txt' WHEN 1 THEN 'scripts/run.sh' WHEN 2 THEN 'src/train_model.py' WHEN 3 THEN 'docs/a.md' WHEN 4 THEN 'app/serve.py' WHEN 5 THEN 'CMakeLists.txt' WHEN 6 THEN 'README.md' WHEN 7 THEN 'kernels/a.cu' ELSE concat('html/', cast(page_id AS VARCHAR)) END"


@query("SELECT page_id, CASE WHEN page_id % 9 IN (0, 2, 6) THEN 1 WHEN page_id % 9 IN (1, 5) THEN 2 END::INT AS tier, CASE page_id % 9 WHEN 2 THEN 1.5 WHEN 4 THEN 0.3 WHEN 3 THEN 0.5 WHEN 6 THEN 0.5 ELSE 1.0 END::DOUBLE AS weight, page_id % 9 = 0 AS dependency FROM pages")
def file_tiering(spark, sf_dir):
    path = F.expr(_PATHS.replace("VARCHAR", "STRING"))
    return table(spark, sf_dir, "pages").select("page_id", T.file_tier(path).alias("tier"), T.file_weight(path).alias("weight"), T.is_dependency_file(path).alias("dependency"))


# --- scan and predicates ----------------------------------------------------------------------------------------------

#: Patterns without look-around, which both engines read alike on the synthesised cards.
PLAIN_SIGNALS = {v: {level: tuple(p for p in own.get(level, ()) if "(?=" not in p and "(?!" not in p and p.isascii()) for level in ("strong", "medium")} for v, own in V.SIGNALS.items()}
_SUMS = " UNION ALL ".join(
    f"SELECT doc_id, '{v}' AS vendor, " + " + ".join(f"{V.LEVEL_WEIGHTS[level]} * len(regexp_extract_all(card, '(?i){p.replace(chr(39), chr(39) * 2)}'))" for level, ps in own.items() for p in ps) + " AS score FROM c"
    for v, own in PLAIN_SIGNALS.items()
)


@query(f"WITH c AS {{CARD}}, s AS ({_SUMS}) SELECT doc_id, vendor, score::DOUBLE AS score FROM s WHERE score > 0")
def signal_scan(spark, sf_dir):
    rows = scan.dealt(cards(spark, sf_dir), "doc_id").select("doc_id", F.explode(scan.signal_hits("card", None, PLAIN_SIGNALS)).alias("h"))
    return rows.groupBy("doc_id", F.col("h.vendor").alias("vendor")).agg(F.sum("h.base").cast("double").alias("score"))


@query(f"WITH c AS {{CARD}}, s AS ({_SUMS}), o AS (SELECT doc_id, vendor, score, row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, CASE vendor {' '.join(f'WHEN {chr(39)}{v}{chr(39)} THEN {k}' for k, v in enumerate(V.SIGNALS))} END) AS r FROM s WHERE score > 0) SELECT doc_id, CASE WHEN score >= 6 THEN vendor ELSE 'unknown' END AS vendor, CASE WHEN score >= 6 THEN least(1.0, printf('%.2f', score / 30)::DOUBLE) ELSE 0.0 END::DOUBLE AS confidence FROM o WHERE r = 1")
def argmax_threshold(spark, sf_dir):
    rows = scan.dealt(cards(spark, sf_dir), "doc_id").select("doc_id", F.explode(scan.signal_hits("card", None, PLAIN_SIGNALS)).alias("h"))
    sums = rows.groupBy("doc_id", F.col("h.vendor").alias("vendor")).agg(F.sum("h.base").cast("double").alias("score"), F.min("h.vendor_pos").alias("first"))
    best, wins = scan.ranked_scores(sums, "doc_id").filter("rank = 1"), F.col("score") >= V.MIN_SCORE
    return best.select("doc_id", F.when(wins, F.col("vendor")).otherwise("unknown").alias("vendor"), F.when(wins, F.least(F.lit(1.0), py_round(F.col("score") / V.CONFIDENCE_DIVISOR, 2))).otherwise(0.0).alias("confidence"))


_RE = lambda p: "'(?i)" + p.replace("'", "''") + "'"


@query(f"""
WITH c AS {{CARD}}, m AS (SELECT doc_id, card, strpos(card, 'trained it on') - 1 AS pos FROM c),
w AS (SELECT doc_id, substr(card, greatest(pos - 80, 0) + 1, pos - greatest(pos - 80, 0)) AS before, substr(card, greatest(pos - 80, 0) + 1, least(pos + 13 + 80, length(card)) - greatest(pos - 80, 0)) AS near, substr(card, greatest(pos - 160, 0) + 1, least(pos + 13 + 160, length(card)) - greatest(pos - 160, 0)) AS wide FROM m)
SELECT doc_id, CASE WHEN regexp_matches(before, {_RE(V.NEGATION)}) THEN 0 WHEN regexp_matches(before, {_RE(V.COMPARISON)}) THEN 0.3 WHEN regexp_matches(before, {_RE(V.EXPORT)}) THEN 0.25 WHEN regexp_matches(wide, {_RE(V.HARDWARE_DURATION)}) AND regexp_matches(wide, {_RE(V.HARDWARE_LITERAL)}) THEN 2.5 WHEN regexp_matches(near, {_RE(V.CARD_TRAINING)}) THEN 1.5 ELSE 1 END::DOUBLE AS multiplier FROM w""")
def context_multiplier(spark, sf_dir):
    start = F.locate("trained it on", F.col("card")) - 1
    return cards(spark, sf_dir).select("doc_id", scan.card_multiplier(F.col("card"), start, start + 13).cast("double").alias("multiplier"))


@query(f"""
WITH c AS {{CARD}}, s AS (SELECT doc_id, card AS s FROM c)
SELECT doc_id, s <> '' AND NOT regexp_matches(s, {_RE(V.CONDITIONAL)}) AND ((regexp_matches(s, {_RE(V.EXPLICIT_TRAINING)}) AND regexp_matches(s, {_RE(V.HARDWARE_LITERAL)})) OR regexp_matches(s, {_RE(V.HARDWARE_DURATION)})) AS disclosure,
s <> '' AND NOT regexp_matches(s, {_RE(V.CONDITIONAL)}) AND (regexp_matches(s, {_RE(V.EXPLICIT_TRAINING)}) OR regexp_matches(s, {_RE(V.LAUNCHER)})) AS context, regexp_matches(s, {_RE(V.RUNTIME_NOISE)}) AS noise FROM s""")
def disclosure_flags(spark, sf_dir):
    s = F.col("card")
    one = F.array(F.struct(F.lit(None).cast("string").alias("provider"), s.alias("snippet"), F.lit("").alias("source")))
    rows = cards(spark, sf_dir)
    return rows.select("doc_id", predicates.is_disclosure(s).alias("disclosure"), predicates.is_training_context(s).alias("context"), (predicates.runtime_only(one) | (predicates.has_evidence(one) & F.rlike(s, F.lit("(?iUd)" + V.RUNTIME_NOISE)))).alias("noise"))


_EVENTS = "CASE event_type WHEN 'purchase' THEN 'import mindspore' WHEN 'view' THEN 'torchrun --x' WHEN 'click' THEN 'rocm' ELSE event_type END"


@query(f"WITH s AS (SELECT user_id, {_EVENTS} AS s FROM events), r AS (SELECT user_id, CASE WHEN contains(s, 'rocm') THEN 1 WHEN contains(s, 'mindspore') THEN 2 WHEN contains(s, 'torchrun') THEN 9 END AS r FROM s) SELECT user_id, CASE min(r) WHEN 1 THEN 'amd' WHEN 2 THEN 'huawei_ascend' WHEN 9 THEN 'nvidia' END AS vendor FROM r GROUP BY user_id")
def launcher_priority(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select("user_id", predicates.launcher_vendor(F.expr(_EVENTS)).alias("r")).groupBy("user_id").agg(F.min("r").alias("r"))
    return rows.select("user_id", F.get(F.array(*(F.lit(v) for v in predicates.LAUNCHER_ORDER)), F.col("r")).alias("vendor"))


# --- ranking, fusion, inheritance -------------------------------------------------------------------------------------


@query("""
WITH c AS (SELECT l_orderkey, l_linenumber, (l_quantity::INT % 12) - 3 AS score, count(*) OVER (PARTITION BY l_orderkey) AS n FROM lineitem),
r AS (SELECT *, lead(score) OVER w AS second, row_number() OVER w AS k FROM c WINDOW w AS (PARTITION BY l_orderkey ORDER BY score DESC, l_linenumber))
SELECT l_orderkey, l_linenumber, CASE WHEN n = 1 THEN least(1.0, 0.7::DOUBLE + greatest(0, score) * 0.03::DOUBLE) ELSE printf('%.2f', least(1.0::DOUBLE, greatest(0.1::DOUBLE, 0.5::DOUBLE + least(0.3::DOUBLE, (score - second) * 0.06::DOUBLE) + least(0.15::DOUBLE, greatest(0, score) * 0.015::DOUBLE))))::DOUBLE END::DOUBLE AS confidence FROM r WHERE k = 1""")
def link_rank(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", (F.col("l_quantity").cast("int") % 12 - 3).alias("score"))
    n = rows.groupBy("l_orderkey").count()
    best = stable_argmax(rows, ["l_orderkey"], "score", "l_linenumber").join(n, "l_orderkey")
    return best.select("l_orderkey", "l_linenumber", ranking.confidence(F.col("score"), F.coalesce("second", F.lit(-10)), F.col("count")).alias("confidence"))


# --- candidate links --------------------------------------------------------------------------------------------------

#: Of every document a model, a repository and a paper (one in 17 has none), told in turn beside an introduction, in a bibtex fence, in a
#: table, in an install line, beside another's work, and beside the model's name; in one half of the cards first, in the other last.
_OWNER = "CASE doc_id % 4 WHEN 0 THEN 'Qwen' WHEN 1 THEN 'timm' WHEN 2 THEN 'facebook' ELSE concat('org', cast(doc_id % 13 AS VARCHAR)) END"
_REPO = (
    "concat('https://github.com/', CASE doc_id % 7 WHEN 0 THEN 'QwenLM' WHEN 1 THEN 'huggingface' WHEN 2 THEN 'facebookresearch' ELSE concat('org', cast(doc_id % 13 AS VARCHAR)) END, '/', "
    "CASE doc_id % 5 WHEN 0 THEN concat('Model-', cast(doc_id AS VARCHAR)) WHEN 1 THEN concat('Modal-', cast(doc_id AS VARCHAR)) WHEN 2 THEN 'tools' WHEN 3 THEN concat('model', cast(doc_id AS VARCHAR), '-code') ELSE 'model-dataset' END)"
)
_PAPER = "concat('https://arxiv.org/abs/2401.', lpad(cast(doc_id % 100000 AS VARCHAR), 5, '0'))"
_OTHER = "https://github.com/huggingface/transformers"
_TOLD = (
    f"CASE WHEN doc_id % 17 = 0 THEN '' ELSE concat(chr(10), CASE doc_id % 6 WHEN 0 THEN concat('Source code: ', {_REPO}, ' and our paper ', {_PAPER}) "
    f"WHEN 1 THEN concat('```bibtex', chr(10), '@misc(x, url = (', {_REPO}, '), note = (', {_PAPER}, '))', chr(10), '```') WHEN 2 THEN concat('| ', {_REPO}, ' | ', {_PAPER}, ' |') "
    f"WHEN 3 THEN concat('pip install git+', {_REPO}, ' --upgrade', chr(10), 'based on ', {_PAPER}) WHEN 4 THEN concat('Look at ', {_REPO}, ' (inspired by ', {_PAPER}, ')') ELSE concat({_REPO}, ' has Model-', cast(doc_id AS VARCHAR), '-7b and ', {_PAPER}) END, chr(10), '{_OTHER}', chr(10)) END"
)
_TOLD_CARD = f"CASE WHEN doc_id % 2 = 0 THEN concat({_TOLD}, coalesce(text, '')) ELSE concat(coalesce(text, ''), {_TOLD}) END"

_AROUND = "substr(card, greatest(spot - {0}, 0) + 1, greatest(least(spot + {1}, length(card)) - greatest(spot - {0}, 0), 0))"
_TERM = lambda *terms: (" + ".join(f"CASE WHEN {c} THEN {n} ELSE 0 END" for c, n, _ in terms), "concat_ws('; ', " + ", ".join(f"CASE WHEN {c} THEN '{r}' END" for c, _, r in terms) + ")")
_PLACE_TERMS = {
    "very early": ("share < 0.15", 2, "very early in card"), "early": ("share >= 0.15 AND share < 0.35", 1, "early in card"),
    "bibtex": ("fence >= 0 AND fence <= spot AND spot <= closed", -3, "inside bibtex"), "row": ("regexp_matches(trim(line, chr(9) || chr(10) || chr(13) || ' '), '^[|].*[|]')", {"repo": -2, "paper": -1}, "inside table row"),
}
_SAME_NAME = "own_name <> '' AND repo <> '' AND (contains(repo, own_name) OR contains(own_name, repo))"
_REPO_POINTS, _REPO_REASONS = _TERM(
    ("pip >= 0 AND contains(substr(card, pip + 1, length(pip_line) + 100), link) AND abs(spot - pip) < 200", -3, "only in pip install context"), (_SAME_NAME, 4, "model name in repo name"),
    # the one kind of name that is not contained and has a ratio over .6
    (f"NOT ({_SAME_NAME}) AND starts_with(repo, 'modal')", 2, "fuzzy model name match"), ("own_org = org", 3, "org exact match"),
    ("own_org <> org AND (own_org, org) IN (" + ", ".join(f"('{k}', '{o}')" for k, v in V.ORG_ALIASES.items() for o in v) + ")", 3, "org alias match"), _PLACE_TERMS["very early"], _PLACE_TERMS["early"],
    (f"regexp_matches({_AROUND.format(200, 222)}, {_RE(V.INTRO)})", 3, "intro keyword context"), (_PLACE_TERMS["row"][0], -2, _PLACE_TERMS["row"][2]), _PLACE_TERMS["bibtex"],
)
_PAPER_POINTS, _PAPER_REASONS = _TERM(
    (f"regexp_matches({_AROUND.format(200, 260)}, {_RE(V.OUR_PAPER)})", 4, "our paper context"), (f"contains(lower({_AROUND.format(300, 300)}), 'model-' || doc_id || '-7b')", 3, "model name near link"),
    _PLACE_TERMS["very early"], _PLACE_TERMS["early"], _PLACE_TERMS["bibtex"], (_PLACE_TERMS["row"][0], -1, _PLACE_TERMS["row"][2]), (f"regexp_matches({_AROUND.format(200, 260)}, {_RE(V.THIRD_PARTY)})", -2, "third-party reference context"),
)
_SCORES_SQL = f"""
c AS (SELECT doc_id, {_TOLD_CARD} AS card, lower({_OWNER}) AS own_org, 'model' || doc_id AS own_name, {_REPO} AS r, {_PAPER} AS p FROM documents),
l AS (SELECT *, 'repo' AS kind, 0 AS link_pos, r AS link FROM c WHERE doc_id % 17 > 0 UNION ALL SELECT *, 'repo', 1, '{_OTHER}' FROM c WHERE doc_id % 17 > 0 UNION ALL SELECT *, 'paper', 0, p FROM c WHERE doc_id % 17 > 0),
a AS (SELECT *, strpos(card, link) - 1 AS spot, strpos(card, '```bibtex') - 1 AS fence, regexp_replace(lower(split_part(link, '/', 4)), '[^a-z0-9]', '', 'g') AS org, regexp_replace(lower(split_part(link, '/', 5)), '[^a-z0-9]', '', 'g') AS repo,
  regexp_extract(card, {_RE(V.PIP_INSTALL)}) AS pip_line FROM l),
b AS (SELECT *, spot / length(card) AS share, CASE WHEN pip_line <> '' THEN strpos(card, pip_line) - 1 ELSE -1 END AS pip, string_split(substr(card, 1, spot), chr(10))[-1] || string_split(substr(card, spot + 1), chr(10))[1] AS line,
  CASE WHEN strpos(substr(card, fence + 4), '```') > 0 THEN fence + 2 + strpos(substr(card, fence + 4), '```') ELSE length(card) END AS closed FROM a),
s AS (SELECT doc_id, kind, link_pos, link, repo, (CASE WHEN kind = 'repo' THEN {_REPO_POINTS} ELSE {_PAPER_POINTS} END)::INT AS score, CASE WHEN kind = 'repo' THEN {_REPO_REASONS} ELSE {_PAPER_REASONS} END AS reasons FROM b)"""


def _told(spark: SparkSession, sf_dir: str) -> DataFrame:
    sql = lambda e: F.expr(e.replace("VARCHAR", "STRING"))
    rows = table(spark, sf_dir, "documents").select("doc_id", F.concat(sql(_OWNER), F.lit("/Model-"), F.col("doc_id").cast("string"), F.lit("-7b-instruct")).alias("id"), sql(_TOLD_CARD).alias("modelcard"))
    return rows.withColumns({"github_links": links.repo_links(F.col("modelcard")), "arxiv_links": links.paper_links(F.col("modelcard"))})


@query(f"WITH {_SCORES_SQL} SELECT doc_id, kind, link_pos::INT AS link_pos, link, score, reasons FROM s")
def link_scores(spark, sf_dir):
    """Every candidate link with its points and their reasons."""
    rows = _told(spark, sf_dir)
    both = ranking.repo_candidates(rows).withColumn("kind", F.lit("repo")).unionByName(ranking.paper_candidates(rows).withColumn("kind", F.lit("paper")))
    return both.select(F.regexp_extract("id", "Model-(\\d+)", 1).cast("long").alias("doc_id"), "kind", "link_pos", "link", "score", F.array_join("reasons", "; ").alias("reasons"))


@query(f"""WITH {_SCORES_SQL},
k AS (SELECT *, count(*) OVER (PARTITION BY doc_id, kind) AS n, row_number() OVER w AS place, lead(score) OVER w AS second FROM s WINDOW w AS (PARTITION BY doc_id, kind ORDER BY score DESC, link_pos)),
m AS (SELECT doc_id, kind, link, CASE WHEN n = 1 THEN least(1.0::DOUBLE, 0.7::DOUBLE + greatest(0, score) * 0.03::DOUBLE) ELSE printf('%.2f', least(1.0::DOUBLE, greatest(0.1::DOUBLE, 0.5::DOUBLE + least(0.3::DOUBLE, (score - second) * 0.06::DOUBLE) + least(0.15::DOUBLE, greatest(0, score) * 0.015::DOUBLE))))::DOUBLE END AS own,
  kind = 'repo' AND regexp_matches(repo, {_RE(V.DATASET_REPO)}) AS data_set FROM k WHERE place = 1),
f AS (SELECT doc_id, kind, link, CASE WHEN data_set THEN least(own, 0.5) ELSE own END AS confidence FROM m)
SELECT d.doc_id, CASE WHEN r.link IS NOT NULL AND d.doc_id % 3 = 0 THEN '{_OTHER}' ELSE r.link END AS main_github, coalesce(r.confidence, 0)::DOUBLE AS main_github_confidence, CASE WHEN r.link IS NOT NULL THEN CASE WHEN d.doc_id % 3 = 0 THEN 'llm' ELSE 'heuristic' END END AS main_github_source,
  r.link IS NOT NULL AND r.confidence < 0.6 AS review, p.link AS main_arxiv, coalesce(p.confidence, 0)::DOUBLE AS main_arxiv_confidence
FROM documents d LEFT JOIN f r ON r.doc_id = d.doc_id AND r.kind = 'repo' LEFT JOIN f p ON p.doc_id = d.doc_id AND p.kind = 'paper'""")
def link_answers(spark, sf_dir):
    """The best candidate of each kind and its confidence, which of them are to be reviewed, and recorded answers: of those only a candidate counts."""
    rows = _told(spark, sf_dir)
    best = ranking.choose(ranking.choose(rows, "github"), "arxiv")
    queue = ranking.review_queue(best, "github").select("id", F.lit(True).alias("review"))
    answers = rows.select("id", F.when(F.col("doc_id") % 3 == 0, _OTHER).otherwise("https://github.com/not/there").alias("answer"))
    out = ranking.take_answers(best, answers, "github").join(queue, "id", "left")
    return out.select("doc_id", "main_github", "main_github_confidence", "main_github_source", F.coalesce("review", F.lit(False)).alias("review"), "main_arxiv", "main_arxiv_confidence")


_ANY = "[0-9]+|https?://[a-z]+"


@query(rf"""
WITH c AS (SELECT doc_id, {_TOLD_CARD} AS card FROM documents), m AS (SELECT doc_id, card, regexp_extract_all(card, '(?i){_ANY}') AS own, string_split_regex(card, '(?i){_ANY}') AS gaps FROM c),
k AS (SELECT *, unnest(range(len(own))) AS k FROM m),
s AS (SELECT doc_id, card, k, list_sum(list_transform(gaps[1:k + 1], lambda x: length(x))) + coalesce(list_sum(list_transform(own[1:k], lambda x: length(x))), 0) AS low, length(own[k + 1]) AS n FROM k),
w AS (SELECT *, string_split(substr(card, 1, low::BIGINT), chr(10))[-1] || string_split(substr(card, low::BIGINT + 1), chr(10))[1] AS line FROM s)
SELECT doc_id, low::INT AS low, (low + n)::INT AS high, regexp_matches(line, '^\s*[|](?:.*[|])?\s*$') AS in_table,
  '...' || regexp_replace(replace(substr(card, greatest(low - 100, 0)::BIGINT + 1, (least(low + n + 100, length(card)) - greatest(low - 100, 0))::BIGINT), chr(10), ' '), '^\s+|\s+$', '', 'g') || '...' AS snippet FROM w""")
def match_offsets(spark, sf_dir):
    """All matches of a pattern with their places, whether in a table's row, and their surroundings."""
    rows = scan.dealt(_told(spark, sf_dir).select("doc_id", F.col("modelcard").alias("card")), "doc_id").withColumn("s", F.explode(spans(F.col("card"), _ANY)))
    low, high = F.col("s.start"), F.col("s.end")
    return rows.select("doc_id", low.alias("low"), high.alias("high"), T.is_table_line(T.line_at(F.col("card"), low)).alias("in_table"), scan.snippet_of(F.col("card"), low, high, 100, True).alias("snippet"))


@query(r"""
WITH c AS {CARD}, b AS (SELECT doc_id, regexp_replace(substr(card, 4, strpos(substr(card, 4), chr(10) || '---') - 1), '^\s+|\s+$', '', 'g') AS yaml, substr(card, strpos(substr(card, 4), chr(10) || '---') + 7) AS body FROM c),
l AS (SELECT doc_id, unnest(string_split(body, chr(10))) AS line, generate_subscripts(string_split(body, chr(10)), 1) AS k FROM b),
n AS (SELECT doc_id, line, k, sum(CASE WHEN starts_with(line, '#') THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY k) AS s FROM l),
t AS (SELECT doc_id, s, regexp_replace(string_agg(line, chr(10) ORDER BY k), '^\s+|\s+$', '', 'g') AS text, first(line ORDER BY k) AS head FROM n GROUP BY doc_id, s),
o AS (SELECT doc_id, s, text, CASE WHEN head = '## Training' THEN 0 WHEN head = '## Usage' THEN 2 ELSE 3 END AS place, CASE WHEN head = '## Training' THEN 'TRAINING' WHEN head = '## Usage' THEN 'COMPATIBILITY' ELSE 'BODY' END AS name FROM t WHERE text <> '')
SELECT doc_id, string_agg('=== [' || name || '] ===' || chr(10) || text, chr(10) || chr(10) ORDER BY place, s) || chr(10) || chr(10) || '=== [YAML FRONTMATTER] ===' || chr(10) || substr(first(yaml), 1, 800) AS told FROM o JOIN b USING (doc_id) GROUP BY doc_id""")
def labelled_text(spark, sf_dir):
    front = T.front_matter(F.col("card"))
    return cards(spark, sf_dir).select("doc_id", T.labelled_text(front["yaml"], T.card_sections(front["body"])).alias("told"))


_RENDER = "concat(repeat(coalesce(html, ''), cast(20 AS INT)), CASE page_id % 3 WHEN 0 THEN '<h2 id=\"s\">3 Training &amp; <i>Setup</i></h2>' WHEN 1 THEN '<h3>Thanks</h3>' ELSE '' END)"
_HEAD_KINDS = " OR ".join(f"regexp_matches(lower(x), {_RE(p)})" for p in (V.PAPER_TRAINING_HEADING, V.PAPER_METHOD_HEADING, V.PAPER_RESULTS_HEADING))


@query(rf"""
WITH h AS (SELECT page_id, {_RENDER} AS h FROM pages), t AS (SELECT page_id, regexp_extract_all(h, '(?is)<h[2-3][^>]*>(.*?)</h[2-3]>', 1) AS heads, trim(regexp_replace(replace(replace(replace(replace(replace(regexp_replace(h, '<[^>]+>', ' ', 'g'), '&amp;', '&'), '&lt;', '<'), '&gt;', '>'), '&nbsp;', ' '), '&#x27;', ''''), '\s+', ' ', 'g')) AS plain FROM h)
SELECT page_id, length(plain) >= 15000 AND len(list_filter(list_transform(heads, lambda y: regexp_replace(regexp_replace(y, '<[^>]+>', ' ', 'g'), '\s+', ' ', 'g')), lambda x: {_HEAD_KINDS})) > 0 AS ok FROM t""")
def render_ok(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", T.render_ok(F.expr(_RENDER)).alias("ok"))


@query(f"SELECT doc_id, split_part({_REPO}, '/', 4) AS owner, split_part({_REPO}, '/', 5) AS repo, '2401.' || lpad((doc_id % 100000)::VARCHAR, 5, '0') AS paper FROM documents")
def url_parts(spark, sf_dir):
    sql = lambda e: F.expr(e.replace("VARCHAR", "STRING"))
    own = links.repo_of_url(F.concat(sql(_REPO), F.lit(".git/")))
    return table(spark, sf_dir, "documents").select("doc_id", own["owner"].alias("owner"), own["repo"].alias("repo"), links.paper_id(F.concat(F.replace(sql(_PAPER), F.lit("/abs/"), F.lit("/pdf/")), F.lit("v3.pdf"))).alias("paper"))


@query("SELECT o_orderkey AS pos, o_custkey::VARCHAR AS id, c_name AS name FROM orders LEFT JOIN (SELECT * FROM customer WHERE c_custkey % 3 > 0) ON c_custkey = o_custkey")
def explicit_ids(spark, sf_dir):
    catalog = table(spark, sf_dir, "customer").filter("c_custkey % 3 > 0").select(F.col("c_custkey").cast("string").alias("id"), F.col("c_name").alias("name"))
    return selection.by_ids(table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("pos"), F.col("o_custkey").cast("string").alias("id")), catalog).select("pos", "id", "name")


@query("SELECT l_orderkey, 1 - list_product(list_transform(list_sort(list(l_discount)), lambda x: 1 - x)) AS combined FROM lineitem GROUP BY l_orderkey")
def noisy_or_by_order(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_list("l_discount")).alias("c"))
    return rows.select("l_orderkey", noisy_or(F.col("c")).alias("combined"))


def _verdict_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey")
    names = F.array(*(F.lit(v) for v in ("nvidia", "amd", "google_tpu", "unknown")))
    none = F.array().cast(SNIPPETS)
    told = F.array(F.struct(F.get(names, (k % 4).cast("int")).alias("provider"), F.lit("We trained on 8 A100 GPUs").alias("snippet"), F.lit("x").alias("source")))
    return table(spark, sf_dir, "orders").select(
        k.alias("id"), F.lit(None).cast("string").alias("main_github"), F.get(names, (k % 4).cast("int")).alias("mc_chip_provider"), ((k % 11) / 10).alias("mc_chip_provider_confidence"), F.when(k % 5 == 0, told).otherwise(none).alias("mc_chip_snippets"),
        F.array().cast("array<string>").alias("mc_matched_sections"), (k % 13 == 0).alias("mc_is_derivative"), F.get(names, (F.floor(k / 4) % 4).cast("int")).alias("gh_chip_provider"), ((k % 7) / 10).alias("gh_chip_provider_confidence"), none.alias("gh_chip_snippets"),
        F.array().cast("array<string>").alias("gh_detection_files"), F.get(names, (F.floor(k / 16) % 4).cast("int")).alias("ax_chip_provider"), ((k % 17) / 20).alias("ax_chip_provider_confidence"), none.alias("ax_chip_snippets"),
    )


@query("""
WITH v AS (SELECT o_orderkey AS id, ['nvidia', 'amd', 'google_tpu', 'unknown'][o_orderkey % 4 + 1] AS m, ['nvidia', 'amd', 'google_tpu', 'unknown'][(o_orderkey // 4) % 4 + 1] AS g, ['nvidia', 'amd', 'google_tpu', 'unknown'][(o_orderkey // 16) % 4 + 1] AS a,
  (o_orderkey % 11) / 10 AS mc0, (o_orderkey % 7) / 10 AS gc0, (o_orderkey % 17) / 20 AS ac0, o_orderkey % 5 = 0 AS told, o_orderkey % 13 = 0 AS derived FROM orders),
r AS (SELECT id, m, g, a, told, derived AND a <> 'unknown' AND printf('%.2f', ac0)::DOUBLE > 0 AS blocked, printf('%.2f', mc0)::DOUBLE AS mc1, printf('%.2f', gc0)::DOUBLE AS gc1, printf('%.2f', ac0)::DOUBLE AS ac1 FROM v),
c AS (SELECT id, m, g, a, told, blocked, CASE WHEN m <> 'unknown' AND NOT told AND mc1 > 0.6 THEN 0.6 ELSE mc1 END::DOUBLE AS mc, CASE WHEN g <> 'unknown' THEN least(gc1, 0.6) ELSE gc1 END::DOUBLE AS gc, CASE WHEN blocked THEN 0 WHEN a <> 'unknown' THEN least(ac1, 0.6) ELSE ac1 END::DOUBLE AS ac FROM r),
w AS (SELECT *, CASE WHEN a <> 'unknown' AND ac >= 0.5 AND ac - greatest(gc, mc) >= 0.15::DOUBLE THEN 'ax' WHEN g <> 'unknown' AND gc >= 0.5 AND gc - mc >= 0.15::DOUBLE THEN 'gh' WHEN m <> 'unknown' AND mc > 0 THEN 'mc' WHEN g <> 'unknown' AND gc > 0 THEN 'gh' WHEN a <> 'unknown' AND ac > 0 THEN 'ax' END AS t FROM c),
p AS (SELECT *, CASE t WHEN 'ax' THEN a WHEN 'gh' THEN g WHEN 'mc' THEN m ELSE 'unknown' END AS chip, CASE t WHEN 'ax' THEN ac WHEN 'gh' THEN gc WHEN 'mc' THEN mc ELSE 0 END AS conf FROM w),
o AS (SELECT *, list_filter([{'t': 'mc', 'chip': m, 'conf': mc}, {'t': 'gh', 'chip': g, 'conf': gc}, {'t': 'ax', 'chip': a, 'conf': ac}], lambda x: x.t <> p.t AND x.chip <> 'unknown' AND x.conf > 0) AS others FROM p WHERE true),
f AS (SELECT *, t IS NOT NULL AND len(list_filter(others, lambda x: x.chip <> chip AND x.conf >= 0.3)) > 0 AS conflict, [conf] || list_transform(list_filter(others, lambda x: x.chip = chip AND x.conf >= 0.4), lambda x: x.conf) AS agreeing FROM o),
n AS (SELECT *, CASE WHEN t IS NOT NULL AND len(agreeing) > 1 THEN printf('%.2f', 1 - list_product(list_transform(agreeing, lambda x: 1 - x)))::DOUBLE ELSE conf END AS joint FROM f)
SELECT id, chip AS chip_provider, CASE WHEN conflict AND NOT (told AND m = chip) THEN least(joint, 0.55) ELSE joint END::DOUBLE AS chip_provider_confidence, CASE t WHEN 'ax' THEN 'arxiv_paper' WHEN 'gh' THEN 'github_code' WHEN 'mc' THEN 'modelcard' END AS chip_provider_source, blocked AS quality_blocked_chip, coalesce(conflict, false) AS source_conflict FROM n""")
def fuse_policy(spark, sf_dir):
    return fusion.conclude(_verdict_rows(spark, sf_dir)).select("id", "chip_provider", "chip_provider_confidence", "chip_provider_source", "quality_blocked_chip", "source_conflict")


def _inheritable(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("p_partkey")
    known = k % 10 == 1
    return table(spark, sf_dir, "part").select(
        k.alias("id"), k.alias("pos"), F.when(known, "nvidia").when(k % 10 == 7, "apple").otherwise("unknown").alias("chip_provider"), F.when(known | (k % 10 == 7), (k % 9) / 10 + 0.1).otherwise(0.0).alias("chip_provider_confidence"),
        F.when(known | (k % 10 == 7), "modelcard").alias("chip_provider_source"), (k % 3 > 0).alias("is_derivative"), F.floor(k / 2).cast("long").alias("base_model"), F.when(k % 10 == 7, "mlx").alias("runtime_library"),
    )


@query("""
WITH RECURSIVE r AS (SELECT p_partkey AS id, CASE p_partkey % 10 WHEN 1 THEN 'nvidia' WHEN 7 THEN 'apple' ELSE 'unknown' END AS chip, CASE WHEN p_partkey % 10 IN (1, 7) THEN (p_partkey % 9) / 10 + 0.1 ELSE 0 END::DOUBLE AS conf, p_partkey % 3 > 0 AS derived, p_partkey // 2 AS base FROM part),
done AS (
  SELECT id, CASE WHEN derived AND chip = 'apple' THEN 'unknown' ELSE chip END AS chip, CASE WHEN derived AND chip = 'apple' THEN 0 ELSE conf END::DOUBLE AS conf FROM r WHERE NOT derived OR base NOT IN (SELECT p_partkey FROM part)
  UNION ALL
  SELECT r.id, CASE WHEN b.chip <> 'unknown' AND b.conf >= 0.3 THEN b.chip WHEN r.chip = 'apple' THEN 'unknown' ELSE r.chip END, CASE WHEN b.chip <> 'unknown' AND b.conf >= 0.3 THEN least(b.conf, 0.7) WHEN r.chip = 'apple' THEN 0 ELSE r.conf END::DOUBLE FROM done b JOIN r ON r.base = b.id AND r.derived)
SELECT id, chip AS chip_provider, conf AS chip_provider_confidence FROM done""")
def inherit_base(spark, sf_dir):
    return inherit(_inheritable(spark, sf_dir), keeper(spark)).select("id", "chip_provider", "chip_provider_confidence")


# --- evaluation -------------------------------------------------------------------------------------------------------


def _truth(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "labels").join(table(spark, sf_dir, "documents").select("doc_id", "lang"), "doc_id")
    return rows.select(F.col("doc_id").alias("id"), F.when(F.col("quality") == 1, "nvidia").otherwise("unknown").alias("expected"), F.col("lang").alias("slice"))


def _predictions(spark: SparkSession, sf_dir: str, n: int) -> DataFrame:
    k = F.col("doc_id")
    return table(spark, sf_dir, "documents").select(k.alias("id"), F.when(k % n == 0, "amd").when(k % n < 3, "unknown").otherwise("nvidia").alias("chip_provider"), F.lit("modelcard").alias("chip_provider_source"), F.lit(0.5).alias("chip_provider_confidence"))


_TRUTH = "truth AS (SELECT doc_id AS id, CASE WHEN quality = 1 THEN 'nvidia' ELSE 'unknown' END AS expected, lang AS slice FROM labels JOIN documents USING (doc_id))"
_PRED = "{0} AS (SELECT doc_id AS id, CASE WHEN doc_id % {1} = 0 THEN 'amd' WHEN doc_id % {1} < 3 THEN 'unknown' ELSE 'nvidia' END AS pred FROM documents)"
_OUTCOME = "CASE WHEN pred = expected THEN 'correct' WHEN pred = 'unknown' THEN 'missed' WHEN expected = 'unknown' THEN 'false_positive' ELSE 'confused' END"


@query(f"WITH {_TRUTH}, {_PRED.format('p', 7)}, s AS (SELECT slice, {_OUTCOME} AS o FROM truth JOIN p USING (id)) SELECT CASE WHEN grouping(slice) = 1 THEN '__ALL__' ELSE slice END AS slice, count(*) FILTER (WHERE o = 'correct')::BIGINT AS correct, count(*) FILTER (WHERE o = 'missed')::BIGINT AS missed, count(*) FILTER (WHERE o = 'false_positive')::BIGINT AS false_positive, count(*) FILTER (WHERE o = 'confused')::BIGINT AS confused, count(*)::BIGINT AS total FROM s GROUP BY GROUPING SETS ((slice), ())")
def outcome_matrix(spark, sf_dir):
    return evaluate.outcome_matrix(evaluate.scored(_predictions(spark, sf_dir, 7), _truth(spark, sf_dir)))


@query(f"WITH {_TRUTH}, {_PRED.format('p', 7)}, {_PRED.format('q', 5)}, a AS (SELECT id, expected, pred, {_OUTCOME} AS o FROM truth JOIN p USING (id)), b AS (SELECT id, pred, {_OUTCOME} AS o FROM truth JOIN q USING (id)) SELECT a.id, a.expected, a.pred AS pred_a, a.o AS outcome_a, b.pred AS pred_b, b.o AS outcome_b FROM a JOIN b USING (id) WHERE a.pred <> b.pred OR a.o <> b.o")
def run_diff(spark, sf_dir):
    a, b = (evaluate.scored(_predictions(spark, sf_dir, n), _truth(spark, sf_dir)) for n in (7, 5))
    return evaluate.run_diff(a, b)


@query(f"WITH {_TRUTH}, {_PRED.format('p', 7)}, s AS (SELECT expected, pred FROM p LEFT JOIN truth USING (id)) SELECT count(expected)::BIGINT AS evaluated, count(*) FILTER (WHERE expected IS NULL)::BIGINT AS not_labelled, count(*) FILTER (WHERE pred = expected)::BIGINT AS correct, count(*) FILTER (WHERE pred <> expected)::BIGINT AS incorrect, count(*) FILTER (WHERE pred = expected)::DOUBLE / count(expected) * 100 AS percent FROM s")
def accuracy(spark, sf_dir):
    return evaluate.accuracy(evaluate.flag(_predictions(spark, sf_dir, 7), _truth(spark, sf_dir)))


@query(f"WITH {_TRUTH}, {_PRED.format('p', 7)} SELECT id, expected, pred AS got, 'modelcard' AS source FROM truth JOIN p USING (id) WHERE pred <> expected")
def mismatches(spark, sf_dir):
    return evaluate.mismatches(evaluate.flag(_predictions(spark, sf_dir, 7), _truth(spark, sf_dir)))


@query("SELECT l_orderkey, printf('%d/%d (%.1f%%)', n, d, 100.0::DOUBLE * n / d) AS share FROM (SELECT l_orderkey, count(*) FILTER (WHERE l_quantity > 25) AS n, 16 AS d FROM lineitem GROUP BY l_orderkey)")
def shares(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.count_if(F.col("l_quantity") > 25).alias("n"))
    return rows.select("l_orderkey", evaluate.share(F.col("n"), F.lit(16)).alias("share"))


@query(f"WITH {_TRUTH}, {_PRED.format('p', 7)}, s AS (SELECT id, expected, pred, {_OUTCOME} AS o FROM truth JOIN p USING (id)) SELECT id, pred, o AS outcome FROM s WHERE o <> 'correct'")
def failures_and_misses(spark, sf_dir):
    rows = evaluate.scored(_predictions(spark, sf_dir, 7), _truth(spark, sf_dir))
    return evaluate.failures(rows).unionByName(evaluate.misses(rows)).select("id", "pred", "outcome")


@query("WITH t AS (SELECT s_suppkey, CASE s_suppkey % 5 WHEN 0 THEN ' Nvidia ' WHEN 1 THEN 'Huawei' WHEN 2 THEN 'muxi' WHEN 3 THEN 'Other' ELSE 'google' END AS p FROM supplier) SELECT s_suppkey, CASE s_suppkey % 5 WHEN 0 THEN 'nvidia' WHEN 1 THEN 'huawei_ascend' WHEN 2 THEN 'metax' WHEN 3 THEN 'other' ELSE 'google_tpu' END AS label FROM t")
def label_normalise(spark, sf_dir):
    p = F.get(F.array(*(F.lit(x) for x in (" Nvidia ", "Huawei", "muxi", "Other", "google"))), (F.col("s_suppkey") % 5).cast("int"))
    return table(spark, sf_dir, "supplier").select("s_suppkey", evaluate.label(p).alias("label"))


_WORDS = r"list_filter(regexp_extract_all(regexp_replace(regexp_replace(lower(trim({0})), '[`*|_>#]', ' ', 'g'), '\s+', ' ', 'g'), '[\p{{L}}\p{{N}}_\p{{M}}]+'), lambda w: w NOT IN (" + ", ".join(f"'{w}'" for w in V.STOPWORDS) + "))"


@query("WITH t AS (SELECT conv_id, turn, text, text || ' entirely unseen additions ' || role AS quote FROM conversations), w AS (SELECT conv_id, turn, " + _WORDS.format("quote") + " AS q, " + _WORDS.format("text") + " AS o FROM t) SELECT conv_id, turn, CASE WHEN len(q) > 0 THEN len(list_filter(q, lambda x: list_contains(o, x))) / len(q) ELSE 0 END::DOUBLE AS overlap FROM w")
def quote_overlap(spark, sf_dir):
    quote = F.concat("text", F.lit(" entirely unseen additions "), "role")
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", fusion.quote_overlap(quote, F.col("text")).cast("double").alias("overlap"))


@query("SELECT c_custkey AS id, CASE WHEN c_custkey % 3 = 0 THEN 'nvidia' END AS conclusion, CASE WHEN c_custkey % 3 = 0 THEN CASE c_custkey % 2 WHEN 0 THEN 0.8 ELSE 0.4 END ELSE 0 END::DOUBLE AS confidence FROM customer")
def answer_parse(spark, sf_dir):
    k = F.col("c_custkey")
    quote = F.when(k % 3 == 0, "trained on 8 A100 GPUs").when(k % 3 == 1, "none found").otherwise("can be fine-tuned on H100")
    answer = F.concat(F.lit("training_evidence: \""), quote, F.lit("\"\nconclusion: nvidia\nconfidence: "), F.when(k % 2 == 0, "high").otherwise("low"))
    rows = table(spark, sf_dir, "customer").select(k.alias("id"), answer.alias("answer"), F.concat(F.lit("It was "), quote, F.lit(". "), "c_name").alias("card_text"))
    return fusion.parse_answers(rows).select("id", "conclusion", "confidence")


_FORMS = ("lines", "array", "one file")


@query(f"SELECT doc_id, text, lang, source, n_chars, form FROM documents CROSS JOIN (SELECT unnest({list(_FORMS)}) AS form)")
def json_round_trip(spark, sf_dir):
    """Documents written as JSON lines and as an array, in parts and in one file, as they are read back."""
    docs, path = table(spark, sf_dir, "documents"), f"{shared_dir(spark)}/tracewell/json-{uuid.uuid4().hex}"
    sinks.json_documents(docs, f"{path}/lines")
    sinks.json_array(docs, f"{path}/array", ["doc_id"], f"{path}/array.json".removeprefix("file:"))
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    rows = [readers.json_documents(spark, f"{path}/{name}", schema).withColumn("form", F.lit(form)) for form, name in zip(_FORMS, ("lines", "array", "array.json"))]
    return rows[0].unionByName(rows[1]).unionByName(rows[2])


_HOST = "split_part(split_part(url, '://', 2), '/', 1)"


@query(f"""
WITH k AS (SELECT coalesce({_HOST}, '') AS host, url AS key, bool_or(page_id % 2 = 0) AS early FROM pages WHERE url IS NOT NULL GROUP BY ALL)
SELECT host, key, CASE length(key) % 5 WHEN 0 THEN 404 WHEN 1 THEN 503 ELSE 200 END::INT AS status, CASE WHEN length(key) % 5 = 1 THEN 3 ELSE 1 END::INT AS tries,
(CASE WHEN early AND length(key) % 5 = 1 THEN 2 ELSE 1 END)::BIGINT AS attempts, CASE WHEN length(key) % 5 > 1 THEN 'found at ' || key END AS content FROM k""")
def fetch_runs(spark, sf_dir):
    """Two runs of a store over the addresses of pages, the first over those of even pages: what was found or is not there is asked for
    once, what the server could not give is asked for again. The server is a rule on the address's length."""

    def server(key: str) -> str | None:
        if len(key) % 5 == 1:
            raise Retryable(503, 0.0)
        return f"found at {key}" if len(key) % 5 else None

    rows = table(spark, sf_dir, "pages").select("page_id", F.expr(_HOST).alias("host"), F.col("url").alias("key"))
    name = f"runs_{uuid.uuid4().hex}"
    store = fetch.Store(spark, name, f"{shared_dir(spark)}/tracewell/{name}", int(spark.conf.get("spark.sql.shuffle.partitions")))
    for part in (rows.filter("page_id % 2 = 0"), rows):
        store.update(store.put_keys(part), server, fetch.Budgets(other=fetch.Budget(lanes=8)))
    asked = spark.table(store.table("status")).groupBy("host", "key").agg(F.count("*").alias("attempts"))
    return store.statuses().join(asked, ["host", "key"]).join(store.contents(), ["host", "key"], "left").select("host", "key", "status", "tries", "attempts", "content")


@query("""
SELECT doc_id::VARCHAR AS id, CASE WHEN text IS NOT NULL AND length(text) % 7 > 0 THEN length(text) || ' characters, ' || ((length(text) - length(replace(text, 'the', ''))) // 3) || ' times the' END AS answer,
CASE WHEN text IS NOT NULL AND length(text) % 7 > 0 THEN length(text) ELSE 0 END::DOUBLE AS cost, CASE WHEN text IS NOT NULL AND length(text) % 7 > 0 THEN 200 ELSE 0 END::INT AS status, CASE WHEN text IS NULL THEN 0 ELSE 1 END::INT AS tries FROM documents""")
def completions(spark, sf_dir):
    """The completion stage over all documents, with a client that counts instead of thinking, and breaks at every seventh length."""

    def client():
        async def call(prompt: str) -> tuple[str, float]:
            if len(prompt) % 7 == 0:
                raise ValueError("no answer")
            return f"{len(prompt)} characters, {prompt.count('the')} times the", len(prompt)

        return call

    return completion.completed(table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), F.col("text").alias("prompt")), client).drop("error")


_LINK_HEAD, _LINK_RULE = completion._ASK["github"]
_AROUND = "'  - ...' || regexp_replace(replace(substr(t, greatest(strpos(t, {0}) - 101, 0) + 1, least(strpos(t, {0}) - 1 + length({0}) + 100, length(t)) - greatest(strpos(t, {0}) - 101, 0)), chr(10), ' '), '^\\s+|\\s+$', '', 'g') || '...'"


@query(
    "WITH c AS (SELECT doc_id, concat('org', doc_id % 13, '/model-', doc_id) AS id, concat('https://github.com/org', doc_id % 13, '/model-', doc_id) AS u, 'https://github.com/huggingface/transformers' AS v, card FROM {CARD}), "
    "p AS (SELECT *, concat(card, chr(10), 'Code: ', u, ' and ', v, ', our paper https://arxiv.org/abs/2401.', lpad((doc_id % 60)::VARCHAR, 5, '0'), chr(10)) AS t FROM c) "
    f"SELECT id, concat('{_LINK_HEAD.split('{}')[0]}', id, '{_LINK_HEAD.split('{}')[1]}', chr(10), chr(10), 'Card:', chr(10), substr(t, 1, 4000), chr(10), chr(10), 'Candidates:', chr(10), '- ', u, chr(10), "
    "CASE WHEN doc_id % 2 = 0 THEN concat('  Description: Number ', doc_id, chr(10), '  Topics: [a, b]', chr(10), '  Language: unknown; a fork: no; ', doc_id, ' KB') ELSE '  (nothing is known of it)' END, "
    "chr(10), '- ', v, chr(10), '  (nothing is known of it)', chr(10), chr(10), 'Where the card names them:', chr(10), " + _AROUND.format("u") + ", chr(10), " + _AROUND.format("v") + f", chr(10), chr(10), '{_LINK_RULE}', chr(10), 'Answer with the address alone, or with None.') AS prompt FROM p"
)
def link_prompts(spark, sf_dir):
    """What a model is asked about the repositories of each card; of every second one the repository's metadata is known."""
    own = F.regexp_extract("modelcard", "Code: (\\S+) and", 1)
    rows = _linked(spark, sf_dir).select("id", "modelcard", "pos", F.array(own, F.lit("https://github.com/huggingface/transformers")).alias("github_links"))
    k = F.col("pos").cast("string")
    known = rows.filter("pos % 2 = 0").select(F.get("github_links", F.lit(0)).alias("url"), F.concat(F.lit('{"description": "Number '), k, F.lit('", "topics": ["a", "b"], "size": '), k, F.lit("}")).alias("json"))
    return completion.link_prompts(rows, completion.repo_told(readers.repo_metadata(known)), "github")


# --- without SQL: tested against brute force --------------------------------------------------------------------------


@query()
def name_similarity(spark, sf_dir):
    p = table(spark, sf_dir, "part").select(F.lower("p_name").alias("a"), F.lower("p_type").alias("b"))
    return ranking.similar_names(p.distinct())


@query()
def card_verdicts(spark, sf_dir):
    rows = cards(spark, sf_dir).select("id", F.col("card").alias("modelcard"))
    out = verdicts.card_verdicts(rows, with_text=False)
    return out.select("id", "chip_provider", "chip_provider_score", "chip_provider_confidence", F.to_json("chip_providers_all").alias("all"), F.array_join("matched_sections", ",").alias("matched_sections"), F.size("chip_snippets").alias("n_snippets"), "is_derivative", "runtime_library")


@query()
def disclosure_flags_whole(spark, sf_dir):
    """The flags of disclosure_flags for every section of the card by itself."""
    parts = cards(spark, sf_dir).withColumn("front", T.front_matter(F.col("card")))
    front = F.struct(F.lit("yaml_frontmatter").alias("section_type"), F.col("front.yaml").alias("text"))
    rows = parts.select("doc_id", F.posexplode(F.concat(F.array(front), T.card_sections(F.col("front.body")))).alias("pos", "s"))
    s = F.col("s.text")
    return rows.select("doc_id", "pos", "s.section_type", predicates.is_disclosure(s).alias("disclosure"), predicates.is_training_context(s).alias("context"), F.rlike(s, F.lit("(?iUd)" + V.RUNTIME_NOISE)).alias("noise"))


def _snapshots(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Models (id, main_github, main_arxiv), a repository tree and its files, and papers' plain text. Every document makes a
    repository and a paper; every tenth has a second model, a mirror that names the same two."""
    c, k = cards(spark, sf_dir), F.col("doc_id")
    owner, repo, paper = F.concat(F.lit("org"), (k % 13).cast("string")), F.concat(F.lit("repo"), k.cast("string")), F.format_string("2401.%05d", k)
    ids = F.when(k % 10 == 0, F.array("id", F.concat("id", F.lit("-mirror")))).otherwise(F.array("id"))
    models = c.select(F.explode(ids).alias("id"), F.concat(F.lit("https://github.com/"), owner, F.lit("/"), repo).alias("main_github"), F.concat(F.lit("https://arxiv.org/abs/"), paper).alias("main_arxiv"))
    paths = F.array(*(F.lit(p) for p in ("README.md", "requirements.txt", "train.py", "scripts/go.sh", "src/a.cu")))
    files = c.select(owner.alias("owner"), repo.alias("repo"), "card", F.posexplode(paths).alias("path_pos", "path"))
    # the readme has the whole card, other files what stands before its usage
    own = F.when(F.col("path") == "README.md", F.col("card")).otherwise(F.substring_index("card", "\n## Usage", 1))
    files = files.select("owner", "repo", "path_pos", "path", F.concat(own, F.lit("\ntorch\nflash-attn\nCUDA_VISIBLE_DEVICES=0,1 python train.py with the usual options\n")).alias("content"))
    papers = c.select(paper.alias("arxiv_id"), F.concat(F.lit("Abstract\nWe train.\n1 Introduction\nwords\n2 Method\nwords\n3 Training Setup\n"), "card", F.lit("\nReferences\n[1]")).alias("text"))
    return models, files.select("owner", "repo", "path", F.col("path_pos").cast("int").alias("path_pos")), files.select("owner", "repo", "path", "content"), papers


def _rendered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Renderings (arxiv_id, html) of papers, one for each page: long enough ones, some without a telling heading, and short ones."""
    told = F.concat(F.lit("<p>"), F.element_at(F.array(*(F.lit(f"We trained on {c} for 12 days") for c in CHIPS)), (F.col("page_id") % 7 + 1).cast("int")), F.lit(".</p>"))
    return table(spark, sf_dir, "pages").select(F.format_string("2401.%05d", "page_id").alias("arxiv_id"), F.when(F.col("page_id") % 4 == 3, F.col("html")).otherwise(F.concat(F.expr(_RENDER), told)).alias("html"))


@query()
def code_verdicts(spark, sf_dir):
    models, tree, files, _ = _snapshots(spark, sf_dir)
    out = verdicts.code_verdicts(models, tree, files, keeper(spark))
    return out.select("id", "chip_provider", "chip_provider_score", "chip_provider_confidence", F.array_join("detection_files", ",").alias("detection_files"), F.size("training_snippets").alias("n_training"), "error")


@query()
def paper_verdicts(spark, sf_dir):
    models, _, _, papers = _snapshots(spark, sf_dir)
    out = verdicts.paper_verdicts(models, _rendered(spark, sf_dir), papers, keeper(spark))
    return out.select("id", "chip_provider", "chip_provider_score", "chip_provider_confidence", F.array_join("detection_sections", ",").alias("detection_sections"), "source_render", "error")


def _linked(spark: SparkSession, sf_dir: str) -> DataFrame:
    mention = F.concat(F.lit("\nCode: https://github.com/org"), (F.col("doc_id") % 13).cast("string"), F.lit("/model-"), F.col("doc_id").cast("string"), F.lit(" and https://github.com/huggingface/transformers, our paper https://arxiv.org/abs/2401."), F.lpad((F.col("doc_id") % 60).cast("string"), 5, "0"), F.lit("\n"))
    return cards(spark, sf_dir).select("id", F.concat("card", mention).alias("modelcard"), F.col("doc_id").alias("pos"), F.lit(2024).alias("year"), F.lit(1).alias("month"))


@query()
def link_choice(spark, sf_dir):
    return link_and_rank(_linked(spark, sf_dir)).select("id", "main_github", "main_github_confidence", "main_arxiv", "main_arxiv_confidence")


def _told_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cards (id, modelcard, pos, year, month) of the models of _snapshots, mirrors too, that name their repository and paper, and others."""
    k = F.col("doc_id")
    own = F.concat(F.lit("\nCode: https://github.com/org"), (k % 13).cast("string"), F.lit("/repo"), k.cast("string"), F.lit(" and https://github.com/huggingface/transformers, our paper https://arxiv.org/abs/"), F.format_string("2401.%05d", k), F.lit(", see also https://arxiv.org/abs/1706.03762\n"))
    ids = F.when(k % 10 == 0, F.array("id", F.concat("id", F.lit("-mirror")))).otherwise(F.array("id"))
    return cards(spark, sf_dir).select(F.posexplode(ids).alias("n", "id"), F.concat("card", own).alias("modelcard"), k, F.lit(2024).alias("year"), F.lit(1).alias("month")).select("id", "modelcard", (k * 2 + F.col("n")).alias("pos"), "year", "month")


def _answers(rows: DataFrame) -> DataFrame:
    """Recorded answers (id, answer): a good quote, one that no card has, and none."""
    kind = F.pmod(F.xxhash64("id"), F.lit(3))
    quote = F.when(kind == 0, "Usage Deploy it with vLLM.").when(kind == 1, "trained on a moon base of nine lunar reactors")
    return rows.filter(quote.isNotNull()).select("id", F.concat(F.lit('training_evidence: "'), quote, F.lit('"\nconclusion: amd\nconfidence: high')).alias("answer"))


@query()
def end_to_end(spark, sf_dir):
    """Links of cards, the choice among them, verdicts of card, chosen repository and chosen paper (HTML, or else plain text), fusion,
    recorded answers and inheritance, each from what the one before it gave."""
    keep = keeper(spark)
    _, tree, files, papers = _snapshots(spark, sf_dir)
    rows = keep(link_and_rank(_told_of(spark, sf_dir)))
    card, code = keep(verdicts.card_verdicts(rows)), keep(verdicts.code_verdicts(rows, tree, files, keep))
    paper = keep(verdicts.paper_verdicts(rows, _rendered(spark, sf_dir), papers, keep))
    out = results(rows, card, code, paper, keep, _answers(rows))
    return out.select("id", "main_github", "main_arxiv", "gh_chip_provider", "ax_chip_provider", "chip_provider", "chip_provider_confidence", "chip_provider_source", "source_conflict", "quality_blocked_chip", "needs_llm")
