"""Structure of cards and papers: front matter, sections, tags, headings, file kinds."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tracewell.functions import fixed_values as V
from tracewell.functions.expr import all_groups, any_of, first_of, found, group, matched, rx, spans, window

SECTIONS = "array<struct<section_type:string,text:string>>"


def py_strip(text: Column) -> Column:
    """Without white space (Unicode) at both ends."""
    return F.regexp_replace(text, rx("\\A\\s+|\\s+\\z", "U"), "")


def front_matter(card: Column) -> Column:
    """struct(yaml, body)."""
    end = F.locate("\n---", card, 4)
    has = F.startswith(card, F.lit("---")) & (end > 0)
    return F.struct(F.when(has, F.substring(card, F.lit(4), end - 4)).otherwise("").alias("yaml"), F.when(has, F.substring(card, end + 4, F.length(card))).otherwise(card).alias("body"))


def card_sections(body: Column) -> Column:
    """Sections of a markdown body: every line that begins with # opens one, its heading line included."""
    pieces = F.split(body, "(?md)(?=^#)", -1)
    last = F.size(pieces) - 1

    def section(piece: Column, k: Column) -> Column:
        text = F.when(F.endswith(piece, F.lit("\n")) & (k < last), F.substring(piece, F.lit(1), F.length(piece) - 1)).otherwise(piece)
        line = F.substring_index(piece, "\n", 1)
        kind = first_of([(~F.startswith(piece, F.lit("#")), "body"), (matched(line, V.CARD_TRAINING_HEADING), "training"), (matched(line, V.CARD_COMPATIBILITY_HEADING), "compatibility"), (matched(line, V.CARD_REFERENCES_HEADING), "references")], "body")
        return F.struct(kind.alias("section_type"), text.alias("text"))

    return F.transform(pieces, section)


def yaml_tags(yaml: Column) -> Column:
    """Tags of list items, in order, and then of the first inline list."""
    listed = F.transform(all_groups(yaml, "(?:^|\\n)\\s*-\\s+(\\S+)", 1, "Ud"), lambda t: F.lower(py_strip(t)))
    inline = F.split(F.coalesce(group(F.lower(yaml), "tags:\\s*\\[([^\\]]+)\\]", 1, "Ud"), F.lit("")), ",")
    return F.concat(listed, F.transform(inline, lambda t: F.btrim(py_strip(t), F.lit("'\""))))


def derivative(yaml: Column, model_id: Column, body: Column, strict: bool = True) -> Column:
    """struct(is_derivative, base_model, runtime_library). With strict=False a list under base_model gives its first item
    instead of the list's dash."""
    library = group(F.lower(yaml), "library_name:\\s*(\\S+)", 1, "Ud")
    base = group(yaml, "base_model:\\s*(\\S+)", 1, "Ud")
    if not strict:
        base = F.coalesce(group(yaml, "base_model:\\s*\\n\\s*-\\s*(\\S+)", 1, "Ud"), base)
    strong = found(model_id, V.STRONG_DERIVATIVE_NAME)
    runtime = F.coalesce(F.when(library.isin(*V.RUNTIME_LIBRARIES), library), F.when(strong, first_of((found(model_id, p), r) for r, p in V.NAME_RUNTIMES)))
    tuned = found(F.substring(body, 1, 500), V.FINETUNE_TITLE, "iUmd") | found(body, V.FINETUNE_BODY)
    is_one = runtime.isNotNull() | strong | (found(model_id, V.DERIVATIVE_NAME) & base.isNotNull()) | tuned
    return F.struct(F.coalesce(is_one, F.lit(False)).alias("is_derivative"), base.alias("base_model"), runtime.alias("runtime_library"))


def labelled_text(yaml: Column, sections: Column) -> Column:
    """Sections for a reader with little room: training first, then compatibility, body, references, and the front matter."""
    rank = lambda s: F.when(s["section_type"] == "training", 0).when(s["section_type"] == "compatibility", 2).when(s["section_type"] == "references", 4).otherwise(3)
    ordered = F.array_sort(F.transform(sections, lambda s, k: F.struct(rank(s).alias("rank"), k.alias("pos"), s["section_type"].alias("section_type"), py_strip(s["text"]).alias("text"))))
    parts = F.transform(F.filter(ordered, lambda s: s["text"] != ""), lambda s: F.concat(F.lit("=== ["), F.upper(s["section_type"]), F.lit("] ===\n"), s["text"]))
    head = py_strip(yaml)
    front = F.when(head != "", F.array(F.concat(F.lit("=== [YAML FRONTMATTER] ===\n"), F.substring(head, 1, 800)))).otherwise(F.array().cast("array<string>"))
    return F.array_join(F.concat(parts, front), "\n\n")


def strip_tags(html: Column) -> Column:
    text = F.regexp_replace(html, rx("<[^>]+>", "U"), " ")
    for entity, character in (("&amp;", "&"), ("&lt;", "<"), ("&gt;", ">"), ("&nbsp;", " "), ("&#x27;", "'")):
        text = F.replace(text, F.lit(entity), F.lit(character))
    return py_strip(F.regexp_replace(text, rx("\\s+", "U"), " "))


def heading_type(heading: Column) -> Column:
    text = F.lower(strip_tags(heading))
    return first_of([(F.contains(text, F.lit("abstract")), "abstract"), (found(text, V.PAPER_TRAINING_HEADING), "training"), (found(text, V.PAPER_METHOD_HEADING), "method"), (found(text, V.PAPER_RESULTS_HEADING), "results"), (found(text, V.PAPER_REFERENCES_HEADING), "references")], "body")


_HEADING = "<h[1-3][^>]*>.*?</h[1-3]>"


def html_sections(html: Column) -> Column:
    """The abstract block, if there is one, and the text under each heading of level one to three."""
    block = group(html, "<h\\d[^>]*>[^<]*abstract[^<]*</h\\d>(.*?)(?=<h[1-3])", 1, "iUds")
    abstract = F.when(block.isNotNull(), F.array(F.struct(F.lit("abstract").alias("section_type"), F.substring(strip_tags(block), 1, 5000).alias("text")))).otherwise(F.array().cast(SECTIONS))
    bodies = F.split(html, rx(_HEADING, "iUds"), -1)
    kinds = F.concat(F.array(F.lit("body")), F.transform(all_groups(html, _HEADING, 0, "iUds"), lambda h: heading_type(F.regexp_extract(h, rx("\\A<h[1-3][^>]*>(.*?)</h[1-3]>\\z", "iUds"), 1))))
    rows = F.filter(F.zip_with(kinds, bodies, lambda k, b: F.struct(k.alias("section_type"), b.alias("text"))), lambda s: found(s["text"], "\\S", "U"))
    return F.concat(abstract, F.transform(rows, lambda s: F.struct(s["section_type"].alias("section_type"), F.substring(strip_tags(s["text"]), 1, 15000).alias("text"))))


def render_ok(html: Column) -> Column:
    """A real article: enough text, and a heading of training, method or results."""
    headings = F.transform(all_groups(html, "<h[2-3][^>]*>(.*?)</h[2-3]>", 1, "iUds"), lambda h: F.lower(strip_tags(h)))
    told = lambda h: any_of(found(h, p) for p in (V.PAPER_TRAINING_HEADING, V.PAPER_METHOD_HEADING, V.PAPER_RESULTS_HEADING))
    return F.coalesce((F.length(strip_tags(html)) >= 15000) & F.exists(headings, told), F.lit(False))


def plain_sections(text: Column) -> Column:
    """Sections of a paper's plain text by numbered or telling heading lines; fewer than four: one training section."""
    own = V.PDF_HEADING.replace("(?m)", "")
    at = spans(text, own, None, "iUmd")
    names = all_groups(text, own, 1, "iUmd")
    before = py_strip(F.substring(text, F.lit(1), F.get(at, F.lit(0))["start"]))
    first = F.when(F.length(before) > 200, F.array(F.struct(F.lit("abstract").alias("section_type"), F.substring(before, 1, 5000).alias("text")))).otherwise(F.array().cast(SECTIONS))
    gaps = F.slice(F.split(text, rx(own, "iUmd"), -1), F.lit(2), F.size(at))
    rest = F.filter(F.zip_with(names, gaps, lambda n, b: F.struct(heading_type(n).alias("section_type"), py_strip(b).alias("text"))), lambda s: s["text"] != "")
    return F.when(F.size(at) < 4, F.array(F.struct(F.lit("training").alias("section_type"), text.alias("text")))).otherwise(F.concat(first, rest))


def file_tier(path: Column) -> Column:
    return first_of([(any_of(found(path, p) for p in V.TIER1_PATHS), 1), (any_of(found(path, p) for p in V.TIER2_PATHS), 2)])


def file_weight(path: Column) -> Column:
    return first_of([(found(path, V.TRAINING_FILE), 1.5), (found(path, V.RUNTIME_FILE), 0.3), (found(path, V.DOCS_FILE), 0.5)], 1.0)


def is_dependency_file(path: Column) -> Column:
    return found(path, V.DEPENDENCY_FILE)


def line_at(text: Column, at: Column) -> Column:
    """The line of text that holds the character at offset at."""
    return F.concat(F.substring_index(F.substring(text, F.lit(1), at), "\n", -1), F.substring_index(window(text, at, F.length(text)), "\n", 1))


def is_table_line(line: Column) -> Column:
    """A row of a markdown table: bounded by bars."""
    return found(line, "\\A\\s*\\|(?:.*\\|)?\\s*\\z", "Uds")
