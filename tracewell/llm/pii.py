"""Personal data by boosted trees over candidate spans, in DataFrame functions only.

*Base* spans come from fixed patterns and always count.  Beyond them, *generators* of high recall propose candidate spans,
which may overlap: telephone-like and identity-like groups of digits, masked mail addresses, account codes, and secrets
after a telling word.  Each candidate has features of its format and of the text around it; boosted regression trees
(logistic loss), turned into one CASE expression, give a score, Platt scaling makes it a probability, and a threshold by
kind, set on held-out examples for a required precision, selects spans.  A selected span that overlaps a base span, or a
likelier selected one, is left out.

The trees are trained here, at first use, on a few thousand labelled examples that a seeded generator writes (no labelled
corpus of personal data is at hand); their features are computed by the same expressions as those of documents.

All patterns run over whole texts.  Repetitions are possessive and start only where a run starts or where the last match
ended, which finds the same matches in linear time and without recursion, however long a run is.
"""

from __future__ import annotations

import random
from collections.abc import Callable
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Base kinds in their order of listing, as patterns equal to those of the task; the second item must be in the text.
BASE = {
    "email": ("(?:\\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\\.[A-Za-z0-9-]++)++", "@"),
    "ip": ("(?:\\G|(?<![0-9]))[0-9]++\\.[0-9]++\\.[0-9]++\\.[0-9]++", None),
    "card": ("(?:\\G|(?<![0-9]))[0-9](?:[\\x20-]?[0-9])++", None),
    "phone": ("\\+[0-9][\\x20().0-9-]+[0-9]", "+"),
}
#: Generators: kind, pattern, and what must be in the text ("0": a digit).
GENERATORS = (
    ("phone", "(?<![0-9A-Za-z+.-])\\(?[0-9]{2,}+\\)?(?:[\\x20./-]{1,2}+\\(?[0-9]{2,}+\\)?)++(?![0-9A-Za-z])", "0"),
    ("email", "(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++\\x20?(?:[\\[({](?i:at)[\\])}]|\\x20(?i:at)\\x20|@)\\x20?[A-Za-z0-9-]++(?:\\x20?(?:\\.|[\\[({](?i:dot)[\\])}]|\\x20(?i:dot)\\x20)\\x20?[A-Za-z0-9-]++)++", "at"),
    ("id", "(?<![0-9A-Za-z])(?:[0-9]{3}-[0-9]{2}-[0-9]{4}|[A-Z]{2}[0-9]{2}(?:\\x20?[A-Z0-9]{4}){3,}+(?:\\x20?[A-Z0-9]{1,3})?)(?![0-9A-Za-z])", "0"),
    ("secret", "(?i)(?<![a-z0-9])(?:password|passwd|passphrase|pwd|token|secret|api[_-]?key|access[_-]?key)[\"']?\\x20?[=:]\\x20?[\"']?[a-z0-9_/+.!#$%-]{6,}+={0,2}", "=:"),
)
KINDS = ("email", "ip", "card", "phone", "id", "secret")
LEFT, RIGHT = 32, 8
FEATURES = ("digits", "separators", "letters", "length", "groups", "parens", "phone_word", "id_word", "number_word", "dated", "telling", "mixed", "shortest", "sentence")
ROUNDS, SHRINK, PRECISION, SEED = 40, 0.3, 0.98, 11


#: Elements of a block of a running total.
RUN = 256


def with_running(rows: DataFrame, values: str, name: str, least: int, join: Callable[[Column, Column], Column]) -> DataFrame:
    """rows with the array column name: the elements of the array column values brought together by join, up to each, in work near the
    number of elements: blocks of RUN of them, and blocks of their totals, each begin with what stands before them."""
    zero = F.lit(least)
    blocks = lambda of: F.transform(F.sequence(F.lit(0), F.greatest(F.ceil(F.size(of) / RUN).cast("int") - 1, F.lit(0))), lambda b: F.slice(of, b * RUN + 1, RUN))
    totals = lambda of: F.transform(of, lambda part: F.aggregate(part, zero, join))
    before = lambda of: F.transform(of, lambda _, k: F.aggregate(F.slice(of, F.lit(1), k), zero, join))
    # of a part, what stands before or up to each of its elements, begun with what stands before the part
    within = lambda up_to: lambda part, start: F.transform(part, lambda _, k: F.aggregate(F.slice(part, F.lit(1), k + up_to), start, join))
    rows = rows.withColumn("__parts", blocks(F.col(values)))
    rows = rows.withColumn("__tops", totals(F.col("__parts"))).withColumn("__wide", blocks(F.col("__tops")))
    rows = rows.withColumn("__heads", totals(F.col("__wide"))).withColumn("__heads", before(F.col("__heads")))
    rows = rows.withColumn("__tops", F.flatten(F.zip_with("__wide", "__heads", within(0))))
    return rows.withColumn(name, F.flatten(F.zip_with("__parts", "__tops", within(1)))).drop("__parts", "__tops", "__wide", "__heads")


def matches(rows: DataFrame, text: str, name: str, pattern: str, needs: Column) -> DataFrame:
    """rows with the array column name: every match of pattern as (start, end, value, left, right), left and right being
    what stands between it and its neighbours, cut to LEFT and RIGHT characters; empty where needs is not true."""
    none = F.array().cast("array<string>")
    rows = rows.withColumn("__found", F.when(needs, F.regexp_extract_all(F.col(text), F.lit(pattern), F.lit(0))).otherwise(none))
    rows = rows.withColumn("__gaps", F.when(F.size("__found") > 0, F.split(F.col(text), pattern, -1)).otherwise(none))
    rows = rows.withColumn("__sizes", F.zip_with(F.slice("__gaps", F.lit(1), F.size("__found")), "__found", lambda g, v: F.length(g) + F.length(v)))
    rows = with_running(rows, "__sizes", "__ends", 0, lambda a, x: a + x)
    span = lambda v, k: F.struct((F.get("__ends", k) - F.length(v)).alias("start"), F.get("__ends", k).alias("end"), v.alias("value"), F.right(F.get("__gaps", k), F.lit(LEFT)).alias("left"), F.left(F.get("__gaps", k + 1), F.lit(RIGHT)).alias("right"))
    return rows.withColumn(name, F.when(F.size("__found") > 0, F.transform("__found", span)).otherwise(F.array().cast("array<struct<start:int,end:int,value:string,left:string,right:string>>"))).drop("__found", "__gaps", "__sizes", "__ends")


def digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(number: Column) -> Column:
    own = F.split(F.reverse(number), "")
    doubled = lambda d, k: F.when(k % 2 == 0, d.cast("int")).otherwise(d.cast("int") * 2 - F.when(d.cast("int") > 4, 9).otherwise(0))
    return F.aggregate(F.transform(F.filter(own, lambda d: d != ""), doubled), F.lit(0), lambda a, x: a + x) % 10 == 0


_OCTET = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{1,2})"


def valid(kind: str, span: Column) -> Column:
    value = span["value"]
    if kind == "ip":
        return F.rlike(value, F.lit(f"\\A{_OCTET}(?:\\.{_OCTET}){{3}}\\z"))
    if kind == "card":
        return F.length(digits(value)).between(12, 19) & luhn(digits(value))
    if kind == "phone":
        return F.length(digits(value)).between(9, 15)
    return F.lit(True)


def features(span: Column) -> list[Column]:
    value, left = span["value"], F.lower(span["left"])
    count = lambda pattern: F.length(F.regexp_replace(value, f"[^{pattern}]", ""))
    has = lambda where, pattern: F.rlike(where, F.lit(pattern)).cast("int")
    return [
        count("0-9"), count("\\x20./\\-"), count("A-Za-z"), F.length(value), F.size(F.split(value, "[^0-9A-Za-z]+")), count("()\\[\\]"),
        has(left, "(?:phone|tel|call|fax|mobile|cell|whatsapp|sms|contact|reach|dial)[a-z]*[^a-z]{0,4}(?:[a-z]{1,8}[^a-z]{0,3}){0,2}\\z"),
        has(left, "(?:ssn|social|iban|passport|tax|identity|insurance|account|acct)[a-z]*[^a-z]{0,4}(?:[a-z]{1,8}[^a-z]{0,3}){0,2}\\z"),
        has(left, "(?:version|isbn|page|pages|order|item|invoice|ref|no|chapter|fig|figure|table|score|row|issue|vol|pp)[^a-z]{0,4}\\z"),
        has(value, "\\A(?:[12][0-9]{3}[./-][0-9]{1,2}[./-][0-9]{1,2}|[0-9]{1,2}[./-][0-9]{1,2}[./-](?:[0-9]{2}){1,2}|[12][0-9]{3}[\\x20/-]{1,2}[12][0-9]{3})\\z"),
        has(F.lower(value), "(?:pass|pwd|token|secret|key)"), has(value, "[0-9].*[A-Za-z].*[0-9]|[A-Za-z].*[0-9].*[A-Za-z]"),
        F.array_min(F.transform(F.split(value, "[^0-9A-Za-z]+"), lambda p: F.length(p))), has(value, "\\.\\x20"),
    ]


def examples(n: int = 4000, seed: int = SEED) -> list[tuple[str, str, str, str, int]]:
    """(kind, left, value, right, label): written candidates, half of them personal data or secrets, half look-alikes."""
    rng = random.Random(seed)
    num = lambda k: "".join(rng.choice("0123456789") for _ in range(k))
    word = lambda a=3, b=9: "".join(rng.choice("abcdefghilmnoprstuv") for _ in range(rng.randint(a, b)))
    code = lambda k: "".join(rng.choice("abcdef0123456789ABCXYZ_") for _ in range(k))
    plain = lambda: " ".join(word() for _ in range(rng.randint(1, 4))) + " "
    call = lambda: plain() + rng.choice(["call ", "phone: ", "tel. ", "fax ", "mobile no ", "contact us at ", "reach me on "])
    good = {
        "phone": lambda: (rng.choice([call, call, plain])(), rng.choice([f"({num(3)}) {num(3)}-{num(4)}", f"{num(3)}-{num(3)}-{num(4)}", f"0{num(3)} {num(3)} {num(4)}", f"{num(3)}.{num(3)}.{num(4)}", f"0{num(1)} {num(2)} {num(2)} {num(2)} {num(2)}"])),
        "email": lambda: (plain(), f"{word()}{rng.choice(['.', '_', ''])}{word()}" + rng.choice(["[at]", " (at) ", "(at)", " [at] ", " at "]) + word() + rng.choice([".", " [dot] ", "(dot)", " dot "]) + rng.choice(["com", "org", "net", "de"])),
        "id": lambda: (plain() + rng.choice(["ssn ", "SSN: ", "social security ", "iban ", "account ", ""]), rng.choice([f"{num(3)}-{num(2)}-{num(4)}", rng.choice(["DE", "FR", "ES", "GB"]) + num(2) + "".join(" " + num(4) for _ in range(rng.randint(4, 5)))])),
        "secret": lambda: (plain(), rng.choice(["password", "passwd", "token", "secret", "api_key", "API-KEY", "access_key"]) + rng.choice(["=", ": ", " = ", ' = "']) + code(rng.randint(10, 40))),
    }
    bad = {
        "phone": lambda: (plain() + rng.choice(["", "version ", "pages ", "order ", "score ", "isbn ", "no. ", "in "]), rng.choice([f"{rng.randint(1900, 2030)}-{rng.randint(10, 12)}-{rng.randint(10, 28)}", f"{num(2)}.{num(2)}.{rng.randint(1990, 2030)}", f"{rng.randint(1900, 2030)}-{rng.randint(1900, 2030)}", f"{num(2)} {num(2)}", f"{num(2)}.{num(3)}", f"{num(3)} {num(3)}", f"{num(2)}/{num(2)}", f"{num(3)}.{num(3)}.{num(3)}"])),
        "email": lambda: (plain(), rng.choice([f"{word()} at {word()}. {word().title()}", f"{word()} at {word()}. {word().title()}. {word().title()}", f"{word()} at {word()} . {word()}", f"{word()} at {word()}.{rng.choice(['The', 'But', 'And'])}"])),
        "id": lambda: (plain() + rng.choice(["item ", "ref ", "invoice ", "order "]), rng.choice([f"{num(3)}-{num(2)}-{num(4)}", "AB" + num(2) + "".join(rng.choice("ABCDEFGH") * 4 for _ in range(3))])),
        "secret": lambda: (plain(), rng.choice(["password", "token", "secret", "secret", "token"]) + rng.choice([": ", "="]) + word(6, 12)),
    }
    out = []
    for k in range(n):
        kind, label = rng.choice(sorted(good)), k % 2
        left, value = (good if label else bad)[kind]()
        out.append((kind, left[-LEFT:], value, rng.choice([" ", ". ", ", ", "\n"]) + word(), label))
    return out


@dataclass(frozen=True)
class Tree:
    """Depth two: a split (feature, at most) and one split and two leaves on each side."""

    split: tuple[int, float]
    sides: tuple[tuple[tuple[int, float], float, float], tuple[tuple[int, float], float, float]]


def grow(x: np.ndarray, gradient: np.ndarray, hessian: np.ndarray) -> Tree:
    def best(rows: np.ndarray) -> tuple[float, int, float]:
        found = (-1.0, 0, np.inf)
        for j in range(x.shape[1]):
            for t in np.unique(x[rows, j])[:-1]:
                low = rows[x[rows, j] <= t]
                gl, hl, g, h = gradient[low].sum(), hessian[low].sum(), gradient[rows].sum(), hessian[rows].sum()
                gain = gl**2 / (hl + 1) + (g - gl) ** 2 / (h - hl + 1) - g**2 / (h + 1)
                if gain > found[0]:
                    found = (gain, j, float(t))
        return found

    leaf = lambda rows: float(SHRINK * gradient[rows].sum() / (hessian[rows].sum() + 1)) if len(rows) else 0.0
    every = np.arange(len(x))
    _, j, t = best(every)
    sides = []
    for rows in (every[x[:, j] <= t], every[x[:, j] > t]):
        _, jj, tt = best(rows) if len(rows) > 1 else (0, 0, np.inf)
        sides.append(((jj, tt), leaf(rows[x[rows, jj] <= tt]), leaf(rows[x[rows, jj] > tt])))
    return Tree((j, t), (sides[0], sides[1]))


@dataclass(frozen=True)
class Model:
    start: float
    trees: tuple[Tree, ...]
    slope: float
    shift: float
    thresholds: dict[str, float]

    def margins(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.start)
        for t in self.trees:
            one, two = t.sides
            side = lambda s: np.where(x[:, s[0][0]] <= s[0][1], s[1], s[2])
            out += np.where(x[:, t.split[0]] <= t.split[1], side(one), side(two))
        return out

    def probability(self, own: list[Column]) -> Column:
        at_most = lambda split: own[split[0]] <= F.lit(split[1])
        total = F.lit(self.start)
        for t in self.trees:
            one, two = ((F.when(at_most(s[0]), F.lit(s[1])).otherwise(F.lit(s[2]))) for s in t.sides)
            total = total + F.when(at_most(t.split), one).otherwise(two)
        return 1 / (1 + F.exp(-(F.lit(self.slope) * total + F.lit(self.shift))))


def fit(x: np.ndarray, kinds: list[str], labels: np.ndarray) -> Model:
    """Boosting on two thirds of the examples; Platt scaling and thresholds on the rest."""
    own = np.arange(len(x)) % 3 != 2
    xs, ys = x[own], labels[own].astype(float)
    start = float(np.log(ys.mean() / (1 - ys.mean())))
    trees: list[Tree] = []
    margin = np.full(len(xs), start)
    for _ in range(ROUNDS):
        p = 1 / (1 + np.exp(-margin))
        trees.append(grow(xs, ys - p, p * (1 - p)))
        margin = Model(start, tuple(trees), 1, 0, {}).margins(xs)
    rest, truth = Model(start, tuple(trees), 1, 0, {}).margins(x[~own]), labels[~own].astype(float)
    slope, shift = 1.0, 0.0
    for _ in range(200):  # gradient ascent on two parameters
        p = 1 / (1 + np.exp(-(slope * rest + shift)))
        slope += 0.05 * float(((truth - p) * rest).mean())
        shift += 0.05 * float((truth - p).mean())
    p, thresholds = 1 / (1 + np.exp(-(slope * rest + shift))), {}
    for kind in dict.fromkeys(kinds):
        mine = np.array([k == kind for k in kinds])[~own]
        steps = np.unique(p[mine])
        good = [k for k, t in enumerate(steps) if truth[mine & (p >= t)].mean() >= PRECISION]
        # half-way between the least likely example that may be selected and the likeliest that may not
        thresholds[kind] = float((steps[good[0]] + (steps[good[0] - 1] if good[0] else 0)) / 2) if good else 1.0
    return Model(start, tuple(trees), slope, shift, thresholds)


@lru_cache(maxsize=1)
def _trained() -> Model:
    spark = SparkSession.active()
    rows = spark.createDataFrame([(k, *r) for k, r in enumerate(examples())], "no int, kind string, left string, value string, right string, label int")
    own = rows.select("no", "kind", F.struct("left", "value", "right").alias("span"), "label")
    found = sorted(own.select("no", "kind", F.array(*(f.cast("double") for f in features(F.col("span")))).alias("x"), "label").collect())
    return fit(np.array([r["x"] for r in found]), [r["kind"] for r in found], np.array([r["label"] for r in found]))


def detect(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """doc_id, base and spans of every row of docs: arrays of (start, kind_no, kind, end) in order of start, then kind (as in
    KINDS); offsets are code points, end exclusive. spans has all of base, and what the trees selected.

    Null texts count as empty; a null doc_id stays null; repeated rows are each searched; an empty table gives an empty
    result; other columns are not looked at.
    """
    model = model or _trained()
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumn("has_digit", F.rlike("text", F.lit("[0-9]")))
    for kind, (pattern, needs) in BASE.items():
        rows = matches(rows, "text", f"base_{kind}", pattern, F.contains("text", F.lit(needs)) if needs else F.col("has_digit"))
    may = {"0": F.col("has_digit"), "at": F.rlike("text", F.lit("(?i)[\\x20\\[({@]at[\\x20\\])}]")) | F.contains("text", F.lit("@")), "=:": F.contains("text", F.lit("=")) | F.contains("text", F.lit(":"))}
    for k, (_, pattern, needs) in enumerate(GENERATORS):
        rows = matches(rows, "text", f"more_{k}", pattern, may[needs])
    as_span = lambda kind: lambda s: F.struct(s["start"].alias("start"), F.lit(KINDS.index(kind)).alias("kind_no"), F.lit(kind).alias("kind"), s["end"].alias("end"))
    base = F.array_sort(F.concat(*(F.transform(F.filter(f"base_{kind}", _valid(kind)), as_span(kind)) for kind in BASE)))
    rows = rows.withColumn("base", base)
    scored = [F.filter(F.transform(F.transform(f"more_{k}", _described), _rated(model, kind)), _selected(model.thresholds.get(kind, 1.0))) for k, (kind, _, _) in enumerate(GENERATORS)]
    rows = rows.withColumn("more", F.concat(*scored))
    fixed = F.transform("base", lambda s: F.struct(s["start"].alias("start"), s["kind_no"].alias("kind_no"), s["kind"].alias("kind"), s["end"].alias("end"), F.lit(BASE_RANK).alias("p")))
    rows = rows.withColumn("every", F.when(F.size("more") > 0, F.array_sort(F.concat(fixed, "more"))))
    plain = F.transform("added", lambda s: F.struct(s["start"].alias("start"), s["kind_no"].alias("kind_no"), s["kind"].alias("kind"), s["end"].alias("end")))
    return with_selected(rows).select("doc_id", "base", F.array_sort(F.concat("base", plain)).alias("spans"))


#: A base span's rank among candidates: before any probability.
BASE_RANK = 2.0
SCORED = "array<struct<start:int,kind_no:int,kind:string,end:int,p:double>>"


def with_selected(rows: DataFrame) -> DataFrame:
    """rows with added: of every (spans in order of start, p the probability or BASE_RANK; null: none) those that overlap no base span,
    nor a likelier one (ties: the earlier start, then kind) of those that overlap no base span.

    The spans are cut to runs where one begins behind the ends of all before it; only spans of a run are compared with one another.
    """
    apart = lambda a, b: (a["end"] <= b["start"]) | (b["end"] <= a["start"])
    ahead = lambda a, b: (a["p"] > b["p"]) | ((a["p"] == b["p"]) & ((a["start"] < b["start"]) | ((a["start"] == b["start"]) & (a["kind_no"] < b["kind_no"]))))
    base = lambda s: s["p"] == F.lit(BASE_RANK)
    rows = with_running(rows.withColumn("__stops", F.transform("every", lambda s: s["end"])), "__stops", "__high", -1, lambda a, x: F.greatest(a, x))
    open_ = F.zip_with("every", F.concat(F.array(F.lit(-1)), F.slice("__high", F.lit(1), F.greatest(F.size("every") - 1, F.lit(0)))), lambda s, high: high <= s["start"])
    rows = rows.withColumn("__firsts", F.filter(F.transform(open_, lambda own, k: F.when(own, k)), lambda k: k.isNotNull()))
    ends = F.concat(F.slice("__firsts", F.lit(2), F.size("__firsts")), F.array(F.size("every")))
    runs = F.zip_with("__firsts", ends, lambda low, high: F.slice("every", low + 1, high - low))
    runs = F.transform(runs, lambda run: F.filter(run, lambda s: ~base(s) & F.forall(run, lambda o: ~base(o) | apart(o, s))))
    kept = F.flatten(F.transform(runs, lambda run: F.filter(run, lambda s: ~F.exists(run, lambda o: ahead(o, s) & ~apart(o, s)))))
    return rows.withColumn("added", F.coalesce(kept, F.array().cast(SCORED))).drop("__stops", "__high", "__firsts")


def _valid(kind: str):
    return lambda s: valid(kind, s)


def _selected(threshold: float):
    return lambda s: s["p"] >= F.lit(threshold)


def _described(span: Column) -> Column:
    """The features stand in an array, so that the trees' many splits do not compute them again."""
    return F.struct(span["start"].alias("start"), span["end"].alias("end"), F.array(*(f.cast("double") for f in features(span))).alias("x"))


def _rated(model: Model, kind: str):
    own = lambda s: [F.get(s["x"], F.lit(k)) for k in range(len(FEATURES))]
    return lambda s: F.struct(s["start"].alias("start"), F.lit(KINDS.index(kind)).alias("kind_no"), F.lit(kind).alias("kind"), s["end"].alias("end"), model.probability(own(s)).alias("p"))


def joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def digest(found: DataFrame) -> DataFrame:
    counts = [F.size(F.filter("base", _of(kind))).cast("long").alias(f"n_{kind}") for kind in BASE]
    return found.select("doc_id", *counts, F.sha2(joined(F.col("base")).cast("binary"), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))


def _of(kind: str):
    return lambda s: s["kind"] == kind


def redact(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """docs with a column redacted: text with each found span replaced by its kind in brackets (overlapping spans as one, by the
    first kind), in the place of any column of that name. Other columns stay, whatever their names. A null text stays null."""
    keyed = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("doc_id"), F.col("text"))
    found, text = detect(keyed, model).withColumnRenamed("doc_id", "__row"), F.col("__row").getField("text")
    step = lambda a, s: F.when(s["end"] <= a["at"], a).otherwise(F.struct(F.concat(a["out"], F.substring(text, a["at"] + 1, F.greatest(s["start"] - a["at"], F.lit(0))), F.when(s["start"] >= a["at"], F.concat(F.lit("["), s["kind"], F.lit("]"))).otherwise("")).alias("out"), s["end"].alias("at")))
    redacted = F.aggregate("spans", F.struct(F.lit("").alias("out"), F.lit(0).alias("at")), step, lambda a: F.concat(a["out"], F.substring(text, a["at"] + 1, F.length(text))))
    return found.select(*(F.col("__row").getField(c).alias(c) for c in docs.columns if c != "redacted"), redacted.alias("redacted"))
