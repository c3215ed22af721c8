"""Column builders: Python-equal regular expressions, exact match spans, context windows, rounding, evidence combination."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from tracewell.functions.literals import FOLDED, FOLDING, Gate, first_class, gate

SPAN = "array<struct<start:int,end:int>>"


def rx(pattern: str, flags: str = "iUd") -> str:
    """The pattern for Java as Python's re reads it on str: Unicode classes (U), only LF ends a line (d), any case (i).

    A match in any case is tried only where a character stands that it can begin with: a plain class tells that many times faster
    than word bounds and letters in any case, which are tables of Unicode."""
    first = first_class(pattern, True) if "i" in flags and "x" not in flags else None
    return f"(?={first})(?{flags}){pattern}" if first else f"(?{flags}){pattern}"


def found(text: Column | str, pattern: str, flags: str = "iUd") -> Column:
    return F.rlike(text, F.lit(rx(pattern, flags)))


def matched(text: Column | str, pattern: str, flags: str = "iUd") -> Column:
    """Like found, at the text's start only."""
    return F.rlike(text, F.lit(rx(f"\\A(?:{pattern})", flags)))


def group(text: Column | str, pattern: str, number: int = 1, flags: str = "iUd") -> Column:
    """The group of the first match, null where there is none."""
    return F.when(found(text, pattern, flags), F.regexp_extract(text, rx(pattern, flags), number))


def all_groups(text: Column | str, pattern: str, number: int = 0, flags: str = "iUd") -> Column:
    return F.regexp_extract_all(text, F.lit(rx(pattern, flags)), F.lit(number))


def may_match(text: Column, pattern: str) -> Column:
    """Whether the text has the literals that the pattern, in any case, cannot match without."""
    own = gate(pattern)
    if own is None:
        return F.lit(True)

    def test(own: Gate, low: Column) -> Column:
        if isinstance(own, str):
            return F.contains(low, F.lit(own))
        return reduce(and_ if own[0] == "and" else or_, (test(g, low) for g in own[1:]))

    odd = F.translate(text, "".join(FOLDING), "".join(FOLDED))
    low = F.lower(F.when(F.rlike(text, F.lit(f"[{''.join(FOLDING)}]")), odd).otherwise(text))
    return F.exists(F.array(low), lambda low: test(own, low))


#: What stands around matches while they are searched, and what a text's own such characters count as: to patterns both are alike.
MARK, OTHER_MARK = "\x01", "\x02"


def spans(text: Column, pattern: str, most: int | None = None, flags: str = "iUd") -> Column:
    """Start and end (code points) of all matches, or the first ``most``; patterns must not match the empty string, nor name MARK.

    One search puts marks around the matches; the text cut at the marks gives lengths, whose running sums are the offsets. A text without
    the pattern's literals is not searched, and one without matches not cut.
    """
    none = F.array().cast(SPAN)
    start = F.struct(F.lit(0).alias("at"), F.lit(False).alias("own"), none.alias("out"))

    def step(a: Column, n: Column) -> Column:
        end = a["at"] + n
        return F.struct(end.alias("at"), (~a["own"]).alias("own"), F.when(a["own"], F.concat(a["out"], F.array(F.struct(a["at"].alias("start"), end.alias("end"))))).otherwise(a["out"]).alias("out"))

    def offsets(marked: Column) -> Column:
        every = F.transform(F.split(marked, MARK, -1), lambda p: F.length(p))
        return F.aggregate(every if most is None else F.slice(every, 1, 2 * most), start, step, lambda a: a["out"])

    marked = F.regexp_replace(F.replace(text, F.lit(MARK), F.lit(OTHER_MARK)), F.lit(rx(pattern, flags)), F.lit(f"{MARK}$0{MARK}"))
    found = F.get(F.transform(F.array(marked), lambda m: F.when(F.contains(m, F.lit(MARK)), offsets(m)).otherwise(none)), F.lit(0))
    return F.when(text.isNull() | may_match(text, pattern), found).otherwise(none)


def window(text: Column, begin: Column, end: Column) -> Column:
    """text[begin:end] with both clamped to the text."""
    low = F.greatest(begin, F.lit(0))
    return F.substring(text, low + 1, F.greatest(F.least(end, F.length(text)) - low, F.lit(0)))


def py_round(x: Column, places: int) -> Column:
    """Round half to even on the decimal value of the double, as Python does."""
    return F.call_function("format_number", x.cast("double"), F.lit("0" if places == 0 else "0." + "0" * places)).cast("double")


def noisy_or(values: Column) -> Column:
    """1 - prod(1 - c) over an array of confidences; nulls and non-positive ones don't count."""
    return 1 - F.aggregate(F.filter(values, lambda c: c.isNotNull() & (c > 0)), F.lit(1.0), lambda p, c: p * F.greatest(F.lit(0.0), 1 - c))


def any_of(conditions: Iterable[Column]) -> Column:
    out = F.lit(False)
    for c in conditions:
        out = out | c
    return out


def first_of(cases: Iterable[tuple[Column, object]], otherwise: object = None) -> Column:
    """The value of the first case that holds."""
    out = None
    for condition, value in cases:
        value = value if isinstance(value, Column) else F.lit(value)
        out = F.when(condition, value) if out is None else out.when(condition, value)
    otherwise = otherwise if isinstance(otherwise, Column) else F.lit(otherwise)
    return otherwise if out is None else out.otherwise(otherwise)


def table_of(values: dict, key: Column) -> Column:
    """values[key], null where there is none: one CASE of literals."""
    return first_of(((key == k, v) for k, v in values.items()))
