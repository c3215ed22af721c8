"""Literals that a regular expression cannot match without: a cheap test before an expensive one."""

from __future__ import annotations

import re
from functools import lru_cache
from re import _constants as C
from re import _parser as P

#: Letters beyond both cases that match an ASCII letter in any case, and those letters. No other letter of a pattern has such.
FOLDING, FOLDED = ("\u017f", "\u0131", "\u0130", "\u212a"), ("s", "i", "i", "k")


def lower_sql(text: str) -> str:
    """SQL of the lower-cased text in which gates look for their literals: letters that match an ASCII letter in any case stand as it."""
    return f"CASE WHEN {text} RLIKE '[{''.join(FOLDING)}]' THEN lower(translate({text}, '{''.join(FOLDING)}', '{''.join(FOLDED)}')) ELSE lower({text}) END"


def _better(a: frozenset[str] | None, b: frozenset[str] | None) -> frozenset[str] | None:
    """Of two sets the one whose shortest literal is longer."""
    if not a or not b:
        return a or b
    key = lambda s: (min(map(len, s)), -len(s))
    return a if key(a) >= key(b) else b


def _of(items) -> frozenset[str] | None:
    best, run = None, ""
    for op, arg in [*items, (None, None)]:
        if op is C.LITERAL:
            run += chr(arg).lower()
            continue
        if run:
            best, run = _better(best, frozenset([run])), ""
        own = None
        if op is C.SUBPATTERN:
            own = _of(arg[-1])
        elif op is C.BRANCH:
            each = [_of(a) for a in arg[1]]
            own = frozenset().union(*each) if all(each) else None
        elif op in (C.MAX_REPEAT, C.MIN_REPEAT, C.POSSESSIVE_REPEAT) and arg[0] > 0:
            own = _of(arg[2])
        elif op is C.ASSERT and arg[0] > 0:
            own = _of(arg[1])
        best = _better(best, own)
    return best


@lru_cache(maxsize=None)
def required(pattern: str) -> frozenset[str] | None:
    """Lower-case literals of which every match has at least one (look-aheads included); null where there are none."""
    return _of(P.parse(pattern, re.IGNORECASE))


#: A literal, or ("and" | "or", parts).
Gate = str | tuple


def _gate(items) -> Gate | None:
    parts, run = [], ""
    for op, arg in [*items, (None, None)]:
        if op is C.LITERAL:
            run += chr(arg).lower()
            continue
        if run:
            parts.append(run)
            run = ""
        own = None
        if op is C.SUBPATTERN:
            own = _gate(arg[-1])
        elif op is C.BRANCH:
            each = [_gate(a) for a in arg[1]]
            own = ("or", *dict.fromkeys(each)) if all(each) else None
        elif op in (C.MAX_REPEAT, C.MIN_REPEAT, C.POSSESSIVE_REPEAT) and arg[0] > 0:
            own = _gate(arg[2])
        elif op is C.ASSERT and arg[0] > 0:
            own = _gate(arg[1])
        if own:
            parts.append(own)
    parts = list(dict.fromkeys(parts))
    return None if not parts else parts[0] if len(parts) == 1 else ("and", *parts)


@lru_cache(maxsize=None)
def gate(pattern: str) -> Gate | None:
    """What the lower-cased text of every match has: literals joined by "and" and "or"; null where nothing can be said."""
    return _gate(P.parse(pattern, re.IGNORECASE))


def _first(items) -> tuple[set[str] | None, bool]:
    """(characters that a match of items can begin with, DIGIT for those of any script, null if unknown; whether items can match nothing)."""
    out: set[str] = set()
    for op, arg in items:
        own: set[str] | None = None
        empty = False
        if op in (C.AT, C.ASSERT, C.ASSERT_NOT):
            continue
        if op is C.LITERAL:
            own = {chr(arg)}
        elif op is C.IN and all(k in (C.LITERAL, C.RANGE) or (k, v) == (C.CATEGORY, C.CATEGORY_DIGIT) for k, v in arg):
            own = {x for k, v in arg for x in ([DIGIT] if k is C.CATEGORY else [chr(v)] if k is C.LITERAL else map(chr, range(v[0], min(v[1], v[0] + MOST_FIRST) + 1)))}
        elif op is C.SUBPATTERN:
            own, empty = _first(arg[-1])
        elif op is C.ATOMIC_GROUP:
            own, empty = _first(arg)
        elif op is C.BRANCH:
            each = [_first(a) for a in arg[1]]
            own, empty = (set().union(*(s for s, _ in each)) if all(s is not None for s, _ in each) else None), any(e for _, e in each)
        elif op in (C.MAX_REPEAT, C.MIN_REPEAT, C.POSSESSIVE_REPEAT):
            own, empty = _first(arg[2])
            empty |= arg[0] == 0
        if own is None:
            return None, False
        out |= own
        if not empty:
            return out, False
    return out, True


#: Characters of a class up to which it is worth a test, and those beyond both cases that a letter matches in any case.
MOST_FIRST, ALSO = 40, {"k": "\u212a", "s": "\u017f", "i": "\u0131\u0130"}

#: Digits of all scripts, as a class has them.
DIGIT = "\\p{Nd}"


@lru_cache(maxsize=None)
def first_class(pattern: str, digits: bool = False) -> str | None:
    """A class of all characters that a match in any case can begin with; null where there are too many, or none can be told, as of
    patterns that only Java reads, and, unless digits are asked for, of those that can begin with a digit of any script."""
    try:
        own, empty = _first(P.parse(pattern, re.IGNORECASE))
    except re.error:
        return None
    if own is None or empty or len(own) > MOST_FIRST or DIGIT in own and not digits or any(c.lower() != c.upper() and not c.isascii() for c in own):
        return None
    every = {x for c in own - {DIGIT} for x in (c.lower(), c.upper(), *ALSO.get(c.lower(), ""))} | own & {DIGIT}
    return "[" + "".join(c if c == DIGIT or c.isascii() and c.isalnum() else f"\\x{{{ord(c):x}}}" for c in sorted(every)) + "]"


def passes(gate: Gate | None, low: str) -> bool:
    """Whether a lower-cased text has what the gate asks for."""
    if gate is None or isinstance(gate, str):
        return gate is None or gate in low
    return (all if gate[0] == "and" else any)(passes(g, low) for g in gate[1:])
