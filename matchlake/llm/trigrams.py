"""Boolean trigram queries of regular expressions.

``query(pattern)`` gives clauses: every text with a match holds, lower-cased,
all trigrams of at least one clause.  ``None`` means that no trigram is
mandatory.  The derivation walks the parsed pattern and keeps the set of
strings that the part read last can be; where a part can be too many strings,
the set so far becomes a condition (one of its strings is there) and a new one
begins.  Conditions only ever get weaker than the pattern: a text they reject
has no match.
"""

from __future__ import annotations

from itertools import product
from re import _constants as op
from re import _parser

MOST_STRINGS = 64      # strings a part is followed through as
MOST_CLAUSES = 64      # clauses of a query

Clauses = frozenset[frozenset[str]]
ALWAYS: Clauses = frozenset([frozenset()])


def _least(clauses) -> Clauses:
    """Clauses without those that hold another one."""
    return frozenset(c for c in clauses if not any(d < c for d in clauses))


def _and(a: Clauses, b: Clauses) -> Clauses:
    both = _least({x | y for x, y in product(a, b)})
    return both if len(both) <= MOST_CLAUSES else min(a, b, key=len)


def _grams(s: str) -> frozenset[str]:
    """ASCII trigrams: of other letters, lower case is not the same everywhere."""
    return frozenset(g for g in (s[i:i + 3] for i in range(len(s) - 2)) if g.isascii())


def _one_of(strings: set[str]) -> Clauses:
    return _least({_grams(s) for s in strings})


def _class(items) -> set[str] | None:
    """The characters of a bracket, lower-cased; None if they are many or unknown."""
    out: set[str] = set()
    for kind, value in items:
        if kind is op.LITERAL:
            out.add(chr(value).lower())
        elif kind is op.RANGE and value[1] - value[0] < MOST_STRINGS:
            out |= {chr(c).lower() for c in range(value[0], value[1] + 1)}
        else:
            return None
    return out


def _walk(nodes) -> tuple[set[str] | None, Clauses]:
    """(the strings that the nodes can be or None, what holds besides)."""
    whole, strings, holds = True, {""}, ALWAYS

    def end() -> None:
        nonlocal whole, strings, holds
        holds, whole, strings = _and(holds, _one_of(strings)), False, {""}

    for kind, value in nodes:
        own: set[str] | None = None
        besides = ALWAYS
        if kind is op.LITERAL:
            own = {chr(value).lower()}
        elif kind is op.IN:
            own = _class(value)
        elif kind is op.SUBPATTERN:
            own, besides = _walk(value[3])
        elif kind is op.BRANCH:
            parts = [_walk(p) for p in value[1]]
            if all(s is not None for s, _ in parts):
                own = set().union(*(s for s, _ in parts))
            else:
                besides = _least(set().union(*(h if s is None else _and(h, _one_of(s)) for s, h in parts)))
        elif kind in (op.MAX_REPEAT, op.MIN_REPEAT):
            low, high, inner = value
            part, inside = _walk(inner)
            if part is not None and high == 1:
                own = part | ({""} if low == 0 else set())
            elif part is not None and low == high and len(part) ** low <= MOST_STRINGS:
                own = {"".join(p) for p in product(part, repeat=low)}
            elif low:
                besides = inside if part is None else _one_of(part)
        if own is not None and len(own) * len(strings) <= MOST_STRINGS:
            strings = {a + b for a, b in product(strings, own)}
        elif own is not None and len(own) <= MOST_STRINGS:
            end()
            strings = own
        else:
            end()
        holds = _and(holds, besides)
    if whole:
        return strings, holds
    end()
    return None, holds


def query(pattern: str) -> list[frozenset[str]] | None:
    strings, holds = _walk(_parser.parse(pattern))
    clauses = holds if strings is None else _and(holds, _one_of(strings))
    return None if frozenset() in clauses else sorted(clauses, key=sorted)
