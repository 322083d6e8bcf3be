"""Boolean trigram queries of regular expressions.

A query is a list of alternatives, each a set of trigrams that must all occur in any text
the expression matches; None means that nothing is mandatory. Trigrams are lower-case.

The grammar is the part of regular expressions that rules need: literals, escapes, classes,
groups, `|` and the quantifiers `? * + {m} {m,n}`. Anything else raises ValueError.
"""

from __future__ import annotations

import re

#: Above so many alternatives a piece counts as unknown, which only widens the query.
_WIDE = 64
_SMALL_CLASS = 8
_GAP = None
# One alternative is a tuple of literal strings and gaps; an expression is a set of them.
Pieces = frozenset[tuple]
_UNKNOWN: Pieces = frozenset({(_GAP,)})
_EMPTY: Pieces = frozenset({()})


def required_trigrams(pattern: str) -> list[frozenset[str]] | None:
    pieces, rest = _alternatives(pattern, 0)
    if rest != len(pattern):
        raise ValueError(f"unbalanced group in {pattern!r}")
    query = {_grams(piece) for piece in pieces}
    if not all(query):
        return None
    # An alternative that asks for more than another adds nothing.
    return sorted((q for q in query if not any(other < q for other in query)), key=sorted)


def _join(left: Pieces, right: Pieces) -> Pieces:
    if len(left) * len(right) > _WIDE:
        return _widened(left, right)
    return frozenset(_merge(a, b) for a in left for b in right)


def _grams(piece: tuple) -> frozenset[str]:
    return frozenset(run[i : i + 3] for run in piece if run is not _GAP for i in range(len(run) - 2))


def _widened(left: Pieces, right: Pieces) -> Pieces:
    """Too many combinations: keep the side that says more, forget the other."""

    def least(pieces: Pieces) -> int:
        return min(len(_grams(p)) for p in pieces)

    if least(left) >= least(right):
        return frozenset(_merge(a, (_GAP,)) for a in left)
    return frozenset(_merge((_GAP,), b) for b in right)


def _merge(a: tuple, b: tuple) -> tuple:
    if a and b and a[-1] is not _GAP and b[0] is not _GAP:
        return (*a[:-1], a[-1] + b[0], *b[1:])
    if a and b and a[-1] is _GAP and b[0] is _GAP:
        return (*a, *b[1:])
    return (*a, *b)


def _alternatives(pattern: str, i: int) -> tuple[Pieces, int]:
    found: set[tuple] = set()
    while True:
        branch, i = _sequence(pattern, i)
        found |= branch
        if i < len(pattern) and pattern[i] == "|":
            i += 1
            continue
        return (frozenset(found) if len(found) <= _WIDE else _UNKNOWN), i


def _sequence(pattern: str, i: int) -> tuple[Pieces, int]:
    done = _EMPTY
    while i < len(pattern) and pattern[i] not in "|)":
        atom, i = _atom(pattern, i)
        low, high, i = _quantifier(pattern, i)
        done = _join(done, _repeated(atom, low, high))
    return done, i


def _repeated(atom: Pieces, low: int, high: int | None) -> Pieces:
    if (low, high) == (0, 1):
        return atom | _EMPTY
    done = _EMPTY
    for _ in range(min(low, 3)):
        done = _join(done, atom)
    return done if high == low <= 3 else _join(done, _UNKNOWN)


def _quantifier(pattern: str, i: int) -> tuple[int, int | None, int]:
    simple = {"?": (0, 1), "*": (0, None), "+": (1, None)}
    low, high = 1, 1
    if i < len(pattern) and pattern[i] in simple:
        (low, high), i = simple[pattern[i]], i + 1
    elif m := re.compile(r"\{(\d+)(,(\d*))?\}").match(pattern, i):
        low, i = int(m[1]), m.end()
        high = low if m[2] is None else int(m[3]) if m[3] else None
    else:
        return low, high, i
    return low, high, i + (i < len(pattern) and pattern[i] in "?+")  # lazy or possessive


def _atom(pattern: str, i: int) -> tuple[Pieces, int]:
    c = pattern[i]
    if c == "(":
        if pattern.startswith("(?", i):
            if not pattern.startswith("(?:", i):
                raise ValueError(f"unsupported group in {pattern!r}")
            i += 2
        inner, i = _alternatives(pattern, i + 1)
        if i >= len(pattern):
            raise ValueError(f"unbalanced group in {pattern!r}")
        return inner, i + 1
    if c == "[":
        return _class(pattern, i)
    if c in "^$":
        return _EMPTY, i + 1
    if c == ".":
        return _UNKNOWN, i + 1
    if c in "?*+{":
        raise ValueError(f"misplaced {c!r} in {pattern!r}")
    if c == "\\":
        value, i = _escape(pattern, i)
        if value in ("b", "B", "A", "Z"):
            return _EMPTY, i
        return (_UNKNOWN if value is None else _literal(value[1:])), i
    return _literal(c), i + 1


def _literal(c: str) -> Pieces:
    return frozenset({(c.lower(),)})


def _escape(pattern: str, i: int) -> tuple[str | None, int]:
    """`=c` for a character, a bare letter for a position, None for a class."""
    if i + 1 >= len(pattern):
        raise ValueError(f"trailing backslash in {pattern!r}")
    c = pattern[i + 1]
    if c == "x":
        return "=" + chr(int(pattern[i + 2 : i + 4], 16)), i + 4
    if c in "dDsSwW":
        return None, i + 2
    if c in "bBAZ":
        return c, i + 2
    controls = {"n": "\n", "t": "\t", "r": "\r", "f": "\f", "v": "\v"}
    if c.isalnum() and c not in controls:
        raise ValueError(f"unsupported escape in {pattern!r}")
    return "=" + controls.get(c, c), i + 2


def _class(pattern: str, i: int) -> tuple[Pieces, int]:
    """The characters of a small class as alternatives, other classes as unknown."""
    i += 1
    known = i < len(pattern) and pattern[i] != "^"
    i += not known
    chars: set[str] = set()
    first = True
    while i < len(pattern) and (pattern[i] != "]" or first):
        first = False
        if pattern[i] == "\\":
            value, i = _escape(pattern, i)
            known = known and value is not None and value[0] == "="
            chars.add((value or "=")[1:])
        elif i + 2 < len(pattern) and pattern[i + 1] == "-" and pattern[i + 2] != "]":
            low, high = ord(pattern[i]), ord(pattern[i + 2])
            known = known and high - low < _SMALL_CLASS
            chars |= {chr(k) for k in range(low, min(high, low + _SMALL_CLASS) + 1)}
            i += 3
        else:
            chars.add(pattern[i])
            i += 1
    if i >= len(pattern):
        raise ValueError(f"unbalanced class in {pattern!r}")
    folded = {c.lower() for c in chars}
    return (frozenset((c,) for c in folded) if known and len(folded) <= _SMALL_CLASS else _UNKNOWN), i + 1
