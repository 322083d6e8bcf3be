"""Dictionary patterns: fixed regex semantics on the JVM, and index keys for them.

Dictionary patterns are hand-written regexes with one of two meanings:

* ASCII mode (default): letters match case-insensitively for A-Z only, and word
  characters, boundaries and blanks are ASCII. `\\bver\\b` matches in "éver".
* Unicode mode: case folding, word characters and boundaries are Unicode-aware.

In both `.` stops at a line feed only. Java's defaults differ from this (its boundary
even changed between releases), so `java_pattern` spells the meaning out.

`index_keys` lists short strings of which every matching text contains at least one.
They let a whole dictionary be looked up by words instead of tested pattern by pattern.
"""

from __future__ import annotations

import re
import unicodedata
from dataclasses import dataclass
from functools import cache
from re import _constants as sre
from re import _parser

from pyspark.sql import Column
from pyspark.sql import functions as F

_LETTERS = frozenset("abcdefghijklmnopqrstuvwxyz")
_MAX_VARIANTS = 64
_MIN_PREFIX = 3
# Word-start keys are cut to this length, so that a text's word starts are taken once or twice.
PREFIX_LENGTH = 5


class PatternError(ValueError):
    """The pattern cannot be used in a dictionary."""


def _parse(regex: str):
    if regex is None or not regex.strip():
        raise PatternError("empty pattern")
    body = re.sub(r"^\(\?[a-z]*(?:-[a-z]+)?\)", "", regex)
    body = _respelt(body)
    if re.search(r"\[:\^?[a-z]+:\]", body):
        # The parser below would read such a class as single characters.
        raise PatternError("POSIX character classes are not supported")
    try:
        return _parser.parse(body)
    except (re.error, OverflowError) as exc:
        raise PatternError(str(exc)) from exc


def _respelt(body: str) -> str:
    """Spellings of other pattern dialects in those of the parser: `(?<name>`, `\\z`, and `(?i:`, which every pattern is."""
    out, i, in_class = [], 0, False
    while i < len(body):
        if body[i] == "\\" and i + 1 < len(body):
            out.append("\\Z" if body[i + 1] == "z" and not in_class else body[i : i + 2])
            i += 2
            continue
        if in_class:
            in_class = body[i] != "]"
        elif body[i] == "[":
            # A bracket that opens the class belongs to it.
            in_class = True
            opening = re.match(r"\[\^?\]?", body[i:])[0]
            out.append(opening)
            i += len(opening)
            continue
        elif named := re.match(r"\(\?<(?=[A-Za-z_])", body[i:]):
            out.append("(?P<")
            i += named.end()
            continue
        elif body.startswith("(?i:", i):
            out.append("(?:")
            i += 4
            continue
        out.append(body[i])
        i += 1
    return "".join(out)


# --- Java form ---------------------------------------------------------------


def java_pattern(regex: str, unicode_case: bool = False) -> str:
    """`regex` with its mode spelt out as a Java pattern, flags included."""
    return ("(?iuU)" if unicode_case else "(?i)") + java_body(regex, unicode_case)


def java_body(regex: str, unicode_case: bool = False) -> str:
    """As `java_pattern` but without flags and grouped, to be embedded in another pattern."""
    return f"(?:{_emit(_parse(regex), not unicode_case)})"


def near_pattern(first: str, second: str, max_chars: int, unicode_case: bool = False) -> str:
    """Both terms in either order with at most `max_chars` characters of one line between."""
    a, b = java_body(first, unicode_case), java_body(second, unicode_case)
    gap = f"[^\\n]{{0,{max_chars}}}"
    return ("(?iuU)" if unicode_case else "(?i)") + f"{a}{gap}{b}|{b}{gap}{a}"


def python_pattern(regex: str, unicode_case: bool = False) -> re.Pattern:
    """`regex` compiled for Python workers, with the meaning of `java_pattern`."""
    return re.compile(_python_body(regex, unicode_case), _python_flags(unicode_case))


def python_near_pattern(first: str, second: str, max_chars: int, unicode_case: bool = False) -> re.Pattern:
    """`near_pattern` compiled for Python workers."""
    a, b = _python_body(first, unicode_case), _python_body(second, unicode_case)
    gap = f"[^\\n]{{0,{max_chars}}}"
    return re.compile(f"{a}{gap}{b}|{b}{gap}{a}", _python_flags(unicode_case))


def longest_match(regex: str) -> int | None:
    """The most characters a match can have, None without a bound."""
    most = _parse(regex).getwidth()[1]
    return int(most) if most < 10_000 else None


def has_positions(regex: str) -> bool:
    """The pattern has a boundary or an anchor."""
    return _any_node(_parse(regex), lambda op, arg: op is sre.AT)


def within_word(regex: str, unicode_case: bool = False) -> bool:
    """Every match lies in one run of ASCII word characters and depends on nothing outside of it but boundaries."""
    def leaves(op, arg) -> bool:
        if op is sre.AT:
            return unicode_case or arg not in (sre.AT_BOUNDARY, sre.AT_NON_BOUNDARY)
        if op in (sre.BRANCH, sre.SUBPATTERN, sre.MAX_REPEAT, sre.MIN_REPEAT):
            return False
        # In Unicode mode a category has members outside ASCII.
        return not _is_word_node(op, arg) or (unicode_case and op is sre.IN and any(kind is sre.CATEGORY for kind, _ in arg))

    return not _any_node(_parse(regex), leaves)


def _any_node(nodes, test) -> bool:
    for op, arg in nodes:
        parts = arg[1] if op is sre.BRANCH else [arg[3]] if op is sre.SUBPATTERN else [arg[2]] if op in (sre.MAX_REPEAT, sre.MIN_REPEAT) else []
        if test(op, arg) or any(_any_node(part, test) for part in parts):
            return True
    return False


def letter_runs(regex: str) -> list[tuple[str, ...]]:
    """Runs of letters; every match, folded, holds all those of at least one tuple."""
    found = []
    for variant in _variants(_parse(regex)):
        runs = "".join(e if e in _LETTERS else " " for e in variant).split()
        found.append(tuple(dict.fromkeys(runs)))
    return list(dict.fromkeys(found))


def _python_flags(unicode_case: bool) -> int:
    return re.IGNORECASE if unicode_case else re.IGNORECASE | re.ASCII


def _python_body(regex: str, unicode_case: bool) -> str:
    body = java_body(regex, unicode_case).replace("\\z", "\\Z").replace("(?-iu:", "(?-i:")
    if not unicode_case:
        return body
    # Word characters of the Unicode mode include marks, connectors and joiners.
    outside = _python_marks()
    body = body.replace("[\\W]", "\\W").replace("[^\\W]", "\\w")
    body = re.sub(r"\[(\^?)([^\]]*)\]", lambda m: f"[{m[1]}{m[2]}{outside if chr(92) + 'w' in m[2] else ''}]", body)
    word, other = f"[\\w{outside}]", f"[^\\w{outside}]"
    body = re.sub(r"(?<!\[)(?<!\[\^)\\w(?![^\[]*\])", lambda _: word, body)
    body = re.sub(r"\\W(?![^\[]*\])", lambda _: other, body)
    edge = f"(?:(?<={word})(?!{word})|(?<!{word})(?={word}))"
    inner = f"(?:(?<={word})(?={word})|(?<!{word})(?!{word}))"
    return body.replace("\\b", edge).replace("\\B", inner)


@cache
def _python_marks() -> str:
    """The word characters that Python's own class lacks, as ranges."""
    codes = [c for c in range(0x300, 0x110000) if unicodedata.category(chr(c)) in ("Mn", "Mc", "Me", "Pc") or c in (0x200C, 0x200D)]
    parts, start = [], None
    for code, after in zip(codes, [*codes[1:], None], strict=True):
        start = code if start is None else start
        if after != code + 1:
            parts.append(f"{chr(start)}-{chr(code)}")
            start = None
    return "".join(parts)


def _char(code: int) -> str:
    char = chr(code)
    if char.isalnum() or code > 127:
        return char
    return f"\\x{code:02x}"


def _category(name) -> str:
    """ASCII without the flag U, Unicode-aware with it: in both modes what the pattern means."""
    return {
        sre.CATEGORY_WORD: "\\w", sre.CATEGORY_NOT_WORD: "\\W",
        sre.CATEGORY_SPACE: "\\s", sre.CATEGORY_NOT_SPACE: "\\S",
        sre.CATEGORY_DIGIT: "\\d", sre.CATEGORY_NOT_DIGIT: "\\D",
    }[name]
def _class(members) -> str:
    parts, negate = [], ""
    for op, arg in members:
        if op is sre.NEGATE:
            negate = "^"
        elif op is sre.LITERAL:
            parts.append(_char(arg))
        elif op is sre.RANGE:
            parts.append(f"{_char(arg[0])}-{_char(arg[1])}")
        elif op is sre.CATEGORY:
            parts.append(_category(arg))
        else:
            raise PatternError(f"unsupported class member {op}")
    return f"[{negate}{''.join(parts)}]"


def _emit(nodes, ascii_mode: bool, before=(), after=()) -> str:
    """Java text of `nodes`; `before` and `after` are the surrounding nodes, for boundaries."""
    nodes = list(nodes)
    out = []
    for i, (op, arg) in enumerate(nodes):
        left, right = [*before, *nodes[:i]], [*nodes[i + 1:], *after]
        if op in (sre.LITERAL, sre.NOT_LITERAL, sre.ANY, sre.IN):
            out.append(_emit_char(op, arg, ascii_mode))
        elif op is sre.BRANCH:
            out.append("(?:" + "|".join(_emit(b, ascii_mode, left, right) for b in arg[1]) + ")")
        elif op is sre.SUBPATTERN:
            if arg[1] or arg[2]:
                raise PatternError("inline flags inside a pattern")
            out.append(f"(?:{_emit(arg[3], ascii_mode, left, right)})")
        elif op in (sre.MAX_REPEAT, sre.MIN_REPEAT):
            out.append(_emit_repeat(*arg, ascii_mode) + ("?" if op is sre.MIN_REPEAT else ""))
        elif op is sre.AT:
            out.append(_position(arg, left, right, ascii_mode))
        else:
            raise PatternError(f"unsupported construct {str(op).lower()}")
    return "".join(out)


def _emit_char(op, arg, ascii_mode: bool) -> str:
    """Java text for one character. Java's Unicode folding also equates i with U+0130 and
    U+0131, which the pattern modes do not, so those two are decided without folding."""
    if op is sre.ANY:
        return "[^\\n]"
    if op is sre.LITERAL:
        letter = chr(arg)
        return "(?-iu:[iI])" if not ascii_mode and letter in "iI" else _char(arg)
    members = [(sre.NEGATE, None), (sre.LITERAL, arg)] if op is sre.NOT_LITERAL else list(arg)
    negated = members[0][0] is sre.NEGATE
    text = _class(members)
    if ascii_mode or not _covers_i(members):
        return text
    return f"(?:{text}|(?-iu:[\u0130\u0131]))" if negated else f"(?:(?-iu:(?![\u0130\u0131])){text})"


def _covers_i(members) -> bool:
    """The class names i, but neither of its two dotted or dotless relatives."""
    def has(codes):
        return any(
            (op is sre.LITERAL and arg in codes) or (op is sre.RANGE and any(arg[0] <= c <= arg[1] for c in codes))
            for op, arg in members
        )

    return has((0x69, 0x49)) and not has((0x130, 0x131))


def _emit_repeat(low, high, item, ascii_mode: bool) -> str:
    single = len(item) == 1 and item[0][0] in (sre.LITERAL, sre.NOT_LITERAL, sre.ANY, sre.IN)
    body = _emit(item, ascii_mode) if single and ascii_mode else f"(?:{_emit(item, ascii_mode)})"
    if (low, high) == (0, 1):
        return body + "?"
    if high is sre.MAXREPEAT and low < 2:
        return body + "*+"[low]
    return f"{body}{{{low},{'' if high is sre.MAXREPEAT else high}}}"


def _position(at, before, after, ascii_mode: bool) -> str:
    if at in (sre.AT_BEGINNING, sre.AT_BEGINNING_STRING):
        return "\\A"
    if at in (sre.AT_END, sre.AT_END_STRING):
        return "\\z"
    behind, ahead = r"(?<!\w)", r"(?!\w)"
    if at is sre.AT_BOUNDARY:
        if not ascii_mode:
            return "\\b"
        if _word_edge(after, first=True):
            # Testing the next character first is cheaper than looking behind everywhere.
            return _next_char_test(after) + behind
        if _word_edge(before, first=False):
            return ahead
        return rf"(?:(?<=\w){ahead}|{behind}(?=\w))"
    if at is sre.AT_NON_BOUNDARY:
        if not ascii_mode:
            return "\\B"
        return rf"(?:(?<=\w)(?=\w)|{behind}{ahead})"
    raise PatternError(f"unsupported position {at}")


def _next_char_test(nodes) -> str:
    variants = _variants(nodes)
    chars = {v[0] for v in variants if v}
    if not chars <= _LETTERS or len(chars) > 4 or () in variants:
        return ""
    return f"(?=[{''.join(sorted(chars))}])"


def _word_edge(nodes, first: bool) -> bool:
    """True when the text matched by `nodes` certainly starts (ends) with an ASCII word character."""
    nodes = list(nodes) if first else list(nodes)[::-1]
    for op, arg in nodes:
        if op is sre.SUBPATTERN:
            return _word_edge(arg[3], first)
        if op is sre.BRANCH:
            return all(_word_edge(b, first) for b in arg[1])
        if op in (sre.MAX_REPEAT, sre.MIN_REPEAT):
            if not _word_edge(arg[2], first):
                return False
            if arg[0] > 0:
                return True
            continue
        return _is_word_node(op, arg)
    return False


def _is_word_node(op, arg) -> bool:
    def word(code):
        return code < 128 and (chr(code).isalnum() or code == 95)

    if op is sre.LITERAL:
        return word(arg)
    if op is not sre.IN:
        return False
    for kind, value in arg:
        if kind is sre.LITERAL and word(value):
            continue
        if kind is sre.RANGE and all(word(c) for c in range(value[0], min(value[1], 127) + 1)) and value[1] < 128:
            continue
        if kind is sre.CATEGORY and value in (sre.CATEGORY_WORD, sre.CATEGORY_DIGIT):
            continue
        return False
    return True


# --- index keys --------------------------------------------------------------
#
# A pattern is unrolled into a few flat variants. Their elements are ASCII letters and:
_BOUND = "B"  # a word boundary
_OUTSIDE = "N"  # one character that is no ASCII letter, any such character
_BREAK = "#"  # surely no ASCII word character here
_EDGE = "|"  # surely no ASCII letter here
_TAIL = "*"  # any number of word characters
_GAP = "?"  # anything, or nothing


@dataclass(frozen=True, order=True)
class Key:
    """A literal of which a match may consist, and how to look for it.

    `kind` names the unit searched: a whole run of word characters or of letters, the start
    of such a run, any substring of the folded text, or nothing (every text qualifies).
    `certain` keys prove the match; the others only make the text a candidate.
    """

    uncertain: bool
    kind: str
    literal: str = ""

    @property
    def certain(self) -> bool:
        return not self.uncertain


WORD, WORD_START, RUN, RUN_START, INSIDE, ALWAYS = "word", "word start", "run", "run start", "inside", "always"


def index_keys(regex: str, unicode_case: bool = False) -> list[Key]:
    """Keys of which every text that matches has at least one; certain keys come first."""
    variants = _variants(_parse(regex))
    keys = set()
    for variant in variants:
        key = _proof(variant, variants) if not unicode_case else None
        key = key or _best_run(variant)
        if key is None:
            return [Key(True, ALWAYS)]
        keys.add(key)
    # A run of letters (or its start) is found wherever the same word is.
    wider = {WORD: RUN, WORD_START: RUN_START}
    covered = {k for k in keys if k.uncertain and Key(True, wider.get(k.kind, ""), k.literal) in keys}
    return sorted(keys - covered)


def _proof(variant, variants) -> Key | None:
    """The certain key of a variant that is nothing but one delimited word."""
    inner = variant[1:-1]
    if len(variant) < 3 or variant[0] not in (_BOUND, _OUTSIDE):
        return None
    if set(inner) <= _LETTERS and variant[-1] in (_BOUND, _OUTSIDE):
        word = "".join(inner)
        sides = {(v[0], v[-1]) for v in variants if v[1:-1] == inner}
        if sides >= {(a, b) for a in (_BOUND, _OUTSIDE) for b in (_BOUND, _OUTSIDE)}:
            return Key(False, RUN, word)
        return Key(False, WORD, word) if variant[0] == variant[-1] == _BOUND else None
    tail = inner[:-1] if variant[-1] == _BOUND else variant[1:-1]
    tailed = variant[-2:] == (_TAIL, _BOUND) or variant[-1] == _TAIL
    if variant[0] == _BOUND and tailed and set(tail) <= _LETTERS and _MIN_PREFIX <= len(tail) <= PREFIX_LENGTH:
        return Key(False, WORD_START, "".join(tail))
    return None


def _variants(nodes) -> list[tuple[str, ...]]:
    variants = [()]
    for op, arg in nodes:
        step = _unroll(op, arg)
        if len(variants) * len(step) > _MAX_VARIANTS:
            step = [(_GAP,)]
        variants = list(dict.fromkeys(v + s for v in variants for s in step))
    return variants


def _unroll(op, arg) -> list[tuple[str, ...]]:
    if op is sre.LITERAL:
        return [(_element(arg),)]
    if op is sre.IN:
        return _unroll_class(arg)
    if op is sre.AT:
        if arg is sre.AT_NON_BOUNDARY:
            return [(_GAP,)]
        return [(_BOUND if arg is sre.AT_BOUNDARY else _BREAK,)]
    if op is sre.SUBPATTERN:
        return _variants(arg[3])
    if op is sre.BRANCH:
        merged = list(dict.fromkeys(v for b in arg[1] for v in _variants(b)))
        return merged if len(merged) <= _MAX_VARIANTS else [(_GAP,)]
    if op in (sre.MAX_REPEAT, sre.MIN_REPEAT):
        return _unroll_repeat(*arg)
    return [(_GAP,)]


def _unroll_repeat(low, high, item) -> list[tuple[str, ...]]:
    inner = _variants(item)
    if inner in ([(_BREAK,)], [(_EDGE,)]):
        return inner if low else [(), *inner]
    if (low, high) == (1, 1):
        return inner
    if (low, high) == (0, 1):
        return [(_GAP,)] if inner == [(_GAP,)] else list(dict.fromkeys([(), *inner]))
    if low:
        return [v + (_GAP,) for v in inner]
    if high is sre.MAXREPEAT and list(item) == [(sre.IN, [(sre.CATEGORY, sre.CATEGORY_WORD)])]:
        return [(_TAIL,)]
    return [(_GAP,)]


def _element(code: int) -> str:
    char = chr(code)
    if code < 128:
        if char.lower() in _LETTERS:
            return char.lower()
        return _EDGE if char.isdigit() or char == "_" else _BREAK
    # U+017F, U+212A and U+0130 fold to ASCII letters, so they are no edge.
    return _GAP if code in (0x17F, 0x212A, 0x130) else _BREAK


def _unroll_class(members) -> list[tuple[str, ...]]:
    members = list(members)
    negated = bool(members) and members[0][0] is sre.NEGATE
    covered, small = set(), True
    for op, arg in members[1:] if negated else members:
        if op is sre.LITERAL:
            covered.add(_element(arg))
        elif op is sre.RANGE and arg[1] < 128:
            covered.update(_element(c) for c in range(arg[0], arg[1] + 1))
        elif op is sre.CATEGORY and arg is sre.CATEGORY_SPACE:
            covered.add(_BREAK)
        elif op is sre.CATEGORY and arg is sre.CATEGORY_DIGIT:
            covered.add(_EDGE)
        else:
            small = False
    if negated:
        if covered == _LETTERS and small:
            return [(_OUTSIDE,)]
        return [(_EDGE,)] if _LETTERS <= covered else [(_GAP,)]
    if small and _GAP not in covered and len(covered) <= 4:
        return [(e,) for e in sorted(covered)]
    return [(_GAP,)]


def _best_run(variant) -> Key | None:
    """The most selective letter run of a variant; a lookup by words beats a substring test."""
    best, best_rank = None, (0, 0)
    elements = (_GAP, *variant, _GAP)
    start = None
    for i, element in enumerate(elements):
        if element in _LETTERS:
            start = i if start is None else start
            continue
        if start is not None:
            literal = "".join(elements[start:i])
            kind = _unit(elements[start - 1], element)
            if kind in (WORD_START, RUN_START) and len(literal) < _MIN_PREFIX:
                kind = INSIDE
            if kind == INSIDE:
                tier = 2 if len(literal) >= 4 else 1 if len(literal) == 3 else 0
            else:
                tier = 3 if len(literal) >= 3 else 1
            if (tier, len(literal)) > best_rank and tier:
                cut = literal[:PREFIX_LENGTH] if kind in (WORD_START, RUN_START) else literal
                best, best_rank = Key(True, kind, cut), (tier, len(literal))
        start = None
    return best


def _unit(left: str, right: str) -> str:
    breaks, edges = (_BOUND, _BREAK), (_BOUND, _BREAK, _OUTSIDE, _EDGE)
    if left in breaks:
        return WORD if right in breaks else RUN if right in edges else WORD_START
    if left in edges:
        return RUN if right in edges else RUN_START
    return INSIDE


# --- text side ---------------------------------------------------------------


def python_folded(text: str, unicode_case: bool = False) -> str:
    """`fold_case` for Python workers: as long as the text, so that places in it stay the same."""
    text = text.replace("\u0130", " ")
    return (text.replace("\u017f", "s") if unicode_case else text.replace("\u212a", " ")).lower()


def fold_case(text: Column, unicode_case: bool = False) -> Column:
    """Lower-cased text in which ASCII letters stand only where the pattern mode sees them.

    Lower-casing maps U+212A to k and U+0130 to i plus a dot; ASCII mode must not see
    those as letters. Unicode mode folds U+017F to s and U+212A to k.
    """
    text = F.replace(text, F.lit("İ"), F.lit(" "))
    if unicode_case:
        return F.lower(F.replace(text, F.lit("ſ"), F.lit("s")))
    return F.lower(F.replace(text, F.lit("K"), F.lit(" ")))
