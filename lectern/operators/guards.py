"""Content guards and safe edits: sequence comparison of a source and its correction.

A comparison is a list of ``Change`` blocks. Every guard is a row of a table (which
side is measured, from what size on, which circumstances excuse it), and so is every
safe edit (kind of block, condition, what takes its place).

Comparisons grow faster than the text, so long pairs are cut at words that both sides
hold once (``lectern.operators.pairing``) and compared part by part.
"""

from __future__ import annotations

from collections.abc import Callable
from difflib import SequenceMatcher
from itertools import compress
from typing import NamedTuple

import regex

from lectern.functions import tokens as K
from lectern.functions.text import NOISE_MARKERS, QUOTE_PAIRS
from lectern.operators.pairing import LIMIT, parts

DELETED, INSERTED = 3, 3
ALIKE = 0.5
#: Characters on both sides of a span that are searched for digits in its place.
NEAR = 30
_DIGITS = regex.compile(r"[\d.,، %]*\d[\d.,، %]*")
_WEB = ("http", "www", "ftp")


class Change(NamedTuple):
    """A block in which two sequences differ."""

    kind: str
    i1: int
    i2: int
    j1: int
    j2: int

    @property
    def net(self) -> int:
        """Items lost, less items gained."""
        return (self.i2 - self.i1) - (self.j2 - self.j1)


def opcodes(a, b):
    return SequenceMatcher(None, a, b, autojunk=False).get_opcodes()


def changes(a, b) -> list[Change]:
    if a == b:
        return []
    return [Change(*o) for o in opcodes(a, b) if o[0] != "equal"]


def similar(a: str, b: str) -> bool:
    return bool(a and b) and SequenceMatcher(None, a, b, autojunk=False).ratio() >= ALIKE


def strip_conversions(source: str, corrected: str) -> tuple[str, str]:
    """Both texts without number conversions (gone on both sides) and without stutters
    (gone from the source)."""
    a, b = K.diff_words(source), K.diff_words(corrected)
    if not (a and b):
        return source, corrected
    keep_a, keep_b = bytearray(b"\1") * len(a), bytearray(b"\1") * len(b)
    for c in changes(a, b):
        converted = c.kind == "replace" and K.is_conversion(b[c.j1 : c.j2])
        if converted or (c.i2 > c.i1 and K.is_stutter(a, c.i1, c.i2)):
            keep_a[c.i1 : c.i2] = bytes(c.i2 - c.i1)
        if converted:
            keep_b[c.j1 : c.j2] = bytes(c.j2 - c.j1)
    return " ".join(compress(a, keep_a)), " ".join(compress(b, keep_b))


class Pair:
    """Two token lists with what the excuses look at."""

    def __init__(self, a: list[str], b: list[str], source: str = "", corrected: str = "", at_a=(), at_b=()):
        self.a, self.b, self.source, self.corrected, self.at_a, self.at_b = a, b, source, corrected, at_a, at_b
        self.changes = changes(a, b)

    def old(self, c: Change) -> list[str]:
        return self.a[c.i1 : c.i2]

    def new(self, c: Change) -> list[str]:
        return self.b[c.j1 : c.j2]


# Circumstances under which a change is no fault.
def _alike(p: Pair, c: Change) -> bool:
    return similar("".join(p.old(c)), "".join(p.new(c)))


def _has_digit(p: Pair, c: Change) -> bool:
    return any(map(str.isdigit, "".join(p.new(c))))


def _becomes_address(p: Pair, c: Change) -> bool:
    return "".join(p.new(c)).startswith(_WEB)


def _repeats(p: Pair, c: Change) -> bool:
    return K.repeats_context(p.a, c.i1, c.i2)


def _numerals_lost(p: Pair, c: Change) -> bool:
    return K.cjk_numerals().issuperset(p.old(c))


def _numerals_gained(p: Pair, c: Change) -> bool:
    return K.cjk_numerals().issuperset(p.new(c))


def _digits_near(source: str, corrected: str, first: int, last: int, side: int) -> bool:
    """True if near a span one text has nothing but digits where the other has
    something else. ``side`` tells whose digits: 0 the source's, 1 the correction's."""
    lo, hi = max(0, first - NEAR), last + NEAR
    windows = source[lo:hi], corrected[lo:hi]
    if not windows[side]:
        return False
    for c in changes(*windows):
        piece = windows[side][slice(*((c.i1, c.i2), (c.j1, c.j2))[side])]
        if c.kind == "replace" and _DIGITS.fullmatch(piece):
            return True
    return False


def _became_digits(p: Pair, c: Change) -> bool:
    return _digits_near(p.source, p.corrected, p.at_a[c.i1], p.at_a[c.i2 - 1] + 1, 1)


def _were_digits(p: Pair, c: Change) -> bool:
    return _digits_near(p.source, p.corrected, p.at_b[c.j1], p.at_b[c.j2 - 1] + 1, 0)


class Guard(NamedTuple):
    """A rule: blocks that lose (or gain) too much are faults unless excused."""

    category: str
    loses: bool
    spare: int  # 1 where a change of exactly the limit is still allowed
    excuses: tuple[Callable[[Pair, Change], bool], ...]
    joint: str
    shown: int
    message: str

    def breach(self, p: Pair, limit: int) -> str | None:
        """What the first fault says, or None."""
        skip = "insert" if self.loses else "delete"
        for c in p.changes:
            size = c.net if self.loses else -c.net
            if c.kind == skip or size < limit + self.spare or any(x(p, c) for x in self.excuses):
                continue
            span = self.joint.join((p.old(c) if self.loses else p.new(c))[: self.shown])
            return self.message.format(size=size, limit=limit, span=span)
        return None


WORD_GUARDS = (
    Guard("long_span", True, 1, (_alike, _has_digit, _becomes_address, _repeats), " ", 12, "long span was removed (deleted_tokens={size}, span='{span}')"),
    Guard("hallucination", False, 1, (_alike, _has_digit), " ", 8, "text was invented (inserted_tokens={size}, max_allowed={limit}, span='{span}')"),
)
CHARACTER_GUARDS = (
    Guard("long_span_ns", True, 0, (_numerals_lost, _became_digits, _repeats), "", 20, "long span was removed (deleted_chars={size}, threshold={limit}, span='{span}')"),
    Guard("hallucination_ns", False, 1, (_numerals_gained, _were_digits), "", 20, "text was invented (inserted_chars={size}, max_allowed={limit}, span='{span}')"),
)


def _dense_pair(source: str, corrected: str) -> Pair:
    a, b = K.dense_positions(source), K.dense_positions(corrected)
    return Pair([x for x, _ in a], [x for x, _ in b], source, corrected, [k for _, k in a], [k for _, k in b])


def _limit(guard: Guard, deleted: int, inserted: int) -> int:
    return deleted if guard.loses else inserted


def _faults(source: str, corrected: str, deleted: int, inserted: int):
    """(category, error) of every guard that fails, in the order of the tables."""
    b, known = K.strip_labels(K.tokenize(corrected))
    words = Pair(K.folded(K.strip_known_labels(K.tokenize(source), known)), K.folded(b))
    for table, pair in ((WORD_GUARDS, words if words.a else None), (CHARACTER_GUARDS, _dense_pair(source, corrected))):
        for g in table if pair else ():
            error = g.breach(pair, _limit(g, deleted, inserted))
            if error:
                yield g.category, error


def check(source: str, corrected: str, deleted: int = DELETED, inserted: int = INSERTED, cleaning: bool = True) -> tuple[bool, str | None, str | None]:
    """(ok, error, category) of a correction: removed or invented stretches, by words
    and by characters of scripts without spaces."""
    if source == corrected:
        return True, None, None
    if cleaning:
        clean = strip_conversions(source, corrected)
        if not any(clean):
            return True, None, None
        if clean != (source, corrected) and all(clean) and next(_faults(*clean, deleted, inserted), None) is None:
            return True, None, None
    category, error = next(_faults(source, corrected, deleted, inserted), (None, None))
    return category is None, error, category


def check_parts(source: str, corrected: str, limit: int = LIMIT) -> tuple[bool, str | None, str | None]:
    """``check`` of a pair of any length, part by part; the first fault counts."""
    for a, b in parts(source, corrected, limit):
        got = check(source[slice(*a)], corrected[slice(*b)])
        if not got[0]:
            return got
    return True, None, None


def guards_alone(source: str, corrected: str, limit: int = 3) -> dict[str, bool]:
    """Every guard by itself, labels and all; a blank source fails the two word guards."""
    words = Pair(K.folded(K.tokenize(source)), K.folded(K.tokenize(corrected)))
    dense = _dense_pair(source, corrected)
    got = {g.category: bool(words.a) and g.breach(words, limit) is None for g in WORD_GUARDS}
    return got | {g.category: g.breach(dense, limit) is None for g in CHARACTER_GUARDS}


def guards_alone_parts(source: str, corrected: str, limit: int = LIMIT) -> dict[str, bool]:
    """``guards_alone`` of a pair of any length: a guard holds if it holds in every part
    that has words."""
    got = [guards_alone(source[slice(*a)], corrected[slice(*b)]) for a, b in parts(source, corrected, limit) if source[slice(*a)].strip()]
    return {k: all(g[k] for g in got) for k in got[0]} if got else guards_alone(source, corrected)


# ---------------------------------------------------------------- safe edits

# Decorative marks; marks that may go on their own.
DECORATIVE = "\"'“”‘’«»()[]{}&~*"
DELETABLE = DECORATIVE + "."
_WORD_CHAR = regex.compile(r"\w")
_SYMBOL = regex.compile(r"[^\w\s]")
_SPACED_DOTS = regex.compile(r"(?<![A-Za-z])(?:[A-Za-z]\. )+[A-Za-z]\.")
_DOTTED = regex.compile(r"(?:[A-Za-z]\.){2,}")
_LATIN_RUN = regex.compile("[A-Za-z]+")


def unquote(text: str) -> str:
    """The text without one outer pair of quotes; plain quotes are unescaped within."""
    if len(text) < 2 or (text[0], text[-1]) not in QUOTE_PAIRS:
        return text
    return text[1:-1].replace('\\"', '"') if text[0] == '"' else text[1:-1]


def abbreviation_split(letters: str, words: set[str]) -> list[str] | None:
    """Letters as pieces of two or more that are words (in any case), the first piece as
    long as possible, then the second, and so on; None if there is no way."""
    best: list[list[str] | None] = [None] * len(letters) + [[]]
    for at in range(len(letters) - 2, -1, -1):
        ends = (e for e in range(len(letters), at + 1, -1) if best[e] is not None and letters[at:e].lower() in words)
        end = next(ends, None)
        if end is not None:
            best[at] = [letters[at:end], *best[end]]
    return best[0]


def undot(original: str, output: str) -> str:
    """The original with the dots of abbreviations dropped where the output writes them
    without; spaced abbreviations are closed up first."""
    if "." not in original:
        return original
    words = {w.lower() for w in _LATIN_RUN.findall(output)}

    def plain(m) -> str:
        letters = m[0].replace(".", "")
        found = [letters] if letters.lower() in words else abbreviation_split(letters, words)
        return " ".join(found) if found else m[0]

    return _DOTTED.sub(plain, _SPACED_DOTS.sub(lambda m: m[0].replace(" ", ""), original))


def _words(text: str) -> str:
    return "".join(_WORD_CHAR.findall(text))


_DROP_DECORATION = str.maketrans("", "", DECORATIVE)


class Rule(NamedTuple):
    """What takes the place of a block, and whether that follows the output."""

    kind: str
    when: Callable[[str, str], bool]
    then: Callable[[str, str], str]
    accepts: bool


def _otherwise(old: str, new: str) -> bool:
    return True


#: The first rule that fits a block decides. ``old`` is the original's side.
RULES = (
    Rule("equal", _otherwise, lambda old, new: old, True),
    Rule("insert", lambda old, new: not _words(new), lambda old, new: new, True),
    Rule("insert", _otherwise, lambda old, new: "", False),
    Rule("delete", lambda old, new: any(n in old.lower() for n in NOISE_MARKERS), lambda old, new: "", True),
    Rule("delete", lambda old, new: bool(_words(old)), lambda old, new: old.translate(_DROP_DECORATION), False),
    Rule("delete", lambda old, new: not set(old).isdisjoint(DELETABLE), lambda old, new: "", True),
    Rule("delete", _otherwise, lambda old, new: old, False),
    Rule("replace", lambda old, new: _words(old).lower() == _words(new).lower(), lambda old, new: new, True),
    Rule("replace", lambda old, new: not _words(old), lambda old, new: _WORD_CHAR.sub("", new), False),
    Rule("replace", _otherwise, lambda old, new: _SYMBOL.sub("", old), False),
)


def merged(original: str, output: str) -> tuple[str, list[tuple[str, str, str]]]:
    """(text before squeezing, [(decision, old, new)]) of one pair."""
    if original == output:
        return original, []
    out, log = [], []
    for kind, i1, i2, j1, j2 in opcodes(original, output):
        old, new = original[i1:i2], output[j1:j2]
        rule = next(r for r in RULES if r.kind == kind and r.when(old, new))
        put = rule.then(old, new)
        out.append(put)
        if kind != "equal":
            log.append(("kept" if rule.accepts else "cleaned" if put != old and old else "rejected", old, new))
    return "".join(out), log


def safe_edits(original: str, output: str, limit: int = LIMIT) -> str:
    """The original with the output's punctuation and case, without its word edits."""
    return safe_report(original, output, limit)[0]


def safe_report(original: str, output: str, limit: int = LIMIT) -> tuple[str, list[tuple[str, str, str]]]:
    """(merged text, [(decision, old, new)]): the decision is ``kept`` where the output
    was followed, ``rejected`` where not, ``cleaned`` where only marks went."""
    original = undot(unquote(original), output)
    got = [merged(original[slice(*a)], output[slice(*b)]) for a, b in parts(original, output, limit)]
    return regex.sub(" {2,}", " ", "".join(t for t, _ in got)).strip(), [x for _, log in got for x in log]
