"""Garbled text from wrong character encoding.

Adjacent character pairs are counted over the distinct lines of all documents, so
copies, of texts or of lines, do not make what they hold probable. A pair's share of the
corpus mutual information, p(ab) log p(ab)/p(a)p(b), tells how well it fits this
corpus; pairs with a small share score as improbable, and the maximum-scoring
segments of a line, rounded to whole words, are its improbable runs. Inverse mappings
are tried inside runs and nowhere else: neighbouring runs together, then each run,
then its parts are encoded with an encoding that a reader may have used by mistake and
decoded with the one the text was written in, twice where the damage was done twice.
Which encodings can have been at work follows from the characters beside each other,
so most runs of sound text cost no trial. A mapping counts if the corpus makes the
result clearly more likely than what stands there.

Defined results
---------------
* null and blank texts are no cases; texts within ASCII neither;
* of several inverse mappings the one with the most likely result wins, ties by the
  order of ``MAPPINGS``;
* where characters were lost (U+FFFD, or bytes that no longer fit) the text is
  marked and its restored form is null;
* copies under other ids are judged one by one; extra columns are ignored;
* characters are counted exactly. Pairs are counted in a fixed table (count-min, two
  rows): a pair's share of the corpus is never too small, and too large by about the
  share of all rare pairs that fall into its bucket, at most 1 / BUCKETS of the corpus
  on average in each row (1e-6, against 1e-5 where a pair begins to count as probable),
  whatever the size of the corpus.
"""

from __future__ import annotations

import codecs
import re
from bisect import bisect_left
from functools import lru_cache

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lectern.operators.arrow import map_columns

BUCKETS = 1 << 20
CHARS = 0x110000

# Encodings by which UTF-8 was read, one byte and several bytes a
# character, and (encoding read by mistake, encoding of the text) for the rest.
SINGLE = (
    "cp1252 latin-1 cp1250 cp1251 mac_roman cp437 cp850 cp852 cp866 koi8-r iso8859-2 iso8859-15 cp1254 cp1256 cp1253 cp1257 cp874 "
    "mac_latin2 mac_cyrillic iso8859-5"
).split()
DOUBLE = "gb18030 big5 cp932 euc_jp cp949".split()
DENSE = [
    tuple(x.split(">"))
    for x in (
        "cp1252>cp932 cp1252>euc_jp cp1252>gb18030 cp1252>big5 cp1252>cp949 cp1252>cp1251 cp1252>koi8-r cp1252>cp866 cp1252>cp1256 "
        "cp1252>iso8859-6 cp1252>cp874 cp1252>iso8859-5 cp1251>koi8-r koi8-r>cp1251 cp1251>cp866 cp866>cp1251 cp1250>cp1251 cp1250>cp932 "
        "cp1250>gb18030 cp1250>euc_jp cp1250>cp949 cp1251>cp932 cp1251>gb18030 mac_roman>cp1251 cp437>cp1251 cp437>cp932 cp437>gb18030 "
        "cp932>euc_jp euc_jp>cp932 cp932>gb18030 gb18030>cp932 gb18030>big5 big5>gb18030 gb18030>cp949 cp949>gb18030 gb18030>euc_jp"
    ).split()
]
SPARSE = [
    tuple(x.split(">"))
    for x in (
        "cp1252>cp1250 cp1252>iso8859-2 cp1252>mac_roman cp1252>cp437 cp1252>cp850 cp1252>cp852 cp1250>cp1252 cp1250>cp852 iso8859-2>cp1250 "
        "mac_roman>cp1252 cp437>cp1252 cp850>cp1252 cp852>cp1250 cp1251>cp1252 koi8-r>cp1252 cp1252>cp1257 cp1252>cp1254"
    ).split()
]
#: Readers after which a second inversion is tried.
TWICE = ("cp1252", "latin-1", "cp1250", "cp437", "mac_roman", "cp1251")


def _raw_bytes(error: UnicodeEncodeError):
    """Control characters stand for the bytes a code page leaves open."""
    chars = error.object[error.start : error.end]
    if all("\x80" <= c <= "\x9f" or c == "\xa0" for c in chars):
        return bytes(map(ord, chars)), error.end
    raise error


codecs.register_error("lectern_raw", _raw_bytes)


def _codes(text: str):
    import numpy as np

    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)


def _buckets(a, b):
    """Two bucket numbers of every pair."""
    import numpy as np

    mask = np.uint64(BUCKETS - 1)
    with np.errstate(over="ignore"):
        h = (a << np.uint64(21)) ^ b
        one = (h * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(40)
        two = ((h + np.uint64(0x7F4A7C15)) * np.uint64(0xC2B2AE3D27D4EB4F)) >> np.uint64(38)
    return (one & mask).astype(np.int64), (two & mask).astype(np.int64)


class Pairs:
    """Counts of characters and adjacent pairs over the distinct lines of the corpus."""

    def __init__(self, pairs, chars):
        import numpy as np

        self.pairs, self.chars = pairs, chars
        self.total = float(max(1.0, chars.sum()))
        self.known: dict = {}
        self.lines: dict = {}
        self.logs: dict[tuple[str, str], float] = {}

    def __getstate__(self):
        return {"pairs": self.pairs, "chars": self.chars}

    def __setstate__(self, state):
        self.__init__(state["pairs"], state["chars"])

    def log_likelihood(self, text: str) -> float:
        """Log probability of a text, character by character given the one before. Pairs
        that were asked for are remembered, a bounded number of them."""
        import numpy as np

        known = self.logs
        pairs = list(zip(text, text[1:]))
        new = [p for p in pairs if p not in known]
        if new:
            if len(known) > 400_000:
                known.clear()
                new = pairs
            first, second = _codes("".join(p[0] for p in new)), _codes("".join(p[1] for p in new))
            one, two = _buckets(first, second)
            seen = np.minimum(self.pairs[0][one], self.pairs[1][two]) + SMOOTH * (self.chars[second] + 0.01) / self.total
            known.update(zip(new, np.log(seen / (self.chars[first] + SMOOTH)).tolist()))
        return sum(map(known.__getitem__, pairs))

    def scores(self, codes):
        """Improbability of every pair: positive where its share of the corpus mutual
        information is small. Pairs within ASCII are not looked up."""
        import numpy as np

        out = np.full(len(codes) - 1, ASCII_PAIR)
        at = np.flatnonzero((codes[:-1] | codes[1:]) > 127)
        first, second = codes[at], codes[at + 1]
        one, two = _buckets(first, second)
        n = np.minimum(self.pairs[0][one], self.pairs[1][two]) + 0.1
        a, b = self.chars[first] + 1.0, self.chars[second] + 1.0
        share = n / self.total * np.maximum(0.05, np.log(n * self.total / (a * b)))
        out[at] = np.clip(np.log(RARE / share), -1.0, 4.0)
        return out


ASCII_PAIR = -0.4
#: A pair scores zero at this share of the corpus mutual information (in nats).
RARE = 1e-4
#: Weight of the single character in the probability of a pair.
SMOOTH = 5.0


#: Characters that are worked at once.
CHUNK = 1 << 18


def _joined(lines: list[str]):
    """Codes of the lines, each between line feeds, some hundred thousand at a time."""
    part, size = [], 0
    for line in lines:
        part.append(line)
        size += len(line) + 1
        if size >= CHUNK:
            yield _codes("\n" + "\n".join(part) + "\n")
            part, size = [], 0
    if part:
        yield _codes("\n" + "\n".join(part) + "\n")


def count_pairs(df: DataFrame) -> Pairs:
    """Pair and character counts over all distinct lines: every task fills fixed tables
    and sends their filled buckets, so the result is bounded by the table size. Copies
    meet in the tasks first, so a line in many copies does not gather anywhere."""
    import numpy as np

    def run(batches):
        import pyarrow as pa

        pairs = [np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)]
        chars, plain = np.zeros(CHARS, np.int64), np.zeros(1 << 14, np.int64)
        for batch in batches:
            for codes in _joined(batch.column(0).to_pylist()):
                np.add.at(chars, codes.astype(np.int64), 1)
                a, b = codes[:-1], codes[1:]
                wide = (a | b) > 127
                plain += np.bincount((a[~wide] << np.uint64(7) | b[~wide]).astype(np.int64), minlength=1 << 14)
                for t, at in zip(pairs, _buckets(a[wide], b[wide])):
                    np.add.at(t, at, 1)
        every = np.arange(1 << 14, dtype=np.uint64)
        for t, at in zip(pairs, _buckets(every >> np.uint64(7), every & np.uint64(127))):
            np.add.at(t, at, plain)
        for kind, t in enumerate((*pairs, chars)):
            at = np.flatnonzero(t)
            for k in range(0, len(at), 50_000):
                part = at[k : k + 50_000]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(part), kind, np.int32)), pa.array(part), pa.array(t[part])], names=["kind", "bucket", "n"]
                )

    lines = df.select(F.explode(F.split("text", "\n")).alias("text")).filter("text <> ''").distinct()
    rows = lines.mapInArrow(run, "kind int, bucket bigint, n bigint").groupBy("kind", "bucket").agg(F.sum("n").alias("n"))
    got = rows.toArrow()
    kind, bucket, n = (got.column(c).to_numpy() for c in ("kind", "bucket", "n"))
    tables = []
    for k, size in enumerate((BUCKETS, BUCKETS, CHARS)):
        t = np.zeros(size, np.float32)
        t[bucket[kind == k]] = n[kind == k]
        tables.append(t)
    return Pairs(tables[:2], tables[2].astype(np.float64))


DROP = 6.0


def segments(scores: list[float]) -> list[tuple[int, int, float]]:
    """Maximum-scoring segments (start, end, sum) of a score sequence: a segment grows
    while its sum stays above zero and within DROP of its maximum, and ends at that
    maximum, from where the search goes on."""
    out = []
    n, i = len(scores), 0
    while i < n:
        if scores[i] <= 0:
            i += 1
            continue
        start, end, total, best = i, i + 1, scores[i], scores[i]
        for k in range(i + 1, n):
            total += scores[k]
            if total > best:
                best, end = total, k + 1
            elif total <= 0 or best - total > DROP:
                break
        out.append((start, end, best))
        i = end
    return out


#: Least sum of scores of a run, and most of what a run may sum to and be left alone.
RUN_SCORE = 1.0


def runs(line: str, own: list[float]) -> list[tuple[int, int]]:
    """(start, end) of the improbable runs of a line: its maximum-scoring segments of at
    least RUN_SCORE, rounded to whole words; such in one word are one run. ``own[k]`` is
    the score of the pair that ends with character k."""
    out: list[tuple[int, int]] = []
    for x, y, score in segments(own):
        if score < RUN_SCORE:
            continue
        a = line.rfind(" ", 0, max(0, x - 1) + 1) + 1
        b = line.find(" ", min(y, len(line)) - 1 if y > x + 1 else y)
        b = len(line) if b < 0 else b
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        elif a < b and not line[a:b].isascii():
            out.append((a, b))
    return out


_ODD = re.compile("[\x00-\x08\x0b\x0c\x0e-\x1f\x7f-\x9f\ue000-\uf8ff\ufffd\U000e0100-\U0010ffff]")
_MARKED = "\ufeff"


@lru_cache(None)
def _byte_chars(wrong: str) -> list[str]:
    """What every byte looks like to a reader; open bytes look like themselves."""
    return [bytes([b]).decode(wrong, "replace").replace("\ufffd", chr(b)) for b in range(256)]


@lru_cache(None)
def _sequences(wrong: str) -> re.Pattern:
    """UTF-8 sequences as a reader of one byte a character sees them."""
    c = _byte_chars(wrong)
    cls = lambda a, b: "[" + "".join(re.escape(x) for x in dict.fromkeys(c[a : b + 1])) + "]"
    tail = cls(0x80, 0xBF)
    return re.compile(f"(?:{cls(0xC2, 0xDF)}{tail}|{cls(0xE0, 0xEF)}{tail}{{2}}|{cls(0xF0, 0xF4)}{tail}{{3}})+")


@lru_cache(1)
def _sequence_masks() -> tuple[dict[str, int], dict[str, int]]:
    """For every character the encodings (bits of SINGLE) in which it looks like the first
    byte of a UTF-8 sequence, and like a later one."""
    first: dict[str, int] = {}
    later: dict[str, int] = {}
    for bit, wrong in enumerate(SINGLE):
        c = _byte_chars(wrong)
        for table, part in ((first, c[0xC2:0xF5]), (later, c[0x80:0xC0])):
            for ch in part:
                table[ch] = table.get(ch, 0) | 1 << bit
    return first, later


_TWO = re.compile("[^\x00-\x7f]{2,}")
#: Runs of the letters of one of these scripts alone are written so; as bytes of UTF-8
#: they would hold symbols or controls as well.
_PLAIN = re.compile("[\u0410-\u044f\u0401\u0451\x00-\x7f]*|[\u0e01-\u0e5b\x00-\x7f]*")


#: Lines of one of these scripts that no reader makes out of other text: bytes read as
#: Arabic or Thai also give signs beside the letters, and no encoding here has Devanagari.
_OWN = re.compile(
    "[\x00-\x7f\u0621-\u0652\u0660-\u0669\u060c\u061b\u061f]*|[\x00-\x7f\u0e01-\u0e5b]*|[\x00-\x7f\u0900-\u097f]*"
)


@lru_cache(1)
def _start() -> re.Pattern:
    first, later = _sequence_masks()
    cls = lambda table: "[" + "".join(map(re.escape, sorted(table))) + "]"
    return re.compile(cls(first) + cls(later))


@lru_cache(1 << 12)
def readers(run: str) -> list[str]:
    """Encodings by which the run can be UTF-8 read one byte a character: those in which
    two neighbours look like the start of a sequence."""
    if _PLAIN.fullmatch(run) or not _start().search(run):
        return []
    first, later = _sequence_masks()
    mask = 0
    for m in _TWO.finditer(run):
        part = m[0]
        for a, b in zip(part, part[1:]):
            if a in first:
                mask |= first[a] & later.get(b, 0)
    return [wrong for bit, wrong in enumerate(SINGLE) if mask >> bit & 1]


@lru_cache(1 << 16)
def _writers(ch: str) -> frozenset[str]:
    """Encodings that have a character, or that leave open the byte it stands for."""
    out = set()
    for wrong in {*SINGLE, *DOUBLE, *(w for w, _ in DENSE + SPARSE)}:
        try:
            ch.encode(wrong, "lectern_raw")
        except UnicodeError:
            continue
        out.add(wrong)
    return frozenset(out)


def writers(run: str) -> frozenset[str]:
    """Encodings that have all characters of a run."""
    chars = [c for c in set(run) if c > "\x7f"]
    return frozenset.intersection(*map(_writers, chars)) if chars else frozenset()


def _decode_run(run: str, wrong: str) -> str:
    try:
        return run.encode(wrong, "lectern_raw").decode("utf-8")
    except UnicodeError:
        return run


def _unread(text: str, wrong: str) -> str:
    return _sequences(wrong).sub(lambda m: _decode_run(m[0], wrong), text)


def _invert(text: str, wrong: str, true: str) -> str | None:
    try:
        out = text.encode(wrong, "lectern_raw").decode(true)
    except (UnicodeError, LookupError):
        return None
    return None if out == text or _ODD.search(out) else out


#: Characters that a repaired word of a Latin script does not hold.
_NO_TEXT = re.compile("[\u0080-\u00a0\u00a2-\u00a9\u00ac-\u00ba\u00bc-\u00be\u00d7\u00f7\u0370-\u1dff\u2020-\u2025\u2030\u2100-\uffff]")
_CJK = re.compile("[\u3040-\u30ff\u3400-\u9fff\uac00-\ud7af\uff61-\uff9f]")
_HIGH_RUN = re.compile("[^\x00-\x7f](?:[^\n]*[^\x00-\x7f])?")
_PART = re.compile("[\u0080-\u024f\u02c6\u02dc\u0400-\u04ff\u0192\u2010-\u2122\u2500-\u25a0!-~]{3,}")


#: A restored run and its mapping, or None, and for mappings of single letters that
#: alone were not sure [(mapping, restored, gain above the cost)].
Trial = tuple[tuple[str, str] | None, list[tuple[str, str, float]]]


def restore(run: str, table: Pairs, left: str = "\n", right: str = "\n", odd: float = 1.0) -> Trial:
    """The inverse mapping that makes the run clearly likelier. ``odd`` is the share of
    improbable pairs: mappings that fit almost any text are tried only in runs that are
    improbable throughout."""
    if run.isascii():
        return None, []
    key = (run, left, right, odd >= 0.5, odd >= 0.3)
    if key in table.known:
        return table.known[key]
    if len(table.known) > 50_000:  # the memory of repeated runs is bounded; it only saves time
        table.known.clear()
    table.known[key] = got = _restore(run, table, left, right, odd)
    return got


def _restore(run: str, table: Pairs, left: str, right: str, odd: float) -> Trial:
    best: tuple[float, str, str] | None = None
    weak: list[tuple[str, str, float]] = []
    base: float | None = None
    gains: dict[str, float] = {}  # several mappings may make the same of a run

    def offer(out: str | None, mapping: str, need: float, cost: float = 0.0) -> None:
        nonlocal best, base
        if out is None or out == run or out not in gains and _ODD.search(out):
            return
        if base is None:
            base = table.log_likelihood(left + run + right)
        gain = gains.get(out)
        if gain is None:
            gain = gains[out] = 9.0 if out.startswith(_MARKED) and out[1:] in run else table.log_likelihood(left + out + right) - base
        if gain > need and (best is None or gain > best[0]):
            best = (gain, out, mapping)
        elif cost and gain > cost:
            weak.append((mapping, out, gain - cost))

    small: float | None = None

    def capitals() -> float:
        """What the run would gain in small letters."""
        nonlocal small
        if small is None:
            low = run.lower()
            small = max(0.0, table.log_likelihood(left + low + right) - table.log_likelihood(left + run + right)) if low != run else 0.0
        return small

    for wrong in readers(run):
        out = _unread(run, wrong)
        offer(out, f"{wrong}>utf-8", 2.0, LIKELY)
        if wrong in TWICE and out != run:
            for again in set(readers(out)).intersection(TWICE):
                offer(_unread(out, again), f"{wrong}>utf-8", 2.0, LIKELY)
    high = sum(c > "\x7f" for c in run)
    able = writers(run) if odd >= 0.3 else frozenset()
    if able and high >= 3 and _CJK.search(run):
        for wrong in DOUBLE:
            if wrong in able:
                offer(_invert(run, wrong, "utf-8"), f"{wrong}>utf-8", 6.0)
    if able and best is None and odd >= 0.5 and high >= 4 and high >= 0.35 * len("".join(run.split())):
        for wrong, true in DENSE:
            if wrong in able and (wrong not in DOUBLE or _CJK.search(run)):
                out = _invert(run, wrong, true)
                if out is not None:  # a shorter text is likelier for its length alone, capitals are rare anyway
                    cost = COST * high + SHORTER * (len(run) - len(out)) + capitals()
                    offer(out, f"{wrong}>{true}", SURE + cost, cost)
    if able and best is None and high < 0.6 * len(run):
        for wrong, true in SPARSE:
            out = _invert(run, wrong, true) if wrong in able else None
            if out is not None and not _NO_TEXT.search(out):
                offer(out, f"{wrong}>{true}", SURE + 2.0 * high, 2.0 * high)
    return (best[1], best[2]) if best else None, weak


#: What the gains of a mapping must come to, above its cost; the cost of a mapping for
#: every character outside ASCII, and for every character by which the text gets shorter.
SURE = 9.0
COST, SHORTER = 0.1, 2.0
#: A run that decodes as UTF-8 may lose so much where the same reader was at work in
#: another run of the text.
LIKELY = -4.0


def lossy(run: str, table: Pairs) -> bool:
    """True if most of a run's sequences are UTF-8 read by a wrong encoding, though
    some bytes no longer fit."""
    likely = [w for w in readers(run) if w in ("cp1252", "latin-1", "cp1250", "cp1251", "cp437", "mac_roman")]
    for wrong in [*likely, "gb18030"] if _CJK.search(run) else likely:
        try:
            out = run.encode(wrong, "lectern_raw").decode("utf-8", "replace")
        except UnicodeError:
            continue
        bad = out.count("\ufffd")
        good = sum(1 for c in out if c > "\x7f") - bad
        if good >= 3 and bad <= 0.34 * good and not _ODD.search(out.replace("\ufffd", "")):
            return table.log_likelihood(out.replace("\ufffd", "")) > table.log_likelihood(run) + 3
    return False


def _groups(parts: list[tuple[int, int]]) -> list[list[tuple[int, int]]]:
    """Runs that only a space divides, together."""
    out: list[list[tuple[int, int]]] = []
    for a, b in parts:
        if out and a - out[-1][-1][1] <= 1:
            out[-1].append((a, b))
        else:
            out.append([(a, b)])
    return out


class Line:
    """A line with the scores of its pairs: ``own[k]`` is that of the pair that ends with
    character k. What is found hangs on the line alone, so equal lines are worked once."""

    def __init__(self, text: str, own: list[float], table: Pairs, sums):
        self.text, self.own, self.table, self.sums = text, own, table, sums
        self.found: list[tuple[int, int, str, str]] = []
        self.weak: list[tuple[str, int, int, str, float]] = []
        self.lost = False

    def share(self, a: int, b: int) -> float:
        """Share of improbable pairs among those of a stretch that are not within ASCII."""
        rare, seen, at = self.sums
        return float(rare[at + b + 1] - rare[at + a]) / max(1.0, float(seen[at + b + 1] - seen[at + a]))

    def repair(self, a: int, b: int) -> bool:
        text = self.text
        trial, more = restore(text[a:b], self.table, text[a - 1 : a] or "\n", text[b : b + 1] or "\n", self.share(a, b))
        if trial:
            self.found.append((a, b, *trial))
        else:
            self.weak += [(mapping, a, b, out, gain) for mapping, out, gain in more]
        return bool(trial)

    def work(self) -> Line:
        for group in _groups(runs(self.text, self.own)):
            if self.repair(group[0][0], group[-1][1]):
                continue
            for a, b in group:  # words that were read by different encodings
                if len(group) > 1 and self.repair(a, b):
                    continue
                word = self.text[a:b]
                parts = [(a + m.start(), a + m.end()) for m in _PART.finditer(word) if len(m[0]) < b - a and not m[0].isascii()]
                if not any([self.repair(x, y) for x, y in parts]) and not self.lost and self.share(a, b) >= 0.5:
                    self.lost = lossy(word, self.table)
        self.own, self.sums = [], None  # only what was found is kept
        return self


#: Lines whose result is remembered.
HELD_LINES = 20_000


def _worked(texts: list[str], table: Pairs):
    """(number of the text, start of the line in it, Line) of all lines that may hold an
    improbable run. All texts are scored at once."""
    import numpy as np

    codes = _codes("\n" + "\n".join(texts) + "\n")
    scores = table.scores(codes)
    mass = np.concatenate(([0.0], np.cumsum(np.maximum(scores, 0.0))))
    rare, seen = np.concatenate(([0], np.cumsum(scores > 0))), np.concatenate(([0], np.cumsum(scores != ASCII_PAIR)))
    breaks = np.flatnonzero(codes == 10)
    first, last = breaks[:-1], breaks[1:]  # a line lies between two breaks; its pairs are first .. last - 1
    begins = np.cumsum([1] + [len(t) + 1 for t in texts])[:-1]
    heavy = np.flatnonzero(mass[last] - mass[first] >= RUN_SCORE)
    owner = np.searchsorted(begins, first[heavy] + 1, side="right") - 1
    for x, y, k in zip(first[heavy].tolist(), last[heavy].tolist(), owner.tolist()):
        start = x + 1 - int(begins[k])
        text = texts[k][start : start + y - x - 1]
        if _OWN.fullmatch(text):
            continue
        line = table.lines.get(text)
        if line is None:
            if len(table.lines) >= HELD_LINES:
                table.lines.clear()
            line = table.lines[text] = Line(text, scores[x:y].tolist(), table, (rare, seen, x)).work()
        yield k, start, line


def examine_all(texts: list[str | None], table: Pairs) -> list[tuple[list[tuple[int, int, str, str]], bool]]:
    """([(start, end, restored, mapping)], characters lost) of every text."""
    out: list = [([], False)] * len(texts)
    part, size = [], 0
    for k, text in enumerate(texts):
        if text and not text.isascii():
            part.append(k)
            size += len(text)
        if part and (size >= CHUNK or k == len(texts) - 1):
            for j, found in zip(part, _examined([texts[j] for j in part], table)):
                out[j] = found
            part, size = [], 0
    return out


def _examined(texts: list[str], table: Pairs) -> list[tuple[list, bool]]:
    found: list[list] = [[] for _ in texts]
    weak: list[dict[str, list]] = [{} for _ in texts]
    lost = ["\ufffd" in t for t in texts]
    for k, at, line in _worked(texts, table):
        found[k] += [(at + a, at + b, out, mapping) for a, b, out, mapping in line.found]
        for mapping, a, b, out, gain in line.weak:
            weak[k].setdefault(mapping, []).append((at + a, at + b, out, gain))
        lost[k] = lost[k] or line.lost
    return [(sorted(f + _together(w, f)), x) for f, w, x in zip(found, weak, lost)]


def examine(text: str | None, table: Pairs) -> tuple[list[tuple[int, int, str, str]], bool]:
    return examine_all([text], table)[0]


def _together(weak: dict[str, list], found: list) -> list[tuple[int, int, str, str]]:
    """Runs that alone were not sure: those of a mapping that surely was at work in the
    text, and those of the mapping whose gains together make it sure. Of runs within each
    other the first counts."""
    sure = {mapping for *_, mapping in found}
    best, extra = SURE, []
    out: list[tuple[int, int, str, str]] = []
    for mapping, runs_ in weak.items():
        taken: list[tuple[int, int, str, str]] = []
        total, edge = 0.0, -1
        free = _free(found)
        for a, b, new, gain in sorted(runs_, key=lambda r: (r[0], -r[1])):
            if a >= edge and free(a, b):
                taken.append((a, b, new, mapping))
                total, edge = total + gain, b
        if mapping in sure:
            free = _free(out)
            out += [x for x in taken if free(x[0], x[1])]
        elif total > best and not mapping.endswith(">utf-8"):
            best, extra = total, taken
    free = _free(out)
    return out + [x for x in extra if free(x[0], x[1])]


def _free(kept: list[tuple[int, int, str, str]]):
    """Whether a stretch touches none of those kept, which do not touch each other."""
    ends = sorted((x, y) for x, y, *_ in kept)
    starts = [x for x, _ in ends]

    def free(a: int, b: int) -> bool:
        k = bisect_left(starts, b) - 1
        return k < 0 or ends[k][1] <= a

    return free


def _kernel_with(shared):
    def kernel(columns: dict) -> dict:
        out = {n: [] for n in ("doc_id", "runs", "mapping", "lost", "restored")}
        table = shared.value
        for i, text, (found, lost) in zip(columns["doc_id"], columns["text"], examine_all(columns["text"], table)):
            if not found and not lost:
                continue
            parts, at = [], 0
            for a, b, new, _ in found:
                parts += [text[at:a], new]
                at = b
            whole = "".join(parts) + text[at:]
            for n, v in zip(out, (i, len(found), found[0][3] if found else None, lost, None if lost else whole.lstrip("\ufeff"))):
                out[n].append(v)
        return out

    return kernel


_SCHEMA = "doc_id bigint, runs int, mapping string, lost boolean, restored string"


def garbled(df: DataFrame, counts: DataFrame | None = None) -> DataFrame:
    """(doc_id, runs, mapping, lost, restored) of texts with a garbled stretch."""
    shared = df.sparkSession.sparkContext.broadcast(count_pairs((df if counts is None else counts).select("text")))
    rows = df.select("doc_id", "text").filter("text IS NOT NULL")
    return map_columns(rows, _kernel_with(shared), T.StructType.fromDDL(_SCHEMA))
