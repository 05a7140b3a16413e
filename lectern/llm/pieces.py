"""Splitting oversized texts at natural boundaries.

A text is worked in ranges of fixed size. A worker sees its range and a halo on
either side, nothing else: it finds the boundaries there (paragraph, line, sentence,
clause, word) and its anchor, the strongest of them behind the range's start. Pieces
never run across an anchor, so ranges are independent and the chain of cuts of one
ends where the next begins. Stitching the ranges' tables takes the overlap at the seams
and prefix sums of piece counts; pieces are given by offset.

Texts of a column and byte ranges of giant files go through the same two functions,
``cut_range`` (one range by its window) and ``seam`` (two neighbours).

Defined results
---------------
* texts of at most ``limit`` characters come out as one piece; null gives none and
  an empty text one empty piece;
* each later piece starts with up to ``overlap`` characters of the one before, cut
  at a word where there is one;
* a visible character (base and marks, emoji sequences, flags, syllable blocks) is
  never cut unless it alone is longer than the limit, where the limit holds;
* repeated rows are split one by one; extra columns are ignored.
"""

from __future__ import annotations

import bisect
import itertools
import re
import unicodedata as ud

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lectern.operators.arrow import map_columns

LIMIT, OVERLAP = 300, 50
#: Characters of a range of a text, bytes of a range of a file. A text or file shorter
#: than two ranges is one; the last range takes the rest.
RANGE, FILE_RANGE = 1024, 8 << 20
#: Characters behind a range's start in which its anchor lies, and before and behind
#: that a worker sees besides.
HALO, CONTEXT = 128, 512

PARAGRAPH, LINE, SENTENCE, CLAUSE, WORD, VISIBLE = 5, 4, 3, 2, 1, 0
_NATURAL = re.compile(
    r"(?P<p>(?:\r?\n[ \t]*){2,})|(?P<l>[\r\n  \x0b\x0c]\s*)"
    r"|(?P<s>(?:[!?…]|\.(?![\d.])|؟|۔)+[\"'”’»›)\]]*(?=\s)\s*|[。！？｡।॥]+[」』”’）】》]*\s*)"
    r"|(?P<c>[,;:，、；：،؛]\s+|[，、；：])|(?P<w>\s+)"
)
_RANK = {"p": PARAGRAPH, "l": LINE, "s": SENTENCE, "c": CLAUSE, "w": WORD}


def _extends(ch: str) -> bool:
    """True for characters that belong to the visible character before them."""
    if ch < "̀":
        return False
    return (
        ud.category(ch) in ("Mn", "Mc", "Me")
        or ch in "‌‍ำຳ"
        or "\U0001f3fb" <= ch <= "\U0001f3ff"
        or "\U000e0020" <= ch <= "\U000e007f"
        or "ﾞ" <= ch <= "ﾟ"
    )


def cuts_visible(text: str, at: int) -> bool:
    """True if a cut before ``text[at]`` would divide a visible character."""
    if not 0 < at < len(text):
        return False
    before, after = text[at - 1], text[at]
    if before == "\r" and after == "\n":
        return True
    if before < "̀" and after < "̀":
        return False
    if _extends(after) or before == "‍":
        return True
    if ud.combining(before) == 9 and ud.category(after) == "Lo":  # virama and consonant
        return True
    if "\U0001f1e6" <= after <= "\U0001f1ff" and "\U0001f1e6" <= before <= "\U0001f1ff":
        n = at
        while n > 0 and "\U0001f1e6" <= text[n - 1] <= "\U0001f1ff":
            n -= 1
        return (at - n) % 2 == 1
    if "ᄀ" <= after <= "ᇿ" and ("ᄀ" <= before <= "ᇿ" or "가" <= before <= "힣"):
        lead, vowel = before < "ᅠ", after >= "ᅠ"
        return (lead and "ᄀ" <= before) or vowel
    return False


def boundaries(text: str, lo: int = 0, hi: int | None = None, base: int = 0) -> list[tuple[int, int]]:
    """(offset, rank) of natural cuts with lo < offset <= hi, offsets shifted by base."""
    hi = len(text) if hi is None else hi
    found = []
    for m in _NATURAL.finditer(text, max(0, lo - 1)):
        at = m.end()
        if at > hi:
            if m.start() >= hi:
                break
            continue
        if at > lo and not cuts_visible(text, at):
            found.append((base + at, _RANK[m.lastgroup]))
    return found


def _visible_before(text: str, at: int, floor: int) -> int | None:
    """Last place in (floor, at] that divides no visible character."""
    while at > floor and cuts_visible(text, at):
        at -= 1
    return at if at > floor else None


def _overlap_start(text: str, cut: int, marks: dict[int, int], overlap: int, floor: int) -> int:
    """Start of the piece after ``cut``: at most ``overlap`` characters earlier, at
    the first word there, else at the first visible character."""
    if not overlap:
        return cut
    first = max(floor + 1, cut - overlap)
    for at in range(first, cut):
        if at in marks:
            return at
    for at in range(first, cut):
        if not cuts_visible(text, at):
            return at
    return cut


def chain(text: str, stops: list[tuple[int, int]], start: int, end: int, limit: int, overlap: int, first: int) -> list[tuple[int, int, int]]:
    """(start, end, rank of the end) of the pieces from cut ``first`` to ``end``; the
    first piece starts at ``start``, which may lie before ``first``, the others behind
    ``first``, so that the first may also start there (``seam``)."""
    marks = dict(stops)
    order = sorted(marks)
    out, lo, cut, k = [], start, first, 0
    while end - lo > limit:
        far = lo + limit
        while k < len(order) and order[k] <= cut:
            k += 1
        best, j = None, k
        while j < len(order) and order[j] <= far:
            near = order[j] - lo >= limit // 2
            key = (near, marks[order[j]] if near else 0, order[j])
            if best is None or key > best:
                best = key
            j += 1
        at = best[2] if best and best[2] - lo > overlap else None
        if at is None:
            at = _visible_before(text, far, max(cut, lo + overlap)) or far
        rank = marks.get(at, VISIBLE)
        out.append((lo, at, rank))
        lo, cut = _overlap_start(text, at, marks, overlap, max(lo, first)), at
    out.append((lo, end, marks.get(end, VISIBLE)))
    return out


def anchor(text: str, stops: list[tuple[int, int]], lo: int) -> int:
    """The strongest boundary of the HALO characters behind ``lo``, the first of equals;
    in a run without boundaries the first place that divides nothing. It hangs on these
    characters alone, so both ranges that meet here find the same."""
    near = [(r, -o) for o, r in stops if lo < o <= lo + HALO]
    if near:
        return -max(near)[1]
    for at in range(lo, min(lo + HALO, len(text)) + 1):
        if not cuts_visible(text, at) and not "\U0001f1e6" <= text[at : at + 1] <= "\U0001f1ff":
            return at
    return lo


def cut_range(window: str, lo: int, hi: int, first: bool, last: bool, limit: int, overlap: int) -> tuple[int, list[tuple[int, int, int]]]:
    """(anchor, [(start, end, rank of the end)]) of the range lo..hi of a window, in
    places of the window. The first piece starts up to ``overlap`` before the anchor."""
    stops = boundaries(window)
    begin = lo if first else anchor(window, stops, lo)
    end = len(window) if last else anchor(window, stops, hi)
    start = begin if first else _overlap_start(window, begin, dict(stops), overlap, max(0, begin - limit))
    return begin, chain(window, [b for b in stops if begin < b[0] <= end], start, end, limit, overlap, begin)


def seam(start: int, begin: int, before: int | None) -> int:
    """Where the first piece of a range starts, given the start of the last piece of the
    range before: without overlap if that would reach back beyond what it repeats."""
    return begin if before is not None and start <= before else start


def spans(total: int, size: int) -> list[tuple[int, int]]:
    """The ranges of 0..total."""
    n = max(1, total // size)
    return [(k * size, total if k == n - 1 else (k + 1) * size) for k in range(n)]


def _checked(limit: int, overlap: int, size: int) -> None:
    if not 0 <= overlap < limit // 2:
        raise ValueError("overlap must be below half the limit")
    if size < 4 * HALO:
        raise ValueError("a range must hold at least four halos")


def split_text(text: str, limit: int = LIMIT, overlap: int = OVERLAP, size: int = RANGE) -> list[tuple[int, int, int]]:
    """(start, end, rank of the end) of all pieces of a text."""
    _checked(limit, overlap, size)
    n = len(text)
    if n <= limit:
        return [(0, n, PARAGRAPH)]
    out: list[tuple[int, int, int]] = []
    for lo, hi in spans(n, size):
        left, right = max(0, lo - CONTEXT), min(n, hi + HALO + CONTEXT)
        begin, rows = cut_range(text[left:right], lo - left, hi - left, lo == 0, hi == n, limit, overlap)
        (start, end, rank), rest = rows[0], rows[1:]
        out.append((seam(left + start, left + begin, out[-1][0] if out else None), left + end, rank))
        out += [(left + a, left + b, r) for a, b, r in rest]
    return out


_LEVEL = {PARAGRAPH: "high", LINE: "high", SENTENCE: "high", CLAUSE: "medium", WORD: "medium", VISIBLE: "low"}
_SCHEMA = (
    "payload_id bigint, piece_no int, n_pieces int, start_off bigint, end_off bigint, piece_text string, "
    "seg_start string, seg_end string"
)


def pieces(df: DataFrame, limit: int = LIMIT, overlap: int = OVERLAP) -> DataFrame:
    """Pieces of ``source_text``. The first keeps the row's seg_start, the last its
    seg_end; inner edges are rated by the kind of boundary."""

    def kernel(columns: dict) -> dict:
        out = {n: [] for n in ("payload_id", "piece_no", "n_pieces", "start_off", "end_off", "piece_text", "seg_start", "seg_end")}
        for i, text, first, last in zip(columns["payload_id"], columns["source_text"], columns["seg_start"], columns["seg_end"]):
            parts = split_text(text, limit, overlap)
            edge = first
            for k, (a, b, rank) in enumerate(parts):
                final = k == len(parts) - 1
                for n, v in zip(out, (i, k + 1, len(parts), a, b, text[a:b], edge, last if final else _LEVEL[rank])):
                    out[n].append(v)
                edge = _LEVEL[rank]
        return out

    rows = df.select("payload_id", "source_text", "seg_start", "seg_end").filter("source_text IS NOT NULL")
    return map_columns(rows, kernel, _SCHEMA)


# ---------------------------------------------------------------- giant files


def _open(path: str):
    """A file of any store that Arrow knows (local, HDFS, object stores), for reading at
    an offset."""
    from pyarrow import fs

    store, inner = fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)
    return store.open_input_file(inner)


def _characters(data: bytes, at: int) -> int:
    """The first start of a UTF-8 character at or behind ``at``."""
    most = min(len(data), at + 3)
    while at < most and 0x80 <= data[at] < 0xC0:
        at += 1
    return at


def cut_bytes(path: str, lo: int, hi: int, total: int, limit: int, overlap: int) -> list[tuple[int, int, int, int, int]]:
    """(byte start, byte end, characters, byte of the anchor, characters from the anchor)
    of the pieces of one byte range. Only the range and its halos are read."""
    left, right = max(0, lo - 4 * CONTEXT), min(total, hi + 4 * (HALO + CONTEXT))
    with _open(path) as f:
        f.seek(left)
        data = f.read(right - left)
    a, b = _characters(data, 0), len(data)
    if right < total:  # leave out a character that may be incomplete
        b = next((k for k in range(b - 1, max(a, b - 4), -1) if not 0x80 <= data[k] < 0xC0), b)
    window = data[a:b].decode("utf-8", "surrogateescape")
    if window.isascii():
        places = range(left + a, left + b + 1)
    else:
        sizes = (1 if "\udc80" <= c <= "\udcff" else len(c.encode()) for c in window)
        places = list(itertools.accumulate(sizes, initial=left + a))
    at_lo, at_hi = bisect.bisect_left(places, lo), bisect.bisect_left(places, hi)
    begin, rows = cut_range(window, at_lo, at_hi, lo == 0, hi == total, limit, overlap)
    return [(places[x], places[y], y - x, places[begin], y - begin) for x, y, _ in rows]


def split_files(spark: SparkSession, paths: list[str], limit: int = LIMIT, overlap: int = OVERLAP, size: int = FILE_RANGE) -> DataFrame:
    """Pieces of giant UTF-8 files that every worker can open: (path, piece_no,
    byte_start, byte_end, n_chars). No task holds more than a range and its halos: ranges
    are made by the tasks from the files' sizes, their tables are stitched by the row
    before and numbered by prefix sums of their counts. An empty file gives no piece; a
    byte that is no UTF-8 counts as one character."""
    from pyspark.sql import Window

    _checked(limit, overlap, size)
    sized = []
    for p in paths:
        with _open(p) as f:
            sized.append((p, f.size()))
    files = spark.createDataFrame([x for x in sized if x[1]], "path string, total bigint")
    n = F.greatest(F.lit(1), F.floor(F.col("total") / size)).cast("long")
    ranges = files.select("path", "total", n.alias("n"), F.explode(F.sequence(F.lit(0).cast("long"), n - 1)).alias("r"))
    ranges = ranges.select("path", "total", "r", (F.col("r") * size).alias("lo"), F.when(F.col("r") == F.col("n") - 1, F.col("total")).otherwise((F.col("r") + 1) * size).alias("hi"))
    many = sum(max(1, t // size) for _, t in sized)
    ranges = ranges.repartition(max(1, min(many, MOST_TASKS)), "path", "r")

    names = ("path", "r", "k", "byte_start", "byte_end", "n_chars", "begin", "begin_chars")

    def kernel(columns: dict) -> dict:
        out = {c: [] for c in names}
        for path, total, r, lo, hi in zip(*(columns[c] for c in ("path", "total", "r", "lo", "hi"))):
            for k, row in enumerate(cut_bytes(path, lo, hi, total, limit, overlap)):
                for c, v in zip(names, (path, r, k, *row)):
                    out[c].append(v)
        return out

    schema = "path string, r bigint, k int, byte_start bigint, byte_end bigint, n_chars int, begin bigint, begin_chars int"
    rows = map_columns(ranges, kernel, schema)
    tables = rows.groupBy("path", "r").agg(F.count("*").alias("n"), F.max("byte_start").alias("last"))
    by = Window.partitionBy("path").orderBy("r")  # one row a range
    tables = tables.select("path", "r", (F.sum("n").over(by) - F.col("n")).alias("before"), F.lag("last").over(by).alias("last"))
    early = (F.col("k") == 0) & (F.col("byte_start") <= F.col("last"))
    return rows.join(tables, ["path", "r"]).select(
        "path",
        (F.col("before") + F.col("k") + 1).cast(T.LongType()).alias("piece_no"),
        F.when(early, F.col("begin")).otherwise(F.col("byte_start")).alias("byte_start"),
        "byte_end",
        F.when(early, F.col("begin_chars")).otherwise(F.col("n_chars")).alias("n_chars"),
    )


#: Tasks of a run over files.
MOST_TASKS = 20_000
