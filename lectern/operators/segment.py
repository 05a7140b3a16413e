"""Segments of lines for a model call, and their re-assembly."""

from __future__ import annotations

import unicodedata as ud

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.operators.arrow import map_columns

# Sentence marks, clause marks and closers.
MARKS = ".!?。！？؟۔।॥։።;:；：؛"
CLOSERS = "\"'”’»›」』》】〉）］｝)]}"
BREAKS = ("\n\n", "\r\n\r\n", "\n", "\r\n")
CONTEXT = 50


def _joins(ch: str) -> bool:
    return ud.category(ch) in ("Mn", "Mc", "Me") or ch in "‌‍" or "︀" <= ch <= "️" or "\U0001f3fb" <= ch <= "\U0001f3ff"


def _flag(ch: str) -> bool:
    return "\U0001f1e6" <= ch <= "\U0001f1ff"


def _unstable(text: str, at: int) -> bool:
    if not 0 < at < len(text):
        return False
    if _joins(text[at]) or text[at - 1] == "‍":
        return True
    if _flag(text[at]) and _flag(text[at - 1]):
        k = at
        while k > 0 and _flag(text[k - 1]):
            k -= 1
        return (at - k) % 2 == 1
    return False


def stabilize(text: str, start: int, at: int, hard: int) -> int:
    """Move a cut off joined characters: to the right within the limit, else left."""
    moved = at
    while moved < hard and _unstable(text, moved):
        moved += 1
    while moved > start + 1 and _unstable(text, moved):
        moved -= 1
    return max(moved, start + 1)


def _letters_around(text: str, left: int, right: int) -> bool:
    return (left < 0 or text[left].isalpha()) and (right >= len(text) or text[right].isalpha())


def cut_index(text: str, start: int, limit: int) -> int:
    """Where the next segment ends, by falling preference of boundary."""
    hard = min(len(text), start + limit)
    least = start + max(1, limit // 2)
    for mark in BREAKS:
        k = text.rfind(mark, start, hard)
        if k >= 0 and k + len(mark) >= least:
            return k + len(mark)
    ends, last_mark = [], -1
    k = start
    while k < hard:
        if text[k] in MARKS:
            j = k + 1
            while j < hard and text[j] in CLOSERS:
                j += 1
            ends.append((k, j))
            last_mark = k + 1
        k += 1
    for k, j in reversed(ends):
        if j < hard and text[j].isspace():
            w = j
            while w < len(text) and text[w].isspace():
                w += 1
            if j >= least and _letters_around(text, k - 1, w):
                return j
    blanks = [k for k in range(hard - 1, start - 1, -1) if text[k].isspace() and k + 1 >= least]
    for k in blanks:
        if _letters_around(text, k - 1, k + 1):
            return k + 1
    if blanks:
        return blanks[0] + 1
    for _, j in reversed(ends):
        if j >= least:
            return j
    return last_mark if last_mark >= least else hard


def take_next(text: str, start: int, limit: int) -> tuple[str, int]:
    """(segment, end): the rest whole while it is at most half over the limit."""
    if limit <= 0 or len(text) - start <= 1.5 * limit:
        return text[start:], len(text)
    end = stabilize(text, start, cut_index(text, start, limit), min(len(text), start + limit))
    return text[start:end], end


def split(text: str, limit: int) -> list[tuple[int, int]]:
    out, at = [], 0
    while at < len(text):
        _, end = take_next(text, at, limit)
        out.append((at, end))
        at = end
    return out or [(0, 0)]


def segments(df: DataFrame, id_col: str, text_col: str, limit: int = 300) -> DataFrame:
    """(id, seg_no, seg_text, start_off, end_off, prev_context, next_context) of every
    line; the contexts are the last and first characters beside the segment."""
    names = (id_col, "seg_no", "seg_text", "start_off", "end_off", "prev_context", "next_context")

    def kernel(columns: dict) -> dict:
        out = {n: [] for n in names}
        for i, text in zip(columns[id_col], columns[text_col]):
            cuts = [(0, 0), *split(text, limit), (len(text), len(text))]
            for k in range(1, len(cuts) - 1):
                (x, a), (_, b), (_, y) = cuts[k - 1], cuts[k], cuts[k + 1]
                for n, v in zip(names, (i, k - 1, text[a:b], a, b, text[max(x, a - CONTEXT) : a], text[b : min(y, b + CONTEXT)])):
                    out[n].append(v)
        return out

    rows = df.select(id_col, text_col).filter(F.col(text_col).isNotNull())
    schema = f"{id_col} bigint, seg_no int, seg_text string, start_off int, end_off int, prev_context string, next_context string"
    return map_columns(rows, kernel, schema)
