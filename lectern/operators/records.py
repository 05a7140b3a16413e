"""Rows that fail to parse.

Lines are six tab-separated cells. Every Arrow batch is a block of lines that is
parsed on a columnar path: one pattern and the checks of the cells over all lines,
then bulk casts. A block in which anything fails is bisected until the failing lines
stand alone: first by what the pattern and the checks left without a match (sums of
the marks before each line tell in one step whether a part holds any), then, over the
lines that are left, by casts that fail as a whole, such as that of 30 February. Only
the lines isolated so are read by the strict reader, which names the reason; all
others stay Arrow columns throughout.

Defined results
---------------
* null or blank lines, lines whose first non-space character is ``#`` and
  repeated header lines are no data and give no row;
* a line sent again gives its own row (ids decide, not content);
* a trailing CR is ignored;
* ``line_no`` beyond 64 bits is valid, loads as null and stays in ``line_no_text``;
* an empty table gives an empty result; further input columns are ignored;
* a valid time with an offset loads as UTC, one without as it stands.
"""

from __future__ import annotations

import re
from datetime import datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

COLUMNS = ("corpus_name", "recorded_at", "line_no", "duration_s", "source_filename", "source_text")
EXTENSIONS = ("wav", "mp3", "m4a", "flac", "ogg")
_TIME = re.compile(
    r"(\d{4})-(\d{2})-(\d{2})[T ](\d{2}):(\d{2}):(\d{2})(?:\.(\d+))?(?:(Z)|\+(\d{2}):(\d{2}))?", re.ASCII
)
_LINE_NO = re.compile(r"[0-9]*[1-9][0-9]*")
_DURATION = re.compile(r"(?:[0-9]+(?:\.[0-9]+)?)?")
_NAME = re.compile(r".+\.(?:" + "|".join(EXTENSIONS) + r")", re.IGNORECASE | re.DOTALL)
_BAD_CHAR = re.compile("[\x00-\x08\x0b-\x1f\x7f-\x9f�]")

# The same contract as one RE2 pattern for a whole block. An unquoted cell does
# not begin with a quote, so the alternatives exclude each other.
_CELL = r'(?:"(?:[^"]|"")*"|[^"\t][^\t]*|)'
_ROW = r"(?s)\A" + r"\t".join(f"(?P<{c}>{_CELL})" for c in COLUMNS) + r"\z"
_FAST_TIME = r"\A[0-9]{4}-[0-9]{2}-[0-9]{2}[T ][0-9]{2}:[0-9]{2}:[0-9]{2}(\.[0-9]+)?(Z|\+([01][0-9]|2[0-3]):[0-5][0-9])?\z"

SCHEMA = (
    "raw_id bigint, ok boolean, reason string, corpus_name string, recorded_at timestamp_ntz, line_no bigint, "
    "line_no_text string, duration_s double, source_filename string, source_text string"
)


def split_cells(line: str) -> list[str] | None:
    """Cells of one line, or None where a quoted cell is unclosed or wrongly closed."""
    cells, at, end = [], 0, len(line)
    while True:
        if line[at : at + 1] == '"':
            out, at = [], at + 1
            while True:
                stop = line.find('"', at)
                if stop < 0:
                    return None
                out.append(line[at:stop])
                if line[stop + 1 : stop + 2] == '"':
                    out.append('"')
                    at = stop + 2
                    continue
                at = stop + 1
                break
            if at < end and line[at] != "\t":
                return None
            cells.append("".join(out))
        else:
            stop = line.find("\t", at)
            stop = end if stop < 0 else stop
            cells.append(line[at:stop])
            at = stop
        if at >= end:
            return cells
        at += 1


def read_time(value: str) -> datetime | None:
    """Date and time in UTC, or None where the value is no existing time."""
    m = _TIME.fullmatch(value)
    if not m:
        return None
    try:
        at = datetime(*map(int, m.group(1, 2, 3, 4, 5, 6)), int((m[7] or "0")[:6].ljust(6, "0")))
        if m[9]:
            if int(m[9]) > 23 or int(m[10]) > 59:
                return None
            at -= timedelta(hours=int(m[9]), minutes=int(m[10]))
    except (ValueError, OverflowError):
        return None
    return at


def is_data(line: str | None) -> bool:
    """False for blank, comment and header lines."""
    if line is None or not line.strip():
        return False
    if line.lstrip().startswith("#"):
        return False
    if line.count("\t") != len(COLUMNS) - 1:
        return True
    names = tuple(c.strip().strip('"').strip().lower() for c in line.lstrip("\ufeff").split("\t"))
    return names != COLUMNS


def diagnose(line: str) -> tuple[str | None, tuple | None]:
    """Strict reading of one line: (reason, None) or (None, typed cells)."""
    cells = split_cells(line.removesuffix("\r"))
    if cells is None:
        return "quoting", None
    if len(cells) != len(COLUMNS):
        return "column_count", None
    corpus, at, number, duration, name, text = cells
    when = read_time(at)
    if (
        not corpus.strip()
        or when is None
        or not _LINE_NO.fullmatch(number)
        or not _DURATION.fullmatch(duration)
        or not _NAME.fullmatch(name)
        or not text.strip()
        or _BAD_CHAR.search(name)
        or _BAD_CHAR.search(text)
    ):
        return "invalid_value", None
    value = int(number)
    return None, (corpus, when, value if value < 2**63 else None, number, float(duration) if duration else None, name, text)


_HEADER = r"(?is)corpus_name.*\t.*source_text"
_BAD = r"[\x00-\x08\x0b-\x1f\x7f\x{80}-\x{9f}\x{fffd}]"


def _data_marks(lines):
    """Which lines (a pyarrow string array) are data, as ``is_data`` tells."""
    import numpy as np
    import pyarrow.compute as pc

    skip = pc.or_(pc.equal(pc.utf8_trim_whitespace(lines), ""), pc.starts_with(pc.utf8_ltrim_whitespace(lines), "#"))
    marks = ~np.asarray(pc.fill_null(skip, True))
    for k in np.flatnonzero(np.asarray(pc.fill_null(pc.match_substring_regex(lines, _HEADER), False)) & marks):
        marks[k] = is_data(lines[int(k)].as_py())  # few lines look like a header
    return marks


def _cells(lines):
    """(cells as six string arrays, which lines have six well-formed cells with valid
    characters and forms): one pass over the whole block."""
    import numpy as np
    import pyarrow.compute as pc

    found = pc.extract_regex(lines, _ROW)
    sound = ~np.asarray(found.is_null())
    cells = []
    for i in range(len(COLUMNS)):
        cell = pc.fill_null(found.field(i), "")
        quoted = pc.starts_with(cell, '"')
        if pc.any(quoted).as_py():
            inner = pc.replace_substring(pc.utf8_slice_codeunits(cell, 1, -1), '""', '"')
            cell = pc.if_else(quoted, inner, cell)
        cells.append(cell)
    corpus, at, number, duration, name, text = cells
    for checked in (
        pc.match_substring_regex(at, _FAST_TIME),
        pc.match_substring_regex(number, r"\A0*[1-9][0-9]{0,17}\z"),
        pc.match_substring_regex(duration, r"\A([0-9]+(\.[0-9]+)?)?\z"),
        pc.match_substring_regex(name, r"(?is)\A.+\.(" + "|".join(EXTENSIONS) + r")\z"),
        pc.invert(pc.match_substring_regex(name, _BAD)),
        pc.invert(pc.match_substring_regex(text, _BAD)),
        pc.greater(pc.utf8_length(pc.utf8_trim_whitespace(corpus)), 0),
        pc.greater(pc.utf8_length(pc.utf8_trim_whitespace(text)), 0),
    ):
        sound &= np.asarray(checked)
    return cells, sound


def _cast(cells):
    """Typed columns of a block of sound lines, or None where a cast fails."""
    import pyarrow as pa
    import pyarrow.compute as pc

    corpus, at, number, duration, name, text = cells
    try:
        numbers = pc.cast(pc.utf8_ltrim(number, "0"), pa.int64())
        seconds = pc.cast(pc.replace_substring(pc.utf8_slice_codeunits(at, 0, 19), "T", " "), pa.timestamp("us"))
        lengths = pc.cast(pc.utf8_lpad(duration, 1, "0"), pa.float64())
    except pa.ArrowInvalid:
        return None
    rest = pc.extract_regex(at, r"\A.{19}(?:\.(?P<f>[0-9]+))?(?:Z|\+(?P<h>[0-9]{2}):(?P<m>[0-9]{2}))?\z")
    zero = lambda a: pc.cast(pc.if_else(pc.equal(a, ""), "0", a), pa.int64())
    micro = zero(pc.utf8_slice_codeunits(pc.utf8_rpad(rest.field(0), 6, "0"), 0, 6))
    shift = pc.add(pc.multiply(zero(rest.field(1)), 3600), pc.multiply(zero(rest.field(2)), 60))
    when = pc.add(pc.cast(seconds, pa.int64()), pc.subtract(micro, pc.multiply(shift, 1_000_000)))
    lengths = pc.if_else(pc.equal(duration, ""), pa.scalar(None, pa.float64()), lengths)
    return [corpus, pc.cast(when, pa.timestamp("us")), numbers, number, lengths, name, text]


def bisect(n: int, fails) -> tuple[list[tuple[int, int]], list[int]]:
    """([parts that are sound], [single places that fail]) of 0..n. ``fails(a, b)`` tells
    whether a part holds a failing place; such parts are halved."""
    parts, alone, stack = [], [], [(0, n)] if n else []
    while stack:
        a, b = stack.pop()
        if not fails(a, b):
            parts.append((a, b))
        elif b - a == 1:
            alone.append(a)
        else:
            half = (a + b) // 2
            stack += [(half, b), (a, half)]
    return parts, alone


def parse_block(lines):
    """(places of sound lines, their typed columns, places of isolated lines) of a block
    of data lines without their trailing CR."""
    import numpy as np
    import pyarrow as pa

    cells, sound = _cells(lines)
    before = np.concatenate(([0], np.cumsum(~sound)))
    parts, alone = bisect(len(lines), lambda a, b: before[b] > before[a])
    rest = np.concatenate([np.arange(a, b) for a, b in parts]) if parts else np.zeros(0, np.int64)
    left = [c.take(pa.array(rest)) for c in cells]
    typed: dict[tuple[int, int], list] = {}

    def fails(a: int, b: int) -> bool:
        part = pa.array(np.arange(a, b))
        got = _cast([c.take(part) for c in left] if b - a < len(rest) else left)  # copies: slices of text mislead if_else
        if got is not None:
            typed[a, b] = got
        return got is None

    parts, failing = bisect(len(rest), fails)
    places = np.concatenate([rest[a:b] for a, b in parts]) if parts else rest
    columns = [pa.concat_arrays(list(c)) for c in zip(*(typed[p] for p in parts))] if parts else None
    return places, columns, sorted(alone + [int(rest[k]) for k in failing])


_TYPED = ("corpus_name", "recorded_at", "line_no", "line_no_text", "duration_s", "source_filename", "source_text")


def parse_lines(df: DataFrame, id_col: str = "raw_id", line_col: str = "raw_line", carry: str | None = None, loaded: bool = True, rejected: bool = True) -> DataFrame:
    """One row per data line: ``ok`` rows carry typed cells, the others a reason. One more
    column of text may be carried along; rows that are not asked for are not built."""
    schema = T.StructType.fromDDL(SCHEMA + (", carried string" if carry else ""))

    def run(batches):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(schema)

        def build(n: int, **columns):
            made = [pa.array(columns[f.name], f.type) if isinstance(columns.get(f.name), list) else pc.cast(columns[f.name], f.type) if f.name in columns else pa.nulls(n, f.type) for f in arrow]
            return pa.RecordBatch.from_arrays(made, schema=arrow)

        for batch in batches:
            kept = pa.array(np.flatnonzero(_data_marks(batch.column(1))))
            batch = batch.take(kept)
            if not len(kept):
                continue
            lines = pc.replace_substring_regex(batch.column(1), r"\r\z", "")
            places, columns, failing = parse_block(lines)
            rows = [(k, *diagnose(batch.column(1)[k].as_py())) for k in failing]
            good = [r for r in rows if r[1] is None]  # valid, but beyond what the casts take
            bad = [r for r in rows if r[1] is not None]
            more = lambda at: {"carried": batch.column(2).take(pa.array(at, pa.int64()))} if carry else {}
            ids = lambda at: batch.column(0).take(pa.array(at, pa.int64()))
            if loaded and columns is not None:
                yield build(len(places), raw_id=ids(places), ok=pa.repeat(True, len(places)), **dict(zip(_TYPED, columns)), **more(places))
            if loaded and good:
                at = [r[0] for r in good]
                corpus, when, number, written, duration, name, text = map(list, zip(*(r[2] for r in good)))
                values = dict(zip(_TYPED, (corpus, when, number, written, duration, name, text)))
                yield build(len(at), raw_id=ids(at), ok=[True] * len(at), **values, **more(at))
            if rejected and bad:
                at = [r[0] for r in bad]
                yield build(len(at), raw_id=ids(at), ok=[False] * len(at), reason=[r[1] for r in bad], **more(at))

    rows = [F.col(id_col).alias("raw_id"), F.col(line_col).alias("raw_line")]
    return df.select(*rows, *([F.col(carry).cast("string").alias("carried")] if carry else [])).mapInArrow(run, schema)


def rejected(df: DataFrame, id_col: str = "raw_id", line_col: str = "raw_line") -> DataFrame:
    """Lines that break the contract, with the reason."""
    return parse_lines(df, id_col, line_col, loaded=False).select("raw_id", "reason")
