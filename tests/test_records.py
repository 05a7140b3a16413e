"""The record parser against strict reading line by line, and its edge cases."""

import csv
import io

import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from lectern.operators import records as R

GOOD = "c1\t2025-03-01T10:00:00+02:00\t007\t1.5\ta.WAV\thello"


def strict(lines):
    return [(k, *R.diagnose(x)) for k, x in enumerate(lines) if R.is_data(x)]


def found(lines):
    """(place, reason, typed cells) of data lines by the columnar path."""
    kept = [(k, x.removesuffix("\r")) for k, x in enumerate(lines) if R.is_data(x)]
    marks = R._data_marks(pa.array(lines, pa.string()))
    assert [k for k, m in enumerate(marks) if m] == [k for k, _ in kept]
    if not kept:
        return []
    places, columns, failing = R.parse_block(pa.array([x for _, x in kept], pa.string()))
    rows = [(kept[k][0], None, cells) for k, cells in zip(places, zip(*(c.to_pylist() for c in columns)))] if columns else []
    return sorted(rows + [(kept[k][0], *R.diagnose(lines[kept[k][0]])) for k in failing], key=lambda r: r[0])


cell = st.text(alphabet='ab" \t\nÄ1\r', max_size=6)
line = st.one_of(
    st.just(GOOD),
    st.lists(cell, min_size=5, max_size=7).map("\t".join),
    st.builds(lambda t, n: GOOD.replace("hello", t).replace("007", n), cell, st.sampled_from(["1", "0", "x", "00012", "12345678901234567890"])),
)


@settings(max_examples=150, deadline=None)
@given(st.lists(line, max_size=40))
def test_blocks_equal_strict_reading(lines):
    assert found(lines) == strict(lines)


def test_only_failing_lines_are_read_strictly():
    """One line in twelve is broken in one of three ways; nothing else is isolated."""
    broken = (GOOD.replace("hello", '"a'), GOOD + "\tx", GOOD.replace("2025-03-01", "2025-02-30"))
    lines = [broken[k // 12 % 3] if k % 12 == 5 else GOOD for k in range(3000)]
    places, columns, failing = R.parse_block(pa.array(lines))
    assert failing == [k for k in range(3000) if k % 12 == 5] and len(places) == 2750 == len(columns[0])


def test_bisection():
    bad = {3, 4, 17, 99}
    calls = []
    parts, alone = R.bisect(100, lambda a, b: calls.append(1) or any(a <= k < b for k in bad))
    assert set(alone) == bad and sum(b - a for a, b in parts) == 96 and len(calls) < 60 and R.bisect(0, None) == ([], [])


def test_reasons():
    cases = {
        GOOD: None, GOOD + "\r": None, GOOD.replace("hello", '"a\tb ""q"""'): None, GOOD.replace("hello", '"a'): "quoting", GOOD.replace("hello", '"a"x'): "quoting",
        GOOD + "\tx": "column_count", "a\tb": "column_count", GOOD.replace("2025-03-01", "2025-02-29"): "invalid_value", GOOD.replace("007", "0"): "invalid_value",
        GOOD.replace("1.5", "1,5"): "invalid_value", GOOD.replace(".WAV", ".txt"): "invalid_value", GOOD.replace("hello", " "): "invalid_value", GOOD.replace("hello", "a\x07"): "invalid_value",
        GOOD.replace("1.5", ""): None, GOOD.replace("+02:00", "Z"): None, GOOD.replace("+02:00", "+24:00"): "invalid_value",
    }
    assert {x: R.diagnose(x)[0] for x in cases} == cases


def test_no_data():
    assert not any(map(R.is_data, (None, "", "  \t", "# note", "  #x", "\t".join(R.COLUMNS), "\t".join(R.COLUMNS) + "\r")))


def test_cells_like_a_csv_reader():
    for text in (GOOD, GOOD.replace("hello", '"a ""b"" c"'), GOOD.replace("hello", '"a\nb"')):
        assert R.split_cells(text) == next(csv.reader(io.StringIO(text), delimiter="\t"))


def test_frame(spark):
    long = GOOD.replace("hello", "x" * 300_000)
    rows = [(1, GOOD, "a"), (2, GOOD, "a"), (3, None, None), (4, "", "b"), (5, long, "b"), (6, "x", None), (None, GOOD, "c")]
    df = spark.createDataFrame(rows, "raw_id bigint, raw_line string, reason string")
    got = {r.raw_id: r for r in R.parse_lines(df).collect()}
    assert set(got) == {1, 2, 5, 6, None} and got[1].ok and got[2].ok and len(got[5].source_text) == 300_000
    assert got[6].reason == "column_count" and str(got[1].recorded_at) == "2025-03-01 08:00:00" and got[1].line_no == 7
    assert R.parse_lines(df.limit(0)).count() == 0 and R.rejected(df).count() == 1
