import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lectern.llm import pieces as K


def check(text, parts, limit, overlap):
    assert parts[0][0] == 0 and parts[-1][1] == len(text)
    for k, (a, b, _) in enumerate(parts):
        assert b - a <= limit and (b > a or not text)
        if b - a < limit:
            assert not K.cuts_visible(text, a) and not K.cuts_visible(text, b)
        if k:
            before = parts[k - 1]
            assert before[0] < a <= before[1] < b and before[1] - a <= overlap


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="ab .!\n，。é́‍👍🏽🇩🇪क्ष한", max_size=400), st.sampled_from([(10, 0), (20, 5), (60, 20)]))
def test_rules(text, sizes):
    check(text, K.split_text(text, *sizes), *sizes)


def small_ranges(monkeypatch):
    monkeypatch.setattr(K, "HALO", 16)
    monkeypatch.setattr(K, "CONTEXT", 160)


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="ab .!\n，。é́‍👍🏽🇩🇪क्ष한", min_size=150, max_size=900), st.sampled_from([(20, 5), (60, 20)]))
def test_rules_over_ranges(text, sizes):
    with pytest.MonkeyPatch.context() as patch:
        small_ranges(patch)
        check(text, K.split_text(text, *sizes, size=64), *sizes)


def test_ranges(monkeypatch):
    small_ranges(monkeypatch)
    text = "Some words. More of them, and more\n" * 300
    for size in (128, 500, 5000, 50_000):
        check(text, K.split_text(text, 60, 10, size), 60, 10)
    for word in ("a" * 5000, "字" * 5000, "🇩🇪" * 2500, "é" * 2500, " " * 5000):
        check(word, K.split_text(word, 60, 10, 128), 60, 10)


def test_ranges_see_only_their_windows(monkeypatch):
    """The pieces of a range follow from its window: those of a text of many ranges are
    the seams of pieces that every window gives alone."""
    text = "".join(f"Line {k} says this. And more of it, too\n" for k in range(400))
    seen = []
    real = K.cut_range
    monkeypatch.setattr(K, "cut_range", lambda window, *a: seen.append(len(window)) or real(window, *a))
    got = K.split_text(text)
    assert len(seen) == len(text) // K.RANGE > 10 and max(seen) <= 2 * K.RANGE + 2 * K.CONTEXT + K.HALO
    check(text, got, 300, 50)
    with pytest.raises(ValueError):
        K.split_text(text, size=K.HALO)


def test_natural_places():
    text = "First sentence is here. " * 30
    assert all(text[b - 2] == "." for _, b, _ in K.split_text(text, 100, 20)[:-1])
    with pytest.raises(ValueError):
        K.split_text("a" * 500, 100, 60)


def test_files(spark, tmp_path):
    """The pieces of a file by byte range are those of its text by ranges of characters,
    where both have the same ranges, and keep the rules."""
    text = "".join(f"Line {k} says příliš 漢字. And more.\n" for k in range(4000))
    path = tmp_path / "giant.txt"
    path.write_text(text, encoding="utf-8")
    (tmp_path / "plain.txt").write_text("Some words here. And some more, too\n" * 3000)
    (tmp_path / "empty.txt").write_text("")
    data = path.read_bytes()
    got = K.split_files(spark, [str(path), f"file://{tmp_path}/plain.txt", str(tmp_path / "empty.txt")], size=20_000)
    rows = got.filter(got.path.endswith("giant.txt")).orderBy("piece_no").collect()
    assert [r.piece_no for r in rows] == list(range(1, len(rows) + 1))
    assert rows[0].byte_start == 0 and rows[-1].byte_end == len(data)
    for p, q in zip(rows, rows[1:]):
        assert p.byte_start < q.byte_start <= p.byte_end < q.byte_end
        assert len(data[q.byte_start : q.byte_end].decode()) == q.n_chars <= 300
        assert len(data[q.byte_start : p.byte_end].decode()) <= 50
    plain = (tmp_path / "plain.txt").read_text()
    rows = got.filter(got.path.endswith("plain.txt")).orderBy("piece_no").collect()
    assert [(r.byte_start, r.byte_end) for r in rows] == [(a, b) for a, b, _ in K.split_text(plain, size=20_000)]
    assert K.split_files(spark, []).count() == 0


def test_frame(spark):
    long = "word " * 60_000
    rows = [(1, "short", "high", "low", 1), (2, None, None, None, 1), (3, "", "low", "low", 1), (4, long, "medium", "high", 1), (5, "short", "high", "low", 1)]
    df = spark.createDataFrame(rows, "payload_id bigint, source_text string, seg_start string, seg_end string, piece_no int")
    got = K.pieces(df).collect()
    assert sorted(r.payload_id for r in got if r.piece_no == 1) == [1, 3, 4, 5]
    four = sorted((r for r in got if r.payload_id == 4), key=lambda r: r.piece_no)
    assert four[0].seg_start == "medium" and four[-1].seg_end == "high" and four[0].n_pieces == len(four)
    assert K.pieces(df.limit(0)).count() == 0


@pytest.mark.parametrize("run", ["a" * 120_000, "字" * 40_000, "กำ" * 20_000, "🇩🇪" * 3_000])
def test_files_without_boundaries(tmp_path, run):
    """A run without boundaries across range starts comes out once, whole and in order,
    and no range reads more than its halos besides itself."""
    path = tmp_path / "run.txt"
    path.write_text("Words before it. " * 1500 + run + " words after it." * 3000, encoding="utf-8")
    total, data = path.stat().st_size, path.read_bytes()
    ranges = [K.cut_bytes(str(path), lo, hi, total, 300, 50) for lo, hi in K.spans(total, 20_000)]
    rows = [r for part in ranges for r in part]
    assert rows[0][0] == 0 and rows[-1][1] == total
    assert all(p[0] < q[0] <= p[1] < q[1] for p, q in zip(rows, rows[1:]))
    assert all(len(data[a:b].decode()) == n <= 300 for a, b, n, _, _ in rows)


def test_broken_bytes(tmp_path):
    """Bytes that are no UTF-8 count as one character each; nothing is lost."""
    path = tmp_path / "broken.txt"
    path.write_bytes(b"ok \xff\xfe words. " * 4000 + b"\x80" * 9000 + "é".encode() * 3000)
    total = path.stat().st_size
    rows = [r for lo, hi in K.spans(total, 10_000) for r in K.cut_bytes(str(path), lo, hi, total, 300, 50)]
    assert rows[0][0] == 0 and rows[-1][1] == total and all(p[0] < q[0] <= p[1] < q[1] for p, q in zip(rows, rows[1:]))
