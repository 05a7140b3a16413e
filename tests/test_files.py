"""Readers and writers of files."""

import pytest
from pyspark.sql import functions as F

from lectern.operators import segment
from lectern.session import checkpoint_dir
from lectern.sources import files


def rows_of(df, *columns):
    return [tuple(r[c] for c in columns) for r in df.orderBy("file", "line_no").collect()]


@pytest.fixture
def folder(tmp_path):
    (tmp_path / "a.txt").write_bytes("příliš\nžluťoučký\n\nkůň\n".encode("cp1250"))
    (tmp_path / "b.txt").write_bytes(b"\xef\xbb\xbf" + "# note\nplain <b>text</b>\nété\n".encode())
    (tmp_path / "c.tsv").write_text("corpus  text\nname one   and more words here\n\n  other second text\n")
    (tmp_path / "d.tsv").write_text("file\tnumber\ttext\nx.wav\t7\t<em>hi</em>  there\n\t\t \n\t\tlast\n")
    (tmp_path / "e.txt").write_bytes(b"caf\xe9 \x81 \x8d\n")
    (tmp_path / "f.txt").write_text("ascii\n" * 3)
    (tmp_path / "g.txt").write_text("")
    return str(tmp_path)


def test_encodings(spark, folder):
    got = files.read_lines(spark, folder).withColumn("file", F.regexp_extract("file", r"\w\.\w+$", 0))
    by = {}
    for file, line, encoding in rows_of(got, "file", "line", "encoding"):
        by.setdefault((file, encoding), []).append(line)
    assert by[("a.txt", "cp1250")] == ["příliš", "žluťoučký", "", "kůň"]
    assert by[("b.txt", "utf-8")] == ["# note", "plain <b>text</b>", "été"]
    assert by[("e.txt", "latin-1")] == ["caf\xe9 \x81 \x8d"] and by[("f.txt", "utf-8")] == ["ascii"] * 3
    assert not any(f == "g.txt" for f, _ in by)


def test_tables(spark, folder):
    got = files.read_table(spark, folder).withColumn("file", F.regexp_extract("file", r"\w\.\w+$", 0))
    by = {}
    for file, *row in rows_of(got, "file", "line_no", "cells", "source_id", "text", "is_header", "is_comment", "delimiter"):
        by.setdefault(file, []).append(row)
    assert by["c.tsv"] == [
        [0, ["corpus", "text"], "corpus", "text", True, False, " "],
        [1, ["name", "one   and more words here"], "name", "one   and more words here", False, False, " "],
        [3, ["other", "second text"], "other", "second text", False, False, " "],
    ]
    assert [r[4] for r in by["d.tsv"]] == [True, False, False] and [r[3] for r in by["d.tsv"]] == ["text", "hi  there", "last"]
    assert [r[2] for r in by["d.tsv"]] == ["number", "7", None] and all(r[6] == "\t" for r in by["d.tsv"])
    assert [r[5] for r in by["b.txt"]] == [True, False, False] and len(by["a.txt"]) == 4


def test_payload_files(spark, tmp_path):
    (tmp_path / "l.jsonl").write_text('{"source_text": "a", "corrected_text": "b"}\nbroken\n[1]\n{"source_text": "c"}\n')
    (tmp_path / "w.json").write_text('[\n{"source_text": "a"},\n{"source_text": "b"}]')
    (tmp_path / "o.json").write_text('{"source_text": "x",\n "corrected_text": "y"}')
    schema = "source_text string, corrected_text string"
    read = lambda name, whole: sorted(tuple(r) for r in files.read_payloads(spark, str(tmp_path / name), schema, whole).fillna("-").collect())
    assert read("l.jsonl", False) == [("a", "b"), ("c", "-")]
    assert read("w.json", True) == [("a", "-"), ("b", "-")] and read("o.json", True) == [("x", "y")]


def test_json_texts(spark, tmp_path):
    (tmp_path / "t.json").write_text('{"transcriptions": ["a", " <b>b</b> "]}')
    assert [(r.pos, r.text) for r in files.read_json_texts(spark, str(tmp_path)).orderBy("pos").collect()] == [(0, "a"), (1, "b")]


def test_templates():
    assert files.without_comments("# head\nbody {x}\n  # note\nend") == "body {x}\nend"


def test_snapshots(spark, tmp_path):
    """A chunk written again replaces itself alone."""
    path = str(tmp_path / "out")
    df = spark.createDataFrame([(0, "a"), (0, "b"), (1, "c")], "chunk int, line string")
    files.write_snapshot(df, path, "chunk")
    files.write_snapshot(spark.createDataFrame([(0, "x")], "chunk int, line string"), path, "chunk")
    assert sorted((r.chunk, r.line) for r in spark.read.parquet(path).collect()) == [(0, "x"), (1, "c")]
    rows = spark.createDataFrame(
        [("%%PS%%{  }", "done", "s", None), ("a\n  b", "done", "s", None), ("x", "failed", "s", "old"), (None, "failed", "s", None), ("x", "done", "# c", None)],
        "t string, state string, original string, earlier string",
    )
    out = [r[0] for r in rows.select(files.output_line(*map(F.col, ("t", "state", "original", "earlier")))).collect()]
    assert out == ["%%PS%%{  }", "a b", "old", "", "# c"]


def test_segment_rows(spark):
    long = "One sentence here. " * 40
    df = spark.createDataFrame([(1, f"f.wav\t3\t{long}"), (2, "short"), (3, None), (4, long)], "id bigint, row string")
    got = files.segment_rows(df, "id", "row", 300).orderBy("id", "seg").collect()
    first = [r for r in got if r.id == 1]
    assert [r.row.split("\t")[0] for r in first] == [f"f.wav_seg{k}of{len(first)}" for k in range(len(first))] and {r.total for r in first} == {len(first)}
    assert "".join(r.row.split("\t")[-1] for r in first) == long.strip() and [(r.seg, r.total, r.row) for r in got if r.id == 2] == [(0, 1, "short")]
    assert len([r for r in got if r.id == 4]) == len(segment.split(long.strip(), 300)) and not [r for r in got if r.id == 3]


def test_a_cluster_must_name_its_folder():
    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master = "spark://host:7077"

        def getConf(self):
            return Conf()

    class Session:
        sparkContext, conf = Context(), Conf()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        checkpoint_dir(Session())
