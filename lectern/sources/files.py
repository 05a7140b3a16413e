"""Readers and writers of line and table files. Files are read by splits: what holds for
a whole file (encoding, delimiter, header, line numbers) is found by aggregations whose
results, a row a file or split, are sent to the lines, so no task loads a file and no
line is shuffled."""

from __future__ import annotations

import os
import unicodedata
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lectern.functions import text as X
from lectern.operators.arrow import map_columns, map_partition
from lectern.operators.lookup import checked
from lectern.operators.segment import split
from lectern.session import checkpoint_dir

# Encodings in the order in which they are tried; the last never fails.
ENCODINGS = ("utf-8", "utf-8-sig", "cp1250", "cp1252", "latin-1")
_LEGACY = ENCODINGS[2:]


def decode(data: bytes | None) -> tuple[str | None, str | None]:
    """(text, encoding) by the first encoding that fits; a byte order mark is dropped."""
    if data is None:
        return None, None
    for name in ENCODINGS:
        try:
            text = bytes(data).decode(name)
        except UnicodeDecodeError:
            continue
        return text.removeprefix("﻿"), name
    return None, None


def decoded(df: DataFrame, id_col: str, bytes_col: str) -> DataFrame:
    """(id, text, encoding) of binary content."""

    def kernel(columns: dict) -> dict:
        got = [decode(b) for b in columns[bytes_col]]
        return {id_col: columns[id_col], "text": [g[0] for g in got], "encoding": [g[1] for g in got]}

    return map_columns(df.select(id_col, bytes_col), kernel, f"{id_col} bigint, text string, encoding string")


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, line_no, line) of text files. Lines are numbered by their place in the
    file: parts are counted first and their sums shift the numbers within a part, so no
    task sees a whole file."""
    raw = spark.read.text(path).select(F.input_file_name().alias("file"), F.col("value").alias("line"))
    placed = raw.withColumn("id", F.monotonically_increasing_id())
    placed = placed.withColumn("part", F.shiftright("id", 33)).withColumn("k", F.col("id").bitwiseAND((1 << 33) - 1))
    sizes = placed.groupBy("file", "part").agg(F.count("*").alias("n"), F.min("k").alias("k0"))
    before = sizes.select("file", "part", "k0", (F.sum("n").over(Window.partitionBy("file").orderBy("part")) - F.col("n")).alias("before"))
    return checked(placed, before, ["file", "part"], ("id",)).select("file", (F.col("before") + F.col("k") - F.col("k0")).alias("line_no"), "line")


def file_encodings(lines: DataFrame) -> DataFrame:
    """(file, encoding, plain) of lines whose text is the bytes as read: the first encoding
    that fits all lines of a file; ``plain`` files hold ASCII alone. Only the lines of
    files that are no UTF-8 are looked at outside the JVM."""
    flags = lines.groupBy("file").agg(
        F.bool_and(F.is_valid_utf8("line")).alias("utf8"), F.bool_and(~F.col("line").rlike(r"[^\x00-\x7F]")).alias("plain")
    )

    def kernel(batches):
        bad: dict[str, set[str]] = {}
        for columns in batches:
            for name, data in zip(columns["file"], columns["data"]):
                mine = bad.setdefault(name, set())
                for e in _LEGACY[:-1]:
                    if e not in mine:
                        try:
                            bytes(data).decode(e)
                        except UnicodeDecodeError:
                            mine.add(e)
        rows = [(f, e) for f, es in bad.items() for e in _LEGACY if e not in es]
        yield {"file": [r[0] for r in rows], "encoding": [r[1] for r in rows], "tasks": [1] * len(rows)}

    foreign = checked(lines, flags.filter("NOT utf8").select("file"), "file", ("line_no",))
    fits = map_partition(foreign.select("file", F.col("line").cast("binary").alias("data")), kernel, "file string, encoding string, tasks bigint")
    votes = fits.groupBy("file", "encoding").agg(F.sum("tasks").alias("n"))
    most = votes.groupBy("file").agg(F.max(F.when(F.col("encoding") == _LEGACY[-1], F.col("n"))).alias("all"))
    rank = F.array_position(F.array(*map(F.lit, ENCODINGS)), F.col("encoding"))
    best = votes.join(most, "file").filter("n = all").groupBy("file").agg(F.min_by("encoding", rank).alias("legacy"))
    return flags.join(best, "file", "left").select("file", F.when(F.col("utf8"), "utf-8").otherwise(F.coalesce("legacy", F.lit(_LEGACY[-1]))).alias("encoding"), "plain")


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, line_no, line, encoding): lines decoded by the encoding of their file, in
    composed form (NFC), without a byte order mark."""
    lines = numbered_lines(spark, path)
    known = checked(lines, file_encodings(lines), "file", ("line_no",))

    def kernel(columns: dict) -> dict:
        out = []
        for no, data, e in zip(columns["line_no"], columns["data"], columns["encoding"]):
            text = bytes(data).decode(e)
            out.append(unicodedata.normalize("NFC", text.removeprefix("﻿") if no == 0 else text))
        return {"file": columns["file"], "line_no": columns["line_no"], "line": out, "encoding": columns["encoding"]}

    rest = known.filter("NOT plain").select("file", "line_no", F.col("line").cast("binary").alias("data"), "encoding")
    return known.filter("plain").select("file", "line_no", "line", "encoding").unionByName(
        map_columns(rest, kernel, "file string, line_no bigint, line string, encoding string")
    )


def file_shapes(lines: DataFrame) -> DataFrame:
    """(file, delimiter, most, header_no) of files: table files (``.tsv``) whose first
    non-blank line has no tab but two words or more are divided by white space, into at
    most as many cells as that line; ``header_no`` is the first line where it is a header."""
    first = lines.filter(~X.is_blank(F.col("line"))).groupBy("file").agg(F.min(F.struct("line_no", "line")).alias("f"))
    line = F.col("f.line")
    words = F.filter(F.split(line, r"\s+"), lambda w: w != "")
    table = F.lower("file").endswith(".tsv")
    white = table & ~F.contains(line, F.lit("\t")) & (F.size(words) >= 2)
    cells = F.when(F.contains(line, F.lit("\t")), F.split(line, "\t")).when(F.size(words) >= 2, words).otherwise(F.array(F.trim(line)))
    return first.select(
        "file",
        F.when(white, " ").otherwise("\t").alias("delimiter"),
        F.when(white, F.size(words)).otherwise(-1).alias("most"),
        F.when(X.is_header(cells), F.col("f.line_no")).alias("header_no"),
    )


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """(file, line_no, cells, source_id, text, is_header, is_comment, delimiter) of tab
    tables, of tables by white space and of plain lines. Blank rows of tables are left
    out, blank lines of plain files stay."""
    lines = read_lines(spark, path).drop("encoding")
    rows = checked(lines, file_shapes(lines), "file", ("line_no",), "left").withColumn("delimiter", F.coalesce("delimiter", F.lit("\t")))
    line, white = F.col("line"), F.col("delimiter") == " "
    by_space = F.split(F.regexp_replace(line, r"^\s+", ""), r"\s+", F.coalesce("most", F.lit(-1)))
    rows = rows.withColumn("cells", F.when(white, by_space).when(F.contains(line, F.lit("\t")), F.split(line, "\t")).otherwise(F.array(line)))
    table = F.lower("file").endswith(".tsv")
    return rows.filter(~(table & X.is_blank(line))).select(
        "file",
        "line_no",
        "cells",
        X.source_id(F.col("cells")).alias("source_id"),
        F.trim(X.strip_tags(F.element_at("cells", -1))).alias("text"),
        F.coalesce(F.col("line_no") == F.col("header_no"), F.lit(False)).alias("is_header"),
        X.is_comment(line).alias("is_comment"),
        "delimiter",
    )


def read_json_texts(spark: SparkSession, path: str) -> DataFrame:
    """(file, pos, text) of files that hold a JSON list of texts, or an object with
    ``transcriptions``; items that are no text are skipped."""
    raw = spark.read.text(path, wholetext=True).select(F.input_file_name().alias("file"), F.col("value"))
    listed = F.coalesce(F.from_json("value", "array<string>"), F.from_json("value", "transcriptions array<string>")["transcriptions"])
    return raw.select("file", F.posexplode(listed).alias("pos", "text")).withColumn("text", F.trim(X.strip_tags(F.col("text"))))


def read_payloads(spark: SparkSession, path: str, schema: str, whole: bool = False) -> DataFrame:
    """Payload records by ``schema``: one JSON object a line, or (``whole``) files that
    hold a list of objects or one object. What is no object is left out."""
    raw = spark.read.text(path, wholetext=whole)
    if whole:
        some = F.from_json("value", f"array<struct<{schema}>>")
        raw = raw.select(F.explode(F.when(F.ltrim("value").startswith("["), some).otherwise(F.array(F.from_json("value", schema)))).alias("r"))
    else:
        raw = raw.filter(F.ltrim("value").startswith("{")).select(F.from_json("value", schema).alias("r"))
    rows = raw.select("r.*")
    return rows.filter(F.greatest(*[F.col(c).isNotNull().cast("int") for c in rows.columns], F.lit(0)) == 1)


def without_comments(template: str) -> str:
    """A prompt template without the lines that begin with ``#``."""
    return "\n".join(row for row in template.split("\n") if not row.lstrip().startswith("#"))


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder."""
    return os.path.join(checkpoint_dir(spark).rstrip("/"), f"{name}-{uuid.uuid4().hex}")


def write_lines(df: DataFrame, path: str, line: str, *keys: str) -> None:
    """Text lines ordered by keys: ranges of the keys go to files in order."""
    df.orderBy(*keys).select(line).write.mode("overwrite").text(path)


def write_records(df: DataFrame, path: str, mode: str = "append") -> None:
    """One compact JSON record a line."""
    df.select(F.to_json(F.struct(*df.columns)).alias("value")).write.mode(mode).text(path)


def write_snapshot(df: DataFrame, path: str, chunk: str) -> None:
    """Rows of some chunks in a folder each: a chunk that is written again replaces what
    it wrote before, the others stay."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(chunk).parquet(path)


def output_line(text: Column, state: Column, original: Column, earlier: Column) -> Column:
    """The line that a snapshot holds for a row: comments as they are, rows that are not
    done as an earlier output has them (or empty), results in output form, markers of
    partial results untouched."""
    result = F.when(text.startswith("%%PS%%"), text).otherwise(X.sanitize(text))
    return F.when(X.is_comment(original), original).when(state == "done", result).otherwise(F.coalesce(earlier, F.lit("")))


def segment_rows(df: DataFrame, id_col: str, row_col: str, limit: int) -> DataFrame:
    """(id, seg, total, row): table rows whose text is longer than ``limit`` in several,
    the first cell marked with the segment; (id, seg, total) is the line map by which the
    output is put together again."""

    def kernel(columns: dict) -> dict:
        out = {n: [] for n in (id_col, "seg", "total", "row")}
        for i, row in zip(columns[id_col], columns[row_col]):
            *prefix, text = row.split("\t")
            body = text.strip()
            cuts = split(body, limit) if 0 < limit < len(body) else []
            for k, (a, b) in enumerate(cuts):
                marked = [f"{prefix[0]}_seg{k}of{len(cuts)}", *prefix[1:]] if prefix else []
                for n, v in zip(out, (i, k, len(cuts), "\t".join([*marked, body[a:b]]))):
                    out[n].append(v)
            if not cuts:
                for n, v in zip(out, (i, 0, 1, row)):
                    out[n].append(v)
        return out

    rows = df.select(id_col, row_col).filter(F.col(row_col).isNotNull())
    return map_columns(rows, kernel, f"{id_col} bigint, seg int, total int, row string")
