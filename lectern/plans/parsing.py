"""Queries over received lines (problem 1) and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.operators import records
from lectern.session import prepare, spread
from lectern.sources.tables import table


def p1_found(spark: SparkSession, folder: str) -> DataFrame:
    """Each line that breaks the contract, with the reason."""
    prepare(spark)
    return records.rejected(spread(table(spark, folder, "raw_lines").select("raw_id", "raw_line")))


def p1_loaded(spark: SparkSession, folder: str) -> DataFrame:
    """All valid lines as typed rows."""
    prepare(spark)
    rows = records.parse_lines(spread(table(spark, folder, "raw_lines").select("raw_id", "raw_line")), rejected=False)
    return rows.select(
        "raw_id",
        "corpus_name",
        F.date_format("recorded_at", "yyyy-MM-dd HH:mm:ss.SSS").alias("recorded_at"),
        "line_no",
        F.round("duration_s", 3).alias("duration_s"),
        "source_filename",
        "source_text",
    )


def p1_reasons(spark: SparkSession, folder: str) -> DataFrame:
    """Rejected and loaded lines per feed; the feed goes with its line."""
    prepare(spark)
    lines = spread(table(spark, folder, "raw_lines").select("raw_id", "raw_line", "feed"))
    rows = records.parse_lines(lines, carry="feed")
    return rows.groupBy(F.col("carried").alias("feed"), F.coalesce("reason", F.lit("loaded")).alias("outcome")).agg(F.count("*").alias("n"))


QUERIES = {"p1_found": p1_found, "p1_loaded": p1_loaded, "p1_reasons": p1_reasons}

_CELL = r'(?:"(?:[^"]|"")*"|[^"\t][^\t]*|)'
_NAMES = "['corpus_name','recorded_at','line_no','duration_s','source_filename','source_text']"
_READ = rf"""
data AS (
  SELECT raw_id, feed, regexp_replace(raw_line, '\r$', '') AS l FROM raw_lines
  WHERE raw_line IS NOT NULL AND regexp_matches(raw_line, '\S')
    AND NOT regexp_matches(raw_line, '^\s*#')
    AND lower(regexp_replace(regexp_replace(raw_line, '\r$', ''), '"', '', 'g')) <>
        concat_ws(chr(9), 'corpus_name','recorded_at','line_no','duration_s','source_filename','source_text')),
shaped AS (
  SELECT raw_id, feed, l,
    NOT regexp_full_match(l, '(?s){_CELL}(?:\t{_CELL})*') AS bad_quoting,
    regexp_full_match(l, '(?s){_CELL}(?:\t{_CELL}){{5}}') AS six,
    regexp_extract(l, '(?s)^({_CELL})\t({_CELL})\t({_CELL})\t({_CELL})\t({_CELL})\t({_CELL})$', {_NAMES}) AS c
  FROM data),
cells AS (
  SELECT raw_id, feed, bad_quoting, six,
    CASE WHEN c.corpus_name[1] = '"' THEN replace(c.corpus_name[2:-2], '""', '"') ELSE c.corpus_name END AS corpus_name,
    CASE WHEN c.recorded_at[1] = '"' THEN replace(c.recorded_at[2:-2], '""', '"') ELSE c.recorded_at END AS recorded_at,
    CASE WHEN c.line_no[1] = '"' THEN replace(c.line_no[2:-2], '""', '"') ELSE c.line_no END AS line_no,
    CASE WHEN c.duration_s[1] = '"' THEN replace(c.duration_s[2:-2], '""', '"') ELSE c.duration_s END AS duration_s,
    CASE WHEN c.source_filename[1] = '"' THEN replace(c.source_filename[2:-2], '""', '"') ELSE c.source_filename END AS source_filename,
    CASE WHEN c.source_text[1] = '"' THEN replace(c.source_text[2:-2], '""', '"') ELSE c.source_text END AS source_text
  FROM shaped),
read AS (
  SELECT *, CASE WHEN bad_quoting THEN 'quoting' WHEN NOT six THEN 'column_count'
    WHEN NOT regexp_matches(corpus_name, '\S')
      OR NOT regexp_full_match(recorded_at, '\d{{4}}-\d\d-\d\d[T ]\d\d:\d\d:\d\d(\.\d+)?(Z|\+([01]\d|2[0-3]):[0-5]\d)?')
      OR try_cast(replace(recorded_at[1:19], 'T', ' ') AS TIMESTAMP) IS NULL
      OR NOT regexp_full_match(line_no, '[0-9]*[1-9][0-9]*')
      OR NOT regexp_full_match(duration_s, '([0-9]+(\.[0-9]+)?)?')
      OR NOT regexp_full_match(source_filename, '(?is).+\.(wav|mp3|m4a|flac|ogg)')
      OR NOT regexp_matches(source_text, '\S')
      OR regexp_matches(source_filename, '[\x00-\x08\x0b-\x1f\x7f\x{{80}}-\x{{9f}}\x{{fffd}}]')
      OR regexp_matches(source_text, '[\x00-\x08\x0b-\x1f\x7f\x{{80}}-\x{{9f}}\x{{fffd}}]')
    THEN 'invalid_value' END AS reason
  FROM cells)"""

SQL = {
    "p1_found": f"WITH {_READ} SELECT raw_id, reason FROM read WHERE reason IS NOT NULL",
    "p1_loaded": f"""WITH {_READ} SELECT raw_id, corpus_name,
  strftime(replace(recorded_at[1:19], 'T', ' ')::TIMESTAMP
    + to_milliseconds(coalesce(rpad(nullif(regexp_extract(recorded_at, '\\.(\\d{{1,3}})', 1), ''), 3, '0')::BIGINT, 0))
    - to_minutes(coalesce(60 * nullif(regexp_extract(recorded_at, '\\+(\\d\\d):(\\d\\d)$', 1), '')::BIGINT
      + nullif(regexp_extract(recorded_at, '\\+(\\d\\d):(\\d\\d)$', 2), '')::BIGINT, 0)), '%Y-%m-%d %H:%M:%S.%g') AS recorded_at,
  try_cast(line_no AS BIGINT) AS line_no, round(try_cast(duration_s AS DOUBLE), 3) AS duration_s, source_filename, source_text
  FROM read WHERE reason IS NULL""",
    "p1_reasons": f"""WITH {_READ} SELECT feed, coalesce(reason, 'loaded') AS outcome, count(*)::BIGINT AS n
  FROM read GROUP BY ALL""",
}
