"""Queries over lines, cells and characters, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lectern.functions import classes as K
from lectern.functions import steps as S
from lectern.functions import text as X
from lectern.functions import tokens as T
from lectern.operators import chunks
from lectern.operators.arrow import map_columns
from lectern.session import prepare, spread
from lectern.sources.tables import table

LIMIT = 300
VERDICT_KEYS = ("！！", "……")
MARKS = r".,;:!?\x{3002}\x{FF0C}\x{FF1B}\x{FF1A}\x{FF01}\x{FF1F}\x{3001}\x{00B7}\x{2026}\x{FF0E}"
LEGIT = ("!!", "??", "!?", "?!", "..")


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents").filter("text IS NOT NULL")


def payloads(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "payloads")


def lines(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, pos, line): documents split at line feeds."""
    return documents(spark, folder).select("doc_id", F.posexplode(F.split("text", "\n")).alias("pos", "line"))


def tab_rows(spark: SparkSession, folder: str) -> DataFrame:
    flat = F.replace(F.col("text"), F.lit("\n"), F.lit(" "))
    tagged = F.when(F.col("doc_id") % 7 == 0, F.concat(F.lit("<b>"), flat, F.lit("</b>"))).otherwise(flat)
    row = F.when(F.col("doc_id") % 11 == 0, F.concat(F.lit("# "), flat)).otherwise(
        F.concat_ws("\t", "source", F.col("doc_id").cast("string"), tagged)
    )
    return documents(spark, folder).select("doc_id", row.alias("row"))


def q_read_cells(spark, folder):
    rows = tab_rows(spark, folder).withColumn("c", X.cells(F.col("row")))
    text = F.when(X.is_comment(F.col("row")), F.col("row")).otherwise(X.strip_tags(F.element_at("c", -1)))
    return rows.select("doc_id", X.source_id(F.col("c")).alias("source_id"), text.alias("text"))


def q_header_detect(spark, folder):
    """Which received lines are headers, and the delimiter of each."""
    rows = table(spark, folder, "raw_lines").filter("raw_line IS NOT NULL")
    tab = F.contains("raw_line", F.lit("\t"))
    parts = F.when(tab, F.split("raw_line", "\t")).otherwise(F.split(F.trim("raw_line"), " +"))
    return rows.select("raw_id", F.coalesce(X.is_header(parts), F.lit(False)).alias("is_header"), F.when(tab, "tab").otherwise("space").alias("delim"))


def q_estimate_segments(spark, folder):
    est = X.estimate_segments(F.col("text"), LIMIT).alias("segs")
    return documents(spark, folder).select(est).groupBy("segs").agg(F.count("*").alias("n"))


#: Estimated segments at which a chunk closes.
CHUNK = 4


def q_chunk_ids(spark, folder):
    """Chunks of a document's lines: a chunk closes on the line where its running
    estimate reaches the target, then the count starts again."""
    prepare(spark)
    rows = lines(spark, folder).select("doc_id", "pos", X.estimate_segments(F.col("line"), LIMIT).alias("e"))
    return chunks.chunk_ids(rows, "doc_id", "pos", "e", CHUNK).groupBy("doc_id", "chunk_id").agg(F.count("*").alias("rows"))


def q_file_chunks(spark, folder):
    """Chunks over whole files: the lines of all documents of a source in order."""
    prepare(spark)
    rows = documents(spark, folder).select("doc_id", F.coalesce("source", F.lit("-")).alias("file"), F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    rows = rows.select("file", (F.col("doc_id") * (1 << 24) + F.col("pos")).alias("at"), X.estimate_segments(F.col("line"), LIMIT).alias("e"))
    got = chunks.chunk_ids(rows, "file", "at", "e", CHUNK)
    return got.groupBy("file").agg(F.count("*").alias("lines"), (F.max("chunk_id") + 1).alias("chunks"))


def q_resume_align(spark, folder):
    """State of every line against an earlier output: done, partial, pending. The earlier
    output is made from the same rows here, so both sides are aligned within a row."""

    def cell(line, pos):
        kept = F.when(F.col("doc_id") % 10 == 0, F.concat(F.lit("%%PS%%"), line)).when(F.col("doc_id") % 3 != 0, line).otherwise("")
        return F.when(pos % 5 != 4, kept)

    prior = F.transform(F.split("text", "\n"), cell)
    rows = documents(spark, folder).select("doc_id", F.posexplode(prior).alias("pos", "cell"))
    state = F.when(F.col("cell").startswith("%%PS%%"), "partial").when(X.is_blank(F.col("cell")), "pending").otherwise("done")
    return rows.select("doc_id", "pos", state.alias("state"))


def q_sanitize(spark, folder):
    return documents(spark, folder).select("doc_id", X.sanitize(F.col("text")).alias("t"))


def q_rebuild_rows(spark, folder):
    """Rows with the last cell replaced by its sanitised text."""
    c = X.cells(F.col("row"))
    prefix = F.transform(F.slice(c, F.lit(1), F.size(c) - 1), X.tsv_cell)
    line = F.array_join(F.concat(prefix, F.array(X.sanitize(F.element_at(c, -1)))), "\t")
    return tab_rows(spark, folder).select("doc_id", line.alias("line"))


def _characters(spark, folder):
    """Distinct characters of all transcripts; map-side aggregation keeps the shuffle
    at one row per character and partition."""
    return payloads(spark, folder).filter("source_text IS NOT NULL").select(F.explode(F.array_distinct(F.split("source_text", ""))).alias("ch")).filter("ch <> ''").distinct()


def q_script_group(spark, folder):
    c = F.col("ch")
    return _characters(spark, folder).select(
        "ch",
        K.script_group(c).alias("grp"),
        c.rlike(f"^[{K.CONNECTORS}]$").alias("connector"),
        c.rlike(r"^\p{P}$").alias("punct"),
        c.isin(":", "：").alias("colon"),
        c.rlike(r"^[\p{L}\p{M}]$").alias("letter"),
        c.rlike(r"^[\p{Lu}\p{Ll}\p{Lt}]$").alias("cased"),
        c.rlike(f"^[{K.JOINERS}]$").alias("joiner"),
        c.rlike(f"^[{K.FLAGS}]$").alias("flag"),
        c.rlike(f"[{K.NO_SPACE}{K.GROUPS['hangul']}]").alias("no_space"),
    )


def q_latin_class(spark, folder):
    c = F.col("ch")
    return _characters(spark, folder).select("ch", c.rlike(r"^\p{IsLatin}$").alias("latin"), (c.rlike(r"^\p{L}$") & ~c.rlike(r"^\p{IsLatin}$")).alias("other_letter"))


def q_newline_norm(spark, folder):
    return documents(spark, folder).select("doc_id", X.result_newlines(F.col("text")).alias("t"))


def q_strip_emoji(spark, folder):
    t = X.strip_emojis(F.col("source_text"))
    rows = payloads(spark, folder).filter("source_text IS NOT NULL")
    return rows.select("payload_id", t.alias("t"), (t != F.col("source_text")).alias("changed"))


def q_despace(spark, folder):
    t = X.despace(F.col("source_text"))
    rows = payloads(spark, folder).filter("source_text IS NOT NULL")
    return rows.select("payload_id", t.alias("t"), (t != F.col("source_text")).alias("changed"))


def q_script_boundary(spark, folder):
    return payloads(spark, folder).filter("source_text IS NOT NULL").select("payload_id", X.script_boundaries(F.col("source_text")).alias("t"))


def q_case_flags(spark, folder):
    c = F.col("text")
    return documents(spark, folder).select("doc_id", X.all_upper(c).alias("upper"), X.all_lower(c).alias("lower"), F.md5(X.lower_shouting(c)).alias("norm"))


def _pairs(spark, folder):
    return payloads(spark, folder).filter("source_text IS NOT NULL AND corrected_text IS NOT NULL")


def q_terminal_punct(spark, folder):
    s, c = F.col("source_text"), F.col("corrected_text")
    t = X.keep_terminal(c, s)
    return _pairs(spark, folder).select("payload_id", X.terminal_mark(c).alias("mark"), t.alias("t"), (t != c).alias("changed"))


def q_first_casing(spark, folder):
    touch = F.coalesce("no_touch_tokens", F.array().cast("array<string>"))
    return _pairs(spark, folder).select("payload_id", X.keep_first_casing(F.col("corrected_text"), F.col("source_text"), touch).alias("t"))


def q_word_diff_tokens(spark, folder):
    w = X.diff_words(F.col("text"))
    return documents(spark, folder).select("doc_id", F.size(w).cast("bigint").alias("n"), F.md5(F.array_join(w, " ")).alias("h"))


def q_compare_text(spark, folder):
    """Text in composed form with white space folded."""
    prepare(spark)

    def kernel(columns):
        import unicodedata

        return {"payload_id": columns["payload_id"], "nfc": [unicodedata.normalize("NFC", t) for t in columns["source_text"]]}

    rows = payloads(spark, folder).filter("source_text IS NOT NULL").select("payload_id", "source_text")
    nfc = map_columns(spread(rows), kernel, "payload_id bigint, nfc string")
    return nfc.select("payload_id", F.trim(F.regexp_replace("nfc", r"[ \t\n\r]+", " ")).alias("t"))


def q_no_space_chars(spark, folder):
    rows = payloads(spark, folder).filter("source_text IS NOT NULL")
    found = rows.select("payload_id", X.no_space_chars(F.col("source_text")).alias("c"))
    return found.filter("size(c) > 0").select("payload_id", F.size("c").cast("bigint").alias("n"), F.array_join("c", "").alias("chars"))


def q_no_space_positions(spark, folder):
    """Characters of the scripts without spaces with their offsets."""
    rows = payloads(spark, folder).filter(F.col("source_text").rlike(f"[{K.NO_SPACE}]"))
    chars = rows.select("payload_id", F.posexplode(F.split("source_text", "")).alias("pos", "ch"))
    return chars.filter(F.col("ch").rlike(f"^[{K.NO_SPACE}]$") & ~F.col("ch").rlike(r"^[\p{P}\p{S}]$"))


def q_join_rule(spark, folder):
    w = Window.partitionBy("doc_id").orderBy("pos")
    rows = lines(spark, folder).withColumn("nxt", F.lead("line").over(w)).filter("nxt IS NOT NULL")
    return rows.select("doc_id", "pos", X.needs_space(F.col("line"), F.col("nxt")).alias("needs"))


def q_edit_parts(spark, folder):
    """What safe edits ask of a text: its word characters, its other characters, whether
    it holds any, a noise annotation, and the text without outer quotes."""
    c = F.col("source_text")
    rows = payloads(spark, folder).filter("source_text IS NOT NULL")
    return rows.select(
        "payload_id",
        F.md5(F.regexp_replace(c, r"[^\p{L}\p{N}_]", "")).alias("words"),
        F.md5(F.regexp_replace(c, r"[\p{L}\p{N}_]", "")).alias("rest"),
        c.rlike(r"[\p{L}\p{N}_]").alias("any"),
        X.has_noise(c).alias("noise"),
        F.md5(X.unquote(F.concat(F.lit("“"), c, F.lit("”")))).alias("inner"),
    )


def _distinct_words(spark, folder):
    words = F.explode(F.array_distinct(X.diff_words(F.col("source_text"))))
    return spread(payloads(spark, folder).filter("source_text IS NOT NULL").select(words.alias("word")).distinct())


def q_word_kinds(spark, folder):
    """Distinct words: whether each is like a number, or a conversion by itself."""
    prepare(spark)

    def kernel(c):
        return {"word": c["word"], "number": [T.is_number_like(w) for w in c["word"]], "conversion": [T.is_conversion([w]) for w in c["word"]]}

    return map_columns(_distinct_words(spark, folder), kernel, "word string, number boolean, conversion boolean")


def q_label_signature(spark, folder):
    """Distinct labels in brackets with their signature and whether it is a sure one."""
    prepare(spark)
    label = F.explode(F.regexp_extract_all("source_text", F.lit(r"\[([^\[\]\n:]{1,24})\]:"), F.lit(1)))
    rows = payloads(spark, folder).select(label.alias("label")).distinct()

    def kernel(c):
        got = [T.signature(x.split(" ")) for x in c["label"]]
        return {"label": c["label"], "signature": ["|".join(g) for g in got], "sure": [T.strong_signature(g) for g in got]}

    return map_columns(spread(rows), kernel, "label string, signature string, sure boolean")


def q_row_count(spark, folder):
    return lines(spark, folder).agg(F.count("*").alias("rows"), F.count_if(~X.is_blank(F.col("line"))).alias("non_blank"))


def q_edit_text(spark, folder):
    """Edits of all steps written as marked text, parsed back, and their changes joined."""
    none = F.array().cast("array<array<string>>")
    steps = F.array(*[F.struct(F.lit(f).alias("step"), F.coalesce(f"{f}.edits", none).alias("edits")) for f in S.STEP_FIELDS.values()])
    rows = payloads(spark, folder).select("payload_id", F.inline(steps)).select("payload_id", "step", F.posexplode("edits").alias("pos", "e")).filter("size(e) = 2")
    mark = lambda c: F.concat(F.lit("<chg>"), c, F.lit("</chg>"))
    text = F.concat(F.lit("["), mark(F.col("e")[0]), F.lit("] -> ["), mark(F.col("e")[1]), F.lit("]"))
    both = rows.select("payload_id", "step", "pos", text.alias("text"))
    before = F.regexp_extract("text", r"(?s)^\[(.*)\] -> \[(.*)\]$", 1)
    after = F.regexp_extract("text", r"(?s)^\[(.*)\] -> \[(.*)\]$", 2)
    return both.select("payload_id", "step", "pos", before.alias("before"), after.alias("after"), X.join_changes(X.change_segments(after)).alias("joined"))


def double_marks(spark, folder):
    """(key, doc_id, pos) of every pair of marks that is not customary."""
    found = F.regexp_extract_all("line", F.lit(f"([{MARKS}])[ \\t]*([{MARKS}])"), F.lit(0))
    rows = lines(spark, folder).select("doc_id", "pos", F.explode(found).alias("key"))
    return rows.filter(~F.replace(F.replace(F.col("key"), F.lit(" "), F.lit("")), F.lit("\t"), F.lit("")).isin(*LEGIT))


def q_double_punct_extract(spark, folder):
    found = double_marks(spark, folder).groupBy("key").agg(F.count("*").alias("n"), F.min(F.struct("doc_id", "pos")).alias("at"))
    return found.select("key", "n", F.col("at.doc_id").alias("first_doc"), F.col("at.pos").alias("first_pos"))


def q_missing_verdicts(spark, folder):
    """Mined keys that have no verdict yet."""
    have = spark.createDataFrame([(k,) for k in VERDICT_KEYS], "key string")
    return double_marks(spark, folder).select("key").distinct().join(F.broadcast(have), "key", "left_anti")


def q_line_text(spark, folder):
    """Text of output lines that are JSON records or table rows."""
    rows = payloads(spark, folder).filter("corrected_text IS NOT NULL")
    line = F.when(F.col("payload_id") % 2 == 0, F.to_json(F.struct("corrected_text"))).otherwise(
        F.concat_ws("\t", "source_filename", F.translate("corrected_text", "\t\n", "  "))
    )
    text = F.when(F.col("payload_id") % 2 == 0, F.get_json_object("line", "$.corrected_text")).otherwise(F.trim(F.element_at(F.split("line", "\t"), -1)))
    return rows.select("payload_id", line.alias("line")).select("payload_id", text.alias("text"))


QUERIES = {k: v for k, v in list(globals().items()) if k.startswith("q_")}

# ---------------------------------------------------------------- SQL

_LINES = "lines AS (SELECT doc_id, unnest(range(len(l)))::INT AS pos, unnest(l) AS line FROM (SELECT doc_id, str_split(text, chr(10)) AS l FROM documents WHERE text IS NOT NULL))"
_TAB = """tab AS (SELECT doc_id, CASE WHEN doc_id % 11 = 0 THEN '# ' || f
  ELSE concat_ws(chr(9), source, doc_id::VARCHAR, CASE WHEN doc_id % 7 = 0 THEN '<b>' || f || '</b>' ELSE f END) END AS row
  FROM (SELECT doc_id, source, replace(text, chr(10), ' ') AS f FROM documents WHERE text IS NOT NULL))"""
_WS = r"[ \t\n\r]"
_NUL = r"[\x00-\x1F\x7F\x{85}\x{2028}\x{2029}]"


def s_sanitize(x: str) -> str:
    return f"coalesce(trim(regexp_replace(regexp_replace({x}, '{_NUL}', ' ', 'g'), ' {{2,}}', ' ', 'g')), '')"


def s_blank(x: str) -> str:
    return f"({x} IS NULL OR regexp_full_match({x}, '{_WS}*'))"


def s_estimate(x: str) -> str:
    return f"(CASE WHEN length({x}) <= {LIMIT} THEN 1 ELSE ceil(length({x}) / {LIMIT}.0) END)::INT"


def s_newlines(x: str) -> str:
    x = f"regexp_replace({x}, '[\\x1C-\\x1E\\x{{85}}\\x{{2028}}\\x{{2029}}]', '', 'g')"
    x = f"regexp_replace({x}, '\\r\\n|[\\r\\x0B\\x0C]', chr(10), 'g')"
    x = f"regexp_replace({x}, '[ \\t\\n]*\\n[ \\t\\n]*', ' ', 'g')"
    return f"trim(regexp_replace({x}, ' {{2,}}', ' ', 'g'))"


def s_despace(x: str) -> str:
    for cls in K.GROUPS.values():
        for _ in range(2):
            x = f"regexp_replace({x}, '([{cls}]){_WS}+([{cls}])', '\\1\\2', 'g')"
    return x


def s_needs(a: str, b: str) -> str:
    same = " OR ".join(
        f"(regexp_matches(right({a}, 1), '[{c}]') AND regexp_matches(left({b}, 1), '[{c}]'))" for n, c in K.GROUPS.items() if n != "hangul"
    )
    return (
        f"(length({a}) > 0 AND length({b}) > 0 AND NOT (regexp_matches(right({a}, 1), '{_WS}') OR regexp_matches(left({b}, 1), '{_WS}') OR {same} "
        f"OR (regexp_matches(right({a}, 1), '[\\p{{P}}\\p{{S}}]') AND regexp_matches(left({b}, 1), '[\\p{{P}}\\p{{S}}]'))))"
    )


_CHARS = "chars AS (SELECT DISTINCT unnest(str_split(source_text, '')) AS ch FROM payloads WHERE source_text IS NOT NULL)"
_GRP = "CASE " + " ".join(f"WHEN regexp_matches(ch, '^[{c}]') THEN '{n}'" for n, c in K.GROUPS.items()) + " END"
_FW = X.FIRST_WORD
_MARK_SQL = r"regexp_extract({x}, '(\p{{P}})[ \t\n\r]*$', 1)"
_PUNCT = f"found AS (SELECT doc_id, pos, unnest(regexp_extract_all(line, '([{MARKS}])[ \\t]*([{MARKS}])')) AS key FROM lines), kept AS (SELECT * FROM found WHERE replace(replace(key, ' ', ''), chr(9), '') NOT IN ({', '.join(repr(x) for x in LEGIT)}))"

SQL = {
    "q_read_cells": f"""WITH {_TAB}, c AS (SELECT doc_id, row, str_split(row, chr(9)) AS c FROM tab)
SELECT doc_id, list_filter(c[1:-2], lambda x: NOT {s_blank('x')})[-1] AS source_id,
  CASE WHEN ltrim(row)[1] = '#' THEN row ELSE regexp_replace(c[-1], '(?i)</?(?:b|strong|em|i)>', '', 'g') END AS text FROM c""",
    "q_header_detect": f"""WITH p AS (SELECT raw_id, contains(raw_line, chr(9)) AS tab,
  CASE WHEN contains(raw_line, chr(9)) THEN str_split(raw_line, chr(9)) ELSE regexp_split_to_array(trim(raw_line), ' +') END AS c FROM raw_lines WHERE raw_line IS NOT NULL)
SELECT raw_id, coalesce(CASE WHEN len(c) >= 2 THEN lower(replace(trim(c[1]), ' ', '_')) IN {X.FILE_LABELS} AND lower(replace(trim(c[-1]), ' ', '_')) IN {X.TEXT_LABELS}
  ELSE lower(replace(trim(c[-1]), ' ', '_')) IN {X.TEXT_LABELS} END, false) AS is_header, CASE WHEN tab THEN 'tab' ELSE 'space' END AS delim FROM p""",
    "q_estimate_segments": f"SELECT {s_estimate('text')} AS segs, count(*)::BIGINT AS n FROM documents WHERE text IS NOT NULL GROUP BY 1",
    "q_chunk_ids": f"""WITH RECURSIVE {_LINES}, e AS (SELECT doc_id, pos, {s_estimate('line')} AS e FROM lines),
f AS (SELECT doc_id, pos, 0 AS chunk_id, CASE WHEN e >= 4 THEN 0 ELSE e END AS run, CASE WHEN e >= 4 THEN 1 ELSE 0 END AS nxt FROM e WHERE pos = 0
  UNION ALL SELECT e.doc_id, e.pos, f.nxt, CASE WHEN f.run + e.e >= 4 THEN 0 ELSE f.run + e.e END, CASE WHEN f.run + e.e >= 4 THEN f.nxt + 1 ELSE f.nxt END
  FROM f JOIN e ON e.doc_id = f.doc_id AND e.pos = f.pos + 1)
SELECT doc_id, chunk_id, count(*)::BIGINT AS rows FROM f GROUP BY ALL""",
    "q_file_chunks": f"""WITH {_LINES}, e AS (SELECT coalesce(source, '-') AS file, list({s_estimate('line')}::BIGINT ORDER BY l.doc_id, pos) AS e FROM lines l JOIN documents d ON l.doc_id = d.doc_id GROUP BY ALL),
f AS (SELECT file, len(e) AS lines, list_reduce(list_prepend(0::BIGINT, e), lambda a, x: CASE WHEN a % 1000 + x >= {CHUNK} THEN (a // 1000 + 1) * 1000 ELSE a + x END) AS s FROM e)
SELECT file, lines::BIGINT AS lines, (s // 1000 + CASE WHEN s % 1000 > 0 THEN 1 ELSE 0 END)::INT AS chunks FROM f""",
    "q_resume_align": f"""WITH {_LINES}, prior AS (SELECT doc_id, pos, CASE WHEN doc_id % 10 = 0 THEN '%%PS%%' || line WHEN doc_id % 3 <> 0 THEN line ELSE '' END AS cell FROM lines WHERE pos % 5 <> 4)
SELECT l.doc_id, l.pos, CASE WHEN starts_with(cell, '%%PS%%') THEN 'partial' WHEN {s_blank('cell')} THEN 'pending' ELSE 'done' END AS state
FROM lines l LEFT JOIN prior p ON l.doc_id = p.doc_id AND l.pos = p.pos""",
    "q_sanitize": f"SELECT doc_id, {s_sanitize('text')} AS t FROM documents WHERE text IS NOT NULL",
    "q_rebuild_rows": f"""WITH {_TAB}, c AS (SELECT doc_id, str_split(row, chr(9)) AS c FROM tab)
SELECT doc_id, array_to_string(list_append(list_transform(c[1:-2], lambda x: translate(x, chr(9) || chr(10) || chr(13), '   ')), {s_sanitize('c[-1]')}), chr(9)) AS line FROM c""",
    "q_script_group": f"""WITH {_CHARS} SELECT ch, {_GRP} AS grp, regexp_full_match(ch, '[{K.CONNECTORS}]') AS connector, regexp_full_match(ch, '\\p{{P}}') AS punct,
  ch IN (':', '：') AS colon, regexp_full_match(ch, '[\\p{{L}}\\p{{M}}]') AS letter, regexp_full_match(ch, '[\\p{{Lu}}\\p{{Ll}}\\p{{Lt}}]') AS cased,
  regexp_full_match(ch, '[{K.JOINERS}]') AS joiner, regexp_full_match(ch, '[{K.FLAGS}]') AS flag, regexp_matches(ch, '[{K.NO_SPACE}{K.GROUPS['hangul']}]') AS no_space FROM chars WHERE ch <> ''""",
    "q_latin_class": f"WITH {_CHARS} SELECT ch, regexp_full_match(ch, '\\p{{Latin}}') AS latin, regexp_full_match(ch, '\\p{{L}}') AND NOT regexp_full_match(ch, '\\p{{Latin}}') AS other_letter FROM chars WHERE ch <> ''",
    "q_newline_norm": f"SELECT doc_id, {s_newlines('text')} AS t FROM documents WHERE text IS NOT NULL",
    "q_strip_emoji": f"""WITH s AS (SELECT payload_id, source_text, trim(regexp_replace(regexp_replace(source_text, '[{K.EMOJI}]+', '', 'g'), '{_WS}{{2,}}', ' ', 'g')) AS t FROM payloads WHERE source_text IS NOT NULL)
SELECT payload_id, t, t <> source_text AS changed FROM s""",
    "q_despace": f"WITH s AS (SELECT payload_id, source_text, {s_despace('source_text')} AS t FROM payloads WHERE source_text IS NOT NULL) SELECT payload_id, t, t <> source_text AS changed FROM s",
    "q_script_boundary": r"""SELECT payload_id, regexp_replace(regexp_replace(source_text, '([\p{Latin}\p{Nd}²³¹⁰⁴-⁹]\p{M}*)([^\P{L}\p{Latin}])', '\1 \2', 'g'),
  '([^\P{L}\p{Latin}]\p{M}*)([\p{Latin}\p{Nd}²³¹⁰⁴-⁹])', '\1 \2', 'g') AS t FROM payloads WHERE source_text IS NOT NULL""",
    "q_case_flags": f"""WITH f AS (SELECT doc_id, text, regexp_matches(text, '\\p{{Lu}}') AND NOT regexp_matches(text, '[\\p{{Ll}}\\p{{Lt}}]') AS upper, regexp_matches(text, '\\p{{Ll}}') AND NOT regexp_matches(text, '[\\p{{Lu}}\\p{{Lt}}]') AS lower FROM documents WHERE text IS NOT NULL)
SELECT doc_id, upper, lower, md5(CASE WHEN upper AND len(list_filter(regexp_split_to_array(text, '{_WS}+'), lambda w: regexp_matches(w, '[\\p{{Lu}}\\p{{Ll}}\\p{{Lt}}]'))) > 1 AND length(lower(text)) = length(text) THEN lower(text) ELSE text END) AS norm FROM f""",
    "q_terminal_punct": f"""WITH f AS (SELECT payload_id, source_text s, corrected_text c, {_MARK_SQL.format(x='corrected_text')} AS mark, {_MARK_SQL.format(x='source_text')} AS want FROM payloads WHERE source_text IS NOT NULL AND corrected_text IS NOT NULL),
g AS (SELECT *, CASE WHEN regexp_matches(s, '\\p{{P}}') AND want <> mark THEN regexp_replace(regexp_replace(c, '{_WS}+$', ''), '\\p{{P}}+$', '') || want ELSE c END AS t FROM f) SELECT payload_id, mark, t, t <> c AS changed FROM g""",
    "q_first_casing": f"""WITH f AS (SELECT payload_id, corrected_text c, coalesce(no_touch_tokens, []) AS p, regexp_extract(corrected_text, '{_FW}', 1) AS have, regexp_extract(source_text, '{_FW}', 1) AS want,
  length(regexp_extract(corrected_text, '^([^\\p{{Lu}}\\p{{Ll}}\\p{{Lt}}]*)', 1)) AS n FROM payloads WHERE source_text IS NOT NULL AND corrected_text IS NOT NULL)
SELECT payload_id, CASE WHEN have <> '' AND have <> want AND lower(have) = lower(want) AND len(list_filter(p, lambda x: lower(x) = lower(have) OR starts_with(lower(x), lower(have) || ' '))) = 0
  THEN substr(c, 1, n) || want || substr(c, n + length(have) + 1) ELSE c END AS t FROM f""",
    "q_word_diff_tokens": f"""WITH w AS (SELECT doc_id, list_filter(regexp_split_to_array(regexp_replace(lower(translate(text, 'İΣ', 'iσ')), '(://|[.:,;/])', ' \\1 ', 'g'), '{_WS}+'), lambda x: x <> '') AS w FROM documents WHERE text IS NOT NULL)
SELECT doc_id, len(w)::BIGINT AS n, md5(coalesce(array_to_string(w, ' '), '')) AS h FROM w""",
    "q_compare_text": f"SELECT payload_id, trim(regexp_replace(nfc_normalize(source_text), '{_WS}+', ' ', 'g')) AS t FROM payloads WHERE source_text IS NOT NULL",
    "q_no_space_chars": f"WITH c AS (SELECT payload_id, regexp_extract_all(source_text, '[{K.NO_SPACE}]') AS c FROM payloads WHERE source_text IS NOT NULL) SELECT payload_id, len(c)::BIGINT AS n, array_to_string(c, '') AS chars FROM c WHERE len(c) > 0",
    "q_no_space_positions": f"""WITH c AS (SELECT payload_id, unnest(range(length(source_text)))::INT AS pos, unnest(str_split(source_text, '')) AS ch FROM payloads WHERE regexp_matches(source_text, '[{K.NO_SPACE}]'))
SELECT payload_id, pos, ch FROM c WHERE regexp_full_match(ch, '[{K.NO_SPACE}]') AND NOT regexp_full_match(ch, '[\\p{{P}}\\p{{S}}]')""",
    "q_join_rule": f"WITH {_LINES}, n AS (SELECT doc_id, pos, line, lead(line) OVER (PARTITION BY doc_id ORDER BY pos) AS nxt FROM lines) SELECT doc_id, pos, {s_needs('line', 'nxt')} AS needs FROM n WHERE nxt IS NOT NULL",
    "q_edit_parts": f"""SELECT payload_id, md5(regexp_replace(source_text, '[^\\p{{L}}\\p{{N}}_]', '', 'g')) AS words, md5(regexp_replace(source_text, '[\\p{{L}}\\p{{N}}_]', '', 'g')) AS rest,
  regexp_matches(source_text, '[\\p{{L}}\\p{{N}}_]') AS any, len(list_filter([{', '.join(repr(m) for m in X.NOISE_MARKERS)}], lambda m: contains(lower(source_text), m))) > 0 AS noise, md5(source_text) AS inner FROM payloads WHERE source_text IS NOT NULL""",
    "q_word_kinds": f"""WITH w AS (SELECT DISTINCT unnest(list_filter(regexp_split_to_array(regexp_replace(lower(translate(source_text, 'İΣ', 'iσ')), '(://|[.:,;/])', ' \\1 ', 'g'), '{_WS}+'), lambda x: x <> '')) AS word FROM payloads WHERE source_text IS NOT NULL)
SELECT word, regexp_full_match(word, '\\p{{Nd}}+([.,:٫٬]\\p{{Nd}}+)*(%|[\\p{{L}}\\p{{M}}]{{1,4}})?') AS number, regexp_matches(word, '[\\p{{Nd}}²³¹⁰⁴-⁹₀-₉]') OR NOT regexp_matches(word, '\\p{{L}}') AS conversion FROM w""",
    "q_label_signature": """WITH l AS (SELECT DISTINCT unnest(regexp_extract_all(source_text, '\\[([^\\[\\]\\n:]{1,24})\\]:', 1)) AS label FROM payloads),
s AS (SELECT label, list_filter(list_transform(str_split(lower(label), ' '), lambda x: trim(x)), lambda x: x <> '') AS s FROM l)
SELECT label, coalesce(array_to_string(s, '|'), '') AS signature, coalesce(array_to_string(s, ''), '') IN ('speaker', 'spk', 'spkr') OR regexp_matches(coalesce(array_to_string(s, ''), ''), '[\\p{Nd}_-]') AS sure FROM s""",
    "q_row_count": f"WITH {_LINES} SELECT count(*)::BIGINT AS rows, count(*) FILTER (NOT {s_blank('line')})::BIGINT AS non_blank FROM lines",
    "q_edit_text": "WITH a AS (" + " UNION ALL ".join(f"SELECT payload_id, '{f}' AS step, unnest(range(len({f}.edits)))::INT AS pos, unnest({f}.edits) AS e FROM payloads" for f in S.STEP_FIELDS.values()) + """)
SELECT payload_id, step, pos, '<chg>' || e[1] || '</chg>' AS before, '<chg>' || e[2] || '</chg>' AS after, trim(e[2]) AS joined FROM a WHERE len(e) = 2""",
    "q_double_punct_extract": f"WITH {_LINES}, {_PUNCT}, m AS (SELECT key, count(*)::BIGINT AS n, min({{'d': doc_id, 'p': pos}}) AS f FROM kept GROUP BY key) SELECT key, n, f.d AS first_doc, f.p AS first_pos FROM m",
    "q_missing_verdicts": f"WITH {_LINES}, {_PUNCT} SELECT DISTINCT key FROM kept WHERE key NOT IN {VERDICT_KEYS}",
    "q_line_text": "SELECT payload_id, CASE WHEN payload_id % 2 = 0 THEN corrected_text ELSE trim(translate(corrected_text, chr(9) || chr(10), '  ')) END AS text FROM payloads WHERE corrected_text IS NOT NULL",
}
