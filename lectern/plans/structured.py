"""Queries over payloads, prompts, results, evaluations and jobs, and their SQL."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lectern.functions import prompts as P
from lectern.functions import steps as S
from lectern.functions import text as X
from lectern.plans.textual import lines, payloads, s_newlines, s_sanitize
from lectern.sources.tables import table

FIELDS = tuple(S.STEP_FIELDS.values())
TEMPLATE = "Steps {chain_steps}; locale {locale}; before {prev_context}; after {next_context}; text: {input_transcript}"
ERRORS = (
    (1, "NON_REPAIRABLE: Expecting value"),
    (2, "Long-span preservation check failed: span removed"),
    (3, "JSON parse recursion error: depth"),
    (4, "Schema error: missing key"),
)
FAILURES = (
    (1, "HTTP 429 Please retry after 12 seconds"),
    (2, "Rate limit reached, retry after 1.5 second"),
    (3, "busy"),
    (4, "request was throttled"),
)
SELECTORS = ("LEXICAL", "PUNCT, CASING, 7", "bogus", "4,1", "ALL", "0,9", "[NUMERAL]", "SPEAKER,DISFLUENCY", '["3", "PUNCT"]')
FAMILY = "alpha"
MODELS = ("alpha-x", "beta-y", "Alpha-z", "other")
LOGS = (
    (1, "start\nSchema error: missing key 'a'\nJSON parse error: bad\nend"),
    (2, "Traceback\nValueError: no value\n"),
    (3, "all fine"),
)


def _spell(rows: tuple, names: str) -> str:
    q = lambda v: str(v) if isinstance(v, int) else "'" + v.replace("'", "''") + "'"
    return "(VALUES " + ", ".join("(" + ", ".join(q(v) for v in (r if isinstance(r, tuple) else (r,))) + ")" for r in rows) + f") AS v({names})"


def payload_error() -> Column:
    """First rule that a payload breaks, or null."""
    rules = [
        (F.col("tokenization").isNull() | F.col("tokenization.tokens").isNull(), "tokenization"),
        (F.col("translation").isNull(), "translation"),
        (~F.coalesce(F.col("aggressiveness_level").isin(*S.LEVELS), F.lit(False)), "aggressiveness_level"),
        (F.col("speaker_scope").isNotNull() & ~F.col("speaker_scope").isin(*S.SCOPES), "speaker_scope"),
        (F.col("seg_start").isNotNull() & ~F.col("seg_start").isin(*S.LEVELS), "seg_start"),
        (F.col("seg_end").isNotNull() & ~F.col("seg_end").isin(*S.LEVELS), "seg_end"),
        (F.col("no_touch_tokens").isNull(), "no_touch_tokens"),
        *((F.exists(F.coalesce(f"{f}.edits", F.array().cast("array<array<string>>")), lambda e: F.size(e) != 2), f) for f in FIELDS),
    ]
    return F.coalesce(*[F.when(cond, F.lit(name)) for cond, name in rules])


def last_result() -> Column:
    """Text of the last step that has one, else the corrected text."""
    return F.coalesce(*[F.when(F.col(f"{f}.result") != "", F.col(f"{f}.result")) for f in reversed(FIELDS)], F.col("corrected_text"), F.lit(""))


def q_payload_validate(spark, folder):
    rows = payloads(spark, folder).withColumn("error", payload_error())
    active = S.active_fields("PUNCT, CASING")
    quiet = [F.when(F.size(F.coalesce(F.col(f"{f}.edits"), F.array().cast("array<array<string>>"))) > 0, F.lit(f)) for f in FIELDS if f not in active]
    return rows.select(
        "payload_id", F.col("error").isNull().alias("ok"), "error", F.array_join(F.array_compact(F.array(*quiet)), ",").alias("inactive_edits"), F.md5(last_result()).alias("text_hash")
    )


def q_payload_newlines(spark, folder):
    return payloads(spark, folder).select("payload_id", X.result_newlines(F.col("ct_punct.result")).alias("punct"), X.result_newlines(F.col("corrected_text")).alias("text"))


def q_payload_shape(spark, folder):
    """Output form of a payload: fields in order, strings sanitised, inactive steps and
    the tokenisation dropped."""
    keep = sorted(S.active_fields("PUNCT, CASING"))
    order = ["source_filename", "source_text", *[k for k in S.REQUIRED if k != "tokenization" and (k in keep or not k.startswith("ct_"))], "corrected_text"]
    clean = F.transform(F.coalesce("no_touch_tokens", F.array().cast("array<string>")), X.sanitize)
    return payloads(spark, folder).select(
        "payload_id", F.lit(",".join(order)).alias("keys"), X.sanitize(F.col("source_text")).alias("source_text"), X.sanitize(F.col("translation")).alias("translation"),
        F.array_join(clean, "|").alias("no_touch"), X.sanitize(F.col("ct_punct.result")).alias("punct"), X.sanitize(F.col("ct_casing.result")).alias("casing"),
    )


def q_safe_default(spark, folder):
    """Payloads that an output replaces by the empty payload."""
    return payloads(spark, folder).select("payload_id", payload_error().isNotNull().alias("is_default"), F.when(payload_error().isNull(), F.col("translation")).otherwise("").alias("translation"))


def q_edits_by_step(spark, folder):
    names = {f: S.STEPS[i] for i, f in S.STEP_FIELDS.items()}
    pairs = F.array(*[F.struct(F.lit(names[f]).alias("step"), F.size(F.coalesce(F.col(f"{f}.edits"), F.array().cast("array<array<string>>"))).cast("bigint").alias("n")) for f in FIELDS])
    return payloads(spark, folder).select("payload_id", F.inline(pairs))


def q_chain_resolve(spark, folder):
    rows = [(s, ",".join(S.resolve(s)), S.describe(s), ",".join(sorted(S.active_fields(s)))) for s in SELECTORS]
    return spark.createDataFrame(rows, "selector string, ids string, described string, fields string")


def q_prompts(spark, folder):
    w = Window.partitionBy("custom").orderBy("seg_no", "payload_id")
    rows = payloads(spark, folder).filter("source_text IS NOT NULL").withColumn("custom", F.regexp_extract("custom_id", r"^(idx-\d+)", 1))
    # one line was delivered under several ids; its segments stay a bounded group
    values = {
        "chain_steps": F.lit(S.describe("ALL")),
        "locale": F.coalesce("locale", F.lit("unknown")),
        "prev_context": F.right(F.lag("source_text").over(w), F.lit(50)),
        "next_context": F.left(F.lead("source_text").over(w), F.lit(50)),
        "input_transcript": F.col("source_text"),
    }
    return rows.select("payload_id", F.md5(P.fill(TEMPLATE, values)).alias("h"))


REPAIR = "Fix this: {validation_error} in {previous_output}"
AUDIT = "Compare {original_text} with {patched_text}"


def q_repair_prompts(spark, folder):
    rows = payloads(spark, folder).withColumn("error", payload_error()).filter("error IS NOT NULL")
    return rows.select("payload_id", F.md5(P.repair(REPAIR, F.col("error"), F.col("translation"), "payload")).alias("h"))


def q_eval_prompts(spark, folder):
    none = F.array().cast("array<array<string>>")
    each = [F.array_join(F.transform(F.coalesce(f"{f}.edits", none), lambda e: F.array_join(e, ">")), ";") for f in FIELDS]
    edits = F.concat_ws("|", *each)
    return payloads(spark, folder).select("payload_id", F.md5(P.evaluation(AUDIT, F.col("source_text"), F.col("corrected_text"), S.describe("ALL"), edits)).alias("h"))


def q_retry_hint(spark, folder):
    rows = spark.createDataFrame(FAILURES, "id int, message string")
    hint = F.regexp_extract(F.lower("message"), r"retry after\s+(\d+(?:\.\d+)?)\s+second", 1)
    return rows.select("id", F.when(hint != "", hint.cast("double")).alias("seconds"), F.lower("message").rlike("429|rate limit|throttl").alias("retryable"))


def q_error_kind(spark, folder):
    m = F.col("message")
    kind = F.when(m.startswith("NON_REPAIRABLE:"), "non_repairable").when(m.contains("Long-span preservation check failed:"), "long_span").when(m.startswith("JSON parse recursion error:"), "recursion").otherwise("other")
    return spark.createDataFrame(ERRORS, "id int, message string").select("id", kind.alias("kind"))


def q_model_family(spark, folder):
    return spark.createDataFrame([(m,) for m in MODELS], "model string").select("model", F.lower("model").startswith(FAMILY).alias("flag"))


def q_log_error(spark, folder):
    m = F.col("log")
    last = lambda p: F.try_element_at(F.regexp_extract_all(m, F.lit(p), F.lit(1)), F.lit(-1))
    return spark.createDataFrame(LOGS, "id int, log string").select("id", F.coalesce(last(r"(JSON parse error: [^\n]*)"), last(r"(Schema error: [^\n]*)"), last(r"(\w+Error: [^\n]*)")).alias("message"))


def partial_marker(limit: Column, parts: Column) -> Column:
    return F.concat(F.lit("%%PS%%"), F.to_json(F.struct(limit.alias("limit"), parts.alias("parts"))))


def q_partial_codec(spark, folder):
    """Segment states written as a marker and read back."""
    state = F.element_at(F.array(F.lit("ok"), F.lit("fail"), F.lit("filtered")), (F.col("payload_id") % 3 + 1).cast("int"))
    parts = F.array(F.struct(state.alias("s"), F.coalesce("translation", F.lit("")).alias("t")))
    rows = payloads(spark, folder).select("payload_id", partial_marker(F.lit(150), parts).alias("marker"))
    read = F.from_json(F.substr("marker", F.lit(7)), "limit int, parts array<struct<s:string,t:string>>")
    return rows.filter(F.col("marker").startswith("%%PS%%")).select("payload_id", read["limit"].alias("lim"), read["parts"][0]["s"].alias("s"), read["parts"][0]["t"].alias("t"))


def q_batch_results(spark, folder):
    """Bulk result records by outcome."""
    k = F.col("payload_id") % 5
    reason = F.when(k == 1, "length").when(k == 2, "content_filter").otherwise("stop")
    body = F.to_json(F.struct(F.concat(F.lit("idx-"), F.col("payload_id")).alias("custom_id"), F.struct(F.when(k == 0, 500).otherwise(200).alias("status_code"), reason.alias("finish_reason")).alias("response")))
    read = F.from_json("body", "custom_id string, response struct<status_code:int,finish_reason:string>")
    kind = F.when(read["response"]["status_code"] != 200, "failed").when(read["response"]["finish_reason"] == "length", "length").when(read["response"]["finish_reason"] == "content_filter", "filtered").otherwise("ok")
    return payloads(spark, folder).select(body.alias("body")).select(F.regexp_extract(read["custom_id"], "^idx-(.*)$", 1).cast("bigint").alias("payload_id"), kind.alias("kind"))


def q_eval_pairs(spark, folder):
    """Lines of source and answer paired by position, padded to the longer side: both
    sides are in one row, so nothing is joined."""
    both = F.arrays_zip(
        F.coalesce(F.split("source_text", "\n"), F.array().cast("array<string>")).alias("src"),
        F.coalesce(F.split("corrected_text", "\n"), F.array().cast("array<string>")).alias("out"),
    )
    rows = payloads(spark, folder).select("payload_id", F.posexplode(both).alias("pos", "p"))
    return rows.select("payload_id", "pos", F.coalesce("p.src", F.lit("")).alias("src"), F.coalesce("p.out", F.lit("")).alias("out"))


def edit_error_rate(edits: Column, invalid: Column, missing: Column) -> Column:
    chances = edits + missing
    return F.when(chances == 0, F.lit(0.0)).otherwise(F.least(F.lit(1.0), F.greatest(F.lit(0.0), (invalid + missing) / chances)))


def _fold(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, r"[ \t\n\r]+", " "))


def q_eval_score(spark, folder):
    """Scores of judged edits of all steps, those of casing taken as missing: invalid and
    missing edits, without missing ones that change nothing or that contradict an invalid
    edit."""
    none = F.array().cast("array<array<string>>")
    p = payloads(spark, folder).filter("payload_id IS NOT NULL")
    edits = F.concat(*[F.coalesce(f"{f}.edits", none) for f in FIELDS if f != "ct_casing"])
    judged = F.transform(edits, lambda e: F.struct(e[0].alias("a"), e[1].alias("b"), F.when(e[1] == "", "INVALID").when(F.col("payload_id") % 7 == 0, "STEP_MISMATCH").otherwise("VALID").alias("outcome")))
    missing = F.transform(F.coalesce("ct_casing.edits", none), lambda e: F.struct(e[0].alias("span"), e[1].alias("expected")))
    rows = p.select("payload_id", judged.alias("e"), missing.alias("m"))
    real = F.filter("m", lambda m: _fold(m["span"]) != _fold(m["expected"]))
    rows = rows.select("payload_id", "e", real.alias("m"))
    against = lambda m, e: (e["outcome"] == "INVALID") & (_fold(e["b"]) == _fold(m["expected"])) & (_fold(e["a"]) == _fold(m["span"]))
    kept = F.filter("m", lambda m: ~F.exists("e", lambda e: against(m, e)))
    cleared = F.size(F.filter("e", lambda e: F.exists("m", lambda m: against(m, e))))
    bad = F.size(F.filter("e", lambda e: e["outcome"] != "VALID")) - cleared
    out = rows.select("payload_id", F.size("e").alias("n"), bad.alias("bad"), F.size(kept).alias("gap"))
    rate = edit_error_rate(F.col("n"), F.col("bad"), F.col("gap"))
    return out.select("payload_id", ((F.col("bad") == 0) & (F.col("gap") == 0)).alias("passed"), F.round(rate, 9).alias("rate"), F.col("gap").cast("bigint").alias("missing"))


def q_eval_summary(spark, folder):
    """Pass rates per result file; partial aggregation keeps the shuffle small."""
    r = table(spark, folder, "line_results")
    files = r.groupBy("evaluator", "result_file").agg(F.count("*").alias("lines"), F.count_if("passed").alias("passed"))
    return files.select("evaluator", "result_file", "lines", "passed", (F.col("lines") - F.col("passed")).alias("failed"), F.bround(100.0 * F.col("passed") / F.col("lines"), 2).alias("rate"))


def q_eval_overall(spark, folder):
    r = table(spark, folder, "line_results").groupBy("evaluator").agg(F.count("*").alias("lines"), F.count_if("passed").alias("passed"), F.round(F.avg("edit_error_rate"), 6).alias("error_rate"))
    return r.select("evaluator", "lines", F.bround(100.0 * (1 - (F.col("lines") - F.col("passed")) / F.col("lines")), 2).alias("overall"), "error_rate")


def q_report_read(spark, folder):
    """Run errors kept as JSON maps, read back to rows: all errors of every job."""
    rows = table(spark, folder, "jobs").select("job_id", F.posexplode("errors").alias("k", "error"))
    as_json = rows.select(F.to_json(F.create_map(F.concat_ws("#", "job_id", F.col("k").cast("string")), "error")).alias("j"))
    return as_json.select(F.explode(F.from_json("j", "map<string,string>")).alias("key", "error"))


def _time(c: str) -> Column:
    return F.coalesce(F.date_format(F.timestamp_seconds(c), "yyyy-MM-dd HH:mm:ss"), F.lit("-"))


def q_jobs(spark, folder):
    c = F.col("request_counts")
    counts = F.format_string("%d/%d (%d failed)", c["completed"], c["total"], c["failed"])
    return table(spark, folder, "jobs").select("job_id", _time("created_at").alias("created"), _time("completed_at").alias("completed"), F.when(c.isNotNull(), counts).otherwise("-").alias("counts"), F.array_join(F.slice("errors", 1, 3), "; ").alias("errors"))


def q_job_groups(spark, folder):
    """Jobs by user and input file, of the states that can still be cancelled."""
    jobs = table(spark, folder, "jobs").filter(F.col("status").isin("validating", "in_progress", "finalizing", "completed", "failed"))
    return jobs.groupBy(F.coalesce("metadata.user", F.lit("-")).alias("user"), F.coalesce("metadata.input_file", F.lit("-")).alias("input_file")).agg(F.count("*").alias("n"), F.min("created_at").alias("oldest"))


def q_merge(spark, folder):
    """Segments of a line merged field by field. Redelivered segments count once."""
    rows = payloads(spark, folder).withColumn("line", F.regexp_extract("custom_id", r"^idx-(\d+)", 1)).filter("line <> ''")
    first = rows.groupBy("line", "custom_id").agg(F.min_by(F.struct("seg_no", "translation", "aggressiveness_level", "speaker_scope", "seg_start", "seg_end"), "payload_id").alias("p"))
    level = F.create_map(*[x for k, v in enumerate(S.LEVELS) for x in (F.lit(v), F.lit(k))])
    scope = F.create_map(F.lit("multi"), F.lit(2), F.lit("single"), F.lit(1), F.lit("unknown"), F.lit(0))
    got = first.groupBy("line").agg(
        F.count("*").alias("segments"),
        F.max(F.coalesce(level[F.col("p.aggressiveness_level")], F.lit(0))).alias("lv"),
        F.max(F.coalesce(scope[F.col("p.speaker_scope")], F.lit(0))).alias("sc"),
        F.min_by("p.seg_start", F.struct(F.coalesce("p.seg_no", F.lit(0)), F.col("custom_id"))).alias("seg_start"),
        F.max_by("p.seg_end", F.struct(F.coalesce("p.seg_no", F.lit(0)), F.col("custom_id"))).alias("seg_end"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(F.coalesce("p.seg_no", F.lit(0)).alias("k"), F.col("custom_id"), F.coalesce("p.translation", F.lit("")).alias("t")))), lambda x: x["t"]), "\n\n").alias("tr"),
    )
    return got.select(
        "line", "segments", F.element_at(F.array(*map(F.lit, S.LEVELS)), F.col("lv") + 1).alias("level"), F.element_at(F.array(F.lit("unknown"), F.lit("single"), F.lit("multi")), F.col("sc") + 1).alias("scope"),
        F.coalesce("seg_start", F.lit("medium")).alias("seg_start"), F.coalesce("seg_end", F.lit("medium")).alias("seg_end"), F.md5("tr").alias("translation_hash"),
    )


QUERIES = {k: v for k, v in list(globals().items()) if k.startswith("q_")}

# ---------------------------------------------------------------- SQL

_E = lambda f: f"coalesce({f}.edits, [])"
_ERROR = (
    "CASE WHEN tokenization IS NULL OR tokenization.tokens IS NULL THEN 'tokenization' WHEN translation IS NULL THEN 'translation' "
    "WHEN NOT coalesce(aggressiveness_level IN ('low','medium','high'), false) THEN 'aggressiveness_level' "
    "WHEN speaker_scope IS NOT NULL AND speaker_scope NOT IN ('single','multi','unknown') THEN 'speaker_scope' "
    "WHEN seg_start IS NOT NULL AND seg_start NOT IN ('low','medium','high') THEN 'seg_start' WHEN seg_end IS NOT NULL AND seg_end NOT IN ('low','medium','high') THEN 'seg_end' "
    "WHEN no_touch_tokens IS NULL THEN 'no_touch_tokens' "
    + " ".join(f"WHEN len(list_filter({_E(f)}, lambda e: len(e) <> 2)) > 0 THEN '{f}'" for f in FIELDS)
    + " END"
)
_ALL = reduce(lambda a, b: f"list_concat({a}, {b})", [_E(f) for f in FIELDS if f != "ct_casing"])
_EACH = "concat_ws('|', " + ", ".join(f"coalesce(array_to_string(list_transform({_E(f)}, lambda e: array_to_string(e, '>')), ';'), '')" for f in FIELDS) + ")"
_QUIET = ", ".join(f"CASE WHEN len({_E(f)}) > 0 THEN '{f}' END" for f in FIELDS if f not in S.active_fields("PUNCT, CASING"))
_LAST = "coalesce(" + ", ".join(f"nullif({f}.result, '')" for f in reversed(FIELDS)) + ", corrected_text, '')"
# written by hand, so that the check does not repeat the code
_KEYS = (
    "source_filename,source_text,translation,aggressiveness_level,speaker_scope,seg_start,seg_end,no_touch_tokens,ct_punct,ct_casing,corrected_text"
)
_FOLD = lambda x: f"trim(regexp_replace({x}, '[ \\t\\n\\r]+', ' ', 'g'))"
_PROMPT = reduce(
    lambda acc, kv: f"replace({acc}, '{{{kv[0]}}}', coalesce({kv[1]}, ''))",
    [("chain_steps", "'" + S.describe("ALL") + "'"), ("locale", "coalesce(locale, 'unknown')"), ("prev_context", "right(prv, 50)"), ("next_context", "left(nxt, 50)"), ("input_transcript", "source_text")],
    f"'{TEMPLATE}'",
)
# Expected rows written by hand: selector, ids, description, fields.
_EVERY = (
    "0,1,2,3,4,5,6,7,8,9",
    "0:SPEAKER, 1:COMBINE, 2:NO_TOUCH, 3:LEXICAL, 4:DISFLUENCY, 5:FORMAT, 6:NUMERAL, 7:PUNCT, 8:CASING, 9:REMAIN_FIX",
    "ct_casing,ct_combine,ct_disfluency,ct_format,ct_lexical,ct_numeral,ct_punct,ct_remain_fix,ct_speaker",
)
_RESOLVED = (
    ("LEXICAL", "2,3", "2:NO_TOUCH, 3:LEXICAL", "ct_lexical"),
    ("PUNCT, CASING, 7", "7,8", "7:PUNCT, 8:CASING", "ct_casing,ct_punct"),
    ("bogus", *_EVERY),
    ("4,1", "2,4,1", "2:NO_TOUCH, 4:DISFLUENCY, 1:COMBINE", "ct_combine,ct_disfluency"),
    ("ALL", *_EVERY),
    ("0,9", "0,9", "0:SPEAKER, 9:REMAIN_FIX", "ct_remain_fix,ct_speaker"),
    ("[NUMERAL]", "6", "6:NUMERAL", "ct_numeral"),
    ("SPEAKER,DISFLUENCY", "0,2,4", "0:SPEAKER, 2:NO_TOUCH, 4:DISFLUENCY", "ct_disfluency,ct_speaker"),
    ('["3", "PUNCT"]', "2,3,7", "2:NO_TOUCH, 3:LEXICAL, 7:PUNCT", "ct_lexical,ct_punct"),
)

SQL = {
    "q_payload_validate": f"SELECT payload_id, {_ERROR} IS NULL AS ok, {_ERROR} AS error, coalesce(array_to_string(list_filter([{_QUIET}], lambda x: x IS NOT NULL), ','), '') AS inactive_edits, md5({_LAST}) AS text_hash FROM payloads",
    "q_payload_newlines": f"SELECT payload_id, {s_newlines('ct_punct.result')} AS punct, {s_newlines('corrected_text')} AS text FROM payloads",
    "q_payload_shape": f"SELECT payload_id, '{_KEYS}' AS keys, {s_sanitize('source_text')} AS source_text, {s_sanitize('translation')} AS translation, coalesce(array_to_string(list_transform(no_touch_tokens, lambda x: {s_sanitize('x')}), '|'), '') AS no_touch, {s_sanitize('ct_punct.result')} AS punct, {s_sanitize('ct_casing.result')} AS casing FROM payloads",
    "q_safe_default": f"SELECT payload_id, {_ERROR} IS NOT NULL AS is_default, CASE WHEN {_ERROR} IS NULL THEN translation ELSE '' END AS translation FROM payloads",
    "q_edits_by_step": " UNION ALL ".join(f"SELECT payload_id, '{S.STEPS[i]}' AS step, len({_E(f)})::BIGINT AS n FROM payloads" for i, f in S.STEP_FIELDS.items()),
    "q_chain_resolve": f"SELECT * FROM {_spell(_RESOLVED, 'selector, ids, described, fields')}",
    "q_prompts": f"""WITH p AS (SELECT *, regexp_extract(custom_id, '^(idx-\\d+)', 1) AS custom FROM payloads WHERE source_text IS NOT NULL),
n AS (SELECT *, lag(source_text) OVER w AS prv, lead(source_text) OVER w AS nxt FROM p WINDOW w AS (PARTITION BY custom ORDER BY seg_no NULLS FIRST, payload_id)) SELECT payload_id, md5({_PROMPT}) AS h FROM n""",
    "q_repair_prompts": f"WITH e AS (SELECT payload_id, translation, {_ERROR} AS error FROM payloads) SELECT payload_id, md5(replace(replace('{REPAIR}', '{{validation_error}}', error), '{{previous_output}}', coalesce(translation, '')) || chr(10) || chr(10) || 'target_schema:' || chr(10) || 'payload') AS h FROM e WHERE error IS NOT NULL",
    "q_eval_prompts": f"SELECT payload_id, md5(replace(replace('{AUDIT}', '{{original_text}}', coalesce(source_text, '')), '{{patched_text}}', coalesce(corrected_text, '')) || chr(10) || chr(10) || 'chain_steps:' || chr(10) || '{S.describe('ALL')}' || chr(10) || chr(10) || 'extracted_edits:' || chr(10) || {_EACH}) AS h FROM payloads",
    "q_retry_hint": f"SELECT id, try_cast(nullif(regexp_extract(lower(message), 'retry after\\s+(\\d+(?:\\.\\d+)?)\\s+second', 1), '') AS DOUBLE) AS seconds, regexp_matches(lower(message), '429|rate limit|throttl') AS retryable FROM {_spell(FAILURES, 'id, message')}",
    "q_error_kind": f"SELECT id, CASE WHEN starts_with(message, 'NON_REPAIRABLE:') THEN 'non_repairable' WHEN contains(message, 'Long-span preservation check failed:') THEN 'long_span' WHEN starts_with(message, 'JSON parse recursion error:') THEN 'recursion' ELSE 'other' END AS kind FROM {_spell(ERRORS, 'id, message')}",
    "q_model_family": f"SELECT model, starts_with(lower(model), '{FAMILY}') AS flag FROM {_spell(MODELS, 'model')}",
    "q_log_error": f"SELECT id, coalesce(regexp_extract_all(log, '(JSON parse error: [^\\n]*)', 1)[-1], regexp_extract_all(log, '(Schema error: [^\\n]*)', 1)[-1], regexp_extract_all(log, '(\\w+Error: [^\\n]*)', 1)[-1]) AS message FROM {_spell(LOGS, 'id, log')}",
    "q_partial_codec": "SELECT payload_id, 150 AS lim, ['ok', 'fail', 'filtered'][(payload_id % 3 + 1)::INT] AS s, coalesce(translation, '') AS t FROM payloads",
    "q_batch_results": "SELECT payload_id, CASE payload_id % 5 WHEN 0 THEN 'failed' WHEN 1 THEN 'length' WHEN 2 THEN 'filtered' ELSE 'ok' END AS kind FROM payloads",
    "q_eval_pairs": """WITH s AS (SELECT payload_id, unnest(range(len(l)))::INT AS pos, unnest(l) AS src FROM (SELECT payload_id, str_split(source_text, chr(10)) AS l FROM payloads WHERE source_text IS NOT NULL)),
o AS (SELECT payload_id, unnest(range(len(l)))::INT AS pos, unnest(l) AS out FROM (SELECT payload_id, str_split(corrected_text, chr(10)) AS l FROM payloads WHERE corrected_text IS NOT NULL))
SELECT coalesce(s.payload_id, o.payload_id) AS payload_id, coalesce(s.pos, o.pos) AS pos, coalesce(src, '') AS src, coalesce(out, '') AS out FROM s FULL JOIN o ON s.payload_id = o.payload_id AND s.pos = o.pos""",
    "q_eval_score": f"""WITH p AS (SELECT payload_id, list_transform({_ALL}, lambda e: {{'a': e[1], 'b': e[2], 'o': CASE WHEN e[2] = '' THEN 'INVALID' WHEN payload_id % 7 = 0 THEN 'STEP_MISMATCH' ELSE 'VALID' END}}) AS e,
  list_filter(list_transform({_E('ct_casing')}, lambda e: {{'s': e[1], 'x': e[2]}}), lambda m: {_FOLD('m.s')} <> {_FOLD('m.x')}) AS m FROM payloads),
q AS (SELECT payload_id, len(e) AS n,
  len(list_filter(e, lambda e1: e1.o <> 'VALID')) - len(list_filter(e, lambda e2: len(list_filter(m, lambda m2: e2.o = 'INVALID' AND {_FOLD('e2.b')} = {_FOLD('m2.x')} AND {_FOLD('e2.a')} = {_FOLD('m2.s')})) > 0)) AS bad,
  len(list_filter(m, lambda m3: len(list_filter(e, lambda e3: e3.o = 'INVALID' AND {_FOLD('e3.b')} = {_FOLD('m3.x')} AND {_FOLD('e3.a')} = {_FOLD('m3.s')})) = 0)) AS gap FROM p)
SELECT payload_id, bad = 0 AND gap = 0 AS passed, round(CASE WHEN n + gap = 0 THEN 0.0 ELSE least(1.0, greatest(0.0, (bad + gap)::DOUBLE / (n + gap))) END, 9) AS rate, gap::BIGINT AS missing FROM q""",
    "q_eval_summary": "SELECT evaluator, result_file, count(*)::BIGINT AS lines, count(*) FILTER (passed)::BIGINT AS passed, count(*) FILTER (NOT coalesce(passed, false))::BIGINT AS failed, round_even(100.0::DOUBLE * count(*) FILTER (passed) / count(*), 2) AS rate FROM line_results GROUP BY ALL",
    "q_eval_overall": "SELECT evaluator, count(*)::BIGINT AS lines, round_even(100.0::DOUBLE * (1 - (count(*) - count(*) FILTER (passed))::DOUBLE / count(*)), 2) AS overall, round(avg(edit_error_rate), 6) AS error_rate FROM line_results GROUP BY ALL",
    "q_report_read": "SELECT job_id || '#' || k AS key, error FROM (SELECT job_id, unnest(range(len(errors))) AS k, unnest(errors) AS error FROM jobs)",
    "q_jobs": "SELECT job_id, coalesce(strftime(make_timestamp(created_at * 1000000), '%Y-%m-%d %H:%M:%S'), '-') AS created, coalesce(strftime(make_timestamp(completed_at * 1000000), '%Y-%m-%d %H:%M:%S'), '-') AS completed, CASE WHEN request_counts IS NOT NULL THEN format('{}/{} ({} failed)', request_counts.completed, request_counts.total, request_counts.failed) ELSE '-' END AS counts, array_to_string(errors[1:3], '; ') AS errors FROM jobs",
    "q_job_groups": "SELECT coalesce(metadata.user, '-') AS user, coalesce(metadata.input_file, '-') AS input_file, count(*)::BIGINT AS n, min(created_at) AS oldest FROM jobs WHERE status IN ('validating','in_progress','finalizing','completed','failed') GROUP BY ALL",
    "q_merge": """WITH r AS (SELECT *, regexp_extract(custom_id, '^idx-(\\d+)', 1) AS line FROM payloads), f AS (SELECT * FROM r WHERE line <> '' QUALIFY row_number() OVER (PARTITION BY line, custom_id ORDER BY payload_id) = 1),
g AS (SELECT line, count(*)::BIGINT AS segments, max(CASE aggressiveness_level WHEN 'high' THEN 2 WHEN 'medium' THEN 1 ELSE 0 END) AS lv, max(CASE speaker_scope WHEN 'multi' THEN 2 WHEN 'single' THEN 1 ELSE 0 END) AS sc,
  list(seg_start ORDER BY coalesce(seg_no, 0), custom_id)[1] AS a, list(seg_end ORDER BY coalesce(seg_no, 0), custom_id)[-1] AS b, string_agg(coalesce(translation, ''), chr(10) || chr(10) ORDER BY coalesce(seg_no, 0), custom_id) AS tr FROM f GROUP BY line)
SELECT line, segments, ['low','medium','high'][lv + 1] AS level, ['unknown','single','multi'][sc + 1] AS scope, coalesce(a, 'medium') AS seg_start, coalesce(b, 'medium') AS seg_end, md5(tr) AS translation_hash FROM g""",
}
