"""Queries whose kernels SQL cannot express: sequence comparison, segmentation, model
calls, mining and streaming. Tests hold them against golden cases and properties."""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import functions as F

from lectern.functions import text as X
from lectern.functions import tokens as K
from lectern.operators import aligned, answers, bulk, evaluation, guards, mining, model, pairing, segment
from lectern.operators.arrow import map_columns
from lectern.operators.lookup import salted
from lectern.plans.textual import _LINES, _TAB, MARKS, VERDICT_KEYS, documents, lines, payloads, s_blank, s_needs, s_sanitize, tab_rows
from lectern.session import cut, prepare, spread
from lectern.sources import files
from lectern.sources.tables import table
from lectern.streaming import ingest as stream

#: Segments keep comparisons short: their cost grows faster than the text.
LIMIT = 300
#: Retries without waiting, for the deterministic clients.
QUICK = model.Policy(sleep=model.no_wait)


def payload_results(spark, folder):
    return table(spark, folder, "line_results").select("evaluator", "result_file", "line", "passed", "edit_error_rate")


def _texts(spark, folder):
    prepare(spark)
    return spread(payloads(spark, folder).select("payload_id", "source_text").filter("source_text IS NOT NULL"))


def _pairs(spark, folder):
    prepare(spark)
    rows = payloads(spark, folder).filter("source_text IS NOT NULL AND corrected_text IS NOT NULL")
    return spread(rows.select("payload_id", "source_text", "corrected_text"))


def _lines(spark, folder):
    """Lines of documents under one id: (line_id, line)."""
    prepare(spark)
    return spread(lines(spark, folder).select((F.col("doc_id") * (1 << 24) + F.col("pos")).alias("line_id"), "line"))


def q_token_stats(spark, folder):
    def kernel(c):
        got = [K.tokenize(t) for t in c["source_text"]]
        return {"payload_id": c["payload_id"], "n": [len(g) for g in got], "numbers": [sum(map(K.is_number_like, g)) for g in got], "words": [len(K.folded(g)) for g in got]}

    return map_columns(_texts(spark, folder), kernel, "payload_id bigint, n int, numbers int, words int")


def q_label_strip(spark, folder):
    def kernel(c):
        got = [K.strip_labels(K.tokenize(t)) for t in c["source_text"]]
        return {"payload_id": c["payload_id"], "labels": [len(g[1]) for g in got], "n": [len(g[0]) for g in got]}

    return map_columns(_texts(spark, folder), kernel, "payload_id bigint, labels int, n int")


def q_span_tests(spark, folder):
    """Repeated and converted spans among the words a correction removed."""

    def kernel(c):
        out = {"payload_id": c["payload_id"], "repeats": [], "stutters": [], "conversions": []}
        for s, t in zip(c["source_text"], c["corrected_text"]):
            counts = [0, 0, 0]
            for x, y in pairing.parts(s, t, LIMIT):
                a, b = K.diff_words(s[slice(*x)]), K.diff_words(t[slice(*y)])
                for change in guards.changes(a, b):
                    gone = change.i2 > change.i1
                    counts[0] += gone and K.repeats_context(a, change.i1, change.i2)
                    counts[1] += gone and K.is_stutter(a, change.i1, change.i2)
                    counts[2] += change.kind == "replace" and K.is_conversion(b[change.j1 : change.j2])
            for name, n in zip(("repeats", "stutters", "conversions"), counts):
                out[name].append(n)
        return out

    return map_columns(_pairs(spark, folder), kernel, "payload_id bigint, repeats int, stutters int, conversions int")


def _segments(spark, folder):
    prepare(spark)
    return segment.segments(spread(documents(spark, folder).select("doc_id", "text")), "doc_id", "text", LIMIT)


def q_segments(spark, folder):
    return _segments(spark, folder).select("doc_id", "seg_no", "seg_text", "start_off", "end_off")


def q_context(spark, folder):
    """Segments with the text beside them."""
    return _segments(spark, folder).select("doc_id", "seg_no", "prev_context", "next_context")


def q_segment_roundtrip(spark, folder):
    """Whether the segments of a document, in order, are the document."""
    joined = _segments(spark, folder).groupBy("doc_id").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("seg_no", "seg_text"))), lambda x: x["seg_text"]), "").alias("t")
    )
    return documents(spark, folder).select("doc_id", "text").join(joined, "doc_id").select("doc_id", (F.col("t") == F.col("text")).alias("ok"))


def q_merge_text(spark, folder):
    """Corrected text of a line's segments, joined by the boundary rule."""
    rows = payloads(spark, folder).withColumn("line", F.regexp_extract("custom_id", r"^idx-(\d+)", 1)).filter("line <> ''")
    once = rows.groupBy("line", "custom_id").agg(F.min_by(F.struct("seg_no", "corrected_text"), "payload_id").alias("p"))
    parts = F.transform(F.array_sort(F.collect_list(F.struct(F.coalesce("p.seg_no", F.lit(0)).alias("k"), F.coalesce("p.corrected_text", F.lit("")).alias("t")))), lambda x: x["t"])
    return once.groupBy("line").agg(X.join_parts(parts).alias("text"))


def q_guards(spark, folder):
    def kernel(c):
        got = [guards.check_parts(s, t, LIMIT) for s, t in zip(c["source_text"], c["corrected_text"])]
        return {"payload_id": c["payload_id"], "ok": [g[0] for g in got], "category": [g[2] for g in got], "error": [g[1] for g in got]}

    return map_columns(_pairs(spark, folder), kernel, "payload_id bigint, ok boolean, category string, error string")


def q_guards_alone(spark, folder):
    kinds = [g.category for g in guards.WORD_GUARDS + guards.CHARACTER_GUARDS]

    def kernel(c):
        got = [guards.guards_alone_parts(s, t, LIMIT) for s, t in zip(c["source_text"], c["corrected_text"])]
        return {"payload_id": c["payload_id"], **{k: [g[k] for g in got] for k in kinds}}

    return map_columns(_pairs(spark, folder), kernel, "payload_id bigint, " + ", ".join(f"{k} boolean" for k in kinds))


#: Words that no text holds, put in and taken out to probe comparisons.
STRANGE = " qvalpha qvbeta qvgamma qvdelta qvepsilon"


def q_guard_probe(spark, folder):
    """Guards on every text against itself, against itself with five strange words less,
    and with five more."""

    def kernel(c):
        out = {"payload_id": c["payload_id"], "same": [], "less": [], "more": [], "alone_less": [], "alone_more": []}
        for t in c["source_text"]:
            out["same"].append(guards.check_parts(t, t, LIMIT)[0])
            out["less"].append(guards.check_parts(t + STRANGE, t, LIMIT)[2])
            out["more"].append(guards.check_parts(t, t + STRANGE, LIMIT)[2])
            out["alone_less"].append(guards.guards_alone_parts(t + STRANGE, t, LIMIT)["long_span"])
            out["alone_more"].append(guards.guards_alone_parts(t, t + STRANGE, LIMIT)["hallucination"])
        return out

    return map_columns(_texts(spark, folder), kernel, "payload_id bigint, same boolean, less string, more string, alone_less boolean, alone_more boolean")


def q_edit_probe(spark, folder):
    """Edits between every text and itself, and itself with one strange word put behind
    and one before it; safe edits that take neither."""
    word = STRANGE.split()[0]

    def kernel(c):
        out = {"payload_id": c["payload_id"], "same": [], "behind": [], "before": [], "kept": []}
        for t in c["source_text"]:
            out["same"].append(len(aligned.edits(t, t)))
            for name, other in (("behind", f"{t} {word}"), ("before", f"{word} {t}")):
                got = aligned.edits(t, other)
                out[name].append(len(got) == 1 and f"<chg>{word}</chg>" in got[0])
            out["kept"].append(word not in guards.safe_edits(t, f"{t} {word}", LIMIT))
        return out

    return map_columns(_texts(spark, folder), kernel, "payload_id bigint, same int, behind boolean, before boolean, kept boolean")


def q_mend_probe(spark, folder):
    """Every text with one fault of each kind behind it, of which alone a verdict asks to
    be mended."""
    faults = {
        "missing_space": ("qvone.Qvtwo", "qvone.qvtwo", "YES"), "letter_digit": ("qvword42", "qvword|42", "INSERT"),
        "digit_letter": ("77 qvx", "77 qvx", "REMOVE"), "double_mark": ("qv;：", ";：", ";"),
    }

    def kernel(c):
        out = {"payload_id": c["payload_id"]}
        for kind, (fault, key, verdict) in faults.items():
            out[kind] = [hashlib.md5(mining.apply_text(f"{t}\n{fault}", kind, {key: verdict})[0].encode()).hexdigest() for t in c["source_text"]]
        return out

    return map_columns(_texts(spark, folder), kernel, "payload_id bigint, " + ", ".join(f"{k} string" for k in faults))


def q_label_probe(spark, folder):
    """Every text with a label behind it that its source writes without space: that label
    loses its space, those of the text stay as they are."""

    def kernel(c):
        got = [mining.unspace_labels(f"{t}\n[Qv 7]: b", mining.label_forms(f"{t}\n[Qv7]: a")) for t in c["source_text"]]
        return {"payload_id": c["payload_id"], "t": got}

    return map_columns(_texts(spark, folder), kernel, "payload_id bigint, t string")


def q_answer_probe(spark, folder):
    """Every text as JSON within fences, quotes, mark-up and prose, as text of a nested
    response: whether it comes back."""

    def kernel(c):
        out = {"payload_id": c["payload_id"], "back": [], "nested": []}
        for i, t in zip(c["payload_id"], c["source_text"]):
            body = json.dumps({"a": t}, ensure_ascii=i % 2 == 0)
            shape = (f"```json\n{body}\n```", f"~~~\n{body}\n~~~", f"> {body}", f"<pre><code>{body}</code></pre>", f"So: {body} Done.", f"> ```\n> {body}\n> ```")[i % 6]
            plain = answers.unfence(shape)
            out["back"].append(json.loads(answers.fix_escapes(answers.first_object(plain) or plain))["a"] == t)
            out["nested"].append(answers.text_of({"message": {"content": [{"text": t}, None, ["!"]]}}) == t + "!")
        return out

    return map_columns(_texts(spark, folder), kernel, "payload_id bigint, back boolean, nested boolean")


def q_segment_limits(spark, folder):
    """Characters and segments of every document, and whether all segments keep the limit."""
    got = _segments(spark, folder).groupBy("doc_id").agg(
        F.sum(F.length("seg_text")).alias("chars"), (F.max(F.length("seg_text")) <= LIMIT * 3 // 2).alias("fits"), (F.count("*") > 1).alias("cut"), F.max("end_off").alias("end")
    )
    return got.select("doc_id", "chars", "fits", "cut", "end")


def q_safe_edits(spark, folder):
    """Corrections reduced to punctuation and case, with the number of edits followed,
    cleaned and rejected. Pairs are cut at common words and not at line breaks, which
    both sides need not share."""

    def kernel(c):
        got = [guards.safe_report(s, t, LIMIT) for s, t in zip(c["source_text"], c["corrected_text"])]
        count = lambda kind: [sum(x[0] == kind for x in log) for _, log in got]
        return {"payload_id": c["payload_id"], "t": [g[0] for g in got], **{k: count(k) for k in ("kept", "cleaned", "rejected")}}

    return map_columns(_pairs(spark, folder), kernel, "payload_id bigint, t string, kept int, cleaned int, rejected int")


def q_aligned_edits(spark, folder):
    def kernel(c):
        got = [aligned.edits(s, t) for s, t in zip(c["source_text"], c["corrected_text"])]
        return {"payload_id": c["payload_id"], "n": [len(g) for g in got], "edits": [json.dumps(g, ensure_ascii=False) for g in got]}

    return map_columns(_pairs(spark, folder), kernel, "payload_id bigint, n int, edits string")


def _answer(i: int, source: str, corrected: str) -> str:
    """A model answer in one of the shapes that occur, by payload."""
    payload = answers.empty_payload()
    payload["ct_punct"] = {"edits": [], "result": corrected}
    if i % 7 == 3:
        payload.pop("translation")
    if i % 7 == 4:
        payload["speaker_scope"] = "crowd"
    body = json.dumps(payload, ensure_ascii=False)
    return (body, f"```json\n{body}\n```", f"Here it is: {body} Done.", body, body, "> " + body, "no answer")[i % 7]


def q_json_extract(spark, folder):
    def kernel(c):
        out = {"payload_id": [], "found": [], "keys": []}
        for i, s, t in zip(c["payload_id"], c["source_text"], c["corrected_text"]):
            body = answers.first_object(answers.unfence(_answer(i, s, t)))
            out["payload_id"].append(i)
            out["found"].append(body is not None)
            out["keys"].append(len(json.loads(answers.fix_escapes(body))) if body else 0)
        return out

    return map_columns(_pairs(spark, folder), kernel, "payload_id bigint, found boolean, keys int")


def q_response_pipeline(spark, folder):
    def kernel(c):
        got = [answers.respond(_answer(i, s, t), s) for i, s, t in zip(c["payload_id"], c["source_text"], c["corrected_text"])]
        return {"payload_id": c["payload_id"], "ok": [g[1] is None for g in got], "kind": [(g[1] or "ok").split(":")[0] for g in got]}

    return map_columns(_pairs(spark, folder), kernel, "payload_id bigint, ok boolean, kind string")


def _requests(spark, folder):
    segs = segment.segments(_texts(spark, folder), "payload_id", "source_text", LIMIT)
    key = F.concat("payload_id", F.lit("_s"), "seg_no")
    prompt = F.concat(F.lit("before: "), "prev_context", F.lit("; after: "), "next_context", F.lit("; text: "), "seg_text")
    return segs.select(key.alias("key"), bulk.request_record(key, prompt).alias("record"))


def q_bulk_requests(spark, folder):
    """Request records of a bulk job, one a segment, in files of a set size."""
    return bulk.in_files(_requests(spark, folder), size=2000)


def q_bulk_run(spark, folder):
    """All segments through a deterministic bulk service: outcomes and texts."""
    return bulk.run(_requests(spark, folder), bulk.FakeBulk, pause=0.0, size=2000).select("key", "outcome", F.md5("text").alias("h"))


def q_bulk_patch(spark, folder):
    """All texts by bulk jobs, then what is partial once more: texts and states."""
    rows = _texts(spark, folder)
    first = bulk.patch_lines(rows, "payload_id", "source_text", bulk.FakeBulk, limit=LIMIT, size=2000, pause=0.0)
    again = bulk.patch_lines(rows, "payload_id", "source_text", bulk.FakeBulk, cut(first.select("id", "text")), LIMIT, 2000, 0.0)
    return again.select(F.col("id").alias("payload_id"), F.md5("text").alias("h"), "state")


def q_patch_fake(spark, folder):
    """All texts through the deterministic client."""
    return model.patch(_texts(spark, folder), "payload_id", "source_text", model.FakeClient, QUICK, limit=LIMIT)


def _outcomes(spark, folder, faults):
    def kernel(c):
        out = {"payload_id": [], "fault": [], "outcome": [], "attempts": []}
        for i, t in zip(c["payload_id"], c["source_text"]):
            k = i % len(faults)
            _, outcome, tries = model.corrected(model.FakeClient(dict(faults[k])), t, QUICK, i)
            for n, v in zip(out, (i, k, outcome, tries)):
                out[n].append(v)
        return out

    return map_columns(_texts(spark, folder), kernel, "payload_id bigint, fault int, outcome string, attempts int")


def q_retry_states(spark, folder):
    """Outcome and attempts for every fault of the service, on every text."""
    both = lambda x: {0: x, 1: x}
    return _outcomes(spark, folder, ({}, {0: "timeout"}, both("timeout"), {0: "limit"}, {0: "broken"}, {0: "prose"}, both("empty"), {0: "model"}, both("model")))


def q_retry_short(spark, folder):
    """Outcome and attempts where the answer leaves most of the text out."""
    return _outcomes(spark, folder, ({0: "short"},))


def q_verdict_files(spark, folder):
    """Verdicts written and read back; open ones are left out."""
    path = files.scratch(spark, "verdicts")
    verdict = F.element_at(F.array(F.lit("YES"), F.lit("NO"), F.lit("UNRESOLVED")), (F.col("payload_id") % 3 + 1).cast("int"))
    mining.write_verdicts(payloads(spark, folder).select(F.concat(F.lit('k"'), "payload_id").alias("key"), verdict.alias("verdict")), path)
    return mining.load_verdicts(spark, path)


def q_double_punct_apply(spark, folder):
    """Pairs of marks replaced by their first mark, for the keys with a verdict."""
    verdicts = spark.createDataFrame([(k, k[0]) for k in VERDICT_KEYS], "key string, verdict string")
    return mining.apply_joined(_lines(spark, folder), "line_id", "line", "double_mark", verdicts).select("line_id", "fixes")


def _extract(spark, folder, kind):
    """Keys by falling count with their first three examples."""
    found = mining.ranked(mining.patterns(_lines(spark, folder), "line_id", "line", kind))
    first = F.col("examples")[0]
    shown = F.array_join(F.transform("examples", lambda e: F.concat(e["left"], F.lit("▸"), e["mark"], F.lit("◂"), e["right"])), "\n")
    return found.select("key", "n", first["id"].alias("first_line"), first["pos"].alias("first_pos"), shown.alias("examples"))


def _apply(spark, folder, kind):
    """Keys seen twice or more count as judged positive."""
    rows = _lines(spark, folder)
    good = mining.patterns(rows, "line_id", "line", kind).filter("n >= 2")
    return mining.apply_joined(rows, "line_id", "line", kind, good.select("key", F.lit(mining.KINDS[kind].yes).alias("verdict"))).select("line_id", "fixes")


def q_missing_space_extract(spark, folder):
    return _extract(spark, folder, "missing_space")


def q_missing_space_apply(spark, folder):
    return _apply(spark, folder, "missing_space")


def q_letter_digit_extract(spark, folder):
    return _extract(spark, folder, "letter_digit")


def q_letter_digit_apply(spark, folder):
    return _apply(spark, folder, "letter_digit")


def _key_counts(spark, folder, kind):
    return mining.patterns(_lines(spark, folder), "line_id", "line", kind).select("key", "n")


def q_digit_letter_counts(spark, folder):
    """Occurrences of every key."""
    return _key_counts(spark, folder, "digit_letter")


def q_digit_letter_extract(spark, folder):
    return _extract(spark, folder, "digit_letter")


def q_digit_letter_apply(spark, folder):
    return _apply(spark, folder, "digit_letter")


def _judged(spark, folder, kind, known=None):
    found = mining.patterns(_lines(spark, folder), "line_id", "line", kind)
    return mining.judge(found, kind, lambda: mining.SeededJudge(kind), known)


def q_judge_fake(spark, folder):
    """Mined keys of every kind put to a deterministic client in questions of fifty."""
    out = None
    for kind in mining.KINDS:
        mine = _judged(spark, folder, kind).select(F.lit(kind).alias("kind"), "key", "verdict")
        out = mine if out is None else out.unionByName(mine)
    return out


def q_judge_resume(spark, folder):
    """Verdicts written, read back and completed: none that is known is asked again."""
    path = files.scratch(spark, "verdicts")
    mining.write_verdicts(_judged(spark, folder, "missing_space"), path)
    known = mining.load_verdicts(spark, path).filter(F.pmod(F.xxhash64("key"), F.lit(2)) == 0).withColumn("verdict", F.lit("KNOWN"))
    done = _judged(spark, folder, "missing_space", cut(known))
    return done.groupBy((F.col("verdict") == "KNOWN").alias("known")).agg(F.count("*").alias("n"))


def q_verdict_apply(spark, folder):
    """Lines mended by the verdicts of the deterministic client."""
    verdicts = cut(_judged(spark, folder, "missing_space"))
    return mining.apply_joined(_lines(spark, folder), "line_id", "line", "missing_space", verdicts).select("line_id", F.md5("text").alias("h"), "fixes")


def q_speaker_fix(spark, folder):
    """Labels of corrected texts in the form the sources use: the last form seen in the
    corpus counts. A label that no source has loses its space, a text without labels
    stays."""
    rows = _pairs(spark, folder)

    def forms(c):
        found = [(i, k, v) for i, s in zip(c["payload_id"], c["text"]) for k, v in mining.label_forms(s).items()]
        return dict(zip(("payload_id", "label", "form"), map(list, zip(*found)))) if found else {"payload_id": [], "label": [], "form": []}

    schema = "payload_id bigint, label string, form string"
    corpus = map_columns(rows.select("payload_id", F.col("source_text").alias("text")), forms, schema)
    corpus = corpus.groupBy("label").agg(F.max_by("form", "payload_id").alias("form"))
    own = map_columns(rows.select("payload_id", F.col("corrected_text").alias("text")), forms, schema).select("payload_id", "label")
    mine = salted(own, corpus, "label", ("payload_id",)).groupBy("payload_id").agg(F.map_from_entries(F.collect_list(F.struct("label", "form"))).alias("forms"))
    # only texts with a label are shuffled; the others stay as they are
    labelled = F.col("corrected_text").rlike(r"\[[^\[\]\n]*\w ?\d")
    with_label = rows.filter(labelled).select("payload_id", "corrected_text").join(mine, "payload_id", "left")

    def fix(c):
        got = [mining.unspace_labels(t, dict(f or {})) for t, f in zip(c["corrected_text"], c["forms"])]
        return {"payload_id": c["payload_id"], "t": got, "changed": [a != b for a, b in zip(got, c["corrected_text"])]}

    fixed = map_columns(with_label, fix, "payload_id bigint, t string, changed boolean")
    return fixed.unionByName(rows.filter(~labelled).select("payload_id", F.col("corrected_text").alias("t"), F.lit(False).alias("changed")))


def q_eval_fake(spark, folder):
    """Pairs judged by a deterministic evaluator: prompt, answer, repair and score."""
    got = evaluation.judged(_pairs(spark, folder), "payload_id", "source_text", "corrected_text", evaluation.SeededEvaluator, QUICK)
    return got.select("payload_id", "passed", "rate", F.array_join("summary", "; ").alias("summary"), F.size("reasons").alias("reasons"))


class _Strict:
    """Evaluator that finds every edit with one strange word invalid and all others valid."""

    def complete(self, prompt, temperature=0.0):
        edits = json.loads(prompt.rsplit("extracted_edits:\n", 1)[1])
        return json.dumps({"edits": [{"edit": e, "valid_step": None if "qvbeta" in e else "PUNCT", "rule": "R", "note": ""} for e in edits], "missing_edits": []})


def q_eval_probe(spark, folder):
    """Every text against itself with a word put behind it, judged by a known rule."""
    odd = F.col("payload_id") % 2 == 1
    rows = _texts(spark, folder).withColumn("t", F.concat("source_text", F.when(odd, " qvbeta").otherwise(" qvalpha")))
    got = evaluation.judged(rows, "payload_id", "source_text", "t", _Strict, QUICK)
    return got.select("payload_id", "passed", "rate", F.size("reasons").alias("reasons"), F.element_at("summary", 1).alias("summary"))


def q_eval_outputs(spark, folder):
    """Score and summary files written for the recorded results and read back."""
    path = files.scratch(spark, "eval")
    evaluation.write_outputs(payload_results(spark, folder), path)
    per_file = spark.read.option("header", True).schema("evaluator string, result_file string, line_count bigint, passed_lines bigint, failed_lines bigint, pass_rate_percent double").csv(f"{path}/scores")
    return per_file.join(spark.read.option("header", True).schema("evaluator string, runs bigint, average double, overall double").csv(f"{path}/summary"), "evaluator")


def q_decode(spark, folder):
    """Texts written in several encodings and read back by trial."""
    prepare(spark)
    rows = documents(spark, folder).select("doc_id", "text")

    def kernel(c):
        names = ("utf-8", "utf-8-sig", "cp1250", "cp1252", "latin-1")
        out = {"doc_id": c["doc_id"], "encoding": [], "same": []}
        for i, t in zip(c["doc_id"], c["text"]):
            try:
                data = t.encode(names[i % 5])
            except UnicodeEncodeError:
                data = t.encode("utf-8")
            text, name = files.decode(data)
            out["encoding"].append(name)
            out["same"].append(text == t)
        return out

    return map_columns(spread(rows), kernel, "doc_id bigint, encoding string, same boolean")


def q_read_table(spark, folder):
    """Table rows written to files and read back with the encoding, delimiter and header
    of their file."""
    prepare(spark)
    path = files.scratch(spark, "table")
    tab_rows(spark, folder).select("row").write.text(path)
    got = files.read_table(spark, path).filter("NOT is_header")
    return got.select(F.element_at("cells", 1).alias("first"), "source_id", F.md5("text").alias("h"), "is_comment", "delimiter")


def q_segment_rows(spark, folder):
    """Rows with long texts in several, and the line map that puts them together."""
    prepare(spark)
    return files.segment_rows(spread(tab_rows(spark, folder)), "doc_id", "row", LIMIT).select("doc_id", "seg", "total", F.md5("row").alias("h"))


def q_segment_rows_back(spark, folder):
    """Whether the segments of a row, in the order of the line map, hold its text."""
    prepare(spark)
    rows = files.segment_rows(spread(tab_rows(spark, folder)), "doc_id", "row", LIMIT)
    text = F.element_at(F.split("row", "\t"), -1)
    whole = rows.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("seg", text.alias("t")))).alias("s"), F.max("total").alias("total"))
    back = whole.select("doc_id", F.array_join(F.transform("s", lambda x: x["t"]), "").alias("t"), (F.size("s") == F.col("total")).alias("all"))
    trim = lambda c: F.regexp_replace(c, r"^\s+|\s+$", "")
    return back.join(tab_rows(spark, folder), "doc_id").select("doc_id", (F.col("all") & (trim(F.col("t")) == trim(text))).alias("ok"))


def q_snapshot(spark, folder):
    """Chunks of lines written, some written again with their results: lines and done
    lines of every chunk."""
    path = files.scratch(spark, "snapshot")
    rows = lines(spark, folder).withColumn("chunk", (F.col("doc_id") % 7).cast("int"))
    state = F.when(F.col("pos") % 3 == 0, "failed").otherwise("done")
    out = lambda s: files.output_line(F.col("line"), s, F.col("line"), F.lit(None).cast("string"))
    files.write_snapshot(rows.select("chunk", "doc_id", "pos", out(state).alias("line")), path, "chunk")
    files.write_snapshot(rows.filter("chunk < 3").select("chunk", "doc_id", "pos", out(F.lit("done")).alias("line")), path, "chunk")
    return spark.read.parquet(path).groupBy("chunk").agg(F.count("*").alias("n"), F.count_if(F.col("line") != "").alias("filled"))


def q_payload_files(spark, folder):
    """Payload records written as JSON lines and read back."""
    path = files.scratch(spark, "payloads")
    files.write_records(payloads(spark, folder).select("payload_id", "source_text", "corrected_text", "ct_punct"), path, "overwrite")
    back = files.read_payloads(spark, path, "payload_id bigint, source_text string, corrected_text string, ct_punct struct<edits:array<array<string>>,result:string>")
    return back.select("payload_id", F.md5("source_text").alias("s"), F.md5("corrected_text").alias("c"), F.size(F.coalesce("ct_punct.edits", F.array().cast("array<array<string>>"))).cast("bigint").alias("edits"))


def q_write_roundtrip(spark, folder):
    """Rows written as lines and as records in the shared folder and read back."""
    prepare(spark)
    rows = documents(spark, folder).select("doc_id", X.sanitize(F.col("text")).alias("text"))
    path = files.scratch(spark, "lines")
    files.write_lines(rows.select("doc_id", F.concat_ws("\t", F.col("doc_id").cast("string"), "text").alias("line")), path, "line", "doc_id")
    back = files.read_table(spark, path).select(F.element_at("cells", 1).cast("bigint").alias("doc_id"), F.element_at("cells", -1).alias("line"))
    records = files.scratch(spark, "records")
    files.write_records(rows, records, "overwrite")
    again = spark.read.schema("doc_id bigint, text string").json(records)
    both = rows.join(back, "doc_id").join(again.withColumnRenamed("text", "again"), "doc_id")
    return both.agg(F.count("*").alias("rows"), F.count_if(X.sanitize(F.col("line")) == F.col("text")).alias("lines_equal"), F.count_if(F.col("again") == F.col("text")).alias("records_equal"))


def q_stream_ingest(spark, folder):
    """Lines through micro-batches with a checkpoint: all arrive, in several batches."""
    source, target, check = (files.scratch(spark, n) for n in ("source", "target", "check"))
    lines(spark, folder).repartition(6, "doc_id").write.parquet(source)
    stream.ingest(spark, source, spark.read.parquet(source).schema, target, check, lambda b: b.withColumn("line", X.sanitize(F.col("line"))))
    got = spark.read.parquet(target)
    return got.agg(F.count("*").alias("rows"), (F.count_distinct("batch_id") > 1).alias("several"), F.sum(F.length("line")).alias("characters"))


QUERIES = {k: v for k, v in list(globals().items()) if k.startswith("q_")}
SQL: dict[str, str] = {
    "q_read_table": f"""WITH {_TAB}, c AS (SELECT row, CASE WHEN contains(row, chr(9)) THEN str_split(row, chr(9)) ELSE [row] END AS c FROM tab)
SELECT c[1] AS first, list_filter(c[1:-2], lambda x: NOT {s_blank('x')})[-1] AS source_id, md5(trim(regexp_replace(c[-1], '(?i)</?(?:b|strong|em|i)>', '', 'g'))) AS h, ltrim(row)[1] = '#' AS is_comment, chr(9) AS delimiter FROM c""",
    "q_guard_probe": """SELECT payload_id, true AS same, 'long_span' AS less, CASE WHEN regexp_matches(source_text, '[^\\s\\p{Z}\\p{P}]') THEN 'hallucination' END AS more, false AS alone_less, false AS alone_more FROM payloads WHERE source_text IS NOT NULL""",
    "q_eval_probe": """SELECT payload_id, payload_id % 2 = 0 AS passed, (payload_id % 2)::DOUBLE AS rate, (payload_id % 2)::INT AS reasons,
  CASE payload_id % 2 WHEN 1 THEN 'edit_error_rate=100.00%; invalid=1; missing=0; opportunities=1' ELSE 'edit_error_rate=0.00%; invalid=0; missing=0; opportunities=1' END AS summary FROM payloads WHERE source_text IS NOT NULL""",
    "q_patch_fake": r"""WITH p AS (SELECT payload_id, source_text, regexp_full_match(source_text, '[\s\x{A0}\x{3000}\x{2000}-\x{200A}]*') AS blank FROM payloads WHERE source_text IS NOT NULL)
SELECT payload_id, CASE WHEN blank THEN '' ELSE source_text END AS text, CASE WHEN blank THEN 'blank' WHEN regexp_matches(source_text, '^\s*#') THEN 'comment' ELSE 'ok' END AS state FROM p""",
    "q_merge_text": f"""WITH r AS (SELECT *, regexp_extract(custom_id, '^idx-(\\d+)', 1) AS line FROM payloads), f AS (SELECT * FROM r WHERE line <> '' QUALIFY row_number() OVER (PARTITION BY line, custom_id ORDER BY payload_id) = 1),
g AS (SELECT line, list(coalesce(corrected_text, '') ORDER BY coalesce(seg_no, 0), coalesce(corrected_text, '')) AS l FROM f GROUP BY line)
SELECT line, list_reduce(list_prepend('', l), lambda a, p: CASE WHEN p = '' THEN a WHEN a = '' THEN p WHEN {s_needs('a', 'p')} THEN a || ' ' || p ELSE a || p END) AS text FROM g""",
    "q_mend_probe": """SELECT payload_id, md5(source_text || chr(10) || 'qvone. Qvtwo') AS missing_space, md5(source_text || chr(10) || 'qvword 42') AS letter_digit,
  md5(source_text || chr(10) || '77qvx') AS digit_letter, md5(source_text || chr(10) || 'qv;') AS double_mark FROM payloads WHERE source_text IS NOT NULL""",
    "q_label_probe": "SELECT payload_id, source_text || chr(10) || '[Qv7]: b' AS t FROM payloads WHERE source_text IS NOT NULL",
    "q_answer_probe": "SELECT payload_id, true AS back, true AS nested FROM payloads WHERE source_text IS NOT NULL",
    "q_edit_probe": "SELECT payload_id, 0 AS same, true AS behind, true AS before, true AS kept FROM payloads WHERE source_text IS NOT NULL",
    "q_segment_limits": f"SELECT doc_id, length(text)::BIGINT AS chars, true AS fits, length(text) > {LIMIT * 3 // 2} AS cut, length(text)::INT AS end FROM documents WHERE text IS NOT NULL",
    "q_retry_states": """WITH p AS (SELECT payload_id, (payload_id % 9)::INT AS fault, regexp_full_match(source_text, '[\\s\\x{A0}\\x{3000}\\x{2000}-\\x{200A}]*') AS blank FROM payloads WHERE source_text IS NOT NULL)
SELECT payload_id, fault, CASE WHEN fault IN (2, 8) THEN 'timeout' WHEN fault = 6 THEN 'invalid' WHEN blank THEN 'empty' ELSE 'ok' END AS outcome,
  (CASE WHEN fault IN (2, 8) THEN 1 WHEN fault = 6 THEN 2 WHEN fault = 4 THEN CASE WHEN blank THEN 3 ELSE 2 END WHEN fault = 5 THEN 2 WHEN blank THEN 2 ELSE 1 END)::INT AS attempts FROM p""",
    "q_json_extract": "SELECT payload_id, payload_id % 7 <> 6 AS found, CASE payload_id % 7 WHEN 6 THEN 0 WHEN 3 THEN 15 ELSE 16 END::INT AS keys FROM payloads WHERE source_text IS NOT NULL AND corrected_text IS NOT NULL",
    "q_verdict_files": "SELECT 'k\"' || payload_id AS key, CASE payload_id % 3 WHEN 0 THEN 'YES' ELSE 'NO' END AS verdict FROM payloads WHERE payload_id % 3 <> 2",
    "q_double_punct_apply": f"""WITH {_LINES}, k AS (SELECT doc_id * 16777216 + pos AS line_id, len(list_filter(regexp_extract_all(line, '([{MARKS}])[ \\t]*([{MARKS}])'), lambda x: x IN {VERDICT_KEYS}))::INT AS fixes FROM lines) SELECT line_id, fixes FROM k WHERE fixes > 0""",
    "q_stream_ingest": f"WITH {_LINES} SELECT count(*)::BIGINT AS rows, true AS several, sum(length({s_sanitize('line')}))::BIGINT AS characters FROM lines",
    "q_eval_outputs": """WITH f AS (SELECT evaluator, result_file, count(*)::BIGINT AS line_count, count(*) FILTER (passed)::BIGINT AS passed_lines, count(*) FILTER (NOT coalesce(passed, false))::BIGINT AS failed_lines, round_even(100.0::DOUBLE * count(*) FILTER (passed) / count(*), 2) AS pass_rate_percent FROM line_results GROUP BY ALL),
s AS (SELECT evaluator, count(*)::BIGINT AS runs, round_even(avg(pass_rate_percent), 2) AS average, round_even(100.0::DOUBLE * (1 - sum(failed_lines)::DOUBLE / sum(line_count)), 2) AS overall FROM f GROUP BY evaluator)
SELECT evaluator, result_file, line_count, passed_lines, failed_lines, pass_rate_percent, runs, average, overall FROM f JOIN s USING (evaluator)""",
    # labels become one sign, then every single space between two pieces is looked at
    "q_digit_letter_counts": f"""WITH {_LINES}, p AS (SELECT doc_id, pos, str_split(regexp_replace(line, '(?i)\\[[^\\]\\n]*\\]\\s*:|\\[\\s*(?:speaker|spk|spkr|s|sp|спикер)[^\\]\\n]*\\]|\\b(?:speaker|spk|spkr|s|sp|спикер) ?\\d+\\s*:', '§', 'g'), ' ') AS p FROM lines),
g AS (SELECT unnest(p[:-2]) AS a, unnest(p[2:]) AS b FROM p WHERE len(p) > 1)
SELECT replace(lower(regexp_extract(a, '([^\\s\\p{{P}}\\p{{S}}\\p{{Z}}]{{0,20}})$', 1) || ' ' || regexp_extract(b, '^[^\\s\\p{{P}}\\p{{S}}\\p{{Z}}]{{0,20}}')), 'ß', 'ss') AS key, count(*)::BIGINT AS n
FROM g WHERE (regexp_matches(a, '\\p{{Nd}}$') AND regexp_matches(b, '^\\p{{Latin}}')) OR (regexp_matches(a, '\\p{{Latin}}$') AND regexp_matches(b, '^\\p{{Nd}}')) GROUP BY 1""",
    "q_segment_rows_back": "SELECT doc_id, true AS ok FROM documents WHERE text IS NOT NULL",
    "q_snapshot": r"""WITH l AS (SELECT doc_id, (doc_id % 7)::INT AS chunk, unnest(range(len(l))) AS pos, unnest(l) AS line FROM (SELECT doc_id, str_split(text, chr(10)) AS l FROM documents WHERE text IS NOT NULL))
SELECT chunk, count(*)::BIGINT AS n, count(*) FILTER (ltrim(line)[1] = '#' OR ((chunk < 3 OR pos % 3 <> 0) AND trim(regexp_replace(line, '[\x00-\x1F\x7F\x{85}\x{2028}\x{2029}]', ' ', 'g')) <> ''))::BIGINT AS filled FROM l GROUP BY chunk""",
    "q_payload_files": "SELECT payload_id, md5(source_text) AS s, md5(corrected_text) AS c, coalesce(len(ct_punct.edits), 0)::BIGINT AS edits FROM payloads",
    "q_segment_roundtrip": "SELECT doc_id, true AS ok FROM documents WHERE text IS NOT NULL",
    "q_write_roundtrip": "SELECT count(*)::BIGINT AS rows, count(*)::BIGINT AS lines_equal, count(*)::BIGINT AS records_equal FROM documents WHERE text IS NOT NULL",
}
