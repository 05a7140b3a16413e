"""Bulk jobs: request records in files of a set size, submitted, polled and read back.

Defined results
---------------
* every file holds at most ``size`` records, whatever their number; a record's file
  depends on its id alone, so a task that runs again writes the same file;
* a job that does not end as ``completed`` gives no results: its records come back as
  ``lost`` and can be submitted again;
* broken result records and unknown ids are left out.
"""

from __future__ import annotations

import json
import time
import unicodedata
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lectern.functions import text as X
from lectern.operators import answers, segment
from lectern.operators.arrow import map_columns
from lectern.operators.clients import FakeClient, RateLimited

#: Records of a file; files that one hash bucket is divided into.
FILE_RECORDS, FILES_PER_BUCKET = 10_000, 8
ENDED = ("completed", "failed", "cancelled", "expired")


def request_record(key: Column, prompt: Column, max_tokens: int = 16384, temperature: float = 0.0) -> Column:
    """One request as JSON; its id is ``idx-`` and the key."""
    message = F.array(F.struct(F.lit("user").alias("role"), prompt.alias("content")))
    body = F.struct(F.lit(max_tokens).alias("max_tokens"), F.lit(temperature).alias("temperature"), message.alias("messages"))
    return F.to_json(F.struct(F.concat(F.lit("idx-"), key).alias("custom_id"), F.lit("POST").alias("method"), F.lit("/chat/completions").alias("url"), body.alias("body")))


def in_files(requests: DataFrame, key: str = "key", size: int = FILE_RECORDS) -> DataFrame:
    """``requests`` with a column ``file``: hash buckets of a few files each, records
    numbered within their bucket, so no task numbers all of them."""
    rows = requests.count()
    buckets = max(1, rows // (size * FILES_PER_BUCKET))
    bucketed = requests.withColumn("_bucket", F.pmod(F.xxhash64(key), F.lit(buckets)))
    place = F.row_number().over(Window.partitionBy("_bucket").orderBy(key)) - 1
    return bucketed.withColumn("file", F.concat_ws("-", "_bucket", F.floor(place / size))).drop("_bucket")


def with_retry(work: Callable, *args, tries: int = 5, sleep: Callable = time.sleep):
    """Up to ``tries`` calls, 1, 2, 4 ... seconds apart, 30 at most; the last error is raised."""
    for k in range(tries):
        try:
            return work(*args)
        except (OSError, RateLimited):
            if k == tries - 1:
                raise
            sleep(min(2**k, 30))


def run_job(client, lines: list[str], pause: float = 30.0, sleep: Callable = time.sleep) -> list[str]:
    """Result lines of one file; none unless the job completes."""
    job = with_retry(client.submit, lines, sleep=sleep)
    while (state := with_retry(client.status, job, sleep=sleep)) not in ENDED:
        sleep(pause)
    return with_retry(client.results, job, sleep=sleep) if state == "completed" else []


def read_result(line: str) -> tuple[str, str, str | None] | None:
    """(key, outcome, text) of a result record; outcomes are ok, length, filtered, failed."""
    try:
        row = json.loads(line)
        key = str(row["custom_id"]).split("idx-", 1)[-1]
        reply = row.get("response") or {}
        if reply.get("status_code", 200) != 200:
            return key, "failed", None
        choice = reply["body"]["choices"][0]
        kind = {"length": "length", "content_filter": "filtered"}.get(choice.get("finish_reason"), "ok")
        return key, kind, unicodedata.normalize("NFC", choice["message"]["content"]) if kind == "ok" else None
    except (ValueError, KeyError, IndexError, TypeError, AttributeError):
        return None


def run(requests: DataFrame, make_client: Callable, pause: float = 30.0, size: int = FILE_RECORDS) -> DataFrame:
    """(key, outcome, text) of all requests (key, record): a file is one job."""

    def work(pdf):
        import pandas as pd

        got = {x[0]: x[1:] for x in map(read_result, run_job(make_client(), list(pdf["record"]), pause)) if x}
        rows = [(k, *got.get(k, ("lost", None))) for k in pdf["key"]]
        return pd.DataFrame(rows, columns=["key", "outcome", "text"])

    files = in_files(requests.select("key", "record"), "key", size)
    return files.groupBy("file").applyInPandas(work, "key string, outcome string, text string")


MARKER = "%%PS%%"


def segment_states(segs: DataFrame, results: DataFrame) -> DataFrame:
    """(id, seg_no, state, text) of segments (id, seg_no, seg_text, key) and results (key,
    outcome, text): an answer is read, checked and guarded; filtered segments pass through
    as they are, all others that are not sound fail with their own text."""
    joined = segs.join(results, "key", "left").select("id", "seg_no", "seg_text", "outcome", "text")

    def kernel(columns: dict) -> dict:
        out = {"id": columns["id"], "seg_no": columns["seg_no"], "state": [], "text": []}
        for source, outcome, answer in zip(columns["seg_text"], columns["outcome"], columns["text"]):
            payload = answers.respond(answer, source)[0] if outcome == "ok" else None
            good = payload is not None and bool((payload.get("corrected_text") or "").strip())
            out["state"].append("ok" if good or not source.strip() else "filtered" if outcome == "filtered" else "fail")
            out["text"].append(payload["corrected_text"] if good else source)
        return out

    return map_columns(joined, kernel, "id bigint, seg_no int, state string, text string")


def patch_lines(df: DataFrame, id_col: str, text_col: str, make_client: Callable, prior: DataFrame | None = None, limit: int = 300, size: int = FILE_RECORDS, pause: float = 30.0) -> DataFrame:
    """(id, text, state) of all lines by bulk jobs. Lines that ``prior`` (id, text) has
    done are taken over and not asked again; a line with a segment that failed comes out
    as a marker of its segments' states, from which a later run goes on."""
    rows = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("line")).filter("line IS NOT NULL")
    done = None
    if prior is not None:
        done = prior.filter(~F.col("text").startswith(MARKER) & F.col("text").rlike(r"\S")).select("id", "text")
        rows = rows.join(done.select("id"), "id", "left_anti")
    segs = segment.segments(rows, "id", "line", limit)
    key = F.concat(F.col("id"), F.lit("_s"), F.col("seg_no"))
    prompt = F.concat(F.lit("before: "), "prev_context", F.lit("; after: "), "next_context", F.lit("; text: "), "seg_text")
    segs = segs.select("id", "seg_no", "seg_text", key.alias("key"), request_record(key, prompt).alias("record"))
    states = segment_states(segs.drop("record"), run(segs.select("key", "record"), make_client, pause, size))
    lines = states.groupBy("id").agg(F.array_sort(F.collect_list(F.struct("seg_no", "state", "text"))).alias("parts"))  # the segments of one line
    whole = ~F.exists("parts", lambda p: p["state"] == "fail")
    kept = F.transform("parts", lambda p: F.struct(p["state"].alias("s"), p["text"].alias("t")))
    marker = F.concat(F.lit(MARKER), F.to_json(F.struct(F.lit(limit).alias("limit"), kept.alias("parts"))))
    text = F.when(whole, X.join_parts(F.transform("parts", lambda p: p["text"]))).otherwise(marker)
    got = lines.select("id", text.alias("text"), F.when(whole, "done").otherwise("partial").alias("state"))
    return got if done is None else got.unionByName(done.withColumn("state", F.lit("kept")))


class FakeBulk:
    """Deterministic service: jobs pass through two states; of every tenth key the answer
    is cut off, of another tenth it is filtered."""

    def __init__(self):
        self.jobs: dict[int, list] = {}

    def submit(self, lines: list[str]) -> int:
        self.jobs[len(self.jobs)] = [lines, 0]
        return len(self.jobs) - 1

    def status(self, job: int) -> str:
        self.jobs[job][1] += 1
        return ("validating", "in_progress", "completed")[min(2, self.jobs[job][1] - 1)]

    def results(self, job: int) -> list[str]:
        out = []
        for line in self.jobs[job][0]:
            row = json.loads(line)
            n = sum(map(ord, row["custom_id"]))
            said = FakeClient().complete(row["body"]["messages"][0]["content"])
            choice = {"finish_reason": ("length", "content_filter")[n % 2] if n % 5 == 0 else "stop", "message": {"content": said}}
            out.append(json.dumps({"custom_id": row["custom_id"], "response": {"status_code": 200, "body": {"choices": [choice]}}}, ensure_ascii=False))
        return out
