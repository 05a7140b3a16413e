"""Comparisons in parts, clients, bulk jobs, evaluation and mining."""

import http.server
import json
import threading

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lectern.functions import tokens as K
from lectern.operators import aligned, answers, bulk, clients, evaluation, guards, lookup, mining, model, pairing

QUICK = model.Policy(sleep=model.no_wait)
words = st.lists(st.sampled_from("a b c dd ee 我 你 ไป . , 12".split()), max_size=40)


@settings(max_examples=150, deadline=None)
@given(words, words, st.integers(4, 60))
def test_parts_cover_both_sides(a, b, limit):
    s, t = " ".join(a), " ".join(b)
    got = pairing.parts(s, t, limit)
    for side, text in ((0, s), (1, t)):
        assert "".join(text[slice(*p[side])] for p in got) == text
    assert pairing.parts(s, s, limit) == [((0, len(s)), (0, len(s)))]


def test_parts_are_short_and_guards_agree():
    text = " ".join(f"word{k} and so on" for k in range(400))
    other = text.replace("word50 and so on", "word50").replace("word200", "Word200,")
    got = pairing.parts(text, other)
    assert len(got) > 10 and max(b - a for (a, b), _ in got) <= 450
    assert guards.check_parts(text, text.replace("word300 and so on word301 and so", "word300"))[2] == "long_span"
    assert guards.check_parts(text, other)[0] and guards.safe_edits(text, other) == text.replace("word200", "Word200,")


def _count(whole, part):
    return sum(whole[k : k + len(part)] == part for k in range(len(whole) - len(part) + 1))


@settings(max_examples=200, deadline=None)
@given(words, words)
def test_windows_by_brute_force(a, b):
    ops = [o for o in guards.opcodes(a, b) if o[0] != "equal"]
    for _, i1, i2, j1, j2 in ops:
        left_most = right_most = 0
        while left_most < min(i1, j1) and a[i1 - left_most - 1] == b[j1 - left_most - 1]:
            left_most += 1
        while right_most < min(len(a) - i2, len(b) - j2) and a[i2 + right_most] == b[j2 + right_most]:
            right_most += 1
        want = next(
            (
                (left, total - left)
                for total in range(left_most + right_most + 1)
                for left in range(max(0, total - right_most), min(left_most, total) + 1)
                if (x := a[i1 - left : i2 + total - left]) and (y := b[j1 - left : j2 + total - left]) and _count(a, x) == 1 and _count(b, y) == 1
            ),
            (left_most, right_most),
        )
        assert aligned._window(a, b, aligned._index(a), aligned._index(b), i1, i2, j1, j2) == want


@settings(max_examples=200, deadline=None)
@given(words, st.integers(0, 40), st.integers(0, 8))
def test_stutters_by_definition(tokens, a, n):
    a, b = min(a, len(tokens)), min(a + n, len(tokens))
    span = tokens[a:b]
    want = any(
        len(span) % size == 0 and span[:size] * (len(span) // size) == span and span[:size] in (tokens[b : b + size], tokens[max(0, a - size) : a])
        for size in range(1, min(4, len(span)) + 1)
    )
    assert K.is_stutter(tokens, a, b) == want


def test_conversions():
    assert K.is_conversion(["1000"]) and K.is_conversion([":"]) and K.is_conversion(["a", "b2"]) and not K.is_conversion(["ab", "c"]) and not K.is_conversion([])


# ---------------------------------------------------------------- clients


@pytest.fixture
def service():
    """A local service: it knows no schemas, is busy once, then echoes."""
    seen = []

    class Handler(http.server.BaseHTTPRequestHandler):
        def do_POST(self):
            body = json.loads(self.rfile.read(int(self.headers["Content-Length"])))
            seen.append(body)
            if body["response_format"]["type"] == "json_schema":
                code, out, extra = 400, {"error": "json_schema is unsupported"}, {}
            elif len(seen) == 2:
                code, out, extra = 429, {"error": "slow down"}, {"Retry-After": "0.5"}
            else:
                code, out, extra = 200, {"choices": [{"message": {"content": [{"text": body["messages"][0]["content"]}]}}]}, {}
            data = json.dumps(out).encode()
            self.send_response(code)
            for k, v in {**extra, "Content-Length": str(len(data))}.items():
                self.send_header(k, v)
            self.end_headers()
            self.wfile.write(data)

        def log_message(self, *a):
            pass

    server = http.server.ThreadingHTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{server.server_port}/", seen
    server.shutdown()


def test_http_client(service):
    url, seen = service
    client = clients.HttpClient(url, "m", schema={"name": "x"})
    with pytest.raises(clients.RateLimited) as busy:
        client.complete("é")
    assert busy.value.seconds == 0.5 and client.complete("é") == "é"
    assert [b["response_format"]["type"] for b in seen] == ["json_schema", "json_object", "json_object"]
    assert model.call(clients.HttpClient("http://127.0.0.1:9/", "m"), "x", QUICK, 1) is None


class Session:
    def __init__(self, *replies):
        self.replies, self.log = replies, [{"id": 0, "type": "assistant.message", "content": "old"}]

    def send(self, prompt):
        self.log += [{"id": k + 1, **r} for k, r in enumerate(self.replies)]

    def events(self):
        return self.log


def test_session_client():
    part = lambda t: {"type": "assistant.message_delta", "delta_content": t}
    end = {"type": "assistant.turn_end"}
    ask = lambda *r, **k: clients.SessionClient(lambda: Session(*r), sleep=model.no_wait, **k).complete("x")
    assert ask(part("a"), part("b"), end) == "ab" and ask(part("a"), {"type": "assistant.message", "content": "whole"}, end) == "whole"
    with pytest.raises(clients.WrongModel):
        ask({"type": "assistant.usage", "model": "b"}, model="a")
    with pytest.raises(OSError, match="broken"):
        ask({"type": "session.error", "message": "broken"})
    with pytest.raises(TimeoutError):
        ask(part("a"), seconds=0.0)


def test_policy():
    waits = []
    policy = model.Policy(sleep=waits.append, timeout_retries=2)
    assert model.call(clients.FakeClient({0: "timeout", 1: "timeout"}), "text: a", policy, 1) and waits == [10.0, 20.0]
    assert model.corrected(clients.FakeClient({0: "model"}), "hello there", QUICK, 1)[1] == "ok"
    assert model.corrected(clients.FakeClient({0: "model", 1: "model"}), "hello there", QUICK, 1)[1] == "timeout"
    assert clients.wait_hint("x", "Retry after 2.5 seconds") == 2.5 and clients.wait_hint(None, "no") is None and clients.wait_hint("-1", "") is None


def test_concurrency_is_bounded_and_ordered():
    lock, now, most = threading.Lock(), [0], [0]

    def work(k):
        with lock:
            now[0] += 1
            most[0] = max(most[0], now[0])
        threading.Event().wait(0.005)
        with lock:
            now[0] -= 1
        return k

    assert model.each(work, range(40), 4) == list(range(40)) and 1 < most[0] <= 4


def test_bulk():
    job = bulk.FakeBulk()
    lines = [json.dumps({"custom_id": f"idx-{k}", "body": {"messages": [{"content": f"text: {k}"}]}}) for k in range(20)]
    got = {x[0]: x for x in map(bulk.read_result, bulk.run_job(job, lines, 0.0, model.no_wait))}
    assert len(got) == 20 and {x[1] for x in got.values()} == {"ok", "length", "filtered"}
    assert all(answers.respond(x[2], k)[0]["corrected_text"] == k for k, x in got.items() if x[1] == "ok")
    assert bulk.read_result("{") is None and bulk.read_result('{"custom_id":"idx-1","response":{"status_code":500}}') == ("1", "failed", None)
    tries = []

    def work():
        tries.append(1)
        if len(tries) < 3:
            raise OSError
        return "done"

    assert bulk.with_retry(work, sleep=model.no_wait) == "done" and len(tries) == 3


def test_bulk_files_hold_a_set_size(spark):
    rows = spark.range(1000).selectExpr("cast(id as string) AS key", "cast(id as string) AS record")
    sizes = [r["count"] for r in bulk.in_files(rows, size=30).groupBy("file").count().collect()]
    assert sum(sizes) == 1000 and max(sizes) <= 30 and not bulk.in_files(rows.filter("key < '0'")).count()


def test_bulk_lines(spark):
    """Lines come out whole, filtered segments as they were, failed ones in a marker; what
    an earlier run has done is kept."""
    long = "One sentence is here. " * 60
    rows = [(k, long if k % 7 == 0 else f"line {k}") for k in range(60)] + [(99, None), (100, "  ")]
    df = spark.createDataFrame(rows, "id bigint, t string")
    got = {r.id: r for r in bulk.patch_lines(df, "id", "t", bulk.FakeBulk, pause=0.0, size=20).collect()}
    assert set(got) == {*range(60), 100} and {r.state for r in got.values()} == {"done", "partial"}
    texts = dict(rows)
    assert all(r.text.split() == texts[k].split() for k, r in got.items() if r.state == "done")
    part = json.loads(next(r.text for k, r in got.items() if r.state == "partial" and k % 7 == 0).removeprefix(bulk.MARKER))
    assert part["limit"] == 300 and {p["s"] for p in part["parts"]} >= {"fail"} and "".join(p["t"] for p in part["parts"]) == long
    prior = spark.createDataFrame([(1, "kept"), (2, bulk.MARKER + "{}"), (3, " ")], "id bigint, text string")
    again = {r.id: r for r in bulk.patch_lines(df, "id", "t", bulk.FakeBulk, prior, pause=0.0).collect()}
    assert again[1].text == "kept" and again[1].state == "kept" and again[2].state != "kept" and len(again) == 61


def test_reminders():
    class Log(clients.FakeClient):
        seen: list = []

        def complete(self, prompt, temperature=0.0):
            self.seen.append(prompt)
            return super().complete(prompt, temperature)

    client = Log({0: "prose"})
    assert model.corrected(client, "hello there", model.Policy(sleep=model.no_wait, remind=True), 1)[1] == "ok"
    assert len(set(client.seen)) == 2 and all("JSON" in p and p.endswith("text: hello there") for p in client.seen)
    assert model.reminded("x", QUICK, 1) == "x"


# ---------------------------------------------------------------- evaluation


def edit(text, step="PUNCT", rule="R", note=""):
    return {"edit": text, "valid_step": step, "rule": rule, "note": note}


def miss(span, expected):
    return {"span": span, "expected_edit": expected, "step": "CASING", "reason": "why"}


def test_scores():
    good = evaluation.score({"edits": [edit("[<chg>a</chg>] -> [<chg>A</chg>]")], "missing_edits": []})
    assert good["pass"] and good["edit_error_rate"] == 0 and good["fail_reasons"] == []
    bad = evaluation.score({"edits": [edit("[<chg>a</chg> b] -> [<chg>A</chg> b]", None), edit("[x] -> [y]", rule="step_mismatch")], "missing_edits": [miss("c", "C"), miss("d", " d ")]})
    assert not bad["pass"] and bad["edit_error_rate"] == 1.0 and len(bad["missing_edits"]) == 1
    assert bad["fail_reasons"][0].startswith("INVALID: valid_step=None; edit=[<chg>a") and bad["fail_reasons"][-1] == "MISSING: step=CASING; span=c; reason=why"
    clash = evaluation.score({"edits": [edit("[<chg>a</chg> b] -> [<chg>A</chg> b]", None)], "missing_edits": [miss("a", "A")]})
    assert clash["pass"] and clash["diff_summary"][2].startswith("contradiction_resolved_overlap=1")
    for broken in (None, {}, {"edits": [1], "missing_edits": []}, {"edits": [], "missing_edits": [{}]}):
        assert evaluation.score(broken)["edit_error_rate"] == 1.0
    assert evaluation.score({"edits": [], "missing_edits": []})["pass"]


def test_edit_text():
    assert evaluation.split_edit("[a [b] c] -> [d]") == ("a [b] c", "d") and evaluation.split_edit("[a] [b]") is None and evaluation.split_edit("a -> b") is None
    assert evaluation.changed("x <chg>a</chg> y <chg> b</chg>") == "a b" and evaluation.changed("<chg>我</chg>x<chg>你</chg>") == "我你"
    assert evaluation.schema("PUNCT")["schema"]["properties"]["edits"]["items"]["properties"]["valid_step"]["enum"] == ["PUNCT", None]


def test_judging_repairs_and_fails():
    class Once:
        def __init__(self, *said):
            self.said = list(said)

        def complete(self, prompt, temperature=0.0):
            x = self.said.pop(0)
            if isinstance(x, Exception):
                raise x
            return x

    ok = '{"edits": [], "missing_edits": []}'
    assert evaluation.judge(Once("{", ok), "a", "b", QUICK, 1)["pass"]
    assert evaluation.judge(Once("", ok), "a", "b", QUICK, 1)["pass"]
    assert not evaluation.judge(Once("{", "{", "{", "{"), "a", "b", QUICK, 1)["pass"]
    assert "timed out" in evaluation.judge(Once(*[TimeoutError()] * 4), "a", "b", QUICK, 1)["fail_reasons"][0]


# ---------------------------------------------------------------- mining


def test_judge_questions():
    items = [("a.b", {"left": "some words to the left a", "mark": ".", "right": "b and to the right"})]
    assert '1. "the left a.▸b and to t"' in mining.judge_prompt("missing_space", items)
    assert '1. "left a.▸b and"' in mining.judge_prompt("missing_space", items, minimal=True)
    assert "key='a.b'" in mining.judge_prompt("double_mark", items)
    assert mining.read_verdicts("missing_space", '{"1": "yes", "2": "what"}', ["a", "b"]) == ["YES", "NO"]
    assert mining.read_verdicts("missing_space", "no json", ["a"]) == [None] == mining.read_verdicts("missing_space", "[1]", ["a"])
    assert mining.read_verdicts("double_mark", '{"1": "."}', [".,", ",."]) == [".", ",."]


def test_judge_refusals():
    class Stubborn:
        def __init__(self, error):
            self.error, self.asked = error, []

        def complete(self, prompt, temperature=0.0):
            self.asked.append(prompt)
            raise self.error

    items = [("a.b", {"left": "one two three a", "mark": ".", "right": "b"})]
    refusing = Stubborn(mining.Refused())
    assert mining.judge_batch(refusing, "missing_space", items) == ["NO"] and refusing.asked[0] != refusing.asked[1]
    assert mining.judge_batch(Stubborn(TimeoutError()), "missing_space", items) == ["UNRESOLVED"]


def test_patterns_and_application(spark, tmp_path, monkeypatch):
    rows = [(k, "Hello.World and ok.fine" if k % 2 else "Hello.World", "x") for k in range(50)] + [(99, None, "x"), (100, "", "x")]
    df = spark.createDataFrame(rows, "id bigint, line string, key string").repartition(7)
    got = {r.key: r for r in mining.patterns(df, "id", "line", "missing_space").collect()}
    assert got["hello.world"].n == 50 and [e.id for e in got["hello.world"].examples] == [0, 1, 2] and got["ok.fine"].n == 25
    assert [r.key for r in mining.ranked(mining.patterns(df, "id", "line", "missing_space")).collect()] == ["hello.world", "ok.fine"]
    verdicts = spark.createDataFrame([("hello.world", "YES"), ("ok.fine", "NO"), ("other", "YES")], "key string, verdict string")
    mining.write_verdicts(verdicts, str(tmp_path / "v"))
    done = mining.apply_joined(df, "id", "line", "missing_space", mining.load_verdicts(spark, str(tmp_path / "v"))).collect()
    assert len(done) == 50 and {r.text for r in done} == {"Hello. World and ok.fine", "Hello. World"}
    by_map = sorted(tuple(r) for r in done)
    monkeypatch.setattr(mining, "SENT_VERDICTS", 0)
    assert by_map == sorted(tuple(r) for r in mining.apply_joined(df, "id", "line", "missing_space", verdicts).collect())
    (tmp_path / "m.json").write_text('{\n"verdicts": {"a": "YES", "b": "UNRESOLVED"}}')
    assert [tuple(r) for r in mining.load_verdicts(spark, str(tmp_path / "m.json"), whole=True).collect()] == [("a", "YES")]
    judged = mining.judge(mining.patterns(df, "id", "line", "missing_space"), "missing_space", lambda: mining.SeededJudge("missing_space"), verdicts.filter("key = 'ok.fine'"))
    assert {r.key: r.verdict for r in judged.collect()}["ok.fine"] == "NO"
    assert not mining.patterns(df.filter("id < 0"), "id", "line", "missing_space").count()


def test_salted_join_equals_a_join(spark):
    left = spark.range(500).selectExpr("id", "if(id < 400, 'hot', cast(id % 7 as string)) AS key")
    right = spark.createDataFrame([("hot", 1), ("3", 2)], "key string, v int")
    for how in ("inner", "left"):
        got = lookup.checked(left, right, "key", ("id",), how).select("id", "v").collect()
        assert sorted(got) == sorted(lookup.checked(left, right, "key", ("id",), how, most=1).select("id", "v").collect())
        assert sorted(lookup.salted(left, right, "key", ("id",), how).select("id", "v").collect()) == sorted(left.join(right, "key", how).select("id", "v").collect())


# ---------------------------------------------------------------- chunks


@pytest.mark.parametrize("block", [7, 50, 10_000])
def test_chunks_by_a_plain_fold(spark, monkeypatch, block):
    """Chunks over ranges of any size equal one pass, also where a group spans ranges."""
    import random

    from lectern.operators import chunks

    monkeypatch.setattr(chunks, "BLOCK", block)
    rng = random.Random(2)
    rows = [(rng.choice(["hot", "hot", "hot", "b", None]), k, rng.choice([0, 1, 1, 2, 3, 9, None])) for k in range(300)]
    df = spark.createDataFrame(rows, "g string, k int, e int").repartition(5)
    want, state = {}, {}
    for g, k, e in rows:
        run, chunk = state.get(g, (0, 0))
        want[k] = chunk
        run += e or 0
        state[g] = (0, chunk + 1) if run >= 5 else (run, chunk)
    assert {r.k: r.chunk_id for r in chunks.chunk_ids(df, "g", "k", "e", 5).collect()} == want
    assert chunks.chunk_ids(df.limit(0), "g", "k", "e", 5).count() == 0


def test_script_boundaries(spark):
    from lectern.functions import text as X
    from pyspark.sql import functions as F

    cases = {
        "hello你好world": "hello 你好 world", "123你好": "123 你好", "abc123def": "abc123def", "abc.123": "abc.123", "abc,你好": "abc,你好",
        "ที่3km": "ที่ 3km", "éa日本1": "éa 日本 1", "мир你好": "мир你好", "": "", "é日": "é 日",
    }
    df = spark.createDataFrame(list(cases.items()), "t string, want string")
    assert [r for r in df.select("t", "want", X.script_boundaries(F.col("t")).alias("got")).collect() if r.got != r.want] == []
