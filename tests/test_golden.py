"""Golden cases of the kernels."""

import json

import pytest

from lectern.functions import steps as S
from lectern.functions import tokens as K
from lectern.operators import aligned, answers, guards, mining, model, segment
from lectern.sources import files

QUICK = model.Policy(sleep=model.no_wait)


@pytest.mark.parametrize(
    "source, corrected, ok, kind",
    [
        ("one two three four five six seven", "one seven", False, "long_span"),
        ("one two three four five", "one five", True, None),
        ("alpha omega", "alpha beta gamma delta kappa omega", False, "hallucination"),
        ("今天天气好啊", "今天啊", False, "long_span_ns"),
        ("今天天气很好啊", "今天啊", False, "long_span"),
        ("二零二零年", "2020年", True, None),
        ("", "", True, None),
        ("abc " * 36 + "我家买了两千三百多个苹果", "abc " * 36 + "我家买了2300个苹果", True, None),
        ("我家买了两千三百多个苹果", "我家买了2300个苹果", True, None),
        ("abc", "abc今天天气很好", False, "hallucination_ns"),
        ("abc", "abc 的的的的的", False, "hallucination"),
    ],
)
def test_guards(source, corrected, ok, kind):
    got = guards.check(source, corrected)
    assert (got[0], got[2]) == (ok, kind)


def test_guard_passes_itself():
    for t in ("hello there", "今天天气好啊", "[SPK 1]: hi 12", "สวัสดี ครับ"):
        assert guards.check(t, t)[0]


def test_opcodes_replay():
    a, b = "the cat sat on the mat", "a cat sits on the mats"
    assert "".join(b[j1:j2] if t != "equal" else a[i1:i2] for t, i1, i2, j1, j2 in guards.opcodes(a, b)) == b


def test_safe_edits():
    assert guards.safe_edits("hello world", "Hello, world.") == "Hello, world."
    assert guards.safe_edits("good cat", "good dog") == "good cat"
    assert guards.safe_edits("[noise] hello", "hello") == "hello"
    assert guards.safe_edits("U.S.A. won", "usa won") == "usa won" and guards.undot("the N. A. S. A. plan", "the plan") == "the N.A.S.A. plan"
    assert guards.undot("A.B.C.D.", "ab, cd") == "AB CD" and guards.undot("A.B.C.D.", "abc d") == "A.B.C.D."
    assert guards.safe_edits("costs $a+b now", "costs xyz now").startswith("costs ab") and guards.unquote("“a”") == "a" and guards.unquote("„a”") == "a"
    assert [x[0] for x in guards.safe_report("good cat", "Good dog")[1]] == ["kept", "rejected"]


def test_aligned():
    assert aligned.as_json("a b", "a c") == '["[<chg>b</chg>] -> [<chg>c</chg>]"]'
    assert aligned.as_json("well yes", "yes") == '["[<chg>well</chg> yes] -> [yes]"]'
    assert aligned.edits("same", "same") == []


def test_tokens():
    assert K.diff_words("http://www.foo") == ["http", "://", "www", ".", "foo"]
    assert K.repeats_context(["ez", "egy"] * 4 + ["lét"], 0, 6)
    assert K.is_number_like("3.5kg") and not K.is_number_like("3abcdef")
    assert K.strip_labels(K.tokenize("[SPK 1]: hi"))[0] == ["hi"]


@pytest.mark.parametrize(
    "text, labels, left",
    [
        ("[SPK 1]: hi", {("spk1",)}, ["hi"]), ("speaker 2: hi there", {("speaker2",)}, ["hi", "there"]), ("LWX: hi LWX: yes", {("lwx",)}, ["hi", "yes"]),
        ("LWX: hi", set(), ["LWX", ":", "hi"]), ("王小明: 你好 ok 李四: 好", {("王小明",), ("李四",)}, ["你", "好", "ok", "好"]), ("José: a Zoë: b", {("josé",), ("zoë",)}, ["a", "b"]),
        ("note: this", set(), ["note", ":", "this"]), ("[one two]: x", set(), ["[", "one", "two", "]", ":", "x"]), ("", set(), []),
    ],
)
def test_labels(text, labels, left):
    assert K.strip_labels(K.tokenize(text)) == (left, labels)
    assert K.strip_known_labels(K.tokenize(text), labels) == left


def test_label_like():
    assert all(map(K.label_like, ("LWX", "S1", "spk_3", "USER-2", "a1", "小明", "Аня", "José", "élan2")))
    assert not any(map(K.label_like, ("note", "1A", "", "élan", "foo-bar", "A" * 17, "д" * 13)))
    assert K.strong_signature(("spk",)) and K.strong_signature(("a-b",)) and not K.strong_signature(("lwx",)) and not K.strong_signature(())


def test_segments():
    flags = "🇩🇪🇫🇷"
    assert (segment.stabilize(flags, 0, 1, 4), segment.stabilize(flags, 0, 1, 1)) == (2, 1)
    assert len(segment.split("a" * 450, 300)) == 1 and len(segment.split("a" * 451, 300)) == 2
    text = "One sentence here. " * 100
    parts = segment.split(text, 300)
    assert "".join(text[a:b] for a, b in parts) == text and all(b - a <= 450 for a, b in parts)


def test_answers():
    assert answers.unfence('```json\n{"a":1}\n```') == '{"a":1}' == answers.unfence('> {"a":1}')
    assert answers.first_object('x {"a":"}"} y') == '{"a":"}"}'
    assert answers.first_object('{"a":') is None and answers.first_object("none") is None
    assert json.loads('"' + answers.fix_escapes(r"p\u000159\u0000edli\u000161") + '"') == "příliš"
    assert answers.fix_escapes(r"\u000159edn\u0000edc") == r"\u0159edn\u00edc"
    assert json.loads(answers.fix_escapes(r'"a\u000022b\u00005c"')) == 'a"b\\'
    assert answers.fix_escapes(r"\u0000000 \ud83d\ude00 \u00d8000") == r"\u0000000 \ud83d\ude00 \u00d8000".replace(r"\u00d8000", r"\u00d8000")
    assert answers.unfence('~~~json\n{"a":1}\n~~~') == '{"a":1}' == answers.unfence('<pre><code class="x">{"a":1}</code></pre>')
    assert answers.parse("[1]")[1] == "JSON parse error" or answers.parse("[1]")[1].startswith(("Schema", answers.NON_REPAIRABLE))
    loop: list = []
    loop.append(loop)
    assert answers.text_of(loop) == "" and answers.text_of([{"text": "a"}, "b"]) == "ab"
    assert answers.text_of({"message": {"content": [{"text": "a"}, {"delta_content": "b"}]}}) == "ab" and answers.text_of(None) == ""


@pytest.mark.parametrize(
    "faults, outcome",
    [({}, "ok"), ({0: "timeout"}, "ok"), ({0: "timeout", 1: "timeout"}, "timeout"), ({0: "limit"}, "ok"), ({0: "broken"}, "ok"), ({0: "short"}, "long_span"), ({0: "empty", 1: "empty"}, "invalid")],
)
def test_faults(faults, outcome):
    assert model.corrected(model.FakeClient(faults), "hello there my friend how are you doing", QUICK, 1)[1] == outcome


def test_patch_shortens_after_a_lost_span():
    text = "hello there my friend how are you doing today " * 8
    assert model.patch_line(model.FakeClient({0: "short"}), text, QUICK, 1) == (text, "ok")


def test_mining():
    assert [x[0] for x in mining.missing_spaces("Hello.World")] == ["hello.world"]
    assert not mining.missing_spaces("U.S.A. ok") and not mining.missing_spaces("3.14") and not mining.missing_spaces("你好。世界")
    assert mining.letter_digits("augusztus29")[0][:2] == ("augusztus|29", 9)
    assert not mining.letter_digits("mp3") and mining.letter_digits("H264")[0][0] == "h|264"
    assert [x[0] for x in mining.digit_letter_spaces("I have 3 dogs")] == ["have 3", "3 dogs"]
    assert not mining.digit_letter_spaces("[Speaker 2]: hi")
    assert mining.apply_text("Hello.World", "missing_space", {"hello.world": True}) == ("Hello. World", 1)
    assert mining.apply_text("augusztus29", "letter_digit", {"augusztus|29": True}) == ("augusztus 29", 1)
    assert mining.apply_text("Hello.World", "missing_space", {}) == ("Hello.World", 0)
    assert mining.apply_text("Wait., ok", "double_mark", {".,": "."}) == ("Wait. ok", 1)
    assert mining.apply_text("Wait., ok", "double_mark", {".,": ".,"}) == ("Wait., ok", 0) and not mining.double_marks("What?!")
    assert mining.unspace_labels("[SPK 1]: a", mining.label_forms("[SPK1]: a")) == "[SPK1]: a"
    assert mining.unspace_labels("[SPK 1]: a", mining.label_forms("[SPK 1]: a")) == "[SPK 1]: a"
    assert mining.unspace_labels("[SPK 1]: a", {}) == "[SPK1]: a"


def test_steps():
    assert S.resolve(None) == list("0123456789") == S.resolve("bogus")
    assert S.resolve("LEXICAL") == ["2", "3"] and S.resolve("PUNCT, CASING, 7") == ["7", "8"]
    assert S.resolve('["4","1"]') == ["2", "4", "1"] and S.resolve(["PUNCT", "CASING,7"]) == ["7", "8"] and S.resolve("[3, 'PUNCT']") == ["2", "3", "7"]
    assert S.expand_selector(["[NUMERAL]", " ", None, 3]) == ["[NUMERAL]"] and S.expand_selector("[]") == [] and S.expand_selector(None) == []
    schema = S.payload_schema()["schema"]
    assert set(schema["required"]) == set(S.REQUIRED) and answers.payload_error(answers.empty_payload() | {"speaker_scope": "single"}) is None


def test_decode():
    for name in ("utf-8", "utf-8-sig"):
        assert files.decode("příliš".encode(name))[0] == "příliš"
    assert files.decode("ž".encode("cp1250")) == ("ž", "cp1250")
    assert files.decode(None) == (None, None) and files.decode(b"") == ("", "utf-8")
