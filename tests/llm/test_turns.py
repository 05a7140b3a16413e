import pyarrow.parquet as pq
import re

from hypothesis import given, settings
from hypothesis import strategies as st

from lectern.llm import turns as K
from lectern.llm.lookalike import one_form


def test_against_corrected_labels():
    """Where the corrected text is whole, its labels name the turns."""
    rows = pq.read_table("/root/testdata/sf0.01/payloads.parquet", columns=["source_text", "corrected_text"]).to_pylist()
    same = seen = 0
    for r in rows:
        clean = one_form(r["corrected_text"] or "")
        labels = re.findall(r"\[([^\[\]\n]{1,30})\]:", clean)
        if labels and not clean.startswith("["):
            labels = ["UNK", *labels]
        got = [t[1] for t in K.turns(r["source_text"])]
        if labels and got and len(labels) >= len(got):
            seen, same = seen + 1, same + (got == labels)
    assert seen > 100 and same / seen > 0.98


def test_labels():
    cases = {
        "[SPK 2]: hi": ["SPK2"], "SPEAKER_04: hi": ["SPK4"], "Spk2 : hi": ["SPK2"], "**Zoë:** hi": ["ZOË"], "<v Łucja> hi": ["ŁUCJA"], "Łucja (host): hi": ["ŁUCJA"],
        ">> Speaker 3: hi": ["SPK3"], "Mówca 3: hi": ["SPK3"], "说话人 A： 你好": ["SPKA"], "[话者 B]: はい": ["SPKB"], "hello [SPK1]: hi": ["UNK", "SPK1"],
        "[SPK1]: um [noise] [SPK1]: yes [SPK1]: no": ["SPK1", "SPK1"], "at 10:30 we go": [], "no label": [], "[00:01:02] [A B]: x": ["A B"], "http://a.b": [],
    }
    assert {t: [x[1] for x in K.turns(t)] for t in cases} == cases


def test_sweep_and_overlap():
    text = "[00:00:20] [A1]: second [00:00:10] [B1]: first"
    assert [t[1:3] for t in K.turns(text)] == [("SPK1", "first"), ("SPK1", "second")]
    assert K.overlap("we go to the", "to the market") == len("to the") and K.overlap("a", "a") == 0
    assert K.seconds("01:02:03,500") == 3723.5 and K.seconds("10:05") == 605


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="aB1 :[]<>*_\n♪(v)", max_size=60))
def test_never_fails(text):
    rows = K.turns(text)
    assert [r[0] for r in rows] == list(range(1, len(rows) + 1))


def test_frame(spark):
    rows = [(1, "[A1]: hi", 1), (2, None, 1), (3, "", 1), (4, "[A1]: " + "word " * 50_000, 1), (5, "[A1]: hi", 1), (None, "B: yes", 1)]
    df = spark.createDataFrame(rows, "payload_id bigint, source_text string, speaker int")
    assert sorted(r.payload_id or 0 for r in K.speaker_turns(df).collect()) == [0, 1, 4, 5]
    assert K.speaker_turns(df.limit(0)).count() == 0 and K.calibrated_pause(df) is None


def test_rolling_captions():
    """A caption that shows the end of the last one again is no turn, in time order; said
    again later, by another speaker or without times it is one."""
    said = lambda text: [t[1:3] for t in K.turns(text)]
    roll = "[00:00:01] [A1]: we go to the market [00:00:03] [A1]: to the market [00:00:05] [A1]: to the market and buy bread"
    assert said(roll) == [("SPK1", "we go to the market"), ("SPK1", "and buy bread")]
    shuffled = "[00:00:05] [A1]: to the market and buy bread [00:00:01] [A1]: we go to the market [00:00:03] [A1]: to the market"
    assert said(shuffled) == said(roll)
    assert len(said("[00:00:01] [A1]: that was it [00:01:01] [A1]: that was it")) == 2 == len(said("[A1]: that was it [A1]: that was it"))
    assert said("[00:00:01] [A1]: that was it [00:01:01] [A1]: that was it indeed")[1] == ("SPK1", "that was it indeed")
    assert len(said("[00:00:01] [A1]: that was it [00:00:02] [B2]: that was it")) == 2
    assert len(said("00:00:01.000 --> 00:00:09.000 [A1]: that was it 00:00:06.000 --> 00:00:12.000 [A1]: that was it")) == 1


def test_pauses():
    text = "[00:00:01] [A1]: one two [00:00:02] three four [00:01:00] five six"
    assert [t[2] for t in K.turns(text, 10.0)] == ["one two three four", "five six"] and len(K.turns(text)) == 1
