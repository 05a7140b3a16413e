import random

import pytest
from pyspark.sql import Row

from lectern.llm import sentences as K

FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def rows():
    import pyarrow.parquet as pq

    got = pq.read_table(f"{FOLDER}/payloads.parquet", columns=["corrected_text", "ct_punct"]).to_pylist()
    return [(r["corrected_text"], r["ct_punct"]["edits"]) for r in got if r["corrected_text"] and r["ct_punct"] and r["ct_punct"]["edits"]]


def test_held_out(rows):
    """Ends on rows that were not learned from; copies of learned texts are left out."""
    random.Random(1).shuffle(rows)
    cut = len(rows) * 2 // 3
    chain = K.Chain().fit(K.training_data(rows[:cut]))
    known = {t for t, _ in rows[:cut]}
    right = found = true = 0
    for text, edits in rows[cut:]:
        ends = K.labelled_ends(text, edits)
        if ends is None or text in known:
            continue
        got = set(K.sentence_ends(text, chain))
        right, found, true = right + len(got & set(ends)), found + len(got), true + len(ends)
    assert true > 200 and right / found > 0.97 and right / true > 0.97


def test_held_out_without_marks():
    """Gaps of stripped texts that were not learned from."""
    import pyarrow.parquet as pq

    got = pq.read_table("/root/testdata/sf0.1/payloads.parquet", columns=["corrected_text", "ct_punct"]).to_pylist()
    texts = {r["corrected_text"]: r["ct_punct"]["edits"] for r in got if r["corrected_text"] and r["ct_punct"] and r["ct_punct"]["edits"]}
    rows = sorted(texts.items())
    random.Random(1).shuffle(rows)
    bare = K.fit_bare(K.bare_data(rows[:4000]))
    right = found = true = 0
    for cands, gold in K.bare_data(rows[4000:6000]):
        told = bare.decode(cands)
        right, found, true = right + sum(map(min, told, gold)), found + sum(told), true + sum(gold)
    assert true > 1000 and right / found > 0.95 and right / true > 0.9


def test_codes_do_not_make_a_script_flat():
    """A stretch of a script without capitals is not of one case for a Latin code in it."""
    assert not K._mostly_cased("这个相机 RJ4728 坏了") and K._mostly_cased("das ist so") and not K._mostly_cased("123")
    chain = K.Chain()
    chain.weights = {"m。": 1.0}
    chain.bare = K.Chain()
    chain.bare.bias = 9.0
    assert K.sentence_ends("相机RJ4728坏了。我们走。", chain) == [11, 15]


def test_labels_open_sentences():
    chain = K.Chain()
    chain.bare = K.Chain()
    chain.bare.weights = {"gs": -1.0}
    assert K.sentence_ends("hi there [SPK 2]: yes [noise] ok", chain) == [8, 32]


def test_places():
    assert [c[0] for c in K.places("See www.a.example. Pi is 3.14 now.")] == [18, 34]
    chain = K.Chain()
    assert K.sentence_ends(None, chain) == K.sentence_ends(" ", chain) == [] and K.sentence_ends("no marks ", chain) == [8]


def test_frame(spark):
    data = [Row(payload_id=1, field="f", text="One. Two."), Row(payload_id=2, field="f", text=None), Row(payload_id=3, field="f", text=""), Row(payload_id=4, field=None, text="word " * 50_000), Row(payload_id=1, field="f", text="One. Two.")]
    df = spark.createDataFrame(data).withColumn("sent_no", F_lit())
    chain = K.Chain()
    got = K.units(df, chain).collect()
    assert {r.payload_id for r in got} == {1, 4} and all(r.sent_start < r.sent_end for r in got)
    assert K.units(df.limit(0), chain).count() == 0
    assert K.Chain().fit([]).weights == {}


def F_lit():
    from pyspark.sql import functions as F

    return F.lit(1)


def test_stretches_without_marks():
    """A line break or one mark does not keep the word gaps of the rest from being read."""
    chain = K.Chain()
    chain.bare = K.Chain()
    chain.weights = {"mN": 1.0, "m?": 1.0, "m.": -1.0}
    chain.bare.weights = {"gs": -1.0, "Nwe": 3.0}
    assert K.sentence_ends("it was late we went\nwe slept", chain) == [11, 19, 28]
    assert K.sentence_ends("who came? it was late we went", chain) == [9, 21, 29]
    assert K.sentence_ends("mr. x was late we went", chain) == [14, 22]
    assert K.sentence_ends("[0:10] so late\n[0:12] SPK 2: we went", chain)[0] == 14
