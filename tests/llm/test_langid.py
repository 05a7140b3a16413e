import random

import pyarrow.parquet as pq
import pytest

from lectern.llm import langid as K


@pytest.fixture(scope="module")
def split():
    rows = [(r["text"], r["lang"]) for r in pq.read_table("/root/testdata/sf0.01/documents.parquet", columns=["text", "lang"]).to_pylist() if r["lang"] and r["text"] and 40 <= len(r["text"]) <= 4000]
    random.Random(1).shuffle(rows)
    return rows[:500], rows[500:]


@pytest.fixture(scope="module")
def model(split):
    return K.fit(split[0])


def test_held_out(model, split):
    known = {t for t, _ in split[0]}
    rows = [x for x in split[1] if x[0] not in known and not any(c in x[0] for c in "ÃÂ�¤¥")]
    got = K.label_batch(model, [t for t, _ in rows])
    right = sum(max(K.text_languages(s), key=lambda x: x[1])[0] == lang for s, (_, lang) in zip(got, rows) if s)
    assert right / len(rows) > 0.97


def test_mixed(model):
    text = "That was really a wonderful day! Na koniec tylko 30 osób zostało w szkole. Can we start the recording now?"
    (found,) = K.label_batch(model, [text])
    assert [x for x, _ in K.text_languages(found)] == ["en", "pl"] and all(0 < c <= 1 for _, _, _, c, _ in found)


def test_marginals_by_brute_force():
    """Forward-backward equals the sum over all label sequences."""
    import itertools

    import numpy as np

    rng = np.random.default_rng(3)
    n = len(K.LANGUAGES)
    model = K.Model(rng.normal(size=(1 << K.BITS, n)).astype("float32"), rng.random((2, n, n)) + 0.01, {"cd": (0, 3)})
    words = [(0, 1, "ab", True), (2, 3, "cd", False), (4, 5, "ef", True)]
    (got,) = model.marginals([words])
    emit = model.rows[model.ids([w[2] for w in words])] * (1 - K.FLOOR) + K.FLOOR / n
    want = np.zeros((3, n))
    for ys in itertools.product(range(n), repeat=3):
        p = emit[0, ys[0]]
        for k in (1, 2):
            p *= emit[k, ys[k]] * model.steps[0 if words[k][3] else 1][ys[k - 1], ys[k]]
        for k in range(3):
            want[k, ys[k]] += p
    assert np.allclose(got, want / want.sum(1, keepdims=True), atol=1e-6)


def test_segments_of_spliced_texts(model, split):
    """Words of held-out texts in two languages: nine in ten get their own language."""
    rng = random.Random(4)
    known = {t for t, _ in split[0]}
    rows = [(t.split("\n")[0], y) for t, y in split[1] if t not in known and not any(c in t for c in "ÃÂ�¤¥")]
    rows = [x for x in rows if 30 < len(x[0]) < 300]
    right = total = found = pairs = 0
    for _ in range(200):
        (a, x), (b, y) = rng.sample(rows, 2)
        if x == y:
            continue
        (got,) = K.label_batch(model, [a + "\n" + b])
        pairs += 1
        found += {x, y} == {z for z, _ in K.text_languages(got)}
        for lo, hi, z, _, _ in got:
            for c, want in ((max(0, min(hi, len(a)) - lo), x), (max(0, hi - max(lo, len(a) + 1)), y)):
                total, right = total + c, right + c * (z == want)
    assert pairs > 100 and right / total > 0.95 and found / pairs > 0.9


def test_steps_are_learned(model):
    """Staying is likelier inside a sentence than at its start, and steps differ."""
    import numpy as np

    stay = [np.diag(s).mean() for s in model.steps]
    assert 0.5 < stay[0] < stay[1] <= 1 and np.unique(model.steps.round(9)).size > 50


def test_splicing_keeps_labels():
    sentences = [(0, ["a"] * 9)] * 300 + [(1, ["b"] * 9)] * 300
    got = [x for s in K.spliced(sentences) for x in s]
    assert all((w == "a") == (y == 0) for w, y, _ in got) and len(got) >= 5400 and max(map(len, K.spliced(sentences))) <= K.SEQUENCE


def test_locales():
    cases = {"en-IN": "en", "English": "en", "eng": "en", "cs_CZ": "cs", "zh-cn": "zh", "czech": "cs", "??": None, "zxx": None, "": None, None: None, "pt-BR": None}
    assert {k: K.locale_language(k) for k in cases} == cases


def test_frame(spark, model):
    rows = [(1, "That was really a wonderful day!", "de", 1), (2, None, "en", 1), (3, " ", None, 1), (4, "short", None, 1), (5, "we go to the market " * 5_000, "en-GB", 1), (6, "That was really a wonderful day!", "de", 1)]
    df = spark.createDataFrame(rows, "payload_id bigint, source_text string, locale string, lang int")
    assert sorted(tuple(r)[:2] for r in K.mislabelled(df, model).collect()) == [(1, "en"), (6, "en")]
    assert {r.payload_id for r in K.label(df, model).collect()} >= {1, 5, 6} and K.mislabelled(df.limit(0), model).count() == 0
    assert len(K.fit([]).steps) == 2
