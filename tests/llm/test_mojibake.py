import random

import pyarrow.parquet as pq
import pytest

from lectern.llm import mojibake as K


@pytest.fixture(scope="module")
def clean():
    rows = pq.read_table("/root/testdata/sf0.01/documents.parquet", columns=["text"]).to_pylist()
    return [r["text"] for r in rows if r["text"] and not any(c in r["text"] for c in "ÃÂ�ÐÑ√â├¤¥ƒØ")]


@pytest.fixture(scope="module")
def table(spark, clean):
    return K.count_pairs(spark.createDataFrame([(t,) for t in clean], "text string"))


READERS = [("utf-8", "cp1252"), ("utf-8", "latin-1"), ("utf-8", "cp1250"), ("utf-8", "cp437"), ("utf-8", "mac_roman")]


def test_round_trip(table, clean):
    """Lines garbled on purpose come back; clean texts stay."""
    rng = random.Random(1)
    lines = [x for t in clean for x in t.split("\n") if sum(c > "\x7f" for c in x) >= 4 and len(x) < 400]
    back = tried = 0
    for line in rng.sample(lines, 150):
        true, wrong = rng.choice(READERS)
        try:
            bad = "".join(bytes([b]).decode(wrong) if wrong != "cp1252" or b not in (0x81, 0x8D, 0x8F, 0x90, 0x9D) else chr(b) for b in line.encode(true))
        except UnicodeError:
            continue
        found, lost = K.examine(bad, table)
        out, at = [], 0
        for a, b, new, _ in found:
            out += [bad[at:a], new]
            at = b
        tried, back = tried + 1, back + ("".join(out) + bad[at:] == line)
    assert tried > 100 and back / tried > 0.9
    assert sum(K.examine(t, table) != ([], False) for t in clean) <= 0.01 * len(clean)


def test_segments():
    assert K.segments([]) == [] and K.segments([-1, 2, 3, -1, -9, 4]) == [(1, 3, 5), (5, 6, 4)]
    assert K.segments([9, -5, 3, -3, 2]) == [(0, 1, 9), (2, 3, 3), (4, 5, 2)]  # what lies behind a maximum is looked at again


def test_mappings_are_tried_inside_runs_alone(table, monkeypatch):
    """No character outside the improbable runs of its line is given to a mapping, and
    what a mapping changes lies within runs."""
    tried = []
    real = K.restore
    monkeypatch.setattr(K, "restore", lambda run, *a: tried.append(run) or real(run, *a))
    line = "Wir haben das Angebot gelesen und dann war der CafÃ© am Markt geschlossen, schön war es nicht"
    scores = table.scores(K._codes("\n" + line + "\n")).tolist()
    inside = [line[a:b] for a, b in K.runs(line, scores)]
    found, _ = K.examine(line, K.Pairs(table.pairs, table.chars))
    assert [line[a:b] for a, b, *_ in found] == ["CafÃ©"] and found[0][2] == "Café"
    assert tried and all(any(t in run for run in inside) for t in tried) and sum(map(len, inside)) < len(line) / 2


def test_every_character_has_its_own_count(spark):
    df = spark.createDataFrame([("A\U00020041\U00030041",)], "text string")
    chars = K.count_pairs(df).chars
    assert chars[0x41] == chars[0x20041] == chars[0x30041] == 1 and chars[10] == 2


def test_error_of_the_pair_table():
    """Many rare pairs make counts too large by a small part of what makes a pair
    probable: with a million pairs in the table the mean error is below 1e-6 of all."""
    import numpy as np

    rng = np.random.default_rng(3)
    n = 1_000_000
    a, b = rng.integers(0x4E00, 0x9FFF, n).astype(np.uint64), rng.integers(0x4E00, 0x9FFF, n).astype(np.uint64)
    rows = [np.bincount(x, minlength=K.BUCKETS) for x in K._buckets(a, b)]
    one, two = K._buckets(a[:5000], b[:5000])
    over = (np.minimum(rows[0][one], rows[1][two]) - 1) / n
    assert over.min() >= 0 and over.mean() < 1e-6 < K.RARE / 10


def test_one_letter_encodings_and_single_letters(table):
    """Letters of one byte read as other letters, sure by themselves or together."""
    russian = "Сегодня я хочу рассказать про рецепт и билет"
    found, _ = K.examine(russian.encode("cp1251").decode("koi8-r"), table)
    assert found and "рассказать" in " ".join(x[2] for x in found)
    assert K.examine("МАРТА: НАМ НУЖЕН РЕЦЕПТ", table)[0] == []


def test_batches_equal_single_texts(table, clean):
    texts = [*clean[:60], None, "", "ascii", "dÃ©jÃ  vu\ncafÃ© und schÃ¶n"] * 2
    fresh = lambda: K.Pairs(table.pairs, table.chars)
    assert K.examine_all(texts, fresh()) == [K.examine(t, fresh()) for t in texts]


def test_frame(spark, table):
    rows = [(1, "dÃ©jÃ  vu cafÃ©", 1), (2, None, 1), (3, "", 1), (4, "plain", 1), (5, "gan� mucho", 1), (6, "x" * 200_000 + " cafÃ©", 1)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, runs int")
    got = {r.doc_id: r for r in K.garbled(df).collect()}
    assert got[5].lost and got[5].restored is None and set(got) <= {1, 5, 6}
    assert K.garbled(df.limit(0)).count() == 0


def test_copies_do_not_hide(spark, clean):
    """A garbled text is found though a third of all rows are its copies."""
    line = next(x for t in clean for x in t.split("\n") if 60 < len(x) < 200 and sum("\u0400" <= c <= "\u04ff" for c in x) > 40)
    bad = "".join(bytes([b]).decode("cp1252", "replace").replace("\ufffd", chr(b)) for b in line.encode())
    rows = [(k, t) for k, t in enumerate(clean)] + [(-1, bad)] * (len(clean) // 2)
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = [r.restored for r in K.garbled(df).filter("doc_id = -1").collect()]
    assert got == [line] * (len(clean) // 2)
