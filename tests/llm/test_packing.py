import random

from hypothesis import given, settings
from hypothesis import strategies as st

from lectern.llm import packing as K


@settings(max_examples=200, deadline=None)
@given(st.dictionaries(st.integers(1, 60), st.integers(0, 40), max_size=20), st.sampled_from([60, 64, 100]))
def test_plan(histogram, capacity):
    placed = {}
    for packs, items in K.plan(histogram, capacity):
        assert packs > 0 and sum(n * t for n, t in items) <= capacity
        for n, t in items:
            placed[n] = placed.get(n, 0) + packs * t
    assert placed == {n: c for n, c in histogram.items() if c}


def test_plan_fills_well():
    rng = random.Random(1)
    histogram = {}
    for _ in range(20_000):
        n = min(512, max(1, int(rng.lognormvariate(4, 1))))
        histogram[n] = histogram.get(n, 0) + 1
    containers = sum(p for p, _ in K.plan(histogram, 512))
    assert sum(n * c for n, c in histogram.items()) / (containers * 512) > 0.99


def test_frame(spark):
    rng = random.Random(2)
    rows = [(k, rng.choice([0, 5, 7, 7, 7, 30, 64, 200]), "x") for k in range(400)] + [(1000 + k, 7, "x") for k in range(200)]
    df = spark.createDataFrame(rows, "doc_id bigint, n_tokens bigint, rank string")
    got = K.pack(df, "small", 64).collect()
    used, per_doc = {}, {}
    for r in got:
        used[r.container_id] = used.get(r.container_id, 0) + r.n_tokens
        per_doc.setdefault(r.doc_id, []).append((r.token_start, r.n_tokens))
    assert max(used.values()) <= 64 and set(used) == set(range(len(used)))
    for doc, n, _ in rows:
        parts = sorted(per_doc.get(doc, []))
        assert sum(p[1] for p in parts) == n and (len(parts) <= 1 or n > 64)
        assert [p[0] for p in parts] == [64 * k for k in range(len(parts))]
    assert sorted(map(tuple, got)) == sorted(map(tuple, K.pack(df.repartition(7), "small", 64).collect()))
    assert K.pack(df.limit(0), "small", 64).count() == 0
