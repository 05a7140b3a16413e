import random

from lectern.llm import mixing as K

TARGETS = [("a", 0.5, 1), ("b", 0.3, 3), ("c", 0.2, 2), ("gone", 0.0, 1)]


def frame(spark):
    rng = random.Random(1)
    rows = [(k, rng.choice(["a", "a", "a", "a", "b", "c", None, "other"]), rng.choice([0, 1, 10, 10, 300])) for k in range(800)]
    return rows, spark.createDataFrame(rows, "doc_id bigint, source string, n_tokens bigint")


def test_shares(spark):
    rows, df = frame(spark)
    got = K.mixture(df, TARGETS).collect()
    total = sum(r.used for r in got)
    for source, share, most in TARGETS[:3]:
        own = [r for r in got if r.source == source]
        assert abs(sum(r.used for r in own) / total - share) < 0.001
        uses = {}
        for r in own:
            assert 0 < r.used <= r.n_tokens and (r.doc_id, r.epoch) not in uses
            uses[r.doc_id, r.epoch] = 1
        assert max(r.epoch for r in own) <= most and sum(r.used < r.n_tokens for r in own) <= 1
    assert {r.source for r in got} == {"a", "b", "c"}
    again = K.mixture(df.repartition(5), TARGETS).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, again))


def test_prefix_by_brute_force(spark):
    """The last epoch holds the texts with the smallest keys, up to the budget."""
    from pyspark.sql import functions as F

    _, df = frame(spark)
    got = K.mixture(df, TARGETS, size=3000).collect()
    keys = {r.doc_id: r.k for r in df.select("doc_id", F.xxhash64(F.lit(1), "doc_id").alias("k")).collect()}
    for source, share, _ in TARGETS[:3]:
        left, want = int(share * 3000), {}
        for r in sorted((r for r in df.collect() if r.source == source and r.n_tokens > 0), key=lambda r: (keys[r.doc_id], r.doc_id)):
            take = min(r.n_tokens, left)
            if take > 0:
                want[r.doc_id] = take
                left -= take
        assert {r.doc_id: r.used for r in got if r.source == source} == want


def test_edges(spark):
    _, df = frame(spark)
    assert K.mixture(df.limit(0), TARGETS).count() == 0 and K.mixture(df, [("nobody", 1.0, 1)]).count() == 0
    targets = spark.createDataFrame(TARGETS, "source string, target_share double, max_repeats int")
    report = {r.source: r for r in K.report(K.mixture(df, TARGETS), targets).collect()}
    assert report["gone"].tokens == 0 and abs(sum(r.actual_share for r in report.values()) - 1) < 1e-6
