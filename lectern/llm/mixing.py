"""Mixing sources to target weights.

The largest mixture is built that gives every source its share without using a text
more than ``max_repeats`` times (or one of a given size). A source's budget is whole
epochs of all its texts and a part of one more, for which texts get hash-random keys:
the key's range is cut into equal buckets, token sums are added up within buckets and
over buckets, and the texts whose sum stays within the rest of the budget are taken.

Defined results
---------------
* texts of no source, or of a source without a target, and texts without tokens are
  left out;
* a source with a target but without tokens contributes nothing and does not bind
  the size of the others;
* the text that crosses the budget is used up to the budget (``used`` tokens), so a
  source reaches its budget exactly, whatever the sizes of its texts;
* ties of keys are broken by doc_id; copies under other ids count one by one; extra
  columns are ignored; empty tables give no rows.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Texts per key bucket that the number of buckets aims at.
BUCKET_ROWS = 20_000
MAX_BUCKETS = 1 << 16


def budgets(totals: dict[str, int], targets: list[tuple[str, float, int]], size: int | None = None) -> dict[str, int]:
    """Token budget of every source for the largest possible (or the given) size."""
    live = [(s, w, r) for s, w, r in targets if w > 0 and r > 0 and totals.get(s, 0) > 0]
    if not live:
        return {}
    most = min(r * totals[s] / w for s, w, r in live)
    whole = most if size is None else min(size, most)
    return {s: min(r * totals[s], math.floor(w * whole + 1e-6)) for s, w, r in live}


def mixture(counts: DataFrame, targets: list[tuple[str, float, int]], size: int | None = None, seed: int = 1) -> DataFrame:
    """(source, epoch, doc_id, n_tokens, used, order_key) of the mixture. ``counts`` (doc_id,
    source, n_tokens) should be materialised: it is read three times. ``targets`` is a
    small fixed table of (source, share, most uses)."""
    spark = counts.sparkSession
    names = [s for s, _, _ in targets]
    texts = counts.filter(F.col("source").isin(names) & (F.col("n_tokens") > 0)).select("doc_id", "source", "n_tokens")
    sums = texts.groupBy("source").agg(F.sum("n_tokens").alias("t"), F.count("*").alias("n")).collect()  # one row per target
    totals = {r.source: r.t for r in sums}
    rows = sum(r.n for r in sums)
    budget = budgets(totals, targets, size)
    plan = [(s, b // totals[s], b - b // totals[s] * totals[s]) for s, b in budget.items()]
    schema = "source string, epochs bigint, rest bigint"
    shares = F.broadcast(spark.createDataFrame(plan, schema))  # one row per target
    buckets = min(MAX_BUCKETS, 1 << max(4, math.ceil(math.log2(max(1, rows / BUCKET_ROWS)))))
    keyed = (
        texts.join(shares, "source")
        .withColumn("key", F.xxhash64(F.lit(seed), "doc_id"))
        .withColumn("bucket", F.shiftright("key", 64 - int(math.log2(buckets))).cast("int"))
    )
    sums = keyed.groupBy("source", "bucket").agg(F.sum("n_tokens").alias("b"))
    before = sums.select(
        "source", "bucket", (F.sum("b").over(Window.partitionBy("source").orderBy("bucket")) - F.col("b")).alias("before")
    )
    inside = F.sum("n_tokens").over(
        Window.partitionBy("source", "bucket").orderBy("key", "doc_id").rowsBetween(Window.unboundedPreceding, 0)
    )
    start = F.col("before") + F.col("inside") - F.col("n_tokens")
    part = F.greatest(F.lit(0).cast("long"), F.least("n_tokens", F.col("rest") - start))
    summed = keyed.withColumn("inside", inside).join(before, ["source", "bucket"]).withColumn("part", part)
    whole = F.transform(
        F.when(F.col("epochs") > 0, F.sequence(F.lit(1).cast("long"), "epochs")).otherwise(F.array().cast("array<bigint>")),
        lambda e: F.struct(e.alias("epoch"), F.col("n_tokens").alias("used")),
    )
    last = F.when(F.col("part") > 0, F.array(F.struct((F.col("epochs") + 1).alias("epoch"), F.col("part").alias("used"))))
    uses = F.concat(whole, F.coalesce(last, F.array().cast("array<struct<epoch:bigint,used:bigint>>")))
    return summed.select("source", "doc_id", "n_tokens", F.inline(uses)).select(
        "source",
        F.col("epoch").cast("int").alias("epoch"),
        "doc_id",
        "n_tokens",
        "used",
        F.xxhash64(F.lit(seed + 1), "epoch", "doc_id").alias("order_key"),
    )


def report(mixed: DataFrame, targets: DataFrame) -> DataFrame:
    """Reached share, tokens and most uses of a text per source."""
    got = mixed.groupBy("source").agg(
        F.sum("used").alias("tokens"), F.count("*").alias("texts"), F.max("epoch").alias("most_uses")
    )
    whole = F.sum("tokens").over(Window.partitionBy())  # one row per target
    return (
        targets.select("source", "target_share", "max_repeats")
        .join(got, "source", "left")
        .select(
            "source",
            "target_share",
            "max_repeats",
            F.coalesce("tokens", F.lit(0)).alias("tokens"),
            F.coalesce("texts", F.lit(0)).alias("texts"),
            F.coalesce("most_uses", F.lit(0)).alias("most_uses"),
            F.round(F.coalesce(F.col("tokens") / whole, F.lit(0.0)), 9).alias("actual_share"),
        )
    )
