"""Filling fixed-capacity containers with texts.

Shortest-pack-first over the histogram of lengths: lengths are placed longest first,
each into the pack with the most free space that takes it, and only counts of packing
patterns are updated, so the work depends on the capacity and not on the number of
texts. The patterns become ranges of ranks per length; a text finds its container by
its rank among the texts of its length.

Ranks are distributed: rank = texts of that length in earlier hash buckets + place
within the bucket, so no length, however common, is numbered by one task.

Defined results
---------------
* a text larger than the capacity is cut into full pieces and a rest; no other text
  is cut;
* texts without tokens (null, empty) take no container;
* ties are broken by doc_id; copies under other ids are packed one by one; extra
  columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import heapq

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lectern.operators.arrow import map_columns

#: Hash buckets for ranks; a bucket holds a thousandth of the texts of a length.
RANK_BUCKETS = 1024


def plan(histogram: dict[int, int], capacity: int) -> list[tuple[int, list[tuple[int, int]]]]:
    """[(packs, [(length, items of it in each pack)])] that place every item."""
    groups: dict[int, list[list]] = {}  # free space -> [[packs, pattern]]; a pattern is (length, times, rest)
    heap: list[int] = []

    def add(space: int, packs: int, pattern) -> None:
        if space not in groups:
            groups[space] = []
            heapq.heappush(heap, -space)
        groups[space].append([packs, pattern])

    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        if length <= 0 or left <= 0:
            continue
        if length > capacity:
            raise ValueError("an item is larger than the capacity")
        while left:
            while heap and not groups.get(-heap[0]):
                groups.pop(-heapq.heappop(heap), None)
            space = -heap[0] if heap else -1
            if space < length:
                each = capacity // length  # no pack takes the item: open new ones, filled one after the other
                if left >= each:
                    add(capacity - each * length, left // each, (length, each, None))
                if left % each:
                    add(capacity - left % each * length, 1, (length, left % each, None))
                left = 0
                continue
            packs, pattern = groups[space].pop()
            take = min(packs, left)
            if take < packs:
                groups[space].append([packs - take, pattern])
            times = 1
            if take == packs:
                second = max((s for s in groups if s != space and groups[s]), default=-1)
                if groups[space]:
                    second = space
                times = max(1, min(left // packs, space // length, (space - max(second, 0)) // length))
            add(space - times * length, take, (length, times, pattern))
            left -= take * times
    out = []
    for members in groups.values():
        for packs, pattern in members:
            items: dict[int, int] = {}
            while pattern:
                items[pattern[0]] = items.get(pattern[0], 0) + pattern[1]
                pattern = pattern[2]
            out.append((packs, sorted(items.items(), reverse=True)))
    return sorted(out, key=lambda x: (x[1], x[0]), reverse=True)


def rank_ranges(patterns: list[tuple[int, list[tuple[int, int]]]]):
    """Sorted arrays (length, first rank, first container, packs): items of a length with
    ranks from ``first rank`` go round the packs of one pattern."""
    import numpy as np

    rows, used, base = [], {}, 0
    for packs, items in patterns:
        for length, times in items:
            rows.append((length, used.get(length, 0), base, packs))
            used[length] = used.get(length, 0) + packs * times
        base += packs
    rows.sort()
    return np.array(rows, np.int64).reshape(-1, 4), base


def pieces(counts: DataFrame, capacity: int) -> DataFrame:
    """(doc_id, piece_no, token_start, size): whole texts, and cut ones where larger."""
    last = F.ceil(F.col("n_tokens") / capacity).cast("long") - 1
    return (
        counts.filter("n_tokens > 0")
        .select("doc_id", "n_tokens", F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("k"))
        .select(
            "doc_id",
            (F.col("k") + 1).cast("int").alias("piece_no"),
            (F.col("k") * capacity).alias("token_start"),
            F.least(F.lit(capacity).cast("long"), F.col("n_tokens") - F.col("k") * capacity).alias("size"),
        )
    )


def ranked(items: DataFrame) -> DataFrame:
    """Rank of every item among those of its size, from 0, without one task per size."""
    bucketed = items.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "piece_no"), F.lit(RANK_BUCKETS)).cast("int"))
    sums = bucketed.groupBy("size", "bucket").agg(F.count("*").alias("n"))
    before = sums.select(
        "size", "bucket", (F.sum("n").over(Window.partitionBy("size").orderBy("bucket")) - F.col("n")).alias("before")
    )
    place = F.row_number().over(Window.partitionBy("size", "bucket").orderBy("doc_id", "piece_no")) - 1
    return bucketed.withColumn("place", place).join(before, ["size", "bucket"]).select(
        "doc_id", "piece_no", "token_start", "size", (F.col("before") + F.col("place")).alias("rank")
    )


def pack(counts: DataFrame, name: str, capacity: int) -> DataFrame:
    """(pack_name, container_id, doc_id, piece_no, token_start, n_tokens) for one
    capacity. ``counts`` (doc_id, n_tokens) should be materialised: it is read twice."""
    import numpy as np

    items = pieces(counts, capacity)
    histogram = {r["size"]: r["n"] for r in items.groupBy("size").agg(F.count("*").alias("n")).collect()}  # at most ``capacity`` rows
    table, _ = rank_ranges(plan(histogram, capacity))
    shared = counts.sparkSession.sparkContext.broadcast(table)  # bounded by the capacity as well

    def kernel(columns: dict) -> dict:
        t = shared.value
        keys = t[:, 0] * (1 << 40) + t[:, 1]
        size, rank = np.array(columns["size"], np.int64), np.array(columns["rank"], np.int64)
        at = np.searchsorted(keys, size * (1 << 40) + rank, side="right") - 1
        where = t[at, 2] + (rank - t[at, 1]) % t[at, 3] if len(rank) else rank
        return {
            "pack_name": [name] * len(rank),
            "container_id": where,
            "doc_id": columns["doc_id"],
            "piece_no": columns["piece_no"],
            "token_start": columns["token_start"],
            "n_tokens": columns["size"],
        }

    return map_columns(
        ranked(items), kernel, "pack_name string, container_id bigint, doc_id bigint, piece_no int, token_start bigint, n_tokens bigint"
    )


def report(packed: DataFrame, sizes: DataFrame) -> DataFrame:
    """Containers, used tokens and fill per capacity."""
    return (
        packed.groupBy("pack_name", "container_id")
        .agg(F.sum("n_tokens").alias("used"), F.count("*").alias("items"))
        .groupBy("pack_name")
        .agg(F.count("*").alias("containers"), F.sum("items").alias("items"), F.sum("used").alias("tokens"))
        .join(F.broadcast(sizes.select("pack_name", "capacity_tokens")), "pack_name")
        .withColumn("fill", F.round(F.col("tokens") / (F.col("containers") * F.col("capacity_tokens")), 6))
    )
