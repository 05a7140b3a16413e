"""Chunks of lines in order: a chunk closes on the line where the sum of its estimates
reaches a target, then the count starts again.

The fold looks sequential, but a part of the lines is a function of the count that it
starts with, which is below the target. Lines are laid out in ranges of their order; a
range gives that function for the group that it begins with, the functions are put
together in order (one row a range), and every range numbers its lines from there. No
task sees more than a range, whatever the size of a group.

Defined results
---------------
* chunks of a group count from 0; null estimates count nothing;
* an estimate of the target or more closes the chunk that it falls into;
* ties of the order go by the estimate; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.operators.arrow import map_partition
from lectern.session import cut

#: Lines of a range.
BLOCK = 1 << 16


def step(count: int, estimate: int, target: int) -> tuple[int, int]:
    """(count after a line, whether it closes the chunk)."""
    return (0, 1) if count + estimate >= target else (count + estimate, 0)


class Effect:
    """What a run of lines does to every count that it may start with. Starts that come to
    one count go on together, so it costs hardly more than one pass."""

    def __init__(self, target: int):
        self.target = target
        self.at = {k: [k] for k in range(target)}  # count now -> starts
        self.closed = [0] * target
        self.shared = 0  # chunks closed since all starts are one

    def add(self, estimate: int) -> None:
        if len(self.at) == 1:
            ((count, starts),) = self.at.items()
            count, full = step(count, estimate, self.target)
            self.at, self.shared = {count: starts}, self.shared + full
            return
        after: dict[int, list[int]] = {}
        for count, starts in self.at.items():
            count, full = step(count, estimate, self.target)
            for s in starts if full else ():
                self.closed[s] += 1
            after.setdefault(count, []).extend(starts)
        self.at = after

    def table(self) -> tuple[list[int], list[int]]:
        """(count at the end, chunks closed) by the count at the start."""
        ends = {s: count for count, starts in self.at.items() for s in starts}
        return [ends[k] for k in range(self.target)], [c + self.shared for c in self.closed]


def chunk_ids(df: DataFrame, group: str, order: str, estimate: str, target: int) -> DataFrame:
    """(group, order, chunk_id) of every line of ``df``."""
    ranges = max(1, math.ceil(df.count() / BLOCK))
    rows = df.select(group, order, F.coalesce(F.col(estimate), F.lit(0)).cast("int").alias("e"))
    laid = rows.repartitionByRange(ranges, group, order, "e").sortWithinPartitions(group, order, "e")
    laid = cut(laid.withColumn("part", F.spark_partition_id()))  # read twice, and always in the same ranges

    def effects(batches: Iterator[dict]) -> Iterator[dict]:
        first = last = None
        head, tail, part = Effect(target), Effect(target), None
        for c in batches:
            for key, e, part in zip(c[group], c["e"], c["part"]):
                if first is None:
                    first = (key,)
                if (key,) == first:
                    head.add(e)
                else:
                    if (key,) != last:
                        last, tail = (key,), Effect(target)
                    tail.add(e)
        if first is not None:
            (a, b), (x, y) = head.table(), tail.table()
            yield {"part": [part], "first": [repr(first)], "last": [repr(last or first)], "ends": [a], "closed": [b], "tail_end": [x[0]], "tail_closed": [y[0]]}

    schema = "part int, first string, last string, ends array<int>, closed array<bigint>, tail_end int, tail_closed bigint"
    starts: dict[int, tuple[int, int]] = {}
    count = chunk = 0
    before = None
    for r in sorted(map_partition(laid, effects, schema).collect(), key=lambda r: r.part):  # one row a range
        if r.first != before:
            count = chunk = 0
        starts[r.part] = (count, chunk)
        if r.first == r.last:
            count, chunk = r.ends[count], chunk + r.closed[count]
        else:
            count, chunk = r.tail_end, r.tail_closed
        before = r.last
    shared = df.sparkSession.sparkContext.broadcast(starts)  # two numbers a range

    def number(batches: Iterator[dict]) -> Iterator[dict]:
        key = None
        count = chunk = 0
        for c in batches:
            out = []
            for k, e, part in zip(c[group], c["e"], c["part"]):
                if (k,) != key:
                    count, chunk = shared.value[part] if key is None else (0, 0)
                    key = (k,)
                out.append(chunk)
                count, full = step(count, e, target)
                chunk += full
            yield {group: c[group], order: c[order], "chunk_id": out}

    types = dict(laid.dtypes)
    return map_partition(laid, number, f"{group} {types[group]}, {order} {types[order]}, chunk_id int")
