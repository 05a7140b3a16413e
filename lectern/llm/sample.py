"""Bounded samples for fitting models."""

from __future__ import annotations

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

#: Times the wanted rows that the first cut of the hashes aims at.
AMPLE = 2


def bounded(df: DataFrame, key: str, rows: int, *columns: str) -> list[Row]:
    """One row for each of the ``rows`` smallest hashes of ``key``, so the pick does not
    depend on order or partitions and copies count once (of copies that differ in other
    columns the smallest row counts). A range of hashes that should hold enough is looked
    at first, and all of them where copies leave too few in it; the driver receives the
    picked rows alone."""
    hashed = df.select(F.xxhash64(key).alias("h"), F.struct(*columns).alias("r"))
    share = AMPLE * rows / max(1, df.count())
    for cut in (share, 1.0) if share < 1 else (1.0,):
        part = hashed if cut >= 1 else hashed.filter(F.col("h") <= int(2**64 * cut) - 2**63)
        got = part.groupBy("h").agg(F.min("r").alias("r")).orderBy("h").limit(rows).collect()
        if len(got) == rows:
            break
    return [x["r"] for x in got]
