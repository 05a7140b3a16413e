"""Joins of many rows with a table of keys, of which a few keys may be hot."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.session import cut

#: Parts into which the rows of one key are divided.
SALTS = 16
#: Rows of a table that may be sent to every task.
SENT_ROWS = 100_000


def salted(left: DataFrame, right: DataFrame, key: str | list[str], spread_by: tuple[str, ...], how: str = "inner", salts: int = SALTS) -> DataFrame:
    """``left`` joined with ``right`` (one row per ``key``) on the key. Rows of a key are
    divided over ``salts`` parts by the hash of ``spread_by`` and every row of ``right``
    is sent to each of them, so a key that holds a third of all rows is no single task's
    work. Nothing is broadcast unless the planner finds ``right`` small when it runs."""
    keys = [key] if isinstance(key, str) else key
    mine = left.withColumn("_salt", F.pmod(F.xxhash64(*spread_by), F.lit(salts)).cast("int"))
    theirs = right.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return mine.join(theirs, [*keys, "_salt"], how).drop("_salt")


def checked(left: DataFrame, right: DataFrame, key: str | list[str], spread_by: tuple[str, ...], how: str = "inner", most: int = SENT_ROWS) -> DataFrame:
    """``left`` joined with ``right`` (one small row per ``key``), which is written once
    and counted: up to ``most`` rows are sent to the tasks that hold ``left``, so that its
    rows are not shuffled; more are joined by ``salted``."""
    right = cut(right)
    if right.count() <= most:
        return left.join(F.broadcast(right), [key] if isinstance(key, str) else key, how)
    return salted(left, right, key, spread_by, how)
