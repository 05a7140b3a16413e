"""Session helpers: a local session for tests, checkpoint folder, spreading of
small inputs over the cores, and shipping of the package to executors."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import DataFrame, SparkSession

#: Arrow batches stay small because one row may hold a very long text.
ARROW_ROWS = 2000
ARROW_BYTES = "16m"


def local_session(cores: str = "*", shuffle: int = 8, memory: str = "4g") -> SparkSession:
    """A session for tests and for ``bench.py``."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("lectern")
        .config("spark.sql.shuffle.partitions", str(shuffle))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def prepare(spark: SparkSession) -> SparkSession:
    """Bound Arrow batches by rows and bytes and make the package importable on
    executors of a cluster. Safe to call before every query."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    try:
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", ARROW_BYTES)
    except Exception:  # older releases have no byte bound
        pass
    ship(spark)
    return spark


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send the package to executors once per application (not in local mode)."""
    sc = spark.sparkContext
    if sc.master.startswith("local[") or sc.master == "local" or sc.applicationId in _shipped:
        return
    _shipped.add(sc.applicationId)
    root = os.path.dirname(os.path.abspath(__file__))
    shared = (named_dir(spark) or "").removeprefix("file://")
    if shared.startswith("/"):  # the folder that all executors share
        os.makedirs(shared, exist_ok=True)
        path = os.path.join(shared, f"lectern-{sc.applicationId}.zip")
    else:  # the driver's own folder, from where it serves the file
        path = os.path.join(tempfile.mkdtemp(prefix="lectern-"), "lectern.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for base, _, files in os.walk(root):
            for name in files:
                if name.endswith(".py"):
                    full = os.path.join(base, name)
                    z.write(full, os.path.join("lectern", os.path.relpath(full, root)))
    sc.addPyFile(path)  # the driver serves it; executors fetch their own copy


def named_dir(spark: SparkSession) -> str | None:
    """The folder named in ``spark.checkpoint.dir``."""
    return spark.sparkContext.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder that the cluster names. Only a local session, as in tests, may
    do without one and gets a temporary folder; elsewhere that is an error."""
    sc = spark.sparkContext
    named = named_dir(spark)
    if not named:
        if not (sc.master == "local" or sc.master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        named = os.path.join(tempfile.gettempdir(), "lectern-checkpoint")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(named)
    return named


def cut(df: DataFrame) -> DataFrame:
    """Cut lineage through the shared checkpoint folder."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def spread(df: DataFrame) -> DataFrame:
    """Give a scan with fewer splits than cores one partition per core. Larger
    inputs keep their splits, so nothing is shuffled at scale."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
