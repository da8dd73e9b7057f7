"""Session settings, the shared work folder and the checked broadcast."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# A side is broadcast only when its counted rows, a few narrow columns each, stay within this bound; above it the join
# shuffles and AQE splits skewed partitions.
BROADCAST_ROWS = 500_000


def local_session(cpus: str = "*", app: str = "listmill", **conf: str) -> SparkSession:
    """A single-machine session for tests and benchmarks; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", "12g")
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir`` of the session.

    Only a local session may fall back to a folder of its own; a cluster without the setting is an error.
    """
    context = spark.sparkContext
    folder = context.getConf().get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder is None:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="listmill-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder


def fresh_dir(spark: SparkSession, name: str) -> str:
    """A new folder name below the shared one, never used before."""
    return os.path.join(shared_dir(spark), f"{name}-{uuid.uuid4().hex}")


# Files of shuffles go when the query that wrote them is through.
_CLEANED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def settle(df: DataFrame) -> DataFrame:
    """Compute ``df`` once and cut its lineage with a reliable checkpoint, which outlives lost executors.

    Nothing reads the shuffles behind a checkpoint again, so their files go at once rather than when the driver happens to collect them.
    """
    spark = df.sparkSession
    shared_dir(spark)
    before = spark.conf.get(_CLEANED, None)
    spark.conf.set(_CLEANED, "true")
    try:
        # a plan of its own, so that no other action on ``df`` looks for them
        return df.select("*").checkpoint(eager=True)
    finally:
        if before is None:
            spark.conf.unset(_CLEANED)
        else:
            spark.conf.set(_CLEANED, before)


def small(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Hint a broadcast when ``df`` was counted to be within ``max_rows``; otherwise hand it back for a shuffle join."""
    if df.limit(max_rows + 1).count() <= max_rows:
        return F.broadcast(df)
    return df


def balanced(df: DataFrame) -> DataFrame:
    """Spread a table that lies in fewer files than there are cores, so that heavy work per row uses them all.

    A large table has files enough and is handed back as it is.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if len(df.inputFiles()) < cores else df
