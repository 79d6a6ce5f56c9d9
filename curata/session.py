"""Session settings and durable intermediate results."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession

#: Rows of a partition that wide sorts or large aggregates run over.
TASK_ROWS = 1 << 18
#: Rows of a file of a settled table whose rows are few bytes. Spark takes a file for 4 MB at least and gives a task 128 MB, so 32 files at most.
FILE_ROWS = 1 << 15
#: The same for rows of a hundred columns and more, a thousand bytes and more each: a task reads at most half of ``TASK_ROWS`` of them.
WIDE_ROWS = TASK_ROWS >> 6

# Settings the operators rely on; the cluster's own values win where they are already set.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, **conf: str) -> SparkSession:
    """A local session for tests and benchmarks."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("curata")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder of the session; a temporary one only on a local master."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        shared = tempfile.mkdtemp(prefix="curata-checkpoint-")
    spark.sparkContext.setCheckpointDir(shared)
    return shared


_tracked: list[list[tuple[SparkSession, str]]] = []


def own_folder(spark: SparkSession, kind: str) -> str:
    """The path of a new folder in the shared checkpoint folder; it goes at the end of the ``stages`` block it was named in."""
    path = f"{ensure_checkpoint_dir(spark)}/{kind}-{uuid.uuid4().hex}"
    for block in _tracked:
        block.append((spark, path))
    return path


def settle(df: DataFrame, file_rows: int = 0) -> DataFrame:
    """Write ``df`` once as a table in the shared checkpoint folder and go on from it.

    For results that several branches read: they are computed once, are the same in every branch, also
    after an executor was lost, and come back with a known size and prunable columns. Runs a job at once. The table stays
    until the folder is cleared, or until the end of the ``stages`` block it was written in.

    ``file_rows`` limits the rows of a file. A task that reads gets files by their bytes, and holds what it sends to many others in memory, so
    rows of which a few bytes are thousands there should be laid in files of ``FILE_ROWS``, or ``WIDE_ROWS``.
    """
    spark = df.sparkSession
    path = own_folder(spark, "settled")
    writer = df.write.option("maxRecordsPerFile", file_rows) if file_rows else df.write
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def once(df: DataFrame) -> DataFrame:
    """``df``, settled if its plan shuffles; for a frame that is about to be read twice.

    Reading and filtering a table again costs less than writing it; joins and aggregates cost more, and doubling them
    at every step of a plan multiplies.
    """
    return settle(df, FILE_ROWS) if "Exchange" in df._jdf.queryExecution().executedPlan().toString() else df


def dealt(df: DataFrame, rows: int, *keys: Column | str) -> DataFrame:
    """``df`` by ``keys`` in as many partitions as its ``rows`` rows, there or about to be made of it, need.

    What a task holds then does not grow with the table. Spark alone merges partitions by their bytes as written, and some tens of those can be
    thousands in memory: mostly empty columns and runs of hours shrink to almost nothing on the way.
    """
    return df.repartition(max(-(-rows // TASK_ROWS), df.sparkSession.sparkContext.defaultParallelism), *keys)


@contextmanager
def stages() -> Iterator[None]:
    """Drop the tables settled and the folders named inside the block at its end; results must be written by then."""
    block: list[tuple[SparkSession, str]] = []
    _tracked.append(block)
    try:
        yield
    finally:
        _tracked[:] = [b for b in _tracked if b is not block]  # blocks of equal content are not the same block
        for spark, path in block:
            folder = spark._jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
