"""Session construction and lineage helpers.

The library never sets cluster-wide options itself; ``build_session`` is for
tests, the benchmark and local runs.  On a cluster the caller's session is used
as is, and ``spark.checkpoint.dir`` (a shared, reliable folder) is read from it.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def build_session(master: str | None = None, shuffle_partitions: int = 8,
                  checkpoint_dir: str | None = None, app: str = "clickseg") -> SparkSession:
    """Local session with AQE on, UI off and UTC as the session zone."""
    cpus = os.environ.get("BENCH_CPUS", "8")
    builder = (
        SparkSession.builder.master(master or f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if checkpoint_dir:
        builder = builder.config("spark.checkpoint.dir", checkpoint_dir)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared checkpoint folder named by the session, if any."""
    d = spark.conf.get("spark.checkpoint.dir", None)
    if d and spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(d)
    return d or spark.sparkContext.getCheckpointDir()


def scratch_dir(spark: SparkSession, prefix: str) -> str:
    """A new folder's path for intermediate tables: under the session's checkpoint folder,
    or a local one where a local session has none."""
    root = checkpoint_dir(spark)
    if root is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
        root = tempfile.gettempdir()
    return f"{root.rstrip('/')}/{prefix}_{uuid.uuid4().hex}"


def materialize(df: DataFrame) -> DataFrame:
    """Cut lineage for a frame that is reused many times (K-Means input).

    With a checkpoint folder configured the frame is written there (survives
    executor loss without recomputing the cleaning chain); otherwise it is
    persisted in memory and on disk and lost blocks are recomputed from lineage.
    """
    if checkpoint_dir(df.sparkSession):
        return df.checkpoint(eager=True)
    return kept(df)


def kept(df: DataFrame) -> DataFrame:
    """Persist a frame that several results read; :func:`released` lets it go."""
    df = df.persist(StorageLevel.MEMORY_AND_DISK)
    held = _held.get()
    if held is not None:
        held.append(df)
    return df


_held: ContextVar[list[DataFrame] | None] = ContextVar("held", default=None)


@contextmanager
def released():
    """Unpersist on exit what :func:`kept` and :func:`materialize` persisted inside the block.

    For jobs that have written their results by then; frames read later are
    computed again.  Blocks nest, each releases its own frames.
    """
    held: list[DataFrame] = []
    token = _held.set(held)
    try:
        yield
    finally:
        _held.reset(token)
        for df in held:
            df.unpersist()


def delete_paths(spark: SparkSession, paths: list[str]) -> None:
    """Delete folders of any file system that the session reads."""
    for path in paths:
        p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def broadcast_if_small(df: DataFrame, max_rows: int = 100_000) -> DataFrame:
    """Materialize a small side, count it, and hint broadcast only below ``max_rows``.

    Above the bound the frame is returned as is and the join shuffles (AQE
    splits skewed partitions).
    """
    df = materialize(df)
    return F.broadcast(df) if df.count() <= max_rows else df


def scale_conf(input_bytes: int, split_bytes: int = 512 * 1024 ** 2,
               shuffle_bytes: int = 1024 ** 3, max_shuffle_partitions: int = 100_000
               ) -> dict[str, str]:
    """Spark settings sized for an input of ``input_bytes`` (pass to the session builder).

    Scan splits of ``split_bytes``.  Shuffle partitions: about one per
    ``shuffle_bytes`` of input, capped, because map tasks times reduce
    partitions is the number of shuffle blocks (too many makes every fetch
    tiny); the aggregates combine on the map side, so most shuffles carry far
    less than the input, and AQE coalesces partitions toward the advisory size
    and splits skewed join partitions at runtime.  ``spark.checkpoint.dir`` is
    left to the cluster (a shared, reliable folder).
    """
    shuffle = min(max_shuffle_partitions, max(200, -(-input_bytes // shuffle_bytes)))
    return {
        "spark.sql.files.maxPartitionBytes": str(split_bytes),
        "spark.sql.shuffle.partitions": str(shuffle),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(256 * 1024 ** 2),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.localShuffleReader.enabled": "true",
    }
