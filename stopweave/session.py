"""Session settings, and tables kept between steps."""

from __future__ import annotations

import math
import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_MB = 1024 * 1024


#: Reading tasks times shuffle partitions is the number of shuffle blocks a
#: cluster has to track; beyond this many of each, partitions grow instead.
_MOST_PARTITIONS = 100_000


def settings(input_bytes: int, cores: int, partition_mb: int = 256) -> dict[str, str]:
    """Settings for jobs reading ``input_bytes`` on ``cores`` cores.

    Shuffle partitions have ``partition_mb`` of input and are never fewer than
    the cores. Above 100,000 of them, that is 25 TB, they grow, to 1 GB at 100 TB,
    and sorts spill to disk instead of the driver tracking too many blocks; adaptive execution merges small ones, splits
    skewed ones and broadcasts a join side only after measuring it.
    """
    size = max(partition_mb * _MB, math.ceil(input_bytes / _MOST_PARTITIONS))
    return {
        "spark.sql.shuffle.partitions": str(max(cores, math.ceil(input_bytes / size))),
        "spark.sql.files.maxPartitionBytes": str(size),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_mb // 2 * _MB),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
    }


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors reach, as named by ``spark.checkpoint.dir``.

    A single-machine session without one gets a temporary folder.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if not re.fullmatch(r"local(\[.*\])?", context.master):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    folder = context.getCheckpointDir()
    if folder is None:
        context.setCheckpointDir(tempfile.mkdtemp(prefix="stopweave-"))
        folder = context.getCheckpointDir()
    return folder.rstrip("/")


def stored(df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder and read back.

    For tables read many times, as in model fitting: the steps before are not
    run again, also not after a lost executor, and readers take only the
    columns they need.
    """
    path = f"{_folders[-1] if _folders else shared_folder(df.sparkSession)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Of tables stored inside, the shuffle files go as soon as a table is written, not when the driver's garbage is collected."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


#: Folders of the jobs that run now, the innermost last.
_folders: list[str] = []


@contextmanager
def job_tables(spark: SparkSession) -> Iterator[str]:
    """Tables stored inside are removed at the end, also after an error."""
    folder = f"{shared_folder(spark)}/job-{uuid.uuid4().hex}"
    _folders.append(folder)
    try:
        yield folder
    finally:
        _folders.remove(folder)
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
