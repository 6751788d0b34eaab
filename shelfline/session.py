"""Session set-up and the one place that decides where intermediate files go."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"
FILES_PER_CORE = 4
# With these, shuffle files go when the job that made them ends, not when the driver happens to collect its garbage.
DROP_SHUFFLES = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}


def local_session(cores: str = "*", shuffle_partitions: int = 8, driver_memory: str = "20g") -> SparkSession:
    """Session for tests and the bench; on a cluster the caller brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("shelfline")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", driver_memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Session settings that hold inside the block only."""
    before = {key: spark.conf.get(key, None) for key in values}
    try:
        for key, value in values.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: the one the cluster names, or a temporary one in local mode.

    A cluster without that setting is an error, because a machine-local folder would be lost
    together with the executor that wrote it.
    """
    named = spark.conf.get(CHECKPOINT_KEY, None)
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_KEY} to a folder all executors share")
    local = os.path.join(tempfile.gettempdir(), f"shelfline-{os.getpid()}")
    os.makedirs(local, exist_ok=True)
    return local


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame, ids: bool = False) -> DataFrame:
    """Reliable checkpoint: survives executor loss, unlike cached or local blocks.

    `ids`: rows of a few numbers, which go to FILES_PER_CORE files for each core of the cluster at most
    instead of one for each shuffle partition. On a local disk an executor starts a process (chmod) several
    times per file, and until that process runs its own program it shares the whole memory of the executor."""
    context = df.sparkSession.sparkContext
    if ids:
        df = df.coalesce(FILES_PER_CORE * context.defaultParallelism)
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint(eager=True)
