"""Session settings the jobs are written for, and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Adaptive execution picks partition counts, join sides and skew splits at run time,
# so no job sets a partition number of its own.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.ui.enabled": "false",
    # Shuffle and spill files take about half the disk they take with lz4.
    "spark.io.compression.codec": "zstd",
}


def build_session(app: str, master: str | None = None, extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **(extra or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


#: Folder named by a program for sessions without ``spark.checkpoint.dir``.
_named: list[str] = []
#: Paths of the tables written so far and not deleted.
_written: list[str] = []


def name_own_folder(spark: SparkSession) -> None:
    """Name a temporary folder for a local trial session without ``spark.checkpoint.dir``.

    For programs that start jobs on one machine (checks, trials), never called by a job.
    """
    if not _named and not spark.conf.get("spark.checkpoint.dir", None) and spark.sparkContext.master.startswith("local"):
        _named.append(tempfile.mkdtemp(prefix="ledgerloom-"))


def shared_folder(spark: SparkSession) -> str:
    """Folder all executors see: ``spark.checkpoint.dir``, else the one a program named."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or next(iter(_named), None)
    if not folder:
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    return folder.rstrip("/")


#: Deletes the shuffle files of a query when it ends, not when the driver happens to collect garbage.
FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def written_table(df: DataFrame, label: str, compact: bool = False) -> DataFrame:
    """Write ``df`` once as parquet in the shared folder and read it back.

    Fixes row placement and cuts lineage: a lost executor later on costs a re-read of
    files, never a recomputation that could place rows differently. The table stays until
    ``drop_written``, or until the end of the ``scratch`` block it was written in.
    ``compact`` is for large steps of a job: the files are packed tighter, and what was
    shuffled to write them leaves the disk before the next step.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"
    if compact:
        before = spark.conf.get(FREE_SHUFFLES, "false")
        spark.conf.set(FREE_SHUFFLES, "true")
        try:
            df.write.option("compression", "zstd").parquet(path)
        finally:
            spark.conf.set(FREE_SHUFFLES, before)
    else:
        df.write.parquet(path)
    _written.append(path)
    return spark.read.schema(df.schema).parquet(path)


def own_path(spark: SparkSession, label: str) -> str:
    """A new path in the shared folder, deleted like the tables of ``written_table``."""
    path = f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"
    _written.append(path)
    return path


def drop_written(spark: SparkSession, keep: int = 0) -> None:
    """Delete the tables written by ``written_table``, but for the first ``keep``."""
    conf = spark._jsparkSession.sessionState().newHadoopConf()
    while len(_written) > keep:
        path = spark._jvm.org.apache.hadoop.fs.Path(_written[-1])
        path.getFileSystem(conf).delete(path, True)
        _written.pop()


def written_count() -> int:
    return len(_written)


def drop_but_last(spark: SparkSession, keep: int) -> None:
    """Delete the tables written after the first ``keep``, but for the last one."""
    last = _written.pop()
    drop_written(spark, keep)
    _written.append(last)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Tables written inside are deleted on leaving; an error leaves them to be looked at."""
    before = len(_written)
    yield
    drop_written(spark, before)
