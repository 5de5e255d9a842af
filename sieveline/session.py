"""Session helpers: where durable intermediate data goes, and how wide scans run."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named in ``spark.checkpoint.dir``.

    A session whose executors are threads of this very process, as in tests, may
    leave it unset and gets a temporary one; on a cluster that is an error.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if named is None:
        if not re.fullmatch(r"local(\[.*\])?", context.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        named = tempfile.mkdtemp(prefix="sieveline-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(named)
    return named


def work_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder below :func:`shared_dir`."""
    return f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def spread(df: DataFrame) -> DataFrame:
    """Use every core on an input that arrives in fewer splits than there are cores.

    A large table has splits enough and passes through with no shuffle.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back.

    For results that several steps read: they are computed once, survive the loss
    of executors, and can be pruned by column and by file statistics.
    """
    path = work_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def has_table(spark: SparkSession, path: str) -> bool:
    """Whether a Parquet table was written at ``path``."""
    try:
        spark.read.parquet(path)
    except AnalysisException:
        return False
    return True
