"""A new folder that the driver and all executors share, and the end of such folders."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

#: Folders made within the open cleared() blocks, the innermost last.
_OPEN: list[list[str]] = []


def scratch(spark: SparkSession) -> str:
    """Under spark.checkpoint.dir. Where that is unset, a local folder is made, which only a local master can share."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = "file://" + tempfile.mkdtemp(prefix="spark-country-")
        spark.sparkContext.setCheckpointDir(root)
    path = f"{root.rstrip('/')}/country-{uuid.uuid4().hex}"
    if _OPEN:
        _OPEN[-1].append(path)
    return path


def settled(df: DataFrame) -> DataFrame:
    """df as a written table: what reads it often doesn't make it anew, and lost executors don't either."""
    path = scratch(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def large(df: DataFrame) -> DataFrame:
    """df, which joins don't broadcast, unless the other side is F.broadcast(): written tables look small, as their files are
    compressed, but a broadcast table goes through the driver as it is."""
    return df.hint("merge")


@contextmanager
def cleared(spark: SparkSession) -> Iterator[None]:
    """Removes the folders that scratch() and settled() make in the block at its end; what reads them must be done by then."""
    _OPEN.append([])
    try:
        yield
    finally:
        for path in _OPEN.pop():
            where = spark._jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
