"""Small helpers shared by the corpus operators."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words are runs of characters other than ASCII white space.
SPACE = "[\\x20\\x09-\\x0D]+"
SPACE_CHARS = " \t\n\x0b\x0c\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words(text: Column) -> Column:
    """Array of the words of a text; empty for null or blank texts."""
    bare = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACE_CHARS))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, SPACE, -1))


def fold(text: Column) -> Column:
    """Lower-cases A-Z and leaves every other character alone."""
    return F.translate(text, UPPER, LOWER)


def let(value: Column, body) -> Column:
    """body(value), with value computed once for each row even where body uses it in lambdas."""
    return F.transform(F.array(value), body).getItem(0)


def shared_dir(spark: SparkSession) -> str:
    """A new folder under spark.checkpoint.dir; a local one is set only where that is unset, as in tests."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        root = "file://" + tempfile.mkdtemp(prefix="spark-corpus-")
        spark.sparkContext.setCheckpointDir(root)
    return f"{root.rstrip('/')}/corpus-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """df as a Parquet table in the shared folder: cuts lineage, and any executor can read it again."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small(df: DataFrame, row_bytes: int, limit_bytes: int = 8 << 20) -> tuple[bool, int]:
    """Whether df is known to stay under limit_bytes when broadcast, and its rows; reads no more rows than decide it."""
    n = df.limit(limit_bytes // row_bytes + 1).count()
    return n * row_bytes <= limit_bytes, n


def sliced(batches: Iterator, rows: int = 500) -> Iterator:
    """The same Arrow batches in slices of at most `rows` rows; Spark bounds the bytes of a batch."""
    for b in batches:
        for i in range(0, b.num_rows, rows):
            yield b.slice(i, rows)


def small_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Bounds the rows that enter Python at once. Queries and stages call it on their session; operators leave that alone."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= rows:
        spark.conf.set(name, str(rows))


def fresh(taken: list[str], *names: str) -> list[str]:
    """The names with as many underscores behind them as make them differ from those that are taken, in any case."""
    used, out = {t.lower() for t in taken}, []
    for n in names:
        while n.lower() in used:
            n += "_"
        used.add(n.lower())
        out.append(n)
    return out
