"""Sinks: partitioned tables, and nested documents per country."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import certify, discovery, ranking
from .readers import CURRENT
from .scratch import settled
from .versions import Versions

LEAST_COUNTRIES = 240
SCHEMA_VERSION = 1


def ranking_documents(ranked: DataFrame, catalogue: DataFrame, coverage: DataFrame, source: dict[str, str], generated_at: str, methodology: str = CURRENT, country_col: str = "country") -> DataFrame:
    """(country, document): the published document of each country of the catalogue as one JSON text.

    coverage has a row for each country; its columns are the counters of the document. The list of a country holds at
    most its ranking limit.
    """
    rest = ["rank", *[c for c in ranked.columns if c not in ("rank", country_col)]]
    lists = ranked.groupBy(F.col(country_col).alias("code")).agg(F.array_sort(F.collect_list(F.struct(*rest))).alias("repositories"))
    counters = coverage.select(F.col(country_col).alias("code"), F.struct(*[F.col(c) for c in coverage.columns if c != country_col]).alias("coverage"))
    whole = lists.join(counters, "code", "left").join(catalogue.select("code", "name", "slug"), "code")
    parts = F.struct(
        F.lit(SCHEMA_VERSION).alias("schemaVersion"), F.lit(methodology).alias("methodologyVersion"), F.lit(generated_at).alias("generatedAt"), F.struct("code", "name", "slug").alias("country"),
        F.struct(*[F.lit(v).alias(k) for k, v in source.items()]).alias("source"), "coverage", "repositories",
    )
    return whole.select(F.col("code").alias(country_col), F.to_json(parts).alias("document"))


def write_rankings(documents: DataFrame, path: str, country_col: str = "country") -> None:
    """One folder for each country with its document, a JSON text; countries that documents hasn't stay as they are."""
    rows = documents.select(F.col(country_col).alias("country_code"), F.col("document").alias("value")).repartition("country_code")
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("country_code").text(path)


CERTIFIED = "country string, threshold bigint, frontier bigint, certified_at string"


def certified(spark: SparkSession, path: str) -> Versions:
    """The countries that publish_certified() has certified."""
    return Versions(spark, f"{path}/certified", CERTIFIED, "country")


def publish_certified(pool: DataFrame, frontier: DataFrame, catalogue: DataFrame, path: str, now: str, run: int, source: dict[str, str], limit: int = ranking.RANKING_LIMIT) -> DataFrame:
    """Certifies the countries of a pool at a frontier and writes the documents of those that are certified for the first time,
    below path; returns these countries. Others' documents stay as they are, and a run without new ones writes none.

    Documents come before the table of the certified, so a run that stops between them is made up for by the next one.
    """
    spark = pool.sparkSession
    table = certified(spark, path)
    before = table.read(run)
    present = certify.certify_countries(pool, frontier, before.select("country", "certified_at"), now, limit=limit)
    fresh = settled(certify.newly_certified(present, before).select("country", "threshold", "frontier", "certified_at"))
    if table.committed(run) or not fresh.limit(1).count():
        return fresh.limit(0) if not table.committed(run) else table.read(run + 1).join(before, "country", "left_anti")
    mine = settled(pool.join(F.broadcast(fresh.select("country")), "country", "left_semi"))  # at most the catalogue's countries
    ranked = ranking.rank_repositories(mine, limit=limit)
    coverage = discovery.certified_coverage(ranked, mine).join(fresh.select("country", "frontier"), "country")
    write_rankings(ranking_documents(ranked.select("country", "rank", "name_with_owner", "stars"), catalogue, coverage, source, now), f"{path}/rankings")
    table.replace(fresh, run)
    table.vacuum()
    return fresh


def certified_documents(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The documents that publish_certified() has written below path, read by a schema; no rows while no country is certified."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/rankings")
    if not folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).json(f"{path}/rankings")


def geo_index_rows(terms: DataFrame) -> DataFrame:
    """(code, kind, terms): the sorted term lists of each country. terms: (code, kind, norm, term)."""
    return terms.groupBy("code", "kind").agg(F.transform(F.array_sort(F.collect_set(F.struct("norm", "term"))), lambda x: x["term"]).alias("terms"))


def write_geo_index(terms: DataFrame, path: str, least: int = LEAST_COUNTRIES) -> None:
    """Index lists by country; refuses to publish fewer than `least` countries."""
    n = terms.select("code").distinct().limit(least).count()
    if n < least:
        raise ValueError(f"refusing to publish {n} countries, fewer than {least}")
    geo_index_rows(terms).write.mode("overwrite").partitionBy("code").parquet(path)


def write_state(state: DataFrame, path: str, country_col: str = "country", version: int | None = None) -> Versions:
    """Replaces the countries that state holds, as the next version of the table at path or as a given one; others stay as
    they are. The version becomes visible whole, see Versions, and older ones go, so that the folder is plain Parquet too."""
    store = Versions(state.sparkSession, path, state.schema, country_col)
    known = store.versions()
    store.replace(state.repartition(country_col), (known[-1] + 1 if known else 0) if version is None else version)
    store.vacuum(keep=1)
    return store


def write_named(documents: DataFrame, path: str, name_col: str, value_col: str, ending: str = ".json") -> None:
    """One file <name><ending> in the folder for each document, replacing those of the same names. Documents are as many as the
    catalogue has countries; tasks write them, and their files are then renamed one by one."""
    spark = documents.sparkSession
    make = spark._jvm.org.apache.hadoop.fs.Path
    hidden = make(f"{path}/.{uuid.uuid4().hex}")
    rows = documents.select(F.col(name_col).alias("_file"), F.col(value_col).alias("value"))
    rows.repartition("_file").write.partitionBy("_file").text(hidden.toString())
    files = hidden.getFileSystem(spark._jsc.hadoopConfiguration())
    for folder in files.listStatus(hidden):
        name = folder.getPath().getName()
        if name.startswith("_file="):
            part = next(f.getPath() for f in files.listStatus(folder.getPath()) if f.getPath().getName().startswith("part-"))
            end = make(f"{path}/{name.removeprefix('_file=')}{ending}")
            files.delete(end, False)
            files.rename(part, end)
    files.delete(hidden, True)


def write_once(df: DataFrame, path: str) -> bool:
    """df as a folder that appears by a rename, whole; False if it is there already, and nothing is written."""
    make, spark = df.sparkSession._jvm.org.apache.hadoop.fs.Path, df.sparkSession
    end = make(path)
    files, hidden = end.getFileSystem(spark._jsc.hadoopConfiguration()), make(f"{end.getParent()}/.{uuid.uuid4().hex}")
    if files.exists(end):
        return False
    df.write.parquet(hidden.toString())
    return bool(files.rename(hidden, end))
