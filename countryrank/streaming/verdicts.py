"""Verdicts on locations as lookup state of a stream: a table by normalised location that only unseen locations extend.

The key of a location holds all that its verdict depends on: its ordered candidates, or, as it may be a country's code, the
two letters that it is. Writings that differ in case, accents and signs share a key, and each key is resolved once for as
long as the resolver's version stays. Another version has a table of its own, so nothing of an older one is found.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text
from ..operators import attribution
from ..sources.scratch import large, settled
from ..sources.versions import Versions

RESOLVER_VERSION = 2
WORLD = "key string, attribution struct<accepted:boolean,country_code:string,confidence:string,evidence:string,matched:string,conflicts:array<string>>"
TARGET = "key string, code string, attribution struct<accepted:boolean,country_code:string,confidence:string,evidence:string,matched:string,conflicts:array<struct<code:string,name:string>>>"


def table(spark: SparkSession, path: str, schema: str = WORLD, resolver_version: int = RESOLVER_VERSION) -> Versions:
    return Versions(spark, f"{path}/resolver={resolver_version}", schema)


def location_key() -> Column:
    """Of the rows of attribution.location_keys()."""
    return F.when(F.rlike("raw", F.lit("^[A-Za-z]{2}$")), F.concat(F.lit("="), "raw")).otherwise(F.array_join("candidates", "|"))


def judged(rows: DataFrame, store: Versions, resolve: Callable[[DataFrame], DataFrame], version: int) -> DataFrame:
    """rows (location, and code where the table has it) with `attribution`. What the table lacks is resolved and appended to it
    as `version`; run again with the same version, it gives the same rows.

    resolve(df) has the columns of df, distinct, and `attribution`.
    """
    by = [c for c in ("code",) if c in store.schema.names]
    bare = text.trimmed(F.coalesce(F.col("location"), F.lit(""))) == ""
    told = rows.filter(~bare)
    keys = attribution.location_keys(told).withColumn("key", location_key()).select("location", "raw", "key")
    wanted = large(settled(told.select("location", *by).distinct().join(large(keys), "location")))
    unseen = wanted.groupBy("key", *by).agg(F.min("raw").alias("location")).join(large(store.read(version).select("key", *by)), ["key", *by], "left_anti")
    unseen = large(settled(unseen))
    store.append(unseen.join(resolve(unseen.select("location", *by)), ["location", *by]).select("key", *by, "attribution"), version)
    verdicts = wanted.join(store.read(version + 1), ["key", *by]).select("location", *by, "attribution")
    done = told.join(large(verdicts), ["location", *by]).select(*rows.columns, "attribution")
    missing = attribution.missing(store.schema["attribution"].dataType)
    return done.unionByName(rows.filter(bare).withColumn("attribution", missing).select(*done.columns))
