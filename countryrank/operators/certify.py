"""Certifying rankings once an unfinished scan can no longer change them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .ranking import RANKING_LIMIT, pool_threshold


def star_frontier(queue: DataFrame, unresolved: DataFrame) -> DataFrame:
    """One row (frontier): the most stars that unseen rows may have. queue: (max_stars), unresolved: (stars)."""
    both = queue.select(F.col("max_stars").alias("s")).union(unresolved.select("stars"))
    return both.agg(F.coalesce(F.max("s"), F.lit(0)).cast("bigint").alias("frontier"))


def certify_countries(pool: DataFrame, frontier: DataFrame, certified: DataFrame, now: str, country_col: str = "country", limit: int = RANKING_LIMIT) -> DataFrame:
    """(country, threshold, frontier, certified_at): certified when the limit-th repository has more stars than the
    frontier; the first certification stays. certified: (country, certified_at) so far."""
    front = F.broadcast(frontier)  # one row
    sized = pool_threshold(pool, country_col, limit).join(certified, country_col, "left").join(front, F.lit(True), "left")
    fresh = F.when(F.col("threshold") > F.col("frontier"), F.lit(now))
    return sized.select(country_col, F.col("threshold").cast("bigint").alias("threshold"), "frontier", F.coalesce("certified_at", fresh).alias("certified_at"))


def newly_certified(present: DataFrame, before: DataFrame, country_col: str = "country") -> DataFrame:
    """Rows of certify_countries() whose country is certified now and wasn't before. before: (country, certified_at)."""
    known = before.filter("certified_at IS NOT NULL").select(country_col)
    return present.filter("certified_at IS NOT NULL").join(known, country_col, "left_anti")


def changed_countries(batch: DataFrame, country_col: str = "country") -> DataFrame:
    """Countries that a batch touches."""
    return batch.select(country_col).distinct()
