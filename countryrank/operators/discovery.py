"""Folding overlapping discovery pages into owners, and counting what was covered. `seq` is the order of arrival."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .ranking import weight

UNRESOLVED_KEPT = 500


def owner_dedupe(hits: DataFrame, key_cols: list[str] | None = None) -> DataFrame:
    """One row per accepted owner: first profile, latest non-null id, sorted distinct terms, strongest attribution."""
    keys = key_cols or ["login"]
    return hits.filter("accepted").groupBy(*keys).agg(
        F.min_by("location", "seq").alias("location"), F.max_by("id", F.when(F.col("id").isNotNull(), F.col("seq"))).alias("id"),
        F.array_sort(F.collect_set("search_term")).alias("terms"),
        F.max_by("confidence", F.struct(weight(F.col("confidence")), -F.col("seq"))).alias("confidence"),
        F.max_by("evidence", F.struct(weight(F.col("confidence")), -F.col("seq"))).alias("evidence"), F.count("*").alias("hits"),
    )


def owner_rejects(hits: DataFrame, key_cols: list[str] | None = None) -> DataFrame:
    """Owners that were never accepted, with the last location and reason: one fold decides both."""
    keys = key_cols or ["login"]
    last = hits.groupBy(*keys).agg(F.bool_or("accepted").alias("_a"), F.max_by(F.struct("location", F.col("evidence").alias("reason")), "seq").alias("_l"))
    return last.filter("NOT _a").select(*keys, "_l.location", "_l.reason")


def owner_repo_join(owners: DataFrame, batches: DataFrame, key_cols: list[str] | None = None) -> DataFrame:
    """Repository rows of owners that are already accepted."""
    return batches.join(owners.select(*(key_cols or ["login"])), key_cols or ["login"], "left_semi")


def coverage_counts(hits: DataFrame, candidates: DataFrame, repositories: DataFrame, stats: DataFrame, country_col: str = "country", limit: int = 100) -> DataFrame:
    """Per country: raw hits, accepted and rejected owners, candidates and their threshold, repositories considered and
    published, and capped terms."""
    owners = hits.groupBy(country_col, "login").agg(F.bool_or("accepted").alias("a"), F.count("*").alias("n"))
    base = owners.groupBy(country_col).agg(F.sum("n").alias("raw_hits"), F.count_if("a").alias("accepted_owners"), F.count_if(~F.col("a")).alias("rejected_owners"))
    chosen = candidates.groupBy(country_col).agg(F.count("*").alias("candidate_owners"), F.min("top_stars").alias("threshold"))
    repos = repositories.groupBy(country_col).agg(F.count_distinct("name_with_owner").alias("considered"))
    capped = stats.groupBy(country_col).agg(F.count_if("capped").alias("capped_terms"))
    out = base.join(chosen, country_col, "left").join(repos, country_col, "left").join(capped, country_col, "left")
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    return out.select(country_col, "raw_hits", "accepted_owners", "rejected_owners", zero("candidate_owners"), "threshold", zero("considered"), F.least(F.coalesce("considered", F.lit(0)), F.lit(limit)).alias("published"), zero("capped_terms"))


def certified_coverage(ranked: DataFrame, pool: DataFrame, country_col: str = "country", owner_col: str = "owner") -> DataFrame:
    """Per country: unique owners and least stars of the published list, its length, and the size of the pool."""
    top = ranked.groupBy(country_col).agg(F.count_distinct(owner_col).alias("unique_owners"), F.min("stars").alias("cut_off"), F.count("*").alias("published"))
    return top.join(pool.groupBy(country_col).agg(F.count("*").alias("pool_size")), country_col)


def query_stats(summaries: DataFrame, key_cols: list[str] | None = None) -> DataFrame:
    """The latest summary of each term; capped if it left queries unresolved."""
    keys = key_cols or ["term"]
    rest = [c for c in summaries.columns if c not in (*keys, "seq")]
    last = summaries.groupBy(*keys).agg(F.max_by(F.struct(*rest), "seq").alias("_s")).select(*keys, "_s.*")
    return last.withColumn("capped", F.coalesce(F.size("unresolved"), F.lit(0)) > 0)


def discovery_stats(summaries: DataFrame, country_col: str = "country") -> DataFrame:
    """Terms, requests, pages, splits and hits of each country."""
    total = lambda c: F.sum(F.coalesce(c, F.lit(0))).alias(c)
    return summaries.groupBy(country_col).agg(F.count("*").alias("terms"), total("requests"), total("pages"), F.count_if("sharded").alias("splits"), total("raw_hits"), total("accepted"), total("rejected"))


def discovery_terms(config: DataFrame) -> DataFrame:
    """Search and geography terms of each country: the first spelling of each key, without ambiguous terms unless the
    country's own alias. config: (code, kind, term, norm, seq) with kinds search, geography, ambiguous, alias."""
    rank = F.when(F.col("kind") == "search", F.lit(0)).otherwise(F.lit(1))
    some = config.filter(F.col("kind").isin("search", "geography") & (F.col("norm") != ""))
    first = some.groupBy("code", "norm").agg(F.min_by("term", F.struct(rank, "seq", "term")).alias("term"))
    key = lambda k: config.filter(F.col("kind") == k).select("code", "norm").distinct()
    bad = key("ambiguous").join(key("alias"), ["code", "norm"], "left_anti")
    return first.join(bad, ["code", "norm"], "left_anti").select("code", "norm", "term")


def state_reconcile(current: DataFrame, states: DataFrame, version: int = 2) -> DataFrame:
    """Each country's state for (code, cycle, sha256, terms_total): kept if nothing changed, else begun anew. Candidates
    stay in either case. states: (code, schema_version, cycle, sha256, terms_total, next_term_index, phase, candidates)."""
    old = states.select(F.col("code").alias("_code"), *[F.col(c).alias(f"_{c}") for c in states.columns if c != "code"])
    same = (F.col("_schema_version") == version) & F.col("_cycle").eqNullSafe(F.col("cycle")) & F.col("_sha256").eqNullSafe(F.col("sha256")) & F.col("_terms_total").eqNullSafe(F.col("terms_total"))
    kept = F.coalesce(same, F.lit(False))
    return current.join(old, F.col("code") == F.col("_code"), "left").select(
        "code", "cycle", "sha256", "terms_total", kept.alias("kept"), F.when(kept, F.coalesce("_next_term_index", F.lit(0))).otherwise(F.lit(0)).cast("bigint").alias("next_term_index"),
        F.when(kept, F.coalesce("_phase", F.lit("discovery"))).otherwise(F.lit("discovery")).alias("phase"), F.coalesce("_candidates", F.lit(0)).cast("bigint").alias("candidates"),
    )


def unresolved_shards(shards: DataFrame, country_col: str = "country", most: int = UNRESOLVED_KEPT) -> DataFrame:
    """Distinct (term, query, reason) of each country, the `most` newest; a repeat keeps its first arrival."""
    first = shards.groupBy(country_col, "term", "query", "reason").agg(F.min("seq").alias("seq"))
    w = Window.partitionBy(country_col).orderBy(F.desc("seq"), "term", "query", "reason")
    return first.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") <= most).drop("_r")


def shard_summary(queries: DataFrame, term_cols: list[str] | None = None) -> DataFrame:
    """Per term: queries, leaves, pages, rows reported by leaves, whether it was split, unresolved queries.

    queries: (term, capped, final, reported, pages): a capped query that isn't final was split.
    """
    leaf = ~F.col("capped")
    return queries.groupBy(*(term_cols or ["term"])).agg(
        F.count("*").alias("queries"), F.count_if(leaf).alias("leaves"), F.sum(F.when(leaf, F.col("pages")).otherwise(0)).alias("pages"),
        F.sum(F.when(leaf, F.col("reported")).otherwise(0)).alias("reported"), F.bool_or(F.col("capped") & ~F.col("final")).alias("sharded"), F.count_if(F.col("capped") & F.col("final")).alias("unresolved"),
    )
