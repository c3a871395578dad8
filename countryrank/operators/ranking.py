"""Repositories and owners: one row each, ranked, cut and merged. Ties: owner cuts keep them, repository cuts don't."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

RANKING_LIMIT = 100
POOL_LIMIT = 500
REPOSITORY_POOL = 125


def by_name(name: Column) -> Column:
    """Names in the order of the root locale, not of their bytes."""
    return F.collate(name, "UNICODE")


def repository_order(name_col: str = "name_with_owner") -> list[Column]:
    """Most stars first, then most forks, then by name."""
    return [F.desc(F.coalesce(F.col("stars"), F.lit(0))), F.desc(F.coalesce(F.col("forks"), F.lit(0))), by_name(F.col(name_col)), F.col(name_col)]


def filter_owner_type(df: DataFrame, type_col: str = "typename") -> DataFrame:
    return df.filter(F.col(type_col).isin("User", "Organization"))


def filter_non_fork(df: DataFrame, fork_col: str = "is_fork") -> DataFrame:
    return df.filter(~F.coalesce(F.col(fork_col), F.lit(False)))


def latest_repository(df: DataFrame, key_cols: list[str] | None = None, seq_col: str = "seq") -> DataFrame:
    """The last written row of each repository; the fold keeps one row of each key before the shuffle."""
    keys = key_cols or ["name_with_owner"]
    last = df.groupBy(*keys).agg(F.max_by(F.struct(*[c for c in df.columns if c not in keys]), seq_col).alias("_r"))
    return last.select(*keys, "_r.*").select(*df.columns)


def rank_repositories(df: DataFrame, country_col: str = "country", limit: int = RANKING_LIMIT) -> DataFrame:
    """The `limit` best repositories of each country with their rank from 1. Each task keeps its own best first."""
    w = Window.partitionBy(country_col).orderBy(*repository_order())
    return df.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= limit)


def owner_top_stars(repositories: DataFrame, owner_cols: list[str]) -> DataFrame:
    """Most stars of each owner's repositories, 0 at least; owners without repositories have no row."""
    return repositories.groupBy(*owner_cols).agg(F.greatest(F.lit(0), F.max(F.coalesce("stars", F.lit(0)))).cast("bigint").alias("top_stars"))


def candidate_owners(owners: DataFrame, country_col: str = "country", limit: int = RANKING_LIMIT, stars_col: str = "top_stars") -> DataFrame:
    """Owners at or above the stars of the limit-th one of their country, ties kept."""
    w = Window.partitionBy(country_col).orderBy(F.desc(stars_col))
    return owners.withColumn("_r", F.rank().over(w)).filter(F.col("_r") <= limit).drop("_r")


def candidate_threshold_owners(owners: DataFrame, country_col: str = "country", limit: int = RANKING_LIMIT) -> DataFrame:
    """The least stars of each country's candidate owners, and their number."""
    return candidate_owners(owners, country_col, limit).groupBy(country_col).agg(F.min("top_stars").alias("threshold"), F.count("*").alias("candidates"))


def repo_pool_topk(df: DataFrame, country_col: str = "country", limit: int = REPOSITORY_POOL) -> DataFrame:
    """The best `limit` repositories of each country, without ties and without a rank."""
    return rank_repositories(df, country_col, limit).drop("rank")


def pool_threshold(pool: DataFrame, country_col: str = "country", limit: int = RANKING_LIMIT) -> DataFrame:
    """Stars of the limit-th entry of each country's pool, null if it has fewer."""
    w = Window.partitionBy(country_col).orderBy(*repository_order())
    top = pool.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") <= limit)
    return top.groupBy(country_col).agg(F.max(F.when(F.col("_r") == limit, F.coalesce("stars", F.lit(0)))).alias("threshold"))


def repo_record(df: DataFrame) -> DataFrame:
    """The published shape of raw repository rows with their owner: counts default to 0, empty texts become null."""
    text = lambda c: F.when(F.col(c) != "", F.col(c)).alias(c)
    count = lambda c, to: F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(to)
    return df.select(
        "name_with_owner", count("stargazer_count", "stars"), count("fork_count", "forks"), text("description"), text("homepage_url"),
        F.coalesce("is_archived", F.lit(False)).alias("archived"), F.struct(F.col("owner_login").alias("login"), text("owner_location").alias("location")).alias("owner"),
    )


def probe_candidates(owners: DataFrame, repositories: DataFrame, seq_col: str = "seq") -> DataFrame:
    """Owners that have a repository, with their best one (the earlier of equals) as a struct."""
    best = repositories.groupBy("login").agg(F.max_by(F.struct("name_with_owner", "stars"), F.struct(F.coalesce("stars", F.lit(0)), -F.col(seq_col))).alias("top_repository"))
    return owners.join(best, "login")


def hydrate_pool(pool: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Owners, and their best repositories, out of a pool."""
    repos = pool.filter("top_repository IS NOT NULL").select("login", "top_repository.name_with_owner", "top_repository.stars")
    return pool.drop("top_repository"), repos


#: What an attribution's confidence weighs.
WEIGHTS = {"unknown": 0, "medium": 1, "high": 2}


def weight(confidence: Column) -> Column:
    out = F.lit(0)
    for name, w in WEIGHTS.items():
        out = F.when(confidence == name, F.lit(w)).otherwise(out)
    return out


def pool_merge(existing: DataFrame, fresh: DataFrame, key_cols: list[str] | None = None) -> DataFrame:
    """One row per owner of both pools: latest fields, strongest attribution (the earlier of equals), all terms, and the
    repository with more stars (the newer of equals). Columns: keys, confidence, terms, stars, repository, seq, others."""
    return _merged(existing.withColumn("_p", F.lit(0)).unionByName(fresh.withColumn("_p", F.lit(1))), key_cols)


def pool_fold(rows: DataFrame, key_cols: list[str] | None = None) -> DataFrame:
    """One row per owner of rows that arrived in the order of seq, as pool_merge() would make it of them."""
    return _merged(rows.withColumn("_p", F.lit(0)), key_cols)


def _merged(both: DataFrame, key_cols: list[str] | None) -> DataFrame:
    keys = key_cols or ["country", "login"]
    at = F.struct("_p", "seq")
    special = {*keys, "confidence", "terms", "stars", "repository", "_p"}
    rest = [c for c in both.columns if c not in special]
    stars = F.coalesce("stars", F.lit(0))
    return both.filter("repository IS NOT NULL").groupBy(*keys).agg(
        *[F.max_by(c, at).alias(c) for c in rest],
        F.max_by("confidence", F.struct(weight(F.col("confidence")), -F.col("_p"), -F.col("seq"))).alias("confidence"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("terms")))).alias("terms"),
        F.max_by("stars", F.struct(stars, at)).alias("stars"), F.max_by("repository", F.struct(stars, at)).alias("repository"),
    )


def pool_truncate(pool: DataFrame, country_col: str = "country", limit: int = POOL_LIMIT) -> DataFrame:
    """The best `limit` owners of each country, and all that tie with the last one."""
    return candidate_owners(pool.withColumn("_s", F.coalesce("stars", F.lit(0))), country_col, limit, "_s").drop("_s")


def preview_topk(df: DataFrame, k: int, country_col: str = "country") -> DataFrame:
    """The best k repositories or candidates of each country for its progress page."""
    return rank_repositories(df, country_col, k)


def two_stage_topn(repositories: DataFrame, country_col: str = "country", owner_col: str = "owner", limit: int = RANKING_LIMIT, per_owner: int = 100) -> DataFrame:
    """The ranking by probing each owner's best repository, and expanding only owners that can still matter."""
    some = filter_non_fork(repositories)
    chosen = candidate_owners(owner_top_stars(some, [country_col, owner_col]), country_col, limit).select(country_col, owner_col)
    expanded = some.join(chosen, [country_col, owner_col], "left_semi")
    w = Window.partitionBy(country_col, owner_col).orderBy(*repository_order())
    expanded = expanded.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") <= per_owner).drop("_r")
    return rank_repositories(expanded, country_col, limit)
