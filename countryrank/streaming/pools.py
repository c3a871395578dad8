"""Streams from raw search pages to pools: pages are attributed as they arrive, and fold into the pools of their countries.

Repositories: one stream. A batch is attributed by the verdict table, and its repositories are merged into the stored pools
of the countries that it touches. Owners: two streams. The first attributes hits and folds those of a batch to one row an
owner, which appears as a folder; the second reads these folders one by one and keeps the pools as keyed state.

Every step is numbered by its batch and does nothing the second time, so a stream that stops anywhere and starts again from
its checkpoint gives the same tables. Folders that a batch makes on its way are removed at its end.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import attribution, certify, ranking
from ..sources.scratch import cleared, settled
from ..sources.versions import Versions
from ..sources.writers import write_once
from . import owners, verdicts

REPOSITORIES = "country string, name_with_owner string, owner string, seq bigint, stars bigint, forks bigint, location string, resolver int"
OUTCOMES = "seen bigint, attributed bigint, ambiguous bigint, unknown bigint"
#: Versions between two batches, for what happens to a pool beside its stream.
STEP = 1000
Batch = Callable[[DataFrame, int], None]


def repository_pool(spark: SparkSession, path: str) -> Versions:
    return Versions(spark, f"{path}/repositories", REPOSITORIES, "country")


def owner_pool(spark: SparkSession, path: str) -> Versions:
    return Versions(spark, f"{path}/owners", owners.OWNERS, "country")


def outcomes(spark: SparkSession, path: str) -> Versions:
    """One row for each batch: what became of its repositories."""
    return Versions(spark, f"{path}/outcomes", OUTCOMES)


def merge_repositories(pool: DataFrame, batch: DataFrame) -> DataFrame:
    """The best repositories of both; the later row of a repository counts. A row that fell out can't return."""
    both = pool.unionByName(batch.select(*pool.columns))
    return ranking.repo_pool_topk(ranking.latest_repository(both, ["country", "name_with_owner"]))


def fold_repositories(path: str, catalogue: DataFrame, resolve: Callable[[DataFrame], DataFrame], resolver_version: int = verdicts.RESOLVER_VERSION) -> Batch:
    """A foreachBatch function from rows of readers.read_repo_pages() to the pools below path."""

    def run(batch: DataFrame, batch_id: int) -> None:
        spark, version = batch.sparkSession, batch_id * STEP
        pool, seen = repository_pool(spark, path), outcomes(spark, path)
        if pool.committed(version) and seen.committed(batch_id):
            return
        with cleared(spark):
            rows = ranking.filter_non_fork(batch).select("name_with_owner", F.col("owner_login").alias("owner"), "seq", F.col("stargazer_count").alias("stars"), F.col("fork_count").alias("forks"), F.col("owner_location").alias("location"))
            told, mine, touched = _attributed(settled(rows), path, catalogue, resolve, resolver_version, version)
            pool.replace(merge_repositories(pool.of_keys(touched, version), mine), version)
            seen.append(attribution.attribution_outcomes(told), batch_id)
            for table in (pool, seen):
                table.vacuum()

    return run


def _attributed(rows: DataFrame, path: str, catalogue: DataFrame, resolve: Callable[[DataFrame], DataFrame], resolver_version: int, version: int) -> tuple[DataFrame, DataFrame, list[str]]:
    """rows with verdicts, those that are accepted with their country, and these countries, which the catalogue bounds."""
    known = verdicts.table(rows.sparkSession, path, verdicts.WORLD, resolver_version)
    told = settled(verdicts.judged(rows, known, resolve, version))
    known.vacuum()
    mine = attribution.filter_accepted(told, catalogue).withColumn("country", F.col("attribution.country_code")).withColumn("resolver", F.lit(resolver_version))
    mine = settled(mine)
    return told, mine, [r[0] for r in certify.changed_countries(mine).collect()]


def backfill(spark: SparkSession, path: str, catalogue: DataFrame, resolve: Callable[[DataFrame], DataFrame], resolver_version: int) -> list[str]:
    """Sends the repositories that another version of the resolver has attributed through attribution again, and returns their
    former countries, whose certificates no longer hold; see writers.certified(). Other repositories stay as they are, and
    pools without such rows aren't written unless one moves into them. Run it while the stream rests."""
    pool = repository_pool(spark, path)
    with cleared(spark):
        old = F.coalesce(F.col("resolver") != resolver_version, F.lit(True))
        rows = settled(pool.read().filter(old))
        stale = [r[0] for r in certify.changed_countries(rows).collect()]
        if not stale:
            return []
        version = pool.versions()[-1] + 1
        _, mine, touched = _attributed(rows.drop("country", "resolver"), path, catalogue, resolve, resolver_version, version)
        keys = sorted({*stale, *touched})
        pool.replace(merge_repositories(pool.of_keys(keys, version).filter(~old), mine), version, gone=stale)
        pool.vacuum()
    return sorted(stale)


def fold_owners(path: str, resolve: Callable[[DataFrame], DataFrame], resolver_version: int = verdicts.RESOLVER_VERSION) -> Batch:
    """A foreachBatch function from rows of readers.read_owner_pages(), each with its target country, to one row for each owner
    that is accepted there. A batch becomes the folder hits/<batch> below path."""

    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        with cleared(spark):
            known = verdicts.table(spark, f"{path}/targets", verdicts.TARGET, resolver_version)
            rows = ranking.filter_owner_type(batch).select("login", F.col("country").alias("code"), "location", "seq", "search_term", F.col("top.stargazerCount").alias("stars"), F.col("top.nameWithOwner").alias("repository"))
            told = verdicts.judged(settled(rows), known, resolve, batch_id).filter("attribution.accepted")
            one = told.select(F.col("code").alias("country"), "login", "seq", F.coalesce("stars", F.lit(0).cast("bigint")).alias("stars"), "repository", "attribution.confidence", F.array("search_term").alias("terms"))
            # one file, which the second stream takes as one batch: an owner is in it once
            write_once(ranking.pool_fold(one).repartition(1), f"{path}/hits/{batch_id:010d}")
            known.vacuum()

    return run


def keep_owners(path: str) -> Batch:
    """A foreachBatch function that stores the pools that owners.owner_pools() gives."""

    def run(batch: DataFrame, batch_id: int) -> None:
        pool = owner_pool(batch.sparkSession, path)
        pool.replace(batch, batch_id)
        pool.vacuum()

    return run


def _run(source: DataFrame, run: Batch, checkpoint: str, mode: str = "append") -> None:
    source.writeStream.outputMode(mode).foreachBatch(run).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def run_repositories(pages: DataFrame, path: str, catalogue: DataFrame, resolve: Callable[[DataFrame], DataFrame], resolver_version: int = verdicts.RESOLVER_VERSION) -> None:
    """Folds all pages that are there, in micro-batches, and ends. pages: a stream of readers.read_repo_pages()."""
    _run(pages, fold_repositories(path, catalogue, resolve, resolver_version), f"{path}/checkpoints/repositories")


def run_owners(pages: DataFrame, path: str, resolve: Callable[[DataFrame], DataFrame], limit: int = ranking.POOL_LIMIT, resolver_version: int = verdicts.RESOLVER_VERSION) -> None:
    """Attributes all pages that are there, then folds what they gave into the state, and ends. pages: a stream of
    readers.read_owner_pages(). A batch without an accepted owner leaves an empty folder, which the second stream skips."""
    spark = pages.sparkSession
    _run(pages, fold_owners(path, resolve, resolver_version), f"{path}/checkpoints/hits")
    hits = spark.readStream.schema(owners.OWNERS).option("maxFilesPerTrigger", 1).parquet(f"{path}/hits/*")
    with owners.keyed_state(spark):
        _run(owners.owner_pools(hits, limit), keep_owners(path), f"{path}/checkpoints/owners", "update")
