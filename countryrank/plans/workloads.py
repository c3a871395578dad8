"""Gazetteer build, repository scan to certified rankings, and owner-first ranking of target countries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import attribution, certify, discovery, gazetteer, ranking


def gazetteer_build(source: DataFrame, places: DataFrame, catalogue: DataFrame) -> dict[str, DataFrame]:
    """Terms with their norms, ambiguous terms, counts and hashes per country."""
    terms = gazetteer.normed(gazetteer.geo_enrich(gazetteer.geo_build(source, catalogue), places, catalogue))
    return {"terms": terms, "ambiguous": gazetteer.ambiguous_terms(terms), "counts": gazetteer.geo_counts(terms), "hashes": gazetteer.term_hashes(terms)}


def repository_scan(repositories: DataFrame, catalogue: DataFrame, terms: DataFrame, queue: DataFrame, unresolved: DataFrame, certified: DataFrame, now: str) -> dict[str, DataFrame]:
    """Attributes repositories by their owners' locations, keeps the best of each country and certifies them."""
    resolved = attribution.resolve_location(ranking.filter_non_fork(repositories), catalogue, terms)
    mine = attribution.filter_accepted(resolved, catalogue).withColumn("country", F.col("attribution.country_code"))
    pool = ranking.repo_pool_topk(ranking.latest_repository(mine))
    ranked = ranking.rank_repositories(pool)
    done = certify.certify_countries(pool, certify.star_frontier(queue, unresolved), certified, now)
    return {"outcomes": attribution.attribution_outcomes(resolved), "pool": pool, "ranked": ranked, "certified": done, "coverage": discovery.certified_coverage(ranked, pool)}


def country_ranking(hits: DataFrame, repositories: DataFrame, config: DataFrame, regions: DataFrame) -> dict[str, DataFrame]:
    """Attributes owner hits (code, login, location, id, search_term, seq) to their target country and ranks the
    repositories (login, name_with_owner, stars, forks, is_fork, seq) of the owners found."""
    verdict = attribution.attribute_location(hits, config, regions)
    told = hits.join(verdict, hits["location"].eqNullSafe(verdict["location"]) & (hits["code"] == verdict["code"])).select(hits["*"], F.col("attribution.accepted").alias("accepted"), F.col("attribution.confidence").alias("confidence"), F.col("attribution.evidence").alias("evidence"))
    told = told.withColumnRenamed("code", "country")
    owners = discovery.owner_dedupe(told, ["country", "login"])
    mine = ranking.filter_non_fork(repositories).join(owners.select("country", "login"), "login")
    last = ranking.latest_repository(mine, ["country", "name_with_owner"])
    return {"owners": owners, "rejects": discovery.owner_rejects(told, ["country", "login"]), "ranked": ranking.two_stage_topn(last, owner_col="login")}
