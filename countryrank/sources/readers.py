"""Readers of landed pages, gazetteers, indexes, states and rankings. Damaged files and rows are left out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

NAMED = "name STRING, native STRING"
GAZETTEER = f"iso2 STRING, {NAMED}, translations MAP<STRING,STRING>, states ARRAY<STRUCT<{NAMED.replace(' STRING', ': STRING')}, iso2: STRING, cities: ARRAY<STRUCT<{NAMED.replace(' STRING', ': STRING')}, state_code: STRING>>>>"
INDEX = "country STRUCT<code: STRING, name: STRING, slug: STRING>, attributionTerms ARRAY<STRING>, discoveryTerms ARRAY<STRING>, compoundTerms ARRAY<STRING>, ambiguousTerms ARRAY<STRING>, contentSha256 STRING"
REPO = "name: STRING, nameWithOwner: STRING, url: STRING, description: STRING, stargazerCount: BIGINT, forkCount: BIGINT, isArchived: BOOLEAN, isFork: BOOLEAN, createdAt: STRING, pushedAt: STRING, homepageUrl: STRING, primaryLanguage: STRUCT<name: STRING>, licenseInfo: STRUCT<name: STRING, spdxId: STRING>"
OWNER = "__typename: STRING, id: STRING, login: STRING, name: STRING, location: STRING, url: STRING, avatarUrl: STRING"
OWNER_PAGE = f"seq BIGINT, searchTerm STRING, country STRUCT<code: STRING>, userCount BIGINT, nodes ARRAY<STRUCT<{OWNER}, repositories: STRUCT<nodes: ARRAY<STRUCT<{REPO}>>>>>"
REPO_PAGE = f"seq BIGINT, repositoryCount BIGINT, nodes ARRAY<STRUCT<{REPO}, owner: STRUCT<{OWNER}>>>"
STATE = "schemaVersion INT, cycle INT, phase STRING, nextTermIndex BIGINT, updatedAt STRING, country STRUCT<code: STRING>, geography STRUCT<sha256: STRING, termsTotal: BIGINT>, scanFrontierStars BIGINT"
PUBLISHED = "methodologyVersion STRING, generatedAt STRING, country STRUCT<code: STRING, name: STRING, slug: STRING>, coverage STRUCT<publishedRepositories: BIGINT>"
#: The methodology that is current, and the one that one country may still have.
CURRENT, EARLIER = "0.8.0-repository-first", ("LK", "0.2.0-poc")


def _json(spark: SparkSession, path: str, schema: str, lines: bool, glob: str | None = None, stream: bool = False) -> DataFrame:
    reader = (spark.readStream if stream else spark.read).schema(f"{schema}, _corrupt_record STRING").option("multiLine", not lines).option("mode", "PERMISSIVE")
    df = (reader.option("pathGlobFilter", glob) if glob else reader).json(path)
    return df.filter(F.col("_corrupt_record").isNull()).drop("_corrupt_record")


def read_gazetteer(spark: SparkSession, path: str) -> DataFrame:
    """Countries of a nested array of countries, plain or compressed."""
    return _json(spark, path, GAZETTEER, lines=False)


def read_geonames(spark: SparkSession, path: str) -> DataFrame:
    """(name, ascii_name, alternates, country_code, admin1) of tab-separated rows; rows of fewer than 19 fields go."""
    c = F.split("value", "\t", -1)
    code = F.upper(F.trim(c[8]))
    return spark.read.text(path).filter(F.size(c) >= 19).select(c[1].alias("name"), c[2].alias("ascii_name"), c[3].alias("alternates"), code.alias("country_code"), F.trim(c[10]).alias("admin1"))


def read_geo_indexes(spark: SparkSession, path: str, glob: str | None = "[A-Z][A-Z].json") -> DataFrame:
    """(code, kind, term, seq) of the XX.json files of a folder; glob names other files, or all with None."""
    df = _json(spark, path, INDEX, lines=False, glob=glob).filter("country.code IS NOT NULL")
    kinds = {"attribution": "attributionTerms", "discovery": "discoveryTerms", "compound": "compoundTerms", "ambiguous": "ambiguousTerms"}
    lists = F.explode(F.array(*[F.struct(F.lit(k).alias("kind"), F.col(c).alias("terms")) for k, c in kinds.items()]))
    return df.select("country.code", lists.alias("l")).select("code", "l.kind", F.posexplode("l.terms").alias("seq", "term"))


def _repo(r: str) -> list:
    get = lambda c, to: F.col(f"{r}.{c}").alias(to)
    return [get("nameWithOwner", "name_with_owner"), get("stargazerCount", "stargazer_count"), get("forkCount", "fork_count"), get("isFork", "is_fork"), get("isArchived", "is_archived"), get("description", "description"), get("homepageUrl", "homepage_url"), get("createdAt", "created_at"), get("primaryLanguage.name", "language")]


def read_owner_pages(spark: SparkSession, path: str, stream: bool = False) -> DataFrame:
    """Owner hits of landed search pages, one JSON page a line, in order of arrival, with the inline best repository; as a
    stream of the pages that arrive, if asked."""
    page = _json(spark, path, OWNER_PAGE, lines=True, stream=stream).select("seq", F.col("searchTerm").alias("search_term"), F.col("country.code").alias("country"), F.posexplode("nodes").alias("pos", "n"))
    return page.select("seq", "pos", "search_term", "country", F.col("n.__typename").alias("typename"), "n.id", "n.login", "n.name", "n.location", F.get("n.repositories.nodes", F.lit(0)).alias("top"))


def read_repo_pages(spark: SparkSession, path: str, stream: bool = False) -> DataFrame:
    """Repositories of landed search pages with their owner; as a stream of the pages that arrive, if asked."""
    page = _json(spark, path, REPO_PAGE, lines=True, stream=stream).select("seq", F.posexplode("nodes").alias("pos", "n"))
    return page.select("seq", "pos", *_repo("n"), F.col("n.owner.login").alias("owner_login"), F.col("n.owner.location").alias("owner_location"), F.col("n.owner.__typename").alias("owner_type"))


def read_owner_repos(spark: SparkSession, path: str) -> DataFrame:
    """Repositories of landed per-owner batches."""
    page = _json(spark, path, OWNER_PAGE, lines=True).select("seq", F.explode("nodes").alias("n"))
    return page.select("seq", "n.login", F.col("n.__typename").alias("typename"), F.explode("n.repositories.nodes").alias("r")).select("seq", "login", "typename", *_repo("r"))


def read_state(spark: SparkSession, path: str, version: int | None = 2) -> DataFrame:
    """Discovery states of a folder, or, with version None, repository candidate states."""
    df = _json(spark, path, STATE, lines=False).filter("country.code IS NOT NULL")
    df = df if version is None else df.filter(F.col("schemaVersion") == version)
    return df.select("country.code", "cycle", "phase", F.col("nextTermIndex").alias("next_term_index"), F.col("geography.termsTotal").alias("terms_total"), F.col("geography.sha256").alias("sha256"), F.col("updatedAt").alias("updated_at"), F.col("scanFrontierStars").alias("scan_frontier_stars"))


def current_rankings(df: DataFrame) -> DataFrame:
    """Rankings of the current methodology, and of the earlier one for the country that may have it, by name."""
    keep = (F.col("methodology_version") == CURRENT) | ((F.col("code") == EARLIER[0]) & (F.col("methodology_version") == EARLIER[1]))
    return df.filter(keep & F.col("code").isNotNull() & F.col("name").isNotNull()).orderBy(F.collate("name", "UNICODE"))


def read_published(spark: SparkSession, path: str) -> DataFrame:
    """Published rankings of a folder."""
    df = _json(spark, path, PUBLISHED, lines=False)
    return current_rankings(df.select("country.code", "country.name", F.col("methodologyVersion").alias("methodology_version"), F.col("generatedAt").alias("generated_at"), F.col("coverage.publishedRepositories").alias("published_repositories")))
