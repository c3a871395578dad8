"""Queries of sources, sinks and streams: files that Spark makes of the given tables are read, folded or written back."""

from __future__ import annotations

from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators import attribution, discovery, gazetteer, ranking
from ..sources import readers, writers
from ..sources.scratch import scratch, settled
from ..streaming import pools
from .entries import ATTRIBUTED, BEST, FRONTIER, LIVE, NORMED, RESOLVED, SOURCED, THRESHOLDS, _at, _config, _frontier, _terms, _territories, catalogue, nested, register


def _landed(df: DataFrame, how: str, **options) -> str:
    path = scratch(df.sparkSession)
    writer = df.write.options(**options)
    getattr(writer, how)(path)
    return path


def _documents(df: DataFrame, key: str) -> str:
    """One JSON file for each key: a document a file."""
    path = scratch(df.sparkSession)
    one = df.select(F.col(key).alias("_file"), F.to_json(F.struct(*[c for c in df.columns])).alias("value"))
    one.repartition("_file").write.partitionBy("_file").text(path)
    return path


def _by_page(raw: DataFrame) -> DataFrame:
    """raw as a table written once, in parts by `page`, of which a run reads its own."""
    path = scratch(raw.sparkSession)
    raw.write.partitionBy("page").parquet(path)
    return raw.sparkSession.read.schema(raw.schema).parquet(path)


@register("read_gazetteer", f"WITH {SOURCED} SELECT * FROM src")
def _(b):
    source = nested(b)
    arrays = source.select(F.concat(F.lit("["), F.to_json(F.struct(*source.columns)), F.lit("]")).alias("value"), F.col("iso2").alias("_file"))
    path = scratch(source.sparkSession)
    arrays.repartition("_file").write.partitionBy("_file").option("compression", "gzip").text(path)
    return gazetteer.source_counts(readers.read_gazetteer(source.sparkSession, path).withColumn("code", F.upper("iso2")))


@register("read_owner_pages", "SELECT login, search_term, min(seq) OVER (PARTITION BY search_term, floor(seq / 100)) AS page, (row_number() OVER (PARTITION BY search_term, floor(seq / 100) ORDER BY seq) - 1)::INT AS pos, location FROM {hits}")
def _(b):
    nodes = F.array_sort(F.collect_list(F.struct("seq", F.struct(F.lit("User").alias("__typename"), "id", "login", "location").alias("n"))))
    pages = b("hits").groupBy("search_term", F.floor(F.col("seq") / 100).alias("_page")).agg(F.min("seq").alias("seq"), F.transform(nodes, lambda x: x["n"]).alias("nodes"))
    landed = pages.select("seq", F.col("search_term").alias("searchTerm"), F.size("nodes").alias("userCount"), "nodes")
    return readers.read_owner_pages(landed.sparkSession, _landed(landed, "json")).select("login", "search_term", F.col("seq").alias("page"), "pos", "location")


@register("read_published", f"WITH {LIVE} SELECT code, name, methodology_version, generated_at, published_repositories FROM pub")
def _(b):
    p = b("published")
    docs = p.select(F.col("methodology_version").alias("methodologyVersion"), F.col("generated_at").alias("generatedAt"), F.struct("code", "name").alias("country"), F.struct(F.col("published_repositories").alias("publishedRepositories")).alias("coverage"), F.col("code").alias("of"))
    return readers.read_published(p.sparkSession, _documents(docs, "of")).select("code", "name", "methodology_version", "generated_at", "published_repositories")


@register("write_geo_index", f"WITH {NORMED} SELECT code, kind, string_agg(term, '|' ORDER BY norm, term) AS terms FROM nt GROUP BY ALL")
def _(b):
    terms = _terms(b)
    spark, path = terms.sparkSession, scratch(terms.sparkSession)
    writers.write_geo_index(terms, path, least=20)
    return spark.read.schema("kind string, terms array<string>, code string").parquet(path).select("code", "kind", F.array_join("terms", "|").alias("terms"))


@register("write_rankings", f"""WITH p AS (SELECT *, row_number() OVER {BEST} AS rank FROM {{latest}})
SELECT country AS code, any_value(c.name) AS name, 1::INT AS schema_version, '0.8.0-repository-first' AS methodology_version, count(*) FILTER (rank <= 100)::BIGINT AS n, min(rank)::INT AS first_rank, sum(CASE WHEN rank <= 100 THEN stars END)::BIGINT AS stars,
  count(DISTINCT owner) FILTER (rank <= 100)::BIGINT AS unique_owners, min(CASE WHEN rank <= 100 THEN stars END)::BIGINT AS cut_off FROM p JOIN {{countries}} c ON c.code = p.country GROUP BY country""")
def _(b):
    pool = ranking.repo_pool_topk(b("latest"))
    ranked = ranking.rank_repositories(pool)
    coverage = discovery.certified_coverage(ranked, pool)
    docs = writers.ranking_documents(ranked.select("country", "rank", "name_with_owner", "stars"), catalogue(b), coverage, {"provider": "search pages", "countryBasis": "public owner profile location"}, "2026-11-28T00:00:00Z")
    spark, path = docs.sparkSession, scratch(docs.sparkSession)
    writers.write_rankings(docs, path)
    kind = "schemaVersion INT, methodologyVersion STRING, country STRUCT<code: STRING, name: STRING>, coverage STRUCT<unique_owners: BIGINT, cut_off: BIGINT>, repositories ARRAY<STRUCT<rank: INT, stars: BIGINT>>"
    back = spark.read.schema(kind).json(path)
    total = F.aggregate("repositories", F.lit(0).cast("bigint"), lambda a, x: a + x["stars"])
    return back.select("country.code", "country.name", F.col("schemaVersion").alias("schema_version"), F.col("methodologyVersion").alias("methodology_version"), F.size("repositories").cast("bigint").alias("n"), F.array_min(F.transform("repositories", lambda x: x["rank"])).alias("first_rank"), total.alias("stars"), "coverage.unique_owners", "coverage.cut_off")


@register("read_geonames", "SELECT name, ascii_name, alternates, upper(trim(country_code)) AS country_code, admin1 FROM {places} WHERE length(admin1) < 2 OR admin1 <> '04'")
def _(b):
    p = b("places")
    blank = [F.lit("")] * 8
    row = F.concat_ws("\t", F.lit("1"), "name", "ascii_name", "alternates", F.lit(""), F.lit(""), F.lit(""), F.lit(""), "country_code", F.lit(""), "admin1", *blank)
    short = F.when(F.col("admin1") == "04", F.concat_ws("\t", "name", "country_code")).otherwise(row)
    return readers.read_geonames(p.sparkSession, _landed(p.select(short.alias("value")), "text"))


@register("read_geo_indexes", "SELECT code, kind, term, row_number() OVER (PARTITION BY code, kind ORDER BY term) - 1 AS seq FROM (SELECT DISTINCT code, kind, term FROM {raw_terms}) q WHERE code NOT IN ('AC', 'AD')")
def _(b):
    """Files are found by their names: that of AD has none of a country, and the document of AC lacks its code."""
    of = lambda k: F.array_sort(F.collect_set(F.when(F.col("kind") == k, F.col("term"))))
    t = b("raw_terms").groupBy("code").agg(of("attribution").alias("attributionTerms"), of("discovery").alias("discoveryTerms"), of("compound").alias("compoundTerms"))
    docs = t.select(F.when(F.col("code") != "AC", F.struct("code")).alias("country"), "attributionTerms", "discoveryTerms", "compoundTerms", F.when(F.col("code") == "AD", F.lit("_index")).otherwise(F.col("code")).alias("name"))
    path = scratch(t.sparkSession)
    writers.write_named(docs.select("name", F.to_json(F.struct("country", "attributionTerms", "discoveryTerms", "compoundTerms")).alias("value")), path, "name", "value")
    return readers.read_geo_indexes(t.sparkSession, path).select("code", "kind", "term", F.col("seq").cast("bigint").alias("seq"))


def _repo_struct(**more) -> Column:
    return F.struct(F.col("name_with_owner").alias("nameWithOwner"), F.col("stars").alias("stargazerCount"), F.col("forks").alias("forkCount"), F.col("is_fork").alias("isFork"), F.struct(F.col("language").alias("name")).alias("primaryLanguage"), *[v.alias(k) for k, v in more.items()])


@register("read_repo_pages", "SELECT name_with_owner, seq, stars AS stargazer_count, is_fork, language, owner AS owner_login FROM {repos}")
def _(b):
    node = _repo_struct(owner=F.struct(F.col("owner").alias("login"), F.col("segment").alias("location")))
    pages = b("repos").select(F.col("seq"), F.array(node).alias("nodes"))
    return readers.read_repo_pages(pages.sparkSession, _landed(pages, "json")).select("name_with_owner", "seq", "stargazer_count", "is_fork", "language", "owner_login")


@register("read_owner_repos", "SELECT owner AS login, name_with_owner, stars AS stargazer_count FROM {repos}")
def _(b):
    per = b("repos").groupBy("owner").agg(F.collect_list(_repo_struct()).alias("r"))
    pages = per.select(F.lit(1).alias("seq"), F.array(F.struct(F.lit("User").alias("__typename"), F.col("owner").alias("login"), F.struct(F.col("r").alias("nodes")).alias("repositories"))).alias("nodes"))
    return readers.read_owner_repos(pages.sparkSession, _landed(pages, "json")).select("login", "name_with_owner", "stargazer_count")


@register("read_state", "SELECT code, phase, next_term_index, terms_total, updated_at FROM {progress} WHERE next_term_index % 4 <> 0")
def _(b):
    p = b("progress")
    docs = p.select(F.when(F.col("next_term_index") % 4 != 0, F.lit(2)).otherwise(F.lit(1)).alias("schemaVersion"), "phase", F.col("next_term_index").alias("nextTermIndex"), F.col("updated_at").alias("updatedAt"), F.struct("code").alias("country"), F.struct(F.col("terms_total").alias("termsTotal")).alias("geography"), "code")
    return readers.read_state(p.sparkSession, _documents(docs, "code")).select("code", "phase", "next_term_index", "terms_total", "updated_at")


@register("write_state", "SELECT country, name_with_owner, CASE WHEN country < 'AF' THEN stars + 1000 ELSE stars END AS stars FROM {latest}")
def _(b):
    rows = b("latest").select("country", "name_with_owner", "stars")
    path = scratch(rows.sparkSession)
    writers.write_state(rows, path)
    return writers.write_state(rows.filter("country < 'AF'").withColumn("stars", F.col("stars") + 1000), path).read()


@register("maintained_terms", f"WITH {NORMED} SELECT DISTINCT code, norm FROM nt WHERE kind = 'discovery' AND norm IN (SELECT norm FROM nt WHERE kind = 'discovery' GROUP BY norm HAVING count(DISTINCT code) > 1)")
def _(b):
    """Countries begin with the names of their neighbours too, and come to their own terms in three updates."""
    terms = settled(_terms(b))
    spark, path = terms.sparkSession, scratch(terms.sparkSession)
    codes = sorted(r["code"] for r in b("countries").select("code").collect())
    own = terms.filter("kind = 'discovery'").select("code", "kind", "norm")
    near = own.withColumn("code", F.concat(F.lit("A"), F.chr(F.lit(65) + (F.ascii(F.substring("code", 2, 1)) - 64) % 25)))
    gazetteer.update_terms(own.unionByName(near), path, codes, 0)
    for k in range(3):
        gazetteer.update_terms(own, path, codes[k::3], k + 1)
    return gazetteer.kept_ambiguous_terms(spark, path)


@register("publish_certified", _at(f"WITH {FRONTIER}, {THRESHOLDS}, ", 9) + _at("f2 AS (WITH " + FRONTIER + " SELECT frontier AS later FROM fr)", 15) + """ SELECT country, CASE WHEN threshold > frontier THEN 'first' ELSE 'second' END AS generated_at, 20::BIGINT AS n,
  CASE WHEN threshold > frontier THEN frontier ELSE later END AS frontier, threshold AS cut_off FROM th, fr, f2 WHERE threshold > frontier OR threshold > later""")
def _(b):
    """Two runs of a scan, the second one further down, and a third that finds nothing new."""
    pool = settled(ranking.repo_pool_topk(b("latest")))
    spark, path = pool.sparkSession, scratch(pool.sparkSession)
    known = catalogue(b)
    for run, (now, requests) in enumerate((("first", 9), ("second", 15), ("third", 15))):
        writers.publish_certified(pool, _frontier(b, 100_000, requests), known, path, now, run, {"provider": "search pages"}, limit=20)
    kind = "generatedAt STRING, country STRUCT<code: STRING>, coverage STRUCT<cut_off: BIGINT, frontier: BIGINT>, repositories ARRAY<STRUCT<rank: INT>>"
    n = F.size("repositories").cast("bigint")
    return writers.certified_documents(spark, path, kind).select(F.col("country.code").alias("country"), F.col("generatedAt").alias("generated_at"), n.alias("n"), "coverage.frontier", "coverage.cut_off")


PAGES = 3
#: What the raw pages of repositories have of `located`.
REPOSITORY = ["name_with_owner", "owner", "stars", "forks", "is_fork", "language", "location"]


def _unrolled(first: str, step: str) -> str:
    """p0, p1 and p2: the pool after each run over its page; {k} and {before} in step are the run and the pool before it."""
    return ", ".join([first.replace("{k}", "0"), *(step.replace("{k}", str(k)).replace("{before}", f"p{k - 1}") for k in range(1, PAGES))])


REPO_ROWS = "rows_ AS (SELECT s.*, v[3] AS country FROM {located} s JOIN res ON res.id = s.customer WHERE v[3] IS NOT NULL AND NOT is_fork)"
REPO_POOL = f"p{{k}} AS (SELECT country, name_with_owner, seq, stars, forks FROM (SELECT *, row_number() OVER {BEST} AS r FROM (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY country, name_with_owner ORDER BY seq DESC) AS n FROM ({{rows}}) q) q WHERE n = 1) q) q WHERE r <= 125)"
_new = "SELECT country, name_with_owner, seq, stars, forks FROM rows_ WHERE page = {k}"


@register("stream_repo_pool", f"{RESOLVED}, {REPO_ROWS}, {_unrolled(REPO_POOL.replace('{rows}', _new), REPO_POOL.replace('{rows}', 'SELECT * FROM {before} UNION ALL ' + _new))} SELECT country, name_with_owner, stars FROM p{PAGES - 1}")
def _(b):
    """Raw pages land in three runs; the stream starts anew for each, from its checkpoint."""
    raw = _by_page(b("located").select("page", "seq", *REPOSITORY))
    spark, path = raw.sparkSession, scratch(raw.sparkSession)
    known, terms, names = settled(catalogue(b)), settled(_terms(b)), settled(_territories(b))
    resolve = partial(attribution.resolve_location, catalogue=known, terms=terms, names=names)
    node = _repo_struct(owner=F.struct(F.lit("User").alias("__typename"), F.col("owner").alias("login"), F.col("location")))
    pages = readers.read_repo_pages(spark, f"{path}/pages/*", stream=True)
    for k in range(PAGES):
        raw.filter(F.col("page") == k).select("seq", F.array(node).alias("nodes")).write.json(f"{path}/pages/{k}")
        pools.run_repositories(pages, path, known, resolve)
    return pools.repository_pool(spark, path).read().select("country", "name_with_owner", "stars")


POOL_OF = f"SELECT * EXCLUDE (n, r) FROM (SELECT *, row_number() OVER {BEST} AS r FROM (SELECT *, row_number() OVER (PARTITION BY country, name_with_owner ORDER BY seq DESC) AS n FROM ({{rows}}) q) q WHERE n = 1) q WHERE r <= 125"
_old = "SELECT 'AA' AS country, name_with_owner, seq, stars, forks, location, 1 AS resolver FROM {located} WHERE page = 0 AND NOT is_fork AND trim(location, ' ' || chr(9) || chr(160)) <> ''"
_second = "SELECT * FROM b0 UNION ALL SELECT country, name_with_owner, seq, stars, forks, location, 2 FROM rows_ WHERE page = 1"
_moved = "SELECT * FROM b1 WHERE resolver = 2 UNION ALL SELECT v[3], name_with_owner, seq, stars, forks, b1.location, 2 FROM b1 JOIN (SELECT DISTINCT location, v FROM res) u ON u.location = b1.location WHERE resolver = 1 AND v[3] IS NOT NULL"


@register("backfill", f"{RESOLVED}, {REPO_ROWS}, b0 AS ({POOL_OF.replace('{rows}', _old)}), b1 AS ({POOL_OF.replace('{rows}', _second)}) SELECT country, name_with_owner, stars, resolver FROM ({POOL_OF.replace('{rows}', _moved)}) q")
def _(b):
    """The first version of the resolver took all places for one country; the second one comes with the second run of pages, and
    what the first one had attributed is then sent through it."""
    raw = _by_page(b("located").filter("page < 2").select("page", "seq", *REPOSITORY))
    spark, path = raw.sparkSession, scratch(raw.sparkSession)
    known, terms, names = settled(catalogue(b)), settled(_terms(b)), settled(_territories(b))
    resolve = partial(attribution.resolve_location, catalogue=known, terms=terms, names=names)
    first = lambda df: resolve(df).withColumn("attribution", F.col("attribution").withField("accepted", F.lit(True)).withField("country_code", F.lit("AA")))
    node = _repo_struct(owner=F.struct(F.lit("User").alias("__typename"), F.col("owner").alias("login"), F.col("location")))
    pages = readers.read_repo_pages(spark, f"{path}/pages/*", stream=True)
    for k, how in enumerate((first, resolve)):
        raw.filter(F.col("page") == k).select("seq", F.array(node).alias("nodes")).write.json(f"{path}/pages/{k}")
        pools.run_repositories(pages, path, known, how, k + 1)
    pools.backfill(spark, path, known, resolve, 2)
    return pools.repository_pool(spark, path).read().select("country", "name_with_owner", "stars", "resolver")


OWNER_ROWS = """rows_ AS (SELECT page, h.code AS country, login, seq, stars, repository, term, v.confidence, CASE v.confidence WHEN 'high' THEN 2 ELSE 1 END AS w FROM {owner_hits} h JOIN verdict v ON v.location = h.location AND v.code = h.code WHERE v.accepted),
new AS (SELECT page, country, login, max(seq) AS seq, max(stars) AS stars, arg_max(repository, (stars, seq)) AS repository, max(w) AS w, list(DISTINCT term) AS terms FROM rows_ GROUP BY ALL)"""
OWNER_POOL = """p{k} AS (SELECT * EXCLUDE (r) FROM (SELECT *, rank() OVER (PARTITION BY country ORDER BY stars DESC) AS r FROM (SELECT country, login, max(seq) AS seq, max(stars) AS stars, arg_max(repository, (stars, p)) AS repository, max(w) AS w, list_distinct(flatten(list(terms))) AS terms FROM ({rows}) q GROUP BY ALL) q) q WHERE r <= 20)"""
_fresh = "SELECT country, login, seq, stars, repository, w, terms, 1 AS p FROM new WHERE page = {k}"
_told = ATTRIBUTED.replace("{pairs}", "{owner_pairs}")
VERDICT = _told[: (_at := _told.rindex("SELECT location, code, v[1] IN"))].rstrip() + ", verdict AS (" + _told[_at:] + ")"


@register("stream_owner_pool", f"{VERDICT}, {OWNER_ROWS}, {_unrolled(OWNER_POOL.replace('{rows}', _fresh), OWNER_POOL.replace('{rows}', 'SELECT *, 0 AS p FROM {before} UNION ALL ' + _fresh))} SELECT country, login, stars, repository, CASE w WHEN 2 THEN 'high' ELSE 'medium' END AS confidence, array_to_string(list_sort(terms), ',') AS terms FROM p{PAGES - 1}")
def _(b):
    raw = _by_page(b("owner_hits").select("page", "code", "seq", "login", "repository", "stars", "term", "location"))
    spark, path = raw.sparkSession, scratch(raw.sparkSession)
    config, regions = settled(_config(b)), settled(attribution.region_rows(attribution.alias_rows(catalogue(b))))
    resolve = partial(attribution.attribute_location, config=config, regions=regions)
    top = F.struct(F.array(F.struct(F.col("repository").alias("nameWithOwner"), F.col("stars").alias("stargazerCount"))).alias("nodes"))
    node = F.struct(F.lit("User").alias("__typename"), F.col("login"), F.col("location"), top.alias("repositories"))
    pages = readers.read_owner_pages(spark, f"{path}/pages/*", stream=True)
    for k in range(PAGES):
        some = raw.filter(F.col("page") == k).select("seq", F.col("term").alias("searchTerm"), F.struct("code").alias("country"), F.array(node).alias("nodes"))
        some.write.json(f"{path}/pages/{k}")
        pools.run_owners(pages, path, resolve, limit=20)
    return pools.owner_pool(spark, path).read().select("country", "login", "stars", "repository", "confidence", F.array_join("terms", ",").alias("terms"))
