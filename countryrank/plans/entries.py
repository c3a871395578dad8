"""One registered query for each operator, over the given tables, with DuckDB SQL for the same rows."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text
from ..operators import attribution, catalog, certify, discovery, gazetteer, ranking, shards, status
from ..sources import readers
from .bindings import bound, with_bindings

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    """Registers fn(b), where b(name) is a binding."""

    def add(fn):
        QUERIES[name] = lambda spark, sf_dir: fn(partial(bound, spark, sf_dir))
        if sql is not None:
            ORACLE_SQL[name] = with_bindings(sql)
        return fn

    return add


def norm(x: str) -> str:
    """DuckDB SQL of normalize_location(), for Latin text."""
    return rf"trim(regexp_replace(replace(lower(strip_accents(coalesce({x}, ''))), '&', ' and '), '[^\p{{L}}\p{{N}}\p{{M}}]+', ' ', 'g'))"


def BLANK(x: str) -> str:
    return f"trim({x}, ' ' || chr(9) || chr(160))"


def squeezed(x: str) -> str:
    return rf"trim(regexp_replace(coalesce({x}, ''), '\s+', ' ', 'g'))"


def catalogue(b) -> DataFrame:
    """The catalogue with aliases as lists."""
    names = b("aliases").groupBy("code").agg(F.transform(F.array_sort(F.collect_list(F.struct("seq", "alias"))), lambda x: x["alias"]).alias("aliases"))
    return catalog.country_dim(b("countries").select("code", "name").join(names, "code", "left"))


# -- projections, filters, predicates


@register("country_dim", f"""SELECT c.code, c.name, trim(regexp_replace({norm('c.name').replace('[^', '[^')}, '[^a-z0-9]+', '-', 'g'), '-') AS slug,
  chr(127397 + ascii(c.code[1])) || chr(127397 + ascii(c.code[2])) AS flag, (SELECT string_agg(alias, '|' ORDER BY seq) FROM {{aliases}} a WHERE a.code = c.code) AS aliases FROM {{countries}} c""")
def _(b):
    return catalogue(b).withColumn("aliases", F.array_join("aliases", "|"))


@register("country_lookup", "SELECT c_custkey, name FROM {customer} LEFT JOIN {countries} ON code = concat('A', chr(CAST(65 + c_custkey % 30 AS INT)))")
def _(b):
    asked = b("customer").select("c_custkey", F.concat(F.lit(" a"), F.chr(97 + F.col("c_custkey") % 30), F.lit(" ")).alias("asked"))
    asked = asked.withColumn("asked", F.when(F.col("c_custkey") % 30 > 25, F.lit("??")).otherwise(F.col("asked")))
    return catalog.country_lookup(asked, b("countries").select("code", "name"), "asked").select("c_custkey", "name")


CONFIG = """terms AS (SELECT DISTINCT code, kind, term FROM {raw_terms}), idx AS (SELECT code, kind, term, row_number() OVER (PARTITION BY code, kind ORDER BY term) AS seq FROM terms),
cfg AS (SELECT code, 'alias' AS kind, name AS term, 0 AS l, 0 AS seq FROM {countries} UNION ALL SELECT code, 'search', name, 0, 0 FROM {countries} UNION ALL SELECT code, 'alias', alias, 0, seq + 1 FROM {aliases} UNION ALL SELECT code, 'search', alias, 0, seq + 1 FROM {aliases}
 UNION ALL SELECT code, 'exact', lower(code), 0, 0 FROM {countries} UNION ALL SELECT code, CASE kind WHEN 'attribution' THEN 'place' WHEN 'discovery' THEN 'geography' ELSE 'compound' END, term, 1, seq FROM idx
 UNION ALL SELECT code, 'place', concat('Somewhere ', name), 2, 0 FROM {countries} WHERE k % 2 = 0 UNION ALL SELECT code, 'curated', concat('Somewhere ', name), 2, 0 FROM {countries} WHERE k % 2 = 0)"""


def overrides(b) -> DataFrame:
    return b("countries").filter("k % 2 = 0").select("code", F.lit("place").alias("kind"), F.concat(F.lit("Somewhere "), "name").alias("term"), F.lit(0).alias("seq"))


def index_terms(b) -> DataFrame:
    placed = shards.positions(b("raw_terms").distinct(), [F.col("term")], ["code", "kind"], "seq")
    return placed.withColumn("seq", F.col("seq") + 1)


@register("config_terms", f"WITH {CONFIG}, f AS (SELECT code, kind, term, min((l, seq)) AS ord FROM cfg GROUP BY ALL) SELECT code, kind, term, row_number() OVER (PARTITION BY code, kind ORDER BY ord, term)::BIGINT AS seq FROM f")
def _(b):
    return catalog.config_terms(catalogue(b), index_terms(b), overrides(b))


@register("config_validate", """SELECT c_custkey, concat_ws('|', CASE WHEN c_custkey % 3 = 0 THEN 'name' END, CASE WHEN c_custkey % 4 = 0 THEN 'searchTerms' END, CASE WHEN c_custkey % 150 <= 0 OR c_custkey % 150 > 100 THEN 'rankingLimit' END) AS problems FROM {customer}""")
def _(b):
    rows = b("customer").select("c_custkey", F.when(F.col("c_custkey") % 3 != 0, F.col("c_name")).otherwise(F.lit(" ")).alias("name"), F.when(F.col("c_custkey") % 4 != 0, F.array("c_mktsegment")).alias("searchTerms"), (F.col("c_custkey") % 150).alias("rankingLimit"))
    return catalog.config_problems(rows, ["name"], ["searchTerms"], ["rankingLimit"]).select("c_custkey", F.array_join("problems", "|").alias("problems"))


@register("filter_owner_type", "SELECT event_id, event_type FROM {events} WHERE event_type IN ('view', 'click')")
def _(b):
    kinds = F.when(F.col("event_type") == "view", "User").when(F.col("event_type") == "click", "Organization").otherwise("Bot")
    return ranking.filter_owner_type(b("events").withColumn("typename", kinds)).select("event_id", "event_type")


@register("filter_non_fork", "SELECT name_with_owner, seq FROM {repos} WHERE NOT is_fork")
def _(b):
    return ranking.filter_non_fork(b("repos")).select("name_with_owner", "seq")


@register("filter_catalog", "SELECT ' ' AS x, upper(trim(country_code)) AS code, name FROM {places} WHERE upper(trim(country_code)) IN (SELECT code FROM {countries})")
def _(b):
    return catalog.filter_catalog(b("places").withColumn("x", F.lit(" ")), b("countries"), "x", "country_code").select("x", "code", "name")


@register("repo_record", """SELECT name_with_owner, seq, CASE WHEN seq % 5 = 0 THEN 0 ELSE stars END AS stars, forks, CASE WHEN seq % 3 = 0 THEN NULL ELSE language END AS description, is_fork AS archived, owner AS login, CASE WHEN seq % 2 = 0 THEN segment END AS location FROM {repos}""")
def _(b):
    raw = b("repos").select("name_with_owner", "seq", F.when(F.col("seq") % 5 != 0, F.col("stars")).alias("stargazer_count"), F.col("forks").alias("fork_count"), F.when(F.col("seq") % 3 == 0, F.lit("")).otherwise(F.col("language")).alias("description"), F.lit("").alias("homepage_url"), F.when(F.col("is_fork"), F.lit(True)).alias("is_archived"), F.col("owner").alias("owner_login"), F.when(F.col("seq") % 2 == 0, F.col("segment")).otherwise(F.lit("")).alias("owner_location"))
    key = raw.withColumn("name_with_owner", F.concat_ws("~", "name_with_owner", "seq"))
    done = ranking.repo_record(key)
    cut = F.split("name_with_owner", "~")
    return done.select(cut[0].alias("name_with_owner"), cut[1].cast("bigint").alias("seq"), "stars", "forks", "description", "archived", "owner.login", "owner.location")


PROBE = "SELECT owner AS login, name_with_owner, stars FROM (SELECT *, row_number() OVER (PARTITION BY owner ORDER BY stars DESC, seq) AS rn FROM {latest}) q WHERE rn = 1"


def _pool(b) -> DataFrame:
    repos = b("latest").withColumnRenamed("owner", "login")
    return ranking.probe_candidates(b("customer").select(F.col("c_name").alias("login"), F.col("c_mktsegment").alias("location")), repos)


@register("probe_candidates", PROBE)
def _(b):
    return _pool(b).select("login", "top_repository.name_with_owner", "top_repository.stars")


@register("hydrate_pool", PROBE)
def _(b):
    return ranking.hydrate_pool(_pool(b))[1]


# -- scalar functions


@register("normalize_location", f"SELECT doc_id, {norm('text')} AS norm FROM {{documents}}")
def _(b):
    return b("documents").select("doc_id", text.normalize_location(F.col("text")).alias("norm"))


@register("clean_term", f"SELECT doc_id, CASE WHEN length({squeezed('text')}) BETWEEN 1 AND 120 THEN {squeezed('text')} END AS term FROM {{documents}}")
def _(b):
    return b("documents").select("doc_id", text.clean_term(F.col("text")).alias("term"))


CANDIDATES = f"""parts AS (SELECT DISTINCT location FROM {{locations}} WHERE {BLANK('location')} <> ''), split AS (SELECT location, unnest(list_concat([location], string_split_regex(location, '[,/|;]+'))) AS p, generate_subscripts(list_concat([location], string_split_regex(location, '[,/|;]+')), 1) AS i FROM parts),
cand AS (SELECT location, {norm('p')} AS norm, min(i) AS pos FROM split WHERE {norm('p')} <> '' GROUP BY ALL)"""


@register("location_candidates", f"WITH {CANDIDATES} SELECT location, string_agg(norm, '|' ORDER BY pos) AS candidates FROM cand GROUP BY location")
def _(b):
    one = b("locations").select("location").distinct().filter(text.trimmed(F.col("location")) != "")
    return one.select("location", F.array_join(text.location_candidates(F.col("location")), "|").alias("candidates"))


@register("contains_phrase", f"SELECT doc_id, (' ' || {norm('text')} || ' ') LIKE '% of the %' AS held FROM {{documents}}")
def _(b):
    return b("documents").select("doc_id", text.contains_phrase(text.normalize_location(F.col("text")), F.lit("of the")).alias("held"))


@register("name_variants", "SELECT p_partkey, unnest(list_distinct([p_name, p_brand, p_type])) AS term FROM {part}")
def _(b):
    item = F.struct(F.concat(F.lit("  "), F.col("p_name")).alias("name"), F.col("p_brand").alias("native"))
    made = b("part").withColumn("i", item)
    return made.select("p_partkey", F.explode(text.name_variants(F.col("i"), ["name", "native"], F.create_map(F.lit("fr"), F.col("p_type"), F.lit("xx"), F.col("p_name")))).alias("term"))


@register("admin_codes", "SELECT p_partkey, unnest(CASE WHEN p_partkey % 2 = 0 THEN ['us-' || p_partkey::VARCHAR, p_partkey::VARCHAR, p_brand] ELSE ['US-', p_brand] END) AS code FROM {part}")
def _(b):
    first = F.when(F.col("p_partkey") % 2 == 0, F.concat(F.lit("us-"), F.col("p_partkey"))).otherwise(F.lit("US-"))
    return b("part").select("p_partkey", F.explode(text.admin_codes([first, F.lit(""), F.col("p_brand"), F.repeat("p_brand", 9)], F.lit("us"))).alias("code"))


@register("compound_terms", "SELECT p_partkey, unnest(list_distinct([p_name || ', ' || p_brand, p_name || ', ' || p_type, p_type || ', ' || p_brand, p_type || ', ' || p_type])) AS term FROM {part}")
def _(b):
    return b("part").select("p_partkey", F.explode(text.compound_terms(F.array("p_name", "p_type"), F.array("p_brand"), F.array("p_type"))).alias("term"))


@register("split_alternates", "SELECT DISTINCT name, trim(t) AS term FROM (SELECT name, unnest(string_split(alternates, ',')) AS t FROM {places}) q WHERE trim(t) <> ''")
def _(b):
    return b("places").select("name", F.explode(text.split_alternates(F.col("alternates"))).alias("term"))


@register("sort_terms", f"SELECT segment, term, row_number() OVER (PARTITION BY segment ORDER BY n, term) - 1 AS pos FROM (SELECT DISTINCT c_mktsegment AS segment, c_name AS term, {norm('c_name')} AS n FROM {{customer}}) q")
def _(b):
    named = b("customer").select(F.col("c_mktsegment").alias("segment"), F.col("c_name").alias("term")).distinct().withColumn("norm", text.normalize_location(F.col("term")))
    return shards.positions(named, [F.col("norm"), F.col("term")], ["segment"], "pos").drop("norm")


@register("base_order", "SELECT segment, term, row_number() OVER (PARTITION BY segment ORDER BY lower(strip_accents(term)), term) - 1 AS pos FROM (SELECT DISTINCT segment, term FROM {spellings}) q")
def _(b):
    return gazetteer.base_order(b("spellings").distinct(), ["segment"])


@register("slugify", "SELECT doc_id, trim(regexp_replace(lower(strip_accents(text)), '[^a-z0-9]+', '-', 'g'), '-') AS slug FROM {documents}")
def _(b):
    return b("documents").select("doc_id", text.slugify(F.col("text")).alias("slug"))


@register("country_flag", "SELECT c_custkey, CASE WHEN c_custkey % 30 > 25 THEN '🌐' ELSE chr(127397 + 65) || chr(CAST(127397 + 65 + c_custkey % 30 AS INT)) END AS flag FROM {customer}")
def _(b):
    code = F.when(F.col("c_custkey") % 30 > 25, F.lit("A1")).otherwise(F.concat(F.lit("a"), F.chr(97 + F.col("c_custkey") % 30)))
    return b("customer").select("c_custkey", text.country_flag(code).alias("flag"))


@register("format_number", "SELECT o_orderkey, format('{:,}', CAST(floor(o_totalprice) AS BIGINT)) AS shown FROM orders")
def _(b):
    return b("orders").select("o_orderkey", text.thousands(F.floor("o_totalprice").cast("bigint")).alias("shown"))


@register("format_date", "SELECT event_id, CASE WHEN event_id % 10 = 0 THEN event_type ELSE strftime(ts, '%d %b %Y, %H:%M UTC') END AS shown FROM {events}")
def _(b):
    said = F.when(F.col("event_id") % 10 == 0, F.col("event_type")).otherwise(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"))
    return b("events").select("event_id", text.display_date(said).alias("shown"))


@register("truncate_text", f"SELECT doc_id, CASE WHEN length({squeezed('text')}) > 80 THEN rtrim({squeezed('text')}[:79]) || '…' ELSE {squeezed('text')} END AS short FROM {{documents}}")
def _(b):
    return b("documents").select("doc_id", text.truncate_text(F.col("text"), 80).alias("short"))


@register("escape_html", "SELECT page_id, replace(replace(replace(replace(replace(html, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '\"', '&quot;'), '''', '&#39;') AS safe FROM {pages}")
def _(b):
    return b("pages").select("page_id", text.escape_html(F.col("html")).alias("safe"))


@register("escape_markdown", "SELECT doc_id, regexp_replace(replace(text, '|', '\\|'), '\\r?\\n', ' ', 'g') AS safe FROM {documents}")
def _(b):
    return b("documents").select("doc_id", text.escape_markdown(F.col("text")).alias("safe"))


@register("progress_percent", "SELECT l_orderkey, l_linenumber, CASE WHEN l_partkey % 4 = 0 THEN 0 ELSE least(100, floor(l_suppkey / (l_partkey % 4 * 20.0) * 100))::INT END AS percent FROM {lineitem}")
def _(b):
    return b("lineitem").select("l_orderkey", "l_linenumber", text.progress_percent(F.col("l_suppkey"), F.col("l_partkey") % 4 * 20.0).alias("percent"))


@register("search_query_text", """SELECT o_orderkey, 'location:"' || replace(replace(o_orderpriority || '"x\\', '\\', '\\\\'), '"', '\\"') || '"' AS q, 'stars:' || greatest(1, o_orderkey % 50) || '..' || greatest(o_orderkey % 50, 1, o_custkey % 60) || ' fork:false sort:stars-desc' AS r FROM {orders}""")
def _(b):
    return b("orders").select("o_orderkey", text.location_query(F.concat("o_orderpriority", F.lit('"x\\'))).alias("q"), text.star_range_query(F.col("o_orderkey") % 50, F.col("o_custkey") % 60).alias("r"))


@register("shard_dates", """WITH o AS (SELECT o_orderkey, year(o_orderdate) AS y, month(o_orderdate) AS mm FROM {orders})
SELECT o_orderkey, 'month' AS stage, m::INT AS part, strftime(make_date(y, m, 1), '%Y-%m-%d') AS low, strftime(last_day(make_date(y, m, 1)), '%Y-%m-%d') AS high FROM o, (SELECT unnest(range(1, 13)) AS m) q
UNION ALL SELECT o_orderkey, 'day', d::INT, strftime(make_date(y, mm, d), '%Y-%m-%d'), strftime(make_date(y, mm, d), '%Y-%m-%d') FROM (SELECT *, unnest(range(1, day(last_day(make_date(y, mm, 1))) + 1)) AS d FROM o) q""")
def _(b):
    o = b("orders").select("o_orderkey", F.year("o_orderdate").alias("y"), F.month("o_orderdate").alias("m"))
    months = o.select("o_orderkey", F.lit("month").alias("stage"), F.explode(text.month_ranges(F.col("y"))).alias("r")).select("o_orderkey", "stage", F.col("r.month").alias("part"), "r.low", "r.high")
    days = o.select("o_orderkey", F.lit("day").alias("stage"), F.explode(text.day_ranges(F.col("y"), F.col("m"))).alias("r")).select("o_orderkey", "stage", F.col("r.day").alias("part"), "r.low", "r.high")
    return months.unionByName(days)


NORMED = f"nt AS (SELECT DISTINCT code, kind, term, {norm('term')} AS norm FROM {{raw_terms}} WHERE {norm('term')} <> '')"


@register("content_hash", f"""WITH {NORMED}, l AS (SELECT code, kind, string_agg('"' || term || '"', ',' ORDER BY norm, term) AS ts FROM nt GROUP BY ALL),
w AS (SELECT code, max(CASE WHEN kind = 'attribution' THEN ts END) AS a, max(CASE WHEN kind = 'compound' THEN ts END) AS c, max(CASE WHEN kind = 'discovery' THEN ts END) AS d FROM l GROUP BY code)
SELECT code, sha256('{{"attribution":[' || coalesce(a, '') || '],"code":"' || code || '","compound":[' || coalesce(c, '') || '],"discovery":[' || coalesce(d, '') || ']}}') AS content_sha256 FROM w""".replace("{{\"attr", "{\"attr").replace("']}}')", "']}')"))
def _(b):
    return gazetteer.term_hashes(gazetteer.normed(b("raw_terms").distinct()))


# -- joins and attribution

CODES = """tc AS (SELECT norm, list_sort(list(DISTINCT code)) AS codes FROM nt WHERE kind = 'attribution' GROUP BY norm), cc AS (SELECT norm, list_sort(list(DISTINCT code)) AS codes FROM nt WHERE kind = 'compound' GROUP BY norm)"""
ALIASES = f"al AS (SELECT DISTINCT code, {norm('a')} AS norm FROM (SELECT code, name AS a FROM {{countries}} UNION ALL SELECT code, alias FROM {{aliases}}) q), ac AS (SELECT norm, list_sort(list(DISTINCT code)) AS codes FROM al GROUP BY norm)"


def _keys(b) -> DataFrame:
    return attribution.location_keys(b("locations"))


def _terms(b) -> DataFrame:
    return gazetteer.normed(b("raw_terms").distinct())


@register("lookup_terms", f"WITH {CANDIDATES}, {NORMED}, {CODES} SELECT location, cand.norm, array_to_string(codes, ',') AS codes FROM cand LEFT JOIN tc ON tc.norm = cand.norm")
def _(b):
    return attribution.lookup_terms(attribution.candidate_rows(_keys(b)), _terms(b)).select("location", "norm", F.array_join("codes", ",").alias("codes"))


@register("lookup_compound", f"WITH {CANDIDATES}, {NORMED}, {CODES} SELECT location, array_to_string(codes, ',') AS codes FROM parts LEFT JOIN cc ON cc.norm = {norm('location')}")
def _(b):
    return attribution.lookup_compound(_keys(b), _terms(b)).select("location", F.array_join("compound_codes", ",").alias("codes"))


@register("lookup_alias", f"WITH {CANDIDATES}, {ALIASES} SELECT location, cand.norm, array_to_string(codes, ',') AS codes FROM cand LEFT JOIN ac ON ac.norm = cand.norm")
def _(b):
    return attribution.lookup_alias(attribution.candidate_rows(_keys(b)), attribution.alias_rows(catalogue(b))).select("location", "norm", F.array_join("alias_codes", ",").alias("codes"))


#: Two segment names stand in for territories.
def _territories(b) -> DataFrame:
    return b("countries").filter("k < 2").select(F.when(F.col("k") == 0, F.lit("machinery")).otherwise(F.lit("nation 3")).alias("norm"), "code")


TERRITORY = "te AS (SELECT CASE WHEN k = 0 THEN 'machinery' ELSE 'nation 3' END AS norm, code FROM {countries} WHERE k < 2), tt AS (SELECT location, min_by(te.code, pos) AS code, min_by(te.norm, pos) AS norm FROM cand JOIN te ON te.norm = cand.norm GROUP BY location)"


@register("lookup_territory", f"WITH {CANDIDATES}, {TERRITORY} SELECT location, code, norm FROM tt")
def _(b):
    return attribution.lookup_territory(attribution.candidate_rows(_keys(b)), _territories(b)).select("location", "territory.code", "territory.norm")


@register("lookup_iso2", "SELECT DISTINCT location, CASE WHEN upper(location) IN (SELECT code FROM {countries}) THEN upper(location) END AS iso2 FROM {locations} WHERE trim(location, ' ' || chr(9) || chr(160)) <> ''")
def _(b):
    return attribution.lookup_iso2(_keys(b), b("countries")).select("location", "iso2")


@register("phrase_match", f"WITH {CANDIDATES}, {ALIASES} SELECT location, al.code, al.norm FROM parts JOIN al ON (' ' || {norm('location')} || ' ') LIKE ('% ' || al.norm || ' %')")
def _(b):
    return attribution.phrase_match(_keys(b), attribution.alias_rows(catalogue(b))).select("location", "code", "norm").distinct()


RESOLVED = f"""WITH {CANDIDATES}, {NORMED}, {CODES}, {ALIASES}, {TERRITORY},
each AS (SELECT location, pos, cand.norm, tc.codes AS t, ac.codes AS a FROM cand LEFT JOIN tc ON tc.norm = cand.norm LEFT JOIN ac ON ac.norm = cand.norm),
ev AS (SELECT location, pos, t[1] AS code, 2 AS score, norm FROM each WHERE len(t) = 1 UNION ALL SELECT location, pos, a[1], 3, norm FROM each WHERE len(a) = 1 AND (t IS NULL OR (len(t) = 1 AND t[1] = a[1]))),
un AS (SELECT location, bool_or(coalesce(len(t), 0) > 1 OR coalesce(len(a), 0) > 1 OR (coalesce(len(a), 0) = 1 AND t IS NOT NULL AND NOT (len(t) = 1 AND t[1] = a[1]))) AS u FROM each GROUP BY location),
best AS (SELECT location, code, max(score) AS score, arg_min(norm, (-score, pos)) AS norm FROM ev GROUP BY ALL),
e AS (SELECT location, count(*) AS n, any_value(code) AS code, any_value(score) AS score, any_value(norm) AS norm, string_agg(code, ',' ORDER BY code) AS codes FROM best GROUP BY location),
j AS (SELECT p.location, {norm('p.location')} AS full_norm, tt.code AS tcode, tt.norm AS tnorm, cc.codes AS cc, CASE WHEN upper(p.location) IN (SELECT code FROM {{countries}}) THEN upper(p.location) END AS iso, e.*, un.u FROM parts p
  LEFT JOIN tt ON tt.location = p.location LEFT JOIN cc ON cc.norm = {norm('p.location')} LEFT JOIN e ON e.location = p.location LEFT JOIN un ON un.location = p.location),
r AS (SELECT location, CASE WHEN tcode IS NOT NULL THEN ['high', 'explicit-territory', tcode, tnorm, NULL] WHEN len(cc) = 1 THEN ['high', 'recognized-place-with-admin', cc[1], full_norm, NULL]
  WHEN len(cc) > 1 THEN ['ambiguous', 'ambiguous-compound-place', NULL, full_norm, array_to_string(cc, ',')] WHEN iso IS NOT NULL THEN ['high', 'country-code', iso, location, NULL]
  WHEN n = 1 AND score = 3 THEN ['high', 'explicit-country', code, norm, NULL] WHEN n = 1 THEN ['medium', 'recognized-place', code, norm, NULL]
  WHEN n > 1 THEN ['ambiguous', 'conflicting-place-evidence', NULL, full_norm, codes] WHEN u THEN ['ambiguous', 'ambiguous-place', NULL, full_norm, ''] ELSE ['unknown', 'unrecognized-location', NULL, NULL, NULL] END AS v FROM j),
res AS (SELECT l.id, l.location, coalesce(v, ['unknown', 'missing-location', NULL, NULL, NULL]) AS v FROM {{locations}} l LEFT JOIN r ON r.location = l.location)"""


def _resolved(b) -> DataFrame:
    return attribution.resolve_location(b("locations"), catalogue(b), _terms(b), names=_territories(b))


@register("resolve_location", RESOLVED + " SELECT id, location, v[3] IS NOT NULL AS accepted, v[1] AS confidence, v[2] AS evidence, v[3] AS country_code, v[4] AS matched, v[5] AS conflicts FROM res")
def _(b):
    a = "attribution."
    return _resolved(b).select("id", "location", a + "accepted", a + "confidence", a + "evidence", a + "country_code", a + "matched", F.array_join(a + "conflicts", ",").alias("conflicts"))


@register("filter_accepted", RESOLVED + " SELECT id, v[3] AS country_code FROM res WHERE v[3] IS NOT NULL")
def _(b):
    return attribution.filter_accepted(_resolved(b), b("countries")).select("id", "attribution.country_code")


@register("attribution_outcomes", RESOLVED + " SELECT count(*) AS seen, count(v[3]) AS attributed, count(*) FILTER (v[1] = 'ambiguous') AS ambiguous, count(*) FILTER (v[1] = 'unknown') AS unknown FROM res")
def _(b):
    return attribution.attribution_outcomes(_resolved(b))


def _config(b) -> DataFrame:
    """Configuration of all countries with norms; shared places are ambiguous."""
    cfg = catalog.config_terms(catalogue(b), index_terms(b), overrides(b)).filter("kind NOT IN ('search', 'geography')")
    cfg = gazetteer.normed(cfg)
    shared = cfg.filter("kind = 'place'").groupBy("norm").agg(F.count_distinct("code").alias("n")).filter("n > 1").select("norm")
    bad = cfg.filter("kind = 'place'").join(shared, "norm", "left_semi").withColumn("kind", F.lit("ambiguous"))
    return cfg.unionByName(bad)


ATTRIBUTED = f"""WITH {CONFIG}, {ALIASES}, f AS (SELECT code, kind, term, {norm('term')} AS norm, min((l, seq)) AS ord FROM cfg WHERE kind NOT IN ('search', 'geography') GROUP BY ALL),
amb AS (SELECT norm FROM f WHERE kind = 'place' GROUP BY norm HAVING count(DISTINCT code) > 1), pr AS (SELECT DISTINCT location, code, {norm('location')} AS n FROM {{pairs}}),
rg AS (SELECT * FROM al UNION SELECT unnest(['US', 'US', 'GB', 'GB', 'AE', 'AE']), unnest(['usa', 'u s a', 'uk', 'u k', 'uae', 'u a e'])),
fr AS (SELECT location, code, string_agg(c || ':' || name, ',' ORDER BY c) AS fs FROM (SELECT pr.location, pr.code, rg.code AS c, arg_min(rg.norm, (length(rg.norm), rg.norm)) AS name FROM pr JOIN rg ON rg.code <> pr.code AND (' ' || n || ' ') LIKE ('% ' || rg.norm || ' %') GROUP BY ALL) q GROUP BY location, code),
sp AS (SELECT location, code, n, unnest(list_concat([location], string_split_regex(location, '[,/|;]+'))) AS p, generate_subscripts(list_concat([location], string_split_regex(location, '[,/|;]+')), 1) AS i FROM pr),
cd AS (SELECT location, code, n, {norm('p')} AS norm, min(i) AS pos FROM sp WHERE {norm('p')} <> '' GROUP BY ALL),
x AS (SELECT pr.*, (SELECT arg_min(term, (ord, term)) FROM f WHERE f.code = pr.code AND kind = 'alias' AND (' ' || n || ' ') LIKE ('% ' || norm || ' %')) AS alias,
  (SELECT fs FROM fr WHERE fr.location = pr.location AND fr.code = pr.code) AS foreign_codes,
  (SELECT min(term) FROM f WHERE f.code = pr.code AND kind = 'compound' AND norm = n) AS compound, (SELECT min(term) FROM f WHERE f.code = pr.code AND kind = 'exact' AND norm = n) AS exact,
  (SELECT min(term) FROM f WHERE f.code = pr.code AND kind = 'exact' AND norm <> n AND norm = split_part(n, ' ', -1) AND EXISTS (SELECT 1 FROM cd JOIN f g ON g.code = cd.code AND g.norm = cd.norm AND g.kind IN ('place', 'curated') WHERE cd.location = pr.location AND cd.code = pr.code AND cd.norm <> f.norm AND cd.norm <> n)) AS context,
  (SELECT arg_min([cd.norm, CASE WHEN cd.norm IN (SELECT norm FROM amb) THEN '1' ELSE '0' END], pos) FROM cd WHERE cd.location = pr.location AND cd.code = pr.code AND cd.norm IN (SELECT norm FROM f WHERE f.code = pr.code AND kind = 'place')) AS place,
  (SELECT arg_min(term, (ord, term)) FROM f WHERE f.code = pr.code AND kind = 'curated' AND (' ' || n || ' ') LIKE ('% ' || norm || ' %')) AS curated FROM pr)
SELECT location, code, v[1] IN ('high', 'medium') AS accepted, v[1] AS confidence, v[2] AS evidence, v[3] AS matched, v[4] AS conflicts FROM (SELECT location, code, CASE WHEN {BLANK('location')} = '' THEN ['unknown', 'missing-location', NULL, NULL]
  WHEN (alias IS NOT NULL OR exact IS NOT NULL) AND foreign_codes IS NOT NULL THEN ['ambiguous', 'multiple-countries', NULL, foreign_codes] WHEN foreign_codes IS NOT NULL THEN ['unknown', 'foreign-country', NULL, foreign_codes]
  WHEN alias IS NOT NULL THEN ['high', 'explicit-country', alias, NULL] WHEN compound IS NOT NULL THEN ['high', 'recognized-place-with-admin', n, NULL] WHEN context IS NOT NULL THEN ['high', 'country-code-with-place', coalesce(exact, context), NULL]
  WHEN exact IS NOT NULL THEN ['high', 'country-code', exact, NULL] WHEN place[2] = '1' THEN ['ambiguous', 'ambiguous-place', place[1], NULL] WHEN place[2] = '0' THEN ['medium', 'recognized-place', place[1], NULL]
  WHEN curated IS NOT NULL THEN ['medium', 'curated-location', curated, NULL] ELSE ['unknown', 'unrecognized-location', NULL, NULL] END AS v FROM x) q"""


@register("attribute_location", ATTRIBUTED)
def _(b):
    out = attribution.attribute_location(b("pairs"), _config(b), attribution.region_rows(attribution.alias_rows(catalogue(b))))
    a = "attribution."
    return out.select("location", "code", a + "accepted", a + "confidence", a + "evidence", a + "matched", F.array_join(F.transform(a + "conflicts", lambda x: F.concat(x["code"], F.lit(":"), x["name"])), ",").alias("conflicts"))


@register("curated_places", f"WITH {CONFIG}, {CANDIDATES}, f AS (SELECT DISTINCT code, {norm('term')} AS norm FROM cfg WHERE kind IN ('place', 'curated')) SELECT DISTINCT location, code, cand.norm FROM cand JOIN f ON f.norm = cand.norm WHERE lower(code) <> cand.norm")
def _(b):
    return attribution.curated_places(attribution.candidate_rows(_keys(b)), _config(b))


@register("owner_repo_join", "SELECT owner, name_with_owner, seq FROM {repos} WHERE owner IN (SELECT c_name FROM {customer} WHERE c_mktsegment = 'BUILDING')")
def _(b):
    owners = b("customer").filter("c_mktsegment = 'BUILDING'").select(F.col("c_name").alias("owner"))
    return discovery.owner_repo_join(owners, b("repos"), ["owner"]).select("owner", "name_with_owner", "seq")


def _status(b) -> DataFrame:
    return status.status_join(b("countries").select("code", "name"), readers.current_rankings(b("published")), b("progress"), b("repo_progress"))


LIVE = "pub AS (SELECT * FROM {published} WHERE methodology_version = '0.8.0-repository-first' OR (code = 'LK' AND methodology_version = '0.2.0-poc'))"
STATUS = "st AS (SELECT c.code, c.name, pub.generated_at, p.phase, p.next_term_index AS done, p.terms_total AS total, p.updated_at AS pu, r.updated_at AS ru, pub.code IS NOT NULL AS a, p.code IS NOT NULL AS b, r.code IS NOT NULL AS d FROM {countries} c LEFT JOIN pub ON pub.code = c.code LEFT JOIN {progress} p ON p.code = c.code LEFT JOIN {repo_progress} r ON r.code = c.code)"


@register("status_join", f"WITH {LIVE}, {STATUS} SELECT code, generated_at, phase, done, ru FROM st")
def _(b):
    return _status(b).select("code", "published.generated_at", "progress.phase", F.col("progress.next_term_index").alias("done"), F.col("repo_progress.updated_at").alias("ru"))


@register("country_status", f"""WITH {LIVE}, {STATUS} SELECT code, name, CASE WHEN NOT b AND NOT d THEN CASE WHEN a THEN '🟢 **Live**' ELSE '⚪ Queued' END WHEN NOT b THEN CASE WHEN a THEN '🟢 **Live**' ELSE '🟡 Repository scan' END
  WHEN phase = 'complete' THEN CASE WHEN a THEN '**Live**' ELSE 'Completed' END ELSE CASE WHEN a THEN '🟢 **Live** · ' ELSE '' END || '🟡 ' || CASE WHEN phase = 'finalize' THEN 'Finalizing' ELSE 'Building ' || CASE WHEN total > 0 THEN least(100, floor(done / total * 100))::INT ELSE 0 END || '%' END END AS status,
  coalesce(ru, pu, generated_at) AS updated_at FROM st""")
def _(b):
    return status.country_status(_status(b))


@register("status_counts", f"WITH {LIVE}, {STATUS} SELECT count(*) AS indexed, count(*) FILTER (a) AS live, count(*) FILTER ((b AND coalesce(phase, '') <> 'complete') OR d) AS building, count(*) FILTER (NOT a AND NOT b AND NOT d) AS queued FROM st")
def _(b):
    return status.status_counts(_status(b))


@register("unpublished_countries", f"WITH {LIVE} SELECT code FROM {{countries}} WHERE code NOT IN (SELECT code FROM pub)")
def _(b):
    return status.unpublished_countries(b("countries"), readers.current_rankings(b("published"))).select("code")


@register("queued_countries", f"WITH {LIVE} SELECT code FROM {{countries}} EXCEPT (SELECT code FROM pub UNION SELECT code FROM {{progress}} UNION SELECT code FROM {{repo_progress}})")
def _(b):
    return status.queued_countries(b("countries"), readers.current_rankings(b("published")), b("progress"), b("repo_progress"))


@register("building_countries", "SELECT code FROM {progress} WHERE phase <> 'complete' UNION SELECT code FROM {repo_progress}")
def _(b):
    return status.building_countries(b("progress"), b("repo_progress"))


@register("discovery_terms", f"""WITH {CONFIG}, amb AS (SELECT {norm('term')} AS norm FROM {{raw_terms}} WHERE kind = 'discovery' GROUP BY 1 HAVING count(DISTINCT code) > 1),
f AS (SELECT code, {norm('term')} AS norm, arg_min(term, (l2, seq, term)) AS term FROM (SELECT *, CASE WHEN kind = 'search' THEN 0 ELSE 1 END AS l2 FROM cfg WHERE kind IN ('search', 'geography')) q GROUP BY ALL)
SELECT code, norm, term FROM f WHERE norm NOT IN (SELECT norm FROM amb) OR (code, norm) IN (SELECT code, {norm('term')} FROM cfg WHERE kind = 'alias')""")
def _(b):
    cfg = gazetteer.normed(catalog.config_terms(catalogue(b), index_terms(b), overrides(b)))
    bad = gazetteer.ambiguous_terms(_terms(b)).select("code", F.lit("ambiguous").alias("kind"), F.col("norm").alias("term"), F.lit(0).cast("bigint").alias("seq"), "norm")
    return discovery.discovery_terms(cfg.unionByName(bad.select(*cfg.columns)))


@register("state_reconcile", "SELECT code, 'h' || k % 3 AS sha256, coalesce(k % 3 = 0 AND k % 2 = 0 AND k % 5 <> 4, false) AS kept, CASE WHEN k % 3 = 0 AND k % 2 = 0 AND k % 5 <> 4 THEN k * 7 ELSE 0 END::BIGINT AS next_term_index, CASE WHEN k % 3 = 0 AND k % 2 = 0 AND k % 5 <> 4 THEN 'finalize' ELSE 'discovery' END AS phase, CASE WHEN k % 5 <> 4 THEN k ELSE 0 END::BIGINT AS candidates FROM {countries}")
def _(b):
    now = b("countries").select("code", F.lit(1).alias("cycle"), F.concat(F.lit("h"), F.col("k") % 3).alias("sha256"), F.lit(10).alias("terms_total"))
    old = b("countries").filter("k % 5 <> 4").select("code", F.lit(2).alias("schema_version"), (1 + F.col("k") % 2).alias("cycle"), F.lit("h0").alias("sha256"), F.lit(10).alias("terms_total"), (F.col("k") * 7).alias("next_term_index"), F.lit("finalize").alias("phase"), F.col("k").alias("candidates"))
    return discovery.state_reconcile(now, old).select("code", "sha256", "kept", "next_term_index", "phase", "candidates")


# -- gazetteer


@register("term_countries", f"WITH {NORMED} SELECT norm, string_agg(DISTINCT code, ',' ORDER BY code) AS codes, count(DISTINCT code) AS n FROM nt GROUP BY norm")
def _(b):
    return gazetteer.term_countries(_terms(b)).withColumn("codes", F.array_join("codes", ","))


@register("ambiguous_terms", f"WITH {NORMED} SELECT DISTINCT code, norm FROM nt WHERE kind = 'discovery' AND norm IN (SELECT norm FROM nt WHERE kind = 'discovery' GROUP BY norm HAVING count(DISTINCT code) > 1)")
def _(b):
    return gazetteer.ambiguous_terms(_terms(b))


def nested(b) -> DataFrame:
    """The nested source: nations hold their segments as states, and those their customers as cities."""
    c = b("customer").join(b("countries"), F.col("k") == F.col("c_nationkey"))
    state = c.groupBy("code", "c_mktsegment").agg(F.collect_list(F.struct(F.col("c_name").alias("name"), F.upper("c_name").alias("native"), F.concat("code", F.lit("-0"), F.col("c_custkey") % 9).alias("state_code"))).alias("cities"))
    states = state.groupBy("code").agg(F.collect_list(F.struct(F.col("c_mktsegment").alias("name"), F.lit(None).cast("string").alias("native"), F.substring("c_mktsegment", 1, 2).alias("iso2"), "cities")).alias("states"))
    return b("countries").join(states, "code", "left").select(F.lower("code").alias("iso2"), F.concat(F.lit(" "), "name").alias("name"), F.lit("").alias("native"), F.create_map(F.lit("fr"), F.concat(F.lit("Le "), "name")).alias("translations"), "states")


BUILT = """cu AS (SELECT code, c_mktsegment AS s, c_name AS c, '0' || c_custkey % 9 AS a, name FROM {customer} JOIN {countries} ON k = c_nationkey),
ad AS (SELECT code, unnest(['attribution', 'discovery']) AS kind, term FROM (SELECT code, s AS term FROM cu UNION SELECT code, c FROM cu UNION SELECT code, upper(c) FROM cu UNION SELECT code, name FROM {countries} UNION SELECT code, 'Le ' || name FROM {countries}) q),
built AS (SELECT * FROM ad UNION SELECT code, 'compound', n || ', ' || x FROM (SELECT code, unnest([c, upper(c)]) AS n, s, a FROM cu) q, LATERAL (SELECT unnest([s, s[:2], code || '-' || a, a]) AS x) l)"""


@register("geo_build", f"WITH {BUILT} SELECT code, kind, term FROM built")
def _(b):
    return gazetteer.geo_build(nested(b), b("countries").select("code", "name"))


ENRICHED = BUILT + """, pl AS (SELECT upper(trim(country_code)) AS code, name, ascii_name, alternates, admin1 FROM {places} WHERE upper(trim(country_code)) IN (SELECT code FROM {countries})),
enr AS (SELECT * FROM built UNION SELECT code, unnest(['attribution', 'discovery']), n FROM (SELECT code, unnest([name, ascii_name]) AS n FROM pl) q UNION SELECT code, 'attribution', trim(t) FROM (SELECT code, unnest(string_split(alternates, ',')) AS t FROM pl) q WHERE trim(t) <> ''
  UNION SELECT code, 'compound', n || ', ' || admin1 FROM (SELECT code, admin1, unnest([name, ascii_name]) AS n FROM pl WHERE admin1 <> '') q)"""


SOURCED = "src AS (SELECT code, count(DISTINCT c_mktsegment)::INT AS states, count(c_custkey)::INT AS city_records, count(DISTINCT c_name)::INT + count(DISTINCT upper(c_name))::INT AS primary_cities, count(DISTINCT c_mktsegment)::INT AS primary_admins FROM {countries} LEFT JOIN {customer} ON k = c_nationkey GROUP BY code)"


def _enriched(b) -> DataFrame:
    known = b("countries").select("code", "name")
    return gazetteer.geo_enrich(gazetteer.geo_build(nested(b), known), b("places"), known)


@register("geo_enrich", f"WITH {ENRICHED} SELECT code, kind, term FROM enr")
def _(b):
    return _enriched(b)


@register("geo_counts", f"""WITH {ENRICHED}, per AS (SELECT code, count(*) FILTER (kind = 'attribution') AS a, count(*) FILTER (kind = 'discovery') AS d, count(*) FILTER (kind = 'compound') AS c FROM enr GROUP BY code), {SOURCED},
  gr AS (SELECT code, count(*) AS g FROM pl GROUP BY code)
SELECT code, sum(a)::BIGINT AS attribution_terms, sum(d)::BIGINT AS discovery_terms, sum(c)::BIGINT AS compound_terms, sum(states)::BIGINT AS states, sum(city_records)::BIGINT AS city_records, sum(primary_cities)::BIGINT AS primary_cities, sum(primary_admins)::BIGINT AS primary_admins, coalesce(sum(g), 0)::BIGINT AS place_rows
FROM per FULL JOIN src USING (code) FULL JOIN gr USING (code) GROUP BY ROLLUP (code)""")
def _(b):
    places = catalog.filter_catalog(b("places"), b("countries").select("code"), "country_code")
    return gazetteer.geo_counts(_enriched(b), nested(b).withColumn("code", F.upper("iso2")), places)


@register("resolver_stats", f"WITH {NORMED}, {ALIASES} SELECT (SELECT count(*) FROM {{countries}}) AS countries, (SELECT count(DISTINCT norm) FROM al) AS country_aliases, count(DISTINCT CASE WHEN kind = 'attribution' THEN norm END) AS location_terms, count(DISTINCT CASE WHEN kind = 'compound' THEN norm END) AS compound_terms FROM nt")
def _(b):
    return gazetteer.resolver_stats(attribution.alias_rows(catalogue(b)), _terms(b))


# -- discovery


@register("owner_dedupe", """WITH h AS (SELECT *, CASE confidence WHEN 'high' THEN 2 WHEN 'medium' THEN 1 ELSE 0 END AS w FROM {hits} WHERE accepted) SELECT login, arg_min(location, seq) AS location, arg_max(id, seq) FILTER (id IS NOT NULL) AS id, string_agg(DISTINCT search_term, ',' ORDER BY search_term) AS terms,
  arg_min(confidence, (-w, seq)) AS confidence, arg_min(evidence, (-w, seq)) AS evidence, count(*) AS hits FROM h GROUP BY login""")
def _(b):
    return discovery.owner_dedupe(b("hits")).withColumn("terms", F.array_join("terms", ","))


@register("owner_rejects", "SELECT login, arg_max(location, seq) AS location, arg_max(evidence, seq) AS reason FROM {hits} GROUP BY login HAVING NOT bool_or(accepted)")
def _(b):
    return discovery.owner_rejects(b("hits"))


@register("owner_top_stars", "SELECT country, owner, greatest(0, max(stars))::BIGINT AS top_stars FROM {sources} GROUP BY ALL")
def _(b):
    return ranking.owner_top_stars(b("sources"), ["country", "owner"])


def _pools(b) -> tuple[DataFrame, DataFrame]:
    rows = b("pool_rows").withColumn("terms", F.array("term"))
    one = rows.groupBy("country", "login", "old").agg(F.max_by(F.struct("seq", "stars", "repository", "confidence"), "seq").alias("r"), F.array_sort(F.collect_set("term")).alias("terms"))
    flat = one.select("country", "login", "old", "r.*", "terms")
    return flat.filter("old").drop("old"), flat.filter("NOT old").drop("old")


MERGED = """a AS (SELECT country, login, old, max(seq) AS seq, arg_max(stars, seq) AS stars, arg_max(repository, seq) AS repository, arg_max(confidence, seq) AS confidence, list(DISTINCT term) AS terms FROM {pool_rows} GROUP BY ALL),
m AS (SELECT country, login, arg_max(seq, CASE WHEN old THEN 0 ELSE 1 END) AS seq, arg_min(confidence, (-CASE confidence WHEN 'high' THEN 2 WHEN 'medium' THEN 1 ELSE 0 END, CASE WHEN old THEN 0 ELSE 1 END)) AS confidence, array_to_string(list_sort(list_distinct(flatten(list(terms)))), ',') AS terms,
  max(stars) AS stars, arg_max(repository, (stars, CASE WHEN old THEN 0 ELSE 1 END)) AS repository FROM a GROUP BY country, login)"""


@register("pool_merge", f"WITH {MERGED} SELECT * FROM m")
def _(b):
    return ranking.pool_merge(*_pools(b)).withColumn("terms", F.array_join("terms", ","))


@register("pool_truncate", f"WITH {MERGED} SELECT country, login, stars FROM (SELECT *, rank() OVER (PARTITION BY country ORDER BY stars DESC) AS r FROM m) q WHERE r <= 20")
def _(b):
    return ranking.pool_truncate(ranking.pool_merge(*_pools(b)), limit=20).select("country", "login", "stars")


@register("coverage_counts", """WITH t AS (SELECT country, owner, top_stars FROM (SELECT *, rank() OVER (PARTITION BY country ORDER BY top_stars DESC) AS r FROM {tops}) q WHERE r <= 10),
o AS (SELECT country, login, bool_or(accepted) AS a, count(*) AS n FROM {hits} GROUP BY ALL), base AS (SELECT country, sum(n)::BIGINT AS raw_hits, count(*) FILTER (a) AS accepted_owners, count(*) FILTER (NOT a) AS rejected_owners FROM o GROUP BY country)
SELECT country, raw_hits, accepted_owners, rejected_owners, coalesce((SELECT count(*) FROM t WHERE t.country = base.country), 0) AS candidate_owners, (SELECT min(top_stars) FROM t WHERE t.country = base.country) AS threshold, (SELECT count(DISTINCT name_with_owner) FROM {latest} l WHERE l.country = base.country) AS considered,
  least((SELECT count(DISTINCT name_with_owner) FROM {latest} l WHERE l.country = base.country), 100) AS published, (SELECT count(*) FILTER (capped) FROM {summaries} s WHERE s.country = base.country) AS capped_terms FROM base""")
def _(b):
    return discovery.coverage_counts(b("hits"), ranking.candidate_owners(b("tops"), limit=10), b("latest"), b("summaries"))


@register("certified_coverage", """WITH p AS (SELECT *, row_number() OVER (PARTITION BY country ORDER BY stars DESC, forks DESC, name_with_owner) AS r FROM {latest}) SELECT country, count(DISTINCT owner) FILTER (r <= 20) AS unique_owners, min(stars) FILTER (r <= 20) AS cut_off, count(*) FILTER (r <= 20) AS published, count(*) FILTER (r <= 25) AS pool_size FROM p GROUP BY country""")
def _(b):
    pool = ranking.repo_pool_topk(b("latest"), limit=25)
    return discovery.certified_coverage(ranking.rank_repositories(pool, limit=20), pool)


@register("query_stats", "SELECT country, term, arg_max(reported, seq) AS reported, arg_max(pages, seq) AS pages, arg_max(unresolved_n, seq) > 0 AS capped FROM {summaries} GROUP BY country, term")
def _(b):
    rows = b("summaries").select("country", "term", "seq", "reported", "pages", F.when(F.col("unresolved_n") > 0, F.sequence(F.lit(1), F.col("unresolved_n"))).alias("unresolved"))
    return discovery.query_stats(rows, ["country", "term"]).select("country", "term", "reported", "pages", "capped")


@register("discovery_stats", "SELECT country, count(*) AS terms, sum(requests)::BIGINT AS requests, sum(pages)::BIGINT AS pages, count(*) FILTER (sharded) AS splits, sum(reported)::BIGINT AS raw_hits, sum(unresolved_n)::BIGINT AS accepted, sum(requests)::BIGINT AS rejected FROM {summaries} GROUP BY country")
def _(b):
    return discovery.discovery_stats(b("summaries").withColumns({"raw_hits": F.col("reported"), "accepted": F.col("unresolved_n"), "rejected": F.col("requests")}))


@register("shard_summary", "SELECT country, term, count(*) AS queries, count(*) FILTER (NOT capped) AS leaves, sum(CASE WHEN capped THEN 0 ELSE pages END)::BIGINT AS pages, sum(CASE WHEN capped THEN 0 ELSE reported END)::BIGINT AS reported, bool_or(capped AND NOT final) AS sharded, count(*) FILTER (capped AND final) AS unresolved FROM {summaries} GROUP BY ALL")
def _(b):
    return discovery.shard_summary(b("summaries"), ["country", "term"])


@register("unresolved_shards", "SELECT country, term, query, reason, seq FROM (SELECT *, row_number() OVER (PARTITION BY country ORDER BY seq DESC, term, query, reason) AS r FROM (SELECT country, term, 'q' || pages AS query, reason, min(seq) AS seq FROM {summaries} WHERE capped AND final GROUP BY ALL) q) p WHERE r <= 50")
def _(b):
    rows = b("summaries").filter("capped AND final").withColumn("query", F.concat(F.lit("q"), F.col("pages")))
    return discovery.unresolved_shards(rows, most=50).select("country", "term", "query", "reason", "seq")


@register("terms_union", "SELECT term, row_number() OVER (ORDER BY l, s, term)::BIGINT AS seq FROM (SELECT term, min(l) AS l, arg_min(s, (l, s)) AS s FROM (SELECT o_orderpriority AS term, 0 AS l, min(o_orderkey) AS s FROM orders GROUP BY 1 UNION ALL SELECT o_orderstatus, 1, min(o_orderkey) FROM orders GROUP BY 1) q GROUP BY term) p")
def _(b):
    make = lambda c: b("orders").groupBy(F.col(c).alias("term")).agg(F.min("o_orderkey").alias("seq")).select(F.lit("x").alias("code"), F.lit("y").alias("kind"), "term", "seq")
    return catalog.ordered_terms(make("o_orderpriority"), make("o_orderstatus")).select("term", "seq")


# -- ranking

BEST = "(PARTITION BY country ORDER BY stars DESC, forks DESC, name_with_owner)"


@register("latest_repository", "SELECT name_with_owner, seq, stars, forks FROM {latest}")
def _(b):
    return ranking.latest_repository(b("sources")).select("name_with_owner", "seq", "stars", "forks")


@register("rank_repositories", f"SELECT country, rank, name_with_owner, owner, stars, forks FROM (SELECT *, row_number() OVER {BEST}::INT AS rank FROM {{latest}}) q WHERE rank <= 100")
def _(b):
    last = ranking.latest_repository(ranking.filter_non_fork(b("repos")))
    return ranking.rank_repositories(last).select("country", "rank", "name_with_owner", "owner", "stars", "forks")


CANDIDATE = "SELECT country, owner, top_stars FROM (SELECT *, rank() OVER (PARTITION BY country ORDER BY top_stars DESC) AS r FROM {tops}) q WHERE r <= 20"


@register("candidate_owners", CANDIDATE)
def _(b):
    return ranking.candidate_owners(ranking.owner_top_stars(b("latest"), ["country", "owner"]), limit=20)


@register("candidate_threshold_owners", f"SELECT country, min(top_stars) AS threshold, count(*) AS candidates FROM ({CANDIDATE}) c GROUP BY country")
def _(b):
    return ranking.candidate_threshold_owners(ranking.owner_top_stars(b("latest"), ["country", "owner"]), limit=20)


@register("pool_threshold", f"SELECT country, max(CASE WHEN r = 100 THEN stars END) AS threshold FROM (SELECT *, row_number() OVER {BEST} AS r FROM {{latest}}) q GROUP BY country")
def _(b):
    return ranking.pool_threshold(b("latest"))


@register("repo_pool_topk", f"SELECT country, name_with_owner, stars FROM (SELECT *, row_number() OVER {BEST} AS r FROM {{latest}}) q WHERE r <= 125")
def _(b):
    return ranking.repo_pool_topk(b("latest")).select("country", "name_with_owner", "stars")


@register("preview_topk", f"SELECT country, name_with_owner, r::INT AS rank FROM (SELECT *, row_number() OVER {BEST} AS r FROM {{latest}}) q WHERE r <= 20")
def _(b):
    return ranking.preview_topk(b("latest"), 20).select("country", "name_with_owner", "rank")


@register("two_stage_topn", f"SELECT country, name_with_owner, rank FROM (SELECT *, row_number() OVER {BEST}::INT AS rank FROM {{latest}}) q WHERE rank <= 100")
def _(b):
    last = ranking.latest_repository(ranking.filter_non_fork(b("repos")))
    return ranking.two_stage_topn(last.withColumn("is_fork", F.lit(False))).select("country", "name_with_owner", "rank")


# -- shards


@register("capped_buckets", "SELECT l_suppkey, count(*) AS n FROM {lineitem} GROUP BY l_suppkey HAVING count(*) > 100")
def _(b):
    return shards.capped_buckets(b("lineitem"), "l_suppkey", cap=100)


RANGES = """h AS (SELECT stars, count(*) AS n FROM {repos} GROUP BY stars), t(lo, hi, n) AS (SELECT 1::BIGINT, 600::BIGINT, (SELECT sum(n) FROM h WHERE stars BETWEEN 1 AND 600)::BIGINT
 UNION ALL SELECT c.lo, c.hi, coalesce((SELECT sum(n) FROM h WHERE stars BETWEEN c.lo AND c.hi), 0)::BIGINT FROM (SELECT unnest([{'lo': (lo + hi) // 2 + 1, 'hi': hi}, {'lo': lo, 'hi': (lo + hi) // 2}], recursive := true) FROM t WHERE n > 200 AND lo < hi) c),
 ra AS (SELECT lo AS min_stars, hi AS max_stars, coalesce(n, 0)::BIGINT AS n FROM t WHERE coalesce(n, 0) <= 200 OR lo >= hi)"""


def _ranges(b) -> DataFrame:
    return shards.split_star_ranges(shards.star_histogram(b("repos")), 1, 600, cap=200)


@register("split_star_ranges", f"WITH {RANGES} SELECT * FROM ra")
def _(b):
    return _ranges(b)


@register("star_range_rows", f"WITH {RANGES} SELECT name_with_owner, seq, stars, min_stars, max_stars FROM {{repos}} LEFT JOIN ra ON stars BETWEEN min_stars AND max_stars")
def _(b):
    return shards.rows_in_ranges(b("repos").select("name_with_owner", "seq", "stars"), _ranges(b))


#: Ranges from the highest with the requests before them; those not done within REQUESTS are open.
REQUESTS = 6
QUEUE = f"{RANGES}, qu AS (SELECT * FROM (SELECT *, sum(greatest(1, ceil(n / 100.0))) OVER (ORDER BY max_stars DESC) AS spent FROM ra) q WHERE spent > {{requests}})"
QUEUE = QUEUE.replace("{{requests}}", "{requests}")


def _queue(b, requests: int = REQUESTS) -> DataFrame:
    return shards.scan_queue(_ranges(b), requests)


@register("scan_queue", f"WITH {QUEUE.replace('{requests}', str(REQUESTS))} SELECT min_stars, max_stars, n FROM qu")
def _(b):
    return _queue(b)


@register("unresolved_star_counts", "SELECT stars FROM {histogram} WHERE n > 40")
def _(b):
    return shards.unresolved_star_counts(shards.star_histogram(b("repos")), cap=40)


FACETS = """fa AS (SELECT CASE WHEN account_type = 'Organization' THEN 'type:org' ELSE 'type:user' END AS t, followers AS f, public_repos AS p, strftime(created_at, '%Y') AS y, strftime(created_at, '%Y-%m') AS m, strftime(created_at, '%Y-%m-%d') AS d FROM {accounts}),
fb AS (SELECT t, CASE WHEN f = 0 THEN 'followers:0' WHEN f < 5 THEN 'followers:1..4' WHEN f < 10 THEN 'followers:5..9' WHEN f < 25 THEN 'followers:10..24' WHEN f < 50 THEN 'followers:25..49' WHEN f < 100 THEN 'followers:50..99' WHEN f < 250 THEN 'followers:100..249' WHEN f < 500 THEN 'followers:250..499' WHEN f < 1000 THEN 'followers:500..999'
 WHEN f < 2500 THEN 'followers:1000..2499' WHEN f < 5000 THEN 'followers:2500..4999' WHEN f < 10000 THEN 'followers:5000..9999' WHEN f < 25000 THEN 'followers:10000..24999' WHEN f < 50000 THEN 'followers:25000..49999' ELSE 'followers:>=50000' END AS f,
 CASE WHEN p = 0 THEN NULL WHEN p < 5 THEN 'repos:1..4' WHEN p < 10 THEN 'repos:5..9' WHEN p < 25 THEN 'repos:10..24' WHEN p < 50 THEN 'repos:25..49' WHEN p < 100 THEN 'repos:50..99' WHEN p < 250 THEN 'repos:100..249' WHEN p < 500 THEN 'repos:250..499' ELSE 'repos:>=500' END AS p, y, m, d FROM fa)"""


@register("facet_buckets", f"WITH {FACETS} SELECT t AS type, f AS followers, p AS repos, count(*) AS n FROM fb GROUP BY ALL")
def _(b):
    return shards.facet_buckets(b("accounts")).groupBy("type", "followers", "repos").agg(F.count("*").alias("n"))


@register("facet_shards", f"""WITH {FACETS}, fc AS (SELECT *, y BETWEEN '2008' AND '2012' AS covered FROM fb), g AS (SELECT t, f, coalesce(p, '-') AS p, CASE WHEN covered THEN y ELSE 'uncovered' END AS y, CASE WHEN covered THEN m ELSE 'uncovered' END AS m, CASE WHEN covered THEN d ELSE 'uncovered' END AS d, covered FROM fc),
c AS (SELECT *, count(*) OVER () AS n0, count(*) OVER (PARTITION BY t) AS n1, count(*) OVER (PARTITION BY t, f) AS n2, count(*) OVER (PARTITION BY t, f, p) AS n3, count(*) OVER (PARTITION BY t, f, p, y) AS n4, count(*) OVER (PARTITION BY t, f, p, y, m) AS n5, count(*) OVER (PARTITION BY t, f, p, y, m, d) AS n6 FROM g),
l AS (SELECT *, CASE WHEN n0 <= 30 THEN 0 WHEN n1 <= 30 THEN 1 WHEN n2 <= 30 THEN 2 WHEN n3 <= 30 THEN 3 WHEN n4 <= 30 OR NOT covered THEN 4 WHEN n5 <= 30 THEN 5 ELSE 6 END AS level FROM c)
SELECT level::INT AS level, CASE WHEN level >= 1 THEN t END AS type, CASE WHEN level >= 2 THEN f END AS followers, CASE WHEN level >= 3 THEN p END AS repos, CASE WHEN level >= 4 THEN y END AS year, CASE WHEN level >= 5 THEN m END AS month, CASE WHEN level >= 6 THEN d END AS day, count(*) AS n, count(*) > 30 AS capped, bool_and(level < 4 OR covered) AS covered FROM l GROUP BY ALL""")
def _(b):
    return shards.facet_shards(shards.facet_buckets(b("accounts")), cap=30, years=(shards.FIRST_YEAR, 2012))


@register("batch_chunks", "SELECT name_with_owner, (floor((row_number() OVER (PARTITION BY country ORDER BY name_with_owner) - 1) / 30))::BIGINT AS batch FROM {latest}")
def _(b):
    return shards.batch_chunks(b("latest"), 30, ["name_with_owner"], ["country"]).select("name_with_owner", "batch")


# -- certification and progress


FRONTIER = f"{QUEUE}, fr AS (SELECT greatest(coalesce((SELECT max(max_stars) FROM qu), 0), coalesce((SELECT max(stars) FROM h WHERE n > {{cap}}), 0))::BIGINT AS frontier)"


def _frontier(b, cap: int = 40, requests: int = REQUESTS) -> DataFrame:
    return certify.star_frontier(_queue(b, requests), shards.unresolved_star_counts(shards.star_histogram(b("repos")), cap=cap))


def _at(sql: str, requests: int, cap: int = 100_000) -> str:
    """sql with FRONTIER after a number of requests; no star value of the tables has over 100,000 repositories."""
    return sql.replace("{requests}", str(requests)).replace("{cap}", str(cap))


@register("star_frontier", _at(f"WITH {FRONTIER} SELECT frontier FROM fr", REQUESTS, 40))
def _(b):
    return _frontier(b)


THRESHOLDS = f"th AS (SELECT country, max(CASE WHEN r = 20 THEN stars END) AS threshold FROM (SELECT *, row_number() OVER {BEST} AS r FROM {{latest}}) q GROUP BY country)"


@register("certify_countries", _at(f"""WITH {FRONTIER}, {THRESHOLDS}
SELECT th.country, threshold, frontier, coalesce(CASE WHEN k % 6 = 0 THEN 'before' END, CASE WHEN threshold > frontier THEN 'now' END) AS certified_at FROM th JOIN {{countries}} ON code = th.country, fr""", 9))
def _(b):
    earlier = b("countries").filter("k % 6 = 0").select(F.col("code").alias("country"), F.lit("before").alias("certified_at"))
    return certify.certify_countries(b("latest"), _frontier(b, 100_000, 9), earlier, "now", limit=20)


@register("changed_countries", "SELECT DISTINCT country FROM {repos}")
def _(b):
    return certify.changed_countries(b("repos"))


@register("resume_progress", """WITH e AS (SELECT *, row_number() OVER (PARTITION BY code ORDER BY seq) AS i FROM {term_events}),
f AS (SELECT code, 0::BIGINT AS i, next_term_index AS nx, terms_total AS total, terms_processed AS p, active_term AS t, active_since AS since, 0::BIGINT AS d, completed_at AS c, NULL::VARCHAR AS u FROM {term_states}
 UNION ALL SELECT f.code, e.i, CASE WHEN kind = 'finish' AND since IS NOT NULL THEN nx + 1 ELSE nx END, total, CASE WHEN kind = 'finish' AND since IS NOT NULL THEN p + 1 ELSE p END, CASE kind WHEN 'begin' THEN CASE WHEN since IS NULL THEN e.term ELSE t END WHEN 'finish' THEN NULL ELSE t END,
  CASE kind WHEN 'begin' THEN coalesce(since, e.at) WHEN 'finish' THEN NULL ELSE since END, CASE kind WHEN 'finish' THEN 0 WHEN 'defer' THEN CASE WHEN since IS NULL THEN 0 ELSE d + 1 END ELSE d END,
  coalesce(c, CASE WHEN kind = 'finish' AND since IS NOT NULL AND nx + 1 >= total THEN e.at END), e.at FROM f JOIN e ON e.code = f.code AND e.i = f.i + 1)
SELECT code, arg_max(nx, i) AS next_term_index, any_value(total) AS terms_total, arg_max(p, i) AS terms_processed, CASE WHEN max(nx) >= any_value(total) THEN 'complete' ELSE 'discovery' END AS phase, arg_max(CASE WHEN since IS NULL THEN -1 ELSE nx END, i) AS active_index,
 arg_max(coalesce(t, '-'), i) AS active_term, arg_max(coalesce(since, '-'), i) AS active_since, arg_max(d, i) AS deferrals, max(c) AS completed_at, max(c) AS finalized_at, arg_max(coalesce(u, '-'), i) AS updated_at FROM f GROUP BY code""")
def _(b):
    """The DuckDB SQL goes event by event."""
    out = status.resume_progress(b("term_states"), b("term_events"))
    named = {c: F.coalesce(c, F.lit("-")) for c in ("active_term", "active_since", "updated_at")}
    return out.withColumns({**named, "active_index": F.coalesce("active_index", F.lit(-1))})
