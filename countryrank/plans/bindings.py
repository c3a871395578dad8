"""The given tables as inputs of the library: SQL that Spark and DuckDB both read, with {names} for what it reads."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = {"region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "pages", "labels"}

BINDINGS = {
    "countries": "SELECT n_nationkey AS k, concat('A', chr(65 + n_nationkey)) AS code, n_name AS name, r_name AS region FROM {nation} JOIN {region} ON n_regionkey = r_regionkey",
    "aliases": "SELECT code, concat('Republic of ', name) AS alias, 0 AS seq FROM {countries} UNION ALL SELECT code, region AS alias, 1 AS seq FROM {countries}",
    # repositories: many rows of a name, ties of stars
    "repos": """SELECT n.code AS country, c_name AS owner, concat(c_name, '/', CAST(o_orderkey % 20 AS STRING)) AS name_with_owner, CAST(o_orderkey AS BIGINT) AS seq,
        CAST(floor(o_totalprice / 1000) AS BIGINT) AS stars, CAST(o_orderkey % 97 AS BIGINT) AS forks, o_orderstatus = 'P' AS is_fork, o_orderpriority AS language,
        o_orderdate AS created_at, c_mktsegment AS segment FROM {orders} JOIN {customer} ON o_custkey = c_custkey JOIN {countries} n ON n.k = c_nationkey""",
    "sources": "SELECT country, owner, name_with_owner, seq, stars, forks, language FROM {repos} WHERE NOT is_fork",
    "latest": "SELECT country, owner, name_with_owner, seq, stars, forks, language FROM (SELECT *, row_number() OVER (PARTITION BY name_with_owner ORDER BY seq DESC) AS rn FROM {sources}) q WHERE rn = 1",
    "tops": "SELECT country, owner, CAST(max(stars) AS BIGINT) AS top_stars FROM {latest} GROUP BY country, owner",
    # places of the gazetteer
    "raw_terms": """SELECT code, 'attribution' AS kind, c_name AS term FROM {customer} JOIN {countries} ON k = c_nationkey
        UNION ALL SELECT code, 'attribution', c_mktsegment FROM {customer} JOIN {countries} ON k = c_nationkey
        UNION ALL SELECT code, 'attribution', s_name FROM {supplier} JOIN {countries} ON k = s_nationkey
        UNION ALL SELECT code, 'attribution', name FROM {countries}
        UNION ALL SELECT code, 'discovery', name FROM {countries}
        UNION ALL SELECT code, 'discovery', c_mktsegment FROM {customer} JOIN {countries} ON k = c_nationkey
        UNION ALL SELECT code, 'discovery', c_name FROM {customer} JOIN {countries} ON k = c_nationkey
        UNION ALL SELECT code, 'compound', concat(c_mktsegment, ', ', name) FROM {customer} JOIN {countries} ON k = c_nationkey
        UNION ALL SELECT code, 'compound', concat(c_mktsegment, ', ', region) FROM {customer} JOIN {countries} ON k = c_nationkey""",
    "places": """SELECT c_name AS name, upper(c_name) AS ascii_name, concat(c_name, ' Town,', c_mktsegment, ' City,,', c_name) AS alternates,
        CASE WHEN c_custkey % 13 = 0 THEN 'ZZ' WHEN c_custkey % 2 = 0 THEN lower(code) ELSE concat(' ', code) END AS country_code,
        CASE WHEN c_custkey % 4 = 0 THEN '' ELSE concat('0', CAST(c_custkey % 9 AS STRING)) END AS admin1 FROM {customer} JOIN {countries} ON k = c_nationkey""",
    # free-text locations
    "locations": """SELECT c_custkey AS id, n.code AS own, o.code AS other, CASE c_custkey % 13 WHEN 0 THEN n.name WHEN 1 THEN concat(c_name, ', ', n.name) WHEN 2 THEN c_mktsegment
        WHEN 3 THEN concat(c_mktsegment, ',  ', n.name) WHEN 4 THEN concat(n.name, ' / ', o.name) WHEN 5 THEN lower(n.code) WHEN 6 THEN '' WHEN 7 THEN c_name
        WHEN 8 THEN concat(c_name, ', ', n.code) WHEN 9 THEN concat(c_name, ', USA') WHEN 10 THEN concat(chr(9), ' ') WHEN 11 THEN chr(160) ELSE concat('Somewhere near ', c_name, ' & ', n.region) END AS location
        FROM {customer} JOIN {countries} n ON n.k = c_nationkey JOIN {countries} o ON o.k = (c_nationkey + 1) % 25""",
    "pairs": "SELECT location, own AS code FROM {locations} UNION SELECT location, other AS code FROM {locations}",
    # owner hits of overlapping searches
    "hits": """SELECT concat('u', CAST(user_id AS STRING)) AS login, event_type AS search_term, CAST(event_id AS BIGINT) AS seq, CASE WHEN event_id % 3 = 0 THEN NULL ELSE concat('id', CAST(event_id AS STRING)) END AS id,
        concat('loc', CAST(event_id % 17 AS STRING)) AS location, event_type NOT IN ('error', 'signup') OR user_id % 5 = 0 AS accepted_raw,
        user_id % 4 <> 1 AND event_type NOT IN ('error') AS accepted, CASE WHEN event_type = 'view' THEN 'high' WHEN event_type = 'error' THEN 'unknown' ELSE 'medium' END AS confidence,
        concat('e-', event_type) AS evidence, CAST(floor(value) AS BIGINT) AS stars, concat('A', chr(CAST(65 + user_id % 25 AS INT))) AS country FROM {events}""",
    # raw search pages of three runs in the order of seq: owners with locations, and owners hit for two target countries
    "located": """SELECT l.id AS customer, CAST(floor(r.seq * 3 / (m.last + 1)) AS INT) AS page, r.seq, r.name_with_owner, r.owner, r.stars, r.forks, r.is_fork, r.language, l.location, l.own, l.other
        FROM {repos} r JOIN {customer} ON c_name = r.owner JOIN {locations} l ON l.id = c_custkey JOIN (SELECT max(seq) AS last FROM {repos}) m ON TRUE""",
    "owner_hits": """SELECT page, own AS code, seq * 2 AS seq, owner AS login, name_with_owner AS repository, stars, language AS term, CASE WHEN page = 1 THEN concat(location, ', ', owner) ELSE location END AS location FROM {located}
        UNION ALL SELECT page, other, seq * 2 + 1, owner, name_with_owner, stars, language, CASE WHEN page = 2 THEN owner ELSE location END FROM {located}""",
    "owner_pairs": "SELECT DISTINCT location, code FROM {owner_hits}",
    # candidate pools before and after a date
    "pool_rows": """SELECT n.code AS country, c_name AS login, CAST(o_orderkey AS BIGINT) AS seq, CAST(floor(o_totalprice / 1000) AS BIGINT) AS stars, concat(c_name, '/', CAST(o_orderkey % 20 AS STRING)) AS repository,
        CASE WHEN o_orderkey % 3 = 0 THEN 'high' WHEN o_orderkey % 3 = 1 THEN 'medium' ELSE 'unknown' END AS confidence, o_orderpriority AS term, o_orderdate < TIMESTAMP '1997-01-01 00:00:00' AS old
        FROM {orders} JOIN {customer} ON o_custkey = c_custkey JOIN {countries} n ON n.k = c_nationkey""",
    # accounts for shards
    "accounts": """SELECT CASE WHEN c_custkey % 3 = 0 THEN 'Organization' ELSE 'User' END AS account_type, CAST(floor(o_totalprice / 100) AS BIGINT) AS followers, CAST(o_orderkey % 300 AS BIGINT) AS public_repos,
        o_orderdate + INTERVAL 15 YEAR AS created_at FROM {orders} JOIN {customer} ON o_custkey = c_custkey""",
    # five spellings of each name
    "spellings": "SELECT c_mktsegment AS segment, concat(CASE c_custkey % 5 WHEN 0 THEN 'É' WHEN 1 THEN 'e' WHEN 2 THEN 'E' WHEN 3 THEN 'è' ELSE 'Zü' END, 'n', CASE WHEN c_custkey % 2 = 0 THEN upper(c_mktsegment) ELSE c_mktsegment END, ' ', CAST(CAST(floor(c_custkey / 10) AS INT) AS STRING)) AS term FROM {customer}",
    "histogram": "SELECT stars, count(*) AS n FROM {repos} GROUP BY stars",
    # progress of countries
    "published": "SELECT CASE WHEN k = 15 THEN 'LK' ELSE code END AS code, name, CASE k % 4 WHEN 0 THEN '0.8.0-repository-first' WHEN 1 THEN '0.5.0-resumable-global-crawl' WHEN 2 THEN '0.8.0-repository-first' ELSE '0.2.0-poc' END AS methodology_version, concat('2026-10-0', CAST(1 + k % 9 AS STRING)) AS generated_at, CAST(90 + k AS BIGINT) AS published_repositories FROM {countries} WHERE k % 3 <> 2",
    "progress": "SELECT code, CASE WHEN k % 5 = 0 THEN 'complete' WHEN k % 5 = 1 THEN 'finalize' ELSE 'discovery' END AS phase, CAST(k * 7 AS BIGINT) AS next_term_index, CAST(CASE WHEN k % 6 = 0 THEN 0 ELSE 100 END AS BIGINT) AS terms_total, concat('2026-11-0', CAST(1 + k % 9 AS STRING)) AS updated_at FROM {countries} WHERE k % 2 = 0",
    # starts, ends and delays of terms
    "term_events": """SELECT n.code, CAST(o_orderkey AS BIGINT) AS seq, CASE o_orderpriority WHEN '1-URGENT' THEN 'begin' WHEN '2-HIGH' THEN 'begin' WHEN '3-MEDIUM' THEN 'defer' ELSE 'finish' END AS kind, c_mktsegment AS term, CAST(CAST(o_orderdate AS DATE) AS STRING) AS at
        FROM {orders} JOIN {customer} ON o_custkey = c_custkey JOIN {countries} n ON n.k = c_nationkey""",
    "term_states": "SELECT code, CAST(k AS BIGINT) AS next_term_index, CAST(k + 1 + k % 7 * 4 AS BIGINT) AS terms_total, CAST(k AS BIGINT) AS terms_processed, CASE WHEN k % 4 = 1 THEN name END AS active_term, CASE WHEN k % 4 = 1 THEN '1990-01-01' END AS active_since, CASE WHEN k % 8 = 3 THEN '1991-02-03' END AS completed_at FROM {countries} WHERE k < 24",
    "repo_progress": "SELECT code, CAST(k AS BIGINT) AS scan_frontier_stars, concat('2026-12-0', CAST(1 + k % 9 AS STRING)) AS updated_at FROM {countries} WHERE k % 3 = 0",
    # summaries of searches
    "summaries": """SELECT n.code AS country, c_mktsegment AS term, CAST(o_orderkey AS BIGINT) AS seq, CAST(floor(o_totalprice / 100) AS BIGINT) AS reported, CAST(o_orderkey % 11 AS BIGINT) AS pages, CAST(o_orderkey % 13 AS BIGINT) AS requests,
        o_orderkey % 4 = 0 AS sharded, CAST(o_orderkey % 5 AS BIGINT) AS unresolved_n, o_orderpriority AS reason, o_orderstatus = 'F' AS capped, o_orderkey % 2 = 0 AS final
        FROM {orders} JOIN {customer} ON o_custkey = c_custkey JOIN {countries} n ON n.k = c_nationkey""",
}


def bound(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table or binding as a DataFrame."""
    if name in TABLES:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")
    sql = BINDINGS[name]
    names = set(re.findall(r"\{(\w+)\}", sql))
    made = spark.sql(sql, **{n: bound(spark, sf_dir, n) for n in names})
    return F.broadcast(made) if name == "countries" else made  # 25 rows, which Spark may take for more than a grown table


def with_bindings(sql: str) -> str:
    """DuckDB SQL with the bindings that {names} in it need, as common table expressions."""
    order: list[str] = []

    def need(text: str) -> None:
        for n in re.findall(r"\{(\w+)\}", text):
            if n in BINDINGS and n not in order:
                need(BINDINGS[n])
                order.append(n)

    need(sql)
    plain = lambda text: re.sub(r"\{(\w+)\}", r"\1", text)
    own = sql.strip()
    head = ",\n".join(f"{n} AS ({plain(BINDINGS[n])})" for n in order)
    if own.startswith("WITH "):
        return f"WITH RECURSIVE {head},\n{plain(own[5:])}" if head else plain(own)
    return f"WITH {head}\n{plain(own)}" if head else plain(own)
