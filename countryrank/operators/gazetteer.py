"""Building the world gazetteer: terms of places per country, shared terms, counts and hashes.

Terms are rows (code, kind, term) of kinds attribution, discovery and compound, distinct.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text
from ..sources.scratch import settled
from ..sources.versions import Versions
from .catalog import filter_catalog
from .shards import positions

NAMES = ["name", "native"]


def geo_build(source: DataFrame, catalogue: DataFrame) -> DataFrame:
    """Terms of the nested country / state / city source.

    Translations count for attribution everywhere and for discovery on countries only. Each record is exploded on its
    own path, so nothing is grouped before the one distinct.
    """
    source = filter_catalog(source, catalogue, "iso2")
    state = source.select("code", F.explode_outer("states").alias("s"))
    city = state.filter("s IS NOT NULL").select("code", "s", F.explode("s.cities").alias("c"))
    kinds = lambda *k: F.array(*[F.lit(x) for x in k])

    def terms(df: DataFrame, made: Column, *kind: str) -> DataFrame:
        return df.select("code", F.explode(kinds(*kind)).alias("kind"), F.explode(made).alias("term")) if len(kind) == 1 else df.select("code", F.explode(made).alias("term")).select("code", F.explode(kinds(*kind)).alias("kind"), "term")

    here = F.struct(*NAMES)
    compound = text.compound_terms(
        text.name_variants(F.col("c"), NAMES), text.name_variants(F.col("s"), NAMES),
        F.array_union(text.admin_codes([F.col("s.iso2")], F.col("code")), text.admin_codes([F.col("c.state_code")], F.col("code"))),
    )
    state = state.filter("s IS NOT NULL")
    parts = [
        terms(source.withColumn("_n", here), text.name_variants(F.col("_n"), NAMES, F.col("translations")), "attribution", "discovery"),
        terms(state, text.name_variants(F.col("s"), NAMES), "attribution", "discovery"),
        terms(city, text.name_variants(F.col("c"), NAMES), "attribution", "discovery"),
        city.select("code", F.lit("compound").alias("kind"), F.explode(compound).alias("term")),
        catalogue.join(source.select("code").distinct(), "code", "left_semi").select("code", F.explode(kinds("attribution", "discovery")).alias("kind"), F.col("name").alias("term")),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p.select("code", "kind", "term"))
    return out.distinct()


def geo_enrich(terms: DataFrame, places: DataFrame, catalogue: DataFrame) -> DataFrame:
    """terms with those of place rows (name, ascii_name, alternates, country_code, admin1)."""
    rows = filter_catalog(places, catalogue, "country_code")
    main = F.filter(F.array(text.clean_term(F.col("name")), text.clean_term(F.col("ascii_name"))), lambda x: x.isNotNull())
    admin = F.trim(F.coalesce("admin1", F.lit("")))
    both = rows.select("code", F.explode(main).alias("term"), admin.alias("a"))
    more = (
        both.select("code", F.explode(F.array(F.lit("attribution"), F.lit("discovery"))).alias("kind"), "term")
        .unionByName(rows.select("code", F.lit("attribution").alias("kind"), F.explode(text.split_alternates(F.col("alternates"))).alias("term")))
        .unionByName(both.filter("a <> ''").select("code", F.lit("compound").alias("kind"), text.clean_term(F.concat_ws(", ", "term", "a")).alias("term")).filter("term IS NOT NULL"))
    )
    return terms.select("code", "kind", "term").unionByName(more).distinct()


def normed(terms: DataFrame) -> DataFrame:
    """terms with `norm`; distinct terms are normalised once, whatever the number of countries that share them."""
    norms = terms.select("term").distinct().withColumn("norm", text.normalize_location(F.col("term")))
    return terms.join(norms, "term").filter("norm <> ''")


def term_countries(terms: DataFrame) -> DataFrame:
    """(norm, codes, n): the countries that use each normalised term."""
    return terms.groupBy("norm").agg(F.array_sort(F.collect_set("code")).alias("codes"), F.count_distinct("code").alias("n"))


def ambiguous_terms(terms: DataFrame) -> DataFrame:
    """(code, norm) of discovery terms that more than one country uses."""
    found = terms.filter("kind = 'discovery'").select("code", "norm").distinct()
    shared = found.groupBy("norm").agg(F.count("*").alias("n")).filter("n > 1").select("norm")
    return found.join(shared, "norm", "left_semi").select("code", "norm")


PAIRS, CHANGES = "code string, norm string", "norm string, n bigint"


def term_tables(spark, path: str) -> tuple[Versions, Versions]:
    """The discovery terms of each country, and changes of the number of countries that use a term, as stored tables."""
    return Versions(spark, f"{path}/pairs", PAIRS, "code"), Versions(spark, f"{path}/changes", CHANGES)


def _summed(changes: DataFrame) -> DataFrame:
    return changes.groupBy("norm").agg(F.sum("n").alias("n")).filter("n <> 0")


def update_terms(terms: DataFrame, path: str, codes: list[str], version: int) -> DataFrame:
    """Takes the discovery terms of the countries in `codes` from terms (code, kind, norm) and returns (norm, n), how many more
    countries use a term than before. Of the stored terms only those of these countries are read.

    Changes come before the countries' terms; the version again, after either, gives the same tables.
    """
    pairs, changes = term_tables(terms.sparkSession, path)
    new = terms.filter((F.col("kind") == "discovery") & F.col("code").isin(codes)).select("code", "norm").distinct()
    old = pairs.of_keys(codes, version)
    changed = settled(_summed(new.select("norm", F.lit(1).alias("n")).unionByName(old.select("norm", F.lit(-1).alias("n")))))
    changes.append(changed, version, fold=_summed)
    pairs.replace(new, version, gone=codes)
    pairs.vacuum()
    changes.vacuum()
    return changed


def kept_ambiguous_terms(spark, path: str) -> DataFrame:
    """ambiguous_terms() of the tables that update_terms() keeps: a term whose number has fallen to 1 is none any more."""
    pairs, changes = term_tables(spark, path)
    return pairs.read().join(_summed(changes.read()).filter("n > 1").select("norm"), "norm", "left_semi").select("code", "norm")


def base_order(terms: DataFrame, group_cols: list[str], term_col: str = "term") -> DataFrame:
    """terms with `pos`, their place in their group in the order of the base gazetteer: that of the root locale without case
    and accents, then by spelling. Groups are ordered by many tasks; lists are made of them where they are written."""
    return positions(terms, [F.collate(F.col(term_col), "UNICODE_CI_AI"), F.col(term_col)], group_cols, "pos")


def geo_counts(terms: DataFrame, source: DataFrame, places: DataFrame) -> DataFrame:
    """Counts of each country, and in total where code is null: terms of each kind, and, of the nested source (with
    `code`), states, city records and distinct primary names, and rows of places (with `code`)."""
    kinds = ["attribution", "discovery", "compound"]
    per = terms.select("code", "kind", "term").distinct().groupBy("code").agg(*[F.count_if(F.col("kind") == k).alias(f"{k}_terms") for k in kinds])
    rows = places.groupBy("code").agg(F.count("*").alias("place_rows"))
    both = per.join(source_counts(source), "code", "full").join(rows, "code", "full")
    return both.rollup("code").agg(*[F.coalesce(F.sum(c), F.lit(0)).cast("bigint").alias(c) for c in both.columns if c != "code"])


def source_counts(source: DataFrame) -> DataFrame:
    """States, cities and distinct primary names per country of the nested source, with `code`."""
    states = F.coalesce("states", F.array().cast(source.schema["states"].dataType))
    cities = F.flatten(F.transform(states, lambda s: F.coalesce(s["cities"], F.array().cast(source.schema["states"].dataType.elementType["cities"].dataType))))
    names = lambda a: F.size(F.array_distinct(F.flatten(F.transform(a, lambda x: text.name_variants(x, NAMES)))))
    return source.select("code", F.size(states).alias("states"), F.size(cities).alias("city_records"), names(cities).alias("primary_cities"), names(states).alias("primary_admins"))


def term_hashes(terms: DataFrame) -> DataFrame:
    """(code, content_sha256) over each country's term lists, sorted by (norm, term)."""
    of = lambda k: F.transform(F.array_sort(F.collect_set(F.when(F.col("kind") == k, F.struct("norm", "term")))), lambda x: x["term"]).alias(k)
    return terms.groupBy("code").agg(of("attribution"), of("compound"), of("discovery")).select("code", text.content_hash(F.struct("attribution", "code", "compound", "discovery")).alias("content_sha256"))


def resolver_stats(catalogue_aliases: DataFrame, terms: DataFrame) -> DataFrame:
    """One row: countries, and distinct keys of each lookup."""
    keys = terms.agg(F.count_distinct(F.when(F.col("kind") == "attribution", F.col("norm"))).alias("location_terms"), F.count_distinct(F.when(F.col("kind") == "compound", F.col("norm"))).alias("compound_terms"))
    names = catalogue_aliases.agg(F.count_distinct("code").alias("countries"), F.count_distinct("norm").alias("country_aliases"))
    return names.withColumn("_k", F.lit(1)).join(keys.withColumn("_k", F.lit(1)), "_k").drop("_k")
