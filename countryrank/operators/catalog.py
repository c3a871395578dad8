"""The country catalogue, records against it, and the term lists of a country's configuration."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text
from .shards import positions


#: The region beside the ISO list, names that differ from the display names, and other names of countries.
EXTRA = [("XK", "Kosovo")]
NAME_OVERRIDES = {
    "BO": "Bolivia", "BN": "Brunei", "CD": "DR Congo", "CG": "Republic of the Congo", "CI": "Côte d'Ivoire", "CZ": "Czechia", "FM": "Micronesia", "HK": "Hong Kong", "GB": "United Kingdom",
    "IR": "Iran", "KP": "North Korea", "KR": "South Korea", "LA": "Laos", "MD": "Moldova", "MO": "Macao", "PS": "Palestine", "RU": "Russia", "SY": "Syria", "TZ": "Tanzania",
    "US": "United States", "VE": "Venezuela", "VN": "Vietnam",
}
ALIASES = {
    "AE": ["UAE", "U.A.E."],
    "BO": ["Plurinational State of Bolivia"],
    "BN": ["Brunei Darussalam"],
    "CD": ["Democratic Republic of the Congo", "DRC", "D.R.C."],
    "CI": ["Ivory Coast"],
    "CV": ["Cape Verde"],
    "CZ": ["Czech Republic"],
    "FM": ["Federated States of Micronesia"],
    "GB": ["UK", "U.K.", "Great Britain"],
    "HK": ["Hong Kong SAR", "Hong Kong S.A.R.", "Hong Kong SAR China", "Hong Kong Special Administrative Region"],
    "IR": ["Islamic Republic of Iran"],
    "KP": ["DPRK", "D.P.R.K.", "Democratic People's Republic of Korea"],
    "KR": ["Republic of Korea", "ROK", "R.O.K."],
    "LA": ["Lao People's Democratic Republic", "Lao PDR"],
    "MD": ["Republic of Moldova"],
    "MO": ["Macau", "Macau SAR", "Macao SAR", "Macao SAR China", "Macao Special Administrative Region"],
    "MM": ["Burma"],
    "PS": ["State of Palestine", "Palestinian Territories"],
    "RU": ["Russian Federation"],
    "SZ": ["Swaziland"],
    "TL": ["East Timor"],
    "TR": ["Turkey", "Türkiye"],
    "TZ": ["United Republic of Tanzania"],
    "US": ["USA", "U.S.A.", "United States of America"],
    "VA": ["Vatican City"],
    "VE": ["Bolivarian Republic of Venezuela"],
    "VN": ["Viet Nam"],
    "XK": ["Republic of Kosovo"],
}


def _display_names(spark: SparkSession, codes: list[str]) -> dict[str, str]:
    """English names of region codes, as the driver's JVM has them from the public locale data; unknown codes are left out."""
    locale = spark._jvm.java.util.Locale
    names = {c: locale("", c).getDisplayCountry(locale.ENGLISH) for c in codes}
    return {c: n for c, n in names.items() if n and n != c and n != "Unknown Region"}


def world(spark: SparkSession) -> DataFrame:
    """The catalogue of all countries by name: the ISO list and EXTRA, with NAME_OVERRIDES and ALIASES. 250 rows."""
    names = _display_names(spark, list(spark._jvm.java.util.Locale.getISOCountries())) | dict(EXTRA) | NAME_OVERRIDES
    rows = [(c, n, ALIASES.get(c, [])) for c, n in names.items()]
    return country_dim(spark.createDataFrame(rows, "code string, name string, aliases array<string>")).orderBy(F.collate("name", "UNICODE"))


def region_names(spark: SparkSession) -> DataFrame:
    """(code, norm) of the names of all regions that the locale data has, countries or not."""
    letters = [chr(65 + i) for i in range(26)]
    rows = list(_display_names(spark, [a + b for a in letters for b in letters]).items())
    return spark.createDataFrame(rows, "code string, name string").select("code", text.normalize_location(F.col("name")).alias("norm"))


def country_dim(source: DataFrame) -> DataFrame:
    """(code, name, slug, flag, aliases) of a (code, name, aliases) list of countries."""
    return source.select("code", "name", text.slugify(F.col("name")).alias("slug"), text.country_flag(F.col("code")).alias("flag"), F.coalesce("aliases", F.array().cast("array<string>")).alias("aliases"))


def normalize_code(*codes: Column) -> Column:
    """The first non-empty code, trimmed and in upper case, if it has two letters."""
    first = F.upper(F.trim(F.coalesce(*[F.when(F.trim(c) != "", c) for c in codes])))
    return F.when(F.rlike(first, F.lit("^[A-Z]{2}$")), first)


def country_lookup(df: DataFrame, catalogue: DataFrame, code_col: str) -> DataFrame:
    """df with the catalogue's columns for a code in any case; nulls where it is unknown."""
    return df.join(F.broadcast(catalogue).withColumnRenamed("code", "_code"), F.upper(F.trim(F.col(code_col))) == F.col("_code"), "left").drop("_code")


def filter_catalog(df: DataFrame, catalogue: DataFrame, *code_cols: str) -> DataFrame:
    """Records whose first non-empty code is valid and in the catalogue; adds it as `code`."""
    coded = df.withColumn("code", normalize_code(*[F.col(c) for c in code_cols]))
    return coded.join(F.broadcast(catalogue.select("code")), "code", "left_semi")


def ordered_terms(*lists: DataFrame) -> DataFrame:
    """Union of (code, kind, term, seq) lists without repeats: each term keeps its first place; later lists come behind."""
    out = None
    for n, terms in enumerate(lists):
        part = terms.select("code", "kind", "term", F.struct(F.lit(n).alias("list"), F.col("seq").cast("bigint").alias("seq")).alias("at"))
        out = part if out is None else out.unionByName(part)
    first = out.groupBy("code", "kind", "term").agg(F.min("at").alias("at"))
    placed = positions(first, [F.col("at"), F.col("term")], ["code", "kind"], "seq")  # a country may have many terms
    return placed.select("code", "kind", "term", (F.col("seq") + 1).alias("seq"))


def config_terms(catalogue: DataFrame, index_terms: DataFrame, overrides: DataFrame) -> DataFrame:
    """All terms of every country: catalogue names and aliases, its geography index and its overrides.

    Kinds: alias, exact, place, compound, ambiguous, search, geography, curated (the overrides' places).
    """
    names = catalogue.select("code", F.posexplode(F.concat(F.array("name"), "aliases")).alias("seq", "term"))
    base = names.select("code", F.explode(F.array(F.lit("alias"), F.lit("search"))).alias("kind"), "term", "seq")
    exact = catalogue.select("code", F.lit("exact").alias("kind"), F.lower("code").alias("term"), F.lit(0).alias("seq"))
    kinds = F.create_map(*[F.lit(x) for pair in (("attribution", "place"), ("compound", "compound"), ("ambiguous", "ambiguous"), ("discovery", "geography")) for x in pair])
    index = index_terms.select("code", F.element_at(kinds, F.col("kind")).alias("kind"), "term", "seq").filter("kind IS NOT NULL")
    curated = overrides.filter("kind = 'place'").withColumn("kind", F.lit("curated"))
    return ordered_terms(base.unionByName(exact), index, overrides.select("code", "kind", "term", "seq").unionByName(curated.select("code", "kind", "term", "seq")))


def config_problems(config: DataFrame, strings: list[str], lists: list[str], limits: list[str], most: int = 100) -> DataFrame:
    """config with `problems`: the names of the fields that are missing, empty, not positive or above `most`."""
    bad = [F.when(F.trim(F.coalesce(F.col(c), F.lit(""))) == "", F.lit(c)) for c in strings]
    bad += [F.when(F.coalesce(F.size(c), F.lit(0)) <= 0, F.lit(c)) for c in lists]
    bad += [F.when(F.coalesce((F.col(c) <= 0) | (F.col(c) > most), F.lit(True)), F.lit(c)) for c in limits]
    return config.withColumn("problems", F.filter(F.array(*bad), lambda x: x.isNotNull()))
