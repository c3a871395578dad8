"""From a free-text location to a country, with confidence and evidence.

Both variants work on distinct locations: candidates are exploded with their place, met with the lookups by equi-joins
on the normalised term, folded per location, and the verdict is joined back to the rows.
"""

from __future__ import annotations

from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions import text
from ..sources.scratch import large, settled

#: Names of territories that decide before anything else.
TERRITORIES = [
    ("hong kong sar", "HK"),
    ("hong kong s a r", "HK"),
    ("hong kong sar china", "HK"),
    ("hong kong special administrative region", "HK"),
    ("macao", "MO"),
    ("macau", "MO"),
    ("macao sar", "MO"),
    ("macau sar", "MO"),
    ("macao sar china", "MO"),
    ("macao special administrative region", "MO"),
    ("puerto rico", "PR"),
    ("guam", "GU"),
    ("american samoa", "AS"),
    ("northern mariana islands", "MP"),
    ("u s virgin islands", "VI"),
    ("united states virgin islands", "VI"),
]


#: Short names of regions that count beside their full names.
SHORT_NAMES = [
    ("US", "usa"),
    ("US", "u s a"),
    ("GB", "uk"),
    ("GB", "u k"),
    ("AE", "uae"),
    ("AE", "u a e"),
]


#: Phrases that are broadcast at most.
BROADCAST = 50_000


def region_rows(names: DataFrame) -> DataFrame:
    """(code, norm) of (code, norm) names of regions, such as alias_rows() or catalog.region_names(), and of SHORT_NAMES."""
    return names.select("code", "norm").unionByName(names.sparkSession.createDataFrame(SHORT_NAMES, "code string, norm string")).distinct()


def territories(spark) -> DataFrame:
    """(norm, code) of the fixed territory names."""
    return spark.createDataFrame(TERRITORIES, "norm string, code string")


def location_keys(df: DataFrame, location_col: str = "location") -> DataFrame:
    """(location, raw, normalized, candidates) of the distinct non-empty locations."""
    raw = text.trimmed(F.col(location_col))
    one = df.select(F.col(location_col).alias("location"), raw.alias("raw")).filter("raw <> ''").distinct()
    bare = one.withColumn("_b", text.strip_marks(F.col("raw")))
    return bare.select("location", "raw", text.fold_location(F.col("_b")).alias("normalized"), text.distinct_candidates(text.location_parts(F.col("_b"))).alias("candidates"))


def candidate_rows(keys: DataFrame) -> DataFrame:
    """(location, pos, norm): the ordered candidates of each location."""
    return keys.select("location", F.posexplode("candidates").alias("pos", "norm"))


def codes_by(terms: DataFrame, kind: str | None = None) -> DataFrame:
    """(norm, codes): the sorted countries of each normalised term."""
    some = terms if kind is None else terms.filter(F.col("kind") == kind)
    return some.groupBy("norm").agg(F.array_sort(F.collect_set("code")).alias("codes"))


def lookup_terms(candidates: DataFrame, terms: DataFrame) -> DataFrame:
    """candidates with the countries that have the candidate as a place; null if there are none."""
    return candidates.join(large(codes_by(terms, "attribution")), "norm", "left")


def lookup_compound(keys: DataFrame, terms: DataFrame) -> DataFrame:
    """locations with the countries of the whole location as a compound place."""
    found = codes_by(terms, "compound").select(F.col("norm").alias("normalized"), F.col("codes").alias("compound_codes"))
    return keys.join(large(found), "normalized", "left")


def alias_rows(catalogue: DataFrame) -> DataFrame:
    """(code, norm) of country names and aliases."""
    names = catalogue.select("code", F.explode(F.concat(F.array("name"), "aliases")).alias("term"))
    return names.select("code", text.normalize_location(F.col("term")).alias("norm")).filter("norm <> ''").distinct()


def lookup_alias(candidates: DataFrame, aliases: DataFrame) -> DataFrame:
    """candidates with the countries that have the candidate as a name or alias. The catalogue bounds the aliases."""
    return candidates.join(F.broadcast(codes_by(aliases)).withColumnRenamed("codes", "alias_codes"), "norm", "left")


def lookup_territory(candidates: DataFrame, names: DataFrame) -> DataFrame:
    """(location, territory): the first candidate that names one, as struct (code, norm). The list of names is fixed."""
    met = candidates.join(F.broadcast(names), "norm")
    return met.groupBy("location").agg(F.min_by(F.struct("code", "norm"), "pos").alias("territory"))


def lookup_iso2(keys: DataFrame, catalogue: DataFrame) -> DataFrame:
    """keys with iso2, the code that the raw location is, else null."""
    codes = F.broadcast(catalogue.select(F.col("code").alias("iso2")))
    return keys.join(codes, (F.upper("raw") == F.col("iso2")) & F.rlike(F.col("raw"), F.lit("^[A-Za-z]{2}$")), "left")


def phrase_match(keys: DataFrame, phrases: DataFrame) -> DataFrame:
    """(location, code, norm, pos, words): the phrases (code, norm) that a normalised location holds as whole words.

    Token n-grams up to the longest phrase are exploded and joined by equality, so nothing is compared with every phrase.
    Phrases are broadcast if they are no more than BROADCAST.
    """
    phrases = phrases.select("code", "norm").distinct()
    n, longest = phrases.agg(F.count("*"), F.coalesce(F.max(F.size(F.split("norm", " "))), F.lit(0))).first()
    tokens = F.split("normalized", " ")
    grams = keys.select("location", tokens.alias("t")).select("location", "t", F.posexplode("t").alias("pos", "_"))
    sizes = F.sequence(F.lit(1), F.least(F.lit(max(longest, 1)), F.size("t") - F.col("pos")))
    grams = grams.select("location", "pos", "t", F.explode(sizes).alias("words"))
    grams = grams.select("location", "pos", "words", F.array_join(F.slice("t", F.col("pos") + 1, F.col("words")), " ").alias("norm"))
    return grams.join(F.broadcast(phrases) if n <= BROADCAST else large(phrases), "norm").select("location", "code", "norm", "pos", "words")


def _verdict(accepted: bool, confidence: str, evidence: str, code: Column | None = None, matched: Column | None = None, conflicts: Column | None = None, of: str = "string") -> Column:
    no_text, no_list = F.lit(None).cast("string"), F.lit(None).cast(f"array<{of}>")
    return F.struct(
        F.lit(accepted).alias("accepted"), (no_text if code is None else code).alias("country_code"), F.lit(confidence).alias("confidence"),
        F.lit(evidence).alias("evidence"), (no_text if matched is None else matched).alias("matched"), (no_list if conflicts is None else conflicts).alias("conflicts"),
    )


MISSING = ("unknown", "missing-location")


def missing(of: StructType) -> Column:
    """The verdict on a location that isn't there, as a struct of the type of other verdicts."""
    return _verdict(False, *MISSING, of=of["conflicts"].dataType.elementType.simpleString())


def resolve_locations(keys: DataFrame, catalogue: DataFrame, terms: DataFrame, names: DataFrame | None = None) -> DataFrame:
    """(location, attribution) of distinct locations against all countries; the first rule that applies decides.

    terms: (code, kind, norm) with attribution and compound places.
    """
    names = territories(keys.sparkSession) if names is None else names
    keys = settled(keys)
    candidates = candidate_rows(keys)
    found = lookup_alias(lookup_terms(candidates, terms), alias_rows(catalogue))
    place = F.when(F.size("codes") == 1, F.struct(F.lit(2).alias("score"), F.element_at("codes", 1).alias("code"), F.lit("recognized-place").alias("evidence"), "norm"))
    clash = F.col("codes").isNotNull() & ((F.size("codes") > 1) | ~F.array_contains("codes", F.element_at("alias_codes", 1)))
    named = F.when((F.size("alias_codes") == 1) & ~clash, F.struct(F.lit(3).alias("score"), F.element_at("alias_codes", 1).alias("code"), F.lit("explicit-country").alias("evidence"), "norm"))
    unsure = (F.coalesce(F.size("codes"), F.lit(0)) > 1) | (F.coalesce(F.size("alias_codes"), F.lit(0)) > 1) | ((F.size("alias_codes") == 1) & clash)
    each = found.select("location", "pos", F.coalesce(unsure, F.lit(False)).alias("unsure"), F.filter(F.array(place, named), lambda x: x.isNotNull()).alias("e"))
    flags = each.groupBy("location").agg(F.bool_or("unsure").alias("unsure"))
    per_code = each.select("location", "pos", F.explode("e").alias("e")).groupBy("location", "e.code").agg(F.max_by(F.struct("e.score", "e.evidence", "e.norm"), F.struct("e.score", -F.col("pos"))).alias("best"), F.min("pos").alias("first"))
    evidence = per_code.groupBy("location").agg(F.array_sort(F.collect_list(F.struct("first", "code", "best"))).alias("evidence"))
    all_ = (
        lookup_iso2(lookup_compound(keys, terms), catalogue)
        .join(large(lookup_territory(candidates, names)), "location", "left").join(large(flags), "location", "left").join(large(evidence), "location", "left")
    )
    n = F.coalesce(F.size("evidence"), F.lit(0))
    top = F.get("evidence", F.lit(0))
    chain = (
        F.when(F.col("territory").isNotNull(), _verdict(True, "high", "explicit-territory", F.col("territory.code"), F.col("territory.norm")))
        .when(F.size("compound_codes") == 1, _verdict(True, "high", "recognized-place-with-admin", F.element_at("compound_codes", 1), F.col("normalized")))
        .when(F.size("compound_codes") > 1, _verdict(False, "ambiguous", "ambiguous-compound-place", None, F.col("normalized"), F.col("compound_codes")))
        .when(F.col("iso2").isNotNull(), _verdict(True, "high", "country-code", F.col("iso2"), F.col("raw")))
        .when((n == 1) & (top["best"]["score"] >= 3), _verdict(True, "high", "explicit-country", top["code"], top["best"]["norm"]))
        .when(n == 1, _verdict(True, "medium", "recognized-place", top["code"], top["best"]["norm"]))
        .when(n > 1, _verdict(False, "ambiguous", "conflicting-place-evidence", None, F.col("normalized"), F.array_sort(F.transform("evidence", lambda x: x["code"]))))
        .when(F.col("unsure"), _verdict(False, "ambiguous", "ambiguous-place", None, F.col("normalized"), F.array().cast("array<string>")))
        .otherwise(_verdict(False, "unknown", "unrecognized-location"))
    )
    return all_.select("location", chain.alias("attribution"))


def resolve_location(df: DataFrame, catalogue: DataFrame, terms: DataFrame, location_col: str = "location", names: DataFrame | None = None) -> DataFrame:
    """df with `attribution`. Rows without a location, often the largest group, skip the join."""
    told = text.trimmed(F.coalesce(F.col(location_col), F.lit(""))) != ""
    verdicts = resolve_locations(location_keys(df.filter(told), location_col), catalogue, terms, names)
    some = df.filter(told).join(large(verdicts.withColumnRenamed("location", location_col)), location_col, "left")
    none = df.filter(~told).withColumn("attribution", _verdict(False, *MISSING))
    return some.select(*df.columns, "attribution").unionByName(none.select(*df.columns, "attribution"))


def curated_places(candidates: DataFrame, config: DataFrame) -> DataFrame:
    """(location, code, norm) of candidates that are known or curated places of a country, other than its own code."""
    places = config.filter(F.col("kind").isin("place", "curated")).select("code", "norm").distinct()
    return candidates.join(large(places), "norm").filter(F.lower("code") != F.col("norm")).select("location", "code", "norm").distinct()


def attribute_location(pairs: DataFrame, config: DataFrame, regions: DataFrame, strict: bool = True) -> DataFrame:
    """(location, code, attribution): whether a location is in the target country `code`; the first rule decides.

    config: (code, kind, norm, term, seq) with kinds alias, exact, place, compound, curated, ambiguous. regions: (code,
    norm) of the names of all regions, see region_rows(). Every foreign name that the location holds is a conflict; with
    strict=False one inside a longer matched name of the target isn't. conflicts lists (code, name), by code, with the
    shortest name that is held.
    """
    verdict = partial(_verdict, of="struct<code:string,name:string>")
    wanted, config = large(settled(pairs.select("location", "code").distinct())), large(settled(config))
    keys = large(settled(location_keys(wanted)))
    told = large(settled(wanted.join(keys, "location")))
    candidates = candidate_rows(keys)
    kind = lambda *k: config.filter(F.col("kind").isin(*k))

    # names and curated terms that the location holds
    own = phrase_match(keys, kind("alias"))
    first_alias = own.join(kind("alias").select("code", "norm", "seq", "term"), ["code", "norm"]).groupBy("location", "code").agg(F.min_by("term", "seq").alias("alias"))
    spans = own.groupBy("location", "code").agg(F.collect_list(F.struct("pos", "words")).alias("spans"))
    other = phrase_match(keys, regions).select("location", F.col("code").alias("other"), "norm", "pos", "words")
    met = wanted.join(other, "location").filter("code <> other").join(large(spans), ["location", "code"], "left")
    inside = F.exists("spans", lambda s: (s["pos"] <= F.col("pos")) & (s["pos"] + s["words"] >= F.col("pos") + F.col("words")) & (s["words"] > F.col("words")))
    foreign = met.filter(F.lit(True) if strict else ~F.coalesce(inside, F.lit(False)))
    foreign = foreign.groupBy("location", "code", "other").agg(F.min_by("norm", F.struct(F.length("norm"), "norm")).alias("name"))
    foreign = foreign.groupBy("location", "code").agg(F.array_sort(F.collect_list(F.struct(F.col("other").alias("code"), "name"))).alias("foreign"))
    curated = phrase_match(keys, kind("curated")).join(kind("curated").select("code", "norm", "seq", "term"), ["code", "norm"]).groupBy("location", "code").agg(F.min_by("term", "seq").alias("curated"))

    # codes, compounds and places
    whole = lambda k, name: told.join(kind(k).select("code", F.col("norm").alias("normalized"), "term", "seq"), ["code", "normalized"]).groupBy("location", "code").agg(F.min_by("term", "seq").alias(name))
    last = told.withColumn("last", F.element_at(F.split("normalized", " "), -1)).filter("last <> normalized")
    context = last.join(kind("exact").select("code", F.col("norm").alias("last"), F.col("term").alias("context"), "seq"), ["code", "last"])
    near = candidates.join(kind("place", "curated").select("code", "norm").distinct(), "norm")
    context = context.join(large(near), ["location", "code"]).filter("norm <> last AND norm <> normalized").groupBy("location", "code").agg(F.min_by("context", "seq").alias("context"))
    state = F.max(F.when(F.col("kind") == "ambiguous", 1).otherwise(0))
    place = candidates.join(kind("ambiguous", "place").select("code", "norm", "kind").distinct(), "norm").groupBy("location", "code", "pos", "norm").agg(state.alias("unsure"))
    place = place.groupBy("location", "code").agg(F.min(F.struct("pos", "norm", "unsure")).alias("place"))

    all_ = told
    for part in (first_alias, foreign, curated, whole("compound", "compound"), whole("exact", "exact"), context, place):
        all_ = all_.join(large(part), ["location", "code"], "left")
    code, names = F.col("code"), F.col("foreign")
    chain = (
        F.when((F.col("alias").isNotNull() | F.col("exact").isNotNull()) & F.col("foreign").isNotNull(), verdict(False, "ambiguous", "multiple-countries", None, None, names))
        .when(F.col("foreign").isNotNull(), verdict(False, "unknown", "foreign-country", None, None, names))
        .when(F.col("alias").isNotNull(), verdict(True, "high", "explicit-country", code, F.col("alias")))
        .when(F.col("compound").isNotNull(), verdict(True, "high", "recognized-place-with-admin", code, F.col("normalized")))
        .when(F.col("context").isNotNull(), verdict(True, "high", "country-code-with-place", code, F.coalesce("exact", "context")))
        .when(F.col("exact").isNotNull(), verdict(True, "high", "country-code", code, F.col("exact")))
        .when(F.col("place.unsure") == 1, verdict(False, "ambiguous", "ambiguous-place", None, F.col("place.norm")))
        .when(F.col("place.unsure") == 0, verdict(True, "medium", "recognized-place", code, F.col("place.norm")))
        .when(F.col("curated").isNotNull(), verdict(True, "medium", "curated-location", code, F.col("curated")))
        .otherwise(verdict(False, "unknown", "unrecognized-location"))
    )
    done = all_.select("location", "code", chain.alias("attribution"))
    bare = wanted.join(keys.select("location"), "location", "left_anti").withColumn("attribution", verdict(False, *MISSING))
    missing = pairs.filter("location IS NULL").select("location", "code").distinct().withColumn("attribution", verdict(False, *MISSING))
    return done.unionByName(bare.filter("location IS NOT NULL")).unionByName(missing)


def filter_accepted(df: DataFrame, catalogue: DataFrame) -> DataFrame:
    """Rows whose attribution is accepted, in a country of the catalogue."""
    codes = F.broadcast(catalogue.select(F.col("code").alias("_code")))
    return df.filter("attribution.accepted").join(codes, F.col("attribution.country_code") == F.col("_code"), "left_semi")


def attribution_outcomes(df: DataFrame) -> DataFrame:
    """One row: seen, attributed, ambiguous, unknown."""
    is_ = lambda c: F.count_if(~F.col("attribution.accepted") & (F.col("attribution.confidence") == c))
    return df.agg(F.count("*").alias("seen"), F.count_if("attribution.accepted").alias("attributed"), is_("ambiguous").alias("ambiguous"), is_("unknown").alias("unknown"))
