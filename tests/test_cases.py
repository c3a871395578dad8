"""Small cases with known answers."""

import random

import pytest
from pyspark.sql import functions as F

from countryrank.functions import text
from countryrank.operators import attribution, catalog, certify, gazetteer, ranking, shards
from countryrank.sources import readers, writers


def one(spark, column, **values):
    df = spark.createDataFrame([tuple(values.values())], list(values)) if values else spark.range(1)
    return df.select(column).first()[0]


@pytest.mark.parametrize(("said", "norm"), [(" Nuwara-Eliya,  Sri Lanka ", "nuwara eliya sri lanka"), ("කොළඹ", "කොළඹ"), ("São Paulo & co", "sao paulo and co"), ("", ""), ("İzmir", "izmir"), ("!!", "")])
def test_normalize(spark, said, norm):
    assert one(spark, text.normalize_location(F.col("x")), x=said) == norm


def test_scalars(spark):
    assert one(spark, text.slugify(F.lit("Côte d'Ivoire"))) == "cote-d-ivoire"
    assert one(spark, text.country_flag(F.lit("lk"))) == "🇱🇰"
    assert one(spark, text.country_flag(F.lit("l1"))) == "🌐"
    assert one(spark, text.display_date(F.lit("2026-10-03T05:02:00Z"))) == "03 Oct 2026, 05:02 UTC"
    assert one(spark, text.display_date(F.lit("soon"))) == "soon"
    assert one(spark, text.truncate_text(F.lit("ab  cd ef"), 6)) == "ab cd…"
    assert one(spark, text.progress_percent(F.lit(250), F.lit(1000))) == 25
    assert one(spark, text.progress_percent(F.lit(5), F.lit(0))) == 0
    assert one(spark, text.star_range_query(F.lit(100), F.lit(999))) == "stars:100..999 fork:false sort:stars-desc"
    assert one(spark, text.location_query(F.lit('a"b\\c'))) == 'location:"a\\"b\\\\c"'
    assert one(spark, text.clean_term(F.lit("x" * 121))) is None
    assert one(spark, text.thousands(F.lit(1234567))) == "1,234,567"


@pytest.fixture(scope="module")
def world(spark):
    rows = [("US", "United States", ["USA"]), ("CA", "Canada", []), ("AU", "Australia", []), ("GE", "Georgia", []), ("GB", "United Kingdom", ["UK"]), ("HK", "Hong Kong", ["Hong Kong SAR"]), ("PR", "Puerto Rico", [])]
    countries = catalog.country_dim(spark.createDataFrame(rows, "code string, name string, aliases array<string>"))
    terms = []
    for code, names, compounds in [("US", ["United States", "Oregon", "Georgia", "San Francisco", "Portland"], ["Portland, OR", "Portland, Oregon", "San Francisco, CA"]), ("CA", ["Canada", "Toronto"], ["Toronto, ON"]), ("AU", ["Australia", "Portland"], ["Portland, Victoria"]), ("GE", ["Georgia", "Tbilisi"], []), ("GB", ["United Kingdom", "London"], []), ("HK", ["Hong Kong"], []), ("PR", ["Puerto Rico"], [])]:
        terms += [(code, "attribution", t) for t in names] + [(code, "compound", t) for t in compounds]
    return countries, gazetteer.normed(spark.createDataFrame(terms, "code string, kind string, term string"))


GLOBAL = {
    "Portland, OR": ("US", "high", "recognized-place-with-admin"), "San Francisco, CA": ("US", "high", "recognized-place-with-admin"), "Portland": (None, "ambiguous", "ambiguous-place"),
    "Georgia": (None, "ambiguous", "ambiguous-place"), "Tbilisi, Georgia": ("GE", "medium", "recognized-place"), "London, UK": ("GB", "high", "explicit-country"), "Hong Kong SAR": ("HK", "high", "explicit-territory"),
    "Puerto Rico": ("PR", "high", "explicit-territory"), "": (None, "unknown", "missing-location"), None: (None, "unknown", "missing-location"), "CA": ("CA", "high", "country-code"), "Toronto / London": (None, "ambiguous", "conflicting-place-evidence"),
    "on the road": (None, "unknown", "unrecognized-location"), "  ": (None, "unknown", "missing-location"), "\t": (None, "unknown", "missing-location"), "\u00a0 ": (None, "unknown", "missing-location"),
}


def test_global_resolver(spark, world):
    df = spark.createDataFrame([(x,) for x in GLOBAL], "location string")
    got = {r["location"]: (r["attribution"]["country_code"], r["attribution"]["confidence"], r["attribution"]["evidence"]) for r in attribution.resolve_location(df, *world).collect()}
    assert got == GLOBAL
    out = attribution.attribution_outcomes(attribution.resolve_location(df, *world)).first()
    assert out["seen"] == out["attributed"] + out["ambiguous"] + out["unknown"] == len(GLOBAL)


def test_catalogue(spark):
    rows = {r["code"]: r for r in catalog.world(spark).collect()}
    assert len(rows) == 250 and all(len(c) == 2 for c in rows)
    assert rows["XK"]["name"] == "Kosovo" and rows["HK"]["name"] == "Hong Kong" and "Macau" in rows["MO"]["aliases"] and "AX" in rows
    assert (rows["CI"]["slug"], rows["LK"]["flag"], rows["JP"]["aliases"]) == ("cote-d-ivoire", "🇱🇰", [])
    names = [r["name"] for r in catalog.world(spark).collect()]
    assert names.index("Åland Islands") < names.index("Albania") < names.index("Zimbabwe")
    asked = spark.createDataFrame([(" lk ",), ("zz",)], "c string")
    assert [r["name"] for r in catalog.country_lookup(asked, catalog.world(spark), "c").orderBy("c").collect()] == ["Sri Lanka", None]
    regions = {tuple(r) for r in attribution.region_rows(catalog.region_names(spark)).collect()}
    assert {("EU", "european union"), ("US", "usa"), ("GB", "u k"), ("IC", "canary islands")} <= regions


def test_target_attribution(spark):
    config = [("LK", "alias", "Sri Lanka"), ("LK", "exact", "lk"), ("LK", "place", "Colombo"), ("LK", "place", "Kalutara"), ("LK", "place", "කොළඹ"), ("LK", "curated", "Kandy district"), ("US", "alias", "United States"), ("US", "exact", "us"), ("US", "compound", "Portland, OR"), ("US", "place", "Portland"), ("US", "ambiguous", "portland"), ("AS", "alias", "American Samoa")]
    cfg = gazetteer.normed(spark.createDataFrame([(*c, i) for i, c in enumerate(config)], "code string, kind string, term string, seq int"))
    config += [("FR", "alias", "France"), ("FR", "place", "Paris")]
    cfg = gazetteer.normed(spark.createDataFrame([(*c, i) for i, c in enumerate(config)], "code string, kind string, term string, seq int"))
    regions = spark.createDataFrame([("BR", "brazil"), ("SG", "singapore"), ("DE", "germany"), ("LK", "sri lanka"), ("WS", "samoa"), ("AS", "american samoa")], "code string, norm string")
    want = {
        ("Colombo, Sri Lanka", "LK"): (True, "explicit-country"), ("Kalutara", "LK"): (True, "recognized-place"), ("Colombo, LK", "LK"): (True, "country-code-with-place"), ("", "LK"): (False, "missing-location"),
        ("Berlin, Germany", "LK"): (False, "foreign-country"), ("Colombo, Brazil", "LK"): (False, "foreign-country"), ("Sri Lanka / Singapore", "LK"): (False, "multiple-countries"), ("කොළඹ", "LK"): (True, "recognized-place"),
        ("Portland, OR", "US"): (True, "recognized-place-with-admin"), ("Portland", "US"): (False, "ambiguous-place"), ("American Samoa", "AS"): (False, "multiple-countries"), ("Paris, USA", "FR"): (False, "foreign-country"), ("Paris", "FR"): (True, "recognized-place"), ("\t", "FR"): (False, "missing-location"), ("lk", "LK"): (True, "country-code"),
        ("near Kandy  District now", "LK"): (True, "curated-location"), ("nowhere", "LK"): (False, "unrecognized-location"),
    }
    pairs = spark.createDataFrame(list(want), "location string, code string")
    got = {(r["location"], r["code"]): (r["attribution"]["accepted"], r["attribution"]["evidence"]) for r in attribution.attribute_location(pairs, cfg, attribution.region_rows(regions)).collect()}
    assert got == want
    strict = attribution.attribute_location(pairs.filter("code = 'AS'"), cfg, regions).first()["attribution"]
    assert [tuple(c) for c in strict["conflicts"]] == [("WS", "samoa")]
    loose = attribution.attribute_location(pairs.filter("code = 'AS'"), cfg, regions, strict=False).first()
    assert loose["attribution"]["evidence"] == "explicit-country"


def test_owner_cuts_keep_ties(spark):
    df = spark.createDataFrame([("X", n, s) for n, s in [("a", 100), ("b", 80), ("c", 60), ("d", 59), ("e", 1)]] + [("Y", n, s) for n, s in [("a", 100), ("b", 50), ("c", 50)]], "country string, owner string, top_stars long")
    assert {r["owner"] for r in ranking.candidate_owners(df.filter("country = 'X'"), limit=3).collect()} == {"a", "b", "c"}
    assert {r["owner"] for r in ranking.candidate_owners(df.filter("country = 'Y'"), limit=2).collect()} == {"a", "b", "c"}


def test_repository_order(spark):
    df = spark.createDataFrame([("X", "b", 100, 5), ("X", "a", 100, 5), ("X", "c", 100, 10)], "country string, name_with_owner string, stars long, forks long")
    assert [r["name_with_owner"] for r in ranking.rank_repositories(df).orderBy("rank").collect()] == ["c", "a", "b"]


def test_pool_merge_and_cut(spark):
    kind = "country string, login string, stars long, repository string, confidence string, terms array<string>, seq long"
    old = spark.createDataFrame([("X", "a", 50, "a/1", "medium", ["Colombo"], 1)], kind)
    new = spark.createDataFrame([("X", "a", 75, "a/2", "medium", ["Sri Lanka"], 2)], kind)
    r = ranking.pool_merge(old, new).first()
    assert (r["stars"], r["repository"], r["terms"]) == (75, "a/2", ["Colombo", "Sri Lanka"])
    pool = spark.createDataFrame([("X", n, s, n, "high", [], 1) for n, s in [("a", 100), ("b", 90), ("c", 80), ("d", 80), ("e", 10)]], kind)
    assert {r["login"] for r in ranking.pool_truncate(pool, limit=3).collect()} == {"a", "b", "c", "d"}


def test_certification_is_strict_and_stays(spark):
    pool = spark.createDataFrame([(c, f"{c}{i}", s, 0) for c, s in (("A", 50), ("B", 51), ("C", 10)) for i in range(2)], "country string, name_with_owner string, stars long, forks long")
    frontier = spark.createDataFrame([(50,)], "frontier long")
    earlier = spark.createDataFrame([("C", "then")], "country string, certified_at string")
    got = {r["country"]: r["certified_at"] for r in certify.certify_countries(pool, frontier, earlier, "now", limit=2).collect()}
    assert got == {"A": None, "B": "now", "C": "then"}


@pytest.mark.parametrize("cap", [1, 7, 1000])
def test_split_ranges(spark, cap):
    rnd = random.Random(cap)
    stars = [rnd.choice([1, 2, 3, 50, rnd.randint(1, 400)]) for _ in range(300)]
    hist = shards.star_histogram(spark.createDataFrame([(s,) for s in stars], "stars long"))
    got = sorted((r[0], r[1], r[2]) for r in shards.split_star_ranges(hist, 1, 400, cap).collect())
    at = 1
    for lo, hi, n in got:
        assert lo == at and n == sum(lo <= s <= hi for s in stars) and (n <= cap or lo == hi)
        at = hi + 1
    assert at == 401


def test_two_stage_equals_brute_force(spark):
    rnd = random.Random(1)
    rows = [(f"C{rnd.randint(0, 2)}", f"o{rnd.randint(0, 40)}", f"n{i}", rnd.randint(0, 30), rnd.randint(0, 3), rnd.random() < 0.2) for i in range(600)]
    df = spark.createDataFrame(rows, "country string, owner string, name_with_owner string, stars long, forks long, is_fork boolean")
    two = {(r["country"], r["rank"], r["name_with_owner"]) for r in ranking.two_stage_topn(df, limit=10).collect()}
    all_ = {(r["country"], r["rank"], r["name_with_owner"]) for r in ranking.rank_repositories(ranking.filter_non_fork(df), limit=10).collect()}
    assert two == all_


def test_partitions_do_not_matter(spark):
    rnd = random.Random(2)
    rows = [(f"n{rnd.randint(0, 50)}", i, rnd.randint(0, 9), 0) for i in range(400)]
    df = spark.createDataFrame(rows, "name_with_owner string, seq long, stars long, forks long")
    first = sorted(map(tuple, ranking.latest_repository(df).collect()))
    assert first == sorted(map(tuple, ranking.latest_repository(df.orderBy(F.rand(3)).repartition(13)).collect()))


def test_files(spark, tmp_path):
    (tmp_path / "geo").mkdir()
    (tmp_path / "geo" / "AA.json").write_text('{"country": {"code": "AA"}, "attributionTerms": ["x", "y"], "discoveryTerms": ["x"]}')
    (tmp_path / "geo" / "BB.json").write_text('{"country": ')
    (tmp_path / "geo" / "notes.json").write_text('{"country": {"code": "ZZ"}}')
    got = {(r["code"], r["kind"], r["term"]) for r in readers.read_geo_indexes(spark, str(tmp_path / "geo")).collect()}
    assert got == {("AA", "attribution", "x"), ("AA", "attribution", "y"), ("AA", "discovery", "x")}
    source = tmp_path / "source.json"
    source.write_text('[{"iso2": "lk", "name": "Sri Lanka", "translations": {"fr": "Sri Lanka FR"}, "states": [{"name": "Western", "iso2": "1", "cities": [{"name": "Colombo", "native": "කොළඹ", "state_code": "LK-1"}]}]}]')
    countries = spark.createDataFrame([("LK", "Sri Lanka")], "code string, name string")
    terms = {(r["kind"], r["term"]) for r in gazetteer.geo_build(readers.read_gazetteer(spark, str(source)), countries).collect()}
    assert {("attribution", "කොළඹ"), ("discovery", "Sri Lanka FR"), ("compound", "Colombo, Western"), ("compound", "Colombo, 1"), ("compound", "Colombo, LK-1")} <= terms
    with pytest.raises(ValueError, match="refusing"):
        writers.write_geo_index(gazetteer.normed(spark.createDataFrame([("AA", "attribution", "x")], "code string, kind string, term string")), str(tmp_path / "out"))
    state = spark.createDataFrame([("A", 1), ("B", 2)], "country string, n int")
    writers.write_state(state, str(tmp_path / "state"))
    writers.write_state(state.filter("country = 'A'").withColumn("n", F.lit(9)), str(tmp_path / "state"))
    assert {tuple(r) for r in spark.read.parquet(str(tmp_path / "state")).select("country", "n").collect()} == {("A", 9), ("B", 2)}
