"""Versioned tables, verdicts as lookup state, keyed pools: crashes, restarts, and what is left on disk."""

import os

import pandas as pd
import pytest
from pyspark.sql import functions as F

from countryrank.operators import attribution, ranking
from countryrank.sources import scratch, writers
from countryrank.sources.versions import Versions
from countryrank.streaming import owners, pools, verdicts

POOL = "country string, name string, stars long"


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def folders(path):
    return sum(len(d) for _, d, _ in os.walk(path))


def test_versions_appear_by_their_manifest(spark, tmp_path):
    t = Versions(spark, f"file://{tmp_path}/t", POOL, "country")
    assert t.read().count() == 0
    t.replace(spark.createDataFrame([("A", "x", 1), ("B/é", "y", 2), (None, "z", 3)], POOL), 0)
    t.replace(spark.createDataFrame([("A", "x", 5)], POOL), 1)
    want = [("A", "x", 5), ("B/é", "y", 2), (None, "z", 3)]
    assert rows(t.read()) == sorted(want, key=repr) and rows(t.read(before=1))[0] == ("A", "x", 1)
    t.replace(spark.createDataFrame([("A", "other", 9)], POOL), 1)  # the version is there already
    t._write(spark.createDataFrame([("A", "lost", 9)], POOL), 2)  # a writer that died before its manifest
    t.vacuum()
    assert rows(t.read()) == sorted(want, key=repr)
    t.replace(spark.createDataFrame([("A", "x", 7)], POOL), 2)
    assert ("A", "x", 7) in rows(t.read()) and ("A", "lost", 9) not in rows(t.read())
    assert rows(t.of_keys(["A"])) == [("A", "x", 7)]


def test_folders_stay_bounded(spark, tmp_path):
    t = Versions(spark, f"file://{tmp_path}/t", POOL, "country")
    for v in range(50):
        t.replace(spark.createDataFrame([("ABC"[v % 3], "x", v)], POOL), v)
        t.vacuum()
        assert folders(tmp_path) < 20 and len(os.listdir(tmp_path / "t" / "_manifests")) < 6
    assert rows(t.read()) == [("A", "x", 48), ("B", "x", 49), ("C", "x", 47)]
    a = Versions(spark, f"file://{tmp_path}/a", "n long")
    for v in range(40):
        a.append(spark.createDataFrame([(v,)], "n long"), v, most=4)
        a.append(spark.createDataFrame([(v,)], "n long"), v, most=4)
        a.vacuum()
        assert len(a.live()[""]) <= 4 and len([n for n in os.listdir(tmp_path / "a") if n.startswith("version=")]) <= 6
    assert rows(a.read()) == sorted([(v,) for v in range(40)], key=repr)


def test_states_are_replaced_by_country(spark, tmp_path):
    path = f"file://{tmp_path}/s"
    writers.write_state(spark.createDataFrame([("A", "x", 1), ("B", "y", 2)], POOL), path)
    store = writers.write_state(spark.createDataFrame([("B", "z", 3)], POOL), path)
    assert rows(store.read()) == [("A", "x", 1), ("B", "z", 3)] and store.versions() == [1]
    assert rows(spark.read.schema(POOL).parquet(path).select("country", "name", "stars")) == rows(store.read())
    assert writers.write_once(spark.range(3), f"{path}-once") and not writers.write_once(spark.range(4), f"{path}-once")
    assert spark.read.parquet(f"{path}-once").count() == 3


def test_scratch_folders_end_with_their_block(spark, tmp_path):
    with scratch.cleared(spark):
        kept = scratch.settled(spark.range(3))
        path = kept.inputFiles()[0].rsplit("/", 1)[0].removeprefix("file://")
        assert kept.count() == 3 and os.path.exists(path)
    assert not os.path.exists(path)


def test_scratch_needs_a_shared_folder_on_a_cluster(spark, monkeypatch):
    class Context:
        master = "spark://host:7077"
        getCheckpointDir = staticmethod(lambda: None)

    class Session:
        sparkContext = Context

        class conf:
            get = staticmethod(lambda *_: None)

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch.scratch(Session)


CATALOGUE = "code string, name string, aliases array<string>"
PLACES = "code string, kind string, norm string"


def world(spark):
    known = spark.createDataFrame([("LK", "Sri Lanka", []), ("DE", "Germany", ["Deutschland"])], CATALOGUE)
    terms = spark.createDataFrame([("LK", "attribution", "colombo"), ("DE", "attribution", "munchen"), ("DE", "attribution", "twin"), ("LK", "attribution", "twin")], PLACES)
    return known, terms


def test_only_unseen_locations_are_resolved(spark, tmp_path):
    known, terms = world(spark)
    asked = []

    def resolve(df):
        asked.append(sorted(r["location"] for r in df.collect()))
        return attribution.resolve_location(df, known, terms)

    store = verdicts.table(spark, f"file://{tmp_path}/v")
    first = spark.createDataFrame([(1, "Colombo"), (2, "COLOMBO "), (3, None), (4, "lk"), (5, "twin"), (6, "?!")], "n long, location string")
    one = verdicts.judged(first, store, resolve, 0)
    want = attribution.resolve_location(first, known, terms)
    assert rows(one) == rows(want.select(*one.columns))
    assert asked == [["?!", "COLOMBO", "lk", "twin"]]
    assert rows(verdicts.judged(first, store, resolve, 0)) == rows(one)  # the batch again
    again = spark.createDataFrame([(7, "colombo"), (8, "LK"), (9, "München, Germany"), (10, "Munchen,GERMANY")], "n long, location string")
    two = verdicts.judged(again, store, resolve, 1)
    assert rows(two) == rows(attribution.resolve_location(again, known, terms).select(*two.columns))
    assert asked[-1] == ["LK", "Munchen,GERMANY"] and store.read().count() == 6
    later = verdicts.table(spark, f"file://{tmp_path}/v", resolver_version=3)
    verdicts.judged(again, later, resolve, 2)
    assert asked[-1] == ["LK", "Munchen,GERMANY", "colombo"]


PAGE = "name_with_owner string, owner_login string, seq long, stargazer_count long, fork_count long, is_fork boolean, owner_location string"


def test_repositories_fold_the_same_after_a_crash(spark, tmp_path, monkeypatch):
    known, terms = world(spark)
    resolve = lambda df: attribution.resolve_location(df, known, terms)
    path = f"file://{tmp_path}/p"
    run = pools.fold_repositories(path, known, resolve)
    batch = lambda k, places, stars: spark.createDataFrame([(f"o{i}/r", f"o{i}", 10 * k + i, stars + i, 0, i == 9, p) for i, p in enumerate(places)], PAGE)
    run(batch(0, ["Colombo", "Germany", "nowhere", "twin"], 50), 0)
    second = batch(1, ["Colombo", "Deutschland", "Colombo"], 5)

    def broken(self, *_):
        raise OSError("no manifest")

    with monkeypatch.context() as m:
        m.setattr(Versions, "_publish", broken)
        with pytest.raises(OSError):
            run(second, 1)
    pool = pools.repository_pool(spark, path)
    assert rows(pool.read().select("country", "name_with_owner", "stars")) == [("DE", "o1/r", 51), ("LK", "o0/r", 50)]
    for _ in range(2):
        run(second, 1)
        assert rows(pool.read().select("country", "name_with_owner", "stars")) == [("DE", "o1/r", 6), ("LK", "o0/r", 5), ("LK", "o2/r", 7)]
        assert rows(pools.outcomes(spark, path).read().groupBy().sum()) == [(7, 5, 1, 1)]


def test_owner_state_over_batches_and_restarts(spark, tmp_path):
    """The pool of many small runs is that of merges in plain Spark, row by row of each batch."""
    import random

    rnd, path = random.Random(4), f"file://{tmp_path}/o"
    resolve = lambda df: df.withColumn("attribution", F.struct((F.col("location") != "bad").alias("accepted"), F.col("code").alias("country_code"), F.when(F.col("location") == "sure", "high").otherwise("medium").alias("confidence"), F.lit("e").alias("evidence"), F.lit("m").alias("matched"), F.lit(None).cast("array<struct<code:string,name:string>>").alias("conflicts")))
    want, seq = spark.createDataFrame([], owners.OWNERS), 0
    for k in range(3):
        hits = []
        for _ in range(120):
            seq += 1
            login = f"u{rnd.randrange(40)}"
            hits.append(("User", "AB"[rnd.randrange(2)], login, rnd.choice(["sure", "perhaps", "perhaps", "bad", None]), seq, rnd.choice("xyz"), {"nameWithOwner": f"{login}/{rnd.randrange(3)}", "stargazerCount": rnd.randrange(30)}))
        batch = spark.createDataFrame(hits, "typename string, country string, login string, location string, seq long, search_term string, top struct<nameWithOwner:string,stargazerCount:long>")
        run = pools.fold_owners(path, resolve)
        run(batch, k)
        run(batch, k)  # again, as after a crash
        stream = spark.readStream.schema(owners.OWNERS).option("maxFilesPerTrigger", 1).parquet(f"{path}/hits/*")
        with owners.keyed_state(spark):
            pools._run(owners.owner_pools(stream, 5), pools.keep_owners(path), f"{path}/checkpoints/owners", "update")
        good = batch.filter("location IN ('sure', 'perhaps')").select("country", "login", "seq", F.col("top.stargazerCount").alias("stars"), F.col("top.nameWithOwner").alias("repository"), F.when(F.col("location") == "sure", "high").otherwise("medium").alias("confidence"), F.array("search_term").alias("terms"))
        merged = ranking.pool_truncate(ranking.pool_merge(want, ranking.pool_fold(good).select(*want.columns)), limit=5).select(*want.columns)
        want = spark.createDataFrame(merged.collect(), owners.OWNERS)
        assert rows(pools.owner_pool(spark, path).read()) == rows(want)
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass").endswith("HDFSBackedStateStoreProvider")


class Handle:
    """State in a dict."""

    def __init__(self):
        self.kept = {}

    def getMapState(self, *_):
        return self

    def exists(self):
        return bool(self.kept)

    def iterator(self):
        return iter(list(self.kept.items()))

    def updateValue(self, key, value):
        self.kept[key] = value

    def removeKey(self, key):
        del self.kept[key]


def test_pool_is_cut_while_rows_stream(spark):
    """However rows of a batch are ordered: an owner that is pushed out before its own row comes keeps its history."""
    make = lambda logins, stars: pd.DataFrame({"country": "A", "login": logins, "seq": range(len(logins)), "stars": stars, "repository": logins, "confidence": "medium", "terms": [[x] for x in "t" * len(logins)]})
    for order in (False, True):
        pool, state = owners.OwnerPool(2), Handle()
        pool.init(state)
        list(pool.handleInputRows(("A",), iter([make(["a", "b"], [1, 2])]), None))
        fresh = [make([f"n{i}" for i in range(20)], range(10, 30)), make(["a"], [100]).assign(terms=[["later"]])]
        out = next(pool.handleInputRows(("A",), iter(fresh[:: -1 if order else 1]), None))
        got = {r.login: (r.stars, r.terms) for r in out.itertuples()}
        assert got == {"a": (100, ["later", "t"]), "n19": (29, ["t"])} and {k[0] for k in state.kept} == set(got)
