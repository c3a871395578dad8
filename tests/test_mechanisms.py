"""Ranges, queues, active terms, facets, certificates, backfills and maintained terms against plain Python."""

import os
import random
from collections import Counter

from pyspark.sql import functions as F

from countryrank.operators import attribution, gazetteer, shards, status
from countryrank.sources import writers
from countryrank.streaming import pools
from test_streams import PAGE, folders, rows, world


def test_blocks_are_the_range(spark):
    rnd = random.Random(1)
    pairs = [(0, 0), (0, 1), (1, 1), (0, 1023), (5, 4), (7, 1000), (1, 2**40)] + [tuple(sorted((rnd.randrange(3000), rnd.randrange(3000)))) for _ in range(30)]
    df = spark.createDataFrame(pairs, "lo long, hi long")
    for r in df.select("lo", "hi", shards.dyadic(F.col("lo"), F.col("hi")).alias("b")).collect():
        spans = sorted((b["prefix"] << b["level"], (b["prefix"] + 1 << b["level"]) - 1) for b in r["b"])
        assert all(a[1] + 1 == b[0] for a, b in zip(spans, spans[1:]))
        assert (spans[0][0], spans[-1][1]) == (r["lo"], r["hi"]) if r["lo"] <= r["hi"] else not spans


def test_rows_meet_their_ranges(spark):
    rnd = random.Random(2)
    values = [rnd.randrange(2000) for _ in range(300)] + [0, None, 10**12] + [77] * 100
    ranges = [(0, 9, 1), (10, 76, 1), (77, 77, 1), (78, 1500, 1), (70, 80, 1)]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id long, stars long")
    out = shards.rows_in_ranges(df, spark.createDataFrame(ranges, "min_stars long, max_stars long, n long"))
    want = []
    for i, v in enumerate(values):
        held = [(i, v, lo, hi) for lo, hi, _ in ranges if v is not None and lo <= v <= hi]
        want += held or [(i, v, None, None)]
    assert rows(out) == sorted(want, key=repr)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert shards.rows_in_ranges(df, spark.createDataFrame([], "min_stars long, max_stars long, n long")).filter("min_stars IS NULL").count() == len(values)


def test_planned_ranges_hold_their_counts(spark):
    rnd = random.Random(3)
    df = spark.createDataFrame([(int(rnd.paretovariate(0.7)) % 5000 + 1,) for _ in range(2000)], "stars long")
    ranges = shards.split_star_ranges(shards.star_histogram(df), 1, 5000, cap=100)
    met = Counter((r["min_stars"], r["max_stars"]) for r in shards.rows_in_ranges(df, ranges).collect())
    plan = {(r["min_stars"], r["max_stars"]): r["n"] for r in ranges.collect()}
    assert met == {k: n for k, n in plan.items() if n}
    spent, open_ = 0, []
    for (lo, hi), n in sorted(plan.items(), reverse=True):
        spent += max(1, -(-n // 40))
        if spent > 25:
            open_.append((lo, hi, n))
    assert rows(shards.scan_queue(ranges, 25, 40)) == sorted(open_, key=repr)


def test_facets_equal_a_walk_from_the_top(spark):
    rnd = random.Random(4)
    made = [(rnd.choice(["a", "b"]), rnd.choice("xyz"), str(rnd.choice([2007, 2008, 2009, 2010])), rnd.choice("mn")) for _ in range(400)] + [("c", "x", None, "m")] * 5
    df = spark.createDataFrame(made, "type string, followers string, year string, month string")
    levels = ["type", "followers", "year", "month"]
    seen = []

    def walk(level, path, some):
        missed = level >= 3 and path[2] == "uncovered"
        if len(some) <= 30 or level == 4 or missed:
            seen.append((level, *path, *[None] * (4 - level), len(some), len(some) > 30, not missed))
            return
        for v in sorted({r[level] for r in some}):
            walk(level + 1, [*path, v], [r for r in some if r[level] == v])

    cut = [(t, f, *((y, m) if y and 2008 <= int(y) <= 2009 else ("uncovered",) * 2)) for t, f, y, m in made]
    walk(0, [], cut)
    assert rows(shards.facet_shards(df, 30, levels, (2008, 2009))) == sorted(seen, key=repr)
    assert rows(shards.facet_shards(df.limit(3), 30, levels)) == [(0, None, None, None, None, 3, False, True)]


STATES = "code string, next_term_index long, terms_total long, terms_processed long, active_term string, active_since string, completed_at string"
EVENTS = "code string, seq long, kind string, term string, at string"


def test_active_terms_event_by_event(spark):
    rnd = random.Random(5)
    states = [(c, i, i + rnd.randrange(6), i, *(("held", "t-1") if i % 2 else (None, None)), "before" if i == 4 else None) for i, c in enumerate("ABCDEFGH")]
    events = [(rnd.choice("ABCDEFG"), n, rnd.choice(["begin", "begin", "finish", "defer", "page"]), f"term{n}", f"t{n:03}") for n in range(160)]
    want = []
    for code, nx, total, done, term, since, completed in states:
        index, delays, last = nx if since else None, 0, None
        for _, _, kind, name, at in sorted(e for e in events if e[0] == code):
            last = at
            if kind == "begin" and index is None:
                index, term, since, delays = nx, name, at, 0
            elif kind == "defer" and index is not None:
                delays += 1
            elif kind == "finish" and index is not None:
                nx, done, index, term, since, delays = nx + 1, done + 1, None, None, None, 0
                completed = completed or (at if nx >= total else None)
        want.append((code, nx, total, done, "complete" if nx >= total else "discovery", index, term, since, delays, completed, completed, last))
    got = status.resume_progress(spark.createDataFrame(states, STATES), spark.createDataFrame(events, EVENTS))
    assert rows(got) == sorted(want, key=repr)


def test_documents_are_published_once(spark, tmp_path):
    known, _ = world(spark)
    catalogue = known.withColumn("slug", F.lower("code"))
    pool = spark.createDataFrame([(c, f"{c}/{i}", f"o{i}", s - i, 0) for c, s in (("LK", 100), ("DE", 50)) for i in range(4)], "country string, name_with_owner string, owner string, stars long, forks long")
    path = f"file://{tmp_path}/c"
    publish = lambda frontier, now, run: rows(writers.publish_certified(pool, spark.createDataFrame([(frontier,)], "frontier long"), catalogue, path, now, run, {}, limit=3).select("country", "certified_at"))
    at = lambda: {d: os.path.getmtime(tmp_path / "c" / "rankings" / d) for d in os.listdir(tmp_path / "c" / "rankings") if "=" in d}
    assert publish(100, "t0", 0) == []
    assert publish(60, "t1", 1) == [("LK", "t1")]
    before = at()
    assert publish(60, "t2", 2) == [] and at() == before
    assert publish(10, "t3", 3) == [("DE", "t3")]
    assert set(at()) == {"country_code=LK", "country_code=DE"} and at()["country_code=LK"] == before["country_code=LK"]
    assert publish(10, "again", 3) == [("DE", "t3")]
    assert rows(writers.certified(spark, path).read().select("country", "certified_at")) == [("DE", "t3"), ("LK", "t1")]


def test_backfill_moves_only_stale_rows(spark, tmp_path):
    known, terms = world(spark)
    old = terms.filter("norm <> 'munchen'").unionByName(spark.createDataFrame([("LK", "attribution", "munchen")], terms.schema))
    by = lambda t: lambda df: attribution.resolve_location(df, known, t)
    path = f"file://{tmp_path}/p"
    batch = lambda k, places: spark.createDataFrame([(f"o{k}{i}/r", f"o{k}{i}", 10 * k + i, 50 + i, 0, False, p) for i, p in enumerate(places)], PAGE)
    pools.fold_repositories(path, known, by(old), 1)(batch(0, ["München", "Sri Lanka", "München"]), 0)
    pools.fold_repositories(path, known, by(terms), 2)(batch(1, ["Germany"]), 1)
    pool = pools.repository_pool(spark, path)
    have = lambda: rows(pool.read().select("country", "name_with_owner", "resolver"))
    assert have() == [("DE", "o10/r", 2), ("LK", "o00/r", 1), ("LK", "o01/r", 1), ("LK", "o02/r", 1)]
    assert pools.backfill(spark, path, known, by(terms), 2) == ["LK"]
    assert have() == [("DE", "o00/r", 2), ("DE", "o02/r", 2), ("DE", "o10/r", 2), ("LK", "o01/r", 2)]
    assert pools.backfill(spark, path, known, by(terms), 2) == []
    nobody = by(terms.limit(0))
    assert pools.backfill(spark, path, known.limit(0), nobody, 3) == ["DE", "LK"] and have() == []
    pools.fold_repositories(path, known, by(terms), 3)(batch(2, ["Germany"]), 2)  # the stream goes on
    assert have() == [("DE", "o20/r", 3)]


def test_terms_are_kept_up_to_date(spark, tmp_path):
    rnd, path = random.Random(6), f"file://{tmp_path}/t"
    now = {c: {f"n{rnd.randrange(12)}" for _ in range(6)} for c in "ABCDEF"}
    frame = lambda: spark.createDataFrame([(c, "discovery", n) for c, ns in now.items() for n in ns] + [("A", "compound", "n1")], "code string, kind string, norm string")
    gazetteer.update_terms(frame(), path, list(now), 0)
    for k in range(1, 4):
        changed = rnd.sample(sorted(now), 2)
        for c in changed:
            now[c] = {f"n{rnd.randrange(12)}" for _ in range(5)} if k < 3 else set()
        pairs, _ = gazetteer.term_tables(spark, path)
        kept = {p: vs for p, vs in pairs.live().items() if p[-1] not in changed}
        for _ in range(2):  # the second time, nothing happens
            gazetteer.update_terms(frame(), path, changed, k)
            assert rows(gazetteer.kept_ambiguous_terms(spark, path)) == rows(gazetteer.ambiguous_terms(frame()))
        assert kept.items() <= pairs.live().items()  # other countries aren't written
    assert folders(tmp_path) < 40
