"""The mix against targets, counts and places made in plain Python; reruns, limits and odd rows."""

import random
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from countryrank.llm import mixing

SCHEMA = "doc_id long, text string, source string"


def documents(n=400, seed=3):
    rnd = random.Random(seed)
    out = []
    for i in range(n):
        source = rnd.choice(["big"] * 6 + ["a", "b", "Ω", "ü", None, "z"])
        out.append((i, " ".join("abc"[: rnd.randint(1, 3)] for _ in range(rnd.randint(0, 300))), source))
    out += [(900, "one two\tthree", "tiny"), (901, None, "tiny"), (902, "", "none"), (None, "four five", "a"), (7, "x \x0b y", None)]
    return out + [out[0]] * 30 + [(None, "same text here", "big")] * 50


def run(spark, rows, parts=3, **how):
    df = spark.createDataFrame(rows, SCHEMA).repartition(parts).withColumn("size", F.lit("x")).withColumn("k", F.lit(0))
    src, docs, slots = mixing.mix(df, **how)
    return src, docs, slots, mixing.taken(docs, slots, how.get("block", mixing.BLOCK))


def targets(rows):
    size = Counter()
    for _, text, source in rows:
        size[source] += len((text or "").split())
    weight = {s: (1, 2, 3)[i % 3] for i, s in enumerate(sorted(size, key=lambda s: (s is None, (s or "").encode())))}
    total, held = sum(size.values()), {}
    while True:
        left, free = total - sum(held.values()), sum(w for s, w in weight.items() if s not in held)
        above = [s for s in size if s not in held and weight[s] * left / free > 3 * size[s]]
        if not above:
            return size, {s: held.get(s, weight[s] * left / max(free, 1)) for s in size}
        held |= {s: 3 * size[s] for s in above}


def test_targets_and_limits(spark):
    rows = documents()
    src, docs, slots, taken = run(spark, rows, block=4)
    size, target = targets(rows)
    assert {r["source"]: r["words"] for r in src.collect()} == size
    assert any(t == 3 * size[s] > 0 for s, t in target.items()) and any(t < size[s] for s, t in target.items())
    for r in src.collect():
        assert abs(r["target"] - target[r["source"]]) < 1e-6
    got = taken.collect()
    assert Counter((r["id"], r["size"], r["source"]) for r in got) == Counter((i, len((t or "").split()), s) for i, t, s in rows)
    assert all(0 <= r["taken"] <= 3 * r["size"] for r in got)
    by = Counter()
    for r in got:
        by[r["source"]] += r["taken"]
    for s, t in target.items():
        assert abs(by[s] - t) <= 0.03 * t + 40


def test_taken_follows_slots(spark):
    """Streams are gapless; what is taken is the overlap with the blocks of the slots."""
    _, docs, slots, taken = run(spark, documents(), block=16, shard=50)
    streams, order = defaultdict(list), {}
    for r in docs.collect():
        order[r["k"]] = r["source"]
        if r["size"]:
            streams[r["k"]].append((r["start"], r["size"], r["id"]))
    times = Counter((r["k"], r["block"]) for r in slots.collect())
    want = Counter()
    for k, docs_ in streams.items():
        at = 0
        for start, size, i in sorted(docs_):
            assert start == at
            at += size
            want[k, i, sum(times[k, w // 16] for w in range(start, start + size))] += 1
    got = taken.filter("size > 0").collect()
    assert Counter((r["k"], r["id"], r["taken"]) for r in got) == want
    assert max(times.values()) <= 3
    for k in order:  # a round reads every block once before one is read again
        n = [c for (s, _), c in times.items() if s == k]
        assert not n or max(n) == 1 or len(n) == -(-sum(s for _, s, _ in streams[k]) // 16)
        assert not n or max(n) - min(n) <= 1
    place = Counter((r["shard"], r["slot"]) for r in slots.collect())
    assert max(place.values()) == 1


def test_reruns_agree(spark):
    rows = documents()
    one = sorted(map(tuple, run(spark, rows, 1)[3].collect()), key=repr)
    random.Random(5).shuffle(rows)
    assert sorted(map(tuple, run(spark, rows, 7)[3].collect()), key=repr) == one


def test_permutations(spark):
    for n in (1, 2, 3, 7, 64, 1000):
        got = [r[0] for r in spark.range(n).select(mixing.permuted(F.col("id"), F.lit(n).cast("bigint"), F.lit(5))).collect()]
        assert sorted(got) == list(range(n)) and (n < 64 or got != list(range(n)))


def test_draws_are_near_their_shares(spark):
    src = spark.createDataFrame([(0, int(10.3 * mixing.UNIT)), (1, int(500.5 * mixing.UNIT)), (2, 0), (3, int(89.2 * mixing.UNIT))], "k long, share long")
    got = Counter()
    shards = set()
    for r in mixing.drawn(src, shard=40).collect():
        got[r["k"]] += r["n"]
        shards.add(r["shard"])
    assert sum(got.values()) in (599, 600) and len(shards) > 10 and got[2] == 0
    assert abs(got[0] - 10.3) < 6 and abs(got[1] - 500.5) < 9 and abs(got[3] - 89.2) < 9


def test_mixed_texts(spark):
    rows = [(i, f"w{i}a w{i}b  w{i}c", "s") for i in range(10)] + [(i, f"v{i}", "t") for i in range(40)]
    df = spark.createDataFrame(rows, SCHEMA)
    src, docs, slots = mixing.mix(df, block=4)
    out = mixing.mixed_texts(df, docs, slots, block=4).collect()
    got = Counter(w for r in out for w in r["text"].split())
    want = {r["id"]: r["taken"] for r in mixing.taken(docs, slots, 4).filter("source = 't'").collect()}
    assert {i: got[f"v{i}"] for i in range(40)} == want
    assert len(out) == slots.count()


def test_no_rows(spark):
    assert run(spark, [])[3].count() == 0
    assert [r["taken"] for r in run(spark, [(1, None, None), (2, " ", "a")])[3].collect()] == [0, 0]
