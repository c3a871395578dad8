import random

import numpy as np
import pytest

from countryrank.llm import jaccard
from countryrank.llm.components import components
from countryrank.llm.passages import tokens


def brute(texts):
    sets = {}
    for i, t in texts:
        w = (t or "").encode().lower().split()
        sets[i] = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
    where, up = {}, {i: i for i in sets}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for i, s in sets.items():
        for g in s:
            where.setdefault(g, []).append(i)
    for i, s in sets.items():
        for j in {j for g in s for j in where[g] if j < i}:
            both = len(s & sets[j])
            if 100 * both >= 75 * len(s | sets[j]):
                a, b = sorted((root(i), root(j)))
                up[b] = a
    return {i: (len(s), root(i)) for i, s in sets.items()}


def check(spark, texts):
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in texts], "doc_id long, text string, n string, component int")
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.cluster(df).collect()}
    assert got == brute(texts)


def near(rnd, words, share):
    return [w if rnd.random() > share else f"z{rnd.random()}" for w in words]


@pytest.mark.parametrize("hot", [2, 32])
def test_against_brute_force(spark, monkeypatch, hot):
    monkeypatch.setattr(jaccard, "HOT", hot)
    rnd = random.Random(hot)
    passage = [f"p{i}" for i in range(60)]
    texts = []
    for k in range(12):
        base = [f"w{k}_{rnd.randint(0, 400)}" for _ in range(rnd.choice([5, 8, 20, 60, 150, 300]))]
        for _ in range(rnd.randint(1, 9)):
            own = near(rnd, base, rnd.choice([0, 0.01, 0.03, 0.06]))
            if rnd.random() < 0.4:
                own = own[: len(own) // 2] + passage + own[len(own) // 2 :]
            texts.append(" ".join(own))
    for _ in range(30):  # mostly the passage: hot buckets decide
        own = [f"u{rnd.random()}" for _ in range(rnd.randint(5, 30))]
        texts.append(" ".join(near(rnd, passage, 0.01) + own))
    texts += ["", None, "one", "ONE", "one two", "a b c d", "a b c d e", "A b C d e", texts[0], texts[0], " \t "]
    check(spark, list(enumerate(texts)))


def test_few_filled_segments(spark):
    """Shingles of short texts may fall in so few segments that one difference spoils them all."""
    texts = []
    for n in range(1, 65):
        for seed in range(400 if n < 8 else 20):
            w = [f"v{n}_{seed}_{i}" for i in range(n + 5)]
            texts += [" ".join(w[:-1]), " ".join(w)]
    check(spark, list(enumerate(texts)))


def test_one_filled_segment(spark):
    """8 shingles in one segment, and 6 of them: one deletion isn't enough."""
    words = [f"q{i}" for i in range(500_000)]
    x = tokens([" ".join(words).encode()])[0]
    m = next(m for s, m, _ in jaccard.schemes(6) if s == 2)
    with np.errstate(over="ignore"):
        seg = jaccard.mix(x + np.uint64(3) * jaccard._A) % np.uint64(m)
    same = np.convolve(seg[1:] == seg[:-1], np.ones(7), "valid")
    texts = []
    for i in np.flatnonzero(same == 7)[:10].tolist():
        texts += [" ".join(words[i : i + 10]), " ".join(words[i : i + 12])]
    assert texts
    check(spark, list(enumerate(texts)))


def test_sample_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    check(spark, [(r[0], r[1]) for r in docs])


def test_empty_and_null_ids(spark):
    assert jaccard.cluster(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    df = spark.createDataFrame([(None, "a b c d e f"), (None, "q"), (4, "a b c d e f")], "doc_id long, text string")
    assert {tuple(r) for r in jaccard.cluster(df).collect()} == {(None, 2, 4), (None, 1, None), (4, 2, 4)}


def brute_rows(texts):
    """(id, n_shingles, component id) of each row, with rows as documents."""
    parts = brute(list(enumerate(t for _, t in texts)))
    least = {}
    for k, (i, _) in enumerate(texts):
        least[parts[k][1]] = min(least.get(parts[k][1], i), i)
    return sorted((i, parts[k][0], least[parts[k][1]]) for k, (i, _) in enumerate(texts))


def family(rnd, size, words, edits):
    """Copies of one origin, each with other words in `edits` places of its own."""
    base, out = [f"o{rnd.random()}" for _ in range(words)], []
    for _ in range(size):
        own = list(base)
        for at in rnd.sample(range(words), edits):
            own[at] = f"e{rnd.random()}"
        out.append(" ".join(own))
    return out


def test_texts_of_one_id(spark):
    """Ids with several texts, each of which links with another id."""
    rnd = random.Random(3)
    texts = []
    for k in range(30):
        a, b = family(rnd, 2, 120, 2), family(rnd, 2, 120, 2)
        texts += [(1000 + k, a[0]), (1000 + k, b[0]), (2000 + k, a[1]), (3000 + k, b[1])]
    got = jaccard.cluster(spark.createDataFrame(texts, "doc_id long, text string")).collect()
    assert sorted(tuple(r) for r in got) == brute_rows(texts)


def test_large_groups_that_do_not_link(spark):
    """150 texts around one origin: most are too far from it and from each other, some are near it, some are cut off."""
    rnd = random.Random(4)
    texts = [t for k in (1, 2, 3, 4, 5, 6) for t in family(random.Random(9), 1, 146, 0) + family(rnd, 1, 146, k)]
    base = texts[0].split()
    for k in range(150):
        own = base[: 90 + k % 30] if k % 10 == 0 else list(base)
        for at in rnd.sample(range(len(own)), 3 + k % 6):
            own[at] = f"e{rnd.random()}"
        texts.append(" ".join(own))
    check(spark, list(enumerate(texts)))


def test_numbers_that_clash(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "node_of", lambda text: jaccard.F.pmod(jaccard.F.xxhash64(text), jaccard.F.lit(40)))
    rnd = random.Random(6)
    check(spark, list(enumerate([t for _ in range(40) for t in family(rnd, 3, 60, 1)] + ["", None, "a b"])))


def test_buckets_across_batches():
    """Counts are right up to HOT, whatever the batches; copies of a row count once."""
    import pyarrow as pa

    rnd = random.Random(8)
    rows = sorted((k, -1, n) for k in range(300) for n in rnd.choices(range(1000), k=rnd.choice([1, 2, 3, 30, 60, 500])))
    want = {}
    for k, _, n in rows:
        want.setdefault(k, set()).add(n)
    batches, at = [], 0
    while at < len(rows):
        part = rows[at : at + rnd.choice([1, 50, 90_000])]
        at += len(part)
        k, t, n = (np.array(x) for x in zip(*part, strict=True))
        batches.append(pa.RecordBatch.from_arrays([pa.array(k), pa.array(n), pa.array(t)], ["key", "node", "n"]))
    out = [r for b in jaccard._buckets(["key", "node", "n"], "n")(iter(batches)) for r in b.to_pylist()]
    assert {(r["key"], r["node"]) for r in out} == {(k, n) for k, v in want.items() if len(v) > 1 for n in v}
    for r in out:
        size = len(want[r["key"]])
        assert r["c"] == size if size <= jaccard.HOT else r["c"] > jaccard.HOT


def test_very_long_text(spark):
    """A text of 300,000 words, a copy of it with a few other words, and its first half."""
    rnd = random.Random(10)
    words = [f"l{rnd.randint(0, 10**9)}" for _ in range(300_000)]
    texts = [" ".join(words), " ".join(near(rnd, words, 0.01)), " ".join(words[:150_000])]
    check(spark, list(enumerate(texts)))


def test_bounds():
    """Every similar pair of sizes shares a scheme with more segments than it has differences."""
    for x in range(1, 700):
        for y in range(x, 4 * x // 3 + 1):
            shared = {s: (m, h) for s, m, h in jaccard.schemes(x)}.keys() & {s for s, _, _ in jaccard.schemes(y)}
            assert jaccard.band(x) in shared
            d = (x + y) // 7
            for n in (x, y):
                m, h = next((m, h) for s, m, h in jaccard.schemes(n) if s == jaccard.band(x))
                assert m > h >= d


def test_components(spark):
    rnd = random.Random(5)
    pairs = [(rnd.randint(0, 300), rnd.randint(0, 300)) for _ in range(180)] + [(i, i + 1) for i in range(1000, 1090)]
    up = {x: x for p in pairs for x in p}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in pairs:
        a, b = sorted((root(a), root(b)))
        up[b] = a
    got = {r[0]: r[1] for r in components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert got == {x: root(x) for x in up}
