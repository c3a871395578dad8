import hashlib
import random

import pytest

from countryrank.llm import suffix

L = suffix.LENGTH


def brute(texts):
    seen = {}
    raws = [(t or "").encode() for t in texts]
    for raw in raws:
        for p in range(len(raw) - L + 1):
            seen[raw[p : p + L]] = seen.get(raw[p : p + L], 0) + 1
    out = []
    for raw in raws:
        gone = bytearray(len(raw))
        for p in range(len(raw) - L + 1):
            if seen[raw[p : p + L]] > 1:
                gone[p : p + L] = b"\1" * L
        kept = bytes(b for b, g in zip(raw, gone, strict=True) if not g)
        runs = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out.append((len(raw), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return out


def check(spark, texts, ids=None):
    rows = [(i if ids is None else ids[i], t, 1) for i, t in enumerate(texts)]
    got = suffix._cut(spark.createDataFrame(rows, "doc_id long, text string, cls int"), "doc_id", "text", "kept_sha256 string", lambda kept: hashlib.sha256(kept).hexdigest()).collect()
    want = sorted((repr(i), *w) for (i, _, _), w in zip(rows, brute(texts), strict=True))
    assert sorted((repr(r[0]), *r[1:]) for r in got) == want


@pytest.mark.parametrize("seed", range(200))
def test_suffix_array(seed):
    rnd = random.Random(seed)
    a = [rnd.randint(1, rnd.choice([1, 2, 3, 30])) for _ in range(rnd.randint(0, 120))] + [0]
    assert suffix.suffix_array(a) == sorted(range(len(a)), key=lambda i: a[i:])


@pytest.mark.parametrize("seed", [1, 2])
def test_against_brute_force(spark, seed):
    rnd = random.Random(seed)
    letters = "abcdefghij é\n"

    def rand(n):
        return "".join(rnd.choice(letters) for _ in range(n))

    pool = [rand(rnd.randint(150, 500)) for _ in range(6)]
    texts = []
    for _ in range(40):
        parts = []
        for _ in range(rnd.randint(1, 4)):
            x = rnd.choice([*pool, rand(rnd.randint(1, 300))])
            lo = rnd.randint(0, 60)
            parts.append(rnd.choice([x, x[lo:], x[: len(x) - lo]]))
        texts.append(rnd.choice(["", rand(10)]).join(parts))
    base = rand(700)
    for k in range(12):  # near copies: each anchor has many contexts
        at = rnd.randint(0, len(base) - 1)
        texts.append(base[:at] + "#" * (k % 3) + base[at + 1 :])
    texts += ["", None, "a" * 199, "b" * 200, "b" * 200, "c" * 200, "d" * 201, "ab" * 400, base, base, "é" * 150]
    check(spark, texts)
    check(spark, texts, [None if i % 7 == 0 else i // 2 for i in range(len(texts))])


def test_sample_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").collect()
    check(spark, [r[0] for r in docs])


def test_no_rows(spark):
    assert suffix.dedup(spark.createDataFrame([], "doc_id long, text string")).count() == 0
