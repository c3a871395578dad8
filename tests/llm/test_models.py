"""Language ID and language-model scores: exact parts against brute force, models on held-out text."""

import collections
import math
import random
import zlib

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from countryrank.llm import langid, maxent
from countryrank.llm.langid import fold_of

SF = "/root/testdata/sf0.001"


def test_language_id(spark):
    got = langid.op8(spark, "/root/testdata/sf0.01").toPandas()
    docs = pd.read_parquet("/root/testdata/sf0.01/documents.parquet")
    both = got.merge(docs, on="doc_id")
    assert len(both) == len(docs)
    assert (both["held_out"] == [zlib.crc32(str(i).encode()) % 3 == 1 for i in both["doc_id"]]).all()
    held = both[both["held_out"]]
    assert (held["lang_pred"] == held["lang"]).mean() > 0.97
    assert both["score"].between(0, 1).all()


def test_language_id_edges(spark):
    en, de = "the cat and the dog with this " * 30, "der hund und die katze mit dem " * 30
    rows = [(i, (en, de)[i % 2], ("en", "de")[i % 2], 1.0) for i in range(40)] + [(50, None, "en", 0.0), (51, "", None, 0.0), (52, "123 %% 456", "de", 0.0), (None, en.upper(), None, 0.0), (53, de * 300, None, 0.0), (53, de * 300, None, 0.0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, score double")
    model = langid.fit(df)
    got = langid.predict(df, model).collect()
    assert len(got) == len(rows)
    by = {r["doc_id"]: r for r in got}
    assert by[50]["lang_pred"] == by[51]["lang_pred"] == by[52]["lang_pred"] == "und" and by[52]["score"] == 0
    assert by[None]["lang_pred"] == "en" and by[53]["lang_pred"] == "de" and by[0]["lang"] == "en"
    nothing = df.filter("false")
    assert langid.fit(nothing) is None
    assert {r["lang_pred"] for r in langid.predict(df, None).collect()} == {"und"}
    assert langid.predict(nothing, model).count() == 0


def check_base(rows, texts, held):
    counts = collections.Counter()
    tok = [[*(t or "").encode().lower().split(), b"\n"] for t in texts]
    for t, h in zip(tok, held, strict=True):
        if not h:
            counts.update(t)
    n, v = sum(counts.values()), len(counts)
    for r, t in zip(rows, tok, strict=True):
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(t), sum(counts[w] > 0 for w in t), n)
        assert math.isclose(r["base_score"], sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in t), rel_tol=1e-9, abs_tol=1e-6)


def test_scores(spark, monkeypatch):
    docs = pd.read_parquet(f"{SF}/documents.parquet").sort_values("doc_id")
    got = maxent.op4(spark, SF).orderBy("doc_id").collect()
    held = [zlib.crc32(str(i).encode()) % 7 == 2 for i in docs["doc_id"]]
    assert [r["held_out"] for r in got] == held
    check_base(got, docs["text"], held)
    out = [r for r in got if r["held_out"]]
    assert sum(r["score"] for r in out) > sum(r["base_score"] for r in out)


def test_rare_words_are_joined(spark, monkeypatch):
    monkeypatch.setattr(maxent, "HEAD", 8)
    texts = ["a b c a b", "a x y z", None, "", "b c d e f a", "a q", "only here", "A b"]
    df = spark.createDataFrame([(i, t, 0) for i, t in enumerate(texts)], "doc_id long, text string, score int")
    got = maxent.score(df, (df["doc_id"] % 3) == 2).orderBy("doc_id").collect()
    check_base(got, texts, [i % 3 == 2 for i in range(len(texts))])


def test_scores_by_brute_force(spark, monkeypatch):
    """Every score as a sum over tokens of log P(class | history) + log P(word | class), and probabilities that add up to 1."""
    kept = {}
    for name in ("cluster", "train_weights"):
        monkeypatch.setattr(maxent, name, lambda *a, f=getattr(maxent, name), n=name, **k: kept.setdefault(n, f(*a, **k)))
    rnd = random.Random(1)
    words = [*"abcdefgh", "xa", "yb", "zzz"]
    train = [" ".join(rnd.choices(words, k=rnd.randint(1, 30))) for _ in range(50)]
    texts = [*train, "", None, "a b unseen C", " ".join(rnd.choices(words, k=20_000))]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r["score"] for r in maxent.score(df, df["doc_id"] >= len(train)).collect()}
    counts = collections.Counter(w for t in train for w in [*t.encode().split(), maxent.END])
    units = {w: i for i, (w, _) in enumerate(sorted(counts.items(), key=lambda x: (-x[1], x[0])))}
    unit = lambda w: units.get(w, maxent.suffix_unit(w))
    label, weights = kept["cluster"], kept["train_weights"].astype(float)
    n, v = collections.Counter(), collections.Counter()
    for w, c in counts.items():
        n[label[unit(w)]] += c
        v[label[unit(w)]] += 1

    def classes(u):
        """P(class | history) of the last of the units u."""
        rows = [int(f[-1]) for f in maxent.features(np.array(u), np.array([len(u)]))]
        z = np.exp(weights[[0, *rows]].sum(axis=0))
        return z / z.sum()

    within = lambda w: (counts[w] + 1) / (n[label[unit(w)]] + v[label[unit(w)]] + 1)
    for i, t in enumerate(texts[:-1]):
        u, total = [], 0.0
        for w in [*(t or "").lower().encode().split(), maxent.END]:
            u.append(unit(w))
            total += math.log10(classes(u)[label[unit(w)]] * within(w))
        assert math.isclose(total, got[i], rel_tol=1e-4), i
    assert got[len(texts) - 1] < -1000
    p = classes([0, 1, 2])
    known = sum(p[label[unit(w)]] * within(w) for w in counts)
    assert math.isclose(known + sum(p[k] / (n[k] + v[k] + 1) for k in range(maxent.CLASSES)), 1, rel_tol=1e-9)


def test_scores_do_not_depend_on_the_split(spark, monkeypatch):
    """Equal scores over 1, 6 and 40 partitions, rows in any order and Arrow batches of any size, with many shards."""
    monkeypatch.setattr(maxent, "SHARD", 20_000)
    monkeypatch.setattr(maxent, "FAN", 3)
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    held, name = fold_of("doc_id", 7) == 2, "spark.sql.execution.arrow.maxRecordsPerBatch"
    want, before = None, spark.conf.get(name)
    for parts, batch in ((1, "10000"), (6, "7"), (40, "10000")):
        spark.conf.set(name, batch)
        try:
            got = {r["doc_id"]: r["score"] for r in maxent.score(docs.orderBy(F.rand(parts)).repartition(parts), held).collect()}
        finally:
            spark.conf.set(name, before)
        want = want or got
        assert got.keys() == want.keys() and all(math.isclose(got[k], want[k], rel_tol=1e-6) for k in want)


def test_no_rows(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert maxent.score(df, df["doc_id"] == 1).count() == 0
    one = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    r = maxent.score(one, one["doc_id"] == 1).first()
    assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (3, 0, 0)
