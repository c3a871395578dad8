"""Language identification by a byte convolutional network.

Filters of several widths slide over the bytes of fixed windows, each keeps its largest response, and a softmax reads
them. The filters act on one-hot bytes, so a response is a sum of table rows and needs no embedding. The network is
trained in numpy on a bounded sample of labelled rows (TRAIN_DOCS per language, all windows of each); inference
covers every window of every whole text and averages their probabilities by their letters.

Null texts and texts without a letter get `und` and score 0, as does everything if there is nothing to learn from.
Only the text is an input of a prediction; extra columns are ignored, and repeated rows stay separate rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import fresh

WINDOW = 192
WIDTHS = (2, 3, 4)
FILTERS = 16
TRAIN_DOCS = 400
EPOCHS = 3
NONE = "und"


def _folded() -> np.ndarray:
    """Byte table: A-Z to lower case, digits to 0, white space and signs to a space."""
    t = np.arange(256, dtype=np.uint8)
    t[:128] = 32
    t[97:123] = np.arange(97, 123)
    t[65:91] = np.arange(97, 123)
    t[48:58] = 48
    return t


FOLD = _folded()


def fold_bytes(raw: np.ndarray) -> np.ndarray:
    """Folds letter case in ASCII and in the Latin-1 letters of UTF-8, and signs to spaces."""
    out = FOLD[raw]
    if len(raw) > 1:
        upper = (raw[:-1] == 0xC3) & (raw[1:] >= 0x80) & (raw[1:] <= 0x9E)
        out[1:][upper] = raw[1:][upper] + 0x20
    return out


def windows(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(windows by WINDOW bytes, index of the text of each), padded with spaces at the ends of texts."""
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    counts = -(-sizes // WINDOW)
    flat = fold_bytes(np.frombuffer(b"".join(texts), dtype=np.uint8))
    out = np.full((int(counts.sum()), WINDOW), 32, dtype=np.uint8)
    owner = np.repeat(np.arange(len(texts)), counts)
    starts, firsts = np.concatenate([[0], np.cumsum(sizes)[:-1]]), np.concatenate([[0], np.cumsum(counts)[:-1]])
    at = np.arange(len(flat), dtype=np.int64)
    at += np.repeat(firsts * WINDOW - starts, sizes)
    out.reshape(-1)[at] = flat
    return out, owner


def _pooled(x: np.ndarray, filters: list[np.ndarray], bias: list[np.ndarray]) -> tuple[np.ndarray, list[np.ndarray]]:
    """Largest response of each filter over the positions of each window, and those responses."""
    pooled, all_ = [], []
    for t, b in zip(filters, bias, strict=True):
        w, n = t.shape[0], WINDOW - t.shape[0] + 1
        r = np.take(t[0], x[:, :n], axis=0)
        for j in range(1, w):
            r += np.take(t[j], x[:, j : j + n], axis=0)
        all_.append(r)
        pooled.append(r.max(axis=1) + b)
    return np.concatenate(pooled, axis=1), all_


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def predict_windows(x: np.ndarray, model: dict, chunk: int = 256) -> np.ndarray:
    """Class probabilities of each window."""
    out = np.empty((len(x), len(model["langs"])), dtype=np.float32)
    for i in range(0, len(x), chunk):
        h, _ = _pooled(x[i : i + chunk], model["filters"], model["bias"])
        out[i : i + chunk] = softmax(np.maximum(h, 0) @ model["out"] + model["out_bias"])
    return out


def train(x: np.ndarray, y: np.ndarray, langs: list[str], epochs: int = EPOCHS, seed: int = 1) -> dict:
    """Fits the network with Adam on minibatches; the same rows give the same network."""
    rnd = np.random.default_rng(seed)
    h = FILTERS * len(WIDTHS)
    p = {f"t{w}": rnd.normal(0, 0.1, (w, 256, FILTERS)).astype(np.float32) for w in WIDTHS}
    p |= {f"b{w}": np.zeros(FILTERS, np.float32) for w in WIDTHS}
    p |= {"v": rnd.normal(0, 0.1, (h, len(langs))).astype(np.float32), "c": np.zeros(len(langs), np.float32)}
    m1, m2, step = {k: np.zeros_like(v) for k, v in p.items()}, {k: np.zeros_like(v) for k, v in p.items()}, 0
    weight = 1 / np.maximum(np.bincount(y, minlength=len(langs)), 1)
    weight = (weight / weight[y].mean()).astype(np.float32)
    for _ in range(epochs):
        order = rnd.permutation(len(x))
        for i in range(0, len(x), 64):
            rows = order[i : i + 64]
            xb, yb = x[rows], y[rows]
            hb, responses = _pooled(xb, [p[f"t{w}"] for w in WIDTHS], [p[f"b{w}"] for w in WIDTHS])
            act = np.maximum(hb, 0)
            g = softmax(act @ p["v"] + p["c"])
            g[np.arange(len(yb)), yb] -= 1
            g *= (weight[yb] / len(yb))[:, None]
            grad = {"v": act.T @ g, "c": g.sum(0)}
            dh = (g @ p["v"].T) * (hb > 0)
            for k, w in enumerate(WIDTHS):
                d, best = dh[:, k * FILTERS : (k + 1) * FILTERS], responses[k].argmax(axis=1)
                gt, f = np.zeros_like(p[f"t{w}"]), np.broadcast_to(np.arange(FILTERS), best.shape)
                for j in range(w):
                    np.add.at(gt[j], (np.take_along_axis(xb, best + j, axis=1), f), d)
                grad |= {f"t{w}": gt, f"b{w}": d.sum(0)}
            step += 1
            for k, gk in grad.items():
                m1[k] += 0.1 * (gk - m1[k])
                m2[k] += 0.001 * (gk * gk - m2[k])
                p[k] -= 0.01 * (m1[k] / (1 - 0.9**step)) / (np.sqrt(m2[k] / (1 - 0.999**step)) + 1e-8)
    return {"langs": langs, "filters": [p[f"t{w}"] for w in WIDTHS], "bias": [p[f"b{w}"] for w in WIDTHS], "out": p["v"], "out_bias": p["c"]}


def fold_of(id_col: str, parts: int) -> Column:
    """crc32 of the id as text, modulo parts."""
    return F.crc32(F.encode(F.coalesce(F.col(id_col).cast("string"), F.lit("")), "UTF-8")) % parts


def fit(labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", per_lang: int = TRAIN_DOCS) -> dict | None:
    """Trains on all windows of at most per_lang labelled rows of each language, those with the smallest hashes.

    Ranks are made of hashes alone, of which a task sends at most per_lang for each language; texts are read for the rows
    within the bound only. Rows with equal ids and texts have equal hashes: the bound then holds some more of them.
    """
    of = F.xxhash64(F.col(id_col), F.col(text_col))
    some = labelled.filter(F.col(lang_col).isNotNull() & F.rlike(F.col(text_col), F.lit("\\p{L}"))).select(F.col(lang_col).alias("l"), of.alias("h"), F.col(text_col).alias("t"))
    order = Window.partitionBy("l").orderBy("h")
    bounds = some.select("l", "h").distinct().withColumn("n", F.row_number().over(order)).filter(F.col("n") <= per_lang).groupBy("l").agg(F.max("h").alias("most"))
    rows = some.join(F.broadcast(bounds), "l").filter("h <= most").select("l", "h", "t").toPandas()  # one bound for each language
    if rows.empty:
        return None
    rows = rows.sort_values(["l", "h"], kind="stable").drop_duplicates(["l", "h"])
    langs = sorted(rows["l"].unique())
    x, owner = windows([t.encode() for t in rows["t"]])
    y = np.searchsorted(langs, rows["l"].to_numpy().astype(str))[owner]
    letters = (x != 32).mean(axis=1) > 0.4
    return train(x[letters], y[letters], langs) if letters.any() else None


def predict(df: DataFrame, model: dict | None, text_col: str = "text", lang_out: str = "lang_pred", score_out: str = "score") -> DataFrame:
    """df with the predicted language and its probability."""
    if model is None:
        return df.withColumn(lang_out, F.lit(NONE)).withColumn(score_out, F.lit(0.0))
    fields = [f for f in df.schema if f.name not in (lang_out, score_out)]
    names = [f.name for f in fields]
    (said,) = fresh([*names, lang_out, score_out], "_seen")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields) + f", `{lang_out}` string, `{score_out}` double"

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        langs = np.array([*model["langs"], NONE], dtype=object)
        for b in batches:
            for i in range(0, b.num_rows, 200):  # bounds the windows held at once
                part = b.slice(i, 200)
                texts = [t.encode() for t in part.column(said).to_pylist()]
                best, sure = np.full(len(texts), len(langs) - 1), np.zeros(len(texts))
                x, owner = windows(texts)
                if len(x):
                    p = predict_windows(x, model)
                    letters = (x != 32).sum(axis=1) + 1e-9
                    total = np.zeros((len(texts), p.shape[1]))
                    for k in range(p.shape[1]):
                        total[:, k] = np.bincount(owner, weights=p[:, k] * letters, minlength=len(texts))
                    share = total / np.maximum(np.bincount(owner, weights=letters, minlength=len(texts)), 1e-9)[:, None]
                    has = np.bincount(owner, minlength=len(texts)) > 0
                    best, sure = np.where(has, share.argmax(axis=1), best), np.where(has, share.max(axis=1), 0.0)
                cols = [part.column(n) for n in names]
                yield pa.RecordBatch.from_arrays([*cols, pa.array(langs[best], pa.string()), pa.array(np.clip(sure, 0, 1), pa.float64())], [*names, lang_out, score_out])

    seen = F.when(F.rlike(F.col(text_col), F.lit("\\p{L}")), F.col(text_col)).otherwise(F.lit(""))
    return df.select(*[f"`{n}`" for n in names], F.coalesce(seen, F.lit("")).alias(said)).mapInArrow(score, schema)


def op8(spark, sf_dir: str) -> DataFrame:
    """Languages of all documents, learned from those outside the held-out third."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    held = fold_of("doc_id", 3) == 1
    model = fit(docs.filter(~held))
    ids = docs.select("doc_id", "text", held.alias("held_out"))
    return predict_slim(ids, model)


def predict_slim(ids: DataFrame, model: dict | None) -> DataFrame:
    """Predictions without the texts: these enter the tasks once, as what is seen, and don't come back."""
    seen = ids.select("doc_id", "held_out", F.col("text").alias("_t"))
    if model is None:
        return seen.select("doc_id", "held_out", F.lit(NONE).alias("lang_pred"), F.lit(0.0).alias("score"))
    return predict(seen.select("doc_id", "held_out", "_t"), model, text_col="_t").select("doc_id", "held_out", "lang_pred", "score")

