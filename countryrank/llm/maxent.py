"""Language-model scoring by a hashed maximum-entropy model with a class-factored softmax.

log P(word | history) = log P(class(word) | history) + log P(word | class(word)).

* Every word belongs to a unit: a frequent word is its own, any other goes by its last two bytes. Units are clustered
  into CLASSES classes by the frequent words that they stand beside.
* P(class | history) is a maximum-entropy model over hashed n-gram features (one and two words back) and skip features
  (two back alone, three back alone, one with three back). It is trained on every training document: each logical
  shard, of documents dealt by a hash, takes gradient steps over its documents in a fixed order, and the updates are
  averaged row by row of the weight table through Spark. How the input is partitioned doesn't change a score.
* P(word | class) = (c + 1) / (N_class + V_class + 1), where the 1 in the last term stands for unseen words.

The unigram base score uses the same counts c over all training tokens. Counts of the HEAD most frequent words go to
the tasks (a fixed bound); those of all other words are joined by a shuffle, so no word is left out.

Null texts count as empty: one end token. Repeated ids stay separate rows. Other columns are ignored.
"""

from __future__ import annotations

import math
import uuid
from collections import Counter
from collections.abc import Iterator
from itertools import groupby, repeat

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import written
from .langid import fold_of

HEAD = 1 << 18
FREQUENT = 1 << 14
SUFFIXES = 512
CLASSES = 24
CONTEXTS = 32
ROWS = 1 << 15
BLOCK = 256
BATCH = 2048
END = b"\n"  # no word holds white space
UNITS = FREQUENT + SUFFIXES + 1  # the last one marks what precedes a text
#: Slices of the training documents, in the order of the rounds: hash modulo SLICES below these bounds.
SLICES, ROUNDS = 8, ((0, 1), (1, 8))
#: Training tokens of a logical shard on average, and the updates of how many shards are summed at once.
SHARD, FAN = 1 << 22, 256
UPDATES = "shard long, block int, v binary, n binary"


def tokens(text: str) -> list[bytes]:
    """Words with A-Z in lower case, then the end. bytes.split() splits at ASCII white space only."""
    return [*text.encode().lower().split(), END]


def suffix_unit(w: bytes) -> int:
    """Unit of a word that isn't frequent."""
    return FREQUENT + (w[-1] * 31 + (w[-2] if len(w) > 1 else 0)) % SUFFIXES


class Vocabulary:
    """Counts of the HEAD most frequent words, packed so that it ships as two buffers."""

    def __init__(self, words: list[bytes], counts: list[int]):
        self.blob, self.counts, self.key = b" ".join(w if w != END else b"" for w in words), np.array(counts, dtype=np.int64), uuid.uuid4().hex

    def open(self) -> dict[bytes, int]:
        """Word to rank; kept by a worker from one task to the next."""
        kept = getattr(Vocabulary, "_kept", None)
        if kept is None or kept[0] != self.key:
            words = self.blob.split(b" ") if len(self.counts) else []
            ranks = {w or END: i for i, w in enumerate(words)}
            units = np.array([i if i < FREQUENT else suffix_unit(w or END) for i, w in enumerate(words)], dtype=np.int32)
            kept = Vocabulary._kept = (self.key, ranks, units)
        return kept

    def look_up(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[bytes]]:
        """(rank or -1 of each token, unit, tokens in each text, all tokens)."""
        _, ranks, units = self.open()
        lists = [tokens(t) for t in texts]
        sizes = np.array([len(x) for x in lists], dtype=np.int64)
        flat = [w for x in lists for w in x]
        r = np.fromiter(map(ranks.get, flat, repeat(-1)), dtype=np.int32, count=len(flat))
        u = units[r] if len(units) else np.zeros(len(r), dtype=np.int32)
        for i in np.flatnonzero(r < 0).tolist():
            u[i] = suffix_unit(flat[i])
        return r, u, sizes, flat


def _batches(batches: Iterator[pa.RecordBatch], size: int = 500) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    for b in batches:
        for i in range(0, b.num_rows, size):
            part = b.slice(i, size)
            yield part, [t or "" for t in part.column("text").to_pylist()]


def count_words(train: DataFrame) -> DataFrame:
    """(word binary, n, unit) of all training tokens; each task sums before it sends."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()

        def flush() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(list(seen), pa.binary()), pa.array(list(seen.values()), pa.int64())], ["word", "n"])
            seen.clear()
            return out

        for _, texts in _batches(batches):
            for t in texts:
                seen.update(tokens(t))
            if len(seen) > 400_000:
                yield flush()
        yield flush()

    return train.select("text").mapInArrow(count, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


def frequent_words(counts: DataFrame, most: int = HEAD) -> Vocabulary:
    """The words at or above the least count that at most `most` words reach, the most frequent first."""
    below = Window.partitionBy("part").orderBy(F.desc("n"))
    sizes = counts.groupBy("n").agg(F.count("*").alias("v")).withColumn("part", F.lit(0))  # one row for each distinct count
    least = sizes.withColumn("v", F.sum("v").over(below)).filter(F.col("v") <= most).agg(F.min("n")).first()[0]
    top = [] if least is None else [(-r["n"], bytes(r["word"])) for r in counts.filter(F.col("n") >= least).toLocalIterator()]
    top.sort()
    return Vocabulary([w for _, w in top], [-n for n, _ in top])


def _history(u: np.ndarray, sizes: np.ndarray) -> list[np.ndarray]:
    """Units one, two and three tokens back, UNITS - 1 before the start of a text."""
    place = np.arange(len(u)) - np.repeat(np.concatenate([[0], np.cumsum(sizes)[:-1]]), sizes)
    out = []
    for k in (1, 2, 3):
        h = np.full(len(u), UNITS - 1, dtype=np.int64)
        h[k:] = u[:-k] if len(u) > k else h[k:]
        h[place < k] = UNITS - 1
        out.append(h)
    return out


def features(u: np.ndarray, sizes: np.ndarray) -> list[np.ndarray]:
    """Rows of the weight table that are active for each token, an array for each feature; row 0 is the bias of all."""
    a, b, c = _history(u, sizes)

    def hashed(x: np.ndarray, salt: int) -> np.ndarray:
        x = (x + np.int64(salt) * 1_000_003) * np.int64(0x9E3779B97F4A7C1)
        return (x >> 28 & (ROWS - 1)).astype(np.int16)

    return [hashed(a, 1), hashed(a * UNITS + b, 2), hashed(b, 3), hashed(c, 4), hashed(a * UNITS + c, 5)]


def class_scores(w: np.ndarray, rows: list[np.ndarray]) -> np.ndarray:
    """Score of each class for each token."""
    z = w.take(rows[0], axis=0)
    for r in rows[1:]:
        z += w.take(r, axis=0)
    z += w[0]
    z -= z.max(axis=1, keepdims=True)
    return z


def sgd(w: np.ndarray, g2: np.ndarray, touched: np.ndarray, rows: list[np.ndarray], classes: np.ndarray, rate: float = 0.5) -> None:
    """One pass of Adagrad over the tokens in minibatches; a step sums the gradients of a table row, then scales them.

    Rows are brought together by a radix sort of their 16-bit numbers; the bias, which every token has, is summed apart.
    """
    for i in range(0, len(classes), BATCH):
        r, y = [x[i : i + BATCH] for x in rows], classes[i : i + BATCH]
        g = class_scores(w, r)
        np.exp(g, out=g)
        g /= g.sum(axis=1, keepdims=True)
        g[np.arange(len(y)), y] -= 1
        flat = np.concatenate(r)
        order = np.argsort(flat, kind="stable")
        flat = flat[order]
        first = np.flatnonzero(np.concatenate([[True], flat[1:] != flat[:-1]]))
        used = flat[first]
        total = np.add.reduceat(g.take(order % len(y), axis=0), first, axis=0)
        count = np.diff(np.append(first, len(flat)))
        if used[0] == 0:
            used, total, count = used[1:], total[1:], count[1:]
        for at, t, n in ((used, total, count), (np.zeros(1, dtype=np.int64), g.sum(axis=0, keepdims=True), np.array([len(y)]))):
            g2[at] += np.einsum("ij,ij->i", t, t) / t.shape[1]
            touched[at] += n
            w[at] -= rate * t / np.sqrt(g2[at] + 1.0)[:, None]


def _unit_contexts(train: DataFrame, vocab: Vocabulary) -> np.ndarray:
    """How often each unit stands beside each of the CONTEXTS most frequent words, over all training documents."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(UNITS * CONTEXTS, dtype=np.int64)
        for _, texts in _batches(batches):
            _, u, sizes, _ = vocab.look_up(texts)
            before = _history(u, sizes)[0]
            for x, y in ((u, before), (before, u)):
                near = y < CONTEXTS
                total += np.bincount(x[near] * CONTEXTS + y[near], minlength=len(total))
        for k, part in enumerate(np.array_split(total, UNITS // BLOCK + 1)):
            if part.any():
                yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([part.tolist()], pa.list_(pa.int64()))], ["block", "v"])

    summed = train.select("text").mapInArrow(count, "block int, v array<bigint>").groupBy("block").applyInPandas(lambda b: pd.DataFrame({"block": [b["block"].iloc[0]], "v": [np.sum(np.stack(b["v"].to_list()), axis=0).tolist()]}), "block int, v array<bigint>")
    parts = np.array_split(np.zeros(UNITS * CONTEXTS, dtype=np.int64), UNITS // BLOCK + 1)
    for r in summed.collect():  # a table of fixed size
        parts[r["block"]] = np.array(r["v"], dtype=np.int64)
    return np.concatenate(parts).reshape(UNITS, CONTEXTS)


def cluster(contexts: np.ndarray, classes: int = CLASSES, rounds: int = 12, seed: int = 3) -> np.ndarray:
    """Class of each unit: spherical k-means over the units' contexts, relative to what the contexts have on average."""
    share = (contexts + 0.1) / (contexts.sum(axis=1, keepdims=True) + 0.1 * contexts.shape[1])
    x = np.log(share / share.mean(axis=0))
    x /= np.linalg.norm(x, axis=1, keepdims=True) + 1e-9
    weight = np.sqrt(contexts.sum(axis=1) + 1.0)
    rnd = np.random.default_rng(seed)
    centre = x[rnd.choice(len(x), classes, replace=False, p=weight / weight.sum())]
    label = np.zeros(len(x), dtype=np.int64)
    for _ in range(rounds):
        label = (x @ centre.T).argmax(axis=1)
        for k in range(classes):
            if (label == k).any():
                centre[k] = (x[label == k] * weight[label == k, None]).sum(axis=0)
                centre[k] /= np.linalg.norm(centre[k]) + 1e-9
    return label


def _shards(batches: Iterator[pa.RecordBatch], texts: int = 200, chars: int = 1 << 20) -> Iterator[tuple[int, list[str]]]:
    """(shard, texts) in order, cut by what a shard holds alone: never by the Arrow batches that rows happen to come in."""
    shard, got, size = None, [], 0
    for b in batches:
        for i in range(0, b.num_rows, 500):
            part = b.slice(i, 500)
            for k, t in zip(part.column("shard").to_pylist(), part.column("text").to_pylist(), strict=True):
                if got and (k != shard or len(got) == texts or size >= chars):
                    yield shard, got
                    got, size = [], 0
                shard = k
                got.append(t)
                size += len(t)
    if got:
        yield shard, got


def _added(b: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Sums of the updates and of their counts, in the order of the shards."""
    b = b.sort_values("shard")
    v, n = np.zeros((BLOCK, CLASSES)), np.zeros(BLOCK, dtype=np.int64)
    for x, m in zip(b["v"], b["n"], strict=True):
        v += np.frombuffer(x, dtype=np.float32).reshape(BLOCK, CLASSES)
        n += np.frombuffer(m, dtype=np.int64)
    return v, n


def _merge(group: tuple, b: pd.DataFrame) -> pd.DataFrame:
    v, n = _added(b)
    return pd.DataFrame({"shard": [group[1]], "block": [group[0]], "v": [v.astype(np.float32).tobytes()], "n": [n.tobytes()]})


def _average(b: pd.DataFrame) -> pd.DataFrame:
    v, n = _added(b)
    return pd.DataFrame({"block": [b["block"].iloc[0]], "v": [(v / np.maximum(n, 1)[:, None]).astype(np.float32).tobytes()]})


def train_weights(train: DataFrame, vocab: Vocabulary, label: np.ndarray, tokens_all: int, id_col: str = "doc_id") -> np.ndarray:
    """Weight table after the rounds of distributed gradient updates over all training documents.

    The documents of a round are dealt to logical shards by a hash of id and text and sorted within, and as many shards are
    made as the number of tokens asks for, so the table is the same however the rows were split before.
    """
    w = np.zeros((ROWS, CLASSES), dtype=np.float32)
    hashed = train.select(F.xxhash64(F.col(id_col), F.col("text")).alias("h"), "text")
    part = F.pmod(F.col("h"), F.lit(SLICES))
    for low, high in ROUNDS:
        start, shards = w, max(1, math.ceil(tokens_all * (high - low) / SLICES / SHARD))

        def step(batches: Iterator[pa.RecordBatch], start: np.ndarray = start) -> Iterator[pa.RecordBatch]:
            for shard, lists in groupby(_shards(batches), key=lambda x: x[0]):
                own, g2, touched = start.copy(), np.zeros(ROWS, dtype=np.float32), np.zeros(ROWS, dtype=np.int64)
                for _, texts in lists:
                    _, u, sizes, _ = vocab.look_up(texts)
                    sgd(own, g2, touched, features(u, sizes), label[u])
                for k in range(0, ROWS, BLOCK):
                    n = touched[k : k + BLOCK]
                    if n.any():
                        v = (own[k : k + BLOCK] - start[k : k + BLOCK]) * n[:, None].astype(np.float32)
                        yield pa.RecordBatch.from_arrays([pa.array([shard], pa.int64()), pa.array([k], pa.int32()), pa.array([v.astype(np.float32).tobytes()], pa.binary()), pa.array([n.tobytes()], pa.binary())], ["shard", "block", "v", "n"])

        some = hashed.filter((part >= low) & (part < high)).withColumn("shard", F.pmod(F.xxhash64("h"), F.lit(shards)))
        some = some.repartitionById(shards, F.col("shard").cast("int")).sortWithinPartitions("shard", "h", "text")
        rows = some.select("shard", "text").mapInArrow(step, UPDATES)
        while shards > FAN:
            rows = rows.groupBy("block", F.floor(F.col("shard") / FAN)).applyInPandas(_merge, UPDATES)
            shards = math.ceil(shards / FAN)
        w = start.copy()
        for r in rows.groupBy("block").applyInPandas(_average, "block int, v binary").collect():  # ROWS / BLOCK rows of fixed size
            w[r["block"] : r["block"] + BLOCK] += np.frombuffer(r["v"], dtype=np.float32).reshape(BLOCK, CLASSES)
    return w


def score(docs: DataFrame, held_out: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Base and model scores of all documents, learning from those that held_out leaves."""
    docs = docs.select(F.col(id_col), F.coalesce(F.col(text_col), F.lit("")).alias("text"), F.coalesce(held_out, F.lit(False)).alias("held_out"))
    train = docs.filter(~F.col("held_out"))
    counts = written(count_words(train), "counts")
    tot = counts.agg(F.sum("n").alias("n"), F.count("*").alias("v")).first()
    n_all, v_all = int(tot["n"] or 0), int(tot["v"])
    vocab = frequent_words(counts)
    label = cluster(_unit_contexts(train, vocab))
    weights = train_weights(train, vocab, label, n_all, id_col)
    n_class, v_class = _class_totals(counts, vocab, label)
    log_z = np.log10(n_class + v_class + 1.0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        log_c = np.log10(np.concatenate([vocab.counts, [0]]) + 1.0)
        for part, texts in _batches(batches):
            r, u, sizes, flat = vocab.look_up(texts)
            y = label[u]
            lp = np.empty(len(u))
            rows = features(u, sizes)
            for i in range(0, len(u), 1 << 12):
                z = class_scores(weights, [x[i : i + (1 << 12)] for x in rows])
                own = z[np.arange(len(z)), y[i : i + (1 << 12)]]
                lp[i : i + (1 << 12)] = own - np.log(np.exp(z, out=z).sum(axis=1))
            owner = np.repeat(np.arange(len(sizes)), sizes)
            sums = [np.bincount(owner, weights=x, minlength=len(sizes)) for x in (np.where(r >= 0, log_c[r], 0.0), r >= 0, lp / np.log(10) - log_z[y])]
            rare, tails = np.flatnonzero(r < 0), [Counter() for _ in range(len(sizes))]
            for i, d in zip(rare.tolist(), owner[rare].tolist(), strict=True):
                tails[d][flat[i]] += 1
            yield pa.RecordBatch.from_arrays(
                [part.column(id_col), part.column("held_out"), pa.array(sizes), pa.array(sums[0]), pa.array(sums[1].astype(np.int64)), pa.array(sums[2]), pa.array([list(t) for t in tails], pa.list_(pa.binary())), pa.array([list(t.values()) for t in tails], pa.list_(pa.int64()))],
                [id_col, "held_out", "n_tokens", "s", "k", "m", "words", "times"],
            )

    kind = docs.schema[id_col].dataType.simpleString()
    made = docs.mapInArrow(run, f"`{id_col}` {kind}, held_out boolean, n_tokens long, s double, k long, m double, words array<binary>, times array<long>")
    made = written(made.withColumn("_row", F.monotonically_increasing_id()), "scored")
    rare = made.select("_row", F.explode(F.arrays_zip("words", "times")).alias("x")).select("_row", "x.words", "x.times")
    known = rare.join(counts, F.col("words") == F.col("word")).groupBy("_row").agg(F.sum(F.col("times") * F.log10(F.col("n") + 1)).alias("s2"), F.sum("times").alias("k2"))
    out = made.drop("words", "times").join(known, "_row", "left")
    total = F.col("s") + F.coalesce("s2", F.lit(0.0))
    return out.select(
        id_col, "held_out", "n_tokens", (F.col("k") + F.coalesce("k2", F.lit(0))).alias("n_known"), F.lit(n_all).cast("bigint").alias("train_tokens"),
        (total - F.col("n_tokens") * F.log10(F.lit(float(n_all + v_all + 1)))).alias("base_score"), (total + F.col("m")).alias("score"),
    )


def _class_totals(counts: DataFrame, vocab: Vocabulary, label: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Tokens and distinct words of each class: those of the frequent words from their counts, the rest by last bytes."""
    units = min(FREQUENT, len(vocab.counts))
    n, v = np.zeros(CLASSES), np.zeros(CLASSES)
    np.add.at(n, label[:units], vocab.counts[:units])
    np.add.at(v, label[:units], 1)
    least = int(vocab.counts[units - 1]) if units else 0
    edge = [bytes(w) or END for w in vocab.blob.split(b" ")[:units]] if units else []
    tied = [w for w, c in zip(edge, vocab.counts[:units].tolist(), strict=True) if c == least]
    rest = counts.filter(F.col("n") <= least)  # words as rare as the last frequent one are told apart below
    hexed = F.hex(F.substring(F.col("word"), -2, 2))
    for r in rest.groupBy(hexed.alias("h")).agg(F.sum("n").alias("n"), F.count("*").alias("v")).collect():  # 65,792 rows at most
        c = label[suffix_unit(bytes.fromhex(r["h"]))]
        n[c] += r["n"]
        v[c] += r["v"]
    for w in tied:
        c = label[suffix_unit(w)]
        n[c] -= least
        v[c] -= 1
    return n, v


def op4(spark, sf_dir: str) -> DataFrame:
    """All documents, learned from those whose crc32 modulo 7 isn't 2."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return score(docs, fold_of("doc_id", 7) == 2)
