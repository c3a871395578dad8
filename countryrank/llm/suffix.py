"""Exact removal of repeated substrings with suffix arrays built by linear grouping.

Every byte covered by a string of LENGTH bytes that also starts anywhere else goes. Matches never cross documents.

* Anchors: of the hashes of all GRAM-byte strings, the least in each window of LENGTH - GRAM + 1 is an anchor. Equal
  strings of LENGTH bytes hold the same anchors at the same places, so occurrences of one anchor meet by its hash.
* The context of an anchor is all bytes that LENGTH-byte strings around it can have. Occurrences with equal contexts
  repeat one another whole; tasks and buckets settle those by two 64-bit hashes, of the anchor and of the context, and send
  one occurrence of each context on. Bytes of settled contexts aren't compared: the chance of a wrong removal is that of
  two different contexts with the same 128 bits.
* Different contexts of one anchor are compared byte by byte: their right parts and their reversed left parts are
  written as strings of SYMBOL-byte symbols, whose suffix arrays give the order of the parts and the bytes that neighbours
  share. Two contexts hold the same string at the same place exactly if both parts share enough.

Null and short texts lose nothing. Repeated rows repeat each other. Ids may be null or repeat; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import sliced, small_batches, written
from .jaccard import _A, _B, mix

LENGTH = 200
GRAM = 32
LEFT = LENGTH - GRAM
WHOLE = LEFT + LENGTH
#: Bytes of a symbol of the suffix arrays.
SYMBOL = 24
#: Right or left parts whose suffix array is built at once, unless one anchor has more.
AT_ONCE = 20_000


def suffix_array(s: list[int]) -> list[int]:
    """Suffix array of a list of small numbers whose last is its only 0.

    First, suffixes are grouped by their Lyndon prefixes: groups start as first symbols and are taken in descending
    order; every member looks up the nearest suffix before it in a lower group, and suffixes named l times by a group
    leave their own group for one right behind it, those with more mentions behind those with fewer. Then suffixes are
    emitted in ascending order: each one places, in their groups, the suffixes whose Lyndon prefix ends at it.
    """
    n = len(s)
    top = max(s) + 1
    members: list[list[int]] = [[] for _ in range(top)]
    for i, c in enumerate(s):
        members[c].append(i)
    gid, before, after, done = list(s), list(range(-1, top - 1)), list(range(1, top + 1)), [False] * top
    after[-1] = -1
    prev = [-1] * n
    g = top - 1
    while g >= 0:
        counts: dict[int, int] = {}
        for i in members[g]:
            if gid[i] == g:
                p = i - 1
                while p >= 0 and (gid[p] == g or done[gid[p]]):
                    p = prev[p]
                prev[i] = p
                if p >= 0:
                    counts[p] = counts.get(p, 0) + 1
        done[g] = True
        by: dict[int, list[int]] = {}
        for p, k in counts.items():
            by.setdefault(k, []).append(p)
        for k in sorted(by, reverse=True):
            made: dict[int, int] = {}
            for p in by[k]:
                old = gid[p]
                new = made.get(old)
                if new is None:
                    new = made[old] = len(members)
                    members.append([])
                    done.append(False)
                    before.append(old)
                    after.append(after[old])
                    if after[old] >= 0:
                        before[after[old]] = new
                    after[old] = new
                gid[p] = new
                members[new].append(p)
        g = before[g]
    sizes = [0] * len(members)
    for x in gid:
        sizes[x] += 1
    start, at, g = [0] * len(members), 0, 0
    while g >= 0:
        start[g] = at
        at += sizes[g]
        g = after[g]
    out, placed = [-1] * n, [False] * n
    out[0], placed[n - 1] = n - 1, True
    start[gid[n - 1]] += 1
    for i in range(n):
        p = out[i] - 1
        while p >= 0 and not placed[p]:
            x = gid[p]
            out[start[x]] = p
            start[x] += 1
            placed[p] = True
            p = prev[p]
    return out


def sliding(x: np.ndarray, width: int, least) -> np.ndarray:
    """least (a ufunc) over each window of `width` elements."""
    have = 1
    while have < width:
        step = min(have, width - have)
        x = least(x[: len(x) - step], x[step:])
        have += step
    return x


def grams(text: np.ndarray) -> np.ndarray:
    """Hash of the GRAM bytes at each place."""
    n = len(text) - GRAM + 1
    with np.errstate(over="ignore"):
        words = np.ndarray((n + GRAM - 8,), dtype="<u8", buffer=text, strides=(1,))
        h = words[:n] * _A
        for k in range(8, GRAM, 8):
            h = (h ^ (h >> np.uint64(29))) * _B + words[k : k + n]
        return mix(h)


def anchors(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(places of the anchors, hashes of all grams)."""
    h = grams(np.frombuffer(text, dtype=np.uint8))
    low = sliding(h, LEFT + 1, np.minimum)
    # the largest of the minima of the windows that hold a place
    edge = np.zeros(LEFT, dtype=np.uint64)
    high = sliding(np.concatenate([edge, low, edge]), LEFT + 1, np.maximum)
    return np.flatnonzero(h == high), h


def fingerprints(text: bytes, at: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Hash of the context of each anchor; contexts that a text's ends clip are hashed with their sizes."""
    out = np.zeros(len(at), dtype=np.uint64)
    n = len(text)
    full = (at >= LEFT) & (at + LENGTH <= n)
    with np.errstate(over="ignore"):
        i = at[full]
        f = h[i + LEFT].copy()
        for k, off in enumerate(range(-LEFT, LEFT, GRAM)):
            f = mix(f + h[i + off] * np.uint64(2 * k + 3))
        out[full] = f
    for j in np.flatnonzero(~full).tolist():
        i = int(at[j])
        part = text[max(0, i - LEFT) : i + LENGTH]
        out[j] = int.from_bytes(hashlib.blake2b(part, digest_size=8, salt=min(i, LEFT).to_bytes(2, "big")).digest(), "big")
    return out


def _occurrences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (key, print, id, cls, place, size, times): an anchor's occurrence, or, with times = 0, a span that is settled.

    Equal contexts within a batch settle each other; one of them goes on as two.
    """
    for b in sliced(batches):
        cols: list[list[np.ndarray]] = []
        for i, c, t in zip(*(b.column(k).to_pylist() for k in range(3)), strict=True):
            raw = t.encode()
            if len(raw) < LENGTH:
                continue
            at, h = anchors(raw)
            cols.append([h[at].view(np.int64), fingerprints(raw, at, h).view(np.int64), np.full(len(at), i, dtype=np.int64), np.full(len(at), c, dtype=np.int64), at, np.full(len(at), len(raw), dtype=np.int64)])
        if not cols:
            continue
        key, mark, ids, cls, at, size = (np.concatenate(c) for c in zip(*cols, strict=True))
        first, times, settled = _same(key, mark, np.ones(len(key), dtype=np.int64))
        own = key.copy()
        with np.errstate(over="ignore"):  # settled spans meet nobody: they are spread over all partitions
            key[settled] = mix(ids[settled].view(np.uint64) * _A + at[settled].view(np.uint64)).view(np.int64)
        out = [np.concatenate([x[first], x[settled]]) for x in (own, mark, ids, cls, at, size)]
        out[0] = np.concatenate([own[first], key[settled]])
        out.append(np.concatenate([np.minimum(times[first], 2), np.zeros(len(settled), dtype=np.int64)]))
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in out], list(ROW))


#: Columns of an occurrence.
ROW = ("key", "print", "id", "cls", "place", "size", "times")


def _same(key: np.ndarray, mark: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(a row of each distinct pair, total weight of each row's pair, rows whose pair weighs more than one)."""
    order = np.lexsort((mark, key))
    k, m = key[order], mark[order]
    new = np.concatenate([[True], (k[1:] != k[:-1]) | (m[1:] != m[:-1])])
    group = np.cumsum(new) - 1
    total = np.zeros(len(key), dtype=np.int64)
    total[order] = np.bincount(group, weights=weight[order]).astype(np.int64)[group]
    return order[new], total, np.flatnonzero(total > 1)


def _meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Buckets of a partition: settled spans (times = 0), and one occurrence of each context of anchors with several."""
    got = [b for b in batches if b.num_rows]
    if not got:
        return
    t = pa.Table.from_batches(got)
    c = {n: t.column(n).to_numpy() for n in ROW}
    del got, t
    spans, rows = np.flatnonzero(c["times"] == 0), np.flatnonzero(c["times"] > 0)
    out = [{n: c[n][spans] for n in ROW}]
    if len(rows):
        key = c["key"][rows]
        first, total, settled = _same(key, c["print"][rows], c["times"][rows])
        out.append({n: c[n][rows[settled]] for n in ROW} | {"times": np.zeros(len(settled), dtype=np.int64)})
        order = first[np.argsort(key[first], kind="stable")]
        k = key[order]
        many = np.zeros(len(k), dtype=bool)
        if len(k) > 1:
            same = k[1:] == k[:-1]
            many[1:] |= same
            many[:-1] |= same
        some = order[many]
        out.append({n: c[n][rows[some]] for n in ROW} | {"times": np.minimum(total[some], 2)})
    for part in out:
        for lo in range(0, len(part["key"]), 1 << 18):
            yield pa.RecordBatch.from_arrays([pa.array(part[n][lo : lo + (1 << 18)]) for n in ROW], list(ROW))


def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Bytes of the contexts that are still to be compared."""
    names = ["key", "id", "cls", "place", "size", "times", "bytes"]
    for b in sliced(batches):
        out: list[tuple] = []
        for i, c, t, wanted in zip(*(b.column(k).to_pylist() for k in range(4)), strict=True):
            raw = t.encode()
            for w in wanted:
                p = w["place"]
                out.append((w["key"], i, c, p, len(raw), w["times"], raw[max(0, p - LEFT) : p + LENGTH]))
                if len(out) >= 20_000:
                    yield _batch(out, names)
                    out = []
        if out:
            yield _batch(out, names)


def _batch(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    cols = list(zip(*rows, strict=True))
    return pa.RecordBatch.from_arrays([*[pa.array(c, pa.int64()) for c in cols[:-1]], pa.array(cols[-1], pa.binary())], names)


def shared_order(key: np.ndarray, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order of rows by key and bytes, bytes that each shares with the row before it, -1 at the first of a key)."""
    m, width = parts.shape
    padded = np.zeros((m, -(-width // SYMBOL) * SYMBOL), dtype=np.uint8)
    padded[:, :width] = parts
    words = padded.view(">u8").astype(np.uint64).reshape(-1, SYMBOL // 8)
    by = np.lexsort(words.T[::-1])
    symbols = np.zeros(len(words), dtype=np.int64)
    symbols[by[1:]] = np.cumsum((words[by[1:]] != words[by[:-1]]).any(axis=1))
    symbols = symbols.reshape(m, -1)
    text = np.ones((m, symbols.shape[1] + 2), dtype=np.int64)  # the key's rank, the symbols, and a 1 as the end
    text[:, 0] = np.unique(key, return_inverse=True)[1] + 2
    text[:, 1:-1] = symbols + 2
    per = text.shape[1]
    sa = np.array(suffix_array([*text.ravel().tolist(), 0]), dtype=np.int64)
    order = sa[(sa % per == 0) & (sa < m * per)] // per
    differ = parts[order[1:]] != parts[order[:-1]]
    shared = np.where(differ.any(axis=1), differ.argmax(axis=1), width)
    shared[key[order[1:]] != key[order[:-1]]] = -1
    return order, np.concatenate([[-1], shared])


def _classes(key: np.ndarray, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each row its place in the order of distinct keys and parts, and the bytes shared with what is before it."""
    with np.errstate(over="ignore"):
        wide = np.zeros((len(parts), -(-parts.shape[1] // 8) * 8), dtype=np.uint8)
        wide[:, : parts.shape[1]] = parts
        mark = key.view(np.uint64) * _A
        for col in wide.view("<u8").astype(np.uint64).T:
            mark = mix(mark + col)
    _, one, back = np.unique(mark, return_index=True, return_inverse=True)
    order, same = shared_order(key[one], parts[one])
    place, shared = np.empty(len(one), dtype=np.int64), np.empty(len(one), dtype=np.int64)
    place[order], shared[order] = np.arange(len(one)), same
    return place[back], shared[back]


def _runs(k: np.ndarray) -> tuple[list[int], list[int]]:
    first = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]]))
    return first.tolist(), [*first[1:].tolist(), len(k)]


def repeated(key: np.ndarray, left: np.ndarray, right: np.ndarray, n_left: np.ndarray, n_right: np.ndarray, times: np.ndarray) -> np.ndarray:
    """Which strings are repeated: a row for each context, a column for each number of bytes before the anchor."""
    out = np.zeros((len(key), LEFT + 1), dtype=bool)
    lp, ls = _classes(key, left)
    rp, rs = _classes(key, right)

    def ids(place: np.ndarray, shared: np.ndarray, least: int) -> np.ndarray:
        by = np.zeros(place.max() + 1, dtype=np.int64)
        by[place] = shared < least
        return np.cumsum(by)[place]

    for before in range(LEFT + 1):
        fit = np.flatnonzero((n_left >= before) & (n_right >= LENGTH - before))
        if not len(fit):
            continue
        a, b = ids(lp, ls, before)[fit], ids(rp, rs, LENGTH - before)[fit]
        _, inverse = np.unique(a * (b.max() + 1) + b, return_inverse=True)
        out[fit, before] = np.bincount(inverse, weights=times[fit])[inverse] > 1
    return out


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Spans (id, cls, low, high) of the strings that are repeated in other contexts of the same anchor."""
    got = [b for b in batches if b.num_rows]
    if not got:
        return
    t = pa.Table.from_batches(got).sort_by("key")
    del got
    keys = t.column("key").to_numpy()
    starts, ends = _runs(keys)
    lo = 0
    for a, e in zip(starts, ends, strict=True):
        if e - lo >= AT_ONCE or e == len(keys):
            yield from _compared(t.slice(lo, e - lo))
            lo = e


def _compared(t: pa.Table) -> Iterator[pa.RecordBatch]:
    key, ids, cls, place, times = (t.column(n).to_numpy() for n in ("key", "id", "cls", "place", "times"))
    left, right = np.zeros((len(key), LEFT), dtype=np.uint8), np.zeros((len(key), LENGTH), dtype=np.uint8)
    n_left, n_right = np.minimum(place, LEFT), np.zeros(len(key), dtype=np.int64)
    for i, raw in enumerate(t.column("bytes").to_pylist()):
        x = np.frombuffer(raw, dtype=np.uint8)
        k = int(n_left[i])
        left[i, :k] = x[:k][::-1]
        n_right[i] = len(x) - k
        right[i, : len(x) - k] = x[k:]
    hit = repeated(key, left, right, n_left, n_right, times)
    row, before = np.nonzero(hit)
    if not len(row):
        return
    # columns of a row ascend, so starts descend: neighbouring strings make one span
    start = place[row] - before
    cut = np.concatenate([[True], (row[1:] != row[:-1]) | (start[:-1] - start[1:] > LENGTH)])
    first = np.flatnonzero(cut)
    last = np.concatenate([first[1:], [len(row)]]) - 1
    yield pa.RecordBatch.from_arrays([pa.array(ids[row[first]]), pa.array(cls[row[first]]), pa.array(start[last]), pa.array(start[first] + LENGTH)], ["id", "cls", "low", "high"])


def _keyed(df: DataFrame, id_col: str, text_col: str, keep: bool = False) -> DataFrame:
    """id (null: 0), cls (a hash of the text that tells texts of one id apart) and text; keep: and the id as it was."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return df.select(*[F.col(id_col).alias("_id")] * keep, F.coalesce(F.col(id_col).cast("bigint"), F.lit(0)).alias("id"), F.xxhash64(text).alias("cls"), text.alias("text"))


def repeated_spans(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, cls, spans): spans of repeated bytes of each text that has some; they may touch and overlap."""
    docs = _keyed(df, id_col, text_col)
    long = docs.filter(F.octet_length("text") >= LENGTH)
    kind = ", ".join(f"{n} long" for n in ROW)
    met = written(long.mapInArrow(_occurrences, kind).repartition("key").mapInArrow(_meet, kind), "met")
    settled = met.filter("times = 0").select("id", "cls", F.greatest(F.col("place") - LEFT, F.lit(0)).alias("low"), F.least(F.col("place") + LENGTH, F.col("size")).alias("high"))
    wanted = met.filter("times > 0").groupBy("id", "cls").agg(F.collect_list(F.struct("key", "place", "times")).alias("wanted"))
    bytes_ = long.join(wanted, ["id", "cls"]).select("id", "cls", "text", "wanted")
    found = bytes_.mapInArrow(_contexts, "key long, id long, cls long, place long, size long, times long, bytes binary").repartition("key").mapInArrow(_compare, "id long, cls long, low long, high long")
    return settled.unionByName(found).groupBy("id", "cls").agg(F.collect_set(F.struct("low", "high")).alias("spans"))


def kept_mask(size: int, spans: list) -> np.ndarray:
    """Which bytes stay."""
    edge = np.zeros(size + 1, dtype=np.int64)
    for low, high in spans:
        edge[low] += 1
        edge[high] -= 1
    return np.cumsum(edge)[:size] == 0


def dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """df with kept (the remaining bytes), n_bytes, n_removed and n_spans."""
    return _cut(df, id_col, text_col, "kept binary", lambda kept: kept)


def _cut(df: DataFrame, id_col: str, text_col: str, out: str, make) -> DataFrame:
    spans = written(repeated_spans(df, id_col, text_col), "spans")
    docs = _keyed(df, id_col, text_col, keep=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in sliced(batches):
            rows = []
            for t, s in zip(b.column("text").to_pylist(), b.column("spans").to_pylist(), strict=True):
                raw = t.encode()
                if s:
                    stay = kept_mask(len(raw), [(x["low"], x["high"]) for x in s])
                    kept = np.frombuffer(raw, dtype=np.uint8)[stay].tobytes()
                    gone = np.concatenate([[False], ~stay])
                    rows.append((len(raw), len(raw) - len(kept), int((gone[1:] & ~gone[:-1]).sum()), make(kept)))
                else:
                    rows.append((len(raw), 0, 0, make(raw)))
            cols = list(zip(*rows, strict=True)) or [(), (), (), ()]
            yield pa.RecordBatch.from_arrays([b.column("_id"), *[pa.array(c, pa.int64()) for c in cols[:3]], pa.array(cols[3], pa.string() if out.endswith("string") else pa.binary())], [id_col, "n_bytes", "n_removed", "n_spans", out.split()[0]])

    kind = df.schema[id_col].dataType.simpleString()
    return docs.join(spans, ["id", "cls"], "left").select("_id", "text", "spans").mapInArrow(run, f"`{id_col}` {kind}, n_bytes long, n_removed long, n_spans long, {out}")


def op10(spark, sf_dir: str) -> DataFrame:
    """All documents without the bytes of repeated 200-byte strings."""
    small_batches(spark, 500)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return _cut(docs, "doc_id", "text", "kept_sha256 string", lambda kept: hashlib.sha256(kept).hexdigest())
