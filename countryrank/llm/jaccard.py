"""N-gram Jaccard join by universe partition and pigeonhole.

Two documents link when the Jaccard similarity of their sets of 5-word shingles is 0.75 or more. Then their sets of x and
y shingles differ in at most H = floor((x + y) / 7) shingles.

* Sizes fall in bands of ratio 2. The scheme of a band serves the pairs whose smaller set is in it. It hashes all shingles
  into m segments, m above the largest H of the band. A document takes part in the scheme of its own band and, if it
  may have partners in the band below, in that one.
* A segment's key is a hash of its place and its shingles. Empty segments are never indexed. Of more than H filled
  segments, one at least is equal in both documents, so pairs meet in the bucket of a key.
* Costs are measured bucket sizes. A document takes its segments from the cheapest on until it has one more than H; a
  segment that nobody shares costs nothing. Whoever gets there with such segments alone links with nothing in that
  scheme and leaves it; whoever gets there with buckets of at most HOT documents is found through those.
* The others (documents made mostly of wide-spread passages, or of large near-copy groups, and those whose shingles fall
  in H segments or fewer) also take the one-deletion neighbourhoods of their segments. A segment whose neighbourhood
  buckets are no larger than HOT counts twice, as it tolerates one difference.
* Who still lacks segments meets others like it by single shingles, the segments of the finest partition. Of those that
  two of them share, the cheapest come first: a document of x shingles with p cheaper ones before shares x - p at most, so
  it takes the first x // 4 + 1 places, places of shingles that nobody shares included. Members of a group around one
  origin, each with differences of its own, use these up on their own shingles and never meet.
* The members of a bucket are first compared with the one that has the most in common with others. Links make components;
  then all pairs of a bucket that are in different components are compared. A pair is compared only if its sizes and
  places let it link and enough of its segments are equal. No bucket is cut, and no link between components is lost.

Equal texts are one class. Links are decided on the shingles themselves. Texts with fewer than 5 words have the whole
sequence as one shingle; texts without words, and null texts, have an empty set and link with nothing. Several texts of
one id are told apart: each has its own links, and its own component. Rows with a null id are documents like others, but
their id labels no component: one without any other id is null. Extra columns are ignored.
"""

from __future__ import annotations

from collections import OrderedDict
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import sliced, small, small_batches, written
from .components import components

SHINGLE = 5
HOT = 32
SLACK = 1.2
_A, _B, _C = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))
_POWER = np.uint64(0x2545F4914F6CDD1D)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads their bits."""
    x = (x ^ (x >> np.uint64(30))) * _B
    x = (x ^ (x >> np.uint64(27))) * _C
    return x ^ (x >> np.uint64(31))


def _lower() -> np.ndarray:
    t = np.arange(256, dtype=np.uint8)
    t[65:91] += 32
    return t


LOWER = _lower()
IS_SPACE = np.zeros(256, dtype=bool)
IS_SPACE[[32, 9, 10, 11, 12, 13]] = True


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(64-bit hash of each word of all texts, words in each text), A-Z in lower case."""
    flat = np.frombuffer(b" ".join(texts) + b" ", dtype=np.uint8)
    inside = ~IS_SPACE[flat]
    edge = np.flatnonzero(np.diff(np.concatenate([[False], inside])))
    starts, ends = edge[::2], edge[1::2]
    sizes = np.array([len(t) + 1 for t in texts], dtype=np.int64)
    owner = np.searchsorted(np.cumsum(sizes), starts, side="right")
    counts = np.bincount(owner, minlength=len(texts))
    if not len(starts):
        return np.zeros(0, dtype=np.uint64), counts
    length = ends - starts
    place = np.arange(len(flat), dtype=np.int64)[inside] - np.repeat(starts, length)
    powers = np.cumprod(np.concatenate([[np.uint64(1)], np.full(int(length.max()), _POWER, dtype=np.uint64)]))
    value = (LOWER[flat[inside]].astype(np.uint64) + np.uint64(1)) * powers[place]
    sums = np.add.reduceat(value, np.concatenate([[0], np.cumsum(length)[:-1]]))
    return mix(sums + length.astype(np.uint64) * _A), counts


def shingle_sets(texts: list[bytes], width: int = SHINGLE) -> list[np.ndarray]:
    """Sorted distinct 64-bit hashes of the shingles of each text."""
    w, counts = word_hashes(texts)
    out, at = [], 0
    mult = [np.uint64((2 * k + 1) * int(_C) & 0xFFFFFFFFFFFFFFFF) for k in range(width)]
    with np.errstate(over="ignore"):
        rolled = np.zeros(max(len(w) - width + 1, 0), dtype=np.uint64)
        for k in range(width):
            rolled += mix(w[k : k + len(rolled)] + mult[k])
        rolled = mix(rolled)
        for n in counts.tolist():
            if n >= width:
                out.append(np.unique(rolled[at : at + n - width + 1]))
            elif n:
                out.append(mix(np.array([sum((int(x) * (2 * i + 3)) & 0xFFFFFFFFFFFFFFFF for i, x in enumerate(w[at : at + n])) & 0xFFFFFFFFFFFFFFFF], dtype=np.uint64) + np.uint64(n)))
            else:
                out.append(np.zeros(0, dtype=np.uint64))
            at += n
    return out


def band(n: int) -> int:
    """Band of a set size: band b holds sizes from 2**b to 2**(b+1) - 1."""
    return n.bit_length() - 1


def schemes(n: int) -> list[tuple[int, int, int]]:
    """(band, segments, H) of each scheme that a set of n shingles takes part in."""
    out = []
    b = band(n)
    for s in (b, b - 1):
        if s < 0:
            continue
        top = (2 << s) - 1
        if 3 * n > 4 * top:
            continue
        most = (top + 4 * top // 3) // 7
        partner = 4 * n // 3 if n <= top else top
        out.append((s, int(SLACK * (most + 1)) + 2, (n + partner) // 7))
    return out


def segment_keys(x: np.ndarray, s: int, m: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(place of each non-empty segment, its key, its sum, members ordered by segment, first member of each)."""
    with np.errstate(over="ignore"):
        seg = (mix(x + np.uint64(s + 1) * _A) % np.uint64(m)).astype(np.int64)
        order = np.argsort(seg, kind="stable")
        seg = seg[order]
        first = np.flatnonzero(np.concatenate([[True], seg[1:] != seg[:-1]]))
        member = mix(x[order] + _C)
        total = np.add.reduceat(member, first)
        return seg[first], key_of(seg[first], total, s), total, member, first


def key_of(place: np.ndarray, total: np.ndarray, s: int) -> np.ndarray:
    """Bucket key; its five lowest bits name the scheme."""
    with np.errstate(over="ignore"):
        h = mix(total + place.astype(np.uint64) * _A + np.uint64(s) * _B)
    return ((h & ~np.uint64(31)) | np.uint64(s & 31)).view(np.int64)


def _text_batches(batches: Iterator[pa.RecordBatch], size: int = 100) -> Iterator[tuple[list, list[bytes]]]:
    """First column and texts (the second), at most `size` rows and about 1 MB at a time; a longer text comes alone or last."""
    for b in batches:
        for i in range(0, b.num_rows, size):
            part = b.slice(i, size)
            ids, texts = part.column(0).to_pylist(), [t.encode() for t in part.column(1).to_pylist()]
            lo, total = 0, 0
            for k, t in enumerate(texts):
                total += len(t)
                if total > 1 << 20:
                    yield ids[lo : k + 1], texts[lo : k + 1]
                    lo, total = k + 1, 0
            if lo < len(texts):
                yield ids[lo:], texts[lo:]


def _once(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list[bytes]]]:
    """As _text_batches, with each node once in a task."""
    seen: set[int] = set()
    for nodes, texts in _text_batches(batches):
        new = []
        for k, node in enumerate(nodes):
            if node not in seen:
                seen.add(node)
                new.append(k)
        if new:
            yield [nodes[k] for k in new], [texts[k] for k in new]


def _signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (key, node, n): each segment's with n = -1, and a few for the document itself, told apart by n modulo 4.

    0: 4 times the set size. 1: the scheme in the key's low bits has n >> 32 segments that aren't empty, and
    (n & 0xFFFFFFFF) >> 2 of them hold more than one shingle.
    """
    for ids, texts in _once(batches):
        keys, nodes, sizes = [], [], []
        for node, x in zip(ids, shingle_sets(texts), strict=True):
            own, n = [[node]], [[4 * len(x)]]
            for s, m, _ in schemes(len(x)) if len(x) else []:
                _, key, _, _, first = segment_keys(x, s, m)
                wide = int((np.diff(np.append(first, len(x))) > 1).sum())
                own += [[(node & ~31) | (s & 31)], key]
                n += [[len(first) << 32 | wide << 2 | 1], np.full(len(key), -1, dtype=np.int64)]
            keys.append(np.concatenate(own).astype(np.int64))
            sizes.append(np.concatenate(n).astype(np.int64))
            nodes.append(np.full(len(keys[-1]), node, dtype=np.int64))
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in (keys, nodes, sizes)], ["key", "node", "n"])


def _deletions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (key, node, place, size): the keys of a document's segments and of their one-deletion neighbourhoods.

    Columns: node, text, its schemes, the keys of its hot segments, and those of them that it stands for. Hot segments are
    left out; of all documents that share one, one alone emits the keys around it, with size -1, so that they count as hot.
    """
    for b in sliced(batches, 100):
        parts = []
        sets = shingle_sets([t.encode() for t in b.column(1).to_pylist()])
        for i, (node, x) in enumerate(zip(b.column(0).to_pylist(), sets, strict=True)):
            wanted, hot, led = (np.array(b.column(k)[i].as_py() or [], dtype=np.int64) for k in (2, 3, 4))
            for s, m, _ in schemes(len(x)) if len(x) else []:
                if s not in wanted:
                    continue
                place, own, total, member, first = segment_keys(x, s, m)
                size = np.diff(np.append(first, len(x)))
                size = np.where(~np.isin(own, hot), size, np.where(np.isin(own, led), -1, 0))
                of = np.repeat(size, np.diff(np.append(first, len(x))))
                wide = (of > 1) | (of < 0)
                with np.errstate(over="ignore"):
                    less = (np.repeat(total, np.diff(np.append(first, len(x)))) - member)[wide]
                at = np.repeat(place, np.diff(np.append(first, len(x))))[wide]
                some = size != 0
                key = np.concatenate([own[some], key_of(at, less, s)])
                parts.append((key, np.full(len(key), node, dtype=np.int64), np.concatenate([place[some], at]).astype(np.int32), np.concatenate([size[some], of[wide]]).astype(np.int32)))
        if parts:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*parts, strict=True)], ["key", "node", "place", "size"])


def _shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (key, node, x): the shingles of each document, and how many it has."""
    for ids, texts in _once(batches):
        sets = shingle_sets(texts)
        size = np.array([len(x) for x in sets], dtype=np.int64)
        with np.errstate(over="ignore"):
            key = mix(np.concatenate(sets) ^ _POWER).view(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(np.repeat(np.array(ids, dtype=np.int64), size)), pa.array(np.repeat(size, size))], ["key", "node", "x"])


def _buckets(columns: list[str], info: str | None):
    """Rows sorted by key, info and node, with the size c of their bucket, single rows left out.

    Rows whose column info is 0 or more are no members of a bucket and pass as they are. Of a bucket no more than HOT
    members are held at once: c is right up to HOT, and some number above it otherwise. A row of a size below 0 makes its
    bucket hot.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] | None = None
        hot, part, rows = None, [], 0
        for b in chain(batches, [None]):
            if b is not None:
                part.append(b)
                rows += b.num_rows
                if rows < 1 << 17:
                    continue
            cols = [np.concatenate([x.column(c).to_numpy(zero_copy_only=False) for x in part] or [np.zeros(0, dtype=np.int64)]) for c in columns]
            part, rows = [], 0
            if held is not None:
                cols, held = [np.concatenate(c) for c in zip(held, cols, strict=True)], None
            key, node, told = cols[0], cols[1], cols[columns.index(info)] if info else np.full(len(cols[0]), -1)
            if not len(key):
                continue
            new = np.concatenate([[True], (key[1:] != key[:-1]) | (told[1:] != told[:-1])])
            again = np.concatenate([[False], node[1:] == node[:-1]]) & ~new
            first = np.flatnonzero(new)
            group = np.cumsum(new) - 1
            weight = ~again if info else np.where(cols[columns.index("size")] < 0, HOT + 1, ~again)
            size = np.bincount(group, weights=weight).astype(np.int64)
            if hot is not None and key[0] == hot and told[0] < 0:
                size[0] += HOT
            hot, upto = None, len(key)
            if b is not None and told[-1] < 0:
                if size[-1] > HOT:
                    hot = key[-1]
                else:
                    upto = first[-1]
                    held = [c[upto:] for c in cols]
            c = size[group]
            keep = (told >= 0) | (c > 1)
            if info:  # the same row of a copy of the text
                keep &= ~again
            at = np.flatnonzero(keep[:upto])
            if len(at):
                yield pa.RecordBatch.from_arrays([*[pa.array(x[at]) for x in cols], pa.array(c[at])], [*columns, "c"])

    return run


def _sets(text: str) -> frozenset:
    w = text.encode().lower().split()
    return frozenset(zip(*[w[i:] for i in range(SHINGLE)], strict=False)) if len(w) >= SHINGLE else frozenset([tuple(w)] if w else [])


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The pairs whose sets of shingles, compared as words, are similar enough."""
    kept: OrderedDict = OrderedDict()

    def of(node: int, text: str) -> frozenset:
        if node not in kept:
            kept[node] = _sets(text)
            if len(kept) > 32:
                kept.popitem(last=False)
        kept.move_to_end(node)
        return kept[node]

    for b in batches:
        a, c, ta, tb = (b.column(i).to_pylist() for i in range(4))
        good = []
        for i in range(len(a)):
            x, y = of(a[i], ta[i]), _sets(tb[i])
            both = len(x & y)
            good.append(both > 0 and 100 * both >= 75 * (len(x) + len(y) - both))
        at = np.flatnonzero(good)
        yield pa.RecordBatch.from_arrays([pa.array([a[i] for i in at], pa.int64()), pa.array([c[i] for i in at], pa.int64())], ["a", "b"])


def _needed(n: Column, s: Column) -> Column:
    """H of a set of n shingles in scheme s, as schemes() has it."""
    top = F.call_function("shiftleft", F.lit(2).cast("bigint"), s) - 1
    return F.floor((n + F.when(n <= top, F.floor(4 * n / 3)).otherwise(top)) / 7)


def node_of(text: Column) -> Column:
    """Number of a class of equal texts, unless another class has it too; never negative."""
    return F.xxhash64(text).bitwiseAND(F.lit((1 << 63) - 1))


def classes_of(texts: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """All rows (id, h, node, text), and one row (h, node, rep) for each text: its number and smallest id.

    Classes are told by SHA-256. Should several have one number, they get numbers below 0.
    """
    docs = texts.select(F.col(id_col).cast("bigint").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    docs = docs.withColumn("h", F.unhex(F.sha2(F.encode("text", "UTF-8"), 256))).withColumn("node", node_of(F.col("text")))
    classes = written(docs.groupBy("h", "node").agg(F.min("id").alias("rep")), "classes")
    twice = written(classes.join(classes.groupBy("node").count().filter("count > 1").select("node"), "node", "left_semi").select("h"), "twice")
    fits, n = small(twice, 64)
    if n:
        anew = written(twice.withColumn("anew", -1 - F.monotonically_increasing_id()), "anew")
        anew = F.broadcast(anew) if fits else anew
        docs, classes = (d.join(anew, "h", "left").withColumn("node", F.coalesce("anew", "node")).drop("anew") for d in (docs, classes))
    return docs.select("id", "h", "node", "text"), classes.select("h", "node", "rep")


def links(texts: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame, DataFrame]:
    """Classes of equal texts (h, node, rep, n), verified links (a, b) between nodes, and components (node, component).

    The links joined with the classes' copies connect exactly the documents that similar pairs connect.
    """
    docs, classes = classes_of(texts, id_col, text_col)
    signed = docs.select("node", "text").mapInArrow(_signatures, "key long, node long, n long").repartition("key").sortWithinPartitions("key", "n", "node")
    rows = written(signed.mapInArrow(_buckets(["key", "node", "n"], "n"), "key long, node long, n long, c long"), "buckets")
    scheme = F.col("key").bitwiseAND(F.lit(31).cast("bigint")).cast("int").alias("s")
    sizes = rows.filter("n >= 0 AND n % 4 = 0").select("node", (F.col("n") / 4).cast("bigint").alias("n"))
    filled = rows.filter("n >= 0 AND n % 4 = 1").select("node", scheme, F.expr("shiftright(n, 32)").alias("filled"), F.expr("shiftright(n & 4294967295L, 2)").alias("wide"))
    shared = rows.filter("n < 0").select("key", "node", "c", scheme)

    # who needs segments that others share, and who needs more than those of small buckets
    hot = F.sum(F.when(F.col("c") > HOT, 1).otherwise(0))
    state = filled.join(sizes, "node").withColumn("need", _needed(F.col("n"), F.col("s")) + 1)
    state = state.join(shared.groupBy("node", "s").agg(F.count("*").alias("k"), hot.alias("hot")), ["node", "s"], "left").na.fill(0, ["k", "hot"])
    state = written(state.filter("filled - k < need"), "state")
    state = state.withColumn("hard", F.expr("filled - hot < need"))
    active = written(shared.join(state.select("node", "s", "hard", F.col("n").alias("x"), (F.col("need") - F.col("filled") + F.col("k")).alias("take")), ["node", "s"]), "active")
    order = F.row_number().over(Window.partitionBy("node", "s").orderBy("c", "key"))
    cold = active.filter(F.col("c") <= HOT).select("key", "node", "x", F.lit(0).cast("bigint").alias("p"), (order <= F.col("take")).alias("own"))

    # one-deletion neighbourhoods
    hard = state.filter("hard").select("node", "s", "n", "hot", "need", "filled", "wide")
    spread = active.filter(F.col("hard") & (F.col("c") > HOT)).select("key", "node")
    stands = spread.groupBy("key").agg(F.min("node").alias("node")).groupBy("node").agg(F.collect_list("key").alias("led"))
    asked = hard.groupBy("node").agg(F.collect_set("s").alias("schemes")).join(spread.groupBy("node").agg(F.collect_list("key").alias("hot")), "node", "left").join(stands, "node", "left")
    asked = _texts(docs, classes, hard.select("node").distinct()).join(asked, "node").select("node", "text", "schemes", "hot", "led")
    near = asked.mapInArrow(_deletions, "key long, node long, place int, size int").repartition("key").sortWithinPartitions("key", "node")
    near = written(near.mapInArrow(_buckets(["key", "node", "place", "size"], None), "key long, node long, place int, size int, c long").filter("size > 0"), "near")
    near = near.withColumn("s", scheme).join(hard.select("node", "s", F.col("n").alias("x")), ["node", "s"])
    lost = near.filter((F.col("c") > HOT) & (F.col("size") > 1)).groupBy("node", "s").agg(F.count_distinct("place").alias("lost"))
    # each hot segment loses its single count and, if wide, its double one; at worst the two sets of places are apart
    hardest = hard.join(lost, ["node", "s"], "left").filter("filled - hot + wide - hot - coalesce(lost, 0) < need")
    beside = near.filter(F.col("c") <= HOT).select("key", "node", "x", F.lit(0).cast("bigint").alias("p"), F.lit(True).alias("own")).distinct()

    # the finest partition, for the rest
    finest = _cheapest(_texts(docs, classes, hardest.select("node").distinct()).mapInArrow(_shingles, "key long, node long, x long"))
    met = written(cold.unionByName(beside).unionByName(finest), "met")

    # each bucket's most common member with the others, then all pairs of a bucket that links haven't joined
    segments = written(state.join(active.groupBy("node", "s").agg(F.collect_list("key").alias("keys")), ["node", "s"], "left").select("node", "s", "n", "filled", F.coalesce("keys", F.array().cast("array<bigint>")).alias("keys")), "segments")
    leads = met.groupBy("key").agg(F.min_by(F.struct(F.col("node").alias("b"), F.col("x").alias("y"), F.col("p").alias("q")), F.struct(F.col("p") / F.col("x"), "node")).alias("lead"))
    could = 7 * F.least(F.col("x") - F.col("p"), F.col("y") - F.col("q")) >= 3 * (F.col("x") + F.col("y"))
    led = met.join(leads, "key").select("node", "x", "p", "lead.*").filter((F.col("node") != F.col("b")) & could).select(F.least("node", "b").alias("a"), F.greatest("node", "b").alias("b")).distinct()
    led = written(_plausible(led, segments), "led")
    found = written(_checked(led, docs, classes), "links")
    label = met.join(components(found), "node", "left").withColumn("part", F.coalesce("component", "node")).drop("component")
    mixed = label.groupBy("key").agg(F.min("part").alias("lo"), F.max("part").alias("hi")).filter("lo < hi").select("key")
    left = written(label.join(mixed, "key", "left_semi"), "left")
    other = left.select("key", F.col("node").alias("b"), F.col("x").alias("y"), F.col("p").alias("q"), F.col("own").alias("own_b"), F.col("part").alias("part_b"))
    smaller = (F.col("y") < F.col("x")) | ((F.col("y") == F.col("x")) & (F.col("b") < F.col("node")))
    rest = left.join(other, "key").filter(smaller & could & (F.col("part") != F.col("part_b")) & (F.col("own") | F.col("own_b")))
    rest = rest.select(F.least("node", "b").alias("a"), F.greatest("node", "b").alias("b")).distinct()
    rest = _plausible(rest, segments).join(led, ["a", "b"], "left_anti")
    found = written(found.unionByName(_checked(rest, docs, classes)).distinct(), "links")
    return classes.join(sizes, "node", "left"), found, components(found)


def _cheapest(shingles: DataFrame) -> DataFrame:
    """Buckets (key, node, x, p, own) of single shingles: of each document's x, those at the first x // 4 + 1 places.

    Places go by the number of documents that have a shingle; p is a shingle's place. Those that nobody shares come first
    and are counted only.
    """
    often = shingles.groupBy("key").agg(F.count("*").alias("d")).filter("d > 1")
    common = shingles.join(often, "key")
    of = Window.partitionBy("node")
    placed = common.withColumn("p", F.col("x") - F.count("*").over(of) + F.row_number().over(of.orderBy("d", "key")) - 1)
    return placed.filter("4 * p <= x").select("key", "node", "x", F.col("p").cast("bigint").alias("p"), F.lit(True).alias("own"))


def _plausible(pairs: DataFrame, segments: DataFrame) -> DataFrame:
    """The pairs (a, b) that can link by what is known without their texts.

    In the scheme of the smaller one's band, each shingle in which the two differ spoils one segment at most, so of the
    segments that either fills all but floor((x + y) / 7) must be equal. Who isn't active there links with nothing.
    """
    n = segments.select("node", "n").distinct()
    sized = pairs.join(n.select(F.col("node").alias("a"), F.col("n").alias("x")), "a").join(n.select(F.col("node").alias("b"), F.col("n").alias("y")), "b")
    sized = sized.filter(100 * F.least("x", "y") >= 75 * F.greatest("x", "y"))
    sized = sized.withColumn("s", F.floor(F.log2(F.least("x", "y").cast("double") + 0.5)).cast("int").bitwiseAND(F.lit(31)))
    of = lambda c: segments.select(F.col("node").alias(c), "s", F.col("keys").alias(f"{c}_keys"), F.col("filled").alias(f"{c}_filled"))
    both = sized.join(of("a"), ["a", "s"]).join(of("b"), ["b", "s"])
    return both.filter(F.size(F.array_intersect("a_keys", "b_keys")) >= F.greatest("a_filled", "b_filled") - F.floor((F.col("x") + F.col("y")) / 7)).select("a", "b")


def _texts(docs: DataFrame, classes: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node, text) of some nodes, once each; the list of nodes is broadcast only while it is small."""
    nodes = classes.join(nodes, "node").select(F.col("node").alias("of"), "rep")
    fits, _ = small(nodes, 24)
    one = docs.join(F.broadcast(nodes) if fits else nodes, (F.col("node") == F.col("of")) & F.col("id").eqNullSafe(F.col("rep")))
    return one.groupBy("node").agg(F.any_value("text").alias("text"))


def _checked(pairs: DataFrame, docs: DataFrame, classes: DataFrame) -> DataFrame:
    """The pairs (a, b) that link."""
    pairs = written(pairs, "pairs")
    texts = written(_texts(docs, classes, pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()), "texts")
    two = pairs.join(texts.select(F.col("node").alias("b"), F.col("text").alias("tb")), "b").join(texts.select(F.col("node").alias("a"), F.col("text").alias("ta")), "a")
    return two.select("a", "b", "ta", "tb").mapInArrow(_verify, "a long, b long").distinct()


def labelled(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, h (SHA-256 of the text), n_shingles, component_id, and the component's smallest text id."""
    classes, _, parts = links(df, id_col, text_col)
    known = classes.join(parts, "node", "left").withColumn("part", F.coalesce("component", "node"))
    least = known.groupBy("part").agg(F.min("rep").alias("component_id"))
    known = written(known.join(least, "part").select("h", "part", "n", "component_id"), "known")
    text = F.coalesce(F.col(text_col), F.lit(""))
    bare = ~F.rlike(text, F.lit("[^\\x20\\x09-\\x0D]"))
    rows = df.select(F.col(id_col), bare.alias("_bare"), F.unhex(F.sha2(F.encode(text, "UTF-8"), 256)).alias("h"))
    own = F.when(F.col("_bare"), F.col(id_col)).otherwise(F.col("component_id")).cast("bigint")
    return rows.join(known, "h").select(id_col, "h", F.coalesce(F.col("n").cast("bigint"), F.lit(0)).alias("n_shingles"), own.alias("component_id"), F.when(~F.col("_bare"), F.col("part")).alias("part"))


def cluster(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, n_shingles and component_id."""
    return labelled(df, id_col, text_col).select(id_col, "n_shingles", "component_id")


def op5(spark, sf_dir: str) -> DataFrame:
    """All documents with their components at Jaccard 0.75 over 5-word shingles."""
    small_batches(spark)
    return cluster(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))


ORACLE = r"""
WITH RECURSIVE t AS (SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, CASE WHEN len(w) < 5 THEN array_to_string(w, ' ') ELSE array_to_string(w[i : i + 4], ' ') END AS g FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM t WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
l AS (SELECT x, y FROM p JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * c >= 75 * (a.n + b.n - c)),
e AS (SELECT x, y FROM l UNION ALL SELECT y, x FROM l),
r AS (SELECT doc_id, doc_id AS c FROM documents UNION SELECT e.x, r.c FROM r JOIN e ON e.y = r.doc_id)
SELECT d.doc_id, coalesce(any_value(n.n), 0)::BIGINT AS n_shingles, min(r.c)::BIGINT AS component_id FROM documents d JOIN r ON r.doc_id = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id GROUP BY d.doc_id
"""
