"""Hard negatives by a multiway hyperplane tree (GNAT).

Vectors count as integers, floor(256 x), and score by their integer inner product. A vector x is lifted to
(x, sqrt(M - |x|^2)) with M the largest squared norm of all rows, a query q to (q, 0). Their squared distance is then
|q|^2 + M - 2 score, so a window of scores is an annulus around the query, exactly.

* The split points are chosen on a sample of SAMPLE rows, those of the least hashes: a node takes FANOUT far-apart rows
  of its own, and every row belongs to the nearest split point. A node is a leaf when it stands for LEAF_ROWS rows or
  fewer, or when all its sample rows are equal. The sample only places split points. All rows are sent down the tree.
* Each split point keeps the least and largest distance to the rows of every sibling's subtree, over all rows.
* An anchor goes down the tree with its windows. A subtree whose ranges, seen from any split point of the node, can't
  meet the annulus of any window is left out. The window begins at the k-th best fitting sample row, which is a row like
  others, so nothing is lost.
* Leaves are compared exactly. A leaf of many rows (copies, or more rows than the sample can tell apart) is cut into
  pieces by a hash; rows of a piece come first in their task, and anchors stream past them.

Rows with a null label, a null vector, or a null or non-finite component take no part. Shorter vectors count as filled
with zeros. Null ids come last among ties and are never anchors' own. Repeated rows, also those of one id, are separate
rows; an anchor leaves out only itself. An empty table has no results. Extra columns are ignored. A table whose scores
could pass 2^56 is refused with an error.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import table, written

SAMPLE, FANOUT, LEAF_ROWS, POSITIVES, NEGATIVES = 4096, 8, 256, 5, 10
FOUND = "anchor long, w int, id long, score long"
RESULT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
_FAR = 1 << 60


class Tree(NamedTuple):
    """points[node]: its split points as integers; children[node]: nodes, or ~leaf. reach: M, the squared norm of all lifted
    rows. wide: whether products may pass what doubles hold exactly."""

    points: list
    children: list
    leaves: int
    reach: float
    wide: bool


def vectors(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """(row, id, label, q) of the rows that take part, as a written table; row tells them apart."""
    x = F.col(vec_col)
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v.cast("double")) & (F.abs(v.cast("double")) < F.lit(float("inf"))))
    some = df.filter(F.col(label_col).isNotNull() & x.isNotNull()).filter(finite)
    q = F.transform(x, lambda v: F.floor(v.cast("double") * 256).cast("bigint"))
    return written(some.select(F.col(id_col).cast("bigint").alias("id"), F.col(label_col).cast("bigint").alias("label"), q.alias("q")).withColumn("row", F.monotonically_increasing_id()), "vectors")


def matrix(column: pa.Array) -> np.ndarray:
    """The rows of a list column of equal lengths."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), len(flat) // len(column) if len(column) else 0)


def products(a: np.ndarray, b: np.ndarray, wide: bool) -> np.ndarray:
    """Integer inner products of the rows of a with those of b, as long."""
    return a @ b.T if wide else (a.astype(np.float64) @ b.T.astype(np.float64)).astype(np.int64)


def lift(x: np.ndarray, reach: float) -> np.ndarray:
    return np.sqrt(np.maximum(reach - (x.astype(np.float64) ** 2).sum(1), 0))


def apart(x: np.ndarray, y: np.ndarray, tree: Tree, query: bool = False) -> np.ndarray:
    """Distances of lifted rows of x, or of queries, to lifted rows of y."""
    dot = products(x, y, tree.wide).astype(np.float64)
    if query:
        return np.sqrt(np.maximum((x.astype(np.float64) ** 2).sum(1)[:, None] + tree.reach - 2 * dot, 0))
    return np.sqrt(np.maximum(2 * tree.reach - 2 * (dot + np.outer(lift(x, tree.reach), lift(y, tree.reach))), 0))


def grow(sample: np.ndarray, rows: int, reach: float, wide: bool, fanout: int = FANOUT, leaf_rows: int = LEAF_ROWS) -> Tree:
    """A tree over a sample that stands for `rows` rows."""
    rnd = np.random.default_rng(0)
    tree = Tree([], [], 0, reach, wide)
    each, leaves = rows / max(len(sample), 1), 0
    todo = [(np.arange(len(sample)), None, 0)]
    while todo:
        own, parent, place = todo.pop()
        chosen: list[int] = []
        if len(own) * each > leaf_rows and len(own) > 1:
            tried = rnd.choice(own, min(len(own), 3 * fanout), replace=False)
            near = np.full(len(tried), np.inf)
            pick = 0
            while len(chosen) < fanout and near[pick] > 1e-6:
                chosen.append(int(tried[pick]))
                near = np.minimum(near, np.where((sample[tried] == sample[tried[pick]]).all(1), 0, apart(sample[tried], sample[tried[pick]][None], tree)[:, 0]))
                pick = int(near.argmax())
        if len(chosen) < 2:
            name, leaves = ~leaves, leaves + 1
        else:
            name = len(tree.points)
            tree.points.append(sample[chosen])
            tree.children.append([0] * len(chosen))
            to = apart(sample[own], sample[chosen], tree).argmin(1)
            todo += [(own[to == j], name, j) for j in range(len(chosen))]
        if parent is not None:
            tree.children[parent][place] = name
    return tree._replace(leaves=leaves)


def routed(x: np.ndarray, tree: Tree) -> np.ndarray:
    """The leaf of each row."""
    out, todo = np.zeros(len(x), np.int64), [(0, np.arange(len(x)))] if tree.points else []
    while todo:
        node, own = todo.pop()
        to = apart(x[own], tree.points[node], tree).argmin(1)
        for j, child in enumerate(tree.children[node]):
            mine = own[to == j]
            if child < 0:
                out[mine] = ~child
            elif len(mine):
                todo.append((child, mine))
    return out


def paths(tree: Tree) -> list[list[tuple[int, int]]]:
    """For each leaf, the (node, child) steps that lead to it."""
    out, todo = [[] for _ in range(tree.leaves)], [(0, [])] if tree.points else []
    while todo:
        node, above = todo.pop()
        for j, child in enumerate(tree.children[node]):
            step = [*above, (node, j)]
            if child < 0:
                out[~child] = step
            else:
                todo.append((child, step))
    return out


def _leaves(tree: Tree) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            leaf = pa.array(routed(matrix(b.column("q")), tree).astype(np.int32)) if b.num_rows else pa.array([], pa.int32())
            yield pa.RecordBatch.from_arrays([*b.columns, leaf], [*b.schema.names, "leaf"])

    return run


def _ranges(tree: Tree) -> Callable:
    """Partial (node, point, child, low, high) of the distances from each split point to the rows of each child."""
    steps = paths(tree)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}
        for b in batches:
            if not b.num_rows:
                continue
            x, leaf = matrix(b.column("q")), b.column("leaf").to_numpy()
            below: dict[tuple[int, int], list] = {}
            for k in np.unique(leaf):
                for step in steps[k]:
                    below.setdefault(step, []).append(np.flatnonzero(leaf == k))
            for (node, j), own in below.items():
                d = apart(x[np.concatenate(own)], tree.points[node], tree)
                low, high = seen.get((node, j), (np.inf, -np.inf))
                seen[node, j] = np.minimum(low, d.min(0)), np.maximum(high, d.max(0))
        rows = [(node, i, j, low[i], high[i]) for (node, j), (low, high) in seen.items() for i in range(len(low))]
        cols = list(zip(*rows)) or [[]] * 5
        yield pa.RecordBatch.from_arrays([*(pa.array(c, pa.int32()) for c in cols[:3]), *(pa.array(c, pa.float64()) for c in cols[3:])], ["node", "point", "child", "low", "high"])

    return run


def visited(q: np.ndarray, inner: np.ndarray, outer: np.ndarray, tree: Tree, low: list, high: list) -> Iterator[tuple[int, np.ndarray]]:
    """(leaf, queries) whose annuli (inner and outer radii: queries x windows) may hold rows of the leaf."""
    slack = 1e-7 * (np.sqrt(tree.reach) + np.sqrt((q.astype(np.float64) ** 2).sum(1)) + 1)
    if not tree.points:
        yield 0, np.arange(len(q))
    todo = [(0, np.arange(len(q)))] if tree.points else []
    while todo:
        node, own = todo.pop()
        d = apart(q[own], tree.points[node], tree, query=True)
        for j, child in enumerate(tree.children[node]):
            near = np.maximum(d - high[node][:, j], low[node][:, j] - d).max(1) - slack[own]
            far = (d + high[node][:, j]).min(1) + slack[own]
            meets = ((inner[own] <= far[:, None]) & (outer[own] >= near[:, None])).any(1)
            if not meets.any():
                continue
            if child < 0:
                yield ~child, own[meets]
            else:
                todo.append((child, own[meets]))


def flat_windows(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """w, low and high of a list column of windows as (rows x most windows); empty places can hold nothing. And the lengths."""
    size = np.diff(column.offsets.to_numpy())
    flat = column.flatten()
    at = np.repeat(np.arange(len(size)), size), np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)
    out = []
    for name, empty in (("w", 0), ("lo", _FAR), ("hi", -_FAR)):
        a = np.full((len(size), max(1, size.max(initial=1))), empty, np.int64)
        a[at] = flat.field(name).to_numpy(zero_copy_only=False)
        out.append(a)
    return (*out, size)


def _visits(tree: Tree, low: list, high: list, pieces: np.ndarray, sample: tuple, k: int, same: bool, width: int = 256) -> Callable:
    """Queries (row, label, q, windows) once for each piece of each leaf that they have to see, with tightened windows."""
    s_q, s_label, s_row = sample

    def some(b: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        q, row, label = matrix(b.column("q")), b.column("row").to_numpy(), b.column("label").to_numpy()
        w, lo, hi, size = flat_windows(b.column("windows"))
        score = products(q, s_q, tree.wide)
        fits = (label[:, None] == s_label) & (row[:, None] != s_row) if same else label[:, None] != s_label
        for j in range(lo.shape[1]):
            if score.shape[1] >= k:
                ok = np.where(fits & (score >= lo[:, j : j + 1]) & (score <= hi[:, j : j + 1]), score, -_FAR)
                lo[:, j] = np.maximum(lo[:, j], np.partition(ok, -k, axis=1)[:, -k])
        norm = (q.astype(np.float64) ** 2).sum(1)[:, None] + tree.reach
        inner, outer = np.sqrt(np.maximum(norm - 2.0 * hi, 0)), np.where(hi >= lo, np.sqrt(np.maximum(norm - 2.0 * lo, 0)), -np.inf)
        kept = np.arange(lo.shape[1]) < size[:, None]
        spans = pa.StructArray.from_arrays([pa.array(w[kept].astype(np.int32)), pa.array(lo[kept]), pa.array(hi[kept])], ["w", "lo", "hi"])
        windows = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(size)]).astype(np.int32)), spans)
        for leaf, own in visited(q, inner, outer, tree, low, high):
            for g in range((leaf << 32), (leaf << 32) + int(pieces[leaf])):
                ix = pa.array(own)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(own), g)), b.column("row").take(ix), b.column("label").take(ix), b.column("q").take(ix), windows.take(ix)], ["g", "row", "label", "q", "windows"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(0, b.num_rows, width):
                yield from some(b.slice(i, width))

    return run


def best(score: np.ndarray, fits: np.ndarray, lo: np.ndarray, hi: np.ndarray, ids: np.ndarray, unknown: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, window, row) of the k best fitting rows of each window, by score from the highest, then by id."""
    parts = []
    for j in range(lo.shape[1]):
        a, r = np.nonzero(fits & (score >= lo[:, j : j + 1]) & (score <= hi[:, j : j + 1]))
        order = np.lexsort((ids[r], unknown[r], -score[a, r], a))
        a, r = a[order], r[order]
        rank = np.arange(len(a)) - np.searchsorted(a, a)
        parts.append((a[rank < k], np.full((rank < k).sum(), j), r[rank < k]))
    return tuple(np.concatenate(x) for x in zip(*parts))


def _matched(k: int, same: bool, wide: bool, width: int = 256) -> Callable:
    """Pieces, each as its rows and then its queries, to (anchor, w, id, score): the k best of every window in the piece."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held, block = None, [], None
        for b in batches:
            g, query = b.column("g").to_numpy(), b.column("query").to_numpy(zero_copy_only=False)
            cuts = np.flatnonzero((np.diff(g) != 0) | (np.diff(query.astype(np.int8)) != 0)) + 1
            for start, stop in zip([0, *cuts], [*cuts, len(g)]):
                if start == stop:
                    continue
                if g[start] != now:
                    now, held, block = g[start], [], None
                if not query[start]:
                    held.append(b.slice(start, stop - start))
                    continue
                if not held:
                    continue
                if block is None:
                    t = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                    ids = t.column("id")
                    block = matrix(t.column("q")), t.column("label").to_numpy(), t.column("row").to_numpy(), ids.fill_null(0).to_numpy(), ids.is_null().to_numpy(zero_copy_only=False)
                x, x_label, x_row, x_id, unknown = block
                for i in range(start, stop, width):
                    some = b.slice(i, min(width, stop - i))
                    row, label = some.column("row").to_numpy(), some.column("label").to_numpy()
                    w, lo, hi, _ = flat_windows(some.column("windows"))
                    score = products(matrix(some.column("q")), x, wide)
                    fits = (label[:, None] == x_label) & (row[:, None] != x_row) if same else label[:, None] != x_label
                    a, j, r = best(score, fits, lo, hi, x_id, unknown, k)
                    yield pa.RecordBatch.from_arrays([pa.array(row[a]), pa.array(w[a, j].astype(np.int32)), pa.array(x_id[r], mask=unknown[r]), pa.array(score[a, r])], ["anchor", "w", "id", "score"])

    return run


class Index(NamedTuple):
    rows: DataFrame
    tree: Tree
    low: list
    high: list
    pieces: np.ndarray
    sample: tuple


def index(rows: DataFrame, sample_rows: int = SAMPLE, fanout: int = FANOUT, leaf_rows: int = LEAF_ROWS) -> Index | None:
    """All of vectors() in the leaves of a tree, with the ranges of its split points; None without rows.

    What comes to the driver is bounded by sample_rows: the sample, the ranges and the sizes of the leaves.
    """
    spark = rows.sparkSession
    square = F.aggregate("q", F.lit(0.0), lambda a, x: a + x.cast("double") * x)
    n, dim, reach, most = rows.agg(F.count("*"), F.max(F.size("q")), F.max(square), F.max(F.array_max(F.transform("q", lambda x: F.abs(x.cast("double")))))).first()
    if not n:
        return None
    bound = dim * (most or 0) ** 2
    if bound >= 2**56:
        raise ValueError(f"components of {most:.3g} let scores of {dim} of them pass 2^56")
    even = rows.withColumn("q", F.concat("q", F.array_repeat(F.lit(0).cast("bigint"), F.lit(dim) - F.size("q"))))
    some = even.orderBy(F.xxhash64("q", "id"), "row").limit(sample_rows).select("row", "label", "q").toArrow().combine_chunks()
    q = matrix(some.column("q").combine_chunks() if some.num_rows else some.column("q"))
    tree = grow(q, n, reach, bound >= 2**53, fanout, leaf_rows)
    placed = written(even.mapInArrow(_leaves(tree), "id long, label long, q array<long>, row long, leaf int"), "leaves")
    low = [np.full((len(p), len(p)), np.inf) for p in tree.points]
    high = [np.full((len(p), len(p)), -np.inf) for p in tree.points]
    for r in placed.select("q", "leaf").mapInArrow(_ranges(tree), "node int, point int, child int, low double, high double").groupBy("node", "point", "child").agg(F.min("low").alias("low"), F.max("high").alias("high")).collect():
        low[r["node"]][r["point"], r["child"]], high[r["node"]][r["point"], r["child"]] = r["low"], r["high"]
    sizes = placed.groupBy("leaf").count().collect()
    pieces = np.ones(tree.leaves, np.int64)
    for r in sizes:
        pieces[r["leaf"]] = -(-r["count"] // (2 * leaf_rows))
    cut = spark.createDataFrame([(i, int(p)) for i, p in enumerate(pieces)], "leaf int, pieces int")  # at most sample_rows leaves
    g = F.call_function("shiftleft", F.col("leaf").cast("bigint"), F.lit(32)) + F.pmod(F.xxhash64("row"), F.col("pieces"))
    sample = q, some.column("label").to_numpy(), some.column("row").to_numpy()
    return Index(placed.join(F.broadcast(cut), "leaf").withColumn("g", g), tree, low, high, pieces, sample)


def search(ix: Index, queries: DataFrame, k: int, same: bool) -> DataFrame:
    """(anchor, w, id, score, rank): the k best rows in each window of each query (row, label, q, windows), of the query's
    label without the query itself, or of other labels."""
    seen = queries.select("row", "label", "q", "windows").mapInArrow(_visits(ix.tree, ix.low, ix.high, ix.pieces, ix.sample, k, same), "g long, row long, label long, q array<long>, windows array<struct<w:int,lo:long,hi:long>>")
    mine = ix.rows.select("g", F.lit(False).alias("query"), "row", "id", "label", "q", F.lit(None).cast("array<struct<w:int,lo:long,hi:long>>").alias("windows"))
    both = mine.unionByName(seen.select("g", F.lit(True).alias("query"), "row", F.lit(None).cast("bigint").alias("id"), "label", "q", "windows"))
    found = both.repartition("g").sortWithinPartitions("g", "query").mapInArrow(_matched(k, same, ix.tree.wide), FOUND)
    order = Window.partitionBy("anchor", "w").orderBy(F.desc("score"), F.col("id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def mine(df: DataFrame, is_anchor: Column, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label", positives: int = POSITIVES, negatives: int = NEGATIVES, least: int = 30, most: int = 90, **tree) -> DataFrame:
    """RESULT: for each anchor and each of its `positives` best rows of the same label, the best `negatives` rows of other
    labels that score at least `least` and at most `most` percent of the positive. is_anchor reads `id` and `label`."""
    ix = index(vectors(df, id_col, vec_col, label_col), **tree)
    if ix is None:
        return df.sparkSession.createDataFrame([], RESULT)
    anchors = ix.rows.filter(is_anchor).select("row", F.col("id").alias("anchor_id"), "label", "q")
    whole = F.array(F.struct(F.lit(0).alias("w"), F.lit(-_FAR).alias("lo"), F.lit(_FAR).alias("hi")))
    good = written(search(ix, anchors.withColumn("windows", whole), positives, True).select(F.col("anchor").alias("row"), F.col("rank").alias("w"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score")), "positives")
    part = lambda p, up: F.expr(f"({p} * positive_score {'+' if up else '-'} pmod({'-' if up else ''}{p} * positive_score, 100)) div 100")
    window = F.struct("w", part(least, True).alias("lo"), part(most, False).alias("hi"))
    windows = good.select("row", window.alias("x")).filter("x.lo <= x.hi").groupBy("row").agg(F.collect_list("x").alias("windows"))  # as many as positives
    bad = search(ix, anchors.join(windows, "row"), negatives, False).select(F.col("anchor").alias("row"), "w", "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
    return bad.join(good, ["row", "w"]).join(anchors.select("row", "anchor_id"), "row").select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def op11(spark, sf_dir: str) -> DataFrame:
    """Hard negatives of the embeddings whose id is divisible by 100; labels of ids divisible by 7 are moved on by one."""
    df = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine(df.withColumn("label", moved), F.col("id") % 100 == 0)


ORACLE = """WITH v AS (SELECT row_number() OVER () AS row, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.row AS arow, a.vec_id AS anchor_id, b.row, b.vec_id, a.label = b.label AS same, list_dot_product(a.q, b.q)::BIGINT AS score FROM v a JOIN v b ON a.row <> b.row WHERE a.vec_id % 100 = 0),
p AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY arow ORDER BY score DESC, vec_id) AS k FROM s WHERE same) q WHERE k <= 5)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM (SELECT p.anchor_id, p.vec_id AS positive_id, s.vec_id AS negative_id, p.score AS positive_score, s.score AS negative_score,
  row_number() OVER (PARTITION BY p.arow, p.k ORDER BY s.score DESC, s.vec_id)::INT AS rank FROM p JOIN s ON s.arow = p.arow AND NOT s.same AND 30 * p.score <= 100 * s.score AND 100 * s.score <= 90 * p.score) q WHERE rank <= 10"""
