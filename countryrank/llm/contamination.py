"""Benchmark decontamination by size-partitioned MinHash containment.

A document holds an item when at least THRESHOLD of the item's distinct 5-word shingles occur in it. Items are
partitioned by size; an item of q shingles is indexed by its bottom-k MinHash sketch with k = q - ceil(0.75 q) + 1, the
smallest k for which any document with enough of its shingles must hold one of the k. So the search misses nothing, and
short items are found inside documents of any length. A pair is tested only if the document has enough shingles for the
item, and every pair found is verified on the shingles themselves.

Texts with fewer than 5 words have one shingle, the whole sequence; null and blank texts have none and match nothing.
Items with equal texts are searched once and reported each. Documents are told by their id: rows of one id that hold an
item equally well are reported once, as are rows with a null id. Extra columns are ignored, whatever their names.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fold, fresh, let, small, table, words, written

SHINGLE = 5
THRESHOLD = 75  # hundredths
#: Bits of a Bloom filter over the index: BITS_EACH for each entry, between these powers of two. An index that would leave
#: less than BITS_FEW for each entry is split by hash, each part with its own filter and scan, so filters never fill up.
BITS_EACH, BITS_FEW, BITS_LEAST, BITS_MOST = 128, 16, 1 << 12, 1 << 24


def _hashes(text: Column) -> Column:
    """Hashes of all shingles of a text, repeats included. Folding all letters only adds candidates."""

    def run(w: Column) -> Column:
        n = F.size(w)
        many = F.transform(F.sequence(F.lit(0), n - SHINGLE), lambda i: F.xxhash64(*[w[i + j] for j in range(SHINGLE)]))
        return F.when(n >= SHINGLE, many).when(n > 0, F.array(F.xxhash64(F.array_join(w, " ")))).otherwise(F.array().cast("array<bigint>"))

    return let(words(F.lower(text)), run)


def shingles(text: Column) -> Column:
    """The distinct shingles of a text, with A-Z in lower case."""

    def run(w: Column) -> Column:
        n = F.size(w)
        many = F.transform(F.sequence(F.lit(0), n - SHINGLE), lambda i: F.concat_ws(" ", *[w[i + j] for j in range(SHINGLE)]))
        return F.array_distinct(F.when(n >= SHINGLE, many).when(n > 0, F.array(F.array_join(w, " "))).otherwise(F.array().cast("array<string>")))

    return let(words(fold(text)), run)


def index_items(items: DataFrame, item_col: str = "item_id", text_col: str = "text", threshold: int = THRESHOLD) -> DataFrame:
    """One row per (distinct item, sketch hash): item, its size q, the least number of shingles needed, the hash."""
    one = items.groupBy(fold(F.col(text_col)).alias("t")).agg(F.min(item_col).alias("item"))
    sets = one.select("item", F.size(shingles(F.col("t"))).alias("q"), F.array_sort(F.array_distinct(_hashes(F.col("t")))).alias("h")).filter("q > 0")
    need = F.ceil(F.col("q") * threshold / F.lit(100)).cast("int")
    sized = sets.withColumn("need", need).withColumn("size_class", F.floor(F.log2(F.col("q").cast("double"))).cast("int"))
    return sized.select("item", "q", "need", "size_class", F.explode(F.slice("h", F.lit(1), F.col("q") - F.col("need") + 1)).alias("hash"))


def _bits(entries: int) -> int:
    """Size of a filter over so many entries, a power of two."""
    bits = BITS_LEAST
    while bits < min(BITS_MOST, entries * BITS_EACH):
        bits *= 2
    return bits


def _bloom(index: DataFrame, bits: int) -> Column:
    """A bit array over the hashes of the index as a constant list of longs; `bits` alone sets its size."""
    at = index.select(F.explode(F.array(*[F.pmod(x, F.lit(bits)).cast("int") for x in _probes(F.col("hash"))])).alias("b"))
    set_words = at.groupBy((F.col("b") / 64).cast("int").alias("id")).agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("b") % 64)).alias("w"))
    dense = [0] * (bits // 64)
    for i, w in set_words.collect():  # no more rows than bits / 64
        dense[i] = w
    return F.split(F.lit(",".join(map(str, dense))), ",").cast("array<bigint>")


def _probes(h: Column) -> list[Column]:
    """Three runs of bits of a hash, each of 26 bits or more: the largest filter needs 24."""
    return [h, F.call_function("shiftright", h, F.lit(19)), F.call_function("shiftright", h, F.lit(38))]


def within(h: Column, bloom: Column, bits: int) -> Column:
    """Whether the filter may hold the hash h."""
    found = F.lit(True)
    for x in _probes(h):
        b = F.pmod(x, F.lit(bits)).cast("int")
        found = found & (F.call_function("shiftright", F.get(bloom, (b / 64).cast("int")), b % 64).bitwiseAND(F.lit(1).cast("bigint")) == 1)
    return found


def _sieve(bloom: Column, bits: int):
    """Of the hashes of a text: how many there are, and the distinct ones that the filter lets through."""

    def sift(hashes: Column) -> Column:
        return F.struct(F.size(hashes).alias("n"), F.array_distinct(F.filter(hashes, lambda h: within(h, bloom, bits))).alias("h"))

    return sift


def search(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", threshold: int = THRESHOLD) -> DataFrame:
    """(document, item, shared, q) for every item of which a document holds at least the threshold.

    Documents are scanned once for each filter, which is once unless the index passes BITS_MOST / BITS_FEW entries: a lambda
    hashes the shingles and keeps those in the filter. The few documents with a hit are written down, joined with the index
    on the hash, pruned by size and verified.
    """
    index = written(index_items(items, item_col, text_col, threshold), "index")
    entries = index.count()
    parts = max(1, math.ceil(entries * BITS_FEW / BITS_MOST))
    bits, hits = _bits(math.ceil(entries / parts)), None
    for k in range(parts):
        bloom = _bloom(index if parts == 1 else index.filter(F.pmod("hash", F.lit(parts)) == k), bits)
        kept = _sieve(bloom, bits)
        some = docs.select(F.col(id_col).alias("_d"), F.col(text_col).alias("_t"), let(_hashes(F.col(text_col)), kept).alias("_s"))
        some = some.select("_d", "_t", "_s.n", "_s.h").filter(F.size("h") > 0)
        hits = some if hits is None else hits.unionAll(some)
    hits = written(hits.withColumn("_row", F.monotonically_increasing_id()), "hits")
    pairs = hits.select("_row", "n", F.explode("h").alias("hash")).join(index, "hash").filter("n >= need").select("_row", "item", "need").distinct()
    texts = items.groupBy(fold(F.col(text_col)).alias("t")).agg(F.min(item_col).alias("item"), F.collect_list(item_col).alias("ids"))
    sets = texts.select("item", "ids", shingles(F.col("t")).alias("of_item"))
    per_doc = pairs.join(sets, "item").groupBy("_row").agg(F.collect_list(F.struct("ids", "of_item", "need")).alias("c"))
    held = per_doc.join(hits.select("_row", "_d", "_t"), "_row").select("_d", F.explode(let(shingles(F.col("_t")), lambda s: F.transform("c", lambda c: F.struct(c["ids"].alias("ids"), c["need"].alias("need"), F.size(c["of_item"]).alias("q"), F.size(F.array_intersect(c["of_item"], s)).alias("shared"))))).alias("c"))
    kept = held.filter("c.shared >= c.need").select(F.col("_d").alias(id_col), F.explode("c.ids").alias(item_col), F.col("c.shared").cast("bigint").alias("shared"), F.col("c.q").cast("bigint").alias("q"))
    return kept.dropDuplicates([id_col, item_col, "shared", "q"])


def clean(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs without the documents that hold an item, told by id and a hash of the text."""
    both = F.struct(F.col(id_col).alias("id"), F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("cls"))
    bad = search(docs.select(both.alias("_who"), F.col(text_col)), items, "_who", text_col).select("_who.id", "_who.cls").distinct()
    bad = written(bad, "bad")
    fits, _ = small(bad, 32)
    of, cls = fresh(docs.columns, "_id", "_cls")
    bad = bad.select(F.col("id").alias(of), F.col("cls").alias(cls))
    same = F.col(id_col).eqNullSafe(F.col(of)) & (F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))) == F.col(cls))
    return docs.join(F.broadcast(bad) if fits else bad, same, "left_anti")


def op6(spark, sf_dir: str) -> DataFrame:
    """All (document, benchmark item) pairs at containment 0.75 or more."""
    found = search(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark").select("item_id", "text"))
    return found.select("doc_id", "item_id", "shared", "q")


ORACLE = r"""
WITH t AS (SELECT 0 AS kind, doc_id AS id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
  UNION ALL SELECT 1, item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') FROM benchmark),
s AS (SELECT DISTINCT kind, id, CASE WHEN len(w) < 5 THEN array_to_string(w, ' ') ELSE array_to_string(w[i : i + 4], ' ') END AS g
  FROM (SELECT kind, id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM t WHERE len(w) > 0)),
q AS (SELECT id, count(*) AS q FROM s WHERE kind = 1 GROUP BY id)
SELECT a.id AS doc_id, b.id AS item_id, count(*)::BIGINT AS shared, any_value(q.q)::BIGINT AS q
FROM s a JOIN s b ON a.g = b.g AND a.kind = 0 AND b.kind = 1 JOIN q ON q.id = b.id GROUP BY a.id, b.id HAVING 100 * count(*) >= 75 * any_value(q.q)
"""
