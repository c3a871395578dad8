"""Mixing sources to target weights: blocks of words, multinomial counts per shard, pseudorandom index permutations.

* Sources in the order of their code points, null last, weigh WEIGHTS in turn. Their targets are shares of all words; a
  target stops at MOST_REPEATS times its source's words, and the excess is shared again by weight until none is above.
* The words of a source are one stream, cut into blocks of BLOCK words. Documents lie in it in an order by hash.
* The mix is a number of shards of about SHARD slots, and a slot holds a block. Of each shard, a source has the whole part
  of its expected number of slots; the slots that are left are drawn from a multinomial over the fractions.
* The slots of a source are numbered over all shards. Slot j reads block p(j mod n) of the source's n blocks, p being the
  pseudorandom permutation of round j div n: all blocks are read once before one is read again. Slots beyond MOST_REPEATS
  rounds, a few that the draw may give to a source at its limit, stay empty.
* Slots and blocks meet by index. No word is read more than MOST_REPEATS times, so no document passes that many times its
  size.

Every count is an integer and every draw a hash, so reruns agree, however the input is split. Null texts have no words;
null ids and null sources are values like others. Repeated rows are separate rows, each with its own place. An empty table
has an empty mix. Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import small, table, words, written

WEIGHTS, MOST_REPEATS, BLOCK, SHARD, ROUNDS, SEED = (1, 2, 3), 3, 64, 4096, 16, 12
#: Rows whose place in the stream of a source one task settles, slots that one task makes, and the unit of a slot in integer
#: shares.
BUCKET, TASK, UNIT = 1024, 1 << 16, 1 << 20
_KEY = ["source", "id", "size", "crc"]


def sized(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """(source, id, size, crc, n): the distinct rows, their words, and how often they occur."""
    data = F.coalesce(F.col(text_col), F.lit(""))
    size = F.regexp_count(data, F.lit("[^\\x20\\x09-\\x0D]+")).cast("bigint")
    return df.select(F.col(source_col).alias("source"), F.col(id_col).alias("id"), size.alias("size"), F.crc32(F.encode(data, "UTF-8")).alias("crc")).groupBy(*_KEY).agg(F.count("*").alias("n"))


def running(df: DataFrame, order: list[Column], value: Column, name: str) -> DataFrame:
    """df with the sum of value over the rows before each. Ranges of the order are summed by one task each; what comes to the
    driver is a sum for each range."""
    dealt = written(df.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()).withColumn("_v", value), "ranges")
    total, starts = 0, []
    for r in dealt.groupBy("_range").agg(F.sum("_v").alias("v")).orderBy("_range").collect():
        starts.append((r["_range"], total))
        total += r["v"]
    inside = Window.partitionBy("_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    before = df.sparkSession.createDataFrame(starts, "_range int, _start long")
    out = dealt.withColumn(name, F.coalesce(F.sum("_v").over(inside), F.lit(0))).join(F.broadcast(before), "_range")
    return out.withColumn(name, (F.col(name) + F.col("_start")).cast("bigint")).drop("_range", "_start", "_v")


def sources(records: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_REPEATS, block: int = BLOCK) -> DataFrame:
    """(source, k, words, rows, weight, blocks, target, share): one row a source as a written table; k is its place in order and
    share its expected slots in UNITs. Each round of sharing is a sum over the sources."""
    own = records.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("words"), F.sum("n").alias("rows"))
    ranked = running(own, [F.col("source").isNull(), F.col("source")], F.lit(1), "k")
    ranked = written(ranked.withColumn("weight", F.get(F.array(*[F.lit(w) for w in weights]), (F.col("k") % len(weights)).cast("int")).cast("bigint")), "sources")
    wide = lambda c: c.cast("decimal(38,0)")
    above = F.lit(False)
    held = given = free = None
    while True:
        total, full, open_ = ranked.agg(F.coalesce(F.sum("words"), F.lit(0)), F.coalesce(F.sum(F.when(above, F.col("words") * most)), F.lit(0)), F.coalesce(F.sum(F.when(~above, F.col("weight"))), F.lit(0))).first()
        if (full, open_) == (held, free):
            break
        held, given, free = full, total - full, open_
        above = wide(F.col("weight")) * F.lit(given).cast("decimal(19,0)") > wide(F.col("words")) * F.lit(most * free).cast("decimal(19,0)")
    target = F.when(above, F.col("words") * F.lit(float(most))).otherwise(F.col("weight") * F.lit(float(given)) / F.lit(float(max(free, 1))))
    blocks = F.ceil(F.col("words") / block).cast("bigint")
    share = F.when(F.col("words") > 0, F.floor(F.col("target") / F.col("words") * F.col("blocks") * UNIT + 0.5)).otherwise(0).cast("bigint")
    return written(ranked.withColumn("target", target).withColumn("blocks", blocks).withColumn("share", share), "targets")


def drawn(src: DataFrame, shard: int = SHARD, seed: int = SEED) -> DataFrame:
    """(shard, k, n): the slots of each source in each shard."""
    spark = src.sparkSession
    total = src.agg(F.coalesce(F.sum("share"), F.lit(0))).first()[0]
    shards = max(1, -(-total // (shard * UNIT)))
    unit = shards * UNIT
    parts = src.select("k", F.expr(f"share div {unit}").alias("whole"), (F.col("share") % unit).alias("rest"))
    parts = written(running(parts, [F.col("k")], F.col("rest"), "at"), "parts")
    left = parts.agg(F.coalesce(F.sum("rest"), F.lit(0))).first()[0]
    until = lambda s: F.expr(f"cast({s} as decimal(19,0)) * {left}bd div {unit}bd")
    every = F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(shards - 1).cast("bigint"))).alias("shard")
    each = spark.range(shards).withColumnRenamed("id", "shard")
    free = each.withColumn("n", until("shard + 1") - until("shard")).filter("n > 0").select("shard", F.explode(F.sequence(F.lit(1), F.col("n"))).alias("u"))
    draws = free.select("shard", F.pmod(F.xxhash64(F.lit(seed), "shard", "u"), F.lit(left if left else 1)).alias("at"), F.lit(1).alias("draw"), F.lit(None).cast("bigint").alias("k"))
    bounds = parts.filter("rest > 0").select(every, "at", F.lit(0).alias("draw"), "k")
    owner = F.last("k", ignorenulls=True).over(Window.partitionBy("shard").orderBy("at", "draw").rowsBetween(Window.unboundedPreceding, 0))
    taken = draws.unionByName(bounds).withColumn("k", owner).filter("draw = 1").select("shard", "k", F.lit(1).cast("bigint").alias("n"))
    whole = parts.filter("whole > 0").select(every, "k", F.col("whole").alias("n"))
    return taken.unionByName(whole).groupBy("shard", "k").agg(F.sum("n").alias("n"))


def permuted(x: Column, n: Column, *key: Column, rounds: int = ROUNDS) -> Column:
    """x under a keyed permutation of 0 to n - 1: swap-or-not, which fits any n."""

    def step(at: Column, r: Column) -> Column:
        other = F.pmod(F.pmod(F.xxhash64(*key, r), n) - at, n)
        swap = F.xxhash64(*key, r, F.greatest(at, other)).bitwiseAND(F.lit(1)) == 1
        return F.when(swap, other).otherwise(at)

    return F.aggregate(F.sequence(F.lit(1), F.lit(rounds)), x, step)


def slots(src: DataFrame, counts: DataFrame, most: int = MOST_REPEATS, seed: int = SEED) -> DataFrame:
    """(shard, slot, k, block): the block that each slot reads. The slots of a shard are numbered in a permuted order."""
    before = Window.partitionBy("k").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    inside = Window.partitionBy("shard").orderBy("k").rowsBetween(Window.unboundedPreceding, -1)
    sum_ = lambda w: F.coalesce(F.sum("n").over(w), F.lit(0))
    known, _ = small(src, 64)
    held = src.select("k", "blocks").filter("blocks > 0")
    runs = counts.withColumn("first", sum_(before)).withColumn("place", sum_(inside)).withColumn("all", F.sum("n").over(Window.partitionBy("shard"))).join(F.broadcast(held) if known else held, "k")
    runs = runs.withColumn("stop", F.least(F.col("first") + F.col("n"), F.col("blocks") * most)).filter("stop > first")
    tasks = -(-src.agg(F.coalesce(F.sum("share"), F.lit(0))).first()[0] // (TASK * UNIT)) or 1
    one = runs.repartition(tasks, "shard", "k").select("*", F.explode(F.sequence("first", F.col("stop") - 1)).alias("j"))
    block = permuted(F.col("j") % F.col("blocks"), F.col("blocks"), F.lit(seed), F.col("k"), F.expr("j div blocks"))
    slot = permuted(F.col("place") + F.col("j") - F.col("first"), F.col("all"), F.lit(seed + 1), F.col("shard"))
    return one.select("shard", slot.alias("slot"), "k", block.alias("block"))


def placed(records: DataFrame, src: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """(source, k, id, size, crc, start): one row for each row of the input; start is its first word in its source's stream.

    Rows of a source are dealt to buckets by hash and summed there; copies of one row are dealt to many.
    """
    known, _ = small(src, 256)
    key = src.select(F.col("source").alias("_s"), "k", F.ceil(F.col("rows") / bucket).cast("bigint").alias("buckets"))
    mine = records.join(F.broadcast(key) if known else key, F.col("source").eqNullSafe(F.col("_s"))).drop("_s")
    mine = mine.withColumn("h", F.xxhash64("id", "crc", "size")).withColumn("pieces", F.least("n", "buckets"))
    dealt = mine.withColumn("r", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("pieces") - 1)))
    dealt = dealt.withColumn("copies", F.expr("n div pieces + if(r < n % pieces, 1, 0)")).withColumn("bucket", F.pmod(F.col("h") + F.col("r"), F.col("buckets")))
    order = ["h", "id", "crc", "size"]
    local = Window.partitionBy("k", "bucket").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    dealt = dealt.withColumn("local", F.coalesce(F.sum(F.col("size") * F.col("copies")).over(local), F.lit(0)))
    before = Window.partitionBy("k").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = dealt.groupBy("k", "bucket").agg(F.sum(F.col("size") * F.col("copies")).alias("v"))
    starts = sums.select("k", "bucket", F.coalesce(F.sum("v").over(before), F.lit(0)).alias("base"))
    one = dealt.join(starts, ["k", "bucket"]).withColumn("c", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("copies") - 1)))
    return one.select("source", "k", "id", "size", "crc", (F.col("base") + F.col("local") + F.col("c") * F.col("size")).alias("start"))


def pieces(docs: DataFrame, block: int = BLOCK) -> DataFrame:
    """docs with words once for each block they lie in: `block`, `first` word of the document in it, and how many, `part`."""
    end = F.col("start") + F.col("size")
    cut = docs.filter("size > 0").withColumn("block", F.explode(F.sequence(F.expr(f"start div {block}"), F.expr(f"(start + size - 1) div {block}"))))
    low = F.greatest("start", F.col("block") * block)
    return cut.withColumn("part", F.least(end, (F.col("block") + 1) * block) - low).withColumn("first", low - F.col("start"))


def mix(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: tuple[int, ...] = WEIGHTS, most: int = MOST_REPEATS, block: int = BLOCK, shard: int = SHARD, seed: int = SEED) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(sources, documents, slots): sources(), placed() and slots() of a table, each as a written table."""
    records = written(sized(df, id_col, text_col, source_col), "records")
    src = sources(records, weights, most, block)
    docs = written(placed(records, src), "places")
    return src, docs, written(slots(src, drawn(src, shard, seed), most, seed), "slots")


def taken(docs: DataFrame, chosen: DataFrame, block: int = BLOCK) -> DataFrame:
    """docs with `taken`, the words that the mix takes of each row."""
    times = chosen.groupBy("k", "block").agg(F.count("*").alias("times"))
    met = pieces(docs, block).join(times, ["k", "block"], "left")
    rows = met.groupBy("k", "start", "source", "id", "size").agg(F.sum(F.col("part") * F.coalesce("times", F.lit(0))).alias("taken"))
    return rows.unionByName(docs.filter("size = 0").select("k", "start", "source", "id", "size", F.lit(0).cast("bigint").alias("taken")))


def mixed_texts(df: DataFrame, docs: DataFrame, chosen: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", block: int = BLOCK) -> DataFrame:
    """(shard, slot, text): the mix itself, a block of words for each slot."""
    data = F.coalesce(F.col(text_col), F.lit(""))
    texts = df.select(F.col(source_col).alias("_s"), F.col(id_col).alias("_i"), F.crc32(F.encode(data, "UTF-8")).alias("_c"), words(data).alias("w")).dropDuplicates(["_s", "_i", "_c"])
    same = F.col("source").eqNullSafe(F.col("_s")) & F.col("id").eqNullSafe(F.col("_i")) & (F.col("crc") == F.col("_c"))
    said = pieces(docs, block).join(texts, same).select("k", "block", "start", F.array_join(F.slice("w", (F.col("first") + 1).cast("int"), F.col("part").cast("int")), " ").alias("t"))
    whole = said.groupBy("k", "block").agg(F.array_sort(F.collect_list(F.struct("start", "t"))).alias("p"))  # a block has as many parts as words at most
    return chosen.join(whole, ["k", "block"]).select("shard", "slot", F.array_join(F.transform("p", lambda x: x["t"]), " ").alias("text"))


def op12(spark, sf_dir: str) -> DataFrame:
    """What the mix of all documents takes of each."""
    src, docs, chosen = mix(table(spark, sf_dir, "documents").select("doc_id", "source", "text"))
    known, _ = small(src, 64)
    own = src.select("k", F.col("words").alias("source_size"), "target")
    return taken(docs, chosen).join(F.broadcast(own) if known else own, "k").select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken", "source")
