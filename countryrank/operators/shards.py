"""Planning bounded shards from counts: star ranges, facets and batches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.scratch import settled

CAP = 1000
#: Lower bounds of the follower and repository buckets; each ends before the next.
FOLLOWERS = [0, 1, 5, 10, 25, 50, 100, 250, 500, 1000, 2500, 5000, 10000, 25000, 50000]
REPOSITORIES = [1, 5, 10, 25, 50, 100, 250, 500]
#: Facets from the coarsest to the finest.
LEVELS = ["type", "followers", "repos", "year", "month", "day"]
#: Fixed value: the first year that searches ask for.
FIRST_YEAR = 2008
UNCOVERED = "uncovered"


def capped_buckets(df: DataFrame, *cols: str, cap: int = CAP) -> DataFrame:
    """Buckets with more than `cap` rows."""
    return df.groupBy(*cols).agg(F.count("*").alias("n")).filter(F.col("n") > cap)


def star_histogram(df: DataFrame, stars_col: str = "stars") -> DataFrame:
    """Rows per star value: one shuffle, and as many rows as there are values."""
    return df.filter(F.col(stars_col).isNotNull()).groupBy(F.col(stars_col).alias("stars")).agg(F.count("*").alias("n"))


def split_star_ranges(histogram: DataFrame, low: int, high: int, cap: int = CAP) -> DataFrame:
    """(min_stars, max_stars, n): [low, high] halved, the upper half above floor((min + max) / 2), until a range has at
    most `cap` rows or one value.

    The ranges around a star value, one for each level, follow from low and high alone. So the histogram is summed once
    over all levels; ranges over the cap give their halves, and those halves that fit are the result.
    """
    levels = max(1, (high - low + 1).bit_length() + 1)
    mid = lambda r: F.floor((r["lo"] + r["hi"]) / 2).cast("bigint")
    lower, upper = lambda r: F.struct(r["lo"].alias("lo"), mid(r).alias("hi")), lambda r: F.struct((mid(r) + 1).alias("lo"), r["hi"].alias("hi"))
    whole = F.struct(F.lit(low).cast("bigint").alias("lo"), F.lit(high).cast("bigint").alias("hi"))

    def step(path: Column, _: Column) -> Column:
        last = F.element_at(path, -1)
        return F.when(last["lo"] >= last["hi"], path).otherwise(F.concat(path, F.array(F.when(F.col("stars") > mid(last), upper(last)).otherwise(lower(last)))))

    paths = F.aggregate(F.sequence(F.lit(1), F.lit(levels)), F.array(whole), step)
    known = histogram.filter(F.col("stars").between(low, high)).select("n", F.explode(paths).alias("r"))
    sums = known.groupBy("r.lo", "r.hi").agg(F.sum("n").alias("n"))
    open_ = sums.filter((F.col("n") > cap) & (F.col("lo") < F.col("hi"))).select(F.struct("lo", "hi").alias("r"))
    halves = open_.select(F.explode(F.array(upper(F.col("r")), lower(F.col("r")))).alias("h")).select("h.lo", "h.hi")
    made = halves.unionByName(histogram.sparkSession.range(1).select(whole.alias("h")).select("h.lo", "h.hi"))
    sized = made.join(sums, ["lo", "hi"], "left").select(F.col("lo").alias("min_stars"), F.col("hi").alias("max_stars"), F.coalesce("n", F.lit(0)).cast("bigint").alias("n"))
    return sized.filter((F.col("n") <= cap) | (F.col("min_stars") >= F.col("max_stars")))


def dyadic(low: Column, high: Column, levels: int = 63) -> Column:
    """The aligned power-of-two blocks that make up [low, high] of numbers from 0: an array of (level, prefix), two a level at
    most; a number x is in one of them if x >> level is its prefix."""
    block = lambda level, at: F.array(F.struct(level.cast("int").alias("level"), at.alias("prefix")))
    none = F.array().cast("array<struct<level:int,prefix:bigint>>")

    def step(s: Column, level: Column) -> Column:
        lo, hi = s["lo"], s["hi"]
        odd, even = (lo <= hi) & (lo % 2 == 1), (lo <= hi) & (hi % 2 == 0)
        out = F.concat(s["out"], F.when(odd, block(level, lo)).otherwise(none), F.when(even & ~(odd & (lo == hi)), block(level, hi)).otherwise(none))
        lo, hi = F.when(odd, lo + 1).otherwise(lo), F.when(even, hi - 1).otherwise(hi)
        return F.struct(F.when(lo <= hi, F.floor(lo / 2).cast("bigint")).otherwise(F.lit(1).cast("bigint")).alias("lo"), F.when(lo <= hi, F.shiftright(hi, 1)).otherwise(F.lit(0).cast("bigint")).alias("hi"), out.alias("out"))

    start = F.struct(low.cast("bigint").alias("lo"), high.cast("bigint").alias("hi"), none.alias("out"))
    return F.aggregate(F.sequence(F.lit(0), F.lit(levels - 1)), start, step, lambda s: s["out"])


def rows_in_ranges(df: DataFrame, ranges: DataFrame, stars_col: str = "stars") -> DataFrame:
    """df with the range (min_stars, max_stars) that holds its star value, null where none does; a row for each if ranges overlap.

    Ranges are cut into aligned blocks and met by equality, so nothing is compared with every range. Only distinct values are
    met with the blocks, at those levels that blocks have; rows then take their value's range.
    """
    blocks = settled(ranges.select("min_stars", "max_stars", F.explode(dyadic(F.col("min_stars"), F.col("max_stars"))).alias("b")).select("min_stars", "max_stars", "b.*"))
    levels = [r[0] for r in blocks.select("level").distinct().collect()]  # 63 at most
    values = df.select(F.col(stars_col).cast("bigint").alias("_v")).filter("_v >= 0").distinct()
    shifted = F.explode(F.array(*[F.struct(F.lit(n).alias("level"), F.shiftright("_v", n).alias("prefix")) for n in sorted(levels)]).cast("array<struct<level:int,prefix:bigint>>"))
    met = values.select("_v", shifted.alias("b")).select("_v", "b.*").join(blocks, ["level", "prefix"]).select("_v", "min_stars", "max_stars")
    return df.join(met, F.col(stars_col) == F.col("_v"), "left").drop("_v")


def scan_queue(ranges: DataFrame, requests: int, page: int = 100) -> DataFrame:
    """The ranges (min_stars, max_stars, n) that are still open after a number of requests of `page` rows each, spent from the
    highest range down; an empty range takes one request, and a range is done when all its pages are."""
    pages = F.greatest(F.lit(1), F.ceil(F.col("n") / page)).cast("bigint")
    ahead = running(ranges.withColumn("requests", pages), [F.desc("max_stars"), F.desc("min_stars")], F.col("requests"), "before")
    return ahead.filter(F.col("before") + F.col("requests") > requests).select("min_stars", "max_stars", "n")


def running(df: DataFrame, order: list[Column], value: Column, name: str) -> DataFrame:
    """df with the sum of value over the rows before each one. Rows are dealt by ranges of the order and summed there; what
    comes to the driver is a sum for each range."""
    dealt = settled(df.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()).withColumn("_value", value))
    total, starts = 0, []
    for r in dealt.groupBy("_range").agg(F.sum("_value").alias("v")).orderBy("_range").collect():
        starts.append((r["_range"], int(total)))
        total += r["v"] or 0
    inside = Window.partitionBy("_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    offsets = df.sparkSession.createDataFrame(starts, "_range int, _start long")
    out = dealt.withColumn(name, F.coalesce(F.sum("_value").over(inside), F.lit(0))).join(F.broadcast(offsets), "_range")
    return out.withColumn(name, (F.col(name) + F.col("_start")).cast("bigint")).drop("_range", "_start", "_value")


def unresolved_star_counts(histogram: DataFrame, cap: int = CAP) -> DataFrame:
    """Single star values that are still over the cap, the highest first."""
    return histogram.filter(F.col("n") > cap).select("stars").orderBy(F.desc("stars"))


def bucket_label(value: Column, bounds: list[int], name: str) -> Column:
    """Label of the bucket of a value, such as `followers:5..9`; null below the first bound."""
    out = F.lit(None).cast("string")
    for i, low in enumerate(bounds):
        last = i + 1 == len(bounds)
        high = None if last else bounds[i + 1] - 1
        label = f"{name}:>={low}" if last else f"{name}:{low}" if low == high else f"{name}:{low}..{high}"
        out = F.when(value >= low, F.lit(label)).otherwise(out)
    return out


def facet_buckets(df: DataFrame) -> DataFrame:
    """df (account_type, followers, public_repos, created_at) with the facet columns of LEVELS."""
    created = F.col("created_at")
    return (
        df.withColumn("type", F.when(F.lower("account_type").startswith("org"), F.lit("type:org")).otherwise(F.lit("type:user")))
        .withColumn("followers", bucket_label(F.col("followers"), FOLLOWERS, "followers")).withColumn("repos", bucket_label(F.col("public_repos"), REPOSITORIES, "repos"))
        .withColumn("year", F.date_format(created, "yyyy")).withColumn("month", F.date_format(created, "yyyy-MM")).withColumn("day", F.date_format(created, "yyyy-MM-dd"))
    )


def facet_shards(df: DataFrame, cap: int = CAP, levels: list[str] | None = None, years: tuple[int, int] | None = None) -> DataFrame:
    """(level, facets..., n, capped, covered): the coarsest shards of at most `cap` rows, and the finest ones that are over it.

    Rows are counted once by all facets and rolled up once. A shard is open if its parent is over the cap, which then holds for
    all above; a parent's rows are the sum of its children's, one window over siblings. years bounds the years that searches
    ask for, FIRST_YEAR to a given one: where shards are cut by year, rows of other years are one shard that isn't covered.
    """
    levels = levels or LEVELS
    cols = [F.coalesce(F.col(c), F.lit("-")) for c in levels]  # null facets are a bucket of their own, which rollup's null would hide
    if years and "year" in levels:
        within = F.coalesce(F.col("year").cast("int").between(*years), F.lit(False))
        cols = [F.when(within, c).otherwise(F.lit(UNCOVERED)) if name in ("year", "month", "day") else c for name, c in zip(levels, cols)]
    counts = df.groupBy(*[c.alias(name) for name, c in zip(levels, cols)]).agg(F.count("*").alias("n"))
    rolled = counts.rollup(*levels).agg(F.sum("n").cast("bigint").alias("n"), F.grouping_id().alias("g")).withColumn("level", (F.lit(len(levels)) - F.bit_count("g")).cast("int"))
    parent = [F.when(F.col("level") > i + 1, F.col(c)) for i, c in enumerate(levels)]
    above = F.when(F.col("level") > 0, F.sum("n").over(Window.partitionBy("level", *parent)))
    out = rolled.withColumn("above", above)
    at = levels.index("year") + 1 if "year" in levels else len(levels)
    missed = F.coalesce(F.col(levels[at - 1]) == UNCOVERED, F.lit(False))
    closed = (F.col("n") <= cap) | (F.col("level") == len(levels)) | (missed & (F.col("level") == at))
    out = out.filter((F.coalesce("above", F.lit(cap + 1)) > cap) & closed & ~(missed & (F.col("level") > at)))
    return out.select("level", *levels, "n", (F.col("n") > cap).alias("capped"), (~missed).alias("covered"))


def positions(df: DataFrame, order: list[Column], group_cols: list[str], name: str) -> DataFrame:
    """df with the place of each row in the order within its group, from 0.

    Rows are dealt by ranges of group and order, numbered within each range, and shifted by the counts of the ranges
    before it, so a large group is numbered by many tasks. The dealt rows are written once.
    """
    dealt = settled(df.repartitionByRange(*group_cols, *order).withColumn("_range", F.spark_partition_id()))
    before = Window.partitionBy(*group_cols).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    counts = dealt.groupBy(*group_cols, "_range").agg(F.count("*").alias("_rows"))
    starts = counts.select(F.col("_range").alias("_of"), F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"), *[F.col(c).alias(f"_g{i}") for i, c in enumerate(group_cols)])
    inside = Window.partitionBy("_range", *group_cols).orderBy(*order)
    same = F.col("_range") == F.col("_of")
    for i, c in enumerate(group_cols):
        same = same & F.col(c).eqNullSafe(F.col(f"_g{i}"))
    out = dealt.withColumn("_n", F.row_number().over(inside)).join(starts, same)
    return out.select(*df.columns, (F.col("_start") + F.col("_n") - 1).cast("bigint").alias(name))


def batch_chunks(df: DataFrame, size: int, order_cols: list[str], group_cols: list[str]) -> DataFrame:
    """df with `batch`: chunks of `size` rows in order within each group."""
    return positions(df, [F.col(c) for c in order_cols], group_cols, "batch").withColumn("batch", F.floor(F.col("batch") / size).cast("bigint"))
