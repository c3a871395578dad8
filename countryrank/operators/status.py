"""Status of every catalogue country, from published rankings and two kinds of progress."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text


def status_join(catalogue: DataFrame, published: DataFrame, progress: DataFrame, repo_progress: DataFrame) -> DataFrame:
    """Every country with its ranking, owner progress and repository progress as structs, null where there is none."""
    part = lambda df, name: df.select("code", F.struct(*[c for c in df.columns if c != "code"]).alias(name))
    out = catalogue
    for df, name in ((published, "published"), (progress, "progress"), (repo_progress, "repo_progress")):
        out = out.join(part(df, name), "code", "left")
    return out


def status_label(published: Column, progress: Column, repo_progress: Column, phase: Column, done: Column, total: Column) -> Column:
    """Label of a country; the first three tell whether it has such a record."""
    percent = text.progress_percent(F.coalesce(done, F.lit(0)), F.coalesce(total, F.lit(0)))
    step = F.when(phase == "finalize", F.lit("Finalizing")).otherwise(F.concat(F.lit("Building "), percent, F.lit("%")))
    pick = lambda a, b: F.when(published, a if isinstance(a, Column) else F.lit(a)).otherwise(b if isinstance(b, Column) else F.lit(b))
    return (
        F.when(~progress & ~repo_progress, pick("🟢 **Live**", "⚪ Queued"))
        .when(~progress, pick("🟢 **Live**", "🟡 Repository scan"))
        .when(phase == "complete", pick("**Live**", "Completed"))
        .otherwise(pick(F.concat(F.lit("🟢 **Live** · 🟡 "), step), F.concat(F.lit("🟡 "), step)))
    )


def country_status(joined: DataFrame) -> DataFrame:
    """(code, name, status, updated_at) of status_join(): repository progress dates a country, else owner progress, else
    its ranking."""
    has = lambda c: F.col(c).isNotNull()
    label = status_label(has("published"), has("progress"), has("repo_progress"), F.col("progress.phase"), F.col("progress.next_term_index"), F.col("progress.terms_total"))
    return joined.select("code", "name", label.alias("status"), F.coalesce("repo_progress.updated_at", "progress.updated_at", "published.generated_at").alias("updated_at"))


def status_counts(joined: DataFrame) -> DataFrame:
    """One row: indexed, live, building and queued countries; a live country can still be building."""
    has = lambda c: F.col(c).isNotNull()
    building = (has("progress") & (F.coalesce("progress.phase", F.lit("")) != "complete")) | has("repo_progress")
    return joined.agg(F.count("*").alias("indexed"), F.count_if(has("published")).alias("live"), F.count_if(building).alias("building"), F.count_if(~has("published") & ~has("progress") & ~has("repo_progress")).alias("queued"))


def unpublished_countries(catalogue: DataFrame, published: DataFrame) -> DataFrame:
    return catalogue.join(published.select("code"), "code", "left_anti")


def queued_countries(catalogue: DataFrame, *states: DataFrame) -> DataFrame:
    """Codes without any state."""
    known = states[0].select("code")
    for s in states[1:]:
        known = known.union(s.select("code"))
    return catalogue.select("code").subtract(known)


def building_countries(progress: DataFrame, repo_progress: DataFrame) -> DataFrame:
    """Codes of unfinished owner crawls and of repository scans."""
    return progress.filter(F.coalesce("phase", F.lit("")) != "complete").select("code").union(repo_progress.select("code")).distinct()


def resume_progress(state: DataFrame, events: DataFrame) -> DataFrame:
    """State after the events of a run, with the term that is active.

    state: (code, next_term_index, terms_total, terms_processed, active_term, active_since, completed_at), the last three null
    where there is none. events: (code, seq, kind, term, at); kind is begin, finish, defer or others, in the order of seq.
    A begin counts when no term is active: it takes the next index. A finish counts when one is: the term is processed and the
    next index grows. So what an event does follows from the begin or finish before it, and the fold is a lag and counts. A
    defer leaves the term active and is counted. At terms_total the country is complete; the first time stays.
    """
    first = F.lit(-(1 << 62)).cast("bigint")
    held = state.filter("active_since IS NOT NULL").select("code", first.alias("seq"), F.lit("begin").alias("kind"), F.col("active_term").alias("term"), F.col("active_since").alias("at"))
    all_ = events.select("code", F.col("seq").cast("bigint").alias("seq"), "kind", "term", "at").unionByName(held)
    order = Window.partitionBy("code").orderBy("seq")
    before = F.last(F.when(F.col("kind").isin("begin", "finish"), F.col("kind")), ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, -1))
    marked = all_.withColumn("before", before)
    counts = (F.col("kind") == "finish") & (F.col("before") == "begin")
    opens = (F.col("kind") == "begin") & (F.coalesce("before", F.lit("finish")) == "finish")
    marked = marked.withColumn("done", F.when(counts, F.sum(F.when(counts, 1).otherwise(0)).over(order)))
    left = state.select("code", (F.col("terms_total") - F.col("next_term_index")).alias("left"))
    folded = marked.join(left, "code").groupBy("code").agg(
        F.count("done").alias("n"), F.min(F.when(F.col("done") >= F.col("left"), F.struct("seq", "at"))).alias("end"),
        F.max(F.when(opens, F.struct("seq", "term", "at"))).alias("open"), F.max(F.when(F.col("kind") == "finish", F.col("seq"))).alias("closed"),
        F.max(F.when(F.col("seq") > first, F.struct("seq", "at"))).alias("last"),
    )
    active = F.when(F.coalesce(F.col("closed") < F.col("open.seq"), F.col("open").isNotNull()), F.col("open"))
    folded = folded.withColumn("active", active)
    deferred = marked.filter("kind = 'defer'").join(folded.select("code", F.col("active.seq").alias("from")), "code").filter("seq > from").groupBy("code").agg(F.count("*").alias("deferrals"))
    at = (F.col("next_term_index") + F.coalesce("n", F.lit(0))).cast("bigint")
    done = F.coalesce(F.col("completed_at"), F.col("end.at"))
    return state.join(folded, "code", "left").join(deferred, "code", "left").select(
        "code", at.alias("next_term_index"), "terms_total", (F.col("terms_processed") + F.coalesce("n", F.lit(0))).alias("terms_processed"), F.when(at >= F.col("terms_total"), "complete").otherwise("discovery").alias("phase"),
        F.when(F.col("active").isNotNull(), at).alias("active_index"), F.col("active.term").alias("active_term"), F.col("active.at").alias("active_since"), F.coalesce("deferrals", F.lit(0)).alias("deferrals"),
        done.alias("completed_at"), done.alias("finalized_at"), F.col("last.at").alias("updated_at"),
    )
