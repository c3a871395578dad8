"""Stages that make a clean, tokenized corpus of the documents table.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before kept; run() writes what a stage returns as
Parquet and reads it again for the next one. Rows with null ids are kept by the stages that tell documents by id.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from countryrank.llm import bpe, contamination, jaccard, langid, pii
from countryrank.llm.common import small, small_batches, table, written

#: A document goes if its language is undetermined or less likely than this.
LEAST_SURE = 0.4


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents whose language is told; the network learns from a bounded sample of the labelled ones."""
    small_batches(spark)
    told = langid.predict(docs, langid.fit(docs), lang_out="_lang", score_out="_sure")
    return told.filter((F.col("_lang") != langid.NONE) & (F.col("_sure") >= LEAST_SURE)).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one row of each component at Jaccard 0.75: of the smallest id, and of its texts the one of the smallest hash.

    Rows with a null id, and rows without words, which link with nothing, stay.
    """
    small_batches(spark)
    marked = jaccard.labelled(docs.select("doc_id", "text")).filter("doc_id IS NOT NULL AND part IS NOT NULL")
    groups = written(marked.groupBy("part", "doc_id", "h").agg(F.count("*").alias("n")), "groups")
    first = groups.groupBy("part").agg(F.min(F.struct("doc_id", "h")).alias("first"))
    ranked = groups.join(first, "part").withColumn("stays", F.struct("doc_id", "h") == F.col("first"))
    gone = written(ranked.filter("NOT stays").select(F.col("doc_id").alias("_of"), F.col("h").alias("_h")), "gone")
    again = written(ranked.filter("stays AND n > 1").select(F.col("doc_id").alias("_of"), F.col("h").alias("_h")), "again")
    h = F.unhex(F.sha2(F.encode(F.coalesce("text", F.lit("")), "UTF-8"), 256))

    def met(rows: DataFrame, how: str) -> DataFrame:
        fits, _ = small(rows, 48)
        return kept.join(F.broadcast(rows) if fits else rows, (F.col("doc_id") == F.col("_of")) & (h == F.col("_h")), how)

    kept = docs
    kept = met(gone, "left_anti")
    if not again.limit(1).count():
        return kept
    return met(again, "left_anti").unionByName(met(again, "left_semi").withColumn("_h", h).dropDuplicates(["doc_id", "_h"]).drop("_h"))


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents that hold no benchmark item at containment 0.75."""
    return contamination.clean(docs, table(spark, sf_dir, "benchmark").select("item_id", "text"))


def private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with pseudonyms in place of personal data under the key of the session."""
    small_batches(spark)
    return pii.pseudonymize(docs, pii.key_of(spark))


def tokenized(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Tokens of all documents: their number, and digests of the ids and of the text decoded from them."""
    small_batches(spark)
    import public_tokenizers

    out = bpe.digest_texts(docs.select("doc_id", "lang", "source", "text"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    return out.select("doc_id", "lang", "source", "n_tokens", "ids_sha256", "decoded_sha256")


STAGES = [("language_id", language), ("ngram_jaccard_join", near_duplicates), ("benchmark_decontamination", decontaminated), ("pii", private), ("bpe", tokenized)]

#: SQL can't express the network, the permutations or the tokens.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over the documents table."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
