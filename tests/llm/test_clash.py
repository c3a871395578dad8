"""Operators on tables whose extra columns have the names that they use themselves; repeated rows and odd ids."""

import datetime
import random

import public_tokenizers
import pytest
from pyspark.sql import functions as F

from countryrank.llm import bpe, contamination, jaccard, langid, maxent, mixing, passages, phrases, pii, quality, sharding, suffix
from countryrank.llm.common import shared_dir

NAMES = """_id _cls _d _t _row _text _n _s _w _l _pii _new _seen _who _bare _h _of h node rep n key id cls part words times ids_ kept spans l t lang_pred score hash item item_id c
component_id n_shingles n_tokens ids ids_sha256 decoded_sha256 held_out size text_crc32 virtual_slot shard a b x p text_ n_bytes n_removed n_spans""".split()


def docs(spark):
    rnd = random.Random(1)
    base = [f"w{rnd.randint(0, 999)}" for _ in range(90)]
    rows = [(k, " ".join([*base[: 60 + k % 9], *(f"u{rnd.randint(0, 999)}" for _ in range(30))])) for k in range(20)]
    rows += [rows[0], rows[0], (None, rows[1][1]), (3, None), (4, ""), (5, "call +1 (212) 555-0123 or 1999-12-31, 10.0.0.1"), (6, "z" * 3000)]
    return spark.createDataFrame(rows, "doc_id long, text string")


def items(spark):
    return spark.createDataFrame([(1, " ".join(docs(spark).first()["text"].split()[:40])), (2, "none of this occurs in there at all")], "item_id long, text string")


RANKS, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
OPERATORS = {
    "bpe_digests": lambda d, _: bpe.digest_texts(d, RANKS, PATTERN, piece=256).select("doc_id", *[x.split()[0] for x in bpe.DIGESTS.split(", ")]),
    "bpe": lambda d, _: bpe.encode_texts(d, RANKS, PATTERN, piece=256).select("doc_id", "ids"),
    "quality": lambda d, _: quality.ledger(d),
    "sharding": lambda d, _: sharding.place(sharding.sized(d), sharding.slot_map(sharding.slot_stats(sharding.sized(d)))).select("doc_id", "shard", "slot", "size"),
    "maxent": lambda d, _: maxent.score(d, langid.fold_of("doc_id", 7) == 2).select("doc_id", "held_out", "n_tokens", "n_known", F.round("base_score", 6).alias("base")),
    "jaccard": lambda d, _: jaccard.cluster(d),
    "contamination": lambda d, i: contamination.search(d, i),
    "contamination_clean": lambda d, i: contamination.clean(d, i).select("doc_id", "text"),
    "passages": lambda d, _: passages.repeats(d),
    "langid": lambda d, _: langid.predict(d, langid.fit(d.withColumn("lang", F.lit("en")))).select("doc_id", "lang_pred"),
    "pii": lambda d, _: pii.pseudonymize(d, "k", found_col="found").select("doc_id", "text", "found"),
    "mixing": lambda d, _: mixing.taken(*mixing.mix(d.withColumn("source", F.lit("s")))[1:]).select("id", "size", "taken"),
    "phrases": lambda d, _: phrases.collocations(d.withColumn("lang", F.lit("en")), least=2),
    "suffix": lambda d, _: suffix.dedup(d).select("doc_id", "kept", "n_removed"),
}


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_extra_columns(spark, name):
    plain = docs(spark)
    wide = plain.select("*", *[F.lit(f"extra {n}").alias(n) for n in NAMES])
    rows = lambda df: sorted(map(str, df.collect()))
    assert rows(OPERATORS[name](wide, items(spark))) == rows(OPERATORS[name](plain, items(spark)))


def test_extra_columns_pass_through(spark):
    wide = docs(spark).select("*", *[F.lit(f"extra {n}").alias(n) for n in NAMES if n not in ("lang_pred", "score")])
    for out in (pii.pseudonymize(wide, "k"), contamination.clean(wide, items(spark)), bpe.encode_texts(wide, RANKS, PATTERN, piece=256), langid.predict(wide, None)):
        row = out.first().asDict()
        assert all(row[n] == f"extra {n}" for n in NAMES if n not in ("lang_pred", "score", "ids"))


def test_session_stays_as_it_is(spark):
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    passages.repeats(docs(spark)).count()
    suffix.dedup(docs(spark)).count()
    jaccard.cluster(docs(spark)).count()
    assert spark.conf.get(name) == before


def test_pseudonyms_keep_format(spark):
    said = ["1850-02-28", "0001-01-01", "2150-07-04", "9999-12-31", "2099-12-31", "1900-01-01", "1999-02-30", "010.002.003.004", "10.2.3.4", "256.1.1.1", "00.0.0.0", "(555) 223-4567", "555-223-4567", "555-123-4567", "+44 20 7946 0958"]
    df = spark.createDataFrame([(i, f"see {v} there") for i, v in enumerate(said)], "doc_id long, text string")
    new = pii.pseudonymize(df, "k")
    got = {r["doc_id"]: r["text"] for r in new.collect()}
    back = {r["doc_id"]: r["text"] for r in pii.pseudonymize(new, "k", inverse=True).collect()}
    assert back == {i: f"see {v} there" for i, v in enumerate(said)}
    value = [got[i].split("see ")[1].rsplit(" there", 1)[0] for i in range(len(said))]
    for i in range(6):
        assert datetime.date.fromisoformat(value[i])
    assert value[0] < "1900" and value[2] >= "2099-12-31" and value[3] >= "2099-12-31"
    assert all(value[i] != said[i] for i in (0, 2, 3, 7, 8, 11, 12, 14))
    assert all(value[i] == said[i] for i in (6, 9, 13))
    assert [len(p) for p in value[7].split(".")] == [3, 3, 3, 3] and all(p[0] == "0" for p in value[7].split("."))
    assert [len(x) for x in value[11].replace("(", "").replace(")", "").replace("-", " ").split()] == [3, 3, 4]


def test_stored_maps(spark):
    path = f"{shared_dir(spark)}/slots"
    records = sharding.sized(docs(spark))
    sharding.store_map(sharding.slot_map(sharding.slot_stats(records), 4), path)
    first = {r["virtual_slot"]: r["shard"] for r in sharding.load_map(spark, path).collect()}
    second = {r["virtual_slot"]: r["shard"] for r in sharding.rebalance(spark, path, 5).collect()}
    assert first.keys() == second.keys() and all(second[s] in (first[s], 4) for s in first)
    assert {r["virtual_slot"]: r["shard"] for r in sharding.load_map(spark, path, 1).collect()} == first
    assert sharding.load_map(spark, path).first()["map_version"] == 2
    for _ in range(2):  # a driver that runs anew stores its version again
        sharding.store_map(sharding.slot_map(sharding.slot_stats(records), 4), path)
    assert {r["virtual_slot"]: r["shard"] for r in sharding.load_map(spark, path, 1).collect()} == first
    assert sharding.load_map(spark, path, 1).count() == len(first) and sharding.load_map(spark, path, 2).count() == len(second)
