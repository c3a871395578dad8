"""The pipeline's stages against brute force on the smallest table."""

import hashlib
import re

import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline as P
from countryrank.llm import langid, pii
from test_jaccard import brute

SF = "/root/testdata/sf0.001"


def grams(t):
    w = t.encode().lower().split()
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def test_run(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    told = langid.predict(docs, langid.fit(docs), lang_out="p", score_out="s").collect()
    kept = {r["doc_id"]: r for r in told if r["p"] != "und" and r["s"] >= P.LEAST_SURE}
    groups = brute([(i, r["text"]) for i, r in kept.items()])
    kept = {i: r for i, r in kept.items() if groups[i][1] == i}
    items = [grams(r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    kept = {i: r for i, r in kept.items() if not any(q and 100 * len(q & grams(r["text"])) >= 75 * len(q) for q in items)}
    df = spark.createDataFrame([(i, r["text"]) for i, r in kept.items()], "doc_id long, text string")
    clean = {r["doc_id"]: r["text"] for r in pii.pseudonymize(df, pii.PUBLIC_KEY).collect()}
    assert any(clean[i] != r["text"] for i, r in kept.items())
    assert not any(re.search(re.escape(v), clean[i]) for i, r in kept.items() for v in re.findall(r"\+1 \(\d{3}\) \d{3}-\d{4}|[\w.]+@\w+\.example\.com", r["text"]))
    own = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = {}
    for i, t in clean.items():
        ids = own.encode(t, add_special_tokens=False).ids
        want[i] = (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(t.encode()).hexdigest())
    got = {r["doc_id"]: (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in P.run(spark, SF).collect()}
    assert got == want


def test_stages_keep_columns_and_take_odd_rows(spark, tmp_path):
    en = "the cat and the dog with this house of that man " * 8
    rows = [(1, en, "en", "s", 1), (1, en, "en", "s", 1), (None, en + "x", None, None, None), (2, None, "en", "s", None), (3, "", None, "s", 0), (4, "der hund und die katze mit dem haus von jenem mann " * 9, "de", "s", 1)]
    kind = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(rows, kind).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, "nothing of this kind is in there at all")], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    for name, stage in P.STAGES[:-1]:
        assert stage(spark, docs, str(tmp_path)).columns == docs.columns, name
        assert stage(spark, docs.limit(0), str(tmp_path)).count() == 0, name
    got = sorted(str(r["doc_id"]) for r in P.run(spark, str(tmp_path)).collect())
    assert got == ["1", "4", "None"]
