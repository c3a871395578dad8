import hashlib
import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from countryrank.llm import bpe

PATH, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
CHUNKS = ["a" * 300, " " * 90, "\n\n\n", "1234567" * 30, "the of and ", "don't we'll ", "éèàß" * 20, "日本語" * 15, "!?..." * 20, "<|endoftext|>", "\t x", "thtion" * 40, " 's", "😀" * 9, "ab" * 200, "<|endof", "=" * 150, "qwertyuiop" * 30]


@pytest.fixture(scope="module")
def enc():
    return bpe.codec(PATH, PATTERN)


@pytest.mark.parametrize("seed", range(30))
def test_tree_equals_whole(enc, seed):
    rnd = random.Random(seed)
    text = "".join(rnd.choice(CHUNKS)[: rnd.randint(1, 400)] + rnd.choice(["", " ", "\n", "x"]) for _ in range(rnd.randint(1, 60)))
    for size in (37, 150, 801):
        parts = [(x, bpe.encode_piece(x, enc[0])) for x in bpe.cut(text, size)]
        assert "".join(x for x, _ in parts) == text
        assert bpe.concat_tree(parts, enc[0], enc[1]) == bpe.encode_piece(text, enc[0])


@pytest.mark.parametrize("unit", ["a", "ab", " ", "é", "0", "thtion", "\n", "="])
def test_unsplit_runs(enc, unit):
    text = unit * 3000
    parts = [(x, bpe.encode_piece(x, enc[0])) for x in bpe.cut(text, 500)]
    assert bpe.concat_tree(parts, enc[0], enc[1]) == bpe.encode_piece(text, enc[0])


def test_query_matches_tokenizers_library(spark, enc):
    own = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = [None, "", "x", "a <|endoftext|> b", "word " * 400, "q" * 5000, "é" * 2500 + " the end", "x"]
    df = spark.createDataFrame([(i, t, "z") for i, t in enumerate(texts)], "doc_id long, text string, ids string")
    got = {r["doc_id"]: r for r in bpe.digest_texts(df.select("doc_id", "text"), PATH, PATTERN, piece=700).collect()}
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        ids = own.encode(t or "", add_special_tokens=False).ids
        assert got[i]["n_tokens"] == len(ids)
        assert got[i]["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert got[i]["decoded_sha256"] == hashlib.sha256(own.decode(ids, skip_special_tokens=False).encode()).hexdigest()
    ids = {r["doc_id"]: r["ids"] for r in bpe.encode_texts(df.drop("ids"), PATH, PATTERN, piece=700).collect()}
    assert ids[4] == own.encode(texts[4], add_special_tokens=False).ids


def test_no_rows(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert bpe.digest_texts(df, PATH, PATTERN).count() == 0
