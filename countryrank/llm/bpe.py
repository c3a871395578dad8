"""BPE encoding and decoding by tree concatenation.

Short texts are encoded whole. Long texts are cut in pieces that Spark deals over the cluster, each piece is encoded on
its own, and neighbours are joined pairwise up a tree. A join re-encodes a window of characters around the seam, growing
it until the window's tokens agree with those of both sides; the agreed parts are kept. No cut depends on white space,
so text that the pre-tokenizer never splits is handled the same way.

Null texts count as empty: no tokens and an empty decoded text. All other columns pass through, repeated rows stay separate
rows, and a column with the name of a result is replaced.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fresh

#: Texts of more characters than this are encoded in pieces of this size.
PIECE = 1 << 16
#: Characters on each side of a seam that are encoded anew at first; doubled until both sides agree.
WINDOW = 64
END_OF_TEXT = "<|endoftext|>"


@lru_cache(maxsize=2)
def codec(ranks_path: str, pattern: str):
    """(encoder, bytes of each token, decimal text of each token) of a byte-level vocabulary."""
    import tiktoken

    with open(ranks_path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    end = len(ranks)
    table = [b""] * (end + 1)
    for token, i in ranks.items():
        table[i] = token
    table[end] = END_OF_TEXT.encode()
    made = tiktoken.Encoding("corpus", pat_str=pattern, mergeable_ranks=ranks, special_tokens={END_OF_TEXT: end})
    return made, table, [str(i) for i in range(end + 1)]


def encode_piece(text: str, enc) -> list[int]:
    """Token ids of a text; the end marker in a text is its own token."""
    return enc.encode(text, allowed_special="all")


def cut(text: str, size: int) -> list[str]:
    """Pieces of at most about `size` characters; a cut never lies inside an end marker."""
    out, at = [], 0
    while at < len(text):
        to = min(len(text), at + size)
        near = text.rfind(END_OF_TEXT, max(at, to - len(END_OF_TEXT) + 1), to + len(END_OF_TEXT) - 1)
        if near >= 0 and near < to < near + len(END_OF_TEXT):
            to = near + len(END_OF_TEXT)
        out.append(text[at:to])
        at = to
    return out


def _ends(ids: list[int], table: list[bytes]) -> np.ndarray:
    """Byte offset of the end of each token."""
    return np.cumsum(np.fromiter((len(table[i]) for i in ids), dtype=np.int64, count=len(ids)))


def join(left: list[int], right: list[int], a: str, b: str, enc, table: list[bytes], window: int = WINDOW) -> list[int]:
    """Tokens of a + b, given those of a and of b.

    The window grows until its tokens agree with the left side on the first half of the window's left part and with the
    right side on the second half of its right part, and the splice then happens inside the agreed stretch: AGREE equal
    tokens at equal places, or the start or end of the text.
    """
    if not a or not b:
        return right if not a else left
    while True:
        p, q = max(0, len(a) - window), min(len(b), window)
        mid = encode_piece(a[p:] + b[:q], enc)
        if p == 0 and q == len(b):
            return mid
        # byte lengths on either side of the seam
        left_bytes, right_bytes = len(a[p:].encode()), len(b[:q].encode())
        l_ends = _ends(left[-min(len(left), left_bytes):], table)
        l_at = l_ends - (l_ends[-1] - left_bytes)  # relative to the window's start
        m_ends = _ends(mid, table)
        r_ends = _ends(right[: min(len(right), right_bytes)], table) + left_bytes
        lo = _agree(l_at, left[-len(l_at):], m_ends, mid, left_bytes, from_left=True) if p else (0, 0)
        hi = _agree(r_ends, right[: len(r_ends)], m_ends, mid, left_bytes, from_left=False) if q < len(b) else (len(mid), len(right))
        if lo is not None and hi is not None and lo[0] <= hi[0]:
            head = left[: len(left) - len(l_at) + lo[1]] if p else []
            return head + mid[lo[0] : hi[0]] + right[hi[1] :]
        window *= 4


#: Tokens in a row that must agree, at the same bytes, for a side to count as agreed.
AGREE = 4


def _agree(at: np.ndarray, ids: list[int], m_at: np.ndarray, mid: list[int], seam: int, from_left: bool):
    """(tokens of mid, tokens of the side) before a splice inside a run of AGREE common tokens, or None.

    On the left the run nearest the seam's far half is sought from the seam outward, on the right alike.
    """
    side, middle = {}, {}
    for k, e in enumerate(at.tolist()):
        side[e] = k
    for k, e in enumerate(m_at.tolist()):
        middle[e] = k
    size = int(m_at[-1])
    shared = sorted(e for e in side if e in middle and ids[side[e]] == mid[middle[e]])
    if from_left:
        shared = [e for e in shared if e <= seam // 2][::-1]
    else:
        shared = [e for e in shared if e > seam + (size - seam) // 2]
    for e in shared:
        s, m = side[e], middle[e]
        if from_left:
            if s >= AGREE - 1 and m >= AGREE and all(ids[s - i] == mid[m - i] and at[s - i] == m_at[m - i] for i in range(AGREE)):
                return m + 1 - AGREE // 2, s + 1 - AGREE // 2
        elif s + AGREE <= len(ids) and m + AGREE < len(mid) and all(ids[s + i] == mid[m + i] and at[s + i] == m_at[m + i] for i in range(AGREE)):
            return m + AGREE // 2, s + AGREE // 2
    return None


def concat_tree(pieces: list[tuple[str, list[int]]], enc, table: list[bytes]) -> list[int]:
    """Joins encoded pieces pairwise until one is left."""
    while len(pieces) > 1:
        pairs = [(x[0] + y[0], join(x[1], y[1], x[0], y[0], enc, table)) for x, y in zip(pieces[::2], pieces[1::2], strict=False)]
        pieces = pairs + ([pieces[-1]] if len(pieces) % 2 else [])
    return pieces[0][1] if pieces else []


def decode(ids, table: list[bytes]) -> str:
    """The text of token ids, as the vocabulary's byte-level decoder gives it."""
    return b"".join([table[i] for i in ids]).decode("utf-8", errors="replace")


def _digest(ids: list[int], table: list[bytes], names: list[str]) -> tuple[int, str, str]:
    said = ",".join([names[i] for i in ids]).encode()
    return len(ids), hashlib.sha256(said).hexdigest(), hashlib.sha256(decode(ids, table).encode()).hexdigest()


DIGESTS = "n_tokens long, ids_sha256 string, decoded_sha256 string"


def encode_long(docs: DataFrame, ranks_path: str, pattern: str, piece: int = PIECE) -> DataFrame:
    """(_row, ids) of long texts: pieces are encoded over the whole cluster, then each text's pieces are joined."""

    def pieces(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for row, text in zip(b["_row"], b["_text"], strict=True):
                parts = cut(text, piece)
                yield pd.DataFrame({"_row": row, "_n": range(len(parts)), "_text": parts})

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc, _, _ = codec(ranks_path, pattern)
        for b in batches:
            yield b.assign(ids=[encode_piece(x, enc) for x in b["_text"]])

    def gather(b: pd.DataFrame) -> pd.DataFrame:
        enc, table, _ = codec(ranks_path, pattern)
        b = b.sort_values("_n")
        ids = concat_tree([(t, [int(i) for i in x]) for t, x in zip(b["_text"], b["ids"], strict=True)], enc, table)
        return pd.DataFrame({"_row": [b["_row"].iloc[0]], "ids": [ids]})

    split = docs.mapInPandas(pieces, "_row string, _n int, _text string").repartition("_row", "_n")
    return split.mapInPandas(encode, "_row string, _n int, _text string, ids array<int>").groupBy("_row").applyInPandas(gather, "_row string, ids array<int>")


def encode_texts(df: DataFrame, ranks_path: str, pattern: str, text_col: str = "text", piece: int = PIECE) -> DataFrame:
    """df with ids (array<int>), the tokens of each whole text."""
    return _run(df, ranks_path, pattern, text_col, piece, "ids array<int>", lambda ids, table, names: (ids,))


def digest_texts(df: DataFrame, ranks_path: str, pattern: str, text_col: str = "text", piece: int = PIECE) -> DataFrame:
    """df with n_tokens, ids_sha256 and decoded_sha256; tokens stay in the tasks that make them."""
    return _run(df, ranks_path, pattern, text_col, piece, DIGESTS, _digest)


def _run(df: DataFrame, ranks_path: str, pattern: str, text_col: str, piece: int, out: str, make) -> DataFrame:
    """Short texts in one pass without a shuffle; only the long ones are dealt out in pieces."""
    names = [x.split()[0] for x in out.split(", ")]
    rest = [c for c in df.columns if c != text_col and c not in names]
    said, row = fresh([*rest, *names], "_text", "_row")
    text = F.coalesce(F.col(text_col), F.lit(""))
    kept = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in df.schema if f.name in rest)
    back = [f"`{c}`" for c in (*rest, *names)]

    def short(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc, table, words = codec(ranks_path, pattern)
        for b in batches:
            made = [make(encode_piece(x, enc), table, words) for x in b[said]]
            yield b[rest].assign(**{n: [m[k] for m in made] for k, n in enumerate(names)})

    def long_(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        _, table, words = codec(ranks_path, pattern)
        for b in batches:
            made = [make([int(i) for i in x], table, words) for x in b["ids"]]
            yield pd.DataFrame({row: b["_row"]}).assign(**{n: [m[k] for m in made] for k, n in enumerate(names)})

    quoted = [f"`{c}`" for c in rest]
    few = df.filter(F.length(text) <= piece).select(*quoted, text.alias(said)).mapInPandas(short, f"{kept}{out}")
    big = df.filter(F.length(text) > piece).select(*quoted, text.alias(said), F.sha2(F.encode(text, "UTF-8"), 256).alias(row))  # equal texts are encoded once
    ids = encode_long(big.select(F.col(row).alias("_row"), F.col(said).alias("_text")).dropDuplicates(["_row"]), ranks_path, pattern, piece)
    done = big.drop(said).join(ids.mapInPandas(long_, f"{row} string, {out}"), row).select(*back)
    return few.select(*back).unionByName(done)


def op1(spark, sf_dir: str) -> DataFrame:
    """All documents encoded with the public 50k byte-level vocabulary and decoded again."""
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return digest_texts(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
