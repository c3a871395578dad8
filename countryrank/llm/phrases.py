"""Phrase collocations counted in quotient filters.

* Words are counted per language; those below the least count can't be in a candidate and break phrases like the signs
  between pieces. The others get dense ids, across languages, so an id tells its language.
* Tasks find the id of a word by a 64-bit key of it and its language. Whether two words of the table, rare ones too, have one
  key is looked up first; if so, and for dictionaries of more than WORDS_MOST words, ids come to the texts by a join instead.
* A phrase of 2 to 4 ids is packed into two halves, which are as wide as phrases of its length need. A Feistel network permutes
  the packed number. Its first bits, the quotient, name the filter's slot, and all the others, the remainder, are kept in full:
  counts are of phrases, not of hashes, and the network run backwards gives the ids again.
* A filter holds phrases of one length and is sorted. It is stored as the bits of occupied slots, the bits that end a slot's
  run, the remainders in as few bytes as hold them, and the counts in a byte, larger ones apart. Tasks count runs of words, cut
  the filter into ranges of the quotient, and send each range to the task that merges it. Quotients are spread evenly, whatever
  the phrases are, and the number of ranges grows with the number of words, so a range has a bounded size.
* Candidates, cuts and containing phrases are then joined by ids, with decimal arithmetic.

Null texts are empty, a null language is `und`, and copies count as often as they occur. A text without words, and an empty
table, have no phrases. Long texts are read in slices. Only the language and the text are read, so other columns and their
names don't matter. Bytes that aren't UTF-8 don't occur in Spark's strings.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import table, written
from .jaccard import _A, _POWER, mix

LEAST, LONGEST, TOP, COVER = 30, 4, 2000, 80
#: Words that a task counts at once, entries of a range aimed at, and the words up to which a dictionary goes to all tasks, at
#: 12 bytes each.
BUFFER, RANGE, WORDS_MOST = 1 << 21, 1 << 19, 1 << 22
SLICE = 1 << 17
_BREAK = b"."
_TABLE = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ\t,;:!?\n\x0b\x0c\r", b"abcdefghijklmnopqrstuvwxyz " + 9 * _BREAK)
_KEYS = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93)]


def slices(text: bytes | None) -> Iterator[bytes]:
    """A text in slices; no word is cut."""
    text, at = text or b"", 0
    while at < len(text):
        end = at + SLICE
        while end < len(text) and text[end] not in b" \t.":
            end += 1
        yield text[at:end]
        at = end


def tokens(text: bytes | None) -> Iterator[list[bytes]]:
    """The words of a text and, as `.`, its breaks, a slice at a time."""
    for some in slices(text):
        yield some.translate(_TABLE).replace(_BREAK, b" . ").split()


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Partial (lang, word, n)."""
    seen: dict[str, Counter] = {}

    def out() -> pa.RecordBatch:
        rows = [(lang, w, n) for lang, c in seen.items() for w, n in c.items() if w != _BREAK]
        seen.clear()
        cols = list(zip(*rows)) or [[]] * 3
        return pa.RecordBatch.from_arrays([pa.array(cols[0], pa.string()), pa.array(cols[1], pa.binary()), pa.array(cols[2], pa.int64())], ["lang", "word", "n"])

    for b in batches:
        for lang, text in zip(b.column(0).to_pylist(), b.column(1)):
            c = seen.setdefault(lang, Counter())
            for some in tokens(text.as_py()):
                c.update(some)
            if sum(map(len, seen.values())) > 200_000:
                yield out()
    yield out()


def word_counts(docs: DataFrame) -> DataFrame:
    """(lang, word, n) of (lang, text) in bytes."""
    return docs.mapInArrow(_counts, "lang string, word binary, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))


def numbered(counts: DataFrame) -> DataFrame:
    """counts with dense ids from 1; what comes to the driver is a number for each partition."""
    kept = written(counts.withColumn("m", F.monotonically_increasing_id()), "words")
    part = F.call_function("shiftright", F.col("m"), F.lit(33)).cast("int")
    starts, total = [], 1
    for r in kept.groupBy(part.alias("p")).count().orderBy("p").collect():
        starts.append((r["p"], total))
        total += r["count"]
    first = F.broadcast(kept.sparkSession.createDataFrame(starts, "p int, s long"))
    return written(kept.withColumn("p", part).join(first, "p").select("lang", "word", "n", (F.col("m").bitwiseAND(F.lit((1 << 33) - 1)) + F.col("s")).alias("id")), "dictionary")


# -- keys of words

#: 0 for bytes of words, 1 for those between words, 2 for breaks; and the values of the bytes of words, A-Z in lower case.
_KIND = np.array([2 if _TABLE[i] == _BREAK[0] else int(_TABLE[i] in b" ") for i in range(256)], dtype=np.uint8)
_VALUE = np.where(_KIND == 0, np.frombuffer(_TABLE, np.uint8).astype(np.uint64) + np.uint64(1), np.uint64(0))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    return tuple(np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(n - 1, x, np.uint64)])) for x in (int(_POWER), pow(int(_POWER), -1, 1 << 64)))


_kept_powers = cache(_powers)


def hashed(text: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, bool]:
    """(hash of each word, place of its first byte, whether a break is before it, whether one is behind the last) of a text."""
    flat = np.frombuffer(text, np.uint8)
    kind, inside = _KIND[flat], np.zeros(len(flat) + 2, bool)
    np.equal(kind, 0, out=inside[1:-1])
    edge = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edge[::2], edge[1::2]
    n = 1 << max(len(flat).bit_length(), SLICE.bit_length())
    forth, back = (_kept_powers if n <= 4 * SLICE else _powers)(n)
    sums = np.zeros(len(flat) + 1, np.uint64)
    np.cumsum(_VALUE[flat] * forth[: len(flat)], out=sums[1:])
    breaks = np.cumsum(kind == 2, dtype=np.int64)
    before = breaks[starts]
    own = mix((sums[ends] - sums[starts]) * back[starts] + (ends - starts).astype(np.uint64) * _A)
    return own, starts, np.diff(before, prepend=0) > 0, len(flat) > 0 and bool(breaks[-1] > (before[-1] if len(before) else 0))


@cache
def _salt(lang: str) -> np.uint64:
    return np.uint64(int.from_bytes(hashlib.blake2b(lang.encode(), digest_size=8).digest(), "little"))


def keys_of(own: np.ndarray, starts: np.ndarray, langs: list[str], firsts: list[int]) -> np.ndarray:
    """Keys of words by their hashes; texts of these languages begin at the bytes `firsts`."""
    n = np.diff(np.append(np.searchsorted(starts, firsts), len(starts)))
    return mix(own + np.repeat(np.array([_salt(x) for x in langs], np.uint64), n))


def _keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, id) of (lang, word, id)."""
    for b in batches:
        for i in range(0, b.num_rows, 10_000):
            langs, words, ids = (b.column(k)[i : i + 10_000] for k in range(3))
            words = words.to_pylist()
            firsts = np.cumsum([0, *(len(w) + 1 for w in words[:-1])])
            own, starts, _, _ = hashed(_BREAK.join(words))
            yield pa.RecordBatch.from_arrays([pa.array(keys_of(own, starts, langs.to_pylist(), firsts).view(np.int64)), ids], ["key", "id"])


def keyed(words: DataFrame) -> DataFrame:
    """(key, id) of words (lang, word, id)."""
    return words.select("lang", "word", "id").mapInArrow(_keyed, "key long, id long")


def _encoded(keys: np.ndarray, ids: np.ndarray) -> Callable:
    """Texts (lang, text) to pieces of the ids of their words by sorted keys; 0 for other words, breaks and the ends of texts."""

    def block(pieces: list[bytes], langs: list[str], firsts: list[int]) -> np.ndarray:
        own, starts, broken, behind = hashed(b"".join(pieces))
        key = keys_of(own, starts, langs, firsts)
        at = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
        out = np.zeros(len(key) + np.count_nonzero(broken) + behind, np.uint64)
        out[np.arange(len(key)) + np.cumsum(broken)] = np.where(keys[at] == key, ids[at], 0)
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
        pieces, langs, firsts, size = [], [], [], 0
        for b in batches:
            for lang, text in zip(b.column("lang").to_pylist(), b.column("text")):
                for some in slices(text.as_py()):
                    pieces.append(some)
                    langs.append(lang)
                    firsts.append(size)
                    size += len(some)
                    if size >= SLICE:
                        yield block(pieces, langs, firsts)
                        pieces, langs, firsts, size = [], [], [], 0
                pieces.append(_BREAK)
                langs.append(lang)
                firsts.append(size)
                size += 1
        if pieces:
            yield block(pieces, langs, firsts)

    return run if len(keys) else lambda batches: iter(())


def _listed(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
    """Texts (text, words, ids), each with the ids of its words, to pieces as of _encoded()."""
    for b in batches:
        for i in range(b.num_rows):
            own = dict(zip(b.column("words")[i].as_py() or [], b.column("ids")[i].as_py() or []))
            for some in tokens(b.column("text")[i].as_py()):
                yield np.fromiter((own.get(w, 0) for w in some), np.uint64, len(some))
            yield np.zeros(1, np.uint64)


# -- packed phrases and their permutation


def _mixed(x: np.ndarray, r: int, mask: np.uint64) -> np.ndarray:
    x = (x + _KEYS[r]) * _KEYS[(r + 1) % 4]
    x = (x ^ (x >> np.uint64(29))) * _KEYS[(r + 2) % 4]
    return (x ^ (x >> np.uint64(32))) & mask


def permute(high: np.ndarray, low: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """A permutation of pairs of numbers below 2^(2 bits)."""
    mask = np.uint64((1 << 2 * bits) - 1)
    for r in range(4):
        high, low = low, high ^ _mixed(low, r, mask)
    return high, low


def restore(high: np.ndarray, low: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """permute() backwards."""
    mask = np.uint64((1 << 2 * bits) - 1)
    for r in reversed(range(4)):
        high, low = low ^ _mixed(high, r, mask), high
    return high, low


def packed(ids: np.ndarray, stop: int, bits: int, least: int = 2, most: int = LONGEST) -> tuple[np.ndarray, np.ndarray]:
    """All phrases of `least` to `most` ids that begin before `stop`; id 0 breaks them."""
    b = np.uint64(bits)
    a = np.concatenate([ids, np.zeros(LONGEST, np.uint64)])
    w = [a[i : i + stop] for i in range(LONGEST)]
    high, low = [], []
    ok = w[0] > 0
    for n in range(2, most + 1):
        ok = ok & (w[n - 1] > 0)
        if n < least:
            continue
        high.append((w[0][ok] << b) | w[1][ok])
        low.append(((w[2][ok] << b) if n > 2 else np.zeros(ok.sum(), np.uint64)) | (w[3][ok] if n > 3 else np.uint64(0)))
    return np.concatenate(high), np.concatenate(low)


def unpacked(high: np.ndarray, low: np.ndarray, bits: int) -> list[np.ndarray]:
    """The ids of phrases, 0 behind their ends."""
    b, mask = np.uint64(bits), np.uint64((1 << bits) - 1)
    return [high >> b, high & mask, low >> b, low & mask]


def narrow(m: int, bits: int) -> int:
    """The `bits` that a pair of halves has which holds phrases of m ids alone."""
    return -(-m * bits // LONGEST)


def narrowed(high: np.ndarray, low: np.ndarray, m: int, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Packed phrases of m ids in halves of 2 x narrow() bits."""
    b, half, mask = np.uint64(bits), 2 * narrow(m, bits), np.uint64((1 << bits) - 1)
    if m == 2:
        return high >> b, high & mask
    if m == 3:
        rest = ((high & mask) << b) | (low >> b)  # the last two ids
        return ((high >> b) << np.uint64(2 * bits - half)) | (rest >> np.uint64(half)), rest & np.uint64((1 << half) - 1)
    return high, low


def widened(high: np.ndarray, low: np.ndarray, m: int, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """narrowed() backwards."""
    b, half, mask = np.uint64(bits), 2 * narrow(m, bits), np.uint64((1 << bits) - 1)
    if m == 2:
        return (high << b) | low, np.zeros(len(low), np.uint64)
    if m == 3:
        more = np.uint64(2 * bits - half)
        rest = ((high & np.uint64((1 << int(more)) - 1)) << np.uint64(half)) | low
        return ((high >> more) << b) | (rest >> b), (rest & mask) << b
    return high, low


def summed(high: np.ndarray, low: np.ndarray, n: np.ndarray | None, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct pairs in order with their sums."""
    if not len(high):
        return high, low, np.zeros(0, np.int64)
    if 4 * bits <= 64:
        key = (high << np.uint64(2 * bits)) | low
        if n is None:
            key.sort()
        else:
            order = key.argsort(kind="stable")  # merges runs that are in order
            key, n = key[order], n[order]
        at = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        high, low = key[at] >> np.uint64(2 * bits), key[at] & np.uint64((1 << 2 * bits) - 1)
    else:
        first = (high << np.uint64(64 - 2 * bits)) | (low >> np.uint64(4 * bits - 64))
        order = first.argsort(kind=None if n is None else "stable")
        same = first[order]
        same = np.flatnonzero(same[1:] == same[:-1])
        if (low[order[same]] > low[order[same + 1]]).any():  # pairs that differ in their last bits alone
            order = np.lexsort((low, high))
        high, low, n = high[order], low[order], None if n is None else n[order]
        at = np.flatnonzero(np.concatenate([[True], (high[1:] != high[:-1]) | (low[1:] != low[:-1])]))
        high, low = high[at], low[at]
    return high, low, np.diff(np.append(at, len(key if 4 * bits <= 64 else order))) if n is None else np.add.reduceat(n, at)


# -- filters


def _bytes_of(x: np.ndarray, width: int) -> bytes:
    return x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].tobytes()


def _numbers(data: bytes, width: int) -> np.ndarray:
    out = np.zeros((len(data) // width if width else 0, 8), np.uint8)
    out[:, :width] = np.frombuffer(data, np.uint8).reshape(-1, width)
    return out.view("<u8")[:, 0].astype(np.uint64)


def stored(high: np.ndarray, low: np.ndarray, n: np.ndarray, bits: int, ranges: int) -> bytes:
    """A filter of sorted distinct pairs of one range; the first `ranges` bits are those of the range and are left out."""
    half = 2 * bits
    q = min(max(1, len(n).bit_length() - 1), half - ranges)  # bits of the quotient
    rest = half - ranges - q
    joint = rest + half <= 64
    slot = (high >> np.uint64(rest)) & np.uint64((1 << q) - 1)
    ends = np.append(slot[1:] != slot[:-1], True)
    occupied = np.zeros(1 << q, bool)
    occupied[slot.astype(np.int64)] = True
    wide = n >= 255
    head = np.array([len(n), q, wide.sum()], "<i4").tobytes()
    remainder = high & np.uint64((1 << rest) - 1)
    return b"".join([
        head, np.packbits(occupied).tobytes(), np.packbits(ends).tobytes(),
        *([_bytes_of((remainder << np.uint64(half)) | low, -(-(rest + half) // 8))] if joint else [_bytes_of(remainder, -(-rest // 8)), _bytes_of(low, -(-half // 8))]),
        np.minimum(n, 255).astype(np.uint8).tobytes(), n[wide].astype("<i8").tobytes(),
    ])


def loaded(data: bytes, bits: int, ranges: int, part: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """stored() backwards."""
    m, q, wide = np.frombuffer(data, "<i4", 3)
    half, at = 2 * bits, 12
    rest = half - ranges - int(q)

    def cut(size: int) -> bytes:
        nonlocal at
        at += size
        return data[at - size : at]

    occupied = np.unpackbits(np.frombuffer(cut(-(-(1 << int(q)) // 8)), np.uint8), count=1 << int(q))
    ends = np.unpackbits(np.frombuffer(cut(-(-int(m) // 8)), np.uint8), count=int(m))
    slot = np.flatnonzero(occupied)[np.cumsum(ends) - ends].astype(np.uint64)
    if rest + half <= 64:
        width = -(-(rest + half) // 8)
        both = _numbers(cut(int(m) * width), width)
        remainder, low = both >> np.uint64(half), both & np.uint64((1 << half) - 1)
    else:
        width = -(-rest // 8)
        remainder = _numbers(cut(int(m) * width), width) if width else np.zeros(m, np.uint64)
        low = _numbers(cut(int(m) * -(-half // 8)), -(-half // 8))
    n = np.frombuffer(cut(int(m)), np.uint8).astype(np.int64)
    n[n == 255] = np.frombuffer(cut(8 * int(wide)), "<i8")
    prefix = np.uint64(part << (half - ranges)) if ranges else np.uint64(0)
    return prefix | (slot << np.uint64(rest)) | remainder, low, n


def _cuts(ranges: int, m: int, bits: int) -> int:
    """Bits of the ranges of phrases of m ids."""
    return min(ranges, 2 * narrow(m, bits) - 1)


def _filters(encoded: Callable, bits: int, ranges: int) -> Callable:
    """(part, filter): the counts of the phrases of some words, cut by length and range. encoded: to pieces of ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        buffer, size = [], 0

        def flush(last: bool) -> Iterator[pa.RecordBatch]:
            nonlocal buffer, size
            ids = np.concatenate(buffer)
            stop = len(ids) if last else max(0, len(ids) - LONGEST + 1)  # later ones begin before what comes next
            buffer, size = [ids[stop:]], len(ids) - stop
            for m in range(2, LONGEST + 1):
                own, cut = narrow(m, bits), _cuts(ranges, m, bits)
                high, low, n = summed(*permute(*narrowed(*packed(ids, stop, bits, m, m), m, bits), own), None, own)
                part = (high >> np.uint64(2 * own - cut)).astype(np.int64)
                cuts = np.searchsorted(part, np.arange((1 << cut) + 1)) if len(n) * 4 > 1 << cut else np.append(np.flatnonzero(np.diff(part, prepend=-1)), len(n))
                some = [(int(part[i]) * (LONGEST + 1) + m, stored(high[i:j], low[i:j], n[i:j], own, cut)) for i, j in zip(cuts, cuts[1:]) if j > i]
                for k in range(0, len(some), 256):
                    yield pa.RecordBatch.from_arrays([pa.array([p for p, _ in some[k : k + 256]], pa.int64()), pa.array([f for _, f in some[k : k + 256]], pa.binary())], ["part", "filter"])

        for ids in encoded(batches):
            buffer.append(ids)
            size += len(ids)
            if size >= BUFFER:
                yield from flush(False)
        if size:
            yield from flush(True)

    return run


def _merged(bits: int, ranges: int, least: int) -> Callable:
    """Filters, in the order of their parts, to the phrases (w1 to w4, f) of each part that occur often enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, m, own, held, entries = None, 2, 0, [], 0

        def merge() -> None:
            nonlocal held, entries
            held = [summed(*(np.concatenate(x) for x in zip(*held)), own)]
            entries = len(held[0][2])

        def out() -> pa.RecordBatch:
            merge()
            high, low, n = held[0]
            ok = n >= least
            ids = unpacked(*widened(*restore(high[ok], low[ok], own), m, bits), bits)
            return pa.RecordBatch.from_arrays([*(pa.array(x.astype(np.int64)) for x in ids), pa.array(n[ok])], ["w1", "w2", "w3", "w4", "f"])

        for b in batches:
            for part, data in zip(b.column("part").to_pylist(), b.column("filter")):
                if part != now and held:
                    yield out()
                    held, entries = [], 0
                now, m = part, part % (LONGEST + 1)
                own = narrow(m, bits)
                held.append(loaded(data.as_py(), own, _cuts(ranges, m, bits), part // (LONGEST + 1)))
                entries += len(held[-1][2])
                if entries > 4 * len(held[0][2]) + 4 * RANGE:
                    merge()
        if held:
            yield out()

    return run


# -- phrases


def _with_ids(docs: DataFrame, words: DataFrame) -> DataFrame:
    """(text, words, ids): each text with the ids of its words, by a join; for dictionaries too large to send to all tasks, and equal keys."""

    def distinct(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                seen = set()
                for some in tokens(b.column("text")[i].as_py()):
                    seen.update(some)
                seen.discard(_BREAK)
                if seen:
                    yield pa.RecordBatch.from_arrays([pa.array([b.column("row")[i].as_py()] * len(seen), pa.int64()), pa.array([b.column("lang")[i].as_py()] * len(seen), pa.string()), pa.array(list(seen), pa.binary())], ["row", "lang", "word"])

    kept = written(docs.withColumn("row", F.monotonically_increasing_id()), "texts")
    met = kept.mapInArrow(distinct, "row long, lang string, word binary").join(words.select("lang", "word", "id"), ["lang", "word"])
    lists = met.groupBy("row").agg(F.collect_list("word").alias("words"), F.collect_list("id").alias("ids"))  # the words of one text
    return kept.join(lists, "row").select("text", "words", "ids")


def phrase_counts(docs: DataFrame, counts: DataFrame, words: DataFrame, total: int, least: int = LEAST, words_most: int = WORDS_MOST, entries: int = RANGE) -> DataFrame:
    """(w1, w2, w3, w4, f): phrases of 2 to 4 words by ids, 0 behind the end, that occur `least` times or more. docs: (lang,
    text) in bytes; counts: word_counts(); words: numbered(); total: the number of all words."""
    n = words.count()
    bits = max(4, int(n).bit_length())
    ranges = max(0, (total // entries).bit_length())
    fits = n <= words_most and keyed(counts.withColumn("id", F.lit(0).cast("bigint"))).groupBy("key").count().filter("count > 1").isEmpty()
    if fits:
        got = keyed(words).toArrow()
        keys, ids = got["key"].to_numpy().view(np.uint64), got["id"].to_numpy().astype(np.uint32)
        order = keys.argsort()
        filters = docs.mapInArrow(_filters(_encoded(keys[order], ids[order]), bits, ranges), "part long, filter binary")
    else:
        filters = _with_ids(docs, words).mapInArrow(_filters(_listed, bits, ranges), "part long, filter binary")
    return filters.repartition("part").sortWithinPartitions("part").mapInArrow(_merged(bits, ranges, least), "w1 long, w2 long, w3 long, w4 long, f long")


def _part(ids: list[Column]) -> Column:
    """A key of up to LONGEST ids."""
    return F.struct(*[(ids[i] if i < len(ids) else F.lit(0).cast("bigint")).alias(f"w{i + 1}") for i in range(LONGEST)])


def collocations(df: DataFrame, lang_col: str = "lang", text_col: str = "text", least: int = LEAST, top: int = TOP, cover: int = COVER, **how) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the `top` best phrases of each language. how: see phrase_counts()."""
    docs = df.select(F.coalesce(F.col(lang_col), F.lit("und")).alias("lang"), F.encode(F.coalesce(F.col(text_col), F.lit("")), "UTF-8").alias("text"))
    counts = written(word_counts(docs), "counts")
    langs = counts.groupBy("lang").agg(F.sum("n").alias("n"))
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    words = numbered(counts.filter(F.col("n") >= least))
    grams = written(phrase_counts(docs, counts, words, total, least, **how), "phrases")
    w = [F.col(f"w{i + 1}") for i in range(LONGEST)]
    length = 2 + (F.col("w3") > 0).cast("int") + (F.col("w4") > 0).cast("int")
    grams = grams.select(F.struct(*w).alias("p"), "f", length.alias("m"), *w)
    single = words.select(_part([F.col("id")]).alias("p"), F.col("n").alias("f"))
    known = grams.select("p", "f").unionByName(single)
    wide = lambda c: F.col(c).cast("decimal(20,0)")

    # every cut of every phrase, its two parts by their counts
    cuts = F.array(*[F.when(F.col("m") == m, F.struct(F.lit(k).alias("k"), _part(w[:k]).alias("left"), _part(w[k:m]).alias("right"))) for m in range(2, LONGEST + 1) for k in range(1, m)])
    cut = grams.select("p", "f", F.explode(F.filter(cuts, lambda x: x.isNotNull())).alias("c")).select("p", "f", "c.*")
    cut = cut.join(known.select(F.col("p").alias("left"), F.col("f").alias("l")), "left").join(known.select(F.col("p").alias("right"), F.col("f").alias("r")), "right")
    score = F.expr("2000000bd * cast(f as decimal(19,0)) div (cast(l as decimal(20,0)) + r)")
    scored = cut.withColumn("score", score).groupBy("p").agg(F.first("f").alias("a"), F.min(F.struct("score", "k", "l", "r")).alias("b"))

    # phrases inside longer ones
    inner = F.array(*[F.when(F.col("m") == m, _part(w[i : i + k])) for m in range(3, LONGEST + 1) for k in range(2, m) for i in range(m - k + 1)])
    held = grams.filter("m > 2").select("f", F.explode(F.array_distinct(F.filter(inner, lambda x: x.isNotNull()))).alias("p")).groupBy("p").agg(F.max("f").alias("longer"))
    kept = scored.join(held, "p", "left").filter(F.coalesce(wide("longer") * 100 < wide("a") * cover, F.lit(True)))

    # the words of the phrases
    said = kept.select("p", "a", "b.score", "b.l", "b.r", F.posexplode(F.array("p.w1", "p.w2", "p.w3", "p.w4")).alias("at", "id")).filter("id > 0")
    spelled = said.join(words.select("id", "lang", F.decode("word", "UTF-8").alias("word")), "id").groupBy("p").agg(
        F.first("lang").alias("lang"), F.first("a").alias("a"), F.first("score").alias("score"), F.first("l").alias("l"), F.first("r").alias("r"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "word"))), lambda x: x["word"]), " ").alias("phrase"),
    )
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase"))
    best = spelled.withColumn("rank", rank.cast("bigint")).filter(F.col("rank") <= top)
    return best.join(langs, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op13(spark, sf_dir: str) -> DataFrame:
    """The 2,000 best collocations of each language of the documents."""
    return collocations(table(spark, sf_dir, "documents").select("lang", "text"))


ORACLE = r"""WITH d AS (SELECT row_number() OVER () AS d, coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
w AS (SELECT lang, list_filter(string_split_regex(unnest(string_split_regex(t, '[.,;:!?\x0A-\x0D]')), '[\x20\x09]+'), lambda x: x <> '') AS w FROM d),
g AS (SELECT lang, m, array_to_string(w[i : i + m - 1], ' ') AS phrase FROM (SELECT lang, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM (SELECT lang, w, unnest([1, 2, 3, 4]) AS m FROM w) q WHERE len(w) >= m) q),
f AS (SELECT lang, m, phrase, count(*) AS f FROM g GROUP BY ALL HAVING count(*) >= 30), n AS (SELECT lang, sum(len(w))::BIGINT AS n FROM w GROUP BY lang),
c AS (SELECT *, string_split(phrase, ' ') AS s FROM f WHERE m > 1),
k AS (SELECT lang, phrase, m, f, s, unnest(range(1, m)) AS k FROM c),
x AS (SELECT k.lang, k.phrase, k.f AS a, k.k, l.f AS l, r.f AS r, (2000000::HUGEINT * k.f // (l.f + r.f))::BIGINT AS score FROM k JOIN f l ON l.lang = k.lang AND l.phrase = array_to_string(s[: k.k], ' ') JOIN f r ON r.lang = k.lang AND r.phrase = array_to_string(s[k.k + 1 :], ' ')),
y AS (SELECT lang, phrase, any_value(a) AS a, arg_min(l, (score, k)) AS l, arg_min(r, (score, k)) AS r, min(score) AS score FROM x GROUP BY ALL),
i AS (SELECT lang, array_to_string(s[i : i + j - 1], ' ') AS phrase, max(f) AS longer FROM (SELECT *, unnest(range(1, m - j + 2)) AS i FROM (SELECT *, unnest(range(2, m)) AS j FROM c WHERE m > 2) q) q GROUP BY ALL),
z AS (SELECT y.*, row_number() OVER (PARTITION BY y.lang ORDER BY score DESC, a DESC, y.phrase) AS rank FROM y LEFT JOIN i ON i.lang = y.lang AND i.phrase = y.phrase WHERE longer IS NULL OR 100 * longer < 80 * a)
SELECT z.lang, rank, phrase, a, l, r, n, score FROM z JOIN n ON n.lang = z.lang WHERE rank <= 2000"""
