"""Phrases against brute force, filters and permutations both ways, and dictionaries that are joined."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa

from countryrank.llm import phrases

SCHEMA = "lang string, text string"


def documents(seed=2, n=300):
    rnd = random.Random(seed)
    words = [f"w{i}" for i in range(12)] + ["Ab", "aB", "é", "日本", "x\x1cy", "\x85"]
    rows = []
    for _ in range(n):
        text = ""
        for _ in range(rnd.randint(0, 60)):
            text += rnd.choice(words) if rnd.random() < 0.7 else "alpha beta gamma delta" if rnd.random() < 0.5 else "beta gamma"
            text += rnd.choice([" ", " ", " ", "\t", ", ", "  ", ".\n", "!"])
        rows.append((rnd.choice(["en", "en", "de", None]), text))
    return rows + [("en", None), (None, ""), ("fr", "  . , "), rows[0], rows[0]] + [("en", "same same same same same same")] * 9


def brute(rows, least=30, top=2000):
    f, n = defaultdict(Counter), Counter()
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    for lang, text in rows:
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(low)):
            w = [x for x in re.split("[\x20\x09]+", piece) if x]
            n[lang or "und"] += len(w)
            for m in range(1, 5):
                for i in range(len(w) - m + 1):
                    f[lang or "und"][tuple(w[i : i + m])] += 1
    out = []
    for lang, c in f.items():
        good = {p: a for p, a in c.items() if a >= least}
        found = []
        for p, a in good.items():
            if len(p) < 2:
                continue
            longer = [good[q] for q in good if len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q)))]
            if any(100 * x >= 80 * a for x in longer):
                continue
            cuts = [(2000000 * a // (c[p[:k]] + c[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            found.append((-score, -a, " ".join(p).encode(), c[p[:k]], c[p[k:]]))
        out += [(lang, r + 1, p.decode(), -a, x, y, n[lang], -s) for r, (s, a, p, x, y) in enumerate(sorted(found)[:top])]
    return sorted(out)


def mined(spark, rows, **how):
    return sorted(map(tuple, phrases.collocations(spark.createDataFrame(rows, SCHEMA).repartition(3), **how).collect()))


def test_phrases_equal_brute_force(spark):
    rows = documents()
    want = brute(rows)
    assert len(want) > 30
    assert mined(spark, rows) == want
    assert mined(spark, rows, words_most=0) == want  # ids by a join
    assert mined(spark, rows, entries=20) == want  # many ranges
    assert mined(spark, rows, top=5) == brute(rows, top=5)


def test_long_text(spark):
    text = "long text of words. " * 90_000
    rows = [("en", text), ("en", "x" * 3_000_000 + " long text")]
    assert mined(spark, rows) == brute(rows)


def test_no_phrases(spark):
    assert mined(spark, []) == [] == mined(spark, [("en", "a b c"), (None, None)])


def test_permutation_and_packing():
    rnd = np.random.default_rng(1)
    for bits in (4, 15, 16, 17, 24, 31):
        ids = rnd.integers(0, 1 << bits, 500).astype(np.uint64) * (rnd.random(500) < 0.9)
        high, low = phrases.packed(ids, len(ids), bits)
        p = phrases.permute(high, low, bits)
        assert max(int(x.max()) for x in p) < 1 << 2 * bits
        assert all((a == b).all() for a, b in zip(phrases.restore(*p, bits), (high, low)))
        back = {tuple(int(x) for x in t if x) for t in zip(*phrases.unpacked(high, low, bits))}
        x = [int(i) for i in ids]
        assert back == {tuple(x[i : i + n]) for n in (2, 3, 4) for i in range(len(x) - n + 1) if all(x[i : i + n])}


def test_filters_are_lossless():
    rnd = np.random.default_rng(2)
    for bits, ranges in ((5, 0), (5, 3), (16, 0), (16, 6), (20, 4), (4, 7)):
        for m in (1, 2, 40, 3000):
            half = 1 << 2 * bits
            high, low = (rnd.integers(0, half, m).astype(np.uint64) for _ in range(2))
            part = 0
            if ranges:
                part = int(rnd.integers(0, 1 << ranges))
                high = (high >> np.uint64(ranges)) | np.uint64(part << (2 * bits - ranges))
            high, low, n = phrases.summed(high, low, None, bits)
            n = n * rnd.choice([1, 254, 255, 256, 10**12], len(n))
            got = phrases.loaded(phrases.stored(high, low, n, bits, ranges), bits, ranges, part)
            assert all((a == b).all() for a, b in zip(got, (high, low, n)))


def test_large_dictionary_goes_to_tasks(spark, monkeypatch):
    """300,000 words are found by their keys; from 262,144 on, all texts and their words were written and joined before."""
    monkeypatch.setattr(phrases, "_with_ids", None)
    rnd = random.Random(3)
    words = 2 * [f"word{i}" for i in range(270_000)] + ["alpha beta gamma"] * 50
    rnd.shuffle(words)
    rows = [("en", " ".join(words[i : i + 500]) + ".") for i in range(0, len(words), 500)]
    got = mined(spark, rows, least=2)
    assert got == brute(rows, least=2)
    assert ("en", "alpha beta gamma", 50) in {(r[0], r[2], r[3]) for r in got}


def test_encoded_texts_equal_their_tokens(monkeypatch):
    """Ids by keys of blocks of texts equal those by word, however the texts are cut."""
    rnd = random.Random(4)
    parts = ["a", "B", "é", "日", "xyz", "\x1c", "\x85", "0", " ", " ", "  ", "\t", ".", ", ", "\n", "\x0b", "!?"]
    rows = [(rnd.choice(["en", "de"]), "".join(rnd.choice(parts) for _ in range(rnd.choice([0, 1, 2, 50, 400]))).encode() or None) for _ in range(300)]
    words = sorted({(lang, w) for lang, text in rows for some in phrases.tokens(text) for w in some if w != b"."})
    words = words[::2]
    ids = {w: i + 1 for i, w in enumerate(words)}
    table = pa.RecordBatch.from_arrays([pa.array([x for x, _ in words]), pa.array([w for _, w in words], pa.binary()), pa.array(list(ids.values()))], ["lang", "word", "id"])
    keyed = next(phrases._keyed([table]))
    keys = keyed.column(0).to_numpy().view(np.uint64)
    order = keys.argsort()
    batch = pa.RecordBatch.from_arrays([pa.array([x for x, _ in rows]), pa.array([t for _, t in rows], pa.binary())], ["lang", "text"])

    def runs(numbers):
        return [r for r in " ".join("." if not x else str(x) for x in numbers).split(".") if r.strip()]

    want = [ids.get((lang, w), 0) for lang, text in rows for some in phrases.tokens(text) for w in [*some, b"."]]
    for size in (5, 300, 1 << 17):
        monkeypatch.setattr(phrases, "SLICE", size)
        got = np.concatenate(list(phrases._encoded(keys[order], keyed.column(1).to_numpy()[order])([batch.slice(0, 100), batch.slice(100)])))
        assert [x.split() for x in runs(got.tolist())] == [x.split() for x in runs(want)]


def test_words_of_one_key(spark):
    """Two words whose hashes are equal, whatever the factor of the hash, are told apart."""
    bits = [bin(i).count("1") % 2 for i in range(1024)]
    one, two = ("".join(x[b] for b in bits) for x in ("ab", "ba"))
    assert len(set(phrases.hashed(f"{one} {two} a b".encode())[0].tolist())) == 3
    rows = [("en", f"{one} x. {two} y. {two} x")] * 40 + [("en", f"{one} y")]
    assert mined(spark, rows) == brute(rows)


def test_phrases_of_one_length_take_fewer_bytes():
    rnd = np.random.default_rng(5)
    for bits in (4, 5, 15, 18, 20, 23, 31):
        ids = rnd.integers(0, 1 << bits, 4000).astype(np.uint64)
        size = []
        for m in (2, 3, 4):
            high, low = phrases.packed(ids, len(ids), bits, m, m)
            own = phrases.narrow(m, bits)
            there = phrases.narrowed(high, low, m, bits)
            assert max(int(x.max()) for x in there) < 1 << 2 * own
            assert all((a == b).all() for a, b in zip(phrases.widened(*there, m, bits), (high, low)))
            some = phrases.summed(*phrases.permute(*there, own), None, own)
            keys = [(int(a) << 2 * own) | int(b) for a, b in zip(*some[:2])]
            assert keys == sorted(set(keys))
            size.append(len(phrases.stored(*some, own, 0)) / len(some[2]))
        if bits == 18:
            assert size[0] < 6 and size[1] < 8 and size[2] < 11  # 9 to 10 each before


def test_pairs_that_differ_in_their_last_bits():
    """Pairs of halves of 40 bits are in order even if their first 64 bits agree."""
    high, low = np.array([7, 7, 7, 3, 7], np.uint64), np.array([9, 4, 9, 1, 5], np.uint64)
    for n in (None, np.ones(5, np.int64)):
        assert [x.tolist() for x in phrases.summed(high, low, n, 20)] == [[3, 7, 7, 7], [1, 4, 5, 9], [1, 1, 1, 2]]
