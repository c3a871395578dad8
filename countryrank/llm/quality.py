"""Quality rules as a bitmask ledger.

Every rule is evaluated once per document. The ledger keeps the measurements and one bit per failed rule, and is stored;
policies are masks over those bits, so a new policy version or an ablation is a bitwise pass over the stored ledger, not
over texts. A ledger lies in the folder of the version of the rules that made it, so bits are never read by other rules.

Nulls and empty texts count as texts without words and fail the length rule. Repeated rows stay separate rows.
Only the identifying column and the text are read; other columns, whatever their names, are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import SPACE, let, shared_dir, table, words

#: bit -> (name, condition on the measurements that fails a document).
RULES = {
    0: ("few_words", "n_words < 50"),
    1: ("repeated_windows", "100 * n_repeat_words > 50 * n_words"),
    2: ("symbols", "4 * n_symbols > n_words"),
    3: ("repeated_lines", "5 * n_dup_lines > 2 * n_lines"),
    4: ("long_words", "word_chars > 20 * n_words"),
    5: ("short_words", "word_chars < 2 * n_words"),
    6: ("few_letters", "2 * n_letters < word_chars"),
    7: ("digits", "5 * n_digits > 2 * word_chars"),
    8: ("upper_case", "2 * n_upper > n_letters"),
    9: ("bullets", "10 * n_bullets > 9 * n_lines"),
    10: ("cut_lines", "10 * n_cut_lines > 3 * n_lines"),
    11: ("one_word", "4 * n_top_word > 3 * n_words"),
}
#: Number of this set of rules: a changed rule needs a new one, and ledgers made by it.
RULES_VERSION = 2
BASE_MASK = 0b000011
#: (policy, version) -> mask of the rules that reject a document.
POLICIES = {
    ("base", 1): BASE_MASK,
    ("default", 1): 0b111111,
    ("default", 2): 0b111111111111,
    ("lenient", 1): 0b000111,
    ("lenient", 2): 0b100001000111,
}
MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_letters", "n_digits", "n_upper", "n_bullets", "n_cut_lines", "n_top_word"]


def _repeat_words(w: Column) -> Column:
    """Words that lie in a 3-word window found at least twice in the text.

    Windows are sorted as (hash, position) packed in one long; only positions whose hash has a neighbour are then
    compared as strings, so the count is exact and costs n log n for any text.
    """
    n = F.size(w)
    shift = F.ceil(F.log2(n.cast("double"))).cast("int") + 1
    window = lambda i: F.concat_ws(" ", w[i], w[i + 1], w[i + 2])

    def packed(s: Column) -> Column:
        return F.sort_array(F.transform(F.sequence(F.lit(0), n - 3), lambda i: F.call_function("shiftleft", F.xxhash64(w[i], w[i + 1], w[i + 2]), s).bitwiseOR(i.cast("bigint"))))

    def beside(a: Column, key) -> Column:
        """Elements of a sorted array whose key equals that of a neighbour."""
        return F.filter(a, lambda x, j: F.coalesce(key(F.get(a, j - 1)) == key(x), F.lit(False)) | F.coalesce(key(F.get(a, j + 1)) == key(x), F.lit(False)))

    def covered(at: Column) -> Column:
        return F.aggregate(F.transform(at, lambda p, j: F.when(j == 0, F.lit(3)).otherwise(F.least(F.lit(3), p - F.get(at, j - 1)))), F.lit(0), lambda a, x: a + x)

    def count(s: Column) -> Column:
        place = lambda x: x.bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("bigint"), s) - 1).cast("int")
        top = lambda x: F.call_function("shiftright", x, s)

        def exact(found: Column) -> Column:
            strings = F.sort_array(F.transform(found, lambda x: F.struct(window(place(x)).alias("t"), place(x).alias("i"))))
            same = let(strings, lambda a: F.sort_array(F.transform(beside(a, lambda e: e["t"]), lambda e: e["i"])))
            return let(same, covered)

        return let(packed(s), lambda a: let(beside(a, top), lambda c: F.when(F.size(c) == 0, F.lit(0)).otherwise(exact(c))))

    return F.when(n < 4, F.lit(0)).otherwise(let(shift, count)).cast("bigint")


#: Lines that begin with a bullet, and lines that end in dots.
BULLET, CUT = "^[\\x20\\x09-\\x0D]*[-*\u2022]", "(?:\\.\\.\\.|\u2026)[\\x20\\x09-\\x0D]*$"


def _like(lines: Column, pattern: str) -> Column:
    return F.size(F.filter(lines, lambda x: F.rlike(x, F.lit(pattern)))).cast("bigint")


def _top_word(w: Column) -> Column:
    """Occurrences of the most frequent word: the longest run of equal words once they are sorted."""

    def longest(a: Column) -> Column:
        starts = F.filter(F.transform(a, lambda x, i: F.when(F.get(a, i - 1).eqNullSafe(x), F.lit(None)).otherwise(i)), lambda i: i.isNotNull())
        return let(starts, lambda s: F.array_max(F.transform(s, lambda p, j: F.coalesce(F.get(s, j + 1), F.size(a)) - p)))

    return F.when(F.size(w) == 0, F.lit(0)).otherwise(let(F.array_sort(w), longest)).cast("bigint")


def measure(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: the measurements that the rules use."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    lines = F.filter(F.split(text, "\n", -1), lambda x: F.rlike(x, F.lit("[^\\x20\\x09-\\x0D]")))
    out = df.select(
        F.col(id_col),
        let(words(text), lambda w: F.struct(F.size(w).cast("bigint").alias("n_words"), _repeat_words(w).alias("n_repeat_words"), _top_word(w).alias("n_top_word"))).alias("_w"),
        let(lines, lambda a: F.struct(
            F.size(a).cast("bigint").alias("n_lines"),
            (F.size(a) - F.size(F.array_distinct(a))).cast("bigint").alias("n_dup_lines"),
            _like(a, BULLET).alias("n_bullets"),
            _like(a, CUT).alias("n_cut_lines"),
        )).alias("_l"),
        F.length(F.regexp_replace(text, SPACE, "")).cast("bigint").alias("word_chars"),
        *[F.length(F.regexp_replace(text, f"[^{of}]+", "")).cast("bigint").alias(n) for n, of in (("n_symbols", "#*$%&|<>"), ("n_digits", "0-9"))],
        *[F.length(F.regexp_replace(text, f"\\P{{{of}}}+", "")).cast("bigint").alias(n) for n, of in (("n_letters", "L"), ("n_upper", "Lu"))],
    )
    return out.select(id_col, *[f"_w.{m}" if m in ("n_words", "n_repeat_words", "n_top_word") else f"_l.{m}" if "line" in m or "bullets" in m else m for m in MEASURES])


def ledger(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Measurements and fail_bits: bit b is set where rule b fails."""
    bits = F.lit(0).cast("bigint")
    for b, (_, fails) in RULES.items():
        bits = bits + F.when(F.expr(fails), F.lit(1 << b)).otherwise(F.lit(0)).cast("bigint")
    return measure(df, id_col, text_col).withColumn("fail_bits", bits)


def store(book: DataFrame, root: str) -> DataFrame:
    """The ledger, stored in the folder of its version of the rules below root and read again; a second run replaces it."""
    path = f"{root.rstrip('/')}/rules={RULES_VERSION}"
    book.write.mode("overwrite").parquet(path)
    return load(book.sparkSession, root)


def load(spark: SparkSession, root: str) -> DataFrame:
    """The ledger stored below root by the present version of the rules."""
    return spark.read.parquet(f"{root.rstrip('/')}/rules={RULES_VERSION}")


def apply_policy(book: DataFrame, policy: str = "default", version: int = 1) -> DataFrame:
    """The ledger with base_failed and kept under one version of a policy."""
    mask = POLICIES[policy, version]
    fails = lambda m: F.col("fail_bits").bitwiseAND(F.lit(m).cast("bigint")) != 0
    return book.withColumn("base_failed", fails(BASE_MASK)).withColumn("kept", ~fails(mask | BASE_MASK)).withColumn("policy_version", F.lit(f"{policy}/{version}"))


def ablations(book: DataFrame, policy: str = "default", version: int = 1) -> DataFrame:
    """Per rule of a policy: documents it fails, and documents that only it fails (kept again without the rule).

    Counts per distinct mask first, so at most 2**rules rows meet the list of rules.
    """
    mask = POLICIES[policy, version]
    masks = book.groupBy(F.col("fail_bits").bitwiseAND(F.lit(mask).cast("bigint")).alias("bits")).agg(F.count("*").alias("n"))
    used = [(b, name) for b, (name, _) in RULES.items() if mask >> b & 1]
    rules = F.explode(F.array(*[F.struct(F.lit(b).alias("bit"), F.lit(name).alias("rule")) for b, name in used]))
    one = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("r.bit"))
    hit = F.col("bits").bitwiseAND(one) != 0
    return masks.select("bits", "n", rules.alias("r")).groupBy("r.bit", "r.rule").agg(
        F.sum(F.when(hit, F.col("n")).otherwise(0)).alias("failed"),
        F.sum(F.when(F.col("bits") == one, F.col("n")).otherwise(0)).alias("failed_only_here"),
    )


def _booked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ledger of all documents, stored and read again."""
    return store(ledger(table(spark, sf_dir, "documents").select("doc_id", "text")), f"{shared_dir(spark)}/ledger")


def op2(spark, sf_dir: str) -> DataFrame:
    """Rules of all documents, kept under the default policy and kept_v2 under its second version, read off the stored ledger."""
    book = _booked(spark, sf_dir)
    second = F.col("fail_bits").bitwiseAND(F.lit(POLICIES["default", 2] | BASE_MASK).cast("bigint")) == 0
    return apply_policy(book).withColumn("kept_v2", second).select("doc_id", *MEASURES, "base_failed", "kept", "kept_v2", "fail_bits")


def ablation_report(spark, sf_dir: str) -> DataFrame:
    """Per version of a policy and rule: documents of the whole table that the rule fails, and those that it alone fails."""
    book = _booked(spark, sf_dir)
    out = None
    for policy, version in sorted(POLICIES):
        one = ablations(book, policy, version).select(F.lit(policy).alias("policy"), F.lit(version).alias("version"), "bit", "rule", "failed", "failed_only_here")
        out = one if out is None else out.unionByName(one)
    return out


_MEASURED = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w, [x FOR x IN string_split(text, chr(10)) IF regexp_matches(x, '[^\x20\x09-\x0D]')] AS lines FROM d),
tri AS (SELECT doc_id, unnest(range(1, len(w) - 1)) AS i, w FROM w WHERE len(w) >= 4),
tt AS (SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS t FROM tri),
dup AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, t) AS c FROM tt) WHERE c > 1),
rep AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM dup, (SELECT unnest([0, 1, 2]) AS k) GROUP BY doc_id),
m AS (SELECT w.doc_id, len(w)::BIGINT AS n_words, length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars,
  length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols, (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
  coalesce(rep.n, 0)::BIGINT AS n_repeat_words, len(lines)::BIGINT AS n_lines,
  length(regexp_replace(text, '\P{L}+', '', 'g'))::BIGINT AS n_letters, length(regexp_replace(text, '[^0-9]+', '', 'g'))::BIGINT AS n_digits,
  length(regexp_replace(text, '\P{Lu}+', '', 'g'))::BIGINT AS n_upper,
  len([x FOR x IN lines IF regexp_matches(x, '^[\x20\x09-\x0D]*[-*•]')])::BIGINT AS n_bullets,
  len([x FOR x IN lines IF regexp_matches(x, '(\.\.\.|…)[\x20\x09-\x0D]*$')])::BIGINT AS n_cut_lines,
  coalesce(list_max(map_values(list_histogram(w.w))), 0)::BIGINT AS n_top_word
  FROM w LEFT JOIN rep ON rep.doc_id = w.doc_id),
f AS (SELECT *, ((n_words < 50)::INT + 2 * (100 * n_repeat_words > 50 * n_words)::INT + 4 * (4 * n_symbols > n_words)::INT
  + 8 * (5 * n_dup_lines > 2 * n_lines)::INT + 16 * (word_chars > 20 * n_words)::INT + 32 * (word_chars < 2 * n_words)::INT
  + 64 * (2 * n_letters < word_chars)::INT + 128 * (5 * n_digits > 2 * word_chars)::INT + 256 * (2 * n_upper > n_letters)::INT
  + 512 * (10 * n_bullets > 9 * n_lines)::INT + 1024 * (10 * n_cut_lines > 3 * n_lines)::INT + 2048 * (4 * n_top_word > 3 * n_words)::INT)::BIGINT AS fail_bits FROM m)
"""

ORACLE = _MEASURED + r"""
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines, n_letters, n_digits, n_upper, n_bullets, n_cut_lines, n_top_word,
  (fail_bits & 3) <> 0 AS base_failed, (fail_bits & 63) = 0 AS kept, fail_bits = 0 AS kept_v2, fail_bits FROM f
"""

ABLATION_ORACLE = _MEASURED + r""",
p(policy, version, mask) AS (VALUES ('base', 1, 3), ('default', 1, 63), ('default', 2, 4095), ('lenient', 1, 7), ('lenient', 2, 2119)),
r(bit, rule) AS (VALUES (0, 'few_words'), (1, 'repeated_windows'), (2, 'symbols'), (3, 'repeated_lines'), (4, 'long_words'), (5, 'short_words'),
  (6, 'few_letters'), (7, 'digits'), (8, 'upper_case'), (9, 'bullets'), (10, 'cut_lines'), (11, 'one_word')),
b AS (SELECT fail_bits, count(*) AS n FROM f GROUP BY fail_bits)
SELECT policy, version, bit, rule, coalesce(sum(n) FILTER ((fail_bits >> bit) & 1 = 1), 0)::BIGINT AS failed,
  coalesce(sum(n) FILTER ((fail_bits & mask) = (1 << bit)), 0)::BIGINT AS failed_only_here
FROM p JOIN r ON (mask >> bit) & 1 = 1 CROSS JOIN b GROUP BY policy, version, bit, rule
"""
