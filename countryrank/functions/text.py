"""Text functions of columns. Only Unicode normalisation leaves the JVM, as one vectorised helper."""

from __future__ import annotations

import re
import unicodedata

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

SPACES = r"(?U)\s+"
#: Fixed value: the signs that separate the parts of a location.
SEPARATORS = "[,/|;]+"
GLOBE = "🌐"


_MARKS = re.compile("[\u0300-\u036f]")
#: Texts that are Python strings at once.
SLICE = 64


def _bare(text: str | None) -> str | None:
    return text if text is None or text.isascii() else unicodedata.normalize("NFC", _MARKS.sub("", unicodedata.normalize("NFKD", text)))


@F.arrow_udf(StringType())
def strip_marks(values: pa.Array) -> pa.Array:
    """NFKD, then without the marks U+0300 to U+036F, then NFC. Other marks, such as vowel signs, stay."""
    done = [pa.array([_bare(t) for t in values.slice(i, SLICE).to_pylist()], pa.string()) for i in range(0, len(values), SLICE)]
    return pa.concat_arrays(done or [pa.array([], pa.string())])


def fold_location(bare: Column) -> Column:
    """The part of normalize_location() behind Unicode normalisation: for text that strip_marks() has seen."""
    text = F.replace(F.lower(F.coalesce(bare, F.lit(""))), F.lit("&"), F.lit(" and "))
    return F.trim(F.regexp_replace(text, r"[^\p{L}\p{N}\p{M}]+", " "))


def normalize_location(text: Column) -> Column:
    """Letters, numbers and marks in lower case without accents, other runs as one space; null becomes empty."""
    return fold_location(strip_marks(F.coalesce(text, F.lit(""))))


def squeeze(text: Column) -> Column:
    """Runs of white space as one space, none at the ends."""
    return F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), SPACES, " "))


def clean_term(text: Column, longest: int = 120) -> Column:
    """A squeezed term, or null if it is empty or longer than `longest` characters."""
    return F.when(F.length(squeeze(text)).between(1, longest), squeeze(text))


def location_parts(raw: Column) -> Column:
    """The raw location, then its parts; not yet normalised, and empty ones are still there."""
    return F.concat(F.array(F.coalesce(raw, F.lit(""))), F.split(F.coalesce(raw, F.lit("")), SEPARATORS, -1))


def distinct_candidates(parts: Column) -> Column:
    """Ordered distinct non-empty candidates of an array of parts whose marks are stripped."""
    return F.array_distinct(F.filter(F.transform(parts, lambda x: fold_location(x)), lambda c: c != ""))


def location_candidates(raw: Column) -> Column:
    """Normalised location and parts, in order, distinct and non-empty.

    Stripping marks doesn't touch the separators, so it comes first and once.
    """
    return distinct_candidates(location_parts(strip_marks(F.coalesce(raw, F.lit("")))))


def contains_phrase(haystack: Column, phrase: Column) -> Column:
    """Whether a normalised text holds a normalised phrase as whole words; an empty phrase is held by none."""
    pad = lambda c: F.concat(F.lit(" "), c, F.lit(" "))
    return (phrase != "") & (F.instr(pad(haystack), pad(phrase)) > 0)


def name_variants(item: Column, fields: list[str], translations: Column | None = None) -> Column:
    """Distinct clean terms of the name fields of a struct and of its translations."""
    names = F.array(*[clean_term(item[f]) for f in fields])
    if translations is not None:
        more = F.coalesce(F.map_values(translations), F.array().cast("array<string>"))
        names = F.concat(names, F.transform(more, lambda x: clean_term(x)))
    return F.array_distinct(F.filter(names, lambda x: x.isNotNull()))


def admin_codes(fields: list[Column], country: Column, longest: int = 16) -> Column:
    """Distinct administrative codes, and what follows the country's prefix in them."""
    raw = F.filter(F.array(*[F.trim(F.coalesce(f.cast("string"), F.lit(""))) for f in fields]), lambda x: F.length(x).between(1, longest))
    prefix = F.concat(F.upper(F.coalesce(country, F.lit(""))), F.lit("-"))
    bare = lambda x: F.when(F.startswith(F.upper(x), prefix) & (F.length(x) > F.length(prefix)), F.substring(x, F.length(prefix) + 1, F.length(x)))
    both = F.flatten(F.transform(raw, lambda x: F.array(x, bare(x))))
    return F.array_distinct(F.filter(both, lambda x: x.isNotNull()))


def compound_terms(cities: Column, admins: Column, codes: Column) -> Column:
    """`city, admin` for every city name with every admin name and code."""
    pairs = F.flatten(F.transform(cities, lambda c: F.transform(F.concat(admins, codes), lambda a: F.concat_ws(", ", c, a))))
    return F.array_distinct(F.filter(F.transform(pairs, lambda x: clean_term(x)), lambda x: x.isNotNull()))


def split_alternates(names: Column) -> Column:
    """Clean distinct terms of a comma list."""
    return F.array_distinct(F.filter(F.transform(F.split(F.coalesce(names, F.lit("")), ","), lambda x: clean_term(x)), lambda x: x.isNotNull()))


def sort_terms(pairs: Column) -> Column:
    """Terms of an array of (norm, term) structs, in that order."""
    return F.transform(F.array_sort(pairs), lambda x: x["term"])


def slugify(name: Column) -> Column:
    """Lower-case letters a-z and digits, other runs as one dash, none at the ends."""
    bare = F.regexp_replace(F.lower(strip_marks(F.coalesce(name, F.lit("")))), "[^a-z0-9]+", "-")
    return F.btrim(bare, F.lit("-"))


def country_flag(code: Column) -> Column:
    """The flag of a two-letter code, else a globe."""
    letters = "".join(chr(65 + i) for i in range(26))
    signs = "".join(chr(127397 + 65 + i) for i in range(26))
    upper = F.upper(F.coalesce(code, F.lit("")))
    return F.when(F.rlike(upper, F.lit("^[A-Z]{2}$")), F.translate(upper, letters, signs)).otherwise(F.lit(GLOBE))


def thousands(n: Column) -> Column:
    """A count with thousands separators."""
    return F.format_number(F.coalesce(n, F.lit(0)), 0)


def display_date(text: Column) -> Column:
    """`03 Oct 2026, 05:02 UTC`; a text that is no date stays, and null is `unknown`."""
    return F.coalesce(F.date_format(F.try_to_timestamp(text), "dd MMM yyyy, HH:mm 'UTC'"), text, F.lit("unknown"))


def truncate_text(text: Column, longest: int) -> Column:
    """Squeezed text, cut with an ellipsis if it has more than `longest` characters."""
    flat = squeeze(text)
    return F.when(F.length(flat) > longest, F.concat(F.rtrim(F.substring(flat, 1, longest - 1)), F.lit("…"))).otherwise(flat)


def escape_html(text: Column) -> Column:
    out = F.coalesce(text, F.lit(""))
    for sign, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#39;")):
        out = F.replace(out, F.lit(sign), F.lit(entity))
    return out


def escape_markdown(text: Column) -> Column:
    return F.regexp_replace(F.replace(F.coalesce(text, F.lit("")), F.lit("|"), F.lit("\\|")), "\r?\n", " ")


def progress_percent(done: Column, total: Column) -> Column:
    """Whole percent, 100 at most; 0 of nothing."""
    return F.when(total > 0, F.least(F.lit(100), F.floor(done / total * 100)).cast("int")).otherwise(F.lit(0))


def trimmed(col: Column) -> Column:
    """col without white space of any kind at its ends."""
    return F.regexp_replace(col, "(?U)^[\\s\\uFEFF]+|[\\s\\uFEFF]+$", "")


def location_query(term: Column) -> Column:
    return F.concat(F.lit('location:"'), F.regexp_replace(term, r'(["\\])', r"\\$1"), F.lit('"'))


def star_range_query(low: Column, high: Column) -> Column:
    least = F.greatest(F.lit(1), F.floor(F.coalesce(low, F.lit(1)))).cast("bigint")
    most = F.greatest(least, F.floor(F.coalesce(high, least)).cast("bigint"))
    return F.concat(F.lit("stars:"), least, F.lit(".."), most, F.lit(" fork:false sort:stars-desc"))


def month_ranges(year: Column) -> Column:
    """First and last day of each month of a year, as text."""
    first = lambda m: F.make_date(year, m, F.lit(1))
    return F.transform(F.sequence(F.lit(1), F.lit(12)), lambda m: F.struct(m.alias("month"), F.date_format(first(m), "yyyy-MM-dd").alias("low"), F.date_format(F.last_day(first(m)), "yyyy-MM-dd").alias("high")))


def day_ranges(year: Column, month: Column) -> Column:
    """Each day of a month, as text."""
    first = F.make_date(year, month, F.lit(1))
    days = F.sequence(first, F.last_day(first))
    return F.transform(days, lambda d: F.struct(F.dayofmonth(d).alias("day"), F.date_format(d, "yyyy-MM-dd").alias("low"), F.date_format(d, "yyyy-MM-dd").alias("high")))


def content_hash(canonical: Column) -> Column:
    """sha256 of a country's canonical JSON: a struct whose fields are declared in the order of their names."""
    return F.sha2(F.to_json(canonical), 256)
