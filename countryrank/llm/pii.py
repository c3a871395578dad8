"""Format-preserving Feistel pseudonyms for personal data, in built-in functions only.

A value found in a text is validated (Luhn sum, IBAN remainder, calendar date, octets, area code), turned into digits of
mixed radix, and permuted by a keyed Feistel network over exactly those digits. The result has the same format and passes the
same validation, and equal values get equal pseudonyms in every document. inverse=True gives the values back to who has the key.

Kinds: e-mail names in any letters (those of the alphabets below are permuted within them, letters of other scripts stay),
access keys behind their prefix, hex secrets of 32 to 128 digits, IBANs, MAC, IPv6 and IPv4 addresses, phone numbers, dates
(yyyy-mm-dd of the years 1 to 9999; day and month in either order before a year of 1900 to 2099, behind the separator that
they have), social security numbers and card numbers. Of an e-mail name of more than 64 characters the last 64 are changed.

Null texts stay null, texts without such values stay as they are, and all other columns, whatever their names, pass through
unchanged. Repeated rows stay separate rows and get equal texts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fresh, let

ROUNDS = 8
#: The character sets that a position can be permuted within.
DIGITS = "0123456789"
LETTERS = "abcdefghijklmnopqrstuvwxyz"
#: Days from year 1 to 9999, in three ranges that dates stay in: (first day, days by days). The middle one begins in 1900
#: and ends on 30 December 2099.
SPANS = [("0001-01-01", 35, 19817), ("1900-01-01", 184, 397), ("2099-12-31", 8, 360677)]

#: Letters beyond ASCII that are permuted among themselves, as ranges of code points.
OTHERS = [
    "".join(chr(c) for low, high in ranges for c in range(low, high))
    for ranges in ([(0xDF, 0xF7), (0xF8, 0x100)], [(0xC0, 0xD7), (0xD8, 0xDF)], [(0x100, 0x180)], [(0x3B1, 0x3CA)], [(0x391, 0x3A2), (0x3A3, 0x3AA)], [(0x430, 0x450)], [(0x410, 0x430)])
]

EMAIL = r"[\p{L}\p{N}][\p{L}\p{M}\p{N}._%+-]{0,63}@[\p{L}\p{N}-]{1,63}(?:\.[\p{L}\p{N}-]{1,63}){0,8}\.\p{L}{2,24}"
TOKEN = r"\b(?:(?:AKIA|ASIA)[0-9A-Z]{16}\b|gh[opsur]_[A-Za-z0-9]{36,255}\b|sk_(?:live|test)_[A-Za-z0-9]{16,64}\b|AIza[A-Za-z0-9_-]{35}(?![\w-])|xox[abprs]-[A-Za-z0-9-]{10,72}(?![\w-]))"
PREFIX = r"^(?:AKIA|ASIA|gh[opsur]_|sk_(?:live|test)_|AIza|xox[abprs]-)"
SECRET = r"\b[0-9a-f]{32,128}\b"
UPPER_SECRET = r"\b[0-9A-F]{32,128}\b"
IBAN = r"(?<!\w)[A-Z]{2}\d{2}(?:(?: [A-Z0-9]{4}){2,7}(?: [A-Z0-9]{1,3})?|[A-Z0-9]{11,30})(?!\w)"
MAC = r"(?<![\w:-])[0-9A-Fa-f]{2}(?:(?::[0-9A-Fa-f]{2}){5}|(?:-[0-9A-Fa-f]{2}){5})(?![\w:-])"
IPV6 = r"(?<![\w:.])(?=[A-Fa-f:]{0,39}[0-9])(?:(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}|(?:[0-9A-Fa-f]{1,4}:){1,6}(?::[0-9A-Fa-f]{1,4}){1,6})(?![\w:])"
PHONE = r"(?<![\w+])\+\d{1,3}[ .-]?(?:\(\d{2,4}\)|\d{2,4})[ .-]?\d{3,4}[ .-]?\d{3,4}(?!\d)"
LOCAL = r"(?<![\w+.(-])(?:\([2-9]\d{2}\) ?|[2-9]\d{2}[ .-])[2-9]\d{2}[ .-]\d{4}(?![\w-])"
IP = r"(?<![\w.])(?:\d{1,3}\.){3}\d{1,3}(?!\w|\.\d)"
DATE = r"(?<![\w-])\d{4}-\d{2}-\d{2}(?![\w-])"
DAY_FIRST = r"(?<![\w/.-])\d{1,2}(?:/\d{1,2}/|\.\d{1,2}\.|-\d{1,2}-)(?:19|20)\d{2}(?![\w/-])"
SSN = r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])"
CARD = r"(?<![\w-])\d(?:[ -]?\d){12,18}(?![\w-])"
ANY = "|".join(f"(?:{p})" for p in (EMAIL, TOKEN, SECRET, UPPER_SECRET, IBAN, MAC, IPV6, PHONE, LOCAL, IP, DATE, DAY_FIRST, SSN, CARD))
#: What a text must have for any of these to be in it.
MAY = r"[0-9@:_-]|AKIA|ASIA|AIza|[A-Fa-f]{32}"


def _sum(a: Column) -> Column:
    return F.aggregate(a, F.lit(0), lambda x, y: x + y)


def luhn_sum(digits: Column) -> Column:
    """Luhn sum of an array of digits, the last one being the check digit."""
    n = F.size(digits)
    return _sum(F.transform(digits, lambda d, i: F.when((n - i) % 2 == 1, d).when(d > 4, 2 * d - 9).otherwise(2 * d)))


def feistel(values: Column, radices: Column, key: str, tweak: str, rounds: int = ROUNDS, inverse: bool = False) -> Column:
    """Permutes an array of numbers, the i-th below radices[i], by adding a keyed hash of one half to the other half.

    Halves have fixed places, so any lengths and any mix of radices work and no value leaves its domain.
    """
    half = F.floor((F.size(values) + 1) / 2).cast("int")
    sign = F.lit(-1 if inverse else 1)
    order = [r for r in (reversed(range(rounds)) if inverse else range(rounds))]

    def mixed(v: Column, r: Column) -> Column:
        moves = lambda i: (i < half) == (r % 2 == 0)  # noqa: E731  the halves change in turn
        other = F.concat_ws("|", F.lit(f"{key}|{tweak}"), r.cast("string"), F.array_join(F.filter(v, lambda _, i: ~moves(i)).cast("array<string>"), ","))

        def shift(said: Column) -> Column:
            def one(x: Column, i: Column) -> Column:
                block = F.sha2(F.concat_ws("|", said, F.floor(i / 8).cast("string")), 256)
                add = F.conv(F.substring(block, 8 * (i % 8) + 1, F.lit(8)), 16, 10).cast("bigint")
                return F.when(moves(i), F.pmod(x + sign * add, F.get(radices, i)).cast("int")).otherwise(x)

            return F.transform(v, one)

        return let(other, shift)

    return F.aggregate(F.array(*[F.lit(r) for r in order]), values, mixed)


def _chars(x: Column) -> Column:
    return F.filter(F.split(x, ""), lambda c: c != "")


def _within(x: Column, key: str, tweak: str, alphabet: Column | None, inverse: bool) -> Column:
    """Permutes the letters and digits of x within their kinds; every other character keeps its place."""

    def kinds(c: Column) -> Column:
        """The alphabet that holds c, or c alone. Letters beyond ASCII are looked up only where the text has some."""
        plain = [DIGITS, LETTERS, LETTERS.upper()]
        out = F.when(F.instr(F.lit(plain[0]), c) > 0, F.lit(plain[0]))
        for a in [*plain[1:], *OTHERS]:
            out = out.when(F.instr(F.lit(a), c) > 0, F.lit(a))
        return out.otherwise(c)

    of = (lambda c: alphabet) if alphabet is not None else kinds

    def run(chars: Column) -> Column:
        sets = F.transform(chars, of)
        values = F.zip_with(chars, sets, lambda c, s: F.instr(s, c) - 1)
        done = feistel(values, F.transform(sets, lambda s: F.length(s)), key, tweak, inverse=inverse)
        return F.array_join(F.zip_with(done, sets, lambda v, s: F.substring(s, v + 1, F.lit(1))), "")

    return let(_chars(x), run)


def _hexed(x: Column, key: str, tweak: str, inverse: bool) -> Column:
    """Permutes digits within digits and A to F within their case, so that the case of a number is never lost."""

    def run(chars: Column) -> Column:
        sets = F.transform(chars, lambda c: F.when(F.rlike(c, F.lit("[0-9]")), F.lit(DIGITS)).when(F.rlike(c, F.lit("[a-f]")), F.lit("abcdef")).when(F.rlike(c, F.lit("[A-F]")), F.lit("ABCDEF")).otherwise(c))
        done = feistel(F.zip_with(chars, sets, lambda c, s: F.instr(s, c) - 1), F.transform(sets, lambda s: F.length(s)), key, tweak, inverse=inverse)
        return F.array_join(F.zip_with(done, sets, lambda v, s: F.substring(s, v + 1, F.lit(1))), "")

    return let(_chars(x), run)


def _fill(pattern: Column, digits: Column) -> Column:
    """pattern with its digits replaced, in order, by the given ones."""

    def one(acc: Column, c: Column) -> Column:
        is_digit = F.instr(F.lit(DIGITS), c) > 0
        return F.struct(
            F.concat(acc["s"], F.when(is_digit, F.get(digits, acc["i"]).cast("string")).otherwise(c)).alias("s"),
            (acc["i"] + F.when(is_digit, F.lit(1)).otherwise(F.lit(0))).alias("i"),
        )

    return F.aggregate(_chars(pattern), F.struct(F.lit("").alias("s"), F.lit(0).alias("i")), one, lambda a: a["s"])


def _digits(x: Column) -> Column:
    return F.transform(_chars(F.regexp_replace(x, "[^0-9]", "")), lambda c: c.cast("int"))


def _ints(n: int, values: list[int]) -> Column:
    return F.array(*[F.lit(v) for v in values[:n]])


def _card(x: Column, key: str, inverse: bool) -> Column:
    def run(d: Column) -> Column:
        n = F.size(d)
        body = feistel(F.slice(d, F.lit(1), n - 1), F.array_repeat(F.lit(10), n - 1), key, "card", inverse=inverse)
        with_check = let(body, lambda b: F.concat(b, F.array(F.pmod(F.lit(10) - luhn_sum(F.concat(b, F.array(F.lit(0)))) % 10, F.lit(10)))))
        return F.when(luhn_sum(d) % 10 == 0, let(with_check, lambda v: _fill(x, v))).otherwise(x)

    return let(_digits(x), run)


def _phone(x: Column, key: str, inverse: bool) -> Column:
    """Keeps the country code; North American area and exchange codes keep a first digit of 2 to 9."""
    code = F.regexp_extract(x, r"^\+\d{1,3}?(?=[ .(-])|^\+1(?=\d{10}$)|^\+\d{2}", 0)
    rest = F.substring(x, F.length(code) + 1, F.length(x))

    def run(d: Column) -> Column:
        north = code.isin("+1", "") & (F.size(d) == 10) & (F.get(d, F.lit(0)) > 1) & (F.get(d, F.lit(3)) > 1)
        low = F.transform(d, lambda _, i: F.when(north & i.isin(0, 3), F.lit(2)).otherwise(F.lit(0)))
        values = F.zip_with(d, low, lambda v, b: v - b)
        done = feistel(values, F.transform(low, lambda b: F.lit(10) - b), key, "phone", inverse=inverse)
        return let(F.zip_with(done, low, lambda v, b: v + b), lambda v: F.concat(code, _fill(rest, v)))

    return let(_digits(rest), run)


def _ip(x: Column, key: str, inverse: bool) -> Column:
    """An octet that is written with leading zeros keeps its width and one of them."""

    def run(parts: Column) -> Column:
        padded = lambda p: F.startswith(p, F.lit("0")) & (F.length(p) > 1)
        radices = F.transform(parts, lambda p: F.when(padded(p), F.pow(F.lit(10), F.length(p) - 1).cast("int")).otherwise(F.lit(256)))
        octets = parts.cast("array<int>")
        done = feistel(octets, radices, key, "ip", inverse=inverse)
        said = F.zip_with(parts, done, lambda p, v: F.when(padded(p), F.lpad(v.cast("string"), F.length(p), F.lit("0"))).otherwise(v.cast("string")))
        return F.when(F.exists(F.zip_with(octets, radices, lambda o, r: o >= r), lambda bad: bad), x).otherwise(F.array_join(said, "."))

    return let(F.split(x, r"\."), run)


def _date(x: Column, key: str, inverse: bool) -> Column:
    """A real date of the years 1 to 9999, as another one of its range in SPANS."""
    day = F.datediff(F.try_to_timestamp(x, F.lit("yyyy-MM-dd")).cast("date"), F.to_date(F.lit(SPANS[0][0])))
    starts = [sum(a * b for _, a, b in SPANS[:i]) for i in range(len(SPANS))]

    def of(n: Column, values: list[int]) -> Column:
        out = F.lit(values[0])
        for start, v in list(zip(starts, values, strict=True))[1:]:
            out = F.when(n >= start, F.lit(v)).otherwise(out)
        return out

    def moved(n: Column) -> Column:
        base, a, b = of(n, starts), of(n, [s[1] for s in SPANS]), of(n, [s[2] for s in SPANS])
        values = F.array(F.floor((n - base) / b).cast("int"), ((n - base) % b).cast("int"))
        done = feistel(values, F.array(a, b), key, "date", inverse=inverse)
        return let(done, lambda v: F.date_format(F.date_add(F.to_date(F.lit(SPANS[0][0])), base + F.get(v, F.lit(0)) * b + F.get(v, F.lit(1))), "yyyy-MM-dd"))

    return let(day, lambda n: F.when(n.between(0, sum(a * b for _, a, b in SPANS) - 1), moved(n)).otherwise(x))


def _remainder(chars: Column) -> Column:
    """Remainder by 97 of the number that digits and letters (A is 10) spell."""

    def add(r: Column, c: Column) -> Column:
        v = F.ascii(c) - F.when(F.ascii(c) >= 65, F.lit(55)).otherwise(F.lit(48))
        return (r * F.when(v >= 10, F.lit(100)).otherwise(F.lit(10)) + v) % 97

    return F.aggregate(chars, F.lit(0), add)


def _iban(x: Column, key: str, inverse: bool) -> Column:
    """Letters and digits of the account part within their kinds, and the check digits that fit them; the country stays."""
    head, body = F.substring(x, F.lit(1), F.lit(2)), F.substring(x, F.lit(5), F.length(x))
    spelt = lambda b, check: _chars(F.concat(F.regexp_replace(b, " ", ""), head, check))
    check = F.substring(x, F.lit(3), F.lit(2))
    good = check.cast("int").between(2, 98) & (_remainder(spelt(body, check)) == 1)
    made = lambda b: F.concat(head, F.lpad((98 - _remainder(spelt(b, F.lit("00")))).cast("string"), F.lit(2), F.lit("0")), b)
    return F.when(good, let(_within(body, key, "iban", None, inverse), made)).otherwise(x)


def _day_first(x: Column, key: str, inverse: bool) -> Column:
    """Two numbers and a year of 1900 to 2099, either of them the day.

    Dates stay among those of like form: both numbers up to 12; else the day, on its side, up to 28; 29 or 30 outside
    February; 31; 29 February of a leap year. Each form is a product of ranges. A number of one digit stays one.
    """

    def run(p: Column) -> Column:
        wide = [F.length(F.get(p, F.lit(i))) > 1 for i in range(2)]
        n = [F.get(p, F.lit(i)).cast("int") for i in range(3)]
        left = n[0] > 12
        day, month = F.when(left, n[0]).otherwise(n[1]), F.when(left, n[1]).otherwise(n[0])
        month_wide = F.when(left, wide[1]).otherwise(wide[0])
        year = n[2] - 1900
        leap = (n[2] % 4 == 0) & (n[2] != 1900)
        months = lambda w: F.when(w, F.lit(12)).otherwise(F.lit(9))
        short = lambda v, w, most: F.when(w, F.lit(most)).otherwise(F.lit(v))
        put = lambda v, w: F.when(w, F.lpad(v.cast("string"), F.lit(2), F.lit("0"))).otherwise(v.cast("string"))
        sep = F.regexp_extract(x, "[/.-]", 0)

        def moved(values: list[Column], radices: list[Column], tweak: str, back) -> Column:
            return let(feistel(F.array(*values), F.array(*radices), key, tweak, inverse=inverse), lambda v: back([F.get(v, F.lit(i)) for i in range(len(values))]))

        def said(d: Column, m: Column, y: Column) -> Column:
            d, m = put(d, F.lit(True)), put(m, month_wide)
            return F.concat(F.when(left, d).otherwise(m), sep, F.when(left, m).otherwise(d), sep, (y + 1900).cast("string"))

        def nth(values: list[int], v: Column) -> Column:
            return F.get(F.array(*[F.lit(a) for a in values]), v)

        def place(values: list[int], v: Column) -> Column:
            return F.array_position(F.array(*[F.lit(a) for a in values]), v).cast("int") - 1

        not_feb, long = [1, *range(3, 13)], [1, 3, 5, 7, 8, 10, 12]  # months of one digit come first
        both = moved([n[0] - 1, n[1] - 1, year], [months(wide[0]), months(wide[1]), F.lit(200)], "d-any", lambda v: F.concat(put(v[0] + 1, wide[0]), sep, put(v[1] + 1, wide[1]), sep, (v[2] + 1900).cast("string")))
        to28 = moved([day - 13, month - 1, year], [F.lit(16), months(month_wide), F.lit(200)], "d-28", lambda v: said(v[0] + 13, v[1] + 1, v[2]))
        to30 = moved([day - 29, place(not_feb, month), year], [F.lit(2), short(8, month_wide, 11), F.lit(200)], "d-30", lambda v: said(v[0] + 29, nth(not_feb, v[1]), v[2]))
        on31 = moved([place(long, month), year], [short(5, month_wide, 7), F.lit(200)], "d-31", lambda v: said(F.lit(31), nth(long, v[0]), v[1]))
        on29 = moved([F.floor(year / 4).cast("int") - 1, F.lit(0)], [F.lit(49), F.lit(1)], "d-29", lambda v: said(F.lit(29), F.lit(2), v[0] * 4 + 4))
        least = (n[0] > 0) & (n[1] > 0)
        return (
            F.when(least & (n[0] <= 12) & (n[1] <= 12), both)
            .when(~least | (month > 12) | (day > 31), x)
            .when(day <= 28, to28)
            .when((month == 2) & (day == 29) & leap, on29)
            .when((month == 2) | ((day == 31) & ~month.isin(*long)), x)
            .when(day <= 30, to30)
            .otherwise(on31)
        )

    return let(F.split(x, "[/.-]"), run)


def _ssn(x: Column, key: str, inverse: bool) -> Column:
    """Nine digits; area 1 to 899 without 666, group 1 to 99 and serial 1 to 9999 stay in those ranges."""

    def run(p: Column) -> Column:
        area, group, serial = (F.get(p, F.lit(i)) for i in range(3))
        good = (area > 0) & (area < 900) & (area != 666) & (group > 0) & (serial > 0)
        values = F.array(area - F.when(area > 666, F.lit(2)).otherwise(F.lit(1)), group - 1, serial - 1)
        done = feistel(values, _ints(3, [898, 99, 9999]), key, "ssn", inverse=inverse)
        back = lambda v: F.format_string("%03d-%02d-%04d", F.get(v, F.lit(0)) + F.when(F.get(v, F.lit(0)) >= 665, F.lit(2)).otherwise(F.lit(1)), F.get(v, F.lit(1)) + 1, F.get(v, F.lit(2)) + 1)
        return F.when(good, let(done, back)).otherwise(x)

    return let(F.split(x, "-").cast("array<int>"), run)


def _kinds(x: Column) -> list[tuple[str, Column]]:
    """(kind, whether a matched value is of it), the first that holds being its kind; any other is a card."""
    full = lambda *p: F.rlike(x, F.lit("^(?:" + "|".join(f"(?:{q})" for q in p) + ")$"))
    return [
        ("email", F.instr(x, "@") > 0),
        ("token", F.rlike(x, F.lit(PREFIX))),
        ("secret", full(SECRET)),
        ("upper_secret", full(UPPER_SECRET)),
        ("iban", full(IBAN)),
        ("mac", full(MAC)),
        ("ipv6", full(IPV6)),
        ("date", full(DATE)),
        ("day_first", full(DAY_FIRST)),
        ("ssn", full(SSN)),
        ("ip", full(IP)),
        ("phone", F.startswith(x, F.lit("+")) | full(LOCAL)),
    ]


def pseudonym(x: Column, key: str, inverse: bool = False) -> Column:
    """The pseudonym of one matched value; a value that fails its validation stays as it is."""
    local, domain = F.substring_index(x, "@", 1), F.substring_index(x, "@", -1)
    prefix = F.regexp_extract(x, PREFIX, 0)
    of = {
        "email": F.concat(_within(local, key, "email", None, inverse), F.lit("@"), domain),
        "token": F.concat(prefix, _within(F.substring(x, F.length(prefix) + 1, F.length(x)), key, "token", None, inverse)),
        "secret": _within(x, key, "secret", F.lit("0123456789abcdef"), inverse),
        "upper_secret": _hexed(x, key, "secret", inverse),
        "iban": _iban(x, key, inverse),
        "mac": _hexed(x, key, "mac", inverse),
        "ipv6": _hexed(x, key, "ipv6", inverse),
        "date": _date(x, key, inverse),
        "day_first": _day_first(x, key, inverse),
        "ssn": _ssn(x, key, inverse),
        "ip": _ip(x, key, inverse),
        "phone": _phone(x, key, inverse),
    }
    out = F
    for name, holds in _kinds(x):
        out = out.when(holds, of[name])
    return out.otherwise(_card(x, key, inverse))


def kind(x: Column) -> Column:
    """Name of the kind of a matched value."""
    out = F
    for name, holds in _kinds(x):
        out = out.when(holds, F.lit(name))
    return out.otherwise("card")


def pseudonymize(df: DataFrame, key: str, text_col: str = "text", inverse: bool = False, found_col: str | None = None) -> DataFrame:
    """df with every validated value in text_col replaced; found_col, if given, gets the count of changed values.

    Texts are split once at the matches; only rows that may have a match, and have one, evaluate the network.
    """
    pii, new = fresh([*df.columns, *[found_col] * bool(found_col)], "_pii", "_new")
    text = F.col(text_col)
    may = F.rlike(text, F.lit(MAY))
    cut = F.when(may, F.struct(F.split(text, ANY, -1).alias("gaps"), F.regexp_extract_all(text, F.lit(ANY), F.lit(0)).alias("hits")))
    parts = df.withColumn(pii, cut)
    hits = F.coalesce(F.col(f"{pii}.hits"), F.array().cast("array<string>"))
    changed = F.when(F.size(hits) > 0, F.transform(hits, lambda h: pseudonym(h, key, inverse))).otherwise(hits)
    parts = parts.withColumn(new, changed)
    joined = F.array_join(F.flatten(F.zip_with(F.col(f"{pii}.gaps"), F.col(new), lambda g, h: F.array(g, F.coalesce(h, F.lit(""))))), "")
    out = parts.withColumn(text_col, F.when(F.size(new) > 0, joined).otherwise(text))
    if found_col:
        out = out.withColumn(found_col, F.size(F.filter(F.zip_with(hits, F.col(new), lambda a, b: a != b), lambda x: x)).cast("bigint"))
    return out.drop(pii, new)


#: Whoever has the key can invert the pseudonyms; the session's setting KEY_SETTING replaces this public one.
PUBLIC_KEY, KEY_SETTING = "corpus-key-1", "corpus.pseudonyms.key"


def key_of(spark) -> str:
    """The key of the session."""
    return spark.conf.get(KEY_SETTING, PUBLIC_KEY)


def op9(spark, sf_dir: str, key: str | None = None) -> DataFrame:
    """All documents with pseudonyms in place of personal data."""
    key = key or key_of(spark)
    return pseudonymize(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"), key, found_col="n_values")
