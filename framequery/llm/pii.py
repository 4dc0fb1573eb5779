"""Format-preserving pseudonyms for personal numbers, dates and addresses, in the JVM alone.

A value is found by its format and validated (Luhn digit, remainder by 97, calendar, octets, number ranges).
Its symbols then go through a keyed Feistel network of additions modulo each symbol's own
radix, which permutes the values of a format among themselves: the same value becomes the
same pseudonym in every document, however it is punctuated, and distinct values stay
distinct. Check digits are computed anew, so a pseudonym is as valid as the value was.

``key`` is a secret of the caller; who has it can invert the permutation.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import shielded

ROUNDS = 10

#: The country codes of two digits; 1 and 7 have one and all others three.
TWO_DIGIT_CODES = "20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 65 66 81 82 84 86 90 91 92 93 94 95 98".split()

_BEFORE = r"(?<![0-9A-Za-z_])(?<![0-9][.])"
_AFTER = r"(?![0-9A-Za-z_])(?![.][0-9])"
_OCTET = r"(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
EMAIL = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,24}"
IPV4 = rf"{_OCTET}(?:\.{_OCTET}){{3}}"
YEAR_FIRST = r"(?:1[0-9]|20)[0-9]{2}(?:-(?:0?[1-9]|1[0-2])-(?:0?[1-9]|[12][0-9]|3[01])|/(?:0?[1-9]|1[0-2])/(?:0?[1-9]|[12][0-9]|3[01])|\.(?:0?[1-9]|1[0-2])\.(?:0?[1-9]|[12][0-9]|3[01]))"
YEAR_LAST = r"(?:0?[1-9]|[12][0-9]|3[01])(?:-(?:0?[1-9]|[12][0-9]|3[01])-|/(?:0?[1-9]|[12][0-9]|3[01])/|\.(?:0?[1-9]|[12][0-9]|3[01])\.)(?:1[0-9]|20)[0-9]{2}"
CARD = r"(?:[0-9]{13,19}|(?:[0-9]{4} ){3}[0-9]{1,7}|(?:[0-9]{4}-){3}[0-9]{1,7}|[0-9]{4} [0-9]{6} [0-9]{5}|[0-9]{4}-[0-9]{6}-[0-9]{5})"
PHONE = r"(?:\+[0-9]{1,3}[ .-]?(?:\([0-9]{2,4}\)[ .-]?)?[0-9]{2,4}(?:[ .-]?[0-9]{2,4}){1,3}|\([0-9]{3}\)[ .-]?[0-9]{3}[ .-][0-9]{4}|[0-9]{3}[.-][0-9]{3}[.-][0-9]{4})"
SOCIAL = r"(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}"
IBAN = r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?"
_NUMBERS = "|".join((IBAN, IPV4, YEAR_FIRST, YEAR_LAST, SOCIAL, CARD, PHONE))
FOUND = rf"{EMAIL}|(?<![0-9A-Za-z_+(])(?<![0-9][.])(?:{_NUMBERS}){_AFTER}|{_BEFORE}(?:{PHONE}){_AFTER}"


def _let(x: Column, use: Callable[[Column], Column]) -> Column:
    """``use(x)`` with x worked out once."""
    return F.element_at(F.transform(F.array(x), use), 1)


def feistel(symbols: Column, radices: Column, tweak: Column, key: str, rounds: int = ROUNDS) -> Column:
    """A keyed permutation of arrays of ints, symbol i staying below radix i.

    Even rounds add to the first half what a hash of the second half says, odd rounds the
    other way round; each can be taken back, so the whole is one to one whatever the hash.
    ``tweak`` names the format and makes each format a permutation of its own.
    """
    n = F.size(symbols)
    half = F.floor(n / 2).cast("int")

    def turn(state: Column, r: Column) -> Column:
        first = r % 2 == 0
        other = F.when(first, F.slice(state, half + 1, n - half)).otherwise(F.slice(state, 1, half))
        seed = F.concat_ws("|", F.lit(key), tweak, n.cast("string"), r.cast("string"), F.array_join(other.cast("array<string>"), ","))

        def moved(x: Column, i: Column, sown: Column) -> Column:
            drawn = F.conv(F.substring(F.sha2(F.concat_ws("|", sown, i.cast("string")), 256), 1, 12), 16, 10).cast("long")
            return F.when((i < half) == first, F.pmod(x + drawn, F.element_at(radices, i + 1).cast("long")).cast("int")).otherwise(x)

        return _let(seed, lambda sown: F.transform(state, lambda x, i: moved(x, i, sown)))

    return F.aggregate(F.sequence(F.lit(0), F.lit(rounds - 1)), symbols, turn)


def _chars(s: Column) -> Column:
    return F.filter(F.split(s, ""), lambda c: c != "")


def _digits(s: Column) -> Column:
    return F.regexp_replace(s, "[^0-9]", "")


def _ints(digits: Column) -> Column:
    return F.transform(_chars(digits), lambda c: c.cast("int"))


def _joined(ints: Column) -> Column:
    return F.array_join(ints.cast("array<string>"), "")


def _refill(template: Column, digits: Column) -> Column:
    """The template with its digits, in order, replaced by ``digits``."""
    start = F.struct(F.lit("").alias("out"), F.lit(1).alias("k"))

    def put(acc: Column, c: Column) -> Column:
        is_digit = c.between("0", "9")
        return F.struct(F.concat(acc["out"], F.when(is_digit, F.substring(digits, acc["k"], 1)).otherwise(c)).alias("out"), (acc["k"] + is_digit.cast("int")).alias("k"))

    return F.aggregate(_chars(template), start, put, lambda acc: acc["out"])


def permuted_digits(digits: Column, kind: str, key: str) -> Column:
    """Another string of as many digits."""
    return _let(_ints(digits), lambda x: _joined(feistel(x, F.transform(x, lambda _: F.lit(10)), F.lit(kind), key)))


def luhn_digit(body: Column) -> Column:
    """The digit that makes ``body`` followed by it pass the Luhn check."""
    doubled = F.transform(F.reverse(_ints(body)), lambda x, i: F.when(i % 2 == 0, x * 2 - F.when(x > 4, 9).otherwise(0)).otherwise(x))
    return F.pmod(-F.aggregate(doubled, F.lit(0), lambda a, x: a + x), F.lit(10)).cast("string")


def _body(digits: Column) -> Column:
    return F.left(digits, F.length(digits) - 1)


def valid_card(value: Column) -> Column:
    return _let(_digits(value), lambda d: luhn_digit(_body(d)) == F.right(d, F.lit(1)))


def card(value: Column, key: str) -> Column:
    """All digits but the last are permuted; the last is the new check digit."""
    return _let(permuted_digits(_body(_digits(value)), "card", key), lambda body: _refill(value, F.concat(body, luhn_digit(body))))


def _code_length(digits: Column) -> Column:
    """How many of an international number's digits are its country code; codes are no prefixes of one another."""
    return F.when(F.left(digits, F.lit(1)).isin("1", "7"), 1).when(F.left(digits, F.lit(2)).isin(*TWO_DIGIT_CODES), 2).otherwise(3)


def valid_phone(value: Column) -> Column:
    """Whether an international number has 7 to 15 digits, as the numbering plan allows; numbers without a code always pass."""
    return ~value.startswith("+") | F.length(_digits(value)).between(7, 15)


def phone(value: Column, key: str) -> Column:
    """The country code stays; the other digits are permuted, whatever stands between them."""

    def new(digits: Column) -> Column:
        n = F.when(value.startswith("+"), _code_length(digits)).otherwise(0)
        return _refill(value, F.concat(F.left(digits, n), permuted_digits(F.substr(digits, n + 1), "phone", key)))

    return _let(_digits(value), new)


def social(value: Column, key: str) -> Column:
    """Area (not 000, 666, 900 up), group (not 00) and serial (not 0000) are permuted within their ranges."""
    part = lambda k: F.element_at(F.split(value, "-"), k).cast("int")
    symbols = F.array(part(1) - F.when(part(1) > 666, 2).otherwise(1), part(2) - 1, part(3) - 1)
    new = feistel(symbols, F.array(F.lit(898), F.lit(99), F.lit(9999)), F.lit("social"), key)
    area = lambda x: x + F.when(x >= 665, 2).otherwise(1)
    return _let(new, lambda s: F.format_string("%03d-%02d-%04d", area(s[0]), s[1] + 1, s[2] + 1))


def ipv4(value: Column, key: str) -> Column:
    octets = F.transform(F.split(value, r"\."), lambda c: c.cast("int"))
    return F.array_join(feistel(octets, F.array(*[F.lit(256)] * 4), F.lit("ipv4"), key).cast("array<string>"), ".")


def permuted_signs(text: Column, kind: str, key: str) -> Column:
    """Letters and digits permuted, each within its kind; other signs stay in place."""
    radix = lambda c: F.when(c.between("0", "9"), 10).when(c.between("a", "z") | c.between("A", "Z"), 26).otherwise(1)
    base = lambda c: F.when(c.between("0", "9"), 48).when(c.between("a", "z"), 97).when(c.between("A", "Z"), 65).otherwise(F.ascii(c))

    def new(chars: Column) -> Column:
        symbols = F.transform(chars, lambda c: F.ascii(c) - base(c))
        moved = feistel(symbols, F.transform(chars, radix), F.lit(kind), key)
        return F.array_join(F.zip_with(chars, moved, lambda c, x: F.char(base(c) + x)), "")

    return _let(_chars(text), new)


def email(value: Column, key: str) -> Column:
    """The local part is permuted; the domain stays."""
    return F.concat(permuted_signs(F.substring_index(value, "@", 1), "email", key), F.lit("@"), F.substring_index(value, "@", -1))


def _mod97(signs: Column) -> Column:
    """The remainder by 97 of a string of digits and capitals, these counting 10 to 35."""
    return F.aggregate(_chars(signs), F.lit(0), lambda a, c: F.when(c.between("0", "9"), a * 10 + F.ascii(c) - 48).otherwise(a * 100 + F.ascii(c) - 55) % 97)


def _turned(signs: Column) -> Column:
    return F.concat(F.substr(signs, F.lit(5)), F.left(signs, F.lit(4)))


def valid_iban(value: Column) -> Column:
    return _let(F.regexp_replace(value, " ", ""), lambda s: _mod97(_turned(s)) == 1)


def iban(value: Column, key: str) -> Column:
    """The country stays, the account is permuted and the two check digits are computed anew."""

    def new(s: Column) -> Column:
        land = F.left(s, F.lit(2))
        fresh = lambda body: F.concat(land, F.lpad((98 - _mod97(F.concat(body, land, F.lit("00")))).cast("string"), 2, "0"), body)
        return _let(permuted_signs(F.substr(s, F.lit(5)), "iban", key), fresh)

    def spaced(signs: Column) -> Column:
        start = F.struct(F.lit("").alias("out"), F.lit(1).alias("k"))
        put = lambda acc, c: F.when(c == " ", F.struct(F.concat(acc["out"], F.lit(" ")).alias("out"), acc["k"].alias("k"))).otherwise(F.struct(F.concat(acc["out"], F.substring(signs, acc["k"], 1)).alias("out"), (acc["k"] + 1).alias("k")))
        return F.aggregate(_chars(value), start, put, lambda acc: acc["out"])

    return _let(_let(F.regexp_replace(value, " ", ""), new), spaced)


def _date_parts(value: Column) -> Column:
    """(y, m, d, order) of a date; order tells which of m and d comes first where the year is last.

    With slashes the month comes first if it can, otherwise the day does, and the other way
    round with dots and hyphens.
    """
    parts = F.transform(F.split(value, "[-/.]"), lambda c: c.cast("int"))

    def ordered(p: Column) -> Column:
        month_first = F.when(value.contains("/"), p[0] <= 12).otherwise(p[1] > 12)
        return (
            F.when(p[0] > 31, F.struct(p[0].alias("y"), p[1].alias("m"), p[2].alias("d"), F.lit("ymd").alias("order")))
            .when(month_first, F.struct(p[2].alias("y"), p[0].alias("m"), p[1].alias("d"), F.lit("mdy").alias("order")))
            .otherwise(F.struct(p[2].alias("y"), p[1].alias("m"), p[0].alias("d"), F.lit("dmy").alias("order")))
        )

    return _let(parts, ordered)


def valid_date(value: Column) -> Column:
    """Whether the calendar has the day."""
    return _let(_date_parts(value), lambda p: F.when(p["m"] > 12, F.lit(False)).otherwise(p["d"] <= F.dayofmonth(F.last_day(F.make_date(p["y"], p["m"], F.lit(1))))))


def date(value: Column, key: str) -> Column:
    """Another day of the same century, written the same way.

    A century has 36,525 days (75 x 487) or 36,524 (92 x 397), so a day's number is two
    symbols that use up their radices and no day is ever drawn twice.
    """

    def new(p: Column) -> Column:
        century = F.floor(p["y"] / 100).cast("int")
        first = F.make_date(century * 100, F.lit(1), F.lit(1))
        number = F.datediff(F.make_date(p["y"], p["m"], p["d"]), first)
        long = century % 4 == 0
        high, low = F.when(long, 75).otherwise(92), F.when(long, 487).otherwise(397)
        moved = feistel(F.array(F.floor(number / low).cast("int"), (number % low).cast("int")), F.array(high, low), F.concat(F.lit("date"), century.cast("string")), key)
        return _let(F.date_add(first, _let(moved, lambda s: s[0] * low + s[1])), lambda day: _written(value, p["order"], day))

    return _let(_date_parts(value), new)


def _written(like: Column, order: Column, day: Column) -> Column:
    sep = F.regexp_extract(like, "[-/.]", 0)
    padded = ~like.rlike(r"(?<![0-9])[0-9](?![0-9])")
    y, m, d = F.year(day).cast("string"), F.month(day).cast("string"), F.dayofmonth(day).cast("string")
    m, d = (F.when(padded, F.lpad(x, 2, "0")).otherwise(x) for x in (m, d))
    return F.when(order == "ymd", F.concat(y, sep, m, sep, d)).when(order == "mdy", F.concat(m, sep, d, sep, y)).otherwise(F.concat(d, sep, m, sep, y))


def pseudonym(value: Column, key: str) -> Column:
    """The pseudonym of a found value; null if it fails validation."""
    full = lambda p: value.rlike(f"^(?:{p})$")
    return (
        F.when(value.contains("@"), email(value, key))
        .when(full(IPV4), ipv4(value, key))
        .when(full(IBAN), F.when(valid_iban(value), iban(value, key)))
        .when(full(f"{YEAR_FIRST}|{YEAR_LAST}"), F.when(valid_date(value), date(value, key)))
        .when(full(SOCIAL), social(value, key))
        .when(full(CARD), F.when(valid_card(value), card(value, key)))
        .when(full(PHONE), F.when(valid_phone(value), phone(value, key)))
    )


@shielded
def pseudonymize(docs: DataFrame, key: str, text_col: str = "text", count_col: str | None = None) -> DataFrame:
    """``docs`` with every validated value in the texts replaced by its pseudonym; all else as it was.

    ``count_col`` adds a column with the number of values replaced. A null text stays null
    (count 0); values that fail validation stay, as does what surrounds them. Rows are
    independent: repeated rows, null ids and empty tables need nothing special, and nothing
    is shuffled.
    """
    text = F.col(text_col)
    found = F.when(text.rlike("[0-9@]"), F.regexp_extract_all(text, F.lit(FOUND), F.lit(0))).otherwise(F.array().cast("array<string>"))
    between = F.split(text, FOUND, -1)
    with_new = docs.withColumn("__found", found).withColumn("__new", F.transform("__found", lambda v: pseudonym(v, key)))
    put = F.concat(F.zip_with("__found", "__new", lambda v, n: F.coalesce(n, v)), F.array(F.lit("")))
    replaced = F.array_join(F.zip_with(between, put, lambda a, b: F.concat(a, b)), "")
    changed = F.size(F.filter("__new", lambda n: n.isNotNull()))
    columns = [F.when(changed > 0, replaced).otherwise(text).alias(c) if c == text_col else F.col(f"`{c}`") for c in docs.columns]
    return with_new.select(*columns, *([F.greatest(changed, F.lit(0)).alias(count_col)] if count_col else []))
