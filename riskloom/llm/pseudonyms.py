"""Format-preserving pseudonyms by a keyed Feistel network (DataFrame functions only).

Personal values are found by one pattern, validated (check digits, calendar,
octets), and permuted inside their own format: a card stays a card with a right
check digit, a date a date, an address an address. Equal values get equal
pseudonyms in every document, different values different ones, as a Feistel
network is a permutation: the value's symbols are cut into two halves, and each
round adds a keyed hash of one half to the other, symbol by symbol, modulo each
symbol's own radix.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.llm.text import fresh

ROUNDS = 8
# The forms that are looked for, first match first.
EMAIL = r"(?<![\p{L}0-9._%+-])[\p{L}0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+"
SECRET = r"(?<![0-9A-Za-z])[0-9A-Fa-f]{32,}+(?![0-9A-Za-z])"
ADDRESS = r"(?<![\d.])\d{1,3}(?:\.\d{1,3}){3}(?!\.?\d)"
ISO_DATE = r"(?<![\d-])\d{4}-\d{2}-\d{2}(?![\d-])"
DAY_FIRST_DATE = r"(?<![\d./])\d{1,2}(?:\.\d{1,2}\.|/\d{1,2}/)\d{4}(?!\d)"
PHONE = r"(?<![\d+])(?:\+\d{1,3}[ .-]?)?(?:\(\d{3}\) ?|\d{3}[.-])\d{3}[ .-]\d{4}(?!\d)"
SOCIAL = r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])"
CARD = r"(?<!\d)\d(?:[ -]?\d){12,18}(?!\d)"
ALL = "|".join([EMAIL, SECRET, ADDRESS, ISO_DATE, DAY_FIRST_DATE, PHONE, SOCIAL, CARD])
# Every form holds a digit or an @, or is a secret of letters only: a cheap test that most texts fail.
HINT = r"[0-9@]|[A-Fa-f]{32}"
# 400 Gregorian years always have 146,097 days, which is 189 * 773: dates permute without leaving the calendar.
FIRST_DAY, LAST_DAY = "1800-01-01", "2199-12-31"
DAY_RADICES = (189, 773)
HEX = "0123456789abcdef"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """The body with ``value`` worked out once."""
    return F.transform(F.array(value), body)[0]


def feistel(values: Column, radices: Column, secret: str, kind: str) -> Column:
    """A keyed permutation of ``values`` (array of int), each below the radix at its place."""
    cut = F.floor(F.size(values) / 2).cast("int")
    rest = F.size(values) - cut
    left_radices, right_radices = F.slice(radices, F.lit(1), cut), F.slice(radices, cut + 1, rest)

    def added(half: Column, other: Column, sizes: Column, turn: Column) -> Column:
        text = F.concat_ws("|", F.lit(secret), F.lit(kind), turn.cast("string"), F.concat_ws(",", other.cast("array<string>")))

        def shifted(digest: Column) -> Column:
            places = F.sequence(F.lit(0), F.size(half) - 1)
            # four digits of the digest per place
            shifts = F.transform(
                places, lambda i: F.conv(F.substring(digest, (i % 32) * 4 + 1, F.lit(4)), 16, 10).cast("int")
            )
            sums = F.zip_with(half, shifts, lambda a, b: a + b)
            return F.zip_with(sums, sizes, lambda a, r: a % r)

        return F.when(F.size(half) == 0, half).otherwise(let(F.sha2(text, 512), shifted))

    def step(state: Column, turn: Column) -> Column:
        even = turn % 2 == 0
        return F.struct(
            F.when(even, added(state["l"], state["r"], left_radices, turn)).otherwise(state["l"]).alias("l"),
            F.when(even, state["r"]).otherwise(added(state["r"], state["l"], right_radices, turn)).alias("r"),
        )

    start = F.struct(F.slice(values, F.lit(1), cut).alias("l"), F.slice(values, cut + 1, rest).alias("r"))
    turns = F.sequence(F.lit(0), F.lit(ROUNDS - 1))
    return F.aggregate(turns, start, step, lambda s: F.concat(s["l"], s["r"]))


def _symbols(text: Column) -> Column:
    return F.filter(F.split(text, ""), lambda c: c != "")


def _digits(text: Column) -> Column:
    return F.transform(_symbols(F.regexp_replace(text, r"[^0-9]", "")), lambda c: c.cast("int"))


def _joined(values: Column) -> Column:
    return F.array_join(values.cast("array<string>"), "")


def _woven(form: Column, digits: Column) -> Column:
    """The form with its digits replaced in order."""
    start = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))

    def step(a: Column, c: Column) -> Column:
        is_digit = c.rlike("[0-9]")
        taken = F.when(is_digit, F.substring(digits, a["at"] + 1, F.lit(1))).otherwise(c)
        return F.struct(F.concat(a["out"], taken).alias("out"), (a["at"] + is_digit.cast("int")).alias("at"))

    return F.aggregate(_symbols(form), start, step, lambda a: a["out"])


def _constant(values: Column, radix: int) -> Column:
    return F.transform(values, lambda _: F.lit(radix))


def luhn_sum(digits: Column, shift: int = 0) -> Column:
    """The check sum of card digits; ``shift`` 1 leaves room for a check digit behind them."""
    doubled = F.transform(
        F.reverse(digits),
        lambda d, i: F.when((i + shift) % 2 == 0, d).otherwise(F.when(d > 4, 2 * d - 9).otherwise(2 * d)),
    )
    return F.aggregate(doubled, F.lit(0), lambda a, d: a + d)


def _card(m: Column, secret: str) -> Column:
    def known(digits: Column) -> Column:
        body = F.slice(digits, F.lit(1), F.size(digits) - 1)
        fresh_body = feistel(body, _constant(body, 10), secret, "card")
        done = let(fresh_body, lambda b: F.concat(_joined(b), ((10 - luhn_sum(b, 1) % 10) % 10).cast("string")))
        return F.when(luhn_sum(digits) % 10 == 0, _woven(m, done)).otherwise(m)

    return let(_digits(m), known)


def _address(m: Column, secret: str) -> Column:
    def known(octets: Column) -> Column:
        out = F.array_join(feistel(octets, _constant(octets, 256), secret, "address").cast("array<string>"), ".")
        return F.when(F.forall(octets, lambda o: o < 256), out).otherwise(m)

    return let(F.split(m, r"\.").cast("array<int>"), known)


def _day(date: Column, secret: str) -> Column:
    """The pseudonym day of a valid date in the calendar range, else null."""
    day = F.datediff(date, F.lit(FIRST_DAY).cast("date"))
    values = F.array(F.floor(day / DAY_RADICES[1]).cast("int"), (day % DAY_RADICES[1]).cast("int"))
    radices = F.array(*[F.lit(r) for r in DAY_RADICES])
    index = let(feistel(values, radices, secret, "date"), lambda v: v[0] * DAY_RADICES[1] + v[1])
    inside = date.between(F.lit(FIRST_DAY).cast("date"), F.lit(LAST_DAY).cast("date"))
    return F.when(inside, F.date_add(F.lit(FIRST_DAY).cast("date"), index))


def _iso_date(m: Column, secret: str) -> Column:
    valid = F.call_function("try_to_date", m, F.lit("yyyy-MM-dd"))
    return F.coalesce(F.date_format(_day(valid, secret), "yyyy-MM-dd"), m)


def _day_first_date(m: Column, secret: str) -> Column:
    parts = F.split(m, "[./]")
    iso = F.concat_ws("-", parts[2], F.lpad(parts[1], 2, "0"), F.lpad(parts[0], 2, "0"))
    valid = F.call_function("try_to_date", iso, F.lit("yyyy-MM-dd"))
    mark = F.when(m.contains("/"), "/").otherwise(".")

    def written(day: Column) -> Column:
        return F.concat(F.date_format(day, "dd"), mark, F.date_format(day, "MM"), mark, F.date_format(day, "yyyy"))

    return F.coalesce(let(_day(valid, secret), written), m)


def _phone(m: Column, secret: str) -> Column:
    def known(digits: Column) -> Column:
        prefix = F.size(digits) - 10  # the country code stays
        number = F.slice(digits, prefix + 1, F.lit(10))
        # area and exchange don't begin with 0 or 1 where they didn't before
        low = F.transform(number, lambda d, i: F.when(((i == 0) | (i == 3)) & (d >= 2), 2).otherwise(0))
        radices = F.transform(low, lambda b: 10 - b)
        moved = feistel(F.zip_with(number, low, lambda d, b: d - b), radices, secret, "phone")
        kept = F.slice(digits, F.lit(1), prefix)
        return _woven(m, F.concat(_joined(kept), _joined(F.zip_with(moved, low, lambda d, b: d + b))))

    return let(_digits(m), known)


def _social(m: Column, secret: str) -> Column:
    parts = F.split(m, "-").cast("array<int>")
    area, group, serial = parts[0], parts[1], parts[2]
    valid = (area > 0) & (area < 900) & (area != 666) & (group > 0) & (serial > 0)
    values = F.array(area - 1 - (area > 666).cast("int"), group - 1, serial - 1)
    radices = F.array(F.lit(898), F.lit(99), F.lit(9999))

    def written(v: Column) -> Column:
        number = v[0] + 1 + (v[0] >= 665).cast("int")
        return F.concat_ws("-", *[
            F.lpad(x.cast("string"), n, "0") for x, n in ((number, 3), (v[1] + 1, 2), (v[2] + 1, 4))
        ])

    return F.when(valid, let(feistel(values, radices, secret, "social"), written)).otherwise(m)


def _coded(text: Column, secret: str, kind: str, hexadecimal: bool) -> Column:
    """Digits and letters A-Z permuted at their places; case and other characters stay."""
    symbols = _symbols(text)
    movable = F.filter(symbols, lambda c: c.rlike("[0-9A-Za-z]"))
    if hexadecimal:
        values = F.transform(movable, lambda c: F.instr(F.lit(HEX), F.lower(c)) - 1)
        radices = _constant(values, 16)
    else:
        values = F.transform(
            movable, lambda c: F.when(c.rlike("[0-9]"), F.ascii(c) - 48).otherwise(F.ascii(F.lower(c)) - 97)
        )
        radices = F.transform(movable, lambda c: F.when(c.rlike("[0-9]"), 10).otherwise(26))
    start = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))

    def woven(moved: Column) -> Column:
        def step(a: Column, c: Column) -> Column:
            moves = c.rlike("[0-9A-Za-z]")
            value = moved[a["at"]]
            if hexadecimal:
                plain = F.substring(F.lit(HEX), value + 1, F.lit(1))
                cased = F.when(text.rlike("[A-F]"), F.upper(plain)).otherwise(plain)
            else:
                letter = F.char(value + 97)
                cased = F.when(c.rlike("[0-9]"), value.cast("string")).when(c.rlike("[A-Z]"), F.upper(letter)).otherwise(letter)
            return F.struct(
                F.concat(a["out"], F.when(moves, cased).otherwise(c)).alias("out"),
                (a["at"] + moves.cast("int")).alias("at"),
            )

        return F.aggregate(symbols, start, step, lambda a: a["out"])

    return F.when(F.size(movable) == 0, text).otherwise(let(feistel(values, radices, secret, kind), woven))


def _email(m: Column, secret: str) -> Column:
    local = F.substring_index(m, "@", 1)
    return F.concat(_coded(local, secret, "email", False), F.lit("@"), F.substring_index(m, "@", -1))


def pseudonym(m: Column, secret: str) -> Column:
    """A found value's pseudonym; the value itself where it is not valid."""

    def whole(pattern: str) -> Column:
        return m.rlike(f"^(?:{pattern})$")

    return (
        F.when(m.contains("@"), _email(m, secret))
        .when(whole(SECRET), _coded(m, secret, "secret", True))
        .when(whole(ADDRESS), _address(m, secret))
        .when(whole(ISO_DATE), _iso_date(m, secret))
        .when(whole(DAY_FIRST_DATE), _day_first_date(m, secret))
        .when(whole(PHONE), _phone(m, secret))
        .when(whole(SOCIAL), _social(m, secret))
        .otherwise(_card(m, secret))
    )


def pseudonymise(docs: DataFrame, secret: str, text: str = "text", count_column: str = "n_replaced") -> DataFrame:
    """The rows with personal values replaced in the whole text, plus how many were.

    E-mail addresses (the part before the @), hexadecimal secrets of 32 and more
    digits, IPv4 addresses, dates of 1800 to 2199, telephone numbers, social
    security numbers and cards with a right check digit are replaced; what only
    looks like one is kept. A value that its permutation maps to itself counts
    as not replaced. A null text stays null with 0, an empty one stays empty;
    repeated rows and values are replaced alike. An empty table stays empty,
    other columns are kept, and the new one gets underscores where names clash.
    """
    name, found, gaps, new = (fresh(docs, n) for n in (count_column, "__found", "__gaps", "__new"))
    matches = F.regexp_extract_all(F.col(text), F.lit(f"({ALL})"), F.lit(1))
    marked = docs.withColumn(found, F.when(F.col(text).rlike(HINT), matches).otherwise(F.array().cast("array<string>")))
    # only texts with a match are cut and put together again
    hit = F.size(found) > 0
    marked = marked.withColumn(new, F.when(hit, F.transform(F.col(found), lambda m: pseudonym(m, secret))))
    pieces = F.zip_with(
        F.split(F.col(text), ALL, -1), F.col(new), lambda gap, value: F.concat(gap, F.coalesce(value, F.lit("")))
    )
    changed = F.size(F.filter(F.arrays_zip(F.col(found).alias("a"), F.col(new).alias("b")), lambda p: p["a"] != p["b"]))
    replaced = F.when(hit, F.array_join(pieces, "")).otherwise(F.col(text))
    columns = [replaced.alias(text) if c == text else F.col(f"`{c}`") for c in docs.columns]
    return marked.select(*columns, F.when(hit, changed).otherwise(0).alias(name))
