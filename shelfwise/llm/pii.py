"""Format-preserving pseudonyms for personal data, by keyed Feistel networks in Spark expressions.

Mail addresses, phone numbers, payment cards, account numbers (IBAN), social security numbers, network
addresses and dates are found by pattern and validated (check digits, ranges, calendar). A valid
value is permuted within its own format: digits stay digits, check digits hold, a date stays in
its century. The permutation depends on the key and the value only, so equal values stay linked
across documents, and different values stay different.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.common import text_or_empty, unused

KEY = "shelfwise-pii-1"
ROUNDS = 8

# Fixed patterns of the scan, tried in this order at each place.
EMAIL = r"[A-Za-z0-9][A-Za-z0-9._%+-]*+@(?:[A-Za-z0-9-]++\.)+[A-Za-z]{2,}"
IBAN = r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?"
NANP = (
    r"\+1[ .-]?(?:\([0-9]{3}\)|[2-9][0-9]{2})[ .-]?[0-9]{3}[ .-]?[0-9]{4}"
    r"|(?:1[ .-]?)?(?:\([0-9]{3}\) ?|[2-9][0-9]{2}[ .-])[0-9]{3}[ .-][0-9]{4}"
)
PHONE = r"\+[2-9][0-9]{0,2}(?:[ -]?\(?[0-9]{2,4}\)?){2,5}"
IPV4 = r"[0-9]{1,3}(?:\.[0-9]{1,3}){3}"
ISO = r"[0-9]{4}-[0-9]{2}-[0-9]{2}"
DATE = ISO + r"|[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}|[0-9]{1,2}\.[0-9]{1,2}\.[0-9]{4}"
SSN = r"[0-9]{3}-[0-9]{2}-[0-9]{4}"
CARD = r"[0-9](?:[ -]?[0-9]){12,18}"
NUMBER = rf"(?:{ISO}(?=[Tt][0-9]{{2}})|(?:{IBAN}|{NANP}|{PHONE}|{IPV4}|{DATE}|{SSN}|{CARD})(?![A-Za-z0-9])(?!\.[0-9]))"
# Signs may precede a value, unless they continue an address's name or a number.
ANY = rf"(?:(?<![A-Za-z0-9])(?<![A-Za-z0-9][._%+-]{{1,3}}){EMAIL}|(?<![A-Za-z0-9+])(?<![0-9][.-]){NUMBER})"
FIRST_SIGNS = r"[0-9@]"
SEPARATED = rf"^(?:{IBAN}|{CARD})$"  # may hold more than one value
BREAK = "\ufdd0\ufdef\ufdd0"  # noncharacters: set between values while a text is scanned

# Lengths of account numbers by country.
IBAN_LENGTHS = (
    "AD24 AE23 AL28 AT20 AZ28 BA20 BE16 BG22 BH22 BR29 BY28 CH21 CR22 CY28 CZ24 DE22 DK18 DO28 EE20 EG29 ES24 FI18 FO18 FR27 GB22 GE22 "
    "GI23 GL18 GR27 GT28 HR21 HU28 IE22 IL23 IQ23 IS26 IT27 JO30 KW30 KZ20 LB28 LC32 LI21 LT20 LU20 LV21 LY25 MC27 MD24 ME22 MK19 MR27 "
    "MT31 MU30 NL18 NO15 PK24 PL28 PS29 PT25 QA29 RO24 RS22 SA24 SC31 SD18 SE24 SI19 SK24 SM27 ST25 SV28 TL23 TN24 TR26 UA29 VA22 VG24 XK20"
)

# Alphabets that a place may move in: first code and size. The last two hold the digits 2-9 and
# 0-1 of places where a telephone number allows only these.
DIGITS, UPPER, LOWER, HIGH, LOW = (48, 10), (65, 26), (97, 26), (192, 8), (200, 2)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, the value computed once (a lambda's outer expressions run for each element)."""
    return F.element_at(F.transform(F.array(value), body), 1)


def keyed(*parts: Column) -> Column:
    """64 hex digits from the key, a round and a value."""
    return F.sha2(F.concat_ws("|", *[p.cast("string") for p in parts]), 256)


def shifted(sign: Column, by: Column) -> Column:
    """The sign moved within its alphabet; signs of no alphabet stay."""
    code = F.ascii(sign)
    out = None
    for first, size in (DIGITS, UPPER, LOWER, HIGH, LOW):
        inside = (code >= first) & (code < first + size)
        moved = F.char(F.lit(first) + (code - first + by) % size)
        out = F.when(inside, moved) if out is None else out.when(inside, moved)
    return out.otherwise(sign)


def shift_text(value: Column, digest: Column) -> Column:
    places = F.when(F.length(value) > 0, F.sequence(F.lit(0), F.length(value) - 1)).otherwise(F.array().cast("array<int>"))
    amount = lambda drawn, i: F.conv(F.substr(drawn, (i * 4) % 60 + 1, F.lit(5)), 16, 10).cast("int")
    return let(
        digest,
        lambda drawn: F.array_join(
            F.transform(places, lambda i: shifted(F.substr(value, i + 1, F.lit(1)), amount(drawn, i))), ""
        ),
    )


def permute_text(value: Column, key: str) -> Column:
    """Feistel over the halves of a text: each round shifts one half by a keyed digest of the other."""
    half = F.floor(F.length(value) / 2).cast("int")
    start = F.struct(F.substr(value, F.lit(1), half).alias("a"), F.substr(value, half + 1).alias("b"))
    step = lambda s, r: F.struct(
        F.when(r % 2 == 0, shift_text(s["a"], keyed(F.lit(key), r, F.lower(s["b"])))).otherwise(s["a"]).alias("a"),
        F.when(r % 2 == 1, shift_text(s["b"], keyed(F.lit(key), r, F.lower(s["a"])))).otherwise(s["b"]).alias("b"),
    )
    return F.aggregate(rounds(), start, step, lambda s: F.concat(s["a"], s["b"]))


def permute_number(high: Column, low: Column, highs: Column, lows: Column, key: str) -> Column:
    """Feistel over a pair of numbers below ``highs`` and ``lows``: a permutation of all such pairs."""
    mixed = lambda r, x: F.conv(F.substr(keyed(F.lit(key), r, x), F.lit(1), F.lit(12)), 16, 10).cast("long")
    step = lambda s, r: F.struct(
        F.when(r % 2 == 0, (s["a"] + mixed(r, s["b"])) % highs).otherwise(s["a"]).cast("long").alias("a"),
        F.when(r % 2 == 1, (s["b"] + mixed(r, s["a"])) % lows).otherwise(s["b"]).cast("long").alias("b"),
    )
    return F.aggregate(rounds(), F.struct(high.cast("long").alias("a"), low.cast("long").alias("b")), step)


def rounds() -> Column:
    return F.array(*[F.lit(r) for r in range(ROUNDS)])


def only(signs: str, value: Column) -> Column:
    return F.regexp_replace(value, f"[^{signs}]", "")


def refilled(template: Column, signs: str, filling: Column) -> Column:
    """``template`` with its signs of the class replaced, in order, by those of ``filling``."""
    place = lambda i: F.substr(template, i, F.lit(1))
    nth = lambda i: F.length(only(signs, F.substr(template, F.lit(1), i)))
    return let(
        filling,
        lambda new: F.array_join(
            F.transform(
                F.sequence(F.lit(1), F.length(template)),
                lambda i: F.when(place(i).rlike(f"[{signs}]"), F.substr(new, nth(i), F.lit(1))).otherwise(place(i)),
            ),
            "",
        ),
    )


def digit_sum(digits: Column, doubled: int) -> Column:
    """Luhn sum; places counted from the right, from 0, with remainder ``doubled`` by 2 count double."""
    return F.aggregate(
        F.sequence(F.lit(0), F.length(digits) - 1),
        F.lit(0),
        lambda total, i: total
        + F.when(
            i % 2 == doubled,
            F.element_at(F.array(*[F.lit(x) for x in (0, 2, 4, 6, 8, 1, 3, 5, 7, 9)]), digit(digits, i) + 1),
        ).otherwise(digit(digits, i)),
    )


def digit(digits: Column, from_right: Column) -> Column:
    return F.substr(digits, F.length(digits) - from_right, F.lit(1)).cast("int")


def valid_card(digits: Column) -> Column:
    return digit_sum(digits, 1) % 10 == 0


def email(value: Column, key: str) -> Column:
    return let(
        F.substring_index(value, "@", 1),
        lambda name: F.concat(permute_text(name, key + ":mail"), F.substr(value, F.length(name) + 1)),
    )


def card(value: Column, key: str) -> Column:
    body = lambda digits: F.concat(
        F.substr(digits, F.lit(1), F.lit(1)),
        let(F.substr(digits, F.lit(2), F.length(digits) - 2), lambda x: permute_text(x, key + ":card")),
    )
    checked = lambda x: F.concat(x, ((10 - digit_sum(x, 0) % 10) % 10).cast("string"))
    return let(
        only("0-9", value),
        lambda digits: F.when(valid_card(digits), refilled(value, "0-9", let(body(digits), checked))),
    )


def phone(value: Column, key: str) -> Column:
    """The country code stays; of ten-digit North American numbers area and exchange keep a lawful first digit."""
    digits = only("0-9", value)
    country = F.when(value.startswith("+"), F.regexp_extract(value, r"^\+(1|[0-9]{1,3})", 1)).otherwise(
        F.regexp_extract(value, "^(1)", 1)
    )
    american = ~value.startswith("+") | value.startswith("+1")
    national = F.substr(digits, F.length(digits) - 9)
    to, back = ("".join(chr(200 + i) for i in range(2)) + "".join(chr(192 + i) for i in range(8)), "0123456789")
    lawful = lambda x: F.translate(x, back, to)
    piece = lambda start, n: F.substr(national, F.lit(start), F.lit(n))
    hidden = F.concat(lawful(piece(1, 1)), piece(2, 2), lawful(piece(4, 1)), piece(5, 6))
    permuted = lambda x: let(x, lambda bound: permute_text(bound, key + ":phone"))
    us = F.concat(country, F.translate(permuted(hidden), to, back))
    rest = F.concat(country, permuted(F.substr(digits, F.length(country) + 1)))
    return (
        F.when(american & (F.length(digits) - F.length(country) == 10), refilled(value, "0-9", us))
        .when(~american & F.length(digits).between(8, 15), refilled(value, "0-9", rest))
    )


def ipv4(value: Column, key: str) -> Column:
    octets = F.transform(F.split(value, r"\."), lambda x: x.cast("int"))
    o = lambda i: F.element_at(octets, i)
    pair = permute_number(o(1) * 256 + o(2), o(3) * 256 + o(4), F.lit(65536), F.lit(65536), key + ":ip")
    joined = lambda s: F.concat_ws(
        ".",
        *[x.cast("string") for x in (F.floor(s["a"] / 256), s["a"] % 256, F.floor(s["b"] / 256), s["b"] % 256)],
    )
    return F.when(F.forall(octets, lambda x: x <= 255), let(pair, joined))


def ssn(value: Column, key: str) -> Column:
    """Areas 001-899 without 666, groups 01-99, serials 0001-9999, numbered and permuted."""
    n = lambda start, size: F.substr(value, F.lit(start), F.lit(size)).cast("int")
    area, group, serial = n(1, 3), n(5, 2), n(8, 4)
    valid = area.between(1, 899) & (area != 666) & (group >= 1) & (serial >= 1)
    index = F.when(area > 666, area - 2).otherwise(area - 1)
    pair = permute_number(index * 99 + group - 1, serial - 1, F.lit(898 * 99), F.lit(9999), key + ":ssn")
    place = lambda s: F.floor(s["a"] / 99)
    written = lambda s: F.concat_ws(
        "-",
        F.lpad((F.when(place(s) >= 665, place(s) + 2).otherwise(place(s) + 1)).cast("string"), 3, "0"),
        F.lpad((s["a"] % 99 + 1).cast("string"), 2, "0"),
        F.lpad((s["b"] + 1).cast("string"), 4, "0"),
    )
    return F.when(valid, let(pair, written))


def date(value: Column, key: str) -> Column:
    """Permuted among the days of its century: 36,524 = 92 x 397 days, or 36,525 = 75 x 487 with a leap first year.

    With slashes the month comes first if that makes a date, else the day; with dots the day comes first.
    """
    part = lambda i: F.element_at(F.split(value, r"[-/.]"), i)
    made = lambda y, m, d: F.try_to_date(
        F.concat_ws("-", F.lpad(y, 4, "0"), F.lpad(m, 2, "0"), F.lpad(d, 2, "0")), "yyyy-MM-dd"
    )
    iso, slash = value.contains("-"), value.contains("/")
    month_first = slash & made(part(3), part(1), part(2)).isNotNull()
    day = (
        F.when(iso, made(part(1), part(2), part(3)))
        .when(month_first, made(part(3), part(1), part(2)))
        .otherwise(made(part(3), part(2), part(1)))
    )
    two = F.length(value) == 10  # else parts are written without a leading zero

    def moved(day: Column) -> Column:
        century = F.floor(F.year(day) / 100).cast("int")
        start = F.make_date(century * 100, F.lit(1), F.lit(1))
        leap, index = century % 4 == 0, F.datediff(day, start)
        highs, lows = F.when(leap, 75).otherwise(92), F.when(leap, 487).otherwise(397)
        pair = permute_number(F.floor(index / lows), index % lows, highs, lows, key + ":date")
        return F.when(century > 0, let(pair, lambda s: F.date_add(start, (s["a"] * lows + s["b"]).cast("int"))))

    def written(new: Column) -> Column:
        text = lambda long, short: F.when(two, F.date_format(new, long)).otherwise(F.date_format(new, short))
        return (
            F.when(iso, F.date_format(new, "yyyy-MM-dd"))
            .when(month_first, text("MM/dd/yyyy", "M/d/yyyy"))
            .when(slash, text("dd/MM/yyyy", "d/M/yyyy"))
            .otherwise(text("dd.MM.yyyy", "d.M.yyyy"))
        )

    return let(let(day, moved), written)


def remainder_97(value: Column) -> Column:
    """An account number's remainder by 97, its first four signs moved to the end and letters read as 10 to 35."""
    turned = F.concat(F.substr(value, F.lit(5)), F.substr(value, F.lit(1), F.lit(4)))
    return F.aggregate(
        F.sequence(F.lit(1), F.length(turned)),
        F.lit(0),
        lambda total, i: F.when(
            F.substr(turned, i, F.lit(1)).rlike("[0-9]"), (total * 10 + F.ascii(F.substr(turned, i, F.lit(1))) - 48) % 97
        ).otherwise((total * 100 + F.ascii(F.substr(turned, i, F.lit(1))) - 55) % 97),
    )


def valid_iban(bare: Column) -> Column:
    return F.length(bare).between(15, 34) & (remainder_97(bare) == 1)


def iban(value: Column, key: str) -> Column:
    bare = F.regexp_replace(value, " ", "")
    country = F.substr(bare, F.lit(1), F.lit(2))
    check = lambda body: 98 - remainder_97(F.concat(country, F.lit("00"), body))
    made = let(
        let(F.substr(bare, F.lit(5)), lambda x: permute_text(x, key + ":iban")),
        lambda body: F.concat(country, F.lpad(check(body).cast("string"), 2, "0"), body),
    )
    return F.when(valid_iban(bare), refilled(value, "A-Z0-9", made))


def whole_value(value: Column) -> Column:
    """True for a card number, or an account number of its country's length, without anything else."""
    digits = only("0-9", value)
    bare = F.regexp_replace(value, " ", "")
    known = F.concat(F.substr(bare, F.lit(1), F.lit(2)), F.lit("([0-9]{2})"))
    length = F.call_function("regexp_extract", F.lit(IBAN_LENGTHS), known, F.lit(1))
    lawful = F.when(length == "", F.length(bare).between(15, 34)).otherwise(F.length(bare) == length.try_cast("int"))
    return (
        F.when(value.rlike(f"^{CARD}$"), valid_card(digits))
        .when(value.rlike(f"^{IBAN}$"), lawful & valid_iban(bare))
        .otherwise(False)
    )


def parted(value: Column) -> Column:
    """A found run that fails validation with breaks around the first, and then longest, valid value between its separators."""
    places = F.filter(F.sequence(F.lit(1), F.length(value)), lambda i: F.substr(value, i, F.lit(1)).isin(" ", "-"))
    starts = lambda at: F.concat(F.array(F.lit(1)), F.transform(at, lambda i: i + 1))
    ends = lambda at: F.reverse(F.concat(at, F.array(F.length(value) + 1)))
    runs = lambda at: F.flatten(
        F.transform(
            starts(at),
            lambda start: F.transform(
                F.filter(ends(at), lambda end: (end - start).between(13, 44)),
                lambda end: F.struct(start.alias("start"), F.substr(value, start, end - start).alias("own")),
            ),
        )
    )
    broken = lambda run: F.concat(
        F.substr(value, F.lit(1), run["start"] - 1),
        F.when(run["start"] > 1, BREAK).otherwise(""),
        run["own"],
        F.lit(BREAK),
        F.substr(value, run["start"] + F.length(run["own"])),
    )
    found = let(places, lambda at: F.get(F.filter(runs(at), lambda run: whole_value(run["own"])), F.lit(0)))
    several = value.rlike(SEPARATED) & value.rlike("[ -]") & ~value.rlike(f"^(?:{NANP}|{PHONE}|{DATE}|{SSN})$")
    invalid = F.when(value.rlike("^[A-Z]"), ~valid_iban(F.regexp_replace(value, " ", ""))).otherwise(~valid_card(only("0-9", value)))
    return F.when(several & invalid, let(found, lambda run: F.when(run.isNull(), value).otherwise(broken(run)))).otherwise(value)


def with_breaks(text: Column) -> Column:
    """``text`` with breaks inside runs that hold a valid value and more, scanned again behind each until nothing changes."""

    def again(state: Column) -> Column:
        found = lambda t: F.transform(F.regexp_extract_all(t, F.lit(ANY), 0), parted)
        made = let(
            state["text"],
            lambda t: F.array_join(
                F.zip_with(F.split(t, ANY, -1), found(t), lambda a, b: F.concat(a, F.coalesce(b, F.lit("")))), ""
            ),
        )
        return let(made, lambda new: F.struct(new.alias("text"), (new != state["text"]).alias("going")))

    rounds = F.sequence(F.lit(1), F.greatest(F.floor(F.length(text) / 13).cast("int"), F.lit(1)))  # a value has 13 signs at least
    start = F.struct(text.alias("text"), F.lit(True).alias("going"))
    return F.aggregate(rounds, start, lambda s, _: F.when(s["going"], again(s)).otherwise(s), lambda s: s["text"])


def pseudonym(value: Column, key: str) -> Column:
    """The pseudonym of one found string; null where it fails validation."""
    return (
        F.when(value.contains("@"), email(value, key))
        .when(value.rlike("^[A-Z]"), iban(value, key))
        .when(value.rlike(f"^(?:{NANP}|{PHONE})$"), phone(value, key))
        .when(value.rlike(f"^{IPV4}$"), ipv4(value, key))
        .when(value.rlike(f"^(?:{DATE})$"), date(value, key))
        .when(value.rlike(f"^{SSN}$"), ssn(value, key))
        .otherwise(card(value, key))
    )


def pseudonymise(docs: DataFrame, key: str = KEY, text: str = "text", count: str | None = "n_pseudonyms") -> DataFrame:
    """Rows of ``docs`` with every valid personal value in ``text`` replaced by its pseudonym.

    ``count`` names an added column (long) with the number of values replaced; None adds none, and a
    column of that name is replaced. Strings that fail validation stay as they are. Null texts stay
    null (count 0), empty ones empty. Equal rows give equal rows. Other columns are carried along.
    """
    whole = text_or_empty(text)
    several = whole.rlike(r"[A-Z0-9](?:[ -]?[A-Z0-9]){12}") & whole.rlike(r"[0-9][ -]") & ~whole.contains(BREAK)
    scanned, pii = unused(docs, "__scanned"), unused(docs, "__pii")
    docs = docs.withColumn(scanned, F.when(several, with_breaks(whole)).otherwise(whole))
    whole = F.col(scanned)
    candidate = whole.rlike(FIRST_SIGNS)
    found = F.when(candidate, F.regexp_extract_all(whole, F.lit(ANY), 0))
    working = docs.select("*", F.struct(found.alias("found")).alias(pii))
    made = F.transform(F.col(pii)["found"], lambda value: pseudonym(value, key))
    working = working.withColumn(
        pii, F.when(F.size(F.col(pii)["found"]) > 0, F.struct(F.col(pii)["found"].alias("found"), made.alias("made")))
    )
    between = F.split(whole, ANY, -1)
    chosen = F.zip_with(F.col(pii)["found"], F.col(pii)["made"], lambda old, new: F.coalesce(new, old))
    joined = F.array_join(F.zip_with(between, chosen, lambda a, b: F.concat(a, F.coalesce(b, F.lit("")))), "")
    out = working.withColumn(text, F.when(F.col(pii).isNull(), F.col(text)).otherwise(F.when(F.col(text).contains(BREAK), joined).otherwise(F.replace(joined, F.lit(BREAK), F.lit("")))))
    if count:
        number = F.size(F.filter(F.col(pii)["made"], lambda x: x.isNotNull()))
        out = out.withColumn(count, F.when(F.col(pii).isNull(), 0).otherwise(number).cast("long"))
    return out.drop(pii, scanned)
