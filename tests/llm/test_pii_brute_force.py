"""Pseudonyms of whole texts against a plain scan and Feistel networks written without Spark."""

from __future__ import annotations

import datetime
import hashlib
import random

import regex

from conftest import prose
from shelfwise.llm import pii

KEY = pii.KEY
FIND = regex.compile(pii.ANY, regex.ASCII)


def digest(*parts):
    return hashlib.sha256("|".join(map(str, parts)).encode()).hexdigest()


def shifted(sign, by):
    for first, size in ((48, 10), (65, 26), (97, 26), (192, 8), (200, 2)):
        if first <= ord(sign) < first + size:
            return chr(first + (ord(sign) - first + by) % size)
    return sign


def shift_text(value, drawn):
    return "".join(shifted(c, int(drawn[(i * 4) % 60 : (i * 4) % 60 + 5], 16)) for i, c in enumerate(value))


def permute_text(value, key):
    a, b = value[: len(value) // 2], value[len(value) // 2 :]
    for r in range(8):
        if r % 2 == 0:
            a = shift_text(a, digest(key, r, b.lower()))
        else:
            b = shift_text(b, digest(key, r, a.lower()))
    return a + b


def permute_number(a, b, highs, lows, key):
    for r in range(8):
        if r % 2 == 0:
            a = (a + int(digest(key, r, b)[:12], 16)) % highs
        else:
            b = (b + int(digest(key, r, a)[:12], 16)) % lows
    return a, b


def luhn(digits):
    doubled = [int(d) if i % 2 == 0 else sum(divmod(2 * int(d), 10)) for i, d in enumerate(reversed(digits))]
    return sum(doubled) % 10 == 0


def refilled(template, keep, filling):
    new = iter(filling)
    return "".join(next(new) if keep(c) else c for c in template)


def card(value):
    digits = "".join(c for c in value if c.isdigit())
    if not luhn(digits):
        return None
    body = digits[0] + permute_text(digits[1:-1], KEY + ":card")
    return refilled(value, str.isdigit, body + next(str(d) for d in range(10) if luhn(body + str(d))))


def remainder(bare):
    return int("".join(str(int(c, 36)) for c in bare[4:] + bare[:4])) % 97


def iban(value):
    bare = value.replace(" ", "")
    if not 15 <= len(bare) <= 34 or remainder(bare) != 1:
        return None
    body = permute_text(bare[4:], KEY + ":iban")
    check = 98 - remainder(bare[:2] + "00" + body)
    return refilled(value, str.isalnum, f"{bare[:2]}{check:02d}{body}")


def phone(value):
    digits = "".join(c for c in value if c.isdigit())
    american = not value.startswith("+") or value.startswith("+1")
    if american:
        country = "1" if digits.startswith("1") and (value.startswith("+1") or value.startswith("1")) else ""
        if len(digits) - len(country) != 10:
            return None
        to = {str(d): chr(200 + d) if d < 2 else chr(190 + d) for d in range(10)}
        back = {v: k for k, v in to.items()}
        own = digits[-10:]
        hidden = to[own[0]] + own[1:3] + to[own[3]] + own[4:]
        made = "".join(back.get(c, c) for c in permute_text(hidden, KEY + ":phone"))
        return refilled(value, str.isdigit, country + made)
    if not 8 <= len(digits) <= 15:
        return None
    country = regex.match(r"\+(1|[0-9]{1,3})", value)[1]
    return refilled(value, str.isdigit, country + permute_text(digits[len(country) :], KEY + ":phone"))


def ipv4(value):
    o = [int(x) for x in value.split(".")]
    if max(o) > 255:
        return None
    a, b = permute_number(o[0] * 256 + o[1], o[2] * 256 + o[3], 65536, 65536, KEY + ":ip")
    return f"{a // 256}.{a % 256}.{b // 256}.{b % 256}"


def ssn(value):
    area, group, serial = map(int, value.split("-"))
    if not 1 <= area <= 899 or area == 666 or not group or not serial:
        return None
    index = area - 2 if area > 666 else area - 1
    a, b = permute_number(index * 99 + group - 1, serial - 1, 898 * 99, 9999, KEY + ":ssn")
    place = a // 99
    return f"{place + 2 if place >= 665 else place + 1:03d}-{a % 99 + 1:02d}-{b + 1:04d}"


def made_date(y, m, d):
    try:
        return datetime.date(int(y), int(m), int(d))
    except ValueError:
        return None


def date(value):
    x, y, z = regex.split("[-/.]", value)
    month_first = "/" in value and made_date(z, x, y) is not None
    day = made_date(x, y, z) if "-" in value else made_date(z, x, y) if month_first else made_date(z, y, x)
    if day is None or day.year < 100:
        return None
    century = day.year // 100
    highs, lows = (75, 487) if century % 4 == 0 else (92, 397)
    start = datetime.date(century * 100, 1, 1)
    index = (day - start).days
    a, b = permute_number(index // lows, index % lows, highs, lows, KEY + ":date")
    new = start + datetime.timedelta(a * lows + b)
    if "-" in value:
        return new.isoformat()
    m, d = (f"{new.month:02d}", f"{new.day:02d}") if len(value) == 10 else (str(new.month), str(new.day))
    return f"{m}/{d}/{new.year}" if month_first else f"{d}/{m}/{new.year}" if "/" in value else f"{d}.{m}.{new.year}"


def email(value):
    name, host = value.split("@", 1)
    return f"{permute_text(name, KEY + ':mail')}@{host}"


def pseudonym(value):
    whole = lambda pattern: regex.fullmatch(pattern, value, regex.ASCII) is not None
    if "@" in value:
        return email(value)
    if "A" <= value[0] <= "Z":
        return iban(value)
    for pattern, made in ((f"{pii.NANP}|{pii.PHONE}", phone), (pii.IPV4, ipv4), (pii.DATE, date), (pii.SSN, ssn)):
        if whole(pattern):
            return made(value)
    return card(value)


def replaced(text):
    """The text with each valid value found from left to right replaced, and the number of them."""
    found = FIND.findall(text)
    made = [pseudonym(v) for v in found]
    out, at = [], 0
    for m, new in zip(FIND.finditer(text), made):
        out += [text[at : m.start()], m[0] if new is None else new]
        at = m.end()
    return "".join(out) + text[at:], sum(new is not None for new in made)


def with_check(body):
    return body + next(str(d) for d in range(10) if luhn(body + str(d)))


def made_values(draw):
    digits = lambda n: "".join(draw.choices("0123456789", k=n))
    number = with_check(draw.choice("3456") + digits(14))
    body = "".join(draw.choices("0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ", k=18))
    account = next(f"DE{c:02d}{body}" for c in range(2, 99) if remainder(f"DE{c:02d}{body}") == 1)
    day = datetime.date(draw.randint(1901, 2099), 1, 1) + datetime.timedelta(draw.randint(0, 364))
    return [
        f"{draw.choice(['ann', 'j.o_hn', 'x'])}{digits(3)}@{draw.choice(['example.com', 'mail.example.org'])}",
        number, " ".join(number[i : i + 4] for i in range(0, 16, 4)), number[:-1] + str((int(number[-1]) + 1) % 10),
        account, " ".join(account[i : i + 4] for i in range(0, len(account), 4)), account[:-1] + ("A" if account[-1] != "A" else "B"),
        f"({draw.randint(200, 999)}) 555-{digits(4)}", f"+1 {draw.randint(200, 999)}-555-{digits(4)}", f"1-800-555-{digits(4)}", f"+49 30 {digits(4)} {digits(4)}",
        f"{draw.randint(0, 255)}.{draw.randint(0, 255)}.{draw.randint(0, 300)}.{draw.randint(0, 255)}",
        f"{draw.randint(0, 999):03d}-{digits(2)}-{digits(4)}", day.isoformat(), f"{day.month}/{day.day}/{day.year}", f"{day:%d.%m.%Y}", "2023-02-30", "31/02/2001", digits(8),
    ]


def test_made_values_and_texts_equal_brute_force(spark):
    draw = random.Random(11)
    values = [v for _ in range(25) for v in made_values(draw)]
    texts = [f"{prose(k, 3)}, {v}; {prose(k + 1, 2)}" for k, v in enumerate(values)]
    texts += [f"{prose(k, 5)} ({draw.choice(values)}) {prose(k, 4)}: {draw.choice(values)}!" for k in range(60)]
    texts += [prose(3, 500), "", "no values 12 @ here", f"_{values[0]}_ -{values[1]} tel.{values[7]}"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = {r["doc_id"]: (r["text"], r["n_pseudonyms"]) for r in pii.pseudonymise(docs).collect()}
    for k, text in enumerate(texts):
        assert rows[k] == replaced(text), text


def test_every_document_equals_brute_force(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text")
    rows = {r["doc_id"]: (r["text"], r["n_pseudonyms"]) for r in pii.pseudonymise(docs).collect()}
    n = 0
    for r in docs.collect():
        if r["text"] is not None:
            assert rows[r["doc_id"]] == replaced(r["text"]), r["doc_id"]
            n += rows[r["doc_id"]][1]
    assert n > 0
