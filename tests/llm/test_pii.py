from __future__ import annotations

import datetime
import re

import pytest
from conftest import frame
from pyspark.sql import functions as F

from shelfwise.llm import pii, queries


def replaced(spark, texts):
    rows = pii.pseudonymise(frame(spark, texts)).select("doc_id", "text", "n_pseudonyms").collect()
    by_id = {r["doc_id"]: (r["text"], r["n_pseudonyms"]) for r in rows}
    return [by_id[i] for i in range(len(texts))]


def luhn(number: str) -> bool:
    digits = [int(d) for d in re.sub(r"\D", "", number)][::-1]
    return sum(d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d) for i, d in enumerate(digits)) % 10 == 0


def shape(text: str) -> str:
    return re.sub("[a-z]", "a", re.sub("[A-Z]", "A", re.sub("[0-9]", "9", text)))


VALID = [
    "bob.smith@mail7.example.com", "+1 (389) 555-5010", "212-555-0199", "4387513035237269", "4387 5130 3523 7269",
    "39.197.112.39", "2024-02-29", "12/31/1999", "31.12.1999", "123-45-6789", "DE89 3704 0044 0532 0130 00",
    "GB82WEST12345698765432", "+49 30 1234567",
]
INVALID = ["4111111111111112", "999.1.1.1", "2023-02-29", "000-12-3456", "DE00 3704 0044 0532 0130 00", "1234", "a@b"]


def test_valid_values_change_within_their_format(spark):
    results = replaced(spark, [f"x {v} y" for v in VALID])
    for value, (text, n) in zip(VALID, results):
        made = text[2:-2]
        if re.fullmatch(r"[\d.]+", value) and value.count(".") == 3:  # an octet has one to three digits
            assert n == 1 and made != value and re.fullmatch(r"\d+(\.\d+){3}", made)
        else:
            assert n == 1 and made != value and shape(made) == shape(value), (value, made)
    made = [t[2:-2] for t, _ in results]
    assert luhn(made[3]) and re.sub(r"\D", "", made[3]) == re.sub(r"\D", "", made[4])  # linked across formats
    assert all(int(o) <= 255 for o in made[5].split("."))
    assert datetime.date.fromisoformat(made[6]).year // 100 == 20
    assert datetime.datetime.strptime(made[7], "%m/%d/%Y") == datetime.datetime.strptime(made[8], "%d.%m.%Y")
    assert made[0].endswith("@mail7.example.com")


def test_invalid_and_missing_values_stay(spark):
    assert replaced(spark, INVALID) == [(v, 0) for v in INVALID]
    assert replaced(spark, [None, "", "no numbers"]) == [(None, 0), ("", 0), ("no numbers", 0)]


def test_long_texts_and_many_values(spark, awkward_texts):
    long = "\n".join(f"line {i} card 4387513035237269 end" for i in range(500))
    ((text, n), *rest) = replaced(spark, [long, *awkward_texts])
    assert n == 500 and "4387513035237269" not in text and len(text) == len(long)
    assert [t for t, _ in rest] == awkward_texts


@pytest.mark.parametrize("kind", ["numbers", "text", "days"])
def test_permutations_are_one_to_one(spark, kind):
    base = spark.range(6000)
    if kind == "numbers":
        pair = pii.permute_number(F.floor(F.col("id") / 75), F.col("id") % 75, F.lit(80), F.lit(75), "k")
        made = base.select(F.concat_ws("-", pair["a"], pair["b"]).alias("m"))
    elif kind == "text":
        made = base.select(pii.permute_text(F.lpad(F.col("id").cast("string"), 4, "0"), "k").alias("m"))
    else:
        made = base.select(pii.date(F.date_format(F.date_add(F.lit("1999-12-01"), F.col("id").cast("int")), "yyyy-MM-dd"), "k").alias("m"))
    assert made.distinct().count() == 6000


def test_other_columns_stay_and_a_clashing_count_is_replaced(spark):
    docs = frame(spark, ["mail a.b@c.de"]).withColumn("n_pseudonyms", F.lit("old"))
    row = pii.pseudonymise(docs).first()
    assert row["n_pseudonyms"] == 1 and row["key"] == "k" and row["block"] == "b"
    assert pii.pseudonymise(docs.limit(0)).count() == 0
    assert "n_pseudonyms" not in pii.pseudonymise(frame(spark, ["x"]), count=None).columns


def test_query_leaves_no_card_or_address(spark, small):
    before = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    for row in queries.op2_pseudonyms(spark, small).collect():
        for value in re.findall(r"(?<!\w)(?:\d{16}|\+1 \(\d{3}\) \d{3}-\d{4}|[\w.]+@[\w.]+\.com|\d+\.\d+\.\d+\.\d+)(?!\w)", before[row["doc_id"]]):
            if luhn(value) or not value.isdigit():
                assert value not in row["text"]
            else:  # sixteen digits that are no card number
                assert value in row["text"]
        assert len(row["text"]) == len(before[row["doc_id"]]) or re.search(r"\d+\.\d+\.\d+\.\d+", before[row["doc_id"]])


def test_plan_has_no_python(spark, small):
    assert "Python" not in queries.op2_pseudonyms(spark, small)._jdf.queryExecution().executedPlan().toString()


BESIDE = [
    ("at {}T10:00:00Z", "2024-01-05"), ("call {} now", "+12125551234"), ("call {} now", "+1 2125551234"), ("call {} now", "1-800-555-0199"),
    ("tel.{}", "212-555-1234"), ("_{}_", "john@example.com"), ("-{}", "4111111111111111"), ("no.{}", "4111111111111111"),
    ("id_{}_x", "4111111111111111"), ("root@{}:", "10.0.0.5"),
]


def test_values_beside_signs_and_further_telephone_forms(spark):
    for (around, value), (text, n) in zip(BESIDE, replaced(spark, [a.format(v) for a, v in BESIDE])):
        before, behind = around.split("{}")
        made = text[len(before) : len(text) - len(behind)]
        assert n == 1 and text == before + made + behind and made != value, (value, text)
        assert "." in value or shape(made) == shape(value)
    linked = [t for t, _ in replaced(spark, ["+12125551234", "1-212-555-1234", "212-555-1234"])]
    assert len({re.sub(r"\D", "", t)[-10:] for t in linked}) == 1 and all(t.lstrip("+").startswith("1") for t in linked[:2])
    parts = ["v1.2.3.4.5", "a4111111111111111", "4111111111111111b", "2024-01-05Tuesday", "x2024-01-05"]
    assert replaced(spark, parts) == [(p, 0) for p in parts]


FOLLOWED = [
    ("4111111111111111", " 123"), ("4111 1111 1111 1111", " 12/25"), ("4111111111111111", " 2 items"), ("ES91 2100 0418 4502 0005 1332", " PARA"),
    ("4111111111111111", " 12 x"),
]


def test_runs_of_a_valid_value_and_more(spark):
    texts = [value + more for value, more in FOLLOWED]
    for (value, more), (text, n) in zip(FOLLOWED, replaced(spark, texts)):
        assert n == 1 and text.endswith(more) and value not in text and shape(text) == shape(value + more), text
    ((text, n), (other, m), (pair, k), *rest) = replaced(
        spark, ["4111111111111111 123-45-6789", "no. 12 4111111111111111", "4111111111111111 123, 4111 1111 1111 1111 99", "4111111111111112 123"]
    )
    assert n == 2 and "123-45-6789" not in text and shape(text) == "9" * 16 + " 999-99-9999"
    assert m == 1 and other.startswith("no. 12 ") and "4111111111111111" not in other
    assert k == 2 and pair.endswith(" 99") and " 123, " in pair and rest == [("4111111111111112 123", 0)]


def test_columns_with_the_operators_own_names_are_carried_along(spark):
    docs = spark.createDataFrame([(1, "mail ann@example.com", "x", "y", "z")], "doc_id long, text string, __pii string, __scanned string, __PII_ string")
    row = pii.pseudonymise(docs).first()
    assert (row["__pii"], row["__scanned"], row["__PII_"], row["n_pseudonyms"]) == ("x", "y", "z", 1) and "ann@" not in row["text"]
