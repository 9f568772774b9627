"""Cleaning pipeline over ``documents``: each stage takes (spark, docs, sf_dir) and returns a DataFrame.

Each stage's rows are written as Parquet and read again as the next one's ``docs``. All but the last
return the columns of the documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.llm import bpe, jaccard, mixing, pii, toxicity
from shelfwise.llm.common import table, tokenizer_path, unused
from shelfwise.session import discard, shared_folder


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model, learned from labelled ones among them, doesn't reject."""
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    score = unused(docs, "toxicity")
    return toxicity.score(docs, model, score).filter(F.col(score) < toxicity.THRESHOLD).drop(score)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by near-equal word shingles."""
    return jaccard.one_of_each(docs)


def replace_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with pseudonyms in place of personal data; where there were any, characters are counted anew."""
    found = unused(docs, "found")
    replaced = pii.pseudonymise(docs, count=found)
    counted = F.length("text").cast(docs.schema["n_chars"].dataType)
    return replaced.withColumn("n_chars", F.when(F.col(found) > 0, counted).otherwise(F.col("n_chars"))).select(docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them: a document taken twice is two rows."""
    return mixing.repeated(mixing.mix(docs)).select(docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their token ids (binary, little-endian 32-bit) and the number of them."""
    encoded = bpe.encode(docs, tokenizer_path("byte_bpe_50k.json"), "ids")
    return encoded.withColumn("n_tokens", (F.octet_length("ids") / 4).cast("long"))


STAGES = [
    ("toxicity", drop_toxic),
    ("near_copies", drop_near_copies),
    ("personal_data", replace_personal_data),
    ("mixing", mix_sources),
    ("bpe", encode),
]

# Trained scores, hashed signatures and keyed permutations have no SQL form; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``; what one stage has stored is removed when the next one's rows are."""
    docs, path = table(spark, sf_dir, "documents"), None
    for _, stage in STAGES[:-1]:
        rows, before, path = stage(spark, docs, sf_dir), path, shared_folder(spark)
        rows.write.parquet(path)
        docs = spark.read.schema(rows.schema).parquet(path)
        if before:
            discard(spark, before)
    return STAGES[-1][1](spark, docs, sf_dir)
