"""Helpers shared by the training-data operators."""

from __future__ import annotations

import math
import sys
import types
from collections.abc import Callable, Hashable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.session import ensure_checkpoint_dir

WORD = r"[^\x20\x09-\x0D]+"

# A small side is broadcast only when its counted rows stay within this bound.
BROADCAST_ROWS = 100_000


def tokenizer_path(name: str) -> str:
    """Where the public tokenizer package keeps a vocabulary file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def per_worker(key: Hashable, make: Callable):
    """``make()``, once for each Python worker: functions that travel with a task lose their own module's state."""
    kept = sys.modules.setdefault("shelfwise_worker_state", types.ModuleType("shelfwise_worker_state"))
    if key not in kept.__dict__.setdefault("values", {}):
        kept.values[key] = make()
    return kept.values[key]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut the lineage in the shared folder, so that a lost executor repeats no earlier work."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def unused(df: DataFrame, name: str) -> str:
    """``name``, with underscores behind it as long as ``df`` has a column of that name."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def learned(doc_id: str, modulus: int, left_out: int) -> Column:
    """True for rows that training may use: crc32 of the id as text, by remainder. A null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))) % modulus != left_out


def small_side(df: DataFrame) -> DataFrame:
    """``df`` (already checkpointed) with a broadcast hint if its counted rows are few."""
    return F.broadcast(df) if df.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else df


FILTER_WORDS = 1 << 18  # of 64 bits: 16 million bits, whatever is entered


def key_filter(keys: DataFrame, columns: list[str]) -> DataFrame:
    """A bit table of hashed keys, of at most ``FILTER_WORDS`` rows: small enough to broadcast at any size of ``keys``."""
    h = F.xxhash64(*columns)
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), h.bitwiseAND(F.lit(63)).cast("int"))
    words = keys.select(F.shiftrightunsigned(h, 6).bitwiseAND(F.lit(FILTER_WORDS - 1)).alias("word"), bit.alias("bit"))
    return checkpointed(words.groupBy("word").agg(F.bit_or("bit").alias("bits")))


def with_maybe(df: DataFrame, filter_: DataFrame, columns: list[str], into: str) -> DataFrame:
    """``df`` plus ``into``: false only if a row's key is not among the filter's keys. Nulls are hashed like values."""
    h = F.xxhash64(*columns)
    known = filter_.select(F.col("word").alias("__word"), F.col("bits").alias("__bits"))
    joined = df.join(F.broadcast(known), F.shiftrightunsigned(h, 6).bitwiseAND(F.lit(FILTER_WORDS - 1)) == F.col("__word"), "left")
    bit = F.call_function("shiftright", F.col("__bits"), h.bitwiseAND(F.lit(63)).cast("int")).bitwiseAND(F.lit(1)) == 1
    return joined.withColumn(into, F.coalesce(bit, F.lit(False))).drop("__word", "__bits")


def pieces(df: DataFrame, column: str, target_bytes: int) -> int:
    """How many parts of about ``target_bytes`` the texts of ``column`` make; at least one."""
    total = df.agg(F.sum(F.octet_length(column))).first()[0] or 0
    return max(1, math.ceil(total / target_bytes))


def with_computed(
    df: DataFrame,
    into: str,
    kind: T.DataType,
    source: str,
    compute: Callable[[], Callable[[list], list]],
    slice_bytes: int = 2_000_000,
) -> DataFrame:
    """``df`` plus ``into``, computed from lists of ``source`` values in Arrow batches.

    ``compute`` is called once for a task and gives the function over lists; a list holds about
    ``slice_bytes``, so a task's memory does not follow the session's batch size. All other columns pass through as
    they are, nulls and types included; a column already named ``into`` is replaced.
    """
    kept = [f for f in df.schema.fields if f.name.lower() != into.lower()]
    schema = T.StructType([*kept, T.StructField(into, kind)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_type

        function = compute()
        for batch in batches:
            rows = max(1, slice_bytes * batch.num_rows // max(1, batch.column(source).nbytes))
            for at in range(0, batch.num_rows, rows):
                part = batch.slice(at, rows)
                values = pa.array(function(part.column(source).to_pylist()), to_arrow_type(kind))
                yield pa.RecordBatch.from_arrays([*(part.column(f.name) for f in kept), values], [*(f.name for f in kept), into])

    return df.mapInArrow(run, schema)
