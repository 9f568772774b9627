"""Interaction audit of filters by sorted posting lists.

Every filter keeps, per part of the corpus and range of row numbers, the sorted list of the rows that
fail it. After a set of filters the union of their lists is gone, and a next filter removes the difference of its
list and that union. So each set and each filter outside it answers a step of every order that begins with that
set. Unions and differences are galloping merges inside a range, and their sizes are summed over the ranges.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.common import WORD, checkpointed
from shelfwise.operators.numbering import numbered
from shelfwise.session import staging, stored

RANGE = 1 << 13  # row numbers of one range: what one task holds of a list
STRIDE = 2048  # row numbers that one step of a merge takes at most


def gallop(ids: np.ndarray, target: int, at: int) -> int:
    """First place from ``at`` on whose id is at least ``target``: steps double until they pass it, then it is searched."""
    step, end = 1, at
    while end < len(ids) and ids[end] < target:
        at, end, step = end + 1, end + step, step * 2
    return at + int(np.searchsorted(ids[at : min(end, len(ids))], target))


def union(lists: list[np.ndarray]) -> np.ndarray:
    """Merge of sorted lists without repeats.

    From the smallest head on, each list gallops to the end of a stride. Ids that only one list has up to the
    next list's head are taken as they are; where lists overlap, the strides are merged.
    """
    at, out = [0] * len(lists), []
    while True:
        heads = [int(ids[i]) if i < len(ids) else None for ids, i in zip(lists, at)]
        live = sorted((h, k) for k, h in enumerate(heads) if h is not None)
        if not live:
            return np.concatenate(out) if out else np.zeros(0, np.int64)
        low, first = live[0]
        if len(live) == 1:
            out.append(lists[first][at[first] :])
            at[first] = len(lists[first])
        elif live[1][0] > low + STRIDE:
            stop = gallop(lists[first], live[1][0], at[first])
            out.append(lists[first][at[first] : stop])
            at[first] = stop
        else:
            ends = [gallop(ids, low + STRIDE, i) for ids, i in zip(lists, at)]
            out.append(np.unique(np.concatenate([ids[i:j] for ids, i, j in zip(lists, at, ends)])))
            at = ends


def difference(ids: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Ids of a sorted list that another lacks: runs between the other's ids as they are, strides where both overlap."""
    i, j, out = 0, 0, [ids[:0]]
    while i < len(ids):
        low = int(ids[i])
        j = gallop(other, low, j)
        if j == len(other) or int(other[j]) > low + STRIDE:
            stop = gallop(ids, int(other[j]), i) if j < len(other) else len(ids)
            out.append(ids[i:stop])
        else:
            stop, end = gallop(ids, low + STRIDE, i), gallop(other, low + STRIDE, j)
            out.append(np.setdiff1d(ids[i:stop], other[j:end], assume_unique=True))
            j = end
        i = stop
    return np.concatenate(out)


def flagged(docs: DataFrame, filters: dict[str, Column], part: Column, keys: dict[str, Column]) -> DataFrame:
    """Per row: part, doc_id, one flag per filter (unknown counts as passed), and the keys asked for."""
    flags = [F.coalesce(c, F.lit(False)).alias(f"fails_{name}") for name, c in filters.items()]
    return docs.select(part.alias("part"), "doc_id", *flags, *(c.alias(name) for name, c in keys.items()))


def later_copies(rows: DataFrame, key: str, name: str) -> DataFrame:
    """``rows`` (stored) plus a flag: an equal ``key`` stands in a row with a smaller doc_id.

    Ids are aggregated per key in the map tasks; only keys of more than one id are joined back, and
    a key of very many rows is left to skew splitting. Rows without an id are neither copies nor originals.
    """
    first = rows.groupBy(key).agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
    repeated = stored(first.filter("first < last").select(key, "first"))
    flag = F.coalesce(F.col("doc_id") > F.col("first"), F.lit(False))
    return rows.join(repeated, key, "left").select(*rows.columns, flag.alias(name)).drop(key)


def posting_lists(rows: DataFrame, filters: list[str], labels: list[str]) -> DataFrame:
    """(part, range, rows, one sorted list of row numbers per filter and label) of rows with ``id`` and flags.

    A range holds at most ``RANGE`` row numbers, whatever the sizes of the parts.
    """
    lists = [
        F.array_sort(F.collect_list(F.when(F.col(c), F.col("id")))).alias(c) for c in [f"fails_{f}" for f in filters] + labels
    ]
    return rows.groupBy("part", F.shiftright("id", RANGE.bit_length() - 1).alias("range")).agg(F.count("*").alias("rows"), *lists)


def named(filters) -> str:
    return ",".join(filters)


def removals(lists: DataFrame, filters: list[str], labels: list[str]) -> DataFrame:
    """What each filter removes after each set of others, by part.

    One row per part, set (``before``) and other filter (``name``): rows of the part, gone (the set's union),
    failing (the filter's own list), removed (what of it the union lacks), and removed_<label> for rows of each label.
    """
    counts = ["rows", "gone", "failing", "removed", *(f"removed_{label}" for label in labels)]
    sets = [[f for i, f in enumerate(filters) if bits >> i & 1] for bits in range(1 << len(filters))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: dict[str, list] = {c: [] for c in ("part", "before", "name", *counts)}
            columns = {c: batch.column(c) for c in [f"fails_{f}" for f in filters] + labels}
            for k, (part, rows) in enumerate(zip(batch.column("part").to_pylist(), batch.column("rows").to_pylist())):
                ids = {c: column[k].values.to_numpy() for c, column in columns.items()}
                for chosen in sets:
                    gone = union([ids[f"fails_{f}"] for f in chosen])
                    for name in filters:
                        if name in chosen:
                            continue
                        failing = ids[f"fails_{name}"]
                        removed = difference(failing, gone)
                        lost = [len(removed) - len(difference(removed, ids[label])) for label in labels]
                        for c, value in zip(out, (part, named(chosen), name, rows, len(gone), len(failing), len(removed), *lost)):
                            out[c].append(value)
            yield pa.RecordBatch.from_pydict(out, schema)

    schema = pa.schema([*((c, pa.string()) for c in ("part", "before", "name")), *((c, pa.int64()) for c in counts)])
    ddl = "part string, before string, name string, " + ", ".join(f"{c} long" for c in counts)
    return lists.mapInArrow(run, ddl).groupBy("part", "before", "name").agg(*(F.sum(c).alias(c) for c in counts))


def steps_table(spark, filters: list[str]) -> DataFrame:
    """(filter_order, step, before, name): the filters before each step of each order; fixed by their number."""
    rows = [
        ("".join(order), k + 1, named(f for f in filters if f in order[:k]), name)
        for order in permutations(filters)
        for k, name in enumerate(order)
    ]
    return spark.createDataFrame(rows, "filter_order string, step int, before string, name string")


def interactions(removed: DataFrame, filters: list[str], labels: dict[str, str]) -> DataFrame:
    """One row per part, order of filters and step, from ``removals``. ``labels`` maps a label to its output column.

    shapley sums what the step's filter removes over all orders.
    """
    others = F.size(F.split("before", ",")) == len(filters) - 1 if len(filters) > 2 else F.length("before") > 0
    alone = F.max(F.when(others if len(filters) > 1 else F.lit(True), F.col("removed")))
    unique = removed.groupBy("part", "name").agg(alone.alias("unique_fails"))
    rows = F.broadcast(steps_table(removed.sparkSession, filters)).join(removed, ["before", "name"])
    shapley = rows.groupBy("part", "name").agg(F.sum("removed").alias("shapley"))
    return rows.join(unique, ["part", "name"]).join(shapley, ["part", "name"]).select(
        "part", "filter_order", "step",
        (F.col("rows") - F.col("gone") - F.col("removed")).alias("kept"),
        "removed",
        (F.col("failing") - F.col("removed")).alias("redundant"),
        "unique_fails",
        *(F.col(f"removed_{label}").alias(column) for label, column in labels.items()),
        "shapley",
    )


def text_filters() -> dict[str, Column]:
    """Filters of ``text``: few words, repeated words, capitals, signs. Null texts are empty."""
    text = F.coalesce("text", F.lit(""))
    words = F.regexp_extract_all(text, F.lit(f"({WORD})"), F.lit(1))
    capitals = F.length(text) - F.length(F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))
    return {
        "A": F.size(words) < 100,
        "B": 100 * F.size(F.array_distinct(words)) < 80 * F.size(words),
        "C": 100 * capitals > 10 * F.length(text),
        "D": text.rlike("[#$%&*|]"),
    }


def audit(
    docs: DataFrame,
    labels: DataFrame,
    filters: Callable[[], dict[str, Column]] = text_filters,
    copies: str | None = "E",
    part: str = "lang",
) -> DataFrame:
    """Interactions of the filters, and of ``copies`` (texts equal to one with a smaller doc_id), on ``docs``.

    Every row is a document of its own, rows with equal or null ids included; a null part is the empty one. A
    document is good or toxic if any row of ``labels`` says so of its id. Unknown filter results pass. Other columns of both tables
    are left out; an empty table gives no rows. The result is checkpointed and what was stored on the way is removed.
    """
    with staging(docs.sparkSession):
        chosen = filters()
        keys = {"digest": F.unhex(F.sha2(F.coalesce("text", F.lit("")), 256))} if copies else {}
        rows = numbered(flagged(docs, chosen, F.coalesce(F.col(part).cast("string"), F.lit("")), keys))
        names = [*chosen, *([copies] if copies else [])]
        if copies:
            rows = later_copies(rows, "digest", f"fails_{copies}")
        marked = labels.filter("doc_id is not null and (quality = 1 or toxic = 1)").groupBy("doc_id").agg(
            F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"),
            F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("bad"),
        )
        rows = rows.join(stored(marked), "doc_id", "left").drop("doc_id")
        lists = posting_lists(rows, names, ["good", "bad"])
        removed = stored(removals(lists, names, ["good", "bad"]))
        return checkpointed(interactions(removed, names, {"good": "good_lost", "bad": "toxic_lost"}))
