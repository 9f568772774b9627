"""Exact top-k search by inner product: a Voronoi join of queries and data.

Every vector belongs to the cell of its nearest pivot. Summaries of the cells (the k + 1 vectors
nearest to each pivot, the widest query of each cell) give each group of queries a score that its
k-th best partner reaches at least. A data vector is sent to a group only if its upper bound there
reaches that score; each group is then solved block by block, and the blocks' best are merged.

With group pivot p, widest query distance u, cell pivot c and a vector x at distance d from c:
    q.x >= p.c - u|c| - |p|d - ud    and    q.x <= p.x + u|x|    for every query q of the group.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.llm.common import checkpointed

RESULT = "query_id long, rank int, vec_id long, score long"
SAMPLE = 512


def scaled(values: pd.Series, dimensions: int) -> tuple[np.ndarray, np.ndarray]:
    """floor(64 x) of each vector, padded with zeros, and which vectors take part."""
    out = np.zeros((len(values), dimensions))
    for i, value in enumerate(values):
        if value is not None:
            out[i, : len(value)] = np.asarray(value, float)
    usable = np.array([v is not None for v in values], bool) & np.isfinite(out).all(axis=1)
    out[~usable] = 0
    return np.floor(64 * out), usable


def chosen_pivots(sample: np.ndarray, count: int) -> np.ndarray:
    """Farthest-first: each next pivot is the sampled vector farthest from those before."""
    picked = [0]
    distance = np.linalg.norm(sample - sample[0], axis=1)
    while len(picked) < min(count, len(sample)) and distance.max() > 0:
        picked.append(int(distance.argmax()))
        distance = np.minimum(distance, np.linalg.norm(sample - sample[picked[-1]], axis=1))
    return sample[picked]


def distances(vectors: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    squares = (vectors**2).sum(1)[:, None] + (pivots**2).sum(1) - 2 * vectors @ pivots.T
    return np.sqrt(np.maximum(squares, 0))


def reached_scores(pivots: np.ndarray, near: pd.DataFrame, widest: np.ndarray, k: int) -> np.ndarray:
    """For each group of queries, a score that at least k vectors other than the query's own reach."""
    cell, d = near["cell"].to_numpy(), near["distance"].to_numpy()
    length = np.linalg.norm(pivots, axis=1)
    bound = (
        (pivots @ pivots.T)[:, cell] - widest[:, None] * length[cell] - np.outer(length, d) - np.outer(widest, d)
    )
    if bound.shape[1] <= k:
        return np.full(len(pivots), -math.inf)
    reached = np.sort(bound, axis=1)[:, -(k + 1)]
    return reached - 1e-9 * np.abs(bound).max() - 1e-6  # rounding


def best_of_block(
    queries: np.ndarray, query_ids: np.ndarray, data: np.ndarray, ids: np.ndarray, k: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The k best of one block for each query: query index, data index, score. ``ids`` ascend."""
    largest = max(1, np.abs(queries).max(initial=0)) * max(1, np.abs(data).max(initial=0)) * queries.shape[1]
    if largest * len(ids) < 2**52:
        score = (queries.astype(float) @ data.T.astype(float)).astype(np.int64)
        order = score * len(ids) + np.arange(len(ids))[::-1]  # ties: the smaller id is larger here
        order[query_ids[:, None] == ids] = -(2**62)
        kept = min(k, len(ids))
        top = np.argpartition(-order, kept - 1, axis=1)[:, :kept]
    else:
        score = queries @ data.T
        own = query_ids[:, None] == ids
        top = np.array([np.lexsort((ids, -s.astype(float), o))[:k] for s, o in zip(score, own)])
    row = np.repeat(np.arange(len(queries)), top.shape[1])
    column = top.ravel()
    other = query_ids[row] != ids[column]
    return row[other], column[other], score[row, column][other]


def search(
    vectors: DataFrame,
    is_query: Column,
    k: int = 20,
    pivots: int = 16,
    block_rows: int = 20_000,
    query_rows: int = 1024,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: each query's k highest integer inner products of floor(64 x).

    ``pivots`` are picked from a sample of 512 rows; they only steer the partition, never the result. A task
    holds ``block_rows`` data vectors against ``query_rows`` queries at most, about; larger cells are salted.

    Vectors that are null or hold null or non-finite components take no part; rows with a null id neither.
    Shorter vectors count as padded with zeros. Equal rows count once; rows that share the query's id count
    as its own and are no candidates. Ties go to the smaller id. Fewer candidates than k are all
    returned; an empty table gives an empty result. Other columns are ignored.
    """
    spark = vectors.sparkSession
    source = vectors.select(
        F.col(vec_id).cast("long").alias("vec_id"), F.col(embedding).alias("embedding"), is_query.alias("is_query")
    ).filter(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull())
    dimensions = source.agg(F.max(F.size("embedding"))).first()[0]
    if not dimensions:
        return spark.createDataFrame([], RESULT)
    sample = source.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).select("embedding").toPandas()
    values, usable = scaled(sample["embedding"], dimensions)
    centres = chosen_pivots(values[usable], pivots) if usable.any() else np.zeros((1, dimensions))

    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            values, usable = scaled(batch["embedding"], dimensions)
            batch, values = batch[usable], values[usable]
            far = distances(values, centres)
            yield pd.DataFrame(
                {
                    "vec_id": batch["vec_id"],
                    "v": [x.tobytes() for x in values.astype("<i8")],
                    "is_query": batch["is_query"].fillna(False).astype(bool),
                    "cell": far.argmin(axis=1).astype("int32"),
                    "distance": far.min(axis=1),
                }
            )

    assigned = checkpointed(
        source.mapInPandas(assign, "vec_id long, v binary, is_query boolean, cell int, distance double").dropDuplicates(
            ["vec_id", "v"]
        )
    )
    nearest = Window.partitionBy("cell").orderBy("distance", "vec_id")
    near = (
        assigned.select("cell", "distance", "vec_id")
        .withColumn("n", F.row_number().over(nearest))
        .filter(F.col("n") <= k + 1)
        .select("cell", "distance")
        .toPandas()
    )
    counts = assigned.groupBy("cell", "is_query").agg(F.max("distance").alias("widest"), F.count("*").alias("n")).toPandas()
    of_queries = counts[counts["is_query"]].set_index("cell")
    if of_queries.empty:
        return spark.createDataFrame([], RESULT)
    widest = np.zeros(len(centres))
    widest[of_queries.index] = of_queries["widest"]
    reached = reached_scores(centres, near, widest, k)
    reached[[i for i in range(len(centres)) if i not in of_queries.index]] = math.inf
    chunks = np.zeros(len(centres), int)
    chunks[of_queries.index] = -(-of_queries["n"] // query_rows)
    first = np.cumsum(chunks) - chunks
    salts = max(1, math.ceil(counts["n"].sum() / block_rows))

    def replicate(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            values = np.array([np.frombuffer(v, "<i8") for v in batch["v"]], float).reshape(len(batch), dimensions)
            bound = values @ centres.T + np.linalg.norm(values, axis=1)[:, None] * widest
            row, group = np.nonzero(bound >= reached)
            each = chunks[group]
            row, group = np.repeat(row, each), np.repeat(group, each)
            part = first[group] + np.arange(len(group)) - np.repeat(np.cumsum(each) - each, each)
            out = batch.iloc[row][["vec_id", "v"]].reset_index(drop=True)
            yield out.assign(part=part.astype("int32"), salt=(out["vec_id"] % salts).astype("int32"))

    data = assigned.select("vec_id", "v").mapInPandas(replicate, "vec_id long, v binary, part int, salt int")
    start = F.element_at(F.array(*[F.lit(int(x)) for x in first]), F.col("cell") + 1)
    width = F.element_at(F.array(*[F.lit(int(x)) for x in np.maximum(chunks, 1)]), F.col("cell") + 1)
    asked = assigned.filter("is_query").select(
        F.col("vec_id").alias("query_id"),
        "v",
        (start + F.pmod(F.xxhash64("vec_id"), width)).cast("int").alias("part"),
        F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"),
    )

    def solve(block: pd.DataFrame, wanted: pd.DataFrame) -> pd.DataFrame:
        if block.empty or wanted.empty:
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype("int64")
        block = block.sort_values("vec_id", kind="stable")
        matrix = lambda column: np.frombuffer(b"".join(column), "<i8").reshape(len(column), dimensions)
        ids, query_ids = block["vec_id"].to_numpy(), wanted["query_id"].to_numpy()
        row, column, score = best_of_block(matrix(wanted["v"]), query_ids, matrix(block["v"]), ids, k)
        return pd.DataFrame({"query_id": query_ids[row], "vec_id": ids[column], "score": score})

    solved = (
        data.groupBy("part", "salt")
        .cogroup(asked.groupBy("part", "salt"))
        .applyInPandas(solve, "query_id long, vec_id long, score long")
    )
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        solved.withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
