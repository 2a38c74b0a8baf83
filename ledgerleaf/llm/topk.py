"""Exact top-k inner products by exhaustive term-at-a-time accumulation.

Components become integers floor(scale * x), x as double, without bounds.  Queries come in blocks of
``QUERY_BLOCK``, candidates in blocks of ``CANDIDATE_BLOCK``; each pair of blocks is a cell of its own task group,
and both sides of a cell are bounded.  In a cell, every dimension has a postings list (the candidates with a non-zero
component there); a query's non-zero components scatter weight times posting into a dense score array; a partition
selection keeps its k best and a final merge ranks the cells' survivors.

Scores are exact: before a query is scored, the greatest sum its cell could reach is bounded, and where that is beyond
a 64-bit integer the same accumulation runs on Python's integers.  A score that no long holds is given as the
nearest long; its rank follows the exact value.

Vectors that are null or hold a null or non-finite component take no part; nor do null vec_ids.  A missing
component of a shorter vector counts as zero.  A query's candidates are all rows but its own: other rows that have its
vec_id are candidates.  Rows that repeat a query (same vec_id, same vector) are one query, whose candidates hold the
repeats but one.  Queries of one vec_id and different vectors are ranked apart.  Ties rank by smaller vec_id, then
arbitrarily among rows of one vec_id.  Columns beside the two named are ignored; empty tables give empty results.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from . import common

K, SCALE, EVERY = 10, 1024, 100
QUERY_BLOCK, CANDIDATE_BLOCK = 16_384, 16_384
#: Scores below this in size are summed as 64-bit integers.
SAFE = float(1 << 62)
LONG = (-(1 << 63), (1 << 63) - 1)
#: Bytes of the sort key of a score beyond a long: products of two doubles stay under 2 ** 2200.
KEY = 320


def finite_vectors(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id, v array<double>) of the rows that take part."""
    x = F.col(f"`{vector_col}`").cast("array<double>")
    key = F.col(f"`{id_col}`").cast("long")
    return vectors.select(key.alias("vec_id"), x.alias("v")).where(F.col("vec_id").isNotNull() & F.col("v").isNotNull() & ~F.exists(
        "v",
        lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")),
    ))


def integers(x: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x) as 64-bit integers, or as Python's where one does not fit."""
    if not len(x) or np.abs(x).max() * scale < SAFE:
        return np.floor(x * scale).astype(np.int64)
    # from 2 ** 53 on, a double is a whole number
    return np.array([math.floor(v * scale) if abs(v) < 1 << 53 else int(v) * scale for v in x.tolist()], object)


class Postings:
    """Per dimension, the candidates with a non-zero component and the components."""

    def __init__(self, vectors: list[np.ndarray], scale: int = SCALE):
        self.n = len(vectors)
        lengths = np.fromiter(map(len, vectors), np.int64, self.n)
        flat = integers(np.concatenate(vectors).astype(float) if self.n else np.zeros(0), scale)
        rows = np.repeat(np.arange(self.n), lengths)
        dims = np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        use = flat != 0
        rows, dims, flat = rows[use], dims[use], flat[use]
        order = np.argsort(dims, kind="stable")
        rows, flat = rows[order], flat[order]
        ends = np.searchsorted(dims[order], np.arange(int(lengths.max(initial=0)) + 1))
        self.lists = [(slice(None) if b - a == self.n else rows[a:b], flat[a:b]) for a, b in zip(ends, ends[1:])]
        self.most = [max((abs(x) for x in (v.min(), v.max())), default=0) if len(v) else 0 for _, v in self.lists]

    def scores(self, query: np.ndarray) -> np.ndarray:
        weights = [int(w) for w in query.tolist()]
        # Python's integers: the bound itself cannot overflow
        fits = sum(abs(w) * int(m) for w, m in zip(weights, self.most)) < SAFE
        out = np.zeros(self.n, np.int64) if fits else np.array([0] * self.n, object)
        for weight, (rows, values) in zip(weights, self.lists):
            if weight and len(values):
                out[rows] += weight * values if fits and values.dtype != object else weight * values.astype(object)
        return out


def select(scores: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k highest scores, ties to the smaller position."""
    if scores.dtype == object or len(scores) <= k:
        return np.array(sorted(range(len(scores)), key=lambda i: (-scores[i], i))[:k], np.int64)
    least = np.partition(scores, len(scores) - k)[len(scores) - k]
    above = np.flatnonzero(scores > least)
    level = np.flatnonzero(scores == least)[: k - len(above)]
    best = np.concatenate([above, level])
    return best[np.lexsort((best, -scores[best]))]


def sort_key(score: int) -> bytes | None:
    """Bytes that order scores no long holds; None for all others."""
    return None if LONG[0] < score < LONG[1] else (score + (1 << (8 * KEY - 1))).to_bytes(KEY, "big")


CELL = "query_id long, query long, vec_id long, score long, beyond binary"


def _cell(k: int, scale: int):
    def run(key, queries: pd.DataFrame, candidates: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(queries) and len(candidates):
            candidates = candidates.sort_values("vec_id", kind="stable")
            ids = candidates["vec_id"].to_numpy(np.int64)
            vectors = list(candidates["v"])
            index = Postings(vectors, scale)
            for q, tag, v in zip(queries["vec_id"].to_numpy(np.int64), queries["query"], queries["v"]):
                score = index.scores(integers(np.asarray(v, float), scale))
                best = select(score, k + 1)
                # the query's own row: one of its vec_id and vector
                lo, hi = np.searchsorted(ids, q, "left"), np.searchsorted(ids, q, "right")
                own = next((i for i in range(lo, hi) if np.array_equal(vectors[i], v)), -1)
                best = best[best != own][:k]
                exact = [int(x) for x in score[best]]
                row = {"query_id": q, "query": tag, "vec_id": ids[best], "score": np.array([min(max(x, LONG[0]), LONG[1]) for x in exact], np.int64)}
                out.append(pd.DataFrame({**row, "beyond": [sort_key(x) for x in exact]}))
        if not out:
            return pd.DataFrame({c.split()[0]: [] for c in CELL.split(", ")})
        return pd.concat(out)

    return run


def top_k(queries: DataFrame, candidates: DataFrame, k: int = K, query_block: int = QUERY_BLOCK, candidate_block: int = CANDIDATE_BLOCK, scale: int = SCALE) -> DataFrame:
    """(query_id, rank, vec_id, score) for vectors (vec_id, v) as ``finite_vectors`` gives them.

    The grid of cells repeats a query once a candidate block and a candidate once a query block: the whole work
    is queries times candidates, and no task holds more than one block of each.
    """
    spark = queries.sparkSession
    common.ship(spark)
    queries = queries.select("vec_id", "v").distinct()
    nq, nc = queries.count(), candidates.count()
    qs, cs = max(1, -(-nq // query_block)), max(1, -(-nc // candidate_block))
    # at least as many cells as tasks can run at once, as long as blocks stay of some size
    cs = max(cs, min(common.partitions(spark) // qs, -(-nc // 1024)))
    tag = F.xxhash64("vec_id", "v")
    q = queries.withColumn("query", tag).withColumn("q", F.pmod("query", F.lit(qs)).cast("int")).withColumn(
        "c",
        F.explode(F.sequence(F.lit(0), F.lit(cs - 1))),
    )
    c = candidates.select("vec_id", "v").withColumn("c", F.pmod(tag, F.lit(cs)).cast("int")).withColumn(
        "q",
        F.explode(F.sequence(F.lit(0), F.lit(qs - 1))),
    )
    found = q.groupBy("q", "c").cogroup(c.groupBy("q", "c")).applyInPandas(_cell(k, scale), CELL)
    order = Window.partitionBy("query_id", "query").orderBy(F.desc("score"), F.desc("beyond"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op10_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = finite_vectors(common.table(spark, sf_dir, "embeddings"), "vec_id", "embedding")
    return top_k(vectors.where(F.col("vec_id") % EVERY == 0), vectors)


QUERIES = {"op10_exact_top_k": op10_exact_top_k}
ORACLES = {
    "op10_exact_top_k": """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_sum(list_transform(list_zip(q.e, c.e), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
WHERE rank <= 10
""",
}
