"""Documents in ascending doc_id order, in shards of bounded size, without one task that sees all."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

LOWEST = -(2**63)


def with_shard(docs: DataFrame, shards: int) -> tuple[DataFrame, list[int]]:
    """docs with ``key`` (doc_id, null lowest) and ``shard``, and the shards' bounds.

    Bounds are quantiles of the key alone (shards - 1 longs on the driver).  Equal keys share a shard.
    """
    keyed = docs.withColumn("key", F.coalesce(F.col("doc_id").cast("long"), F.lit(LOWEST)))
    bounds: list[int] = []
    if shards > 1:
        at = keyed.select("key").agg(F.percentile_approx(
            "key",
            [i / shards for i in range(1, shards)],
            max(10_000, 20 * shards),
        ).alias("b")).first().b
        bounds = sorted(set(at or []))
    edges = np.array(bounds, np.int64)

    @F.pandas_udf("int")
    def shard_of(key: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(edges, key.to_numpy(np.int64), side="left").astype(np.int32))

    common.ship(docs.sparkSession)
    return keyed.withColumn("shard", shard_of("key")), bounds


def in_order(docs: DataFrame, shards: int) -> DataFrame:
    """Range-partitioned by doc_id and sorted within each partition; partition numbers ascend with doc_id."""
    keyed = docs.withColumn("key", F.coalesce(F.col("doc_id").cast("long"), F.lit(LOWEST)))
    return keyed.repartitionByRange(shards, "key").sortWithinPartitions("key", "text")


def with_successors(docs: DataFrame, shards: int) -> DataFrame:
    """(shard, own, doc_id, text) by shard, ascending within it, then the row that follows the shard's last one.

    A shard's follower is the first row of the next shard that has rows, after the last the first of all; it is
    dealt to both shards (own is false in the earlier one), so a stream over a shard sees every row's successor.
    Rows of equal doc_id follow each other by text; only the least of them follows another shard.
    """
    spark = docs.sparkSession
    rows, _ = with_shard(
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")),
        shards,
    )
    firsts = rows.groupBy("shard").agg(F.min("key").alias("key")).orderBy("shard").collect()
    own = rows.withColumn("own", F.lit(True))
    if firsts:
        keys = [r.key for r in firsts]
        hops = [(keys[(i + 1) % len(keys)], firsts[i].shard) for i in range(len(keys))]
        hop = spark.createDataFrame(hops, "key long, shard int")
        wanted = docs.where(F.col("doc_id").isin([k for k in keys if k != LOWEST]) | (F.col("doc_id").isNull() if LOWEST in keys else F.lit(False)))
        copies = wanted.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        ).withColumn("key", F.coalesce("doc_id", F.lit(LOWEST)))
        copies = copies.join(F.broadcast(hop), "key").withColumn("own", F.lit(False))  # one row for each shard
        own = own.unionByName(copies.select(*own.columns))
    return own.repartitionById(shards, F.col("shard")).sortWithinPartitions("shard", F.desc("own"), "key", "text").select("shard", "own", "doc_id", "text")
