"""Streaming scorer (an addition): predictions arrive as JSON lines and are held against static ground truth.

``running_accuracy`` counts each sample's first prediction within a watermark, all in Spark's own state.  ``last_wins`` follows the rule of the
batch reader instead: of a sample's predictions the latest holds, in whatever order they arrive.  Behind a watermark its state is the prediction that
holds now; when a later one comes the earlier is retracted, a row of sign -1, before the later is given, a row of sign 1.  Sums over signed rows are thus
right after every batch, and equal the batch result on the predictions seen so far.  Without a watermark nothing would ever leave that state, and a sample
would cost a Python call a batch: ``start_last_wins`` then keeps no state, a batch appends the scores of its own latest predictions, and the reader takes
each sample's latest of all batches.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..functions import text
from ..sources import files

PREDICTION = "sample_id string, fields map<string,string>, at timestamp"


def read_predictions(spark: SparkSession, path: str, files_per_trigger: int = 100) -> DataFrame:
    return spark.readStream.schema(PREDICTION).option("maxFilesPerTrigger", files_per_trigger).json(path)


def running_accuracy(preds: DataFrame, split: DataFrame, gt: DataFrame, delay: str = "1 hour", window: str = "10 minutes") -> DataFrame:
    """(window, tier, total, norm_hits) of populated cells; a sample counts once within the watermark.

    The ground-truth side is static and keyed by (sample_id, key); state is the seen sample ids and the windows,
    both dropped behind the watermark.
    """
    once = preds.withWatermark("at", delay).dropDuplicatesWithinWatermark(["sample_id"])
    cells = once.join(_truth(split, gt), "sample_id").withColumn("pred", F.try_element_at("fields", F.col("key")))
    hit = text.normalize("key", "pred") == F.col("gt_n")
    return cells.groupBy(F.window("at", window), "tier").agg(F.count("*").alias("total"), F.sum(hit.cast("int")).alias("norm_hits"))


def _normal(gt: DataFrame) -> DataFrame:
    """(row_idx, key, kind, gt_n) of the populated cells of gt (row_idx, key, gt); a key's type is found here unless it comes with the rows as kind."""
    gt = gt.select("row_idx", "key", F.col("kind") if "kind" in gt.columns else text.kind_of("key").alias("kind"), text.text("gt").alias("gt"))
    gt = text.with_generic(gt, _g=F.col("gt"))
    return gt.select("row_idx", "key", "kind", text.by_kind("kind", F.col("_g")).alias("gt_n")).where("gt_n <> ''")


def _truth(split: DataFrame, gt: DataFrame) -> DataFrame:
    """(sample_id, tier, key, kind, gt_n) of the populated cells."""
    return _normal(gt).join(split.select("row_idx", "sample_id", "tier"), "row_idx").select("sample_id", "tier", "key", "kind", "gt_n")


def _truth_rows(split: DataFrame, gt: DataFrame) -> DataFrame:
    """(sample_id, tier, cells): the same with a row a sample, cells an array of (key, kind, gt_n); a sample's cells are few."""
    rows = _normal(gt).groupBy("row_idx").agg(F.collect_list(F.struct("key", "kind", "gt_n")).alias("cells"))
    return rows.join(split.select("row_idx", "sample_id", "tier"), "row_idx").select("sample_id", "tier", "cells")


def start(scores: DataFrame, path: str, checkpoint: str, **trigger):
    return scores.writeStream.outputMode("append").format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()


# ---------------------------------------------------------------- the latest prediction holds
SIGNED = "sample_id string, fields string, sign int"
HELD = "at long, fields string"


def _latest(keep_micros: int | None):
    def run(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        held = tuple(state.get) if state.exists else None
        best = held
        for frame in frames:
            rows = zip(frame["micros"].tolist(), frame["fields"].tolist())
            best = max([r for r in (best, *rows) if r is not None])
        if best != held:
            state.update(best)
            if keep_micros is not None:
                state.setTimeoutTimestamp(max(best[0] + keep_micros, state.getCurrentWatermarkMs() * 1000 + 1000) // 1000)
            out = [(key[0], held[1], -1)] if held else []
            yield pd.DataFrame([*out, (key[0], best[1], 1)], columns=["sample_id", "fields", "sign"])

    return run


def _said(preds: DataFrame) -> DataFrame:
    """(sample_id, at, micros, fields): predictions that have a sample and a time, fields as JSON."""
    fields = F.to_json(F.coalesce("fields", F.create_map().cast("map<string,string>"))).alias("fields")
    return preds.where("sample_id is not null and at is not null").select("sample_id", "at", F.unix_micros("at").alias("micros"), fields)


def last_wins(preds: DataFrame, keep: str | None = None) -> DataFrame:
    """(sample_id, fields, sign): changes of each sample's latest prediction; fields are JSON, sign -1 takes back what was given before.

    The latest is that of the greatest ``at``, among equal ones of the greatest text, so the order of arrival does not matter; rows without
    a sample or a time are left out, a repeated prediction changes nothing.  ``keep``, an interval such as '1 hour', is the watermark: what is
    later than that is dropped, and a sample's state goes when the watermark has passed its prediction by as much again.  Without it state stays.
    """
    rows, interval = _said(preds), None
    if keep is not None:
        rows = rows.withWatermark("at", keep)
        interval = int(pd.Timedelta(keep).total_seconds() * 1_000_000)
    timeout = GroupStateTimeout.NoTimeout if keep is None else GroupStateTimeout.EventTimeTimeout
    return rows.groupBy("sample_id").applyInPandasWithState(_latest(interval), SIGNED, HELD, "update", timeout)


def score_changes(changes: DataFrame, truth: DataFrame) -> DataFrame:
    """(tier, total, norm_hits) that a batch of changes adds to or takes from the scores; truth (sample_id, tier, key, gt_n)."""
    cells = changes.withColumn("fields", F.from_json("fields", "map<string,string>")).join(truth, "sample_id")
    hit = text.normalize("key", F.try_element_at("fields", F.col("key"))) == F.col("gt_n")
    return cells.groupBy("tier").agg(F.sum("sign").cast("long").alias("total"), F.sum(F.when(hit, F.col("sign")).otherwise(0)).cast("long").alias("norm_hits"))


def score_latest(said: DataFrame, truth: DataFrame) -> DataFrame:
    """(sample_id, micros, fields, tier, total, norm_hits): scores of each sample's latest prediction of said (sample_id, micros, fields), which is read twice.

    truth (sample_id, tier, cells): a sample meets its cells as one row, and they are unrolled and counted where they meet.
    """
    latest = said.groupBy("sample_id").agg(F.max(F.struct("micros", "fields")).alias("x")).select("sample_id", "x.*")
    cells = latest.select("sample_id", F.from_json("fields", "map<string,string>").alias("_m")).join(truth, "sample_id")
    cells = cells.select("sample_id", "tier", "_m", F.inline("cells"))
    cells = cells.select("sample_id", "tier", "kind", "gt_n", text.text(F.try_element_at("_m", F.col("key"))).alias("_p"))
    cells = text.with_generic(cells, _p=F.col("_p"))
    hit = text.by_kind("kind", F.col("_p")) == F.col("gt_n")
    per = cells.groupBy("sample_id", "tier").agg(F.count("*").alias("total"), F.count_if(hit).alias("norm_hits"))
    return latest.join(per, "sample_id").select("sample_id", "micros", "fields", "tier", "total", "norm_hits")


def start_last_wins(preds: DataFrame, split: DataFrame, gt: DataFrame, path: str, checkpoint: str, keep: str | None = None, **trigger):
    """Starts the scorer: every batch appends its scores below path, once, however often the batch is run; with ``keep`` (see ``last_wins``) the changes
    of the scores by tier, else the scores of the batch's latest predictions by sample, of which ``scores`` takes the latest.

    The populated cells of the truth are normalised once and kept below path, a row a sample; every batch, and a scorer that goes on later, reads them there.
    """
    spark, held = preds.sparkSession, f"{path.rstrip('/')}/truth_rows"
    if not files.exists(spark, f"{held}/_SUCCESS"):
        _truth_rows(split, gt).write.mode("overwrite").parquet(held)
    truth = spark.read.parquet(held)
    cells = truth.select("sample_id", "tier", F.inline("cells"))

    def add(changes: DataFrame, batch: int) -> None:
        files.append_once(score_changes(changes, cells), path, str(batch), form="parquet")

    def add_latest(said: DataFrame, batch: int) -> None:
        files.append_once(score_latest(said, truth), path, str(batch), form="parquet")

    rows, mode, each = (_said(preds), "append", add_latest) if keep is None else (last_wins(preds, keep), "update", add)
    stream = rows.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
    return stream.foreachBatch(each).trigger(**(trigger or {"availableNow": True})).start()


def scores(spark: SparkSession, path: str) -> DataFrame:
    """(tier, total, norm_hits) of the samples' latest predictions so far."""
    rows = files.read_appended(spark, path, "parquet", "sample_id string, micros long, fields string, tier string, total long, norm_hits long")
    latest = rows.where("sample_id is not null").groupBy("sample_id", "tier").agg(F.max(F.struct("micros", "fields", "total", "norm_hits")).alias("x"))
    changes = rows.where("sample_id is null").select("tier", "total", "norm_hits")
    rows = latest.select("tier", "x.total", "x.norm_hits").unionByName(changes)
    return rows.groupBy("tier").agg(F.sum("total").alias("total"), F.sum("norm_hits").alias("norm_hits")).where("total <> 0")
