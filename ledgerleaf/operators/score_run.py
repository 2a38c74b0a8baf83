"""A scoring run from end to end: the compared cells are written once, and every table of the run is made from them.

``start`` writes two tables below a folder, each in one pass: ``cells`` (the cell table, narrow and typed) and ``samples`` (a row a split row, with
whether it was answered and whether the answer parsed).  Counts on the way come from ``observe``, so a run that scores nothing, or
samples that repeat, are known without another pass.  A ``ScoreRun`` reads these two tables only: no report scans the
labels or the predictions again, and a run can be opened later by its folder.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..sources import files
from . import cells as cell_ops
from . import metrics, report


@dataclass
class ScoreRun:
    spark: SparkSession
    path: str
    model: str = ""

    @property
    def cells(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/cells")

    @property
    def samples(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/samples")

    @property
    def totals(self) -> dict:
        """What was counted while the run was written."""
        return json.loads(self.spark.read.text(f"{self.path}/totals").first().value)

    @property
    def outputs(self) -> DataFrame:
        return self.samples.where("answered").select("sample_id", "parse_ok")

    @property
    def missing(self) -> DataFrame:
        return self.samples.where("not answered").select("row_idx", "sample_id", "tier").orderBy("row_idx")

    @property
    def validity(self) -> DataFrame:
        return metrics.cell_validity(self.samples, self.cells, self.outputs)

    @property
    def summary(self) -> DataFrame:
        return metrics.summary_row(self.cells, self.samples, self.validity, self.model)

    def tables(self) -> dict[str, DataFrame]:
        """Every table of the run by name."""
        cells, samples = self.cells, self.samples
        return {
            "tiers": report.tier_table(samples, cells, self.outputs),
            "fields": report.field_report(cells),
            "worst": metrics.worst_fields(cells),
            "misses": metrics.top_misses(cells),
            "populated": metrics.populated_blank(cells),
            "tier_populated": metrics.tier_populated(cells),
            "classes": metrics.by_class(cells),
            "error_rates": metrics.error_rates(cells),
            "validity": self.validity,
            "missing": self.missing,
            "summary": self.summary,
        }

    def text(self) -> str:
        """The report and the summary as text."""
        shown = report.report_text(self.samples, self.cells, self.missing, self.outputs)
        return f"{shown}\n\n{report.summary_text(self.cells, self.samples, self.validity, self.model)}"

    def write_report(self, summaries: str | None = None) -> None:
        """All tables as JSON below the run's folder, and the summary row appended to ``summaries``, once a run."""
        files.write_report(self.tables(), f"{self.path}/report")
        if summaries:
            files.append_once(self.summary, summaries, self.path.rstrip("/").rsplit("/", 1)[-1], form="csv")


def start(split: DataFrame, both: DataFrame, outputs: DataFrame, path: str, model: str = "") -> ScoreRun:
    """Writes a run below path.

    split (row_idx, sample_id, tier); both: what ``cells.compared`` takes, with has_gt and has_pred; outputs (sample_id, parse_ok), a row a sample.
    An empty split gives a run of empty tables.  Split rows that repeat are scored as often as they occur.
    """
    spark = split.sparkSession
    seen = Observation("cells")
    cells = cell_ops.compared(both).observe(
        seen,
        F.count("*").alias("cells"),
        F.count_if("exact").alias("exact"),
        F.count_if("norm").alias("norm"),
        F.count_if(F.col("has_gt") & F.col("has_pred")).alias("both_sides"),
    )
    cells.write.mode("overwrite").parquet(f"{path}/cells")
    asked = Observation("samples")
    rows = split.select("row_idx", "sample_id", "tier").join(outputs.select("sample_id", "parse_ok"), "sample_id", "left")
    rows = rows.select("row_idx", "sample_id", "tier", F.col("parse_ok").isNotNull().alias("answered"), F.coalesce("parse_ok", F.lit(False)).alias("parse_ok"))
    rows = rows.observe(asked, F.count("*").alias("samples"), F.count_if("answered").alias("answered"), F.count_if("parse_ok").alias("parsed"))
    rows.write.mode("overwrite").parquet(f"{path}/samples")
    totals = {k: int(v or 0) for k, v in {**seen.get, **asked.get}.items()}
    spark.createDataFrame([(json.dumps(totals),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/totals")
    return ScoreRun(spark, path, model)


def score(spark: SparkSession, split_path: str, predictions_path: str, batch: str, out: str, model: str = "") -> ScoreRun:
    """Scores a prediction file against the labels of a split: the run that every report comes from.

    Labels, predictions and their validity are read once each; malformed prediction lines are errors.
    """
    split = files.read_manifest(spark, split_path, strict=True)
    preds = files.read_predictions(spark, predictions_path)
    both = cell_ops.side_by_side(files.read_batch(spark, batch, split), cell_ops.prediction_cells(split, preds))
    both = both.join(split.select("row_idx", "sample_id", "tier"), "row_idx")
    valid = files.read_validity(spark, predictions_path).select("sample_id", "parse_ok")
    return start(split, both, valid, out, model)
