"""The cell table: ground truth and predictions, joined key by key and compared once.

Everything the metrics need is computed in one projection above the one join, so a caller caches or writes the
cells and every metric is a single aggregation over narrow columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import keys, text


def last_predictions(preds: DataFrame, order: Column, key: str = "sample_id") -> DataFrame:
    """The last row of each sample: a combinable maximum, no sort of a sample's rows."""
    rest = [c for c in preds.columns if c != key]
    return preds.groupBy(key).agg(F.max_by(F.struct(*rest), order).alias("_x")).select(key, "_x.*")


def prediction_cells(split: DataFrame, preds: DataFrame) -> DataFrame:
    """(row_idx, key, pred) of the split's samples; preds: (sample_id, fields map<string,string>)."""
    named = split.select("row_idx", "sample_id").join(preds.select("sample_id", "fields"), "sample_id")
    return named.select("row_idx", F.explode("fields").alias("key", "pred"))


def missing(split: DataFrame, preds: DataFrame) -> DataFrame:
    """Split rows without a prediction, in split order."""
    return split.join(preds.select("sample_id").distinct(), "sample_id", "left_anti").select("row_idx", "sample_id", "tier").orderBy("row_idx")


def side_by_side(gt: DataFrame, pred: DataFrame) -> DataFrame:
    """(row_idx, key, gt, pred, has_gt, has_pred): the full outer join of both sides."""
    there = F.lit(True)
    gt = gt.select("row_idx", "key", "gt", there.alias("has_gt"))
    both = gt.join(pred.select("row_idx", "key", "pred", there.alias("has_pred")), ["row_idx", "key"], "full")
    return both.fillna(False, ["has_gt", "has_pred"])


def compare_cells(split: DataFrame, gt: DataFrame, pred: DataFrame) -> DataFrame:
    """(row_idx, sample_id, tier, key, gt, pred, gt_n, pred_n, exact, norm, region, cls, cer, has_gt, has_pred).

    split (row_idx, sample_id, tier); gt (row_idx, key, gt); pred (row_idx, key, pred).  A key of one side only
    reads blank on the other; predictions of samples outside the split are left out.
    """
    both = side_by_side(gt, pred)
    return compared(both.join(split.select("row_idx", "sample_id", "tier"), "row_idx"))


def unrolled(rows: DataFrame) -> DataFrame:
    """(row_idx, sample_id, tier, key, gt, pred, has_gt, has_pred): the full outer join of a sample's cells by key, made within its row.

    rows (row_idx, sample_id, tier, cells, fields): cells is an array of (key, gt) and, where they are known, kind, cls ('' for none) and region, which
    are passed on; fields is a map of the predicted texts, in which a key comes once. Either is null for a sample that has none.
    """
    names = rows.schema["cells"].dataType.elementType.names
    known = F.coalesce("cells", F.array().cast(rows.schema["cells"].dataType))
    said = F.coalesce(F.map_keys("fields"), F.array().cast("array<string>"))
    odd = F.transform(F.array_except(said, known["key"]), lambda k: F.struct(*((k if n == "key" else F.lit(None).cast("string")).alias(n) for n in names)))
    # a step of its own: unrolling an array that a lambda makes would be interpreted, and copy the sample's map for each cell
    rows = rows.select("row_idx", "sample_id", "tier", "fields", F.size(known).alias("_n"), F.concat(known, odd).alias("_all"))
    rows = rows.select("row_idx", "sample_id", "tier", "fields", "_n", F.posexplode("_all").alias("_i", "_x"))
    has_gt, key = F.col("_i") < F.col("_n"), F.col("_x.key")
    found = {
        "kind": lambda: F.coalesce("_x.kind", text.kind_of(key)),
        "cls": lambda: F.when(has_gt, F.nullif("_x.cls", F.lit(""))).otherwise(keys.class_of(key)),
        "region": lambda: F.coalesce("_x.region", keys.region_of(key)),
    }
    return rows.select(
        "row_idx",
        "sample_id",
        "tier",
        "_x.key",
        "_x.gt",
        F.try_element_at("fields", key).alias("pred"),
        *(f().alias(n) for n, f in found.items() if n in names),
        has_gt.alias("has_gt"),
        F.coalesce(F.array_contains(F.map_keys("fields"), key), F.lit(False)).alias("has_pred"),
    )


def compare_rows(split: DataFrame, truth: DataFrame, preds: DataFrame) -> DataFrame:
    """The table of ``compare_cells`` for sides that have a row a sample: truth (row_idx, cells), preds (row_idx, fields), see ``unrolled``.

    Only rows meet by shuffle, and not even they if both sides are dealt out by row_idx; no cell is moved or sorted.
    """
    rows = split.select("row_idx", "sample_id", "tier").join(truth.select("row_idx", "cells"), "row_idx", "left")
    return compared(unrolled(rows.join(preds.select("row_idx", "fields"), "row_idx", "left")))


def compared(both: DataFrame, equal: bool = True, populated: bool = False) -> DataFrame:
    """The cell table of rows (row_idx, sample_id, tier, key, gt, pred) that hold both sides.

    Type, class and region follow from the key alone: they are found once for a cell, not once for each side, or come with the
    rows as kind, cls and region.  A prediction that equals the truth as it is takes over its normal form.  has_gt and has_pred, which
    tell a blank side from an absent one, are kept if the rows have them.

    Without ``equal`` no text of a cell whose sides are equal as they are is normalised: its gt_n and pred_n are null.  What counts hits and
    names misses asks for no more; what tells populated cells from blank ones does, or takes the column ``populated``, for which an equal text
    is normalised only if it does not end in a digit.
    """
    found = {"kind": text.kind_of, "cls": keys.class_of, "region": keys.region_of}
    both = both.withColumns({"gt": text.text("gt"), "pred": text.text("pred"), **{n: f("key") for n, f in found.items() if n not in both.columns}})
    exact, cls = F.col("gt") == F.col("pred"), F.col("cls")
    # one text to normalise: where both sides are equal, the prediction's is blank and the truth's holds
    both = both.withColumn("exact", exact).withColumn("_p", F.when(F.col("exact"), "").otherwise(F.col("pred")))
    both = both.withColumn("_known", F.col("exact") & text.surely_holds("gt") if populated else F.lit(False))
    spared = F.col("_known") if populated else F.col("exact")
    both = text.with_generic(both, _g=F.col("gt") if equal else F.when(spared, "").otherwise(F.col("gt")), _p=F.col("_p"))
    both = both.withColumn("gt_n", text.by_kind("kind", F.col("_g")))
    both = both.withColumn("pred_n", F.when(F.col("exact"), F.col("gt_n")).otherwise(text.by_kind("kind", F.col("_p"))))
    norm, full = F.col("gt_n") == F.col("pred_n"), F.col("gt_n") != ""
    if populated:
        both = both.withColumn("populated", F.col("_known") | full)
        full = F.col("populated")
    if not equal:
        both = both.withColumns({c: F.when(~F.col("exact"), F.col(c)) for c in ("gt_n", "pred_n")})
        norm = F.col("exact") | norm
    flags = [c for c in ("has_gt", "has_pred", "populated") if c in both.columns]
    return both.select(
        "row_idx",
        "sample_id",
        "tier",
        "key",
        "gt",
        "pred",
        "gt_n",
        "pred_n",
        "exact",
        norm.alias("norm"),
        "region",
        "cls",
        F.when(
            cls.isin(*keys.CER_CLASSES) & full,
            F.when(F.col("exact"), 0.0).otherwise(keys.char_error_rate("pred_n", "gt_n")),
        ).alias("cer"),
        *flags,
    )
