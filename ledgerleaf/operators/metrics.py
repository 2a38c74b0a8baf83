"""Metrics over the cell table: each is one aggregation with partial sums."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from ..functions import keys


def _rate(hits: Column, n: Column, empty: float = 0.0) -> Column:
    return F.when(n > 0, hits / n).otherwise(F.lit(empty))


def _totals() -> tuple[Column, ...]:
    return F.count("*").alias("total"), F.count_if(F.col("exact")).alias("exact_hits"), F.count_if(F.col("norm")).alias("norm_hits")


def field_stats(cells: DataFrame) -> DataFrame:
    """(tier, key, total, exact_hits, norm_hits, exact_acc, norm_acc); tier NULL is the key over all tiers."""
    per = cells.groupBy("tier", "key").agg(*_totals())
    # the key over all tiers from the sums of each, a row a tier and key
    sums = [F.sum(c).alias(c) for c in ("total", "exact_hits", "norm_hits")]
    sets = per.groupingSets([[F.col("tier"), F.col("key")], [F.col("key")]], F.col("tier"), F.col("key")).agg(*sums)
    return sets.withColumns({"exact_acc": _rate(F.col("exact_hits"), F.col("total")), "norm_acc": _rate(F.col("norm_hits"), F.col("total"))})


def miss_pairs(cells: DataFrame) -> DataFrame:
    """(tier, key, gt_n, pred_n, misses, first_row)"""
    return cells.where(~F.col("norm")).groupBy("tier", "key", "gt_n", "pred_n").agg(F.count("*").alias("misses"), F.min("row_idx").alias("first_row"))


def doc_accuracy(split: DataFrame, cells: DataFrame, preds: DataFrame | None = None) -> DataFrame:
    """(row_idx, tier, keys, hits, all_correct, acc) per split row; a row without keys is right.

    With preds given, only the samples that have a prediction count.
    """
    if preds is not None:
        split = split.join(preds.select("sample_id").distinct(), "sample_id", "left_semi")
    per = cells.groupBy("row_idx").agg(F.count("*").alias("keys"), F.count_if(F.col("norm")).alias("hits"))
    rows = split.select("row_idx", "tier").join(per, "row_idx", "left").fillna(0, ["keys", "hits"])
    return rows.withColumns({"all_correct": F.col("keys") == F.col("hits"), "acc": _rate(F.col("hits"), F.col("keys"), 1.0)})


def doc_stats(split: DataFrame, cells: DataFrame) -> DataFrame:
    """(tier, docs, docs_all_correct, mean_field_acc); tier NULL is the total."""
    return doc_accuracy(split, cells).rollup("tier").agg(
        F.count("*").alias("docs"),
        F.count_if(F.col("all_correct")).alias("docs_all_correct"),
        F.avg("acc").alias("mean_field_acc"),
    )


def tier_macro(cells: DataFrame) -> DataFrame:
    """(tier, norm_field_acc): the plain mean over fields."""
    per = cells.groupBy("tier", "key").agg(*_totals())
    return per.groupBy("tier").agg(F.avg(F.col("norm_hits") / F.col("total")).alias("norm_field_acc"))


def worst_fields(cells: DataFrame, n: int = 15) -> DataFrame:
    """(key, total, norm_hits, norm_acc): least accurate first, then most frequent, then by name."""
    per = cells.groupBy("key").agg(*_totals()).withColumn("norm_acc", F.col("norm_hits") / F.col("total"))
    return per.orderBy("norm_acc", F.desc("total"), "key").limit(n).select("key", "total", "norm_hits", "norm_acc")


def pair_counts(cells: DataFrame, *by: str) -> DataFrame:
    """(by.., gt_n, pred_n, total, exact_hits, norm_hits, first_row): cells counted by field and miss; the right cells of a field are one row."""
    miss = ~F.col("norm")
    pair = [F.when(miss, F.col(c)).alias(c) for c in ("gt_n", "pred_n")]
    return cells.groupBy(*by, *pair).agg(*_totals(), F.min("row_idx").alias("first_row"))


def _field_totals(per: DataFrame, *by: str) -> DataFrame:
    """Totals of each field from its pair counts."""
    sums = [F.sum(c).alias(c) for c in ("total", "exact_hits", "norm_hits") if c in per.columns]
    return per.groupBy(*by).agg(*sums, F.min("first_row").alias("first_row"))


def ranked_misses(per: DataFrame, pairs: int, *by: str) -> DataFrame:
    """The ``pairs`` most frequent misses of each field, with rank; equal counts by first row, then by text.

    A rank below a limit: every task keeps its own first ``pairs`` rows of a field before they meet, so none sees all misses of a field.
    """
    place = F.row_number().over(Window.partitionBy(*by).orderBy(F.desc("total"), "first_row", "gt_n", "pred_n"))
    rows = per.where(F.col("norm_hits") == 0).withColumn("rank", place).where(F.col("rank") <= pairs)
    return rows.select(*by, "rank", "gt_n", "pred_n", F.col("total").alias("misses"))


def top_misses(cells: DataFrame, fields: int = 5, pairs: int = 5) -> DataFrame:
    """(key, rank, gt_n, pred_n, misses) of the worst fields, the rows of which are few and broadcast."""
    # both uses of the counts ask for the same rows and columns, so Spark makes them once: the join below would ask for keys that are not
    # null on one side only, and a field's first row, never needed to order fields, is asked for all the same
    per = pair_counts(cells.where(F.col("key").isNotNull()), "key").drop("exact_hits")
    order = (F.col("norm_hits") / F.col("total"), F.desc("total"), "key", "first_row")
    worst = _field_totals(per, "key").orderBy(*order).limit(fields).select("key")
    return ranked_misses(per, pairs, "key").join(F.broadcast(worst), "key", "left_semi")


def populated_blank(cells: DataFrame, *by: str) -> DataFrame:
    """(by.., populated, total, exact_acc, norm_acc): cells whose truth holds something against those left blank."""
    return cells.groupBy(*by, (F.col("gt_n") != "").alias("populated")).agg(
        F.count("*").alias("total"),
        F.avg(F.col("exact").cast("int")).alias("exact_acc"),
        F.avg(F.col("norm").cast("int")).alias("norm_acc"),
    )


def tier_populated(cells: DataFrame) -> DataFrame:
    """(tier, total, exact_acc, norm_acc) over populated cells."""
    # conditions in place of a filter, which would normalise every value a second time
    full = F.col("gt_n") != ""
    per = cells.groupBy("tier").agg(
        F.count_if(full).alias("total"),
        F.avg(F.when(full, F.col("exact").cast("int"))).alias("exact_acc"),
        F.avg(F.when(full, F.col("norm").cast("int"))).alias("norm_acc"),
    )
    return per.where("total > 0")


def _dimension(df: DataFrame, name: str, values) -> DataFrame:
    return df.sparkSession.createDataFrame([(i, v) for i, v in enumerate(values)], f"position int, {name} string")


def by_class(cells: DataFrame) -> DataFrame:
    """(cls, total, populated, exact_acc, norm_acc): every class, accuracies over populated cells."""
    full = F.col("gt_n") != ""
    per = cells.where("cls is not null").groupBy("cls").agg(
        F.count("*").alias("total"),
        F.count_if(full).alias("populated"),
        F.count_if(full & F.col("exact")).alias("e"),
        F.count_if(full & F.col("norm")).alias("n"),
    )
    out = F.broadcast(_dimension(cells, "cls", keys.CLASSES)).join(per, "cls", "left").fillna(0, ["total", "populated", "e", "n"])
    return out.select(
        "cls",
        "total",
        "populated",
        _rate(F.col("e"), F.col("populated")).alias("exact_acc"),
        _rate(F.col("n"), F.col("populated")).alias("norm_acc"),
    )


def error_rates(cells: DataFrame) -> DataFrame:
    """(cls, n, mean_cer) of the classes that have one; cls 'overall' is the mean over all their cells."""
    # no filter on the rate: it would be computed a second time for it
    per = cells.groupBy("cls").agg(F.count("cer").alias("n"), F.sum("cer").alias("s"))
    some = F.broadcast(_dimension(cells, "cls", keys.CER_CLASSES)).join(per, "cls", "left").fillna(0, ["n", "s"])
    sets = some.rollup("cls").agg(F.sum("n").alias("n"), F.sum("s").alias("s"))  # a row a class, and one of all
    return sets.select(F.coalesce("cls", F.lit("overall")).alias("cls"), F.coalesce("n", F.lit(0)).alias("n"), _rate(F.col("s"), F.col("n")).alias("mean_cer"))


def validity(split: DataFrame, expected: DataFrame, outputs: DataFrame) -> DataFrame:
    """(samples, parse_rate, has_expected_keys_rate, valid_rate, mean_key_coverage).

    expected (row_idx, want array<string>); outputs (sample_id, parse_ok boolean, got array<string>).  Samples
    without an output count as failures.
    """
    rows = split.select("row_idx", "sample_id").join(expected, "row_idx", "left").join(outputs, "sample_id", "left")
    want, ok = F.coalesce("want", F.array().cast("array<string>")), F.coalesce("parse_ok", F.lit(False))
    shared = F.size(F.array_intersect(want, F.coalesce("got", F.array().cast("array<string>"))))
    has = F.coalesce(F.col("sample_id").isNotNull() & F.col("parse_ok").isNotNull(), F.lit(False)) & (shared == F.size(F.array_distinct(want)))
    cover = F.when(F.col("parse_ok").isNull(), 0.0).when(F.size(want) > 0, shared / F.size(F.array_distinct(want))).otherwise(1.0)
    rows = rows.select(ok.alias("ok"), has.alias("has"), cover.alias("cover"))
    one = lambda c: F.coalesce(F.avg(c), F.lit(0.0))
    return rows.agg(
        F.count("*").alias("samples"),
        one(F.col("ok").cast("int")).alias("parse_rate"),
        one(F.col("has").cast("int")).alias("has_expected_keys_rate"),
        one((F.col("ok") & F.col("has")).cast("int")).alias("valid_rate"),
        one(F.col("cover")).alias("mean_key_coverage"),
    )


def cell_validity(split: DataFrame, cells: DataFrame, outputs: DataFrame) -> DataFrame:
    """``validity`` from the cell table: expected are a sample's keys that the truth has, found those of them that its prediction has.

    outputs (sample_id, parse_ok); an output that does not parse has no keys.
    """
    has = F.col("has_gt")
    per = cells.groupBy("row_idx").agg(F.count_if(has).alias("want"), F.count_if(has & F.col("has_pred")).alias("got"))
    rows = split.select("row_idx", "sample_id").join(per, "row_idx", "left").join(outputs.select("sample_id", "parse_ok"), "sample_id", "left")
    rows = rows.fillna(0, ["want", "got"]).select(
        F.col("parse_ok").isNotNull().alias("said"),
        F.coalesce("parse_ok", F.lit(False)).alias("ok"),
        "want",
        F.when(F.coalesce("parse_ok", F.lit(False)), F.col("got")).otherwise(0).alias("got"),
    )
    whole = F.col("said") & (F.col("got") == F.col("want"))
    cover = F.when(~F.col("said"), 0.0).when(F.col("want") > 0, F.col("got") / F.col("want")).otherwise(1.0)
    one = lambda c: F.coalesce(F.avg(c), F.lit(0.0))
    return rows.agg(
        F.count("*").alias("samples"),
        one(F.col("ok").cast("int")).alias("parse_rate"),
        one(whole.cast("int")).alias("has_expected_keys_rate"),
        one((F.col("ok") & whole).cast("int")).alias("valid_rate"),
        one(cover).alias("mean_key_coverage"),
    )


def tier_order(seen: DataFrame) -> DataFrame:
    """(tier, position): the known tiers in their order, others after them by first row; seen (row_idx, tier)."""
    known = _dimension(seen, "tier", keys.TIERS)
    first = seen.groupBy("tier").agg(F.min("row_idx").alias("first"))
    rows = first.join(F.broadcast(known), "tier", "left")
    return rows.select("tier", F.coalesce(F.col("position").cast("long"), len(keys.TIERS) + F.col("first")).alias("position"))


def summary_row(cells: DataFrame, split: DataFrame, valid: DataFrame, model: str) -> DataFrame:
    """One wide row of a run: accuracies by tier and class, error rates and validity, rounded to four places.

    One aggregate over the cells by (tier, class, populated), a handful of rows, from which every number follows.  A tier without
    populated cells is null, a class without any is 0.  Cells may come with populated in place of gt_n.
    """
    populated = F.col("populated") if "populated" in cells.columns else F.col("gt_n") != ""
    sums = cells.groupBy("tier", "cls", populated.alias("full")).agg(
        F.count("*").alias("n"), F.count_if("exact").alias("e"), F.count_if("norm").alias("h"), F.count("cer").alias("k"), F.coalesce(F.sum("cer"), F.lit(0.0)).alias("c")
    )

    def share(hits: str, of: str, when: Column, empty=0.0) -> Column:
        total = F.sum(F.when(when, F.col(of)))
        return F.round(F.when(total > 0, F.sum(F.when(when, F.col(hits))) / total).otherwise(F.lit(empty).cast("double")), 4)

    full = F.col("full")
    wide = {"populated_norm_acc": share("h", "n", full), "blank_norm_acc": share("h", "n", ~full)}
    wide |= {f"tier_{t}_norm_acc": share("h", "n", full & (F.col("tier") == t), None) for t in keys.TIERS}
    wide |= {f"class_{c}_exact": share("e", "n", full & (F.col("cls") == c)) for c in keys.CLASSES}
    wide |= {f"cer_{c}": share("c", "k", F.col("cls") == c) for c in keys.CER_CLASSES}
    wide["cer_overall"] = share("c", "k", F.lit(True))
    parts = [
        split.agg(F.count("*").alias("n_samples")),
        sums.agg(*(v.alias(k) for k, v in wide.items())),
        valid.select(F.round("valid_rate", 4).alias("json_valid_rate"), F.round("parse_rate", 4).alias("json_parse_rate")),
    ]
    one = [p.withColumn("_one", F.lit(1)) for p in parts]  # single rows, put side by side
    out = one[0]
    for p in one[1:]:
        out = out.join(F.broadcast(p), "_one")
    return out.select(F.lit(model).alias("model"), *(c for p in parts for c in p.columns))
