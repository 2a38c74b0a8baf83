"""Reports of a scoring run: tables of a handful of rows, and the texts made of them.

The tables are DataFrames; only their rows (a tier, a field class, the worst fields) reach the driver to be laid out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import keys
from . import metrics

# fixed values: headings and widths of the texts
_TIER_HEAD = (("tier", "<14"), ("docs", ">6"), ("all_correct", ">14"), ("mean_field_acc", ">18"), ("norm_field_acc", ">18"))
_FIELD_HEAD = (("field", "<48"), ("n", ">6"), ("exact", ">9"), ("norm", ">9"))
_POPULATED_HEAD = (("tier", "<14"), ("n", ">7"), ("norm_acc", ">11"))
_CLASS_HEAD = (("class", "<12"), ("pop", ">7"), ("exact", ">9"), ("norm", ">9"), ("CER", ">9"))


def _line(head: tuple, values: tuple | None = None) -> str:
    """Values under a heading (the heading itself without values): numbers with a point get three places."""
    out = []
    for i, (name, width) in enumerate(head):
        v = name if values is None else values[i]
        out.append(format(v, f"{width}.3f") if isinstance(v, float) else format(v, width))
    return "".join(out).rstrip() if values is None else "".join(out)


def tier_table(split: DataFrame, cells: DataFrame, preds: DataFrame | None = None) -> DataFrame:
    """(tier, docs, all_correct, mean_field_acc, norm_field_acc), tiers by name, the total (tier null) last.

    The cells are read once: counts by document and by (tier, key) come from one aggregation, whose rows meet the split's documents by row.
    A row by (tier, key) stays without a document and gives the mean over fields.
    """
    if preds is not None:
        split = split.join(preds.select("sample_id").distinct(), "sample_id", "left_semi")
    docs = split.select("row_idx", F.col("tier").alias("_tier"))
    hits = [F.count("*").alias("keys"), F.count_if(F.col("norm")).alias("hits")]
    per = cells.groupingSets([["row_idx"], ["tier", "key"]], "row_idx", "tier", "key").agg(F.grouping("row_idx").alias("_field"), *hits)
    # an outer join keeps documents without cells and rows by field; what has a document that is not asked for goes
    field = F.coalesce(F.col("_field") == 1, F.lit(False))
    wanted = docs.withColumn("_there", F.lit(True)).withColumn("_field", F.lit(0))
    rows = per.withColumn("_field", F.col("_field").cast("int")).join(wanted, ["row_idx", "_field"], "full").where(field | F.col("_there"))
    rows = rows.select(
        F.when(field, F.col("tier")).otherwise(F.col("_tier")).alias("tier"),
        field.alias("_field"),
        (F.coalesce("keys", F.lit(0)) == F.coalesce("hits", F.lit(0))).cast("int").alias("_right"),
        F.when(F.coalesce("keys", F.lit(0)) > 0, F.col("hits") / F.col("keys")).otherwise(1.0).alias("_acc"),
    )
    doc = ~F.col("_field")
    out = rows.rollup("tier").agg(
        F.count_if(doc).alias("docs"),
        F.avg(F.when(doc, F.col("_right"))).alias("all_correct"),
        F.avg(F.when(doc, F.col("_acc"))).alias("mean_field_acc"),
        F.when((F.grouping("tier") == 0) & F.col("tier").isNotNull(), F.avg(F.when(F.col("_field"), F.col("_acc")))).alias("norm_field_acc"),
    )
    return out.where("docs > 0").orderBy(F.col("tier").asc_nulls_last())


def field_report(cells: DataFrame, pairs: int = 10) -> DataFrame:
    """(tier, key, total, exact_hits, norm_hits, exact_acc, norm_acc, top_misses): each field of each tier and of all (tier
    null) with its most frequent misses as a list of (gt, pred, count); one pass over the cells.

    Misses are counted by tier, added up over tiers, and ranked within a limit: what meets in one task is ``pairs`` rows of each other task.
    """
    per = metrics.pair_counts(cells, "tier", "key")
    counts = [F.sum(c).alias(c) for c in ("total", "exact_hits", "norm_hits")]
    every = per.groupBy("key", "gt_n", "pred_n").agg(*counts, F.min("first_row").alias("first_row"))
    both = per.unionByName(every.withColumn("tier", F.lit(None).cast("string")))
    totals = metrics._field_totals(both, "tier", "key")
    miss = F.struct("rank", F.col("gt_n").alias("gt"), F.col("pred_n").alias("pred"), F.col("misses").alias("count"))
    lists = metrics.ranked_misses(both, pairs, "tier", "key").groupBy("tier", "key").agg(F.array_sort(F.collect_list(miss)).alias("x"))
    lists = lists.select(F.col("tier").alias("_t"), F.col("key").alias("_k"), "x")
    out = totals.join(lists, F.col("tier").eqNullSafe(F.col("_t")) & (F.col("key") == F.col("_k")), "left")
    none = F.array().cast("array<struct<gt:string,pred:string,count:bigint>>")
    misses = F.transform("x", lambda y: F.struct(y["gt"].alias("gt"), y["pred"].alias("pred"), y["count"].alias("count")))
    return out.select(
        "tier",
        "key",
        "total",
        "exact_hits",
        "norm_hits",
        (F.col("exact_hits") / F.col("total")).alias("exact_acc"),
        (F.col("norm_hits") / F.col("total")).alias("norm_acc"),
        F.coalesce(misses, none).alias("top_misses"),
    )


def report_text(split: DataFrame, cells: DataFrame, missing: DataFrame, preds: DataFrame | None = None, worst: int = 15) -> str:
    """The report of a run: tiers, the worst fields, and the misses of the five worst."""
    out = [f"Scored {split.count()} samples ({missing.count()} missing predictions)", "", "=== Per-tier accuracy ===", _line(_TIER_HEAD)]
    for r in tier_table(split, cells, preds).collect():
        if r.tier is None:
            out.append(_line(_TIER_HEAD[:4], ("OVERALL", r.docs, float(r.all_correct or 0.0), float(r.mean_field_acc or 0.0))))
        else:
            out.append(_line(_TIER_HEAD, (r.tier, r.docs, float(r.all_correct), float(r.mean_field_acc), float(r.norm_field_acc or 0.0))))
    fields = field_report(cells, 5).where("tier is null").orderBy("norm_acc", F.desc("total"), "key").limit(worst).collect()
    out += ["", f"=== Worst {worst} fields (by normalized accuracy) ===", _line(_FIELD_HEAD)]
    out += [_line(_FIELD_HEAD, (r.key[:48], r.total, float(r.exact_acc), float(r.norm_acc))) for r in fields]
    out += ["", "=== Top miss pairs (worst fields only) ==="]
    for r in fields[:5]:
        if r.top_misses:
            out.append(f"-- {r.key}")
            out += [f"     {m['count']:>4}x  gt={(m['gt'] or '<blank>')!r:<28}  pred={(m['pred'] or '<blank>')!r}" for m in r.top_misses]
    return "\n".join(out)


def summary_text(cells: DataFrame, split: DataFrame, valid: DataFrame, model: str = "") -> str:
    """The summary of a run: populated and blank fields, tiers, classes with their error rates, validity."""
    found = {r.populated: r for r in metrics.populated_blank(cells).collect()}
    out = [f"=== Summary: {model or '(unnamed)'} ({split.count()} samples) ==="]
    for label, full in (("populated fields", True), ("blank fields", False)):
        r = found.get(full)
        norm, exact, n = (r.norm_acc, r.exact_acc, r.total) if r else (0.0, 0.0, 0)
        out.append(f"{label:<17}: norm={norm:.3f}  exact={exact:.3f}  (n={n})")
    seen = {r.tier: r for r in metrics.tier_populated(cells).collect()}
    out += ["", "--- Per-tier (populated fields, normalized) ---", _line(_POPULATED_HEAD)]
    for r in metrics.tier_order(split).orderBy("position").collect():
        got = seen.get(r.tier)
        out.append(_line(_POPULATED_HEAD, (r.tier, got.total if got else 0, float(got.norm_acc) if got else 0.0)))
    rates = {r.cls: r for r in metrics.error_rates(cells).collect()}
    classes = {r.cls: r for r in metrics.by_class(cells).collect()}
    out += ["", "--- Per field-class (populated only) ---", _line(_CLASS_HEAD)]
    for cls in keys.CLASSES:
        c, rate = classes[cls], rates.get(cls)
        out.append(_line(_CLASS_HEAD, (cls, c.populated, float(c.exact_acc), float(c.norm_acc), float(rate.mean_cer) if rate else "n/a")))
    every = rates["overall"]
    out.append(f"{'CER overall':<12}{every.n:>7}{'':>18}{float(every.mean_cer):>9.3f}")
    v = valid.first()
    out += [
        "",
        "--- JSON validity ---",
        "  ".join(f"{name}={getattr(v, col):.3f}" for name, col in (("parse_rate", "parse_rate"), ("has_expected_keys", "has_expected_keys_rate"), ("valid_rate", "valid_rate"), ("mean_key_coverage", "mean_key_coverage"))),
    ]
    return "\n".join(out)
