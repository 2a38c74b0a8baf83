"""Steps of the summary row: what is not made must not change what is counted."""

from __future__ import annotations

import itertools

from pyspark.sql import functions as F

from ledgerleaf.functions import text
from ledgerleaf.operators import cells
from ledgerleaf.plans import catalog
from ledgerleaf.plans.claims import Claims

SF = "/root/testdata/sf0.001"


def _same(a, b) -> bool:
    return sorted(map(repr, a.collect())) == sorted(map(repr, b.collect()))


def _plan(df) -> str:
    return df._jdf.queryExecution().sparkPlan().toString() + df._jdf.queryExecution().executedPlan().toString()


def test_lines_are_the_sql_ones_and_are_moved_once(spark):
    c = Claims(spark, SF)
    assert _same(c.line, c._of("line").select(*c.line.columns))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = c.cells("gt")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert plan.count("Exchange hashpartitioning") == 2  # claims and line items


def test_sides_are_those_of_the_cells_without_values(spark):
    c = Claims(spark, SF)
    assert _same(c.sides, c.both.select("row_idx", "has_gt", "has_pred"))
    assert "Window" not in _plan(c.sides) and "Window" in _plan(c.both)


def test_populated_is_told_without_the_normal_form_of_equal_texts(spark):
    odd = ["", " ", "0", "n/a", "N/A 1", "$", "$ 1", "$,", "--", "ab9", "é", "é7", "(555) 1", "1/2/99", " ", "٥", "x٥", "a0\n", "none", "١2"]
    kinds = [*text.RULES, "generic"]
    rows = [(i, "s", "fax", "k", a, b, k, cls, "top") for i, (a, b, k, cls) in enumerate(itertools.product(odd, odd, kinds, ["money", None]))]
    both = spark.createDataFrame(rows, "row_idx long, sample_id string, tier string, key string, gt string, pred string, kind string, cls string, region string")
    full = cells.compared(both).select("row_idx", (F.col("gt_n") != "").alias("populated"), "exact", "norm", "cer")
    assert _same(cells.compared(both, equal=False, populated=True).select(*full.columns), full)


def test_the_summary_does_not_normalise_equal_texts(spark):
    got = catalog.rated_cells(spark, SF)
    assert got.where("exact AND gt_n IS NOT NULL").isEmpty()
    want = catalog.all_cells(spark, SF).groupBy("tier", "cls", (F.col("gt_n") != "").alias("populated")).agg(F.count("*"), F.count_if("norm"), F.round(F.sum("cer"), 6))
    assert _same(got.groupBy("tier", "cls", "populated").agg(F.count("*"), F.count_if("norm"), F.round(F.sum("cer"), 6)), want)
