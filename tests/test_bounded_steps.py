"""Steps whose cost must grow no faster than their input: how often a plan makes its rows, and what a step still gives."""

import json
import re

import pytest
from pyspark.sql import functions as F

from ledgerleaf.functions import forms
from ledgerleaf.operators import cells, flatten, metrics, report, synth
from ledgerleaf.plans import catalog
from ledgerleaf.plans.claims import Claims
from ledgerleaf.streaming import scoring

SF = "/root/testdata/sf0.001"


def plan_of(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_nested_documents_make_their_cells_once(spark):
    doc = '{"a":{"b":{"c":{"d":"1"}}},"l":[{"p":{"q":"2"}},{"p":{"q":"3"}}],"t":"é\\"\\\\"}'
    df = spark.createDataFrame([(i, doc) for i in range(3)], "row int, doc string")
    made = flatten.nested_json(flatten.flat_rows(df, "doc", "row"), "row", leaves="cells")
    assert plan_of(made).count("Generate ") == 1
    assert [(r.row, r.doc, r.cells) for r in made.orderBy("row").collect()] == [(i, doc, 4) for i in range(3)]


def test_places_and_order_of_nested_documents(spark):
    cells = [(1, 2, "n[1][0]", "c"), (1, 0, "n[0][1]", "b"), (1, 3, "z", None), (1, 4, "a.k[1].v", "x")]
    made = flatten.nested_json(spark.createDataFrame(cells, "row int, pos int, key string, value string"), "row")
    assert json.loads(made.first().doc) == {"n": [[{}, "b"], ["c"]], "z": "", "a": {"k": [{}, {"v": "x"}]}}
    assert made.select(F.get_json_object("doc", "$.n[0][1]")).first()[0] == "b"


def test_generated_claims_are_dealt_out_and_made_without_lambdas(spark):
    made = synth.of_seeds(spark.range(40).coalesce(1).select(F.col("id").alias("seed")), "2024-06-01")
    assert made.rdd.getNumPartitions() >= 2 * spark.sparkContext.defaultParallelism
    assert "lambdafunction" not in plan_of(made.select("diagnoses", "service_lines"))
    for r in made.select("diagnoses", "service_lines").collect():
        assert 1 <= len(r.service_lines) <= 6 and None not in r.service_lines and len(set(r.diagnoses)) == len(r.diagnoses)
        assert all(set(x.diagnosis_pointers) <= {chr(65 + i) for i in range(len(r.diagnoses))} for x in r.service_lines)


@pytest.mark.parametrize("made", ["both", "gt", "pred"])
def test_cells_stay_within_methods_that_are_compiled(spark, made, tmp_path):
    """A generated method beyond 8,000 bytes of code is interpreted, row by row, for the whole job."""
    tables = {
        "nation": "select 1 n_nationkey, 'PERU' n_name, 1 n_regionkey",
        "customer": "select 7L c_custkey, 'Ann' c_name, 1 c_nationkey, 1.5D c_acctbal, 'AUTO' c_mktsegment",
        "orders": "select 11L o_orderkey, 7L o_custkey, 'O' o_orderstatus, 10.25D o_totalprice, timestamp'1995-03-04' o_orderdate, '1-URGENT' o_orderpriority",
        "lineitem": "select 11L l_orderkey, 3L l_partkey, 4L l_suppkey, 1 l_linenumber, 2D l_quantity, 5.5D l_extendedprice, timestamp'1995-04-05' l_shipdate",
    }
    for name, made_by in tables.items():
        spark.sql(made_by).write.parquet(f"{tmp_path}/{name}.parquet")
    df = getattr(Claims(spark, str(tmp_path)), made)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = df.select("*")._jdf.queryExecution().executedPlan()
        package = getattr(getattr(spark._jvm.org.apache.spark.sql.execution.debug, "package$"), "MODULE$")
        sizes = [int(x) for x in re.findall(r"maxMethodCodeSize:(\d+)", package.codegenString(plan))]
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert sizes and max(sizes) < 8000
    keys_of = {r.key: r.asDict().get("gt", r.asDict().get("pred")) for r in df.collect()}
    assert keys_of["box_24_service_lines[0].date_from"] is not None and ("box_99_unknown" in keys_of) == (made != "gt")


def test_tier_table_reads_the_cells_once(spark):
    split = spark.createDataFrame([(i, f"s{i}", ("fax", "worst", None)[i % 3]) for i in range(7)], "row_idx long, sample_id string, tier string")
    rows = [(i, ("fax", "worst", None)[i % 3], k, (i + j) % 4 > 0) for i in range(6) for j, k in enumerate("abc")]
    cells = spark.createDataFrame(rows, "row_idx long, tier string, key string, norm boolean").withColumn("exact", F.col("norm")).select("*", F.explode(F.array(F.lit(1))).alias("once"))
    said = split.where("row_idx <> 4").select("sample_id")
    table = report.tier_table(split, cells, said)
    assert plan_of(table).count("Generate ") == 1
    macro = {r.tier: r.norm_field_acc for r in metrics.tier_macro(cells).collect()}
    docs = metrics.doc_accuracy(split, cells, said).rollup("tier").agg(F.count("*").alias("docs"), F.avg(F.col("all_correct").cast("int")).alias("r"), F.avg("acc").alias("m")).collect()
    want = sorted(map(str, ((r.tier, r.docs, round(r.r, 9), round(r.m, 9), r.tier and round(macro[r.tier], 9)) for r in docs)))
    assert sorted(map(str, ((r.tier, r.docs, round(r.all_correct, 9), round(r.mean_field_acc, 9), r.norm_field_acc and round(r.norm_field_acc, 9)) for r in table.collect()))) == want


def test_pages_are_dealt_out_before_they_are_made(spark):
    assert catalog._pages(spark, SF).rdd.getNumPartitions() >= 4 * spark.sparkContext.defaultParallelism


def test_cells_of_a_claim_are_not_moved_one_by_one(spark):
    c = Claims(spark, SF)
    assert "Generate" not in plan_of(c.rows) and "Generate" not in plan_of(c.predictions)
    by_cell = {(str(r.row_idx), r.key): r.pred for r in c.pred.collect()}
    assert {(r.sample_id, k): v for r in c.predictions.collect() for k, v in r.fields.items()} == by_cell
    assert plan_of(catalog.QUERIES["region_split"](spark, SF)).count("map_from_arrays") == 1


def test_known_records_are_not_written_and_parsed(spark):
    made = catalog.known_records(spark, SF)
    assert "from_json" not in plan_of(made) and [f.name for f in made.schema][1:] == forms.RECORD.names
    odd = spark.sql("select cast(null as struct<a: int>) s, array(named_struct('x', '1'), null) l")
    want = "struct<a: string, b: string>", "array<struct<x: string, y: string>>"
    got = odd.select(*(forms.as_type(F.col(n), odd.schema[n].dataType, spark.sql(f"select cast(null as {t}) v").schema["v"].dataType).alias(n) for n, t in zip("sl", want))).first()
    assert got.s is None and [x and tuple(x) for x in got.l] == [("1", None), None]


def test_stream_without_watermark_keeps_no_state(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text('{"sample_id":"s","fields":{"a":"1"},"at":"2024-01-01T00:00:00Z"}\n')
    split = spark.createDataFrame([(1, "s", "fax")], "row_idx long, sample_id string, tier string")
    gt = spark.createDataFrame([(1, "a", "1")], "row_idx long, key string, gt string")
    q = scoring.start_last_wins(scoring.read_predictions(spark, str(tmp_path / "in"), 1), split, gt, f"{tmp_path}/out", f"{tmp_path}/cp")
    assert q.awaitTermination(120) and q.exception() is None and not (tmp_path / "cp" / "state").exists()
    assert [tuple(r) for r in scoring.scores(spark, f"{tmp_path}/out").collect()] == [("fax", 1, 1)]


def test_equal_texts_are_not_normalised_where_only_misses_are_named(spark):
    rows = [("a_date", "1/2/24", "1/2/24"), ("a_date", "1/2/24", "01/02/2024"), ("phone", "(1) 2", "13"), ("sex", " male", ""), ("x", None, ""), ("x", "n/a", "")]
    both = spark.createDataFrame([(1, "s", "fax", *r) for r in rows], "row_idx long, sample_id string, tier string, key string, gt string, pred string")
    whole, part = cells.compared(both).collect(), cells.compared(both, equal=False).collect()
    assert [(r.exact, r.norm) for r in part] == [(r.exact, r.norm) for r in whole]
    assert [(r.gt_n, r.pred_n) for r in part] == [(None, None) if r.exact else (r.gt_n, r.pred_n) for r in whole]
    assert [r.exact for r in part] == [True, False, False, False, True, False] and [r.norm for r in part] == [True, True, False, False, True, True]
    for made in (metrics.miss_pairs, metrics.tier_macro, report.field_report, metrics.top_misses):
        got = [sorted(map(str, made(cells.compared(both, **{} if e else {"equal": e})).collect())) for e in (True, False)]
        assert got[0] == got[1]
