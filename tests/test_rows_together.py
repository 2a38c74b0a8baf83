"""What a sample's or a claim's cells are compared with meets them as one row: cells are not moved one by one."""

import json
import re

from pyspark.sql import functions as F

from ledgerleaf.operators import cells, synth
from ledgerleaf.plans import catalog
from ledgerleaf.sources import cell_store
from ledgerleaf.streaming import scoring

SF = "/root/testdata/sf0.001"
SPLIT = "row_idx long, sample_id string, tier string"


def test_truth_of_a_stream_is_a_row_a_sample(spark, tmp_path):
    split = spark.createDataFrame([(i, f"s{i}", "fax") for i in range(5)], SPLIT)
    gt = spark.createDataFrame([(i, k, v, t) for i in range(4) for k, v, t in (("a", "1/2/2020", "date"), ("b", "x", "generic"), ("c", "n/a", "generic"))], "row_idx long, key string, gt string, kind string")
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "0.json").write_text("".join(json.dumps({"sample_id": f"s{i}", "fields": {"a": "2020-1-2", "b": f"x{i or ''}"}, "at": "2024-01-01T00:00:00Z"}) + "\n" for i in range(3)))
    stream = scoring.start_last_wins(scoring.read_predictions(spark, str(tmp_path / "in")), split, gt, f"{tmp_path}/out", f"{tmp_path}/cp")
    assert stream.awaitTermination(180) and stream.exception() is None
    # a key's type came with the truth: "a" alone does not tell that it is a date
    assert [tuple(r) for r in scoring.scores(spark, f"{tmp_path}/out").collect()] == [("fax", 6, 4)]
    held = spark.read.parquet(f"{tmp_path}/out/truth_rows").collect()
    assert sorted(r.sample_id for r in held) == [f"s{i}" for i in range(4)] and all(sorted((c.key, c.gt_n) for c in r.cells) == [("a", "01/02/2020"), ("b", "X")] for r in held)


def rows_of(df, names):
    return sorted(map(repr, df.select(*names).collect()))


def test_rows_compare_as_cells_do(spark):
    """Samples without truth, without prediction, with odd keys, blank and null texts."""
    split = spark.createDataFrame([(i, f"s{i}", "fax") for i in range(6)], SPLIT)
    gt = [(0, "a_date", "01/02/2020"), (0, "x.npi", "123"), (1, "a_date", "3/4/21"), (1, "blank", ""), (2, "x.npi", None), (3, "city.state", "ny"), (9, "a_date", "1")]
    pred = [(0, "x.npi", "124"), (0, "odd_charges", "$1"), (1, "a_date", "2021-3-4"), (1, "blank", None), (2, "x.npi", "N/A"), (4, "odd.npi", "7"), (8, "x.npi", "1")]
    gt, pred = spark.createDataFrame(gt, "row_idx long, key string, gt string"), spark.createDataFrame(pred, "row_idx long, key string, pred string")
    want = cells.compare_cells(split, gt, pred)
    fields = pred.groupBy("row_idx").agg(F.map_from_entries(F.collect_list(F.struct("key", "pred"))).alias("fields"))
    plain = gt.groupBy("row_idx").agg(F.collect_list(F.struct("key", "gt")).alias("cells"))
    known = F.struct("key", "gt", F.expr("CASE WHEN key LIKE '%_date' THEN 'date' WHEN key LIKE '%npi' THEN 'id' WHEN key LIKE '%state' THEN 'state' ELSE 'generic' END AS kind"))
    typed = gt.groupBy("row_idx").agg(F.collect_list(known).alias("cells"))
    for truth in (plain, typed):
        got = cells.compare_rows(split, truth, fields)
        assert sorted(got.columns) == sorted(want.columns) and rows_of(got, want.columns) == rows_of(want, want.columns)


def test_cell_compare_moves_no_cell(spark):
    """Every exchange is of rows by claim or by the key of a table."""
    plan = catalog.QUERIES["cell_compare"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    moved = re.findall(r"Exchange hashpartitioning\(([^)]*?), \d+\)", plan)
    assert moved and not [x for x in moved if "," in x or x.startswith("key#")]


def test_manifest_reads_its_claims_without_a_text_between(spark):
    """What a manifest row asks of its claim is taken from the claim; the same as its text says."""
    got = catalog.QUERIES["synth_manifest"](spark, SF)
    assert "to_json" not in got._jdf.queryExecution().optimizedPlan().toString()
    made = synth.batch(spark, 20, catalog.AS_OF, seed_base=1).select("seed", F.to_json("ground_truth").alias("t")).collect()
    rows = {r.seed: r for r in got.where("seed <= 20").collect()}
    for r in made:
        if r.seed in rows:
            t, row = json.loads(r.t), rows[r.seed]
            want = (t["meta"]["seed"], 1 <= len(t["logical"]["box_24_service_lines"]) <= 6, int(t["logical"]["box_2_patient_name"]["last"] == ""))
            assert (row.truth_seed, row.lines_ok, row.blank_names) == want
    assert rows


def test_claims_are_returned_typed(spark):
    """A whole claim a row, in columns and not as a text that names each field in each row."""
    got = catalog.QUERIES["synth_records"](spark, SF)
    assert got.schema["ground_truth"].dataType.names == ["schema_version", "meta", "fields", "logical"]
    assert "to_json" not in got._jdf.queryExecution().optimizedPlan().toString()


def test_a_store_keeps_a_row_a_sample(spark, tmp_path):
    """Of cells or of gathered rows; keys and sample are not written for each cell, and both give the same table."""
    split = spark.createDataFrame([(i, f"s{i}", "fax") for i in range(8)], SPLIT)
    gt = spark.createDataFrame([(i, k, f"{i}") for i in range(8) for k in ("a", "b.npi")], "row_idx long, key string, gt string")
    pred = spark.createDataFrame([(i, k, f"{i % 3}") for i in range(0, 10, 2) for k in ("a", "c")], "row_idx long, key string, pred string")
    rows = gt.groupBy("row_idx").agg(F.collect_list(F.struct("key", "gt")).alias("cells"))
    fields = pred.groupBy("row_idx").agg(F.map_from_entries(F.collect_list(F.struct("key", "pred"))).alias("fields"))
    got = []
    for name, truth, said in (("by_cell", gt, pred), ("by_row", rows, fields)):
        store = cell_store.CellStore(spark, str(tmp_path / name), f"t_{name}", 4)
        store.put_truth(split, truth)
        store.put_predictions("one", split, said)
        assert spark.read.parquet(str(tmp_path / name / "truth")).count() == 8 and spark.read.parquet(str(tmp_path / name / "one")).count() == 4
        got.append(rows_of(store.cells("one"), sorted(store.cells("one").columns)))
        store.drop()
    assert got[0] == got[1] and len(got[0]) == 8 * 2 + 4
