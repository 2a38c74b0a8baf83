"""Score runs, bucketed cells, ordered and appended sources, artefact sink, documents of unknown shape, lazy iteration."""

import json
import random

import pytest
from pyspark.sql import functions as F

from ledgerleaf.functions import keys, text
from ledgerleaf.operators import cells, flatten, iterate, metrics, report, score_run
from ledgerleaf.sources import artefacts, cell_store, files

SPLIT = "row_idx long, sample_id string, tier string"


def rows_of(df):
    return sorted(map(str, df.collect()))


# ---------------------------------------------------------------- score runs
@pytest.fixture
def batch(tmp_path):
    """A split of three samples with labels, and predictions: one right, one wrong and then another, one missing."""
    (tmp_path / "fax").mkdir()
    for i in range(3):
        (tmp_path / "fax" / f"{i}.json").write_text(json.dumps({"logical": {"a_date": "01/02/2020", "x_npi": f"12{i}", "blank": ""}}))
    (tmp_path / "split.jsonl").write_text("".join(json.dumps({"sample_id": f"s{i}", "tier": ("fax", "worst")[i % 2], "json": f"fax\\{i}.json"}) + "\n" for i in range(3)))
    lines = [
        {"sample_id": "s0", "fields": {"a_date": "2020-1-2", "x_npi": "120", "blank": ""}},
        {"sample_id": "s1", "fields": {"a_date": "bad"}},
        {"sample_id": "s1", "fields": {"a_date": "bad", "x_npi": "1 2 1", "odd": "x"}, "raw": "{broken"},
        {"sample_id": "s9", "fields": {}},
    ]
    (tmp_path / "preds.jsonl").write_text("\n\n".join(map(json.dumps, lines)) + "\n")
    return tmp_path


def test_score_run_from_files(spark, batch):
    run = score_run.score(spark, f"{batch}/split.jsonl", f"{batch}/preds.jsonl", str(batch), f"{batch}/run-1", "m")
    assert run.totals == {"cells": 10, "exact": 4, "norm": 6, "both_sides": 5, "samples": 3, "answered": 2, "parsed": 1}
    t = run.tables()
    assert {(r.tier, r.key): (r.total, r.norm_hits) for r in t["fields"].where("key = 'a_date'").collect()} == {(None, "a_date"): (3, 1), ("fax", "a_date"): (2, 1), ("worst", "a_date"): (1, 0)}
    assert [r.sample_id for r in t["missing"].collect()] == ["s2"]
    v = t["validity"].first()
    assert (v.samples, v.parse_rate, v.has_expected_keys_rate, v.valid_rate, v.mean_key_coverage) == (3, 1 / 3, 1 / 3, 1 / 3, 1 / 3)
    assert "Scored 3 samples (1 missing predictions)" in run.text() and "=== Summary: m (3 samples) ===" in run.text()
    # opened later by its folder, and reported once however often that is asked for
    again = score_run.ScoreRun(spark, run.path, "m")
    for _ in range(2):
        again.write_report(f"{batch}/summaries")
    got = files.read_summaries(spark, f"{batch}/summaries").collect()
    assert [(r.model, r.n_samples) for r in got] == [("m", "3")]
    assert spark.read.json(f"{run.path}/report/worst").count() == 4
    # nothing but the run's own two tables is read
    assert {x.split("/run-1/")[1].split("/")[0] for t in run.tables().values() for x in t.inputFiles()} == {"cells", "samples"}


def test_score_run_of_nothing(spark, tmp_path):
    split = spark.createDataFrame([], SPLIT)
    both = spark.createDataFrame([], f"{SPLIT}, key string, gt string, pred string, has_gt boolean, has_pred boolean")
    run = score_run.start(split, both, spark.createDataFrame([], "sample_id string, parse_ok boolean"), f"{tmp_path}/r")
    assert run.totals["cells"] == 0 and run.tables()["fields"].collect() == []
    assert run.validity.first().samples == 0 and run.summary.first().n_samples == 0


def test_cell_validity_agrees_with_validity(spark):
    r = random.Random(4)
    split = spark.createDataFrame([(i, f"s{i}", "fax") for i in range(20)], SPLIT)
    gt = {i: [k for k in "abcde" if r.random() < 0.6] for i in range(20)}
    said = {i: [k for k in "abcdex" if r.random() < 0.7] for i in range(0, 20, 2)}
    ok = {i: r.random() < 0.7 for i in said}
    both = [(i, f"s{i}", "fax", k, "1", "1", k in gt[i], k in said.get(i, [])) for i in range(20) for k in "abcdex" if k in gt[i] or k in said.get(i, [])]
    c = spark.createDataFrame(both, f"{SPLIT}, key string, gt string, pred string, has_gt boolean, has_pred boolean")
    want = spark.createDataFrame([(i, v) for i, v in gt.items()], "row_idx long, want array<string>")
    out = spark.createDataFrame([(f"s{i}", ok[i], v if ok[i] else []) for i, v in said.items()], "sample_id string, parse_ok boolean, got array<string>")
    a, b = metrics.cell_validity(split, c, out).first(), metrics.validity(split, want, out).first()
    assert a.asDict() == pytest.approx(b.asDict())


def test_misses_rank_within_a_limit(spark):
    """No window over all misses of a field: the plan limits ranks before rows meet."""
    r = random.Random(5)
    rows = [(i, f"s{i}", "fax", r.choice("ab"), str(r.randint(0, 30)), str(r.randint(0, 3))) for i in range(2000)]
    c = cells.compared(spark.createDataFrame(rows, f"{SPLIT}, key string, gt string, pred string"))
    for df in (metrics.top_misses(c), report.field_report(c)):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("Window ") == plan.count("WindowGroupLimit ") == 1
    counts = {}
    for i, _, _, k, g, p in rows:
        if g != p:
            n, first = counts.get((k, g, p), (0, i))
            counts[k, g, p] = (n + 1, first)
    for k in "ab":
        best = sorted(((-n, f, g, p) for (x, g, p), (n, f) in counts.items() if x == k))[:5]
        got = sorted((x.rank, x.gt_n, x.pred_n, x.misses) for x in metrics.top_misses(c).where(F.col("key") == k).collect())
        assert got == [(i, g, p, -n) for i, (n, _, g, p) in enumerate(best, 1)]


# ---------------------------------------------------------------- bucketed cells
def test_cell_store_joins_without_exchange(spark, tmp_path):
    split = spark.createDataFrame([(i, f"s{i}", "fax") for i in range(30)], SPLIT)
    gt = spark.createDataFrame([(i, k, f"{i}") for i in range(30) for k in ("a", "b.npi")] + [(99, "a", "x")], "row_idx long, key string, gt string")
    pred = spark.createDataFrame([(i, k, f"{i % 7}") for i in range(0, 40, 2) for k in ("a", "c")], "row_idx long, key string, pred string")
    store = cell_store.CellStore(spark, str(tmp_path / "store"), "t_cells", 4)
    store.put_truth(split, gt)
    store.put_predictions("one", split, pred)
    got = store.cells("one")
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Exchange" not in plan and plan.count("Bucketed: true") == 2
    want = cells.compare_cells(split, gt, pred)
    assert rows_of(got.select(*sorted(want.columns))) == rows_of(want.select(*sorted(want.columns)))
    store.put_predictions("two", split, pred.where("row_idx < 0"))
    assert store.cells("two").where("has_pred").count() == 0 and store.cells("one").where("has_pred").count() == 30
    with pytest.raises(ValueError):
        store.put_predictions("truth", split, pred)
    store.drop()
    assert not spark.catalog.listTables(pattern="t_cells_*")


# ---------------------------------------------------------------- sources
def test_lines_are_numbered_without_a_shuffle(spark, tmp_path):
    n = 0
    for k, size in (("b", 400), ("a", 3000), ("c", 1)):
        (tmp_path / f"{k}.jsonl").write_text("".join(f'{{"sample_id":"{k}{i}"}}\n' + "\n" * (i % 3 == 0) for i in range(size)))
        n += size
    was = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "7000")  # files in many pieces
        df = files.read_manifest(spark, f"{tmp_path}/*.jsonl")
        got = {r.sample_id: r.row_idx for r in df.collect()}
        plan = df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", was)
    order = [f"a{i}" for i in range(3000)] + [f"b{i}" for i in range(400)] + ["c0"]
    assert got == {x: i for i, x in enumerate(order)} and len(got) == n
    left = plan[: plan.index("BroadcastExchange")]
    assert "Exchange" not in left and "Window" not in left  # rows of the manifest meet the table of pieces where they are read


def test_malformed_predictions_name_their_line(spark, tmp_path):
    good = '{"sample_id":"1","fields":{"a":"0"}}\n'
    (tmp_path / "p.jsonl").write_text(good + "\n" + good + "[1, 2]\n")
    with pytest.raises(Exception, match=r"malformed prediction: line 4 of file:.*p\.jsonl"):
        files.read_predictions(spark, str(tmp_path / "p.jsonl")).collect()


def test_append_once(spark, tmp_path):
    path = str(tmp_path / "table")
    one = spark.createDataFrame([("a", 1), ("b", 2), ("b", 2), (None, 3)], "k string, v int")
    two = spark.createDataFrame([("b", 9), ("c", 4), (None, 5)], "k string, v int")
    assert files.append_once(one, path, "1", ["k"]) and not files.append_once(one, path, "1", ["k"])
    assert files.append_once(two, path, "2", ["k"]) and files.append_once(two.limit(0), path, "3", ["k"])
    assert sorted((r.k or "", r.v, r.batch) for r in files.read_appended(spark, path, "json", "k string, v int").collect()) == [("", 3, "1"), ("a", 1, "1"), ("b", 2, "1"), ("b", 2, "1"), ("c", 4, "2")]
    assert not list((tmp_path / "table").glob("_new*")) and files.read_appended(spark, str(tmp_path / "no"), "json", "k string").collect() == []
    with pytest.raises(ValueError):
        files.append_once(one, path, "a/b")


def test_append_once_lets_one_writer_win(spark, tmp_path, monkeypatch):
    """Another writer shows the batch after this one has looked: its rename loses, and what it wrote goes."""
    path, df = str(tmp_path / "table"), spark.range(3)
    real = files._file_system

    def late(session, where):
        fs, p = real(session, where)
        if not (tmp_path / "table" / "batch=x").exists():
            monkeypatch.setattr(files, "_file_system", real)
            assert files.append_once(spark.range(5), path, "x")

            class Blind:
                def exists(self, _):
                    monkeypatch.setattr(files, "_file_system", real)
                    return False

                def __getattr__(self, name):
                    return getattr(fs, name)

            return Blind(), p
        return fs, p

    monkeypatch.setattr(files, "_file_system", late)
    assert not files.append_once(df, path, "x")
    assert files.read_appended(spark, path, "json", "id long").count() == 5 and not list((tmp_path / "table").glob("_new*"))


def test_artefact_sink(spark, tmp_path):
    rows = [(f"t{i % 3}/f{i}.bin", bytes([i]) * i) for i in range(12)] + [("null.bin", None)]
    df = spark.createDataFrame(rows, "target string, content binary").repartition(3)
    artefacts.write(df, f"file:{tmp_path}/out")
    got = {str(p.relative_to(tmp_path / "out")): p.read_bytes() for p in (tmp_path / "out").rglob("*") if p.is_file()}
    assert got == {t: c or b"" for t, c in rows}
    artefacts.write(df.limit(0), str(tmp_path / "empty"))
    bad = spark.createDataFrame([("ok.bin", b"1"), ("../out.bin", b"2")], "target string, content binary")
    with pytest.raises(Exception, match="no name below the sink"):
        artefacts.write(bad, str(tmp_path / "failed"))
    assert not [p for p in tmp_path.glob("failed/**/*") if p.is_file()] and not (tmp_path / "out.bin").exists()


# ---------------------------------------------------------------- documents of unknown shape
def test_flat_rows_and_back(spark):
    docs = ['{"a":{"b":"1","c":["x","y"]},"l":[{"p":"1"},{"p":"2","q":{"r":"é\\""}}],"z":""}', "{}", "[1]", "no json", None, '{"n":[[{"d":"1"}],[{"d":"2"},{"d":"3"}]]}']
    df = spark.createDataFrame([(i, d) for i, d in enumerate(docs)], "row int, doc string")
    rows = flatten.flat_rows(df, "doc", "row")
    flat = {}
    for r in rows.orderBy("row", "pos").collect():
        flat.setdefault(r.row, []).append((r.key, r.value))
    assert flat[0] == [("a.b", "1"), ("a.c", "x | y"), ("l[0].p", "1"), ("l[1].p", "2"), ("l[1].q.r", 'é"'), ("z", "")] and flat[2] == [("", "1")] and 3 not in flat and 4 not in flat
    back = {r.row: json.loads(r.doc) for r in flatten.nested_json(rows.where("key <> ''"), "row").collect()}
    assert back == {0: flatten.unflat(flat[0]), 5: json.loads(docs[5])}
    gaps = spark.createDataFrame([(1, 0, "l[2].a", "x"), (1, 1, "l[0].a", None)], "row int, pos int, key string, value string")
    assert [json.loads(r.doc) for r in flatten.nested_json(gaps, "row").collect()] == [{"l": [{"a": ""}, {}, {"a": "x"}]}]
    assert flatten.nested_json(gaps.where("row = 0"), "row").collect() == []


def test_names_known_when_the_plan_is_built(spark):
    names = ["box_3_patient_birth", "x.phone", "box_28_total_charge", "box_17b_npi", "p_sex", "a.state", "accident_state", "box_24_service_lines[0].procedure_code", "box_33_billing_provider.name", "city_state_zip", "plain"]
    df = spark.createDataFrame([(n,) for n in names], "key string").select("key", text.kind_of("key"), keys.class_of("key"), keys.region_of("key"))
    for key, kind, cls, region in df.collect():
        assert (text.name_that_holds(key, text.KINDS) or "generic", text.name_that_holds(key, keys.CLASS_ROWS), keys.region_name(key)) == (kind, cls, region)


# ---------------------------------------------------------------- iteration
def test_iter_rows_in_order_and_lazily(spark):
    df = spark.range(5000).select((F.lit(4999) - F.col("id")).alias("row_idx"), F.col("id").cast("string").alias("v")).repartition(7)
    got = [r.row_idx for r in iterate.iter_rows(df, most_rows=300)]
    assert got == list(range(5000))
    first = iterate.iter_rows(df, most_rows=100)
    assert [next(first).row_idx for _ in range(3)] == [0, 1, 2]
    assert list(iterate.iter_rows(df.limit(0))) == []


def test_names_of_uploads(spark):
    df = spark.createDataFrame([("a/b/Claim.PDF",), ("x\\y.pdf",), ("plain",), (None,)], "path string")
    assert [r[0] for r in df.select(files.output_prefix(F.col("path"))).collect()] == ["extractions/Claim", "extractions/y", "extractions/plain", None]
    assert df.select(files.output_prefix(F.col("path"), F.lit("out/1"))).first()[0] == "out/1"
