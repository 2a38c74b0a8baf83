"""Flattening, scoring, splits, generator, sources and streaming on small batches."""

import json

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerleaf.functions import keys
from ledgerleaf.operators import cells, flatten, geometry, images, metrics, serving, splits, synth, training_rows, validators
from ledgerleaf.sources import files
from ledgerleaf.streaming import scoring


def flat(spark, doc):
    r = spark.createDataFrame([(json.dumps(doc),)], "t string").select(flatten.flat_json("t").alias("c")).first().c
    return {x.key: x.value for x in r}


def test_flat_json(spark):
    assert flat(spark, {"a": {"b": 1}, "l": [{"c": "x"}, {"c": None}], "d": ["M15.9", None, True], "y": True, "e": [], "f": {}, "g": None}) == {
        "a.b": "1", "l[0].c": "x", "l[1].c": "", "d": "M15.9 |  | True", "y": "YES", "e": "", "f": "", "g": ""}
    assert flat(spark, {}) == {"": ""}


def test_struct_and_json_agree(spark):
    df = spark.sql("select named_struct('a', 'x', 'o', cast(null as struct<p:string,q:string>), 'l', array(named_struct('c', 1, 'm', array('u', null)), named_struct('c', 2, 'm', cast(array() as array<string>))), 'b', false) doc")
    got = [(x.key, x.value) for x in df.select(flatten.flat_cells(F.col("doc"), df.schema["doc"].dataType).alias("c")).first().c]
    assert got == [("a", "x"), ("o", ""), ("l[0].c", "1"), ("l[0].m", "u | "), ("l[1].c", "2"), ("l[1].m", ""), ("b", "NO")]


@settings(max_examples=60, suppress_health_check=list(HealthCheck), deadline=None)
@given(st.dictionaries(st.sampled_from("abc"), st.one_of(st.text("xy", min_size=1), st.lists(st.dictionaries(st.sampled_from("pq"), st.text("xy", min_size=1), min_size=1), min_size=1)), min_size=1))
def test_unflat_inverts(doc):
    assert flatten.unflat(list(flatten._flat(doc, ""))) == doc


@pytest.fixture
def batch(spark):
    split = spark.createDataFrame([(0, "s1", "fax"), (1, "s2", "worst")], "row_idx long, sample_id string, tier string")
    gt = spark.createDataFrame(
        [(i, k, v) for i in (0, 1) for k, v in (("a_date", "01/02/2020"), ("x.npi", "123"), ("blank", ""))],
        "row_idx long, key string, gt string",
    )
    return split, gt


def test_perfect_and_spoilt(spark, batch):
    split, gt = batch
    same = cells.compare_cells(split, gt, gt.withColumnRenamed("gt", "pred"))
    assert {(r.populated, r.norm_acc) for r in metrics.populated_blank(same).collect()} == {(True, 1.0), (False, 1.0)}
    bad = spark.createDataFrame(
        [(0, "a_date", "2020-1-2"), (0, "x.npi", "124"), (0, "blank", "made up"), (0, "extra", "v")],
        "row_idx long, key string, pred string",
    )
    c = cells.compare_cells(split, gt, bad)
    rows = {(r.row_idx, r.key): r for r in c.collect()}
    assert rows[0, "a_date"].norm and not rows[0, "a_date"].exact and not rows[0, "extra"].norm and not rows[1, "a_date"].norm
    assert rows[0, "x.npi"].cer == pytest.approx(1 / 3)
    assert {r.cls: r.populated for r in metrics.by_class(c).collect()}["dates"] == 2
    assert {r.tier: r.docs for r in metrics.doc_stats(split, c).collect()} == {"fax": 1, "worst": 1, None: 2}
    assert metrics.worst_fields(c, 2).count() == 2
    valid = spark.sql("select 0.5D valid_rate, 0.25D parse_rate")
    row = metrics.summary_row(c, split, valid, "m").first()
    assert row.n_samples == 2 and row.tier_pristine_norm_acc is None and row.json_valid_rate == 0.5


def test_validity(spark, batch):
    split, _ = batch
    want = spark.createDataFrame([(0, ["a", "b"]), (1, ["a", "b"])], "row_idx long, want array<string>")
    out = spark.createDataFrame([("s1", True, ["a", "b", "c"]), ("s2", True, ["a"])], "sample_id string, parse_ok boolean, got array<string>")
    r = metrics.validity(split, want, out).first()
    assert (r.parse_rate, r.has_expected_keys_rate, r.valid_rate, r.mean_key_coverage) == (1.0, 0.5, 0.5, 0.75)
    r = metrics.validity(split, want, out.where("sample_id = 's1'")).first()
    assert (r.parse_rate, r.valid_rate, r.mean_key_coverage) == (0.5, 0.5, 0.5)


def test_splits(spark):
    rows = spark.range(92).select(F.col("id"), F.when(F.col("id") < 90, (F.col("id") % 3).cast("string")).otherwise("few").alias("tier"))
    got = splits.hash_stratified(rows, "tier", "id").collect()
    assert len(got) == 92 and {r.split for r in got if r.tier == "few"} == {"train"}
    assert {(t, s): sum(r.tier == t and r.split == s for r in got) for t in "012" for s in ("train", "val", "test")} == {(t, s): n for t in "012" for s, n in (("train", 24), ("val", 3), ("test", 3))}
    order = splits.ordered_stratified(rows, "tier", "id").where("tier = '0'").orderBy("id").collect()
    assert [r.split for r in order][-6:] == ["validation"] * 3 + ["test"] * 3
    assert splits.first_per_group(rows, "tier", "id", 2).count() == 8


def test_generator(spark):
    b = synth.batch(spark, 12, "2024-01-31", ["fax", "worst"])
    assert [r.tier for r in b.orderBy("seed").collect()] == ["fax", "worst"] * 6
    rec = synth.records(spark, 60, "2024-01-31")
    ok = validators.total_matches(F.col("service_lines"), "charges", F.col("billing.total_charge")) & validators.self_mirrored(
        F.col("patient.relationship_to_insured"),
        F.col("patient.name"),
        F.col("insured.name"),
    )
    assert rec.where(~ok).count() == 0 and keys.TIERS[0] == "pristine"
    with pytest.raises(ValueError):
        synth.batch(spark, 1, "2024-01-31", ["nope"])


def test_sources(spark, tmp_path):
    (tmp_path / "m.jsonl").write_text('{"sample_id":"1","tier":"fax","json":"fax\\\\1.json"}\n\n{"sample_id":"2","tier":"fax","json":"fax/2.json"}\n')
    (tmp_path / "fax").mkdir()
    for i in (1, 2):
        (tmp_path / "fax" / f"{i}.json").write_text(json.dumps({"logical": {"a": str(i), "l": [{"c": 1}]}}))
    split = files.read_manifest(spark, str(tmp_path / "m.jsonl"))
    assert [(r.sample_id, r.json) for r in split.orderBy("row_idx").collect()] == [("1", "fax/1.json"), ("2", "fax/2.json")]
    got = files.read_batch(spark, str(tmp_path), split).collect()
    assert sorted((r.key, r.gt) for r in got) == [("a", "1"), ("a", "2"), ("l[0].c", "1"), ("l[0].c", "1")]
    (tmp_path / "p.jsonl").write_text('{"sample_id":"1","fields":{"a":"0"}}\n{"sample_id":"1","fields":{"a":1.50,"b":null,"c":true},"raw":"{broken"}\nnot json\n')
    p = files.read_predictions(spark, str(tmp_path / "p.jsonl"), strict=False).collect()
    assert [(r.sample_id, r.fields) for r in p] == [("1", {"a": "1.5", "b": "", "c": "True"})]
    with pytest.raises(Exception, match="malformed"):
        files.read_predictions(spark, str(tmp_path / "p.jsonl")).collect()
    assert [(r.sample_id, r.parse_ok) for r in files.read_validity(spark, str(tmp_path / "p.jsonl")).collect()] == [("1", False)]
    files.write_summary(spark.sql("select 'm' model, cast(null as double) x"), str(tmp_path / "s"))
    files.write_summary(spark.sql("select 'n' model, 0.5D x"), str(tmp_path / "s"))
    assert sorted((r.model, r.x) for r in files.read_summaries(spark, str(tmp_path / "s")).collect()) == [("m", None), ("n", "0.5")]
    (tmp_path / "c.csv").write_text('code,description\n01,"A, b"\n')
    assert files.read_codes(spark, str(tmp_path / "c.csv")).first().code == "01"


def test_serving(spark):
    df = spark.createDataFrame([('```json\n{"a": "1"}\n```',), ('x {"a": "1", "b": "2', ), ("none",), (None,)], "t string")
    assert [r.x for r in df.select(serving.extract_json("t").alias("x")).collect()] == ['{"a":"1"}', '{"a":"1"}', None, None]
    said = spark.createDataFrame(
        [('sure: {"doc_type": "EOB ", "confidence": "High"}',), ("no",)],
        "t string",
    ).select(serving.classified(F.col("t")).alias("x")).collect()
    assert [tuple(r.x) for r in said] == [("eob", "high"), ("unknown", "low")]
    assert spark.sql("select map('a', '', 'b', 'x') m").select(serving.num_fields(F.col("m")).alias("n")).first().n == 1


@pytest.mark.parametrize(
    ("said", "found"),
    [
        ('{"a": "1", "b": 2, "c": {"d": ["x", null]}}', {"a": "1", "b": 2, "c": {"d": ["x", None]}}),
        ("  {}  ", {}),
        ('```json\n{ "a" : true }\n```', {"a": True}),
        ('```\n{"a": "1"}', {"a": "1"}),
        ('well: {"a": "x, y", "b": "{", "c": "br', {"a": "x, y", "b": "{"}),
        ('{"a": "1", "b": 5, "c": 6', {"a": "1"}),
        ('{"a": "1", "b": "2"} and more', {"a": "1"}),
        ('{"a": "\\"", "b": "2", "a": "3", "z', {"a": "3", "b": "2"}),
        ('{"a": 5, "b": 6', None),
        ('{"a"', None),
        ("{1: 2}", None),
        ("[1, 2]", None),
        ("", None),
        (None, None),
    ],
)
def test_salvage(said, found):
    assert serving._salvage(said) == found


def test_rows_geometry_images(spark):
    c = spark.sql("""select array(named_struct('key', 'a"b', 'value', 'é')) c""")
    assert c.select(training_rows.target_json(F.col("c")).alias("j")).first().j == json.dumps({'a"b': "é"}, ensure_ascii=False)
    assert geometry.bands(spark.createDataFrame([("x", 0.0, 0.0, 1.0, 1.0)], "name string, x0 double, y0 double, x1 double, y1 double")).count() == 0
    import numpy as np

    px = np.full((40, 30, 3), 200, np.uint8)
    for tier in keys.TIERS:
        a, b = images.degrade(px, tier, 3), images.degrade(px, tier, 3)
        assert a.shape == px.shape and a.dtype == np.uint8 and (a == b).all()
    with pytest.raises(ValueError):
        images.degrade(px, "nope", 1)


def test_streaming_matches_batch(spark, tmp_path, batch):
    split, gt = batch
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text('{"sample_id":"s1","fields":{"a_date":"1/2/2020","x.npi":"9"},"at":"2024-01-01T00:00:00Z"}\n' * 2)
    (tmp_path / "in" / "b.json").write_text('{"sample_id":"s2","fields":{},"at":"2024-01-02T00:00:00Z"}\n')
    scores = scoring.running_accuracy(scoring.read_predictions(spark, str(tmp_path / "in"), 1), split, gt)
    q = scoring.start(scores, str(tmp_path / "out"), str(tmp_path / "cp"))
    q.awaitTermination(120)
    got = {r.tier: (r.total, r.norm_hits) for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert got.get("fax") == (2, 1)
