"""Reports, ordered sources, data set rules, code sets and generator weights."""

import json
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from ledgerleaf.functions import forms, keys, text
from ledgerleaf.operators import cells, codes, flatten, geometry, images, metrics, report, serving, splits, synth, training_rows, validators
from ledgerleaf.sources import files
from ledgerleaf.streaming import scoring


@pytest.fixture
def scored(spark):
    split = spark.createDataFrame([(0, "s1", "worst"), (1, "s2", "fax"), (2, "s3", "fax")], "row_idx long, sample_id string, tier string")
    gt = spark.createDataFrame(
        [(i, k, v) for i in range(3) for k, v in (("a_date", "01/02/2020"), ("x.npi", "123"), ("blank", ""))],
        "row_idx long, key string, gt string",
    )
    pred = spark.createDataFrame(
        [(0, "a_date", "2020-1-2"), (0, "x.npi", "124"), (1, "a_date", "01/02/2020"), (1, "x.npi", "124"), (1, "blank", "")],
        "row_idx long, key string, pred string",
    )
    missing = spark.createDataFrame([(2, "s3", "fax")], "row_idx long, sample_id string, tier string")
    said = spark.createDataFrame([("s1",), ("s2",)], "sample_id string")
    return split, cells.compare_cells(split, gt, pred), missing, said


def test_report_text(scored):
    split, c, missing, said = scored
    lines = report.report_text(split, c, missing, said).split("\n")
    assert lines[:3] == ["Scored 3 samples (1 missing predictions)", "", "=== Per-tier accuracy ==="]
    assert [x.split() for x in lines[3:7]] == [
        ["tier", "docs", "all_correct", "mean_field_acc", "norm_field_acc"],
        ["fax", "1", "0.000", "0.667", "0.500"],
        ["worst", "1", "0.000", "0.667", "0.667"],
        ["OVERALL", "2", "0.000", "0.667"],
    ]
    assert lines[4] == f"{'fax':<14}{1:>6}{0.0:>14.3f}{2 / 3:>18.3f}{0.5:>18.3f}"
    at = lines.index("=== Worst 15 fields (by normalized accuracy) ===")
    assert lines[at + 2].split() == ["x.npi", "3", "0.000", "0.000"]
    assert "-- x.npi" in lines and "        2x  gt='123'" in "\n".join(lines) and "pred='<blank>'" in "\n".join(lines)


def test_summary_text(scored, spark):
    split, c, _, _ = scored
    valid = spark.sql("select 1.0D parse_rate, 0.5D has_expected_keys_rate, 0.5D valid_rate, 0.75D mean_key_coverage")
    out = report.summary_text(c, split, valid, "m").split("\n")
    assert out[0] == "=== Summary: m (3 samples) ===" and out[1] == "populated fields : norm=0.333  exact=0.167  (n=6)" and out[2] == "blank fields     : norm=1.000  exact=1.000  (n=3)"
    assert [x.split()[0] for x in out if x.startswith(("fax", "worst"))] == ["fax", "worst"]  # known tiers in their order
    assert out[-1] == "parse_rate=1.000  has_expected_keys=0.500  valid_rate=0.500  mean_key_coverage=0.750"
    assert any(x.split() == ["dates", "3", "0.333", "0.667", "n/a"] for x in out)


def test_field_report_counts(scored):
    _, c, _, _ = scored
    rows = {(r.tier, r.key): r for r in report.field_report(c).collect()}
    every = rows[None, "x.npi"]
    assert (every.total, every.norm_hits) == (3, 0) and [tuple(m) for m in every.top_misses] == [("123", "124", 2), ("123", "", 1)]
    assert rows["fax", "blank"].norm_acc == 1.0 and rows["fax", "blank"].top_misses == []


def test_rows_are_numbered_by_file_and_place(spark, tmp_path):
    sizes = {"b.jsonl": 3, "a.jsonl": 900, "c.jsonl": 1}
    for name, n in sizes.items():
        (tmp_path / name).write_text("".join(json.dumps({"sample_id": f"{name}{i}", "tier": "fax"}) + "\n\n" for i in range(n)))
    rows = files.read_manifest(spark, f"{tmp_path}/*.jsonl").orderBy("row_idx").collect()
    assert [r.row_idx for r in rows] == list(range(904))
    assert [r.sample_id for r in rows] == [f"{name}{i}" for name in sorted(sizes) for i in range(sizes[name])]
    with pytest.raises(ValueError, match="no rows"):
        (tmp_path / "none.txt").write_text("\n")
        files.read_manifest(spark, str(tmp_path / "none.txt"), strict=True)


def test_last_prediction_over_files_and_missing_file(spark, tmp_path):
    (tmp_path / "p1.jsonl").write_text('{"sample_id":"1","fields":{"a":"old"}}\n' * 50)
    (tmp_path / "p2.jsonl").write_text('{"sample_id":"1","fields":{"a":"new"}}\n')
    assert files.read_predictions(spark, f"{tmp_path}/p*.jsonl").first().fields == {"a": "new"}
    assert files.read_validity(spark, f"{tmp_path}/nothing.jsonl").collect() == []


def test_split_manifest_and_artefacts(spark, tmp_path):
    (tmp_path / "m.jsonl").write_text("".join(json.dumps({
        "sample_id": str(i),
        "tier": ("fax", "worst")[i % 2],
        "image": f"x\\{i}.png",
        "json": f"x/{i}.json",
    }) + "\n" for i in range(60)))
    rows = files.split_manifest(spark, str(tmp_path / "m.jsonl"), str(tmp_path / "out")).collect()
    assert Counter((r.tier, r.split) for r in rows) == {(t, s): n for t in ("fax", "worst") for s, n in (("train", 24), ("val", 3), ("test", 3))}
    back = files.read_dataset_splits(spark, str(tmp_path / "out")).collect()
    assert sorted((r.sample_id, r.split, r.image) for r in back) == sorted((r.sample_id, r.split, r.image) for r in rows)
    order = [int(r.sample_id) for r in sorted(back, key=lambda r: r.row_idx) if r.split == "train"]
    assert order == sorted(order)  # a split keeps the manifest's order
    assert files.split_manifest(spark, str(tmp_path / "m.jsonl"), str(tmp_path / "out")).count() == 60  # and is replaced by a rerun
    assert files.read_dataset_splits(spark, str(tmp_path / "out")).count() == 60
    (tmp_path / "x").mkdir()
    for i in range(4):
        for end in ("png", "json"):
            (tmp_path / "x" / f"{i}.{end}").write_text(f"{i}{end}")
    some = files.sample_artefacts(files.read_manifest(spark, str(tmp_path / "m.jsonl")), 2)
    assert {(r.tier, r.path) for r in some.collect()} == {(("fax", "worst")[i % 2], f"x/{i}.{e}") for i in range(4) for e in ("png", "json")}
    done = files.copy_artefacts(spark, some, str(tmp_path / "x"), str(tmp_path / "copy")).collect()
    assert len(done) == 8 and (tmp_path / "copy" / "worst" / "3.json").read_text() == "3json"


def test_dataset_rules(spark, tmp_path, capsys):
    with pytest.raises(FileNotFoundError):
        files.read_dataset_splits(spark, str(tmp_path))
    (tmp_path / "val.jsonl").write_text('{"sample_id":"1","tier":"fax","image":"a.png","json":"a.json"}\n')
    (tmp_path / "test.jsonl").write_text('{"sample_id":"2","tier":"fax","image":"b.png","json":"b.json","split":"test"}\n')
    rows = files.read_dataset_splits(spark, str(tmp_path))
    labels = spark.createDataFrame([("a.json", [("k", "1")]), ("b.json", [("k", "2")])], "json string, cells array<struct<key:string,value:string>>")
    got = {r.sample_id: r for r in training_rows.dataset_rows(rows, labels, ["k"], "/d/").collect()}
    assert (
        got["1"].split,
        got["2"].split,
        got["1"].image,
        got["1"].target,
    ) == ("validation", "test", "/d/a.png", '{"k": "1"}') and got["1"].prompt == got["2"].prompt
    gt = spark.createDataFrame([(0, 1, "b"), (0, 0, "a"), (1, 0, "b"), (1, 1, "c")], "row_idx long, pos int, key string")
    assert files.print_keys(gt) == ["a", "b", "c"] and capsys.readouterr().out == "a\nb\nc\n"


def test_codes(spark, tmp_path):
    for k, rows in enumerate((["01,one", "02,two"], ["02,again", "03,three"])):
        (tmp_path / f"c{k}.csv").write_text("code,description\n" + "\n".join(rows) + "\n")
    table = files.read_codes(spark, f"{tmp_path}/c*.csv")
    assert [(r.ordinal, r.code) for r in table.orderBy("ordinal").collect()] == [(0, "01"), (1, "02"), (2, "02"), (3, "03")]
    got = codes.described(spark.createDataFrame([("02",), ("9",), (None,)], "c string"), table, "c").collect()
    assert sorted((r.c or "", r.description) for r in got) == [("", ""), ("02", "two"), ("9", "")]


def test_generator_draws_from_code_sets_by_weight(spark):
    own = synth.Codes(places=["11"], procedures=["J1", "J2"], diagnoses=[f"D{i}" for i in range(20)])
    rows = synth.records(spark, 3000, "2024-01-31", codes=own).select("diagnoses", "service_lines", "condition.employment_related").collect()
    n = Counter(len(r.diagnoses) for r in rows)
    assert all(abs(n[i + 1] / 3000 - w / 100) < 0.03 for i, w in enumerate(synth.WEIGHTS["diagnoses"]))
    n = Counter(len(r.service_lines) for r in rows)
    assert all(abs(n[i + 1] / 3000 - w / 100) < 0.03 for i, w in enumerate(synth.WEIGHTS["lines"]))
    lines = [x for r in rows for x in r.service_lines]
    assert {x.place_of_service for x in lines} == {"11"} and {x.cpt for x in lines} == {"J1", "J2"}
    assert all(len(set(r.diagnoses)) == len(r.diagnoses) and set(r.diagnoses) <= set(own.diagnoses) for r in rows)
    mods = Counter(sum(m != "" for m in x.modifiers) for x in lines)
    assert all(abs(mods[i] / len(lines) - w / 100) < 0.03 for i, w in enumerate(synth.WEIGHTS["modifiers"])) and {m for x in lines for m in x.modifiers if m} == set(synth.MODIFIERS)
    assert any(x.diagnosis_pointers != "".join(sorted(x.diagnosis_pointers)) for x in lines) and abs(sum(r.employment_related == "YES" for r in rows) / 3000 - 0.1) < 0.03


def test_unflatten_conflicts():
    assert flatten.unflat([("a", "1"), ("a.b", "2"), ("l[2].x", "3"), ("l[0]", "4")]) == {"a": {"b": "2"}, "l": ["4", {}, {"x": "3"}]}
    assert flatten.unflat([("a.b", "1"), ("a", "2")]) == {"a": "2"} and flatten.unflat([]) == {}
    assert flatten.unflat([("a[0].p", "1"), ("a.q", "2"), ("a.r", "3")]) == {"a": {"q": "2", "r": "3"}}
    assert flatten.unflat([("a[x]", "1"), ("b[0][1]", "2")]) == {"a[x]": "1", "b[0]": [{}, "2"]}


def test_salvage():
    assert serving._salvage('{"a": "1", "b": 2, "c": "3", "d') == {"a": "1", "b": 2, "c": "3"}
    assert serving._salvage('{"a": "1"} thanks') is None and serving._salvage('say {"a": "x,y", "b": "1"} thanks') == {"a": "x,y"}
    assert serving._salvage('```json\n{"a": 1}\n```\n') == {"a": 1} and serving._salvage("") is None and serving._salvage('{"a": 1, "b') is None


def test_regions_bands_and_crops(spark):
    df = spark.sql("select array(named_struct('key', 'box_28_total_charge', 'value', '1'), named_struct('key', 'x', 'value', '2')) c")
    got = df.select(keys.split_regions(F.col("c")).alias("m")).first().m
    assert {k: [x.key for x in v] for k, v in got.items()} == {"top": ["x"], "service": [], "bottom": ["box_28_total_charge"]}
    rows = geometry.standard_bands(spark.createDataFrame([(2550, 3300), (1275, 1650)], "width int, height int")).collect()
    assert {(r.width, r.region): (r.x0, r.y0, r.x1, r.y1) for r in rows}[1275, "service"] == (0, 1077, 1275, 1423)
    page = spark.createDataFrame([("p", 4, 2, bytes(range(24)))], "sample_id string, height int, width int, pixels binary")
    (cut,) = images.crop_regions(page, [("top", 1, 1, 2, 3)]).collect()
    assert (cut.height, cut.width, bytes(cut.pixels)) == (2, 1, bytes([9, 10, 11, 15, 16, 17]))


def test_ordered_split_ties_nulls_and_ranges(spark):
    rows = spark.createDataFrame([(i if i % 10 else None, "s") for i in range(200)], "o int, t string")
    got = splits.ordered_stratified(rows, "t", "o", ranges=16).collect()
    assert Counter(r.split for r in got) == {"train": 160, "validation": 20, "test": 20}
    assert all(r.split == "train" for r in got if r.o is None) and min(r.o for r in got if r.split == "test") > max(r.o for r in got if r.split == "validation")
    assert splits.ordered_stratified(rows.limit(0), "t", "o").collect() == []


def test_top_misses_and_orders(scored, spark):
    _, c, _, _ = scored
    assert [(r.key, r.rank, r.pred_n, r.misses) for r in metrics.top_misses(c).orderBy("key", "rank").collect()] == [
        ("a_date", 1, "", 1),
        ("x.npi", 1, "124", 2),
        ("x.npi", 2, "", 1),
    ]
    order = metrics.tier_order(spark.createDataFrame(
        [(0, "new"), (1, "fax"), (2, "other"), (3, "pristine")],
        "row_idx long, tier string",
    )).orderBy("position").collect()
    assert [r.tier for r in order] == ["pristine", "fax", "new", "other"]


def test_pointed_codes_and_restyled_dates(spark):
    df = spark.createDataFrame([("CA", ["x", "y", "z"]), ("D", ["x"]), ("", ["x"])], "p string, d array<string>")
    assert [r.c for r in df.select(validators.pointed_codes(F.col("p"), F.col("d")).alias("c")).collect()] == [["z", "x"], [None], []]
    days = spark.range(400).select("id", F.date_format(F.date_add(F.lit("1990-01-01").cast("date"), (F.col("id") * 17).cast("int")), "MM/dd/yyyy").alias("d"))
    styled = days.select("d", forms.restyled_date(F.col("d"), F.col("id")).alias("s")).collect()
    slashed = [(r.d, r.s) for r in styled if "/" in r.s]
    assert {c for r in styled for c in r.s if not c.isdigit()} == set("/-.") and len(slashed) > 100
    got = spark.createDataFrame(slashed, "d string, s string").select("d", text.date("s").alias("n")).collect()
    assert all(r.n == r.d for r in got)
    assert spark.createDataFrame([("soon",)], "d string").select(forms.restyled_date(F.col("d"), F.lit(1)).alias("s")).first().s == "soon"


def test_first_keys_of_a_few_rows(spark):
    gt = spark.createDataFrame([(0, 0, "a"), (5, 0, "late")], "row_idx long, pos int, key string")
    assert [r.key for r in splits.canonical_keys(gt, 3).collect()] == ["a"]


# ---------------------------------------------------------------- streams
def _predictions(folder, rows, parts):
    folder.mkdir(exist_ok=True)
    for k in range(parts):
        (folder / f"{k}.json").write_text("".join(json.dumps(r) + "\n" for r in rows[k::parts]))


def test_stream_last_wins(spark, tmp_path):
    """Shuffled and repeated predictions, over several batches and a restart, give the batch result of the latest of each sample."""
    r = random.Random(3)
    split = spark.createDataFrame([(i, f"s{i}", ("fax", "worst")[i % 2]) for i in range(40)], "row_idx long, sample_id string, tier string")
    gt = spark.createDataFrame([(i, k, v) for i in range(40) for k, v in (("a_date", "01/02/2020"), ("x.npi", str(i)), ("blank", ""))], "row_idx long, key string, gt string")
    said = []
    for i in range(30):
        for turn in range(r.randint(1, 4)):
            fields = {"a_date": r.choice(["2020-1-2", "1/2/2020", "no"]), "x.npi": r.choice([str(i), "0"])}
            said.append({"sample_id": f"s{i}", "fields": r.choice([fields, None, {}]), "at": f"2024-01-0{r.randint(1, 3)}T00:00:0{turn}.{i:06d}Z"})
    said += [{"sample_id": "unknown", "fields": {"a_date": "x"}, "at": "2024-01-01T00:00:00Z"}, {"sample_id": None, "at": "2024-01-01T00:00:00Z"}, {"sample_id": "s1", "fields": {}}]
    said += said[::3]
    r.shuffle(said)
    last = {}
    for x in said:
        if x["sample_id"] and x.get("at"):
            key = (x["at"], json.dumps(x["fields"] or {}, separators=(",", ":")))
            last[x["sample_id"]] = max(last.get(x["sample_id"], key), key)
    want = Counter()
    for i in range(40):
        if f"s{i}" in last:
            fields = json.loads(last[f"s{i}"][1])
            want[("fax", "worst")[i % 2], "total"] += 2
            want[("fax", "worst")[i % 2], "hits"] += (fields.get("a_date") in ("2020-1-2", "1/2/2020")) + (fields.get("x.npi") == str(i))

    def got():
        return Counter({(x.tier, n): v for x in scoring.scores(spark, f"{tmp_path}/out").collect() for n, v in (("total", x.total), ("hits", x.norm_hits))})

    half = len(said) // 2
    for part, rows in (("a", said[:half]), ("b", said[half:])):
        folder = tmp_path / "in"
        _predictions(folder, rows, 3) if part == "a" else [(folder / f"b{k}.json").write_text("".join(json.dumps(x) + "\n" for x in rows[k::2])) for k in range(2)]
        stream = scoring.start_last_wins(scoring.read_predictions(spark, str(folder), 1), split, gt, f"{tmp_path}/out", f"{tmp_path}/cp")
        assert stream.awaitTermination(180) and stream.exception() is None
    assert got() == want
    assert scoring.scores(spark, f"{tmp_path}/none").collect() == []
    # a batch that is run again adds nothing
    assert not files.append_once(spark.sql("select 'fax' tier, 1L total, 1L norm_hits"), f"{tmp_path}/out", "0", form="parquet")
    assert got() == want


def test_stream_state_goes_behind_the_watermark(spark, tmp_path):
    """Late predictions are dropped, and a sample whose state has gone counts anew."""
    rows = ["2024-01-01T00:00:00Z", "2024-01-02T00:00:00Z", "2024-01-01T00:30:00Z", "2024-01-03T00:00:00Z", "2024-01-04T00:00:00Z"]
    (tmp_path / "in").mkdir()
    seen = []
    for i, at in enumerate(rows):
        (tmp_path / "in" / f"{i}.json").write_text(json.dumps({"sample_id": "s" if i in (0, 2) else f"t{i}", "fields": {"a": str(i)}, "at": at}) + "\n")
        stream = scoring.last_wins(scoring.read_predictions(spark, str(tmp_path / "in"), 1), "1 hour").writeStream.outputMode("update").option("checkpointLocation", f"{tmp_path}/cp")
        q = stream.foreachBatch(lambda df, _: seen.extend(tuple(r) for r in df.collect())).trigger(availableNow=True).start()
        assert q.awaitTermination(120) and q.exception() is None
    assert ("s", '{"a":"0"}', 1) in seen and not [x for x in seen if x[0] == "s" and x[1] == '{"a":"2"}'] and not [x for x in seen if x[2] < 0]
