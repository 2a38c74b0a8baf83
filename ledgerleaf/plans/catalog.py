"""Queries over the driver's tables, one for each operator, with their oracle SQL."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import forms, keys, text
from ..operators import cells as cell_ops
from ..operators import codes, flatten, geometry, metrics, report, score_run, serving, splits, synth, training_rows, validators
from ..sources import cell_store, files
from ..streaming import scoring
from . import claims
from .claims import Claims, table, with_cells

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def keep(fn):
        QUERIES[name] = fn
        if oracle:
            ORACLES[name] = oracle
        return fn

    return keep


def all_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cell_ops.compared(Claims(spark, sf_dir).both)


def missed_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same for what counts hits and names misses: texts that are equal as they are stay unnormalised."""
    return cell_ops.compared(Claims(spark, sf_dir).both, equal=False).drop("cer")


def rated_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same for what counts hits and error rates of populated cells."""
    return cell_ops.compared(Claims(spark, sf_dir).both, equal=False, populated=True)


def joined_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = Claims(spark, sf_dir)
    return cell_ops.compare_rows(c.split, c.row_cells("key", "gt", "kind", "cls", "region"), c.predicted)


# ---------------------------------------------------------------- scoring
@query("cell_compare", claims.o_cells("SELECT row_idx, sample_id, tier, key, gt_n, pred_n, exact, norm, region, coalesce(cls, '') AS cls, round(coalesce(cer, -1.0), 6) AS cer FROM cells"))
def cell_compare(spark, sf_dir):
    x = joined_cells(spark, sf_dir)
    return x.select(
        "row_idx",
        "sample_id",
        "tier",
        "key",
        "gt_n",
        "pred_n",
        "exact",
        "norm",
        "region",
        F.coalesce("cls", F.lit("")).alias("cls"),
        F.round(F.coalesce("cer", F.lit(-1.0)), 6).alias("cer"),
    )


_FIELDS = "CAST(count(*) AS BIGINT) AS total, CAST(count_if(exact) AS BIGINT) AS exact_hits, CAST(count_if(norm) AS BIGINT) AS norm_hits, CAST(count_if(exact) AS DOUBLE) / count(*) AS exact_acc, CAST(count_if(norm) AS DOUBLE) / count(*) AS norm_acc"


@query("tier_field_stats", claims.o_cells(f"SELECT tier, key, {_FIELDS} FROM cells GROUP BY GROUPING SETS ((tier, key), (key))"))
def tier_field_stats(spark, sf_dir):
    return metrics.field_stats(all_cells(spark, sf_dir))


@query("field_stats", claims.o_cells(f"SELECT key, {_FIELDS} FROM cells GROUP BY key"))
def field_stats(spark, sf_dir):
    return metrics.field_stats(all_cells(spark, sf_dir)).where("tier is null").drop("tier")


_DOCS = """
docs AS (SELECT s.row_idx, s.tier, count(c.key) AS n, count(CASE WHEN c.norm THEN 1 END) AS hits FROM split s LEFT JOIN cells c ON s.row_idx = c.row_idx GROUP BY ALL),
acc AS (SELECT *, n = hits AS all_right, CASE WHEN n > 0 THEN CAST(hits AS DOUBLE) / n ELSE 1.0 END AS a FROM docs)"""


@query("doc_stats", claims.o_cells(f", {_DOCS} SELECT tier, count(*) AS docs, CAST(count_if(all_right) AS BIGINT) AS docs_all_correct, round(avg(a), 6) AS mean_field_acc FROM acc GROUP BY ROLLUP (tier)"))
def doc_stats(spark, sf_dir):
    return metrics.doc_stats(Claims(spark, sf_dir).split, all_cells(spark, sf_dir)).withColumn("mean_field_acc", F.round("mean_field_acc", 6))


@query("tier_macro_acc", claims.o_cells("SELECT tier, round(avg(a), 6) AS norm_field_acc FROM (SELECT tier, key, CAST(count_if(norm) AS DOUBLE) / count(*) AS a FROM cells GROUP BY tier, key) AS x GROUP BY tier"))
def tier_macro_acc(spark, sf_dir):
    return metrics.tier_macro(missed_cells(spark, sf_dir)).withColumn("norm_field_acc", F.round("norm_field_acc", 6))


_WORST = "SELECT key, count(*) AS total, CAST(count_if(norm) AS BIGINT) AS norm_hits, CAST(count_if(norm) AS DOUBLE) / count(*) AS norm_acc FROM cells GROUP BY key ORDER BY norm_acc, total DESC, key"


@query("worst_fields", claims.o_cells(f"{_WORST} LIMIT 15"))
def worst_fields(spark, sf_dir):
    return metrics.worst_fields(all_cells(spark, sf_dir))


@query(
    "top_miss_pairs",
    claims.o_cells(f""", w AS ({_WORST} LIMIT 5),
m AS (SELECT c.key, gt_n, pred_n, count(*) AS misses, min(row_idx) AS f FROM cells c JOIN w ON c.key = w.key WHERE NOT norm GROUP BY c.key, gt_n, pred_n)
SELECT key, CAST(rank AS INTEGER) AS rank, gt_n, pred_n, misses FROM (SELECT *, row_number() OVER (PARTITION BY key ORDER BY misses DESC, f, gt_n, pred_n) AS rank FROM m) AS x WHERE rank <= 5"""),
)
def top_miss_pairs(spark, sf_dir):
    return metrics.top_misses(missed_cells(spark, sf_dir))


@query("miss_pairs", claims.o_cells("SELECT tier, key, gt_n, pred_n, count(*) AS misses, min(row_idx) AS first_row FROM cells WHERE NOT norm GROUP BY ALL"))
def miss_pairs(spark, sf_dir):
    return metrics.miss_pairs(all_cells(spark, sf_dir))


_ACC = "count(*) AS total, avg(CAST(exact AS INT)) AS exact_acc, avg(CAST(norm AS INT)) AS norm_acc"


@query("populated_blank_acc", claims.o_cells(f"SELECT gt_n <> '' AS populated, {_ACC} FROM cells GROUP BY 1"))
def populated_blank_acc(spark, sf_dir):
    return metrics.populated_blank(all_cells(spark, sf_dir))


@query("tier_populated_acc", claims.o_cells(f"SELECT tier, {_ACC} FROM cells WHERE gt_n <> '' GROUP BY tier"))
def tier_populated_acc(spark, sf_dir):
    return metrics.tier_populated(all_cells(spark, sf_dir))


_CLASSES = ", ".join(f"('{c}')" for c in keys.CLASSES)


@query(
    "class_acc",
    claims.o_cells(f""", d AS (SELECT * FROM (VALUES {_CLASSES}) AS v(cls)),
p AS (SELECT cls, count(*) AS total, count_if(gt_n <> '') AS pop, count_if(gt_n <> '' AND exact) AS e, count_if(gt_n <> '' AND norm) AS n FROM cells WHERE cls IS NOT NULL GROUP BY cls)
SELECT d.cls, CAST(coalesce(total, 0) AS BIGINT) AS total, CAST(coalesce(pop, 0) AS BIGINT) AS populated, CASE WHEN pop > 0 THEN CAST(e AS DOUBLE) / pop ELSE 0.0 END AS exact_acc, CASE WHEN pop > 0 THEN CAST(n AS DOUBLE) / pop ELSE 0.0 END AS norm_acc
FROM d LEFT JOIN p ON d.cls = p.cls"""),
)
def class_acc(spark, sf_dir):
    return metrics.by_class(all_cells(spark, sf_dir))


@query(
    "cer_by_class",
    claims.o_cells(""", d AS (SELECT * FROM (VALUES ('codes'), ('money'), ('npis')) AS v(cls)),
p AS (SELECT d.cls, count(c.cer) AS n, sum(c.cer) AS s FROM d LEFT JOIN cells c ON d.cls = c.cls GROUP BY d.cls)
SELECT cls, n, round(CASE WHEN n > 0 THEN s / n ELSE 0.0 END, 6) AS mean_cer FROM p
UNION ALL SELECT 'overall', CAST(sum(n) AS BIGINT), round(CASE WHEN sum(n) > 0 THEN sum(s) / sum(n) ELSE 0.0 END, 6) FROM p"""),
)
def cer_by_class(spark, sf_dir):
    return metrics.error_rates(all_cells(spark, sf_dir)).withColumn("mean_cer", F.round("mean_cer", 6))


def _outputs(split: DataFrame) -> DataFrame:
    """(sample_id, parse_ok) of the samples that have a prediction; every seventh does not parse."""
    return split.where("row_idx % 23 <> 0").select("sample_id", (F.col("row_idx") % 7 != 0).alias("parse_ok"))


@query(
    "json_validity",
    with_cells(""",
w AS (SELECT g.row_idx, count(*) AS want, count(CASE WHEN g.row_idx % 7 <> 0 AND p.key IS NOT NULL THEN 1 END) AS got, bool_or(g.row_idx % 7 <> 0 AND q.row_idx IS NOT NULL) AS ok
  FROM gt g LEFT JOIN pred p ON g.row_idx = p.row_idx AND g.key = p.key LEFT JOIN (SELECT DISTINCT row_idx FROM pred) q ON g.row_idx = q.row_idx GROUP BY g.row_idx)
SELECT count(*) AS samples, avg(CAST(ok AS INT)) AS parse_rate, avg(CAST(got = want AS INT)) AS has_expected_keys_rate, avg(CAST(ok AND got = want AS INT)) AS valid_rate, round(avg(CAST(got AS DOUBLE) / want), 6) AS mean_key_coverage FROM w"""),
)
def json_validity(spark, sf_dir):
    c = Claims(spark, sf_dir)
    return metrics.cell_validity(c.split, c.sides, _outputs(c.split)).withColumn("mean_key_coverage", F.round("mean_key_coverage", 6))


@query("missing_predictions", with_cells("SELECT row_idx, sample_id, tier FROM split WHERE row_idx NOT IN (SELECT row_idx FROM pred)"))
def missing_predictions(spark, sf_dir):
    c = Claims(spark, sf_dir)
    return cell_ops.missing(c.split, c.pred.select(F.col("row_idx").cast("string").alias("sample_id")))


@query("tier_order", with_cells("SELECT tier, CAST(CASE tier WHEN 'pristine' THEN 0 WHEN 'clean_scan' THEN 1 WHEN 'worn_scan' THEN 2 WHEN 'fax' THEN 3 WHEN 'phone_photo' THEN 4 ELSE 5 END AS BIGINT) AS position FROM split GROUP BY tier"))
def tier_order(spark, sf_dir):
    return metrics.tier_order(Claims(spark, sf_dir).split)


_ROUND = "round(coalesce({}, 0.0), 4)"
_VALID = """
vw AS (SELECT g.row_idx, count(*) AS want, count(CASE WHEN g.row_idx % 7 <> 0 AND p.key IS NOT NULL THEN 1 END) AS got, bool_or(g.row_idx % 7 <> 0 AND q.row_idx IS NOT NULL) AS ok
  FROM gt g LEFT JOIN pred p ON g.row_idx = p.row_idx AND g.key = p.key LEFT JOIN (SELECT DISTINCT row_idx FROM pred) q ON g.row_idx = q.row_idx GROUP BY g.row_idx)"""


def _summary_sql(model: str) -> str:
    acc = "avg(CASE WHEN {} THEN CAST({} AS INT) END)"
    cols = [f"'{model}' AS model", "(SELECT count(*) FROM split) AS n_samples"]
    cols += [_ROUND.format(acc.format(f"gt_n {op} ''", "norm")) + f" AS {n}" for op, n in (("<>", "populated_norm_acc"), ("=", "blank_norm_acc"))]
    cols += [f"round({acc.format(f"gt_n <> '' AND tier = '{t}'", 'norm')}, 4) AS tier_{t}_norm_acc" for t in keys.TIERS]
    cols += [_ROUND.format(acc.format(f"gt_n <> '' AND cls = '{c}'", "exact")) + f" AS class_{c}_exact" for c in keys.CLASSES]
    cols += [_ROUND.format(f"avg(CASE WHEN cls = '{c}' THEN cer END)") + f" AS cer_{c}" for c in keys.CER_CLASSES] + [_ROUND.format("avg(cer)") + " AS cer_overall"]
    cols += [
        "(SELECT round(avg(CAST(ok AND got = want AS INT)), 4) FROM vw) AS json_valid_rate",
        "(SELECT round(avg(CAST(ok AS INT)), 4) FROM vw) AS json_parse_rate",
    ]
    return claims.o_cells(f",{_VALID} SELECT {', '.join(cols)} FROM cells")


def _summary(spark, sf_dir, model: str) -> DataFrame:
    c = Claims(spark, sf_dir)
    return metrics.summary_row(rated_cells(spark, sf_dir), c.split, metrics.cell_validity(c.split, c.sides, _outputs(c.split)), model)


@query("summary_row", _summary_sql("base"))
def summary_row(spark, sf_dir):
    return _summary(spark, sf_dir, "base")


_RUN = "model, CAST(n_samples AS VARCHAR) AS n_samples, CAST(populated_norm_acc AS DOUBLE) AS populated_norm_acc, CAST(cer_overall AS DOUBLE) AS cer_overall"


@query("append_runs", f"SELECT {_RUN} FROM ({_summary_sql('base')}) UNION ALL SELECT {_RUN} FROM ({_summary_sql('again')})")
def append_runs(spark, sf_dir):
    """Two runs' summary rows appended to one CSV by the library's writer, and read back."""
    path = _scratch(spark, "summaries")
    row = _summary(spark, sf_dir, "base").toPandas()  # one row, written twice under two names
    for model in ("base", "again"):
        files.write_summary(spark.createDataFrame(row.assign(model=model)), path)
    rows = files.read_summaries(spark, path)
    return rows.select(
        "model",
        "n_samples",
        F.col("populated_norm_acc").cast("double").alias("populated_norm_acc"),
        F.col("cer_overall").cast("double").alias("cer_overall"),
    )


def _scratch(spark: SparkSession, tag: str) -> str:
    """A new folder where executors can write: below the shared folder of the session, or of this machine if the master is local."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        base = tempfile.mkdtemp(prefix="ledgerleaf-")
        atexit.register(shutil.rmtree, base, ignore_errors=True)
    return f"{base.rstrip('/')}/{tag}-{uuid.uuid4().hex}"


@query("report_tiers", claims.o_cells(f""", {_DOCS},
p AS (SELECT DISTINCT row_idx FROM pred),
t AS (SELECT tier, avg(a) AS m FROM (SELECT tier, key, CAST(count_if(norm) AS DOUBLE) / count(*) AS a FROM cells GROUP BY tier, key) AS x GROUP BY tier),
g AS (SELECT tier, count(*) AS docs, round(avg(CAST(all_right AS INT)), 6) AS all_correct, round(avg(a), 6) AS mean_field_acc FROM acc WHERE row_idx IN (SELECT row_idx FROM p) GROUP BY ROLLUP (tier))
SELECT g.tier, docs, all_correct, mean_field_acc, round(t.m, 6) AS norm_field_acc FROM g LEFT JOIN t ON g.tier = t.tier"""))
def report_tiers(spark, sf_dir):
    c = Claims(spark, sf_dir)
    said = c.split.where("row_idx % 23 <> 0").select("sample_id")
    rows = report.tier_table(c.split, all_cells(spark, sf_dir), said)
    return rows.select("tier", "docs", *(F.round(x, 6).alias(x) for x in ("all_correct", "mean_field_acc", "norm_field_acc")))


@query("report_fields", claims.o_cells("""
, m AS (SELECT tier, key, gt_n, pred_n, count(*) AS n, min(row_idx) AS f FROM (SELECT tier, key, gt_n, pred_n, row_idx, norm FROM cells UNION ALL SELECT NULL, key, gt_n, pred_n, row_idx, norm FROM cells) AS x WHERE NOT norm GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY tier, key ORDER BY n DESC, f, gt_n, pred_n) AS k FROM m),
l AS (SELECT tier, key, string_agg(concat(gt_n, '>', pred_n, '=', CAST(n AS VARCHAR)), '|' ORDER BY k) AS misses FROM r WHERE k <= 10 GROUP BY tier, key),
s AS (SELECT tier, key, count(*) AS total, CAST(count_if(exact) AS BIGINT) AS exact_hits, CAST(count_if(norm) AS BIGINT) AS norm_hits FROM cells GROUP BY GROUPING SETS ((tier, key), (key)))
SELECT s.tier, s.key, total, exact_hits, norm_hits, coalesce(misses, '') AS misses FROM s LEFT JOIN l ON s.key = l.key AND s.tier IS NOT DISTINCT FROM l.tier"""))
def report_fields(spark, sf_dir):
    rows = report.field_report(missed_cells(spark, sf_dir))
    return rows.select(
        "tier",
        "key",
        "total",
        "exact_hits",
        "norm_hits",
        F.array_join(
            F.transform("top_misses", lambda m: F.concat(m["gt"], F.lit(">"), m["pred"], F.lit("="), m["count"].cast("string"))),
            "|",
        ).alias("misses"),
    )


@query("model_fields", claims.o_cells("SELECT region, count(*) AS n, count(DISTINCT key) AS n_keys FROM cells WHERE region IN ('top', 'bottom') GROUP BY region"))
def model_fields(spark, sf_dir):
    return all_cells(spark, sf_dir).where(keys.in_model("key", "fields")).groupBy("region").agg(
        F.count("*").alias("n"),
        F.count_distinct("key").alias("n_keys"),
    )


# ---------------------------------------------------------------- runs from end to end
_LONG = "CAST({} AS VARCHAR) AS tier, CAST({} AS VARCHAR) AS name, '{}' AS metric, round(CAST({} AS DOUBLE), 6) AS value"


def _long_sql(part: str, tier: str, name: str, values: dict[str, str], source: str) -> str:
    return " UNION ALL ".join(f"SELECT '{part}' AS part, {_LONG.format(tier, name, m, v)} FROM {source}" for m, v in values.items())


def _long(part: str, df: DataFrame, tier: str | None, name: str | None, *values: str) -> DataFrame:
    """A table of a run as rows (part, tier, name, metric, value)."""
    metric = F.inline(F.array(*(F.struct(F.lit(v).alias("metric"), F.round(F.col(v).cast("double"), 6).alias("value")) for v in values)))
    of = lambda c: (F.col(c) if c else F.lit(None)).cast("string")
    return df.select(F.lit(part).alias("part"), of(tier).alias("tier"), of(name).alias("name"), metric)


_HITS = "count(*) AS total, count_if(exact) AS exact_hits, count_if(norm) AS norm_hits"
_RUN_SQL = [
    _long_sql("fields", "tier", "key", {"total": "total", "exact_hits": "exact_hits", "norm_hits": "norm_hits"}, f"(SELECT tier, key, {_HITS} FROM cells GROUP BY GROUPING SETS ((tier, key), (key)))"),
    _long_sql("tiers", "tier", "NULL", {"docs": "docs", "all_correct": "r", "mean_field_acc": "m"}, "(SELECT tier, count(*) AS docs, avg(CAST(all_right AS INT)) AS r, avg(a) AS m FROM acc WHERE row_idx % 23 <> 0 GROUP BY ROLLUP (tier))"),
    _long_sql("worst", "NULL", "key", {"norm_acc": "norm_acc"}, f"({_WORST} LIMIT 15)"),
    _long_sql("tier_populated", "tier", "NULL", {"total": "total", "norm_acc": "norm_acc"}, f"(SELECT tier, {_ACC} FROM cells WHERE gt_n <> '' GROUP BY tier)"),
    _long_sql("populated", "NULL", "populated", {"total": "total", "exact_acc": "exact_acc"}, f"(SELECT gt_n <> '' AS populated, {_ACC} FROM cells GROUP BY 1)"),
    _long_sql("error_rates", "NULL", "cls", {"n": "n", "mean_cer": "m"}, "(SELECT cls, count(cer) AS n, avg(cer) AS m FROM cells WHERE cls IN ('codes', 'money', 'npis') GROUP BY cls)"),
    _long_sql("validity", "NULL", "NULL", {"samples": "count(*)", "parse_rate": "avg(CAST(ok AS INT))", "valid_rate": "avg(CAST(ok AND got = want AS INT))", "mean_key_coverage": "avg(CAST(got AS DOUBLE) / want)"}, "vw"),
    _long_sql("missing", "tier", "sample_id", {"row_idx": "row_idx"}, "split WHERE row_idx % 23 = 0"),
]


@query("score_run", claims.o_cells(f", {_DOCS}, {_VALID} {' UNION ALL '.join(_RUN_SQL)}"))
def scored_run(spark, sf_dir):
    """A run written once and read for every table: the tables of a run as one."""
    c = Claims(spark, sf_dir)
    run = score_run.start(c.split, c.both, _outputs(c.split), _scratch(spark, "run"), "base")
    t = run.tables()
    parts = [
        _long("fields", t["fields"], "tier", "key", "total", "exact_hits", "norm_hits"),
        _long("tiers", t["tiers"], "tier", None, "docs", "all_correct", "mean_field_acc"),
        _long("worst", t["worst"], None, "key", "norm_acc"),
        _long("tier_populated", t["tier_populated"], "tier", None, "total", "norm_acc"),
        _long("populated", t["populated"], None, "populated", "total", "exact_acc"),
        _long("error_rates", t["error_rates"].where("cls <> 'overall' and n > 0"), None, "cls", "n", "mean_cer"),
        _long("validity", t["validity"], None, None, "samples", "parse_rate", "valid_rate", "mean_key_coverage"),
        _long("missing", t["missing"], "tier", "sample_id", "row_idx"),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@query("cell_join_bucketed", claims.o_cells("SELECT row_idx, sample_id, tier, key, gt_n, pred_n, exact, norm FROM cells"))
def cell_join_bucketed(spark, sf_dir):
    """Truth and predictions written in buckets of their claims, and joined bucket by bucket."""
    c = Claims(spark, sf_dir)
    path = _scratch(spark, "store")
    store = cell_store.CellStore(spark, path, path.rsplit("/", 1)[-1].replace("-", "_"), int(spark.conf.get("spark.sql.shuffle.partitions")))
    store.put_truth(c.split, c.row_cells("key", "gt", "kind", "cls", "region"))
    store.put_predictions("base", c.split, c.predicted)
    return store.cells("base").select("row_idx", "sample_id", "tier", "key", "gt_n", "pred_n", "exact", "norm")


@query("stream_last_wins", claims.o_cells("SELECT tier, count(*) AS total, CAST(count_if(norm) AS BIGINT) AS norm_hits FROM cells WHERE gt_n <> '' AND row_idx % 23 <> 0 GROUP BY tier"))
def stream_last_wins(spark, sf_dir):
    """Every sample's prediction comes twice, first empty and then whole, some again and out of order; the stream's sums hold the whole ones."""
    c = Claims(spark, sf_dir)
    path = _scratch(spark, "stream")
    at = F.timestamp_seconds(F.col("sample_id").cast("long"))
    whole = c.predictions.select("sample_id", "fields", at.alias("at"), F.lit(1).alias("turn"))
    early = F.create_map(F.lit("box_2_patient_name.last"), F.lit("?")).cast("map<string,string>").alias("fields")
    first = c.split.where("row_idx % 23 <> 0").select("sample_id", early, (at - F.expr("INTERVAL 1 SECOND")).alias("at"), F.lit(0).alias("turn"))
    said = whole.unionByName(first).unionByName(first.where("sample_id % 3 = 0"))
    parts = max(4, int(spark.conf.get("spark.sql.shuffle.partitions")))  # files, half of them a batch: as many tasks as a batch has files
    files_of = said.repartition(parts, F.xxhash64("sample_id", "turn"))
    files_of.select("sample_id", "fields", "at").write.json(f"{path}/in")
    stream = scoring.start_last_wins(scoring.read_predictions(spark, f"{path}/in", parts // 2), c.split, c.cells("key", "gt", "kind"), f"{path}/out", f"{path}/checkpoint")
    stream.awaitTermination()
    return scoring.scores(spark, f"{path}/out")


# ---------------------------------------------------------------- normalisers
_RAW = "SELECT o_orderkey AS k, CASE o_orderkey % 5 WHEN 0 THEN {a} WHEN 1 THEN {b} WHEN 2 THEN {c} WHEN 3 THEN {d} ELSE {e} END AS v FROM orders"
_VALUES = {
    "generic": ("concat('  ', o_orderpriority, '  x ')", "'n/a'", "lower(o_orderpriority)", "'None'", "o_orderstatus"),
    "date": (
        claims._date("o_orderdate"),
        f"concat({claims._text('month(o_orderdate)')}, '/', {claims._text('day(o_orderdate)')}, '/', lpad({claims._text('o_orderkey % 100')}, 2, '0'))",
        f"concat({claims._text('year(o_orderdate)')}, '-', {claims._text('month(o_orderdate)')}, '-7')",
        "'13/45/2020'",
        "'May 5'",
    ),
    "phone": ("concat('(', lpad(CAST(o_custkey % 1000 AS VARCHAR(9)), 3, '0'), ') 555-0100')", "'na'", "'1-800 call'", "'555.0100'", "''"),
    "money": (
        claims._money("o_totalprice"),
        f"concat('$ ', {claims._money('o_totalprice')})",
        f"concat({claims._text('o_custkey')}, ',000')",
        f"CASE o_orderkey % 7 WHEN 0 THEN '12d' WHEN 1 THEN '2.675' WHEN 2 THEN '1e30' WHEN 3 THEN 'inf' WHEN 4 THEN '-0.001' ELSE concat({claims._text('o_custkey % 1000')}, '.', lpad({claims._text('o_orderkey % 100000')}, 5, '0')) END",
        f"concat({claims._text('o_custkey')}, '.5')",
    ),
    "id": ("concat('w-', CAST(o_custkey AS VARCHAR(20)))", "'N/A.'", "' 12 34 '", "'null'", "o_orderpriority"),
    "sex": ("'male'", "'F'", "' female '", "''", "'none'"),
    "state": ("'california'", "'ny'", "' t'", "'NA'", "'Navarre'"),
}
_FUNCTIONS = {
    "generic": text.generic,
    "date": text.date,
    "phone": text.phone,
    "money": text.money,
    "id": text.identifier,
    "sex": text.sex,
    "state": text.state,
}


def _normaliser(name: str) -> None:
    raw = _RAW.format(**dict(zip("abcde", _VALUES[name])))
    made = getattr(claims, f"o_{name}")

    @query(f"normalize_{name}", f"SELECT k, v, {made('v')} AS n FROM ({raw}) AS x")
    def run(spark, sf_dir):
        return claims.run_sql(spark, sf_dir, raw).select("k", "v", _FUNCTIONS[name](F.col("v")).alias("n"))


for _name in _VALUES:
    _normaliser(_name)


@query("classify_keys", with_cells(f"SELECT DISTINCT key, {claims.o_kind('key')} AS kind, coalesce({claims.o_class('key')}, '') AS cls, {claims.o_region('key')} AS region FROM (SELECT key FROM gt UNION ALL SELECT key FROM pred) AS x"))
def classify_keys(spark, sf_dir):
    c = Claims(spark, sf_dir)
    k = c.cells("key", extra=True).select("key").distinct()
    return k.select(
        "key",
        text.kind_of("key").alias("kind"),
        F.coalesce(keys.class_of("key"), F.lit("")).alias("cls"),
        keys.region_of("key").alias("region"),
    )


# ---------------------------------------------------------------- nested and flat
def nested_claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = Claims(spark, sf_dir)
    lines = c.line.groupBy("k").agg(F.array_sort(F.collect_list(F.struct(
        "i",
        F.lpad((F.col("l_partkey") % 100000).cast("string"), 5, "0").alias("procedure_code"),
        F.col("l_quantity").cast("long").cast("string").alias("units"),
    ))).alias("x"))
    lines = lines.select(
        "k",
        F.transform("x", lambda s: F.struct(s["procedure_code"].alias("procedure_code"), s["units"].alias("units"))).alias("lines"),
    )
    other = F.when(F.col("k") % 3 == 0, F.struct(F.col("c_name").alias("name"), F.lit("").alias("plan_name")))
    doc = F.struct(
        F.col("c_name").alias("name"),
        F.struct((F.col("k") % 2 == 0).alias("yes"), F.lit(None).cast("string").alias("charges")).alias("lab"),
        other.alias("other"),
        F.when(F.col("k") % 5 != 0, F.array(F.lit("A1"), F.when(F.col("k") % 7 != 0, F.lit("B2")))).alias("codes"),
        F.col("lines").alias("lines"),
    )
    return c.claim.join(lines, "k", "left").select(F.col("k").alias("row_idx"), doc.alias("doc"))


@query(
    "flatten_claims",
    with_cells("""
SELECT k AS row_idx, 'name' AS key, c_name AS value FROM claim
UNION ALL SELECT k, 'lab.yes', CASE WHEN k % 2 = 0 THEN 'YES' ELSE 'NO' END FROM claim
UNION ALL SELECT k, 'lab.charges', '' FROM claim
UNION ALL SELECT k, 'other', '' FROM claim WHERE k % 3 <> 0
UNION ALL SELECT k, 'other.name', c_name FROM claim WHERE k % 3 = 0
UNION ALL SELECT k, 'other.plan_name', '' FROM claim WHERE k % 3 = 0
UNION ALL SELECT k, 'codes', CASE WHEN k % 5 = 0 THEN '' WHEN k % 7 = 0 THEN 'A1 | ' ELSE 'A1 | B2' END FROM claim
UNION ALL SELECT k, 'lines', '' FROM claim WHERE k NOT IN (SELECT k FROM line)
UNION ALL SELECT k, concat('lines[', i, '].procedure_code'), lpad(CAST(l_partkey % 100000 AS VARCHAR), 5, '0') FROM line WHERE k IN (SELECT k FROM claim)
UNION ALL SELECT k, concat('lines[', i, '].units'), CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) FROM line WHERE k IN (SELECT k FROM claim)"""),
)
def flatten_claims(spark, sf_dir):
    df = nested_claims(spark, sf_dir)
    return flatten.explode_cells(df, flatten.flat_cells(F.col("doc"), df.schema["doc"].dataType), "row_idx").select("row_idx", "key", "value")


@query("flatten_props", "SELECT event_id, 'k' AS key, json_extract_string(props, '$.k') AS value FROM events")
def flatten_props(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    return flatten.explode_cells(e.withColumn("c", flatten.flat_json("props")), F.col("c"), "event_id").select("event_id", "key", "value")


@query(
    "unflatten_lines",
    with_cells("""
SELECT k AS row_idx, string_agg(concat(lpad(CAST(l_partkey % 100000 AS VARCHAR), 5, '0'), '=', CAST(CAST(l_quantity AS BIGINT) AS VARCHAR)), ',' ORDER BY i) AS lines FROM line WHERE k IN (SELECT k FROM claim) GROUP BY k"""),
)
def unflatten_lines(spark, sf_dir):
    got = flatten.unflat_lines(Claims(spark, sf_dir).gt.withColumnRenamed("gt", "value"), "row_idx", keys.SERVICE_BOX, ["procedure_code", "units"])
    return got.select(
        "row_idx",
        F.array_join(F.transform("lines", lambda x: F.concat(x["procedure_code"], F.lit("="), x["units"])), ",").alias("lines"),
    )


@query("props_round_trip", "SELECT event_id, 0 AS pos, 'k' AS key, json_extract_string(props, '$.k') AS value, concat('{\"k\":\"', json_extract_string(props, '$.k'), '\"}') AS doc FROM events")
def props_round_trip(spark, sf_dir):
    """Properties of any shape to rows by Arrow batch, and back to documents."""
    rows = flatten.flat_rows(table(spark, sf_dir, "events").select("event_id", "props"), "props", "event_id")
    return rows.join(flatten.nested_json(rows, "event_id"), "event_id")


@query("nested_round_trip", """
WITH l AS (
  SELECT l_orderkey, string_agg(concat('{"part":"', l_partkey, '","ship":{"flag":"', l_returnflag, '","line":"', l_linenumber, '"}}'), ',' ORDER BY l_linenumber, l_partkey, l_returnflag) AS x, count(*) AS n
  FROM lineitem GROUP BY l_orderkey)
SELECT o_orderkey, concat('{"order":{"id":"', o_orderkey, '","status":"', o_orderstatus, '"},"lines":', CASE WHEN x IS NULL THEN '""' ELSE concat('[', x, ']') END, ',"n":"', coalesce(n, 0), '"}') AS doc,
  2 + CASE WHEN n IS NULL THEN 1 ELSE 3 * n END + 1 AS cells
FROM orders LEFT JOIN l ON o_orderkey = l_orderkey""")
def nested_round_trip(spark, sf_dir):
    """Orders with their lines as documents of unknown shape: flat cells, and the same documents built from them."""
    item = F.struct(F.col("l_linenumber").alias("a"), F.col("l_partkey").alias("b"), F.col("l_returnflag").alias("c"))
    lines = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_list(item)).alias("x"))  # an order has few lines
    shaped = F.transform("x", lambda i: F.struct(i["b"].alias("part"), F.struct(i["c"].alias("flag"), i["a"].alias("line")).alias("ship")))
    o = table(spark, sf_dir, "orders").join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    doc = F.struct(
        F.struct(F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("status")).alias("order"),
        F.coalesce(shaped, F.slice(shaped, 1, 0), F.array().cast("array<struct<part:bigint,ship:struct<flag:string,line:int>>>")).alias("lines"),
        F.coalesce(F.size("x"), F.lit(0)).alias("n"),
    )
    n = F.when(F.col("x").isNull(), 0).otherwise(F.size("x"))
    rows = flatten.flat_rows(o.select("o_orderkey", F.to_json(doc.withField("n", n)).alias("doc")), "doc", "o_orderkey")
    return flatten.nested_json(rows, "o_orderkey", leaves="cells")


@query("canonical_keys", with_cells("SELECT CAST(row_number() OVER (ORDER BY r, p) - 1 AS INTEGER) AS position, key FROM (SELECT key, min(row_idx) AS r, arg_min(pos, row_idx) AS p FROM gt GROUP BY key) AS x"))
def canonical_keys(spark, sf_dir):
    return splits.canonical_keys(Claims(spark, sf_dir).cells("pos", "key"))


@query("latest_prediction", "SELECT user_id, max_by(event_type, event_id) AS event_type, max(event_id) AS event_id FROM events GROUP BY user_id")
def latest_prediction(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("user_id", "event_id", "event_type")
    return cell_ops.last_predictions(e, F.col("event_id"), "user_id").select("user_id", "event_type", "event_id")


# ---------------------------------------------------------------- splits and samples
_SHARE = "CASE WHEN n >= {least} THEN greatest(1, CAST(round_even(n * 0.1, 0) AS INTEGER)) ELSE 0 END"


def _split_sql(inner: str, least: int, names: tuple[str, str, str]) -> str:
    s = _SHARE.format(least=least)
    return f"SELECT id, stratum, CASE WHEN r <= n - 2 * ({s}) OR n - 2 * ({s}) < 0 THEN '{names[0]}' WHEN r <= n - ({s}) THEN '{names[1]}' ELSE '{names[2]}' END AS split FROM ({inner}) AS x"


@query("stratified_split_hash", _split_sql("SELECT doc_id AS id, lang AS stratum, row_number() OVER (PARTITION BY lang ORDER BY md5(concat(doc_id, '|42')), doc_id) AS r, count(*) OVER (PARTITION BY lang) AS n FROM documents", 3, ("train", "val", "test")))
def stratified_split_hash(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), F.col("lang").alias("stratum"))
    return splits.hash_stratified(d, "stratum", "id")


@query("stratified_split_ordered", _split_sql("SELECT o_orderkey AS id, o_orderpriority AS stratum, row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_orderkey) AS r, count(*) OVER (PARTITION BY o_orderpriority) AS n FROM orders", 0, ("train", "validation", "test")))
def stratified_split_ordered(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_orderpriority").alias("stratum"))
    return splits.ordered_stratified(o, "stratum", "id")


@query("tier_histogram", "SELECT split, tier, count(*) AS n FROM (" + _split_sql("SELECT o_orderkey AS id, o_orderpriority AS stratum, row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_orderkey) AS r, count(*) OVER (PARTITION BY o_orderpriority) AS n FROM orders", 0, ("train", "validation", "test")).replace("stratum,", "stratum AS tier,", 1) + ") AS y GROUP BY split, tier")
def tier_histogram(spark, sf_dir):
    return splits.tier_histogram(stratified_split_ordered(spark, sf_dir).withColumnRenamed("stratum", "tier"))


@query("first_n_per_tier", with_cells("SELECT row_idx, tier FROM (SELECT *, row_number() OVER (PARTITION BY tier ORDER BY row_idx) AS r FROM split) AS x WHERE r <= 4"))
def first_n_per_tier(spark, sf_dir):
    return splits.first_per_group(Claims(spark, sf_dir).split, "tier", "row_idx", 4).select("row_idx", "tier")


@query("round_robin_tier", f"SELECT o_orderkey, {claims.TIER.format(k='o_orderkey')} AS tier FROM orders")
def round_robin_tier(spark, sf_dir):
    return splits.round_robin(table(spark, sf_dir, "orders").select("o_orderkey"), "o_orderkey", list(keys.TIERS))


# ---------------------------------------------------------------- rows for training
@query("chat_rows", "SELECT concat(CAST(c.conv_id AS VARCHAR), '-', CAST(turn AS VARCHAR)) AS sample_id, 3 AS n_messages, concat('{\"', role, '\": ', to_json(text), '}') AS target_json FROM conversations c")
def chat_rows(spark, sf_dir):
    """A row for every turn of every conversation."""
    c = table(spark, sf_dir, "conversations")
    cells = F.array(F.struct(F.col("role").alias("key"), F.col("text").alias("value")))
    rows = c.select(
        F.concat_ws("-", F.col("conv_id").cast("string"), F.col("turn").cast("string")).alias("sample_id"),
        F.lit("pristine").alias("tier"),
        F.lit("train").alias("split"),
        F.lit("x.png").alias("image_path"),
        training_rows.target_json(cells).alias("target_json"),
    )
    return training_rows.chat_rows(rows).select("sample_id", F.size("messages").alias("n_messages"), "target_json")


_PROMPT = training_rows.instruction(["name", "total"])


@query("vlm_rows", f"SELECT concat(CAST(o_orderkey AS VARCHAR), '.png') AS image, '{_PROMPT.replace(chr(39), chr(39) * 2)}' AS prompt, concat('{{\"name\": \"', o_orderstatus, '\", \"total\": \"', {claims._money('o_totalprice')}, '\"}}') AS target, CAST(o_orderkey AS VARCHAR) AS sample_id, CASE WHEN o_orderkey % 10 = 0 THEN 'validation' ELSE 'train' END AS split FROM orders")
def vlm_rows(spark, sf_dir):
    o = claims.run_sql(spark, sf_dir, f"SELECT *, {claims._money('o_totalprice')} AS total FROM orders")
    cells = F.array(
        F.struct(F.lit("name").alias("key"), F.col("o_orderstatus").alias("value")),
        F.struct(F.lit("total").alias("key"), F.col("total").alias("value")),
    )
    rows = o.select(
        F.concat(F.col("o_orderkey").cast("string"), F.lit(".png")).alias("image_path"),
        F.col("o_orderkey").cast("string").alias("sample_id"),
        F.lit("").alias("tier"),
        F.when(F.col("o_orderkey") % 10 == 0, "val").otherwise("train").alias("split"),
        training_rows.target_json(cells).alias("target_json"),
    )
    return training_rows.vlm_rows(rows, _PROMPT).drop("tier")


# ---------------------------------------------------------------- numbers and rules
_BASE = "concat('1', lpad(CAST(c_custkey % 100000000 AS VARCHAR), 8, '0'))"
_SUM = "list_sum(list_transform(range(1, 15), lambda i: CASE WHEN (14 - i) % 2 = 0 THEN CAST(substr('0246813579', CAST(substr(concat('80840', b), CAST(i AS INTEGER), 1) AS INTEGER) + 1, 1) AS INTEGER) ELSE CAST(substr(concat('80840', b), CAST(i AS INTEGER), 1) AS INTEGER) END))"


@query("luhn_npi", f"SELECT c_custkey, b || CAST((10 - s % 10) % 10 AS VARCHAR) AS npi, c_custkey % 10 = (10 - s % 10) % 10 AS other_valid FROM (SELECT c_custkey, b, CAST({_SUM} AS INTEGER) AS s FROM (SELECT c_custkey, {_BASE} AS b FROM customer) AS x) AS y")
def luhn_npi(spark, sf_dir):
    base = F.concat(F.lit("1"), F.lpad((F.col("c_custkey") % 100000000).cast("string"), 8, "0"))
    c = table(spark, sf_dir, "customer").select("c_custkey", base.alias("b"))
    return c.select(
        "c_custkey",
        F.concat("b", keys.luhn_check_digit("b")).alias("npi"),
        keys.luhn_valid(F.concat("b", (F.col("c_custkey") % 10).cast("string"))).alias("other_valid"),
    )


def _npi_sql(seed: str, lead: str) -> str:
    base = f"concat('{lead}', lpad(CAST(CAST(concat('0x', substr(md5(concat({seed}, '|npi')), 1, 7)) AS BIGINT) % 100000000 AS VARCHAR), 8, '0'))"
    return f"SELECT c_custkey, b || CAST((10 - s % 10) % 10 AS VARCHAR) AS npi FROM (SELECT c_custkey, b, CAST({_SUM} AS INTEGER) AS s FROM (SELECT c_custkey, {base} AS b FROM customer) AS x) AS y"


@query("generate_npi", f"SELECT p.c_custkey, p.npi AS npi, o.npi AS organization, true AS valid FROM ({_npi_sql('c_custkey', '1')}) p JOIN ({_npi_sql('c_custkey', '2')}) o ON p.c_custkey = o.c_custkey")
def generate_npi(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select(
        "c_custkey",
        keys.generate_npi("c_custkey").alias("npi"),
        keys.generate_npi("c_custkey", True).alias("organization"),
    )
    return c.select("*", (keys.luhn_valid("npi") & keys.luhn_valid("organization")).alias("valid"))


@query("validate_total", with_cells("SELECT c.k AS row_idx, coalesce(sum(round(l.l_extendedprice * 100)), 0) = round(max(c.o_totalprice) * 100) + CASE WHEN c.k % 2 = 0 THEN sum(round(l.l_extendedprice * 100)) - round(max(c.o_totalprice) * 100) ELSE 0 END AS ok FROM claim c JOIN line l ON c.k = l.k GROUP BY c.k"))
def validate_total(spark, sf_dir):
    c = Claims(spark, sf_dir)
    cents = lambda x: F.round(F.col(x) * 100).cast("long")
    money = lambda v: (v.cast("decimal(18,0)") / 100).cast("decimal(18,2)").cast("string")
    lines = c.line.groupBy("k").agg(
        F.collect_list(F.struct(money(cents("l_extendedprice")).alias("charges"))).alias("lines"),
        F.sum(cents("l_extendedprice")).alias("s"),
    )
    rows = c.claim.join(lines, "k").withColumn("total", money(F.when(F.col("k") % 2 == 0, F.col("s")).otherwise(cents("o_totalprice"))))
    return rows.select(F.col("k").alias("row_idx"), validators.total_matches(F.col("lines"), "charges", F.col("total")).alias("ok"))


@query("validate_pointers", "SELECT o_orderkey, o_orderkey % 4 <> 0 AND (o_orderkey % 4 <> 3 OR o_custkey % 3 = 2) AS ok FROM orders")
def validate_pointers(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    pointers = F.element_at(F.array(F.lit("AM"), F.lit("A"), F.lit("A"), F.lit("AC")), (F.col("o_orderkey") % 4 + 1).cast("int"))
    diagnoses = F.slice(F.array(F.lit("x"), F.lit("y"), F.lit("z")), 1, (F.col("o_custkey") % 3 + 1).cast("int"))
    return o.select("o_orderkey", validators.pointers_valid(pointers, diagnoses).alias("ok"))


@query("validate_tax_id", "SELECT s_suppkey, CASE s_suppkey % 3 WHEN 0 THEN true WHEN 1 THEN true ELSE false END AS ok FROM supplier")
def validate_tax_id(spark, sf_dir):
    s, k = table(spark, sf_dir, "supplier"), F.col("s_suppkey")
    d = F.lpad(k.cast("string"), 9, "0")
    ein, ssn = F.concat(F.substring(d, 1, 2), F.lit("-"), F.substring(d, 3, 7)), F.concat_ws(
        "-",
        F.substring(d, 1, 3),
        F.substring(d, 4, 2),
        F.substring(d, 6, 4),
    )
    value = F.when(k % 3 == 0, ein).when(k % 3 == 1, ssn).otherwise(d)
    return s.select("s_suppkey", validators.tax_id_valid(value, F.when(k % 3 == 1, "SSN").otherwise("EIN")).alias("ok"))


@query("validate_dates", "SELECT o_orderkey, l_linenumber, l_shipdate, o_orderdate < l_shipdate AND l_shipdate <= TIMESTAMP '1997-06-01 00:00:00' AS ok FROM orders JOIN lineitem ON o_orderkey = l_orderkey")
def validate_dates(spark, sf_dir):
    o, li = table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem")
    rows = o.join(li, o.o_orderkey == li.l_orderkey)
    return rows.select(
        "o_orderkey",
        "l_linenumber",
        "l_shipdate",
        validators.dates_in_order(F.col("o_orderdate"), F.col("l_shipdate"), F.lit("1997-06-01 00:00:00").cast("timestamp")).alias("ok"),
    )


@query("validate_self_mirror", "SELECT c_custkey, c_custkey % 3 <> 0 OR c_custkey % 2 = 0 AS ok FROM customer")
def validate_self_mirror(spark, sf_dir):
    c, k = table(spark, sf_dir, "customer"), F.col("c_custkey")
    me = F.struct(F.col("c_name").alias("n"))
    return c.select(
        "c_custkey",
        validators.self_mirrored(
            F.when(k % 3 == 0, "self").otherwise("child"),
            me,
            F.struct(F.when(k % 2 == 0, F.col("c_name")).otherwise(F.lit("?")).alias("n")),
        ).alias("ok"),
    )


@query("code_enrich", """
WITH c AS (SELECT p_brand AS code, arg_min(p_type, p_partkey) AS description FROM part WHERE p_brand <> 'Brand#11' GROUP BY p_brand)
SELECT p.p_brand AS code, coalesce(c.description, '') AS description, count(*) AS n FROM lineitem JOIN part p ON l_partkey = p.p_partkey LEFT JOIN c ON p.p_brand = c.code GROUP BY ALL""")
def code_enrich(spark, sf_dir):
    """Line items' codes described by a code set that was written and read as a file; one code is not in it."""
    part = table(spark, sf_dir, "part")
    path = _scratch(spark, "codes")
    part.where("p_brand <> 'Brand#11'").select(
        F.col("p_brand").alias("code"),
        F.col("p_type").alias("description"),
        "p_partkey",
    ).repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), "p_partkey").sortWithinPartitions("p_partkey").drop("p_partkey").write.option("header", True).csv(path)
    rows = table(spark, sf_dir, "lineitem").select("l_partkey").join(
        part.select("p_partkey", F.col("p_brand").alias("code")),
        F.col("l_partkey") == F.col("p_partkey"),
    )
    counts = rows.groupBy("code").agg(F.count("*").alias("n"))
    return codes.described(counts, files.read_codes(spark, path), "code").select("code", "description", "n")


# ---------------------------------------------------------------- model output
@query("extract_json_salvage", "SELECT event_id, CASE event_id % 4 WHEN 3 THEN NULL WHEN 2 THEN concat('{\"t\":\"', event_type, '\"}') ELSE concat('{\"t\":\"', event_type, '\",\"u\":\"', CAST(user_id AS VARCHAR), '\"}') END AS found FROM events")
def extract_json_salvage(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    whole = F.concat(F.lit('{"t": "'), F.col("event_type"), F.lit('", "u": "'), F.col("user_id").cast("string"), F.lit('"}'))
    cut = F.concat(F.lit('Sure: {"t": "'), F.col("event_type"), F.lit('", "u": "'), F.col("user_id").cast("string"))
    said = F.element_at(
        F.array(whole, F.concat(F.lit("```json\n"), whole, F.lit("\n```")), cut, F.lit("no object")),
        (F.col("event_id") % 4 + 1).cast("int"),
    )
    return e.select("event_id", serving.extract_json(said).alias("found"))


@query("bill_gate", "SELECT event_id, event_id % 9 = 0 OR event_id % 4 IN (0, 3) OR event_id % 5 NOT IN (0, 1) AS is_bill FROM events")
def bill_gate(spark, sf_dir):
    e, k = table(spark, sf_dir, "events"), F.col("event_id")
    kind = F.element_at(F.array(*map(F.lit, ("hcfa_1500", "eob", " ID_card", "nonsense"))), (k % 4 + 1).cast("int"))
    sure = F.element_at(F.array(*map(F.lit, ("high", "medium", "low", "?", ""))), (k % 5 + 1).cast("int"))
    return e.select("event_id", serving.bill_gate(kind, sure, k % 9 == 0).alias("is_bill"))


@query("num_fields", with_cells("SELECT row_idx, CAST(count_if(pred <> '') AS INTEGER) AS num_fields FROM pred GROUP BY row_idx"))
def num_fields(spark, sf_dir):
    p = Claims(spark, sf_dir).predictions
    return p.select(F.col("sample_id").cast("long").alias("row_idx"), serving.num_fields(F.col("fields")).alias("num_fields"))


# ---------------------------------------------------------------- forms, geometry, generator
def _radio(options: dict, col: str, default: str) -> str:
    return f"CASE {col} " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in options.items()) + f" ELSE '{default}' END"


@query("radio_maps", f"SELECT c_custkey, {_radio(forms.RELATIONSHIP, 'r', 'O')} AS relationship, {_radio(forms.INSURANCE_TYPE, 't', 'Other')} AS insurance, {_radio(forms.INSURED_SEX, 's', 'MALE')} AS sex FROM (SELECT c_custkey, CASE c_custkey % 3 WHEN 0 THEN 'self' WHEN 1 THEN 'child' ELSE 'cousin' END AS r, CASE c_custkey % 3 WHEN 0 THEN 'TRICARE' WHEN 1 THEN 'GroupHealthPlan' ELSE c_mktsegment END AS t, CASE c_custkey % 3 WHEN 0 THEN 'F' WHEN 1 THEN 'M' END AS s FROM customer) AS x")
def radio_maps(spark, sf_dir):
    c, k = table(spark, sf_dir, "customer"), F.col("c_custkey") % 3
    return c.select(
        "c_custkey",
        forms.choice(F.when(k == 0, "self").when(k == 1, "child").otherwise("cousin"), forms.RELATIONSHIP, "O").alias("relationship"),
        forms.choice(
            F.when(k == 0, "TRICARE").when(k == 1, "GroupHealthPlan").otherwise(F.col("c_mktsegment")),
            forms.INSURANCE_TYPE,
            "Other",
        ).alias("insurance"),
        forms.choice(F.when(k == 0, "F").when(k == 1, "M"), forms.INSURED_SEX, "MALE").alias("sex"),
    )


@query("form_dates", "SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 0 THEN '' ELSE concat(lpad(CAST(month(o_orderdate) AS VARCHAR), 2, '0'), '/', lpad(CAST(day(o_orderdate) AS VARCHAR), 2, '0'), '/', CASE WHEN o_orderkey % 4 = 1 THEN CAST(year(o_orderdate) AS VARCHAR) ELSE concat(CASE WHEN o_orderkey % 100 < 50 THEN '20' ELSE '19' END, lpad(CAST(o_orderkey % 100 AS VARCHAR), 2, '0')) END) END AS full_date FROM orders")
def form_dates(spark, sf_dir):
    k = F.col("o_orderkey")
    d = F.struct(
        F.when(k % 4 == 0, "").otherwise(F.date_format("o_orderdate", "MM")).alias("mm"),
        F.date_format("o_orderdate", "dd").alias("dd"),
        F.lpad((k % 100).cast("string"), 2, "0").alias("yy"),
        F.when(k % 4 == 1, F.date_format("o_orderdate", "yyyy")).otherwise("").alias("yyyy"),
    )
    return table(spark, sf_dir, "orders").select("o_orderkey", forms.full_date(d).alias("full_date"))


_WIDGETS = "SELECT concat(CASE p_partkey % 3 WHEN 0 THEN 'cpt' WHEN 1 THEN 'ch' ELSE 'total' END, CAST(p_size % 6 + 1 AS VARCHAR(4))) AS name, CAST(p_size AS DOUBLE) * 2.3 AS x0, 250.0 + p_size + p_partkey % 9 AS y0, CAST(p_size AS DOUBLE) * 4.1 + 3 AS x1, 240.0 + p_size % 7 AS y1 FROM part"


@query("band_geometry", f"""
WITH w AS ({_WIDGETS}),
u AS (SELECT name, min(least(x0, x1)) AS x0, min(least(y0, y1)) AS y0, max(greatest(x0, x1)) AS x1, max(greatest(y0, y1)) AS y1 FROM w GROUP BY name),
b AS (SELECT min(CAST(round_even((792.0 - y1) * (300 / 72.0), 0) AS INTEGER)) AS a, max(CAST(round_even((792.0 - y0) * (300 / 72.0), 0) AS INTEGER)) AS b FROM u WHERE name NOT LIKE 'total%')
SELECT 'top' AS region, 0 AS x0, 0 AS y0, 2550 AS x1, least(3300, a + 50) AS y1 FROM b UNION ALL SELECT 'service', 0, greatest(0, a - 50), 2550, least(3300, b + 50) FROM b UNION ALL SELECT 'bottom', 0, greatest(0, b - 50), 2550, 3300 FROM b""")
def band_geometry(spark, sf_dir):
    return geometry.bands(geometry.field_rects(claims.run_sql(spark, sf_dir, _WIDGETS)))


@query("standard_bands", "SELECT p_partkey, region, CAST(floor(a * (w / 2550)) AS INTEGER) AS x0, CAST(floor(b * (h / 3300)) AS INTEGER) AS y0, CAST(floor(c * (w / 2550)) AS INTEGER) AS x1, CAST(floor(d * (h / 3300)) AS INTEGER) AS y1 FROM (SELECT p_partkey, CAST(p_size * 10 AS DOUBLE) AS w, CAST(p_size * 17 AS DOUBLE) AS h FROM part) AS p, (VALUES ('top', 0, 0, 2550, 2254), ('service', 0, 2154, 2550, 2847), ('bottom', 0, 2747, 2550, 3300)) AS v(region, a, b, c, d)")
def standard_bands(spark, sf_dir):
    pages = table(spark, sf_dir, "part").select(
        "p_partkey",
        (F.col("p_size") * 10).cast("double").alias("width"),
        (F.col("p_size") * 17).cast("double").alias("height"),
    )
    return geometry.standard_bands(pages).drop("width", "height")


@query("region_split", with_cells(f"SELECT row_idx, r AS region, CAST(sum(CASE WHEN region = r THEN 1 ELSE 0 END) AS INTEGER) AS n FROM (SELECT row_idx, {claims.o_region('key')} AS region FROM gt) AS x, (VALUES ('top'), ('service'), ('bottom')) AS v(r) GROUP BY row_idx, r"))
def region_split(spark, sf_dir):
    """Cells of each claim by region; a region without cells is there too."""
    cells = F.transform("cells", lambda x: F.struct(x["key"].alias("key"), x["gt"].alias("value")))
    rows = Claims(spark, sf_dir).rows.select("row_idx", keys.split_regions(cells).alias("m"))
    # no region is left out, so the outer form gives the same rows; Spark would make the map of the other twice, to see that it is not empty
    return rows.select("row_idx", F.explode_outer("m").alias("region", "cells")).select("row_idx", "region", F.size("cells").alias("n"))


@query("manifest_round_trip", f"SELECT o_orderkey % 3 AS file, CAST(row_number() OVER (ORDER BY o_orderkey % 3, o_orderkey) - 1 AS BIGINT) AS row_idx, CAST(o_orderkey AS VARCHAR) AS sample_id, concat('fax/', CAST(o_orderkey AS VARCHAR), '.png') AS image, concat(CAST(o_orderkey AS VARCHAR), '.png') AS name FROM orders")
def manifest_round_trip(spark, sf_dir):
    """Manifests written as three files and read back in order of file and line, with slashes mended."""
    path = _scratch(spark, "manifest")
    o = table(spark, sf_dir, "orders").select(
        (F.col("o_orderkey") % 3).alias("file"),
        "o_orderkey",
        F.to_json(F.struct(
            F.col("o_orderkey").cast("string").alias("sample_id"),
            F.concat(F.lit("fax\\"), F.col("o_orderkey").cast("string"), F.lit(".png")).alias("image"),
        )).alias("value"),
    )
    # files of a folder are written in the order of their names, each in order
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = o.repartitionByRange(parts, "file", "o_orderkey").sortWithinPartitions("file", "o_orderkey")
    ordered.select("value", F.col("file").alias("part")).write.partitionBy("part").text(path)
    rows = files.read_manifest(spark, f"{path}/*")
    return rows.select(
        (F.col("sample_id").cast("long") % 3).alias("file"),
        "row_idx",
        "sample_id",
        "image",
        files.basename(F.col("image")).alias("name"),
    )


_PART = "CASE o_orderkey % 10 WHEN 0 THEN 'val' WHEN 1 THEN 'test' ELSE 'train' END"


@query("split_round_trip", f"SELECT split, CAST(row_number() OVER (PARTITION BY split ORDER BY o_orderkey) - 1 AS BIGINT) AS row_idx, CAST(o_orderkey AS VARCHAR) AS sample_id, tier FROM (SELECT o_orderkey, {_PART} AS split, {claims.TIER.format(k='o_orderkey')} AS tier FROM orders) AS x")
def split_round_trip(spark, sf_dir):
    """Split rows written as train, val and test files and read back in their order."""
    o, path = table(spark, sf_dir, "orders"), _scratch(spark, "splits")
    rows = o.select(F.col("o_orderkey").alias("row_idx"), F.col("o_orderkey").cast("string").alias("sample_id"), F.expr(claims.TIER.format(k="o_orderkey")).alias("tier"), F.expr(_PART).alias("split"))
    files.write_splits(rows, path)
    return files.read_dataset_splits(spark, path).select("split", "row_idx", "sample_id", "tier")


@query("append_manifest", "SELECT CAST(o_orderkey AS VARCHAR) AS sample_id, o_orderkey AS seed, CASE WHEN o_orderkey % 2 = 0 THEN 'even' ELSE 'all' END AS batch FROM orders")
def append_manifest(spark, sf_dir):
    """Two overlapping batches appended to a manifest, and the first once more: no sample comes twice."""
    rows = table(spark, sf_dir, "orders").select(F.col("o_orderkey").cast("string").alias("sample_id"), F.col("o_orderkey").alias("seed"))
    path = _scratch(spark, "appended")
    for batch, some in (("even", rows.where("seed % 2 = 0")), ("all", rows), ("even", rows)):
        files.append_manifest(some, path, batch)
    return files.read_appended_manifest(spark, path).select("sample_id", "seed", "batch")


AS_OF = "2024-06-01"


def _seeds(spark, sf_dir) -> DataFrame:
    """A claim for every order."""
    return table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("seed"))


@query("synth_records")
def synth_records(spark, sf_dir):
    """A whole claim for every order, typed as it is made: as JSON text, which names each field again in each row, it takes several times the room."""
    return synth.batch_of(_seeds(spark, sf_dir), AS_OF)


_SAMPLE_ID = "lpad(CAST(o_orderkey AS VARCHAR), CAST(greatest(5, length(CAST(o_orderkey AS VARCHAR))) AS INTEGER), '0')"


@query("synth_manifest", f"SELECT x.*, concat(tier, '/', sample_id, '.png') AS image, concat(tier, '/', sample_id, '.json') AS json, seed AS truth_seed, true AS lines_ok, 0 AS blank_names FROM (SELECT {_SAMPLE_ID} AS sample_id, {claims.TIER.format(k='o_orderkey')} AS tier, o_orderkey AS seed FROM orders) AS x")
def synth_manifest(spark, sf_dir):
    """A generated claim for every order: its manifest row, and what its ground truth must say."""
    b, truth = synth.batch_of(_seeds(spark, sf_dir), AS_OF), F.col("ground_truth")
    return b.select(
        "sample_id",
        "tier",
        "seed",
        "image",
        "json",
        truth["meta"]["seed"].alias("truth_seed"),
        F.size(truth["logical"]["box_24_service_lines"]).between(1, 6).alias("lines_ok"),
        F.when(truth["logical"]["box_2_patient_name"]["last"] == "", 1).otherwise(0).alias("blank_names"),
    )


@query("pointed_diagnoses", "SELECT o_orderkey, CASE o_orderkey % 3 WHEN 0 THEN 'p' WHEN 1 THEN concat('q,', CASE WHEN o_custkey % 2 = 0 THEN '' ELSE 'r' END) ELSE '' END AS codes FROM orders")
def pointed_diagnoses(spark, sf_dir):
    """The diagnoses that a line's pointers name, in the pointers' order; a pointer beyond the list names none."""
    o = table(spark, sf_dir, "orders")
    pointers = F.element_at(F.array(F.lit("A"), F.lit("B?C"), F.lit("")), (F.col("o_orderkey") % 3 + 1).cast("int"))
    listed = F.slice(F.array(F.lit("p"), F.lit("q"), F.lit("r")), 1, (F.col("o_custkey") % 2 + 2).cast("int"))
    return o.select("o_orderkey", F.array_join(validators.pointed_codes(pointers, listed), ",", "").alias("codes"))


@query("dataset_round_trip", f"SELECT {_PART} AS split, {claims.TIER.format(k='o_orderkey')} AS tier, count(*) AS n, CAST(sum(o_orderkey) AS BIGINT) AS keys FROM orders GROUP BY ALL")
def dataset_round_trip(spark, sf_dir):
    """A data set written by the library's sink, a folder a split, and counted as read."""
    o, path = table(spark, sf_dir, "orders"), _scratch(spark, "dataset")
    rows = o.select(F.col("o_orderkey").alias("key"), F.expr(claims.TIER.format(k="o_orderkey")).alias("tier"), F.expr(_PART).alias("split"))
    files.write_dataset(rows, path)
    return spark.read.parquet(path).groupBy("split", "tier").agg(F.count("*").alias("n"), F.sum("key").alias("keys"))


@query("upload_prefix", "SELECT o_orderkey, concat('extractions/', o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN '.png' ELSE '' END) AS prefix FROM orders")
def upload_prefix(spark, sf_dir):
    ends = F.element_at(F.array(F.lit(".png"), F.lit(".pdf"), F.lit(".PDF")), (F.col("o_orderkey") % 3 + 1).cast("int"))
    path = F.concat(F.lit("inbox\\2024/"), F.col("o_orderkey").cast("string"), ends)
    return table(spark, sf_dir, "orders").select("o_orderkey", files.output_prefix(path).alias("prefix"))


@query("synth_rules", "SELECT o_orderkey AS seed, true AS total_ok, true AS pointers_ok, true AS counts_ok, true AS tax_ok, true AS mirror_ok, true AS npi_ok FROM orders")
def synth_rules(spark, sf_dir):
    """What holds of every generated claim."""
    r = synth.of_seeds(_seeds(spark, sf_dir), AS_OF)
    lines, c = F.col("service_lines"), F.col
    return r.select(
        "seed",
        validators.total_matches(lines, "charges", c("billing.total_charge")).alias("total_ok"),
        F.forall(
            lines,
            lambda x: validators.pointers_valid(x["diagnosis_pointers"], c("diagnoses")) & (F.char_length(x["diagnosis_pointers"]) <= 4),
        ).alias("pointers_ok"),
        (F.size(lines).between(1, 6) & F.size("diagnoses").between(1, 12) & (F.size(F.array_distinct("diagnoses")) == F.size("diagnoses")) & F.forall(
            lines,
            lambda x: (F.size(x["modifiers"]) == 4) & x["units"].cast("int").between(1, 5),
        )).alias("counts_ok"),
        validators.tax_id_valid(c("billing.tax_id"), c("billing.tax_id_type")).alias("tax_ok"),
        validators.self_mirrored(c("patient.relationship_to_insured"), c("patient.name"), c("insured.name")).alias("mirror_ok"),
        (keys.luhn_valid("billing_office.npi") & F.forall(lines, lambda x: keys.luhn_valid(x["rendering_provider_npi"]))).alias("npi_ok"),
    )


def known_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records whose values follow from the tables: columns as the generator's, what the tables do not hold is null."""
    k, d = F.col("k"), F.col("o_orderdate")
    date = F.struct(*(F.date_format(d, p).alias(n) for n, p in (("mm", "MM"), ("dd", "dd"), ("yy", "yy"), ("yyyy", "yyyy"))))
    name = F.struct(F.col("c_name").alias("last"), F.lit("A").alias("first"), F.lit("").alias("middle"))
    line = lambda n: F.struct(date.alias("date_from"), F.lit("99213").alias("cpt"), F.array(F.lit("25"), F.lit("")).alias("modifiers"), F.lit(f"{n}0.00").alias("charges"), F.lit(str(n)).alias("units"))
    doc = F.struct(
        F.struct(
            F.when(k % 3 == 0, "TRICARE").otherwise("GroupHealthPlan").alias("type"),
            F.concat(F.lit("W"), F.col("o_custkey").cast("string")).alias("insured_id"),
        ).alias("insurance"),
        F.struct(
            name.alias("name"),
            date.alias("dob"),
            F.when(k % 2 == 0, "M").otherwise("F").alias("sex"),
            F.struct(F.lit("555").alias("area"), F.lit("010-0000").alias("number")).alias("phone"),
            F.when(k % 4 == 0, "self").when(k % 4 == 1, "child").otherwise("other").alias("relationship_to_insured"),
        ).alias("patient"),
        F.when(k % 5 == 0, F.struct(F.col("c_name").alias("name"), F.lit("P1").alias("policy_or_group"))).alias("other_insured"),
        F.struct((k % 2 == 0).alias("yes")).alias("outside_lab"),
        F.slice(F.array(F.lit("A01.1"), F.lit("B02")), 1, (k % 2 + 1).cast("int")).alias("diagnoses"),
        F.slice(F.array(line(1), line(2)), 1, (k % 3).cast("int")).alias("service_lines"),
    )
    rows = Claims(spark, sf_dir).claim.select("k", doc.alias("r"))
    rows = rows.select("k", forms.as_type(F.col("r"), rows.schema["r"].dataType, forms.RECORD).alias("r"))
    return rows.select(F.col("k").alias("seed"), "r.*")


_MM, _DD, _YY = ("lpad(CAST({}(o_orderdate) AS VARCHAR), 2, '0')".format(p) for p in ("month", "day", "year"))
_YY = "substr(CAST(year(o_orderdate) AS VARCHAR), 3, 2)"
_FIELDS_SQL = {
    "pt_name": "concat(c_name, ', A ')", "birth_mm": _MM, "birth_dd": _DD, "birth_yy": _YY, "sex": "CASE WHEN k % 2 = 0 THEN 'M' ELSE 'F' END", "pt_phone": "'010-0000'", "pt_AreaCode": "'555'",
    "insurance_type": "CASE WHEN k % 3 = 0 THEN 'Tricare' ELSE 'Group' END", "insurance_id": "concat('W', CAST(o_custkey AS VARCHAR))", "rel_to_ins": "CASE k % 4 WHEN 0 THEN 'S' WHEN 1 THEN 'C' ELSE 'O' END",
    "ins_sex": "'MALE'", "lab": "CASE WHEN k % 2 = 0 THEN 'YES' ELSE 'NO' END", "prior_auth": "''", "diagnosis1": "'A01.1'", "cur_ill_mm": "''",
}
_MAYBE_SQL = {
    "other_ins_name": ("k % 5 = 0", "c_name"), "other_ins_policy": ("k % 5 = 0", "'P1'"), "diagnosis2": ("k % 2 = 1", "'B02'"), "cpt1": ("k % 3 >= 1", "'99213'"), "ch2": ("k % 3 = 2", "'20.00'"),
    "sv1_mm_from": ("k % 3 >= 1", _MM), "sv2_yy_from": ("k % 3 = 2", _YY), "mod1": ("k % 3 >= 1", "'25'"), "mod1a": ("k % 3 >= 1", "''"), "mod2c": ("k % 3 = 2", "''"), "day2": ("k % 3 = 2", "'2'"),
}


def _cells_sql(always: dict, maybe: dict, name: str) -> str:
    parts = [f"SELECT k AS seed, '{f}' AS {name}, {v} AS value FROM claim" for f, v in always.items()]
    parts += [f"SELECT k, '{f}', {v} FROM claim WHERE {w}" for f, (w, v) in maybe.items()]
    return with_cells(" UNION ALL ".join(parts))


@query("record_to_fields", _cells_sql(_FIELDS_SQL, _MAYBE_SQL, "field"))
def record_to_fields(spark, sf_dir):
    # a record's map is never empty: the outer form does not make it a second time to see that
    rows = known_records(spark, sf_dir).select("seed", forms.fields().alias("f")).select("seed", F.explode_outer("f").alias("field", "value"))
    return rows.where(F.col("field").isin(*_FIELDS_SQL, *_MAYBE_SQL))


_DATE_SQL = claims._date("o_orderdate")
_LOGICAL_SQL = {
    "box_1_insurance_type": "CASE WHEN k % 3 = 0 THEN 'TRICARE' ELSE 'GroupHealthPlan' END", "box_1a_insured_id": "concat('W', CAST(o_custkey AS VARCHAR))", "box_2_patient_name.last": "c_name", "box_2_patient_name.first": "'A'",
    "box_3_patient_birth": _DATE_SQL, "box_5_patient_address.phone": "'(555) 010-0000'", "box_6_relationship_to_insured": "CASE k % 4 WHEN 0 THEN 'self' WHEN 1 THEN 'child' ELSE 'other' END",
    "box_14_current_illness_date": "''", "box_20_outside_lab.yes": "CASE WHEN k % 2 = 0 THEN 'YES' ELSE 'NO' END", "box_21_diagnoses": "CASE WHEN k % 2 = 0 THEN 'A01.1' ELSE 'A01.1 | B02' END", "box_21_icd_indicator": "'0'",
}
_LOGICAL_MAYBE = {
    "box_9_other_insured": ("k % 5 <> 0", "''"), "box_9_other_insured.name": ("k % 5 = 0", "c_name"), "box_24_service_lines": ("k % 3 = 0", "''"), "box_24_service_lines[0].line_number": ("k % 3 >= 1", "'1'"),
    "box_24_service_lines[0].date_from": ("k % 3 >= 1", _DATE_SQL), "box_24_service_lines[1].procedure_code": ("k % 3 = 2", "'99213'"), "box_24_service_lines[1].modifiers": ("k % 3 = 2", "'25'"), "box_24_service_lines[1].charges": ("k % 3 = 2", "'20.00'"),
}


@query("record_to_logical", _cells_sql(_LOGICAL_SQL, _LOGICAL_MAYBE, "key"))
def record_to_logical(spark, sf_dir):
    df = known_records(spark, sf_dir).select("seed", forms.logical().alias("doc"))
    return flatten.explode_cells(
        df,
        flatten.flat_cells(F.col("doc"), df.schema["doc"].dataType),
        "seed",
    ).drop("pos").where(F.col("key").isin(*_LOGICAL_SQL, *_LOGICAL_MAYBE))


_SYNTH_WEIGHTS = ((60, "plain"), (30, "one"), (10, "two"))


@query("weighted_choice", "SELECT kind, count(*) AS n FROM (SELECT CASE WHEN o_orderkey % 1000 < 600 THEN 'plain' WHEN o_orderkey % 1000 < 900 THEN 'one' ELSE 'two' END AS kind FROM orders) AS x GROUP BY kind")
def weighted_choice(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select(synth.choose(F.col("o_orderkey") % 1000, list(_SYNTH_WEIGHTS)).alias("kind"))
    return o.groupBy("kind").agg(F.count("*").alias("n"))


def _pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A small page for every part, its size and grey levels from the table."""
    p = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("i"),
        (F.col("p_size") % 16 + 32).alias("height"),
        (F.col("p_size") % 8 + 24).alias("width"),
    )
    # the table is a few narrow files: its rows are dealt out before they become pages, or a core or two would make them all
    p = p.repartition(max(int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * spark.sparkContext.defaultParallelism), F.xxhash64("i"))
    rows = splits.round_robin(p, "i", list(keys.TIERS))
    pixels = F.unhex(F.repeat(F.lit("ff00e0"), F.col("height") * F.col("width")))
    return rows.select(F.col("i").cast("string").alias("sample_id"), "tier", F.col("i").alias("seed"), "height", "width", pixels.alias("pixels"))


@query("image_tiers", f"SELECT CAST(p_partkey AS VARCHAR) AS sample_id, {claims.TIER.format(k='p_partkey')} AS tier, CAST((p_size % 16 + 32) * (p_size % 8 + 24) * 3 AS INTEGER) AS bytes, true AS as_should FROM part")
def image_tiers(spark, sf_dir):
    """Pages degraded by tier: the size stays, and a pristine page stays as it is."""
    from ..operators import images

    before = _pages(spark, sf_dir)
    made = images.apply_tiers(before).select("sample_id", "tier", "height", "width", "pixels")
    same = F.col("pixels") == F.unhex(F.repeat(F.lit("ff00e0"), F.col("height") * F.col("width")))
    return made.select(
        "sample_id",
        "tier",
        F.length("pixels").alias("bytes"),
        F.when(F.col("tier") == keys.TIERS[0], same).otherwise(F.lit(True)).alias("as_should"),
    )


@query("image_crops", "SELECT CAST(p_partkey AS VARCHAR) AS sample_id, region, y1 - y0 AS height, p_size % 8 + 20 AS width, CAST((y1 - y0) * (p_size % 8 + 20) * 3 AS INTEGER) AS bytes FROM part, (VALUES ('top', 0, 12), ('service', 10, 20), ('bottom', 18, 30)) AS v(region, y0, y1)")
def image_crops(spark, sf_dir):
    from ..operators import images

    crops = images.crop_regions(_pages(spark, sf_dir), [("top", 4, 0, 999, 12), ("service", 4, 10, 999, 20), ("bottom", 4, 18, 999, 30)])
    return crops.select("sample_id", "region", "height", "width", F.length("pixels").alias("bytes"))
