"""Readers and writers: manifests, splits, labels, predictions, code sets, run summaries, images.

All schemas are declared, numbers stay text, and order that matters is carried in a column.  Paths may use
backslashes; they are read with slashes.
"""

from __future__ import annotations

import json
import re
import uuid

import pandas as pd
from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window

from ..operators import flatten, splits
from . import artefacts as artefact_sink

MANIFEST = T.StructType([T.StructField(n, T.LongType() if n == "seed" else T.StringType()) for n in (
    "sample_id",
    "tier",
    "seed",
    "image",
    "json",
    "pdf",
    "split",
)])


def slashes(path: Column) -> Column:
    return F.translate(path, "\\", "/")


def basename(path: Column) -> Column:
    """The last part of a path, written with either kind of slash."""
    return F.substring_index(slashes(path), "/", -1)


def output_prefix(path: Column, given: Column | None = None) -> Column:
    """Where the results of an uploaded file go: the given prefix, or below ``extractions`` the file's name without a .pdf at its end."""
    made = F.concat(F.lit("extractions/"), F.regexp_replace(basename(path), r"(?i)\.pdf$", ""))
    return made if given is None else F.coalesce(given, made)


def _placed(df: DataFrame) -> DataFrame:
    """Rows as read with their place: file, start of the piece of it, and order within the piece.

    Files are read by pieces packed by size, so the number that Spark gives a row follows a file's order only within a piece.
    """
    return df.select(
        "*",
        F.struct(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("start"),
            F.monotonically_increasing_id().alias("row"),
        ).alias("_at"),
    )


#: Most rows of a table of file pieces that is broadcast.
FEW_PIECES = 1_000_000


def _numbered(placed: DataFrame, name: str = "row_idx", in_file: bool = False) -> DataFrame:
    """Rows with a number 0, 1, 2, .. by file name and place in the file (or in each file anew); no row is shuffled for it.

    Rows of a piece are read one after the other, so a row's number is that of its piece's first row and the distance to it.  Pieces
    are counted by one aggregate, a row a piece; both readings are of one plan and cut the files alike.  A piece is a file or fills
    a partition, so their number is known before anything is read.
    """
    file, start = F.col("_at.file").alias("_f"), F.col("_at.start").alias("_s")
    sizes = placed.groupBy(file, start).agg(F.count("*").alias("_c"), F.min("_at.row").alias("_first"))
    order = Window.partitionBy("_f").orderBy("_s") if in_file else Window.orderBy("_f", "_s")  # a row a piece
    base = sizes.select("_f", "_s", "_first", (F.sum("_c").over(order) - F.col("_c")).alias("_base"))
    if len(placed.inputFiles()) + placed.rdd.getNumPartitions() <= FEW_PIECES:
        base = F.broadcast(base)
    rows = placed.join(base, (F.col("_at.file") == F.col("_f")) & (F.col("_at.start") == F.col("_s")))
    return rows.withColumn(name, F.col("_base") + F.col("_at.row") - F.col("_first")).drop("_f", "_s", "_first", "_base")


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """(value, _at) of the lines that are not blank, in their order."""
    return _placed(spark.read.text(path).where(F.trim("value") != ""))


def exists(spark: SparkSession, path: str) -> bool:
    sc = spark.sparkContext
    where = sc._jvm.org.apache.hadoop.fs.Path(path)
    return bool(where.getFileSystem(sc._jsc.hadoopConfiguration()).globStatus(where))


def read_manifest(spark: SparkSession, path: str, strict: bool = False) -> DataFrame:
    """Manifest or split rows with row_idx; blank lines are skipped, duplicates kept.  strict: an empty one is an error."""
    lines = _numbered(_lines(spark, path))
    rows = lines.select("row_idx", F.from_json("value", MANIFEST, {"mode": "FAILFAST"}).alias("x")).select("row_idx", "x.*")
    rows = rows.withColumns({"image": slashes(F.col("image")), "json": slashes(F.col("json")), "pdf": slashes(F.col("pdf"))})
    if strict and not rows.limit(1).count():
        raise ValueError(f"no rows in {path}")
    return rows


def split_manifest(spark: SparkSession, path: str, out: str, seed: int = 0) -> DataFrame:
    """Reads a manifest, splits it by tier with a seed, writes the splits to out and returns them."""
    rows = splits.hash_stratified(read_manifest(spark, path).drop("split"), "tier", "sample_id", seed)
    write_splits(rows, out)
    return rows


def sample_artefacts(manifest: DataFrame, per_tier: int) -> DataFrame:
    """(sample_id, tier, path) of the first samples of each tier: what a sample folder holds of a batch."""
    some = splits.first_per_group(manifest, "tier", "row_idx", per_tier)
    return some.select("sample_id", "tier", F.explode(F.filter(F.array("image", "json", "pdf"), lambda x: x.isNotNull())).alias("path"))


def relative_path(path: Column, folder: str) -> Column:
    """A path below folder, relative to it, however the file system spells the folder."""
    root = folder.rstrip("/").split(":", 1)[-1].lstrip("/")
    return F.regexp_replace(F.substring_index(path, root + "/", -1), "^/+", "")


def copy_artefacts(spark: SparkSession, artefacts: DataFrame, folder: str, out: str) -> DataFrame:
    """(path, target, bytes): copies files by executors, from below folder to out, under tier and file name.

    A file meets its row by name, and then the whole path must end alike; contents go to the sink of ``sources.artefacts``, which
    shows what all tasks have written or nothing.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
    wanted = artefacts.select("tier", slashes(F.col("path")).alias("path"), basename(F.col("path")).alias("name"))
    found = files.select(F.col("path").alias("file"), basename(F.col("path")).alias("name"), "length", "content")
    rows = found.join(wanted, "name").where(F.col("file").endswith(F.concat(F.lit("/"), F.col("path"))))
    rows = rows.select("path", F.concat_ws("/", "tier", basename(F.col("path"))).alias("target"), F.col("length").alias("bytes"), "content")
    artefact_sink.write(rows.select("target", "content"), out)
    return rows.select("path", F.concat_ws("/", F.lit(out.rstrip("/")), "target").alias("target"), "bytes")


def print_keys(cells: DataFrame, most_rows: int | None = None) -> list[str]:
    """Prints the keys of a batch in first-seen order, a line each, and returns them."""
    names = [r.key for r in splits.canonical_keys(cells, most_rows).orderBy("position").collect()]  # a row a key
    print("\n".join(names))
    return names


def read_labels(spark: SparkSession, folder: str, part: str = "logical") -> DataFrame:
    """(json, cells): flat cells of each label file below folder; json is its path relative to the folder."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.json").load(folder)
    body = F.col("content").cast("string")
    return files.select(relative_path(F.col("path"), folder).alias("json"), flatten.flat_json(_member(body, F.lit(part))).alias("cells"))


@F.pandas_udf(T.StringType())
def _member(texts: pd.Series, names: pd.Series) -> pd.Series:
    return pd.Series([json.dumps(json.loads(t).get(n, {}), ensure_ascii=False) for t, n in zip(texts, names)])


def read_batch(spark: SparkSession, folder: str, split: DataFrame) -> DataFrame:
    """(row_idx, pos, key, gt) of the split's labels."""
    rows = split.select("row_idx", "json").join(read_labels(spark, folder), "json")
    return flatten.explode_cells(rows, F.col("cells"), "row_idx").withColumnRenamed("value", "gt")


_LINE = T.StructType(
    [
        T.StructField("sample_id", T.StringType()),
        T.StructField("fields", T.MapType(T.StringType(), T.StringType())),
        T.StructField("parse_ok", T.BooleanType()),
        T.StructField("got", T.ArrayType(T.StringType())),
        T.StructField("bad", T.BooleanType()),
    ]
)


@F.pandas_udf(_LINE)
def _prediction(lines: pd.Series) -> pd.DataFrame:
    """One prediction line: fields as text; whether its raw output (or else its fields) is an object, and its keys."""
    out = []
    for line in lines:
        row = {"sample_id": None, "fields": None, "parse_ok": False, "got": [], "bad": True}
        try:
            x = json.loads(line)
        except ValueError:
            x = None
        if isinstance(x, dict) and x.get("sample_id") is not None:
            row["sample_id"] = str(x["sample_id"])
            if isinstance(x.get("fields"), dict):
                row["fields"], row["bad"] = {k: "" if v is None else str(v) for k, v in x["fields"].items()}, False
            said = x.get("fields")
            if isinstance(x.get("raw"), str):
                try:
                    said = json.loads(x["raw"])
                except ValueError:
                    said = None
            if isinstance(said, dict):
                row["parse_ok"], row["got"] = True, list(said)
        out.append(row)
    return pd.DataFrame(out, columns=["sample_id", "fields", "parse_ok", "got", "bad"])


def _prediction_lines(spark: SparkSession, path: str) -> DataFrame:
    return _lines(spark, path).select("_at", _prediction("value").alias("x")).select("_at", "x.*")


def read_predictions(spark: SparkSession, path: str, strict: bool = True) -> DataFrame:
    """(sample_id, fields): the last line of each sample, files by name.  strict: a line that is no prediction is an error, which names
    its file and its number there (blank lines count)."""
    if strict:
        lines = _numbered(_placed(spark.read.text(path)), "_line", in_file=True).where(F.trim("value") != "")
        rows = lines.select("_at", "_line", _prediction("value").alias("x")).select("_at", "_line", "x.*")
        said = F.concat(F.lit("malformed prediction: line "), (F.col("_line") + 1).cast("string"), F.lit(" of "), F.col("_at.file"))
        # the value itself fails: a filter could be dropped or moved behind another
        rows = rows.withColumn("fields", F.when(F.col("bad"), F.raise_error(said)).otherwise(F.col("fields")))
    else:
        rows = _prediction_lines(spark, path).where(~F.col("bad"))
    return rows.groupBy("sample_id").agg(F.max_by("fields", "_at").alias("fields"))


def read_validity(spark: SparkSession, path: str) -> DataFrame:
    """(sample_id, parse_ok, got): the tolerant reading; lines without a sample are skipped, a missing file has none."""
    if not exists(spark, path):
        return spark.createDataFrame([], "sample_id string, parse_ok boolean, got array<string>")
    rows = _prediction_lines(spark, path).where(F.col("sample_id").isNotNull())
    return rows.groupBy("sample_id").agg(F.max_by(F.struct("parse_ok", "got"), "_at").alias("x")).select("sample_id", "x.*")


def read_codes(spark: SparkSession, path: str) -> DataFrame:
    """(ordinal, code, description) of a code set, ordinals 0, 1, 2, ..; codes keep their zeros."""
    rows = spark.read.csv(path, header=True, schema="code string, description string")
    return _numbered(_placed(rows)).select(F.col("row_idx").alias("ordinal"), "code", "description")


def read_images(spark: SparkSession, folder: str, pattern: str = "*.png") -> DataFrame:
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(folder).select("path", "content")


def write_splits(rows: DataFrame, path: str, order: str = "row_idx") -> None:
    """Writes train.jsonl, val.jsonl and test.jsonl (whatever values split has) below path, which ``read_dataset_splits`` reads.

    One pass: rows are range-partitioned by split and order, so a split's files hold its rows in order; each split's folder then takes its
    name by one rename.  A split that is there is replaced.
    """
    spark, new = rows.sparkSession, f"{path.rstrip('/')}/_new-{uuid.uuid4().hex}"
    keys = ["split", *([order] if order in rows.columns else [])]
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows.repartitionByRange(parts, *keys).sortWithinPartitions(*keys).drop(order).write.partitionBy("split").json(new)
    fs, where = _file_system(spark, new)
    for found in fs.listStatus(where):
        name = found.getPath().getName()
        if found.isDirectory() and name.startswith("split="):
            target = _path(spark, f"{path.rstrip('/')}/{name.removeprefix('split=')}.jsonl")
            fs.delete(target, True)
            fs.rename(found.getPath(), target)
    fs.delete(where, True)


def _path(spark: SparkSession, path: str):
    return spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)


def _file_system(spark: SparkSession, path: str):
    where = _path(spark, path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def append_once(rows: DataFrame, path: str, batch: str, keys: list[str] | None = None, form: str = "json", schema: str | None = None) -> bool:
    """Appends rows as the batch of that name; whether it was appended now.  A batch that is there already adds nothing.

    The batch is written beside the table, where readers do not look, and shown by one rename that fails if the name is taken: a rerun
    or a second writer of the batch loses, writers of other batches do not meet, and a reader sees whole batches only.  With keys, rows
    whose keys an earlier batch holds are left out (an anti-join; nulls are equal), and repeats within the batch stay.  ``schema`` types the
    keys of earlier batches, else they are texts.
    """
    if not re.fullmatch(r"[\w.-]+", batch):
        raise ValueError(f"no name of a batch: {batch!r}")
    spark, root = rows.sparkSession, path.rstrip("/")
    target, new = f"{root}/batch={batch}", f"{root}/_new-{uuid.uuid4().hex}"
    fs, _ = _file_system(spark, root)
    if fs.exists(_path(spark, target)):
        return False
    if keys and exists(spark, f"{root}/batch=*"):
        had = read_appended(spark, root, form, schema or ", ".join(f"`{k}` string" for k in keys)).select(*(F.col(k).alias(f"_had_{k}") for k in keys))
        same = F.lit(True)
        for k in keys:
            same = same & F.col(k).cast("string").eqNullSafe(F.col(f"_had_{k}").cast("string"))
        rows = rows.join(had, same, "left_anti")
    writer = rows.coalesce(1) if form == "csv" else rows
    options = {"header": True, "emptyValue": ""} if form == "csv" else {}
    writer.write.options(**options).format(form).save(new)
    jvm = spark.sparkContext._jvm
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(_path(spark, new).toUri(), spark.sparkContext._jsc.hadoopConfiguration()) if ":" in new else jvm.org.apache.hadoop.fs.FileContext.getFileContext(spark.sparkContext._jsc.hadoopConfiguration())
    none = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
    try:
        context.rename(_path(spark, new), _path(spark, target), none)
    except Py4JJavaError as e:
        fs.delete(_path(spark, new), True)
        if "FileAlreadyExists" in str(e.java_exception) or fs.exists(_path(spark, target)):
            return False
        raise
    return True


def read_appended(spark: SparkSession, path: str, form: str = "json", schema: str | None = None) -> DataFrame:
    """Rows of all batches below path, with the batch's name; a table without any batch is empty and needs a schema."""
    names = [x.getPath().toString() for x in _batches(spark, path)]
    if not names:
        return spark.createDataFrame([], schema or "batch string").withColumn("batch", F.lit(None).cast("string"))
    reader = spark.read.options(**({"header": True} if form == "csv" else {})).option("basePath", path)
    rows = (reader.schema(f"{schema}, batch string") if schema else reader).format(form).load(names)
    return rows.withColumn("batch", F.col("batch").cast("string"))


def _batches(spark: SparkSession, path: str) -> list:
    fs, where = _file_system(spark, f"{path.rstrip('/')}/batch=*")
    return list(fs.globStatus(where) or [])


def append_manifest(rows: DataFrame, path: str, batch: str) -> bool:
    """Appends a batch's manifest rows; a sample that an earlier batch has is not written again."""
    return append_once(rows, path, batch, ["sample_id"])


def read_appended_manifest(spark: SparkSession, path: str) -> DataFrame:
    return read_appended(spark, path, "json", ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in MANIFEST))


def write_summary(row: DataFrame, path: str, append: bool = True) -> None:
    """A run's wide row as CSV with header; absent cells are empty.  ``append_once`` with form csv does it once a run."""
    row.coalesce(1).write.mode("append" if append else "overwrite").option("header", True).option("emptyValue", "").csv(path)


def read_summaries(spark: SparkSession, path: str) -> DataFrame:
    """All summary rows, however they were appended."""
    return read_appended(spark, path, "csv").drop("batch") if _batches(spark, path) else spark.read.csv(path, header=True)


def write_report(parts: dict[str, DataFrame], path: str) -> None:
    for name, df in parts.items():
        df.write.mode("overwrite").json(f"{path}/{name}")


def write_dataset(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").partitionBy("split").parquet(path)


def read_dataset_splits(spark: SparkSession, folder: str) -> DataFrame:
    """Rows of train.jsonl, val.jsonl and test.jsonl below folder; a missing one is left out, none at all is an error.

    A row without a split takes its file's.
    """
    known = {name: f"{folder.rstrip('/')}/{name}.jsonl" for name in ("train", "val", "test")}
    there = {name: path for name, path in known.items() if exists(spark, path)}
    if not there:
        raise FileNotFoundError(f"no split files below {folder}")
    out = None
    for name, path in there.items():
        rows = read_manifest(spark, path).withColumn("split", F.coalesce("split", F.lit(name)))
        out = rows if out is None else out.unionByName(rows)
    return out
