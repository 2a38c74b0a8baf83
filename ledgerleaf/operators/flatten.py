"""Nested records to flat cells and back.

A struct's known schema is walked when the plan is built, so a flat row is one array of (pos, key, value) made by
built-in expressions.  JSON of unknown shape goes through an Arrow UDF.
"""

from __future__ import annotations

import functools
import json
import re
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

CELL = T.ArrayType(T.StructType([T.StructField("key", T.StringType()), T.StructField("value", T.StringType())]))


def _leaf(c: Column, kind: T.DataType) -> Column:
    if isinstance(kind, T.BooleanType):
        return F.when(c, "YES").when(~c, "NO").otherwise("")
    return F.coalesce(c.cast("string"), F.lit(""))


def _item(c: Column, kind: T.DataType) -> Column:
    if isinstance(kind, T.BooleanType):
        return F.when(c, "True").when(~c, "False")
    return c.cast("string")


def _one(key: Column, value: Column) -> Column:
    return F.array(F.struct(key.alias("key"), value.alias("value")))


def _walk(c: Column, kind: T.DataType, key: Column) -> Column:
    if isinstance(kind, T.StructType):
        parts = [_walk(c[f.name], f.dataType, F.concat(key, F.lit("." + f.name))) for f in kind.fields]
        return F.when(c.isNull(), _one(key, F.lit(""))).otherwise(F.concat(*parts)) if parts else _one(key, F.lit(""))
    if isinstance(kind, T.ArrayType):
        blank = c.isNull() | (F.size(c) == 0)
        if isinstance(kind.elementType, (T.StructType, T.ArrayType)):
            items = F.flatten(F.transform(c, lambda x, i: _walk(x, kind.elementType, F.concat(key, F.lit("["), i.cast("string"), F.lit("]")))))
            return F.when(blank, _one(key, F.lit(""))).otherwise(items)
        joined = F.array_join(F.transform(c, lambda x: _item(x, kind.elementType)), " | ", "")
        return _one(key, F.when(blank, "").otherwise(joined))
    return _one(key, _leaf(c, kind))


def flat_cells(struct: Column, schema: T.StructType) -> Column:
    """array<struct<key, value>> of a struct in source order."""
    parts = [_walk(struct[f.name], f.dataType, F.lit(f.name)) for f in schema.fields]
    return F.concat(*parts) if parts else _one(F.lit(""), F.lit(""))


def explode_cells(df: DataFrame, cells: Column, *keep: str) -> DataFrame:
    """(keep.., pos, key, value), a row for each cell."""
    return df.select(*keep, F.posexplode(cells).alias("pos", "x")).select(*keep, "pos", F.col("x.key").alias("key"), F.col("x.value").alias("value"))


# ---------------------------------------------------------------- unknown shape
def _text(x, in_list: bool = False) -> str:
    if x is None:
        return ""
    if isinstance(x, bool) and not in_list:
        return "YES" if x else "NO"
    return str(x)


def _flat(x, prefix: str) -> Iterator[tuple[str, str]]:
    if isinstance(x, dict) and x:
        for k, v in x.items():
            yield from _flat(v, f"{prefix}.{k}" if prefix else str(k))
    elif isinstance(x, list) and any(isinstance(v, (dict, list)) for v in x):
        for i, v in enumerate(x):
            yield from _flat(v, f"{prefix}[{i}]")
    elif isinstance(x, list):
        yield prefix, " | ".join(_text(v, True) for v in x)
    else:
        yield prefix, "" if isinstance(x, dict) else _text(x)


@F.pandas_udf(CELL)
def flat_json(texts: pd.Series) -> pd.Series:
    """Cells of a JSON document in source order; NULL where it is no JSON."""

    def one(t):
        try:
            return [{"key": k, "value": v} for k, v in _flat(json.loads(t), "")]
        except (TypeError, ValueError):
            return None

    return texts.map(one)


def steps_of(path: str) -> list:
    """Names and list positions of a path: "a.b[2].c" is ["a", "b", 2, "c"]."""
    out: list = []
    for part in path.split("."):
        name, bracket, number = part.rpartition("[")
        if bracket and number.endswith("]") and number[:-1].isdecimal():
            out += [name, int(number[:-1])]
        else:
            out.append(part)
    return out


def _level(steps: list) -> str:
    return "value" if not steps else "list" if isinstance(steps[0], int) else "object"


def _built(items: list[tuple[list, str]]):
    """The value that items (remaining steps, text) make, groups of equal first steps first.

    Items that want different things at one place, a text, an object or a list, follow each other: the last kind holds, from
    where it began.
    """
    kind, first = _level(items[-1][0]), len(items)
    while first and _level(items[first - 1][0]) == kind:
        first -= 1
    if kind == "value":
        return items[-1][1]
    groups: dict = {}
    for steps, text in items[first:]:
        groups.setdefault(steps[0], []).append((steps[1:], text))
    made = {step: _built(rows) for step, rows in groups.items()}
    return made if kind == "object" else [made.get(i, {}) for i in range(max(made) + 1)]


def unflat(cells: list[tuple[str, str]]) -> dict:
    """Nested form of flat cells: dots make objects, [i] makes lists (gaps become {})."""
    return _built([(steps_of(path), text) for path, text in cells]) if cells else {}


@F.pandas_udf(T.StringType())
def unflat_json(keys: pd.Series, values: pd.Series) -> pd.Series:
    """JSON of the nested form of parallel lists of keys and values."""
    return pd.Series([json.dumps(unflat(list(zip(k, v))), ensure_ascii=False) for k, v in zip(keys, values)])


def unflat_lines(cells: DataFrame, row: str, box: str, names: list[str]) -> DataFrame:
    """(row, lines): cells of box[i].name put together as an array of structs in order of i; all built-in."""
    part = F.regexp_extract("key", rf"^{re.escape(box)}\[([0-9]+)\]\.(.+)$", 1)
    name = F.regexp_extract("key", rf"^{re.escape(box)}\[([0-9]+)\]\.(.+)$", 2)
    lines = cells.where(part != "").withColumn("_i", part.try_cast("int")).withColumn("_n", name)
    wide = lines.groupBy(row, "_i").agg(*(F.coalesce(F.max(F.when(F.col("_n") == n, F.col("value"))), F.lit("")).alias(n) for n in names))
    return wide.groupBy(row).agg(F.array_sort(F.collect_list(F.struct("_i", *names))).alias("x")).select(
        row,
        F.transform("x", lambda s: F.struct(*(s[n].alias(n) for n in names))).alias("lines"),
    )


# ---------------------------------------------------------------- as rows, and back by levels
@F.arrow_udf(CELL)
def flat_json_batch(texts: pa.Array) -> pa.Array:
    """``flat_json`` by Arrow batch: no object of its own for a cell."""
    starts, keys, values = [0], [], []
    known = []
    for t in texts.to_pylist():
        try:
            cells = list(_flat(json.loads(t), ""))
        except (TypeError, ValueError):
            cells = None
        known.append(cells is not None)
        for key, value in cells or ():
            keys.append(key)
            values.append(value)
        starts.append(len(keys))
    cells = pa.StructArray.from_arrays([pa.array(keys, pa.string()), pa.array(values, pa.string())], ["key", "value"])
    return pa.ListArray.from_arrays(pa.array(starts, pa.int32()), cells, mask=pa.array([not k for k in known], pa.bool_()))


def flat_rows(df: DataFrame, column: str, *keep: str) -> DataFrame:
    """(keep.., pos, key, value) of a column of JSON texts of any shape: a row for each leaf, in source order; none where it is no JSON."""
    return explode_cells(df.select(*keep, flat_json_batch(column).alias("_cells")), F.col("_cells"), *keep)


_STEP = re.compile(r"\[([0-9]+)\]|([^.\[\]]+)")


@functools.lru_cache(maxsize=1 << 16)
def _path(key: str) -> list:
    """Names and places of a path; any number of places may follow each other."""
    return [int(place) if place else name for place, name in _STEP.findall(key)]


@F.arrow_udf(T.StringType())
def _documents(cells: pa.Array) -> pa.Array:
    """JSON of lists of cells (pos, key, value), each in order of pos."""
    starts, flat = cells.offsets.to_pylist(), cells.values
    pos, keys, values = (flat.field(i).to_pylist() for i in range(3))
    out = []
    for a, b in zip(starts, starts[1:]):
        items = [(_path(keys[i]), values[i] or "") for i in sorted(range(a, b), key=pos.__getitem__)]
        out.append(json.dumps(_built(items), ensure_ascii=False, separators=(",", ":")))
    return pa.array(out, pa.string())


def nested_json(cells: DataFrame, row: str, leaves: str | None = None) -> DataFrame:
    """(row, doc): the documents that flat cells (row, pos, key, value) make, as JSON texts of objects, lists and texts.

    Paths are taken apart into names and [places]; what lies at one path becomes an object, in order of pos, or a list, in order of its
    places (missing ones are {}).  The cells meet once, by row, however deep they lie.  ``leaves`` names a column for the count of a document's cells.
    A row's cells must agree on what is an object, a list or a text; names hold no dots or brackets, and a cell without a name makes no document.
    """
    met = cells.where(F.col("key").rlike(r"[^.\[\]]")).groupBy(row).agg(F.collect_list(F.struct("pos", "key", "value")).alias("_cells"))
    return met.select(row, _documents("_cells").alias("doc"), *([F.size("_cells").cast("long").alias(leaves)] if leaves else []))
