"""Keyed look-up of code sets: tables of at most a few hundred rows, broadcast."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A code set is a bounded table by its nature; more rows than this are an error and not a broadcast.
MOST_CODES = 100_000


def described(rows: DataFrame, codes: DataFrame, code: str, name: str = "description") -> DataFrame:
    """rows with the description of their code; a code that the set does not have reads as blank, the first of equal codes counts.

    codes: (ordinal, code, description), as ``sources.files.read_codes`` gives them.
    """
    one = codes.groupBy("code").agg(F.min_by("description", "ordinal").alias("_said")).withColumnRenamed("code", "_code")
    n = one.limit(MOST_CODES + 1).count()
    if n > MOST_CODES:
        raise ValueError(f"more than {MOST_CODES} codes")
    return rows.join(F.broadcast(one), F.col(code) == F.col("_code"), "left").withColumn(name, F.coalesce("_said", F.lit(""))).drop("_code", "_said")
