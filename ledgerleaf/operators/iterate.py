"""Rows of a split one after the other, for a training loop that reads as it goes."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F


def iter_rows(rows: DataFrame, order: str = "row_idx", most_rows: int = 10_000, prefetch: bool = True) -> Iterator[Row]:
    """Rows in ascending order, a partition at a time.

    Partitions are ranges of the order column of about ``most_rows`` rows; the driver holds one, and with prefetch the next while the first is used.
    Rows of one order stay together, so many of them make a larger partition.  Nothing runs before the first row is asked for, and what the loop
    does not ask for is not computed beyond the partition ahead.  Null orders come first.
    """
    n = rows.select(F.count("*")).first()[0]
    parts = max(1, -(-n // most_rows))
    ordered = rows.repartitionByRange(parts, F.asc(order)).sortWithinPartitions(F.asc(order))
    yield from ordered.toLocalIterator(prefetchPartitions=prefetch)
