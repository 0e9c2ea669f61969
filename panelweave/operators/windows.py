"""First observations, first rows and surrogate ids."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelweave.functions.names import fresh
from panelweave.sources.store import store


def earliest_with_ties(df: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """The rows of each key at its smallest `order` value, ties kept.

    One scan and one shuffle: Spark limits each group to its rank before the shuffle too, so of a key
    with very many rows only the earliest of each task cross it. Nulls come last.
    """
    w = Window.partitionBy(*keys).orderBy(F.col(order).asc_nulls_last())
    return df.withColumn("__rank", F.rank().over(w)).filter("__rank = 1").drop("__rank")


def first_per_group(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """The first row of each key in a declared order.

    Spark limits each group to its first row on both sides of the shuffle.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__row", F.row_number().over(w)).filter("__row = 1").drop("__row")


def surrogate_id(df: DataFrame, key: str, name: str = "iid", parts: int | None = None, rows_per_part: int = 1_000_000) -> DataFrame:
    """Number the rows 1, 2, 3, ... in the order of a unique key, without one global sort.

    Rows go into ranges of the key, one for each rows_per_part rows, and are stored sorted with their place:
    the range and the row within it. A row's number is its place in its range plus the rows of all earlier
    ranges, of which there is one count each. A null key comes first; other columns may have any names.
    """
    place, part, before = fresh("__place", df.columns), fresh("__part", df.columns), fresh("__before", df.columns)
    parts = parts or df.select(key).count() // rows_per_part + 1
    sorted_rows = df.repartitionByRange(parts, key).sortWithinPartitions(key)
    stored = store(sorted_rows.withColumn(place, F.monotonically_increasing_id()), "numbered")
    # the upper bits of the place are the range, the lower 33 the row within it
    ranged = stored.withColumn(part, F.shiftright(place, 33))
    earlier = F.sum("n").over(Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1))  # a row per range
    offsets = ranged.groupBy(part).agg(F.count("*").alias("n")).select(part, F.coalesce(earlier, F.lit(0)).alias(before))
    within = F.col(place).bitwiseAND((1 << 33) - 1)
    return ranged.join(offsets, part).withColumn(name, F.col(before) + within + 1).drop(place, part, before)
