"""Unpivoting, pivoting, replicating, lists and grids."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelweave.functions.names import fresh, select_matches
from panelweave.operators.levels import levels_of, value_with_levels


def unpivot(
    df: DataFrame, ids: Sequence[str], name: str = "name", value: str = "value", columns: Sequence[str] | None = None
) -> DataFrame:
    """One row per (id, column). Text and numeric columns mixed come out as text; orders of labels are kept."""
    columns = list(columns) if columns else [c for c in df.columns if c not in ids]
    types = {df.schema[c].dataType for c in columns}
    if len(types) > 1 and T.StringType() in types:
        df = df.withColumns({c: F.col(c).cast("string") for c in columns})
    levels = levels_of(df.select(*[F.col(f"`{c}`") for c in columns]))
    return value_with_levels(rows_of(df, ids, columns, name, value), levels, value)


def rows_of(df: DataFrame, ids: Sequence[str], columns: Sequence[str], name: str, value: str) -> DataFrame:
    """One row per (id, column), the column's name in `name`. Rows stay where they are, so those stored by person stay so."""
    kind = common_type(df, columns)
    cells = [F.struct(F.lit(c).alias(name), F.col(f"`{c}`").cast(kind).alias(value)) for c in columns]
    return df.select(*[F.col(f"`{c}`") for c in ids], F.inline(F.array(*cells)))


def common_type(df: DataFrame, columns: Sequence[str]) -> T.DataType:
    """The type that holds all columns: text if any is text, else what Spark widens them to."""
    types = [df.schema[c].dataType for c in columns]
    if len(set(types)) == 1:
        return types[0]
    if T.StringType() in types:
        return T.StringType()
    return df.select(F.coalesce(*[F.col(f"`{c}`") for c in columns])).schema[0].dataType


def unpivot_multi_value(
    df: DataFrame, ids: Sequence[str], pattern: str = "(.)(.*)", tag: str = "sweep", keep: Sequence[str] = ()
) -> DataFrame:
    """Split column names into (tag, stem): one row per id and tag, one column per stem.

    A stem that a tag does not have is null there. Columns in `keep` are carried along unsplit. Types
    that differ are widened as Spark widens them; text and numbers come out as text.
    """
    stems: dict[str, dict[str, str]] = {}
    for column in df.columns:
        if column in ids or column in keep:
            continue
        found = re.search(pattern, column)
        if found is None:
            raise ValueError(f"column {column!r} does not match {pattern!r}")
        stems.setdefault(found.group(1), {})[found.group(2)] = column
    names = list(dict.fromkeys(stem for columns in stems.values() for stem in columns))
    types = {s: common_type(df, [c[s] for c in stems.values() if s in c]) for s in names}

    def row(key: str, columns: dict[str, str]) -> Column:
        cells = [
            (F.col(columns[s]) if s in columns else F.lit(None)).cast(types[s]).alias(s) for s in names
        ]
        return F.struct(F.lit(key).alias(tag), *cells)

    rows = F.array(*[row(key, columns) for key, columns in stems.items()])
    return df.select(*ids, *keep, F.inline(rows))


def clean_to_long(df: DataFrame, prefix: str, ids: Sequence[str]) -> DataFrame:
    """Columns `<prefix>_<digits>` to rows (id, fup, <prefix>), fup being the digits."""
    columns = select_matches(df.columns, rf"{prefix}_\d")
    suffix = F.regexp_replace("fup", f"^{prefix}_", "")
    return rows_of(df, ids, columns, "fup", prefix).withColumn("fup", suffix.try_cast("int"))


def pivot_wider(df: DataFrame, keys: Sequence[str], names: str, value: str, levels: Sequence[str]) -> DataFrame:
    """One column per level of `names`; the levels are given, so no extra pass finds them."""
    return df.groupBy(*keys).pivot(names, list(levels)).agg(F.first(value, ignorenulls=True))


BLOCK = 1000  # copies that one generator step makes of a row
LEVELS = 5  # of blocks: BLOCK ** (LEVELS + 1) copies of a row at most in lists of BLOCK items


def deal_copies(df: DataFrame, n: str, index: str | None = None, deal: bool = False) -> DataFrame:
    """Repeat each row as often as its column `n` says, which goes; rows with n below 1 or null vanish.

    Copies are made block by block, the block's number first and then the rest, so no array of all
    copies stands in one row. `index` numbers them from 1. With `deal`, the blocks of rows with very many copies are
    spread over the tasks; the other rows stay where they are.
    """
    block, size = fresh("__block", df.columns), fresh("__size", df.columns)
    rest = [F.col(f"`{c}`") for c in df.columns if c != n]
    count = F.col(f"`{n}`").cast("long")
    rows = df.where(count >= 1).select(*rest, F.lit(0).cast("long").alias(block), count.alias(size))

    def in_blocks(rows: DataFrame) -> DataFrame:
        for level in range(LEVELS, 0, -1):
            width = F.lit(BLOCK**level).cast("long")
            first = F.transform(F.expr(f"sequence(0L, (`{size}` - 1) div {BLOCK**level}L)"), lambda i: i * width)  # noqa: B023
            parts = F.transform(first, lambda i: F.struct((F.col(block) + i).alias(block), F.least(width, F.col(size) - i).alias(size)))  # noqa: B023
            whole = F.array(F.struct(F.col(block), F.col(size)))  # a row with few copies is one block without any list being made
            rows = rows.select(*rest, F.inline(F.when(F.col(size) <= width, whole).otherwise(parts)))
        return rows

    if deal:
        parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        dealt = in_blocks(rows.where(F.col(size) > BLOCK)).repartition(parts, F.col(block), F.monotonically_increasing_id())
        rows = rows.where(F.col(size) <= BLOCK).unionAll(dealt)
    else:
        rows = in_blocks(rows)
    copies = rows.select(*rest, F.explode(F.sequence(F.col(block) + 1, F.col(block) + F.col(size))).alias(index or block))
    return copies if index else copies.drop(block)


def uncount(df: DataFrame, n: Column | int, index: str) -> DataFrame:
    """Repeat each row `n` times, numbered from 1; rows with n below 1 or null vanish."""
    n = F.lit(n) if isinstance(n, int) else n
    times = fresh("__n", [*df.columns, index])
    copies = deal_copies(df.withColumn(times, n.cast("int")), times, index)
    return copies.withColumn(index, F.col(index).cast("int"))


def spread_over(df: DataFrame, values: Sequence[int], name: str) -> DataFrame:
    """Each row once per value of a short fixed list, such as the ages of a study."""
    return df.withColumn(name, F.explode(F.array(*[F.lit(v) for v in values])))


def chop_runs(df: DataFrame, keys: Sequence[str], column: str, into: str) -> DataFrame:
    """Collapse the rows of a key to a sorted list of (value, times).

    Equal values are counted before the shuffle, so the list of a key is as long as the column has
    different values, however many rows the key holds.
    """
    counted = df.groupBy(*keys, column).agg(F.count("*").alias("times"))
    entry = F.struct(F.col(column).alias("value"), F.col("times"))
    return counted.groupBy(*keys).agg(F.array_sort(F.collect_list(entry)).alias(into))


def unchop_runs(df: DataFrame, column: str, name: str) -> DataFrame:
    """Expand a list of (value, times) back to rows; empty lists vanish."""
    others = [c for c in df.columns if c != column]
    value, times = fresh("__value", others), fresh("__times", others)
    runs = df.select(*others, F.inline(column).alias(value, times))
    return deal_copies(runs, times, deal=True).select(*others, F.col(value).alias(name))


def window_grid(df: DataFrame, first: str = "first", last: str = "last") -> DataFrame:
    """Each row once per window (low, high) with first <= low <= high <= last."""
    lows = df.withColumn("low", F.explode(F.sequence(F.col(first), F.col(last))))
    return lows.withColumn("high", F.explode(F.sequence(F.col("low"), F.col(last))))


def sweeps_inside(ages: Column, low: Column, high: Column) -> Column:
    """The ages of a calendar that lie in a window."""
    return F.filter(ages, lambda age: (age >= low) & (age <= high))


def window_sweep_sets(calendar: DataFrame) -> DataFrame:
    """Group the windows of each study by the set of sweeps they contain.

    `calendar` has one row per study: `study`, its `ages`, and the bounds `first` and `last` of the
    grid. Windows without a sweep are dropped.
    """
    inside = sweeps_inside(F.col("ages"), F.col("low"), F.col("high"))
    cells = window_grid(calendar).withColumn("fups", inside)
    return (
        cells.filter(F.size("fups") > 0)
        .groupBy("study", "fups")
        .agg(F.array_sort(F.collect_list(F.struct("low", "high"))).alias("windows"))
    )
