"""Stacking sources and minima over groups."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelweave.operators.levels import KEY, merged


def stack(frames: Sequence[DataFrame]) -> DataFrame:
    """Union by column name; columns a frame lacks are null. Orders of labels are kept, and must agree."""
    union = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    levels: dict[str, dict[str, list[str]]] = {}
    for f in (f for df in frames for f in df.schema.fields):
        if own := f.metadata.get(KEY):
            levels[f.name] = merged([levels.get(f.name, {}), own])
    if not levels:
        return union
    cells = {c: F.col(f"`{c}`").alias(c, metadata={KEY: own}) for c, own in levels.items()}
    return union.select(*[cells.get(c, F.col(f"`{c}`")) for c in union.columns])


def side_by_side(parts: Sequence[DataFrame]) -> DataFrame:
    """The rows of many parts below each other, null where a part lacks a column: `stack` in one step.

    Columns of one name have one type; the first part that has a column gives it.
    """
    kinds = {name: kind for part in reversed(parts) for name, kind in part.dtypes}
    rows = []
    for part in parts:
        own = set(part.columns)
        rows.append(part.selectExpr(*[name if name in own else f"CAST(NULL AS {kind}) AS {name}" for name, kind in kinds.items()]))
    return reduce(DataFrame.unionAll, rows)


def stack_tagged(frames: Mapping[object, DataFrame], tag: str) -> DataFrame:
    """Union by column name with a column that says which source a row comes from."""
    return stack([f.select(F.lit(key).alias(tag), "*") for key, f in frames.items()])


def group_min(df: DataFrame, keys: Sequence[str], column: str, name: str) -> DataFrame:
    """Smallest value per key, e.g. the most advantaged class of a household."""
    return df.groupBy(*keys).agg(F.min(column).alias(name))
