"""Ordered categories: the order of a column's labels, carried in the column's metadata.

A column of one attribute holds its list of labels; an unpivoted column of many holds a list for each name.
Selections, filters, joins and group keys keep a column's metadata; what loses it (aggregates) or mixes
columns (unpivots, unions) passes it on with the functions here.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KEY = "levels"


def with_levels(df: DataFrame, levels: Mapping[str, Sequence[str]]) -> DataFrame:
    """The same rows; the columns named hold the order of their labels."""
    own = {c: labels for c, labels in levels.items() if c in df.columns}
    if not own:
        return df
    return df.select(*[F.col(f"`{c}`").alias(c, metadata={KEY: {c: list(own[c])}}) if c in own else F.col(f"`{c}`") for c in df.columns])


def levels_of(*frames: DataFrame) -> dict[str, list[str]]:
    """Name to ordered labels, of all columns of all tables; two orders for one name are an error."""
    return merged(f.metadata.get(KEY, {}) for df in frames for f in df.schema.fields)


def merged(found: Iterable[Mapping[str, Sequence[str]]]) -> dict[str, list[str]]:
    out: dict[str, list[str]] = {}
    for levels in found:
        for name, labels in levels.items():
            if out.setdefault(name, list(labels)) != list(labels):
                raise ValueError(f"two orders of the labels of {name!r}: {out[name]} and {list(labels)}")
    return out


def value_with_levels(df: DataFrame, levels: Mapping[str, Sequence[str]], value: str = "value") -> DataFrame:
    """An unpivoted table whose value column holds the order of the labels of each name."""
    if not levels:
        return df
    carried = F.col(value).alias(value, metadata={KEY: {n: list(v) for n, v in levels.items()}})
    return df.select(*[carried if c == value else F.col(f"`{c}`") for c in df.columns])
