"""Special codes to null, and counting nulls in a row."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F


def negative_to_null(code: Column) -> Column:
    """Codes of -1 and below become null; values between -1 and 0 stay."""
    return F.when(~(code <= -1), code)


def values_to_null(code: Column, values: Iterable) -> Column:
    """The listed codes become null."""
    return F.when(~code.isin(list(values)), code)


def keep_valid_values(code: Column, values: Iterable) -> Column:
    """Every code that is not listed becomes null."""
    return F.when(code.isin(list(values)), code)


def is_null_or_in(code: Column, values: Iterable) -> Column:
    """Membership in a set that also accepts null."""
    return code.isNull() | code.isin(list(values))


def row_missing_count(columns: Iterable[str | Column]) -> Column:
    """Number of null columns in the row."""
    flags = [F.isnull(c).cast("int") for c in columns]
    return reduce(add, flags, F.lit(0))
