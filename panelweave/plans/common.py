"""Steps shared by the study plans."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelweave.functions.recode import Recode, code_to_category, lookup, recode_sources
from panelweave.operators.levels import with_levels
from panelweave.operators.reshape import unpivot
from panelweave.plans.dictionaries import CATEGORIES
from panelweave.sources.files import SurveyFiles


@dataclass(frozen=True)
class Study:
    """A harmonised study: `keys` name a person, `clean` holds one table per attribute group.

    `children`, if given, are all child numbers that respondents can have.
    """

    name: str
    keys: Sequence[str]
    sample: DataFrame
    response: DataFrame
    clean: Mapping[str, DataFrame]
    children: Sequence[int] | None = None


def clean_tables(files: SurveyFiles, rules: Sequence[Callable[[SurveyFiles], DataFrame]]) -> dict[str, DataFrame]:
    """The tables of all rules by name, their columns with the order of their categories."""
    return {rule.__name__: with_levels(rule(files), CATEGORIES) for rule in rules}


def load(files: SurveyFiles, iid: str, **search) -> DataFrame:
    """The variables found, side by side, with the person in `pid`."""
    return files.load_joined(files.search(**search), iid).withColumnRenamed(iid, "pid")


def with_iid(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Add the panel's person id: the person keys in one column."""
    return df.withColumn("iid", F.col(keys[0]) if len(keys) == 1 else F.concat_ws("_", *keys))


def responded(outcomes: DataFrame, ages: Mapping[str, int]) -> DataFrame:
    """Persons and ages whose outcome is 1; `ages` gives the age of each outcome column."""
    age = lookup(F.col("name"), ages)
    long = unpivot(outcomes, ["pid"], columns=list(ages)).filter("value = 1")
    return with_iid(long.select("pid", age.alias("fup")), ["pid"])


def by_age(
    df: DataFrame,
    attribute: str,
    labels: Sequence[str],
    ages: Mapping[int, Sequence[tuple] | Column] | Sequence[tuple[int, Sequence[tuple] | Column]],
) -> DataFrame:
    """One row per person and entry of `ages`, which gives an age and its code.

    A code is a ready column or a list of sources as (column, recode). Two entries of one age give two
    rows. All entries come from one projection.
    """
    entries = ages.items() if isinstance(ages, Mapping) else ages
    cells = []
    for age, code in entries:
        code = code if isinstance(code, Column) else recode_sources(*((F.col(c), recode) for c, recode in code))
        cells.append(F.struct(F.lit(age).alias("fup"), code.cast("double").alias(attribute)))
    return categorise(df.select("pid", F.inline(F.array(*cells))), attribute, labels)


def once(df: DataFrame, attribute: str, labels: Sequence[str], *sources: tuple[str, Recode]) -> DataFrame:
    """One row per person: an attribute asked once."""
    code = recode_sources(*((F.col(c), recode) for c, recode in sources))
    return df.select("pid", code_to_category(code, labels).alias(attribute))


def categorise(df: DataFrame, attribute: str, labels: Sequence[str]) -> DataFrame:
    """Codes in the attribute column to their labels."""
    return df.withColumn(attribute, code_to_category(F.col(attribute), labels))
