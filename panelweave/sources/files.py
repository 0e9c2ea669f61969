"""Loading the survey files a rule needs."""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelweave.functions.names import select_matches, strip_suffix
from panelweave.operators.combine import stack
from panelweave.operators.joins import full_join_all, label_codes
from panelweave.operators.reshape import unpivot_multi_value


@dataclass(frozen=True)
class Variable:
    """A catalogue row without its labels."""

    fld: str
    dta: str
    variable: str
    file_path: str

    @property
    def var_low(self) -> str:
        return self.variable.lower()


class SurveyFiles:
    """The files of one study: find variables by pattern, then read only those.

    `read` opens a file by its path; `labels` holds (file_path, variable, code, label). `by_person` says that what
    is loaded by person comes in buckets of persons.
    """

    by_person = False

    def __init__(
        self, variables: Sequence[Variable], read: Callable[[str], DataFrame], labels: DataFrame | None = None
    ):
        self.variables = list(variables)
        self.open = read
        self.labels = labels

    @classmethod
    def from_catalog(cls, spark: SparkSession, catalog: DataFrame, study: str, labels: DataFrame) -> SurveyFiles:
        """Files of a stored study; only names and paths come to the driver, never data."""
        found = catalog.filter(F.col("study") == study).select("fld", "dta", "variable", "file_path")
        rows = found.orderBy("file_path", "pos").collect()
        mine = labels.filter(F.col("study") == study).drop("study")
        return cls([Variable(*r) for r in rows], lambda path: read_with_row(spark, path), mine)

    @classmethod
    def from_frames(cls, frames: Mapping[str, DataFrame], labels: DataFrame | None = None) -> SurveyFiles:
        """Files held as DataFrames, named `folder/file`."""
        variables = [
            Variable(path.rpartition("/")[0], path.rpartition("/")[2], column, path)
            for path, df in frames.items()
            for column in df.columns
            if column != "_row"
        ]
        return cls(variables, frames.__getitem__, labels)

    def search(
        self, variable: str = "", var_low: str = "", dta: str = "", fld: str = "", exclude: Callable | None = None
    ) -> list[Variable]:
        """Variables whose name, lower-case name, file and folder contain the patterns."""
        return [
            v
            for v in self.variables
            if re.search(variable, v.variable)
            and re.search(var_low, v.var_low)
            and re.search(dta, v.dta)
            and re.search(fld, v.fld)
            and not (exclude and exclude(v))
        ]

    def load(self, path: str, ids: str, variables: Sequence[str] | None = None, row: bool = False) -> DataFrame:
        """Columns matching `ids` and the wanted ones (all if None) of a file, names in lower case."""
        df = self.open(path)
        names = [c for c in df.columns if c != "_row"]
        keys = select_matches(names, ids)
        rest = [c for c in names if c not in keys and (variables is None or c in variables)]
        return df.selectExpr(*[f"`{c}` AS `{c.lower()}`" for c in keys + rest], *(["_row"] if row else []))

    def load_joined(self, found: Sequence[Variable], iid: str) -> DataFrame:
        """The variables of all files side by side, files joined on the person."""
        files = [self.load(path, f"^{iid}$", names) for path, names in chop(found).items()]
        return full_join_all(files, [iid])

    def load_stacked(
        self,
        found: Sequence[Variable],
        ids: str,
        iid: str,
        suffix: str | None = None,
        per_variable: bool = False,
    ) -> DataFrame:
        """The variables of all files below each other, one row per person and sweep letter.

        The first character of a name is the sweep, the rest the variable. `_file` and `_row` give
        each row its place in the input.
        """
        parts = [(v.file_path, [v.variable]) for v in found] if per_variable else list(chop(found).items())
        frames = []
        for ordinal, (path, names) in enumerate(parts):
            df = self.load(path, ids, names, row=True)
            if suffix:
                df = df.withColumnsRenamed(strip_suffix(df.columns, suffix))
            long = unpivot_multi_value(df, [iid], keep=["_row"])
            frames.append(long.withColumn("_file", F.lit(ordinal)))
        return stack(frames)

    def file_label(self, df: DataFrame, variable: Variable, column: str) -> DataFrame:
        """Replace a code by the label the file gives it; a code without label stays as its number."""
        labels = self.labels.filter(
            (F.col("file_path") == variable.file_path) & (F.col("variable") == variable.variable)
        )
        return label_codes(df, F.broadcast(labels) if self.by_person else labels, column)


def chop(found: Sequence[Variable]) -> dict[str, list[str]]:
    """File to its wanted variables, in catalogue order."""
    files: dict[str, list[str]] = {}
    for v in found:
        files.setdefault(v.file_path, []).append(v.variable)
    return files


def read_with_row(spark: SparkSession, path: str) -> DataFrame:
    """A Parquet survey file with its physical place, unless it carries one: part and row within it."""
    df = spark.read.parquet(path)
    if "_row" in df.columns:
        return df
    return df.select("*", F.struct(F.col("_metadata.file_path"), F.col("_metadata.row_index")).alias("_row"))
