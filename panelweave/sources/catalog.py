"""The variable catalogue: one row per study, folder, file and variable."""

from __future__ import annotations

import json
import sys
from collections.abc import Iterator, Mapping, Sequence
from functools import reduce

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelweave.functions.names import remove_first

# the reading functions travel with the tasks, executors need no copy of this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

FOOTER = (
    "file_path string, fld string, dta string, pos int, variable string, label string, col_type string, "
    "value_labels array<struct<label:string,code:double>>"
)
SPARK_SCHEMA = b"org.apache.spark.sql.parquet.row.metadata"


def study_roots(settings: Mapping[str, str], ending: str = "_fld") -> dict[str, str]:
    """Study to root folder, from settings whose names end in `_fld`."""
    return {k.removesuffix(ending): str(v) for k, v in settings.items() if k.endswith(ending)}


def find_files(spark: SparkSession, root: str, extension: str) -> DataFrame:
    """All files below a folder with the extension; no content is read.

    A folder with the extension, as Spark writes them, is one file of several parts: `file_path` is
    the folder and `part` the first of them, which has the header of all.
    """
    found = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", f"*.{extension}")
        .load(root)
        .select("path")
    )
    above = F.substring_index("path", root.rstrip("/") + "/", 1)
    below = F.expr("substring(path, char_length(above) + 1)")
    whole = F.concat("above", F.regexp_extract(below, rf"^(.*?\.{extension})(/|$)", 1))
    return found.withColumn("above", above).groupBy(whole.alias("file_path")).agg(F.min("path").alias("part"))


def split_path(files: DataFrame, root: str, extension: str) -> DataFrame:
    """Folder and file name below the root; files of the root itself have no folder and are dropped.

    So are the files of folders that start with UKDS.
    """
    below = F.substring_index("file_path", root.rstrip("/") + "/", -1)
    parts = F.split(F.reverse(below), "/", 2)
    return (
        files.withColumn("__parts", parts)
        .withColumn("dta", remove_first(F.reverse(F.get("__parts", F.lit(0))), rf"\.{extension}$"))
        .withColumn("fld", F.reverse(F.get("__parts", F.lit(1))))
        .drop("__parts")
        .filter(~F.col("fld").rlike("^UKDS"))
    )


def _type_name(kind: str) -> str:
    short = {"string": "chr", "double": "dbl", "float": "dbl", "bool": "lgl"}
    if kind.startswith("timestamp"):
        return "dttm"
    if kind.startswith("list"):
        return "list"
    return short.get(kind, "int" if kind.startswith(("int", "uint")) else kind)


def _footers(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    import pyarrow.parquet as pq
    from pyarrow import fs

    for batch in batches:
        for path, part, fld, dta in batch[["file_path", "part", "fld", "dta"]].itertuples(index=False):
            filesystem, name = fs.FileSystem.from_uri(part)
            schema = pq.read_schema(name, filesystem=filesystem)
            stored = (schema.metadata or {}).get(SPARK_SCHEMA)
            fields = json.loads(stored)["fields"] if stored else []
            notes = {f["name"]: f.get("metadata") or {} for f in fields}
            yield pd.DataFrame(
                {
                    "file_path": path,
                    "fld": fld,
                    "dta": dta,
                    "pos": range(1, len(schema.names) + 1),
                    "variable": schema.names,
                    "label": [notes.get(n, {}).get("label") for n in schema.names],
                    "col_type": [_type_name(str(t)) for t in schema.types],
                    "value_labels": [notes.get(n, {}).get("value_labels") or None for n in schema.names],
                }
            )


def parquet_headers(paths: DataFrame) -> DataFrame:
    """One row per column of each Parquet file; the footers are read in parallel tasks, one per file."""
    return paths.select("file_path", "part", "fld", "dta").mapInPandas(_footers, FOOTER)


def catalog_variables(
    spark: SparkSession, roots: Mapping[str, str], extension: str = "parquet", below: str = ""
) -> DataFrame:
    """The catalogue of all studies; `below` limits the search to a subfolder of each root."""
    from panelweave.sources.stata import stata_headers

    studies = []
    for study, root in roots.items():
        root = root.replace("file:///", "/")  # as listed paths show it
        files = split_path(find_files(spark, f"{root.rstrip('/')}/{below}", extension), root, extension)
        files = files.repartition("file_path")
        headers = files.drop("part").join(stata_headers(files), "file_path") if extension == "dta" else parquet_headers(files)
        studies.append(headers.withColumn("study", F.lit(study)))
    catalog = reduce(DataFrame.unionByName, studies)
    return catalog.filter("variable <> '_row'").select(
        "study",
        "fld",
        "dta",
        "pos",
        "variable",
        "label",
        F.concat("col_type", F.when(F.size("value_labels") > 0, "+lbl").otherwise("")).alias("col_type"),
        "value_labels",
        F.lower("variable").alias("var_low"),
        F.lower("label").alias("lab_low"),
        "file_path",
    )


def search_catalog(catalog: DataFrame, exclude: Mapping[str, str] | None = None, **patterns: str) -> DataFrame:
    """Catalogue rows whose columns contain the given patterns, minus those matching all of `exclude`."""
    for column, pattern in patterns.items():
        catalog = catalog.filter(F.col(column).rlike(pattern))
    if exclude:
        hit = reduce(lambda a, b: a & b, [F.col(c).rlike(p) for c, p in exclude.items()])
        catalog = catalog.filter(~hit)
    return catalog


def value_labels(catalog: DataFrame) -> DataFrame:
    """The labelled codes of all variables: (study, file_path, variable, code, label)."""
    return catalog.select("study", "file_path", "variable", F.inline("value_labels")).select(
        "study", "file_path", "variable", "code", "label"
    )


def labels_to_grid(labels: DataFrame, variables: Sequence[str | tuple[str, str]]) -> DataFrame:
    """Codes against variables, to compare the codings of several files.

    A variable that stands in several files is given as (file_path, variable) and gets a column for
    each, named `<file>.<variable>`. Two labels of one code stand side by side, divided by " / ".
    """
    columns = {(None, v) if isinstance(v, str) else tuple(v): v if isinstance(v, str) else f"{_file_name(v[0])}.{v[1]}" for v in variables}
    cells = []
    for (path, variable), name in columns.items():
        here = F.col("variable") == variable
        here = here if path is None else here & (F.col("file_path") == path)
        found = F.array_join(F.array_sort(F.collect_set(F.when(here, F.col("label")))), " / ")
        cells.append(F.nullif(found, F.lit("")).alias(name))
    return labels.groupBy("code").agg(*cells).orderBy("code")


def _file_name(path: str) -> str:
    return path.rstrip("/").rpartition("/")[2].rpartition(".")[0] or path


def write_lookup_csv(catalog: DataFrame, path: str) -> None:
    """The catalogue as CSV, without the columns CSV cannot hold."""
    catalog.drop("value_labels", "file_path").write.mode("overwrite").csv(path, header=True)
