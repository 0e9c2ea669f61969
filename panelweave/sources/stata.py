"""Stata survey files: their catalogue entries and their conversion to Parquet, as Spark jobs.

A file is read by many tasks, each taking a range of its rows.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# the reading functions travel with the tasks, executors need no copy of this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

ROWS_PER_TASK = 100_000
ROWS_PER_BATCH = 10_000

HEADER = (
    "file_path string, pos int, variable string, label string, col_type string, "
    "value_labels array<struct<label:string,code:double>>, n_rows bigint"
)


def _open(path: str):
    from pyarrow import fs

    filesystem, name = fs.FileSystem.from_uri(path) if ":" in path else (fs.LocalFileSystem(), path)
    return pd.io.stata.StataReader(
        filesystem.open_input_file(name), convert_categoricals=False, convert_dates=False, preserve_dtypes=False
    )


def _headers(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for path in batch["file_path"]:
            with _open(path) as reader:
                rows = len(reader_index(reader))
                first = reader.read(1) if rows else pd.DataFrame(columns=list(reader.variable_labels()))
                labels, codes = reader.variable_labels(), reader.value_labels()
                sets = dict(zip(first.columns, reader._lbllist, strict=True))
            yield pd.DataFrame(
                {
                    "file_path": path,
                    "pos": range(1, first.shape[1] + 1),
                    "variable": first.columns,
                    "label": [labels.get(v) for v in first.columns],
                    "col_type": ["chr" if first[v].dtype == object else "dbl" for v in first.columns],
                    "value_labels": [
                        [{"label": t, "code": float(c)} for c, t in codes.get(sets[v], {}).items()] or None
                        for v in first.columns
                    ],
                    "n_rows": rows,
                }
            )


def reader_index(reader) -> range:
    """The row numbers of an open file."""
    reader._ensure_open()
    return range(reader._nobs)


def stata_headers(paths: DataFrame) -> DataFrame:
    """One row per variable of each file in `paths(file_path)`, files read in parallel."""
    return paths.select("file_path").mapInPandas(_headers, HEADER)


def _rows(variables: list[str], numeric: list[str]):
    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, start, stop in batch[["file_path", "start", "stop"]].itertuples(index=False):
                with _open(path) as reader:
                    reader_index(reader)
                    reader._lines_read = start  # the records have a fixed width, so the reader seeks
                    while start < stop:
                        part = reader.read(min(ROWS_PER_BATCH, stop - start), columns=variables)
                        part[numeric] = part[numeric].astype("float64")
                        part["_row"] = range(start, start + len(part))
                        start += len(part)
                        yield part

    return read


def read_stata(spark: SparkSession, path: str, header: list) -> DataFrame:
    """All rows of one Stata file with its row number `_row`; labels go into the column metadata.

    `header` holds the file's rows of `stata_headers`.
    """
    fields = sorted(header, key=lambda r: r["pos"])
    rows = int(fields[0]["n_rows"])
    names = [r["variable"] for r in fields]
    numeric = [r["variable"] for r in fields if r["col_type"] == "dbl"]
    schema = T.StructType(
        [T.StructField(n, T.DoubleType() if n in numeric else T.StringType()) for n in names]
        + [T.StructField("_row", T.LongType())]
    )
    tasks = max(-(-rows // ROWS_PER_TASK), 1)
    ranges = (
        spark.range(tasks, numPartitions=tasks)
        .select(
            F.lit(path).alias("file_path"),
            (F.col("id") * ROWS_PER_TASK).alias("start"),
            F.least((F.col("id") + 1) * ROWS_PER_TASK, F.lit(rows)).alias("stop"),
        )
    )
    data = ranges.mapInPandas(_rows(names, numeric), schema)
    # a NaN stands for a missing code
    cells = [F.nanvl(n, F.lit(None).cast("double")).alias(n) if n in numeric else F.col(n) for n in names]
    data = data.select(*cells, "_row")
    for r in fields:
        labels = [{"label": v["label"], "code": v["code"]} for v in r["value_labels"] or []]
        data = data.withMetadata(r["variable"], {"label": r["label"] or "", "value_labels": labels})
    return data
