"""Storing tables between steps in the shared folder the cluster names."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator, Mapping, Sequence
from contextlib import AbstractContextManager, contextmanager
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, SparkSession

SETTING = "spark.checkpoint.dir"
COMPRESSION = "zstd"
BUCKETS = "spark.sql.shuffle.partitions"
#: Paths of the tables stored since `given_up` began, if it did.
_passing: ContextVar[list[str] | None] = ContextVar("passing", default=None)
#: With this, Spark removes a query's shuffle files when it ends, not when the driver next collects garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


#: With this, a join by person and more asks for no shuffle of tables that are stored by person.
SUBSET = "spark.sql.requireAllClusterKeysForCoPartition"
#: With this, a bucket that is one file is known to be sorted as it was written, and is merged without a sort.
SORTED = "spark.sql.legacy.bucketedTableScan.outputOrdering"
#: Bytes of a generated method; Java leaves longer ones than 8000 uncompiled, and Spark's default generates them.
METHOD = "spark.sql.codegen.hugeMethodLimit"


@contextmanager
def settings(spark: SparkSession, wanted: Mapping[str, str]) -> Iterator[None]:
    """Inside, the session has these settings."""
    before = {key: spark.conf.get(key, None) for key in wanted}
    for key, value in wanted.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def shuffles_removed(spark: SparkSession) -> AbstractContextManager[None]:
    """Inside, the shuffle files of a query go when it ends."""
    return settings(spark, {CLEANUP: "true"})


def stored_by_person(spark: SparkSession, buckets: int) -> AbstractContextManager[None]:
    """Inside, tables are stored in so many buckets of persons, and a join by person and more needs no shuffle of them."""
    return settings(spark, {BUCKETS: str(buckets), SUBSET: "false", SORTED: "true", METHOD: "8000"})


@contextmanager
def given_up(spark: SparkSession) -> Iterator[None]:
    """Tables that this thread stores inside are emptied at the end, but for those to keep."""
    paths: list[str] = []
    token = _passing.set(paths)
    try:
        yield
    finally:
        _passing.reset(token)
        for path in paths:
            spark.range(0).coalesce(1).write.mode("overwrite").parquet(path)


def _noted(path: str) -> str:
    paths = _passing.get()
    if paths is not None:
        paths.append(path)
    return path


def shared_folder(spark: SparkSession) -> str:
    """The cluster's shared folder; a temporary one only in a local session that names none."""
    folder = spark.conf.get(SETTING, None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {SETTING} to a folder that all executors share")
    return tempfile.mkdtemp(prefix="panelweave-")


def store(df: DataFrame, name: str, partition_by: str | None = None, path: str | None = None, keep: bool = False) -> DataFrame:
    """Write a table as Parquet, partitioned by study if asked, and read it back. `keep`: also after `given_up`."""
    spark = df.sparkSession
    if not path:
        path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
        path = path if keep else _noted(path)
    writer = df.write.mode("errorifexists").option("compression", COMPRESSION)
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def store_bucketed(df: DataFrame, name: str, keys: Sequence[str], order: Sequence[str], spread: Column | None = None, dealt: bool = False) -> tuple[DataFrame, DataFrame]:
    """Write a table in buckets of its keys, as many as shuffle partitions, and read it back: by bucket, and plain.

    Joins and aggregates on these keys then need no exchange. A row for which `spread` is not null may be
    written by any task, so a key that is all such rows does not meet in one; buckets of other rows are one
    sorted file each. The name leaves the session's catalog at once; the files stay in the shared folder.
    `dealt`: the rows are grouped by the keys already and need no shuffle of their own.
    """
    spark = df.sparkSession
    label = f"{name}_{uuid.uuid4().hex}"
    path = _noted(f"{shared_folder(spark)}/{label}")
    parts = int(spark.conf.get(BUCKETS))
    rows = df if dealt else df.repartition(parts, *keys, *([] if spread is None else [spread]))
    rows.write.bucketBy(parts, *keys).sortBy(*order).option("path", path).option("compression", COMPRESSION).saveAsTable(label)
    try:
        return spark.table(label), spark.read.schema(df.schema).parquet(path)
    finally:
        spark.sql(f"DROP TABLE `{label}`")
