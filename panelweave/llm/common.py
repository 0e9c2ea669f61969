"""Helpers shared by the operators: written tables in the shared folder, words, salted lookups, components."""

from __future__ import annotations

import tempfile
import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
SPACE = r"[\x20\x09-\x0D]+"


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: `spark.checkpoint.dir`.

    Only a local session, where one machine is all there is, may do without that setting.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        system = path.getFileSystem(spark._jsc.hadoopConfiguration())
        return system.makeQualified(path).toString().rstrip("/")
    if not spark.sparkContext.master.startswith("local") or "cluster" in spark.sparkContext.master:
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    folder = f"file://{tempfile.mkdtemp(prefix='shared-')}"
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def new_path(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def written(df: DataFrame, label: str) -> DataFrame:
    """The same rows as a Parquet table in the shared folder: cuts lineage, survives lost executors."""
    path = new_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small(table: DataFrame, rows: int = 200_000, weight: Column | None = None) -> DataFrame:
    """A written table of narrow rows, to be broadcast if it really has few, and joined by shuffle if not.

    weight: how many narrow rows a row is worth, where it holds an array.
    """
    total = table.count() if weight is None else table.agg(F.sum(weight)).first()[0] or 0
    return F.broadcast(table) if total <= rows else table


def lower_az(text: Column) -> Column:
    """A-Z in lower case, every other character as it is; null is empty."""
    text = F.coalesce(text, F.lit(""))
    only_ascii = F.octet_length(text) == F.char_length(text)
    return F.when(only_ascii, F.lower(text)).otherwise(F.translate(text, UPPER, UPPER.lower()))


def words(text: Column, separators: str) -> Column:
    """The words between runs of separators, none of them empty."""
    return F.array_remove(F.split(text, separators), "")


def let(value: Column, body) -> Column:
    """body(value), with value computed once per row even where body uses it inside lambdas."""
    return F.element_at(F.transform(F.array(value), body), 1)


def fold(id_col: str, folds: int) -> Column:
    """crc32 of the id as text, modulo folds; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % folds


def without_rows(docs: DataFrame, gone: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The documents but those whose id and text hash are in gone (_id, text_hash); no column is added on the way."""
    same = docs[f"`{id_col}`"].eqNullSafe(gone["_id"]) & (F.xxhash64(docs[f"`{text_col}`"]) == gone["text_hash"])
    return docs.join(gone, same, "left_anti")


def null_safe(left: DataFrame, right: DataFrame, keys: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [left[k].eqNullSafe(right[k]) for k in keys])


# --- connected components ---------------------------------------------------------------------


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One large-star or small-star step over (u, v) edges."""
    if large:
        both = edges.select("u", "v").unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        both = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    low = written(low, "component-minima")
    joined = both.join(low, "u")
    if large:
        return joined.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
    own = low.select("u", F.col("m").alias("v"))
    return joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionAll(own).where("u <> v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of the undirected edges (u, v); component is its smallest node.

    Alternates large-star and small-star steps until the edges no longer change. Each step is two
    shuffles of the edges, the edges never outnumber those given, and every step is written to the
    shared folder, so a lost executor repeats one step at most. An empty table gives an empty table.
    """
    edges = written(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    state = None
    while True:
        edges = written(_star(edges, large=True), "edges")
        edges = written(_star(edges, large=False), "edges")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(now) == state:
            break
        state = tuple(now)
    roots = edges.select(F.col("v").alias("node")).distinct().withColumn("component", F.col("node"))
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionAll(roots)
