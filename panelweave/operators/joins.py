"""Joins with the semantics survey tables need: null keys match, full joins over many tables.

A plain chain of full joins shuffles the growing result again at every step, and Spark cannot split
a partition of a full join that a hot key made too large. Two other forms are used here:

* Two tables: one full join; or, for a known hot key, the keys a table lacks are added to it as rows
  without attributes. Then every key exists on both sides and an inner join gives the same rows.
* Many tables: their rows are stored once, bucketed and sorted by the key. The distinct keys of that table are the
  frame, and the tables are merged onto it one after the other, bucket by bucket, without another
  exchange. Keys that are null or hot are kept apart.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelweave.functions.names import fresh
from panelweave.functions.recode import code_text
from panelweave.operators.combine import side_by_side
from panelweave.sources.store import store_bucketed

HOT_ROWS = 500_000  # rows of one key in one table from which the key is dealt over many tasks
SALTED_ROWS = 100_000  # rows of a hot key that go to one task
REGULAR, WITH_NULL, HOT = range(3)


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner", stored_by: str | None = None) -> DataFrame:
    """Equi-join in which null equals null; the keys come out once. `stored_by`: as in `full_join`."""
    renamed = right.withColumnsRenamed({k: f"__{k}" for k in keys})
    condition = reduce(lambda a, b: a & b, [_same(k, stored_by) for k in keys])
    joined = left.join(renamed, condition, how)
    if how in ("left_semi", "left_anti"):
        return joined
    if how == "right":
        found = [F.col(f"__{k}").alias(k) for k in keys]
    else:
        found = [F.col(k) for k in keys]
    rest = [c for c in left.columns if c not in keys] + [c for c in right.columns if c not in keys]
    return joined.select(*found, *rest)


def _same(key: str, stored_by: str | None = None) -> Column:
    """Equal keys of two tables, the right one's named `__key`; null equals null but for the key that the tables are stored by."""
    return F.col(key) == F.col(f"__{key}") if key == stored_by else F.col(key).eqNullSafe(F.col(f"__{key}"))


def _missing_keys(present: DataFrame, wanted: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys of `wanted` that `present` lacks, once each; null is a key like any other."""
    marked = present.select(*keys, F.lit(1).alias("__has")).unionAll(wanted.select(*keys, F.lit(2).alias("__has")))
    return marked.groupBy(*keys).agg(F.bit_or("__has").alias("__has")).filter("__has = 2").select(*keys)


def full_join(left: DataFrame, right: DataFrame, keys: Sequence[str], split_hot: bool = False, stored_by: str | None = None) -> DataFrame:
    """Full join of two tables of any content: one scan and one shuffle of each.

    Spark cannot split a hot key of a full join. Where a key is known to hold a large share of the
    rows, split_hot adds the keys a side lacks to it and joins inner, which Spark may split.
    `stored_by`: the key, such as the person, in whose buckets both sides are stored: their rows meet there, by a hash
    table of the right side's rows, without a shuffle. Rows whose `stored_by` is null all stay, but match none.
    """
    if stored_by:
        renamed = right.withColumnsRenamed({k: f"__{k}" for k in keys})
        same = reduce(lambda a, b: a & b, [_same(k, stored_by) for k in keys])
        rest = [c for c in left.columns if c not in keys] + [c for c in right.columns if c not in keys]
        met = left.join(renamed.hint("shuffle_hash"), same, "left").select(*keys, *rest)
        # A full join's rows are in no buckets for Spark; these two parts are.
        alone = renamed.join(left.select(*keys).hint("shuffle_hash"), same, "left_anti")
        return side_by_side([met, alone.withColumnsRenamed({f"__{k}": k for k in keys})]).select(*keys, *rest)
    if not split_hot:
        renamed = right.withColumnsRenamed({k: f"__{k}" for k in keys})
        same = reduce(lambda a, b: a & b, [_same(k) for k in keys])
        rest = [c for c in left.columns if c not in keys] + [c for c in right.columns if c not in keys]
        return left.join(renamed, same, "full").select(*[F.coalesce(k, f"__{k}").alias(k) for k in keys], *rest)
    padded_left = left.unionByName(_missing_keys(left, right, keys), allowMissingColumns=True)
    padded_right = right.unionByName(_missing_keys(right, left, keys), allowMissingColumns=True)
    return null_safe_join(padded_left, padded_right, keys)


def right_join(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """All rows of the right side, with the left side's attributes where it has the key.

    A left join from the right side: one scan and one shuffle of each, and Spark may split a hot key.
    """
    rest = [c for c in left.columns if c not in keys] + [c for c in right.columns if c not in keys]
    return null_safe_join(right, left, keys, "left").select(*keys, *rest)


def hot_keys(frames: Sequence[DataFrame], keys: Sequence[str], hot_rows: int = HOT_ROWS) -> tuple[dict[int, tuple[int, int]], bool]:
    """Hashes of the keys with very many rows, as {hash: (table with most of them, rows there)}, and whether any key is null.

    One pass over the keys without a shuffle: each task keeps the frequent items of a sketch, which misses none
    that holds more than a thousandth of a table. Keys that share a hash are dealt alike, which is harmless.
    """
    key, some_null = F.xxhash64(*keys), reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    looks = [f.select(F.lit(i).alias("table"), key.alias("key"), some_null.alias("some_null")) for i, f in enumerate(frames)]
    found = reduce(DataFrame.unionAll, looks).groupBy("table").agg(
        F.expr("approx_top_k(key, 1000, 10000)").alias("top"), F.max("some_null").alias("some_null")
    )
    hot: dict[int, tuple[int, int]] = {}
    any_null = False
    for row in found.collect():  # a row for each table, a thousand items each at most
        any_null = any_null or bool(row["some_null"])
        for item in row["top"] or []:
            if item["count"] >= hot_rows and item["count"] > hot.get(item["item"], (0, 0))[1]:
                hot[item["item"]] = (row["table"], item["count"])
    return hot, any_null


def full_join_all(
    frames: Sequence[DataFrame], keys: Sequence[str], hot_rows: int = HOT_ROWS, salted_rows: int = SALTED_ROWS, stored_by: str | None = None
) -> DataFrame:
    """Full join of any number of tables on the same keys, each row of them shuffled once.

    Repeated keys give all combinations of their rows, as a chain of full joins would; null equals null. Three
    tables or more are stored while the plan is built: each is read twice, for its keys and for its
    rows. Keys with a null are joined among themselves; of a hot key,
    the rows of the table that has most of them are dealt over salts and those of the others copied to
    each salt, so no task gets a hot key whole.
    """
    if len(frames) == 1:
        return frames[0]
    columns = [[c for c in f.columns if c not in keys] for f in frames]
    names = [c for cs in columns for c in cs]
    if len(set(names)) < len(names):
        raise ValueError(f"columns found in two tables: {sorted({c for c in names if names.count(c) > 1})}")
    if len(frames) == 2:
        return full_join(*frames, keys, stored_by=stored_by)
    hot, any_null = hot_keys(frames, keys, hot_rows)
    table, apart = (fresh(n, [*names, *keys]) for n in ("__table", "__apart"))
    some_null = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    is_hot = F.xxhash64(*keys).isin(list(hot)) if hot else F.lit(False)
    kind = F.when(is_hot, HOT).when(some_null, WITH_NULL).otherwise(REGULAR)
    tagged = [f.select(F.lit(i).alias(table), kind.alias(apart), *f.columns) for i, f in enumerate(frames)]
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)
    # null for regular rows, which leaves the hash of their keys as it is: they meet in their bucket
    spread = F.when(F.col(apart) != REGULAR, F.monotonically_increasing_id())
    bucketed, plain = store_bucketed(rows, "joined", keys, [apart, table, *keys], spread)

    def tables(stored: DataFrame, which: int) -> list[DataFrame]:
        return [stored.where((F.col(apart) == which) & (F.col(table) == i)).select(*keys, *cs) for i, cs in enumerate(columns)]

    merged = bucketed.where(F.col(apart) == REGULAR).select(*keys).distinct()
    for t in tables(bucketed, REGULAR):
        merged = merged.join(t, list(keys), "left")
    parts = [merged]
    if any_null:
        merged = plain.where(F.col(apart) == WITH_NULL).select(*keys).distinct()
        for t in tables(plain, WITH_NULL):
            merged = null_safe_join(merged, t, keys, "left")
        parts.append(merged)
    for main in sorted({t for t, _ in hot.values()}):
        parts.append(_salted(tables(plain, HOT), keys, main, {h: n for h, (t, n) in hot.items() if t == main}, salted_rows))
    return reduce(DataFrame.unionAll, [p.select(*keys, *names) for p in parts])


def _salted(tables: Sequence[DataFrame], keys: Sequence[str], main: int, hot: Mapping[int, int], salted_rows: int) -> DataFrame:
    """Hot keys whose most rows are in table `main`: its rows dealt over salts, the others' rows copied to each."""
    salt = fresh("__salt", [c for t in tables for c in t.columns])
    key = F.xxhash64(*keys)
    salts = F.create_map(*[F.lit(x) for h, n in hot.items() for x in (h, n // salted_rows + 1)])[key].cast("long")
    mine = [t.where(key.isin(list(hot))) for t in tables]
    joined = mine[main].withColumn(salt, F.pmod(F.monotonically_increasing_id(), salts))
    for i, t in enumerate(mine):
        if i != main:
            copied = t.withColumn(salt, F.explode(F.sequence(F.lit(0).cast("long"), salts - 1)))
            joined = null_safe_join(joined, copied, [*keys, salt], "left")
    return joined


def natural_full_join(left: DataFrame, right: DataFrame) -> DataFrame:
    """Full join on the common columns: a table without a key column spreads over that key."""
    return full_join(left, right, [c for c in left.columns if c in right.columns])


def natural_full_join_all(frame: DataFrame, tables: Sequence[DataFrame]) -> DataFrame:
    """Fold a natural full join over tables, joining runs of tables with equal keys at once."""
    result, run, run_keys = frame, [], []
    columns = list(frame.columns)
    for table in tables:
        keys = [c for c in columns if c in table.columns]
        if run and keys != run_keys:
            result, run = full_join_all([result, *run], run_keys), []
        run.append(table)
        run_keys = keys
        columns += [c for c in table.columns if c not in columns]
    return full_join_all([result, *run], run_keys) if run else result


def full_join_coalesce(first: DataFrame, second: DataFrame, keys: Sequence[str], column: str, stored_by: str | None = None) -> DataFrame:
    """Full join of two sources of one attribute; the first source wins where it has a value."""
    other = f"__{column}"
    joined = full_join(first, second.withColumnRenamed(column, other), keys, stored_by=stored_by)
    return joined.withColumn(column, F.coalesce(column, other)).drop(other)


def label_codes(df: DataFrame, labels: DataFrame, column: str) -> DataFrame:
    """Replace codes by the labels of `labels(code, label)`; a code without label stays as its number."""
    named = labels.select(F.col("code").alias("__code"), F.col("label").alias("__label"))
    joined = df.join(named, F.col(column) == F.col("__code"), "left")
    return joined.withColumn(column, F.coalesce("__label", code_text(F.col(column)))).select(*df.columns)
