"""The published tables: counts per sweep, persons ever observed per age window, category levels."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from panelweave.functions.recode import lookup
from panelweave.operators.levels import levels_of
from panelweave.operators.reshape import window_grid
from panelweave.plans.dictionaries import ATTRIBUTES, CATEGORIES, STUDIES
from panelweave.plans.panel import sweep_ages

HIDDEN = "No"
BITS = 62  # ages per mask column


def display_names(counts: DataFrame, studies: Mapping = STUDIES, attributes: Mapping = ATTRIBUTES) -> DataFrame:
    """Attach the published names; done on the counts, which are small."""
    return counts.withColumns(
        {"study_clean": lookup(F.col("study"), studies), "name_clean": lookup(F.col("name"), attributes)}
    )


def count_by_sweep(long: DataFrame, hidden: str = HIDDEN) -> DataFrame:
    """Rows of the long panel per study, age, attribute and value."""
    return long.filter(F.col("value") != hidden).groupBy("study", "fup", "name", "value").agg(F.count("*").alias("n"))


def count_values_by_sweep(values: DataFrame, hidden: str | None = HIDDEN, distinct: bool = False) -> DataFrame:
    """The same from `responder_values`: its counts are summed first and spread over the ages after.

    With distinct, persons are counted and not their rows: `values` has one row per person and value, whose entries
    at an age then count once. `hidden` None keeps every value.
    """
    sweeps = [c for c in values.columns if c not in ("study", "iid", "name", "value")]
    shown = values if hidden is None else values.filter(F.col("value") != hidden)
    per_row = {c: F.least(F.col(c), F.lit(1)).cast("long") if distinct else F.col(c) for c in sweeps}
    summed = shown.groupBy("study", "name", "value").agg(*[F.sum(x).alias(c) for c, x in per_row.items()])
    cells = summed.select("study", "name", "value", F.posexplode(F.array(*sweeps)).alias("sweep", "n"))
    return cells.filter("n > 0").select("study", F.get(sweep_ages(), F.col("sweep")).alias("fup"), "name", "value", "n")


def observation_masks(long: DataFrame, keys: Sequence[str], first: int, last: int) -> DataFrame:
    """Per key the ages it was observed at, as bits of fixed-size numbers.

    The bits are combined before the shuffle, so each key crosses it once per map task at most. An age
    outside first..last fails the query; a null age is no observation.
    """
    outside = F.raise_error(F.concat(F.lit(f"age outside {first}..{last}: "), F.col("fup").cast("string"))).cast("int")
    offset = F.when(F.col("fup").isNull() | F.col("fup").between(first, last), F.col("fup") - first).otherwise(outside)
    masks = []
    for i in range((last - first) // BITS + 1):
        bit = F.call_function("shiftleft", F.lit(1).cast("long"), offset - i * BITS)
        inside = offset.between(i * BITS, i * BITS + BITS - 1)
        masks.append(F.bit_or(F.when(inside, bit).otherwise(F.lit(0).cast("long"))).alias(f"mask_{i}"))
    return long.groupBy(*keys).agg(*masks)


def ages_observed(masks: DataFrame, first: int, last: int) -> DataFrame:
    """The masks as a sorted array `ages`."""
    words = [f"mask_{i}" for i in range((last - first) // BITS + 1)]

    def seen(age: Column) -> Column:
        offset = age - first
        word = F.get(F.array(*words), F.floor(offset / BITS).cast("int"))
        return F.call_function("getbit", word, offset % BITS) == 1

    return masks.withColumn("ages", F.filter(F.sequence(F.lit(first), F.lit(last)), seen)).drop(*words)


WORDS = 4  # masks of a ring: the ages of a key may lie anywhere, up to (WORDS - 1) * BITS apart


def observed_ages(long: DataFrame, keys: Sequence[str], words: int = WORDS) -> DataFrame:
    """Per key the ages it was observed at as a sorted array `ages`, in one pass and without known bounds.

    Ages are bits of words of fixed size, and a key keeps a ring of a few words with the number of its lowest
    and highest one: bits are combined before the shuffle, so a key crosses it once per map task at most. A key
    whose ages span more words than the ring has fails the query. A null age is no observation.
    """
    word, bit = F.floor(F.col("fup") / BITS).cast("long"), F.pmod(F.col("fup"), F.lit(BITS)).cast("int")
    flag = F.call_function("shiftleft", F.lit(1).cast("long"), bit)
    ring = [F.bit_or(F.when(F.pmod(word, F.lit(words)) == j, flag).otherwise(F.lit(0).cast("long"))).alias(f"mask_{j}") for j in range(words)]
    masks = long.groupBy(*keys).agg(F.min(word).alias("low_word"), F.max(word).alias("high_word"), *ring)
    apart = F.raise_error(F.concat(F.lit("ages of one key lie too far apart: words "), F.col("low_word").cast("string"), F.lit(" to "), F.col("high_word").cast("string")))
    top = F.when(F.col("high_word") - F.col("low_word") < words, F.col("high_word")).otherwise(apart.cast("long"))
    ring_of = F.array(*[f"mask_{j}" for j in range(words)])

    def seen(w: Column) -> Column:
        mask = F.get(ring_of, F.pmod(w, F.lit(words)).cast("int"))
        bits = F.filter(F.sequence(F.lit(0), F.lit(BITS - 1)), lambda b: F.call_function("getbit", mask, b) == 1)
        return F.transform(bits, lambda b: (w * BITS + b).cast("int"))

    ages = F.when(F.col("low_word").isNull(), F.array().cast("array<int>")).otherwise(F.flatten(F.transform(F.sequence("low_word", top), seen)))
    return masks.select(*keys, ages.alias("ages"))


def window_counts(observed: DataFrame, hidden: str = HIDDEN) -> DataFrame:
    """Persons per age window; `observed` has study, name, value and the sorted `ages` of a person, or of `n` persons.

    A person counts in a window once, by the first observation inside it: an observation at age
    `fup` whose predecessor is at age `previous` is the first one of the windows with
    previous < low <= fup <= high. So observations are counted by (previous, fup) and only these
    few counts are expanded to windows, whatever the number of persons.
    """
    steps = F.transform(
        "ages", lambda age, i: F.struct(F.get("ages", i - 1).alias("previous"), age.cast("int").alias("fup"))
    )
    many = F.col("n") if "n" in observed.columns else F.lit(1).cast("long")
    pairs = observed.select("study", "name", "value", many.alias("n"), F.inline(steps))
    counted = pairs.groupBy("study", "name", "value", "previous", "fup").agg(F.sum("n").alias("n"))
    # One row of bounds over these counts, as a scalar subquery on the same aggregate.
    bounds = counted.agg(F.struct(F.min("fup").alias("first"), F.max("fup").alias("last"))).scalar()
    bounded = counted.withColumn("bounds", bounds).select("*", "bounds.*").drop("bounds")
    lows = F.sequence(F.coalesce(F.col("previous") + 1, F.col("first")), F.col("fup"))
    cells = (
        bounded.filter(F.col("value") != hidden)
        .withColumn("low", F.explode(lows))
        .withColumn("high", F.explode(F.sequence("fup", "last")))
    )
    return cells.groupBy("low", "high", "study", "name", "value").agg(F.sum("n").alias("n"))


def ever_in_window(long: DataFrame, first: int | None = None, last: int | None = None, hidden: str = HIDDEN) -> DataFrame:
    """Distinct persons per study, age window, attribute and value, observed at any age inside.

    Given first and last, an age outside them fails the query; otherwise any ages will do.
    """
    keys = ["study", "iid", "name", "value"]
    if first is None or last is None:
        return window_counts(observed_ages(long, keys), hidden)
    return window_counts(ages_observed(observation_masks(long, keys, first, last), first, last), hidden)


def persons_by_ages(values: DataFrame) -> DataFrame:
    """Persons with each value of `responder_values` at just the same ages: study, name, value, sorted `ages`, n.

    The ages are bits while persons are counted, so as many rows remain as sets of ages occur.
    """
    sweeps = [c for c in values.columns if c not in ("study", "iid", "name", "value")]
    bits = reduce(Column.__add__, [F.when(F.col(c) > 0, F.lit(1 << j)).otherwise(F.lit(0)).cast("long") for j, c in enumerate(sweeps)])
    counted = values.select("study", "name", "value", bits.alias("seen")).groupBy("study", "name", "value", "seen").agg(F.count("*").alias("n"))
    ages = F.filter(sweep_ages(), lambda age, i: F.call_function("getbit", F.col("seen"), i) == 1)
    return counted.select("study", "name", "value", ages.alias("ages"), "n")


def values_ever_in_window(values: DataFrame, hidden: str = HIDDEN) -> DataFrame:
    """The same from `responder_values`, or from its persons counted by ages."""
    return window_counts(values if "ages" in values.columns else persons_by_ages(values), hidden)


def published(counts: DataFrame, *keys: str, code: bool = False) -> DataFrame:
    """Columns of the published tables; with code also the place of a value in the order of its attribute.

    The order is the one that the counts carry in the metadata of `value`, from the tables of the studies.
    """
    columns = [*keys, "study_clean", "name_clean", "value", "n"]
    named = display_names(counts)
    if not code:
        return named.select(*columns)
    return named.withColumn("code", code_of(levels_of(counts), F.col("name"), F.col("value"))).select(*columns, "code")


def code_of(levels: Mapping[str, Sequence[str]], name: Column, value: Column) -> Column:
    """The 1-based place of a value among the levels of its attribute; null where it is none of them."""
    order = F.create_map(*[x for n, labels in levels.items() for x in (F.lit(n), F.array(*[F.lit(v) for v in labels]))])
    return F.nullif(F.array_position(order[name], value), F.lit(0)).cast("int")


def var_levels(values: DataFrame) -> DataFrame:
    """The ordered categories of each attribute under its published name, with the rows that have them.

    Attributes and their order come from the metadata that `value` carries, so categories without rows are listed
    too. `values` is the result of `responder_values`.
    """
    levels = levels_of(values)
    rows = [(n, code, label) for n, labels in levels.items() for code, label in enumerate(labels, 1)]
    listed = values.sparkSession.createDataFrame(rows, "name string, code int, value string")
    counts = count_values_by_sweep(values, hidden=None).groupBy("name", "value").agg(F.sum("n").alias("n"))
    joined = listed.join(counts, ["name", "value"], "left")
    clean = lookup(F.col("name"), ATTRIBUTES).alias("name_clean")
    return joined.select(clean, "code", "value", F.coalesce("n", F.lit(0)).cast("long").alias("n"))


def age_windows(long: DataFrame) -> DataFrame:
    """All windows between the smallest and largest age observed, for each study."""
    return windows_between(long.select("study", F.col("fup").alias("first"), F.col("fup").alias("last")))


def windows_between(spans: DataFrame) -> DataFrame:
    """The same from spans of ages (study, first, last), as of persons, which are fewer than observations."""
    studies = spans.groupBy("study").agg(F.min("first").alias("first"), F.max("last").alias("last"))
    bounds = studies.agg(F.struct(F.min("first").alias("first"), F.max("last").alias("last"))).scalar()
    return window_grid(studies.select("study", bounds.alias("bounds")).select("study", "bounds.*")).select("study", "low", "high")


def category_levels(spark: SparkSession, categories: Mapping[str, Sequence[str]] = CATEGORIES) -> DataFrame:
    """Attribute, code and label of all categories; the code is the published order."""
    rows = [(name, code, label) for name, labels in categories.items() for code, label in enumerate(labels, 1)]
    return spark.createDataFrame(rows, "attribute string, code int, label string")


def observed_levels(levels: DataFrame, long: DataFrame) -> DataFrame:
    """The categories that occur in the long panel, renumbered without gaps."""
    used = long.groupBy(F.col("name").alias("attribute"), F.col("value").alias("label")).agg(F.count("*").alias("rows"))
    kept = levels.join(used, ["attribute", "label"])
    code = F.row_number().over(Window.partitionBy("attribute").orderBy("code"))
    return kept.select("attribute", code.alias("code"), "label")


def rename_levels(label: Column, labels: Sequence[str], positions: Mapping[str, int]) -> Column:
    """Rename categories by their position; the others keep their name."""
    renamed = {labels[i - 1]: new for new, i in positions.items()}
    return F.coalesce(lookup(label, renamed), label)
