"""Reshaping, joins and windows on small hand-written tables, skewed keys included."""

import itertools

import pytest
from pyspark.sql import functions as F

from panelweave.operators import joins, reshape, windows
from panelweave.plans import counts


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def brute_full_join(tables, n_keys):
    """All combinations per key, null keys equal, absent tables as nulls."""
    keys = {r[:n_keys] for table, _ in tables for r in table}
    out = []
    for key in keys:
        parts = []
        for table, width in tables:
            found = [r[n_keys:] for r in table if r[:n_keys] == key]
            parts.append(found or [(None,) * width])
        out += [key + sum(combo, ()) for combo in itertools.product(*parts)]
    return sorted(out, key=str)


def test_full_joins_match_null_keys_and_repeat_rows(spark):
    a = [(1, 5, "a"), (1, 5, "a"), (1, None, "b"), (2, 7, None)]
    b = [(1, 5, "c"), (1, None, "d"), (1, None, "e"), (3, 5, "f")]
    c = [(1, 5, "g"), (2, 7, "h"), (2, None, "i"), (1, 5, "j")]
    frames = [spark.createDataFrame(t, f"id int, fup int, {n} string") for t, n in ((a, "x"), (b, "y"), (c, "z"))]
    keys = ["id", "fup"]
    assert rows(joins.full_join_all(frames, keys)) == brute_full_join([(a, 1), (b, 1), (c, 1)], 2)
    assert rows(joins.full_join(*frames[:2], keys)) == brute_full_join([(a, 1), (b, 1)], 2)


def test_full_join_refuses_equal_columns(spark):
    df = spark.createDataFrame([(1, "a")], "id int, x string")
    with pytest.raises(ValueError):
        joins.full_join_all([df, df], ["id"])


def test_natural_full_join_spreads_and_appends(spark):
    frame = spark.createDataFrame([("p", 1, 0), ("p", 1, 5), ("q", 2, 0), ("q", 2, 5)], "pid string, iid int, fup int")
    sex = spark.createDataFrame([("p", "Male"), ("z", "Female")], "pid string, sex string")
    religion = spark.createDataFrame([("p", 5, "r"), ("q", 9, "s"), ("z", 0, "t")], "pid string, fup int, religion string")
    got = rows(joins.natural_full_join_all(frame, [sex, religion]).select("pid", "iid", "fup", "sex", "religion"))
    assert got == sorted(
        [
            ("p", 1, 0, "Male", None),
            ("p", 1, 5, "Male", "r"),
            ("q", 2, 0, None, None),
            ("q", 2, 5, None, None),
            ("q", None, 9, None, "s"),
            ("z", None, 0, None, "t"),
            ("z", None, None, "Female", None),
        ],
        key=str,
    )


def test_right_join_keeps_every_right_row(spark):
    left = spark.createDataFrame([(1, "a"), (1, "b"), (9, "c")], "id int, x string")
    right = spark.createDataFrame([(1, 10), (2, 20), (2, 21)], "id int, y int")
    assert rows(joins.right_join(left, right, ["id"])) == sorted(
        [(1, "a", 10), (1, "b", 10), (2, None, 20), (2, None, 21)], key=str
    )


def test_coalescing_join(spark):
    a = spark.createDataFrame([(1, 5.0), (2, None)], "id int, x double")
    b = spark.createDataFrame([(2, 7.0), (3, 8.0)], "id int, x double")
    assert rows(joins.full_join_coalesce(a, b, ["id"], "x")) == [(1, 5.0), (2, 7.0), (3, 8.0)]


def test_label_codes(spark):
    codes = spark.createDataFrame([(1, 1.0), (2, 7.0), (3, None)], "id int, x double")
    labels = spark.createDataFrame([(1.0, "one")], "code double, label string")
    assert rows(joins.label_codes(codes, labels, "x")) == [(1, "one"), (2, "7"), (3, None)]


def test_unpivot_multi_value_fills_missing_stems(spark):
    df = spark.createDataFrame([(1, 1.0, 2.0, 3.0)], "id int, asex double, bsex double, anum double")
    got = rows(reshape.unpivot_multi_value(df, ["id"]).select("id", "sweep", "sex", "num"))
    assert got == [(1, "a", 1.0, 3.0), (1, "b", 2.0, None)]


def test_clean_to_long_needs_a_number(spark):
    df = spark.createDataFrame([(1, 1, 2, 3)], "id int, x_05 int, x_10 int, x_w8 int")
    assert rows(reshape.clean_to_long(df, "x", ["id"])) == [(1, 10, 2), (1, 5, 1)]


def test_uncount(spark):
    df = spark.createDataFrame([(1, 0), (2, 1), (3, 2), (4, None)], "id int, n int")
    assert rows(reshape.uncount(df, F.col("n"), "i").select("id", "i")) == [(2, 1), (3, 1), (3, 2)]


def test_chop_and_unchop(spark):
    data = [(1, 3), (1, 1), (1, 3), (2, None)]
    df = spark.createDataFrame(data, "id int, v int")
    chopped = reshape.chop_runs(df, ["id"], "v", "runs")
    assert rows(reshape.unchop_runs(chopped, "runs", "v")) == sorted(data, key=str)


def test_hot_key_is_chopped_to_its_values(spark):
    df = spark.range(30000).select((F.col("id") % 3 * F.col("id")).alias("k"), (F.col("id") % 5).alias("v"))
    longest = reshape.chop_runs(df, ["k"], "v", "runs").agg(F.max(F.size("runs"))).first()[0]
    assert longest <= 5


def test_earliest_keeps_ties(spark):
    df = spark.createDataFrame([(1, 5, "a"), (1, 5, "b"), (1, 7, "c"), (None, 3, "d")], "id int, fup int, v string")
    assert rows(windows.earliest_with_ties(df, ["id"], "fup")) == sorted(
        [(1, 5, "a"), (1, 5, "b"), (None, 3, "d")], key=str
    )


def test_first_per_group_limits_groups_before_the_shuffle(spark):
    df = spark.createDataFrame([(1, 2, "b"), (1, 1, "a"), (2, 9, "c")], "id int, o int, v string")
    first = windows.first_per_group(df, ["id"], ["o"])
    assert rows(first) == [(1, 1, "a"), (2, 9, "c")]
    assert "WindowGroupLimit" in first._jdf.queryExecution().executedPlan().toString()


def test_surrogate_ids_have_no_gap(spark):
    df = spark.range(5000).select(F.concat(F.lit("k"), F.lpad(F.col("id").cast("string"), 6, "0")).alias("key"))
    numbered = windows.surrogate_id(df.orderBy(F.rand(3)), "key", parts=7)
    got = [tuple(r) for r in numbered.select("iid", "key").orderBy("key").collect()]
    assert got == [(i + 1, f"k{i:06d}") for i in range(5000)]


LONG = [
    ("s", "p1", "sex", "Male", 0),
    ("s", "p1", "sex", "Male", 100),
    ("s", "p1", "faith", "No", 0),
    ("s", "p1", "faith", "Yes", 7),
    ("s", "p2", "sex", "Male", 7),
    ("s", "p2", "sex", "Female", 7),
    ("s", "p2", "sex", "Female", 7),
    ("t", "p1", "sex", "Female", 30),
]


def brute_windows(long):
    ages = range(min(r[4] for r in long), max(r[4] for r in long) + 1)
    out = {}
    for low in ages:
        for high in range(low, ages[-1] + 1):
            for s, person, name, value, fup in long:
                if low <= fup <= high and value != "No":
                    out.setdefault((low, high, s, name, value), set()).add(person)
    return sorted((*k, len(v)) for k, v in out.items())


def test_windows_against_brute_force_over_more_than_64_ages(spark):
    long = spark.createDataFrame(LONG, "study string, iid string, name string, value string, fup int")
    got = counts.ever_in_window(long, 0, 100).select("low", "high", "study", "name", "value", "n")
    assert sorted(tuple(r) for r in got.collect()) == brute_windows(LONG)


def test_window_of_one_age_equals_distinct_count(spark):
    long = spark.createDataFrame(LONG, "study string, iid string, name string, value string, fup int")
    one = counts.ever_in_window(long, 0, 100).filter("low = high").select("study", "low", "name", "value", "n")
    assert rows(one) == rows(counts.count_by_sweep(long.distinct()))


def test_hot_person_crosses_the_shuffle_as_one_row(spark):
    long = spark.range(40000).select(
        F.lit("s").alias("study"),
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("iid"),
        F.lit("a").alias("name"),
        F.lit("v").alias("value"),
        (F.col("id") % 11).cast("int").alias("fup"),
    )
    got = counts.ever_in_window(long, 0, 10).filter("low = 0 AND high = 10").first()["n"]
    assert got == long.select("iid").distinct().count()
    plan = counts.ever_in_window(long, 0, 10)._jdf.queryExecution().executedPlan().toString()
    assert "partial_bit_or" in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan


def many_tables(spark):
    """Three tables, a third of whose rows have a null key and another third one key; few keys repeat beside them."""
    key = F.when(F.col("id") % 3 == 0, F.lit(None)).when(F.col("id") % 3 == 1, F.lit(7)).otherwise(F.col("id")).cast("int")
    a = spark.range(6000).select(key.alias("k"), F.lit("p").alias("at"), F.col("id").alias("x"))
    b = spark.createDataFrame([(7, "p", 1), (7, "p", 2), (None, "p", 3), (11, "p", 4), (11, None, 5), (None, None, 6)], "k int, at string, y int")
    c = spark.createDataFrame([(7, "p", 1), (None, "p", 2), (11, "p", 3), (11, "p", 4), (-1, "q", 5), (None, None, 6)], "k int, at string, __table int")
    return [a, b, c]


def chain(frames, keys):
    out = frames[0]
    for f in frames[1:]:
        out = joins.full_join(out, f, keys)
    return out


@pytest.mark.parametrize(("hot_rows", "salted_rows"), [(500, 100), (10**9, 10**9)])
def test_many_table_join_with_null_and_hot_keys(spark, hot_rows, salted_rows):
    frames, keys = many_tables(spark), ["k", "at"]
    got = joins.full_join_all(frames, keys, hot_rows, salted_rows)
    wanted = chain(frames, keys)
    assert got.columns == wanted.columns
    assert sorted(map(str, got.collect())) == sorted(map(str, wanted.collect()))


def test_hot_keys_are_found_without_a_shuffle_of_rows(spark):
    frames = many_tables(spark)
    hot, any_null = joins.hot_keys(frames, ["k", "at"], 500)
    assert any_null and len(hot) == 2 and {t for t, _ in hot.values()} == {0} and all(n == 2000 for _, n in hot.values())
    assert joins.hot_keys([f.na.drop() for f in frames], ["k", "at"], 10**9) == ({}, False)


def test_null_keys_of_a_third_of_the_rows_are_written_by_many_tasks(spark):
    """And the merge of the regular keys has neither an exchange nor a list."""
    frames = [f.withColumn("__p", F.spark_partition_id()).drop("__p") for f in many_tables(spark)]
    got = joins.full_join_all(frames, ["k", "at"], 10**9, 10**9)
    files = got.inputFiles()
    assert len(files) > int(spark.conf.get("spark.sql.shuffle.partitions"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        clean = [f.where("k IS NOT NULL AND at IS NOT NULL") for f in many_tables(spark)]
        plan = joins.full_join_all(clean, ["k", "at"])._jdf.queryExecution().executedPlan().toString()
        assert plan.count("SortMergeJoin") == 3 and "Exchange" not in plan and "ObjectHashAggregate" not in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("deal", [False, True])
def test_copies_are_made_in_blocks(spark, deal, monkeypatch):
    monkeypatch.setattr(reshape, "BLOCK", 7)
    data = [("a", 0), ("b", 1), ("c", 7), ("d", 8), ("e", 400), ("f", None), ("g", -3)]
    df = spark.createDataFrame(data, "`my id` string, n long").withColumn("__block", F.lit("kept"))
    got = reshape.deal_copies(df, "n", "i", deal)
    assert got.columns == ["my id", "__block", "i"]
    assert rows(got.select("my id", "i")) == sorted([(k, i + 1) for k, n in data for i in range(n or 0)], key=str)
    assert reshape.deal_copies(df, "n", deal=deal).columns == ["my id", "__block"]


def test_ten_million_copies_of_a_row(spark):
    """Dealt over the tasks: none makes more than a share of them, and no row holds a list of them."""
    df = spark.createDataFrame([(1, [(5, 10_000_000), (6, 2)]), (2, [])], "id int, runs array<struct<value:int,times:long>>")
    back = reshape.unchop_runs(df, "runs", "v")
    found = back.groupBy("id", "v").count()
    assert rows(found) == [(1, 5, 10_000_000), (1, 6, 2)]
    shares = back.groupBy(F.spark_partition_id()).count().collect()
    assert max(r["count"] for r in shares) < 10_000_000


def test_sparse_ages_need_no_bounds(spark):
    """Ages below zero, beyond a word, null, and keys far from each other; a key's own ages lie within the ring."""
    data = [("a", -130), ("a", -5), ("a", 40), ("a", 40), ("b", 100_000), ("b", 100_061), ("c", None), ("a", None)]
    long = spark.createDataFrame(data, "k string, fup int")
    got = {r.k: r.ages for r in counts.observed_ages(long, ["k"]).collect()}
    assert got == {"a": [-130, -5, 40], "b": [100_000, 100_061], "c": []}
    assert "partial_bit_or" in counts.observed_ages(long, ["k"])._jdf.queryExecution().executedPlan().toString()
    wide = spark.createDataFrame([("a", 0), ("a", 5_000)], "k string, fup int")
    with pytest.raises(Exception, match="too far apart"):
        counts.observed_ages(wide, ["k"]).collect()


def test_windows_without_bounds_against_brute_force(spark):
    long = spark.createDataFrame(LONG, "study string, iid string, name string, value string, fup int")
    got = counts.ever_in_window(long).select("low", "high", "study", "name", "value", "n")
    assert sorted(tuple(r) for r in got.collect()) == brute_windows(LONG)


def test_surrogate_ids_of_many_ranges_and_clashing_names(spark):
    df = spark.range(3000).select(F.when(F.col("id") > 0, F.col("id") * 7 % 3001).alias("key"), F.lit(1).alias("__place"), F.lit(2).alias("__part"))
    numbered = windows.surrogate_id(df, "key", rows_per_part=2)
    assert numbered.columns == ["key", "__place", "__part", "iid"]
    got = [r.key for r in numbered.orderBy("iid").collect()]
    assert got == [None, *sorted(k * 7 % 3001 for k in range(1, 3000))]
    assert windows.surrogate_id(df.where("false"), "key").count() == 0
