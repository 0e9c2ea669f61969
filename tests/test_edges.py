"""Results on inputs that no registered query feeds: patterns with groups, ages out of bounds, repeated sweeps."""

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from panelweave.functions.names import remove_first
from panelweave.operators import joins, reshape, windows
from panelweave.plans import bcs70, counts, ncds
from panelweave.plans import panel as p
from panelweave.sources.catalog import labels_to_grid
from panelweave.sources.files import SurveyFiles
from panelweave.sources.joined import joined_once


def test_remove_first_with_groups_and_lines(spark):
    df = spark.createDataFrame([("abXcdY",), ("one\ntwoX",), ("none",), (None,), ("XX",)], "x string")
    got = [r[0] for r in df.select(remove_first(F.col("x"), "(X|Y)")).collect()]
    assert got == ["abcdY", "one\ntwo", "none", None, "X"]


def test_label_grid_keeps_files_and_both_labels(spark):
    rows = [("a/f1.parquet", "sc", 1.0, "I"), ("a/f2.parquet", "sc", 1.0, "One"), ("a/f2.parquet", "sc", 1.0, "Uno"), ("a/f2.parquet", "x", 2.0, "X")]
    labels = spark.createDataFrame(rows, "file_path string, variable string, code double, label string")
    got = labels_to_grid(labels, [("a/f1.parquet", "sc"), ("a/f2.parquet", "sc"), "x"]).collect()
    assert [r.asDict() for r in got] == [
        {"code": 1.0, "f1.sc": "I", "f2.sc": "One / Uno", "x": None},
        {"code": 2.0, "f1.sc": None, "f2.sc": None, "x": "X"},
    ]


def test_wide_ids_keep_their_digits(spark):
    big = (1 << 60) + 1
    df = spark.createDataFrame([(1, 7, big, "t", 2.5)], "id int, anum int, bnum long, atext string, btext double")
    got = {r.sweep: r for r in reshape.unpivot_multi_value(df, ["id"]).collect()}
    assert got["b"].num == big and got["a"].num == 7 and got["b"].text == "2.5"


def test_an_age_outside_the_bounds_fails(spark):
    long = spark.createDataFrame([("s", 1, 5, "n", "v"), ("s", 1, 9, "n", "v"), ("s", 1, None, "n", "v")], "study string, iid int, fup int, name string, value string")
    assert counts.ever_in_window(long, 5, 9).where("low = 5 AND high = 9").first().n == 1
    with pytest.raises(PySparkException, match="age outside"):
        counts.ever_in_window(long, 5, 8).collect()


def test_a_wider_window_never_counts_fewer(spark):
    rows = [("s", i, (i * 7 + k * 3) % 11, "n", f"v{i % 2}") for i in range(40) for k in range(3)]
    long = spark.createDataFrame(rows, "study string, iid int, fup int, name string, value string")
    cells = {(r.value, r.low, r.high): r.n for r in counts.ever_in_window(long, 0, 10).collect()}
    for (v, low, high), n in cells.items():
        assert n <= cells.get((v, low, high + 1), n) and n <= cells.get((v, low - 1, high), n)


def test_two_variables_of_one_sweep_give_two_rows(spark):
    frames = {"a/one": spark.createDataFrame([("p", 1.0)], "BCSID string, BD5CNTRY double"), "a/two": spark.createDataFrame([("p", 2.0)], "BCSID string, bd5xcntry double")}
    files = SurveyFiles.from_frames({"a/one": frames["a/one"], "a/two": frames["a/two"].withColumnRenamed("bd5xcntry", "BDXCNTRY")})
    assert bcs70.country(files).count() == 1  # a name without number has no age
    twice = SurveyFiles.from_frames({"a/one": frames["a/one"], "b/two": spark.createDataFrame([("p", 2.0)], "BCSID string, BD05CNTRY double")})
    assert sorted(r.fup for r in bcs70.country(twice).collect()) == [bcs70.AGES[4]] * 2
    late = SurveyFiles.from_frames({"a/one": spark.createDataFrame([("p", 1.0, 1.0)], "NCDSID string, n8region double, n1region double")})
    assert ncds.sweep_age("30", 11) is None and ncds.country(late).count() == 2


def test_products_of_entries_are_exact(spark):
    big = 3**20
    df = spark.createDataFrame([([big, 3**19, 1],), ([2, 3],)], "f array<long>")
    assert [r[0] for r in df.select(p._times(F.col("f"))).collect()] == [3**39, 6]
    with pytest.raises(PySparkException, match="bigint"):
        spark.createDataFrame([([big, big],)], "f array<long>").select(p._times(F.col("f"))).collect()


def test_earliest_is_limited_before_the_shuffle(spark):
    df = spark.createDataFrame([(1, 2, "a"), (1, 2, "b"), (1, 3, "c"), (2, None, "d"), (2, None, "e"), (3, None, "f"), (3, 1, "g")], "id int, fup int, x string")
    first = windows.earliest_with_ties(df, ["id"], "fup")
    assert sorted(r.x for r in first.collect()) == ["a", "b", "d", "e", "g"]
    assert "WindowGroupLimit" in first._jdf.queryExecution().executedPlan().toString()


def test_right_join_with_a_common_null_key(spark):
    left = spark.createDataFrame([(None, "x")] + [(k, "y") for k in range(5)], "id int, a string")
    right = spark.createDataFrame([(None, k) for k in range(30)] + [(k, k) for k in range(60)], "id int, b int")
    joined = joins.right_join(left, right, ["id"])
    assert joined.columns == ["id", "a", "b"] and joined.count() == 90
    assert joined.where("id IS NULL AND a = 'x'").count() == 30 and joined.where("a IS NULL").count() == 55


def test_joined_once_equals_the_files(spark):
    frames = {
        "w/one": spark.createDataFrame([("p1", 1.0, 2.0), ("p2", 3.0, None)], "ID string, A double, B double"),
        "w/two": spark.createDataFrame([("p2", 4.0), ("p3", 5.0)], "ID string, C double"),
        "w/grid": spark.createDataFrame([("p1", 1.0), ("p1", 2.0), ("p4", 3.0)], "ID string, D double"),
    }
    files = SurveyFiles.from_frames(frames)

    def rule(f):
        return [f.load_joined(f.search(variable=v), "id") for v in ("^(A|C)$", "^B$", "^(B|D)$", "^C$")]

    rule.reads = 4
    once = joined_once(spark, files, "id", [rule])
    assert once.single == {"w/one", "w/two"}
    for a, b in zip(rule(files), rule(once), strict=True):
        assert a.columns == b.columns
        assert sorted(map(str, a.collect())) == sorted(map(str, b.collect()))


@pytest.mark.parametrize("split_hot", [False, True])
def test_full_join_with_a_common_null_key(spark, split_hot):
    left = spark.createDataFrame([(None, "n", k) for k in range(50)] + [(k, "a", k) for k in range(100)], "id int, at string, x int")
    right = spark.createDataFrame([(None, "n", -1), (None, None, -2)] + [(k, "a", -k) for k in range(50, 150)], "id int, at string, y int")
    joined = joins.full_join(left, right, ["id", "at"], split_hot)
    assert joined.columns == ["id", "at", "x", "y"] and joined.count() == 50 + 150 + 1
    assert joined.where("id IS NULL AND y = -1").count() == 50 and joined.where("x IS NULL").count() == 51
    assert joined.where("y IS NULL").count() == 50 and joined.where("id IS NULL AND at IS NULL AND y = -2").count() == 1


def test_a_full_join_of_tables_stored_by_person(spark):
    left = spark.createDataFrame([("p", 1, "a"), ("p", 1, "b"), ("p", None, "c"), ("q", 2, "d"), (None, 1, "e")], "pid string, at int, x string")
    right = spark.createDataFrame([("p", 1, "A"), ("p", None, "C"), ("p", 3, "D"), ("r", 1, "E"), (None, 2, "F")], "pid string, at int, y string")
    keys = ["pid", "at"]
    plain, stored = (sorted(map(str, joins.full_join(left, right, keys, stored_by=by).collect())) for by in (None, "pid"))
    assert stored == plain
    kept = joins.null_safe_join(left, right, keys, "left", stored_by="pid")
    assert sorted(map(str, kept.where("pid IS NOT NULL").collect())) == sorted(map(str, joins.null_safe_join(left, right, keys, "left").where("pid IS NOT NULL").collect()))


def test_unpivoted_rows_stay_where_they_are(spark):
    df = spark.createDataFrame([("a", 1, 2.5, None), ("b", None, 3.0, 4)], "id string, x int, `y z` double, w long").repartition(3, "id")
    long = reshape.unpivot(df, ["id"])
    assert sorted(map(tuple, long.collect()), key=str) == sorted([("a", "x", 1.0), ("a", "y z", 2.5), ("a", "w", None), ("b", "x", None), ("b", "y z", 3.0), ("b", "w", 4.0)], key=str)
    assert long.groupBy("id").count()._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1


def test_few_copies_make_no_lists_and_many_do(spark):
    df = spark.createDataFrame([("a", 1), ("b", 1000), ("c", 2500), ("d", 0), ("e", None)], "id string, n long")
    got = {r.id: (r["count"], r.last) for r in reshape.deal_copies(df, "n", "i").groupBy("id").agg(F.count("*").alias("count"), F.max("i").alias("last")).collect()}
    assert got == {"a": (1, 1), "b": (1000, 1000), "c": (2500, 2500)}
