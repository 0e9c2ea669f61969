"""Survey files from disk to the published counts, against the wide panel."""

import pandas as pd
import pytest
from pyspark.sql import functions as F

from panelweave.operators.combine import stack
from panelweave.operators.levels import levels_of, with_levels
from panelweave.operators.reshape import unpivot
from panelweave.plans import counts, mcs, panel
from panelweave.plans import dictionaries as d
from panelweave.plans.common import Study
from panelweave.sources import stata
from panelweave.sources.catalog import catalog_variables, search_catalog, study_roots, value_labels, write_lookup_csv
from panelweave.sources.files import SurveyFiles
from panelweave.sources.joined import stacked_once
from panelweave.sources.store import store


def study_with_ties(spark):
    """Two persons; p has two sexes and two religions at 5, q has no data but responds."""
    sample = spark.createDataFrame([("p", "p"), ("q", "q")], "pid string, iid string")
    response = spark.createDataFrame(
        [("p", 0, "p"), ("p", 5, "p"), ("q", 5, "q"), ("p", 26, "p")], "pid string, fup int, iid string"
    )
    clean = {
        "sex": spark.createDataFrame([("p", "Male"), ("p", "Female")], "pid string, sex string"),
        "religion": spark.createDataFrame(
            [("p", 5, "Hindu"), ("p", 5, "Hindu"), ("p", 10, "Sikh"), ("q", 0, "Sikh"), ("x", 5, "Sikh")],
            "pid string, fup int, religion string",
        ),
        "social_class": spark.createDataFrame(
            [("p", 5, "a", None), ("p", 26, None, "b"), ("q", 5, None, None)],
            "pid string, fup int, rgsc string, nssec string",
        ),
        "sen": spark.createDataFrame([("p", 5, "No"), ("q", 5, "Yes")], "pid string, fup int, sen string"),
    }
    return Study("bcs70", ["pid"], sample, response, clean)


def test_counts_from_tables_equal_counts_from_the_wide_panel(spark):
    study = study_with_ties(spark)
    tables = panel.stack_studies([study])
    long = panel.long_panel(panel.responder_panel(tables["wide"], tables["response"]))
    values = panel.responder_values([study])

    def rows(df, *columns):
        return sorted(tuple(r) for r in df.select(*columns).collect())

    keys = ("study", "fup", "name", "value", "n")
    by_sweep = rows(counts.count_values_by_sweep(values), *keys)
    assert by_sweep == rows(counts.count_by_sweep(long), *keys)
    assert ("bcs70", 5, "religion", "Hindu", 4) in by_sweep
    assert ("bcs70", 5, "response", "Yes", 5) in by_sweep
    windows = ("low", "high", "study", "name", "value", "n")
    assert rows(counts.values_ever_in_window(values), *windows) == rows(counts.ever_in_window(long, 0, 55), *windows)
    assert tables["sample"].count() == 2


def test_panel_by_aggregation_equals_the_chain_of_joins(spark, monkeypatch):
    """Ties, repeated entries, repeated responses, and persons without data."""
    study = study_with_ties(spark)
    study = Study(study.name, study.keys, study.sample, study.response.unionByName(study.response.where("pid = 'p' AND fup = 5")), study.clean)
    monkeypatch.setattr(panel, "ATTRIBUTES", {n: n for n in ("sex", "religion", "rgsc", "nssec", "sen", "response")})
    tables = panel.stack_studies([study])
    wanted = panel.responder_panel(tables["wide"], tables["response"])
    got = panel.responder_table([study])

    def listed(df):
        return sorted(str(tuple(r)) for r in df.select("study", "iid", "fup", "response", "sex", "religion", "rgsc", "nssec", "sen").collect())

    assert listed(got) == listed(wanted)
    assert got.where("iid = 'p' AND fup = 5 AND religion = 'Hindu'").count() == 8


def test_a_person_with_very_many_equal_entries_arrives_as_one(spark):
    study = study_with_ties(spark)
    many = spark.range(3000).select(F.lit("q").alias("pid"), F.lit(5).alias("fup"), F.lit("Sikh").alias("religion"))
    study = Study(study.name, study.keys, study.sample, study.response, {**study.clean, "religion": many})
    got = panel.responder_table([study])
    assert got.where("iid = 'q' AND religion = 'Sikh'").count() == 3000 and got.where("iid = 'p'").count() == 6


def test_orders_of_categories_reach_the_published_tables(spark):
    study = study_with_ties(spark)
    clean = {t: with_levels(df, d.CATEGORIES) for t, df in study.clean.items()}
    values = panel.responder_values([Study(study.name, study.keys, study.sample, study.response, clean)])
    assert levels_of(values)["religion"] == d.RELIGION
    rows = counts.published(counts.count_values_by_sweep(values), "fup", code=True).collect()
    assert {(r.value, r.code) for r in rows if r.name_clean == "Religion"} == {("Hindu", 4)}
    listed = counts.var_levels(values)
    assert [r.value for r in listed.where("name_clean = 'Religion'").orderBy("code").collect()] == d.RELIGION
    assert listed.where("name_clean = 'Sex' AND value = 'Male'").first().n > 0
    long = unpivot(with_levels(spark.createDataFrame([(1, "No", "Male")], "id int, carer string, sex string"), d.CATEGORIES), ["id"])
    assert levels_of(stack([long, long])) == {"carer": d.BINARY, "sex": d.SEX}
    other = long.withColumn("value", F.col("value").alias("value", metadata={"levels": {"sex": ["x"]}}))
    with pytest.raises(ValueError, match="two orders"):
        stack([long, other])


def test_persons_and_rows_per_sweep(spark):
    values = panel.responder_values([study_with_ties(spark)])
    rows = {(r.fup, r.name, r.value): r.n for r in counts.count_values_by_sweep(values).collect()}
    persons = {(r.fup, r.name, r.value): r.n for r in counts.count_values_by_sweep(values, distinct=True).collect()}
    assert set(rows) == set(persons) and rows[5, "religion", "Hindu"] == 4 and persons[5, "religion", "Hindu"] == 1


def test_stacked_files_equal_the_files(spark):
    frames = {
        "3y/a": spark.createDataFrame([("f", 1.0, 5.0, 6.0, 1), ("f", 1.0, 7.0, None, 2), ("g", None, 8.0, 9.0, 3)], "MCSID string, BCNUM00 double, BX00 double, CY00_R20 double, _row long"),
        "5y/b": spark.createDataFrame([("f", 3.0, 4), (None, 4.0, 5)], "MCSID string, CX00 double, _row long"),
        "5y/c": spark.createDataFrame([("h", "t", 6)], "MCSID string, CZ00 string, _row long"),
    }
    files = SurveyFiles.from_frames(frames)

    def rules(f):
        found = f.search(var_low="(x|y)00")
        return [
            f.load_stacked(found, mcs.IDS, "mcsid", suffix="_r20$").select("mcsid", "sweep", "x00", "y00", "cnum00", "_row", "_file"),
            f.load_stacked(f.search(var_low="x00"), mcs.IDS, "mcsid", per_variable=True).select("mcsid", "sweep", "x00", "cnum00", "_row", "_file"),
            f.load("3y/a", mcs.IDS, ["BX00"], row=True),
            f.load("5y/c", mcs.IDS),
        ]

    rules.reads = 4
    once = stacked_once(spark, files, "mcsid", [rules])
    for a, b in zip(rules(files), rules(once), strict=True):
        assert sorted(map(str, a.select(*b.columns).collect())) == sorted(map(str, b.collect()))
        assert "LogicalRDD" not in b._jdf.queryExecution().optimizedPlan().toString()  # nothing is read from the files again


def test_published_names(spark):
    df = spark.createDataFrame([("bcs70", 5, "rgsc", "a", 1)], "study string, fup int, name string, value string, n long")
    row = counts.published(df, "fup").first()
    assert (row.study_clean, row.name_clean) == ("BCS70", "Registrar General's Social Class")


def test_category_levels(spark):
    levels = counts.category_levels(spark)
    assert levels.filter("attribute = 'nssec'").orderBy("code").first().label == "Managerial & Professional"
    assert levels.count() == sum(len(v) for v in d.CATEGORIES.values())


def write_stata(root, name, df, **labels):
    path = root / f"{name}.dta"
    path.parent.mkdir(parents=True, exist_ok=True)
    df.to_stata(path, write_index=False, version=118, **labels)


def test_stata_catalogue_and_conversion(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(stata, "ROWS_PER_TASK", 40)
    monkeypatch.setattr(stata, "ROWS_PER_BATCH", 15)
    df = pd.DataFrame({"NSID": [f"N{i}" for i in range(100)], "W8DCTRY": [None, 1.0, 2.0, -1.0] * 25})
    labels = {"variable_labels": {"W8DCTRY": "Country"}, "value_labels": {"W8DCTRY": {1: "England", 2: "Wales"}}}
    write_stata(tmp_path, "eul/ns8_main", df, **labels)
    write_stata(tmp_path, "UKDS_old/ns8_main", df)
    write_stata(tmp_path, "at_root", df)
    roots = study_roots({"next_steps_fld": str(tmp_path), "OTHER": "x"})
    catalog = catalog_variables(spark, roots, "dta")
    found = sorted((r.fld, r.dta, r.pos, r.variable, r.col_type, r.lab_low) for r in catalog.collect())
    assert found == [("eul", "ns8_main", 1, "NSID", "chr", ""), ("eul", "ns8_main", 2, "W8DCTRY", "dbl+lbl", "country")]
    path = catalog.first().file_path
    header = stata.stata_headers(catalog.select("file_path").distinct()).collect()
    data = stata.read_stata(spark, path, header)
    got = data.orderBy("_row").collect()
    assert [r.NSID for r in got] == list(df.NSID) and [r._row for r in got] == list(range(100))
    assert [r.W8DCTRY for r in got] == [None, 1.0, 2.0, -1.0] * 25

    parquet = tmp_path / "parquet" / "eul"
    store(data.repartition(3), "ns8_main", path=str(parquet / "ns8_main.parquet"))
    assert len(list(parquet.rglob("*.parquet/part-*.parquet"))) == 3
    again = catalog_variables(spark, {"next_steps": str(tmp_path / "parquet")})
    row = search_catalog(again, variable="^W8DCTRY$").first()
    assert row.label == "Country" and [v.label for v in row.value_labels] == ["England", "Wales"]
    assert row.file_path.endswith("eul/ns8_main.parquet") and (row.fld, row.dta) == ("eul", "ns8_main")
    files = SurveyFiles.from_catalog(spark, again, "next_steps", value_labels(again))
    from panelweave.plans import next_steps

    country = next_steps.country(files).groupBy("country").count().collect()
    assert {(r.country, r["count"]) for r in country} == {(None, 50), ("England", 25), ("Wales", 25)}
    write_lookup_csv(again, str(tmp_path / "lookup"))
    assert spark.read.csv(str(tmp_path / "lookup"), header=True).count() == 2


def test_first_answer_in_file_order(spark):
    """Two parents answer for a child: the one that comes first in the file counts."""
    columns = "MCSID string, CCNUM00 double, CPFREM00 double, CPELFR00 double, CPSCHD00 double, _row long"
    rows = [("f", 1.0, None, 1.0, None, 5), ("f", 1.0, 1.0, None, None, 3), ("f", 1.0, None, None, None, 1)]
    rows += [("f", 2.0, 2.0, None, 2.0, 7), ("f", 2.0, 2.0, 1.0, None, 8)]
    files = SurveyFiles.from_frames({"5y/mcs3_parent_interview": spark.createDataFrame(rows, columns)})
    got = sorted((r.pid, r.cnum, r.fup, r.fsm) for r in mcs.fsm(files).collect())
    assert got == [("f", 1, 5, "No"), ("f", 2, 5, "No")]


def test_store_partitions_by_study(spark, tmp_path):
    df = spark.createDataFrame([("a", 1), ("b", 2)], "study string, x int")
    back = store(df, "panel", partition_by="study", path=str(tmp_path / "panel"))
    assert (tmp_path / "panel" / "study=a").exists()
    assert back.filter(F.col("study") == "b").first().x == 2


def test_panel_of_all_studies(spark):
    from panelweave.workload import QUERIES

    panel = QUERIES["harmonised_panel_all"](spark, "/root/testdata/sf0.001")
    assert {"gender_identity", "carer"} <= set(panel.columns)
    rows = {r.study: (r.n, r.persons) for r in panel.groupBy("study").agg(F.count("*").alias("n"), F.count_distinct("iid").alias("persons")).collect()}
    assert set(rows) == {"mcs", "next_steps", "bcs70", "ncds"}
    assert all(n > persons > 0 for n, persons in rows.values())


def test_classes_of_persons_give_the_rows_of_all(spark, tmp_path, monkeypatch):
    """Cut into classes, the tables are the same, and nothing but their results stays on the disk."""
    from panelweave.plans import ncds
    from panelweave.sources import store as stored
    from panelweave.workload import survey_inputs

    keys = [(i * 7, i) for i in range(60)] + [(7, 1), (None, 3)]
    spark.createDataFrame(keys, "o_orderkey long, o_custkey long").write.parquet(str(tmp_path / "orders.parquet"))
    spark.createDataFrame([(1, 1, 1, 1)], "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long").write.parquet(str(tmp_path / "lineitem.parquet"))
    monkeypatch.setattr(stored, "shared_folder", lambda spark: str(tmp_path / "shared"))
    monkeypatch.setattr(ncds, "RULES", [ncds.sex, ncds.marstat])

    def rows(class_rows):
        monkeypatch.setattr(survey_inputs, "OTHER_CLASS_ROWS", class_rows)
        found = survey_inputs.in_classes(spark, str(tmp_path), lambda s: counts.count_values_by_sweep(panel.responder_values(s)), ("ncds",))
        return sorted(map(str, survey_inputs.summed(found).collect()))

    whole = rows(10**6)
    assert whole and rows(120) == whole
    left = {p.parent.name.split("-")[0].split("_")[0] for p in (tmp_path / "shared").rglob("part-*") if p.stat().st_size > 2000}
    assert left <= {"classes"}


def test_a_class_reads_its_part_of_the_given_tables(spark, tmp_path, monkeypatch):
    """The tables are cut by person once; a class finds all its rows, those without a person too, in its parts."""
    from panelweave.sources import store as stored
    from panelweave.sources.joined import one_class
    from panelweave.workload import survey_inputs

    orders = [(i, i % 7) for i in range(40)] + [(3, 9), (3, 9), (None, 1)]
    lines = [(i % 40, i % 3 + 1, i, i + 1) for i in range(90)] + [(None, 1, 4, 4), (5, None, 4, 4)]
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long").write.parquet(str(tmp_path / "orders.parquet"))
    spark.createDataFrame(lines, "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long").write.parquet(str(tmp_path / "lineitem.parquet"))
    monkeypatch.setattr(stored, "shared_folder", lambda spark: str(tmp_path / "shared"))
    given = survey_inputs.cut_by_person(spark, str(tmp_path), 4)
    shares = [given(which, 4) for which in range(4)]
    assert sorted(str(tuple(r)) for o, _ in shares for r in o.collect()) == sorted(str(r) for r in orders)
    assert max(line.count() for _, line in shares) < len(lines)
    path = "17y/mcs7_cm_interview"
    for of in (2, 4, 8):
        for which in range(of):
            whole, cut = (one_class(survey_inputs.survey_files(spark, str(tmp_path), "mcs", g), "mcsid", which, of).open(path) for g in (None, given(which, of)))
            assert sorted(map(str, whole.collect())) == sorted(map(str, cut.collect()))


def test_two_studies_at_a_time_in_classes(spark, tmp_path, monkeypatch):
    """Cut into classes, the disk holds what two studies need; the parts of the given tables go at the end."""
    import threading

    from panelweave.plans import bcs70, ncds, next_steps
    from panelweave.sources import store as stored
    from panelweave.workload import survey_inputs

    keys = [(i, i % 5) for i in range(60)]
    spark.createDataFrame(keys, "o_orderkey long, o_custkey long").write.parquet(str(tmp_path / "orders.parquet"))
    spark.createDataFrame([(1, 1, 1, 1)], "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long").write.parquet(str(tmp_path / "lineitem.parquet"))
    monkeypatch.setattr(stored, "shared_folder", lambda spark: str(tmp_path / "shared"))
    monkeypatch.setattr(survey_inputs, "OTHER_CLASS_ROWS", 200)
    for plan in (bcs70, ncds, next_steps):
        monkeypatch.setattr(plan, "RULES", [plan.marstat])
    threads = set()

    def work(studies):
        threads.add(threading.get_ident())
        return studies[0].sample.select("iid")

    found = survey_inputs.in_classes(spark, str(tmp_path), work, ("next_steps", "bcs70", "ncds"))
    assert sorted(r.iid for r in found.collect()) == sorted(f"P{i}" for i, _ in keys for _ in range(3))
    assert len(threads) <= 2
    given = [p for p in (tmp_path / "shared").glob("given-*/part=*/*.parquet")]
    assert (tmp_path / "shared").exists() and not given


def test_responders_meet_their_tables_without_shuffling_the_entries(spark, monkeypatch):
    """What is stored by person is not shuffled again to be counted by person."""
    frames = {"w/a": spark.createDataFrame([("p", 1.0, 1.0), ("q", 2.0, 1.0)], "ID string, A double, R double")}
    files = SurveyFiles.from_frames(frames)
    from panelweave.sources.joined import joined_once

    once = joined_once(spark, files, "id", [lambda f: f.load("w/a", "^ID$")])
    df = once.load("w/a", "^ID$")
    one = df.selectExpr("id AS pid", "CASE WHEN a = 1 THEN 'Male' ELSE 'Female' END AS sex")
    two = df.selectExpr("id AS pid", "5 AS fup", "'Sikh' AS religion")
    response = df.selectExpr("id AS pid", "5 AS fup", "id AS iid")
    values = panel.responder_values([Study("bcs70", ["pid"], df.selectExpr("id AS pid"), response, {"sex": one, "religion": two})])
    assert "Exchange" not in values._jdf.queryExecution().executedPlan().toString().replace("AQEShuffleRead", "")
    assert sorted((r.iid, r.name, r.value) for r in values.collect() if r.name != "response") == [("p", "religion", "Sikh"), ("p", "sex", "Male"), ("q", "religion", "Sikh"), ("q", "sex", "Female")]


def test_windows_from_persons_counted_by_ages(spark):
    values = panel.responder_values([study_with_ties(spark)])
    by_ages = counts.persons_by_ages(values)
    assert {(r.name, r.value, tuple(r.ages), r.n) for r in by_ages.collect()} >= {("response", "Yes", (0, 5, 26), 1), ("response", "Yes", (5,), 1)}
    whole, counted = (sorted(map(str, counts.values_ever_in_window(v).collect())) for v in (values, by_ages))
    assert whole == counted


def test_what_is_done_by_person_needs_no_shuffle(spark, tmp_path, monkeypatch):
    """From the stored given tables on, files, rules and responders of all studies stay in their buckets of persons."""
    from panelweave.plans import mcs, ncds, next_steps
    from panelweave.sources import store as stored
    from panelweave.workload import survey_inputs

    spark.createDataFrame([(i, i % 5) for i in range(60)], "o_orderkey long, o_custkey long").write.parquet(str(tmp_path / "orders.parquet"))
    lines = [(i % 60, i % 3 + 1, i, i + 1) for i in range(150)]
    spark.createDataFrame(lines, "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long").write.parquet(str(tmp_path / "lineitem.parquet"))
    monkeypatch.setattr(stored, "shared_folder", lambda spark: str(tmp_path / "shared"))
    monkeypatch.setattr(ncds, "RULES", [ncds.sex, ncds.social_class])
    monkeypatch.setattr(next_steps, "RULES", [next_steps.sex, next_steps.sexuality, next_steps.religion])
    monkeypatch.setattr(mcs, "RULES", [mcs.gender, mcs.fsm])
    plans = {}

    def work(studies):
        plans[studies[0].name] = "".join(f(studies)._jdf.queryExecution().executedPlan().toString() for f in (panel.responder_values, panel.responder_table))
        return counts.count_values_by_sweep(panel.responder_values(studies))

    names = ("ncds", "next_steps", "mcs")
    monkeypatch.setattr(survey_inputs, "BUCKET_ROWS", {"orders": 10, "lineitem": 30})
    before = spark.conf.get("spark.sql.shuffle.partitions")
    found = survey_inputs.in_classes(spark, str(tmp_path), work, names)
    assert found.count() and spark.conf.get("spark.sql.shuffle.partitions") == before
    assert {name: plan.count("Exchange hashpartitioning") for name, plan in plans.items()} == dict.fromkeys(names, 0)
