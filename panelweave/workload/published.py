"""The published tables over the orders panel, and storing a panel."""

from __future__ import annotations

import uuid

from panelweave.operators.combine import stack_tagged
from panelweave.plans.counts import count_by_sweep, observed_ages, window_counts
from panelweave.sources.store import store
from panelweave.workload.orders_panel import LONG_SQL, panel_long, person_long, person_study
from panelweave.workload.registry import SQL, query, table
from panelweave.workload.survey_inputs import survey_files


@query(
    f"WITH {LONG_SQL} SELECT study, fup, name, value, count(*) AS n FROM long WHERE value <> 'No' GROUP BY ALL",
    name="count_by_sweep",
)
def counts_per_sweep(spark, sf):
    """Rows per region, year, attribute and value."""
    return count_by_sweep(panel_long(spark, sf))


@query(
    f"""WITH {LONG_SQL}, ages AS (SELECT min(fup) AS lo, max(fup) AS hi FROM long),
    years AS (SELECT CAST(unnest(range(lo, hi + 1)) AS INTEGER) AS age FROM ages)
    SELECT l.age AS low, h.age AS high, study, name, value, count(DISTINCT iid) AS n FROM long
    JOIN years l ON l.age <= fup JOIN years h ON h.age >= fup WHERE value <> 'No' GROUP BY ALL""",
    name="ever_in_window",
)
def persons_per_window(spark, sf):
    """Distinct customers per region, window of years, attribute and value.

    The years of a customer are combined before the region is joined on, so the join sees one row
    per customer and value.
    """
    observed = observed_ages(person_long(spark, sf), ["iid", "name", "value"])
    return window_counts(observed.join(person_study(spark, sf), "iid"))


@query(
    """WITH e AS (SELECT DISTINCT event_type AS study, user_id AS iid, CAST(day(ts) AS INTEGER) AS fup,
      CASE WHEN value >= 20 THEN 'High' ELSE 'Low' END AS value FROM events),
    days AS (SELECT CAST(unnest(range(1, 31)) AS INTEGER) AS age)
    SELECT l.age AS low, h.age AS high, study, 'spend' AS name, value, count(DISTINCT iid) AS n FROM e
    JOIN days l ON l.age <= fup JOIN days h ON h.age >= fup
    WHERE l.age >= (SELECT min(fup) FROM e) AND h.age <= (SELECT max(fup) FROM e) GROUP BY ALL"""
)
def ever_in_window_days(spark, sf):
    """The same over days of a month and types of event: many sweeps, much repetition."""
    from pyspark.sql import functions as F

    from panelweave.plans.counts import ever_in_window

    long = table(spark, sf, "events").select(
        F.col("event_type").alias("study"),
        F.col("user_id").alias("iid"),
        F.dayofmonth("ts").alias("fup"),
        F.lit("spend").alias("name"),
        F.when(F.col("value") >= 20, "High").otherwise("Low").alias("value"),
    )
    return ever_in_window(long)


@query(
    """SELECT 'customer' AS study, c_custkey AS iid, c_acctbal AS balance FROM customer
    UNION ALL SELECT 'supplier', s_suppkey, s_acctbal FROM supplier"""
)
def panel_store(spark, sf):
    """Write a panel partitioned by study to the shared folder and read it back."""
    frames = {
        "customer": table(spark, sf, "customer").selectExpr("c_custkey AS iid", "c_acctbal AS balance"),
        "supplier": table(spark, sf, "supplier").selectExpr("s_suppkey AS iid", "s_acctbal AS balance"),
    }
    return store(stack_tagged(frames, "study"), "panel", partition_by="study").select("study", "iid", "balance")


MARSTAT_FILES = r"^(b960322|marstat2|bd(\d|10)ms)$"


def stored_study_counts(spark, sf):
    """From files on disk to counts: store a study's files in parts, catalogue them, read what a rule needs, count."""
    from pyspark.sql import functions as F

    from panelweave.plans import bcs70
    from panelweave.sources.catalog import catalog_variables, value_labels
    from panelweave.sources.files import SurveyFiles
    from panelweave.sources.store import shared_folder

    files, root = survey_files(spark, sf, "bcs70"), f"{shared_folder(spark)}/study-{uuid.uuid4().hex}"
    for path in sorted({v.file_path for v in files.search(var_low=MARSTAT_FILES)}):
        store(files.open(path).repartition(3), path, path=f"{root}/bcs70/{path}.parquet")
    catalog = catalog_variables(spark, {"bcs70": f"{root}/bcs70"})
    stored = SurveyFiles.from_catalog(spark, catalog, "bcs70", value_labels(catalog))
    return bcs70.marstat(stored).groupBy("fup", "marstat").agg(F.count("*").alias("n"))


def register_stored_counts() -> None:
    """The SQL is that of the rule, counted; it is registered once the rule is."""
    sql = f"SELECT fup, marstat, count(*) AS n FROM ({SQL['bcs70_marstat']}) GROUP BY ALL"
    query(sql)(stored_study_counts)
