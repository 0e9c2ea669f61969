"""The given orders as a panel: a customer is a person, a year a sweep, a region a study."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelweave.functions.recode import code_to_category, if_else, recode
from panelweave.operators.reshape import unpivot
from panelweave.workload.registry import table

PRIORITY = ["Urgent", "High", "Medium", "Not Specified", "Low"]
STATUS = ["Finished", "Open", "Pending"]
LARGE = ["No", "Yes"]
LEVELS = {"priority": [*PRIORITY, "None"], "status": ["Cancelled", *STATUS], "large": LARGE}


def priority_code():
    return F.substring("o_orderpriority", 1, 1).try_cast("double")


def status_code():
    letter = F.ascii("o_orderstatus").cast("double")
    return recode(letter, [([ord("F")], 1), ([ord("O")], 2), ([ord("P")], 3)])


def person_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order: person, year and three attributes."""
    large = if_else(F.col("o_totalprice") >= 250000, F.lit(2), F.lit(1))
    return table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("iid"),
        F.year("o_orderdate").alias("fup"),
        code_to_category(priority_code(), PRIORITY).alias("priority"),
        code_to_category(status_code(), STATUS).alias("status"),
        code_to_category(large, LARGE).alias("large"),
    )


def person_study(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The region of each customer."""
    nation = table(spark, sf_dir, "nation").join(
        table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    customer = table(spark, sf_dir, "customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    return customer.select(F.col("c_custkey").alias("iid"), F.col("r_name").alias("study"))


def person_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Person, year, attribute and value, without the study."""
    return unpivot(person_years(spark, sf_dir), ["iid", "fup"])


def panel_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The long panel with its study, joined while an order is one row."""
    panel = person_years(spark, sf_dir).join(person_study(spark, sf_dir), "iid")
    return unpivot(panel, ["study", "iid", "fup"])


PERSON_SQL = """
person AS (
  SELECT o_custkey AS iid, CAST(year(o_orderdate) AS INTEGER) AS fup,
    CASE left(o_orderpriority, 1) WHEN '1' THEN 'Urgent' WHEN '2' THEN 'High' WHEN '3' THEN 'Medium'
      WHEN '4' THEN 'Not Specified' WHEN '5' THEN 'Low' END AS priority,
    CASE o_orderstatus WHEN 'F' THEN 'Finished' WHEN 'O' THEN 'Open' WHEN 'P' THEN 'Pending' END AS status,
    CASE WHEN o_totalprice >= 250000 THEN 'Yes' ELSE 'No' END AS large
  FROM orders)
"""

LONG_SQL = f"""
{PERSON_SQL},
panel AS (
  SELECT r_name AS study, person.* FROM person JOIN customer ON iid = c_custkey
  JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
long AS (
  SELECT study, iid, fup, 'priority' AS name, priority AS value FROM panel UNION ALL
  SELECT study, iid, fup, 'status', status FROM panel UNION ALL
  SELECT study, iid, fup, 'large', large FROM panel)
"""
