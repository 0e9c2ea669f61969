"""The variable catalogue of the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelweave.sources.catalog import catalog_variables, search_catalog
from panelweave.workload.registry import query

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()

_COLUMNS = f"""(SELECT DISTINCT table_name, column_name, ordinal_position, data_type FROM information_schema.columns
  WHERE table_name IN ({", ".join(f"'{t}'" for t in TABLES)}))"""
_TYPE = """CASE WHEN data_type LIKE '%[]' THEN 'list' WHEN data_type IN ('INTEGER', 'BIGINT') THEN 'int'
  WHEN data_type IN ('DOUBLE', 'FLOAT') THEN 'dbl' WHEN data_type = 'VARCHAR' THEN 'chr'
  WHEN data_type LIKE 'TIMESTAMP%' THEN 'dttm' END"""


def _catalog(spark, sf):
    root, _, folder = sf.rstrip("/").rpartition("/")
    return catalog_variables(spark, {"tables": root}, below=folder).filter(F.col("dta").isin(TABLES))


@query(
    f"""SELECT 'tables' AS study, table_name AS dta, CAST(ordinal_position AS INTEGER) AS pos, column_name AS variable,
    {_TYPE} AS col_type, lower(column_name) AS var_low FROM {_COLUMNS}""",
    name="catalog_variables",
)
def variables(spark, sf):
    """Every column of every file: position, name and type."""
    return _catalog(spark, sf).select("study", "dta", "pos", "variable", "col_type", "var_low")


@query(
    f"""SELECT table_name AS dta, column_name AS variable FROM {_COLUMNS}
    WHERE regexp_matches(column_name, 'key$|_id$') AND regexp_matches(table_name, '^(l|c|e)')
    AND NOT (column_name = 'l_suppkey' AND table_name = 'lineitem')"""
)
def catalog_search(spark, sf):
    """Keys in some of the files, one of them excluded."""
    found = search_catalog(
        _catalog(spark, sf),
        exclude={"variable": "^l_suppkey$", "dta": "^lineitem$"},
        var_low="key$|_id$",
        dta="^(l|c|e)",
    )
    return found.select("dta", "variable")
