"""Unpivots, pivots, replication, lists, grids and levels over the given tables."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from panelweave.operators import reshape as r
from panelweave.plans.counts import category_levels, observed_levels, windows_between
from panelweave.sources.catalog import catalog_variables, labels_to_grid, value_labels
from panelweave.sources.store import shared_folder, store
from panelweave.workload.orders_panel import LEVELS, LONG_SQL, PERSON_SQL, person_long, person_study, person_years
from panelweave.workload.recodes import _NULLED, _nulled
from panelweave.workload.registry import SQL, query, table


@query(
    f"""WITH x AS {_NULLED} SELECT o_orderkey, 'a' AS name, a AS value FROM x UNION ALL
    SELECT o_orderkey, 'b', b FROM x UNION ALL SELECT o_orderkey, 'c', c FROM x"""
)
def unpivot_name_value(spark, sf):
    return r.unpivot(_nulled(spark, sf), ["o_orderkey"])


@query(
    f"""WITH x AS {_NULLED} SELECT * FROM (SELECT o_orderkey, 'a' AS name, a AS value FROM x UNION ALL
    SELECT o_orderkey, 'b', b FROM x UNION ALL SELECT o_orderkey, 'c', c FROM x) WHERE value IS NOT NULL"""
)
def long_nonnull(spark, sf):
    """Unpivot and keep what is known."""
    return r.unpivot(_nulled(spark, sf), ["o_orderkey"]).na.drop()


def _wide_lines(spark, sf):
    """One column per line number and measure, named <line><measure>."""
    line, cells = F.col("l_linenumber"), []
    for i in range(1, 8):
        cells.append(F.max(F.when(line == i, F.col("l_quantity"))).alias(f"{i}qty"))
        if i < 7:
            cells.append(F.max(F.when(line == i, F.col("l_discount"))).alias(f"{i}disc"))
    return table(spark, sf, "lineitem").groupBy("l_orderkey").agg(*cells)


_LINES = "lines AS (SELECT DISTINCT l_orderkey FROM lineitem)"


@query(
    f"""WITH {_LINES}, m AS (SELECT l_orderkey, l_linenumber, max(l_quantity) AS qty, max(l_discount) AS disc
    FROM lineitem GROUP BY ALL) SELECT lines.l_orderkey, CAST(i AS VARCHAR) AS sweep, qty,
    CASE WHEN i < 7 THEN disc END AS disc
    FROM lines CROSS JOIN (SELECT unnest(range(1, 8)) AS i) LEFT JOIN m ON m.l_orderkey = lines.l_orderkey AND l_linenumber = i"""
)
def unpivot_multi_value(spark, sf):
    """Two measures per sweep; the last sweep has no discount column."""
    return r.unpivot_multi_value(_wide_lines(spark, sf), ["l_orderkey"])


@query(
    f"""WITH {_LINES}, m AS (SELECT l_orderkey, l_linenumber, max(l_quantity) AS qty FROM lineitem GROUP BY ALL)
    SELECT lines.l_orderkey, CAST(i AS INTEGER) AS fup, qty
    FROM lines CROSS JOIN (SELECT unnest(range(1, 8)) AS i) LEFT JOIN m ON m.l_orderkey = lines.l_orderkey AND l_linenumber = i"""
)
def clean_to_long(spark, sf):
    """Columns qty_1 to qty_7 to rows; the discounts do not match the prefix."""
    wide = _wide_lines(spark, sf)
    wide = wide.withColumnsRenamed({c: f"qty_{c[0]}" for c in wide.columns if c.endswith("qty")})
    return r.clean_to_long(wide, "qty", ["l_orderkey"])


@query(
    """SELECT code, max(CASE WHEN variable = 'priority' THEN label END) AS priority,
    max(CASE WHEN variable = 'returnflag' THEN label END) AS returnflag,
    max(CASE WHEN variable = 'status' THEN label END) AS status FROM (
    SELECT 'priority' AS variable, CAST(left(o_orderpriority, 1) AS DOUBLE) AS code, substr(o_orderpriority, 3) AS label FROM orders
    UNION ALL SELECT 'status', CAST(ascii(o_orderstatus) - 64 AS DOUBLE), o_orderstatus FROM orders
    UNION ALL SELECT 'returnflag', CAST(ascii(l_returnflag) - 64 AS DOUBLE), l_returnflag FROM lineitem) GROUP BY code"""
)
def value_label_grid(spark, sf):
    """Codes against variables, labels in the cells."""
    orders, lines = table(spark, sf, "orders"), table(spark, sf, "lineitem")

    def labels(df, variable, code, label):
        return df.select(F.lit(variable).alias("variable"), code.cast("double").alias("code"), label.alias("label"))

    letter = F.col("o_orderstatus")
    flag = F.col("l_returnflag")
    rows = (
        labels(orders, "priority", F.substring("o_orderpriority", 1, 1), F.expr("substring(o_orderpriority, 3)"))
        .unionByName(labels(orders, "status", F.ascii(letter) - 64, letter))
        .unionByName(labels(lines, "returnflag", F.ascii(flag) - 64, flag))
    )
    return labels_to_grid(rows, ["priority", "returnflag", "status"])


@query(SQL["value_label_grid"])
def label_grid_from_files(spark, sf):
    """The same from files whose columns carry their labels: store them, catalogue them, explode the label arrays.

    The labels of a variable are its different codes, few enough for a column's metadata.
    """
    orders, lines, root = table(spark, sf, "orders"), table(spark, sf, "lineitem"), f"{shared_folder(spark)}/labels-{uuid.uuid4().hex}"
    priority = (orders, "priority", F.substring("o_orderpriority", 1, 1).cast("double"), F.expr("substring(o_orderpriority, 3)"))
    status = (orders, "status", (F.ascii("o_orderstatus") - 64).cast("double"), F.col("o_orderstatus"))
    flag = (lines, "returnflag", (F.ascii("l_returnflag") - 64).cast("double"), F.col("l_returnflag"))
    for file, key, variables in (("w1/orders", "o_orderkey", [priority, status]), ("w2/lines", "l_orderkey", [flag])):
        cells = []
        for df, name, code, label in variables:
            known = df.select(code.alias("code"), label.alias("label")).where("code IS NOT NULL").distinct()
            labels = [{"label": r["label"], "code": r["code"]} for r in known.orderBy("code").collect()]
            cells.append(code.alias(name.upper(), metadata={"label": f"Code of {name}", "value_labels": labels}))
        store(variables[0][0].select(key, *cells), file, path=f"{root}/{file}.parquet")
    labels = value_labels(catalog_variables(spark, {"shop": root}))
    grid = labels_to_grid(labels, ["PRIORITY", "RETURNFLAG", "STATUS"])
    return grid.toDF(*[c.lower() for c in grid.columns])


@query(
    """SELECT c_custkey, CAST(i AS INTEGER) AS cnum FROM customer JOIN (SELECT unnest(range(1, 10)) AS i)
    ON i <= CASE WHEN c_mktsegment <> 'MACHINERY' THEN c_nationkey % 3 END"""
)
def uncount_members(spark, sf):
    """Each customer 0, 1 or 2 times, numbered; a null count gives no row."""
    n = F.when(F.col("c_mktsegment") != "MACHINERY", F.col("c_nationkey") % 3)
    return r.uncount(table(spark, sf, "customer"), n, "cnum").select("c_custkey", "cnum")


@query(
    """SELECT l_orderkey, CAST(sum(times) AS BIGINT) AS n, string_agg(l_linenumber || 'x' || times, ',' ORDER BY l_linenumber) AS lines
    FROM (SELECT l_orderkey, l_linenumber, count(*) AS times FROM lineitem GROUP BY ALL) GROUP BY l_orderkey"""
)
def chop_collect(spark, sf):
    """The line numbers of an order as one list of values and how often each occurs."""
    chopped = r.chop_runs(table(spark, sf, "lineitem"), ["l_orderkey"], "l_linenumber", "runs")
    total = F.aggregate("runs", F.lit(0).cast("long"), lambda acc, run: acc + run["times"])
    text = F.transform("runs", lambda run: F.concat_ws("x", run["value"], run["times"]))
    return chopped.select("l_orderkey", total.alias("n"), F.array_join(text, ",").alias("lines"))


@query("SELECT l_orderkey, l_linenumber FROM lineitem")
def unchop_rows(spark, sf):
    """Lists back to rows: every input row returns."""
    chopped = r.chop_runs(table(spark, sf, "lineitem"), ["l_orderkey"], "l_linenumber", "runs")
    return r.unchop_runs(chopped, "runs", "l_linenumber")


@query(
    f"""WITH {LONG_SQL}, ages AS (SELECT min(fup) AS lo, max(fup) AS hi FROM long),
    years AS (SELECT CAST(unnest(range(lo, hi + 1)) AS INTEGER) AS age FROM ages)
    SELECT study, l.age AS low, h.age AS high FROM (SELECT DISTINCT study FROM long), years l, years h WHERE l.age <= h.age"""
)
def age_window_grid(spark, sf):
    """All windows between the first and last year observed, per study."""
    spans = person_years(spark, sf).groupBy("iid").agg(F.min("fup").alias("first"), F.max("fup").alias("last"))
    return windows_between(spans.join(person_study(spark, sf), "iid"))


_CALENDAR = """calendar AS (SELECT o_orderpriority AS study, CAST(year(o_orderdate) AS INTEGER) AS fup FROM orders
  GROUP BY ALL HAVING count(*) % 2 = 1),
  ages AS (SELECT min(fup) AS lo, max(fup) AS hi FROM calendar),
  years AS (SELECT CAST(unnest(range(lo, hi + 1)) AS INTEGER) AS age FROM ages)"""


@query(
    f"""WITH {_CALENDAR} SELECT study, l.age AS low, h.age AS high, string_agg(CAST(fup AS VARCHAR), ',' ORDER BY fup) AS sweeps
    FROM calendar JOIN years l ON l.age <= fup JOIN years h ON h.age >= fup GROUP BY ALL"""
)
def window_sweep_sets(spark, sf):
    """The sweeps inside each window, for studies with gaps; windows without a sweep are left out."""
    orders = table(spark, sf, "orders").select(F.col("o_orderpriority").alias("study"), F.year("o_orderdate").alias("fup"))
    sweeps = orders.groupBy("study", "fup").agg(F.count("*").alias("n")).filter("n % 2 = 1")
    bounds = {"first": sweeps.agg(F.min("fup")).scalar(), "last": sweeps.agg(F.max("fup")).scalar()}
    calendar = sweeps.groupBy("study").agg(F.array_sort(F.collect_set("fup")).alias("ages")).withColumns(bounds)
    sets = r.window_sweep_sets(calendar)
    return sets.select("study", F.array_join("fups", ",").alias("sweeps"), F.inline("windows"))


@query(
    f"""WITH {LONG_SQL}, levels(attribute, code, label) AS (VALUES
    ('priority', 1, 'Urgent'), ('priority', 2, 'High'), ('priority', 3, 'Medium'), ('priority', 4, 'Not Specified'),
    ('priority', 5, 'Low'), ('priority', 6, 'None'), ('status', 1, 'Cancelled'), ('status', 2, 'Finished'),
    ('status', 3, 'Open'), ('status', 4, 'Pending'), ('large', 1, 'No'), ('large', 2, 'Yes'))
    SELECT attribute, CAST(row_number() OVER (PARTITION BY attribute ORDER BY code) AS INTEGER) AS code, label FROM levels
    WHERE (attribute, label) IN (SELECT DISTINCT name, value FROM long)"""
)
def category_levels_query(spark, sf):
    """The categories that occur, in their order, unused ones dropped."""
    return observed_levels(category_levels(spark, LEVELS), person_long(spark, sf))


@query(f"WITH {PERSON_SQL} SELECT iid, fup, priority, status, large FROM person")
def select_by_type(spark, sf):
    """Keys, then all text columns."""
    panel = person_years(spark, sf)
    texts = [f.name for f in panel.schema.fields if f.dataType.simpleString() == "string"]
    return panel.select("iid", "fup", *texts)
