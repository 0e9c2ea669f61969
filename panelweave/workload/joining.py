"""Joins, stacks and first observations over the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelweave.functions.missing import negative_to_null
from panelweave.functions.names import str_sub, to_int
from panelweave.functions.recode import code_to_category, sweep_to_age
from panelweave.operators import joins as j
from panelweave.operators.combine import group_min, stack, stack_tagged
from panelweave.operators.reshape import spread_over, unpivot
from panelweave.operators.windows import earliest_with_ties, surrogate_id
from panelweave.sources.files import SurveyFiles
from panelweave.workload.orders_panel import PRIORITY, STATUS, priority_code, status_code
from panelweave.workload.registry import query, table

def order_year():
    return F.year("o_orderdate")



def _order_files(spark, sf):
    """Three files of orders, each with part of them; one order of the first two has no key."""
    orders, lines = table(spark, sf, "orders"), table(spark, sf, "lineitem")
    key = F.when(F.col("o_orderkey") != 7, F.col("o_orderkey")).cast("double").alias("OID")
    first = orders.filter("o_orderkey % 3 <> 0").select(key, F.col("o_totalprice").alias("PRICE"))
    second = orders.filter("o_orderkey % 5 <> 0").select(
        key, status_code().alias("Status"), F.col("o_custkey").cast("double").alias("unused")
    )
    third = lines.filter("l_returnflag = 'R'").groupBy("l_orderkey").agg(F.max("l_quantity").alias("MAXQTY"))
    third = third.select(F.col("l_orderkey").cast("double").alias("OID"), "MAXQTY")
    return SurveyFiles.from_frames({"w1/price": first, "w1/status": second, "w2/lines": third})


@query(
    """WITH a AS (SELECT CASE WHEN o_orderkey <> 7 THEN CAST(o_orderkey AS DOUBLE) END AS oid, o_totalprice AS price
      FROM orders WHERE o_orderkey % 3 <> 0),
    b AS (SELECT CASE WHEN o_orderkey <> 7 THEN CAST(o_orderkey AS DOUBLE) END AS oid,
      CAST(CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 2 ELSE 3 END AS DOUBLE) AS status FROM orders WHERE o_orderkey % 5 <> 0),
    c AS (SELECT CAST(l_orderkey AS DOUBLE) AS oid, max(l_quantity) AS maxqty FROM lineitem WHERE l_returnflag = 'R' GROUP BY ALL),
    ab AS (SELECT coalesce(a.oid, b.oid) AS oid, price, status FROM a FULL JOIN b ON a.oid IS NOT DISTINCT FROM b.oid)
    SELECT coalesce(ab.oid, c.oid) AS oid, price, status, maxqty FROM ab FULL JOIN c ON ab.oid IS NOT DISTINCT FROM c.oid"""
)
def load_files_full_join(spark, sf):
    """The variables of three files side by side."""
    files = _order_files(spark, sf)
    return files.load_joined(files.search(var_low="^(price|status|maxqty)$"), "oid")


_SCANS = """SELECT l_orderkey, l_partkey, l_suppkey, l_quantity, l_tax FROM lineitem"""


@query(_SCANS)
def load_pruned(spark, sf):
    """Read the keys and the variables found, lower-cased; nothing else is scanned."""
    lines = table(spark, sf, "lineitem")
    files = SurveyFiles.from_frames({"w1/lineitem": lines.toDF(*[c.upper() for c in lines.columns])})
    found = files.search(variable="_(QUANTITY|TAX)$", dta="^line")
    return files.load(found[0].file_path, "^L_(ORDER|PART|SUPP)KEY$", [v.variable for v in found])


def _sweep_files(spark, sf):
    """Two sweeps of orders whose variables start with the sweep's letter."""
    orders = table(spark, sf, "orders")
    key, row = F.col("o_orderkey").alias("OID"), F.col("o_orderkey").alias("_row")
    price, code, year = F.col("o_totalprice"), priority_code(), order_year().cast("double")
    a = orders.filter("o_orderstatus <> 'O'").select(key, row, price.alias("APRICE00"), code.alias("APRIO00"))
    b = orders.filter("o_orderstatus = 'O'").select(key, row, price.alias("BPRICE00_R20"), year.alias("BYEAR00"))
    return SurveyFiles.from_frames({"0y/first": a, "3y/second": b})


@query(
    """SELECT o_orderkey AS oid, 'a' AS sweep, o_totalprice AS price00, CAST(left(o_orderpriority, 1) AS DOUBLE) AS prio00,
      CAST(NULL AS DOUBLE) AS year00 FROM orders WHERE o_orderstatus <> 'O'
    UNION ALL SELECT o_orderkey, 'b', o_totalprice, NULL, CAST(year(o_orderdate) AS DOUBLE) FROM orders WHERE o_orderstatus = 'O'"""
)
def load_files_stack(spark, sf):
    """The files of several sweeps below each other."""
    files = _sweep_files(spark, sf)
    found = files.search(var_low="^.(price|prio|year)00")
    long = files.load_stacked(found, "^oid$", "oid", suffix="_r20$")
    return long.select("oid", "sweep", "price00", "prio00", "year00")


@query(
    """SELECT DISTINCT o_custkey AS iid, CAST(([14, 15, 16, 17, 18, 19, 25])[year(o_orderdate) - 1994] AS INTEGER) AS fup
    FROM orders WHERE year(o_orderdate) BETWEEN 1995 AND 2001"""
)
def response_frame(spark, sf):
    """The ages a customer responded at, from one outcome column per sweep."""
    outcome = [F.min(F.when(order_year() == 1994 + i, 1).otherwise(2)).alias(f"outcme{i:02d}") for i in range(1, 8)]
    wide = table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("iid")).agg(*outcome)
    long = unpivot(wide, ["iid"]).filter("value = 1")
    sweep = to_int(str_sub(F.col("name"), 7, 8))
    return long.select("iid", sweep_to_age(sweep, [14, 15, 16, 17, 18, 19, 25]).alias("fup"))


def _priority_by_year(orders):
    return group_min(orders.withColumn("code", priority_code()), ["o_custkey", "fup"], "code", "code")


@query(
    """WITH o AS (SELECT *, CAST(year(o_orderdate) AS INTEGER) AS fup FROM orders),
    a AS (SELECT o_custkey, fup, max(o_totalprice) AS price FROM o WHERE o_orderstatus <> 'O' GROUP BY ALL),
    b AS (SELECT o_custkey, fup, min(CAST(left(o_orderpriority, 1) AS DOUBLE)) AS code FROM o WHERE o_orderstatus = 'O' GROUP BY ALL)
    SELECT o_custkey, fup, price, code FROM a FULL JOIN b USING (o_custkey, fup)"""
)
def full_join_two_key(spark, sf):
    """Two attributes of a person and age side by side."""
    orders = table(spark, sf, "orders").withColumn("fup", order_year())
    keys = ["o_custkey", "fup"]
    price = orders.filter("o_orderstatus <> 'O'").groupBy(*keys).agg(F.max("o_totalprice").alias("price"))
    return j.full_join(price, _priority_by_year(orders.filter("o_orderstatus = 'O'")), keys)


@query(
    """WITH sample AS (SELECT c_custkey AS pid, c_custkey AS iid FROM customer WHERE c_nationkey < 18),
    years AS (SELECT CAST(unnest(range(1995, 2001)) AS INTEGER) AS fup),
    seg AS (SELECT c_custkey AS pid, c_mktsegment AS segment FROM customer WHERE c_acctbal > 0),
    o AS (SELECT o_custkey AS pid, CAST(year(o_orderdate) AS INTEGER) AS fup, * FROM orders),
    prio AS (SELECT pid, fup, CASE min(CAST(left(o_orderpriority, 1) AS INTEGER)) WHEN 1 THEN 'Urgent' WHEN 2 THEN 'High'
      WHEN 3 THEN 'Medium' WHEN 4 THEN 'Not Specified' ELSE 'Low' END AS priority FROM o GROUP BY ALL),
    stat AS (SELECT pid, fup, CASE min(o_orderstatus) WHEN 'F' THEN 'Finished' WHEN 'O' THEN 'Open' ELSE 'Pending' END AS status
      FROM o WHERE o_totalprice > 150000 GROUP BY ALL),
    w1 AS (SELECT coalesce(s.pid, seg.pid) AS pid, iid, fup, segment
      FROM (SELECT * FROM sample, years) s FULL JOIN seg ON s.pid = seg.pid),
    w2 AS (SELECT coalesce(w1.pid, p.pid) AS pid, iid, coalesce(w1.fup, p.fup) AS fup, segment, priority
      FROM w1 FULL JOIN prio p ON w1.pid = p.pid AND w1.fup IS NOT DISTINCT FROM p.fup)
    SELECT coalesce(w2.pid, s.pid) AS pid, iid, coalesce(w2.fup, s.fup) AS fup, segment, priority, status
      FROM w2 FULL JOIN stat s ON w2.pid = s.pid AND w2.fup IS NOT DISTINCT FROM s.fup"""
)
def panel_wide(spark, sf):
    """Fold the attribute tables onto the person x year frame; customers outside the sample are appended."""
    customer = table(spark, sf, "customer").withColumn("pid", F.col("c_custkey"))
    orders = table(spark, sf, "orders").withColumns({"pid": F.col("o_custkey"), "fup": order_year()})
    frame = customer.filter("c_nationkey < 18").select("pid", F.col("pid").alias("iid"))
    segment = customer.filter("c_acctbal > 0").select("pid", F.col("c_mktsegment").alias("segment"))
    codes = {"priority": (orders, priority_code(), PRIORITY)}
    codes["status"] = (orders.filter("o_totalprice > 150000"), status_code(), STATUS)
    tables = [segment]
    for name, (rows, code, labels) in codes.items():
        least = group_min(rows.withColumn(name, code), ["pid", "fup"], name, name)
        tables.append(least.withColumn(name, code_to_category(F.col(name), labels)))
    return j.natural_full_join_all(spread_over(frame, range(1995, 2001), "fup"), tables)


@query(
    """WITH a AS (SELECT o_orderkey, nullif(CAST(left(o_orderpriority, 1) AS DOUBLE), 2) AS code FROM orders WHERE o_orderstatus = 'F'),
    b AS (SELECT o_orderkey, CASE WHEN o_totalprice > 200000 THEN 1.0 ELSE 0.0 END::DOUBLE AS code FROM orders WHERE o_orderkey % 2 = 0 OR o_orderstatus <> 'F')
    SELECT o_orderkey, coalesce(a.code, b.code) AS code FROM a FULL JOIN b USING (o_orderkey)"""
)
def full_join_coalesce(spark, sf):
    """Two sources of one attribute; the first wins where it has a value."""
    orders = table(spark, sf, "orders")
    first = F.when(priority_code() != 2, priority_code())
    second = F.when(F.col("o_totalprice") > 200000, 1.0).otherwise(0.0)
    a = orders.filter("o_orderstatus = 'F'").select("o_orderkey", first.alias("code"))
    b = orders.filter("o_orderkey % 2 = 0 OR o_orderstatus <> 'F'").select("o_orderkey", second.alias("code"))
    return j.full_join_coalesce(a, b, ["o_orderkey"], "code")


@query(
    """SELECT c_custkey, n_name AS nation FROM customer LEFT JOIN (SELECT * FROM nation WHERE n_regionkey < 4)
    ON c_nationkey = n_nationkey"""
)
def left_join_lookup(spark, sf):
    """Look an attribute up; persons without it stay."""
    nation = table(spark, sf, "nation").filter("n_regionkey < 4")
    names = nation.select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("nation"))
    return j.null_safe_join(table(spark, sf, "customer"), names, ["c_nationkey"], "left").select("c_custkey", "nation")


@query(
    """SELECT c_custkey AS pid, CAST(i AS INTEGER) AS cnum, nation_size FROM customer
    JOIN (SELECT s_nationkey, count(*) AS nation_size FROM supplier GROUP BY ALL) ON c_nationkey = s_nationkey
    JOIN (SELECT unnest(range(1, 3)) AS i) ON i <= c_custkey % 3"""
)
def inner_join_fanout(spark, sf):
    """A value of the household for each of its members."""
    size = table(spark, sf, "supplier").groupBy(F.col("s_nationkey").alias("family")).agg(F.count("*").alias("nation_size"))
    customer = table(spark, sf, "customer").filter("c_custkey % 3 >= 1")
    members = customer.select(
        F.col("c_nationkey").alias("family"),
        F.col("c_custkey").alias("pid"),
        F.explode(F.sequence(F.lit(1), (F.col("c_custkey") % 3).cast("int"))).alias("cnum"),
    )
    return members.join(size, "family").select("pid", "cnum", "nation_size")


@query(
    """SELECT l.doc_id, lang, CAST(CASE WHEN n_chars > 1000 THEN 'Yes' WHEN n_chars IS NOT NULL THEN 'No' END AS VARCHAR) AS long_text,
    quality, 'Yes' AS response FROM (SELECT * FROM documents WHERE lang <> 'fr') d RIGHT JOIN labels l ON d.doc_id = l.doc_id"""
)
def response_right_join(spark, sf):
    """Keep the labelled documents, those without attributes too."""
    documents = table(spark, sf, "documents").filter("lang <> 'fr'")
    size = F.when(F.col("n_chars") > 1000, "Yes").otherwise("No").alias("long_text")
    labels = table(spark, sf, "labels").select("doc_id", "quality")
    joined = j.right_join(documents.select("doc_id", "lang", size), labels, ["doc_id"])
    return joined.withColumn("response", F.lit("Yes"))


@query(
    """SELECT c_custkey AS pid, c_nationkey AS nation, c_acctbal AS balance, c_mktsegment AS segment FROM customer
    UNION ALL SELECT s_suppkey, s_nationkey, s_acctbal, NULL FROM supplier"""
)
def union_sources(spark, sf):
    """Rows of two sources; the column one of them lacks is null."""
    customer = table(spark, sf, "customer").drop("c_name").toDF("pid", "nation", "balance", "segment")
    supplier = table(spark, sf, "supplier").drop("s_name").toDF("pid", "nation", "balance")
    return stack([supplier, customer]).select("pid", "nation", "balance", "segment")


@query(
    """SELECT 'customer' AS study, c_custkey AS iid, CASE WHEN NOT (c_acctbal <= -1) THEN c_acctbal END AS balance FROM customer
    UNION ALL SELECT 'supplier', s_suppkey, CASE WHEN NOT (s_acctbal <= -1) THEN s_acctbal END FROM supplier"""
)
def stack_studies(spark, sf):
    """Studies below each other with their name."""
    frames = {
        name: table(spark, sf, name).select(
            F.col(f"{name[0]}_{key}").alias("iid"), negative_to_null(F.col(f"{name[0]}_acctbal")).alias("balance")
        )
        for name, key in (("customer", "custkey"), ("supplier", "suppkey"))
    }
    return stack_tagged(frames, "study")


@query(
    """SELECT o_custkey, CAST(year(o_orderdate) AS INTEGER) AS fup, CASE min(CAST(left(o_orderpriority, 1) AS INTEGER))
    WHEN 1 THEN 'Urgent' WHEN 2 THEN 'High' WHEN 3 THEN 'Medium' WHEN 4 THEN 'Not Specified' ELSE 'Low' END AS priority
    FROM orders GROUP BY ALL"""
)
def household_min(spark, sf):
    """The first category of a household at each age."""
    least = _priority_by_year(table(spark, sf, "orders").withColumn("fup", order_year()))
    return least.select("o_custkey", "fup", code_to_category(F.col("code"), PRIORITY).alias("priority"))


@query(
    """SELECT user_id, day, event_id, event_type FROM (SELECT *, CAST(day(ts) AS INTEGER) AS day,
    rank() OVER (PARTITION BY user_id ORDER BY day(ts)) AS r FROM events) WHERE r = 1"""
)
def earliest_with_ties_query(spark, sf):
    """All events of a user's first day."""
    events = table(spark, sf, "events").select("user_id", F.dayofmonth("ts").alias("day"), "event_id", "event_type")
    return earliest_with_ties(events, ["user_id"], "day")


@query("SELECT row_number() OVER (ORDER BY o_orderkey) AS iid, o_orderkey FROM orders")
def surrogate_id_query(spark, sf):
    """Number the orders by key."""
    return surrogate_id(table(spark, sf, "orders").select("o_orderkey"), "o_orderkey").select("iid", "o_orderkey")
