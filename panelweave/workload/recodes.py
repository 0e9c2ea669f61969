"""Missing codes, recodes, names and row-wise expressions over the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelweave.functions import names as n
from panelweave.functions.missing import (
    is_null_or_in,
    keep_valid_values,
    negative_to_null,
    row_missing_count,
    values_to_null,
)
from panelweave.functions.recode import (
    SAME,
    Minus,
    Plus,
    Span,
    Tens,
    code_to_category,
    comb_lookup,
    first_match,
    recode,
    recode_sources,
    sweep_to_age,
)
from panelweave.operators.joins import label_codes
from panelweave.operators.windows import first_per_group
from panelweave.plans.counts import rename_levels
from panelweave.workload.orders_panel import PRIORITY, priority_code, status_code
from panelweave.workload.registry import query, table


@query("SELECT c_custkey, CASE WHEN NOT (c_acctbal / 500 <= -1) THEN c_acctbal / 500 END AS balance FROM customer")
def negative_to_null_query(spark, sf):
    customer = table(spark, sf, "customer")
    return customer.select("c_custkey", negative_to_null(F.col("c_acctbal") / 500).alias("balance"))


@query(
    """SELECT l_orderkey, l_partkey, l_suppkey, CASE WHEN l_linenumber NOT IN (3, 4) THEN l_linenumber END AS line,
    CASE WHEN l_quantity NOT IN (1, 98, 50) THEN l_quantity END AS quantity FROM lineitem"""
)
def values_to_null_query(spark, sf):
    return table(spark, sf, "lineitem").select(
        "l_orderkey",
        "l_partkey",
        "l_suppkey",
        values_to_null(F.col("l_linenumber"), [3, 4]).alias("line"),
        values_to_null(F.col("l_quantity"), [1, 98, 50]).alias("quantity"),
    )


@query("SELECT p_partkey, CASE WHEN p_size BETWEEN 1 AND 25 THEN p_size END AS size FROM part")
def keep_valid_values_query(spark, sf):
    return table(spark, sf, "part").select("p_partkey", keep_valid_values(F.col("p_size"), range(1, 26)).alias("size"))


@query(
    """SELECT l_orderkey, l_partkey, l_suppkey,
    CASE WHEN NOT (l_linenumber - 3.0 <= -1) AND l_linenumber - 3.0 NOT IN (2, 3) THEN l_linenumber - 3.0 END AS line,
    CASE WHEN NOT (l_quantity - 3.0 <= -1) AND l_quantity - 3.0 NOT IN (2, 3) THEN l_quantity - 3.0 END AS quantity
    FROM (SELECT * REPLACE (CAST(l_linenumber AS DOUBLE) AS l_linenumber) FROM lineitem)"""
)
def across_clean(spark, sf):
    """The same cleaning over several columns."""
    columns = {"l_linenumber": "line", "l_quantity": "quantity"}
    shifted = {c: F.col(c).cast("double") - 3.0 for c in columns}
    cleaned = [values_to_null(negative_to_null(x), [2, 3]).alias(columns[c]) for c, x in shifted.items()]
    return table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", *cleaned)


@query(
    """SELECT o_orderkey, CASE WHEN q1 IN (1, 2) THEN 3 - q1 END AS disabled_1,
    CASE WHEN q2 IN (1, 2) THEN 3 - q2 END AS disabled_2
    FROM (SELECT o_orderkey, CAST(left(o_orderpriority, 1) AS DOUBLE) AS q1,
      CAST(CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 2 ELSE 3 END AS DOUBLE) AS q2 FROM orders)"""
)
def across_rename(spark, sf):
    """Recode several wave columns and name the results by prefix and wave."""
    df = table(spark, sf, "orders").select(
        "o_orderkey", priority_code().alias("w1disabyp"), status_code().alias("w2disab")
    )
    found = n.select_matches(df.columns, r"w\ddisab")
    return df.select(
        "o_orderkey", *[recode(F.col(v), [([1, 2], Minus(3))]).alias(n.rename_var(v, "disabled")) for v in found]
    )


@query(
    """SELECT o_orderkey, o_totalprice AS price, regexp_replace(o_orderpriority, '-', '') AS priority,
    o_orderstatus AS status FROM orders"""
)
def rename_strip_suffix(spark, sf):
    """Drop a wave suffix from column names and the first match of a pattern from values."""
    df = table(spark, sf, "orders").select(
        "o_orderkey",
        F.col("o_totalprice").alias("price_r20"),
        n.remove_first(F.col("o_orderpriority"), "-").alias("priority_r20"),
        F.col("o_orderstatus").alias("status"),
    )
    return df.withColumnsRenamed(n.strip_suffix(df.columns, "_r20$"))


@query("SELECT o_orderkey, o_orderstatus, o_orderdate, o_orderpriority FROM orders")
def select_matches(spark, sf):
    """Columns by pattern, case ignored."""
    orders = table(spark, sf, "orders")
    return orders.select("o_orderkey", *n.select_matches(orders.columns, "^O_ORDER(STATUS|DATE|PRIORITY)"))


_WAVE_NAME = "CASE WHEN o_orderkey % 12 = 11 THEN 'nd9regn' ELSE 'n' || (o_orderkey % 12) || 'region' END"


@query(
    f"""SELECT o_orderkey, name, substr(name, 2, greatest(length(name) - 7, 0)) AS middle,
    coalesce(TRY_CAST(nullif(substr(name, 2, greatest(length(name) - 7, 0)), '') AS INTEGER), 9) AS wave,
    TRY_CAST(nullif(regexp_extract(name, '[0-9]'), '') AS INTEGER) AS digit,
    CASE WHEN o_orderstatus BETWEEN 'A' AND 'Z' THEN CAST(ascii(lower(o_orderstatus)) - 96 AS INTEGER) END AS letter,
    CAST(NULL AS INTEGER) AS no_letter
    FROM (SELECT *, {_WAVE_NAME} AS name FROM orders)"""
)
def wave_from_name(spark, sf):
    """Waves out of variable names: by position from the right, first digit, letter."""
    number = F.col("o_orderkey") % 12
    name = F.when(number == 11, "nd9regn").otherwise(F.concat(F.lit("n"), number.cast("string"), F.lit("region")))
    middle = n.str_sub(F.col("name"), 2, -7)
    return (
        table(spark, sf, "orders")
        .withColumn("name", name)
        .select(
            "o_orderkey",
            "name",
            middle.alias("middle"),
            F.coalesce(n.to_int(middle), F.lit(9)).alias("wave"),
            n.first_digit(F.col("name")).alias("digit"),
            n.letter_ordinal(F.lower("o_orderstatus")).alias("letter"),
            n.letter_ordinal(F.col("o_orderstatus")).alias("no_letter"),
        )
    )


@query(
    """SELECT p_partkey, CASE WHEN p_size BETWEEN 1 AND 10 THEN 1.0 WHEN p_size IN (11, 12, 15) THEN 2.0
    WHEN p_size BETWEEN 11 AND 20 THEN 3.0 WHEN p_size = 50 THEN 4.0 END::DOUBLE AS size_class FROM part"""
)
def recode_case(spark, sf):
    """Ranges, sets and single codes, first match wins, no match is null."""
    pairs = [(Span(1, 10), 1), ([11, 12, 15], 2), (Span(11, 20), 3), ([50], 4)]
    return table(spark, sf, "part").select("p_partkey", recode(F.col("p_size"), pairs).alias("size_class"))


@query(
    """SELECT p_partkey, CASE WHEN x BETWEEN 1 AND 2 THEN x WHEN x BETWEEN 3 AND 8 THEN 9 - x
    WHEN x BETWEEN 10 AND 20 THEN x / 10 WHEN x IN (31, 32) THEN x - 28 WHEN x BETWEEN 40 AND 50 THEN 1 + x / 10 END AS code,
    CASE CAST(trunc(CASE WHEN x BETWEEN 1 AND 2 THEN x WHEN x BETWEEN 3 AND 8 THEN 9 - x
    WHEN x BETWEEN 10 AND 20 THEN x / 10 WHEN x IN (31, 32) THEN x - 28 WHEN x BETWEEN 40 AND 50 THEN 1 + x / 10 END)
    AS INTEGER) WHEN 1 THEN 'a' WHEN 2 THEN 'b' WHEN 3 THEN 'c' WHEN 4 THEN 'd' WHEN 5 THEN 'e' END AS label
    FROM (SELECT p_partkey, CAST(p_size AS DOUBLE) AS x FROM part)"""
)
def recode_arith(spark, sf):
    """Targets computed from the code; a fractional target is cut off when it becomes a category."""
    x = F.col("p_size").cast("double")
    pairs = [
        ([1, 2], SAME),
        (list(range(3, 9)), Minus(9)),
        (list(range(10, 21)), Tens()),
        ([31, 32], Plus(-28)),
        (list(range(40, 51)), Tens(1)),
    ]
    code = recode(x, pairs)
    return table(spark, sf, "part").select(
        "p_partkey", code.alias("code"), code_to_category(code, list("abcde")).alias("label")
    )


@query(
    """SELECT o_orderkey, CASE WHEN a IN (1, 2) AND (b IS NULL OR b IN (1, 2)) AND c IS NULL THEN 1.0
    WHEN a = 3 AND b IS NULL AND c IS NULL THEN 5.0 WHEN a = 4 AND (b IS NULL OR b = 3) AND (c IS NULL OR c = 1) THEN 6.0
    WHEN a IS NOT NULL AND b IS NOT NULL THEN 2.0 WHEN a IS NOT NULL AND c IS NOT NULL THEN 2.0
    WHEN b IS NOT NULL AND c IS NOT NULL THEN 2.0 END::DOUBLE AS reconciled
    FROM (SELECT o_orderkey, nullif(CAST(left(o_orderpriority, 1) AS DOUBLE), 5) AS a,
      CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 3 END AS b,
      CASE WHEN o_custkey % 3 < 2 THEN o_custkey % 3 END AS c FROM orders)"""
)
def recode_multi_source(spark, sf):
    """Three reporters reconciled, with sets that accept null."""
    df = table(spark, sf, "orders").select(
        "o_orderkey",
        values_to_null(priority_code(), [5]).alias("a"),
        recode(status_code(), [([1], 1), ([2], 3)]).alias("b"),
        keep_valid_values(F.col("o_custkey") % 3, [0, 1]).alias("c"),
    )
    a, b, c = F.col("a"), F.col("b"), F.col("c")
    code = first_match(
        (a.isin(1, 2) & is_null_or_in(b, [1, 2]) & c.isNull(), 1),
        ((a == 3) & b.isNull() & c.isNull(), 5),
        ((a == 4) & is_null_or_in(b, [3]) & is_null_or_in(c, [1]), 6),
        (a.isNotNull() & b.isNotNull(), 2),
        (a.isNotNull() & c.isNotNull(), 2),
        (b.isNotNull() & c.isNotNull(), 2),
    )
    return df.select("o_orderkey", code.alias("reconciled"))


@query(
    """SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN 1.0 WHEN left(o_orderpriority, 1) IN ('2', '3') THEN 4.0
    WHEN left(o_orderpriority, 1) IN ('4', '5') THEN CAST(left(o_orderpriority, 1) AS DOUBLE) - 1 END::DOUBLE AS code FROM orders"""
)
def recode_source_order(spark, sf):
    """Sources tried in order: a filter item first, the detailed item after it."""
    code = recode_sources((status_code(), [([3], 1)]), (priority_code(), [([2, 3], 4), ([4, 5], Plus(-1))]))
    return table(spark, sf, "orders").select("o_orderkey", code.alias("code"))


@query(
    """SELECT p_partkey, CAST(([1, 2, 6, 4, 7, 3, 5, NULL])[CASE WHEN p_size - 3 > 0 THEN p_size - 3 END] AS DOUBLE) AS code
    FROM part"""
)
def comb_lookup_query(spark, sf):
    """Recode by position; zero, negative and too large codes give null."""
    return table(spark, sf, "part").select(
        "p_partkey", comb_lookup(F.col("p_size") - 3, [1, 2, 6, 4, 7, 3, 5, None]).alias("code")
    )


@query(
    """SELECT l_orderkey, l_partkey, l_suppkey, CAST(([0, 3, 5, 7, 11, 14])[l_linenumber] AS INTEGER) AS fup FROM lineitem"""
)
def sweep_to_age_query(spark, sf):
    ages = sweep_to_age(F.col("l_linenumber"), [0, 3, 5, 7, 11, 14])
    return table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", ages.alias("fup"))


@query(
    """SELECT l_orderkey, l_partkey, l_suppkey, CASE CAST(trunc(l_quantity / 10) AS INTEGER)
    WHEN 1 THEN 'Managerial & Professional' WHEN 2 THEN 'Intermediate' WHEN 3 THEN 'Not Working' END AS category
    FROM lineitem"""
)
def code_to_category_query(spark, sf):
    labels = ["Managerial & Professional", "Intermediate", "Not Working"]
    category = code_to_category(F.col("l_quantity") / 10, labels)
    return table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", category.alias("category"))


@query(
    """SELECT s_suppkey, CASE WHEN n_name IS NULL THEN CAST(s_nationkey AS VARCHAR) ELSE n_name END AS nation
    FROM supplier LEFT JOIN (SELECT * FROM nation WHERE n_nationkey < 20) ON s_nationkey = n_nationkey"""
)
def code_to_file_label(spark, sf):
    """Labels that come with the data; a code without label stays as its number."""
    nation = table(spark, sf, "nation").filter("n_nationkey < 20")
    labels = nation.select(F.col("n_nationkey").cast("double").alias("code"), F.col("n_name").alias("label"))
    codes = table(spark, sf, "supplier").select("s_suppkey", F.col("s_nationkey").cast("double").alias("nation"))
    return label_codes(codes, labels, "nation")


@query(
    """SELECT o_orderkey, CASE left(o_orderpriority, 1) WHEN '1' THEN 'At once' WHEN '2' THEN 'High' WHEN '3' THEN 'Medium'
    WHEN '4' THEN 'Unknown' ELSE 'Low' END AS priority FROM orders"""
)
def category_rename(spark, sf):
    """Rename the first and the fourth category."""
    label = code_to_category(priority_code(), PRIORITY)
    renamed = rename_levels(label, PRIORITY, {"At once": 1, "Unknown": 4})
    return table(spark, sf, "orders").select("o_orderkey", renamed.alias("priority"))


_NULLED = """(SELECT o_orderkey, CAST(nullif(left(o_orderpriority, 1), '2') AS DOUBLE) AS a,
  CASE o_orderstatus WHEN 'F' THEN 1.0 WHEN 'O' THEN 2.0 END::DOUBLE AS b,
  CASE WHEN o_totalprice < 250000 THEN o_totalprice END AS c FROM orders)"""


def _nulled(spark, sf):
    return table(spark, sf, "orders").select(
        "o_orderkey",
        values_to_null(priority_code(), [2]).alias("a"),
        keep_valid_values(status_code(), [1, 2]).alias("b"),
        F.when(F.col("o_totalprice") < 250000, F.col("o_totalprice")).alias("c"),
    )


@query(
    f"""SELECT o_orderkey, CAST((a IS NULL)::INTEGER + (b IS NULL)::INTEGER + (c IS NULL)::INTEGER AS INTEGER) AS row_miss
    FROM {_NULLED}"""
)
def row_missing_count_query(spark, sf):
    return _nulled(spark, sf).select("o_orderkey", row_missing_count(["a", "b", "c"]).alias("row_miss"))


@query(
    f"SELECT o_orderkey, CASE WHEN a IS NULL THEN b WHEN b IS NULL THEN a WHEN a < b THEN a ELSE b END AS least FROM {_NULLED}"
)
def rowwise_min(spark, sf):
    """Smaller of two codes, nulls skipped."""
    return _nulled(spark, sf).select("o_orderkey", F.least("a", "b").alias("least"))


@query(
    """SELECT user_id, day, event_id, event_type FROM (SELECT *, CAST(day(ts) AS INTEGER) AS day,
    row_number() OVER (PARTITION BY user_id, day(ts) ORDER BY ts, event_id) AS r FROM events) WHERE r = 1"""
)
def first_per_group_query(spark, sf):
    """The first event of a user's day."""
    events = table(spark, sf, "events").withColumn("day", F.dayofmonth("ts"))
    first = first_per_group(events, ["user_id", "day"], ["ts", "event_id"])
    return first.select("user_id", "day", "event_id", "event_type")
