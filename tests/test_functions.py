"""Column functions on hand-written codes: nulls, fractions, out of range."""

import pytest
from pyspark.sql import functions as F

from panelweave.functions import missing, names
from panelweave.functions import recode as rc
from panelweave.plans import codings
from panelweave.plans.counts import rename_levels

CODES = [-9.0, -1.0, -0.5, 0.0, 1.9, 3.1, 8.0, 98.0, None]


def apply(spark, column, values=CODES, kind="double"):
    rows = [(i, v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, f"i int, x {kind}")
    return [r[0] for r in df.orderBy("i").select(column).collect()]


def test_negative_codes(spark):
    assert apply(spark, missing.negative_to_null(F.col("x"))) == [None, None, -0.5, 0.0, 1.9, 3.1, 8.0, 98.0, None]


def test_listed_and_valid_codes(spark):
    assert apply(spark, missing.values_to_null(F.col("x"), [8, 98]))[4:] == [1.9, 3.1, None, None, None]
    assert apply(spark, missing.keep_valid_values(F.col("x"), [8, 98]))[4:] == [None, None, 8.0, 98.0, None]


def test_cleaning_twice_changes_nothing(spark):
    once = missing.negative_to_null(F.col("x"))
    assert apply(spark, missing.negative_to_null(once)) == apply(spark, once)


def test_set_with_null(spark):
    assert apply(spark, missing.is_null_or_in(F.col("x"), [8]))[-3:] == [True, False, True]


def test_row_missing_count(spark):
    assert apply(spark, missing.row_missing_count(["x", F.nullif("x", F.lit(8.0))])) == [0, 0, 0, 0, 0, 0, 1, 0, 2]


def test_positions_are_cut_off_and_bounded(spark):
    assert apply(spark, rc.code_to_category(F.col("x"), ["a", "b", "c"]))[2:] == [None, None, "a", "c", None, None, None]
    assert apply(spark, rc.comb_lookup(F.col("x"), [5, None, 7]))[3:6] == [None, 5.0, 7.0]


def test_condition_on_null_gives_null(spark):
    got = apply(spark, rc.if_else(F.col("x") == 8, F.lit(2), F.lit(1)))
    assert got == [1, 1, 1, 1, 1, 1, 2, 1, None]


def test_first_pair_wins(spark):
    pairs = [(rc.Span(1, 4), 1), ([3.1, 8], rc.Minus(9))]
    assert apply(spark, rc.recode(F.col("x"), pairs))[3:] == [None, 1.0, 1.0, 1.0, None, None]


def test_code_text(spark):
    assert apply(spark, rc.code_text(F.col("x")))[2:7] == ["-0.5", "0", "1.9", "3.1", "8"]


@pytest.mark.parametrize(
    "recode, codes, expected",
    [
        (codings.DERIVED_MARITAL, range(0, 10), [None, 3, 2, 4, 5, 2, 4, 5, 1, None]),
        (codings.SINGLE_FIRST_PARTNER_TO_9, range(0, 11), [None, 1, 2, 2, 3, 4, 5, 3, 4, 5, None]),
        (codings.MARRIED_FIRST, range(0, 8), [None, 2, 1, 1, 3, 4, 5, None]),
        (codings.RELIGION_TEEN, range(0, 12), [None, 2, 2, 2, 3, 4, 6, 5, 7, None, 1, None]),
        (codings.RELIGION_14, range(0, 16), [None, 1, 2, 2, 2, 2, 2, 2, 2, 2, 4, 7, 3, 5, 6, None]),
        (codings.RELIGION_EIGHT, range(0, 10), [None, 2, 2, 2, 6, 4, 7, 3, 5, None]),
        (codings.NSSEC_EIGHT, range(0, 10), [None, 1, 1, 2, 3, 4, 5, 5, 6, None]),
        (codings.NSSEC_SEVEN, range(0, 10), [None, 1, 1, 2, 3, 4, 5, 5, None, None]),
        (codings.CLASS_AT_BIRTH, range(0, 10), [None, 7, None, 6, 5, 4, 3, 2, 1, None]),
        (codings.CLASS_WITH_31_32, [1, 2, 3, 3.1, 3.2, 4, 5, 6], [1, 2, None, 3, 4, 5, 6, None]),
        (codings.CLASS_TWO_DIGIT_CODES, [10, 15, 20, 31, 32, 40, 50], [1, None, 2, 3, 4, 5, 6]),
        (codings.ETHNIC_SIXTEEN, [0, 1, 4, 8, 9, 11, 12, 14, 15, 16, 17], [None, 1, 2, 3, 4, 6, 5, 5, 6, 6, None]),
        (codings.REGION_EARLY, [0, 1, 9, 10, 11, 12], [None, 1, 1, 2, 3, None]),
        (codings.COUNTRY_WAVE_10, range(0, 6), [None, 1, 4, 3, 2, None]),
        (codings.RELIGION_CHILD_SCOTLAND, range(0, 11), [None, 1, 2, 2, 2, 3, 6, 5, 7, 4, None]),
    ],
)
def test_code_tables(spark, recode, codes, expected):
    got = apply(spark, rc.recode(F.col("x"), recode), [float(c) for c in codes])
    assert got == [None if e is None else float(e) for e in expected]


def test_fractional_tens_become_a_category(spark):
    code = rc.recode(F.col("x"), codings.CLASS_TWO_DIGIT_RANGES)
    assert apply(spark, rc.code_to_category(code, list("abcdef")), [10.0, 15.0, 20.0, 45.0]) == ["a", "a", "b", "e"]


def test_names(spark):
    found = ["n0region", "nd9regn", "bd10cntry", "outcmebm", "abc"]

    def run(column):
        return apply(spark, column, found, "string")

    x = F.col("x")
    assert run(names.to_int(names.str_sub(x, 2, -7))) == [0, None, None, None, None]
    assert run(names.str_sub(x, 3, -6))[2] == "10"
    assert run(names.str_sub(x, 7, 8))[3] == "bm"
    assert run(names.first_digit(x)) == [0, 9, 1, None, None]
    assert run(names.letter_ordinal(F.substring("x", 1, 1))) == [14, 14, 2, 15, 1]
    assert run(names.letter_ordinal(F.upper("x")))[0] is None
    assert run(names.remove_first(x, "n")) == ["0region", "d9regn", "bd10ctry", "outcmebm", "abc"]


def test_schema_names():
    assert names.select_matches(["W1Relig", "w2relig", "other"], "w[12]relig") == ["W1Relig", "w2relig"]
    assert names.rename_var("w7disabv1", "disabled") == "disabled_7"
    assert names.strip_suffix(["a_r20", "b"], "_r20$") == {"a_r20": "a"}


def test_rename_levels(spark):
    got = apply(spark, rename_levels(F.col("x"), ["a", "b"], {"z": 2}), ["a", "b", "c", None], "string")
    assert got == ["a", "z", "c", None]
