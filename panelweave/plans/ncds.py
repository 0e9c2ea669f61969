"""The 1958 cohort: one record per person and file, codings differ by age."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelweave.functions.missing import keep_valid_values, negative_to_null, values_to_null
from panelweave.functions.names import select_matches
from panelweave.functions.recode import Minus, Span, first_match
from panelweave.operators.joins import full_join_all
from panelweave.plans import codings as c
from panelweave.plans import dictionaries as d
from panelweave.plans.common import Study, by_age, categorise, clean_tables, load, responded, with_iid
from panelweave.sources.files import SurveyFiles
from panelweave.sources.joined import reads

ID = "ncdsid"
AGES = d.AGES["ncds"]


def ethnicity(files: SurveyFiles) -> DataFrame:
    df = load(files, ID, variable="^ETHNICID$").withColumnRenamed("ethnicid", "ethnic_group")
    return categorise(df, "ethnic_group", d.ETHNIC)


def sex(files: SurveyFiles) -> DataFrame:
    """Labels come from the file."""
    found = files.search(variable="^N622$", fld="^xwave$")
    df = files.load_joined(found, ID).withColumnRenamed(ID, "pid")
    df = df.select("pid", keep_valid_values(F.col("n622"), [1, 2]).alias("sex"))
    return files.file_label(df, found[0], "sex")


def sweep_age(number: str, unnumbered: int) -> int | None:
    """Age of a sweep from the digits in a name; sweeps count from 0 and the one at 44 has no digits."""
    sweep = unnumbered if not number.isdigit() else int(number) + (1 if int(number) <= 6 else 2)
    return AGES[sweep - 1] if sweep <= len(AGES) else None


def country(files: SurveyFiles) -> DataFrame:
    """Region codes; the sweep is in the variable's name, the last one has no plain number.

    Two variables of one sweep give two rows; one past the last sweep has no age and gives none.
    """
    df = load(files, ID, var_low="(n[0-8]region|nd9regn)")
    found = [(sweep_age(v[1:-6], 11), v) for v in df.columns if v != "pid"]
    ages = [(a, [(v, c.REGION_EARLY if AGES.index(a) < 4 else c.REGION_LATE)]) for a, v in found if a is not None]
    return by_age(df, "country", d.COUNTRY, ages).na.drop()


def fsm(files: SurveyFiles) -> DataFrame:
    df = load(files, ID, var_low="^n(1229|858|2440)$")
    return by_age(
        df,
        "fsm",
        d.BINARY,
        {
            11: [("n1229", [([1], 2)]), ("n858", [([1], 2)]), ("n1229", [([2], 1)]), ("n858", [([2], 1)])],
            16: [("n2440", [(Span(0, 2), Minus(3))])],
        },
    ).na.drop()


def sen(files: SurveyFiles) -> DataFrame:
    df = load(files, ID, var_low="n39[0-2]|n147[6-9]")
    return by_age(
        df,
        "sen",
        d.BINARY,
        {
            7: [*((v, [([9], 2)]) for v in ("n390", "n391", "n392")), ("n390", c.SEN_AGE_7_OTHER)],
            11: [*((v, [([5, 6], 2)]) for v in ("n1477", "n1478", "n1479")), ("n1476", [([1, 2, 3, 4, 5], 1)])],
        },
    ).na.drop()


def marstat(files: SurveyFiles) -> DataFrame:
    df = load(files, ID, variable="^(n5113|n506515|ms|marital|nd7ms|ND[8-9]MS)$")
    return by_age(
        df,
        "marstat",
        d.MARITAL,
        {
            23: [("n5113", c.FIRST_FIVE)],
            33: [("n506515", c.SINGLE_FIRST)],
            42: [("ms", c.MARRIED_FIRST)],
            44: [("marital", c.SINGLE_FIRST)],
            46: [("nd7ms", c.MARRIED_FIRST)],
            50: [("nd8ms", c.SINGLE_FIRST_PARTNER_TO_9)],
            55: [("nd9ms", c.DERIVED_MARITAL)],
        },
    )


def religion(files: SurveyFiles) -> DataFrame:
    df = load(files, ID, variable="^(n5967|n504651|religion|N8RNOWRL|N8RRELNW)$")
    return by_age(
        df,
        "religion",
        d.RELIGION,
        {
            23: [("n5967", c.RELIGION_13)],
            33: [("n504651", c.RELIGION_13)],
            42: [("religion", c.RELIGION_14)],
            50: [("n8rnowrl", c.NO_RELIGION_IS_TWO), ("n8rrelnw", c.RELIGION_EIGHT)],
        },
    )


def disabled(files: SurveyFiles) -> DataFrame:
    names = "n281|n2662|n4139|n504121|n504122|n504125|n504128|n504131|bdmph|lsireg2|n7khldsl|ND8KHLDS|ND9DISEQ"
    df = load(files, ID, variable=f"^({names})$", exclude=lambda v: v.dta == "ncds8_imagine")
    conditions = ("n504122", "n504125", "n504128", "n504131")
    return by_age(
        df,
        "disabled",
        d.BINARY,
        {
            7: [("n281", [([2, 3], Minus(4))])],
            16: [("n2662", c.YES_FIRST)],
            23: [("n4139", c.YES_FIRST)],
            33: [("n504121", [([2], 1)]), *((v, [([1], 2)]) for v in conditions)],
            42: [("lsireg2", c.YES_FIRST)],
            44: [("bdmph", c.YES_FIRST)],
            46: [("n7khldsl", c.YES_ONE_NO_TWO_THREE)],
            50: [("nd8khlds", c.YES_FIRST)],
            55: [("nd9diseq", c.YES_IS_ONE)],
        },
    )


def nssec(files: SurveyFiles) -> DataFrame:
    df = load(files, ID, variable="^(nd7ns8|N8NS8|N9CNS8)$")
    sources = {46: "nd7ns8", 50: "n8ns8", 55: "n9cns8"}
    return by_age(df, "nssec", d.NSSEC, {age: [(v, c.NSSEC_EIGHT)] for age, v in sources.items()})


def rgsc(files: SurveyFiles) -> DataFrame:
    """At birth and at 16 the higher class of the two parents counts."""
    names = "n236|n660|n190|n1687|n2384|n2393|n6149|n540033|sc|n7sc|N8SC|N9CSC"
    df = load(files, ID, variable=f"^({names})$")

    def at_birth(name: str) -> Column:
        code = F.col(name)
        unclassified_last = first_match((code == 1, 8), (code != 1, negative_to_null(code)))
        return values_to_null(unclassified_last, [10, 12])

    df = df.withColumns(
        {
            "parent_birth": F.least(at_birth("n236"), at_birth("n660")),
            "parent_16": F.least(*[keep_valid_values(F.col(v), range(1, 8)) for v in ("n2384", "n2393")]),
        }
    )
    return by_age(
        df,
        "rgsc",
        d.RGSC,
        {
            0: [("parent_birth", c.CLASS_PARENT_AT_BIRTH)],
            7: [("n190", c.CLASS_AGE_7)],
            11: [("n1687", c.CLASS_SIX)],
            16: [("parent_16", c.CLASS_PARENT_AT_16)],
            23: [("n6149", c.CLASS_AGE_23)],
            33: [("n540033", c.CLASS_TWO_DIGIT_CODES)],
            42: [("sc", c.CLASS_WITH_31_32)],
            46: [("n7sc", c.CLASS_WITH_31_32)],
            50: [("n8sc", c.CLASS_WITH_31_32)],
            55: [("n9csc", c.CLASS_WITH_31_32)],
        },
    )


@reads(2)
def social_class(files: SurveyFiles) -> DataFrame:
    """Both class schemes side by side."""
    return full_join_all([rgsc(files), nssec(files)], ["pid", "fup"], stored_by="pid" if files.by_person else None)


def outcomes(files: SurveyFiles) -> DataFrame:
    """The response file: one row per sample member, one outcome per sweep."""
    path = files.search(dta="^ncds_response$", fld="^xwave$")[0].file_path
    df = files.load(path, f"^{ID}$")
    return df.select(F.col(ID).alias("pid"), *select_matches(df.columns, "^outcme..$"))


def sample(files: SurveyFiles) -> DataFrame:
    return with_iid(outcomes(files).select("pid"), ["pid"])


def response(files: SurveyFiles) -> DataFrame:
    """Ages at which a person responded; the biomedical sweep at 44 has letters for a number."""
    df = outcomes(files)
    return responded(df, {v: sweep_age(v[6:8], 8) for v in df.columns if v != "pid"})


RULES = [ethnicity, sex, country, fsm, sen, marstat, religion, disabled, social_class]


def harmonise(files: SurveyFiles) -> Study:
    clean = clean_tables(files, RULES)
    return Study("ncds", ["pid"], sample(files), response(files), clean)
