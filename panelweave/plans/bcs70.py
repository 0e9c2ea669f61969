"""The 1970 cohort: one record per person and file, codings differ by age."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelweave.functions.missing import is_null_or_in, negative_to_null, values_to_null
from panelweave.functions.names import select_matches
from panelweave.functions.recode import first_match
from panelweave.operators.joins import full_join_all
from panelweave.operators.windows import earliest_with_ties
from panelweave.plans import codings as c
from panelweave.plans import dictionaries as d
from panelweave.plans.common import Study, by_age, clean_tables, load, once, responded, with_iid
from panelweave.sources.files import SurveyFiles
from panelweave.sources.joined import reads

ID = "bcsid"
AGES = d.AGES["bcs70"]


def ethnicity(files: SurveyFiles) -> DataFrame:
    """Earliest of five reports; at age 10 three reporters are reconciled."""
    df = load(
        files,
        ID,
        variable="^(a12_(1|4|7)|c6_14|oa3_1|ethnic|bd7ethnic|e245)$",
        exclude=lambda v: v.variable == "c6_14" and v.fld == "10y",
    )
    df = df.withColumns({v: negative_to_null(F.col(v)) for v in df.columns if v != "pid"})
    mother, father, other = F.col("a12_1"), F.col("a12_4"), F.col("a12_7")
    none = other.isNull()
    age_10 = first_match(
        (mother.isin(1, 2, 3) & is_null_or_in(father, [1, 2, 3]) & none, 1),
        ((mother == 4) & father.isNull() & none, 5),
        ((mother == 5) & is_null_or_in(father, [5]) & none, 3),
        (mother.isin(6, 7) & is_null_or_in(father, [6, 7]) & none, 4),
        ((mother == 8) & is_null_or_in(father, [8]) & is_null_or_in(other, [8]), 6),
        (mother.isNotNull() & father.isNotNull(), 2),
        (mother.isNotNull() & other.isNotNull(), 2),
        (father.isNotNull() & other.isNotNull(), 2),
    )
    reports = by_age(
        df,
        "ethnic_group",
        d.ETHNIC,
        {
            10: age_10,
            5: [("e245", c.ETHNIC_BIRTH_COUNTRY)],
            16: [("oa3_1", c.ETHNIC_AGE_16), ("c6_14", c.ETHNIC_AGE_16_OBSERVED)],
            29: [("ethnic", c.ETHNIC_SIXTEEN)],
            34: [("bd7ethnic", c.ETHNIC_SIXTEEN)],
        },
    )
    return earliest_with_ties(reports.na.drop(), ["pid"], "fup").select("pid", "ethnic_group")


def sex(files: SurveyFiles) -> DataFrame:
    """Labels come from the file."""
    found = files.search(fld="^xwave$", variable="^SEX$")
    df = files.load_joined(found, ID).withColumnRenamed(ID, "pid")
    df = df.withColumn("sex", values_to_null(F.col("sex"), [3]))
    return files.file_label(df, found[0], "sex")


def sexuality(files: SurveyFiles) -> DataFrame:
    df = load(files, ID, variable="^B9SXID$")
    return once(df, "sexuality", d.SEXUALITY, ("b9sxid", c.ORIENTATION_REVERSED))


def country(files: SurveyFiles) -> DataFrame:
    """The sweep is in the variable's name; sweep 10 has its own codes.

    Two variables of one sweep give two rows; a name without the number of a sweep gives none, as
    its age would be null.
    """
    df = load(files, ID, var_low="bd.*cntry")
    sweeps = [(int(v[2:-5]), v) for v in df.columns if v != "pid" and v[2:-5].isdigit()]
    ages = [(AGES[s - 1], [(v, c.COUNTRY_FOUR if s < 10 else c.COUNTRY_WAVE_10)]) for s, v in sweeps if 1 <= s <= len(AGES)]
    return by_age(df, "country", d.COUNTRY, ages).na.drop()


def fsm(files: SurveyFiles) -> DataFrame:
    df = load(files, ID, var_low="^m12(6|8)$")
    return by_age(df, "fsm", d.BINARY, {10: [("m126", [([1], 2)]), ("m128", [([1], 2)]), ("m126", [([2], 1)])]}).na.drop()


def sen(files: SurveyFiles) -> DataFrame:
    df = load(files, ID, var_low="^(mea11|l7_5)$")
    at_10 = [
        ("mea11", [([4, 5, 6], 2)]),
        ("l7_5", [([1], 2)]),
        ("mea11", [([1, 2, 3], 1)]),
        ("l7_5", [([2], 1)]),
    ]
    return by_age(df, "sen", d.BINARY, {10: at_10}).na.drop()


def marstat(files: SurveyFiles) -> DataFrame:
    df = load(files, ID, var_low=r"^(b960322|marstat2|bd(\d|10)ms)$")
    return by_age(
        df,
        "marstat",
        d.MARITAL,
        {
            26: [("b960322", c.SINGLE_FIRST)],
            29: [("marstat2", c.SINGLE_FIRST)],
            34: [("bd7ms", c.MARRIED_FIRST)],
            38: [("bd8ms", c.SINGLE_FIRST_PARTNER_TO_8)],
            42: [("bd9ms", c.DERIVED_MARITAL)],
            46: [("bd10ms", c.DERIVED_MARITAL)],
        },
    )


def religion(files: SurveyFiles) -> DataFrame:
    df = load(files, ID, var_low="^(gd1a|b960663|religion|q48|b7rnowrl|b7rrelnw)$")
    return by_age(
        df,
        "religion",
        d.RELIGION,
        {
            16: [("gd1a", c.RELIGION_TEEN)],
            26: [("b960663", c.NO_RELIGION_IS_TWO), ("q48", c.RELIGION_27)],
            29: [("religion", c.RELIGION_14)],
            34: [("b7rnowrl", c.NO_RELIGION_IS_TWO), ("b7rrelnw", c.RELIGION_SIX)],
        },
    )


def disabled(files: SurveyFiles) -> DataFrame:
    df = load(files, ID, variable="^(lsireg2|b7khldl2|b8khldl2|BD9DISEQ|BD10DISEQ)$")
    return by_age(
        df,
        "disabled",
        d.BINARY,
        {
            29: [("lsireg2", c.YES_FIRST)],
            34: [("b7khldl2", c.YES_ONE_NO_TWO_THREE)],
            38: [("b8khldl2", c.YES_FIRST)],
            42: [("bd9diseq", c.YES_IS_ONE)],
            46: [("bd10diseq", c.YES_IS_ONE)],
        },
    )


def nssec(files: SurveyFiles) -> DataFrame:
    df = load(files, ID, variable="^(bd7ns8|B9CNS8|BD10CNS8)$")
    return by_age(
        df,
        "nssec",
        d.NSSEC,
        {
            34: [("bd7ns8", c.NSSEC_SEVEN)],
            42: [("b9cns8", c.NSSEC_EIGHT)],
            46: [("bd10cns8", c.NSSEC_EIGHT)],
        },
    )


def rgsc(files: SurveyFiles) -> DataFrame:
    df = load(files, ID, variable="^(BD1PSOC|BD2SOC|BD3PSOC|BD4PSOC|rgsc91|sc|b7sc|b8sc|B9CSC)$")
    return by_age(
        df,
        "rgsc",
        d.RGSC,
        {
            0: [("bd1psoc", c.CLASS_AT_BIRTH)],
            5: [("bd2soc", c.CLASS_SIX_REVERSED)],
            10: [("bd3psoc", c.CLASS_SIX_REVERSED)],
            16: [("bd4psoc", c.CLASS_SIX_REVERSED)],
            26: [("rgsc91", c.CLASS_TWO_DIGIT_RANGES)],
            29: [("sc", c.CLASS_WITH_31_32)],
            34: [("b7sc", c.CLASS_WITH_31_32)],
            38: [("b8sc", c.CLASS_WITH_31_32)],
            42: [("b9csc", c.CLASS_WITH_31_32)],
        },
    )


@reads(2)
def social_class(files: SurveyFiles) -> DataFrame:
    """Both class schemes side by side."""
    return full_join_all([rgsc(files), nssec(files)], ["pid", "fup"], stored_by="pid" if files.by_person else None)


def outcomes(files: SurveyFiles) -> DataFrame:
    """The response file: one row per sample member, one outcome per sweep."""
    path = files.search(dta="^bcs70_response_1970-2016$", fld="^xwave$")[0].file_path
    df = files.load(path, f"^{ID}$")
    return df.select(F.col(ID).alias("pid"), *select_matches(df.columns, r"^outcme\d\d"))


def sample(files: SurveyFiles) -> DataFrame:
    return with_iid(outcomes(files).select("pid"), ["pid"])


def response(files: SurveyFiles) -> DataFrame:
    """Ages at which a person responded."""
    df = outcomes(files)
    return responded(df, {v: AGES[int(v[6:8]) - 1] for v in df.columns if v != "pid"})


RULES = [ethnicity, sex, sexuality, country, fsm, sen, marstat, religion, disabled, social_class]


def harmonise(files: SurveyFiles) -> Study:
    clean = clean_tables(files, RULES)
    return Study("bcs70", ["pid"], sample(files), response(files), clean)
