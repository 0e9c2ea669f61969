"""The millennium cohort: families with up to two cohort children, seven sweeps.

The sweep is the first letter of a variable's name. Most files hold a row per child (`cnum`), some
a row per family or parent. `pid` is the family.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelweave.functions.missing import negative_to_null, values_to_null
from panelweave.functions.names import letter_ordinal
from panelweave.functions.recode import (
    code_to_category,
    first_match,
    if_else,
    recode,
    recode_sources,
    sweep_to_age,
)
from panelweave.operators.combine import group_min
from panelweave.operators.joins import null_safe_join
from panelweave.operators.reshape import uncount
from panelweave.operators.windows import earliest_with_ties, first_per_group
from panelweave.plans import codings as c
from panelweave.plans import dictionaries as d
from panelweave.plans.common import Study, clean_tables, with_iid
from panelweave.sources.files import SurveyFiles
from panelweave.sources.joined import reads

ID = "mcsid"
IDS = f"^{ID}$|(C|P)NUM00"
AGES = d.AGES["mcs"]
CHILDREN = [1, 2]
CHILD = ["pid", "cnum"]


def by_sweep(files: SurveyFiles, suffix: str | None = None, per_variable: bool = False, **search) -> DataFrame:
    """Stack the files found; adds the age and the child number."""
    long = files.load_stacked(files.search(**search), IDS, ID, suffix, per_variable).withColumnRenamed(ID, "pid")
    sweep = letter_ordinal(F.col("sweep"))
    long = long.withColumns({"sweep": sweep, "fup": sweep_to_age(sweep, AGES)})
    return long.withColumn("cnum", F.col("cnum00").try_cast("int")) if "cnum00" in long.columns else long


def code_columns(long: DataFrame, *names: str) -> DataFrame:
    """Add the variables that no file of the selection has, as nulls."""
    return long.withColumns({n: F.lit(None).cast("double") for n in names if n not in long.columns})


def child(files: SurveyFiles) -> DataFrame:
    """The children of the sample, one row each: families with one or two, numbered."""
    path = files.search(dta="^mcs_longitudinal_family_file$", fld="^xwave$")[0].file_path
    families = files.load(path, f"^{ID}$", ["NOCMHH", "nocmhh"]).filter(F.col("nocmhh").isin(CHILDREN))
    return uncount(families, F.col("nocmhh"), "cnum").select(F.col(ID).alias("pid"), "cnum")


def ethnicity(files: SurveyFiles) -> DataFrame:
    long = code_columns(by_sweep(files, variable="^.DC(06E|E06)00$"), "dc06e00", "dce0600")
    code = recode_sources((F.col("dc06e00"), c.ETHNIC_SIX), (F.col("dce0600"), c.ETHNIC_SIX))
    reports = long.select(*CHILD, "fup", code_to_category(code, d.ETHNIC).alias("ethnic_group"))
    return earliest_with_ties(reports.na.drop(), CHILD, "fup").select(*CHILD, "ethnic_group")


def sex(files: SurveyFiles) -> DataFrame:
    """Each variable is read on its own, so a child with two entries at an age keeps both."""
    long = by_sweep(files, per_variable=True, dta="hhgrid", var_low="csex").filter(F.col("cnum00").isin(CHILDREN))
    long = code_columns(long, "hcsex00", "csex0000")
    code = recode_sources((F.col("hcsex00"), c.SEX_TWO), (F.col("csex0000"), c.SEX_TWO))
    reports = long.select(*CHILD, "fup", code_to_category(code, d.SEX).alias("sex")).na.drop()
    return earliest_with_ties(reports, CHILD, "fup").select(*CHILD, "sex")


def child_variable(files: SurveyFiles, var_low: str) -> DataFrame:
    """One variable of the child questionnaire at 17, with the child's number."""
    found = files.search(var_low=f"^{var_low}$")[0]
    df = files.load(found.file_path, IDS, [found.variable]).withColumnRenamed(ID, "pid")
    return df.withColumns({"cnum": F.col("gcnum00").try_cast("int"), "fup": F.lit(17)})


@reads(2)
def gender(files: SurveyFiles) -> DataFrame:
    """Gender compared with the sex recorded for the child."""
    df = null_safe_join(child_variable(files, "gcgnid00"), sex(files), CHILD, "left", stored_by="pid" if files.by_person else None)
    own, recorded = F.col("gcgnid00"), first_match((F.col("sex") == d.SEX[0], 1), (F.col("sex") == d.SEX[1], 2))
    code = first_match(
        (own.isin(1, 2) & (own == recorded), 1),
        (own.isin(1, 2) & (own != recorded), 2),
        (own.isin(4, 5, 6), 3),
        (own == 3, 4),
    )
    return df.select(*CHILD, "fup", code_to_category(code, d.GENDER).alias("gender_identity"))


def sexuality(files: SurveyFiles) -> DataFrame:
    df = child_variable(files, "gcsxid00")
    code = recode(F.col("gcsxid00"), c.ORIENTATION_SCALE)
    return df.select(*CHILD, "fup", code_to_category(code, d.SEXUALITY).alias("sexuality"))


@reads(3)
def country(files: SurveyFiles) -> DataFrame:
    """The family's country for all its children, and the child's own at 17."""
    family = by_sweep(files, var_low="^.actry00$", dta="family_derived")
    code = recode(F.col("actry00"), c.COUNTRY_FOUR)
    long = family.select("pid", "fup", code_to_category(code, d.COUNTRY).alias("country"))
    shared = long.join(child(files), "pid").select(*CHILD, "fup", "country").na.drop()
    at_17 = child_variable(files, "gactry00").filter(F.col("gcnum00").isin(CHILDREN))
    own = at_17.select(
        *CHILD, "fup", code_to_category(recode(F.col("gactry00"), c.COUNTRY_FOUR), d.COUNTRY).alias("country")
    )
    return own.na.drop().unionByName(shared)


def fsm(files: SurveyFiles) -> DataFrame:
    """Free school meals received, else eligibility; the first answer in file order."""
    long = code_columns(by_sweep(files, var_low="^.p(schd|frem|elfr)00$"), "pschd00", "pfrem00", "pelfr00")
    cleaned = {v: values_to_null(negative_to_null(F.col(v)), [3, 4]) for v in ("pschd00", "pfrem00", "pelfr00")}
    long = long.withColumns(cleaned)
    meals = F.col("pfrem00")
    received = first_match(((F.col("fup") == 5) & (F.col("pschd00") == 2), 1), (meals.isin(1, 2), meals))
    eligible = if_else(F.col("pelfr00") == 1, F.lit(2), F.lit(1))
    code = first_match((received == 2, 2), (eligible == 2, 2), (received == 1, 1), (eligible == 1, 1))
    child_number = negative_to_null(F.col("cnum00")).try_cast("int")
    long = long.withColumns({"cnum": child_number, "fsm": code_to_category(code, d.BINARY)})
    answers = long.na.drop(subset=[*CHILD, "fup", "fsm"])
    return first_per_group(answers, [*CHILD, "fup"], ["_file", "_row"]).select(*CHILD, "fup", "fsm")


def sen(files: SurveyFiles) -> DataFrame:
    long = by_sweep(files, var_low="^[d-f]pcsen00$")
    long = long.withColumn("sen", code_to_category(recode(F.col("pcsen00"), c.YES_FIRST), d.BINARY))
    answers = long.na.drop(subset=[*CHILD, "fup", "sen"])
    return first_per_group(answers, [*CHILD, "fup"], ["_file", "_row"]).select(*CHILD, "fup", "sen")


@reads(3)
def religion(files: SurveyFiles) -> DataFrame:
    """The child's answers, and up to age 11 the main parent's for all children of the family."""
    own = by_sweep(files, suffix="_r20$", dta="cm_interview", var_low="^.crel.00")
    own = code_columns(own, "crele00", "crelw00", "crels00", "creln00")
    code = recode_sources(
        (F.col("crele00"), c.RELIGION_CHILD_ENGLAND_WALES),
        (F.col("crelw00"), c.RELIGION_CHILD_ENGLAND_WALES),
        (F.col("crels00"), c.RELIGION_CHILD_SCOTLAND),
        (F.col("creln00"), c.RELIGION_CHILD_NORTHERN_IRELAND),
    )
    own = own.select(*CHILD, "fup", code_to_category(code, d.RELIGION).alias("religion")).na.drop()
    parent = by_sweep(files, dta="parent_derived", var_low="(elig00|drlg00)").filter("elig00 = 1 AND fup < 14")
    parent = code_columns(parent, "ddrlg00", "drlg00")
    code = recode(F.coalesce("ddrlg00", "drlg00"), c.RELIGION_PARENT)
    parent = parent.select("pid", "fup", code_to_category(code, d.RELIGION).alias("religion")).na.drop()
    shared = parent.join(child(files), "pid").select(*CHILD, "fup", "religion")
    return shared.unionByName(own)


def disabled(files: SurveyFiles) -> DataFrame:
    """The parent's report, else the child's; one item changed its codes after sweep 3."""
    long = code_columns(by_sweep(files, var_low="^.(c|p)cls(i|l)00$"), "pclsi00", "pclsl00", "cclsi00", "cclsl00")
    early, late = F.col("sweep").isin(2, 3), F.col("sweep").isin(4, 5, 6)
    limits, own = F.col("pclsl00"), F.col("cclsl00")
    code = first_match(
        (F.col("pclsi00") == 2, 1),
        (early & (limits == 2), 1),
        (late & (limits == 3), 1),
        (early & (limits == 1), 2),
        (late & limits.isin(1, 2), 2),
        (F.col("cclsi00") == 2, 1),
        (own == 3, 1),
        (own.isin(1, 2), 2),
    )
    return long.select(*CHILD, "fup", code_to_category(code, d.BINARY).alias("disabled"))


def social_class(files: SurveyFiles) -> DataFrame:
    """The most advantaged class of the household; no child number, so it holds for all children."""
    long = code_columns(by_sweep(files, var_low="^.(|d)d05(s|c)00$"), "dd05s00", "d05s00", "dd05c00")
    classes = [values_to_null(F.col(v), [-1, 8]) for v in ("dd05s00", "d05s00", "dd05c00")]
    long = long.withColumn("code", F.coalesce(*classes[:2], classes[2].try_cast("int").cast("double")))
    least = group_min(long.na.drop(subset=["code"]), ["pid", "fup"], "code", "code")
    return least.select("pid", "fup", code_to_category(F.col("code"), d.NSSEC).alias("nssec"))


def carer(files: SurveyFiles) -> DataFrame:
    long = by_sweep(files, variable="^GCCARE00$")
    code = recode(F.col("ccare00"), c.YES_FIRST)
    return long.select(*CHILD, "fup", code_to_category(code, d.BINARY).alias("carer")).na.drop()


def sample(files: SurveyFiles) -> DataFrame:
    return with_iid(child(files), CHILD)


@reads(2)
def response(files: SurveyFiles) -> DataFrame:
    """Ages at which a child of the sample has an interview row."""
    places = {}
    for sweep, age in enumerate(AGES, 1):
        for v in files.search(fld=f"^{age}y$", dta=f"^mcs{sweep}_cm_interview$", variable="(?i)^.CNUM00$"):
            places[v] = age
    ages = F.array(*[F.lit(age) for age in places.values()])
    rows = files.load_stacked(list(places), f"^{ID}$", ID).withColumnRenamed(ID, "pid")
    rows = rows.select("pid", F.col("cnum00").try_cast("int").alias("cnum"), F.get(ages, F.col("_file")).alias("fup"))
    return with_iid(rows.join(child(files), CHILD).select(*CHILD, "fup"), CHILD)


RULES = [
    ethnicity,
    sex,
    gender,
    sexuality,
    country,
    fsm,
    sen,
    religion,
    disabled,
    social_class,
    carer,
]


def harmonise(files: SurveyFiles) -> Study:
    clean = clean_tables(files, RULES)
    return Study("mcs", CHILD, sample(files), response(files), clean, CHILDREN)
