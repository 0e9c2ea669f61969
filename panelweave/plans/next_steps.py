"""The teenage cohort: eight waves, the wave is the first digit of a variable's name."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelweave.functions.missing import keep_valid_values, negative_to_null
from panelweave.functions.names import rename_var, select_matches, str_sub, to_int
from panelweave.functions.recode import code_to_category, comb_lookup, first_match, recode, sweep_to_age
from panelweave.operators.joins import full_join_coalesce
from panelweave.operators.reshape import clean_to_long, unpivot, unpivot_multi_value
from panelweave.operators.windows import earliest_with_ties
from panelweave.plans import codings as c
from panelweave.plans import dictionaries as d
from panelweave.plans.common import Study, by_age, categorise, clean_tables, load, responded, with_iid
from panelweave.sources.files import SurveyFiles
from panelweave.sources.joined import reads

ID = "nsid"
AGES = d.AGES["next_steps"]


def wave_of_name(column: str = "name"):
    return to_int(str_sub(F.col(column), 2, 2))


def by_wave(df: DataFrame, attribute: str, labels: list[str]) -> DataFrame:
    """Columns `<attribute>_<wave>` to rows (pid, age, category)."""
    long = categorise(clean_to_long(df, attribute, ["pid"]), attribute, labels)
    return long.withColumn("fup", sweep_to_age(F.col("fup"), AGES))


def earliest_report(df: DataFrame, attribute: str, labels: list[str]) -> DataFrame:
    """The first category reported over all wave columns."""
    long = unpivot(df, ["pid"], "name", attribute).withColumn("fup", sweep_to_age(wave_of_name(), AGES))
    reports = categorise(long, attribute, labels).select("pid", "fup", attribute).na.drop()
    return earliest_with_ties(reports, ["pid"], "fup").select("pid", attribute)


def ethnicity(files: SurveyFiles) -> DataFrame:
    df = load(files, ID, var_low="(w8dethn6|w?ethgrpyp)", dta="(ns8|young_person)")
    eight = select_matches(df.columns, "w?ethgrpyp")
    codes = {v: negative_to_null(F.col(v).cast("double")) for v in df.columns if v != "pid"}
    codes |= {v: recode(codes[v], c.ETHNIC_EIGHT) for v in eight}
    return earliest_report(df.withColumns(codes), "ethnic_group", d.ETHNIC)


@reads(2)
def sex(files: SurveyFiles) -> DataFrame:
    """The household grid's entry for the young person, else the earliest wave's."""
    df = load(files, ID, var_low=r"^(w8cmsex|w\dsex(|yp))$", fld="^eul$")
    waves = unpivot(df, ["pid"], "name", "sex").select(
        "pid", wave_of_name().alias("sweep"), keep_valid_values(F.col("sex"), [1, 2]).alias("sex")
    )
    own = earliest_with_ties(waves.na.drop(), ["pid"], "sweep").select("pid", "sex")
    grid = load(files, ID, variable="^(Sex|ReltoYP)$").filter("reltoyp = 0")
    grid = grid.select("pid", keep_valid_values(F.col("sex"), [1, 2]).alias("sex"))
    both = full_join_coalesce(grid, own, ["pid"], "sex", stored_by="pid" if files.by_person else None)
    return categorise(both, "sex", d.SEX)


def sexuality(files: SurveyFiles) -> DataFrame:
    df = load(files, ID, var_low="sexual")
    codes = {v: recode(F.col(v), c.ORIENTATION_REVERSED) for v in df.columns if v != "pid"}
    return earliest_report(df.withColumns(codes), "sexuality", d.SEXUALITY)


def country(files: SurveyFiles) -> DataFrame:
    """Labels come from the file."""
    found = files.search(variable="^W8DCTRY$")
    df = files.load_joined(found, ID).withColumnRenamed(ID, "pid")
    df = df.select("pid", F.lit(25).alias("fup"), negative_to_null(F.col("w8dctry")).alias("country"))
    return files.file_label(df, found[0], "country")


def sen(files: SurveyFiles) -> DataFrame:
    """Needs stated now or in the past."""
    df = load(files, ID, var_low="^w.(sen|sencurr|stated)mp$")
    codes = {v: 2 - negative_to_null(F.col(v)) for v in df.columns if v != "pid"}
    long = unpivot_multi_value(df.withColumns(codes), ["pid"], "w(.)(.*)")
    ever, now = F.col("senmp"), F.col("sencurrmp")
    code = first_match(((ever == 1) | (now == 1), 2), ((ever == 0) | (now == 0), 1))
    age = sweep_to_age(to_int(F.col("sweep")), AGES)
    return long.select("pid", age.alias("fup"), code_to_category(code, d.BINARY).alias("sen")).na.drop()


def marstat(files: SurveyFiles) -> DataFrame:
    df = load(files, ID, var_low=r"^w\d.?marstat(|yp)$", fld="^eul$")
    ages = {19: [("w6marstatyp", c.FIRST_FIVE)], 25: [("w8dmarstat", c.MARITAL_NINE)]}
    return by_age(df, "marstat", d.MARITAL, ages)


def religion(files: SurveyFiles, wave_8: bool = False) -> DataFrame:
    """Wave 8 is recoded but left out of the long table, unless asked for."""
    df = load(files, ID, var_low="(w8drelig7|relig(|1)yp)").withColumnRenamed("relig1yp", "w2religy1yp")
    codes = {
        rename_var(v, "religion"): comb_lookup(F.col(v), c.RELIGION_WAVE_1_TO_7)
        for v in select_matches(df.columns, "w[1-7]relig")
    }
    codes["religion_8" if wave_8 else "religion_w8"] = comb_lookup(F.col("w8drelig7"), c.RELIGION_WAVE_8)
    return by_wave(df.withColumns(codes), "religion", d.RELIGION)


def disabled(files: SurveyFiles) -> DataFrame:
    df = load(files, ID, var_low=r"w\ddisab|w8ddisea", dta="young_person|ns8")
    codes = {"disabled_8": recode(F.col("w8ddisea"), c.YES_IS_ONE)}
    for v in ("w7disabv1", "w6disab"):
        codes[rename_var(v, "disabled")] = recode(F.col(v), c.YES_FIRST)
    for v in ("w4disabyp", "w2disabyp", "w1disabyp"):
        codes[rename_var(v, "disabled")] = comb_lookup(F.col(v), [2, 1, 1])
    return by_wave(df.select("pid", *[code.alias(v) for v, code in codes.items()]), "disabled", d.BINARY)


def social_class(files: SurveyFiles, five_class: bool = False) -> DataFrame:
    """At wave 5 the higher class of the two parents counts.

    The variable of wave 8 has five classes but is mapped like those of eight; five_class maps it by its own.
    """
    names = "w[1-4](|c)nssecfam|w5cnssec(mum|dad)|w6nssecyp|w7nssec|w8dnssec5"
    df = load(files, ID, var_low=f"^({names})$")
    parents = [negative_to_null(F.col(v)) for v in ("w5cnssecmum", "w5cnssecdad")]
    df = df.withColumn("w5cnssecfam", F.least(*parents)).drop("w5cnssecmum", "w5cnssecdad")
    codes = [
        comb_lookup(F.col(v), c.NSSEC_FIVE if five_class and v == "w8dnssec5" else c.NSSEC_BY_POSITION).alias(rename_var(v, "nssec"))
        for v in select_matches(df.columns, r"^w\d")
    ]
    return by_wave(df.select("pid", *codes), "nssec", d.NSSEC)


def carer(files: SurveyFiles) -> DataFrame:
    df = load(files, ID, var_low=r"w\dcar(e|ing)yp")
    codes = [
        recode(F.col(v), c.YES_FIRST).alias(rename_var(v, "carer")) for v in select_matches(df.columns, r"w\d")
    ]
    return by_wave(df.select("pid", *codes), "carer", d.BINARY)


def outcomes(files: SurveyFiles) -> DataFrame:
    """The longitudinal file: one row per sample member, one outcome per wave."""
    path = files.search(dta="^next_steps_longitudinal_file$", fld="^eul$")[0].file_path
    df = files.load(path, f"^{ID}$")
    return df.select(F.col(ID).alias("pid"), *select_matches(df.columns, r"^w\doutcome"))


def sample(files: SurveyFiles) -> DataFrame:
    return with_iid(outcomes(files).select("pid"), ["pid"])


def response(files: SurveyFiles) -> DataFrame:
    """Ages at which a person responded."""
    df = outcomes(files)
    return responded(df, {v: AGES[int(v[1]) - 1] for v in df.columns if v != "pid"})


RULES = [ethnicity, sex, sexuality, country, sen, marstat, religion, disabled, social_class, carer]


def harmonise(files: SurveyFiles) -> Study:
    clean = clean_tables(files, RULES)
    return Study("next_steps", ["pid"], sample(files), response(files), clean)
