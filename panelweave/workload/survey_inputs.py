"""Survey-shaped files derived from the given tables, to run the study plans on.

Each order is a person (for mcs: a family, its lines the children). A survey variable is a code
picked by arithmetic on the row's keys; each file lacks some persons and each variable some answers.
The inputs grow with the tables.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelweave.operators.combine import side_by_side, stack
from panelweave.plans.common import Study
from panelweave.plans.dictionaries import AGES
from panelweave.sources.files import SurveyFiles, Variable
from panelweave.sources.joined import joined_once, one_class, stacked_once, wanted_by
from panelweave.sources.store import BUCKETS, given_up, shuffles_removed, store, store_bucketed, stored_by_person
from panelweave.workload.registry import table


def span(low: int, high: int) -> list[float]:
    return [float(x) for x in range(low, high + 1)]


FIVE_CLASSES = [1.0, 2.0, 3.1, 3.2, 4.0, 5.0, -1.0]

# study -> file -> variable -> codes that occur
INPUTS: dict[str, dict[str, dict[str, list[float]]]] = {
    "next_steps": {
        "eul/wave_one_young_person": {
            "W1ethgrpYP": span(-2, 9),
            "W1sexYP": span(-1, 2),
            "W1relig1YP": span(-1, 9),
            "W1disabYP": span(-1, 4),
            "W1careYP": span(-1, 3),
        },
        "eul/wave_two_young_person": {
            "W2ethgrpYP": span(-2, 9),
            "W2SexYP": span(-1, 2),
            "relig1YP": span(-1, 9),
            "W2disabYP": span(-1, 4),
            "W2caringYP": span(-1, 3),
        },
        "eul/wave_two_family_background": {
            "W2senMP": span(-1, 3),
            "W2sencurrMP": span(-1, 3),
            "W2statedMP": span(-1, 3),
            "W1senMP": span(-1, 3),
            "W1sencurrMP": span(-1, 3),
            "W1nssecfam": span(-1, 9),
            "W2nssecfam": span(-1, 9),
            "W3cnssecfam": span(-1, 9),
            "W5cnssecmum": span(-2, 9),
            "W5cnssecdad": span(-2, 9),
        },
        "eul/wave_four_young_person": {"W4disabYP": span(-1, 4), "W3sexual_YP": span(-1, 5)},
        "eul/wave_six_young_person": {
            "W6marstatYP": span(-1, 6),
            "W6disab": span(-1, 3),
            "W6nssecyp": span(-1, 9),
        },
        "eul/wave_seven_young_person": {
            "W7DisabV1": span(-1, 3),
            "W7nssec": span(-1, 9),
            "W6Sexuality": span(-1, 5),
        },
        "eul/ns8_self_completion": {
            "W8DETHN6": span(-2, 7),
            "W8CMSEX": span(-1, 2),
            "W8SEXUALITY": span(-1, 5),
            "W8DCTRY": span(-2, 5),
            "W8DMARSTAT": span(-1, 10),
            "W8DRELIG7": span(-1, 9),
            "W8DDISEA": span(-1, 2),
            "W8DNSSEC5": span(-1, 6),
        },
        "eul/wave_one_household_grid": {"Sex": span(-1, 2), "ReltoYP": span(0, 3)},
        "eul/next_steps_longitudinal_file": {f"W{w}OUTCOME": span(1, 3) for w in range(1, 9)},
    },
    "bcs70": {
        "5y/f699b": {"e245": span(-1, 7), "BD2SOC": span(-1, 7), "BD2CNTRY": span(-1, 6)},
        "0y/bcs1derived": {"BD1PSOC": span(-1, 9), "BD1CNTRY": span(-1, 5)},
        "10y/sn3723": {
            "a12_1": span(-1, 8),
            "a12_4": span(-4, 8),
            "a12_7": [-1.0, -1.0, -1.0, -2.0, -3.0, 1.0, 8.0],
            "c6_14": span(1, 6),
            "m126": span(-1, 3),
            "m128": span(-1, 3),
            "mea11": span(-1, 7),
            "l7_5": span(-1, 3),
            "BD3PSOC": span(-1, 7),
        },
        "16y/bcs7016x": {
            "oa3_1": span(-1, 8),
            "c6_14": span(-1, 7),
            "gd1a": span(-1, 11),
            "BD4PSOC": span(-1, 7),
        },
        "26y/bcs96x": {
            "b960322": span(-1, 7),
            "b960663": span(-1, 3),
            "q48": span(-1, 28),
            "rgsc91": [*span(-1, 1), *span(10, 21), 31.0, 32.0, *span(40, 51)],
        },
        "29y/bcs2000": {
            "ethnic": [*span(-1, 17), 98.0, 99.0],
            "marstat2": span(-1, 7),
            "religion": span(-1, 15),
            "lsireg2": span(-1, 3),
            "sc": FIVE_CLASSES,
        },
        "34y/bcs_2004_followup": {
            "bd7ethnic": span(-1, 17),
            "bd7ms": span(-1, 7),
            "b7rnowrl": span(-1, 3),
            "b7rrelnw": span(-1, 7),
            "b7khldl2": span(-1, 4),
            "bd7ns8": span(-1, 9),
            "b7sc": FIVE_CLASSES,
            "BD7CNTRY": span(-1, 13),
        },
        "38y/bcs_2008_followup": {
            "bd8ms": span(-1, 9),
            "b8khldl2": span(-1, 3),
            "b8nssec": span(-1, 9),
            "b8sc": FIVE_CLASSES,
        },
        "42y/bcs70_2012_derived": {
            "BD9MS": span(-1, 9),
            "BD9DISEQ": span(-1, 2),
            "B9CNS8": span(-1, 9),
            "B9CSC": FIVE_CLASSES,
            "B9SXID": span(-1, 5),
        },
        "46y/bcs_age46_main": {
            "BD10MS": span(-1, 9),
            "BD10DISEQ": span(-1, 2),
            "BD10CNS8": span(-1, 9),
            "BD10CNTRY": span(-1, 6),
        },
        "xwave/bcs70_response_1970-2016": {"SEX": span(1, 3)}
        | {f"OUTCME{s:02d}": span(1, 3) for s in range(1, 11)},
    },
    "ncds": {
        "xwave/ncds_response": {"N622": span(-1, 2), "ETHNICID": span(-1, 7)}
        | {f"OUTCME{s}": span(1, 3) for s in ("00", "01", "02", "03", "04", "05", "06", "07", "08", "09", "bm")},
        "xwave/ncds0123": {
            "n0region": span(-1, 12),
            "n1region": span(-1, 12),
            "n390": span(-1, 12),
            "n391": span(-1, 12),
            "n392": span(-1, 12),
            "n281": span(-1, 4),
            "n236": span(-2, 12),
            "n660": span(-2, 12),
            "n190": span(-1, 9),
            "n1229": span(-1, 4),
            "n858": span(-1, 4),
            "n1476": span(-1, 6),
            "n1477": span(-1, 7),
            "n1478": span(-1, 7),
            "n1479": span(-1, 7),
            "n1687": span(-1, 7),
            "n2440": span(-1, 4),
            "n2662": span(-1, 3),
            "n2384": span(-1, 8),
            "n2393": span(-1, 8),
        },
        "23y/ncds4": {
            "n4region": span(-1, 11),
            "n5113": span(-1, 6),
            "n5967": span(-1, 14),
            "n4139": span(-1, 3),
            "n6149": [-1.0, 11.0, 21.0, 31.0, 32.0, 41.0, 42.0, 52.0, 60.0],
        },
        "33y/ncds5cmi": {
            "n504651": span(-1, 14),
            "n506515": span(-1, 7),
            "n504121": span(1, 3),
            "n504122": span(0, 2),
            "n504125": span(0, 2),
            "n504128": span(0, 2),
            "n504131": span(0, 2),
            "n540033": [-1.0, 10.0, 11.0, 20.0, 31.0, 32.0, 40.0, 45.0, 50.0],
        },
        "42y/ncds6": {
            "n6region": span(-1, 12),
            "ms": span(-1, 7),
            "religion": span(-1, 15),
            "lsireg2": span(-1, 3),
            "sc": FIVE_CLASSES,
        },
        "44y/biomedical": {"marital": span(-1, 7), "bdmph": span(-1, 3)},
        "46y/ncds7": {"nd7ms": span(-1, 7), "n7khldsl": span(-1, 4), "nd7ns8": span(-1, 9), "n7sc": FIVE_CLASSES},
        "50y/ncds_2008": {
            "ND8MS": span(-1, 10),
            "N8RNOWRL": span(-1, 3),
            "N8RRELNW": span(-1, 9),
            "ND8KHLDS": span(-1, 3),
            "N8NS8": span(-1, 9),
            "N8SC": FIVE_CLASSES,
        },
        "55y/ncds_2013": {
            "nd9regn": span(-1, 11),
            "ND9MS": span(-1, 9),
            "ND9DISEQ": span(-1, 2),
            "N9CNS8": span(-1, 9),
            "N9CSC": FIVE_CLASSES,
        },
        "50y/ncds8_imagine": {"lsireg2": span(-1, 3)},
    },
    "mcs": {
        "3y/mcs2_parent_interview": {
            "BDC06E00": span(-1, 7),
            "BPCLSI00": span(1, 3),
            "BPCLSL00": span(-1, 4),
        },
        "3y/mcs2_parent_derived": {
            "BELIG00": span(1, 2),
            "BDRLG00": span(-1, 9),
            "BDDRLG00": span(-1, 9),
            "BD05S00": span(-1, 8),
            "BDD05S00": span(-1, 8),
            "BDD05C00": span(-1, 8),
        },
        "5y/mcs3_parent_interview": {
            "CDCE0600": span(-1, 7),
            "CPSCHD00": span(-1, 3),
            "CPFREM00": span(-1, 4),
            "CPELFR00": span(-1, 3),
            "CPCLSI00": span(1, 3),
            "CPCLSL00": span(-1, 4),
        },
        "7y/mcs4_parent_interview": {
            "DPCSEN00": span(-1, 3),
            "DPFREM00": span(-1, 4),
            "DPELFR00": span(-1, 3),
            "DPCLSL00": span(-1, 4),
        },
        "7y/mcs4_hhgrid": {"DHCSEX00": span(-1, 2), "DCSEX0000": span(-1, 2)},
        "11y/mcs5_hhgrid": {"ECSEX0000": span(-1, 2)},
        "11y/mcs5_parent_cm_interview": {"EPCSEN00": span(-1, 3)},
        "11y/mcs5_cm_interview": {
            "ECRELE00_R20": span(-1, 8),
            "ECRELW00_R20": span(-1, 8),
            "ECRELS00_R20": span(-1, 10),
            "ECRELN00_R20": span(-1, 7),
        },
        "14y/mcs6_family_derived": {"FACTRY00": span(-1, 5)},
        "11y/mcs5_family_derived": {"EACTRY00": span(-1, 5)},
        "14y/mcs6_cm_interview": {"FCCLSI00": span(1, 3), "FCCLSL00": span(-1, 4), "FCRELE00": span(-1, 8)},
        "17y/mcs7_cm_derived": {"GACTRY00": span(-1, 5)},
        "17y/mcs7_cm_interview": {
            "GCGNID00": span(-1, 8),
            "GCSXID00": span(-1, 8),
            "GCCARE00": span(-1, 3),
            "GCCLSI00": span(1, 3),
        },
        "0y/mcs1_cm_interview": {},
        "3y/mcs2_cm_interview": {},
        "5y/mcs3_cm_interview": {},
        "7y/mcs4_cm_interview": {},
    },
}

IDS = {"next_steps": "NSID", "bcs70": "bcsid", "ncds": "ncdsid", "mcs": "MCSID"}
FAMILY_ROWS = ("family_derived",)

# Files that some rule reads alone hold every row. The others lack some, so that joins meet unmatched keys.
WHOLE = {
    "42y/bcs70_2012_derived",
    "xwave/bcs70_response_1970-2016",
    "xwave/ncds_response",
    "eul/next_steps_longitudinal_file",
    "eul/ns8_self_completion",
    "17y/mcs7_cm_interview",
}


def rows_present(path: str, file: int, key: str) -> str:
    """Which rows of the given tables a file has."""
    if path in WHOLE:
        return "TRUE"
    return f"({key} + {file}) % 3 <> 0" if key == "l_partkey" else f"({key} + {3 * file}) % 13 <> 0"

LABELS = [
    ("bcs70", "xwave/bcs70_response_1970-2016", "SEX", 1.0, "Male"),
    ("bcs70", "xwave/bcs70_response_1970-2016", "SEX", 2.0, "Female"),
    ("bcs70", "xwave/bcs70_response_1970-2016", "SEX", 3.0, "Not known"),
    ("ncds", "xwave/ncds_response", "N622", 1.0, "Male"),
    ("ncds", "xwave/ncds_response", "N622", 2.0, "Female"),
    ("next_steps", "eul/ns8_self_completion", "W8DCTRY", 1.0, "England"),
    ("next_steps", "eul/ns8_self_completion", "W8DCTRY", 2.0, "Wales"),
    ("next_steps", "eul/ns8_self_completion", "W8DCTRY", 3.0, "Scotland"),
    ("next_steps", "eul/ns8_self_completion", "W8DCTRY", 4.0, "Northern Ireland"),
]


@dataclass(frozen=True)
class Source:
    """Where a variable's code comes from: its number, codes, and the number of its file."""

    number: int
    codes: list[float]
    file: int

    @property
    def factor(self) -> int:
        return 31 + 2 * self.number


def sources(study: str) -> dict[tuple[str, str], Source]:
    """(file, variable) to its source."""
    found, number = {}, 0
    for i, (path, variables) in enumerate(INPUTS[study].items()):
        for variable, codes in variables.items():
            found[path, variable] = Source(number, codes, i)
            number += 1
    return found


def _code(source: Source, first: str, second: str, name: str) -> str:
    codes = ", ".join(f"{c}D" for c in source.codes)
    pick = f"CAST(({first} * {source.factor} + {second}) % {len(source.codes)} AS INT)"
    return f"CASE WHEN ({first} + {source.number}) % 11 <> 0 THEN get(array({codes}), {pick}) END AS {name}"


def _person(given: DataFrame, key: str) -> str:
    """SQL: the person of a row, from the column by which the given table is stored or else from its key."""
    return PERSON_ID if PERSON_ID in given.columns else f"concat('P', {key})"


def _person_file(orders: DataFrame, study: str, path: str, file: int) -> DataFrame:
    """One row per person."""
    cells = [_code(s, "o_orderkey", "o_custkey", v) for (p, v), s in sources(study).items() if p == path]
    kept = orders.filter(rows_present(path, file, "o_orderkey"))
    row = ["o_orderkey AS _row"] if study == "mcs" else []
    return kept.selectExpr(f"{_person(orders, 'o_orderkey')} AS {IDS[study]}", *cells, *row)


def sweep_letter(path: str) -> str:
    """The letter that starts the variables of a file, by the age in its folder's name."""
    return chr(ord("A") + AGES["mcs"].index(int(path.split("y/")[0])))


def _child_file(lines: DataFrame, path: str, file: int) -> DataFrame:
    """One row per line of an order: child of a family."""
    letter = sweep_letter(path)
    cells = [_code(s, "l_partkey", "l_suppkey", v) for (p, v), s in sources("mcs").items() if p == path]
    return lines.filter(rows_present(path, file, "l_partkey")).selectExpr(
        f"{_person(lines, 'l_orderkey')} AS MCSID",
        f"CAST(l_linenumber AS DOUBLE) AS {letter}CNUM00",
        *cells,
        "l_partkey * 1000000 + l_suppkey AS _row",
    )


def survey_files(spark: SparkSession, sf: str, study: str, given: tuple[DataFrame, DataFrame] | None = None) -> SurveyFiles:
    """The derived files of a study, with the labels of the variables that need them; `given`: of these orders and lines."""
    family_file = "xwave/mcs_longitudinal_family_file"
    paths = list(INPUTS[study])
    orders, lines = given or (table(spark, sf, "orders"), table(spark, sf, "lineitem"))

    def read(path: str) -> DataFrame:
        if path == family_file:
            return orders.selectExpr(f"{_person(orders, 'o_orderkey')} AS MCSID", "CAST(o_custkey % 4 AS DOUBLE) AS NOCMHH", "o_orderkey AS _row")
        file = paths.index(path)
        if study == "mcs" and not path.endswith(FAMILY_ROWS):
            return _child_file(lines, path, file)
        return _person_file(orders, study, path, file)

    columns = {path: [IDS[study], *INPUTS[study][path]] for path in paths}
    if study == "mcs":
        for path in paths:
            if not path.endswith(FAMILY_ROWS):
                columns[path].insert(1, f"{sweep_letter(path)}CNUM00")
        columns[family_file] = ["MCSID", "NOCMHH"]
    variables = [Variable(*path.split("/"), v, path) for path, names in columns.items() for v in names]
    rows = [r[1:] for r in LABELS if r[0] == study] or [("", "", 0.0, "")]
    labels = spark.createDataFrame(rows, "file_path string, variable string, code double, label string")
    return SurveyFiles(variables, read, labels)


#: Rows of a study's files that are worked on at a time. What is stored by person needs no shuffle, so the disk holds
#: little more than the stored tables of a class: some 0.3 GB for so many rows.
CLASS_ROWS = {"mcs": 2_000_000_000}
OTHER_CLASS_ROWS = 500_000_000
#: Studies that are worked on at a time, where they do not all fit into one class.
AT_A_TIME = 2
#: Parts that the given tables are cut into at most. Each task that cuts writes a file a part.
PARTS = 64
#: Rows of the given tables in a bucket of persons; a task holds what is known of the persons of one bucket.
BUCKET_ROWS = {"orders": 60_000, "lineitem": 250_000}
#: What the files need of the given tables; the first column is of the person.
GIVEN = {"orders": ["o_orderkey", "o_custkey"], "lineitem": ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]}
#: The person of a row, in given tables that are stored by person.
PERSON_ID = "person_id"


def cut_by_person(spark: SparkSession, sf: str, parts: int, by_person: bool = False) -> Callable[[int, int], tuple[DataFrame, DataFrame]]:
    """Stores orders and lines in parts of persons; gives those in which the persons of class `which` of `of` are.

    A person's part follows from the hash by which `one_class` picks; `parts` and `of` are powers of two, so a class is
    some whole parts or lies in one. So a class reads its share of the tables and not all of them for each of its files.
    `by_person`: each part is stored in buckets of persons, with the person of each row. Files that are read from them
    come in these buckets, so each table crosses one shuffle, and its files none.
    """
    stored: list[list[DataFrame]] = []  # of a table, one for each part or one for all
    for name, columns in GIVEN.items():
        person = F.concat(F.lit("P"), F.col(columns[0]))
        part = F.pmod(F.xxhash64(person), F.lit(parts)).cast("int")
        given = table(spark, sf, name)
        if by_person:
            rows = given.select(*columns, person.alias(PERSON_ID))
            own = [rows.where(part == p) if parts > 1 else rows for p in range(parts)]
            stored.append([store_bucketed(df, "given", [PERSON_ID], [PERSON_ID])[0] for df in own])
        else:
            stored.append([store(given.select(*columns, part.alias("part")), "given", partition_by="part")])

    def read(which: int, of: int) -> tuple[DataFrame, DataFrame]:
        among = min(of, parts)
        if by_person:
            orders, lines = (side_by_side(own[which % among :: among]) for own in stored)
        else:
            orders, lines = (df.where(F.pmod("part", F.lit(among)) == which % among).drop("part") for (df,) in stored)
        return orders, lines

    return read


def in_classes(
    spark: SparkSession, sf: str, work: Callable[[list[Study]], DataFrame], names: tuple[str, ...] = tuple(AGES), keep: str = "classes"
) -> DataFrame:
    """The rows that `work` gives for the harmonised studies, class by class of their persons, below each other.

    The given tables are stored once in buckets of persons, few enough for a task each, and so is what is made of
    them; what is done by person is done bucket by bucket without a shuffle. A study with very many rows is cut by its persons into
    classes. Each class is prepared, worked
    on and stored before the study's next one begins, and what it needed is given up, so the disk holds the tables of
    one class of two studies whatever the number of persons. The studies do not depend on each other and go on together. Everything about a person is in one class; numbers of rows or persons are summed over them.
    """
    from panelweave.plans import bcs70, mcs, ncds, next_steps

    plans = {"mcs": mcs, "next_steps": next_steps, "bcs70": bcs70, "ncds": ncds}
    rows = {name: table(spark, sf, name).count() for name in GIVEN}
    buckets = max(int(spark.conf.get(BUCKETS)), *(rows[name] // most + 1 for name, most in BUCKET_ROWS.items()))

    def rules(name: str) -> list:
        return [*plans[name].RULES, plans[name].sample, plans[name].response]

    def planned(name: str) -> tuple[dict[str, list[str]], int]:
        wanted = wanted_by(spark, survey_files(spark, sf, name), rules(name))
        most = len(wanted) * rows["lineitem" if name == "mcs" else "orders"]  # a file has some rows of a given table
        of = most // CLASS_ROWS.get(name, OTHER_CLASS_ROWS) + 1
        return wanted, 1 << (of - 1).bit_length()

    def worked(name: str) -> list[DataFrame]:
        plan, (wanted, of) = plans[name], plan_of[name]
        done = []
        for which in range(of):
            with given_up(spark):
                files = one_class(survey_files(spark, sf, name, given(which, of)), plan.ID, which, of)
                if name == "mcs":
                    once = stacked_once(spark, files, plan.ID, rules(name), wanted, copied=False)
                else:  # one record per person and file
                    once = joined_once(spark, files, plan.ID, rules(name), wanted)
                done.append(store(work([plan.harmonise(once)]), keep, keep=True))
        return done

    with shuffles_removed(spark), given_up(spark), stored_by_person(spark, buckets):
        with ThreadPoolExecutor(len(names)) as pool:
            plan_of = dict(zip(names, pool.map(planned, names), strict=True))
        parts = min(PARTS, max(of for _, of in plan_of.values()))
        given = cut_by_person(spark, sf, parts, by_person=True)
        with ThreadPoolExecutor(len(names) if parts == 1 else AT_A_TIME) as pool:
            return stack([df for done in pool.map(worked, names) for df in done])


def summed(counts: DataFrame) -> DataFrame:
    """Counts `n` of classes added up by all other columns."""
    return counts.groupBy(*[c for c in counts.columns if c != "n"]).agg(F.sum("n").alias("n"))


def source_sql(study: str, *wanted: str) -> str:
    """The variables `file:variable` (or plain names, if unique) side by side, as a subquery."""
    known = sources(study)
    cells, present = [], []
    for name in wanted:
        path, _, variable = name.rpartition(":")
        (key,) = [k for k in known if k[1].lower() == variable.lower() and (not path or k[0] == path)]
        s = known[key]
        here = rows_present(key[0], s.file, "o_orderkey")
        if here not in present:
            present.append(here)
        codes = ", ".join(str(c) for c in s.codes)
        cells.append(
            f"CASE WHEN {here} AND (o_orderkey + {s.number}) % 11 <> 0 THEN CAST(([{codes}])"
            f"[1 + (o_orderkey * {s.factor} + o_custkey) % {len(s.codes)}] AS DOUBLE) END AS {variable.lower()}"
        )
    return f"(SELECT 'P' || o_orderkey AS pid, {', '.join(cells)} FROM orders WHERE {' OR '.join(present)})"


def mcs_sql(path: str, *wanted: str) -> str:
    """Rows of one file of mcs: family, child, row number and variables."""
    known = sources("mcs")
    file = list(INPUTS["mcs"]).index(path)
    family = path.endswith(FAMILY_ROWS)
    first, second = ("o_orderkey", "o_custkey") if family else ("l_partkey", "l_suppkey")
    cells = []
    for variable in wanted:
        s = known[path, variable]
        codes = ", ".join(str(c) for c in s.codes)
        cells.append(
            f", CASE WHEN ({first} + {s.number}) % 11 <> 0 THEN CAST(([{codes}])"
            f"[1 + ({first} * {s.factor} + {second}) % {len(s.codes)}] AS DOUBLE) END AS {variable.lower()}"
        )
    if family:
        return f"(SELECT 'P' || o_orderkey AS pid{''.join(cells)} FROM orders WHERE {rows_present(path, file, 'o_orderkey')})"
    return (
        f"(SELECT 'P' || l_orderkey AS pid, l_linenumber AS cnum, l_partkey * 1000000 + l_suppkey AS row{''.join(cells)}"
        f" FROM lineitem WHERE {rows_present(path, file, 'l_partkey')})"
    )
