"""The study plans over survey files derived from the given tables, attribute by attribute."""

from __future__ import annotations

from panelweave.plans import bcs70, mcs, ncds, next_steps
from panelweave.plans import dictionaries as d
from panelweave.plans.counts import count_values_by_sweep, persons_by_ages, published, values_ever_in_window, var_levels
from panelweave.plans.panel import responder_table, responder_values
from panelweave.workload.registry import SQL, query
from panelweave.workload.survey_inputs import in_classes, mcs_sql, source_sql, summed, survey_files

PLANS = {"mcs": mcs, "next_steps": next_steps, "bcs70": bcs70, "ncds": ncds}


def rule(study: str, name: str, sql: str) -> None:
    """Register one attribute of one study."""

    def run(spark, sf):
        return getattr(PLANS[study], name)(survey_files(spark, sf, study))

    query(sql, name=f"{study}_{name}")(run)


def label(code: str, labels: list[str]) -> str:
    """SQL: the label at a code's position."""
    texts = ", ".join(f"'{t}'" for t in labels)
    return f"([{texts}])[CASE WHEN ({code}) >= 1 THEN CAST(trunc({code}) AS INTEGER) END]"


def by_age(source: str, attribute: str, labels: list[str], codes: dict[int, str], keep_null: bool = True) -> str:
    """SQL: one row per person and age."""
    parts = [f"SELECT pid, {age} AS fup, {code} AS code FROM src" for age, code in codes.items()]
    where = "" if keep_null else f" WHERE {label('code', labels)} IS NOT NULL"
    return (
        f"WITH src AS {source}, coded AS ({' UNION ALL '.join(parts)}) "
        f"SELECT pid, CAST(fup AS INTEGER) AS fup, {label('code', labels)} AS {attribute} FROM coded{where}"
    )


def first_report(source: str, attribute: str, labels: list[str], codes: dict[int, str]) -> str:
    """SQL: the category at the earliest age, ties kept."""
    return (
        f"SELECT pid, {attribute} FROM (SELECT *, rank() OVER (PARTITION BY pid ORDER BY fup) AS r FROM "
        f"({by_age(source, attribute, labels, codes, keep_null=False)})) WHERE r = 1"
    )


def yes_no(v: str) -> str:
    return f"CASE WHEN {v} IN (1, 2) THEN 3 - {v} END"


def plus_one(v: str) -> str:
    return f"CASE WHEN {v} IN (0, 1) THEN {v} + 1 END"


def single_first(v: str, partner: str = "") -> str:
    extra = f" WHEN {v} IN ({partner}) THEN {v} - 4" if partner else ""
    return f"CASE WHEN {v} = 1 THEN 1 WHEN {v} IN (2, 3) THEN 2 WHEN {v} IN (4, 5, 6) THEN {v} - 1{extra} END"


def married_first(v: str) -> str:
    return f"CASE WHEN {v} = 1 THEN 2 WHEN {v} IN (2, 3) THEN 1 WHEN {v} IN (4, 5, 6) THEN {v} - 1 END"


def derived_marital(v: str) -> str:
    return (
        f"CASE {v} WHEN 1 THEN 3 WHEN 2 THEN 2 WHEN 3 THEN 4 WHEN 4 THEN 5 WHEN 5 THEN 2 WHEN 6 THEN 4 WHEN 7 THEN 5 WHEN 8 THEN 1 END"
    )


def religion_14(v: str) -> str:
    return (
        f"CASE WHEN {v} = 1 THEN 1 WHEN {v} BETWEEN 2 AND 9 THEN 2 WHEN {v} = 10 THEN 4 WHEN {v} = 11 THEN 7 "
        f"WHEN {v} = 12 THEN 3 WHEN {v} = 13 THEN 5 WHEN {v} = 14 THEN 6 END"
    )


def religion_13(v: str) -> str:
    return (
        f"CASE WHEN {v} = 1 THEN 1 WHEN {v} BETWEEN 2 AND 8 THEN 2 WHEN {v} = 9 THEN 4 WHEN {v} = 10 THEN 7 "
        f"WHEN {v} = 11 THEN 3 WHEN {v} = 12 THEN 5 WHEN {v} = 13 THEN 6 END"
    )


def nssec_8(v: str, last: int = 8) -> str:
    eight = f" WHEN {v} = 8 THEN 6" if last == 8 else ""
    return (
        f"CASE WHEN {v} IN (1, 2) THEN 1 WHEN {v} = 3 THEN 2 WHEN {v} = 4 THEN 3 WHEN {v} = 5 THEN 4 "
        f"WHEN {v} IN (6, 7) THEN 5{eight} END"
    )


def class_decimal(v: str) -> str:
    return (
        f"CASE WHEN {v} IN (1, 2) THEN {v} WHEN {v} = CAST(3.1 AS DOUBLE) THEN 3 WHEN {v} = CAST(3.2 AS DOUBLE) THEN 4 "
        f"WHEN {v} IN (4, 5) THEN {v} + 1 END"
    )


def ethnic_16(v: str) -> str:
    return (
        f"CASE WHEN {v} BETWEEN 1 AND 3 THEN 1 WHEN {v} BETWEEN 4 AND 7 THEN 2 WHEN {v} = 8 THEN 3 "
        f"WHEN {v} IN (9, 10) THEN 4 WHEN {v} IN (12, 13, 14) THEN 5 WHEN {v} IN (11, 15, 16) THEN 6 END"
    )


def ethnic_8(v: str) -> str:
    return f"CASE WHEN {v} BETWEEN 1 AND 3 THEN {v} WHEN {v} IN (4, 5) THEN 4 WHEN {v} IN (6, 7) THEN 5 WHEN {v} = 8 THEN 6 END"


def orientation(v: str) -> str:
    return f"CASE WHEN {v} IN (1, 4) THEN {v} WHEN {v} = 2 THEN 3 WHEN {v} = 3 THEN 2 END"


def position(v: str, codes: list) -> str:
    texts = ", ".join("NULL" if c is None else str(c) for c in codes)
    return f"([{texts}])[CASE WHEN {v} >= 1 THEN CAST({v} AS INTEGER) END]"


def responses(source: str, ages: dict[str, int]) -> str:
    parts = [f"SELECT pid, CAST({age} AS INTEGER) AS fup, pid AS iid FROM src WHERE {v} = 1" for v, age in ages.items()]
    return f"WITH src AS {source} {' UNION ALL '.join(parts)}"


# --- 1970 cohort

_A, _B, _C = "CASE WHEN a12_1 > -1 THEN a12_1 END", "CASE WHEN a12_4 > -1 THEN a12_4 END", "CASE WHEN a12_7 > -1 THEN a12_7 END"
_AGE_10 = """CASE WHEN a IN (1, 2, 3) AND (b IS NULL OR b IN (1, 2, 3)) AND c IS NULL THEN 1
  WHEN a = 4 AND b IS NULL AND c IS NULL THEN 5 WHEN a = 5 AND (b IS NULL OR b = 5) AND c IS NULL THEN 3
  WHEN a IN (6, 7) AND (b IS NULL OR b IN (6, 7)) AND c IS NULL THEN 4
  WHEN a = 8 AND (b IS NULL OR b = 8) AND (c IS NULL OR c = 8) THEN 6
  WHEN (a IS NOT NULL)::INT + (b IS NOT NULL)::INT + (c IS NOT NULL)::INT >= 2 THEN 2 END"""
_AGE_16 = """CASE WHEN oa3_1 IN (1, 2, 3) THEN 1 WHEN oa3_1 = 4 THEN 5 WHEN oa3_1 = 5 THEN 3 WHEN oa3_1 IN (6, 7) THEN 4
  WHEN c6_14 = 1 THEN 1 WHEN c6_14 = 2 THEN 5 WHEN c6_14 = 5 THEN 2 WHEN c6_14 = 6 THEN 6 END"""
_ETHNIC = source_sql(
    "bcs70", "e245", "a12_1", "a12_4", "a12_7", "oa3_1", "16y/bcs7016x:c6_14", "ethnic", "bd7ethnic"
)

rule(
    "bcs70",
    "ethnicity",
    first_report(
        f"(SELECT *, {_A} AS a, {_B} AS b, {_C} AS c FROM {_ETHNIC})",
        "ethnic_group",
        d.ETHNIC,
        {
            5: "CASE WHEN e245 IN (1, 2) THEN 1 WHEN e245 IN (3, 6) THEN 5 END",
            10: _AGE_10,
            16: _AGE_16,
            29: ethnic_16("ethnic"),
            34: ethnic_16("bd7ethnic"),
        },
    ),
)
rule(
    "bcs70",
    "sex",
    f"SELECT pid, CASE sex WHEN 1 THEN 'Male' WHEN 2 THEN 'Female' END AS sex FROM {source_sql('bcs70', 'SEX')}",
)
rule(
    "bcs70",
    "sexuality",
    f"SELECT pid, {label(orientation('b9sxid'), d.SEXUALITY)} AS sexuality FROM {source_sql('bcs70', 'B9SXID')}",
)


def _country_70(v: str) -> str:
    return f"CASE WHEN {v} > -1 AND {v} NOT IN (5, 6, 12) THEN {v} END"


rule(
    "bcs70",
    "country",
    by_age(
        source_sql("bcs70", "BD1CNTRY", "BD2CNTRY", "BD7CNTRY", "BD10CNTRY"),
        "country",
        d.COUNTRY,
        {
            0: _country_70("bd1cntry"),
            5: _country_70("bd2cntry"),
            34: _country_70("bd7cntry"),
            46: "CASE bd10cntry WHEN 1 THEN 1 WHEN 2 THEN 4 WHEN 3 THEN 3 WHEN 4 THEN 2 END",
        },
        keep_null=False,
    ),
)
rule(
    "bcs70",
    "fsm",
    by_age(
        source_sql("bcs70", "m126", "m128"),
        "fsm",
        d.BINARY,
        {10: "CASE WHEN m126 = 1 OR m128 = 1 THEN 2 WHEN m126 = 2 THEN 1 END"},
        keep_null=False,
    ),
)
rule(
    "bcs70",
    "sen",
    by_age(
        source_sql("bcs70", "mea11", "l7_5"),
        "sen",
        d.BINARY,
        {10: "CASE WHEN mea11 IN (4, 5, 6) OR l7_5 = 1 THEN 2 WHEN mea11 IN (1, 2, 3) OR l7_5 = 2 THEN 1 END"},
        keep_null=False,
    ),
)
rule(
    "bcs70",
    "marstat",
    by_age(
        source_sql("bcs70", "b960322", "marstat2", "bd7ms", "bd8ms", "BD9MS", "BD10MS"),
        "marstat",
        d.MARITAL,
        {
            26: single_first("b960322"),
            29: single_first("marstat2"),
            34: married_first("bd7ms"),
            38: single_first("bd8ms", "7, 8"),
            42: derived_marital("bd9ms"),
            46: derived_marital("bd10ms"),
        },
    ),
)
_RELIGION_26 = """CASE WHEN b960663 = 2 THEN 1 WHEN q48 BETWEEN 2 AND 22 THEN 2 WHEN q48 = 23 THEN 4 WHEN q48 = 24 THEN 7
  WHEN q48 = 25 THEN 3 WHEN q48 = 26 THEN 5 WHEN q48 = 27 THEN 6 END"""
_RELIGION_16 = """CASE WHEN gd1a IN (1, 2, 3) THEN 2 WHEN gd1a = 4 THEN 3 WHEN gd1a = 5 THEN 4 WHEN gd1a = 6 THEN 6
  WHEN gd1a = 7 THEN 5 WHEN gd1a = 8 THEN 7 WHEN gd1a = 10 THEN 1 END"""
rule(
    "bcs70",
    "religion",
    by_age(
        source_sql("bcs70", "gd1a", "b960663", "q48", "religion", "b7rnowrl", "b7rrelnw"),
        "religion",
        d.RELIGION,
        {
            16: _RELIGION_16,
            26: _RELIGION_26,
            29: religion_14("religion"),
            34: "CASE WHEN b7rnowrl = 2 THEN 1 ELSE ([2, 6, 4, 7, 3, 5])[CASE WHEN b7rrelnw > 0 THEN CAST(b7rrelnw AS INTEGER) END] END",
        },
    ),
)
rule(
    "bcs70",
    "disabled",
    by_age(
        source_sql("bcs70", "lsireg2", "b7khldl2", "b8khldl2", "BD9DISEQ", "BD10DISEQ"),
        "disabled",
        d.BINARY,
        {
            29: yes_no("lsireg2"),
            34: "CASE WHEN b7khldl2 = 1 THEN 2 WHEN b7khldl2 IN (2, 3) THEN 1 END",
            38: yes_no("b8khldl2"),
            42: plus_one("bd9diseq"),
            46: plus_one("bd10diseq"),
        },
    ),
)


def _six_reversed(v: str) -> str:
    return f"CASE WHEN {v} BETWEEN 1 AND 6 THEN 7 - {v} END"


_RGSC_70 = by_age(
    source_sql("bcs70", "BD1PSOC", "BD2SOC", "BD3PSOC", "BD4PSOC", "rgsc91", "sc", "b7sc", "b8sc", "B9CSC"),
    "rgsc",
    d.RGSC,
    {
        0: "CASE WHEN bd1psoc = 1 THEN 7 WHEN bd1psoc BETWEEN 3 AND 8 THEN 9 - bd1psoc END",
        5: _six_reversed("bd2soc"),
        10: _six_reversed("bd3psoc"),
        16: _six_reversed("bd4psoc"),
        26: """CASE WHEN rgsc91 BETWEEN 10 AND 20 THEN rgsc91 / 10 WHEN rgsc91 IN (31, 32) THEN rgsc91 - 28
          WHEN rgsc91 BETWEEN 40 AND 50 THEN 1 + rgsc91 / 10 END""",
        29: class_decimal("sc"),
        34: class_decimal("b7sc"),
        38: class_decimal("b8sc"),
        42: class_decimal("b9csc"),
    },
)
_NSSEC_70 = by_age(
    source_sql("bcs70", "bd7ns8", "B9CNS8", "BD10CNS8"),
    "nssec",
    d.NSSEC,
    {34: nssec_8("bd7ns8", last=7), 42: nssec_8("b9cns8"), 46: nssec_8("bd10cns8")},
)
rule("bcs70", "rgsc", _RGSC_70)
rule("bcs70", "nssec", _NSSEC_70)
rule("bcs70", "social_class", f"SELECT * FROM ({_RGSC_70}) FULL JOIN ({_NSSEC_70}) USING (pid, fup)")
_OUTCOMES_70 = source_sql("bcs70", *[f"OUTCME{s:02d}" for s in range(1, 11)])
rule("bcs70", "sample", f"SELECT pid, pid AS iid FROM {_OUTCOMES_70}")
rule("bcs70", "response", responses(_OUTCOMES_70, {f"outcme{i:02d}": a for i, a in enumerate(d.AGES["bcs70"], 1)}))

# --- 1958 cohort

rule(
    "ncds",
    "ethnicity",
    f"SELECT pid, {label('ethnicid', d.ETHNIC)} AS ethnic_group FROM {source_sql('ncds', 'ETHNICID')}",
)
rule(
    "ncds", "sex", f"SELECT pid, CASE n622 WHEN 1 THEN 'Male' WHEN 2 THEN 'Female' END AS sex FROM {source_sql('ncds', 'N622')}"
)


def _region(v: str, last: int) -> str:
    return f"CASE WHEN {v} BETWEEN 1 AND {last} THEN 1 WHEN {v} = {last + 1} THEN 2 WHEN {v} = {last + 2} THEN 3 END"


rule(
    "ncds",
    "country",
    by_age(
        source_sql("ncds", "n0region", "n1region", "n4region", "n6region", "nd9regn"),
        "country",
        d.COUNTRY,
        {
            0: _region("n0region", 9),
            7: _region("n1region", 9),
            23: _region("n4region", 8),
            42: _region("n6region", 8),
            55: _region("nd9regn", 8),
        },
        keep_null=False,
    ),
)
rule(
    "ncds",
    "fsm",
    by_age(
        source_sql("ncds", "n1229", "n858", "n2440"),
        "fsm",
        d.BINARY,
        {
            11: "CASE WHEN n1229 = 1 OR n858 = 1 THEN 2 WHEN n1229 = 2 OR n858 = 2 THEN 1 END",
            16: yes_no("n2440"),
        },
        keep_null=False,
    ),
)
rule(
    "ncds",
    "sen",
    by_age(
        source_sql("ncds", "n390", "n391", "n392", "n1476", "n1477", "n1478", "n1479"),
        "sen",
        d.BINARY,
        {
            7: "CASE WHEN n390 = 9 OR n391 = 9 OR n392 = 9 THEN 2 WHEN n390 IN (1, 2, 4, 5, 6, 7, 8, 10, 11, 12) THEN 1 END",
            11: "CASE WHEN n1477 IN (5, 6) OR n1478 IN (5, 6) OR n1479 IN (5, 6) THEN 2 WHEN n1476 BETWEEN 1 AND 5 THEN 1 END",
        },
        keep_null=False,
    ),
)
rule(
    "ncds",
    "marstat",
    by_age(
        source_sql("ncds", "n5113", "n506515", "ms", "marital", "nd7ms", "ND8MS", "ND9MS"),
        "marstat",
        d.MARITAL,
        {
            23: "CASE WHEN n5113 BETWEEN 1 AND 5 THEN n5113 END",
            33: single_first("n506515"),
            42: married_first("ms"),
            44: single_first("marital"),
            46: married_first("nd7ms"),
            50: single_first("nd8ms", "7, 8, 9"),
            55: derived_marital("nd9ms"),
        },
    ),
)
_RELIGION_50 = """CASE WHEN n8rnowrl = 2 THEN 1 WHEN n8rrelnw IN (1, 2, 3) THEN 2 WHEN n8rrelnw = 4 THEN 6 WHEN n8rrelnw = 5 THEN 4
  WHEN n8rrelnw = 6 THEN 7 WHEN n8rrelnw = 7 THEN 3 WHEN n8rrelnw = 8 THEN 5 END"""
rule(
    "ncds",
    "religion",
    by_age(
        source_sql("ncds", "n5967", "n504651", "religion", "N8RNOWRL", "N8RRELNW"),
        "religion",
        d.RELIGION,
        {23: religion_13("n5967"), 33: religion_13("n504651"), 42: religion_14("religion"), 50: _RELIGION_50},
    ),
)
_DISABLED_33 = """CASE WHEN n504121 = 2 THEN 1 WHEN n504122 = 1 OR n504125 = 1 OR n504128 = 1 OR n504131 = 1 THEN 2 END"""
rule(
    "ncds",
    "disabled",
    by_age(
        source_sql(
            "ncds", "n281", "n2662", "n4139", "n504121", "n504122", "n504125", "n504128", "n504131", "bdmph",
            "42y/ncds6:lsireg2", "n7khldsl", "ND8KHLDS", "ND9DISEQ",
        ),
        "disabled",
        d.BINARY,
        {
            7: "CASE WHEN n281 IN (2, 3) THEN 4 - n281 END",
            16: yes_no("n2662"),
            23: yes_no("n4139"),
            33: _DISABLED_33,
            42: yes_no("lsireg2"),
            44: yes_no("bdmph"),
            46: "CASE WHEN n7khldsl = 1 THEN 2 WHEN n7khldsl IN (2, 3) THEN 1 END",
            50: yes_no("nd8khlds"),
            55: plus_one("nd9diseq"),
        },
    ),
)


def _class_birth(v: str) -> str:
    return f"CASE WHEN {v} = 1 THEN 8 WHEN {v} > -1 AND {v} NOT IN (10, 12) THEN {v} END"


def _lesser(a: str, b: str) -> str:
    return f"coalesce(CASE WHEN {a} <= {b} THEN {a} WHEN {b} < {a} THEN {b} END, {a}, {b})"


_CLASSES = source_sql(
    "ncds", "n236", "n660", "n190", "n1687", "n2384", "n2393", "n6149", "n540033", "sc", "n7sc", "N8SC", "N9CSC"
)
_BIRTH = _lesser("a0", "b0")
_AT_16 = _lesser("a16", "b16")
_RGSC_58 = by_age(
    f"""(SELECT *, {_class_birth("n236")} AS a0, {_class_birth("n660")} AS b0,
      CASE WHEN n2384 BETWEEN 1 AND 7 THEN n2384 END AS a16, CASE WHEN n2393 BETWEEN 1 AND 7 THEN n2393 END AS b16
      FROM {_CLASSES})""",
    "rgsc",
    d.RGSC,
    {
        0: f"CASE WHEN {_BIRTH} BETWEEN 2 AND 7 THEN {_BIRTH} - 1 END",
        7: "CASE WHEN n190 BETWEEN 2 AND 5 THEN n190 - 1 WHEN n190 BETWEEN 6 AND 8 THEN n190 - 2 END",
        11: "CASE WHEN n1687 BETWEEN 1 AND 6 THEN n1687 END",
        16: f"CASE WHEN {_AT_16} <= 5 THEN {_AT_16} ELSE {_AT_16} - 1 END",
        23: "CASE n6149 WHEN 11 THEN 1 WHEN 21 THEN 2 WHEN 31 THEN 3 WHEN 32 THEN 4 WHEN 41 THEN 5 WHEN 42 THEN 5 WHEN 52 THEN 6 END",
        33: "CASE n540033 WHEN 10 THEN 1 WHEN 20 THEN 2 WHEN 31 THEN 3 WHEN 32 THEN 4 WHEN 40 THEN 5 WHEN 50 THEN 6 END",
        42: class_decimal("sc"),
        46: class_decimal("n7sc"),
        50: class_decimal("n8sc"),
        55: class_decimal("n9csc"),
    },
)
_NSSEC_58 = by_age(
    source_sql("ncds", "nd7ns8", "N8NS8", "N9CNS8"),
    "nssec",
    d.NSSEC,
    {46: nssec_8("nd7ns8"), 50: nssec_8("n8ns8"), 55: nssec_8("n9cns8")},
)
rule("ncds", "rgsc", _RGSC_58)
rule("ncds", "nssec", _NSSEC_58)
rule("ncds", "social_class", f"SELECT * FROM ({_RGSC_58}) FULL JOIN ({_NSSEC_58}) USING (pid, fup)")
_SWEEPS_58 = {"00": 0, "01": 7, "02": 11, "03": 16, "04": 23, "05": 33, "06": 42, "bm": 44, "07": 46, "08": 50, "09": 55}
_OUTCOMES_58 = source_sql("ncds", *[f"OUTCME{s}" for s in _SWEEPS_58])
rule("ncds", "sample", f"SELECT pid, pid AS iid FROM {_OUTCOMES_58}")
rule("ncds", "response", responses(_OUTCOMES_58, {f"outcme{s}": age for s, age in _SWEEPS_58.items()}))

# --- teenage cohort

rule(
    "next_steps",
    "ethnicity",
    first_report(
        source_sql("next_steps", "W1ethgrpYP", "W2ethgrpYP", "W8DETHN6"),
        "ethnic_group",
        d.ETHNIC,
        {14: ethnic_8("w1ethgrpyp"), 15: ethnic_8("w2ethgrpyp"), 25: "w8dethn6"},
    ),
)
_SEX_WAVES = source_sql("next_steps", "W1sexYP", "W2SexYP", "W8CMSEX")
_SEX_GRID = source_sql("next_steps", "eul/wave_one_household_grid:Sex", "ReltoYP")
rule(
    "next_steps",
    "sex",
    f"""WITH w AS (SELECT pid, CASE WHEN w1sexyp IN (1, 2) THEN w1sexyp WHEN w2sexyp IN (1, 2) THEN w2sexyp
      WHEN w8cmsex IN (1, 2) THEN w8cmsex END AS sex FROM {_SEX_WAVES}),
    g AS (SELECT pid, CASE WHEN sex IN (1, 2) THEN sex END AS sex FROM {_SEX_GRID} WHERE reltoyp = 0),
    own AS (SELECT * FROM w WHERE sex IS NOT NULL)
    SELECT pid, CASE coalesce(g.sex, own.sex) WHEN 1 THEN 'Male' WHEN 2 THEN 'Female' END AS sex FROM g FULL JOIN own USING (pid)""",
)
rule(
    "next_steps",
    "sexuality",
    first_report(
        source_sql("next_steps", "W3sexual_YP", "W6Sexuality", "W8SEXUALITY"),
        "sexuality",
        d.SEXUALITY,
        {16: orientation("w3sexual_yp"), 19: orientation("w6sexuality"), 25: orientation("w8sexuality")},
    ),
)
rule(
    "next_steps",
    "country",
    f"""SELECT pid, CAST(25 AS INTEGER) AS fup, CASE w8dctry WHEN 0 THEN '0' WHEN 1 THEN 'England' WHEN 2 THEN 'Wales'
    WHEN 3 THEN 'Scotland' WHEN 4 THEN 'Northern Ireland' WHEN 5 THEN '5' END AS country FROM {source_sql("next_steps", "W8DCTRY")}""",
)


def _needs(ever: str, now: str) -> str:
    return f"CASE WHEN {ever} = 1 OR {now} = 1 THEN 2 WHEN {ever} = 2 OR {now} = 2 THEN 1 END"


rule(
    "next_steps",
    "sen",
    by_age(
        source_sql("next_steps", "W1senMP", "W1sencurrMP", "W2senMP", "W2sencurrMP", "W2statedMP"),
        "sen",
        d.BINARY,
        {14: _needs("w1senmp", "w1sencurrmp"), 15: _needs("w2senmp", "w2sencurrmp")},
        keep_null=False,
    ),
)
rule(
    "next_steps",
    "marstat",
    by_age(
        source_sql("next_steps", "W6marstatYP", "W8DMARSTAT"),
        "marstat",
        d.MARITAL,
        {
            19: "CASE WHEN w6marstatyp BETWEEN 1 AND 5 THEN w6marstatyp END",
            25: position("w8dmarstat", [1, 2, 3, 4, 5, 2, 3, 4, 5]),
        },
    ),
)
_RELIGION_TEEN = [1, 2, 6, 4, 7, 3, 5, None]
rule(
    "next_steps",
    "religion",
    by_age(
        source_sql("next_steps", "W1relig1YP", "relig1YP", "W8DRELIG7"),
        "religion",
        d.RELIGION,
        {14: position("w1relig1yp", _RELIGION_TEEN), 15: position("relig1yp", _RELIGION_TEEN)},
    ),
)
rule(
    "next_steps",
    "disabled",
    by_age(
        source_sql("next_steps", "W8DDISEA", "W7DisabV1", "W6disab", "W4disabYP", "W2disabYP", "W1disabYP"),
        "disabled",
        d.BINARY,
        {
            25: plus_one("w8ddisea"),
            20: yes_no("w7disabv1"),
            19: yes_no("w6disab"),
            17: position("w4disabyp", [2, 1, 1]),
            15: position("w2disabyp", [2, 1, 1]),
            14: position("w1disabyp", [2, 1, 1]),
        },
    ),
)
_EIGHT = [1, 1, 2, 3, 4, 5, 5, 6]
_MUM, _DAD = (f"CASE WHEN {v} > -1 THEN {v} END" for v in ("w5cnssecmum", "w5cnssecdad"))
rule(
    "next_steps",
    "social_class",
    by_age(
        f"""(SELECT *, least({_MUM}, {_DAD}) AS w5 FROM {source_sql(
            "next_steps", "W1nssecfam", "W2nssecfam", "W3cnssecfam", "W5cnssecmum", "W5cnssecdad", "W6nssecyp", "W7nssec", "W8DNSSEC5"
        )})""",
        "nssec",
        d.NSSEC,
        {
            14: position("w1nssecfam", _EIGHT),
            15: position("w2nssecfam", _EIGHT),
            16: position("w3cnssecfam", _EIGHT),
            18: position("w5", _EIGHT),
            19: position("w6nssecyp", _EIGHT),
            20: position("w7nssec", _EIGHT),
            25: position("w8dnssec5", _EIGHT),
        },
    ),
)
rule(
    "next_steps",
    "carer",
    by_age(
        source_sql("next_steps", "W1careYP", "W2caringYP"),
        "carer",
        d.BINARY,
        {14: yes_no("w1careyp"), 15: yes_no("w2caringyp")},
    ),
)
_OUTCOMES_TEEN = source_sql("next_steps", *[f"W{w}OUTCOME" for w in range(1, 9)])
rule("next_steps", "sample", f"SELECT pid, pid AS iid FROM {_OUTCOMES_TEEN}")
rule(
    "next_steps",
    "response",
    responses(_OUTCOMES_TEEN, {f"w{i}outcome": a for i, a in enumerate(d.AGES["next_steps"], 1)}),
)

# --- millennium cohort

_CHILD = """(SELECT 'P' || o_orderkey AS pid, CAST(i AS INTEGER) AS cnum FROM orders
  JOIN (SELECT unnest([1, 2]) AS i) ON o_custkey % 4 IN (1, 2) AND i <= o_custkey % 4)"""


def _reports(*parts: tuple[str, int, str, str]) -> str:
    """SQL: rows of several files, as (source, age, code, condition)."""
    return " UNION ALL ".join(
        f"SELECT pid, cnum, {age} AS fup, {code} AS code, {i} AS file, row FROM {source} WHERE {condition}"
        for i, (source, age, code, condition) in enumerate(parts)
    )


def _mcs_long(reports: str, attribute: str, labels: list[str], keep_null: bool = True) -> str:
    where = "" if keep_null else f" WHERE {label('code', labels)} IS NOT NULL"
    return (
        f"SELECT pid, CAST(cnum AS INTEGER) AS cnum, CAST(fup AS INTEGER) AS fup, {label('code', labels)} AS {attribute}"
        f" FROM ({reports}){where}"
    )


def _mcs_first(reports: str, attribute: str, labels: list[str]) -> str:
    return (
        f"SELECT pid, cnum, {attribute} FROM (SELECT *, rank() OVER (PARTITION BY pid, cnum ORDER BY fup) AS r FROM "
        f"({_mcs_long(reports, attribute, labels, keep_null=False)})) WHERE r = 1"
    )


def _mcs_top_row(reports: str, attribute: str, labels: list[str]) -> str:
    return _mcs_long(
        f"""SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY pid, cnum, fup ORDER BY file, row) AS r
        FROM ({reports}) WHERE {label("code", labels)} IS NOT NULL) WHERE r = 1""",
        attribute,
        labels,
    )


def _valid(v: str, last: int) -> str:
    return f"CASE WHEN {v} BETWEEN 1 AND {last} THEN {v} END"


rule(
    "mcs",
    "ethnicity",
    _mcs_first(
        _reports(
            (mcs_sql("3y/mcs2_parent_interview", "BDC06E00"), 3, _valid("bdc06e00", 6), "true"),
            (mcs_sql("5y/mcs3_parent_interview", "CDCE0600"), 5, _valid("cdce0600", 6), "true"),
        ),
        "ethnic_group",
        d.ETHNIC,
    ),
)
_TWO = "cnum IN (1, 2)"
_GRID_4, _GRID_5 = mcs_sql("7y/mcs4_hhgrid", "DHCSEX00", "DCSEX0000"), mcs_sql("11y/mcs5_hhgrid", "ECSEX0000")
_MCS_SEX = _mcs_first(
    _reports(
        (_GRID_4, 7, _valid("dhcsex00", 2), _TWO),
        (_GRID_4, 7, _valid("dcsex0000", 2), _TWO),
        (_GRID_5, 11, _valid("ecsex0000", 2), _TWO),
    ),
    "sex",
    d.SEX,
)
rule("mcs", "sex", _MCS_SEX)
_TEEN = mcs_sql("17y/mcs7_cm_interview", "GCGNID00", "GCSXID00", "GCCARE00", "GCCLSI00")
_GENDER = """CASE WHEN gcgnid00 IN (1, 2) AND gcgnid00 = CASE sex WHEN 'Male' THEN 1 WHEN 'Female' THEN 2 END THEN 1
  WHEN gcgnid00 IN (1, 2) AND gcgnid00 <> CASE sex WHEN 'Male' THEN 1 WHEN 'Female' THEN 2 END THEN 2
  WHEN gcgnid00 IN (4, 5, 6) THEN 3 WHEN gcgnid00 = 3 THEN 4 END"""
rule(
    "mcs",
    "gender",
    _mcs_long(
        f"SELECT pid, cnum, 17 AS fup, {_GENDER} AS code FROM {_TEEN} LEFT JOIN ({_MCS_SEX}) USING (pid, cnum)",
        "gender_identity",
        d.GENDER,
    ),
)
_SCALE = "CASE WHEN gcsxid00 IN (1, 2) THEN 1 WHEN gcsxid00 = 3 THEN 2 WHEN gcsxid00 IN (4, 5) THEN 3 WHEN gcsxid00 = 6 THEN 4 END"
rule("mcs", "sexuality", _mcs_long(_reports((_TEEN, 17, _SCALE, "true")), "sexuality", d.SEXUALITY))
_COUNTRY_OWN = mcs_sql("17y/mcs7_cm_derived", "GACTRY00")
_COUNTRY_5, _COUNTRY_6 = (
    mcs_sql("11y/mcs5_family_derived", "EACTRY00"),
    mcs_sql("14y/mcs6_family_derived", "FACTRY00"),
)
rule(
    "mcs",
    "country",
    _mcs_long(
        f"""SELECT pid, cnum, 17 AS fup, {_valid("gactry00", 4)} AS code FROM {_COUNTRY_OWN} WHERE {_TWO} UNION ALL
        SELECT pid, cnum, 11, {_valid("eactry00", 4)} FROM {_COUNTRY_5} JOIN {_CHILD} USING (pid) UNION ALL
        SELECT pid, cnum, 14, {_valid("factry00", 4)} FROM {_COUNTRY_6} JOIN {_CHILD} USING (pid)""",
        "country",
        d.COUNTRY,
        keep_null=False,
    ),
)


def _meals(school: str, free: str, eligible: str) -> str:
    """Received if 2, else eligible if 1; codes 3 and 4 and negatives are no answer."""
    return f"""CASE WHEN NOT coalesce({school}, false) AND {free} = 2 THEN 2 WHEN {eligible} = 1 THEN 2
      WHEN {school} OR {free} = 1 THEN 1 WHEN {eligible} IN (0, 2) THEN 1 END"""


rule(
    "mcs",
    "fsm",
    _mcs_top_row(
        _reports(
            (
                mcs_sql("5y/mcs3_parent_interview", "CPSCHD00", "CPFREM00", "CPELFR00"),
                5,
                _meals("cpschd00 = 2", "cpfrem00", "cpelfr00"),
                "true",
            ),
            (
                mcs_sql("7y/mcs4_parent_interview", "DPFREM00", "DPELFR00"),
                7,
                _meals("false", "dpfrem00", "dpelfr00"),
                "true",
            ),
        ),
        "fsm",
        d.BINARY,
    ),
)
rule(
    "mcs",
    "sen",
    _mcs_top_row(
        _reports(
            (mcs_sql("7y/mcs4_parent_interview", "DPCSEN00"), 7, yes_no("dpcsen00"), "true"),
            (mcs_sql("11y/mcs5_parent_cm_interview", "EPCSEN00"), 11, yes_no("epcsen00"), "true"),
        ),
        "sen",
        d.BINARY,
    ),
)


def _child_religion(*names: str) -> str:
    england, *others = names
    sql = f"CASE WHEN {england} BETWEEN 1 AND 7 THEN ([1, 2, 6, 4, 7, 3, 5])[CAST({england} AS INTEGER)]"
    if others:
        wales, scotland, ireland = others
        sql += f""" WHEN {wales} BETWEEN 1 AND 7 THEN ([1, 2, 6, 4, 7, 3, 5])[CAST({wales} AS INTEGER)]
          WHEN {scotland} BETWEEN 1 AND 9 THEN ([1, 2, 2, 2, 3, 6, 5, 7, 4])[CAST({scotland} AS INTEGER)]
          WHEN {ireland} = 6 THEN 1 WHEN {ireland} BETWEEN 1 AND 4 THEN 2"""
    return sql + " END"


_CHILD_11 = mcs_sql("11y/mcs5_cm_interview", "ECRELE00_R20", "ECRELW00_R20", "ECRELS00_R20", "ECRELN00_R20")
_CHILD_14 = mcs_sql("14y/mcs6_cm_interview", "FCRELE00", "FCCLSI00", "FCCLSL00")
_PARENT_3 = mcs_sql(
    "3y/mcs2_parent_derived", "BELIG00", "BDRLG00", "BDDRLG00", "BD05S00", "BDD05S00", "BDD05C00"
)
_PARENT_RELIGION = """([2, 3, 4, 5, 7, 6, NULL, 1])[CASE WHEN coalesce(bddrlg00, bdrlg00) >= 1
  THEN CAST(coalesce(bddrlg00, bdrlg00) AS INTEGER) END]"""
_ELEVEN = _child_religion("ecrele00_r20", "ecrelw00_r20", "ecrels00_r20", "ecreln00_r20")
rule(
    "mcs",
    "religion",
    _mcs_long(
        f"""SELECT pid, cnum, 11 AS fup, {_ELEVEN} AS code FROM {_CHILD_11}
        UNION ALL SELECT pid, cnum, 14, {_child_religion("fcrele00")} FROM {_CHILD_14}
        UNION ALL SELECT p.pid, k.cnum, 3, {_PARENT_RELIGION} FROM {_PARENT_3} p JOIN {_CHILD} k ON p.pid = k.pid WHERE belig00 = 1""",
        "religion",
        d.RELIGION,
        keep_null=False,
    ),
)


def _limits(first: str, item: str, sweep: int) -> str:
    if sweep < 4:
        return f"CASE WHEN {first} = 2 THEN 1 WHEN {item} = 2 THEN 1 WHEN {item} = 1 THEN 2 END"
    return f"CASE WHEN {first} = 2 THEN 1 WHEN {item} = 3 THEN 1 WHEN {item} IN (1, 2) THEN 2 END"


rule(
    "mcs",
    "disabled",
    _mcs_long(
        _reports(
            (mcs_sql("3y/mcs2_parent_interview", "BPCLSI00", "BPCLSL00"), 3, _limits("bpclsi00", "bpclsl00", 2), "true"),
            (mcs_sql("5y/mcs3_parent_interview", "CPCLSI00", "CPCLSL00"), 5, _limits("cpclsi00", "cpclsl00", 3), "true"),
            (mcs_sql("7y/mcs4_parent_interview", "DPCLSL00"), 7, _limits("NULL", "dpclsl00", 4), "true"),
            (_CHILD_14, 14, _limits("fcclsi00", "fcclsl00", 6), "true"),
            (_TEEN, 17, "CASE WHEN gcclsi00 = 2 THEN 1 END", "true"),
        ),
        "disabled",
        d.BINARY,
    ),
)
_HOUSEHOLD = """least(coalesce(CASE WHEN bdd05s00 NOT IN (-1, 8) THEN bdd05s00 END, CASE WHEN bd05s00 NOT IN (-1, 8) THEN bd05s00 END,
  CASE WHEN bdd05c00 NOT IN (-1, 8) THEN bdd05c00 END))"""
rule(
    "mcs",
    "social_class",
    f"""SELECT pid, CAST(3 AS INTEGER) AS fup, {label("code", d.NSSEC)} AS nssec FROM
    (SELECT pid, min({_HOUSEHOLD}) AS code FROM {_PARENT_3} GROUP BY pid) WHERE code IS NOT NULL""",
)
_CARE = "CASE gccare00 WHEN 1 THEN 2 WHEN 2 THEN 1 END"
rule("mcs", "carer", _mcs_long(_reports((_TEEN, 17, _CARE, "true")), "carer", d.BINARY, keep_null=False))
rule("mcs", "sample", f"SELECT pid, cnum, pid || '_' || cnum AS iid FROM {_CHILD}")
_INTERVIEWS = " UNION ALL ".join(
    f"SELECT pid, cnum, {age} AS fup FROM {mcs_sql(f'{age}y/mcs{i}_cm_interview')}"
    for i, age in enumerate(d.AGES["mcs"], 1)
)
rule(
    "mcs",
    "response",
    f"""SELECT pid, CAST(cnum AS INTEGER) AS cnum, CAST(fup AS INTEGER) AS fup, pid || '_' || cnum AS iid
    FROM ({_INTERVIEWS}) JOIN {_CHILD} USING (pid, cnum)""",
)

# --- all studies

_TABLES = {
    "next_steps": {
        "ethnicity": "pid",
        "sex": "pid",
        "sexuality": "pid",
        "country": "pid, fup",
        "sen": "pid, fup",
        "marstat": "pid, fup",
        "religion": "pid, fup",
        "disabled": "pid, fup",
        "social_class": "pid, fup",
        "carer": "pid, fup",
    },
    "bcs70": {
        "ethnicity": "pid",
        "sex": "pid",
        "sexuality": "pid",
        "country": "pid, fup",
        "fsm": "pid, fup",
        "sen": "pid, fup",
        "marstat": "pid, fup",
        "religion": "pid, fup",
        "disabled": "pid, fup",
        "social_class": "pid, fup",
    },
    "ncds": {
        "ethnicity": "pid",
        "sex": "pid",
        "country": "pid, fup",
        "fsm": "pid, fup",
        "sen": "pid, fup",
        "marstat": "pid, fup",
        "religion": "pid, fup",
        "disabled": "pid, fup",
        "social_class": "pid, fup",
    },
    "mcs": {
        "ethnicity": "pid, cnum",
        "sex": "pid, cnum",
        "gender": "pid, cnum, fup",
        "sexuality": "pid, cnum, fup",
        "country": "pid, cnum, fup",
        "fsm": "pid, cnum, fup",
        "sen": "pid, cnum, fup",
        "religion": "pid, cnum, fup",
        "disabled": "pid, cnum, fup",
        "social_class": "pid, fup",
        "carer": "pid, cnum, fup",
    },
}
_COLUMNS = {
    "ethnicity": ["ethnic_group"],
    "gender": ["gender_identity"],
    "social_class": ["nssec", "rgsc"],
}


def _study_panel(study: str) -> str:
    """SQL: responders of a study with all attributes."""
    joins = " ".join(f"LEFT JOIN ({SQL[f'{study}_{t}']}) {t} USING ({keys})" for t, keys in _TABLES[study].items())
    have = {c for t in _TABLES[study] for c in _COLUMNS.get(t, [t])} - ({"rgsc"} if study in ("mcs", "next_steps") else set())
    cells = [c if c in have else f"CAST(NULL AS VARCHAR) AS {c}" for c in d.ATTRIBUTES if c != "response"]
    return f"SELECT '{study}' AS study, iid, fup, 'Yes' AS response, {', '.join(cells)} FROM ({SQL[f'{study}_response']}) r {joins}"


def _named(column: str, names: dict[str, str]) -> str:
    cases = " ".join(f"WHEN '{k}' THEN '{v.replace(chr(39), chr(39) * 2)}'" for k, v in names.items())
    return f"CASE {column} {cases} END"


_ATTRIBUTES = list(d.ATTRIBUTES)
_PANEL = " UNION ALL ".join(_study_panel(s) for s in _TABLES)
_LONG = f"""panel AS ({_PANEL}), long AS (SELECT study, iid, fup, unnest([{", ".join(f"'{a}'" for a in _ATTRIBUTES)}]) AS name,
  unnest([{", ".join(_ATTRIBUTES)}]) AS value FROM panel), known AS (SELECT * FROM long WHERE value IS NOT NULL)"""
_NAMES = f"{_named('study', d.STUDIES)} AS study_clean, {_named('name', d.ATTRIBUTES)} AS name_clean"


@query(
    f"WITH {_LONG} SELECT fup, {_NAMES}, value, count(*) AS n FROM known WHERE value <> 'No' GROUP BY study, name, fup, value"
)
def harmonised_counts(spark, sf):
    """Published counts per age of all four studies, from the source files to the table."""
    return published(summed(in_classes(spark, sf, lambda s: count_values_by_sweep(responder_values(s)))), "fup")


@query(
    f"""WITH {_LONG}, seen AS (SELECT DISTINCT study, iid, fup, name, value FROM known),
    ages AS (SELECT CAST(unnest(range(min(fup), max(fup) + 1)) AS INTEGER) AS age FROM seen),
    sweeps AS (SELECT DISTINCT study, fup FROM seen),
    sets AS (SELECT study, a.fup AS first, b.fup AS last FROM sweeps a JOIN sweeps b USING (study) WHERE a.fup <= b.fup),
    persons AS (SELECT study, first, last, name, value, count(DISTINCT iid) AS n FROM seen JOIN sets USING (study)
      WHERE fup BETWEEN first AND last AND value <> 'No' GROUP BY ALL),
    windows AS (SELECT l.age AS low, h.age AS high, study, min(fup) AS first, max(fup) AS last FROM sweeps
      JOIN ages l ON l.age <= fup JOIN ages h ON h.age >= fup GROUP BY ALL)
    SELECT low, high, {_NAMES}, value, n FROM windows JOIN persons USING (study, first, last)"""
)
def harmonised_windows(spark, sf):
    """Published persons per window of ages of all four studies."""
    return published(values_ever_in_window(in_classes(spark, sf, lambda s: persons_by_ages(responder_values(s)))), "low", "high")


@query(f"WITH panel AS ({_study_panel('ncds')} UNION ALL {_study_panel('bcs70')}) SELECT * EXCLUDE (gender_identity, carer) FROM panel")
def harmonised_panel(spark, sf):
    """The wide panel of ncds and bcs70 alone, in their own columns."""
    return in_classes(spark, sf, responder_table, ("ncds", "bcs70")).drop("gender_identity", "carer")


@query(_PANEL)
def harmonised_panel_all(spark, sf):
    """The wide panel of responders of all four studies, children of the millennium cohort by family and number."""
    return in_classes(spark, sf, responder_table)


_ORDER = " ".join(f"WHEN '{n}' THEN list_position([{', '.join(repr(v) for v in labels)}], value)" for n, labels in d.CATEGORIES.items())


@query(
    f"""WITH {_LONG} SELECT fup, {_NAMES}, value, count(*) AS n, CAST(CASE name {_ORDER} END AS INTEGER) AS code
    FROM known WHERE value <> 'No' GROUP BY study, name, fup, value"""
)
def published_codes(spark, sf):
    """Published counts per age with the place of each value in its attribute's order, carried from the studies' tables."""
    return published(summed(in_classes(spark, sf, lambda s: count_values_by_sweep(responder_values(s)))), "fup", code=True)


_LEVELS = ", ".join(f"('{n}', {code}, '{label}')" for n, labels in d.CATEGORIES.items() for code, label in enumerate(labels, 1))


@query(
    f"""WITH {_LONG}, levels(name, code, value) AS (VALUES {_LEVELS}),
    counted AS (SELECT name, value, count(*) AS n FROM known GROUP BY ALL)
    SELECT {_named('name', d.ATTRIBUTES)} AS name_clean, CAST(code AS INTEGER) AS code, value, coalesce(n, 0) AS n
    FROM levels LEFT JOIN counted USING (name, value)""",
    name="var_levels",
)
def levels_of_panel(spark, sf):
    """The ordered categories of all attributes under their published names, with the rows of the panel that have them."""
    return summed(in_classes(spark, sf, lambda s: var_levels(responder_values(s))))


@query(
    f"""WITH {_LONG} SELECT fup, {_NAMES}, value, count(DISTINCT iid) AS n
    FROM known WHERE value <> 'No' GROUP BY study, name, fup, value"""
)
def persons_by_sweep(spark, sf):
    """Persons and not rows per age: who has two entries of a value at an age counts once."""
    return published(summed(in_classes(spark, sf, lambda s: count_values_by_sweep(responder_values(s), distinct=True))), "fup")


@query(
    SQL["next_steps_social_class"].replace(position("w8dnssec5", _EIGHT), position("w8dnssec5", [1, 2, 3, 4, 5])),
    name="next_steps_social_class_five",
)
def five_classes(spark, sf):
    """The five-class variable of wave 8 by its own classes."""
    return next_steps.social_class(survey_files(spark, sf, "next_steps"), five_class=True)
