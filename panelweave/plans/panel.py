"""The person x sweep panel: wide, restricted to responders, and long."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelweave.operators.combine import side_by_side, stack_tagged
from panelweave.operators.joins import natural_full_join_all, right_join
from panelweave.operators.levels import levels_of, value_with_levels, with_levels
from panelweave.operators.reshape import deal_copies, spread_over, unpivot
from panelweave.plans.common import Study
from panelweave.plans.dictionaries import AGES, ATTRIBUTES, CATEGORIES
from panelweave.sources.store import store_bucketed

PANEL_KEYS = ["study", "iid", "fup"]
PERSON = ["study", "pid", "cnum"]
CHILDREN = [1, 2]


def person_sweeps(study: Study) -> DataFrame:
    """Every sample member at every age of the study."""
    return spread_over(study.sample, AGES[study.name], "fup")


def panel_wide(study: Study) -> DataFrame:
    """All attributes by person and age; rows of persons outside the sample have no `iid`."""
    wide = natural_full_join_all(person_sweeps(study), list(study.clean.values()))
    return wide.drop(*study.keys)


def stack_studies(studies: Sequence[Study]) -> dict[str, DataFrame]:
    """The sample, wide and response tables of all studies."""
    return {
        "sample": stack_tagged({s.name: s.sample.select("iid") for s in studies}, "study"),
        "wide": stack_tagged({s.name: panel_wide(s) for s in studies}, "study"),
        "response": stack_tagged({s.name: s.response.select("iid", "fup") for s in studies}, "study"),
    }


def responder_panel(wide: DataFrame, response: DataFrame) -> DataFrame:
    """The wide panel at the ages a person responded, responders without data included."""
    joined = right_join(wide.filter("iid IS NOT NULL"), response.select(*PANEL_KEYS), PANEL_KEYS)
    return joined.withColumn("response", F.lit("Yes"))


def long_panel(panel: DataFrame) -> DataFrame:
    """One row per person, age and known attribute."""
    return unpivot(panel, PANEL_KEYS).na.drop()


def responder_values(studies: Sequence[Study]) -> DataFrame:
    """The values of each responder straight from the attribute tables, without the wide panel.

    One row per person, attribute and value; `n0`, `n1`, ... say for each sweep of the study how many
    rows the responder panel has for the value there. That is one, unless a person has several
    entries in a table at an age: then each of them is combined with each entry of every other
    table. Equal entries are counted first, and only entries at sweeps with a response are kept.
    """
    sweeps = range(max(len(AGES[s.name]) for s in studies))
    kinds = list(dict.fromkeys((t, *_attributes(df)) for s in studies for t, df in _tables(s).items()))
    most = max(len(names) for _, *names in kinds)
    frames = []
    for study in studies:
        for table, df in _tables(study).items():
            kind = kinds.index((table, *_attributes(df)))
            cells = [f"`{n}`" for n in kinds[kind][1:]]
            parts = ", ".join(f"named_struct('i', {i}, 'value', CAST({c} AS STRING))" for i, c in enumerate(cells))
            values = ["0 AS i", f"CAST({cells[0]} AS STRING) AS value"] if len(cells) == 1 else [f"inline(array({parts}))"]
            frames.append((study, df, [f"{kind} AS table", *values]))
    # Equal entries of a table in one row: their number at each sweep.
    times = [F.sum(F.shiftright("at", j).bitwiseAND(1)).alias(f"n{j}") for j in sweeps]
    counted = _at_answered(frames).groupBy(*PERSON, "table", "i", "value").agg(*times)
    names = F.array(*[F.lit(kind[i + 1] if i + 1 < len(kind) else None).cast("string") for kind in kinds for i in range(most)])
    name = F.get(names, F.col("table") * most + F.col("i")).alias("name")
    found = _with_sizes(counted, len(sweeps)).where("value IS NOT NULL")
    rows = [_combined(f"n{j}", j).alias(f"n{j}") for j in sweeps]
    return value_with_levels(found.select("study", _iid(studies), name, "value", *rows), study_levels(studies))


def _with_sizes(counted: DataFrame, sweeps: int) -> DataFrame:
    """Adds `sizes`: the tables with several entries of the person at a sweep, with their numbers of entries at each sweep.

    Rows of a second attribute of a table repeat its entries and are left out.
    """
    in_table = Window.partitionBy(*PERSON, "table")
    sums = {f"size{j}": F.sum(F.when(F.col("i") == 0, F.col(f"n{j}"))).over(in_table) for j in range(sweeps)}
    large = reduce(Column.__or__, [F.col(f"size{j}") > 1 for j in range(sweeps)])
    size = F.when(large & (F.col("i") == 0), F.struct("table", F.array(*[f"size{j}" for j in range(sweeps)]).alias("n")))
    return counted.withColumns(sums).withColumn("sizes", F.collect_set(size).over(Window.partitionBy(*PERSON)))


def _combined(n: str, sweep: int) -> Column:
    """Rows of the panel that have the `n` entries of a value: each is combined with each entry of every other table there."""
    others = F.transform("sizes", lambda s: F.when(s["table"] == F.col("table"), F.lit(1).cast("long")).otherwise(F.greatest(F.get(s["n"], F.lit(sweep)), F.lit(1))))
    return F.when((F.size("sizes") == 0) | (F.col(n) == 0), F.col(n)).otherwise(_times(F.concat(F.array(n), others)))


def study_levels(studies: Sequence[Study]) -> dict[str, list[str]]:
    """The order of the categories of every attribute, as the studies' tables carry it."""
    return {"response": CATEGORIES["response"], **levels_of(*[df for s in studies for df in s.clean.values()])}


def responder_table(studies: Sequence[Study]) -> DataFrame:
    """The wide panel of responders by aggregation alone: person keys, `response` and one column per attribute.

    Equal entries of a table are counted first, so a person has few rows however many
    entries there are. The different entries of a table at an age are numbered; a panel row is a number in
    the mixed base of these counts, and an entry stands in every row whose digit for its table is the
    entry's number. One aggregation by person, age and row then puts the entries side by side, and equal
    rows are dealt out as copies. Where every table has one entry, as nearly everywhere, that is one row.
    """
    names = [name for name in ATTRIBUTES if name != "response"]
    tables = list(dict.fromkeys(t for s in studies for t in [*s.clean, "response"]))
    columns = {t: [n for n in names if any(n in s.clean[t].columns for s in studies if t in s.clean)] for t in tables}
    most = max(len(own) for own in columns.values())
    here = [*PERSON, "sweep"]
    frames = []
    for study in studies:
        for table, df in {**study.clean, "response": study.response}.items():
            own = [n if n in df.columns else "NULL" for n in columns[table]] + ["NULL"] * (most - len(columns[table]))
            cells = [f"CAST({n} AS STRING) AS v{i}" for i, n in enumerate(own)]
            frames.append((study, df, [f"{tables.index(table)} AS table", *cells]))
    cells = [f"v{i}" for i in range(most)]
    last = max(len(AGES[study.name]) for study in studies) - 1
    at = F.expr(f"explode(filter(sequence(0, {last}), x -> getbit(at, x) = 1))").alias("sweep")
    place = {n: (tables.index(t), f"v{own.index(n)}") for t, own in columns.items() for n in own}
    side = [F.max(F.expr(f"CASE WHEN table = {place[n][0]} THEN {place[n][1]} END") if n in place else F.lit(None).cast("string")).alias(n) for n in names]
    counted = _at_answered(frames).groupBy(*PERSON, "at", "table", *cells).agg(F.count("*").alias("times"))
    wide = _combinations(counted.select(*PERSON, at, "table", *cells, "times"), cells, side, len(tables))
    age = F.get(sweep_ages(), F.col("sweep")).alias("fup")
    panel = wide.select("study", _iid(studies), age, F.lit("Yes").alias("response"), *names, "copies")
    return with_levels(deal_copies(panel, "copies"), study_levels(studies))


def _combinations(counted: DataFrame, cells: Sequence[str], side: Sequence[Column], tables: int) -> DataFrame:
    """Each entry of a person's table at a sweep beside each entry of every other table there; equal rows are one with their number in `copies`."""
    here = [*PERSON, "sweep"]
    entries = _with_factors(counted, F.count("*"), cells)
    # The sizes of the tables before a table's own are its place value.
    before = F.filter("factors", lambda f: f["table"] < F.col("table"))
    alone = F.size("factors") == 0
    one = F.lit(1).cast("long")
    entries = entries.withColumns(
        {
            "total": F.when(alone, one).otherwise(_times(F.transform("factors", lambda f: f["n"]))),
            "place": F.when(alone, one).otherwise(_times(F.transform(before, lambda f: f["n"]))),
        }
    )
    # The rows of an entry: any number above its digit, any below.
    low = F.expr("sequence(0L, place - 1)")
    high = F.expr("sequence(0L, total div (place * entries) - 1)")
    placed = entries.withColumn("high", F.explode(high)).withColumn("low", F.explode(low))
    placed = placed.withColumn("row", F.expr("(high * entries + digit) * place + low"))
    times = [F.max(F.expr(f"CASE WHEN table = {k} THEN times END")).alias(f"times{k}") for k in range(tables)]
    wide = placed.groupBy(*here, "row").agg(*side, *times)
    return wide.withColumn("copies", _times(F.array(*[F.coalesce(f"times{k}", F.lit(1)) for k in range(tables)])))


def _attributes(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c not in ("pid", "cnum", "iid", "fup")]


def _tables(study: Study) -> dict[str, DataFrame]:
    """All tables of a study, the response as an attribute among them."""
    return {**study.clean, "response": study.response.withColumn("response", F.lit("Yes"))}


def _by_sweep(study: Study, df: DataFrame) -> DataFrame:
    """The rows of persons, the age as the sweep's place in the calendar.

    A table without ages holds for every sweep, one without children for all children.
    """
    calendar = ", ".join(map(str, AGES[study.name]))
    if len(study.keys) > 1:
        if "cnum" not in df.columns:
            df = spread_over(df, study.children or CHILDREN, "cnum")
        elif study.children:
            df = df.where(F.col("cnum").isin(list(study.children)))
    sweep = f"CAST(array_position(array({calendar}), fup) - 1 AS INT)" if "fup" in df.columns else str(EVERY_SWEEP)
    df = df.where(f"fup IN ({calendar})") if "fup" in df.columns else df
    return df.where(" AND ".join(f"{k} IS NOT NULL" for k in study.keys)).withColumn("sweep", F.expr(sweep))


def _answered(study: Study) -> DataFrame:
    """Each respondent once, the sweeps with a response as bits; stored in buckets of persons."""
    bits = F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.col("sweep"))).alias("answered")
    found = _by_sweep(study, study.response).groupBy(*study.keys).agg(bits)
    return store_bucketed(found, "answered", study.keys[:1], study.keys, dealt=True)[0]


def _at_answered(frames: Sequence[tuple[Study, DataFrame, list[str]]]) -> DataFrame:
    """Entries of tables at the sweeps at which their person responded, which are the bits of `at`.

    Each table comes with its study and its number and cells as SQL. All tables of a study meet the respondents by person
    at once, so a task holds the respondents of a bucket once, and all that follows by person needs no other shuffle.
    """
    parts = []
    for study in {id(s): s for s, *_ in frames}.values():
        person = ["CAST(pid AS STRING) AS pid", *(["CAST(cnum AS INT) AS cnum"] if len(study.keys) > 1 else [])]
        mine = [_by_sweep(study, df).selectExpr(*person, "sweep", *own) for s, df, own in frames if s is study]
        met = side_by_side(mine).join(_answered(study).selectExpr(*person, "answered").hint("shuffle_hash"), list(study.keys))
        at = f"CASE WHEN sweep = {EVERY_SWEEP} THEN answered ELSE answered & shiftleft(1L, greatest(sweep, 0)) END"
        cells = [c for c in met.columns if c not in ("pid", "cnum", "sweep", "answered")]
        cnum = "cnum" if len(study.keys) > 1 else "CAST(0 AS INT) AS cnum"
        parts.append(met.withColumn("at", F.expr(at)).where("at <> 0").selectExpr(f"'{study.name}' AS study", "pid", cnum, "at", *cells))
    return side_by_side(parts)


def _iid(studies: Sequence[Study]) -> Column:
    """The panel's person id from the keys of a person."""
    with_children = [s.name for s in studies if len(s.keys) > 1]
    return F.when(F.col("study").isin(with_children), F.concat_ws("_", "pid", "cnum")).otherwise(F.col("pid")).alias("iid")


def _with_factors(entries: DataFrame, size: Column, cells: Sequence[str]) -> DataFrame:
    """Adds `digit`, the number of an entry in its table at the sweep; `entries`, that table's size; and `factors`, the
    (table, n) of all tables there whose size is not 1, as few are."""
    in_table = Window.partitionBy(*PERSON, "sweep", "table")
    entries = entries.withColumns({"digit": F.row_number().over(in_table.orderBy(*cells)) - 1, "entries": size.over(in_table)})
    factor = F.expr("CASE WHEN digit = 0 AND entries > 1 THEN named_struct('table', table, 'n', entries) END")
    return entries.withColumn("factors", F.collect_list(factor).over(Window.partitionBy(*PERSON, "sweep")))


def _times(factors: Column) -> Column:
    """Product of one whole number per table; beyond the range of bigint the query fails, never rounds."""
    product = F.aggregate(factors, F.lit(1).cast("long"), lambda a, b: F.try_multiply(a, b))
    return F.coalesce(product, F.raise_error(F.lit("more rows than bigint holds")).cast("long"))


EVERY_SWEEP = -1


def sweep_ages() -> Column:
    """The ages of the row's study."""
    pairs = [x for study, ages in AGES.items() for x in (F.lit(study), F.array(*[F.lit(a) for a in ages]))]
    return F.create_map(*pairs)[F.col("study")]
