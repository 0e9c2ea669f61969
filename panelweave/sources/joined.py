"""The files of a study read once and stored by person, so that all rules read one table."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelweave.functions.names import select_matches, strip_suffix
from panelweave.operators.combine import side_by_side
from panelweave.operators.reshape import common_type
from panelweave.sources.files import SurveyFiles, Variable, chop
from panelweave.sources.store import store, store_bucketed

Rule = Callable[[SurveyFiles], object]


def reads(times: int) -> Callable[[Rule], Rule]:
    """Says of a rule how often it asks for files; a rule without this asks once."""

    def mark(rule: Rule) -> Rule:
        rule.reads = times
        return rule

    return mark


class _Enough(Exception):
    """A rule has asked for all that it reads."""


class _Wanted(SurveyFiles):
    """Notes which variables rules ask for, on files without rows, and stops each rule at its last request."""

    def __init__(self, spark: SparkSession, files: SurveyFiles):
        self.empty: dict[str, DataFrame] = {}

        def read(path: str) -> DataFrame:
            if path not in self.empty:
                self.empty[path] = spark.createDataFrame([], files.open(path).schema)
            return self.empty[path]

        super().__init__(files.variables, read, files.labels)
        self.found: dict[str, set[str]] = {}
        self.left = 0

    def run(self, rules: Sequence[Rule]) -> dict[str, list[str]]:
        """File to its wanted variables, both in catalogue order."""
        for rule in rules:
            self.left = getattr(rule, "reads", 1)
            try:
                rule(self)
            except _Enough:
                pass
        return {p: [n for n in names if n in self.found[p]] for p, names in chop(self.variables).items() if p in self.found}

    def _ask(self, path_names: dict[str, list[str]], ids: str) -> None:
        for path, names in path_names.items():
            self.found.setdefault(path, set()).update(wanted_names(self, path, ids, names))
        self.left -= 1
        if not self.left:
            raise _Enough

    def load(self, path: str, ids: str, variables: Sequence[str] | None = None, row: bool = False) -> DataFrame:
        known = [v.variable for v in self.variables if v.file_path == path]
        self._ask({path: known if variables is None else [n for n in known if n in variables]}, ids)
        return super().load(path, ids, variables, row)

    def load_joined(self, found: Sequence[Variable], iid: str) -> DataFrame:
        self._ask(chop(found), f"^{iid}$")
        frames = [super(_Wanted, self).load(path, f"^{iid}$", names) for path, names in chop(found).items()]
        return reduce(lambda a, b: a.join(b, a.columns[0]), frames)

    def load_stacked(self, found: Sequence[Variable], ids: str, iid: str, suffix: str | None = None, per_variable: bool = False) -> DataFrame:
        self._ask(chop(found), ids)
        left, self.left = self.left, -1  # its parts are no requests of the rule
        out = super().load_stacked(found, ids, iid, suffix, per_variable)
        self.left = left
        return out


class JoinedFiles(SurveyFiles):
    """Person files whose variables stand side by side in one stored table, one row per person.

    The persons of all files and how often each file has them are stored first, in buckets of persons. A file in which no person
    occurs twice is then merged onto them bucket by bucket: its rows cross a shuffle only where the file is not in
    these buckets itself, and what rules do by person needs no other shuffle. A file in which a person occurs
    twice (a household grid), or with rows of no person, is read from the file itself whenever a rule asks for it, so no row is lost.
    """

    by_person = True

    def __init__(self, files: SurveyFiles, iid: str, wanted: dict[str, list[str]]):
        super().__init__(files.variables, files.open, files.labels)
        self.iid = iid.lower()
        self.columns: dict[tuple[str, str], str] = {}
        self.counts: dict[str, str] = {path: f"n{k}" for k, path in enumerate(wanted)}
        parts = [files.load(path, f"^{iid}$", []).selectExpr(f"`{self.iid}` AS key", f"1L AS {n}") for path, n in self.counts.items()]
        sums = [F.sum(n).alias(n) for n in self.counts.values()]
        frame, _ = store_bucketed(side_by_side(parts).groupBy("key").agg(*sums), "persons", ["key"], ["key"], dealt=True)
        most = frame.agg(*[F.max(F.when(F.col("key").isNotNull(), F.col(n)).when(F.col(n) > 0, 2)).alias(n) for n in self.counts.values()]).first()
        self.single = {path for path, n in self.counts.items() if (most[n] or 0) <= 1}
        joined = frame
        for path, n in self.counts.items():
            if path in self.single:
                own = [v for v in wanted[path] if v.lower() != self.iid]
                self.columns |= {(path, v): f"c{n}_{j}" for j, v in enumerate(own)}
                cells = [f"`{v.lower()}` AS {self.columns[path, v]}" for v in own]
                rows = files.load(path, f"^{iid}$", own).selectExpr(f"`{self.iid}` AS key", *cells)
                joined = joined.join(rows, "key", "left") if own else joined
        self.table, _ = store_bucketed(joined, "persons", ["key"], ["key"], dealt=True)

    def _has(self, path: str, names: Sequence[str]) -> bool:
        return path in self.single and all((path, n) in self.columns or n.lower() == self.iid for n in names)

    def _cells(self, path: str, names: Sequence[str]) -> list[str]:
        return [f"{'key' if n.lower() == self.iid else self.columns[path, n]} AS `{n.lower()}`" for n in names]

    def load(self, path: str, ids: str, variables: Sequence[str] | None = None, row: bool = False) -> DataFrame:
        names = wanted_names(self, path, ids, variables)
        if row or not self._has(path, names):
            return super().load(path, ids, variables, row)
        return self.table.where(f"{self.counts[path]} > 0").selectExpr(*self._cells(path, names))

    def load_joined(self, found: Sequence[Variable], iid: str) -> DataFrame:
        files = chop(found)
        names = [v.var_low for v in found]
        known = iid.lower() == self.iid and all(self._has(path, vs) for path, vs in files.items())
        if not known or len(set(names)) < len(names):
            return super().load_joined(found, iid)
        present = " OR ".join(f"{self.counts[path]} > 0" for path in files)
        cells = [c for path, vs in files.items() for c in self._cells(path, vs)]
        return self.table.where(present).selectExpr(f"key AS `{self.iid}`", *cells)


class StackedFiles(SurveyFiles):
    """Files of several keys and repeated rows (families, their children and parents) in one stored table.

    Every file is read once, and its rows are stored as they are with the file's number: no row meets another, so
    a family or a child with any number of rows is no group. Rules read the rows of their files, which the
    stored parts' statistics leave out otherwise, and stack them in one pass. Without `copied`, no copy is stored: rules
    stack the columns that they need of their files, for files whose rows cost less to read again than to write.
    """

    def __init__(self, files: SurveyFiles, iid: str, wanted: dict[str, list[str]], copied: bool = True):
        super().__init__(files.variables, files.open, files.labels)
        self.iid = iid.lower()
        self.columns: dict[tuple[str, str], str] = {}
        self.place = {path: k for k, path in enumerate(wanted)}
        self.by_person = not copied
        parts = []
        for k, (path, names) in enumerate(wanted.items()):
            df = files.open(path)
            self.columns |= {(path, n): f"c{k}_{j}" for j, n in enumerate(names)}
            row = ["_row"] if "_row" in df.columns else []
            parts.append(df.selectExpr(f"CAST({k} AS INT) AS file", *row, *[f"`{n}` AS {self.columns[path, n]}" for n in names]))
        self.parts = None if copied else dict(zip(wanted, parts, strict=True))
        self.table = store(side_by_side(parts), "families") if copied else side_by_side(parts)

    def _rows(self, paths: Sequence[str]) -> DataFrame:
        """The rows of some files."""
        if self.parts is None:
            return self.table.where(f"file IN ({', '.join(str(self.place[p]) for p in paths)})")
        return side_by_side([self.parts[p] for p in paths])

    def load(self, path: str, ids: str, variables: Sequence[str] | None = None, row: bool = False) -> DataFrame:
        names = wanted_names(self, path, ids, variables)
        if not all((path, n) in self.columns for n in names):
            return super().load(path, ids, variables, row)
        cells = [f"{self.columns[path, n]} AS `{n.lower()}`" for n in names]
        return self._rows([path]).selectExpr(*cells, *(["_row"] if row else []))

    def load_stacked(self, found: Sequence[Variable], ids: str, iid: str, suffix: str | None = None, per_variable: bool = False) -> DataFrame:
        parts = [(v.file_path, [v.variable]) for v in found] if per_variable else list(chop(found).items())
        wanted = [(path, wanted_names(self, path, ids, names)) for path, names in parts]
        if not parts or not all((path, n) in self.columns for path, names in wanted for n in names):
            return super().load_stacked(found, ids, iid, suffix, per_variable)
        rows: list[tuple[str, int, str, dict[str, str]]] = []  # file, its place among those found, sweep, stems
        for ordinal, (path, names) in enumerate(wanted):
            sweeps: dict[str, dict[str, str]] = {}
            for name in names:
                low = name.lower()
                if low != self.iid:
                    low = strip_suffix([low], suffix).get(low, low) if suffix else low
                    sweeps.setdefault(low[0], {})[low[1:]] = self.columns[path, name]
            rows += [(path, ordinal, sweep, stems) for sweep, stems in sweeps.items()]
        stems = list(dict.fromkeys(stem for *_, own in rows for stem in own))
        types = {s: common_type(self.table, [own[s] for *_, own in rows if s in own]).simpleString() for s in stems}
        branches: dict[str, list[str]] = {}
        keys: dict[str, str] = {}
        for path, ordinal, sweep, own in rows:
            keys[path] = next(self.columns[path, n] for n in wanted[ordinal][1] if n.lower() == self.iid)
            values = ", ".join(f"'{s}', CAST({own.get(s, 'NULL')} AS {types[s]})" for s in stems)
            branches.setdefault(path, []).append(f"named_struct('_row', _row, 'sweep', '{sweep}', {values}, '_file', {ordinal})")
        if self.parts is not None:  # file by file, so that rows stored by person stay so
            return side_by_side([self.parts[path].selectExpr(f"{keys[path]} AS `{iid}`", f"inline(array({', '.join(structs)}))") for path, structs in branches.items()])
        key = " ".join(f"WHEN {self.place[path]} THEN {column}" for path, column in keys.items())
        cases = " ".join(f"WHEN {self.place[path]} THEN array({', '.join(structs)})" for path, structs in branches.items())
        return self._rows(list(branches)).selectExpr(f"CASE file {key} END AS `{iid}`", f"inline(CASE file {cases} END)")


def wanted_names(files: SurveyFiles, path: str, ids: str, variables: Sequence[str] | None = None) -> list[str]:
    """The names that `load` reads: those matching `ids`, then the wanted ones, or all."""
    known = [v.variable for v in files.variables if v.file_path == path]
    keys = select_matches(known, ids)
    return keys + [n for n in known if n not in keys and (variables is None or n in variables)]


def wanted_by(spark: SparkSession, files: SurveyFiles, rules: Sequence[Rule]) -> dict[str, list[str]]:
    """File to the variables that the rules read."""
    return _Wanted(spark, files).run(rules)


def one_class(files: SurveyFiles, iid: str, which: int, of: int) -> SurveyFiles:
    """The rows of one class of persons in every file: each person, and the rows without one, are in one class whole."""
    if of == 1:
        return files
    names = {v.file_path: v.variable for v in files.variables if v.var_low == iid.lower()}

    def read(path: str) -> DataFrame:
        return files.open(path).where(F.pmod(F.xxhash64(F.col(f"`{names[path]}`")), F.lit(of)) == which)

    return SurveyFiles(files.variables, read, files.labels)


def joined_once(
    spark: SparkSession, files: SurveyFiles, iid: str, rules: Sequence[Rule], wanted: dict[str, list[str]] | None = None
) -> SurveyFiles:
    """Person files with everything that the rules ask for stored by person."""
    wanted = wanted_by(spark, files, rules) if wanted is None else wanted
    return JoinedFiles(files, iid, wanted) if wanted else files


def stacked_once(
    spark: SparkSession, files: SurveyFiles, iid: str, rules: Sequence[Rule], wanted: dict[str, list[str]] | None = None, copied: bool = True
) -> SurveyFiles:
    """Files of any keys with everything that the rules ask for stored as it is, or not copied."""
    wanted = wanted_by(spark, files, rules) if wanted is None else wanted
    return StackedFiles(files, iid, wanted, copied) if wanted else files
