"""Recoding numeric codes onto common categories.

A recode is a list of `(codes, target)` pairs: `codes` is a list of codes or a `Span`, `target` a
number or a small arithmetic on the code. The first pair that matches wins; no match gives null.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Span:
    """All codes from `low` to `high`, ends included, fractional codes too."""

    low: float
    high: float


@dataclass(frozen=True)
class Plus:
    """The code plus a constant."""

    constant: float

    def __call__(self, code: Column) -> Column:
        return code + F.lit(self.constant)


@dataclass(frozen=True)
class Minus:
    """A constant minus the code."""

    constant: float

    def __call__(self, code: Column) -> Column:
        return F.lit(self.constant) - code


@dataclass(frozen=True)
class Tens:
    """The tens of the code plus a constant."""

    constant: float = 0

    def __call__(self, code: Column) -> Column:
        return code / F.lit(10) + F.lit(self.constant)


SAME = Plus(0)

Codes = Sequence[float] | Span
Target = float | Callable[[Column], Column]
Recode = Sequence[tuple[Codes, Target]]


def _literal(value: str | float | None) -> str:
    """SQL text of a value: one expression of many values is built faster than a literal for each."""
    if value is None:
        return "NULL"
    if isinstance(value, str):
        return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
    return str(value) if isinstance(value, int) else f"{value!r}D"


def _array(values: Sequence) -> Column:
    return F.expr(f"array({', '.join(map(_literal, values))})")


def matches(code: Column, codes: Codes) -> Column:
    if isinstance(codes, Span):
        return code.between(codes.low, codes.high)
    return F.array_contains(_array([float(c) for c in codes]), code)


def first_match(*branches: tuple[Column, Column | float]) -> Column:
    """The value of the first true condition; null conditions count as false, no match is null."""
    result = None
    for condition, value in branches:
        value = value if isinstance(value, Column) else F.lit(float(value))
        result = F.when(condition, value) if result is None else result.when(condition, value)
    return result


def recode_sources(*sources: tuple[Column, Recode]) -> Column:
    """Try the pairs of each source in turn, in the order given."""
    return first_match(
        *(
            (matches(code, codes), target(code) if callable(target) else float(target))
            for code, recode in sources
            for codes, target in recode
        )
    )


def recode(code: Column, pairs: Recode) -> Column:
    """Recode one source."""
    return recode_sources((code, pairs))


def if_else(condition: Column, yes: Column, no: Column) -> Column:
    """A null condition gives null, unlike `when().otherwise()`."""
    return F.when(condition, yes).when(~condition, no)


def position(code: Column) -> Column:
    """A 1-based position from a code; fractions are cut off, anything below 1 is no position."""
    return F.when(code >= 1, code.try_cast("int"))


def pick(values: Sequence, code: Column) -> Column:
    """The element of a fixed list at the code's position, null outside the list."""
    return F.get(_array(values), position(code) - 1)


def comb_lookup(old: Column, new: Sequence[float | None]) -> Column:
    """Recode by position: code 1 takes the first new code, code 2 the second, and so on."""
    return pick([None if v is None else float(v) for v in new], old)


def code_to_category(code: Column, labels: Sequence[str]) -> Column:
    """The label at the code's position."""
    return pick(labels, code)


def sweep_to_age(sweep: Column, ages: Sequence[int]) -> Column:
    """The age at follow-up of a sweep number."""
    return pick(ages, sweep)


def lookup(key: Column, names: Mapping[str, str]) -> Column:
    """Look a key up in a fixed dictionary, null where it has no entry."""
    return F.expr(f"map({', '.join(_literal(x) for item in names.items() for x in item)})")[key]


def code_text(code: Column) -> Column:
    """A numeric code as text, whole numbers without a decimal point."""
    return F.when(code == F.floor(code), F.floor(code).cast("string")).otherwise(code.cast("string"))
