"""Reading sweeps, stems and suffixes out of variable names, as columns and for schemas."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def str_sub(text: Column, start: int, end: int) -> Column:
    """Characters `start` to `end`, both included and 1-based; a negative end counts from the right."""
    if end >= 0:
        return F.substring(text, start, max(end - start + 1, 0))
    length = F.char_length(text) + F.lit(end + 2 - start)
    return F.substring(text, F.lit(start), F.greatest(length, F.lit(0)))


def first_digit(text: Column) -> Column:
    """The first digit of a text, null if it has none."""
    return F.nullif(F.regexp_extract(text, r"\d", 0), F.lit("")).try_cast("int")


def to_int(value: Column) -> Column:
    """Integer value of a text or number, null where there is none."""
    return value.try_cast("int")


def letter_ordinal(letter: Column) -> Column:
    """a is 1, b is 2, ...; null for anything but one lower-case letter."""
    return F.when(letter.rlike("^[a-z]$"), F.ascii(letter) - 96)


def remove_first(text: Column, pattern: str) -> Column:
    """Remove the first match of a pattern, which may have groups and stand on any line."""
    match = F.regexp_substr(text, F.lit(pattern))
    at = F.regexp_instr(text, F.lit(pattern))
    after = F.substring(text, at + F.char_length(match), F.char_length(text))
    return F.when(match.isNull(), text).otherwise(F.concat(F.substring(text, F.lit(1), at - 1), after))


def select_matches(names: Iterable[str], pattern: str) -> list[str]:
    """Column names that contain the pattern, case ignored."""
    return [n for n in names if re.search(pattern, n, re.IGNORECASE)]


def rename_var(name: str, prefix: str) -> str:
    """`prefix_<first digit of the name>`."""
    digit = re.search(r"\d", name)
    return f"{prefix}_{digit.group() if digit else 'NA'}"


def strip_suffix(names: Iterable[str], pattern: str) -> dict[str, str]:
    """Old name to new name, for the names whose pattern match is removed."""
    return {n: re.sub(pattern, "", n, count=1) for n in names if re.search(pattern, n)}


def fresh(name: str, taken: Iterable[str]) -> str:
    """The name, with underscores after it until it is none of those taken."""
    used = {t.lower() for t in taken}
    while name.lower() in used:
        name += "_"
    return name
