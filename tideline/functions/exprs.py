"""Small column helpers used by the source builders and plans."""

from __future__ import annotations

from functools import reduce
from typing import Sequence

from pyspark.sql import Column, functions as F


def safe_div(numerator: Column, denominator: Column) -> Column:
    """NULL, not an error or infinity, when the denominator is zero."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def pick_fraction(scale_when: Column, numerator: Column, denominator: Column) -> Column:
    """``numerator / denominator`` where the condition holds, 1 elsewhere."""
    return F.when(scale_when, safe_div(numerator, denominator)).otherwise(F.lit(1.0))


def pick_resource(use_host: Column, host: Column, other: Column) -> Column:
    return F.when(use_host, host).otherwise(other)


def any_null(columns: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, (F.col(c).isNull() for c in columns), F.lit(False))


def regex_group(text: Column, pattern: str) -> Column:
    """First capture group, NULL when the pattern does not match."""
    return F.nullif(F.regexp_extract(text, pattern, 1), F.lit(""))


def combined_key(columns: Sequence[str], sep: str = "_") -> Column:
    """Columns joined to one text key; NULL when any part is NULL."""
    parts: list[Column] = []
    for c in columns:
        parts += [F.lit(sep), F.col(c).cast("string")]
    return F.concat(*parts[1:])


def member(value: Column, ids: Sequence[str]) -> Column:
    """Membership flag; NULL counts as not a member."""
    return F.coalesce(value.isin(list(ids)), F.lit(False))
