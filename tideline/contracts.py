"""Stage contracts: which columns a frame must have, in which order and type."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime
from typing import Iterable, Mapping

from pyspark.sql import DataFrame, functions as F

INTERVAL = {
    "entity_id": "string",
    "start": "timestamp_ntz",
    "end": "timestamp_ntz",
    "metric": "string",
    "resource": "string",
    "value": "double",
}
TIMELINE = {
    "timestamp": "timestamp_ntz",
    "value": "double",
    "metric": "string",
    "resource": "string",
}
USAGE = {**TIMELINE, "site": "string", "collector_type": "string"}
COMPAT = {
    "time": "timestamp_ntz",
    "site": "string",
    "resource": "string",
    "total": "double",
    "reservable": "double",
    "committed": "double",
    "occupied_ondemand": "double",
    "occupied_reserved": "double",
    "active_ondemand": "double",
    "active_reserved": "double",
}


class ContractError(ValueError):
    """A frame does not have the columns or types its next stage needs."""


def conform(
    df: DataFrame,
    columns: Mapping[str, str],
    coerce: Iterable[str] = (),
    keep_extra: bool = True,
) -> DataFrame:
    """Put the declared columns first; cast those in ``coerce``, refuse other mismatches.

    Undeclared columns follow in their own order, or are dropped when
    ``keep_extra`` is false. Nullability and uniqueness are never checked.
    """
    have = dict(df.dtypes)
    missing = [c for c in columns if c not in have]
    if missing:
        raise ContractError(f"columns missing: {missing}")
    coerce = set(coerce)
    wrong = {
        c: have[c]
        for c, t in columns.items()
        if have[c] != t and have[c] != "void" and c not in coerce
    }
    if wrong:
        raise ContractError(f"unexpected types: {wrong}")
    declared = [
        F.col(c) if have[c] == t else F.col(c).cast(t).alias(c)
        for c, t in columns.items()
    ]
    extra = [c for c in df.columns if c not in columns] if keep_extra else []
    return df.select(*declared, *extra)


def as_interval(df: DataFrame) -> DataFrame:
    return conform(df, INTERVAL, coerce=("end",))


def as_timeline(df: DataFrame) -> DataFrame:
    return conform(df, TIMELINE, coerce=("value",))


def as_usage(df: DataFrame) -> DataFrame:
    return conform(df, USAGE, coerce=("value",))


def group_columns(columns: Mapping[str, str], value_columns: Iterable[str]) -> tuple[str, ...]:
    """Declared columns that are not values, sorted."""
    return tuple(sorted(set(columns) - set(value_columns)))


@dataclass(frozen=True)
class UsageSpec:
    """Group columns and ``(start, end)`` window of a usage run."""

    group_cols: tuple[str, ...]
    time_range: tuple[datetime, datetime]

    def validate_against(self, df: DataFrame) -> None:
        missing = set(self.group_cols) - set(df.columns)
        if missing:
            raise ValueError(f"group_cols not in data: {sorted(missing)}")

    def without(self, column: str) -> "UsageSpec":
        return UsageSpec(
            tuple(c for c in self.group_cols if c != column), self.time_range
        )

    @property
    def other_groups(self) -> list[str]:
        """Group columns besides the metric."""
        return [c for c in self.group_cols if c != "metric"]
