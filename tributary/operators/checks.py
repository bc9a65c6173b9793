"""Guards before work starts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def missing_columns(df: DataFrame, required) -> list[str]:
    return sorted(set(required) - set(df.columns))


def require_columns(df: DataFrame, required) -> DataFrame:
    if gone := missing_columns(df, required):
        raise ValueError(f"missing columns: {', '.join(gone)}")
    return df


def require_rows(df: DataFrame, what: str = "input") -> DataFrame:
    if df.isEmpty():
        raise ValueError(f"{what} has no rows")
    return df


def require_unique(df: DataFrame, *keys: str) -> DataFrame:
    """Fails on keys that repeat; one aggregation."""
    twice = df.groupBy(*keys).count().where("count > 1").limit(1).collect()
    if twice:
        raise ValueError(f"{keys} repeat, as in {twice[0].asDict()}")
    return df


def require_both_classes(df: DataFrame, target: str) -> DataFrame:
    found = {r[0] for r in df.select(F.col(target).cast("int")).where(F.col(target).isNotNull()).distinct().limit(3).collect()}
    if found != {0, 1}:
        raise ValueError(f"{target} must have both classes 0 and 1, has {sorted(found)}")
    return df


def check_fraction(value: float, name: str, open_top: bool = True) -> None:
    if not (0 < value < 1 or (not open_top and value == 1)):
        raise ValueError(f"{name} must be between 0 and 1")


def check_at_least(value: float, least: float, name: str) -> None:
    if value < least:
        raise ValueError(f"{name} must be {least} or more")
