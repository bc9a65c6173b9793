"""Projections and row filters."""

from __future__ import annotations

import re
import unicodedata

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tributary.functions.text import digits, is_legal_entity
from tributary.operators.checks import require_columns


def slug(name: str) -> str:
    flat = unicodedata.normalize("NFKD", str(name)).encode("ascii", "ignore").decode().lower()
    return re.sub("[^a-z0-9]+", "_", flat).strip("_")


def slug_columns(df: DataFrame) -> DataFrame:
    """Names in lower case ASCII with underscores; empty or repeated ones are errors."""
    names = [slug(c) for c in df.columns]
    if "" in names:
        raise ValueError("a column has no usable name")
    if twice := sorted({n for n in names if names.count(n) > 1}):
        raise ValueError(f"column names repeat: {', '.join(twice)}")
    return df.toDF(*names)


def with_constants(df: DataFrame, **columns) -> DataFrame:
    """Adds lineage columns; they replace columns of the same name."""
    return df.withColumns({k: v if not isinstance(v, str | int | float) else F.lit(v) for k, v in columns.items()})


def unify(frames: list[DataFrame], order: list[str] | None = None) -> DataFrame:
    """Union by name; columns in the order they are first seen, absent ones null."""
    if not frames:
        raise ValueError("nothing to unite")
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out.select(*(order or list(dict.fromkeys(c for f in frames for c in f.columns))))


def typed(df: DataFrame, types: dict[str, str], default: str = "string") -> DataFrame:
    """Every column in the type of its name; what doesn't fit becomes null."""
    return df.select(*(F.col(c).try_cast(types.get(c, default)).alias(c) for c in df.columns))


def pick(df: DataFrame, columns: list[str], optional: list[str] = ()) -> DataFrame:
    """The columns, and of the optional ones those there are."""
    require_columns(df, columns)
    return df.select(*columns, *(c for c in optional if c in df.columns))


def legal_entities(df: DataFrame, kind: str = "tipo_pessoa") -> DataFrame:
    return df.where(is_legal_entity(F.col(kind)))


def root_length_filter(df: DataFrame, key: str, width: int = 8) -> DataFrame:
    return df.where(F.length(digits(F.col(key))).between(1, width))


def not_null(df: DataFrame, *columns: str) -> DataFrame:
    return df.dropna(subset=list(columns))
