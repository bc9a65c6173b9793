"""Left joins that say how well they matched."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tributary.operators.checks import require_unique

MATCHED = "encontrado"


def left_join(left: DataFrame, right: DataFrame, key: str, columns: list[str] | None = None, match: str | None = MATCHED) -> DataFrame:
    """All rows of left, its columns first, then `columns` of right and a 0/1 match column.

    right has one row per key (see unique_by_min); null keys never match. Spark picks the strategy: a hot key on the left
    is split by adaptive execution, a small right side is broadcast by its measured size.
    """
    columns = [c for c in (columns or right.columns) if c != key]
    side = right.select(key, *columns, F.lit(1).alias("__hit"))
    out = left.join(side, key, "left")
    hit = [F.coalesce("__hit", F.lit(0)).alias(match)] if match else []
    return out.select(*left.columns, *columns, *hit)


def checked_left_join(left: DataFrame, right: DataFrame, key: str, **kw) -> DataFrame:
    """left_join after a check that right has one row per key."""
    return left_join(left, require_unique(right.where(F.col(key).isNotNull()), key), key, **kw)


def unique_by_min(df: DataFrame, key: str, columns: list[str], width: int | None = 8) -> DataFrame:
    """One row per valid key; of each column on its own the least value that isn't null."""
    rows = df.where(F.length(key) == width) if width else df.where(F.col(key).isNotNull())
    return rows.groupBy(key).agg(*(F.min(c).alias(c) for c in columns))


def join_audit(joined: DataFrame, rows_in: int | None = None, match: str = MATCHED) -> DataFrame:
    """One row: output rows, matched, unmatched, match rate, and whether rows_in rows are still that many."""
    hit = F.col(match)
    out = joined.agg(
        F.count(F.lit(1)).alias("linhas"), F.coalesce(F.sum(hit), F.lit(0)).cast("long").alias("encontradas"), F.coalesce(F.sum(1 - hit), F.lit(0)).cast("long").alias("nao_encontradas"), F.avg(hit).alias("taxa_encontro")
    )
    return out if rows_in is None else out.withColumn("cardinalidade_preservada", F.col("linhas") == rows_in)
