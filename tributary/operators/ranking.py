"""Ranks, top lists and top fractions over whole tables."""

from __future__ import annotations

from math import ceil

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tributary.operators.checks import check_at_least, check_fraction
from tributary.operators.running import running

BUCKETS = 200


def score_buckets(df: DataFrame, score: str, buckets: int = BUCKETS) -> DataFrame:
    """df with __bucket: rows of a higher score never have a lower number. The cuts are approximate quantiles."""
    cuts = df.agg(F.percentile_approx(F.col(score).cast("double"), [i / buckets for i in range(1, buckets)], 10_000)).first()[0]
    cuts = sorted(set(cuts or []))
    number = F.size(F.filter(F.array(*map(F.lit, cuts)), lambda c: c <= F.col(score))) if cuts else F.lit(0)
    return df.withColumn("__bucket", number)


def ranked(df: DataFrame, score: str, key: str) -> DataFrame:
    """df with `posicao`: 1 for the best score, ties by key. Rows without a score are left out; an own column `posicao` is an
    error.

    Tasks get ranges of score and key together, so that a score which very many rows share is split by key.
    """
    return running(df.where(F.col(score).isNotNull()), [F.desc(score), F.col(key).asc()], {}, "ranked", "posicao")


def top_n(df: DataFrame, score: str, key: str, n: int = 100) -> DataFrame:
    """The n best scores with their place; ties by key."""
    check_at_least(n, 1, "n")
    best = df.orderBy(F.desc_nulls_last(score), key).limit(n)
    return best.withColumn("posicao", F.row_number().over(Window.orderBy(F.desc_nulls_last(score), key)))  # n rows


def top_fraction(df: DataFrame, score: str, key: str, fraction: float = 0.1) -> DataFrame:
    """The max(1, ceil(n * fraction)) best rows."""
    check_fraction(fraction, "fraction", open_top=False)
    n = df.where(F.col(score).isNotNull()).count()
    return ranked(df, score, key).where(F.col("posicao") <= max(1, ceil(n * fraction)))


def first_rows(df: DataFrame, order: list, n: int = 30) -> DataFrame:
    return df.orderBy(*order).limit(n)


def model_ranking(comparison: DataFrame) -> DataFrame:
    """Best average precision first, then best area under the curve."""
    by = [F.desc("average_precision"), F.desc("roc_auc"), F.col("modelo")]
    return comparison.withColumn("posicao", F.row_number().over(Window.orderBy(*by)))  # a row per model
