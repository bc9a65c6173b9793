"""Exact ranking metrics, computed on counts per distinct score."""

from __future__ import annotations

from math import ceil

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tributary.operators.checks import check_fraction
from tributary.operators.ranking import ranked, score_buckets


def _curve(df: DataFrame, score: str, target: str) -> DataFrame:
    """Per distinct score: positives and negatives, and those of all higher scores (`tp`, `fp`)."""
    counts = df.where(F.col(score).isNotNull() & F.col(target).isNotNull()).groupBy(F.col(score).alias("s")).agg(F.sum(F.col(target).cast("long")).alias("pos"), F.sum(1 - F.col(target).cast("long")).alias("neg"))
    rows = score_buckets(counts, "s")
    totals = rows.groupBy("__bucket").agg(F.sum("pos").alias("p"), F.sum("neg").alias("n"))
    above = Window.orderBy(F.desc("__bucket")).rowsBetween(Window.unboundedPreceding, -1)  # a row per bucket
    totals = totals.select("__bucket", *(F.coalesce(F.sum(c).over(above), F.lit(0)).alias(f"{c}_off") for c in "pn"))
    inside = Window.partitionBy("__bucket").orderBy(F.desc("s")).rowsBetween(Window.unboundedPreceding, -1)
    before = lambda c: F.coalesce(F.sum(c).over(inside), F.lit(0))
    return rows.join(F.broadcast(totals), "__bucket").select("s", "pos", "neg", (before("pos") + F.col("p_off")).alias("tp"), (before("neg") + F.col("n_off")).alias("fp"))


def ranking_metrics(df: DataFrame, score: str, target: str) -> DataFrame:
    """One row: n, positives, prevalence, roc_auc (ties count half), average_precision (steps), brier."""
    curve = _curve(df, score, target)
    p, n = (F.coalesce(F.sum(c), F.lit(0)) for c in ("pos", "neg"))
    sums = curve.agg(
        p.alias("p"), n.alias("n"), F.sum(F.col("neg") * (F.col("tp") + F.col("pos") / 2)).alias("wins"),
        F.sum(F.col("pos") * (F.col("tp") + F.col("pos")) / (F.col("tp") + F.col("pos") + F.col("fp") + F.col("neg"))).alias("steps"),
        F.sum(F.col("pos") * F.pow(F.col("s") - 1, 2) + F.col("neg") * F.pow("s", 2)).alias("errors"),
    )
    rows = F.col("p") + F.col("n")
    return sums.select(rows.alias("n"), F.col("p").alias("positivos"), F.try_divide("p", rows).alias("prevalencia"), F.try_divide("wins", F.col("p") * F.col("n")).alias("roc_auc"), F.try_divide("steps", F.col("p")).alias("average_precision"), F.try_divide("errors", rows).alias("brier"))


def top_metrics(df: DataFrame, score: str, target: str, key: str, fraction: float = 0.1) -> DataFrame:
    """One row: cutoff, selected positives, lift (null without positives), precision, recall (0 without positives)."""
    check_fraction(fraction, "fraction", open_top=False)
    rows = df.where(F.col(target).isNotNull() & F.col(score).isNotNull())
    cutoff = max(1, ceil(rows.count() * fraction))
    best = F.col("posicao") <= cutoff
    out = ranked(rows, score, key).agg(F.count_if(best).alias("cutoff"), F.coalesce(F.sum(F.when(best, F.col(target))), F.lit(0)).cast("long").alias("selecionados"), F.coalesce(F.sum(target), F.lit(0)).alias("p"), F.avg(target).alias("base"))
    precision = F.try_divide("selecionados", "cutoff")
    return out.select("cutoff", "selecionados", F.when(F.col("base") > 0, precision / F.col("base")).alias("lift"), precision.alias("precision"), F.coalesce(F.try_divide("selecionados", "p"), F.lit(0.0)).alias("recall"))
