"""Per-company totals over a stream of arriving inscriptions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def windowed_totals(stream: DataFrame, key: str, value: str, time: str, window: str = "90 days", late: str = "30 days") -> DataFrame:
    """Count, sum and maximum per key and window of event time; rows later than the watermark are dropped. Works on batch tables too."""
    rows = stream.withWatermark(time, late) if stream.isStreaming else stream
    out = rows.groupBy(F.window(time, window).alias("janela"), F.col(key)).agg(F.count(F.lit(1)).alias("qtd_inscricoes"), F.sum(value).alias("divida_total"), F.max(value).alias("divida_max"))
    return out.select(key, F.col("janela.start").alias("inicio"), F.col("janela.end").alias("fim"), "qtd_inscricoes", "divida_total", "divida_max")
