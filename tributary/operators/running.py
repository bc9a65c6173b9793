"""Ranks and running sums over a whole table in a given order, without bringing it into one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tributary.sources.staging import materialize


def running(df: DataFrame, order: list[Column], sums: dict[str, Column], name: str = "ordered", place: str = "place") -> DataFrame:
    """df with `place` (1 for the first row) and, for each entry of sums, the sum over this row and all before it. Own columns
    of those names are an error; any other name is kept as it is.

    The table is range-partitioned by the order and written, so that a row's partition stays what it is; each partition's
    totals (one row per partition) give its offsets, and a window inside the partition does the rest. Rows that share the
    first columns of the order are split by the later ones, so that no value is too frequent.
    """
    names = [place, *sums]
    if clash := sorted(set(names) & set(df.columns)):
        raise ValueError(f"columns that would be replaced: {', '.join(clash)}")
    # Names of its own that no column has.
    part = next(n for n in ("__part" + "_" * i for i in range(len(df.columns) + 1)) if n not in df.columns)
    offs = [f"{part}_off{i}" for i in range(len(names))]
    if clash := sorted(set(offs) & set(df.columns)):
        raise ValueError(f"columns that would be replaced: {', '.join(clash)}")
    cut = df.repartitionByRange(*order).withColumn(part, F.spark_partition_id()).withColumns(sums)
    cut = materialize(cut, name)
    totals = cut.groupBy(part).agg(F.count(F.lit(1)).alias(offs[0]), *(F.sum(k).alias(o) for k, o in zip(sums, offs[1:], strict=True)))
    before = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)  # one row per partition
    totals = totals.select(part, *(F.coalesce(F.sum(o).over(before), F.lit(0)).alias(o) for o in offs))
    inside = Window.partitionBy(part).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    out = cut.join(F.broadcast(totals), part)  # as many rows as partitions
    out = out.withColumns({place: F.row_number().over(inside) + F.col(offs[0]), **{k: F.sum(k).over(inside) + F.col(o) for k, o in zip(sums, offs[1:], strict=True)}})
    return out.drop(part, *offs)
