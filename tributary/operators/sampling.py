"""Samples and splits that come out the same every time."""

from __future__ import annotations

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tributary.operators.checks import check_fraction
from tributary.operators.running import running
from tributary.sources.delimited import FILES_A_TASK, listed, open_stream, reached_by_python


def hash_slot(key: Column, slots: int = 1000) -> Column:
    """A number from 0 to slots - 1 out of the md5 of the key: the same in every engine."""
    return (F.conv(F.substring(F.md5(key.cast("string").cast("binary")), 1, 8), 16, 10).cast("long") % slots).cast("int")


def hash_sample(df: DataFrame, key: str, threshold: int) -> DataFrame:
    """Keys whose slot of 1000 is below threshold; 0 keeps all."""
    if not 0 <= threshold <= 999:
        raise ValueError("threshold must be between 0 and 999")
    return df if threshold == 0 else df.where(hash_slot(F.col(key)) < threshold)


def even_indices(count: int, total: int) -> list[int]:
    """`count` indices spread evenly over 0..total-1, rounded half to even."""
    if total <= 0 or count <= 0:
        return []
    if count >= total:
        return list(range(total))
    return [0] if count == 1 else list(dict.fromkeys(round(i * (total - 1) / (count - 1)) for i in range(count)))


def systematic_sample(df: DataFrame, rows: int, blocks: int, block_rows: int) -> DataFrame:
    """The first rows of evenly spread blocks of a file source: at most `rows` in all. df must come from files.

    A block is block_rows consecutive rows of one file; the first ceil(rows / blocks) rows of each chosen one are taken,
    in the order of files. Blocks are numbered by running sums over the files; only their total reaches the driver.
    """
    at = df.select("*", F.col("_metadata.file_path").alias("__file"), F.col("_metadata.row_index").alias("__at")).withColumn("__block", F.floor(F.col("__at") / block_rows))
    files = at.groupBy("__file").agg((F.max("__block") + 1).alias("__blocks"))
    placed = running(files, [F.col("__file").asc()], {"__through": F.col("__blocks")}, "files", "__place")
    total = placed.agg(F.coalesce(F.sum("__blocks"), F.lit(0))).first()[0]
    chosen = even_indices(blocks, total)
    each = -(-rows // max(1, len(chosen)))
    numbers = F.array(*(F.struct(F.lit(i).cast("long").alias("index"), F.lit(n).alias("n")) for n, i in enumerate(chosen))).cast("array<struct<index:bigint,n:int>>")
    before = F.col("__through") - F.col("__blocks")
    keys = placed.select("__file", before.alias("__before"), F.explode(F.filter(numbers, lambda x: (x["index"] >= before) & (x["index"] < F.col("__through")))).alias("__c"))
    keys = keys.select("__file", (F.col("__c.index") - F.col("__before")).alias("__block"), F.col("__c.n").alias("__n"))  # `blocks` rows
    out = at.join(F.broadcast(keys), ["__file", "__block"]).where(F.col("__at") % block_rows < each).withColumn("__take", F.col("__n") * each + F.col("__at") % block_rows)
    return out.where(F.col("__take") < rows).drop("__file", "__block", "__at", "__n", "__take")


def footers(batches):
    """A row for each row group of the files, from their footers alone."""
    for b in batches:
        for path in b.column(0).to_pylist():
            with open_stream(path) as f:
                meta = pq.ParquetFile(f).metadata
                sizes = [meta.row_group(i).num_rows for i in range(meta.num_row_groups)]
            yield pa.RecordBatch.from_arrays([pa.array([path] * len(sizes), pa.string()), pa.array(range(len(sizes)), pa.int32()), pa.array(sizes, pa.int64())], ["arquivo", "grupo", "linhas"])


def first_of_groups(batches, columns: list[str], schema: pa.Schema, each: int, rows: int):
    """The first rows of each chosen row group; nothing else of its file is read."""
    for b in batches:
        for path, group, number in zip(*(c.to_pylist() for c in b.columns), strict=True):
            most = min(each, rows - number * each)
            with open_stream(path) as f:
                part = next(pq.ParquetFile(f).iter_batches(batch_size=most, row_groups=[group], columns=columns), None) if most > 0 else None
            if part is not None:
                yield from pa.Table.from_batches([part]).select(columns).cast(schema).to_batches()


def row_group_sample(spark: SparkSession, path: str, rows: int, groups: int, columns: list[str] | None = None) -> DataFrame:
    """systematic_sample over the row groups that Parquet files have: the first ceil(rows / groups) rows of evenly spread
    ones, at most `rows` in all. Tasks read the footers, then of each chosen group its first pages; other groups and
    columns are not touched. Files in the order of their paths; empty groups count. The files have to be where Python
    reaches them; elsewhere use systematic_sample, whose blocks have a fixed number of rows."""
    schema = spark.read.parquet(path).schema
    columns = columns or schema.names
    kept = T.StructType([schema[c] for c in columns])
    files = listed(spark, path, "*.parquet")
    one = files.select("arquivo").first()
    if one is not None and not reached_by_python(one[0]):
        raise ValueError(f"{path} is not within Python's reach")
    found = files.select("arquivo").repartition(max(1, -(-files.count() // FILES_A_TASK))).mapInArrow(footers, "arquivo string, grupo int, linhas long")
    placed = running(found, [F.col("arquivo").asc(), F.col("grupo").asc()], {}, "row-groups")
    chosen = even_indices(groups, placed.count())
    if not chosen or rows < 1:
        return spark.createDataFrame([], kept)
    each = -(-rows // len(chosen))
    number = F.array_position(F.array(*(F.lit(i + 1).cast("long") for i in chosen)), F.col("place")).cast("int") - 1
    take = placed.select("arquivo", "grupo", number.alias("numero")).where("numero >= 0").repartition(len(chosen))  # a row per chosen group
    target = to_arrow_schema(kept)
    return take.mapInArrow(lambda it: first_of_groups(it, columns, target, each, rows), kept)


def _order(key: str, seed: int) -> list[Column]:
    return [F.md5(F.concat(F.col(key).cast("string"), F.lit(f":{seed}")).cast("binary")), F.col(key)]


def stratified_rank(df: DataFrame, target: str, key: str, seed: int, buckets: int = 256) -> DataFrame:
    """__rank of each row inside its class in hash order, and __size of the class.

    A class may hold nearly all rows: ranks are made inside hash buckets, which follow the hash order, and the counts of
    the buckets before are added.
    """
    h, k = _order(key, seed)
    rows = df.withColumn("__h", h).withColumn("__b", (F.conv(F.substring("__h", 1, 8), 16, 10).cast("long") * buckets / (1 << 32)).cast("int"))
    counts = rows.groupBy(target, "__b").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy(target).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("__off", F.coalesce(F.sum("__n").over(before), F.lit(0))).withColumn("__size", F.sum("__n").over(Window.partitionBy(target)))
    counts = counts.select(F.col(target).alias("__t"), F.col("__b").alias("__bb"), "__off", "__size")
    out = rows.join(F.broadcast(counts), F.col(target).eqNullSafe(F.col("__t")) & (F.col("__b") == F.col("__bb")))  # classes x buckets rows
    inside = Window.partitionBy(target, "__b").orderBy("__h", k)
    return out.withColumn("__rank", F.row_number().over(inside) + F.col("__off")).drop("__h", "__b", "__t", "__bb", "__off")


def stratified_split(df: DataFrame, target: str, key: str, test: float = 0.2, seed: int = 42) -> DataFrame:
    """df with `teste`: true for round(test * n) rows of every class, by hash order."""
    check_fraction(test, "test")
    return stratified_rank(df, target, key, seed).withColumn("teste", F.col("__rank") <= F.floor(F.col("__size") * test + 0.5)).drop("__rank", "__size")


def stratified_sample(df: DataFrame, target: str, key: str, rows: int, seed: int = 42) -> DataFrame:
    """About `rows` rows with the shares of the classes kept; all rows if there are fewer."""
    if rows < 2:
        raise ValueError("a sample needs 2 rows at least")
    total = df.count()
    if rows >= total:
        return df
    return stratified_rank(df, target, key, seed).where(F.col("__rank") <= F.floor(F.col("__size") * (rows / total) + 0.5)).drop("__rank", "__size")
