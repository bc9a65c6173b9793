"""Parquet tables and views, sinks, inventories and run logs."""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tributary.operators.checks import require_columns, require_rows
from tributary.sources import delimited


def read_table(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    df = spark.read.parquet(path)
    return require_columns(df, columns).select(*columns) if columns else df


def driver_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def register_views(spark: SparkSession, paths: dict[str, str]) -> None:
    for name, path in paths.items():
        spark.read.parquet(path).createOrReplaceTempView(name)


def write_table(df: DataFrame, path: str, force: bool = False, partition_by: list[str] = (), check: bool = True, need_rows: bool = False) -> int:
    """Snappy Parquet; fails if the target exists unless force. Returns the rows written, counted on the way and, with check, again in what was written."""
    if need_rows:
        require_rows(df, "output")
    seen = Observation("written")
    writer = df.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("overwrite" if force else "errorifexists").option("compression", "snappy")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
    rows = int(seen.get["n"])
    if check and (found := df.sparkSession.read.parquet(path).count()) != rows:
        raise RuntimeError(f"{rows} rows went out, {found} are in {path}")
    return rows


def write_clustered(df: DataFrame, path: str, key: str, force: bool = False, group_rows: int = 1_000_000) -> None:
    """Parquet for lookups by key: files are ranges of the key, sorted, so that a key is in one row group or a few next to
    each other, and each has a Bloom filter of its keys."""
    dealt = df.repartitionByRange(key).sortWithinPartitions(key)
    options = {"parquet.block.row.count.limit": group_rows, f"parquet.bloom.filter.enabled#{key}": "true", f"parquet.bloom.filter.expected.ndv#{key}": group_rows, "compression": "snappy"}
    dealt.write.mode("overwrite" if force else "errorifexists").options(**options).parquet(path)


def partition_values(df: DataFrame, columns: list[str]) -> set[tuple]:
    return {tuple(r) for r in df.select(*(F.col(c).cast("string") for c in columns)).distinct().collect()}  # as many as there are folders


def refresh_partitions(df: DataFrame, path: str, partition_by: list[str], force: bool = False) -> list[tuple]:
    """Writes only the partitions that df has rows of, and leaves the others as they are. Without force it fails, before it
    writes, if one of them is there already. Returns the partitions written, as text. df is read twice."""
    spark, new = df.sparkSession, partition_values(df, partition_by)
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    there = where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)
    if there and not force and (both := sorted(new & partition_values(spark.read.parquet(path), partition_by), key=str)):
        raise ValueError(f"{path} has already: {', '.join('/'.join(map(str, b)) for b in both)}")
    dealt = df.hint("rebalance", *partition_by)  # a partition's rows together, large ones in several files
    dealt.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "snappy").partitionBy(*partition_by).parquet(path)
    return sorted(new, key=str)


def write_report(df: DataFrame, path: str, force: bool = True) -> None:
    """A small table as one CSV file with a header."""
    df.coalesce(1).write.mode("overwrite" if force else "errorifexists").option("header", True).csv(path)


#: Bytes of a file that a task holds while it makes the file's digest.
CHUNK_BYTES = 8 << 20


def digests(batches, chunk: int):
    """SHA-256 of each file, read chunk by chunk."""
    for b in batches:
        out = []
        for path in b.column(0).to_pylist():
            made = hashlib.sha256()
            with delimited.open_stream(path) as f:
                while data := f.read(chunk):
                    made.update(data)
            out.append(made.hexdigest())
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out)], ["arquivo", "sha256"])


def file_inventory(spark: SparkSession, folder: str, pattern: str = "*", digest: bool = True, chunk: int = CHUNK_BYTES) -> DataFrame:
    """One row per file: arquivo, tamanho_mb, sha256_16 (the first 16 hex digits; null without digest).

    Files of any size are hashed in tasks, a chunk at a time. In a store that Python does not reach (see sources.delimited)
    Spark reads them whole, which ends at 2 GB. Empty files are left out."""
    files = delimited.listed(spark, folder, pattern)
    size = (F.col("tamanho") / 1048576).alias("tamanho_mb")
    if not digest:
        return files.select("arquivo", size, F.lit(None).cast("string").alias("sha256_16"))
    one = files.select("arquivo").first()
    if one is None or delimited.reached_by_python(one[0]):
        found = files.select("arquivo").repartition(max(1, files.count())).mapInArrow(lambda it: digests(it, chunk), "arquivo string, sha256 string")  # a file, a task
    else:
        found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(folder).select(F.col("path").alias("arquivo"), F.sha2("content", 256).alias("sha256"))
    return files.join(found, "arquivo").select("arquivo", size, F.substring("sha256", 1, 16).alias("sha256_16"))


LOG_FIELDS = ("momento", "etapa", "arquivo", "status", "mensagem")
GOOD = ("OK", "SKIPPED_EXISTS")


def log_run(spark: SparkSession, path: str, rows: list[dict]) -> None:
    """Appends rows; missing fields are empty."""
    data = [tuple("" if r.get(f) is None else str(r[f]) for f in LOG_FIELDS) for r in rows]
    spark.createDataFrame(data, ", ".join(f"{f} string" for f in LOG_FIELDS)).coalesce(1).write.mode("append").parquet(path)


def log_summary(spark: SparkSession, path: str, strict: bool = False) -> DataFrame:
    """Rows per status; with strict, any other than OK and SKIPPED_EXISTS is an error."""
    out = spark.read.parquet(path).groupBy("status").agg(F.count(F.lit(1)).alias("quantidade"))
    if strict and (bad := out.where(~F.col("status").isin(*GOOD)).collect()):
        raise RuntimeError(f"failed: {[r.asDict() for r in bad]}")
    return out
