"""Inscriptions that arrive by quarter, folded into one state per company."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from tributary.operators.aggregates import KEY, fiscal_state, fiscal_totals, merged_states
from tributary.sources.staging import delete

VERSION = "versao"


def version_path(path: str, number: int) -> str:
    return f"{path.rstrip('/')}/{VERSION}={number}"


def exists(spark: SparkSession, path: str) -> bool:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)


def fold(arrived: DataFrame, number: int, path: str, key: str = KEY) -> None:
    """Merges a batch of inscriptions into the state, as its version `number`.

    Version n is made from version n - 1 and batch n alone and replaces what an interrupted run of the same batch has left,
    so that a batch which is delivered twice counts once. The version before stays until the next one stands. The state
    has a row per company, however many inscriptions arrived; batches are combined before they meet it."""
    spark = arrived.sparkSession
    new = fiscal_state(arrived, key)
    if number > 0:
        if not exists(spark, f"{version_path(path, number - 1)}/_SUCCESS"):
            raise ValueError(f"{path} has no version {number - 1}: the state and the stream's checkpoint don't belong together")
        new = merged_states(spark.read.schema(new.schema).parquet(version_path(path, number - 1)).unionByName(new), key)
    elif exists(spark, version_path(path, 1)):
        raise ValueError(f"{path} has a state already, but the stream begins")
    new.write.mode("overwrite").parquet(version_path(path, number))
    if number > 1:
        delete([(spark, version_path(path, number - 2))])


def follow(stream: DataFrame, path: str, checkpoint: str, key: str = KEY) -> StreamingQuery:
    """Folds all that has arrived, batch by batch, and ends; begun again with the same checkpoint it goes on where it was."""
    writer = stream.writeStream.foreachBatch(lambda batch, number: fold(batch, number, path, key))
    return writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def totals(spark: SparkSession, path: str, key: str = KEY) -> DataFrame:
    """The companies' debts as of the last version: the columns of fiscal_totals."""
    states = spark.read.parquet(path)
    last = states.agg(F.max(VERSION)).first()[0]  # of two versions at most
    return fiscal_totals(states.where(F.col(VERSION) == last).drop(VERSION), key)
