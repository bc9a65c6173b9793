"""Tables that a job writes for itself into the folder that driver and executors share, and their end."""

from __future__ import annotations

import re
import tempfile
import threading
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share; a temporary one only where the session names none (local tests)."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(found)
    return found


#: Bytes of a method that the JVM compiles, and Spark's own default.
COMPILED, UNSET = "8000", "65535"


def compiled(df: DataFrame) -> DataFrame:
    """df, in a session where Spark runs a stage operator by operator if it would make a method of it that the JVM only
    interprets (two to seven times as long where measured). A session that has a limit of its own keeps it."""
    conf, limit = df.sparkSession.conf, "spark.sql.codegen.hugeMethodLimit"
    if conf.get(limit, UNSET) == UNSET:
        conf.set(limit, COMPILED)
    return df


_OPEN = threading.local()


@contextmanager
def scratch():
    """Tables that are materialized inside are deleted when the block ends, unless materialize was told that they stay;
    those belong to the block around it. What belongs to no block is deleted when the application ends."""
    stack = _OPEN.__dict__.setdefault("stack", [])
    own: list[tuple[SparkSession, str]] = []
    stack.append(own)
    try:
        yield own
    finally:
        stack.pop()
        delete(own)


def delete(tables: list[tuple[SparkSession, str]]) -> None:
    """Deletes what materialize wrote; the list is empty afterwards."""
    while tables:
        spark, path = tables.pop()
        where = spark._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def new_folder(spark: SparkSession, name: str, stays: bool = False) -> str:
    """A path in the shared folder that nothing else has; it is deleted with the innermost scratch() block, or with `stays`
    with the one around it, or when the application ends."""
    path = f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(where)
    stack = _OPEN.__dict__.get("stack", [])
    if len(stack) > stays:
        stack[-1 - stays].append((spark, path))
    return path


def materialize(df: DataFrame, name: str, stays: bool = False) -> DataFrame:
    """Write df as Parquet into the shared folder and read it back: cuts the lineage and computes df once.

    stays: the table outlives the innermost scratch() block, because what the block returns reads it.
    """
    path = new_folder(df.sparkSession, name, stays)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
