"""Exact deduplication with a heavy-hitter split.

A Misra-Gries summary of k counters is made in every partition of digests and the summaries are added up in Spark. A
digest whose summed counter reaches N/(k+1) is a heavy hitter: at most k+1 digests can be, and none with 2N/(k+1) rows
or more is missed. Heavy hitters are verified by an exact count and get their winner through a broadcast of at most k+1
rows, so their copies never meet in one task. All other digests have few rows each and are shuffled by digest.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tributary.llm.common import lower_az, materialize, scratch

HEAVY_COUNTERS, MOST_COUNTERS = 512, 65_536


def misra_gries(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    """The partition's summary: at most k (digest, lower bound of its count) and one row (null, number of rows)."""
    held: Counter = Counter()
    rows = 0
    for b in batches:
        digests = b.column(0).to_pylist()
        rows += len(digests)
        held.update(digests)
        if len(held) > k:  # the (k+1)-th largest count is taken off all
            cut = sorted(held.values(), reverse=True)[k]
            held = Counter({d: n - cut for d, n in held.items() if n > cut})
    yield pa.RecordBatch.from_arrays([pa.array([*held, None], pa.binary()), pa.array([*held.values(), rows], pa.int64())], ["digest", "n"])


def heavy_digests(digests: DataFrame, k: int) -> DataFrame:
    """At most k+1 digests; every digest with 2N/(k+1) of N rows or more is among them."""
    summed = materialize(digests.select("digest").mapInArrow(lambda it: misra_gries(it, k), "digest binary, n long").groupBy("digest").agg(F.sum("n").alias("n")), "heavy")
    total = summed.where("digest is null").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    return summed.where(F.col("digest").isNotNull() & (F.col("n") >= max(2, total / (k + 1)))).select("digest")


def counters_for(spark: SparkSession) -> int:
    """Twice as many as a shuffle has partitions, between HEAVY_COUNTERS and MOST_COUNTERS: a digest that is missed has no
    more rows than a usual partition."""
    return min(MOST_COUNTERS, max(HEAVY_COUNTERS, 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", counters: int | None = None) -> DataFrame:
    """One row per row of docs: id_col, keep_id, group_size, kept, text_sha256.

    Texts are equal when they are identical after lower-casing A-Z. Of equal texts the row with the largest id stays.
    A null text counts as empty. A null id loses to any other; a group of null ids only keeps one row with keep_id null.
    Of rows that repeat the winning id one stays. Very long texts are hashed whole. Other columns of docs are not read. An
    empty table gives an empty result.
    """
    text = lower_az(F.coalesce(F.col(text_col).cast("string"), F.lit("")))
    source = docs.select(F.col(id_col).alias("id"), F.monotonically_increasing_id().alias("row"), F.unhex(F.sha2(text.cast("binary"), 256)).alias("digest"))
    agg = [F.count(F.lit(1)).alias("group_size"), F.max(F.struct("id", "row")).alias("best")]  # the row number settles ids that repeat
    with scratch():
        rows = materialize(source, "digests", stays=True)
        heavy = F.broadcast(heavy_digests(rows, counters or counters_for(docs.sparkSession)))  # one row more than counters at most
        winners = materialize(rows.join(heavy, "digest").groupBy("digest").agg(*agg), "winners", stays=True)
        cold = rows.join(F.broadcast(winners.select("digest")), "digest", "left_anti")
        # Written before the join, so that Spark can split a partition that is still too large.
        groups = materialize(cold.groupBy("digest").agg(*agg), "groups", stays=True)
    hot = rows.join(F.broadcast(winners), "digest")
    return hot.unionByName(cold.join(groups, "digest")).select(
        F.col("id").alias(id_col), F.col("best.id").alias("keep_id"), "group_size", (F.col("row") == F.col("best.row")).alias("kept"), F.lower(F.hex("digest")).alias("text_sha256")
    )
