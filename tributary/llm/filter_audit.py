"""What each quality filter removes under every order of the filters.

A document's failures are a mask, and masks are counted per part of the corpus. Orders stand in lexicographic order, so
that an order's place is its Lehmer rank, and orders with the same first filters are an interval of ranks. A mask is
removed in step s by filter f exactly in those intervals whose first s - 1 filters it passes and whose s-th is f: its
count is added where such an interval begins and taken off where it ends, and one prefix sum over the ranks gives what a
step removes under every order.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tributary.llm.common import UPPER, materialize, scratch

#: The filters by letter, in the order of their bits.
FILTERS = "ABCDE"
#: Intervals and orders grow with the factorial of the filters.
MOST_FILTERS = 6


def lehmer_rank(order: str) -> int:
    """The place (from 0) of an order among all orders of its letters: digit k counts the later letters that are smaller."""
    n = len(order)
    return sum(sum(y < x for y in order[k + 1 :]) * factorial(n - 1 - k) for k, x in enumerate(order))


def intervals(letters: str = FILTERS) -> Iterator[tuple[int, int, int, int]]:
    """(mask, step, first rank, rank after the last): where that mask is removed in that step."""
    n = len(letters)
    for mask in range(1, 1 << n):
        failed = [x for k, x in enumerate(letters) if mask >> k & 1]
        passed = [x for x in letters if x not in failed]
        for step in range(1, len(passed) + 2):
            for before in permutations(passed, step - 1):
                for by in failed:
                    head = "".join(before) + by
                    first = lehmer_rank(head + "".join(sorted(set(letters) - set(head))))
                    yield mask, step, first, first + factorial(n - step)


def audit(counts: DataFrame, letters: str = FILTERS) -> DataFrame:
    """counts (part, mask, n, good, toxic; masks may repeat) -> one row per part, filter_order and step.

    kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley: long. The counts are a row per part and mask;
    nothing else here grows with the corpus. Without counts there are no rows.
    """
    if sorted(set(letters)) != [*letters] or not 1 <= len(letters) <= MOST_FILTERS:
        raise ValueError(f"filters are 1 to {MOST_FILTERS} different letters in order")
    spark, n = counts.sparkSession, len(letters)
    orders = F.array(*(F.lit("".join(p)) for p in permutations(letters)))
    sums = ["n", "good", "toxic"]
    masks = counts.groupBy("part", "mask").agg(*(F.sum(k).alias(k) for k in sums))
    cuts = spark.createDataFrame([*intervals(letters)], "mask int, step int, first int, last int")  # fewer than 2^n n! rows
    ends = F.explode(F.array(F.struct(F.col("first").alias("rank"), F.lit(1).alias("sign")), F.struct(F.col("last").alias("rank"), F.lit(-1).alias("sign")))).alias("end")
    marks = masks.join(F.broadcast(cuts), "mask").select("part", "step", *sums, ends).groupBy("part", "step", F.col("end.rank").alias("rank")).agg(*(F.sum(F.col(k) * F.col("end.sign")).alias(k) for k in sums))
    fails = lambda k: F.col("mask").bitwiseAND(F.lit(1 << k)) > 0
    total = lambda k, when: F.coalesce(F.sum(F.when(when, F.col("n"))), F.lit(0))
    parts = masks.groupBy("part").agg(
        F.sum("n").alias("rows"), F.array(*(total(k, fails(k)) for k in range(n))).alias("fails"), F.array(*(total(k, F.col("mask") == 1 << k) for k in range(n))).alias("alone")
    )
    grid = parts.select("*", F.explode(F.sequence(F.lit(0), F.lit(factorial(n) - 1))).alias("rank")).select("*", F.explode(F.sequence(F.lit(1), F.lit(n))).alias("step"))
    ranks = Window.partitionBy("part", "step").orderBy("rank").rowsBetween(Window.unboundedPreceding, 0)  # as many rows as orders
    steps = Window.partitionBy("part", "rank").orderBy("step").rowsBetween(Window.unboundedPreceding, 0)  # as many rows as filters
    done = grid.join(marks, ["part", "step", "rank"], "left").withColumns({k: F.sum(F.coalesce(k, F.lit(0))).over(ranks) for k in sums})
    done = done.withColumn("filter_order", F.element_at(orders, F.col("rank") + 1)).withColumn("by", F.substring("filter_order", F.col("step"), F.lit(1)))
    of = lambda name: F.element_at(name, F.instr(F.lit(letters), F.col("by")))
    return done.select(
        "part", "filter_order", "step", (F.col("rows") - F.sum("n").over(steps)).alias("kept"), F.col("n").alias("removed"), (of("fails") - F.col("n")).alias("redundant"),
        of("alone").alias("unique_fails"), F.col("good").alias("good_lost"), F.col("toxic").alias("toxic_lost"), F.sum("n").over(Window.partitionBy("part", "by")).alias("shapley"),
    )


def text_failures(text: Column, words: Column) -> Column:
    """The first four bits: short, repetitive, shouting, symbols. words: the array of the text's words."""
    n, chars = F.size(words).cast("long"), F.length(text).cast("long")
    upper = chars - F.length(F.translate(text, UPPER, ""))
    tests = [n < 100, 100 * F.size(F.array_distinct(words)).cast("long") < 80 * n, 100 * upper > 10 * chars, text.rlike("[#$%&*|]")]
    return sum((F.when(t, 1 << k).otherwise(0) for k, t in enumerate(tests)), F.lit(0))


def failures(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows of docs counted by part, mask of FILTERS, and label: part, mask, n, good, toxic. See filter_audit.

    The last filter fails a row whose text stands under a smaller id. Rows meet by digest only as one row for each
    digest, part and partition, so that copies of one text, however many, are never gathered: all rows are counted, and
    of each digest the rows of its smallest id are counted as passing.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").alias("id"), F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("part"), text.alias("text"))
    rows = rows.withColumn("words", F.array_remove(F.split("text", "[\\x20\\x09-\\x0D]+"), ""))
    rows = rows.select("id", "part", text_failures(F.col("text"), F.col("words")).alias("mask"), F.unhex(F.sha2(F.col("text").cast("binary"), 256)).alias("digest"))
    known = labels.where("doc_id is not null").groupBy(F.col("doc_id").alias("id")).agg(F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"), F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic"))
    kind = ["part", "mask", "good", "toxic"]
    with scratch():
        rows = materialize(rows, "audit-rows")  # texts are read once
        rows = rows.join(known, "id", "left").withColumns({k: F.coalesce(k, F.lit(False)) for k in ("good", "toxic")}).withColumn("none", F.col("id").isNull())
        rows = materialize(rows, "audit-labelled")
        same_id = rows.groupBy("digest", "part", "none", "id").agg(F.count(F.lit(1)).alias("n"), *(F.max(k).alias(k) for k in ("mask", "good", "toxic")))
        least = same_id.groupBy("digest", "part").agg(F.min(F.struct("none", "id", "n", "mask", "good", "toxic")).alias("first"))
        name = F.struct("first.none", "first.id")
        least = least.withColumn("least", F.min(name).over(Window.partitionBy("digest"))).where(name == F.col("least"))  # a row per part in each digest
        firsts = least.select("part", "first.*").groupBy(kind).agg(F.sum("n").alias("n"))
        every = rows.groupBy(kind).agg(F.count(F.lit(1)).alias("n"))
        last = F.col("mask") + (1 << (len(FILTERS) - 1))
        split = every.withColumn("mask", last).unionByName(firsts.withColumns({"mask": last, "n": -F.col("n")})).unionByName(firsts)
        split = split.groupBy(kind).agg(F.sum("n").alias("n")).where("n > 0")
        return materialize(split.groupBy("part", "mask").agg(F.sum("n").alias("n"), *(F.coalesce(F.sum(F.when(F.col(k), F.col("n"))), F.lit(0)).alias(k) for k in ("good", "toxic"))), "audit-masks", stays=True)


def filter_audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per part (lang; null as empty string), filter_order and step (1-5), zeros included.

    Filters fail a text (null: empty; words between ASCII white space, case-sensitive) with A fewer than 100 words, B less
    than 80 % different words, C more than 10 % A-Z, D one of #$%&*|, E the same text under a smaller id anywhere in the
    table. A null id is larger than any other; rows that repeat an id do not fail each other. A document is good or toxic
    if any of its rows in labels says so (quality = 1, toxic = 1; null says nothing); labels of unknown ids, or of a null
    one, count nowhere. Columns as in audit. Texts are read whole. Other columns are not read, whatever their names. An
    empty table gives an empty result.
    """
    return audit(failures(docs, labels))
