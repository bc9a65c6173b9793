"""Mixing sources to target weights, in DataFrame operations only.

Every document gets a hash-random key; the keys are range-sorted by source, running sums of the word counts are computed
over the partitions, and each source is cut at its budget. A source whose target is above its size is taken whole as often
as that goes, and the rest is cut from one more epoch. The outcome is one cut per source: a document compares its own key
with it, so texts are never sorted or shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tributary.llm.common import AT, FILE, WORD, addressed, if_small, materialize, scratch
from tributary.operators.running import running

WEIGHTS = (5, 2, 1)
MAX_EPOCHS = 3


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MAX_EPOCHS) -> DataFrame:
    """sizes(source, source_size) -> source, source_size, target (double).

    Sources in code-point order (null last) weigh `weights` in turn and share all words; a target stops at `most` times
    the source's size and the excess is shared again. In the order of the cap per weight the capped sources come first:
    one is capped if what the ones before it leave would give it its cap or more.
    """
    ranked = running(sizes, [F.col("source").asc_nulls_last()], {}, "ranks")
    weight = F.element_at(F.array(*map(F.lit, weights)), ((F.col("place") - 1) % len(weights) + 1).cast("int"))
    caps = ranked.withColumns({"w": weight.cast("long"), "cap": F.col("source_size") * most})
    total = caps.agg(F.coalesce(F.sum("source_size"), F.lit(0)), F.coalesce(F.sum("w"), F.lit(0))).first()  # two numbers
    filled = running(caps.withColumnRenamed("place", "rank"), [(F.col("cap") / F.col("w")).asc(), F.col("rank").asc()], {"caps": F.col("cap"), "ws": F.col("w")}, "caps")
    double = lambda c: c.cast("double")
    left, share = F.lit(total[0]) - F.col("caps") + F.col("cap"), F.lit(total[1]) - F.col("ws") + F.col("w")
    filled = filled.withColumn("capped", double(left) * double(F.col("w")) >= double(F.col("cap")) * double(share))
    used = filled.where("capped").agg(F.coalesce(F.sum("cap"), F.lit(0)), F.coalesce(F.sum("w"), F.lit(0))).first()
    fair = double(F.col("w")) * double(F.lit(total[0] - used[0])) / double(F.lit(max(1, total[1] - used[1])))
    return filled.select("source", "source_size", F.when(F.col("capped"), double(F.col("cap"))).otherwise(fair).alias("target"))


ORDER = ("key", "size", FILE, AT)


def source_cuts(rows: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MAX_EPOCHS) -> DataFrame:
    """rows(source, size, key, FILE, AT) -> one row per source: own (its name), source_size, target, epochs, and the cut: the
    ORDER of the document that reaches the budget in the epoch after them, and cut_words, what it gives. Null without a cut.
    A null source is one; sources without words have the target 0 and no cut; no rows give no sources."""
    targets = materialize(source_targets(rows.groupBy("source").agg(F.sum("size").alias("source_size")), weights, most), "targets")
    placed = running(rows.select("source", *ORDER), [F.col("source").asc_nulls_last(), *(F.col(c).asc() for c in ORDER)], {"through": F.col("size")}, "mixed")
    # A source begins where all smaller ones end.
    starts = running(targets, [F.col("source").asc_nulls_last()], {"ends": F.col("source_size")}, "starts")
    budget = F.floor(F.col("target") + 0.5).cast("long")
    epochs = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(0).cast("long")
    starts = starts.select(F.col("source").alias("own"), "source_size", "target", epochs.alias("epochs"), (budget - epochs * F.col("source_size")).alias("rest"), (F.col("ends") - F.col("source_size")).alias("start"))
    starts = materialize(starts, "sources")
    before = F.col("through") - F.col("size") - F.col("start")
    cut = placed.join(if_small(starts.select("own", "rest", "start"), 96), F.col("source").eqNullSafe(F.col("own"))).where((before < F.col("rest")) & (before + F.col("size") >= F.col("rest")))
    cut = cut.select(F.col("source").alias("at_source"), F.struct(*ORDER).alias("cut"), (F.col("rest") - before).alias("cut_words"))
    return starts.join(cut, F.col("own").eqNullSafe(F.col("at_source")), "left").select("own", "source_size", "target", "epochs", "cut", "cut_words")


def mix_sources(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: tuple[int, ...] = WEIGHTS, most: int = MAX_EPOCHS, seed: str = "mix", whole: bool = False
) -> DataFrame:
    """One row per row of docs: id_col, source, size, source_size, target, taken; with `whole` doc (a struct of its columns)
    instead of id_col.

    taken counts words with repeats: whole epochs plus, for the documents before the cut, one more time; the document at
    the cut gives the words up to the budget, so each source's sum is its target rounded to a whole number. No document
    exceeds `most` times its size. Keys are md5 of seed and id: reruns agree; rows that share an id follow each other by
    size, then by their place in the files. Null and empty texts have size 0; null is a source of its own, the last; a null
    id has the key of an empty one. Very long texts are counted whole. Other columns are not read unless `whole`, and then
    lie in the struct, so that names cannot clash; no rows give no rows.
    """
    key = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))).cast("binary"))
    facts = {"source": F.col(source_col).cast("string"), "size": word_count(F.col(text_col)), "key": key}
    own = {"doc": F.struct(*(F.col(f"`{c}`") for c in docs.columns if c not in (FILE, AT)))} if whole else {"id": F.col(id_col)}
    rows = addressed(docs, {**own, **facts}, "sizes")
    with scratch():
        narrow = materialize(rows.drop("doc"), "keys", stays=not whole)
        cuts = materialize(source_cuts(narrow, weights, most), "cuts", stays=True)
    placed = (rows if whole else narrow).join(if_small(cuts, 256), F.col("source").eqNullSafe(F.col("own")))
    place = F.struct(*ORDER)
    once_more = F.when(place < F.col("cut"), F.col("size")).when(place == F.col("cut"), F.col("cut_words")).otherwise(0)
    taken = F.col("epochs") * F.col("size") + F.when(F.col("cut").isNull(), 0).otherwise(once_more)
    return placed.select("doc" if whole else F.col("id").alias(id_col), "source", "size", "source_size", "target", taken.cast("long").alias("taken"))


def epochs_of(mixed: DataFrame) -> DataFrame:
    """Rows repeated as often as the mix takes the document, with `epoch` (0, 1, ...) and the words it takes then."""
    times = F.ceil(F.col("taken") / F.greatest(F.col("size"), F.lit(1))).cast("int")
    out = mixed.where("taken > 0").withColumn("epoch", F.explode(F.sequence(F.lit(0), times - 1)))
    return out.withColumn("words", F.least(F.col("size"), F.col("taken") - F.col("epoch") * F.col("size")))


def first_words(text: Column, n: Column) -> Column:
    """The text up to the end of its n-th word."""
    return F.array_join(F.slice(F.regexp_extract_all(text, F.lit(r"[\x20\x09-\x0D]*" + WORD), F.lit(0)), F.lit(1), n.cast("int")), "")
