"""Language-model scoring: corpus counts by shuffle, a gated recurrent model fitted to every training token in rounds of
averaged shards, and one pass that scores every whole document.

Words outside the head are predicted as a class by the network; inside the class a word has its discounted share of the
corpus counts, and one further outcome stands for every word the training documents lack. The commonest words (a bounded
table) are looked up in the tasks; all rarer ones are joined with the counts by a shuffle.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import repeat
from math import log, log10

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tributary.llm import gru
from tributary.llm.common import blob, crc_mod, materialize, pieces, scratch, small_batches, words_of

END = b"\n"  # cannot be a word
HEAD_WORDS = 1024
KNOWN_WORDS = 131_072
KNOWN_BYTES = 64
HIDDEN = 16
ROUNDS = 3
FAN = 64
_FLUSH = 200_000
BATCH_BYTES = 16 << 20  # of texts that a task holds as Python objects at once


def count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: Counter = Counter()

    def out() -> pa.RecordBatch:
        b = pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.binary()), pa.array(held.values(), pa.int64())], ["word", "c"])
        held.clear()
        return b

    for b in pieces(batches, 10_000, BATCH_BYTES):
        for text in b.column(0).to_pylist():
            held.update(words_of(text))
            held[END] += 1
            if len(held) >= _FLUSH:
                yield out()
    yield out()


class Vocabulary:
    """What every task needs to know: the commonest words with their counts, and the corpus totals."""

    def __init__(self, words: list[bytes], counts: list[int], total: int, distinct: int, ones: int, twos: int, head: int = HEAD_WORDS):
        if END not in words:  # the network takes its number 0 for the end
            words, counts = [*words, END], [*counts, 0]
        order = sorted(range(len(words)), key=lambda i: (words[i] != END, -counts[i], words[i]))
        self.words = [words[i] for i in order]
        self.counts = [counts[i] for i in order]
        self.total, self.distinct = total, distinct
        self.n_head = min(head, len(self.words))
        self.head_counts = np.array(self.counts[: self.n_head], np.float64)
        self.other_total, self.other_distinct = total - int(self.head_counts.sum()), max(0, distinct - int((self.head_counts > 0).sum()))
        self.discount = min(0.95, max(0.1, ones / (ones + 2 * twos))) if ones and twos else 0.5

    def known_share(self, c: int) -> float:
        """log10 of a known other word's share of its class."""
        return log10((c - self.discount) / (self.other_total + 1))

    def unknown_share(self) -> float:
        return log10((self.discount * self.other_distinct + 1) / (self.other_total + 1))


def count_level(c: Column) -> Column:
    """A number from 0 to 16,383 that grows with a count: the count itself below 512, then 256 steps for each doubling."""
    shift = F.greatest(F.length(F.bin(c)) - 9, F.lit(0))
    return shift * 256 + F.floor(c / F.pow(F.lit(2.0), shift)).cast("int")


def vocabulary(counts: DataFrame, known: int = KNOWN_WORDS, head: int = HEAD_WORDS) -> Vocabulary:
    """The end and at most `known` words: all of at most KNOWN_BYTES bytes whose counts reach a level that they fit with.

    Only the number of words at each level (16,384 at most) and the words that were chosen reach the driver.
    """
    is_end = F.col("word") == F.lit(bytearray(END))
    zero = lambda c: F.coalesce(c, F.lit(0))
    *t, ends = counts.agg(zero(F.sum("c")), F.count(F.lit(1)), F.count_if(F.col("c") == 1), F.count_if(F.col("c") == 2), zero(F.sum(F.when(is_end, F.col("c"))))).first()
    short = counts.where(~is_end & (F.length("word") <= KNOWN_BYTES)).withColumn("level", count_level(F.col("c")))
    least, left = 1 << 20, known
    for level, n in sorted(((r[0], r[1]) for r in short.groupBy("level").count().collect()), reverse=True):
        if n > left:
            break
        least, left = level, left - n
    top = short.where(F.col("level") >= least).select("word", "c").toArrow()
    return Vocabulary([END, *map(bytes, top["word"].to_pylist())], [ends, *top["c"].to_pylist()], *t, head=head)


def mean_block(rows: pa.Table) -> pa.Table:
    """Mean of one block of some shards' weights, weighted by tokens; whole numbers, so that reruns agree."""
    w = rows["w"].to_pylist()
    less = max(0, sum(w).bit_length() - 32)  # the sums stay below 2^63
    parts = [max(1, k >> less) for k in w]
    total = sum(k * np.array(v, np.int64) for k, v in zip(parts, rows["v"].to_pylist(), strict=True))
    return pa.table({"at": rows["at"][:1], "shard": pa.array([rows["shard"][0].as_py() // FAN], pa.int64()), "w": pa.array([sum(w)], pa.int64()), "v": pa.array([total // sum(parts)], pa.list_(pa.int64()))})


def fit(train: DataFrame, vocab: Vocabulary, hidden: int = HIDDEN, rounds: int = ROUNDS) -> np.ndarray:
    """Weights of the network. train: text (bytes) and row, a number.

    Every token of every row is learned from once. The rows are dealt over `rounds` rounds by their number; in a round each
    task goes through all tokens of its rows of that round, starting from the common weights, and the weights are then
    averaged, weighted by tokens, FAN shards at a time. There are as many shards as the table has partitions.
    """
    weights = gru.flat(gru.initial(vocab.head_counts, vocab.other_total, hidden)).astype(np.float64)
    if not vocab.total:
        return weights
    sc = train.sparkSession.sparkContext
    n_head, head_words = vocab.n_head, sc.broadcast({w: i for i, w in enumerate(vocab.words[: vocab.n_head])})
    kind = "at long, shard long, w long, v array<long>"
    for turn in range(rounds):
        now = sc.broadcast(weights.copy())

        def shard(batches: Iterator[pa.RecordBatch], now=now) -> Iterator[pa.RecordBatch]:
            ids, other, number = head_words.value, n_head, TaskContext.get().partitionId()

            def docs() -> Iterator[np.ndarray]:
                for b in batches:
                    for text in b.column(0):
                        words = words_of(text.as_py())
                        yield np.append(np.fromiter(map(ids.get, words, repeat(other)), np.int64, len(words)), 0)

            out, got = gru.train(gru.shaped(now.value, n_head, hidden), docs(), n_head)
            if got:
                whole = np.rint(np.clip(gru.flat(out), -500, 500) * (1 << 20)).astype(np.int64)
                for i in range(0, len(whole), 4096):
                    yield pa.RecordBatch.from_arrays([pa.array([i], pa.int64()), pa.array([number], pa.int64()), pa.array([got], pa.int64()), pa.array([whole[i : i + 4096].tolist()], pa.list_(pa.int64()))], ["at", "shard", "w", "v"])

        parts = train.where(F.pmod("row", F.lit(rounds)) == turn).select("text").mapInArrow(shard, kind)
        left = train.rdd.getNumPartitions()
        while left > FAN:
            parts, left = parts.groupBy("at", F.floor(F.col("shard") / FAN)).applyInArrow(mean_block, kind), -(-left // FAN)
        for row in parts.groupBy("at").applyInArrow(mean_block, kind).toLocalIterator():  # at most FAN rows a group; together one value per weight
            weights[row["at"] : row["at"] + len(row["v"])] = np.array(row["v"]) / (1 << 20)
        now.unpersist()
    return weights


def scorer(vocab, weights, hidden: int, most: int = 2_000_000):
    """vocab, weights: broadcasts. Documents are scored together up to `most` tokens, the last of them whole."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v: Vocabulary = vocab.value
        p = gru.shaped(weights.value, v.n_head, hidden)
        rank = {w: i for i, w in enumerate(v.words)}
        counts = np.array([*v.counts, 0], np.float64)  # the last one is for words that aren't here: -1
        plus, known = np.log10(counts + 1), counts > 0
        share = np.zeros(len(counts))
        share[v.n_head : -1] = np.log10((counts[v.n_head : -1] - v.discount) / (v.other_total + 1))

        def scored(b: pa.RecordBatch, ids: list[np.ndarray], rare: list[list[bytes]]) -> pa.RecordBatch:
            sizes = np.array([len(x) for x in ids])
            flat = np.concatenate(ids)
            begins = np.cumsum(sizes) - sizes
            total = lambda x: np.add.reduceat(x[flat], begins)
            model = gru.score(p, np.where((flat < 0) | (flat >= v.n_head), v.n_head, flat), sizes, v.n_head) / log(10)
            return pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), b.column(3), pa.array(sizes), pa.array(total(known.astype(np.int64))), pa.array(total(plus)), pa.array(model + total(share)), pa.array(rare, pa.list_(pa.binary()))],
                ["id", "row", "held_out", "n_tokens", "n_known", "base", "model", "rare"],
            )

        for b in pieces(batches, 10_000, BATCH_BYTES):
            first, size, ids, rare = 0, 0, [], []
            for i, text in enumerate(b.column(2).to_pylist(), 1):
                words = words_of(text)
                at = np.zeros(len(words) + 1, np.int64)
                at[:-1] = np.fromiter(map(rank.get, words, repeat(-1)), np.int64, len(words))
                ids.append(at)
                rare.append([words[k] for k in np.flatnonzero(at < 0).tolist()])
                size += len(at)
                if size >= most or i == b.num_rows:
                    yield scored(b.slice(first, i - first), ids, rare)
                    first, size, ids, rare = i, 0, [], []

    return run


def lm_score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", folds: int = 7, held_out: int = 2, hidden: int = HIDDEN, known: int = KNOWN_WORDS, head: int = HEAD_WORDS) -> DataFrame:
    """One row per row of docs: id_col, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Tokens are the words (A-Z lower-cased, split at ASCII white space) and one end. Rows whose crc32(id) % folds is
    held_out teach nothing. base_score is the add-one unigram log10 probability, score the network's; both know one
    outcome for all words without a count. A null text is an empty one: its end alone. A null id counts as checksum 0.
    Without training rows the score is that of an untrained network. Repeated rows are scored each, and words with equal
    counts are all known or all not. A very long text is scored whole, its state carried on. The training shards are the
    table's partitions, so scores are the same for the same files and partition settings. Other columns are not read; no
    rows give no rows.
    """
    with scratch():
        return _lm_score(docs, id_col, text_col, folds, held_out, hidden, known, head)


def _lm_score(docs: DataFrame, id_col: str, text_col: str, folds: int, held_out: int, hidden: int, known: int, head: int) -> DataFrame:
    small_batches(docs.sparkSession, "16m")  # documents are scored side by side
    rows = docs.select(F.col(id_col).alias("id"), F.monotonically_increasing_id().alias("row"), blob(text_col).alias("text"), (crc_mod(id_col, folds) == held_out).alias("held_out"))
    train = rows.where(~F.col("held_out")).select("text", "row")
    counts = materialize(train.select("text").mapInArrow(count_words, "word binary, c long").groupBy("word").agg(F.sum("c").alias("c")), "counts")
    vocab = vocabulary(counts, known, head)
    weights = fit(train, vocab, hidden)

    sc = docs.sparkSession.sparkContext
    schema = rows.select("id", "row", "held_out").schema
    for name, kind in (("n_tokens", "long"), ("n_known", "long"), ("base", "double"), ("model", "double"), ("rare", T.ArrayType(T.BinaryType()))):
        schema = schema.add(name, kind)
    scored = materialize(rows.mapInArrow(scorer(sc.broadcast(vocab), sc.broadcast(weights), hidden), schema), "scored", stays=True)
    words = scored.select("row", F.explode("rare").alias("word")).join(counts, "word", "left").select("row", "c")
    log_share = F.when(F.col("c").isNull(), F.lit(vocab.unknown_share())).otherwise(F.log10(F.col("c") - F.lit(vocab.discount)) - F.lit(log10(vocab.other_total + 1)))
    late = words.groupBy("row").agg(F.count("c").alias("more"), F.sum(F.log10(F.coalesce("c", F.lit(0)) + F.lit(1.0))).alias("late_base"), F.sum(log_share).alias("late_model"))
    late = materialize(late, "late", stays=True)
    zero = lambda c: F.coalesce(c, F.lit(0))
    out = scored.drop("rare").join(late, "row", "left")
    return out.select(
        F.col("id").alias(id_col), "held_out", "n_tokens", (F.col("n_known") + zero("more")).alias("n_known"), F.lit(vocab.total).cast("long").alias("train_tokens"),
        (F.col("base") + zero("late_base") - F.col("n_tokens") * F.lit(log10(vocab.total + vocab.distinct + 1))).alias("base_score"),
        (F.col("model") + zero("late_model")).alias("score"),
    )
