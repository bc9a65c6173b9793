"""Language identification with error-correcting output codes.

Every language gets a codeword of bits; one binary classifier per bit (logistic regression on hashed byte trigrams of the
lower-cased words) predicts it, and the language whose codeword has the least weighted logistic loss is chosen. A bit
weighs as much as it proved reliable on rows kept aside. Nearly equal losses are flagged as ambiguous.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tributary.llm.common import pieces, small_batches

BUCKETS = 4096
TRAIN_ROWS = 6000
MAX_LANGS = 1000
UND = "und"
#: Bytes that are no letters for the trigrams: ASCII other than a-z.
_SPACED = bytes(c if c >= 128 or 97 <= c <= 122 else 32 for c in range(256))
_PIECE = 1 << 20


def normal(text: str) -> bytes:
    """Lower-cased words of letters, one space around each."""
    return b" " + b" ".join(text.lower().encode().translate(_SPACED).split()) + b" "


def trigram_buckets(data: np.ndarray) -> np.ndarray:
    """The bucket of the trigram that starts at each byte; the last two bytes have none."""
    x = data.astype(np.uint32)
    code = (x[:-2] << np.uint32(16)) | (x[1:-1] << np.uint32(8)) | x[2:]
    return ((code * np.uint32(2654435761)) >> np.uint32(20)).astype(np.int64)  # 12 bits


def histogram(text: bytes) -> np.ndarray:
    if len(text) < 3:
        return np.zeros(BUCKETS, np.float32)
    h = np.bincount(trigram_buckets(np.frombuffer(text, np.uint8)), minlength=BUCKETS)
    return (h * (SCALE / max(1, h.sum()))).astype(np.float32)


SCALE = 100.0


def codewords(n: int, seed: int = 5) -> np.ndarray:
    """[languages, bits] of +1 and -1: all splits of up to six languages; else random ones, the best of many by least distance."""
    if n < 2:
        return np.ones((n, 1))
    if n <= 6:
        return np.array([[1, *c] for c in product((1, -1), repeat=n - 1)][1:]).T
    rng = np.random.default_rng(seed)
    bits = math.ceil(10 * math.log2(n))
    tries = [np.where(rng.random((n, bits)) < 0.5, -1, 1) for _ in range(50)]
    return max(tries, key=lambda c: (c @ c.T - 2 * bits * np.eye(n)).max() * -1)


class Model:
    def __init__(self, langs: list[str], weights: np.ndarray, bias: np.ndarray, trust: np.ndarray):
        self.langs, self.code = langs, codewords(len(langs))
        self.weights, self.bias, self.trust = np.vstack([weights, np.zeros((1, weights.shape[1]))]).astype(np.float32), bias, trust

    def margins(self, texts: list[bytes]) -> np.ndarray:
        """[texts, bits] without ever holding a histogram; long texts go in pieces."""
        out = np.zeros((len(texts), len(self.bias)))
        first, size = 0, 0
        for i, t in enumerate([*texts, b""]):
            if i == len(texts) or size + len(t) > _PIECE:
                if i > first:
                    out[first:i] = self._margins(texts[first:i])
                first, size = i, 0
            size += len(t)
        return out

    def _margins(self, texts: list[bytes]) -> np.ndarray:
        if len(texts) == 1 and len(texts[0]) > _PIECE:
            t, total = texts[0], np.zeros(len(self.bias))
            for i in range(0, len(t), _PIECE):
                total += self.weights[trigram_buckets(np.frombuffer(t[i : i + _PIECE + 2], np.uint8))].sum(axis=0)
            return (total * (SCALE / (len(t) - 2)) + self.bias)[None]
        sizes = np.array([len(t) for t in texts])
        ends = np.cumsum(sizes)
        at = np.append(trigram_buckets(np.frombuffer(b"".join(texts), np.uint8)), [BUCKETS] * 2)
        at[ends - 1] = at[ends - 2] = BUCKETS  # trigrams that would cross into the next text
        sums = np.add.reduceat(self.weights[at], ends - sizes, axis=0)
        return sums * (SCALE / np.maximum(1, sizes - 2))[:, None] + self.bias

    def decode(self, margins: np.ndarray) -> np.ndarray:
        """[texts, languages] probabilities from the weighted losses of the codewords."""
        loss = (np.logaddexp(0, -margins[:, None, :] * self.code[None]) * self.trust).sum(axis=2)
        p = np.exp(loss.min(axis=1, keepdims=True) - loss)
        return p / p.sum(axis=1, keepdims=True)


def fit(x: np.ndarray, y: np.ndarray, aside: np.ndarray, langs: list[str], epochs: int = 12, batch: int = 256) -> Model:
    """x: [rows, BUCKETS] histograms, y: language numbers, aside: rows that only weigh the bits."""
    code = codewords(len(langs))
    bits = code.shape[1]
    w, b = np.zeros((BUCKETS, bits), np.float32), np.zeros(bits)
    if len(langs) < 2:
        return Model(langs, w, b, np.ones(bits))
    rng = np.random.default_rng(3)
    # Languages count alike.
    share = 1 / np.maximum(1, np.bincount(y, minlength=len(langs)))
    m1, m2, mb, vb, step = np.zeros_like(w), np.zeros_like(w), np.zeros(bits), np.zeros(bits), 0
    train = np.flatnonzero(~aside) if (~aside).any() else np.arange(len(y))
    for _ in range(epochs):
        for rows in np.array_split(rng.permutation(train), max(1, len(train) // batch)):
            target, weight = code[y[rows]], share[y[rows]]
            margin = x[rows] @ w + b
            g = (-target / (1 + np.exp(np.clip(target * margin, -30, 30))) * (weight / weight.sum())[:, None]).astype(np.float32)
            gw, gb, step = x[rows].T @ g + 1e-4 * w, g.sum(axis=0), step + 1
            m1 += 0.1 * (gw - m1)
            m2 += 0.01 * (gw * gw - m2)
            mb += 0.1 * (gb - mb)
            vb += 0.01 * (gb * gb - vb)
            c1, c2 = 1 - 0.9**step, 1 - 0.99**step
            w -= 0.05 * (m1 / c1) / (np.sqrt(m2 / c2) + 1e-6)
            b -= 0.05 * (mb / c1) / (np.sqrt(vb / c2) + 1e-6)
    check = np.flatnonzero(aside) if aside.any() else train
    error = (np.sign(x[check] @ w + b) != code[y[check]]).mean(axis=0).clip(0.001, 0.45)
    trust = np.log((1 - error) / error)
    return Model(langs, w, b, trust * bits / trust.sum())


def windows(text: bytes, salt: int) -> Iterator[bytes]:
    """The whole text and two pieces of it, so that the classifiers see short texts too."""
    yield text
    for k, size in enumerate((30, 120)):
        if len(text) > 2 * size:
            at = (salt >> (16 * k)) % (len(text) - size)
            yield text[at : at + size]


def train_histograms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, order) -> rows of the sparse histograms."""
    for b in batches:
        rows: list[tuple] = []
        for lang, order, text in zip(*(b.column(i).to_pylist() for i in range(3)), strict=True):
            for t in windows(normal(text), order):
                h = histogram(t)
                at = np.flatnonzero(h)
                if len(at):
                    rows.append((lang, order, at.astype(np.uint16).tobytes(), h[at].tobytes()))
        cols = list(zip(*rows, strict=True)) or [[]] * 4
        yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.string()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.binary()), pa.array(cols[3], pa.binary())], ["lang", "order", "at", "h"])


def train_model(labelled: DataFrame, key: Column, lang_col: str, text_col: str, train_rows: int = TRAIN_ROWS) -> Model:
    """Learns from at most train_rows histograms (a documented bound) of the labelled rows, as many for each language, picked by a hash.

    Rows without a label or a text teach nothing; of long texts the whole and two pieces are learned from. Ties in the hash
    go by text, and repeated rows may be picked each. Without two languages nothing is to be learned: the model knows the
    one there is, or none. More than MAX_LANGS languages are refused.
    """
    rows = labelled.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(F.col(lang_col).cast("string").alias("lang"), F.shiftrightunsigned(F.xxhash64(key, F.lit("lang")), 1).alias("order"), F.col(text_col).alias("text"))
    known = rows.groupBy("lang").count().limit(MAX_LANGS + 1).collect()
    if len(known) > MAX_LANGS:
        raise ValueError(f"more than {MAX_LANGS} languages: is {lang_col} a label?")
    langs = sorted(r["lang"] for r in known)
    if len(langs) < 2:
        return fit(np.zeros((0, BUCKETS), np.float32), np.zeros(0, int), np.zeros(0, bool), langs)
    small_batches(labelled.sparkSession)
    each = max(1, train_rows // (3 * len(langs)))  # up to three histograms a row
    # some more of each language by the hash, so that few rows are ranked; the rank inside the language makes it a bound
    cut = F.coalesce(*(F.when(F.col("lang") == r["lang"], F.lit(min(1.0, (2 * each + 20) / r["count"]))) for r in known)) * float(1 << 63)
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("order", "text"))
    chosen = rows.where(F.col("order") < cut).withColumn("rank", rank).where(F.col("rank") <= each).drop("rank")
    picked = chosen.mapInArrow(train_histograms, "lang string, order long, at binary, h binary").orderBy("order", "lang", "at", "h").limit(train_rows).collect()
    x, number = np.zeros((len(picked), BUCKETS), np.float32), {v: i for i, v in enumerate(langs)}
    for i, r in enumerate(picked):
        x[i, np.frombuffer(r["at"], np.uint16)] = np.frombuffer(r["h"], np.float32)
    return fit(x, np.array([number[r["lang"]] for r in picked], int), np.array([r["order"] % 5 == 0 for r in picked], bool), langs)


def identify(docs: DataFrame, model: Model, text_col: str = "text", close: float = 0.2) -> DataFrame:
    """One row per row of docs: doc (a struct of its other columns), text, lang_pred, score, second, ambiguous.

    score is the chosen language's probability; ambiguous: the second one's is less than `close` below it. A null text, or
    one without a letter, is `und` with score 0 and not ambiguous, and so is every text if no language was learned. Only
    the text is looked at, whole and however long; repeated rows are judged alike, and of equally likely languages the
    first by name is chosen. No rows give no rows. Columns of docs lie in the struct, so names cannot clash.
    """
    small_batches(docs.sparkSession)
    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m: Model = held.value
        for b in pieces(batches):
            texts = b.column(1).to_pylist()
            judged = [i for i, t in enumerate(texts) if m.langs and t is not None and any(map(str.isalpha, t))]
            lang, score, second, close_by = [UND] * len(texts), np.zeros(len(texts)), [None] * len(texts), np.zeros(len(texts), bool)
            for first in range(0, len(judged), 256):
                own = judged[first : first + 256]
                p = m.decode(m.margins([t if len(t := normal(texts[i])) >= 3 else b"   " for i in own]))
                order = np.argsort(-p, axis=1, kind="stable")
                for i, row, o in zip(own, p, order, strict=True):
                    lang[i], score[i] = m.langs[o[0]], row[o[0]]
                    if len(o) > 1:
                        second[i], close_by[i] = m.langs[o[1]], row[o[0]] - row[o[1]] < close
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(lang), pa.array(score), pa.array(second, pa.string()), pa.array(close_by)], ["doc", "text", "lang_pred", "score", "second", "ambiguous"])

    others = [F.col(c) for c in docs.columns if c != text_col]
    rows = docs.select((F.struct(*others) if others else F.struct(F.lit(1).alias("none"))).alias("doc"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, T.StructType([rows.schema["doc"], T.StructField("text", T.StringType()), T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("second", T.StringType()), T.StructField("ambiguous", T.BooleanType())]))
