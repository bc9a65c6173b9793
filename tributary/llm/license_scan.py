"""Licence scan: a trained classifier of paragraphs, with templates to confirm what it says.

Sparse multinomial logistic regression on hashed word unigrams and bigrams tells the licence families and one unknown
class apart. It learns from varied templates and, for the unknown class, from paragraphs of the corpus; its probabilities
are calibrated by a temperature on varied templates kept aside, and below `threshold` a paragraph is unknown. A prediction
counts once the paragraph and a template of the family share enough of their bigrams.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tributary.llm.common import ALNUM_RUN, LOWER_AZ, blob, pieces, small_batches
from tributary.llm.license_templates import NEAR_MISSES, TEMPLATES

BITS = 16
TRAIN_PARAGRAPHS = 2000
LONG, STEP = 24, 8  # paragraphs of over LONG words are looked at in windows of 2 * STEP words, one every STEP words
VARIANTS = 24
UNKNOWN = "unknown"


class WordCodes(dict):
    """32-bit hashes of words; forgets all when full."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 1 << 16:
            self.clear()
        h = self[word] = xxhash.xxh32_intdigest(word)
        return h


def words_in(paragraph: bytes) -> list[bytes]:
    return ALNUM_RUN.findall(paragraph.translate(LOWER_AZ))


def features(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the unigrams and of the bigrams (the last word has none)."""
    one = (codes * np.uint32(2654435761)) >> np.uint32(32 - BITS)
    two = ((codes[:-1] * np.uint32(40503) ^ (codes[1:] * np.uint32(2246822519) >> np.uint32(3))) * np.uint32(3266489917)) >> np.uint32(32 - BITS)
    return one.astype(np.int64), two.astype(np.int64)


def bigrams(words: list[bytes]) -> set:
    return set(zip(words, words[1:], strict=False)) or {(w,) for w in words}


class Scanner:
    """families[0] is the unknown class."""

    def __init__(self, corpus: list[list[bytes]], templates: dict[str, list[str]] = TEMPLATES, threshold: float = 0.5, confirm: float = 0.6, seed: int = 11):
        self.families = [UNKNOWN, *sorted(templates)]
        self.threshold, self.confirm = threshold, confirm
        self.templates = {f: [bigrams(words_in(t.encode())) for t in templates[f]] for f in self.families[1:]}
        self.codes = WordCodes()
        rng = np.random.default_rng(seed)
        rows: list[tuple[list[bytes], int]] = []
        for label, f in enumerate(self.families[1:], 1):
            for t in templates[f]:
                base = words_in(t.encode())
                rows += [(base, label)] + [(self._varied(base, corpus, rng), label) for _ in range(VARIANTS)]
                rows += [(list(rng.permutation(np.array(base, object))), 0)] * (len(base) > 8)
        rows += [(words_in(t.encode()), 0) for t in NEAR_MISSES for _ in range(4)]
        every = [s for f in self.templates.values() for s in f]
        rows += [(w, 0) for w in corpus if w and not any(self.alike(bigrams(w), s) >= 0.4 for s in every)]
        self._train([(self._features(w), y) for w, y in rows if w], rng)

    def __getstate__(self) -> dict:
        return {**self.__dict__, "codes": WordCodes()}

    @staticmethod
    def _varied(base: list[bytes], corpus: list[list[bytes]], rng: np.random.Generator) -> list[bytes]:
        """Some words dropped, of a long template often a window only, a few words of the corpus before and after."""
        kept = [w for w in base if len(base) < 8 or rng.random() > 0.08]
        if len(kept) > LONG and rng.random() < 0.6:
            at = int(rng.integers(len(kept) - 2 * STEP + 1))
            return kept[at : at + 2 * STEP]
        extra = corpus[rng.integers(len(corpus))] if corpus else []
        a, b = (int(x) for x in rng.integers(0, 6, 2))
        return [*extra[:a], *kept, *extra[a : a + b]]

    def _features(self, words: list[bytes]) -> np.ndarray:
        one, two = features(np.fromiter(map(self.codes.__getitem__, words), np.uint32, len(words)))
        return np.concatenate([one, two])

    def _train(self, rows: list[tuple[np.ndarray, int]], rng: np.random.Generator, epochs: int = 12) -> None:
        self.w, self.b = np.zeros((1 << BITS, len(self.families)), np.float32), np.zeros(len(self.families), np.float32)
        seen = np.full(self.w.shape[0], 1e-2, np.float32)
        order = rng.permutation(len(rows))
        aside, train = order[: len(rows) // 5], order[len(rows) // 5 :]
        self.temperature = 1.0
        for _ in range(epochs):
            for i in rng.permutation(train):
                at, y = rows[i]
                p = self.probabilities(self.logits_of(at)[None])[0]
                p[y] -= 1
                at = np.unique(at)
                g = (p / np.sqrt(len(at))).astype(np.float32)
                seen[at] += (g * g).sum()
                self.w[at] -= 0.5 * g[None] / np.sqrt(seen[at])[:, None]
                self.b -= 0.02 * p.astype(np.float32)
        logits, y = np.array([self.logits_of(rows[i][0]) for i in aside]), np.array([rows[i][1] for i in aside])

        def loss(t: float) -> float:
            self.temperature = t
            return -np.log(self.probabilities(logits)[np.arange(len(y)), y] + 1e-12).mean()

        self.temperature = min(np.geomspace(0.25, 8, 21), key=loss) if len(y) else 1.0

    def logits_of(self, at: np.ndarray) -> np.ndarray:
        return self.w[at].sum(axis=0) / np.sqrt(len(at)) + self.b

    def probabilities(self, logits: np.ndarray) -> np.ndarray:
        z = logits / self.temperature
        z = np.exp(z - z.max(axis=1, keepdims=True))
        return z / z.sum(axis=1, keepdims=True)

    @staticmethod
    def alike(a: set, b: set) -> float:
        """The part of the smaller set that both share."""
        return len(a & b) / max(1, min(len(a), len(b)))

    def scan(self, text: bytes) -> list[tuple[int, str, float, float, bool]]:
        """(paragraph, family, probability, likeness, confirmed) for each family that a paragraph is given to, unknown aside."""
        pieces: list[tuple[int, list[bytes]]] = []
        for k, line in enumerate(text.split(b"\n")):
            words = words_in(line)
            if len(words) > LONG:
                pieces += [(k, words[i : i + 2 * STEP]) for i in range(0, len(words) - STEP, STEP)]
            elif words:
                pieces.append((k, words))
        found: dict[tuple[int, str], tuple[int, str, float, float, bool]] = {}
        for first in range(0, len(pieces), 512):
            part = pieces[first : first + 512]
            sizes = np.array([len(w) for _, w in part])
            ends = np.cumsum(sizes)
            every = [w for _, ws in part for w in ws]
            one, two = features(np.fromiter(map(self.codes.__getitem__, every), np.uint32, len(every)))
            value = self.w[one]
            inner = np.ones(len(every) - 1, bool)
            inner[ends[:-1] - 1] = False  # no bigram goes from one piece to the next
            value[:-1][inner] += self.w[two[inner]]
            p = self.probabilities(np.add.reduceat(value, ends - sizes, axis=0) / np.sqrt(2 * sizes - 1)[:, None] + self.b)
            best = p.argmax(axis=1)
            for i in np.flatnonzero((best > 0) & (p.max(axis=1) >= self.threshold)).tolist():
                k, words = part[i]
                family, own = self.families[best[i]], bigrams(words)
                like = max(self.alike(own, t) for t in self.templates[family])
                new = (k, family, float(p[i, best[i]]), like, like >= self.confirm)
                at = (k, family)
                if at not in found or (new[4], new[2]) > (found[at][4], found[at][2]):
                    found[at] = new
        return [found[k] for k in sorted(found)]


def corpus_paragraphs(docs: DataFrame, text_col: str, rows: int) -> list[list[bytes]]:
    """At most `rows` paragraphs (a documented bound), picked from all documents by a hash of the paragraph, whatever its
    length; of one with more than LONG words a window somewhere in it, as the scan looks at it.

    The paragraphs are counted first, so that about twice as many as wanted pass the hash and no task sends more.
    """
    text = F.col(text_col).cast("string")
    total = docs.agg(F.coalesce(F.sum(F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit(""))) + 1), F.lit(0))).first()[0]
    cut = min(1.0, 2 * rows / max(1, total)) * float(1 << 63)
    lines = docs.select(F.explode(F.split(text, "\n")).alias("line")).where(F.length("line") > 0)
    picked = lines.withColumn("order", F.shiftrightunsigned(F.xxhash64("line", F.lit("licence")), 1)).where(F.col("order") < cut)
    words = F.regexp_extract_all("line", F.lit(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"), F.lit(0))
    picked = picked.select("order", words.alias("words"))
    at = F.pmod(F.col("order"), F.greatest(F.size("words") - 2 * STEP + 1, F.lit(1))).cast("int")
    window = F.when(F.size("words") > LONG, F.slice("words", at + 1, F.lit(2 * STEP))).otherwise(F.col("words"))
    picked = picked.select("order", F.array_join(window, " ").alias("line")).distinct().orderBy("order", "line").limit(rows).collect()
    return [words_in(r["line"].encode()) for r in picked]


def license_scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", train_paragraphs: int = TRAIN_PARAGRAPHS, scanner: Scanner | None = None) -> DataFrame:
    """One row per row of docs: id_col, n_paragraphs, notices.

    notices: array of (paragraph, family, probability, likeness, confirmed), one for each family that the
    classifier gives a paragraph (line) or a window of it to; confirmed if a template of it agrees. Null and empty texts have no notices; long lines are
    looked at in overlapping windows, all of them, however long the text; of equally sure windows of a family the first
    counts; repeated rows are scanned each; null ids are kept. Other columns are not read; no rows give no rows.
    """
    small_batches(docs.sparkSession)
    held = docs.sparkSession.sparkContext.broadcast(scanner or Scanner(corpus_paragraphs(docs, text_col, train_paragraphs)))
    rows = docs.select(F.col(id_col).alias("id"), blob(text_col).alias("text"))
    kind = "array<struct<paragraph:bigint,family:string,probability:double,likeness:double,confirmed:boolean>>"
    fields = ("paragraph", "family", "probability", "likeness", "confirmed")
    arrow = pa.list_(pa.struct([("paragraph", pa.int64()), ("family", pa.string()), ("probability", pa.float64()), ("likeness", pa.float64()), ("confirmed", pa.bool_())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s: Scanner = held.value
        for b in pieces(batches):
            texts = b.column(1).to_pylist()
            found = [[dict(zip(fields, x, strict=True)) for x in s.scan(t)] for t in texts]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([t.count(b"\n") + 1 if t else 0 for t in texts], pa.int64()), pa.array(found, arrow)], ["id", "n_paragraphs", "notices"])

    schema = docs.sparkSession.createDataFrame([], f"n_paragraphs bigint, notices {kind}").schema
    out = rows.mapInArrow(run, type(schema)([rows.schema["id"], *schema.fields]))
    return out.select(F.col("id").alias(id_col), "n_paragraphs", "notices")
