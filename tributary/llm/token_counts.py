"""Token counts of whole texts with a tokenizer of the `tokenizers` library; only lengths leave the tasks.

The vocabulary file is read once, on the driver, and broadcast (its size is checked), so that executors need no copy of it.
Tasks take their texts in Arrow batches bounded by bytes. A text above PIECE_CHARS is cut into pieces where no token can
reach across, and pieces are counted together in groups of about CALL_BYTES, whatever number of rows that is: neither a
long text nor a batch of long texts makes a group large, and short texts share groups. A group is cut further into words
at the same places; of its distinct words those that the worker does not know yet go to the library in one batch, so that
a frequent word is encoded once. A text's count is the sum over its words, equal to that of the whole text.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tributary.llm.common import small_batches

#: Characters after which a text is cut, bytes of texts that are counted together, bytes of a vocabulary file.
PIECE_CHARS, CALL_BYTES, VOCABULARY_BYTES = 1 << 16, 1 << 18, 64 << 20
#: A worker remembers the counts of so many words, twice, of at most so many characters each.
REMEMBERED, SHORT = 1 << 18, 48
#: No token crosses these places: before white space that a word follows, and between an ideograph or kana and full-width punctuation.
WORD_AHEAD = re.compile(r"(?=[ \t\n\r]\w)")
SAFE = re.compile(r"(?=[ \t\n\r]\w)|(?<=[ぁ-ヿ㐀-鿿])(?=[、。，！？：；])")


def may_cut(vocabulary: str) -> bool:
    """Whether SAFE holds for a tokenizer: byte-level merges inside words, and added tokens that are matched as they stand
    and have no white space or full-width punctuation in them."""
    spec = json.loads(vocabulary)
    kinds = [spec.get("pre_tokenizer") or {}, *(spec.get("pre_tokenizer") or {}).get("pretokenizers", [])]
    plain = all(not any(t[k] for k in ("single_word", "lstrip", "rstrip", "normalized")) and not re.search(r"[\s、。，！？：；]", t["content"]) for t in spec["added_tokens"])
    return plain and spec["model"]["type"] == "BPE" and any(k.get("type") == "ByteLevel" and not k["add_prefix_space"] for k in kinds)


def safe_pieces(text: str, most: int = PIECE_CHARS) -> Iterator[str]:
    """The text in pieces that end at the first safe place after `most` characters; what has none stays in one piece."""
    first = 0
    while len(text) - first > most and (cut := SAFE.search(text, first + most)):
        yield text[first : cut.start()]
        first = cut.start()
    yield text[first:]


def groups(texts: list[str], most: int, call: int) -> Iterator[list[tuple[int, str]]]:
    """Pieces with their text's place in the list, about `call` bytes (one piece at least) in each group."""
    held, size = [], 0
    for i, text in enumerate(texts):
        for p in safe_pieces(text, most):
            held.append((i, p))
            size += len(p.encode("utf-8", "surrogatepass"))
            if size >= call:
                yield held
                held, size = [], 0
    if held:
        yield held


class Words:
    """Counts of words that a worker has met, in two generations: when the recent one is full, it becomes the older one and
    the one before is forgotten. A word that is met again is kept."""

    def __init__(self, most: int = REMEMBERED):
        self.most, self.recent, self.older = most, {}, {}

    def learn(self, words: set[str], tokenizer) -> list[str]:
        """Makes `recent` know all words; returns those that the library had to encode, in one batch."""
        missing = words - self.recent.keys()
        again = missing & self.older.keys()
        self.recent.update((w, self.older[w]) for w in again)
        new = list(missing - again)
        self.recent.update(zip(new, map(len, tokenizer.encode_batch_fast(new, add_special_tokens=False)), strict=True))
        return new

    def forget(self, new: list[str]) -> None:
        for w in new:
            if len(w) > SHORT:
                del self.recent[w]
        if len(self.recent) > self.most:
            self.recent, self.older = {}, self.recent


def lengths(texts: list[str], tokenizer, known: Words | None, most: int = PIECE_CHARS, call: int = CALL_BYTES) -> list[int]:
    """Tokens of each text. known: counts of words so far; None: texts are not cut at all."""
    counts = [0] * len(texts)
    if known is None:
        for group in groups(texts, max(map(len, texts), default=0), call):
            for (i, _), e in zip(group, tokenizer.encode_batch_fast([p for _, p in group], add_special_tokens=False), strict=True):
                counts[i] += len(e)
        return counts
    for group in groups(texts, most, call):
        words = [(i, WORD_AHEAD.split(p)) for i, p in group]
        new = known.learn(set().union(*(w for _, w in words)), tokenizer)
        for i, w in words:
            counts[i] += sum(map(known.recent.__getitem__, w))
        known.forget(new)
    return counts


#: Of a worker, which serves many tasks: the last tokenizer, by the digest of its file, and the words counted with it.
_LAST: dict[str, tuple] = {}


def loaded(vocabulary: str, digest: str, cut: bool) -> tuple:
    """The tokenizer, without truncation and padding, and the words that this worker knows."""
    if digest not in _LAST:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks share the cores already
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_str(vocabulary)
        tokenizer.no_truncation()
        tokenizer.no_padding()
        _LAST.clear()
        _LAST[digest] = tokenizer, Words() if cut else None
    return _LAST[digest]


def vocabulary_text(spark: SparkSession, path: str) -> str:
    """The file at a local path of the driver, or at any path that Spark reads."""
    if os.path.exists(path):
        if os.path.getsize(path) > VOCABULARY_BYTES:
            raise ValueError(f"{path} has more than {VOCABULARY_BYTES} bytes")
        with open(path, encoding="utf-8") as f:
            return f.read()
    found = spark.read.format("binaryFile").load(path).where(F.col("length") <= VOCABULARY_BYTES).select("content").collect()  # one file of a bounded size
    if len(found) != 1:
        raise ValueError(f"{path} is no single file of at most {VOCABULARY_BYTES} bytes")
    return bytes(found[0][0]).decode()


def token_counts(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", limit: int = 2048) -> DataFrame:
    """One row per row of docs: id_col, n_bytes (of the text in UTF-8), n_tokens, over_limit (n_tokens > limit).

    path: a .json file of the tokenizers library; other kinds are refused. Tokens are what it gives for the whole text
    without tokens around it; special strings inside a text are special tokens, as is its default. Truncation and padding
    that the file may set are off. A null text counts as empty and has no tokens. Ids are passed on as they are: null and
    repeated ones too, a row each. Very long texts are counted whole. Other columns of docs are not read, whatever their
    names. An empty table gives an empty result.
    """
    if not path.endswith(".json"):
        raise ValueError(f"{path}: a .json file of the tokenizers library is needed")
    spark = docs.sparkSession
    small_batches(spark)
    vocabulary = vocabulary_text(spark, path)
    cut, digest, shared = may_cut(vocabulary), hashlib.sha256(vocabulary.encode()).hexdigest(), spark.sparkContext.broadcast(vocabulary)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer, known = loaded(shared.value, digest, cut)
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(lengths(b.column(2).to_pylist(), tokenizer, known), pa.int64())], ["id", "n_bytes", "n_tokens"])

    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).alias("id"), F.octet_length(text).cast("long").alias("n_bytes"), text.alias("text"))
    schema = T.StructType([rows.schema["id"], T.StructField("n_bytes", T.LongType()), T.StructField("n_tokens", T.LongType())])
    return rows.mapInArrow(count, schema).select(F.col("id").alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
