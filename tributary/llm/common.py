"""Helpers shared by the corpus operators."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tributary.sources.staging import delete, materialize, scratch, shared_dir  # noqa: F401

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: bytes.translate table that lower-cases A-Z and nothing else.
LOWER_AZ = bytes.maketrans(UPPER.encode(), UPPER.lower().encode())
#: A word for the operators that split on ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


_ARROW_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
_GIVEN: set[str] = set()


def small_batches(spark: SparkSession, size: str = "2m") -> None:
    """Rows meet Python in Arrow batches of at most that size unless the session says otherwise: by rows alone, 10,000 long
    texts would stand in the executor and in its Python worker at once."""
    if spark.conf.get(_ARROW_BYTES, None) in (None, *_GIVEN):
        _GIVEN.add(size)
        spark.conf.set(_ARROW_BYTES, size)


#: Reserved names: a table that has both is taken for one with addresses.
FILE, AT = "__tributary_file", "__tributary_at"


def file_rows(docs: DataFrame) -> DataFrame:
    """docs with FILE and AT, a row's address: a hash of its file and its place there. It is the same whenever the files
    are read, on any cluster. docs must come straight from Parquet files: selected and filtered only. Own columns of those
    names are an error."""
    if {FILE, AT} & set(docs.columns):
        raise ValueError(f"{FILE} and {AT} are reserved names of columns")
    return docs.select("*", F.xxhash64("_metadata.file_path").alias(FILE), F.col("_metadata.row_index").alias(AT))


def addressed(docs: DataFrame, columns: dict[str, Column], name: str) -> DataFrame:
    """The columns with FILE and AT. A table that has no addresses is written first; addresses must be unique."""
    if {FILE, AT} <= set(docs.columns):
        return docs.select(*(c.alias(k) for k, c in columns.items()), FILE, AT)
    return file_rows(materialize(docs.select(*(c.alias(k) for k, c in columns.items())), name))


BROADCAST_BYTES = 64 << 20


def if_small(df: DataFrame, row_bytes: int, items: str | None = None, item_bytes: int = 0, most: int = BROADCAST_BYTES) -> DataFrame:
    """df for a broadcast if its counted rows and array items take at most `most` bytes; else as it is, for a shuffle."""
    rows, more = df.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.size(items)), F.lit(0)) if items else F.lit(0)).first()
    return F.broadcast(df) if rows * row_bytes + more * item_bytes <= most else df


def crc_mod(key: Column | str, n: int) -> Column:
    """crc32 of the key written as text, modulo n; a null key counts as 0."""
    key = F.col(key) if isinstance(key, str) else key
    return F.coalesce(F.crc32(key.cast("string").cast("binary")), F.lit(0)) % n


def lower_az(text: Column) -> Column:
    """A-Z in lower case and nothing else. Texts of ASCII only, whose characters are as many as their bytes, take the fast way."""
    return F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, UPPER.lower()))


def blob(text: Column | str) -> Column:
    """UTF-8 bytes of a text; null as empty. Python tasks get bytes and skip decoding."""
    text = F.col(text) if isinstance(text, str) else text
    return F.coalesce(text.cast("string"), F.lit("")).cast("binary")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pieces(batches, rows: int = 2048, most: int = 4 << 20):
    """Record batches of at most `rows` rows and about `most` bytes (one row at least): what a task holds as Python objects stays small."""
    for b in batches:
        first = 0
        while first < b.num_rows:
            n = min(rows, b.num_rows - first)
            while n > 1 and b.slice(first, n).nbytes > most:
                n = -(-n // 2)
            yield b.slice(first, n)
            first += n


def words_of(text: bytes) -> list[bytes]:
    """Lower-cased (A-Z) words between ASCII white space; bytes.split() cuts at exactly \\x20 and \\x09-\\x0D."""
    return text.translate(LOWER_AZ).split()


#: ASCII letters (lower case) and digits, and all of non-ASCII: the complement of the benchmark separators.
ALNUM_RUN = re.compile(rb"[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
