"""From raw documents to a training mixture: five stages, each a call of one corpus operator.

Every stage takes (spark, docs, sf_dir) and returns the documents that it keeps, with the columns of documents; the last
adds epoch (0, 1, ...: the document's repeats) and words (how many of its words that repeat gives). What a stage writes
for itself into the shared folder is deleted by the first later stage whose input does not read it: at once where results
are written and read again, as run() does, and when the application ends where stages are composed lazily.

All stages: a table without rows gives none; repeated rows are documents of their own, each judged by itself unless the
stage is about repeats; null and empty texts and very long ones are ordinary rows, read whole; documents may have further
columns of any name, which stay as they are (but for the last stage's own two), and may lack n_chars.
"""

from __future__ import annotations

import threading
from functools import wraps

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tributary.llm.common import AT, FILE, addressed, delete, file_rows, if_small, materialize, scratch, table
from tributary.llm.decontaminate import decontaminate
from tributary.llm.lang_id import UND, identify, train_model
from tributary.llm.line_dedup import line_dedup
from tributary.llm.mix_sources import epochs_of, first_words, mix_sources
from tributary.llm.near_dedup import near_dedup

NEAR_WORDS, NEAR_PERCENT = 5, 80
_LEFT = threading.local()


def unread(left: list, docs: DataFrame) -> list:
    """Takes those tables out of the list that docs do not read any more."""
    read = {part for f in docs.inputFiles() for part in f.split("/")} if left else set()
    done = [t for t in left if t[1].rstrip("/").rsplit("/", 1)[1] not in read]
    left[:] = [t for t in left if t not in done]
    return done


def stage(f):
    """Deletes what stages before have left in the shared folder and docs don't need, and keeps account of what this one leaves."""

    @wraps(f)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        delete(unread(_LEFT.__dict__.setdefault("tables", []), docs))
        with scratch() as own:
            out = f(spark, docs, sf_dir)
            _LEFT.tables.extend(own)
            own.clear()
        return out

    return run_stage


def with_addresses(docs: DataFrame) -> DataFrame:
    """docs with the addresses of its rows; a table that doesn't come straight from files is written first."""
    try:
        return file_rows(docs)
    except AnalysisException:
        return addressed(docs, {c: F.col(f"`{c}`") for c in docs.columns}, "docs")


def columns_of(docs: DataFrame, struct: str, skip: tuple[str, ...] = (), **changed) -> list:
    return [(changed[c] if c in changed else F.col(f"{struct}.`{c}`")).alias(c) for c in docs.columns if c not in skip]


def chars(docs: DataFrame, changed, text) -> dict:
    """n_chars where the text has changed, if documents have it."""
    return {"n_chars": F.when(changed, F.length(text).cast("long")).otherwise(F.col("doc.n_chars"))} if "n_chars" in docs.columns else {}


@stage
def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without a recognisable language (null, or no letter) go. Missing labels are filled in; ambiguous texts stay."""
    model = train_model(docs, F.col("doc_id"), "lang", "text")
    known = identify(docs, model).where(F.col("lang_pred") != UND)
    return known.select(columns_of(docs, "doc", text=F.col("text"), lang=F.coalesce("doc.lang", "lang_pred")))


@stage
def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages and chunks of lines that an earlier document (by doc_id, null last) has go; so do documents that held
    nothing else. Of repeated rows the first keeps its text."""
    done = line_dedup(with_addresses(docs))
    gone = F.col("lines_removed") > 0
    return done.where(~gone | (F.length(F.trim("text")) > 0)).select(columns_of(docs, "doc", text=F.col("text"), **chars(docs, gone, F.col("text"))))


@stage
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays: the one with the least doc_id (null last; of repeated ids the
    first in storage order). Null and empty texts, which are like nothing, stay."""
    rows = with_addresses(docs)
    name = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", FILE, AT)
    near = near_dedup(rows.select(name.alias("doc_id"), "text", FILE, AT), size=NEAR_WORDS, percent=NEAR_PERCENT)
    copies = near.where("not kept").select(f"doc_id.{FILE}", f"doc_id.{AT}")
    return rows.join(if_small(copies, 48), [FILE, AT], "left_anti").select(*(F.col(f"`{c}`") for c in docs.columns))


@stage
def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Contaminated documents go. The others lose benchmark passages over the operator's limit of words, if they have any."""
    judged = decontaminate(docs, table(spark, sf_dir, "benchmark")).where(~F.col("contaminated"))
    cut = F.col("n_removed") > 0
    return judged.select(columns_of(docs, "doc", text=F.when(cut, F.col("clean_text")).otherwise(F.col("text")), **chars(docs, cut, F.col("clean_text"))))


@stage
def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the target weights take them; the one at a source's cut gives its first words, and documents
    without words nothing. Own columns named epoch and words are replaced."""
    taken = epochs_of(mix_sources(with_addresses(docs), whole=True))
    cut = F.col("words") < F.col("size")
    text = F.when(cut, first_words(F.col("doc.text"), F.col("words"))).otherwise(F.col("doc.text"))
    own = columns_of(docs, "doc", ("epoch", "words"), text=text, **chars(docs, cut, text))
    return taken.select(*own, F.col("epoch").cast("long").alias("epoch"), F.col("words").cast("long").alias("words"))


STAGES = [("language", language), ("lines", lines), ("near_duplicates", near_duplicates), ("benchmark", benchmark), ("mixture", mixture)]

#: SQL cannot express the learned and the sketched stages; tests/llm compares each with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages one after the other; each result is written and read again, and deleted once the next one is written."""
    docs, before = table(spark, sf_dir, "documents"), []
    for name, one in STAGES[:-1]:
        with scratch() as own:
            docs = materialize(one(spark, docs, sf_dir), f"stage-{name}")
            delete(before)
            before = own[:]
            own.clear()
    return STAGES[-1][1](spark, docs, sf_dir)
