"""Near-duplicate detection: SetSketch bands find candidates, a joint likelihood screens them, full sets confirm them.

Copies with the same shingle set collapse to one representative before anything is paired. Only bands are kept of all
documents; registers and full sets are made again for those that share a bucket. Every bucket has a head, its most central
member, and the members of a head's buckets are its family. First each member is compared with the head alone (a star),
which connects a group of near copies without pairing it out. Only members that remain outside the head's component are
then compared with the whole family, block by block inside tasks, so that no link between different components is lost.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tributary.llm import setsketch as S
from tributary.llm.common import AT, FILE, addressed, blob, if_small, materialize, pieces, scratch, small_batches, words_of
from tributary.llm.components import connected_components

_MAX_CACHE = 1 << 16


class WordHashes(dict):
    """64-bit hashes of words; forgets all when full."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= _MAX_CACHE:
            self.clear()
        h = self[word] = xxhash.xxh64_intdigest(word)
        return h


def shingle_set(words: list[bytes], size: int, cache: WordHashes) -> np.ndarray:
    """Sorted distinct hashes of the runs of `size` words; of the whole sequence if it is shorter; none without words."""
    if not words:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(cache.__getitem__, words), np.uint64, len(words))
    n = min(size, len(words))
    x = np.full(len(h) - n + 1, n, np.uint64)
    for i in range(n):
        x = S.mix(x * np.uint64(0x9E3779B97F4A7C15) + h[i : len(h) - n + 1 + i])
    return np.unique(x)


def sketcher(size: int):
    """Bands of every text, or for wanted classes (a fourth column with their keys) what confirmation needs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = WordHashes()
        for b in pieces(batches):
            wanted = b.column(3).to_pylist() if b.num_columns > 3 else None
            low, sizes, keys, sets, own = np.full((b.num_rows, S.REGISTERS), 0xFFFFFFFF, np.uint32), [], [], [], []
            for i, text in enumerate(b.column(2).to_pylist()):
                s = shingle_set(words_of(text), size, cache)
                key = hashlib.blake2b(s.tobytes(), digest_size=16).digest()
                if wanted and key != wanted[i]:
                    continue
                if len(s):
                    low[len(own)] = S.minima(s)
                own.append(i)
                sizes.append(len(s))
                keys.append(key)
                if wanted:
                    sets.append(s.tobytes())
            regs = S.registers(low[: len(own)])
            ids, n = [b.column(i).take(pa.array(own, pa.int64())) for i in (0, 1)], pa.array(sizes, pa.int64())
            if wanted is None:
                bands = pa.ListArray.from_arrays(pa.array(np.arange(0, (len(own) + 1) * S.BANDS, S.BANDS, dtype=np.int32)), pa.array(S.band_keys(regs).ravel()))
                yield pa.RecordBatch.from_arrays([*ids, n, pa.array(keys, pa.binary()), bands], ["id", "row", "n", "key", "bands"])
            else:
                words = S.bits(regs)
                yield pa.RecordBatch.from_arrays(
                    [ids[1], n, pa.array([r.tobytes() for r in regs], pa.binary()), pa.array(sets, pa.binary()), *(pa.array(words[:, i]) for i in range(4))],
                    ["row", "n", "regs", "set", "s0", "s1", "s2", "s3"],
                )

    return run


def sketches(rows: DataFrame, size: int) -> DataFrame:
    """src (id and address), row, n, key and bands of rows(id, text, FILE, AT)."""
    rows = rows.select(F.struct("id", FILE, AT).alias("id"), F.monotonically_increasing_id().alias("row"), "text")
    fields = {"n": T.LongType(), "key": T.BinaryType(), "bands": T.ArrayType(T.LongType())}
    return rows.mapInArrow(sketcher(size), T.StructType([rows.schema["id"], rows.schema["row"], *(T.StructField(k, t) for k, t in fields.items())])).withColumnRenamed("id", "src")


def full_sets(rows: DataFrame, wanted: DataFrame, size: int) -> DataFrame:
    """Registers and sets of the classes wanted(FILE, AT, row, key), made again from the texts of their first documents.

    Rows are found by address; their texts are shuffled only if the list of wanted rows is too long for a broadcast. Nothing
    wanted, or no rows, give none.
    """
    texts = rows.select(FILE, AT, "text").join(if_small(wanted, 96), [FILE, AT]).select(F.lit(0).alias("id"), "row", "text", "key")
    return texts.mapInArrow(sketcher(size), "row long, n long, regs binary, set binary, s0 long, s1 long, s2 long, s3 long")


def confirmer(percent: int):
    """Keeps the pairs whose full sets reach the similarity; sketches whose likelihood estimate is far below it are not compared."""
    least = S.least_estimate(percent / 100)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces(batches, 1024):
            cols = {k: b.column(i) for i, k in enumerate(("a", "b", "n_a", "n_b", "regs_a", "regs_b", "set_a", "set_b"))}
            regs = [np.frombuffer(b"".join(cols[k].to_pylist()), np.uint16).reshape(-1, S.REGISTERS) for k in ("regs_a", "regs_b")]
            near = S.estimate(*regs, cols["n_a"].to_numpy().astype(float), cols["n_b"].to_numpy().astype(float)) >= least
            keep = []
            for i in np.flatnonzero(near).tolist():
                x, y = (np.frombuffer(cols[k][i].as_buffer(), np.uint64) for k in ("set_a", "set_b"))
                both = len(np.intersect1d(x, y, assume_unique=True))
                if 100 * both >= percent * (len(x) + len(y) - both):
                    keep.append(i)
            yield pa.RecordBatch.from_arrays([cols[k].take(pa.array(keep, pa.int64())) for k in ("a", "b")], ["a", "b"])

    return run


def confirmed(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) of rows that are links. A native test of sizes and of one bit per register goes first."""
    short = lambda s: nodes.select(F.col("row").alias(s), F.col("n").alias(f"n_{s}"), *(F.col(f"s{i}").alias(f"s{i}_{s}") for i in range(4)))
    full = lambda s: nodes.select(F.col("row").alias(s), F.col("regs").alias(f"regs_{s}"), F.col("set").alias(f"set_{s}"))
    apart = sum(F.bit_count(F.col(f"s{i}_a").bitwiseXOR(F.col(f"s{i}_b"))) for i in range(4))
    pairs = pairs.join(short("a"), "a").join(short("b"), "b").where(fits("n_a", "n_b", percent) & (apart <= S.most_bits_apart(percent / 100)))
    pairs = pairs.select("a", "b", "n_a", "n_b").join(full("a"), "a").join(full("b"), "b")
    return pairs.select("a", "b", "n_a", "n_b", "regs_a", "regs_b", "set_a", "set_b").mapInArrow(confirmer(percent), "a long, b long")


def fits(n_a: str, n_b: str, percent: int):
    """The sizes allow the similarity."""
    return (100 * F.least(n_a, n_b)) >= (percent * F.greatest(n_a, n_b))


def block_checker(percent: int):
    """Links between outsiders and members of one pair of blocks: for each outsider one link into each other component."""

    def run(rows: pa.Table) -> pa.Table:
        outside = rows["outsider"].to_numpy()
        ids, labels, sizes = (rows[k].to_numpy() for k in ("row", "label", "n"))
        sets = rows["set"].combine_chunks()
        own = np.flatnonzero(~outside)
        a, b = [], []
        if len(own) and outside.any():
            joined = np.frombuffer(b"".join(sets[i].as_py() for i in own.tolist()), np.uint64)
            words, at = np.unique(joined, return_inverse=True)
            begins = np.cumsum(sizes[own]) - sizes[own]
            marks = np.zeros(len(words), np.int64)
            for i in np.flatnonzero(outside).tolist():
                mine = np.frombuffer(sets[i].as_py(), np.uint64)
                k = np.minimum(np.searchsorted(words, mine), len(words) - 1)
                k = k[words[k] == mine]
                marks[k] = 1
                both = np.add.reduceat(marks[at], begins)
                marks[k] = 0
                near = own[(labels[own] != labels[i]) & (100 * both >= percent * (sizes[own] + sizes[i] - both))]
                for j in near[np.unique(labels[near], return_index=True)[1]].tolist():
                    a.append(ids[i])
                    b.append(ids[j])
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return run


def family_links(families: DataFrame, labels: DataFrame, nodes: DataFrame, percent: int, block: int = 256, block_words: int = 1 << 22) -> DataFrame:
    """Links (a, b) between different components within families(head, row): outsiders against all members, in blocks.

    A block has about `block` rows or block_words shingles, whichever is fewer rows; one larger set is a block by itself. No
    families, or families of one component each, give no links.
    """
    named = labels.withColumnRenamed("node", "row")
    rows = families.join(named, "row", "left").withColumn("label", F.coalesce("label", "row")).join(nodes.select("row", "n"), "row")
    heads = named.select(F.col("row").alias("head"), F.col("label").alias("head_label"))
    rows = materialize(rows.join(heads, "head", "left").withColumn("outsider", F.col("label") != F.coalesce("head_label", "head")).drop("head_label"), "families")
    outside = lambda c: F.sum(F.when(F.col("outsider"), c))
    counts = rows.groupBy("head").agg(F.count(F.lit(1)).alias("members"), F.sum("n").alias("words"), outside(F.lit(1)).alias("outsiders"), outside(F.col("n")).alias("outside_words")).where("members > 2 and outsiders > 0")
    blocks = lambda c, n: F.ceil(F.greatest(F.col(c) / block, F.col(n) / block_words)).cast("int")
    # Written before the join: a head with very many members can then be split among tasks.
    counts = materialize(counts.select("head", blocks("members", "words").alias("js"), blocks("outsiders", "outside_words").alias("is")), "blocks")
    rows = rows.join(counts, "head")
    i, j = F.pmod(F.hash("row", F.lit(1)), F.col("is")), F.pmod(F.hash("row"), F.col("js"))
    all_of = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    members = rows.select("head", all_of("is").alias("i"), j.alias("j"), F.lit(False).alias("outsider"), "row", "label")
    outsiders = rows.where("outsider").select("head", i.alias("i"), all_of("js").alias("j"), F.lit(True).alias("outsider"), "row", "label")
    tasks = members.unionByName(outsiders).join(nodes.select("row", "n", "set"), "row")
    return tasks.groupBy("head", "i", "j").applyInArrow(block_checker(percent), "a long, b long")


def near_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 5, percent: int = 80) -> DataFrame:
    """One row per row of docs: id_col, n_shingles, component_id, kept.

    Sets are the distinct runs of `size` words (A-Z lower-cased, split at ASCII white space); a text with fewer words is
    one run. Two rows are linked when 100 * intersection >= percent * union, found with a probability of 1 - 5e-6 or more
    at a threshold of 80 and more above it; lower thresholds are refused. component_id is the least id that can be
    reached. Null and empty texts have no shingles and are linked with nothing; a row with a null id links nothing and has
    component_id null and kept true. Repeated ids with different texts are separate rows. A very long text is one set in
    one task. Other columns are not read; no rows give no rows.
    """
    if not 80 <= percent <= 100:
        raise ValueError("percent must be between 80 and 100: the bands are made for such pairs")
    small_batches(docs.sparkSession)
    with scratch():
        rows = addressed(docs, {"id": F.col(id_col), "text": blob(text_col)}, "texts")
        sk = materialize(sketches(rows, size), "sketches")
        linked = (F.col("n") > 0) & F.col("src.id").isNotNull()
        classes = sk.where(linked).groupBy("key").agg(F.min(F.struct("src.id", "row", f"src.{FILE}", f"src.{AT}")).alias("first"))
        classes = materialize(classes.select("key", "first.*"), "classes")
        bands = sk.select("row", "bands").join(classes.select("row"), "row", "left_semi").select("row", F.explode("bands").alias("band"))
        # Each grouped table is written before its rows are joined with it: very large buckets can then be split among tasks.
        buckets = materialize(bands.groupBy("band").agg(F.count(F.lit(1)).alias("members")).where("members > 1"), "buckets")
        members = materialize(bands.join(buckets, "band"), "members")
        # The head is the member with the most company over all its buckets: in a group of near copies one close to their origin.
        company = materialize(members.groupBy("row").agg(F.sum("members").alias("company")), "company")
        heads = materialize(members.join(company, "row").groupBy("band").agg(F.max_by("row", F.struct("company", "row")).alias("head")), "heads")
        families = materialize(members.join(heads, "band").select("head", "row").distinct(), "stars")
        nodes = materialize(full_sets(rows, classes.join(company.select("row"), "row").select(FILE, AT, "row", "key"), size), "sets")

        star = confirmed(families.where("head != row").select(F.col("head").alias("a"), F.col("row").alias("b")), nodes, percent)
        links = materialize(star, "links")
        more = family_links(families, connected_components(links), nodes, percent)
        labels = connected_components(materialize(links.unionByName(more), "links"))

        placed = classes.join(labels.withColumnRenamed("node", "row"), "row", "left").withColumn("label", F.coalesce("label", "row"))
        least = materialize(placed.groupBy("label").agg(F.min("id").alias("component_id")), "least")
        placed = materialize(placed.join(least, "label").select("key", "component_id"), "placed")
        out = sk.select("src.id", "n", "key").join(placed, "key", "left")
        component = F.when((F.col("n") > 0) & F.col("id").isNotNull(), F.col("component_id")).otherwise(F.col("id"))
        out = materialize(out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), component.alias("component_id")), "near", stays=True)
    return out.withColumn("kept", F.col(id_col).eqNullSafe(F.col("component_id")))
