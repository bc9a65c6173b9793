"""Records of delimited files with line breaks inside quotes, without giving a file to one task.

A file is read in splits, each a run of whole lines. What a split does to the reader's state - outside or inside a quoted
field - is found for both states that it may begin in; composed over the splits before it, in the order of the file, that
tells in which state a split begins. Splits then cut their own records, and a record that crosses a border is put
together from the pieces that its splits have at their ends. Only files in which some line leaves a quote open go this
way, and only a row for each split, with those pieces, is shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tributary.sources.staging import materialize

#: The most bytes of a record; a quote that nobody closes would make the rest of its file one.
RECORD_BYTES = 16 << 20
_QUOTE = b'"'


def leaves_open(line: Column, sep: str) -> Column:
    """Whether a line that begins outside quotes ends inside: a field that begins with a quote has no odd run of quotes
    after it. Quotes elsewhere in a field are plain characters."""
    closes = lambda x: x.rlike('(^|[^"])"("")*([^"]|$)')
    step = lambda inside, x: F.when(inside, ~closes(x)).otherwise(F.startswith(x, F.lit('"')) & ~closes(F.substr(x, F.lit(2))))
    return F.contains(line, F.lit('"')) & F.aggregate(F.split(line, f"[{sep}]"), F.lit(False), step)


def ends_inside(line: bytes, inside: bool, sep: bytes) -> bool:
    """The state at a line's end, from the state at its beginning."""
    at = 0
    while True:
        if inside:
            at = line.find(_QUOTE, at)
            if at < 0:
                return True
            end = at
            while line[end : end + 1] == _QUOTE:
                end += 1
            inside, at = (end - at) % 2 == 0, end
            if inside:
                continue
        elif line[at : at + 1] == _QUOTE:
            inside, at = True, at + 1
            continue
        at = line.find(sep, at)
        if at < 0:
            return False
        at += 1


def fields(record: bytes, sep: bytes) -> list[bytes]:
    """A record's fields. A doubled quote inside quotes is one; what follows a closing quote belongs to the field."""
    if _QUOTE not in record:
        return record.split(sep)
    out, at = [], 0
    while True:
        text = b""
        if record[at : at + 1] == _QUOTE:
            at, n = at + 1, 0
            while n % 2 == 0 and (end := record.find(_QUOTE, at)) >= 0:
                n = 1
                while record[end + n : end + n + 1] == _QUOTE:
                    n += 1
                text, at = text + record[at:end] + _QUOTE * (n // 2), end + n
        cut = record.find(sep, at)
        if cut < 0:
            return [*out, text + record[at:]]
        out.append(text + record[at:cut])
        at = cut + 1


def parsed(records: list[bytes], files: list[int], sep: bytes) -> pa.RecordBatch:
    """Rows of arquivo, campos; blank records are left out."""
    kept = [(f, fields(r.removesuffix(b"\r"), sep)) for f, r in zip(files, records, strict=True) if r.strip(b" \t\r")]
    return pa.RecordBatch.from_arrays([pa.array([f for f, _ in kept], pa.int64()), pa.array([x for _, x in kept], pa.list_(pa.binary()))], ["arquivo", "campos"])


def parse_all(batches: Iterator[pa.RecordBatch], sep: bytes) -> Iterator[pa.RecordBatch]:
    for b in batches:
        yield parsed(b.column(1).to_pylist(), b.column(0).to_pylist(), sep)


def lines_of(spark: SparkSession, paths: list[str]) -> DataFrame:
    """arquivo (a hash of the path), bloco (where its split begins) and the line's bytes, in the order of the file."""
    return spark.read.option("lineSep", "\n").text(paths).select(F.xxhash64("_metadata.file_path").alias("arquivo"), F.col("_metadata.file_block_start").alias("bloco"), F.col("value").cast("binary").alias("linha"))


def splits(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[int, int], Iterator[bytes]]]:
    """A task's splits, one after the other: (arquivo, bloco) and their lines."""
    rows = (row for b in batches for row in zip(*(c.to_pylist() for c in b.columns), strict=True))
    for key, of in groupby(rows, key=lambda r: r[:2]):
        yield key, (r[2] for r in of)


class _Way:
    """Lines of a split read from one beginning state: what closes a record begun before, and what is open at the end."""

    def __init__(self, inside: bool, sep: bytes, most: int):
        self.inside, self.sep, self.most, self.first, self.open, self.size = inside, sep, most, None, [], 0
        self.leading = inside

    def feed(self, line: bytes) -> None:
        was, self.inside = self.inside, ends_inside(line, self.inside, self.sep) if self.inside or _QUOTE in line else False
        if was or self.inside:
            self.size += len(line) + 1
            if self.size <= self.most:
                self.open.append(line)
        if not self.inside:
            if self.leading:
                self.first, self.leading = self.text(), False
            self.open, self.size = [], 0

    def text(self) -> bytes | None:
        return None if self.size > self.most else b"\n".join(self.open)


def split_ends(batches: Iterator[pa.RecordBatch], sep: bytes, most: int) -> Iterator[pa.RecordBatch]:
    """A row for each split: for both states that it may begin in, the state at its end, the lines that close a record begun
    before it (all lines if none does) and those open at its end; null where they are longer than `most` bytes."""
    for (file, block), lines in splits(batches):
        out, inside = _Way(False, sep, most), _Way(True, sep, most)
        for line in lines:
            out.feed(line)
            inside.feed(line)
        ends = [w.text() if w.inside and not w.leading else b"" for w in (out, inside)]
        first = inside.text() if inside.leading else inside.first
        yield pa.RecordBatch.from_pydict({"arquivo": [file], "bloco": [block], "fora": [out.inside], "dentro": [inside.inside], "todo": [inside.leading], "inicio": [first], "fim_fora": [ends[0]], "fim_dentro": [ends[1]]}, SHAPE)


SHAPE = pa.schema([("arquivo", pa.int64()), ("bloco", pa.int64()), ("fora", pa.bool_()), ("dentro", pa.bool_()), ("todo", pa.bool_()), ("inicio", pa.binary()), ("fim_fora", pa.binary()), ("fim_dentro", pa.binary())])
_SHAPE_DDL = "arquivo long, bloco long, fora boolean, dentro boolean, todo boolean, inicio binary, fim_fora binary, fim_dentro binary"


def with_entry(ends: DataFrame) -> DataFrame:
    """ends with `entra`, whether a split begins inside quotes, and `sai`, whether it ends so.

    A split leads both states to one (constant), keeps them, or swaps them; so the state before a split is that of the
    last constant one, swapped as often as there are swaps after it. A window per file, of a row for each split."""
    before = Window.partitionBy("arquivo").orderBy("bloco").rowsBetween(Window.unboundedPreceding, -1)
    through = Window.partitionBy("arquivo").orderBy("bloco").rowsBetween(Window.unboundedPreceding, 0)
    swaps = F.sum(F.when(F.col("fora") & ~F.col("dentro"), 1).otherwise(0)).over(through)
    found = ends.withColumn("trocas", swaps).withColumn("fixo", F.when(F.col("fora") == F.col("dentro"), F.struct("fora", "trocas")))
    found = found.withColumn("ultimo", F.last("fixo", ignorenulls=True).over(before)).withColumn("trocas_antes", F.coalesce(F.lag("trocas").over(Window.partitionBy("arquivo").orderBy("bloco")), F.lit(0)))
    start, since = F.coalesce("ultimo.fora", F.lit(False)), (F.col("trocas_antes") - F.coalesce("ultimo.trocas", F.lit(0))) % 2 == 1
    return found.withColumn("entra", start != since).withColumn("sai", F.when(F.col("entra"), F.col("dentro")).otherwise(F.col("fora"))).drop("trocas", "fixo", "ultimo", "trocas_antes")


def crossing(ends: DataFrame) -> DataFrame:
    """Records that cross a border of splits: arquivo, registro (bytes). ends: see with_entry."""
    pieces = F.array_compact(F.array(
        F.when(F.col("entra"), F.struct(F.lit(0).alias("lado"), F.col("inicio").alias("texto"))),
        F.when(F.col("sai") & ~(F.col("entra") & F.col("todo")), F.struct(F.lit(1).alias("lado"), F.when(F.col("entra"), F.col("fim_dentro")).otherwise(F.col("fim_fora")).alias("texto"))),
    ))
    rows = ends.select("arquivo", "bloco", F.explode(pieces).alias("p")).select("arquivo", "bloco", "p.*")
    number = F.sum("lado").over(Window.partitionBy("arquivo").orderBy("bloco", "lado").rowsBetween(Window.unboundedPreceding, 0))
    parts = rows.withColumn("numero", number).groupBy("arquivo", "numero").agg(F.sort_array(F.collect_list(F.struct("bloco", "lado", "texto"))).alias("partes"))
    joined = F.aggregate(F.slice("partes", F.lit(2), F.size("partes")), F.element_at("partes", 1)["texto"], lambda all_, p: F.concat(all_, F.lit(b"\n"), p["texto"]))
    return parts.select("arquivo", joined.alias("registro"))


def own_records(batches: Iterator[pa.RecordBatch], sep: bytes, entry: dict, header: bool) -> Iterator[pa.RecordBatch]:
    """Records that begin and end in their split. entry: {arquivo: {bloco: whether it begins inside}}."""
    for (file, block), lines in splits(batches):
        if block not in entry.get(file, ()):
            raise RuntimeError("a file was split in another way than when its quotes were counted; read it again")
        skipping, head, held, out, size = entry[file][block], header and block == 0, [], [], 0
        for line in lines:
            if skipping:
                skipping = ends_inside(line, True, sep)
                continue
            if held or _QUOTE in line:
                held.append(line)
                if ends_inside(line, len(held) > 1, sep):
                    continue
                line, held = b"\n".join(held), []
            if head:
                head = False
                continue
            out.append(line)
            size += len(line)
            if size > 1 << 20:
                yield parsed(out, [file] * len(out), sep)
                out, size = [], 0
        if out:
            yield parsed(out, [file] * len(out), sep)


def files_with_breaks(spark: SparkSession, paths: list[str], sep: str) -> list[str]:
    """Those of the files in which some line leaves a quote open; one job, inside the JVM."""
    lines = spark.read.text(paths).select(F.col("_metadata.file_path").alias("arquivo"), leaves_open(F.col("value"), sep).alias("aberta"))
    return [r[0] for r in lines.where("aberta").groupBy("arquivo").count().collect()]  # a row per file


def quoted_records(spark: SparkSession, paths: list[str], sep: str, header: bool = True, most: int = RECORD_BYTES) -> DataFrame:
    """arquivo (xxhash64 of the path) and campos: each record's fields as bytes, line breaks inside quotes as in the file.

    Blank lines outside quotes are left out; so is each file's first record if header is set. A file that ends inside
    quotes is an error, as is a record that crosses splits and has more than `most` bytes. A carriage return before a
    record's end belongs to that end."""
    lines, mark = lines_of(spark, paths), sep.encode()
    ends = materialize(with_entry(lines.mapInArrow(lambda it: split_ends(it, mark, most), _SHAPE_DDL)), "split-ends")
    last = ends.groupBy("arquivo").agg(F.max_by("sai", "bloco").alias("sai")).where("sai")
    long = ends.where((F.col("entra") & F.col("inicio").isNull()) | (F.col("sai") & F.when(F.col("entra"), ~F.col("todo") & F.col("fim_dentro").isNull()).otherwise(F.col("fim_fora").isNull())))
    if last.limit(1).count():
        raise ValueError("a file ends inside a quoted field")
    if long.limit(1).count():
        raise ValueError(f"a record has more than {most} bytes")
    entry: dict[int, dict[int, bool]] = {}
    for r in ends.select("arquivo", "bloco", "entra").toLocalIterator():  # a row per split: the driver's own list of tasks is as long
        entry.setdefault(r[0], {})[r[1]] = r[2]
    shared = spark.sparkContext.broadcast(entry)
    rows = "arquivo long, campos array<binary>"
    own = lines.mapInArrow(lambda it: own_records(it, mark, shared.value, header), rows)
    return own.unionByName(crossing(ends).mapInArrow(lambda it: parse_all(it, mark), rows))
