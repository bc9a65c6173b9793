"""Delimited files whose separator, encoding and header differ from file to file."""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tributary.functions.text import CSV_MISSING, file_state, path_part
from tributary.operators.projections import slug, unify
from tributary.sources.records import files_with_breaks, quoted_records
from tributary.sources.staging import materialize

#: Lines are judged by all of their fields, so the parser must not leave out those that nobody reads.
_EXTRA, _BAD = "_extra", "_corrupt_record"
#: What a ledger's rows get from their file.
LINEAGE = ("ano", "trimestre", "uf", "arquivo_origem")


def listed(spark: SparkSession, folder: str, pattern: str = "*") -> DataFrame:
    """arquivo (path), nome and tamanho of the files below a folder that have any bytes; contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(folder)
    return files.select(F.col("path").alias("arquivo"), F.element_at(F.split("path", "/"), -1).alias("nome"), F.col("length").alias("tamanho")).where("tamanho > 0")


def open_stream(path: str):
    """A seekable stream of a file that Python reaches: local and mounted folders, and what pyarrow has a file system for."""
    from pyarrow import fs

    found, inside = fs.FileSystem.from_uri(re.sub("^file:/+", "file:///", path))
    return found.open_input_file(inside)


def reached_by_python(path: str) -> bool:
    try:
        open_stream(path).close()
    except Exception:  # noqa: BLE001  whatever a file system raises: Spark's own readers are used then
        return False
    return True


def heads(batches, most: int):
    """The first `most` bytes of each file, which is not read any further."""
    for b in batches:
        for path, size in zip(*(c.to_pylist() for c in b.columns), strict=True):
            with open_stream(path) as f:
                head = f.read_at(min(most, size), 0)
            yield pa.RecordBatch.from_arrays([pa.array([path]), pa.array([head], pa.binary())], ["arquivo", "inicio"])


HEAD_BYTES = 1 << 20
#: Files that one task looks at.
FILES_A_TASK = 64


def first_bytes(files: DataFrame, most: int = HEAD_BYTES) -> DataFrame:
    """arquivo, inicio: the first bytes of each of the listed files, read by as many tasks as there are groups of files."""
    n = files.count()
    return files.select("arquivo", "tamanho").repartition(max(1, -(-n // FILES_A_TASK))).mapInArrow(lambda it: heads(it, most), "arquivo string, inicio binary")


def head_facts(spark: SparkSession, files: DataFrame, folder: str, pattern: str, most: int = HEAD_BYTES) -> DataFrame:
    """arquivo, primeira (the first line's bytes), utf8. Where Python does not reach the store, Spark reads the files whole."""
    one = files.select("arquivo").first()
    if one is None or reached_by_python(one[0]):
        # Bytes at the end may be a part of a character, so up to three are not judged where the file goes on.
        begun = r"[\xC0-\xFF][\x80-\xBF]{0,2}$"
        text = F.decode("inicio", "ISO-8859-1")
        whole = F.when(F.octet_length("inicio") < most, F.col("inicio")).otherwise(F.encode(F.regexp_replace(text, begun, ""), "ISO-8859-1"))
        return first_bytes(files, most).select("arquivo", F.encode(F.regexp_extract(text, r"^[^\r\n]*", 0), "ISO-8859-1").alias("primeira"), F.is_valid_utf8(whole.cast("string")).alias("utf8"))
    lines = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).text(folder).select("value", F.col("_metadata.file_path").alias("arquivo"), F.struct(F.col("_metadata.file_block_start"), F.monotonically_increasing_id()).alias("at"))
    return lines.groupBy("arquivo").agg(F.min_by("value", "at").cast("binary").alias("primeira"), F.bool_and(F.is_valid_utf8("value")).alias("utf8"))


def probe(spark: SparkSession, folder: str, pattern: str = "*.[cC][sS][vV]", years: tuple[int, ...] | None = None) -> DataFrame:
    """One row per file: arquivo, nome, ano, trimestre, uf, cabecalho (first line), separador, codificacao, colunas.

    Tasks read the first mebibyte of their files. Files without ano=/trimestre= in their path, with a quarter outside 1-4
    or (if given) another year are left out unread; so are empty files and ones that start with a dot or an underscore.
    The encoding is UTF-8 if the beginning is valid, else Latin-1; the separator is ; if the first line has at least as
    many of it as of commas.
    """
    files = listed(spark, folder, pattern).withColumns({"ano": path_part(F.col("arquivo"), "ano"), "trimestre": path_part(F.col("arquivo"), "trimestre"), "uf": file_state(F.col("nome"))})
    files = files.where(F.col("ano").isNotNull() & F.col("trimestre").isin(1, 2, 3, 4))
    files = files.where(F.col("ano").isin(*years)) if years else files
    out = files.drop("tamanho").join(head_facts(spark, files, folder, pattern), "arquivo")
    count = lambda m: F.length("cabecalho") - F.length(F.replace(F.col("cabecalho"), F.lit(m), F.lit("")))
    head = F.when(F.col("utf8"), F.col("primeira").cast("string")).otherwise(F.decode("primeira", "ISO-8859-1"))
    out = out.withColumn("cabecalho", F.regexp_replace(head, "^\ufeff", "")).drop("primeira")
    out = out.withColumns({"separador": F.when(count(";") >= count(","), ";").otherwise(","), "codificacao": F.when(F.col("utf8"), "UTF-8").otherwise("ISO-8859-1")}).drop("utf8")
    return out.withColumn("colunas", F.size(F.split("cabecalho", F.concat(F.lit("["), F.col("separador"), F.lit("]")))))


def source_inventory(spark: SparkSession, folder: str, **kw) -> DataFrame:
    return probe(spark, folder, **kw).select("nome", "ano", "trimestre", "uf", "separador", "codificacao", "colunas").orderBy("ano", "trimestre", "uf", "nome")


def missing_to_null(df: DataFrame, markers: tuple[str, ...] = CSV_MISSING) -> DataFrame:
    return df.select(*(F.when(~F.col(c).isin(*markers), F.col(c)).alias(c) if t == "string" else F.col(c) for c, t in df.dtypes))


def short_enough(names: int, sep: str):
    """Condition on _BAD, the line: it has no more fields than names. Quoted separators count only if there are too many."""
    seps = lambda c: F.length(c) - F.length(F.replace(c, F.lit(sep), F.lit("")))
    bad = F.col(_BAD)
    return bad.isNotNull() & F.col(_EXTRA).isNull() & ((seps(bad) < names) | (seps(F.regexp_replace(bad, '"[^"]*"', "")) < names))


def raw_rows(spark: SparkSession, paths: list[str], names: list[str], sep: str, encoding: str, header: bool, skip_long: bool) -> DataFrame:
    """names as text and __arquivo (xxhash64 of the path), of files without line breaks in quotes."""
    extra = [_EXTRA, _BAD] if skip_long else []
    schema = T.StructType([T.StructField(n, T.StringType()) for n in [*names, *extra]])
    reader = spark.read.schema(schema).options(sep=sep, encoding=encoding, header=header, quote='"', escape='"', columnPruning=False, mode="PERMISSIVE", recursiveFileLookup="true", columnNameOfCorruptRecord=_BAD)
    rows = reader.csv(paths).select("*", F.xxhash64("_metadata.file_path").alias("__arquivo"))
    if skip_long:  # exactly one field too many is no corrupt record to the parser, fewer or more fields are; of more, the first can be empty
        rows = rows.where(short_enough(len(names), sep))
    return rows.select(*names, "__arquivo")


def broken_rows(spark: SparkSession, paths: list[str], names: list[str], sep: str, encoding: str, header: bool, skip_long: bool) -> DataFrame:
    """names as text and __arquivo, of files with line breaks in quotes; they are split among tasks all the same."""
    rows = quoted_records(spark, paths, sep, header)
    rows = rows.where(F.size("campos") <= len(names)) if skip_long else rows
    return rows.select(*(F.decode(F.get("campos", F.lit(i)), encoding).alias(n) for i, n in enumerate(names)), F.col("arquivo").alias("__arquivo"))


def all_rows(spark: SparkSession, paths: list[str], names: list[str], sep: str, encoding: str, header: bool, skip_long: bool, multiline: bool) -> DataFrame:
    """names as text and __arquivo of files of one shape; with multiline, those with line breaks in quotes are found first,
    in a pass of its own."""
    broken = set(files_with_breaks(spark, paths, sep)) if multiline else set()
    plain = [p for p in paths if p not in broken]
    frames = [raw_rows(spark, plain, names, sep, encoding, header, skip_long)] if plain else []
    frames += [broken_rows(spark, sorted(broken), names, sep, encoding, header, skip_long)] if broken else []
    return frames[0] if len(frames) == 1 else frames[0].unionByName(frames[1])


def read_strings(spark: SparkSession, paths: list[str] | str, names: list[str], sep: str = ";", encoding: str = "UTF-8", header: bool = True, skip_long: bool = True, keep: list[str] | None = None, multiline: bool = False) -> DataFrame:
    """All columns as text. Short lines end in nulls; long lines are dropped, or with skip_long=False cut. Doubled quotes count as one.

    A long line is one with more fields than names, a separator at its end included. multiline: fields may have line
    breaks in quotes. Files are split among tasks in any case.
    """
    found = [paths] if isinstance(paths, str) else paths
    if multiline:
        found = [r[0] for p in found for r in listed(spark, p).select("arquivo").collect()]  # a row per file
        if not found:
            raise ValueError(f"no usable files in {paths}")
    return all_rows(spark, found, names, sep, encoding, header, skip_long, multiline).select(*(keep or names))


def read_ledger(spark: SparkSession, folder: str, years: tuple[int, ...] | None = (2024, 2025), multiline: bool = True) -> DataFrame:
    """All files of a folder as one table: slugged columns united by name, then ano, trimestre, uf, arquivo_origem.

    The files are read by header: one plan for each combination of separator, encoding and header, whose number is small
    next to that of the files. multiline: see read_strings; without it a line break ends a record whatever is quoted.
    """
    files = materialize(probe(spark, folder, years=years), "ledger-files")
    found = files.select("arquivo", "cabecalho", "separador", "codificacao").orderBy("arquivo").collect()  # a row per file
    if not found:
        raise ValueError(f"no usable files in {folder}")
    shapes: dict[tuple, list[str]] = {}
    for f in found:
        shapes.setdefault((f["separador"], f["codificacao"], f["cabecalho"]), []).append(f["arquivo"])
    lineage = files.select(F.xxhash64("arquivo").alias("__arquivo"), F.col("ano").alias("__ano"), F.col("trimestre").cast("byte").alias("__tri"), F.col("uf").alias("__uf"), F.col("nome").alias("__nome"))
    frames = []
    for (sep, encoding, head), paths in shapes.items():
        names = [slug(x.strip('"')) for x in head.split(sep)]
        if "" in names or len(set(names)) < len(names):
            raise ValueError(f"{paths[0]}: empty or repeated column names")
        rows = all_rows(spark, paths, names, sep, encoding, True, True, multiline).join(lineage, "__arquivo")  # a row per file
        data = [F.when(~F.col(n).isin(*CSV_MISSING), F.col(n)).alias(n) for n in names if n not in LINEAGE]
        frames.append(rows.select(*data, F.col("__ano").alias("ano"), F.col("__tri").alias("trimestre"), F.col("__uf").alias("uf"), F.col("__nome").alias("arquivo_origem")))
    order = list(dict.fromkeys(c for f in frames for c in f.columns if c not in LINEAGE))
    return unify(frames, [*order, *LINEAGE])


#: Fields of the two headerless registry files, in order, and those that are kept.
COMPANY_FIELDS = ["cnpj_basico", "razao_social", "natureza_juridica", "qualificacao_responsavel", "capital_social", "porte_empresa", "ente_federativo"]
COMPANY_KEPT = ["cnpj_basico", "razao_social", "porte_empresa"]
ESTABLISHMENT_WIDTH = 30
ESTABLISHMENT_KEPT = {0: "cnpj_basico", 1: "cnpj_ordem", 2: "cnpj_dv", 5: "situacao_cadastral", 6: "data_situacao_cadastral", 10: "data_inicio_atividade", 11: "cnae_fiscal_principal", 19: "uf", 20: "municipio"}


def read_companies(spark: SparkSession, paths) -> DataFrame:
    return missing_to_null(read_strings(spark, paths, COMPANY_FIELDS, encoding="ISO-8859-1", header=False, skip_long=False, keep=COMPANY_KEPT))


def read_establishments(spark: SparkSession, paths) -> DataFrame:
    names = [ESTABLISHMENT_KEPT.get(i, f"campo_{i}") for i in range(ESTABLISHMENT_WIDTH)]
    return missing_to_null(read_strings(spark, paths, names, encoding="ISO-8859-1", header=False, skip_long=False, keep=list(ESTABLISHMENT_KEPT.values())))
