"""Profiles and quality tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tributary.operators.aggregates import exact_percentiles


def schema_table(df: DataFrame) -> DataFrame:
    return df.sparkSession.createDataFrame([(f.name, f.dataType.simpleString(), f.nullable) for f in df.schema], "variavel string, tipo string, aceita_nulo boolean")


def profile(df: DataFrame) -> DataFrame:
    """One row per column: rows, nulls, their percentage, distinct values. Rows are counted per column and value, so that
    no task holds a column's values; they go by hash, long texts by two of 64 bits."""
    if not df.columns:
        raise ValueError("no columns")
    cells = [F.struct(F.lit(i).alias("i"), F.when(F.col(f"`{c}`").isNotNull(), F.struct(F.xxhash64(F.col(f"`{c}`")).alias("a"), F.xxhash64(F.lit(7), F.col(f"`{c}`")).alias("b"))).alias("v")) for i, c in enumerate(df.columns)]
    counts = df.select(F.explode(F.array(*cells)).alias("r")).select("r.*").groupBy("i", "v").agg(F.count(F.lit(1)).alias("n"))
    by_column = counts.groupBy("i").agg(F.sum("n").alias("linhas"), F.coalesce(F.sum(F.when(F.col("v").isNull(), F.col("n"))), F.lit(0)).alias("nulos"), F.count("v").alias("distintos"))
    names = df.sparkSession.createDataFrame(list(enumerate(df.columns)), "i int, variavel string")
    out = F.broadcast(names).join(by_column, "i", "left")  # a row per column, also of an empty table
    out = out.select("variavel", *(F.coalesce(c, F.lit(0)).alias(c) for c in ("linhas", "nulos", "distintos")))
    return out.withColumn("pct_nulos", F.coalesce(F.round(100 * F.try_divide("nulos", "linhas"), 2), F.lit(0.0))).orderBy(F.desc("pct_nulos"), "variavel")


def column_info(df: DataFrame) -> DataFrame:
    """Values that aren't null, and the type, per column."""
    return profile(df).join(F.broadcast(schema_table(df)), "variavel").select("variavel", (F.col("linhas") - F.col("nulos")).alias("nao_nulos"), "tipo")  # a row per column


def suggested_types(df: DataFrame, money: str = "valor_consolidado", few: int = 80) -> DataFrame:
    """profile with `tipo_sugerido`."""
    own = F.broadcast(schema_table(df).select("variavel", "tipo"))  # a row per column
    number = F.col("tipo").rlike("^(tinyint|smallint|int|bigint|float|double|decimal)")
    rule = (
        F.when(F.col("variavel") == money, "float64").when(F.col("variavel").isin("ano", "trimestre"), "inteiro")
        .when(F.lower("variavel").contains("data") | F.col("tipo").rlike("^(date|timestamp)"), "datetime").when(number, F.col("tipo")).when(F.col("distintos") <= few, "categoria").otherwise("texto")
    )
    return profile(df).join(own, "variavel").withColumn("tipo_sugerido", rule)


def decisions(df: DataFrame, protected: list[str] = ()) -> DataFrame:
    """profile with `acao` and `motivo`: nothing is dropped, columns without information are marked for review."""
    keep = F.col("variavel").isin(*protected) if protected else F.lit(False)
    empty, constant = (F.col("linhas") > 0) & (F.col("nulos") == F.col("linhas")), F.col("distintos") <= 1
    out = profile(df).withColumns({
        "acao": F.when(keep, "manter").when(empty | constant, "revisar").otherwise("manter"),
        "motivo": F.when(keep, "protegida").when(empty, "totalmente nula").when(constant, "constante").otherwise("informativa"),
    })
    return out.orderBy(F.when(F.col("acao") == "revisar", 0).otherwise(1), F.desc("pct_nulos"), "variavel")


def domains(df: DataFrame, columns: list[str], top: int = 30) -> DataFrame:
    """The `top` most frequent values of each column, null among them."""
    long = df.select(F.explode(F.array(*(F.struct(F.lit(c).alias("variavel"), F.col(c).cast("string").alias("valor")) for c in columns))).alias("r")).select("r.*")
    counts = long.groupBy("variavel", "valor").agg(F.count(F.lit(1)).alias("quantidade"))
    rank = F.row_number().over(Window.partitionBy("variavel").orderBy(F.desc("quantidade"), F.col("valor").asc_nulls_last()))
    return counts.withColumn("posicao", rank).where(F.col("posicao") <= top)


def key_check(df: DataFrame, key: str, root: str, block: str | None = None, widths: tuple[int, int] = (14, 8)) -> DataFrame:
    """Per block: nulls, well-formed keys and roots, roots that begin their key, and the rates."""
    full, short = (F.coalesce(F.col(c).rlike(rf"^\d{{{w}}}$"), F.lit(False)) for c, w in ((key, widths[0]), (root, widths[1])))
    fits = full & short & (F.substring(key, 1, widths[1]) == F.col(root))
    grouped = df.groupBy(block) if block else df.groupBy()
    out = grouped.agg(F.count(F.lit(1)).alias("linhas"), F.count_if(F.col(key).isNull()).alias("chave_nula"), F.count_if(full).alias("chave_valida"), F.count_if(F.col(root).isNull()).alias("raiz_nula"), F.count_if(short).alias("raiz_valida"), F.count_if(fits).alias("raiz_confere"))
    return out.withColumns({f"taxa_{c}": F.try_divide(c, "linhas") for c in ("chave_valida", "raiz_valida", "raiz_confere")})


def key_check_total(checks: DataFrame) -> DataFrame:
    """Sums and rates over blocks; zeros without any."""
    names = ("linhas", "chave_nula", "chave_valida", "raiz_nula", "raiz_valida", "raiz_confere")
    out = checks.agg(*(F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(c) for c in names))
    return out.withColumns({f"taxa_{c}": F.coalesce(F.try_divide(c, "linhas"), F.lit(0.0)) for c in ("chave_valida", "raiz_valida", "raiz_confere")})


def geography_check(df: DataFrame, block: str, candidates: tuple[str, ...] = ("uf_devedor", "uf")) -> DataFrame:
    """Per block: nulls and distinct values of the first of the candidate columns there is; no rows without one."""
    found = next((c for c in candidates if c in df.columns), None)
    if found is None:
        return df.sparkSession.createDataFrame([], "bloco string, variavel string, linhas long, nulos long, pct_nulos double, distintos long")
    out = df.groupBy(F.col(block).cast("string").alias("bloco")).agg(F.lit(found).alias("variavel"), F.count(F.lit(1)).alias("linhas"), F.count_if(F.col(found).isNull()).alias("nulos"), F.count_distinct(found).alias("distintos"))
    return out.select("bloco", "variavel", "linhas", "nulos", (100 * F.col("nulos") / F.col("linhas")).alias("pct_nulos"), "distintos")


def describe_numbers(df: DataFrame, columns: list[str], points: tuple[float, ...] = (0.25, 0.5, 0.75, 0.9, 0.99)) -> DataFrame:
    """One row per column: count, mean, sd, min, exact percentiles, max. df is read more than once: give a table."""
    found = exact_percentiles(df, columns, list(points))
    parts = [
        F.struct(
            F.lit(c).alias("variavel"), F.count(c).alias("n"), F.avg(c).alias("media"), F.stddev_samp(c).alias("desvio"), F.min(F.col(c).cast("double")).alias("minimo"),
            *(F.lit(x).cast("double").alias(f"p{round(100 * q)}") for x, q in zip(found[c], points, strict=True)), F.max(F.col(c).cast("double")).alias("maximo"),
        ).alias(f"s{i}")
        for i, c in enumerate(columns)
    ]
    stats = df.agg(*parts)
    return stats.select(F.explode(F.array(*(f"s{i}" for i in range(len(columns))))).alias("r")).select("r.*")


def date_ranges(df: DataFrame, columns: list[str]) -> DataFrame:
    parts = [F.struct(F.lit(c).alias("variavel"), F.min(F.col(c).cast("date")).alias("primeira"), F.max(F.col(c).cast("date")).alias("ultima"), F.count_if(F.col(c).isNull()).alias("nulas")).alias(f"s{i}") for i, c in enumerate(columns)]
    return df.agg(*parts).select(F.explode(F.array(*(f"s{i}" for i in range(len(columns))))).alias("r")).select("r.*")
