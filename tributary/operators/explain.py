"""Why a row got its score: the strongest contributions of features, as arrays inside the row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tributary.functions.text import label
from tributary.operators.checks import check_at_least


def strongest(parts: list[Column], k: int) -> Column:
    """The k structs with the largest absolute `contribuicao`, of equal ones the first in order."""
    check_at_least(k, 1, "k")
    by = F.transform(F.array(*parts), lambda x, i: F.struct((-F.abs(x["contribuicao"])).alias("a"), i.alias("i"), x.alias("x")))
    return F.transform(F.slice(F.array_sort(by), 1, k), lambda s: s["x"])


def linear_parts(features: list[str], values: list[Column], coefficients: list[float]) -> list[Column]:
    out = []
    for f, v, w in zip(features, values, coefficients, strict=True):
        c = v * F.lit(w)
        out.append(F.struct(F.lit(f).alias("variavel"), c.alias("contribuicao"), F.when(c > 0, "aumenta o score").when(c < 0, "reduz o score").otherwise("efeito nulo").alias("direcao")))
    return out


def tree_parts(features: list[str], values: list[Column], medians: list[float], importances: list[float], labels: dict[str, str] | None = None, by_value: bool = False) -> list[Column]:
    """(value - median) / max(|median|, 1) * importance; the direction by its sign, or with by_value by value against median."""
    out = []
    for f, v, m, w in zip(features, values, medians, importances, strict=True):
        c = (v - F.lit(m)) / F.lit(max(abs(m), 1.0)) * F.lit(w)
        sign = v - F.lit(m) if by_value else c
        direction = F.when(sign > 0, "acima da referência").when(sign < 0, "abaixo da referência").otherwise("igual à referência")
        out.append(F.struct(F.lit(f).alias("variavel"), label(F.lit(f), labels or {}).alias("descricao"), v.alias("valor_observado"), F.lit(m).alias("valor_referencia"), F.lit(w).alias("importancia_global"), c.alias("contribuicao"), direction.alias("direcao")))
    return out


def factor_rows(df: DataFrame, key: str, score: str, factors: Column) -> DataFrame:
    """One row per row and factor, with its place from 1."""
    return df.select(key, score, F.posexplode(factors).alias("__p", "__f")).select(key, score, (F.col("__p") + 1).alias("posicao_fator"), "__f.*")


def explain_linear(df: DataFrame, model, key: str, score: str, k: int = 5) -> DataFrame:
    """df has the features and the score; model: a LinearModel."""
    return factor_rows(df, key, score, strongest(linear_parts(model.prepared.features, model.prepared.standard(), model.coefficients), k))


def explain_tree(df: DataFrame, model, key: str, score: str, k: int = 5, labels: dict[str, str] | None = None, by_value: bool = False) -> DataFrame:
    p = model.prepared
    return factor_rows(df, key, score, strongest(tree_parts(p.features, p.filled(), p.medians, model.importances(), labels, by_value), k))
