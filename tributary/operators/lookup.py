"""Scores, observed condition and factors for a table of requested companies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tributary.functions.text import lookup_root
from tributary.operators.checks import require_columns
from tributary.operators.explain import linear_parts, strongest, tree_parts
from tributary.operators.models import LinearModel, check_usable
from tributary.sources.staging import materialize

OK, INVALID, MISSING, DUPLICATE = "ok", "invalid_key", "unavailable", "duplicate_key"


def requests_of(requests: DataFrame, request: str) -> DataFrame:
    """pedido and raiz_pedida, one row per request."""
    return requests.select(F.col(request).alias("pedido"), lookup_root(F.col(request)).alias("raiz_pedida"))


def requested(data: DataFrame, asked: DataFrame, key: str) -> DataFrame:
    """The rows of data that some request of requests_of() asks for."""
    return data.join(asked.select(F.col("raiz_pedida").alias(key)).where(F.col(key).isNotNull()).distinct(), key, "left_semi")


#: Requested keys that are pushed to a scan, and conditions they become at most.
PUSHED_KEYS, CONDITIONS = 100_000, 32


def pruned(data: DataFrame, key: str, asked: DataFrame) -> DataFrame:
    """data without row groups that no request can be in, where data is a table written by write_clustered: the requested keys
    go to the scan as equalities, or, if they are many, as ranges of keys next to each other. More requests than PUSHED_KEYS
    read all of data. What is left may have other keys too."""
    found = sorted(r[0] for r in asked.select("raiz_pedida").where("raiz_pedida is not null").distinct().limit(PUSHED_KEYS + 1).collect())
    if len(found) > PUSHED_KEYS:
        return data
    size = max(1, -(-len(found) // CONDITIONS))
    ranges = [(found[i], found[min(i + size, len(found)) - 1]) for i in range(0, len(found), size)]
    tests = [F.col(key) == low if low == high else F.col(key).between(low, high) for low, high in ranges] or [F.lit(False)]
    while len(tests) > 1:  # a balanced tree of ORs
        tests = [a | b for a, b in zip(tests[::2], tests[1::2], strict=False)] + tests[len(tests) // 2 * 2 :]
    return data.where(tests[0])


def attach(asked: DataFrame, data: DataFrame, key: str, columns: list[str], prefix: str = "") -> DataFrame:
    """asked with `status` and the columns of data, all under the prefix; null unless ok.

    status: ok, invalid_key (neither 8 nor 14 digits), unavailable (no such company), duplicate_key (data have it more
    than once).
    """
    own = requested(data, asked, key).groupBy(F.col(key).alias("__key")).agg(F.count(F.lit(1)).alias("__n"), *(F.first(c).alias(f"__{c}") for c in columns))
    out = asked.join(own, asked.raiz_pedida == own["__key"], "left")
    status = F.when(F.col("raiz_pedida").isNull(), INVALID).when(F.col("__n").isNull(), MISSING).when(F.col("__n") > 1, DUPLICATE).otherwise(OK)
    return out.select(*asked.columns, status.alias(f"{prefix}status"), *(F.when(F.col("__n") == 1, F.col(f"__{c}")).alias(prefix + c) for c in columns))


def answers(asked: DataFrame, data: DataFrame, key: str, columns: list[str]) -> DataFrame:
    return attach(asked, data, key, columns).select("pedido", F.col("raiz_pedida").alias("raiz"), "status", *columns)


def lookup(requests: DataFrame, request: str, data: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """One row per request: pedido, raiz, status (see attach) and the columns of the company. Keys in data are stored with
    their zeros, so the join is on the bare column."""
    require_columns(data, [key, *columns])
    return answers(requests_of(requests, request), data, key, columns)


def lookup_stored(requests: DataFrame, request: str, path: str, key: str, columns: list[str]) -> DataFrame:
    """lookup in a table that write_clustered has written: row groups without a requested key are not read. The requests are
    written first: Spark carries the conditions on the key over to them, where it should be a plain column."""
    data = require_columns(requests.sparkSession.read.parquet(path), [key, *columns])
    asked = materialize(requests_of(requests, request), "asked")
    return answers(asked, pruned(data, key, asked), key, columns)


def lookup_scores(requests: DataFrame, request: str, data: DataFrame, key: str, features: list[str], score: Column, factors: Column, condition: Column, name: str, caveat: str) -> DataFrame:
    """lookup with the model's score, the observed condition, the factors (an array) and a caveat; null unless ok."""
    found = lookup(requests, request, data, key, features)
    ok = F.col("status") == OK
    out = found.withColumns({"modelo": F.lit(name), "score": F.when(ok, score), "condicao": F.when(ok, condition), "fatores": F.when(ok, factors), "limitacao": F.lit(caveat)})
    return out.select("pedido", "raiz", "modelo", "status", "score", "condicao", "fatores", "limitacao")


def lookup_models(requests: DataFrame, request: str, models: dict[str, tuple], key: str, k: int = 5, labels: dict[str, str] | None = None) -> DataFrame:
    """One row per request with the answer of every model in columns under its name: status, score, condicao (the target as
    observed, null where data lack it), fatores (the k strongest), and limitacao.

    models: name -> (model, data). Only the rows that are asked for are scored. Tree factors tell values against medians.
    """
    asked = out = requests_of(requests, request)
    for name, (model, data) in models.items():
        own = requested(check_usable(model, data, key) and data, asked, key)
        target = model.meta["target"]
        condition = F.col(target).cast("int") if target in data.columns else F.lit(None).cast("int")
        scored = own.withColumn("__score", model.probability())
        p = model.prepared
        parts = linear_parts(p.features, p.standard(), model.coefficients) if isinstance(model, LinearModel) else tree_parts(p.features, p.filled(), p.medians, model.importances(), labels, by_value=True)
        scored = scored.select(key, F.col("__score").alias("score"), condition.alias("condicao"), strongest(parts, k).alias("fatores"))
        out = attach(out, scored, key, ["score", "condicao", "fatores"], f"{name}_").withColumn(f"{name}_limitacao", F.lit(model.meta["caveat"]))
    return out.withColumnRenamed("raiz_pedida", "raiz")
