"""Aggregations to one row per company, and summaries."""

from __future__ import annotations

from math import ceil, floor

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tributary.functions.dates import SNAPSHOT, age_days
from tributary.functions.numbers import log1p_positive, ratio, years
from tributary.operators.joins import left_join

SITUATION_CLASSES = ("irregular", "beneficio_fiscal", "negociacao", "suspenso_judicial", "garantia")
KEY = "raiz"


def count_where(test: Column) -> Column:
    return F.coalesce(F.sum(F.when(test, 1).otherwise(0)), F.lit(0)).cast("long")


def source_stats(df: DataFrame, key: str, valid: Column) -> DataFrame:
    """One row: rows, valid rows, distinct valid keys."""
    return df.agg(F.count(F.lit(1)).alias("linhas"), F.count_if(valid).alias("validas"), F.count_distinct(F.when(valid, F.col(key))).alias("chaves"))


def key_bitmaps(df: DataFrame, key: str, *groups: str) -> DataFrame:
    """Distinct keys of up to 18 digits per group, as bitmaps of 4 KB for each range of 32,768 keys that occurs: groups,
    balde, mapa. They are exact, and those of several groups unite without the rows (see bitmap_counts). Keys that are no
    such number are left out."""
    number = F.when(F.col(key).rlike("^[0-9]{1,18}$"), F.col(key)).try_cast("long")
    made = df.select(*groups, number.alias("n")).groupBy(*groups, F.bitmap_bucket_number("n").alias("balde")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("n")).alias("mapa"))
    # Not by a test of n before: Spark would carry it down to the raw text, with the text's cleaning copied thousands of times.
    return made.where(F.bitmap_count("mapa") > 0)


def bitmap_counts(bitmaps: DataFrame, *groups: str) -> DataFrame:
    """Distinct keys per group (of all bitmaps without groups), united by OR: groups, chaves."""
    united = bitmaps.groupBy(*groups, "balde").agg(F.bitmap_or_agg("mapa").alias("mapa"))
    return united.groupBy(*groups).agg(F.coalesce(F.sum(F.bitmap_count("mapa")), F.lit(0)).cast("long").alias("chaves"))


def duplicate_excess(df: DataFrame, *keys: str) -> DataFrame:
    """One row: rows beyond the first of their key."""
    again = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return again.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).cast("long").alias("excedente"))


def registry_by_root(establishments: DataFrame, key: str = KEY, status: str = "situacao_cadastral", start: str = "data_inicio_atividade", changed: str = "data_situacao_cadastral", active: str = "02", snapshot: str = SNAPSHOT) -> DataFrame:
    """One row per root: establishments, active and other ones, first and last start, last change, age in days."""
    is_active = F.coalesce(F.col(status) == active, F.lit(False))
    day = lambda c: F.col(c).try_cast("date")
    out = establishments.where(F.col(key).isNotNull()).groupBy(key).agg(
        F.count(F.lit(1)).alias("qtd_estabelecimentos"), count_where(is_active).alias("qtd_ativos"), count_where(~is_active).alias("qtd_inativos"),
        F.min(day(start)).alias("dt_inicio_min"), F.max(day(start)).alias("dt_inicio_max"), F.max(day(changed)).alias("dt_situacao_max"),
    )
    return out.withColumn("idade_empresa_dias", age_days(F.col("dt_inicio_min"), snapshot))


def _situations(column: str, prefix: str) -> list[Column]:
    return [count_where(F.col(column) == s).alias(f"{prefix}qtd_{s}") for s in SITUATION_CLASSES]


#: Distinct quarters are bits of so many 64-bit words, from the first quarter of that year on.
PERIOD_WORDS, FIRST_YEAR = 4, 1970


def period_number(year: Column, quarter: Column) -> Column:
    """Quarters since the first one of FIRST_YEAR; null without year or quarter. Quarters that have no bit are an error."""
    year, quarter = year.cast("int"), quarter.cast("int")
    at = (year - FIRST_YEAR) * 4 + quarter - 1
    wrong = F.raise_error(F.concat(F.lit("no such quarter: "), year.cast("string"), F.lit("-"), quarter.cast("string"))).cast("int")
    return F.when(~quarter.between(1, 4) | ~at.between(0, 64 * PERIOD_WORDS - 1), wrong).otherwise(at)


def period_words(number: str) -> list[Column]:
    """A quarter's number as one bit in PERIOD_WORDS words: the bits of many rows unite by bit_or, so that distinct quarters
    are counted, and merged, without a shuffle by quarter."""
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.col(number).bitwiseAND(63))
    return [F.when(F.shiftright(number, 6) == i, bit) for i in range(PERIOD_WORDS)]


_PERIODS = [f"periodos_{i}" for i in range(PERIOD_WORDS)]
#: How two states of a company become one.
_MERGE = {
    **dict.fromkeys(["qtd_inscricoes", "soma", "com_valor", "marcas", "com_marca", "qtd_ajuizado", *(f"qtd_{s}" for s in SITUATION_CLASSES)], F.sum),
    **dict.fromkeys(["divida_max", "dt_inscricao_max"], F.max), "dt_inscricao_min": F.min, **dict.fromkeys(_PERIODS, F.bit_or),
}


def fiscal_state(rows: DataFrame, key: str = KEY, value: str = "valor_consolidado", flag: str = "indicador_ajuizado", date: str = "data_inscricao", kind: str = "tipo_situacao_inscricao") -> DataFrame:
    """One row per root of inscriptions, with what fiscal_totals needs and states can be merged by. Rows meet once, after they
    are combined on the map side."""
    # What the aggregates use more than once is made in a projection of its own, so that it is made once.
    made = rows.where(F.col(key).isNotNull()).select(key, F.col(value).cast("double").alias("v"), flag, date, kind, period_number(F.col("ano"), F.col("trimestre")).alias("p"))
    return made.groupBy(key).agg(
        F.count(F.lit(1)).alias("qtd_inscricoes"), F.sum("v").alias("soma"), F.count("v").alias("com_valor"), F.max("v").alias("divida_max"),
        F.sum(F.col(flag).cast("long")).alias("marcas"), F.count(flag).alias("com_marca"), count_where(F.col(flag) == 1).alias("qtd_ajuizado"), F.min(date).alias("dt_inscricao_min"), F.max(date).alias("dt_inscricao_max"),
        *(F.bit_or(w).alias(n) for w, n in zip(period_words("p"), _PERIODS, strict=True)), *_situations(kind, ""),
    )


def merged_states(states: DataFrame, key: str = KEY) -> DataFrame:
    """States of several parts of the inscriptions, several rows per root, as the state of all of them."""
    return states.groupBy(key).agg(*(how(c).alias(c) for c, how in _MERGE.items())).select(*states.columns)


def fiscal_totals(state: DataFrame, key: str = KEY) -> DataFrame:
    """The columns of a company's debts; missing amounts and flags don't count in means, a sum of none is null."""
    periods = sum((F.bit_count(F.coalesce(n, F.lit(0).cast("long"))) for n in _PERIODS), F.lit(0))
    return state.select(
        key, "qtd_inscricoes", F.col("soma").alias("divida_total"), F.try_divide("soma", "com_valor").alias("divida_media"), "divida_max", F.try_divide("marcas", "com_marca").alias("pct_ajuizado"), "qtd_ajuizado",
        "dt_inscricao_min", "dt_inscricao_max", periods.cast("int").alias("qtd_periodos"), *(f"qtd_{s}" for s in SITUATION_CLASSES),
    )


def _typed_registry(df: DataFrame) -> DataFrame:
    return df.withColumns({**{c: F.col(c).cast("int") for c in ("qtd_estabelecimentos", "qtd_ativos", "qtd_inativos")}, "idade_empresa_dias": F.col("idade_empresa_dias").cast("long")})


def fiscal_by_root(rows: DataFrame, registry: DataFrame, key: str = KEY, **columns: str) -> DataFrame:
    """One row per root of inscriptions, with the registry's columns where it has the root.

    registry has one row per root. Inscriptions are aggregated before they meet it: both sides are dealt out by root once,
    the join moves nothing, and a company with very many inscriptions is one row in it."""
    out = left_join(fiscal_totals(fiscal_state(rows, key, **columns), key), registry, key, ["qtd_estabelecimentos", "qtd_ativos", "qtd_inativos", "idade_empresa_dias"], match=None)
    return _typed_registry(out)


def fiscal_features(df: DataFrame) -> DataFrame:
    c = F.col
    return df.withColumns({
        "divida_por_estabelecimento": ratio(c("divida_total"), c("qtd_estabelecimentos")), "divida_por_estabelecimento_ativo": ratio(c("divida_total"), c("qtd_ativos")),
        "inscricoes_por_periodo": ratio(c("qtd_inscricoes"), c("qtd_periodos")), "proporcao_ajuizada_calculada": ratio(c("qtd_ajuizado"), c("qtd_inscricoes")),
    })


def discontinuity_by_root(rows: DataFrame, registry: DataFrame, key: str = KEY, prefix: str = "debt_", target: str = "y_descontinuidade", value: str = "valor_consolidado", flag: str = "indicador_ajuizado", date: str = "data_inscricao", kind: str = "tipo_situacao_inscricao") -> DataFrame:
    """One row per root of inscriptions that the registry has, and the target: no active establishment. Missing amounts
    count as 0. Inscriptions are aggregated before they meet the registry, which has one row per root."""
    amount, p = F.coalesce(F.col(value), F.lit(0)), prefix
    litigated = count_where(F.col(flag) == 1)
    debts = rows.where(F.col(key).isNotNull()).groupBy(key).agg(
        F.count(F.lit(1)).alias(f"{p}qtd_registros"), F.count_distinct("numero_inscricao").alias(f"{p}qtd_inscricoes"),
        F.sum(amount).cast("double").alias(f"{p}divida_total"), F.avg(amount).alias(f"{p}divida_media"), F.max(amount).cast("double").alias(f"{p}divida_max"),
        litigated.alias(f"{p}qtd_ajuizadas"), (litigated / F.count(F.lit(1))).alias(f"{p}pct_ajuizadas"),
        F.count_distinct("receita_principal").cast("int").alias(f"{p}qtd_receitas_distintas"), F.count_distinct("situacao_inscricao").cast("int").alias(f"{p}qtd_situacoes_distintas"),
        F.min(date).alias("dt_inscricao_min"), F.max(date).alias("dt_inscricao_max"), *_situations(kind, p),
    )
    known = _typed_registry(registry.dropna(subset=[key, "qtd_ativos", "qtd_estabelecimentos"])).select(
        key, F.when(F.col("qtd_ativos") == 0, 1).otherwise(0).alias(target), "qtd_estabelecimentos", "qtd_ativos", "qtd_inativos", "idade_empresa_dias", "dt_inicio_min", "dt_inicio_max", "dt_situacao_max"
    )
    return known.join(debts, key)


def discontinuity_features(df: DataFrame, prefix: str = "debt_") -> DataFrame:
    c, p = F.col, prefix
    shares = {f"{p}pct_{s}": ratio(c(f"{p}qtd_{s}"), c(f"{p}qtd_registros")) for s in SITUATION_CLASSES}
    return df.withColumns({
        "pct_ativos": ratio(c("qtd_ativos"), c("qtd_estabelecimentos")), **shares, "log1p_qtd_estabelecimentos": log1p_positive(c("qtd_estabelecimentos")),
        "idade_empresa_anos": years(c("idade_empresa_dias")), f"log1p_{p}divida_total": log1p_positive(c(f"{p}divida_total")),
    })


SLICE_ROWS = 1_000_000


def exact_percentiles(df: DataFrame, columns: list[str], points: list[float], slice_rows: int = SLICE_ROWS) -> dict[str, list[float | None]]:
    """Interpolated percentiles of each column, exact, without bringing a column into one task; null without values.

    Of a column with more than slice_rows values, approximate percentiles bound a slice around each point, until it has
    few enough; a value that repeats counts once. Only the slices are sorted, each in a task. NaN counts as the largest
    value. df is read twice, and two times more for each round of bounds (one for some billions of rows).
    """
    values = df.select(*(F.col(c).cast("double").alias(f"v{i}") for i, c in enumerate(columns)))
    sizes = values.agg(*(F.count(f"v{i}") for i in range(len(columns)))).first()
    ranks = {(i, k): q * (n - 1) for i, n in enumerate(sizes) if n for k, q in enumerate(points)}
    # What is known of each: the values from low to high (null: all), how many there are, and how many lie below.
    slices = {key: (None, None, sizes[key[0]], 0) for key in ranks}

    def inside(i: int, low: float | None, high: float | None) -> Column:
        v = F.col(f"v{i}")
        return v.isNotNull() if low is None else (v >= low) & (v <= high)

    wide = [key for key, s in slices.items() if s[2] > slice_rows]
    while wide:
        around = []
        for i, k in wide:
            low, high, n, below = slices[i, k]
            at, near = (ranks[i, k] - below) / n, 2 / 10_000 + 2 / n
            around.append(F.percentile_approx(F.when(inside(i, low, high), F.col(f"v{i}")), [max(0.0, at - near), min(1.0, at + near)], 10_000))
        cuts = values.agg(*around).first()
        counts = values.agg(*(x for (i, _), c in zip(wide, cuts, strict=True) for x in (F.count_if(inside(i, *c)), F.count_if(F.col(f"v{i}") < c[0])))).first()
        left = []
        for j, (i, k) in enumerate(wide):
            n, below = counts[2 * j], counts[2 * j + 1]
            if n < slices[i, k][2] and below <= ranks[i, k] <= below + n - 1:
                slices[i, k] = (*cuts[j], n, below)
                left += [(i, k)] if n > slice_rows and cuts[j][0] < cuts[j][1] else []
        wide = left

    groups: dict[tuple, list[tuple[int, int]]] = {}
    for (i, k), (low, high, _, below) in slices.items():
        groups.setdefault((i, low, high, below), []).append((i, k))
    out: dict[str, list[float | None]] = {c: [None] * len(points) for c in columns}
    if not groups:
        return out
    each = F.array(*(F.when(inside(i, low, high), F.struct(F.lit(j).alias("j"), F.col(f"v{i}").alias("v"))) for j, (i, low, high, _) in enumerate(groups)))
    counts = values.select(F.explode(F.array_compact(each)).alias("r")).select("r.*").groupBy("j", "v").agg(F.count(F.lit(1)).alias("n"))
    through = counts.withColumn("through", F.sum("n").over(Window.partitionBy("j").orderBy("v").rowsBetween(Window.unboundedPreceding, 0)))
    wanted = [[r - below for key in keys for r in (floor(ranks[key]), ceil(ranks[key]))] for (_, _, _, below), keys in groups.items()]
    asked = F.get(F.array(*(F.array(*(F.lit(r).cast("long") for r in w)) for w in wanted)), F.col("j"))
    found = through.where(F.exists(asked, lambda r: (F.col("through") > r) & (F.col("through") - F.col("n") <= r))).collect()  # two rows a point at most
    for j, ((i, _, _, below), keys) in enumerate(groups.items()):
        own = sorted((r["through"], r["v"]) for r in found if r["j"] == j)
        value = lambda r: next(v for through, v in own if through > r - below)  # noqa: E731, B023
        for key in keys:
            low, high = value(floor(ranks[key])), value(ceil(ranks[key]))
            out[columns[i]][key[1]] = low if low == high else low + (high - low) * (ranks[key] - floor(ranks[key]))
    return out


def percentile_value(df: DataFrame, column: str, q: float = 0.9) -> float:
    """The exact interpolated percentile. Fails without values."""
    found = exact_percentiles(df, [column], [q])[column][0]
    if found is None:
        raise ValueError(f"{column} has no values")
    return found


def fiscal_target(df: DataFrame, target: str = "y_risco_fiscal", q: float = 0.9) -> DataFrame:
    """1 for a litigated debt or a total at or above the percentile; a missing total alone gives 0. df is read more than
    once: give a table."""
    cut = percentile_value(df, "divida_total", q)
    return df.withColumn(target, F.when(F.col("qtd_ajuizado") > 0, 1).when(F.col("divida_total") >= F.lit(cut), 1).otherwise(0))


def money_summary(df: DataFrame, column: str) -> DataFrame:
    """One row; quartiles are exact. df is read more than once: give a table."""
    q = exact_percentiles(df, [column], [0.25, 0.5, 0.75])[column]
    quartiles = (F.lit(x).cast("double").alias(n) for x, n in zip(q, ("p25", "p50", "p75"), strict=True))
    return df.agg(F.count(column).alias("n"), F.count_if(F.col(column).isNull()).alias("nulos"), F.avg(column).alias("media"), F.min(column).alias("minimo"), *quartiles, F.max(column).alias("maximo"))


def dataset_summary(df: DataFrame, target: str, active: str = "qtd_ativos") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("empresas"), F.coalesce(F.sum(target), F.lit(0)).cast("long").alias("positivas"), F.avg(target).alias("taxa_positiva"), F.count_if(F.col(active) > 0).alias("com_ativos"))


def registry_summary(df: DataFrame) -> DataFrame:
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long")
    return df.agg(
        F.count(F.lit(1)).alias("empresas"), total("qtd_estabelecimentos").alias("estabelecimentos"), total("qtd_ativos").alias("ativos"), total("qtd_inativos").alias("inativos"),
        F.min("idade_empresa_dias").alias("idade_min"), F.max("idade_empresa_dias").alias("idade_max"),
        (total("qtd_ativos") + total("qtd_inativos") == total("qtd_estabelecimentos")).alias("consistente"),
    )


def with_controls(df: DataFrame, observation, **tests: Column) -> DataFrame:
    """Counts rows and the rows that pass each test while the data go by: no pass of its own."""
    return df.observe(observation, F.count(F.lit(1)).alias("linhas"), *(F.count_if(t).alias(k) for k, t in tests.items()))


def count_by(df: DataFrame, *columns: str) -> DataFrame:
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("quantidade"))


def score_stats(df: DataFrame, score: str) -> DataFrame:
    return df.agg(F.count(score).alias("n"), F.avg(score).alias("media"), F.min(score).alias("minimo"), F.max(score).alias("maximo"))
