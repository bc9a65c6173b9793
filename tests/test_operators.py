"""Operators on small tables."""

import datetime
import math
import random

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from tributary.operators import aggregates as A
from tributary.operators import checks, explain, joins, lookup, metrics, models, projections, quality, ranking, sampling
from tributary.plans import datasets


def test_slugs(spark):
    assert projections.slug(" Número da Inscrição ") == "numero_da_inscricao"
    with pytest.raises(ValueError, match="repeat"):
        projections.slug_columns(spark.range(1).select(F.lit(1).alias("a b"), F.lit(1).alias("A-B")))
    with pytest.raises(ValueError, match="usable"):
        projections.slug_columns(spark.range(1).select(F.lit(1).alias("--")))


def test_checks(spark):
    df = spark.range(3)
    for f in (lambda: checks.require_columns(df, ["id", "x", "a"]), lambda: checks.require_rows(df.limit(0)), lambda: checks.require_unique(df.union(df), "id"), lambda: checks.require_both_classes(df.where("id = 1").withColumn("y", F.lit(1)), "y"), lambda: sampling.hash_sample(df, "id", 1000), lambda: ranking.top_n(df, "id", "id", 0)):
        with pytest.raises(ValueError):
            f()
    assert sampling.hash_sample(df, "id", 0).count() == 3


def test_typed_and_filters(spark):
    df = spark.createDataFrame([("1", "x", "pj"), ("z", "2", None)], "a string, b string, tipo_pessoa string")
    assert [tuple(r) for r in projections.typed(df, {"a": "int"}).select("a", "b").collect()] == [(1, "x"), (None, "2")]
    assert projections.legal_entities(df).count() == 1 and projections.root_length_filter(df, "a").count() == 1
    assert projections.pick(df, ["a"], ["nope", "b"]).columns == ["a", "b"]


def test_left_join_keeps_cardinality(spark):
    left = spark.createDataFrame([("1", 1), ("1", 2), ("2", 3), (None, 4)], "k string, v int")
    right = joins.unique_by_min(spark.createDataFrame([("1", "b", None), ("1", "a", "z"), (None, "q", "q")], "k string, x string, y string"), "k", ["x", "y"], width=None)
    out = joins.checked_left_join(left, right, "k")
    assert sorted(map(str, map(tuple, out.collect()))) == sorted(map(str, [("1", 1, "a", "z", 1), ("1", 2, "a", "z", 1), ("2", 3, None, None, 0), (None, 4, None, None, 0)]))
    assert tuple(joins.join_audit(out, 4).first()) == (4, 2, 2, 0.5, True)
    with pytest.raises(ValueError, match="repeat"):
        joins.checked_left_join(left, left.withColumnRenamed("v", "w"), "k")


def test_even_indices():
    assert sampling.even_indices(4, 10) == [0, 3, 6, 9] and sampling.even_indices(9, 3) == [0, 1, 2] and sampling.even_indices(1, 5) == [0] and sampling.even_indices(2, 0) == []
    assert sampling.even_indices(3, 4) == [0, 2, 3]  # halves go to the even number


INSCRIPTIONS = "raiz string, numero_inscricao string, valor_consolidado double, indicador_ajuizado int, data_inscricao timestamp, ano int, trimestre int, tipo_situacao_inscricao string, situacao_inscricao string, receita_principal string"
COMPANIES = "raiz string, qtd_estabelecimentos long, qtd_ativos long, qtd_inativos long, idade_empresa_dias long, dt_inicio_min date, dt_inicio_max date, dt_situacao_max date"


def test_aggregates_differ_in_nulls(spark):
    rows = spark.createDataFrame([("a", "n1", None, None, None, 2024, q, "garantia", "s", None) for q in (1, None)], INSCRIPTIONS)
    reg = spark.createDataFrame([("a", 1, 0, 1, 5, None, None, None), ("b", 1, 1, 0, 5, None, None, None)], COMPANIES)
    f = A.fiscal_features(A.fiscal_by_root(rows, reg)).first()
    assert (f.divida_total, f.divida_media, f.pct_ajuizado, f.qtd_ajuizado, f.qtd_periodos, f.qtd_garantia) == (None, None, None, 0, 1, 2)
    assert f.divida_por_estabelecimento_ativo is None and f.proporcao_ajuizada_calculada == 0
    d = A.discontinuity_features(A.discontinuity_by_root(rows, reg)).collect()
    assert [(d.debt_divida_total, d.y_descontinuidade, d.debt_qtd_inscricoes, d.debt_qtd_receitas_distintas, d.pct_ativos) for d in d] == [(0.0, 1, 1, 0, 0.0)]
    with pytest.raises(ValueError, match="no values"):
        A.fiscal_target(A.fiscal_features(A.fiscal_by_root(rows, reg)))
    unknown = A.fiscal_by_root(rows, reg.where("raiz = 'b'")).first()
    assert unknown.qtd_ativos is None and A.discontinuity_by_root(rows, reg.where("raiz = 'b'")).count() == 0


def random_inscriptions(spark, n=300):
    rng = random.Random(2)
    day = datetime.datetime(2020, 1, 1)
    some = lambda x: None if rng.random() < 0.2 else x
    rows = [(some(f"c{rng.randrange(9)}"), f"n{i}", some(rng.random() * 100), some(rng.randrange(2)), some(day + datetime.timedelta(i)), some(rng.randrange(1970, 2034)), some(rng.randrange(1, 5)), rng.choice(["garantia", "irregular", None]), "s", "r") for i in range(n)]
    return spark.createDataFrame(rows, INSCRIPTIONS)


def test_states_merge_to_the_whole(spark):
    rows = random_inscriptions(spark).cache()
    whole = A.fiscal_totals(A.fiscal_state(rows))
    parts = A.fiscal_state(rows.where("numero_inscricao like '%1'")).unionByName(A.fiscal_state(rows.where("numero_inscricao not like '%1'")))
    want = rows.where("raiz is not null").groupBy("raiz").agg(F.count_distinct(F.concat("ano", F.lit("-"), "trimestre")).alias("p"), F.avg("valor_consolidado").alias("m"), F.avg("indicador_ajuizado").alias("j"), F.max("data_inscricao").alias("d"), F.count_if(F.col("tipo_situacao_inscricao") == "garantia").alias("g"))
    for got in (whole, A.fiscal_totals(A.merged_states(parts))):
        both = got.join(want, "raiz").collect()
        assert len(both) == 9
        for r in both:
            assert (r.qtd_periodos, r.dt_inscricao_max, r.qtd_garantia) == (r.p, r.d, r.g) and r.divida_media == pytest.approx(r.m) and r.pct_ajuizado == pytest.approx(r.j)
    for year, quarter in ((1969, 4), (2034, 1), (2020, 5)):
        with pytest.raises(Exception, match="no such quarter"):
            A.fiscal_state(rows.limit(1).withColumns({"raiz": F.lit("a"), "ano": F.lit(year), "trimestre": F.lit(quarter)})).collect()


def test_inscriptions_and_registry_are_shuffled_once_each(spark):
    rows, reg = random_inscriptions(spark), spark.createDataFrame([("c1", "02", "2020-01-01", "2020-01-01"), ("c1", "08", None, None)], "raiz string, situacao_cadastral string, data_inicio_atividade string, data_situacao_cadastral string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        plan = A.fiscal_by_root(rows, A.registry_by_root(reg))._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange ") == 2 and "SortMergeJoin" in plan and plan.count("Exchange hashpartitioning(raiz") == 2


def test_bitmaps_unite_to_distinct_counts(spark):
    rows = spark.createDataFrame([(k, q) for q in range(3) for k in ("00000001", "32768", "99999999", f"{q}", None, "x", "1" * 19, "000000000000000001")], "raiz string, t int")
    maps = A.key_bitmaps(rows, "raiz", "t")
    assert {r.t: r.chaves for r in A.bitmap_counts(maps, "t").collect()} == {0: 4, 1: 3, 2: 4} and A.bitmap_counts(maps).first().chaves == 5
    assert A.bitmap_counts(A.key_bitmaps(rows.limit(0), "raiz")).first().chaves == 0


def test_percentile_and_target(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (4.0,), (None,)], "divida_total double").withColumn("qtd_ajuizado", F.lit(0))
    assert A.percentile_value(df, "divida_total") == pytest.approx(3.6)
    assert sorted((str(r.divida_total), r.y_risco_fiscal) for r in A.fiscal_target(df).collect()) == [("1.0", 0), ("2.0", 0), ("4.0", 1), ("None", 0)]


def test_exact_percentiles_in_slices(spark):
    """Slices of a few rows, ties, nulls, NaN and infinities: always what sorting gives."""
    rng = random.Random(5)
    columns = {"a": [rng.gauss(0, 1) for _ in range(3000)], "b": [rng.choice([1.0, 1.0, 2.0, 7.5, None]) for _ in range(3000)], "c": [rng.choice([float("inf"), -1.0, float("nan"), rng.random()]) for _ in range(3000)], "d": [None] * 3000, "e": [None] * 2999 + [4.0]}
    df = spark.createDataFrame(list(zip(*columns.values(), strict=True)), ", ".join(f"{c} double" for c in columns)).repartition(5)
    points = [0.0, 0.1, 0.5, 0.75, 0.999, 1.0]
    for slice_rows in (2, 50, 10**6):
        got = A.exact_percentiles(df, list(columns), points, slice_rows)
        for c, values in columns.items():
            own = sorted((v for v in values if v is not None), key=lambda v: (math.isnan(v), 0 if math.isnan(v) else v))
            for q, x in zip(points, got[c], strict=True):
                if not own:
                    assert x is None
                    continue
                low, high = own[math.floor(q * (len(own) - 1))], own[math.ceil(q * (len(own) - 1))]
                want = low if low == high else low + (high - low) * (q * (len(own) - 1) - math.floor(q * (len(own) - 1)))
                assert x == pytest.approx(want, nan_ok=True)


def test_ranks_of_one_score(spark):
    """A score that all rows share is ranked by key, over several tasks."""
    df = spark.range(1000).select((F.col("id") * 7 % 1000).alias("id"), F.lit(0.5).alias("s"), F.lit("x").alias("place"))
    got = ranking.ranked(df, "s", "id")
    assert all(r.posicao == r.id + 1 and r.place == "x" for r in got.collect()) and got.count() == 1000
    assert ranking.ranked(df.limit(0), "s", "id").count() == 0


def test_controls(spark):
    seen = Observation("x")
    A.with_controls(spark.range(10), seen, par=F.col("id") % 2 == 0).collect()
    assert seen.get == {"linhas": 10, "par": 5}


def test_quality_tables(spark):
    df = spark.createDataFrame([(1, None, "a", "k"), (2, None, "a", "k"), (3, None, None, "k")], "valor_consolidado int, vazio string, c string, fixo string")
    acts = {r.variavel: (r.acao, r.motivo) for r in quality.decisions(df, ["fixo"]).collect()}
    assert acts == {"vazio": ("revisar", "totalmente nula"), "c": ("revisar", "constante"), "fixo": ("manter", "protegida"), "valor_consolidado": ("manter", "informativa")}
    assert {r.variavel: r.tipo_sugerido for r in quality.suggested_types(df).collect()}["valor_consolidado"] == "float64"
    assert {(r.valor, r.quantidade) for r in quality.domains(df, ["c"]).collect()} == {("a", 2), (None, 1)}
    assert quality.geography_check(df, "c").count() == 0 and quality.key_check_total(quality.key_check(df.limit(0), "c", "fixo")).first().linhas == 0


def test_ranking_and_metrics_against_brute_force(spark):
    rng = random.Random(3)
    rows = [(i, rng.choice([0.1, 0.25, 0.5, rng.random()]), int(rng.random() < 0.3)) for i in range(300)]
    df = spark.createDataFrame([*rows, (999, None, 1)], "id int, s double, y int")
    order = sorted(rows, key=lambda r: (-r[1], r[0]))
    got = {r.id: r.posicao for r in ranking.ranked(df, "s", "id").collect()}
    assert got == {r[0]: k for k, r in enumerate(order, 1)}
    assert {r.id for r in ranking.top_fraction(df, "s", "id", 0.05).collect()} == {r[0] for r in order[:15]}
    m = metrics.ranking_metrics(df, "s", "y").first()
    pos, neg = [r for r in rows if r[2]], [r for r in rows if not r[2]]
    assert m.roc_auc == pytest.approx(sum((p[1] > n[1]) + (p[1] == n[1]) / 2 for p in pos for n in neg) / len(pos) / len(neg))
    steps = [(s, sum(r[2] for r in rows if r[1] == s), sum(r[2] for r in rows if r[1] >= s) / sum(1 for r in rows if r[1] >= s)) for s in {r[1] for r in rows}]
    assert m.average_precision == pytest.approx(sum(k / len(pos) * p for _, k, p in steps))
    t = metrics.top_metrics(df, "s", "y", "id", 0.1).first()
    assert (t.cutoff, t.selecionados) == (31, sum(r[2] for r in order[:31])) or t.cutoff == 30
    assert metrics.top_metrics(df.withColumn("y", F.lit(0)), "s", "y", "id").first().lift is None


def test_split_is_exact_and_repeatable(spark):
    df = spark.range(1000).withColumn("y", (F.col("id") % 4 == 0).cast("int"))
    one = sampling.stratified_split(df, "y", "id")
    assert {(r.y, r["sum"]) for r in one.groupBy("y").agg(F.sum(F.col("teste").cast("int")).alias("sum")).collect()} == {(0, 150), (1, 50)}
    assert sorted(map(tuple, one.collect())) == sorted(map(tuple, sampling.stratified_split(df.repartition(9), "y", "id").collect()))
    assert sampling.stratified_sample(df, "y", "id", 100).count() == 100


@pytest.fixture(scope="module")
def labelled(spark):
    rng = random.Random(1)
    rows = []
    for i in range(600):
        a, b = rng.gauss(0, 1), rng.gauss(5, 2)
        rows.append((i, a, None if i % 50 == 0 else b, float("inf") if i % 70 == 0 else 0.5 * a, int(a + 0.1 * rng.gauss(0, 1) > 0.3)))
    return spark.createDataFrame(rows, "id long, a double, b double, c double, y int")


def test_linear_model(spark, labelled, tmp_path):
    m = models.train_linear(labelled, ["a", "b"], "y", c=10.0)
    assert m.coefficients[0] > 5 * abs(m.coefficients[1])
    scored = models.score(labelled, m, "id", keep=["y", "nope"])
    assert metrics.ranking_metrics(scored, "score", "y").first().roc_auc > 0.95
    m.save(spark, f"{tmp_path}/m")
    again = models.LinearModel.load(spark, f"{tmp_path}/m")
    assert sorted(map(tuple, models.score(labelled, again, "id").collect())) == sorted((r.id, r.score) for r in scored.collect())
    # contributions add up to the logit without the intercept
    rows = labelled.withColumn("score", m.probability())
    total = explain.explain_linear(rows, m, "id", "score", 2).groupBy("id", "score").agg(F.sum("contribuicao").alias("z")).limit(20).collect()
    assert all(r.score == pytest.approx(1 / (1 + math.exp(-r.z - m.intercept)), abs=1e-9) for r in total)
    assert [r.variavel for r in models.coefficient_table(spark, m).collect()] == ["a", "b"]
    with pytest.raises(ValueError, match="leak"):
        models.train_linear(labelled, ["a"], "y", leaking=["a"])


def test_tree_models(spark, labelled, tmp_path):
    m = models.train_tree(labelled, ["a", "b", "c"], "y", kind="rf", depth=4, leaf=5, trees=10)
    assert metrics.ranking_metrics(models.score(labelled, m, "id", keep=["y"]), "score", "y").first().roc_auc > 0.95
    assert sum(m.importances()) == pytest.approx(1)
    m.save(spark, f"{tmp_path}/t")
    again = models.TreeModel.load(spark, f"{tmp_path}/t")
    assert again.importances() == m.importances() and again.meta == m.meta
    seen = Observation("any")  # a session that has observed something: a forest must still be sendable
    labelled.observe(seen, F.count(F.lit(1)).alias("n")).collect()
    assert seen.get == {"n": 600} and models.score(labelled, m, "id").count() == 600 and models.score(labelled, m, "id").collect()
    top = ranking.top_n(models.score(labelled, m, "id"), "score", "id", 5).join(labelled, "id")
    assert explain.explain_tree(top, m, "id", "score", 2).count() == 10


def test_train_and_evaluate(spark, labelled, tmp_path):
    """Metrics are those of the part kept aside; a saved model says them, and is refused where it doesn't fit."""
    for kind, more in (("linear", {}), ("tree", {"depth": 3, "leaf": 5})):
        m = models.train_and_evaluate(labelled, ["a", "b"], "y", "id", kind, rows=400, leaking=["c"], **more)
        split = sampling.stratified_split(sampling.stratified_sample(labelled, "y", "id", 400), "y", "id")
        want = metrics.ranking_metrics(models.score(split.where("teste"), m, "id", keep=["y"]), "score", "y").first()
        assert m.meta["metrics"]["roc_auc"] == pytest.approx(want.roc_auc) and want.roc_auc > 0.9
        assert m.meta["rows"] == {"train": split.where("not teste").count(), "test": split.where("teste").count()} and m.meta["caveat"] and m.meta["excluded"] == ["c"]
        m.save(spark, f"{tmp_path}/{kind}")
        again = type(m).load(spark, f"{tmp_path}/{kind}")
        assert again.meta == m.meta and models.check_usable(again, labelled, "id") is again
        for table, key in ((labelled.drop("b"), "id"), (labelled, "a"), (labelled, "nope")):
            with pytest.raises(ValueError):
                models.check_usable(again, table, key)
        again.meta["excluded"] = ["a"]
        with pytest.raises(ValueError, match="leak"):
            models.check_usable(again, labelled, "id")
    with pytest.raises(ValueError, match="leak"):
        models.train_and_evaluate(labelled, ["a"], "y", "id", leaking=["a"])
    row = models.metric_rows(spark, {"tree": m}).first()
    assert (row.modelo, row.roc_auc, row.top_cutoff) == ("tree", m.meta["metrics"]["roc_auc"], m.meta["metrics"]["top_cutoff"])


def test_lookup_of_two_models(spark, labelled):
    rows = labelled.withColumn("raiz", F.lpad(F.col("id").cast("string"), 8, "0"))
    linear = models.train_and_evaluate(rows, ["a", "b"], "y", "raiz")
    tree = models.train_and_evaluate(rows, ["a", "b"], "y", "raiz", "tree", depth=3, leaf=5)
    ask = spark.createDataFrame([("00000001",), ("00000001",), ("99999999",), ("x",)], "k string")
    got = lookup.lookup_models(ask, "k", {"um": (linear, rows), "dois": (tree, rows.where("id > 5"))}, "raiz", 2).collect()
    assert len(got) == 4 and sorted((r.um_status, r.dois_status) for r in got) == [("invalid_key", "invalid_key"), ("ok", "unavailable"), ("ok", "unavailable"), ("unavailable", "unavailable")]
    one = next(r for r in got if r.um_status == "ok")
    want = models.score(rows.where("id = 1"), linear, "raiz", keep=["y"]).first()
    assert (one.um_score, one.um_condicao, len(one.um_fatores), one.dois_score, one.dois_fatores) == (want.score, want.y, 2, None, None)
    both = lookup.lookup_models(ask.limit(0), "k", {"um": (linear, rows)}, "raiz")
    assert both.count() == 0 and "um_limitacao" in both.columns


def test_running_keeps_other_columns(spark):
    df = spark.range(50).select("id", F.lit(7).alias("__part"), F.lit(8).alias("place_off"), (F.col("id") % 3).alias("v"))
    got = ranking.running(df, [F.col("id").asc()], {"soma": F.col("v")}).orderBy("id").collect()
    assert [(r.place, r.soma, r["__part"], r.place_off) for r in got] == [(i + 1, sum(k % 3 for k in range(i + 1)), 7, 8) for i in range(50)]
    with pytest.raises(ValueError, match="posicao"):
        ranking.ranked(df.withColumn("posicao", F.lit(1)), "v", "id")


def test_features_without_values_are_left_out_and_named(spark, labelled):
    rows = labelled.withColumn("vazia", F.lit(None).cast("double"))
    for m in (models.train_linear(rows, ["a", "vazia", "b"], "y"), models.train_tree(rows, ["vazia", "a", "b"], "y", depth=2, leaf=5)):
        assert m.prepared.features == ["a", "b"] and m.meta["empty"] == ["vazia"] and models.score(rows, m, "id").count() == rows.count()
    with pytest.raises(ValueError, match="no feature"):
        models.train_linear(rows, ["vazia"], "y")


def test_strongest_breaks_ties_by_order(spark):
    part = lambda n, c: F.struct(F.lit(n).alias("variavel"), F.lit(c).alias("contribuicao"))
    got = spark.range(1).select(explain.strongest([part("a", 1.0), part("b", -3.0), part("c", -1.0)], 2).alias("f")).first().f
    assert [x.variavel for x in got] == ["b", "a"]


def test_lookup(spark):
    data = spark.createDataFrame([("12345678", 1), ("00000002", 2), ("00000002", 3)], "raiz string, v int")
    ask = spark.createDataFrame([("12.345.678/0001-95",), ("99999999",), ("7",), ("00000002",), (None,)], "k string")
    got = {r.pedido: (r.status, r.v) for r in lookup.lookup(ask, "k", data, "raiz", ["v"]).collect()}
    assert got == {"12.345.678/0001-95": ("ok", 1), "99999999": ("unavailable", None), "7": ("invalid_key", None), "00000002": ("duplicate_key", None), None: ("invalid_key", None)}


def test_datasets_from_raw_records(spark):
    est = spark.createDataFrame([("1", "1", "1", "2", "20200101", "20100101", "1", "sp", "7"), ("1", "2", "1", "08", "0", "20150101", "1", "EXT", "7"), ("", "1", "1", "2", "", "", "", "", "")], "cnpj_basico string, cnpj_ordem string, cnpj_dv string, situacao_cadastral string, data_situacao_cadastral string, data_inicio_atividade string, cnae_fiscal_principal string, uf string, municipio string")
    comp = spark.createDataFrame([("1", " B ", "3"), ("1", "A", None)], "cnpj_basico string, razao_social string, porte_empresa string")
    table = datasets.registry_table(datasets.registry(datasets.establishments(est), datasets.companies(comp)))
    assert tuple(table.first())[:4] == ("00000001", 2, 1, 1)
    assert A.registry_summary(table).first().consistente
