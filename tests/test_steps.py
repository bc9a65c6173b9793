"""The cleaning steps that every company-risk query runs: what they make, and that they make it once."""

from pyspark.sql import functions as F

from tributary.functions import dates, numbers, text
from tributary.operators import aggregates, models
from tributary.plans import datasets, model_queries, probes, queries


def plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_establishments_are_filtered_without_making_their_digits_again(spark):
    parts = ["1", "12.345.678", "123456789", "", "x", None, " 7 ", "00000001"]
    rows = [(a, b, "09", "2", "19990101", "4711301", "sp", "1", d) for a in parts for b in ("1", "12345", None, "a1") for d in ("20000229", " 20000229 ", "20000230", "2000022", " 2000229", "0", None)]
    raw = spark.createDataFrame(rows, "cnpj_basico string, cnpj_ordem string, cnpj_dv string, situacao_cadastral string, data_situacao_cadastral string, cnae_fiscal_principal string, uf string, municipio string, data_inicio_atividade string")
    out = datasets.establishments(raw)
    days = {"20000229", " 20000229 "}
    want = sorted(("".join(c for c in a if c.isdigit()).zfill(8) + ("".join(c for c in b if c.isdigit())).zfill(4) + "09", "2000-02-29" if d in days else "") for a, b, *_, d in rows if a in ("1", "12.345.678", " 7 ", "00000001") and b in ("1", "a1"))
    assert sorted((r.chave, str(r.data_inicio_atividade or "")) for r in out.collect()) == want
    kept = [line for line in plan(out).splitlines() if "Filter" in line]
    assert all("regexp_replace" not in line for line in kept)


def test_a_ledger_is_cleaned_once(spark):
    amounts = ["1.234,56", "R$ 1,234.56", " 12,5 ", "1.234.567", "1,234,567", "1-2", "", "nan", None, "7", "-3.5"]
    rows = spark.createDataFrame([(i, x, " pj ") for i, x in enumerate(amounts)], "i int, valor_consolidado string, tipo_pessoa string").repartition(2)
    out = datasets.consolidated(rows)
    want = [r.v for r in rows.select("i", numbers.money(F.col("valor_consolidado")).alias("v")).orderBy("i").collect()]
    assert [r.valor_consolidado for r in out.orderBy("i").collect()] == want
    assert out.columns == rows.columns and plan(out).count("regexp_replace") == 1


def test_methods_that_the_jvm_would_interpret_are_not_made(spark):
    limit = "spark.sql.codegen.hugeMethodLimit"
    spark.conf.unset(limit)
    ledger = spark.createDataFrame([], ", ".join(f"{c} string" for c in datasets.DEBT_REQUIRED))
    datasets.debts(datasets.consolidated(ledger))
    assert int(spark.conf.get(limit)) <= 8000
    spark.conf.set(limit, 9000)
    datasets.debts(ledger)
    assert spark.conf.get(limit) == "9000"
    spark.conf.unset(limit)


def test_shorter_ways_of_the_cleaning_give_the_same(spark):
    days = ["01/02/2020", "31/02/2020", "2020-02-29", "2020-02-30", "01/01/0000", "1/2/2020", "1T/01/2020", "2020-01-1T", "01/01/2020 10:00", "2020-01-01 10:11:12", "　01/01/2020\t", "é", "", None]
    rows = spark.createDataFrame([(x,) for x in days], "t string").repartition(1)
    t = F.btrim("t", F.lit(text.WHITE))
    read = lambda p: F.try_to_timestamp(t, F.lit(p))
    slow = F.when(F.contains(t, F.lit("/")), read("d/M/yyyy")).when(F.contains(t, F.lit(":")), read("yyyy-M-d H:m:s")).otherwise(read("yyyy-M-d")).cast("timestamp_ntz")
    found = rows.select(text.trim_all(F.col("t")).alias("a"), t.alias("b"), dates.ledger_date(F.col("t")).alias("c"), slow.alias("d"))
    assert found.where("not (a <=> b) or not (c <=> d)").count() == 0


def test_both_datasets_clean_the_ledger_once(spark, monkeypatch):
    made, ledger = [], probes.ledger
    monkeypatch.setattr(probes, "ledger", lambda *a: made.append(1) or ledger(*a))
    model_queries.x_lookup_two(spark, "/root/testdata/sf0.001")
    assert len(made) == 1


def test_datasets_carry_no_test_of_the_root_down_to_the_raw_texts(spark):
    sf = "/root/testdata/sf0.001"
    registry = probes.registry_table(spark, sf)
    plans = [plan(x) for x in (aggregates.fiscal_by_root(probes.debts(spark, sf, keyed=True), registry), aggregates.discontinuity_by_root(probes.debts(spark, sf, keyed=True), registry))]
    kept = [line for p in plans for line in p.splitlines() if line.lstrip(" :+-").startswith("Filter")]
    assert kept and all("regexp_replace" not in line and "lpad(regexp" not in line for line in kept)
    assert probes.debts(spark, sf, keyed=True).exceptAll(probes.debts(spark, sf).where("raiz is not null")).isEmpty()


def test_bitmaps_carry_no_test_of_the_key_down_to_the_raw_texts(spark):
    maps = aggregates.key_bitmaps(probes.debts(spark, "/root/testdata/sf0.001"), "raiz", "ano", "trimestre")
    assert len(plan(maps)) < 20_000 and plan(maps).count("regexp_replace") == plan(maps).count("try_cast") == 1


def test_groups_without_a_number_have_no_bitmap(spark):
    keys = {0: ("x", None), 1: (None, "", "0"), 2: ("1" * 19, "-1"), 3: ("32768", "x", None)}
    maps = aggregates.key_bitmaps(spark.createDataFrame([(k, t) for t, some in keys.items() for k in some], "raiz string, t int"), "raiz", "t")
    assert sorted((r.t, r.balde is None) for r in maps.collect()) == [(1, False), (3, False)]
    assert {r.t: r.chaves for r in aggregates.bitmap_counts(maps, "t").collect()} == {1: 1, 3: 1} and aggregates.bitmap_counts(maps).first().chaves == 2


def test_a_ledger_filtered_before_its_texts_are_cleaned_is_the_same(spark):
    keys = ["12.345.678/0001-99", "12.345.678/0001-9x", "12345678000199", "1234567800019F", " 12.345.678/0001-99\t", "12.34a.678/0001-99", "12.345.678/0001-995", "１２345678000199", "nan", "", None]
    days = ["01/02/2020", "31/02/2020", "2000-02-29", "1900-02-29", "31/04/2020", "0999-01-01", "1T/01/2020", "AB/01/2020", "1/2/2020", "2020-01-01 10:11:12", None]
    kinds = ["Pessoa jurídica", " pj ", "PESSOA JURIDICA", "　PJ", "Pessoa física", "nan", None]
    said = [*text.USUAL_SITUATIONS, "EM COBRANÇA", "x negociada", "Garantia em cobrança", "Outra", "", None]
    flags = ["sim", "Sim", "S", "1", "True", "nao", "NÃO", "Não", "0", "talvez", "", None]
    cells = spark.range(3000).repartition(2).select(*(F.get(F.array(*(F.lit(x).cast("string") for x in v)), (F.abs(F.xxhash64("id", F.lit(n))) % len(v)).cast("int")).alias(n) for n, v in (("cpf_cnpj", keys), ("data_inscricao", days), ("tipo_pessoa", kinds), ("tipo_situacao_inscricao", said), ("indicador_ajuizado", flags))))
    ledger = cells.withColumns({n: F.lit("7") for n in datasets.DEBT_REQUIRED if n not in cells.columns})
    rows = datasets.consolidated(ledger).where(text.is_legal_entity(F.col("tipo_pessoa")))
    key = text.full_key(F.col("cpf_cnpj"))
    want = rows.select(key.alias("chave"), text.situation(F.col("tipo_situacao_inscricao")).alias("s"), dates.ledger_date(F.col("data_inscricao")).alias("d"), text.yes_no(F.col("indicador_ajuizado")).alias("f"))
    for keyed in (False, True):
        found = datasets.ledger_debts(ledger, keyed).select("chave", F.col("tipo_situacao_inscricao").alias("s"), F.col("data_inscricao").alias("d"), F.col("indicador_ajuizado").alias("f"))
        asked = want.where("chave is not null") if keyed else want
        assert not asked.isEmpty() and found.exceptAll(asked).isEmpty() and asked.exceptAll(found).isEmpty()


def test_registry_days_are_calendar_days(spark):
    days = ["20000229", "19000229", "20240431", "20240430", "20241231", "20241301", "20240001", "20240100", "00010101", "00000101", "2024010a", "abcdef12", "2024010", "", None]
    rows = spark.createDataFrame([(x,) for x in days], "t string").repartition(1)
    assert rows.where(~dates.day_of(dates.day_number(F.col("t"))).eqNullSafe(dates.registry_date(F.col("t"), True))).isEmpty()


def written(monkeypatch, module):
    """The plans of what the module writes from now on."""
    plans, write = [], module.materialize
    monkeypatch.setattr(module, "materialize", lambda df, *a, **kw: plans.append(plan(df)) or write(df, *a, **kw))
    return plans


def test_a_discontinuity_table_is_made_of_what_is_read_of_it(spark, monkeypatch):
    sf, plans = "/root/testdata/sf0.001", written(monkeypatch, queries)
    model_queries.m_tree_split(spark, sf)
    assert len(plans) == 1 and not any(c in plans[0] for c in ("valor_consolidado", "data_inscricao", "indicador_ajuizado", "receita_principal", "data_inicio_atividade"))
    some = queries.discontinuity(spark, sf, features=["debt_qtd_inscricoes", "debt_divida_max"])
    whole = datasets.discontinuity_dataset(probes.debts(spark, sf, keyed=True), probes.registry_table(spark, sf, closed=True))
    assert some.columns == ["raiz", "y_descontinuidade", "debt_qtd_inscricoes", "debt_divida_max"]
    assert some.count() == whole.count() > 0 and some.exceptAll(whole.select(some.columns)).isEmpty()


def test_a_fiscal_table_is_made_of_what_is_read_of_it(spark, monkeypatch):
    sf, plans = "/root/testdata/sf0.001", written(monkeypatch, datasets)
    model_queries.x_forest_score(spark, sf)
    assert len(plans) == 1 and not any(c in plans[0] for c in ("valor_consolidado", "data_inscricao", "indicador_ajuizado", "situacao", "receita_principal"))
    whole = queries.fiscal(spark, sf)
    some = queries.fiscal(spark, sf, ["qtd_inscricoes", "idade_empresa_dias"])
    assert some.columns == ["raiz", "qtd_inscricoes", "idade_empresa_dias", "y_risco_fiscal"]
    assert some.count() == whole.count() > 0 and some.exceptAll(whole.select(some.columns)).isEmpty()
    assert queries.fiscal(spark, sf, ["divida_total"]).columns == ["raiz", "divida_total", "y_risco_fiscal"]


def test_numeric_features_are_not_read_from_their_texts(spark):
    cells = "(double('nan'), 9007199254740993L, float('0.1'), '12', true), (-0.0D, -7L, float('inf'), ' 1e3 ', false), (1e-310D, null, null, 'x', null)"
    df = spark.sql(f"select * from values {cells} t(d, l, f, s, b)").repartition(1)
    got = df.select(*models.feature_columns(df.columns, ["d", "l"]))
    assert "as string" in plan(got) and "as string" not in plan(got.select("d", "l"))
    slow = [numbers.finite(numbers.number(F.col(c).cast("string"))).alias(c) for c in df.columns]
    assert got.exceptAll(df.select(*slow)).isEmpty() and df.select(*slow).exceptAll(got).isEmpty()
    # A column that has become text or another kind of number is read as before.
    other = df.select(F.col("s").alias("d"), F.col("f").alias("l"))
    assert other.select(*models.feature_columns(["d", "l"], ["d", "l"])).exceptAll(other.select(*models.feature_columns(["d", "l"]))).isEmpty()


def test_a_tree_and_a_forest_share_what_is_prepared(spark, monkeypatch):
    made, prepare = [], models.prepare
    monkeypatch.setattr(models, "prepare", lambda *a: made.append(1) or prepare(*a))
    rows = spark.range(200).selectExpr("cast(id % 7 as double) as a", "cast(id as string) as b", "cast(null as double) as c", "cast(id % 7 > 3 as int) as y")
    both = models.train_choice(rows, ["a", "b", "c"], "y", leaf=5, depth=2, trees=3)
    assert len(made) == 1 and both["tree"].prepared == both["rf"].prepared and both["rf"].meta["empty"] == ["c"] and both["rf"].prepared.numbers == ["a"]
    alone = models.train_choice(rows, ["a", "b", "c"], "y", choice="rf", leaf=5, depth=2, trees=3)["rf"]
    assert (alone.nodes, alone.prepared, alone.meta) == (both["rf"].nodes, both["rf"].prepared, both["rf"].meta)
