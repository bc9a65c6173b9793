"""The tables of the company-risk chain, from raw records to the two model datasets."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tributary.functions import dates, text
from tributary.functions.numbers import amount_marks, is_plain_number, mark_count, plain_money
from tributary.operators.aggregates import KEY, discontinuity_by_root, discontinuity_features, fiscal_by_root, fiscal_features, fiscal_target, registry_by_root
from tributary.operators.checks import require_columns
from tributary.operators.joins import left_join, unique_by_min
from tributary.operators.projections import legal_entities
from tributary.operators.sampling import hash_sample
from tributary.sources.staging import compiled, materialize

#: Columns of the registry table that are joined to debts.
REGISTRY_COLUMNS = ["qtd_estabelecimentos", "qtd_ativos", "qtd_inativos", "dt_inicio_min", "dt_inicio_max", "dt_situacao_max", "idade_empresa_dias"]
DEBT_REQUIRED = ["cpf_cnpj", "tipo_pessoa", "tipo_devedor", "numero_inscricao", "tipo_situacao_inscricao", "situacao_inscricao", "receita_principal", "data_inscricao", "indicador_ajuizado", "valor_consolidado", "unidade_responsavel", "ano", "trimestre"]

#: What the fiscal model may see, and what its target is made from.
FISCAL_FEATURES = ["qtd_inscricoes", "qtd_periodos", "qtd_irregular", "qtd_beneficio_fiscal", "qtd_negociacao", "qtd_suspenso_judicial", "qtd_garantia", "qtd_estabelecimentos", "qtd_ativos", "qtd_inativos", "idade_empresa_dias", "inscricoes_por_periodo"]
FISCAL_LEAKING = ["divida_total", "divida_media", "divida_max", "qtd_ajuizado", "pct_ajuizado", "divida_por_estabelecimento", "divida_por_estabelecimento_ativo", "proporcao_ajuizada_calculada"]

#: What the discontinuity model may see, and what its target is made from.
DISCONTINUITY_FEATURES = [
    "qtd_estabelecimentos",
    "idade_empresa_anos",
    "log1p_debt_divida_total",
    "debt_qtd_inscricoes",
    "debt_divida_media",
    "debt_divida_max",
    "debt_qtd_ajuizadas",
    "debt_pct_ajuizadas",
    "debt_qtd_receitas_distintas",
    "debt_qtd_situacoes_distintas",
    "debt_pct_irregular",
    "debt_pct_beneficio_fiscal",
    "debt_pct_negociacao",
    "debt_pct_suspenso_judicial",
    "debt_pct_garantia",
]
DISCONTINUITY_LEAKING = ["qtd_ativos", "qtd_inativos", "pct_ativos"]

#: What the features mean, in our words.
LABELS = {
    "qtd_inscricoes": "Inscrições da empresa",
    "qtd_periodos": "Trimestres em que há registro",
    "qtd_irregular": "Inscrições em cobrança",
    "qtd_beneficio_fiscal": "Inscrições com benefício",
    "qtd_negociacao": "Inscrições negociadas",
    "qtd_suspenso_judicial": "Inscrições suspensas por decisão",
    "qtd_garantia": "Inscrições garantidas",
    "qtd_estabelecimentos": "Estabelecimentos",
    "qtd_ativos": "Estabelecimentos em atividade",
    "qtd_inativos": "Estabelecimentos fora de atividade",
    "idade_empresa_dias": "Dias desde a primeira abertura",
    "idade_empresa_anos": "Anos desde a primeira abertura",
    "inscricoes_por_periodo": "Inscrições a cada trimestre",
    "log1p_debt_divida_total": "Total devido, em logaritmo",
    "debt_qtd_inscricoes": "Inscrições distintas",
    "debt_divida_media": "Média do valor devido",
    "debt_divida_max": "Maior valor devido de uma vez",
    "debt_qtd_ajuizadas": "Inscrições em juízo",
    "debt_pct_ajuizadas": "Parte das inscrições em juízo",
    "debt_qtd_receitas_distintas": "Receitas diferentes",
    "debt_qtd_situacoes_distintas": "Situações diferentes",
    "debt_pct_irregular": "Parte em cobrança",
    "debt_pct_beneficio_fiscal": "Parte com benefício",
    "debt_pct_negociacao": "Parte negociada",
    "debt_pct_suspenso_judicial": "Parte suspensa por decisão",
    "debt_pct_garantia": "Parte garantida",
}


def labels_of(features: list[str]) -> dict[str, str]:
    """Descriptions of those features that have one."""
    return {f: LABELS[f] for f in features if f in LABELS}


def consolidated(ledger: DataFrame, tested: tuple[str, ...] = ("tipo_pessoa", "cpf_cnpj")) -> DataFrame:
    """A ledger read as text: texts cleaned, amounts as double. tested: columns that a later filter names."""
    texts = [c for c, kind in ledger.dtypes if kind == "string" and c not in ("uf", "arquivo_origem")]
    # Each step is a projection of its own: Spark then makes what the next one uses more than once only once.
    # debts() filters by the kind of person, others by the key's root: Spark copies what a filter names.
    filtered = [c for c in texts if c in tested]
    out = _each(_each(_each(ledger, filtered, text.trim_once), [c for c in texts if c not in filtered], text.trim_all), texts, text.known)
    if "valor_consolidado" not in texts:
        return out
    amount = F.col("valor_consolidado")
    # Amounts that are not plain are few: their separators are counted where they are used, which saves all rows a projection.
    marks = out.withColumn("__marks", F.when(~is_plain_number(amount), amount_marks(amount)))  # null: the amount is plain, or null
    found = plain_money(F.col("__marks"), mark_count(F.col("__marks"), ","), mark_count(F.col("__marks"), "."))
    return marks.withColumn("valor_consolidado", F.when(F.col("__marks").isNull(), amount.try_cast("double")).otherwise(found)).drop("__marks")


def _each(df: DataFrame, columns: list[str], made) -> DataFrame:
    return df.select(*(made(F.col(c)).alias(c) if c in columns else F.col(c) for c in df.columns))


def ledger_debts(ledger: DataFrame, keyed: bool = False) -> DataFrame:
    """debts(consolidated(ledger)). Rows are left out before their texts are cleaned: Spark would copy the cleaning into the
    filter and do it twice. keyed: rows without a key are left out too, as every dataset of companies does; the root is then
    never null for Spark, and no later test of it is carried down to the ledger."""
    require_columns(ledger, DEBT_REQUIRED)
    kept = ledger.where(text.is_legal_raw(F.col("tipo_pessoa")))
    return _debts(consolidated(kept.where(text.has_key(F.col("cpf_cnpj"))) if keyed else kept, tested=()), True, keyed)


def debts(rows: DataFrame) -> DataFrame:
    """Inscriptions of legal entities with key, root, situation class, flag and date."""
    require_columns(rows, DEBT_REQUIRED)
    return _debts(legal_entities(rows), False, False)


def _debts(rows: DataFrame, cleaned: bool, keyed: bool) -> DataFrame:
    """cleaned: texts are as consolidated() leaves them. keyed: every row has a key."""
    c = F.col
    e, t = (c, c) if cleaned else (lambda n: text.empty_to_null(c(n)), lambda n: text.trim_all(c(n)))
    plain = ("tipo_devedor", "numero_inscricao", "situacao_inscricao", "tipo_situacao_inscricao", "receita_principal", "unidade_responsavel", *(n for n in ("nome_devedor",) if n in rows.columns))
    # What the next projection uses more than once is made first.
    made = rows.select("cpf_cnpj", text.shaped_key(c("cpf_cnpj")).alias("__shaped"), *(e(n).alias(n) for n in plain), t("data_inscricao").alias("data_inscricao"), dates.plain_eight(t("data_inscricao")).alias("__eight"), t("indicador_ajuizado").alias("indicador_ajuizado"), "valor_consolidado", "ano", "trimestre")
    digits = F.when(text.only_digits(c("__shaped")), c("__shaped")).otherwise(text.digits(c("cpf_cnpj")))
    made = made.withColumns({"__digits": digits, "__number": dates.day_number(c("__eight"))})
    key = F.coalesce(c("__digits"), F.lit("")) if keyed else F.when(F.length("__digits") == 14, c("__digits"))
    columns = [
        key.alias("chave"), text.root_of(key).alias(KEY), "tipo_devedor", "numero_inscricao", "situacao_inscricao", text.quick_situation(c("tipo_situacao_inscricao")).alias("tipo_situacao_inscricao"), "receita_principal",
        dates.ledger_day(c("data_inscricao"), c("__number")).alias("data_inscricao"), text.quick_yes_no(c("indicador_ajuizado")).alias("indicador_ajuizado"), c("valor_consolidado").try_cast("double").alias("valor_consolidado"), "unidade_responsavel", c("ano").cast("int").alias("ano"), c("trimestre").cast("byte").alias("trimestre"),
    ]
    return compiled(made.select(*columns, *plain[6:]))


def companies(raw: DataFrame, empty_is_zero: bool = True) -> DataFrame:
    """Company names and sizes under an 8-digit root; rows without a valid one are left out."""
    root = text.company_root(F.col("cnpj_basico"), empty_is_zero=empty_is_zero)
    return raw.select(root.alias(KEY), text.empty_to_null(F.col("razao_social")).alias("razao_social"), text.empty_to_null(F.col("porte_empresa")).alias("porte_empresa")).where(F.col(KEY).isNotNull())


def establishments(raw: DataFrame) -> DataFrame:
    """Establishments whose three key parts are valid."""
    c, days = F.col, ("data_situacao_cadastral", "data_inicio_atividade")
    widths = {"cnpj_basico": 8, "cnpj_ordem": 4, "cnpj_dv": 2, "situacao_cadastral": 2, "cnae_fiscal_principal": 7, "municipio": 4}
    # Digits and trimmed dates first: what the next projection uses more than once is made once.
    # Rows are filtered before: Spark would push a test of the key down, and make all its digits again three times there.
    keyed = raw.where(text.have_digits([c("cnpj_dv"), c("cnpj_ordem"), c("cnpj_basico")], [2, 4, 8]))
    eight = lambda n: F.when(F.length(c(n)) == 8, c(n)).otherwise(text.trim_all(c(n)))  # noqa: E731  (eight digits have nothing to trim)
    made = keyed.select(*(text.quick_digits(c(n)).alias(n) for n in widths), *(eight(n).alias(n) for n in days), F.upper(text.trim_all(c("uf"))).alias("uf"))
    made = made.withColumns({n: dates.day_number(c(n)) for n in days})
    part = lambda n: text.padded(c(n), widths[n])
    # No row is left whose root is null. Spark has to be told, or it carries later tests of it down to the raw text.
    sure = lambda n: F.coalesce(F.lpad(c(n), widths[n], "0"), F.lit(""))
    return compiled(made).select(
        text.join_key(sure("cnpj_basico"), sure("cnpj_ordem"), sure("cnpj_dv")).alias("chave"), sure("cnpj_basico").alias(KEY), part("situacao_cadastral").alias("situacao_cadastral"), dates.day_of(c(days[0])).alias(days[0]),
        part("cnae_fiscal_principal").alias("cnae_fiscal_principal"), F.when(F.length("uf") == 2, c("uf")).alias("uf"), part("municipio").alias("municipio"), dates.day_of(c(days[1])).alias(days[1]),
    )


def registry(establishment_rows: DataFrame, company_rows: DataFrame) -> DataFrame:
    """Establishments with their company's name and size and 0/1 `encontrado`; one company row per root first."""
    return left_join(establishment_rows, unique_by_min(company_rows, KEY, ["razao_social", "porte_empresa"]), KEY)


def registry_table(registry_rows: DataFrame, normal: bool = False, **kw) -> DataFrame:
    """registry_by_root after the root and the status got their zeros. normal: they have them, as those of establishments()."""
    if not normal:
        root = text.digits(text.trim_all(F.col(KEY)))
        registry_rows = registry_rows.withColumns({KEY: text.padded(root, 8), "situacao_cadastral": F.lpad(text.digits(text.trim_all(F.col("situacao_cadastral"))), 2, "0")})
    return registry_by_root(registry_rows, **kw)


def joined(debt_rows: DataFrame, registry_rows: DataFrame) -> DataFrame:
    """All inscriptions with the registry columns of their company; null roots stay without."""
    return left_join(debt_rows, registry_rows, KEY, REGISTRY_COLUMNS, match=None)


def fiscal_rows(debt_rows: DataFrame, registry_rows: DataFrame, threshold: int = 0, columns: list[str] | None = None) -> DataFrame:
    """One row per company with inscriptions and its features, written into the shared folder (see sources.staging). columns:
    only these beside the root, for those who read no others. A written table hides from Spark what is read of it, so that
    all would be made of the raw texts."""
    found = fiscal_features(fiscal_by_root(hash_sample(debt_rows, KEY, threshold), registry_rows))
    return materialize(_only(found, columns), "fiscal")


def fiscal_dataset(debt_rows: DataFrame, registry_rows: DataFrame, threshold: int = 0, columns: list[str] | None = None, **kw) -> DataFrame:
    """One row per company with inscriptions. The features are written first (see fiscal_rows), since the percentile and the
    result both read them. columns: only these beside the root and the target."""
    read = None if columns is None else [*columns, "divida_total", "qtd_ajuizado"]
    found = fiscal_target(fiscal_rows(debt_rows, registry_rows, threshold, read), **kw)
    return found if columns is None else found.drop(*({"divida_total", "qtd_ajuizado"} - set(columns)))


def discontinuity_dataset(debt_rows: DataFrame, registry_rows: DataFrame, threshold: int = 0, prefix: str = "debt_", columns: list[str] | None = None) -> DataFrame:
    """columns: only these beside the root, the target among them if it is wanted."""
    return _only(discontinuity_features(discontinuity_by_root(hash_sample(debt_rows, KEY, threshold), registry_rows, prefix=prefix), prefix), columns)


def _only(df: DataFrame, columns: list[str] | None) -> DataFrame:
    return df if columns is None else df.select(*dict.fromkeys([KEY, *columns]))
