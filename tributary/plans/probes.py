"""Stand-ins for the chain's inputs, derived from the star-schema tables: orders are inscriptions, line items are
establishments, parts and customers are companies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tributary.plans import datasets
from tributary.sources.tables import driver_table

SNAPSHOT = "1998-12-31"


def ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw inscriptions as text, as untidy as the real ones."""
    c, o = F.col, driver_table(spark, sf_dir, "orders")
    key = F.concat(F.lpad(c("o_custkey").cast("string"), 8, "0"), F.lit("0001"), F.lpad((c("o_custkey") % 97).cast("string"), 2, "0"))
    made = o.withColumns({"__digits": key, "__price": c("o_totalprice").cast("decimal(18,2)").cast("string"), "__day": c("o_orderdate").cast("date").cast("string")})
    digits, price, day = c("__digits"), c("__price"), c("__day")
    return made.select(
        F.when(c("o_custkey") % 17 == 0, "XXX123.456XX").when(c("o_orderkey") % 2 == 0, F.concat(F.substring(digits, 1, 2), F.lit("."), F.substring(digits, 3, 3), F.lit("."), F.substring(digits, 6, 3), F.lit("/"), F.substring(digits, 9, 4), F.lit("-"), F.substring(digits, 13, 2))).otherwise(digits).alias("cpf_cnpj"),
        F.when(c("o_orderkey") % 11 == 0, "Pessoa física").when(c("o_orderkey") % 3 == 0, " pj ").otherwise("Pessoa jurídica").alias("tipo_pessoa"), F.lit("PRINCIPAL").alias("tipo_devedor"), c("o_orderkey").cast("string").alias("numero_inscricao"),
        F.when((c("o_orderpriority") == "5-LOW") & (c("o_orderkey") % 2 == 0), "Com Garantia").otherwise(F.element_at(F.create_map(*(F.lit(x) for kv in SITUATIONS.items() for x in kv)), c("o_orderpriority"))).alias("tipo_situacao_inscricao"), c("o_orderpriority").alias("situacao_inscricao"), c("o_orderstatus").alias("receita_principal"),
        F.when(c("o_orderkey") % 5 == 0, day).otherwise(F.concat(F.substring(day, 9, 2), F.lit("/"), F.substring(day, 6, 2), F.lit("/"), F.substring(day, 1, 4))).alias("data_inscricao"),
        F.when(c("o_orderstatus") == "F", " sim").when(c("o_orderstatus") == "O", "NÃO").otherwise("talvez").alias("indicador_ajuizado"),
        F.when(c("o_orderkey") % 13 == 0, "").when(c("o_orderkey") % 7 == 0, F.concat(F.lit("R$ "), F.replace(price, F.lit("."), F.lit(",")))).otherwise(price).alias("valor_consolidado"),
        F.lit("CENTRO").alias("unidade_responsavel"), F.year("o_orderdate").alias("ano"), F.quarter("o_orderdate").alias("trimestre"),
    )


#: Texts of a situation for the order priorities; half of the last one's orders have a guarantee.
SITUATIONS = {"1-URGENT": "Em cobrança", "2-HIGH": "Benefício Fiscal", "3-MEDIUM": "Em negociação", "4-NOT SPECIFIED": "Suspenso por decisão judicial", "5-LOW": "Outra"}


def _eight(day: Column) -> Column:
    """A day of the years 1000 to 9999 as eight digits."""
    return (F.year(day) * 10000 + F.month(day) * 100 + F.day(day)).cast("string")


def raw_establishments(spark: SparkSession, sf_dir: str, closed: bool = False) -> DataFrame:
    """closed: every fourth company has no active establishment, and began five years earlier."""
    c, li = F.col, driver_table(spark, sf_dir, "lineitem")
    gone = (c("l_partkey") % 4 == 0) & F.lit(closed)
    began = F.when(gone, F.date_sub(c("l_shipdate").cast("date"), 1826)).otherwise(c("l_shipdate").cast("date")) if closed else c("l_shipdate")
    return li.select(
        c("l_partkey").cast("string").alias("cnpj_basico"), (c("l_orderkey") % 10000).cast("string").alias("cnpj_ordem"), F.when(c("l_linenumber") == 7, "").otherwise(c("l_linenumber").cast("string")).alias("cnpj_dv"),
        F.when((c("l_linestatus") == "F") & ~gone, "2").otherwise("08").alias("situacao_cadastral"), F.when(c("l_orderkey") % 9 == 0, "0").otherwise(_eight(c("l_shipdate"))).alias("data_situacao_cadastral"),
        F.lit("4711301").alias("cnae_fiscal_principal"), F.when(c("l_returnflag") == "N", "sp").otherwise("EXT").alias("uf"), c("l_suppkey").cast("string").alias("municipio"), _eight(began).alias("data_inicio_atividade"),
    )


def raw_companies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts, every fourth missing, every fifth twice with another name."""
    p = driver_table(spark, sf_dir, "part").where("p_partkey % 4 <> 0").select(F.col("p_partkey").cast("string").alias("cnpj_basico"), F.col("p_name").alias("razao_social"), F.col("p_size").cast("string").alias("porte_empresa"))
    return p.unionByName(p.where("cast(cnpj_basico as bigint) % 5 = 0").withColumn("razao_social", F.upper("razao_social")))


def debts(spark: SparkSession, sf_dir: str, keyed: bool = False) -> DataFrame:
    """keyed: only inscriptions with a company's key."""
    return datasets.ledger_debts(ledger(spark, sf_dir), keyed)


def registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    return datasets.registry(datasets.establishments(raw_establishments(spark, sf_dir)), datasets.companies(raw_companies(spark, sf_dir)))


def registry_table(spark: SparkSession, sf_dir: str, closed: bool = False) -> DataFrame:
    """Needs nothing of the companies' names, so that join is left out."""
    return datasets.registry_table(datasets.establishments(raw_establishments(spark, sf_dir, closed)), normal=True, snapshot=SNAPSHOT)


def joined(spark: SparkSession, sf_dir: str) -> DataFrame:
    return datasets.joined(debts(spark, sf_dir), registry_table(spark, sf_dir))
