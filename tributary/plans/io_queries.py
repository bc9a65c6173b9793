"""Registered queries of sources, sinks and small checks: a table is written in the outside world's formats, read back by
the operators, and compared with the table itself."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tributary.functions import text
from tributary.operators import aggregates as A
from tributary.operators import joins, models, projections, ranking
from tributary.plans import probes
from tributary.plans.queries import _DEBTS, _REGISTRY, _labelled, query
from tributary.sources import delimited, tables
from tributary.sources.staging import new_folder
from tributary.sources.tables import driver_table


#: Rows of a file of a published folder, about.
FILE_ROWS = 1_000_000
#: The number of files that put_csv makes of a table: the same in SQL.
FILES_SQL = f"(SELECT 4 + count(*) // {FILE_ROWS} FROM {{}})"


def put_csv(df: DataFrame, folder: str, stem: str, sep: str, encoding: str, header: bool = True, key: Column | None = None, of: DataFrame | None = None, ending: str = "") -> None:
    """df as CSV files in the folder, {stem}_{number}{ending}: what an office publishes. A row's file is its key modulo the
    number of files, which grows with the table `of`; without a key there is one file, {stem}{ending}, for small tables."""
    spark, raw = df.sparkSession, f"{folder}-parts-{stem}"
    if key is None:
        parts = df.coalesce(1).withColumn("__p", F.lit(0))
    else:
        parts = df.withColumn("__p", key % (4 + of.count() // FILE_ROWS)).repartition("__p")
    parts.write.partitionBy("__p").options(sep=sep, encoding=encoding, header=header, emptyValue="", escape='"').csv(raw)
    path = spark._jvm.org.apache.hadoop.fs.Path
    files = path(raw).getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(path(folder))
    for f in files.globStatus(path(f"{raw}/__p=*/part-*")):  # a name per file
        number = f.getPath().getParent().getName().split("=")[1]
        files.rename(f.getPath(), path(f"{folder}/{stem}{'' if key is None else '_' + number}{ending}"))
    files.delete(path(raw), True)


def put_ledger(spark: SparkSession, sf_dir: str) -> str:
    """Orders as files of three shapes: other separators, encodings and headers, missing markers, line breaks, separators and
    quotes inside quotes, and a year nobody asks for."""
    o, folder, k = driver_table(spark, sf_dir, "orders"), new_folder(spark, "ledger"), F.col("o_orderkey")
    number, status = k.cast("string").alias("Número Inscrição"), F.when(k % 4 == 0, "N/A").otherwise(F.concat(F.lit("situação; "), "o_orderstatus")).alias("SITUAÇÃO")
    note = F.when(k % 5 == 0, F.concat("o_orderpriority", F.lit('\n"citado";\n\nfim'))).otherwise(F.col("o_orderpriority")).alias("Observação")
    for third, columns, where, stem, sep, encoding in (
        (0, [number, status, note], "ano=2024/trimestre=1", "arquivo_SIDA_SP", ";", "ISO-8859-1"), (1, [status, number], "ano=2025/trimestre=4", "arquivo", ",", "UTF-8"), (2, [number], "ano=2019/trimestre=2", "velho", ";", "UTF-8"),
    ):
        put_csv(o.where(k % 3 == third).select(*columns), f"{folder}/{where}", stem, sep, encoding, key=F.col("Número Inscrição").cast("long"), of=o, ending=".csv")
    return folder


_FILES = f"""SELECT CAST(o_orderkey AS VARCHAR) AS numero_inscricao, CASE WHEN o_orderkey % 4 <> 0 THEN 'situação; ' || o_orderstatus END AS situacao,
    CASE WHEN o_orderkey % 3 = 0 THEN o_orderpriority || CASE WHEN o_orderkey % 5 = 0 THEN chr(10) || '"citado";' || chr(10) || chr(10) || 'fim' ELSE '' END END AS observacao, CASE o_orderkey % 3 WHEN 0 THEN 2024 ELSE 2025 END AS ano,
    CAST(CASE o_orderkey % 3 WHEN 0 THEN 1 ELSE 4 END AS TINYINT) AS trimestre, CASE o_orderkey % 3 WHEN 0 THEN 'SP' ELSE 'NA' END AS uf,
    CASE o_orderkey % 3 WHEN 0 THEN 'arquivo_SIDA_SP_' ELSE 'arquivo_' END || (o_orderkey % {FILES_SQL.format("orders")}) || '.csv' AS arquivo_origem
    FROM orders WHERE o_orderkey % 3 < 2"""


@query("s_ledger", _FILES)
def s_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    return delimited.read_ledger(spark, put_ledger(spark, sf_dir))


@query("s_inventory", f"""WITH f AS ({_FILES}) SELECT arquivo_origem AS nome, ano, CAST(trimestre AS INT) AS trimestre, uf, CASE WHEN ano = 2024 THEN ';' ELSE ',' END AS separador, CASE WHEN ano = 2024 THEN 'ISO-8859-1' ELSE 'UTF-8' END AS codificacao,
    CASE WHEN ano = 2024 THEN 3 ELSE 2 END AS colunas, count(*) AS linhas FROM f GROUP BY ALL""")
def s_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The files' shapes beside the rows that were read from each."""
    folder = put_ledger(spark, sf_dir)
    rows = A.count_by(delimited.read_ledger(spark, folder), "arquivo_origem").select(F.col("arquivo_origem").alias("nome"), F.col("quantidade").alias("linhas"))
    return delimited.source_inventory(spark, folder, years=(2024, 2025)).join(rows, "nome")


@query("s_companies", "SELECT CAST(p_partkey AS VARCHAR) AS cnpj_basico, p_name AS razao_social, CASE WHEN p_size % 2 = 0 THEN CAST(p_size AS VARCHAR) END AS porte_empresa FROM part")
def s_companies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as headerless files with the registry's fields, the last ones missing here and there."""
    none = F.lit("").alias
    rows = driver_table(spark, sf_dir, "part").select(F.col("p_partkey").cast("string").alias("a"), "p_name", none("c"), none("d"), none("e"), F.when(F.col("p_size") % 2 == 0, F.col("p_size").cast("string")).otherwise("<NA>").alias("f"), none("g"))
    put_csv(rows, folder := new_folder(spark, "companies"), "EMPRECSV", ";", "ISO-8859-1", header=False, key=F.col("a").cast("long"), of=rows)
    return delimited.read_companies(spark, folder)


@query("s_establishments", "SELECT CAST(l_partkey AS VARCHAR) AS cnpj_basico, CAST(l_orderkey AS VARCHAR) AS cnpj_ordem, CAST(l_linenumber AS VARCHAR) AS cnpj_dv, CASE WHEN l_linestatus = 'F' THEN '02' ELSE '08' END AS situacao_cadastral, strftime(CAST(l_shipdate AS DATE), '%Y%m%d') AS data_situacao_cadastral, strftime(CAST(l_shipdate AS DATE), '%Y%m%d') AS data_inicio_atividade, NULL AS cnae_fiscal_principal, CASE WHEN l_returnflag = 'N' THEN 'São' END AS uf, CAST(l_suppkey AS VARCHAR) AS municipio FROM lineitem")
def s_establishments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as headerless files of 30 fields."""
    c, day = F.col, F.date_format("l_shipdate", "yyyyMMdd")
    own = {
        0: c("l_partkey").cast("string"), 1: c("l_orderkey").cast("string"), 2: c("l_linenumber").cast("string"), 5: F.when(c("l_linestatus") == "F", "02").otherwise("08"), 6: day, 10: day, 11: F.lit("NULL"),
        19: F.when(c("l_returnflag") == "N", "São").otherwise(""), 20: c("l_suppkey").cast("string"),
    }
    rows = driver_table(spark, sf_dir, "lineitem").select(*(own.get(i, F.lit("x")).alias(f"c{i}") for i in range(delimited.ESTABLISHMENT_WIDTH)))
    put_csv(rows, folder := new_folder(spark, "establishments"), "ESTABELE", ";", "ISO-8859-1", header=False, key=F.col("c1").cast("long"), of=rows)
    return delimited.read_establishments(spark, folder)


@query("k_table", "SELECT n_name, count(*) AS clientes, round(sum(c_acctbal), 2) AS saldo FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name")
def k_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A partitioned table written, counted, overwritten, read by columns and through views, and a query written from them."""
    path = new_folder(spark, "customers")
    customers = driver_table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal", "c_nationkey")
    tables.write_table(customers.limit(1), path, partition_by=["c_nationkey"])
    tables.write_table(customers, path, force=True, partition_by=["c_nationkey"], need_rows=True)
    tables.register_views(spark, {"k_customer": path, "k_nation": f"{sf_dir}/nation.parquet"})
    out = spark.sql("SELECT n_name, count(*) AS clientes, round(sum(c_acctbal), 2) AS saldo FROM k_customer JOIN k_nation ON c_nationkey = n_nationkey GROUP BY n_name")
    tables.write_table(out, again := new_folder(spark, "by-nation"))
    return tables.read_table(spark, again, ["n_name", "clientes", "saldo"])


@query("k_report", """WITH c AS (SELECT o_orderpriority AS prioridade, count(*) AS quantidade FROM orders GROUP BY o_orderpriority)
    SELECT *, (SELECT left(sha256('prioridade,quantidade' || chr(10) || string_agg(prioridade || ',' || quantidade || chr(10), '' ORDER BY prioridade)), 16) FROM c) AS sha256_16 FROM c""")
def k_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A report written as CSV in the order of its rows and read again, beside the digest of its one file."""
    counts = A.count_by(driver_table(spark, sf_dir, "orders"), "o_orderpriority").withColumnRenamed("o_orderpriority", "prioridade").orderBy("prioridade")
    tables.write_report(counts, path := new_folder(spark, "report"))
    digest = tables.file_inventory(spark, path, "part-*").first()["sha256_16"]  # of one file
    return spark.read.option("header", True).schema("prioridade string, quantidade long").csv(path).withColumn("sha256_16", F.lit(digest))


@query("k_digest", "SELECT left(sha256(string_agg(n_nationkey || ',' || n_name || chr(10), '' ORDER BY n_nationkey)), 16) AS sha256_16, round(sum(length(n_nationkey || ',' || n_name) + 1) / 1048576, 9) AS tamanho_mb FROM nation")
def k_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Size and digest of a file with the nations' names."""
    put_csv(driver_table(spark, sf_dir, "nation").select("n_nationkey", "n_name").orderBy("n_nationkey"), folder := new_folder(spark, "nations"), "nations", ",", "UTF-8", header=False, ending=".csv")
    return tables.file_inventory(spark, folder, "*.csv").select("sha256_16", F.round("tamanho_mb", 9).alias("tamanho_mb"))


@query("k_log", "SELECT CASE n_regionkey % 2 WHEN 0 THEN 'OK' ELSE 'SKIPPED_EXISTS' END AS status, count(*) AS quantidade FROM nation GROUP BY ALL")
def k_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run log with a row per nation, and its rows by status."""
    path = new_folder(spark, "log")
    for status, even in (("OK", 0), ("SKIPPED_EXISTS", 1)):
        names = driver_table(spark, sf_dir, "nation").where(F.col("n_regionkey") % 2 == even).select("n_name").collect()  # 25 nations
        tables.log_run(spark, path, [{"etapa": "leitura", "arquivo": r["n_name"], "status": status} for r in names])
    return tables.log_summary(spark, path, strict=True)


@query("r_typed", "SELECT c_custkey AS chave, c_custkey % 128 AS pequeno, CASE WHEN c_custkey % 3 > 0 THEN c_acctbal END AS saldo, c_name AS nome FROM customer")
def r_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed by name from text; what doesn't fit is null."""
    c = F.col
    raw = driver_table(spark, sf_dir, "customer").select(c("c_custkey").cast("string").alias("chave"), (c("c_custkey") % 128).cast("string").alias("pequeno"), F.when(c("c_custkey") % 3 == 0, "?").otherwise(c("c_acctbal").cast("string")).alias("saldo"), c("c_name").alias("nome"))
    return projections.typed(raw, {"chave": "bigint", "pequeno": "bigint", "saldo": "double"})


@query("r_pick", "SELECT c_custkey, c_name, c_mktsegment FROM customer WHERE length(regexp_replace(c_name, '[^0-9]', '', 'g')) BETWEEN 1 AND 9 AND c_mktsegment IS NOT NULL")
def r_pick(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Required and optional columns, digits of a width, no nulls."""
    rows = projections.pick(driver_table(spark, sf_dir, "customer"), ["c_custkey", "c_name"], ["absent", "c_mktsegment"])
    return projections.not_null(projections.root_length_filter(rows, "c_name", 9), "c_mktsegment")


@query("a_controls", "SELECT count(*) AS linhas, count(*) FILTER (o_totalprice > 100000) AS caros, count(*) FILTER (o_orderstatus = 'F') AS fechados FROM orders")
def a_controls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts that go along with a write."""
    seen = Observation("orders")
    rows = A.with_controls(driver_table(spark, sf_dir, "orders"), seen, caros=F.col("o_totalprice") > 100000, fechados=F.col("o_orderstatus") == "F")
    rows.write.format("noop").mode("overwrite").save()
    return spark.createDataFrame([tuple(seen.get[k] for k in ("linhas", "caros", "fechados"))], "linhas long, caros long, fechados long")


@query("w_first_rows", "SELECT o_orderkey, o_orderdate FROM orders ORDER BY o_orderdate DESC, o_orderkey LIMIT 30")
def w_first_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.first_rows(driver_table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate"), [F.desc("o_orderdate"), "o_orderkey"], 30)


@query("f_labels", "SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'fechado' WHEN 'O' THEN 'aberto' ELSE o_orderstatus END AS descricao FROM orders")
def f_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return driver_table(spark, sf_dir, "orders").select("o_orderkey", text.label(F.col("o_orderstatus"), {"F": "fechado", "O": "aberto"}).alias("descricao"))


@query("m_class_weights", "SELECT y, count(*) AS linhas, round((SELECT count(*) FROM orders) / (2 * count(*)), 9) AS peso FROM (SELECT CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS y FROM orders) GROUP BY y")
def m_class_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    return models.class_weights(_labelled(spark, sf_dir), "y").groupBy("y").agg(F.count(F.lit(1)).alias("linhas"), F.round(F.max("__w"), 9).alias("peso"))


@query("j_checked", f"WITH {_DEBTS}, {_REGISTRY} SELECT numero_inscricao, qtd_estabelecimentos, CASE WHEN reg.raiz IS NULL THEN 0 ELSE 1 END AS encontrado FROM debts LEFT JOIN reg ON debts.raiz = reg.raiz")
def j_checked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A left join that first sees that its right side's keys are unique."""
    right = probes.registry_table(spark, sf_dir).select("raiz", "qtd_estabelecimentos")
    return joins.checked_left_join(probes.debts(spark, sf_dir), right, "raiz").select("numero_inscricao", "qtd_estabelecimentos", "encontrado")
