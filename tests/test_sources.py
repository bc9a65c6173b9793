"""Files in many shapes, sinks and the streaming form."""

import hashlib

import pytest
from pyspark.sql import functions as F

from tributary.operators import lookup, sampling
from tributary.operators.aggregates import fiscal_state, fiscal_totals
from tributary.sources import delimited, tables
from tributary.streaming import quarters
from tributary.streaming.arrivals import windowed_totals


@pytest.fixture
def ledger(tmp_path):
    def put(where, name, data):
        (tmp_path / where).mkdir(parents=True, exist_ok=True)
        (tmp_path / where / name).write_bytes(data)

    put("ano=2024/trimestre=1", "x_SIDA_AC_1.csv", 'CPF CNPJ;Nome;Valor\n1;"a;""b""";1,5\n2;curto\n3;longo;2;9\n4;longo;2;\n7;longo;2;;9\n8;longo;2;;;\n\n5;NULL;3\n'.encode())
    put("ano=2024/trimestre=2", "y.CSV", "cpf_cnpj,valor,uf devedor\n6,7.5,São\n".encode("latin-1"))
    put("ano=2019/trimestre=1", "z_SIDA_SP_1.csv", b"cpf_cnpj;valor\n9;9\n")
    put("ano=2024/trimestre=5", "q.csv", b"cpf_cnpj;valor\n9;9\n")
    put("solto", "w.csv", b"cpf_cnpj;valor\n9;9\n")
    put("ano=2024/trimestre=3", "empty.csv", b"")
    put("ano=2025/trimestre=4", "head.csv", b"cpf_cnpj;valor\n")
    return str(tmp_path)


def test_inventory(spark, ledger):
    got = [tuple(r) for r in delimited.source_inventory(spark, ledger, years=(2024, 2025)).collect()]
    assert got == [("x_SIDA_AC_1.csv", 2024, 1, "AC", ";", "UTF-8", 3), ("y.CSV", 2024, 2, "NA", ",", "ISO-8859-1", 3), ("head.csv", 2025, 4, "NA", ";", "UTF-8", 2)]


def test_ledger(spark, ledger):
    df = delimited.read_ledger(spark, ledger)
    assert df.columns == ["cpf_cnpj", "nome", "valor", "uf_devedor", "ano", "trimestre", "uf", "arquivo_origem"]
    got = {r.cpf_cnpj: tuple(r)[1:] for r in df.collect()}
    assert got == {
        "1": ('a;"b"', "1,5", None, 2024, 1, "AC", "x_SIDA_AC_1.csv"), "2": ("curto", None, None, 2024, 1, "AC", "x_SIDA_AC_1.csv"), "5": (None, "3", None, 2024, 1, "AC", "x_SIDA_AC_1.csv"), "6": (None, "7.5", "São", 2024, 2, "NA", "y.CSV"),
    }
    assert df.select("arquivo_origem").groupBy("arquivo_origem").count().count() == 2 and df.select("nome").count() == 4  # whatever is read of a line
    with pytest.raises(ValueError, match="no usable"):
        delimited.read_ledger(spark, ledger, years=(1999,))


def test_registry_files(spark, tmp_path):
    (tmp_path / "c").mkdir()
    (tmp_path / "c" / "EMPRECSV").write_bytes("12;Pão;x;x;1;03;x;demais\n13;curta\n".encode("latin-1"))
    assert [tuple(r) for r in delimited.read_companies(spark, str(tmp_path / "c")).orderBy("cnpj_basico").collect()] == [("12", "Pão", "03"), ("13", "curta", None)]
    (tmp_path / "e").mkdir()
    (tmp_path / "e" / "ESTABELE").write_bytes(";".join(f'"{i}"' for i in range(30)).encode())
    assert tuple(delimited.read_establishments(spark, str(tmp_path / "e")).first()) == ("0", "1", "2", "5", "6", "10", "11", "19", "20")


def test_sinks(spark, tmp_path):
    path = f"{tmp_path}/t"
    assert tables.write_table(spark.range(10), path) == 10
    with pytest.raises(Exception, match="exists"):
        tables.write_table(spark.range(3), path)
    assert tables.write_table(spark.range(3).withColumn("ano", F.lit(1)), path, force=True, partition_by=["ano"]) == 3
    with pytest.raises(ValueError):
        tables.write_table(spark.range(0), f"{tmp_path}/none", need_rows=True)
    tables.write_report(spark.range(2), f"{tmp_path}/r")
    assert spark.read.option("header", True).csv(f"{tmp_path}/r").count() == 2
    assert all(len(r.sha256_16) == 16 and r.tamanho_mb > 0 for r in tables.file_inventory(spark, f"{tmp_path}/r", "*.csv").collect())
    tables.register_views(spark, {"t_view": path})
    assert spark.sql("select count(*) from t_view").first()[0] == 3 and tables.read_table(spark, path, ["id"]).columns == ["id"]


def test_digests_of_files_larger_than_a_chunk(spark, tmp_path):
    data = bytes(range(256)) * 1000
    (tmp_path / "deep").mkdir()
    for name, content in (("deep/a.bin", data), ("b.bin", b""), ("c.txt", b"x")):
        (tmp_path / name).write_bytes(content)
    got = {r.arquivo.rsplit("/", 1)[1]: (r.tamanho_mb, r.sha256_16) for r in tables.file_inventory(spark, str(tmp_path), "*.bin", chunk=1000).collect()}
    assert got == {"a.bin": (len(data) / 2**20, hashlib.sha256(data).hexdigest()[:16])}  # empty files are left out
    assert {r.sha256_16 for r in tables.file_inventory(spark, str(tmp_path), digest=False).collect()} == {None}


def test_run_log(spark, tmp_path):
    log = f"{tmp_path}/log"
    tables.log_run(spark, log, [{"etapa": "a", "status": "OK"}])
    tables.log_run(spark, log, [{"etapa": "b", "status": "ERROR", "mensagem": None}])
    assert {tuple(r) for r in tables.log_summary(spark, log).collect()} == {("OK", 1), ("ERROR", 1)}
    with pytest.raises(RuntimeError, match="ERROR"):
        tables.log_summary(spark, log, strict=True)


def test_stream_equals_batch(spark, tmp_path):
    rows = spark.range(100).select((F.col("id") % 3).alias("k"), (F.col("id") * 1.0).alias("v"), F.timestamp_seconds(F.col("id") * 86400 * 5).alias("t"))
    rows.write.parquet(f"{tmp_path}/in")
    stream = windowed_totals(spark.readStream.schema(rows.schema).parquet(f"{tmp_path}/in"), "k", "v", "t")
    q = stream.writeStream.outputMode("complete").format("memory").queryName("totals").start()
    q.processAllAvailable()
    q.stop()
    assert sorted(map(tuple, spark.table("totals").collect())) == sorted(map(tuple, windowed_totals(rows, "k", "v", "t").collect()))


def test_quarters_are_refreshed_one_by_one(spark, tmp_path):
    path, by = f"{tmp_path}/t", ["ano", "trimestre"]
    rows = spark.createDataFrame([(i, 2024, q) for q in (1, 2, 3) for i in range(20)], "v int, ano int, trimestre int")
    assert tables.refresh_partitions(rows.where("trimestre < 3"), path, by) == [("2024", "1"), ("2024", "2")]
    files = lambda q: sorted(p.name for p in (tmp_path / "t/ano=2024" / f"trimestre={q}").iterdir() if p.name.startswith("part"))
    first, second = files(1), files(2)
    with pytest.raises(ValueError, match="2024/2"):
        tables.refresh_partitions(rows.where("trimestre > 1"), path, by)
    assert not (tmp_path / "t/ano=2024/trimestre=3").exists()
    tables.refresh_partitions(rows.where("trimestre > 1").withColumn("v", -F.col("v")), path, by, force=True)
    assert files(1) == first and files(2) != second
    assert {r[0]: r[1] for r in spark.read.parquet(path).groupBy("trimestre").agg(F.sum("v")).collect()} == {1: 190, 2: -190, 3: -190}


INSCRIPTIONS = "raiz string, valor_consolidado double, indicador_ajuizado int, data_inscricao timestamp, ano int, trimestre int, tipo_situacao_inscricao string"


def test_quarters_that_arrive_one_by_one(spark, tmp_path):
    rows = spark.createDataFrame([(f"c{i % 5}", float(i), i % 2, None, 2024 + i % 2, 1 + i % 4, "garantia") for i in range(80)], INSCRIPTIONS)
    want = sorted(map(tuple, fiscal_totals(fiscal_state(rows)).collect()))
    for k, (year, quarter) in enumerate((y, q) for y in (2024, 2025) for q in (1, 2, 3, 4)):
        rows.where((F.col("ano") == year) & (F.col("trimestre") == quarter)).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        if k % 3 == 0:  # ends and goes on, several times
            quarters.follow(spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in"), f"{tmp_path}/s", f"{tmp_path}/c").awaitTermination()
    quarters.follow(spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in"), f"{tmp_path}/s", f"{tmp_path}/c").awaitTermination()
    assert sorted(map(tuple, quarters.totals(spark, f"{tmp_path}/s").collect())) == want
    versions = sorted(p.name for p in (tmp_path / "s").iterdir())
    assert len(versions) == 2
    last = int(versions[-1].split("=")[1])
    with pytest.raises(ValueError, match="no version"):
        quarters.fold(rows, last + 2, f"{tmp_path}/s")
    quarters.fold(rows, 0, f"{tmp_path}/old")
    quarters.fold(rows, 1, f"{tmp_path}/old")
    with pytest.raises(ValueError, match="begins"):
        quarters.fold(rows, 0, f"{tmp_path}/old")


def test_a_batch_delivered_twice_counts_once(spark, tmp_path):
    rows = spark.createDataFrame([("c", 1.0, 1, None, 2024, q, "garantia") for q in (1, 2)], INSCRIPTIONS)
    path = f"{tmp_path}/s"
    quarters.fold(rows.where("trimestre = 1"), 0, path)
    for _ in range(2):
        quarters.fold(rows.where("trimestre = 2"), 1, path)
    assert [(r.qtd_inscricoes, r.divida_total, r.qtd_periodos) for r in quarters.totals(spark, path).collect()] == [(2, 2.0, 2)]


def scanned(df):
    """Rows that the scans of a plan gave, after it has run."""
    df.collect()
    plan, out = df._jdf.queryExecution().executedPlan(), []
    plan = plan.executedPlan() if "AdaptiveSparkPlan" in plan.getClass().getName() else plan
    leaves = plan.collectLeaves()
    for i in range(leaves.size()):
        node = leaves.apply(i)
        node = node.plan().collectLeaves().apply(0) if "QueryStage" in node.getClass().getName() else node
        if "FileSourceScan" in node.getClass().getName():
            out.append(node.metrics().apply("numOutputRows").value())
    return sum(out)


def test_lookups_read_few_row_groups(spark, tmp_path):
    data = spark.range(20_000).select(F.lpad(F.col("id").cast("string"), 8, "0").alias("raiz"), F.col("id").alias("v"))
    tables.write_clustered(data, f"{tmp_path}/t", "raiz", group_rows=500)
    ask = lambda keys: spark.createDataFrame([(k,) for k in keys], "k string")
    few = lookup.pruned(spark.read.parquet(f"{tmp_path}/t"), "raiz", lookup.requests_of(ask(["00000007", "00012345", "99999999", "x", None]), "k"))
    assert sorted(r.v for r in few.collect()) == [7, 12345] and scanned(few) <= 2 * 500
    near = lookup.pruned(spark.read.parquet(f"{tmp_path}/t"), "raiz", lookup.requests_of(ask([f"{i:08}" for i in range(3000, 4000, 3)]), "k"))  # more than there are conditions
    assert near.count() >= 334 and scanned(near) <= 1500
    got = {r.pedido: (r.status, r.v) for r in lookup.lookup_stored(ask(["00000007", "x", "99999999"]), "k", f"{tmp_path}/t", "raiz", ["v"]).collect()}
    assert got == {"00000007": ("ok", 7), "x": ("invalid_key", None), "99999999": ("unavailable", None)}
    assert lookup.pruned(data, "raiz", lookup.requests_of(ask(["x"]), "k")).count() == 0


def test_sample_of_row_groups(spark, tmp_path):
    rows = spark.range(1000).select("id", F.concat(F.lit("t"), "id").alias("t"), F.timestamp_seconds("id").alias("when"))
    for k in range(2):
        rows.where(f"id % 2 = {k}").coalesce(1).write.option("parquet.block.row.count.limit", 100).parquet(f"{tmp_path}/in/p={k}")
    got = sampling.row_group_sample(spark, f"{tmp_path}/in", 7, 3, ["id", "t", "when"])
    # Groups 0, 4 (half to even) and 9 of ten.
    assert sorted(r.id for r in got.collect()) == [0, 2, 4, 800, 801, 802, 804] and [f.dataType for f in got.schema] == [f.dataType for f in rows.schema]
    assert all(r.t == f"t{r.id}" and r.when.timestamp() == r.id for r in got.collect())
    assert sampling.row_group_sample(spark, f"{tmp_path}/in", 0, 3).count() == 0 and sampling.row_group_sample(spark, f"{tmp_path}/in", 5000, 99, ["id"]).count() == 1000
    assert scanned(got) <= 10  # the table of row groups, not the rows
