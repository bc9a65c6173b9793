"""Line breaks in quotes in files that are split, against pandas; heads of files."""

import io
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tributary.sources import delimited, records

TINY = {"spark.sql.files.maxPartitionBytes": "60", "spark.sql.files.openCostInBytes": "1"}


@pytest.fixture
def tiny_splits(spark):
    for k, v in TINY.items():
        spark.conf.set(k, v)
    yield
    for k in TINY:
        spark.conf.unset(k)


def field(rng, sep):
    kind = rng.randrange(6)
    if kind == 0:
        return "".join(rng.choice(["a", "é", " ", "5\" x", "z"]) for _ in range(rng.randrange(1, 6)))  # a quote that is not at the beginning
    if kind == 1:
        return str(rng.randrange(10**6))
    text = "".join(rng.choice(["a", '""', "\n", "\r\n", sep, "ç", "\n\n", " ", ","]) for _ in range(rng.randrange(12)))
    return f'"{text}"' + (rng.choice(["x", 'y"z'])) * (rng.randrange(8) == 0)


def written(rng, sep, rows, end):
    n = lambda k: 3 if k == 0 else rng.choice([3, 3, 3, 2, 4])  # noqa: E731  of a first row that is too long pandas makes an index
    return "c1{0}c2{0}c3".format(sep) + end + "".join(sep.join(field(rng, sep) for _ in range(n(k))) + end for k in range(rows))


def by_pandas(data, sep):
    df = pd.read_csv(io.BytesIO(data), sep=sep, dtype="string", on_bad_lines="skip", engine="c", encoding="utf-8")
    return sorted((tuple(None if v is pd.NA else v for v in r) for r in df.itertuples(index=False)), key=str)


@pytest.mark.parametrize(("seed", "sep", "end"), [(1, ";", "\n"), (2, ",", "\r\n"), (3, ";", "\n")])
def test_ledger_equals_pandas_however_files_are_split(spark, tmp_path, tiny_splits, seed, sep, end):
    rng, want = random.Random(seed), []
    for k, rows in enumerate((80, 1, 40)):
        data = written(rng, sep, rows, end).encode()
        (tmp_path / f"ano=2024/trimestre={k + 1}").mkdir(parents=True)
        (tmp_path / f"ano=2024/trimestre={k + 1}/f.csv").write_bytes(data)
        want += [(k + 1, *r) for r in by_pandas(data, sep)]
    df = delimited.read_ledger(spark, str(tmp_path))
    got = sorted((tuple(r) for r in df.select("trimestre", "c1", "c2", "c3").collect()), key=str)
    assert spark.read.text(f"{tmp_path}/ano=2024/trimestre=1").rdd.getNumPartitions() > 10
    assert got == sorted(want, key=str)


def test_states_at_line_ends():
    for line, out, inside in [(b"", False, True), (b"a;b", False, True), (b'a"b', False, False), (b'"a', True, False), (b'"a"', False, False), (b'"a";"', True, True), (b'""', False, True), (b'"""', True, False), (b'x;"y""', True, False), (b'"a"b";"c', True, True), (b'";"', False, True)]:
        assert (records.ends_inside(line, False, b";"), records.ends_inside(line, True, b";")) == (out, inside), line


def test_native_screen_agrees_with_the_states(spark):
    rng = random.Random(7)
    lines = ["".join(rng.choice('";a') for _ in range(rng.randrange(10))) for _ in range(400)]
    got = spark.createDataFrame([(x,) for x in lines], "l string").select("l", records.leaves_open(F.col("l"), ";")).collect()
    assert all(r[1] == records.ends_inside(r[0].encode(), False, b";") for r in got)


def test_a_record_over_many_splits(spark, tmp_path, tiny_splits):
    long = "\n".join(f"linha {k};" for k in range(100))
    (tmp_path / "f").write_bytes(f'a;b\n1;2\n3;"{long}"\n4;5\n'.encode())
    rows = delimited.read_strings(spark, str(tmp_path), ["a", "b"], multiline=True).collect()
    assert sorted(map(tuple, rows)) == [("1", "2"), ("3", long), ("4", "5")]
    with pytest.raises(ValueError, match="more than 50 bytes"):
        records.quoted_records(spark, [str(tmp_path)], ";", most=50)
    (tmp_path / "f").write_bytes(b'a;b\n1;"2\n3;4\n')
    with pytest.raises(ValueError, match="inside a quoted"):
        records.quoted_records(spark, [str(tmp_path)], ";")
    with pytest.raises(RuntimeError, match="another way"):
        list(records.own_records(iter([records.pa.RecordBatch.from_pydict({"arquivo": [1], "bloco": [5], "linha": [b"x"]})]), b";", {1: {0: False}}, False))


def test_files_without_breaks_keep_the_plain_reader(spark, tmp_path):
    (tmp_path / "ano=2024/trimestre=1").mkdir(parents=True)
    (tmp_path / "ano=2024/trimestre=1/f.csv").write_bytes(b'a;b\n"1";"x;y"\n')
    plan = delimited.read_ledger(spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" not in plan and "csv" in plan
    assert [r.b for r in delimited.read_ledger(spark, str(tmp_path), multiline=False).collect()] == ["x;y"]
    with pytest.raises(TypeError):
        delimited.read_ledger(spark, str(tmp_path), nonsense=3)


def test_only_the_head_of_a_file_is_read(spark, tmp_path, monkeypatch):
    where = tmp_path / "ano=2024" / "trimestre=1"
    where.mkdir(parents=True)
    (where / "a_SIDA_RJ_1.csv").write_bytes("ação;b\n".encode() + b"x;y\n" * 400_000 + b"\xe7;z\n")  # the tail is not UTF-8
    (where / "cut.csv").write_bytes(b"a,b\n" + "é".encode() * 600_000)  # a character lies across the limit
    (where / "latin.csv").write_bytes("\xe7,b,c\r\n".encode("latin-1"))
    (where / ".hidden.csv").write_bytes(b"a;b\n")
    got = {r.nome: (r.cabecalho, r.separador, r.codificacao, r.colunas, r.uf) for r in delimited.probe(spark, str(tmp_path)).collect()}
    assert got == {"a_SIDA_RJ_1.csv": ("ação;b", ";", "UTF-8", 2, "RJ"), "cut.csv": ("a,b", ",", "UTF-8", 2, "NA"), "latin.csv": ("ç,b,c", ",", "ISO-8859-1", 3, "NA")}
    read = []

    class Stream(io.BytesIO):
        def read_at(self, n, at):
            read.append((at, n))
            return b"x" * n

    monkeypatch.setattr(delimited, "open_stream", lambda path: Stream())
    batch = delimited.pa.RecordBatch.from_pydict({"arquivo": ["f"], "tamanho": [10**12]})
    assert [b.column(1)[0].as_py() for b in delimited.heads(iter([batch]), 100)] == [b"x" * 100] and read == [(0, 100)]
    monkeypatch.setattr(delimited, "reached_by_python", lambda path: False)  # a store that only Spark reads
    other = {r.nome: (r.cabecalho, r.separador, r.codificacao) for r in delimited.probe(spark, str(tmp_path)).collect()}
    assert other["a_SIDA_RJ_1.csv"] == ("aÃ§Ã£o;b", ";", "ISO-8859-1") and other["cut.csv"] == ("a,b", ",", "UTF-8")  # it sees whole files
