"""The driver's contract, and the queries against their SQL on the smallest tables."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from tributary.plans.queries import SQL

DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def test_names():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no tables")
@pytest.mark.parametrize("name", ["f_keys", "f_money", "f_classes", "f_dates", "r_unify", "a_registry", "j_audit", "q_profile", "q_domains", "w_ranked", "e_ranking_metrics", "l_fiscal_dataset", "x_lookup", "s_ledger", "s_inventory", "s_companies", "k_table", "k_digest", "x_linear_factors", "x_lookup_scores", "q_systematic_sample", "l_discontinuity_target", "a_controls", "a_streamed_quarters", "a_merged_distinct", "k_quarters", "q_row_group_sample", "m_tree_split", "m_tree_checks", "m_linear_optimal", "x_forest_score", "x_lookup_two", "x_lookup_stored", "c_guards"])
def test_query_equals_sql(spark, name, tmp_path):
    entry.queries()[name](spark, DATA).write.parquet(f"{tmp_path}/out")
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{DATA}/{t}.parquet')")
    c.execute(f"CREATE TABLE want AS {SQL[name]}")
    c.execute(f"CREATE TABLE got AS SELECT * FROM read_parquet('{tmp_path}/out/*.parquet')")
    cols = sorted(r[0] for r in c.execute("DESCRIBE got").fetchall())
    assert cols == sorted(r[0] for r in c.execute("DESCRIBE want").fetchall())
    names = ", ".join(cols)
    for a, b in (("got", "want"), ("want", "got")):
        assert c.execute(f"SELECT count(*) FROM (SELECT {names} FROM {a} EXCEPT ALL SELECT {names} FROM {b})").fetchall() == [(0,)]
