"""Trees as nodes against pyspark.ml, and the optimality of a linear model."""

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tributary.operators import models, trees
from tributary.operators.trees import Node


@pytest.fixture(scope="module")
def labelled(spark):
    rng = np.random.default_rng(3)
    rows = [(i, float(rng.integers(0, 9)), None if i % 10 == 0 else float(rng.normal()), float(rng.normal()), 0) for i in range(900)]
    rows = [(i, a, b, c, int(a + (b or 0) + rng.normal() > 5)) for i, a, b, c, _ in rows]
    df = spark.createDataFrame(rows, "id long, a double, b double, c double, y int").cache()
    df.count()
    return df


@pytest.mark.parametrize("kind", ["tree", "rf"])
def test_scores_and_importances_equal_those_of_the_library(spark, labelled, kind, tmp_path):
    names = ["a", "b", "c"]
    m = models.train_tree(labelled, names, "y", kind=kind, depth=6, leaf=5, trees=7)
    filled = labelled.select("id", *(c.alias(n) for c, n in zip(m.prepared.filled(), names, strict=True)))
    want = {r.id: r.p for r in m.fitted.transform(VectorAssembler(inputCols=names, outputCol="x").transform(filled).withColumnRenamed("x", "__x")).select("id", vector_to_array("probability")[1].alias("p")).collect()}
    m.save(spark, f"{tmp_path}/m")
    for model in (m, models.TreeModel.load(spark, f"{tmp_path}/m")):
        got = {r.id: r.score for r in models.score(labelled, model, "id").collect()}
        assert len(got) == 900 and all(got[i] == pytest.approx(want[i], abs=1e-12) for i in got) and len(set(got.values())) > 5
        assert model.importances() == pytest.approx([float(x) for x in m.fitted.featureImportances.toArray()], abs=1e-12)
    plan = models.score(labelled, m, "id")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "UDF" not in plan


def test_leaves_hold_the_training_rows(spark, labelled):
    m = models.train_tree(labelled, ["a", "b"], "y", depth=4, leaf=20, balanced=False)
    got = {r.no: (r.linhas, r.positivas) for r in trees.leaf_counts(labelled, m.nodes, m.prepared.filled(), "y").collect()}
    assert got == {x.no: (x.n, x.peso1) for x in m.nodes if x.leaf} and min(n for n, _ in got.values()) >= 20


def test_single_leaf_and_bad_nodes(spark, labelled):
    leaf = Node(0, 0, -1, 0.0, -1, -1, 4, 1.0, 3.0, -1.0)
    assert labelled.limit(2).select(trees.tree_probability([leaf], [F.col("a")]).alias("p")).collect() == [(0.75,), (0.75,)]
    assert trees.depth_of([leaf]) == 0 and trees.tree_importances(trees.node_frame(spark, [leaf])).count() == 0
    split = Node(0, 0, 0, 1.0, 1, 2, 4, 1.0, 3.0, 0.1)
    ends = [leaf._replace(no=1), leaf._replace(no=2)]
    assert trees.check_nodes([split, *ends], 1)
    for bad, n in (([split, ends[0]], 1), ([split._replace(direita=1), *ends], 1), ([split, *ends], 0), ([leaf._replace(no=1)], 1)):
        with pytest.raises(ValueError, match="no tree"):
            trees.check_nodes(bad, n)


def test_optimality(spark, labelled):
    m = models.train_linear(labelled, ["a", "b", "c"], "y", c=0.05, tol=1e-10, max_iter=500)
    found = {r.variavel: r for r in models.optimality(m, labelled).collect()}
    assert max(r.residuo for r in found.values()) < 1e-6 and set(found) == {"(intercepto)", "a", "b", "c"}
    assert found["c"].coeficiente == 0 and found["a"].coeficiente > 0  # the lasso part has left out what is noise
    m.coefficients[0] += 0.01
    assert max(r.residuo for r in models.optimality(m, labelled).collect()) > 1e-4
