"""Decision trees as tables of nodes: scoring as one column expression, importances, and checks of a fitted tree.

A node is (arvore, no, variavel, limiar, esquerda, direita, n, peso0, peso1, ganho): its feature's number (-1 for a leaf),
the threshold up to which a row goes left, its children, its training rows and their weights by class, and the gain of
its split. Nodes of a tree are numbered from 0, its root.
"""

from __future__ import annotations

import json
from itertools import groupby
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

NODE_DDL = "arvore int, no int, variavel int, limiar double, esquerda int, direita int, n long, peso0 double, peso1 double, ganho double"
#: The most nodes of a model: they travel with the plan.
MOST_NODES = 1 << 20


class Node(NamedTuple):
    arvore: int
    no: int
    variavel: int
    limiar: float
    esquerda: int
    direita: int
    n: int
    peso0: float
    peso1: float
    ganho: float

    @property
    def leaf(self) -> bool:
        return self.variavel < 0


def saved_nodes(spark: SparkSession, path: str) -> list[Node]:
    """Nodes of a pyspark.ml tree or forest classifier that was saved at the path."""
    data = spark.read.parquet(f"{path}/data")
    rows = data.select(F.col("treeID").alias("arvore"), "nodeData.*") if "treeID" in data.columns else data.select(F.lit(0).alias("arvore"), "*")
    nodes = rows.select(
        "arvore", F.col("id").alias("no"), F.col("split.featureIndex").alias("variavel"), F.coalesce(F.get("split.leftCategoriesOrThreshold", F.lit(0)), F.lit(0.0)).alias("limiar"), F.col("leftChild").alias("esquerda"), F.col("rightChild").alias("direita"),
        F.col("rawCount").alias("n"), F.get("impurityStats", F.lit(0)).alias("peso0"), F.get("impurityStats", F.lit(1)).alias("peso1"), F.col("gain").alias("ganho"), (F.col("split.numCategories") > 0).alias("categorias"),
    )
    found = nodes.limit(MOST_NODES + 1).collect()  # bounded by trees and depth
    if len(found) > MOST_NODES or any(r["categorias"] for r in found):
        raise ValueError(f"trees of more than {MOST_NODES} nodes, or of categories, are not supported")
    return sorted(Node(*r[:-1]) for r in found)


def check_nodes(nodes: list[Node], features: int) -> list[Node]:
    """Fails unless every tree is one: numbered from 0, each node but the root the child of exactly one, thresholds on
    features there are."""
    for tree, of in groupby(sorted(nodes), key=lambda x: x.arvore):
        of = list(of)
        children = sorted(c for x in of if not x.leaf for c in (x.esquerda, x.direita))
        if [x.no for x in of] != list(range(len(of))) or children != list(range(1, len(of))) or any(x.variavel >= features for x in of):
            raise ValueError(f"the nodes of tree {tree} are no tree over {features} features")
    return nodes


def depth_of(nodes: list[Node]) -> int:
    by, deepest = {(x.arvore, x.no): x for x in nodes}, 0
    level = [x for x in nodes if x.no == 0]
    while level := [by[x.arvore, c] for x in level if not x.leaf for c in (x.esquerda, x.direita)]:
        deepest += 1
    return deepest


def tree_probability(nodes: list[Node], values: list[Column]) -> Column:
    """The probability of class 1: the mean over the trees of their leaves' shares, walked inside the JVM without a vector
    or a Python function. values: the features without nulls."""
    trees = [[{"f": x.variavel, "t": x.limiar, "l": x.esquerda, "r": x.direita, "p": x.peso1 / (x.peso0 + x.peso1) if x.peso0 + x.peso1 else 0.0} for x in of] for _, of in groupby(sorted(nodes), key=lambda x: x.arvore)]
    forest = F.from_json(F.lit(json.dumps(trees)), "array<array<struct<f: int, t: double, l: int, r: int, p: double>>>")  # a constant of the plan
    steps = F.sequence(F.lit(1), F.lit(max(1, depth_of(nodes))))

    def leaf(tree: Column, x: Column) -> Column:
        def step(at: Column, _: Column) -> Column:
            node = F.get(tree, at)
            return F.when(node["f"] < 0, at).when(F.get(x, node["f"]) <= node["t"], node["l"]).otherwise(node["r"])

        return F.get(tree, F.aggregate(steps, F.lit(0), step))["p"]

    # The values are bound once as a lambda's variable: a plain array would be made again in every step.
    total = lambda x: F.aggregate(forest, F.lit(0.0), lambda s, tree: s + leaf(tree, x))
    return F.get(F.transform(F.array(F.array(*values)), total), F.lit(0)) / len(trees)


def node_frame(spark: SparkSession, nodes: list[Node]) -> DataFrame:
    return spark.createDataFrame(nodes, NODE_DDL)


def tree_importances(nodes: DataFrame) -> DataFrame:
    """variavel and importancia of the features that split: gains by the weight of the node, as shares of each tree, averaged over the
    trees and scaled to 1."""
    gains = nodes.where("variavel >= 0").groupBy("arvore", "variavel").agg(F.sum(F.col("ganho") * (F.col("peso0") + F.col("peso1"))).alias("g"))
    share = gains.withColumn("s", F.try_divide("g", F.sum("g").over(Window.partitionBy("arvore"))))
    total = share.groupBy("variavel").agg(F.sum("s").alias("importancia"))
    return total.withColumn("importancia", F.try_divide("importancia", F.sum("importancia").over(Window.partitionBy(F.lit(0)))))  # a row per feature


def leaf_counts(rows: DataFrame, nodes: list[Node], values: list[Column], target: str) -> DataFrame:
    """Of a single tree, rows and positives that end in each leaf: no, linhas, positivas."""
    numbered = [x._replace(peso0=float(-x.no), peso1=float(x.no + 1)) for x in nodes]  # the share of class 1 is then the leaf's number plus 1
    at = (tree_probability(numbered, values) - 1).cast("int")
    return rows.select(at.alias("no"), F.col(target).alias("__y")).groupBy("no").agg(F.count(F.lit(1)).alias("linhas"), F.sum("__y").cast("long").alias("positivas"))
