"""Training, scoring and tables of models; all fitting is distributed."""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass, field

from pyspark.ml.classification import DecisionTreeClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tributary.functions.numbers import finite, number
from tributary.functions.text import label
from tributary.operators.aggregates import exact_percentiles
from tributary.operators.checks import check_at_least, require_both_classes, require_columns, require_rows
from tributary.operators.metrics import ranking_metrics, top_metrics
from tributary.operators.sampling import stratified_sample, stratified_split
from tributary.operators.trees import MOST_NODES, Node, check_nodes, node_frame, saved_nodes, tree_importances, tree_probability
from tributary.sources.staging import materialize, new_folder, scratch


#: Types whose values are the same numbers as double, read from their texts or not.
SAME_AS_DOUBLE = ("double", "bigint", "int", "smallint", "tinyint")


def feature_columns(features: list[str], numbers: list[str] = ()) -> list[Column]:
    """Finite numbers as double; null of all else. numbers: features of the types SAME_AS_DOUBLE, which are not written as text
    and read again in every pass. Where a table has one of them in another type, the plan keeps the way by its text."""
    text = lambda c: number(c.cast("string"))
    read = lambda n: F.when(F.typeof(n).isin(*SAME_AS_DOUBLE), number(F.col(n))).otherwise(text(F.col(n))) if n in numbers else text(F.col(n))
    return [finite(read(c)).alias(c) for c in features]


def check_features(features: list[str], leaking: list[str]) -> list[str]:
    if both := sorted(set(features) & set(leaking)):
        raise ValueError(f"features that leak the target: {', '.join(both)}")
    return features


@dataclass
class Prepared:
    """Medians, means and standard deviations of the training rows."""

    features: list[str]
    medians: list[float]
    means: list[float] = field(default_factory=list)
    deviations: list[float] = field(default_factory=list)
    #: Features that were numbers in the training rows (see feature_columns).
    numbers: list[str] = field(default_factory=list)

    def filled(self) -> list[Column]:
        return [F.coalesce(c, F.lit(m)) for c, m in zip(feature_columns(self.features, self.numbers), self.medians, strict=True)]

    def standard(self) -> list[Column]:
        return [(c - F.lit(m)) / F.lit(d or 1.0) for c, m, d in zip(self.filled(), self.means, self.deviations, strict=True)]


def prepare(train: DataFrame, features: list[str]) -> Prepared:
    """Exact medians, then means and deviations in one aggregation. Features without any value are left out (see `empty` in a
    model's meta); none at all is an error. train is read three times: give a table, not a long chain."""
    numbers = [c for c, kind in train.select(*features).dtypes if kind in SAME_AS_DOUBLE]
    found = exact_percentiles(train.select(*feature_columns(features, numbers)), features, [0.5])
    features = [c for c in features if found[c][0] is not None]
    if not features:
        raise ValueError("no feature has any value")
    out = Prepared(features, [found[c][0] for c in features], numbers=[c for c in features if c in numbers])
    filled = train.select(*(c.alias(n) for c, n in zip(out.filled(), features, strict=True)))
    moments = filled.agg(*(x for c in features for x in (F.avg(c), F.stddev_pop(c)))).first()
    out.means, out.deviations = [float(x) for x in moments[::2]], [float(x) for x in moments[1::2]]
    return out


def class_weights(train: DataFrame, target: str, balanced: bool = True) -> DataFrame:
    """train with __w: n / (2 * rows of the class), or 1."""
    if not balanced:
        return train.withColumn("__w", F.lit(1.0))
    n = {int(r[0]): r[1] for r in train.groupBy(F.col(target).cast("int")).count().collect()}  # two rows
    total = sum(n.values())
    return train.withColumn("__w", F.when(F.col(target) == 1, total / (2 * n[1])).otherwise(total / (2 * n[0])))


@dataclass
class LinearModel:
    prepared: Prepared
    coefficients: list[float]
    intercept: float
    meta: dict

    def logit(self) -> Column:
        z = F.lit(self.intercept)
        for c, w in zip(self.prepared.standard(), self.coefficients, strict=True):
            z = z + c * F.lit(w)
        return z

    def probability(self) -> Column:
        return 1 / (1 + F.exp(-self.logit()))

    def save(self, spark: SparkSession, path: str, force: bool = False) -> None:
        spark.createDataFrame([(json.dumps(asdict(self)),)], "model string").coalesce(1).write.mode("overwrite" if force else "errorifexists").parquet(path)

    @staticmethod
    def load(spark: SparkSession, path: str) -> LinearModel:
        raw = json.loads(spark.read.parquet(path).first()[0])
        if gone := {"prepared", "coefficients", "intercept", "meta"} - raw.keys():
            raise ValueError(f"no usable model, it lacks: {', '.join(sorted(gone))}")
        return LinearModel(Prepared(**raw["prepared"]), raw["coefficients"], raw["intercept"], raw["meta"])


def train_linear(train: DataFrame, features: list[str], target: str, c: float = 1.0, l1_ratio: float = 0.5, max_iter: int = 200, tol: float = 1e-4, balanced: bool = True, leaking: list[str] = ()) -> LinearModel:
    """Elastic-net logistic regression on standardised features; regParam 1 / (c * n) gives the same objective as C."""
    if c <= 0 or not 0 <= l1_ratio <= 1:
        raise ValueError("c must be above 0 and l1_ratio between 0 and 1")
    check_features(features, leaking)
    require_both_classes(require_columns(train, [*features, target]), target)
    asked, p = features, prepare(train, features)
    features = p.features
    rows = class_weights(train.where(F.col(target).isNotNull()), target, balanced).select(*(x.alias(n) for x, n in zip(p.standard(), features, strict=True)), F.col(target).cast("double").alias("__y"), "__w")
    data = VectorAssembler(inputCols=features, outputCol="__x").transform(rows).select("__x", "__y", "__w")
    m = LogisticRegression(featuresCol="__x", labelCol="__y", weightCol="__w", elasticNetParam=l1_ratio, regParam=1 / (c * data.count()), maxIter=max_iter, tol=tol, standardization=False).fit(data)
    meta = {"target": target, "excluded": list(leaking), "empty": [c for c in asked if c not in features], "parameters": {"c": c, "l1_ratio": l1_ratio, "max_iter": max_iter, "tol": tol, "balanced": balanced}}
    return LinearModel(p, [float(x) for x in m.coefficients.toArray()], float(m.intercept), meta)


@dataclass
class TreeModel:
    """A tree or a forest as its nodes. fitted: the pyspark.ml model, of a model that was fitted in this session."""

    prepared: Prepared
    nodes: list[Node]
    meta: dict
    fitted: object = None

    def probability(self) -> Column:
        return tree_probability(self.nodes, self.prepared.filled())

    def scored(self, df: DataFrame, score: str) -> DataFrame:
        return df.withColumn(score, self.probability()).select(*df.columns, score)

    def importances(self) -> list[float]:
        spark = SparkSession.active()
        found = {r[0]: r[1] for r in tree_importances(node_frame(spark, self.nodes)).collect()}  # a row per feature
        return [float(found.get(i) or 0.0) for i in range(len(self.prepared.features))]

    def save(self, spark: SparkSession, path: str, force: bool = False) -> None:
        mode = "overwrite" if force else "errorifexists"
        node_frame(spark, self.nodes).coalesce(1).write.mode(mode).parquet(f"{path}/nodes")
        meta = json.dumps({"prepared": asdict(self.prepared), "meta": self.meta})
        spark.createDataFrame([(meta,)], "meta string").coalesce(1).write.mode(mode).parquet(f"{path}/meta")

    @staticmethod
    def load(spark: SparkSession, path: str) -> TreeModel:
        raw = json.loads(spark.read.parquet(f"{path}/meta").first()[0])
        if gone := {"prepared", "meta"} - raw.keys():
            raise ValueError(f"no usable model, it lacks: {', '.join(sorted(gone))}")
        prepared = Prepared(**raw["prepared"])
        nodes = [Node(*r) for r in spark.read.parquet(f"{path}/nodes").limit(MOST_NODES).collect()]
        return TreeModel(prepared, check_nodes(sorted(nodes), len(prepared.features)), raw["meta"])


def train_tree(train: DataFrame, features: list[str], target: str, kind: str = "tree", depth: int = 12, leaf: int | None = None, trees: int = 300, balanced: bool = True, seed: int = 42, leaking: list[str] = (), prepared: Prepared | None = None) -> TreeModel:
    """kind: tree (least leaf 200) or rf (least leaf 50). prepared: prepare(train, features), where it is known already."""
    if kind not in ("tree", "rf"):
        raise ValueError("kind must be tree or rf")
    leaf = leaf or (200 if kind == "tree" else 50)
    for value, name in ((depth, "depth"), (leaf, "leaf"), (trees, "trees")):
        check_at_least(value, 1, name)
    check_features(features, leaking)
    require_both_classes(require_columns(train, [*features, target]), target)
    asked, p = features, prepared or prepare(train, features)
    features = p.features
    rows = class_weights(train.where(F.col(target).isNotNull()), target, balanced).select(*(x.alias(n) for x, n in zip(p.filled(), features, strict=True)), F.col(target).cast("double").alias("__y"), "__w")
    data = VectorAssembler(inputCols=features, outputCol="__x").transform(rows).select("__x", "__y", "__w")
    common = {"featuresCol": "__x", "labelCol": "__y", "weightCol": "__w", "maxDepth": depth, "minInstancesPerNode": leaf, "maxBins": 256, "seed": seed}
    made = DecisionTreeClassifier(**common) if kind == "tree" else RandomForestClassifier(**common, numTrees=trees, featureSubsetStrategy="sqrt")
    meta = {"kind": kind, "target": target, "excluded": list(leaking), "empty": [c for c in asked if c not in features], "parameters": {"depth": depth, "leaf": leaf, "trees": trees if kind == "rf" else 1, "balanced": balanced, "seed": seed}}
    fitted = made.fit(data)
    with scratch():
        path = new_folder(train.sparkSession, "fitted-tree")
        fitted.save(path)
        nodes = check_nodes(saved_nodes(train.sparkSession, path), len(features))
    # The copy has no training summary: that holds the session, which a scoring job cannot be sent once it has observed something.
    return TreeModel(p, nodes, meta, fitted.copy())


def train_choice(train: DataFrame, features: list[str], target: str, choice: str = "both", **kw) -> dict[str, TreeModel]:
    if choice not in ("tree", "rf", "both"):
        raise ValueError("choice must be tree, rf or both")
    if choice != "both":
        return {choice: train_tree(train, features, target, kind=choice, **kw)}
    tree = train_tree(train, features, target, kind="tree", **kw)
    return {"tree": tree, "rf": train_tree(train, features, target, kind="rf", **{**kw, "prepared": tree.prepared})}


def optimality(model: LinearModel, train: DataFrame) -> DataFrame:
    """How far a fitted linear model is from the optimum of its objective: variavel, coeficiente, gradiente, residuo.

    gradiente: of the weighted mean loss and the ridge part, at the coefficients, in one aggregation over the training rows.
    residuo: the distance of 0 from the gradient and the subgradients of the lasso part, 0 for all features (and the
    intercept, which has no penalty) at the optimum and nowhere else."""
    p, how = model.prepared, model.meta["parameters"]
    target = model.meta["target"]
    rows = class_weights(train.where(F.col(target).isNotNull()), target, how["balanced"])
    x = [c.alias(f"x{i}") for i, c in enumerate(p.standard())]
    slope = F.col("__w") * (model.probability() - F.col(target))
    cols = rows.select(*x, slope.alias("d"), "__w")
    sums = cols.agg(F.count(F.lit(1)), F.sum("__w"), F.sum("d"), *(F.sum(F.col("d") * F.col(f"x{i}")) for i in range(len(x)))).first()
    strength, ratio_ = 1 / (how["c"] * sums[0]), how["l1_ratio"]
    out = [("(intercepto)", model.intercept, sums[2] / sums[1], abs(sums[2] / sums[1]))]
    for name, b, g in zip(p.features, model.coefficients, sums[3:], strict=True):
        g, lasso = g / sums[1] + strength * (1 - ratio_) * b, strength * ratio_
        out.append((name, b, g, abs(g + lasso * (1 if b > 0 else -1)) if b else max(0.0, abs(g) - lasso)))
    return train.sparkSession.createDataFrame(out, "variavel string, coeficiente double, gradiente double, residuo double")


def score(df: DataFrame, model: LinearModel | TreeModel, key: str, name: str = "score", keep: list[str] = (), need_rows: bool = False) -> DataFrame:
    """key, the columns of keep that there are (such as the target), and the probability. need_rows: a job first sees
    that there are any."""
    require_columns(df, [key, *model.prepared.features])
    if need_rows:
        require_rows(df)
    keep = [c for c in keep if c in df.columns]
    out = df.withColumn(name, model.probability())
    return out.select(key, *keep, name)


#: Said with every score: what it is not.
CAVEATS = {
    "linear": "o score ordena empresas; não é probabilidade calibrada nem prova de causa",
    "tree": "o score ordena empresas de um recorte; fatores descrevem, não explicam causas",
    "rf": "o score ordena empresas de um recorte; fatores descrevem, não explicam causas",
}


def evaluate(model: LinearModel | TreeModel, rows: DataFrame, key: str, target: str, fraction: float = 0.1) -> dict:
    """Metrics of the model's scores on rows it has not seen, in one dictionary: n, positives, prevalence, area under the
    curve, average precision, Brier score, and those of the best fraction."""
    scored = materialize(score(rows, model, key, keep=[target]), "scored")
    return {**ranking_metrics(scored, "score", target).first().asDict(), **{f"top_{k}": v for k, v in top_metrics(scored, "score", target, key, fraction).first().asDict().items()}, "fraction": fraction}


def train_and_evaluate(df: DataFrame, features: list[str], target: str, key: str, kind: str = "linear", rows: int | None = None, test: float = 0.2, seed: int = 42, **kw) -> LinearModel | TreeModel:
    """Sample (if rows is given), exact split by class, fit on one part, metrics on the other; meta holds them, the sizes of
    both parts, the split, and a caveat. df is read more than once: the split is written into the shared folder."""
    check_features(features, kw.get("leaking", ()))
    known = df.where(F.col(target).isNotNull()).select(key, target, *features)
    sampled = stratified_sample(known, target, key, rows, seed) if rows else known
    with scratch():
        split = materialize(stratified_split(sampled, target, key, test, seed), "split")
        fit_on, kept = split.where("not teste").drop("teste"), split.where("teste").drop("teste")
        model = train_linear(fit_on, features, target, **kw) if kind == "linear" else train_tree(fit_on, features, target, kind=kind, **kw)
        model.meta |= {"metrics": evaluate(model, kept, key, target), "rows": {"train": fit_on.count(), "test": kept.count()}, "split": {"test": test, "seed": seed, "sample": rows}, "caveat": CAVEATS[kind]}
    return model


def check_usable(model: LinearModel | TreeModel, df: DataFrame, key: str) -> LinearModel | TreeModel:
    """Fails unless the model fits the table and itself: key and features are there once, none of them is excluded, medians
    (and of a linear model means, deviations and coefficients) are as many as features, the caveat and the target are told."""
    p = model.prepared
    require_columns(df, [key, *p.features])
    check_features(p.features, model.meta.get("excluded", ()))
    if len(set(p.features)) < len(p.features) or not p.features:
        raise ValueError("the model's features are empty or repeat")
    sizes = [len(p.medians)] + ([len(p.means), len(p.deviations), len(model.coefficients)] if isinstance(model, LinearModel) else [len(model.importances())])
    if set(sizes) != {len(p.features)}:
        raise ValueError(f"{len(p.features)} features, but {sizes} values")
    if gone := [k for k in ("target", "excluded", "metrics", "caveat") if not model.meta.get(k) and model.meta.get(k) != []]:
        raise ValueError(f"the model doesn't say: {', '.join(gone)}")
    if key in p.features or model.meta["target"] in p.features:
        raise ValueError("key and target cannot be features")
    return model


def metric_rows(spark: SparkSession, models: dict[str, LinearModel | TreeModel]) -> DataFrame:
    """One row per model with the metrics in its meta."""
    names = ("n", "positivos", "prevalencia", "roc_auc", "average_precision", "brier", "top_cutoff", "top_lift", "top_precision", "top_recall")
    kinds = ", ".join(f"{n} {'long' if n in ('n', 'positivos', 'top_cutoff') else 'double'}" for n in names)
    return spark.createDataFrame([(k, *(m.meta["metrics"][n] for n in names)) for k, m in models.items()], f"modelo string, {kinds}")


def coefficient_table(spark: SparkSession, model: LinearModel, labels: dict[str, str] | None = None) -> DataFrame:
    rows = spark.createDataFrame(list(zip(model.prepared.features, model.coefficients, strict=True)), "variavel string, coeficiente double")
    c = F.col("coeficiente")
    out = rows.withColumns({"coeficiente_absoluto": F.abs(c), "razao_chances": F.exp(F.greatest(F.lit(-50.0), F.least(F.lit(50.0), c))), "direcao": F.when(c > 0, "aumenta o score").when(c < 0, "reduz o score").otherwise("efeito nulo"), "descricao": label(F.col("variavel"), labels or {})})
    return out.orderBy(F.desc("coeficiente_absoluto"), "variavel")


def importance_table(spark: SparkSession, model: TreeModel, labels: dict[str, str] | None = None) -> DataFrame:
    rows = spark.createDataFrame(list(zip(model.prepared.features, model.importances(), strict=True)), "variavel string, importancia double")
    return rows.withColumns({"importancia_percentual": 100 * F.col("importancia"), "descricao": label(F.col("variavel"), labels or {})}).orderBy(F.desc("importancia"), "variavel")
