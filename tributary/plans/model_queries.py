"""Registered queries of fitted and fixed models whose results SQL can tell: the best split of a tree, checks that hold for
every fitted model, scores of fixed trees, lookups in two fixed models, and the messages of guards."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tributary.operators import checks, lookup, models, trees
from tributary.operators.trees import Node
from tributary.plans import datasets, probes
from tributary.plans.queries import _DEBTS, _DISC, _FISCAL, _REGISTRY, _X, discontinuity, fiscal, fiscal_rows, query, rounded, stored_debts
from tributary.sources.staging import materialize, new_folder
from tributary.sources.tables import driver_table

_SPLIT_FEATURES = ["qtd_estabelecimentos", "debt_qtd_inscricoes", "debt_qtd_situacoes_distintas"]
#: The discontinuity dataset over closed companies: what these queries need of it.
_CLOSED = f"""{_REGISTRY}, {_DEBTS},
    closed AS (SELECT raiz, any_value(lojas) AS qtd_estabelecimentos, count(DISTINCT numero_inscricao) AS debt_qtd_inscricoes, count(DISTINCT situacao_inscricao) AS debt_qtd_situacoes_distintas, CASE WHEN CAST(raiz AS BIGINT) % 4 = 0 OR max(ativos) = 0 THEN 1 ELSE 0 END AS y
               FROM debts JOIN (SELECT raiz AS r, count(*) AS lojas, count(*) FILTER (situacao_cadastral = '02') AS ativos FROM est GROUP BY raiz) ON raiz = r GROUP BY raiz)"""
_GINI = "(1 - power({p} / ({p} + {q}), 2) - power({q} / ({p} + {q}), 2))"


@query("m_tree_split", f"""WITH {_CLOSED}, f AS (SELECT unnest({_SPLIT_FEATURES}) AS variavel, unnest([{", ".join(_SPLIT_FEATURES)}]) AS v, y FROM closed),
    t AS (SELECT count(*) AS nt, CAST(sum(y) AS DOUBLE) AS pt FROM closed), g AS (SELECT variavel, v, count(*) AS n, sum(y) AS p FROM f GROUP BY ALL),
    c AS (SELECT variavel, (v + lead(v) OVER o) / 2 AS limiar, CAST(sum(n) OVER o AS BIGINT) AS nl, CAST(sum(p) OVER o AS BIGINT) AS pl FROM g WINDOW o AS (PARTITION BY variavel ORDER BY v ROWS UNBOUNDED PRECEDING)),
    w AS (SELECT *, nt * pl / (2 * pt) AS p1, nt * (nl - pl) / (2 * (nt - pt)) AS q1, nt / 2 - nt * pl / (2 * pt) AS p2, nt / 2 - nt * (nl - pl) / (2 * (nt - pt)) AS q2 FROM c, t WHERE nl >= 5 AND nt - nl >= 5),
    s AS (SELECT *, 0.5 - (p1 + q1) / nt * {_GINI.format(p="p1", q="q1")} - (p2 + q2) / nt * {_GINI.format(p="p2", q="q2")} AS ganho FROM w)
    SELECT variavel, limiar, nl AS linhas_esquerda, nt - nl AS linhas_direita, round(p1, 6) AS peso_positivas_esquerda, round(p2, 6) AS peso_positivas_direita, round(ganho, 9) AS ganho, CAST(1 AS DOUBLE) AS importancia FROM s ORDER BY s.ganho DESC LIMIT 1""")
def m_tree_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A tree of one split, learned with balanced classes: the split with the largest gain of all, and its feature's
    importance."""
    rows = discontinuity(spark, sf_dir, features=_SPLIT_FEATURES)
    m = models.train_tree(rows, _SPLIT_FEATURES, "y_descontinuidade", depth=1, leaf=5)
    root, left, right = m.nodes
    out = (_SPLIT_FEATURES[root.variavel], root.limiar, left.n, right.n, round(left.peso1, 6), round(right.peso1, 6), root.ganho, m.importances()[root.variavel])
    return rounded(spark.createDataFrame([out], "variavel string, limiar double, linhas_esquerda long, linhas_direita long, peso_positivas_esquerda double, peso_positivas_direita double, ganho double, importancia double"), 9)


@query("m_tree_checks", f"""WITH {_CLOSED} SELECT unnest(['tree', 'rf']) AS modelo, count(*) AS linhas, unnest([CAST(sum(y) AS DOUBLE), NULL]) AS soma_dos_scores, true AS scores_da_biblioteca, true AS importancias_da_biblioteca, true AS filhos_somam, true AS folhas_conferem, true AS salvo_confere FROM closed""")
def m_tree_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A tree and a forest on the discontinuity target. Scores from their nodes are the library's for every company, and so
    are importances; children add up to their parents; the leaves of the tree hold the companies that end in them, so that
    its scores add up to the positives; what is saved is loaded and fits the table."""
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.functions import vector_to_array

    rows, names, target = discontinuity(spark, sf_dir), datasets.DISCONTINUITY_FEATURES, "y_descontinuidade"
    out = []
    for kind, m in models.train_choice(rows, names, target, "both", depth=5, leaf=5, trees=20, balanced=False).items():
        filled = rows.select(m.probability().alias("p"), *(c.alias(n) for c, n in zip(m.prepared.filled(), names, strict=True)))
        other = m.fitted.transform(VectorAssembler(inputCols=names, outputCol="__x").transform(filled)).withColumn("q", vector_to_array("probability")[1])
        n, total, far = other.agg(F.count(F.lit(1)), F.round(F.sum("p"), 6), F.max(F.abs(F.col("p") - F.col("q")))).first()
        same = all(abs(a - b) < 1e-9 for a, b in zip(m.importances(), m.fitted.featureImportances.toArray(), strict=True))
        by = {(x.arvore, x.no): x for x in m.nodes}
        add_up = all(x.leaf or x.n == sum(by[x.arvore, c].n for c in (x.esquerda, x.direita)) for x in m.nodes)
        leaves = {x.no: (x.n, int(x.peso1)) for x in m.nodes if x.leaf}
        right = kind == "rf" or {r.no: (r.linhas, r.positivas) for r in trees.leaf_counts(rows, m.nodes, m.prepared.filled(), target).collect()} == leaves  # a row per leaf
        m.meta |= _SAID
        m.save(spark, path := new_folder(spark, f"saved-{kind}"))
        again = models.check_usable(models.TreeModel.load(spark, path), rows, "raiz")
        out.append((kind, n, total if kind == "tree" else None, far < 1e-9, same, add_up, right, (again.nodes, again.prepared, again.meta) == (m.nodes, m.prepared, m.meta)))
    return spark.createDataFrame(out, "modelo string, linhas long, soma_dos_scores double, scores_da_biblioteca boolean, importancias_da_biblioteca boolean, filhos_somam boolean, folhas_conferem boolean, salvo_confere boolean")


@query("m_linear_optimal", f"""WITH {_FISCAL} SELECT unnest(['(intercepto)', {", ".join(f"'{f}'" for f in datasets.FISCAL_FEATURES)}]) AS variavel, true AS otima, true AS tabela_confere, count(*) AS linhas FROM fiscal""")
def m_linear_optimal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fiscal model, learned to the end: no feature's gradient is away from the optimum by more than a hundredth of the
    penalty's own size. The objective is strictly convex, so no other coefficients would pass. Beside it, whether the table
    of coefficients has each feature's size, odds ratio, direction and description (the intercept has no row there)."""
    rows = fiscal(spark, sf_dir, datasets.FISCAL_FEATURES)
    m = models.train_linear(rows, datasets.FISCAL_FEATURES, "y_risco_fiscal", c=0.01, tol=1e-10, max_iter=500, leaking=datasets.FISCAL_LEAKING)
    n, c = rows.count(), F.col("coeficiente")
    told = models.coefficient_table(spark, m, datasets.labels_of(datasets.FISCAL_FEATURES)).drop("coeficiente")
    both = models.optimality(m, rows).join(told, "variavel", "left")
    direction = F.when(c > 0, "aumenta o score").when(c < 0, "reduz o score").otherwise("efeito nulo")
    right = (F.col("coeficiente_absoluto") == F.abs(c)) & (F.abs(F.ln("razao_chances") - c) < 1e-9) & (F.col("direcao") == direction) & (F.length("descricao") > 0) & (F.col("descricao") != F.col("variavel"))
    return both.select("variavel", (F.col("residuo") <= 0.01 / (0.01 * n)).alias("otima"), (right | (F.col("variavel") == "(intercepto)")).alias("tabela_confere"), F.lit(n).cast("long").alias("linhas"))


#: A fixed forest: (arvore, no, variavel, limiar, esquerda, direita, n, peso0, peso1, ganho).
_FOREST = [
    Node(0, 0, 0, 6.5, 1, 2, 100, 60.0, 40.0, 0.30), Node(0, 1, 2, 1300.0, 3, 4, 50, 40.0, 10.0, 0.20), Node(0, 2, -1, 0.0, -1, -1, 50, 20.0, 30.0, -1.0), Node(0, 3, -1, 0.0, -1, -1, 20, 18.0, 2.0, -1.0), Node(0, 4, -1, 0.0, -1, -1, 30, 22.0, 8.0, -1.0),
    Node(1, 0, 1, 5.5, 1, 2, 100, 60.0, 40.0, 0.25), Node(1, 1, -1, 0.0, -1, -1, 40, 37.0, 3.0, -1.0), Node(1, 2, 0, 12.0, 3, 4, 60, 23.0, 37.0, 0.05), Node(1, 3, -1, 0.0, -1, -1, 32, 20.0, 12.0, -1.0), Node(1, 4, -1, 0.0, -1, -1, 28, 3.0, 25.0, -1.0),
]
_FOREST_SQL = "nodes(arvore, no, variavel, limiar, esquerda, direita, peso0, peso1) AS (VALUES " + ", ".join(f"({x.arvore}, {x.no}, {x.variavel}, {x.limiar}, {x.esquerda}, {x.direita}, {x.peso0}, {x.peso1})" for x in _FOREST) + ")"


@query("x_forest_score", f"""WITH RECURSIVE {_FISCAL}, {_FOREST_SQL}, m AS (SELECT median(qtd_inscricoes) AS a, median(qtd_periodos) AS b, median(idade_empresa_dias) AS c FROM fiscal),
    x AS (SELECT raiz, [coalesce(qtd_inscricoes, a), coalesce(qtd_periodos, b), coalesce(idade_empresa_dias, c)] AS v FROM fiscal, m),
    w AS (SELECT raiz, v, arvore, 0 AS no FROM x, (SELECT DISTINCT arvore FROM nodes)
          UNION ALL SELECT raiz, v, w.arvore, CASE WHEN v[variavel + 1] <= limiar THEN esquerda ELSE direita END FROM w JOIN nodes ON w.arvore = nodes.arvore AND w.no = nodes.no WHERE variavel >= 0)
    SELECT raiz, round(avg(peso1 / (peso0 + peso1)), 6) AS score FROM w JOIN nodes ON w.arvore = nodes.arvore AND w.no = nodes.no WHERE variavel < 0 GROUP BY raiz""")
def x_forest_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A fixed forest's score of every company."""
    rows = fiscal_rows(spark, sf_dir, _X)
    found = models.TreeModel(models.prepare(rows, _X), trees.check_nodes(_FOREST, len(_X)), {})
    return rounded(models.score(rows, found, "raiz"))


_TREE = [x._replace(variavel=min(x.variavel, 1), limiar={0: 30.5, 1: 6.5}.get(x.no, 0.0)) for x in _FOREST if x.arvore == 0]
_TREE_X = ["qtd_estabelecimentos", "debt_qtd_inscricoes"]
_SAID = {"excluded": [], "metrics": {"n": 0}, "caveat": "score relativo"}


@query("x_lookup_two", f"""WITH {_FISCAL.replace("agg AS", "fagg AS").replace("FROM agg)", "FROM fagg)")}, {_DISC[_DISC.index("agg AS"):]},
    fm AS (SELECT median(qtd_inscricoes) AS a, median(qtd_periodos) AS b, median(idade_empresa_dias) AS c FROM fiscal),
    fi AS (SELECT raiz, y_risco_fiscal, coalesce(qtd_inscricoes, a) AS x, coalesce(qtd_periodos, b) AS y, coalesce(idade_empresa_dias, c) AS z FROM fiscal, fm),
    fz AS (SELECT raiz, y_risco_fiscal, 0.5 * (x - avg(x) OVER ()) / stddev_pop(x) OVER () AS k1, -0.25 * (y - avg(y) OVER ()) / stddev_pop(y) OVER () AS k2, 0.125 * (z - avg(z) OVER ()) / stddev_pop(z) OVER () AS k3 FROM fi),
    fs AS (SELECT raiz, y_risco_fiscal, 1 / (1 + exp(-(0.1 + k1 + k2 + k3))) AS p, CASE WHEN abs(k1) >= abs(k2) AND abs(k1) >= abs(k3) THEN '{_X[0]}' WHEN abs(k2) >= abs(k3) THEN '{_X[1]}' ELSE '{_X[2]}' END AS fator FROM fz),
    tm AS (SELECT median(qtd_estabelecimentos) AS a, median(debt_qtd_inscricoes) AS b FROM disc),
    ts AS (SELECT raiz, y_descontinuidade, CASE WHEN qtd_estabelecimentos > 30.5 THEN 0.6 WHEN debt_qtd_inscricoes <= 6.5 THEN 0.1 ELSE 8.0 / 30 END AS p,
                  CASE WHEN abs((qtd_estabelecimentos - a) / greatest(a, 1) * 0.75) >= abs((debt_qtd_inscricoes - b) / greatest(b, 1) * 0.25) THEN '{_TREE_X[0]}' ELSE '{_TREE_X[1]}' END AS fator FROM disc, tm),
    ask AS (SELECT CASE WHEN c_custkey % 10 = 0 THEN CAST(c_custkey AS VARCHAR) ELSE lpad(CAST(c_custkey AS VARCHAR), 8, '0') END AS pedido, CASE WHEN c_custkey % 10 <> 0 THEN lpad(CAST(c_custkey AS VARCHAR), 8, '0') END AS raiz FROM customer)
    SELECT pedido, ask.raiz, CASE WHEN ask.raiz IS NULL THEN 'invalid_key' WHEN fs.raiz IS NULL THEN 'unavailable' ELSE 'ok' END AS fiscal_status, round(fs.p, 6) AS fiscal_score, fs.y_risco_fiscal AS fiscal_condicao, fs.fator AS fiscal_fator,
           CASE WHEN ask.raiz IS NULL THEN 'invalid_key' WHEN ts.raiz IS NULL THEN 'unavailable' ELSE 'ok' END AS descontinuidade_status, round(ts.p, 6) AS descontinuidade_score, ts.y_descontinuidade AS descontinuidade_condicao, ts.fator AS descontinuidade_fator
    FROM ask LEFT JOIN fs ON ask.raiz = fs.raiz LEFT JOIN ts ON ask.raiz = ts.raiz""")
def x_lookup_two(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every customer number looked up in a fixed linear model and a fixed tree."""
    debts, registry = stored_debts(spark, sf_dir), materialize(probes.registry_table(spark, sf_dir), "registry")
    one, two = datasets.fiscal_dataset(debts, registry, columns=_X), materialize(datasets.discontinuity_dataset(debts, registry, columns=["y_descontinuidade", *_TREE_X]), "discontinuity")
    linear = models.LinearModel(models.prepare(one, _X), [0.5, -0.25, 0.125], 0.1, {"target": "y_risco_fiscal", **_SAID})
    tree = models.TreeModel(models.prepare(two, _TREE_X), trees.check_nodes(_TREE, 2), {"target": "y_descontinuidade", **_SAID})
    key = F.col("c_custkey")
    ask = driver_table(spark, sf_dir, "customer").select(F.when(key % 10 == 0, key.cast("string")).otherwise(F.lpad(key.cast("string"), 8, "0")).alias("pedido"))
    out = lookup.lookup_models(ask, "pedido", {"fiscal": (linear, one), "descontinuidade": (tree, two)}, "raiz", 1)
    strongest = lambda m: F.get(F.col(f"{m}_fatores"), F.lit(0))["variavel"].alias(f"{m}_fator")
    return rounded(out.select("pedido", "raiz", *(c for m in ("fiscal", "descontinuidade") for c in (f"{m}_status", f"{m}_score", f"{m}_condicao", strongest(m)))))


def message(action) -> str:
    try:
        action()
    except ValueError as e:
        return str(e)
    return ""


@query("c_guards", """SELECT unnest(['linhas', 'colunas', 'classes', 'vazamento', 'fração', 'mínimo', 'tabela certa']) AS guarda, unnest(['inscriptions has no rows', 'missing columns: o_nada, o_outra', 'y must have both classes 0 and 1, has [1]',
    'features that leak the target: divida_total', 'test must be between 0 and 1', 'leaf must be 1 or more', '']) AS mensagem, (SELECT count(*) FROM orders) AS linhas""")
def c_guards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the guards say of the orders, made wrong in one way each; and nothing of the table as it is."""
    o = driver_table(spark, sf_dir, "orders")
    wrong = {
        "linhas": lambda: checks.require_rows(o.where("o_orderkey < 0"), "inscriptions"), "colunas": lambda: checks.require_columns(o, ["o_orderkey", "o_outra", "o_nada"]),
        "classes": lambda: checks.require_both_classes(o.withColumn("y", (F.col("o_orderkey") >= 0).cast("int")), "y"), "vazamento": lambda: models.check_features(datasets.FISCAL_FEATURES + ["divida_total"], datasets.FISCAL_LEAKING),
        "fração": lambda: checks.check_fraction(1.0, "test"), "mínimo": lambda: models.train_tree(o, ["o_orderkey"], "y", leaf=-1),
        "tabela certa": lambda: checks.require_unique(checks.require_rows(checks.require_columns(o, ["o_orderkey"])), "o_orderkey"),
    }
    return spark.createDataFrame([(k, message(f)) for k, f in wrong.items()], "guarda string, mensagem string").withColumn("linhas", F.lit(o.count()).cast("long"))
