"""A Merkle manifest of a dataset: checkpoint-and-recompute.

Leaves are hashes of rows; every ARITY consecutive nodes of a group (a source) become one until one is left, and the
groups' last nodes likewise become the root. Only every LEVELS-th level is written: the leaves, and of each aligned
subtree of ARITY^LEVELS leaves its top. A proof needs the levels between; they are made again from the stored
descendants of one subtree (one row), the siblings go out, and the rest is forgotten. Proofs are put together from the
root down: a stored node's own path is joined once to the subtree below it, not to each leaf.

Everything is Column expressions; a row holds at most ARITY^LEVELS digests, and no join meets all rows of a source.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tributary.llm.common import if_small, materialize, scratch

ARITY, LEVELS = 16, 2
SPAN = ARITY**LEVELS
_PATH = "array<struct<left: string, right: string>>"


def h(*inputs: Column) -> Column:
    return F.sha2(F.concat(*inputs).cast("binary"), 256)


def field(value: Column) -> Column:
    """A value as it enters a leaf: - for null, else the count of its UTF-8 bytes, a colon, the value."""
    value = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))


def runs(nodes: Column) -> Column:
    """The next level of an array of digests."""
    last = F.ceil(F.size(nodes) / ARITY).cast("int") - 1
    return F.transform(F.sequence(F.lit(0), last), lambda j: h(F.array_join(F.slice(nodes, j * ARITY + 1, F.lit(ARITY)), "")))


def goes_on(level: int) -> Column:
    """Whether that level inside a subtree has one above it: in a group's only subtree, while several nodes are left; any
    other subtree has all LEVELS, however short its last runs are."""
    return (F.col("n") > SPAN) | (F.col("n") > ARITY**level)


def subtrees(nodes: DataFrame, *more: str) -> DataFrame:
    """nodes (group, at, digest, n) -> a row for each aligned subtree: group, block, n, nodes (in order, with the columns
    `more`), and its levels again: level0 has the stored digests, level{LEVELS} the top."""
    rows = nodes.groupBy("group", F.floor(F.col("at") / SPAN).alias("block")).agg(F.max("n").alias("n"), F.sort_array(F.collect_list(F.struct("at", "digest", *more))).alias("nodes"))
    rows = rows.withColumn("level0", F.transform("nodes", lambda x: x["digest"]))
    for k in range(LEVELS):
        rows = rows.withColumn(f"level{k + 1}", F.when(goes_on(k), runs(F.col(f"level{k}"))).otherwise(F.col(f"level{k}")))
    return rows


def build(leaves: DataFrame) -> list[DataFrame]:
    """The stored levels: each has group, at (from 0), digest and n, the nodes of the group there; the first are the leaves
    (a written table), the last has one node for each group."""
    stored, most = [leaves], leaves.agg(F.max("n")).first()[0] or 0
    while most > 1:
        above = subtrees(stored[-1]).select("group", F.col("block").alias("at"), F.element_at(f"level{LEVELS}", 1).alias("digest"), F.ceil(F.col("n") / SPAN).cast("long").alias("n"))
        stored.append(materialize(above, f"merkle-{len(stored) * LEVELS}", stays=True))
        most = -(-most // SPAN)
    return stored


def siblings(level: Column, at: Column) -> Column:
    """Of the node `at` (from 0) of a level: its run's nodes before it and after it, joined."""
    first, place = (at - at % ARITY).cast("int"), (at % ARITY).cast("int")
    part = lambda start, n: F.array_join(F.slice(level, start + 1, n), "")
    return F.struct(part(first, place).alias("left"), part(first + place + 1, ARITY - 1 - place).alias("right"))


def proofs(stored: list[DataFrame], above: DataFrame | None, *more: str) -> DataFrame:
    """A row for each leaf: group, digest, the leaves' columns `more`, top (its group's last node) and path: the siblings
    of every level up to the root.

    above: group and path, that of the group's last node; None: there is nothing above it."""
    tops = stored[-1].withColumn("path", F.array().cast(_PATH)) if above is None else stored[-1].join(above, "group")
    paths = tops.select("group", "at", F.col("digest").alias("top"), "path", *((F.col(c) for c in ("digest", *more)) if len(stored) == 1 else ()))
    for k in range(len(stored) - 2, -1, -1):
        own = more if k == 0 else ()
        paths = materialize(paths, f"merkle-paths-{k + 1}", stays=True).withColumnRenamed("at", "block")
        levels = lambda i: F.array(*(F.when(goes_on(k), siblings(F.col(f"level{k}"), F.floor(i / ARITY**k))) for k in range(LEVELS)))
        node = lambda x, i: F.struct(x["at"].alias("at"), *(x[c].alias(c) for c in ("digest", *own)), F.filter(levels(i), lambda s: s.isNotNull()).alias("own"))  # noqa: E731, B023
        # The subtrees are dealt out by group and block already; the paths are few, but too many for a broadcast.
        inside = subtrees(stored[k], *own).join(paths.hint("shuffle_hash"), ["group", "block"]).select("group", "top", "path", F.explode(F.transform("nodes", node)).alias("x"))
        paths = inside.select("group", "x.at", "top", F.concat("x.own", "path").alias("path"), *(f"x.{c}" for c in (("digest", *own) if k == 0 else ())))
    return paths.drop("at")


def placed(rows: DataFrame, order: list[str], name: str) -> DataFrame:
    """rows (group and others, not part) with at, the place (from 0) in the order inside the group, and n, the group's rows.

    Rows are dealt out in ranges of group and order; repeated rows, which are the same leaf, by their place in the input.
    """
    cut = materialize(rows.withColumn("tie", F.monotonically_increasing_id()).repartitionByRange("group", *order, "tie").withColumn("part", F.spark_partition_id()), name)
    sizes = cut.groupBy("group", "part").agg(F.count(F.lit(1)).alias("rows"))  # a row per partition and per group
    through = Window.partitionBy("group").orderBy("part").rowsBetween(Window.unboundedPreceding, 0)
    sizes = materialize(sizes.select("group", "part", (F.sum("rows").over(through) - F.col("rows")).alias("before"), F.sum("rows").over(Window.partitionBy("group")).alias("n")), f"{name}-sizes", stays=True)
    inside = Window.partitionBy("group", "part").orderBy(*order, "tie")
    out = cut.withColumn("in_part", F.row_number().over(inside)).join(if_small(sizes, 64), ["group", "part"])
    return materialize(out.withColumn("at", F.col("before") + F.col("in_part") - 1).drop("part", "tie", "in_part", "before"), f"{name}-placed", stays=True)


@dataclass(frozen=True)
class Manifest:
    """root: a hex digest, None without rows. leaves: group, at, id, digest, changed (the leaf after tampering, else null)
    and n. trees, groups: the stored levels of the groups' trees and of the tree over them."""

    root: str | None
    leaves: DataFrame
    trees: list[DataFrame]
    groups: list[DataFrame]


def manifest(docs: DataFrame, columns: list[str], id_col: str = "doc_id", group_col: str = "source", changed: dict[str, Column] | None = None, when: Column | None = None) -> Manifest:
    """Hashes every row's columns and stores the trees in the shared folder.

    Groups stand in the order of their names' UTF-8 bytes, null first; rows by id, null first, equal ids by their leaves.
    changed, when: columns with other values, and for which rows; they give a second leaf, against which proofs are checked.
    """
    at = F.lit(False) if when is None else F.coalesce(when, F.lit(False))
    leaf = lambda new: h(*(field(new.get(c, F.col(c))) for c in columns))
    name = F.col(group_col).cast("string")
    rows = docs.select(
        F.coalesce(F.concat(F.lit("="), name), F.lit("-")).alias("group"), F.col(id_col).alias("id"), leaf({}).alias("digest"), F.when(at, leaf(changed or {})).alias("changed"),
    )
    with scratch():
        leaves = placed(rows, ["id", "digest"], "leaves")
        trees = build(leaves)
        tops = trees[-1].select(F.lit("").alias("group"), F.col("group").alias("name"), "digest")
        groups = build(placed(tops, ["name"], "groups"))
        top = groups[-1].select("digest").first()
    return Manifest(top and top[0], leaves, trees, groups)


def all_proofs(made: Manifest) -> DataFrame:
    """A row for each row of the table: id, leaf, changed, subroot, path (array of left and right, the joined siblings of a
    level before and after its node; from the leaf up to the root)."""
    with scratch():
        over = materialize(proofs(made.groups, None, "name").select(F.col("name").alias("group"), "path"), "group-paths", stays=True)
        return proofs(made.trees, over, "id", "changed").select("id", F.col("digest").alias("leaf"), "changed", F.col("top").alias("subroot"), "path")


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its siblings give."""
    return F.aggregate(path, leaf, lambda node, s: h(s["left"], node, s["right"]))


def proof_text(path: Column) -> Column:
    """All siblings, level by level, left to right."""
    return F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), "")


def merkle_manifest(docs: DataFrame, columns: list[str], id_col: str = "doc_id", group_col: str = "source", changed: dict[str, Column] | None = None, when: Column | None = None) -> DataFrame:
    """One row per row of docs: id_col, leaf, subroot, root, proof_sha256, folded_root (from the changed leaf if the row has
    one), verified (folded_root is the root).

    A leaf hashes the columns in their order: - for null, else byte count, colon, value. Null groups are a group, null ids
    come first; repeated ids are leaves of their own, in the order of their digests, and repeated rows each have a proof.
    Empty and very long texts are hashed whole. The only leaf of a group is its subroot, and a table of one row its own
    root, with an empty proof. Rows without id are changed only if `when` holds. Other columns of docs are not read,
    whatever their names. An empty table gives an empty result.
    """
    made = manifest(docs, columns, id_col, group_col, changed, when)
    out = all_proofs(made).withColumn("folded_root", fold(F.coalesce("changed", "leaf"), F.col("path")))
    root = F.lit(made.root).cast("string")
    return out.select(F.col("id").alias(id_col), "leaf", "subroot", root.alias("root"), h(proof_text(F.col("path"))).alias("proof_sha256"), "folded_root", (F.col("folded_root") == root).alias("verified"))
