"""The Merkle manifest against brute force, and its edge cases."""

import hashlib

from pyspark.sql import functions as F

from tributary.llm import merkle as M

DOCS = "doc_id long, source string, text string, group string, at string, n string, digest string, path string"
COLUMNS = ["doc_id", "source", "text"]


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(*values):
    return sha(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def tree(nodes):
    """The last node, and for each leaf the runs on its way: (siblings before, after)."""
    ways, at = [[] for _ in nodes], [*range(len(nodes))]
    while len(nodes) > 1:
        for k, i in enumerate(at):
            run = nodes[i - i % 16 : i - i % 16 + 16]
            ways[k].append(("".join(run[: i % 16]), "".join(run[i % 16 + 1 :])))
        nodes, at = [sha(*nodes[i : i + 16]) for i in range(0, len(nodes), 16)], [i // 16 for i in at]
    return nodes[0], ways


def brute(rows, changed):
    groups = {}
    for i, s, t in rows:
        groups.setdefault(s, []).append((i, leaf(i, s, t), leaf(i, s, t.lower() if t and i in changed else t)))
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    tops = {s: tree([x[1] for x in sorted(groups[s], key=lambda x: (x[0] is not None, x[0] or 0, x[1]))]) for s in names}
    root, over = tree([tops[s][0] for s in names])
    out = []
    for k, s in enumerate(names):
        for (i, own, new), way in zip(sorted(groups[s], key=lambda x: (x[0] is not None, x[0] or 0, x[1])), tops[s][1], strict=True):
            way, node = way + over[k], new
            for a, b in way:
                node = sha(a, node, b)
            out.append((i, own, tops[s][0], root, sha(*(a + b for a, b in way)), node, node == root))
    return sorted(out, key=str)


def judged(spark, rows, parts=3, changed=frozenset()):
    docs = spark.createDataFrame([(i, s, t, "g", "a", "n", "d", "p") for i, s, t in rows], DOCS).repartition(parts)
    when = F.col("doc_id").isin(*changed) if changed else None
    return sorted((tuple(r) for r in M.merkle_manifest(docs, COLUMNS, changed={"text": F.lower("text")}, when=when).collect()), key=str)


def test_manifest_matches_brute_force(spark):
    """Sources of 1, 16, 17, 256, 257 and 700 rows, null and empty ones, null and repeated ids, repeated rows."""
    rows, k = [], 0
    for source, n in ((None, 3), ("", 2), ("-", 1), ("=", 16), ("a", 17), ("é", 256), ("b", 257), ("hot", 700)):
        for _ in range(n):
            rows.append((k * 7919 % 5003, source, [None, "", "Ab", "ab", f"É{k}"][k % 5]))
            k += 1
    rows += [(None, "hot", "X"), (None, "hot", "Y"), (5, "hot", "Z"), (5, "hot", "Z"), (5, "hot", "A"), (6, "a", "Long " * 100_000)]
    changed = {r[0] for r in rows[::3] if r[0] is not None}
    got, want = judged(spark, rows, changed=changed), brute(rows, changed)
    assert got == want
    assert len({r[3] for r in got}) == 1 and {r[6] for r in got} == {True, False} and all(r[6] for r in got if r[0] not in changed)


def test_many_sources(spark):
    rows = [(i, f"s{i % 300}", f"T{i}") for i in range(600)]
    assert judged(spark, rows, changed={4, 5}) == brute(rows, {4, 5})


def test_small_tables(spark):
    assert judged(spark, []) == []
    one = judged(spark, [(1, None, None)])
    assert one == brute([(1, None, None)], set()) and one[0][1] == one[0][2] == one[0][3] and one[0][4] == sha("") and one[0][6]


def test_order_does_not_depend_on_the_layout(spark):
    rows = [(i, "s", f"t{i}") for i in range(300)] + [(3, "s", "t3")] * 40  # repeated rows in several partitions
    assert judged(spark, rows, 1) == judged(spark, rows[::-1], 7) == brute(rows, set())


def test_only_every_second_level_is_stored(spark):
    docs = spark.createDataFrame([(i, "s", f"t{i}", "", "", "", "", "") for i in range(1000)], DOCS)
    made = M.manifest(docs, COLUMNS)
    assert [level.count() for level in made.trees] == [1000, 4, 1] and [level.count() for level in made.groups] == [1]
    proof = M.all_proofs(made)
    assert proof.where(M.fold(F.col("leaf"), F.col("path")) == made.root).count() == 1000 and proof.select(F.size("path")).distinct().collect() == [(3,)]
    other = M.manifest(docs.withColumn("text", F.when(F.col("doc_id") == 500, "other").otherwise(F.col("text"))), COLUMNS)
    assert other.root != made.root
