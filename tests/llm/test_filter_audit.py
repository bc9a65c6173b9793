"""The audit of filter orders against brute force."""

import random
from itertools import permutations

import pytest

from tributary.llm import filter_audit as A

DOCS = "doc_id long, text string, lang string, part string, mask string, n string, digest string"
LABELS = "doc_id long, quality int, toxic int, good string"


def test_lehmer_ranks_and_intervals():
    orders = ["".join(p) for p in permutations("ABCDE")]
    assert [*map(A.lehmer_rank, orders)] == [*range(120)]
    steps = {}
    for mask, step, first, last in A.intervals("ABCDE"):
        for rank in range(first, last):
            assert steps.setdefault((mask, rank), step) == step
    for mask in range(1, 32):
        for rank, order in enumerate(orders):
            assert steps[mask, rank] == 1 + min(order.index("ABCDE"[k]) for k in range(5) if mask >> k & 1)
    assert len({(m, r) for m, r in steps}) == 31 * 120


def brute(docs, labels):
    letters, rows = "ABCDE", {}
    good, toxic = {i for i, q, _ in labels if q == 1}, {i for i, _, t in labels if t == 1}
    key = lambda i: (i is None, i or 0)
    least = {}
    for i, t, _ in docs:
        least[t or ""] = min(least.get(t or "", key(i)), key(i))
    for i, t, lang in docs:
        t = t or ""
        w = [x for x in "".join(" " if c in "\t\n\x0b\x0c\r" else c for c in t).split(" ") if x]
        fails = [len(w) < 100, 100 * len(set(w)) < 80 * len(w), 100 * sum("A" <= c <= "Z" for c in t) > 10 * len(t), any(c in "#$%&*|" for c in t), key(i) > least[t]]
        rows.setdefault(lang or "", []).append((fails, i is not None and i in good, i is not None and i in toxic))
    out = {}
    for part, of in rows.items():
        shapley = dict.fromkeys(letters, 0)
        for p in permutations(range(5)):
            left = of
            for step, f in enumerate(p, 1):
                gone, kept = [r for r in left if r[0][f]], [r for r in left if not r[0][f]]
                all_fail = sum(r[0][f] for r in of)
                alone = sum(r[0][f] and sum(r[0]) == 1 for r in of)
                out[part, "".join(letters[k] for k in p), step] = [len(kept), len(gone), all_fail - len(gone), alone, sum(r[1] for r in gone), sum(r[2] for r in gone)]
                shapley[letters[f]] += len(gone)
                left = kept
        for (q, order, step), x in out.items():
            if q == part:
                x.append(shapley[order[step - 1]])
    return out


def test_filter_audit_matches_brute_force(spark):
    rng = random.Random(4)
    kinds = [None, "", " \n", "A b", "a b", "w " * 120, " ".join(map(str, range(120))), " ".join(f"W{k}\x0b" for k in range(110)), "Ünï#" + " x" * 3, " ".join(f"é{k}" for k in range(101)), "HOT", "x" * 200_000]
    docs = [(i if i % 9 else None, rng.choice(kinds), rng.choice([None, "", "en", "de"])) for i in range(150)] + [(7, "HOT", "en"), (7, "HOT", "de"), (7, "a b", "en")] + [(1000 + i, "HOT", "en") for i in range(80)]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for i in range(0, 160, 2)] + [(2, 1, 0), (2, 0, 1), (None, 1, 1), (99999, 1, 1)]
    got = A.filter_audit(spark.createDataFrame([(i, t, g, "p", "m", "n", "d") for i, t, g in docs], DOCS).repartition(5), spark.createDataFrame([(i, q, t, "g") for i, q, t in labels], LABELS))
    want = brute(docs, labels)
    assert got.dtypes[:3] == [("part", "string"), ("filter_order", "string"), ("step", "int")] and {t for _, t in got.dtypes[3:]} == {"bigint"}
    rows = got.collect()
    assert len(rows) == len(want) == 3 * 600
    for r in rows:
        assert [*r[3:]] == want[r.part, r.filter_order, r.step]


def test_filter_audit_without_rows_or_labels(spark):
    no = spark.createDataFrame([], LABELS)
    assert A.filter_audit(spark.createDataFrame([], DOCS), no).count() == 0
    got = A.filter_audit(spark.createDataFrame([(1, None, None, "p", "m", "n", "d")], DOCS), no).collect()
    assert len(got) == 600 and {r.part for r in got} == {""} and sum(r.removed for r in got) == 120 == sum(r.shapley for r in got if r.filter_order == "ABCDE")


def test_audit_of_other_filters(spark):
    counts = spark.createDataFrame([("p", 3, 2, 1, 0), ("p", 3, 1, 0, 0), ("p", 0, 5, 0, 0), ("q", 2, 4, 0, 4)], "part string, mask int, n long, good long, toxic long")
    got = {(r.part, r.filter_order, r.step): (r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley) for r in A.audit(counts, "XY").collect()}
    assert len(got) == 8 and got["p", "XY", 1] == (5, 3, 0, 0, 1, 0, 3) and got["p", "XY", 2] == (5, 0, 3, 0, 0, 0, 3) and got["q", "YX", 1] == (0, 4, 0, 4, 0, 4, 8)
    for bad in ("", "BA", "AA", "ABCDEFG"):
        with pytest.raises(ValueError):
            A.audit(counts, bad)
