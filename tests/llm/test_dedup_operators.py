"""Exact, near and line deduplication against brute force, and their edge cases."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tributary.llm import exact_dedup as X
from tributary.llm import setsketch as S
from tributary.llm.common import FILE, file_rows
from tributary.llm.components import connected_components
from tributary.llm.exact_dedup import exact_dedup, misra_gries
from tributary.llm.line_dedup import line_dedup
from tributary.llm.near_dedup import near_dedup

DOCS = "doc_id long, text string, lang string, keep_id string, kept string, row string, doc string"
OFF = 10**6  # no chunk has so many lines: passages only
EMPTY = [(1, None), (2, ""), (3, "  \n\t")]


def frame(spark, rows, parts=3):
    """Rows (id, text) with extra columns whose names clash with the operators' own."""
    return spark.createDataFrame([(i, t, "en", "x", "y", "z", "w") for i, t in rows], DOCS).repartition(parts)


def lower(t):
    return (t or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))


def test_exact_dedup_matches_brute_force(spark):
    rows = [(i, random.Random(i % 7).choice(["Aé", "aÉ", "aé", None, "", "B b"])) for i in range(60)] + [(None, "aé"), (5, "q"), (5, "Q")]
    got = exact_dedup(frame(spark, rows), counters=2).collect()
    assert len(got) == len(rows)
    groups = {}
    for i, t in rows:
        groups.setdefault(lower(t), []).append(i)
    want = {hashlib.sha256(t.encode()).hexdigest(): (len(g), max(i for i in g if i is not None)) for t, g in groups.items()}
    for r in got:
        assert (r.group_size, r.keep_id) == want[r.text_sha256]
    for d in want:
        assert sum(r.kept for r in got if r.text_sha256 == d) == 1  # also where an id repeats
    assert all(r.doc_id == r.keep_id for r in got if r.kept)


def test_exact_dedup_with_hot_digests(spark):
    """Two texts have a third of all rows each, one of them too few for a counter of its own."""
    long = "Long " * 100_000
    rows = [(i, ["Hot", "hOt", "warm", "warm", long, f"own {i}"][i % 6]) for i in range(600)]
    for counters in (1, None):
        got = exact_dedup(frame(spark, rows, 8), counters=counters).collect()
        sizes = {t: sum(r.group_size for r in got if r.kept and r.text_sha256 == hashlib.sha256(t.encode()).hexdigest()) for t in ("hot", "warm", long.lower())}
        assert sizes == {"hot": 200, "warm": 200, long.lower(): 100} and sum(r.kept for r in got) == 103 and {r.keep_id for r in got if r.group_size == 200} == {595, 597}


def test_exact_dedup_of_null_ids_and_no_rows(spark):
    got = exact_dedup(frame(spark, [(None, "a"), (None, "A")])).collect()
    assert sorted(r.kept for r in got) == [False, True] and {r.keep_id for r in got} == {None}
    assert exact_dedup(frame(spark, [])).count() == 0


def test_misra_gries_never_misses_a_heavy_hitter():
    pa = X.pa
    rng = random.Random(1)
    stream = [b"hot"] * 400 + [str(rng.randrange(300)).encode() for _ in range(600)]
    rng.shuffle(stream)
    batches = [pa.RecordBatch.from_arrays([pa.array(stream[i : i + 100], pa.binary())], ["digest"]) for i in range(0, 1000, 100)]
    out = list(misra_gries(iter(batches), 4))[0]
    found = dict(zip(out.column(0).to_pylist(), out.column(1).to_pylist(), strict=True))
    assert found[None] == 1000 and 400 - 1000 / 5 <= found[b"hot"] <= 400 and len(found) <= 5


def brute_components(docs, size, percent):
    sets = {}
    for i, t in docs:
        w = lower(t).split(" ")
        w = [x for x in lower(t).replace("\n", " ").replace("\t", " ").split(" ") if x]
        sets[i] = {tuple(w[k : k + size]) for k in range(max(1, len(w) - size + 1))} if w else set()
    to = {i: i for i in sets}

    def find(x):
        while to[x] != x:
            x = to[x]
        return x

    for a in sets:
        for b in sets:
            both = len(sets[a] & sets[b])
            if a < b and sets[a] and 100 * both >= percent * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                to[max(x, y)] = min(x, y)
    return {i: (len(s), find(i)) for i, s in sets.items()}


@pytest.mark.parametrize("size", [2, 5])
def test_near_dedup_matches_brute_force(spark, size):
    rng = random.Random(size)
    docs = list(EMPTY) + [(4, "one"), (5, "One"), (6, "two words"), (7, "TWO words"), (8, "x" * 50_000)]
    for base in range(12):
        words = [f"w{rng.randrange(400)}" for _ in range(rng.choice([30, 80, 200]))]
        for copy in range(rng.choice([1, 2, 6, 14])):
            w = list(words)
            for _ in range(rng.randrange(0, 1 + len(w) // 12)):
                w[rng.randrange(len(w))] = f"new{rng.randrange(1000)}"
            docs.append((100 * (base + 1) + copy, rng.choice([" ", "\n"]).join(w)))
    want = brute_components(docs, size, 80)
    got = {r.doc_id: r for r in near_dedup(frame(spark, docs), size=size).collect()}
    assert {i: (r.n_shingles, r.component_id) for i, r in got.items()} == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in got.values())


def test_near_dedup_edge_cases(spark):
    assert near_dedup(frame(spark, [])).count() == 0
    text = " ".join(f"w{i}" for i in range(40))
    got = near_dedup(frame(spark, [(None, text), (9, text), (9, text), (3, text), (4, None)])).collect()
    assert sorted((str(r.doc_id), str(r.component_id), r.kept) for r in got) == [("3", "3", True), ("4", "4", True), ("9", "3", False), ("9", "3", False), ("None", "None", True)]


def test_setsketch_estimates_and_merges():
    rng = np.random.default_rng(0)
    both, a, b = (rng.integers(0, 1 << 63, n, dtype=np.uint64) for n in (800, 100, 100))
    one, two = np.concatenate([both, a]), np.concatenate([both, b])
    x, y = (S.registers(S.minima(s))[None] for s in (one, two))
    got = S.estimate(x, y, np.array([900.0]), np.array([900.0]))[0]
    assert abs(got - 0.8) < 0.12 and got >= S.least_estimate(0.8)
    assert (S.registers(S.minima(np.concatenate([one, b]))) == np.maximum(x, y)[0]).all()
    assert S.estimate(x, x, np.array([900.0]), np.array([900.0]))[0] == pytest.approx(1)
    assert np.array([bin(int(v)).count("1") for v in (S.bits(x) ^ S.bits(y)).view(np.uint64)[0]]).sum() <= S.most_bits_apart(0.8)


def test_components_of_chains_and_loops(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 100), (7, 7), (None, 3)]
    got = {r.node: r.label for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


LONG = " ".join(f"passage{i}" for i in range(60))
SHORT = [" ".join(f"s{k}{i}" for i in range(5)) for k in range(40)]


def test_line_dedup_removes_later_passages_only(spark):
    block = "\n".join(SHORT)  # 200 words in lines too short to stand alone
    docs = [(2, f"Own first.\n{LONG}\nOwn last."), (1, f"{LONG}\nAnother."), (3, f"Something\n{block}\nmore"), (4, f"Something else\n{block}\nand more"), (5, "All rights reserved.\nx"), (6, "All rights reserved.\ny"), (7, None), (8, ""), (9, f"{LONG}\r\nz")]
    got = {r.doc.doc_id: r for r in line_dedup(frame(spark, docs)).collect()}
    text = {i: r.text for i, r in got.items()}
    assert text[1] == docs[1][1] and text[3] == docs[2][1]  # first occurrences stay
    assert text[2] == "Own first.\nOwn last." and got[2].lines_removed == 1 and got[2].words_removed == 60
    assert text[4].startswith("Something else") and text[4].endswith("and more") and got[4].words_removed > 100
    assert text[5] == docs[4][1] and text[6] == docs[5][1] and text[7] is None and text[8] == "" and text[9] == docs[8][1]
    assert got[7].n_lines == 0 and got[8].n_lines == 1 and got[3].n_lines == 42
    assert got[1].doc.lang == "en" and got[1].doc.doc == "w"


def test_line_dedup_repeats_and_no_rows(spark):
    assert line_dedup(frame(spark, [])).count() == 0
    got = sorted((r.text, r.lines_removed) for r in line_dedup(frame(spark, [(1, LONG), (1, LONG), (None, LONG)], 1)).collect())
    assert got == [("", 1), ("", 1), (LONG, 0)]
    text = f"{LONG}\nx\n{LONG}"
    assert line_dedup(frame(spark, [(1, text)])).first().text == text  # in one document only
    many = "\n".join(f"{LONG} {i}" for i in range(3000))  # 180,000 words
    got = {r.doc.doc_id: r for r in line_dedup(frame(spark, [(1, many), (2, f"{many}\nown"), (3, " ".join([LONG] * 3000))])).collect()}
    assert got[1].lines_removed == 0 and (got[2].text, got[2].lines_removed) == ("own", 3000) and got[3].lines_removed == 0


def brute_pieces(text, min_words=50, min_lines=2):
    """Chunks and spans of a text as (first line, last line), by the rules' words."""
    lines = text.split("\n")
    words = [len(x.split()) for x in lines]
    h = [int(hashlib.md5(x.encode()).hexdigest()[:8], 16) for x in lines]
    out, a = set(), 0
    for b in range(len(lines)):
        rolling = sum(31**k * h[b - k] for k in range(4) if b >= k)
        if rolling % 4 == 0 or b == len(lines) - 1:
            if sum(w > 0 for w in words[a : b + 1]) >= min_lines:
                out.add((a, b))
            a = b + 1
    for i in range(len(lines)):
        for ends in (range(i, len(lines)), range(i, -1, -1)):
            n = 0
            for j in ends:
                n += words[j]
                if words[i] and n > min_words:
                    out.add((min(i, j), max(i, j)))
                    break
    return out


def test_line_dedup_matches_brute_force(spark):
    """A third of all lines is one line; passages are shared, shifted and cut; ids are null or repeat."""
    rng = random.Random(8)
    pool = [" ".join(f"p{rng.randrange(40)}" for _ in range(rng.choice([1, 3, 9, 30, 60]))) for _ in range(60)] + ["", " "]
    docs = []
    for i in range(120):
        at = rng.randrange(50)
        lines = [rng.choice([*pool, pool[0], f"own {rng.random()}"]) for _ in range(rng.randrange(4))] + pool[at : at + rng.randrange(12)] + [pool[0]] * rng.randrange(3) + [f"own {rng.random()}"] * rng.randrange(2)
        docs.append((i, "\n".join(lines)))
    first: dict[str, int] = {}
    cut = lambda t, p: "\n".join(t.split("\n")[p[0] : p[1] + 1])
    for i, t in docs:
        for p in brute_pieces(t):
            first.setdefault(cut(t, p), i)
    want = {}
    for i, t in docs:
        gone = {k for p in brute_pieces(t) if first[cut(t, p)] != i for k in range(p[0], p[1] + 1)}
        want[i] = ("\n".join(x for k, x in enumerate(t.split("\n")) if k not in gone), len(gone))
    assert sum(n > 0 for _, n in want.values()) > 60
    assert {r.doc.doc_id: (r.text, r.lines_removed) for r in line_dedup(frame(spark, docs, 7)).collect()} == want


def test_line_dedup_cuts_alike_after_an_insertion(spark):
    """A line put in front, or changed, moves no cut but those beside it."""
    from tributary.llm.line_dedup import chunk_ends, line_facts

    rng = random.Random(9)
    lines = [f"line {rng.random()}" for _ in range(200)]
    texts = [lines, ["new", *lines], [*lines[:100], "changed", *lines[101:]]]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(texts)], "i long, lines array<string>")
    ends = {r.i: r.e for r in df.select("i", line_facts(F.col("lines")).alias("f")).select("i", chunk_ends(F.col("f")).alias("e")).collect()}
    assert 25 < len(ends[0]) < 80
    assert {e - 1 for e in ends[1] if e > 4} == {e for e in ends[0] if e > 3}
    assert {e for e in ends[2] if not 100 <= e <= 103} == {e for e in ends[0] if not 100 <= e <= 103}


def test_line_dedup_keeps_any_text_without_copies(spark):
    rng = random.Random(4)
    docs = [(i, "".join(rng.choice(["a", " ", "\n", "\n\n", " \n ", "é", "\x01", "word word "]) for _ in range(rng.randrange(80)))) for i in range(80)]
    assert {r.doc.doc_id: r.text for r in line_dedup(frame(spark, docs), min_lines=OFF).collect()} == dict(docs)
    assert {r.doc.doc_id: r.text for r in line_dedup(frame(spark, docs[:1])).collect()} == dict(docs[:1])


def covered(docs, min_words=50):
    """Per document the numbers of its lines inside a run of whole lines over min_words words that an earlier one has, by brute force."""
    split, out = {i: t.split("\n") for i, t in docs}, {}
    for i, own in split.items():
        out[i] = set()
        for j, other in split.items():
            for a in range(len(own)):
                for c in range(len(other)):
                    n = 0
                    while j < i and a + n < len(own) and c + n < len(other) and own[a + n] == other[c + n]:
                        n += 1
                    if sum(len(x.split()) for x in own[a : a + n]) > min_words:
                        worded = [k for k in range(a, a + n) if own[k].split()]
                        out[i].update(range(worded[0], worded[-1] + 1))
    return out


def test_line_dedup_removes_every_repeated_run_of_short_lines(spark):
    rng = random.Random(6)
    short = lambda n: " ".join(f"r{rng.randrange(10**6)}" for _ in range(n))
    docs = []
    for k in range(40):
        size = rng.choice([1, 3, 5, 6, 7])
        lines = [short(size) for _ in range(-(-rng.choice([45, 51, 54, 60, 72]) // size))]
        if k % 4 == 0:
            lines = [lines[0]] * len(lines)  # the same line again and again has either every cut or none
        if k % 4 == 1:
            lines[2:2] = ["", " "]
        for copy in range(2):
            docs.append((2 * k + copy, "\n".join([short(rng.choice([2, 5])) for _ in range(3)] + lines + [short(rng.choice([2, 5])) for _ in range(3)])))
    want = covered(docs)
    assert sum(map(bool, want.values())) > 25
    got = {r.doc.doc_id: r for r in line_dedup(frame(spark, docs), min_lines=OFF).collect()}
    for i, t in docs:
        kept = [x for k, x in enumerate(t.split("\n")) if k not in want[i]]
        if i // 2 % 4 == 0:  # here a line's repeats in one document can be copied chunks besides
            assert got[i].lines_removed >= len(want[i])
        else:
            assert (got[i].text, got[i].lines_removed) == ("\n".join(kept), len(want[i]))


def test_near_dedup_of_long_texts_and_repeated_ids(spark):
    """Many very long texts in one batch, one id on different texts, and a third of all rows alike."""
    rng = random.Random(11)
    base = [f"w{rng.randrange(5000)}" for _ in range(30_000)]
    docs = []
    for i in range(30):
        own = list(base) if i % 3 == 0 else [f"{i}x{rng.randrange(5000)}" for _ in range(30_000)]
        for k in rng.sample(range(len(own)), 300):
            own[k] = f"changed{i}"
        docs.append((i, " ".join(own)))
    docs += [(100, "one two three four five six"), (100, "seven eight nine ten eleven"), (100, "one two three four five six")]
    got = near_dedup(frame(spark, docs, 2)).collect()
    assert len(got) == 33
    for r in got:
        if r.doc_id < 100:
            assert r.component_id == (0 if r.doc_id % 3 == 0 else r.doc_id) and r.n_shingles > 28_000
    assert [r.component_id for r in got if r.doc_id == 100] == [100] * 3
    with pytest.raises(ValueError, match="80"):
        near_dedup(frame(spark, docs), percent=70)


def test_columns_named_like_addresses_are_plain_columns(spark):
    """__file and __at of the user stay in `doc` and address nothing, even where they repeat."""
    text = "one two three four five six\n" * 12
    rows = spark.createDataFrame([(i, text + f"end {i}", 1, 1) for i in range(4)], "doc_id long, text string, __file long, __at long")
    got = line_dedup(rows).select("doc.doc_id", "doc.__file", "doc.__at", "lines_removed").collect()
    assert sorted((r.doc_id, r["__file"], r["__at"], r.lines_removed > 0) for r in got) == [(i, 1, 1, i > 0) for i in range(4)]
    with pytest.raises(ValueError, match="reserved"):
        file_rows(rows.withColumn(FILE, F.lit(1)))
