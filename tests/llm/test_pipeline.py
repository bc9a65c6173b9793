"""Every stage of the pipeline against a brute-force version, each on what the one before it kept."""

import os
import re

import pytest

pytest.importorskip("corpus_pipeline")
import corpus_pipeline as P  # noqa: E402
from test_dedup_operators import brute_components  # noqa: E402
from test_other_operators import brute_hits, brute_targets  # noqa: E402

from tributary.llm.common import materialize, table  # noqa: E402
from tributary.llm.decontaminate import item_words  # noqa: E402

DATA = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no tables")


def brute_lines(docs):
    """Removed (doc, line) pairs if every line were a chunk: what the stage removes lies in it, whole long lines are all in it."""
    first, where = {}, {}
    for d in sorted(docs, key=lambda d: d.doc_id):
        for k, line in enumerate(d.text.split("\n")):
            first.setdefault(line, (d.doc_id, k))
            where.setdefault(line, set()).add(d.doc_id)
    return {(d.doc_id, k) for d in docs for k, line in enumerate(d.text.split("\n")) if len(where[line]) > 1 and first[line] != (d.doc_id, k)}


def long_hits(items, text, most=50):
    """Places of the words in runs of over `most` hit words."""
    hit, out, run = sorted(brute_hits(items, item_words(text))[0]), set(), []
    for k in [*hit, None]:
        if run and k != run[-1] + 1:
            out.update(run if len(run) > most else ())
            run = []
        run.append(k)
    return out


def stored(spark):
    """Files in the shared folder."""
    return {os.path.join(d, f) for d, _, names in os.walk(spark.conf.get("spark.checkpoint.dir")) for f in names if f.startswith("part-")}


def test_nothing_is_left_behind(spark, tmp_path):
    before = stored(spark)
    P.run(spark, DATA).write.parquet(str(tmp_path / "out"))
    last = {f.split("/")[-2].rsplit("-", 1)[0] for f in stored(spark) - before}
    assert last <= {"stage-benchmark", "keys", "cuts"}  # what the last stage reads
    for name, one in P.STAGES[:2]:
        one(spark, spark.read.parquet(f"{DATA}/documents.parquet"), DATA).write.parquet(str(tmp_path / name))
    assert {f.split("/")[-2].rsplit("-", 1)[0] for f in stored(spark) - before} <= {"stage-benchmark", "gone"}


def test_odd_rows(spark):
    """No rows; repeated rows; null ids; a very long text; further columns whose names the stages use themselves."""
    extra = "doc string, row string, id string, epoch string, words string, key string, own string, file string"
    kind = f"doc_id long, text string, lang string, source string, n_chars long, {extra}"
    assert not any(one(spark, spark.createDataFrame([], kind), DATA).count() for _, one in P.STAGES)
    more = ("d", "r", "i", "e", "w", "k", "o", "f")
    long = " ".join(f"word{i}" for i in range(200_000))
    texts = [(1, "the same words here"), (1, "the same words here"), (None, "a text without an id"), (None, None), (2, ""), (3, long)]
    docs = spark.createDataFrame([(i, t, "en", None, len(t or ""), *more) for i, t in texts], kind)
    for name, one in P.STAGES:
        docs = materialize(one(spark, docs, DATA), name)
        assert [c for c in docs.columns if docs.columns.count(c) > 1] == []
    rows = {r.text: r for r in docs.collect()}
    assert set(rows) == {"the same words here", "a text without an id", long} and docs.count() == 3
    assert rows[long].file == "f" and rows[long].epoch == 0 and rows[long].words == 200_000 and rows[long].n_chars == len(long)


def test_stages(spark):
    extra = spark.createDataFrame([(100001, None, "en", "src1", 0), (100002, "12 %%", None, None, 5), (100003, "Le la des une que et les du", None, None, 27), (100004, "", "de", "src2", 0)], "doc_id long, text string, lang string, source string, n_chars long")
    docs = materialize(table(spark, DATA, "documents").select(*COLUMNS).unionByName(extra), "in")
    seen = {}
    for name, stage in P.STAGES:
        before = docs.collect()
        docs = materialize(stage(spark, docs, DATA), name)
        seen[name] = (before, docs.collect())
        assert docs.columns[:5] == COLUMNS
    assert [n for n, _ in P.STAGES] == ["language", "lines", "near_duplicates", "benchmark", "mixture"] and P.ORACLE_SQL is None

    before, after = seen["language"]
    letters = {d.doc_id for d in before if d.text and any(c.isalpha() for c in d.text)}
    assert {d.doc_id for d in after} == letters and next(d for d in after if d.doc_id == 100003).lang == "fr"

    before, after = seen["lines"]
    repeated, kept = brute_lines(before), {d.doc_id: d for d in after}
    for d in before:
        lines = d.text.split("\n")
        gone = [k for k in range(len(lines)) if (d.doc_id, k) in repeated]
        long = {k for k in gone if len(lines[k].split()) > 50}
        if not gone:
            assert kept[d.doc_id] == d
        elif d.doc_id not in kept:
            assert len(gone) == len(lines)
        else:
            left = kept[d.doc_id].text.split("\n")
            assert not [k for k in long if lines[k] in left and lines.count(lines[k]) == 1]
            assert [x for k, x in enumerate(lines) if k not in gone] == [x for x in left if x not in {lines[k] for k in gone}] or len(left) >= len(lines) - len(gone)
            assert kept[d.doc_id].n_chars == len(kept[d.doc_id].text)

    before, after = seen["near_duplicates"]
    groups = brute_components([(d.doc_id, d.text) for d in before], P.NEAR_WORDS, P.NEAR_PERCENT)
    assert {d.doc_id for d in after} == {i for i, (_, c) in groups.items() if i == c}

    before, after = seen["benchmark"]
    items = [(str(r.item_id), item_words(r.text)) for r in table(spark, DATA, "benchmark").collect()]
    clean = {d.doc_id for d in before if not (n := len(brute_hits(items, w := item_words(d.text))[0])) or 20 * n < len(w)}
    assert {d.doc_id for d in after} == clean
    own = {d.doc_id: d.text for d in before}
    for d in after:  # passages of over 50 words go from documents that stay
        gone, words = long_hits(items, own[d.doc_id]), item_words(own[d.doc_id])
        assert item_words(d.text) == [w for k, w in enumerate(words) if k not in gone] if gone else d.text == own[d.doc_id]

    before, after = seen["mixture"]
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    sizes, taken, own = {}, {}, {d.doc_id: d for d in before}
    for d in before:
        sizes[d.source] = sizes.get(d.source, 0) + size(d.text)
    for d in after:
        taken[d.source] = taken.get(d.source, 0) + d.words
        assert size(d.text) == d.words and own[d.doc_id].text.startswith(d.text) and 0 <= d.epoch < 3
    assert all(abs(taken.get(s, 0) - t) <= 0.5 for s, t in brute_targets(sizes).items())


def test_stages_can_be_composed_lazily(spark):
    """A stage whose input still reads what the stage before it left keeps that."""
    docs = table(spark, DATA, "documents").where("doc_id < 60")
    want = lazy = docs
    for name, stage in P.STAGES[1:]:
        want = materialize(stage(spark, want, DATA), f"want-{name}")
    for _, stage in P.STAGES[1:]:
        lazy = stage(spark, lazy, DATA)
    assert sorted(map(str, lazy.collect())) == sorted(map(str, want.collect()))
