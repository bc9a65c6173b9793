"""Token counts against the library on whole texts, and their edge cases."""

import random

import pytest

from tributary.llm import token_counts as C

P = pytest.importorskip("public_tokenizers")
tokenizers = pytest.importorskip("tokenizers")
PARTS = ["a", "Bé", " ", "  ", "\n", "\t", "'s", "'", "1", "é", "é", "́", "。", "、", "漢", "か", "<|endoftext|>", "<|EndOfText|>", "<|", "|>", "\xa0", "ß", "Σ", "İ", "!", "_", "가", "ᆨ", "\x1c", "\x85", " ", "x y"]
ROWS = "doc_id long, text string, id string, n_tokens string, n_bytes string"


def whole(name):
    t = tokenizers.Tokenizer.from_file(P.path(name))
    return t, lambda text: len(t.encode(text or "", add_special_tokens=False))


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_pieces_give_the_count_of_the_whole(name):
    t, want = whole(name)
    rng, known = random.Random(5), C.Words(20)
    with open(P.path(name), encoding="utf-8") as f:
        assert C.may_cut(f.read())
    for _ in range(3000):
        texts = ["".join(rng.choice(PARTS) for _ in range(rng.randrange(40))) for _ in range(3)]
        assert C.lengths(texts, t, known, rng.randrange(1, 9), rng.randrange(1, 60)) == [*map(want, texts)] == C.lengths(texts, t, None)
        assert len(known.recent) <= 20 and all("".join(C.safe_pieces(x, 3)) == x for x in texts)


def test_groups_are_filled_by_bytes_and_long_texts_are_cut():
    texts = ["é" * 10] * 7 + ["word " * 1000] + ["x" * 500]
    found = list(C.groups(texts, 50, 100))
    assert all(sum(len(p.encode()) for _, p in g[:-1]) < 100 for g in found) and len(found) > 50
    assert ["".join(p for g in found for i, p in g if i == k) for k in range(9)] == texts


def test_token_counts(spark):
    _, want = whole("word_bpe_49k.json")
    texts = [None, "", "  \n", "Ünïted <|endoftext|> x'S 12", "ab " * 200_000, "z" * 30_000, "漢字。" * 30_000, "same", "same"]
    rows = [(i if i < 7 else None, t, "a", "b", "c") for i, t in enumerate(texts)]
    got = C.token_counts(spark.createDataFrame(rows, ROWS).repartition(2), P.path("word_bpe_49k.json"), limit=100).collect()
    assert sorted(((r.doc_id or 0), r.n_bytes, r.n_tokens, r.over_limit) for r in got) == sorted((i or 0, len((t or "").encode()), want(t), want(t) > 100) for i, t, *_ in rows)
    assert C.token_counts(spark.createDataFrame([], ROWS), P.path("word_bpe_49k.json")).count() == 0


def test_vocabulary_through_spark_and_refusals(spark, tmp_path):
    from_file = C.vocabulary_text(spark, P.path("word_bpe_49k.json"))
    assert C.vocabulary_text(spark, f"file://{P.path('word_bpe_49k.json')}") == from_file
    for bad in (P.path("piece_bpe_32k.model"), "none.txt"):
        with pytest.raises(ValueError, match="json"):
            C.token_counts(spark.createDataFrame([], ROWS), bad)
    text = from_file.replace('"lstrip":false', '"lstrip":true').replace('"lstrip": false', '"lstrip": true')
    assert not C.may_cut(text)  # such a token takes white space before it
    short = tmp_path / "short.json"  # truncation and padding in a file are off
    t = tokenizers.Tokenizer.from_file(P.path("word_bpe_49k.json"))
    t.enable_truncation(2)
    t.enable_padding(length=9)
    t.save(str(short))
    rows = [(1, "one two three four", "", "", "")]
    assert [r.n_tokens for r in C.token_counts(spark.createDataFrame(rows, ROWS), str(short)).collect()] == [4]
