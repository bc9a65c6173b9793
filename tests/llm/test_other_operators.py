"""Language ID, URL filters, decontamination, licences, language model, mixing and chat formatting."""

import math
import os
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tributary.llm import gru
from tributary.llm import lang_id as li
from tributary.llm import lm_score as lm
from tributary.llm.chat_format import chat_examples, read_back
from tributary.llm.decontaminate import SuffixAutomaton, decontaminate, item_words
from tributary.llm.lang_id import codewords, identify, train_model
from tributary.llm.license_scan import Scanner, license_scan
from tributary.llm.lm_score import lm_score
from tributary.llm.mix_sources import epochs_of, first_words, mix_sources
from tributary.llm.url_filter import filter_urls, rules_frame

DOCS = "doc_id long, text string, source string, n_words string, rule string, kept string, score string"


def frame(spark, rows, parts=3):
    return spark.createDataFrame([(i, t, s, "a", "b", "c", "d") for i, t, s in rows], DOCS).repartition(parts)


WORDS = {"aa": "tam tem kala kelo mita", "bb": "zug grath brok zruk dorg", "cc": "fiou leau queue douce oux"}


def prose(lang, n, rng):
    return " ".join(rng.choice(WORDS[lang].split()) for _ in range(n))


def test_language_id_on_held_out_texts(spark):
    rng = random.Random(0)
    rows = [(i, prose(lang, rng.choice([6, 40, 300]), rng), lang) for i, lang in enumerate(random.Random(1).choices(list(WORDS), k=240))]
    train = spark.createDataFrame(rows[:160], "doc_id long, text string, lang string")
    model = train_model(train, F.col("doc_id"), "lang", "text")
    test = [(i, t, s) for i, t, s in rows[160:]] + [(1000, None, None), (1001, "", None), (1002, "123 ²_!!", None), (1003, "Tam TEM kala " * 20_000, None), (1004, "x", None), (None, "tam tem", None)]
    got = {r.doc.doc_id: r for r in identify(frame(spark, test), model).collect()}
    assert all(got[i].lang_pred == s for i, _, s in rows[160:])
    assert [got[i].lang_pred for i in (1000, 1001, 1002)] == ["und"] * 3 and got[1000].score == 0
    assert got[1003].lang_pred == "aa" and got[1004].lang_pred in WORDS and got[None].lang_pred == "aa"
    assert all(0 <= r.score <= 1 for r in got.values()) and got[160].doc.kept == "c"


def test_language_id_with_few_labels(spark):
    none = train_model(spark.createDataFrame([], "doc_id long, text string, lang string"), F.col("doc_id"), "lang", "text")
    one = train_model(spark.createDataFrame([(1, "a b", "aa"), (2, None, "bb"), (3, "c", None)], "doc_id long, text string, lang string"), F.col("doc_id"), "lang", "text")
    docs = frame(spark, [(1, "some text", None), (2, None, None)])
    assert {r.lang_pred for r in identify(docs, none).collect()} == {"und"}
    assert sorted((r.lang_pred, r.score) for r in identify(docs, one).collect()) == [("aa", 1.0), ("und", 0.0)]
    assert identify(frame(spark, []), one).count() == 0


def test_rare_language_gets_its_share_of_the_training_rows(spark, monkeypatch):
    rng = random.Random(3)
    rows = [(i, prose(lang, 300, rng), lang) for i, lang in enumerate(["aa"] * 2000 + ["bb"] * 1960 + ["cc"] * 40)]
    seen = []
    monkeypatch.setattr(li, "fit", lambda x, y, aside, langs: seen.append(np.bincount(y, minlength=3)))
    train_model(spark.createDataFrame(rows, "doc_id long, text string, lang string"), F.col("doc_id"), "lang", "text", train_rows=270)
    assert seen[0].tolist() == [90, 90, 90]


def test_language_decoding_matches_brute_force(spark):
    """The same weights, one trigram and one language at a time."""
    rng = random.Random(4)
    rows = [(i, prose(lang, rng.choice([5, 60]), rng), lang) for i, lang in enumerate(random.Random(2).choices(list(WORDS), k=150))]
    model = train_model(spark.createDataFrame(rows, "doc_id long, text string, lang string"), F.col("doc_id"), "lang", "text")
    texts = [(i, f"{prose('aa', 3, rng)} {prose('bb', i, rng)}, É {i}!", None) for i in range(12)] + [(20, "Zug" * 30, None), (21, "é", None)]
    got = {r.doc.doc_id: r for r in identify(frame(spark, texts), model).collect()}
    for i, t, _ in texts:
        data = b" " + b" ".join(re.sub(rb"[\x00-\x60\x7b-\x7f]", b" ", t.lower().encode()).split()) + b" "
        code = [(data[k] << 16 | data[k + 1] << 8 | data[k + 2]) * 2654435761 % 2**32 >> 20 for k in range(len(data) - 2)]
        margin = [sum(float(model.weights[c, bit]) for c in code) * li.SCALE / len(code) + model.bias[bit] for bit in range(len(model.bias))]
        loss = [sum(w * math.log1p(math.exp(-m * c)) for m, c, w in zip(margin, word, model.trust, strict=True)) for word in model.code]
        p = [math.exp(min(loss) - x) for x in loss]
        p = {lang: x / sum(p) for lang, x in zip(model.langs, p, strict=True)}
        best = sorted(p, key=lambda k: -p[k])
        assert (got[i].lang_pred, got[i].second) == (best[0], best[1]) and got[i].score == pytest.approx(p[best[0]], abs=1e-5)
        assert got[i].ambiguous == (p[best[0]] - p[best[1]] < 0.2)


def test_too_many_languages_are_refused(spark, monkeypatch):
    monkeypatch.setattr(li, "MAX_LANGS", 2)
    with pytest.raises(ValueError, match="more than 2"):
        train_model(spark.createDataFrame([(i, "a b", x) for i, x in enumerate("abc")], "doc_id long, text string, lang string"), F.col("doc_id"), "lang", "text")


def test_codewords_are_apart():
    assert codewords(4).shape == (4, 7)
    for n in (2, 5, 20):
        c = codewords(n)
        assert min((a != b).sum() for i, a in enumerate(c) for b in c[:i]) >= max(1, c.shape[1] // 4)


RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/"), ("block", "x.y.z", "")]


def brute_url(url):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.split(r"[/?#]", rest)[0]
    path = re.split(r"[?#]", rest[len(host) :])[0]
    host = host.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    fits = [(len(h + p), h + p, v) for v, h, p in RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return (host, path, *(max(fits)[1:] if fits else (None, "allow")))


def test_url_filter_matches_brute_force(spark):
    urls = [None, "", "no scheme", "://", "http://", "http://ORG/", "http://org", "https://a.EXAMPLE.org/es/x?y", "http://example.org/es", "http://notexample.org/es/", "http://example.org/en/12#z", "http://b.com/fr/", "x://com/de/", "http://x.y.z", "http://q.x.y.z?a/b", "http://x://y.org/z", "http://..org/", "http://É.com/de/é", "http://a\nb.com/de/"]
    pages = spark.createDataFrame([(i, u, "h", "p") for i, u in enumerate(urls)] + [(1, "http://org/", "", ""), (None, "http://com/de/", "", "")], "page_id long, url string, host string, rule string")
    got = filter_urls(pages, rules_frame(spark, [*RULES, RULES[0]])).collect()
    assert len(got) == len(urls) + 2
    for r in got:
        if r.page_id is not None and r.page_id != 1:
            assert (r.host, r.path, r.rule, r.verdict) == brute_url(urls[r.page_id]), urls[r.page_id]
    assert filter_urls(pages.limit(0), rules_frame(spark, RULES)).count() == 0
    hot = spark.range(900).select(F.col("id").alias("page_id"), F.when(F.col("id") % 3 > 0, "http://a.com/de/").otherwise(F.concat(F.lit("http://org/"), F.repeat(F.lit("x"), 20_000), "id")).alias("url"))
    got = filter_urls(hot, rules_frame(spark, RULES)).groupBy("rule", "verdict").count().collect()  # two thirds of all rows are one URL, the others are long
    assert {tuple(r) for r in got} == {("com/de/", "block", 600), ("org/", "allow", 300)}
    assert {r.verdict for r in filter_urls(pages, rules_frame(spark, RULES).limit(0), default="block").collect()} == {"block"}
    # A rule without the slash: host and path together are another host's name.
    got = filter_urls(pages.where("page_id = 6"), rules_frame(spark, [("block", "example.o", "rg"), ("block", "or", "g"), ("allow", "zz.net", "")]), default="none").first()
    assert (got.host, got.rule, got.verdict) == ("org", None, "none")


def brute_hits(items, words, window=13):
    hit, found = set(), set()
    for key, w in items:
        k = min(window, len(w))
        wins = {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if w else set()
        for i in range(len(words) - k + 1):
            if tuple(words[i : i + k]) in wins:
                hit |= set(range(i, i + k))
                found.add(key)
    return hit, found


def test_automaton_matches_brute_force():
    rng = random.Random(3)
    for _ in range(60):
        letters = [b"a", b"b", b"c", b"d"][: rng.choice([2, 3, 4])]
        window = rng.choice([2, 3, 5])
        items = [(str(i), [rng.choice(letters) for _ in range(rng.randrange(0, 12))]) for i in range(rng.randrange(1, 6))]
        sam = SuffixAutomaton(items, window)
        for _ in range(10):
            words = [rng.choice([*letters, b"z"]) for _ in range(rng.randrange(0, 40))]
            spans, found = sam.match(words)
            hit, want = brute_hits([(k, w) for k, w in items if w], words, window)
            assert {i for s, e in spans for i in range(s, e)} == hit and found == want


def test_decontaminate_with_long_items_and_without_ids(spark):
    """Items are cut into parts when they are longer than a block; all agree with brute force."""
    rng = random.Random(12)
    letters = "abcde"
    items = [(str(i) if i % 3 else None, [rng.choice(letters) for _ in range(n)]) for i, n in enumerate([90, 3, 40, 12, 14, 200, 1])]
    texts = [(i, [rng.choice([*letters, "z"]) for _ in range(rng.randrange(5))] + items[i % 7][1][i : i + 30] + ["z"]) for i in range(40)]
    frame_of = spark.createDataFrame([(k, " ".join(w)) for k, w in items], "item_id string, text string")
    want = {i: brute_hits(items, w, 5) for i, w in texts}
    for block_words in (7, 50, 10_000):
        got = {r.doc.doc_id: r for r in decontaminate(frame(spark, [(i, " ".join(w), "s") for i, w in texts]), frame_of, window=5, span_limit=9, block_words=block_words).collect()}
        for i, w in texts:
            hit, found = want[i]
            assert (got[i].n_words, got[i].n_hit, got[i].item_ids) == (len(w), len(hit), sorted(found - {None}))
            assert got[i].contaminated == (0 < 20 * len(hit) >= len(w)) and got[i].n_removed == len(hit)  # all are contaminated or clean here


def test_decontaminate(spark):
    item = " ".join(f"q{i}" for i in range(20))
    items = spark.createDataFrame([(10, item), (9, "Short one"), (8, None), (None, "x y"), (7, "...")], "item_id long, text string")
    docs = [(1, f"Before, {item.upper()}! after"), (2, " ".join(f"q{i}" for i in range(12))), (3, "a SHORT-one b"), (4, None), (5, ""), (6, "w " * 2000 + item + " w" * 2000), (7, "xshort one")]
    for block_words in (1, 100_000):
        got = {r.doc.doc_id: r for r in decontaminate(frame(spark, [(i, t, "s") for i, t in docs]), items, block_words=block_words, span_limit=15).collect()}
        assert (got[1].n_words, got[1].n_hit, got[1].item_ids, got[1].contaminated, got[1].clean_text) == (22, 20, ["10"], True, "Before, ! after")
        assert (got[2].n_hit, got[2].contaminated, got[2].clean_text) == (0, False, docs[1][1])
        assert (got[3].item_ids, got[3].n_hit, got[3].contaminated) == (["9"], 2, True)
        assert (got[4].n_words, got[4].clean_text, got[5].n_words, got[5].contaminated) == (0, None, 0, False)
        assert got[6].n_hit == 20 and not got[6].contaminated and "q3" not in got[6].clean_text  # long span, low coverage
        assert got[7].n_hit == 0 and got[1].doc.kept == "c"
    assert decontaminate(frame(spark, [(1, item, "s")]), items.limit(0)).first().n_hit == 0
    assert decontaminate(frame(spark, []), items).count() == 0
    assert item_words("É-Ab c1") == ["É".encode(), b"ab", b"c1"]


def test_license_scan(spark):
    rng = random.Random(5)
    filler = [prose("aa", 12, rng) for _ in range(300)]
    notices = {
        1: ("Released under the MIT License.", "mit"), 2: ("Licensed under the Apache License, Version 2.0.", "apache-2.0"), 3: ("This work is licensed under the GNU General Public License, version 3.", "gpl"), 4: ("All rights reserved.", "proprietary"), 5: ("Licensed under CC BY-NC 4.0.", "cc-by-nc-4.0"),
    }
    docs = [(i, f"{filler[i]}\n{t}\n{filler[i + 9]}", "s") for i, (t, _) in notices.items()]
    docs += [(6, prose("aa", 400, rng) + " " + notices[2][0] + " " + prose("aa", 300, rng), "s"), (7, None, "s"), (8, "", "s"), (9, "The rights of the public are reserved for members of the library.", "s"), (10, filler[0], "s"), (None, notices[1][0], "s")]
    scanner = Scanner([item_words(t) for t in filler[100:]])
    got = {r.doc_id: r for r in license_scan(frame(spark, docs), scanner=scanner).collect()}
    for i, (_, family) in notices.items():
        assert [(n.family, n.paragraph, n.confirmed) for n in got[i].notices if n.confirmed] == [(family, 1, True)]
    assert [n.family for n in got[6].notices if n.confirmed] == ["apache-2.0"] and [n.family for n in got[None].notices] == ["mit"]
    assert all(not any(n.confirmed for n in got[i].notices) for i in (7, 8, 9, 10)) and got[7].n_paragraphs == 0
    assert license_scan(frame(spark, [])).count() == 0


def brute_notices(scanner, text):
    """The same weights, one window, word and template at a time."""
    from tributary.llm.license_scan import BITS, LONG, STEP
    import xxhash

    out = {}
    for k, line in enumerate((text or "").split("\n")):
        words = re.findall(r"[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", line.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")))
        for own in [words[i : i + 2 * STEP] for i in range(0, len(words) - STEP, STEP)] if len(words) > LONG else [words] * bool(words):
            code = [xxhash.xxh32_intdigest(w.encode()) for w in own]
            slots = [c * 2654435761 % 2**32 >> (32 - BITS) for c in code]
            slots += [((a * 40503 % 2**32) ^ (b * 2246822519 % 2**32 >> 3)) * 3266489917 % 2**32 >> (32 - BITS) for a, b in zip(code, code[1:], strict=False)]
            z = [(sum(float(scanner.w[s, y]) for s in slots) / math.sqrt(len(slots)) + float(scanner.b[y])) / scanner.temperature for y in range(len(scanner.families))]
            p = [math.exp(x - max(z)) for x in z]
            y = p.index(max(p))
            if y and max(p) / sum(p) >= scanner.threshold:
                pairs = set(zip(own, own[1:], strict=False)) or {(own[0],)}
                like = max(len({(a.decode(), *(x.decode() for x in b)) for a, *b in t} & pairs) / min(len(t), len(pairs)) for t in scanner.templates[scanner.families[y]])
                new = (like >= scanner.confirm, max(p) / sum(p))
                if new > out.get((k, scanner.families[y]), (False, -1)):
                    out[k, scanner.families[y]] = new
    return out


def test_license_scan_matches_brute_force(spark):
    from tributary.llm.license_templates import NEAR_MISSES, TEMPLATES

    rng = random.Random(7)
    lines = [t for ts in TEMPLATES.values() for t in ts] + list(NEAR_MISSES) + [prose("aa", 12, rng) for _ in range(20)]
    docs = [(i, "\n".join(" ".join(rng.sample(lines, rng.choice([1, 1, 3]))) for _ in range(4)), "s") for i in range(25)]
    scanner = Scanner([item_words(prose("aa", 12, rng)) for _ in range(200)])
    found = 0
    for r in license_scan(frame(spark, docs), scanner=scanner).collect():
        want = brute_notices(scanner, docs[r.doc_id][1])
        assert {(n.paragraph, n.family): n.confirmed for n in r.notices} == {k: sure for k, (sure, _) in want.items()}
        assert all(n.probability == pytest.approx(want[n.paragraph, n.family][1], abs=1e-4) for n in r.notices)
        found += len(want)
    assert found > 30


def test_license_training_rows_have_any_length(spark):
    from tributary.llm.license_scan import LONG, STEP, corpus_paragraphs

    long = " ".join(f"Word{i}" for i in range(5000))  # some 44,000 characters
    got = corpus_paragraphs(frame(spark, [(1, f"{long}\n\nshort one", "s"), (2, None, "s")]), "text", 100)
    assert sorted(map(len, got)) == [2, 2 * STEP] and LONG > 2 * STEP
    own = max(got, key=len)
    assert own == [f"word{int(own[0][4:]) + i}".encode() for i in range(len(own))]


def test_license_scan_finds_every_family_of_a_long_line():
    rng = random.Random(5)
    scanner = Scanner([item_words(prose("aa", 12, rng)) for _ in range(200)])
    line = " ".join([prose("aa", 100, rng), "Licensed under the Apache License, Version 2.0.", prose("aa", 100, rng), "This work is licensed under the GNU General Public License, version 3.", prose("aa", 100, rng)])
    assert {"apache-2.0", "gpl"} <= {f for _, f, _, _, sure in scanner.scan(line.encode()) if sure}


def test_gradient_is_right(monkeypatch):
    monkeypatch.setattr(gru, "F32", np.float64)
    rng = np.random.default_rng(0)
    n_head, hidden = 130, 4
    p = gru.initial(rng.integers(1, 100, n_head).astype(float), 50, hidden)
    p = {k: v.astype(np.float64) + rng.normal(0, 0.3, v.shape) for k, v in p.items()}
    inputs, targets, h = rng.integers(0, n_head + 1, (4, 7)), rng.integers(0, n_head + 1, (4, 7)), rng.normal(0, 0.5, (4, hidden))
    inputs[1, 3] = 0

    def loss(q):
        now, states = h, []
        for t in range(7):
            now, _ = gru.step(q["x"] + q["b"], q["u"], inputs[:, t], np.where((inputs[:, t] == 0)[:, None], 0, now))
            states.append(now)
        return -gru.log_probs(q, np.concatenate(states), targets.T.ravel(), n_head).mean()

    grad, _ = gru.gradient(p, inputs, targets, h, n_head)
    for k in p:
        for _ in range(4):
            at = tuple(rng.integers(0, s) for s in p[k].shape)
            at = (inputs[0, 2], at[1]) if k == "x" else at
            up, down = ({a: b.copy() for a, b in p.items()} for _ in range(2))
            up[k][at] += 1e-5
            down[k][at] -= 1e-5
            assert grad[k][at] == pytest.approx((loss(up) - loss(down)) / 2e-5, abs=1e-6)


def test_scores_do_not_depend_on_company_or_windows():
    rng = np.random.default_rng(1)
    p = gru.initial(np.full(100, 5.0), 50, 6)
    p = {k: (v + rng.normal(0, 0.2, v.shape)).astype(np.float32) for k, v in p.items()}
    docs = [np.append(rng.integers(1, 101, n), 0) for n in (0, 1, 3, 70, 200)]
    every = gru.score(p, np.concatenate(docs), np.array([len(d) for d in docs]), 100, lanes=2, window=16)
    for d, s in zip(docs, every, strict=True):
        assert gru.score(p, d, np.array([len(d)]), 100, window=500)[0] == pytest.approx(s, abs=1e-3)


@pytest.mark.parametrize("sizes", [[0, 1, 3, 700, 5, 90_000], [2], [400] * 50, []])
def test_blocks_hold_every_token_once(sizes):
    docs, at = [], 1
    for n in sizes:
        docs.append(np.append(np.arange(at, at + n), 0))
        at += n
    blocks = list(gru.blocks_of(docs, 32, 8, 5000))
    targets = np.concatenate([b[:, 1:].ravel() for b in blocks] or [np.zeros(0, np.int64)])
    assert sorted(targets) == sorted(np.concatenate(docs or [np.zeros(0, np.int64)]))
    assert all((b[:, 1:] == b[:, :-1] + 1)[(b[:, :-1] > 0) & (b[:, 1:] > 0)].all() for b in blocks)  # order is kept


def test_lm_score_learns_from_late_documents(spark):
    n = 40
    docs = [("q " * 20_000).encode()] * n + [b"a b " * 10_000] * n + [b"z y " * 400_000]  # over 900,000 tokens before the last one
    rows = spark.createDataFrame([(d, i) for i, d in enumerate(docs)], "text binary, row long").coalesce(1)
    tokens = [d.split() for d in docs]
    counts = Counter(w for t in tokens for w in t) + Counter({lm.END: len(docs)})
    v = lm.Vocabulary(list(counts), list(counts.values()), sum(counts.values()), len(counts), 0, 0)
    p = gru.shaped(lm.fit(rows, v, hidden=4), v.n_head, 4)
    text = np.array([v.words.index(w) for w in [b"z", b"y"] * 100] + [0])
    assert gru.score(p, text, np.array([len(text)]), v.n_head)[0] / len(text) > -1.2  # ln(1 / 6) = -1.8 by counts alone


def test_lm_score(spark):
    rng = random.Random(2)
    rows = [(i, prose(rng.choice(list(WORDS)), rng.randrange(0, 60), rng), "s") for i in range(300)] + [(1000, None, "s"), (1001, "", "s"), (1002, "Kala unseen-word", "s"), (None, "tam", "s"), (5, "tam", "s")]
    got = lm_score(frame(spark, rows), known=10, head=8).collect()
    assert len(got) == len(rows)
    tokens = {i: [*(t or "").lower().split(), None] for i, t, _ in rows[:-1]}
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2
    counts: dict = {}
    for i, t, _ in rows:
        if not held(i):
            for w in [*(t or "").lower().split(), None]:
                counts[w] = counts.get(w, 0) + 1
    n, v = sum(counts.values()), len(counts)
    for r in got:
        if r.doc_id == 5:
            continue
        own = tokens[r.doc_id]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held(r.doc_id), len(own), sum(w in counts for w in own), n)
        assert r.base_score == pytest.approx(sum(math.log10((counts.get(w, 0) + 1) / (n + v + 1)) for w in own))
        assert r.score < 0
    test = [r for r in got if r.held_out]
    assert sum(r.score for r in test) > sum(r.base_score for r in test)  # it knows that a text keeps to one language
    assert lm_score(frame(spark, [])).count() == 0
    few = lm_score(frame(spark, [(2, "a b", "s")] if held(2) else [(12, None, "s")])).first()
    assert math.isfinite(few.score) and math.isfinite(few.base_score)


def test_production_model_learns_the_corpus(spark):
    """With the parameters of the query the held-out documents of a table are far likelier than by unigrams."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet") if os.path.isdir("/root/testdata/sf0.001") else pytest.skip("no tables")
    got = lm_score(docs).where("held_out").agg(F.sum("score").alias("s"), F.sum("base_score").alias("b"), F.sum("n_tokens").alias("n")).first()
    assert (got.s - got.b) / got.n > 0.3  # log10: a token is more than twice as likely


def test_outcomes_of_the_language_model_sum_to_one():
    """After any state the head words, the known other words and the one unknown outcome have all of the probability."""
    words, counts = [f"w{i}".encode() for i in range(300)], [1 + i % 7 for i in range(300)]
    v = lm.Vocabulary(words, counts, sum(counts), len(words), counts.count(1), counts.count(2), head=130)
    assert v.words[0] == lm.END and v.counts[0] == 0 and v.n_head == 130
    rng = np.random.default_rng(1)
    p = {k: rng.normal(0, 0.5, x.shape).astype(np.float32) for k, x in gru.initial(v.head_counts, v.other_total, 5).items()}
    p["bw"].ravel()[v.n_head :] = -60  # as initial() has it: places of the last class without a word
    h = rng.uniform(-1, 1, (3, 5)).astype(np.float32)
    shares = sum(10 ** v.known_share(c) for c in v.counts[v.n_head :]) + 10 ** v.unknown_share()
    for state in h:
        each = gru.log_probs(p, np.repeat(state[None], v.n_head + 1, axis=0), np.arange(v.n_head + 1), v.n_head)
        assert np.exp(each[:-1]).sum() + np.exp(each[-1]) * shares == pytest.approx(1, abs=1e-4)


def test_vocabulary_takes_whole_levels(spark):
    rows = [(b"\n", 3), *((f"w{i}".encode(), 1000 - i) for i in range(40)), *((f"x{i}".encode(), 7) for i in range(50)), (b"y" * 100, 5000)]
    counts = spark.createDataFrame(rows, "word binary, c long")
    assert len(lm.vocabulary(counts, known=80).words) == 41 and lm.vocabulary(counts, known=10**6).n_head == 91
    v = lm.vocabulary(counts, known=12)  # counts of 512 and more are levels of two
    assert 11 <= len(v.words) <= 13 and v.words[:2] == [lm.END, b"w0"] and v.counts[0] == 3 and v.total == sum(c for _, c in rows)
    levels = [r[0] for r in spark.range(1, 5000).select(lm.count_level(F.col("id"))).collect()]
    assert levels == sorted(levels) and levels[:600] == [*range(1, 512), *(512 + i // 2 for i in range(89))]
    assert spark.range(1).select(lm.count_level(F.lit(2**62))).first()[0] < 1 << 14


def brute_targets(sizes, weights=(5, 2, 1), most=3):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[i % 3] for i, s in enumerate(names)}
    total, capped = sum(sizes.values()), set()
    while True:
        left = total - sum(most * sizes[s] for s in capped)
        share = sum(w[s] for s in names if s not in capped)
        target = {s: float(most * sizes[s]) if s in capped else w[s] * left / share for s in names}
        more = {s for s in names if s not in capped and target[s] > most * sizes[s]}
        if not more:
            return target
        capped |= more


def test_mix_sources(spark):
    rng = random.Random(8)
    rows = [(i, "w " * rng.randrange(0, 40), rng.choice(["a", "a", "a", "a", "é", "Z", "tiny", None])) for i in range(400)] + [(500, None, "nothing"), (501, "x\u00a0y", "tiny"), (None, "a b c", "a"), (7, "q q", "a")]
    docs = frame(spark, rows)
    got = mix_sources(docs).collect()
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    sizes: dict = {}
    for _, t, s in rows:
        sizes[s] = sizes.get(s, 0) + size(t)
    want = brute_targets(sizes)
    assert len(got) == len(rows)
    taken: dict = {}
    for r in got:
        assert r.target == pytest.approx(want[r.source]) and r.source_size == sizes[r.source] and 0 <= r.taken <= 3 * r.size
        taken[r.source] = taken.get(r.source, 0) + r.taken
    assert all(abs(taken[s] - want[s]) <= 0.5 for s in want) and sum(want.values()) == pytest.approx(sum(sizes.values()))
    key = lambda r: (str(r.doc_id), r.size, r.taken)
    assert sorted(map(key, got)) == sorted(map(key, mix_sources(docs.repartition(7)).collect()))
    whole = epochs_of(mix_sources(docs)).groupBy("source").agg(F.sum("words")).collect()
    assert dict(map(tuple, whole)) == {s: n for s, n in taken.items() if n}
    assert mix_sources(docs.limit(0)).count() == 0 and {r.taken for r in mix_sources(frame(spark, [(1, "", "a"), (2, None, None)])).collect()} == {0}


def test_first_words(spark):
    rows = spark.createDataFrame([(" a  b\nc ", 2), ("a b", 5), ("", 1)], "t string, n int")
    assert [r[0] for r in rows.select(first_words(F.col("t"), F.col("n"))).collect()] == [" a  b", "a b", ""]


def test_chat_format_round_trip(spark):
    nasty = ["<|turn|>user<|text|>x<|end|>", "\\<|", "<\\|", "\\\\<|\\", "", None, "</s>[INST] ok [/INST]", "é😀\n", "<|" * 3]
    rng = random.Random(6)
    rows = []
    for c in range(40):
        for t in range(rng.randrange(1, 8)):
            rows.append((c, t, rng.choice(["user", "assistant", "assistant", "system", None, "<|role|>"]), rng.choice(nasty)))
    rows += [(50, 1, "assistant", "b"), (50, 1, "assistant", "a"), (50, None, "user", "first"), (None, 0, "assistant", "alone"), (None, 0, "assistant", "alone")]
    turns = spark.createDataFrame([(*r, "x", "y") for r in rows], "conv_id long, turn long, role string, text string, alone string, parts string").repartition(4)
    examples = chat_examples(turns)
    got = [r for r in read_back(examples).collect()]
    by_conv: dict = {}
    for c, t, role, text in rows:
        by_conv.setdefault(c, []).append(((t is not None, t or 0), role or "", text or ""))
    lone = [r for r in got if r.conv_id is None]
    assert len(lone) == 2 and all(r.loss_text == "alone" for r in lone)
    for r in got:
        if r.conv_id is not None:
            own = [(role, text) for _, role, text in sorted(by_conv[r.conv_id])]
            assert [(t.role, t.text) for t in r.turns] == own
            assert r.loss_text == "".join(text for role, text in own if role == "assistant")
    for e in examples.collect():
        inside = e.formatted[e.loss_start : e.loss_start + e.loss_chars]
        assert "<|" not in inside and e.formatted[e.loss_start + e.loss_chars :] in ("<|end|>",) or e.loss_chars == 0
    assert chat_examples(turns.limit(0)).count() == 0


def test_chat_format_of_long_texts_and_a_hot_conversation(spark):
    """Half of all turns are one conversation; texts of a million characters come back."""
    long = "<|turn|>\\ é " * 80_000
    rows = [(0, t, "assistant" if t % 2 else "user", f"text {t}") for t in range(300)] + [(c, t, "assistant" if t else "user", long if c < 6 else "short") for c in range(1, 150) for t in range(2)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(3)
    got = {r.conv_id: r for r in read_back(chat_examples(turns)).collect()}
    assert len(got) == 150 and len(got[0].turns) == 300 and got[0].loss_text == "".join(f"text {t}" for t in range(1, 300, 2))
    assert all(got[c].loss_text == long and got[c].turns[0].text == long for c in range(1, 6)) and got[149].loss_text == "short"
