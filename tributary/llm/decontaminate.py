"""Benchmark decontamination with a generalised suffix automaton over words.

The items are a stated query set. They are read in blocks of bounded size; each block is broadcast, every Python worker
builds its automaton once, and all documents stream through it in a narrow stage. Several blocks take a pass each, which
writes what it hit and no text. While a document's words pass, the automaton tracks the longest suffix that is a run of item words; a run of `window` words or
more, or a whole shorter item, is a hit.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator
from functools import reduce
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tributary.llm.common import ALNUM_RUN, AT, FILE, LOWER_AZ, addressed, if_small, materialize, pieces, scratch, small_batches

WINDOW = 13
BLOCK_WORDS = 100_000
BIGRAM_BITS = 22

SPANS = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))
ITEMS = T.ArrayType(T.StringType())


class SuffixAutomaton:
    """Of all items' words; each item starts at the root again, so no match crosses two items."""

    def __init__(self, items: Iterable[tuple[str | None, list[bytes]]], window: int = WINDOW):
        items = [(k, w) for k, w in items if w]
        self.window = window
        self.word_id: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        self.shortest = min([window, *(len(w) for _, w in items)])
        ends: list[tuple[str, list[int]]] = []  # the state after each word of each item
        pairs: list[tuple[int, int]] = []
        for key, words in items:
            ids = [self.word_id.setdefault(w, len(self.word_id)) for w in words]
            pairs += zip(ids, ids[1:], strict=False)
            last, path = 0, []
            for c in ids:
                last = self._extend(last, c)
                path.append(last)
            ends.append((key, path))
        # What a state says about the windows that end there: items whose window it is, by the state of the window's words.
        self.items: list[set[str]] = [set() for _ in self.link]
        self.short: list[list[tuple[int, str]]] = [[] for _ in self.link]
        for key, path in ends:
            if len(path) < window:
                self.short[path[-1]].append((len(path), key))
                continue
            for end in path[window - 1 :]:
                if (u := self._anchor(end)) >= 0:
                    self.items[u].add(key)
        self.anchor = [self._anchor(u) for u in range(len(self.link))]
        for u in sorted(range(1, len(self.link)), key=self.length.__getitem__):  # short items that end in a shorter suffix
            self.short[u] = self.short[u] + self.short[self.link[u]]
        self.pairs = np.zeros(1 << BIGRAM_BITS, bool)
        if pairs:
            a, b = np.array(pairs, np.int64).T
            self.pairs[self._slot(a, b)] = True

    def _extend(self, last: int, c: int) -> int:
        nxt, link, length = self.next, self.link, self.length
        if c in nxt[last]:
            q = nxt[last][c]
            return q if length[q] == length[last] + 1 else self._split(last, c, q)
        new = self._state(length[last] + 1, {})
        p = last
        while p >= 0 and c not in nxt[p]:
            nxt[p][c] = new
            p = link[p]
        if p < 0:
            link[new] = 0
        else:
            q = nxt[p][c]
            link[new] = q if length[q] == length[p] + 1 else self._split(p, c, q)
        return new

    def _state(self, length: int, transitions: dict[int, int]) -> int:
        self.next.append(transitions)
        self.link.append(0)
        self.length.append(length)
        return len(self.link) - 1

    def _split(self, p: int, c: int, q: int) -> int:
        clone = self._state(self.length[p] + 1, dict(self.next[q]))
        self.link[clone], self.link[q] = self.link[q], clone
        while p >= 0 and self.next[p].get(c) == q:
            self.next[p][c] = clone
            p = self.link[p]
        return clone

    def _anchor(self, u: int) -> int:
        """The state of the last `window` words of state u; -1 if u is shorter."""
        if self.length[u] < self.window:
            return -1
        while self.length[self.link[u]] >= self.window:
            u = self.link[u]
        return u

    def _slot(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return (a * 1_000_003 + b) & ((1 << BIGRAM_BITS) - 1)

    def _runs(self, ids: np.ndarray) -> Iterator[tuple[int, int]]:
        """Stretches long enough for a window in which each two neighbours may be neighbours in an item. A match lies in one whole."""
        known = ids >= 0
        if self.shortest == 1:
            ok, extra = known, 0
        else:
            ok, extra = known[:-1] & known[1:] & self.pairs[self._slot(ids[:-1], ids[1:])], 1
        edges = np.flatnonzero(np.diff(np.concatenate(([0], ok.view(np.int8), [0]))))
        for s, e in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):
            if e + extra - s >= self.shortest:
                yield s, e + extra

    def match(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Word spans [start, end) inside occurrences of windows, in order and without overlap, and the items they belong to."""
        if not self.word_id or len(words) < self.shortest:
            return [], set()
        ids = np.fromiter(map(self.word_id.get, words, repeat(-1)), np.int64, len(words))
        spans: list[tuple[int, int]] = []
        found: set[str] = set()
        nxt, link, length = self.next, self.link, self.length
        for s, e in self._runs(ids):
            u = size = 0
            for i, c in enumerate(ids[s:e].tolist(), s):
                while u and c not in nxt[u]:
                    u = link[u]
                    size = length[u]
                if c in nxt[u]:
                    u, size = nxt[u][c], size + 1
                reach = 0
                if size >= self.window:
                    reach = size
                    found |= self.items[self.anchor[u]]
                for k, key in self.short[u]:
                    if k <= size:
                        found.add(key)
                        reach = max(reach, k)
                if reach:
                    spans.append((i + 1 - reach, i + 1))
        return merged(spans), found


def merged(spans: Iterable[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for s, e in sorted(spans):
        if out and s <= out[-1][1]:
            out[-1] = (out[-1][0], max(e, out[-1][1]))
        else:
            out.append((s, e))
    return out


def item_words(text: str | bytes | None) -> list[bytes]:
    text = text.encode() if isinstance(text, str) else text or b""
    return ALNUM_RUN.findall(text.translate(LOWER_AZ))


_BUILT: dict[str, SuffixAutomaton] = {}


def automaton_of(key: str, block, window: int) -> SuffixAutomaton:
    """One block's automaton is kept per Python worker."""
    if key not in _BUILT:
        _BUILT.clear()
        _BUILT[key] = SuffixAutomaton(block.value, window)
    return _BUILT[key]


def blocks_of(benchmark: DataFrame, id_col: str, text_col: str, block_words: int, window: int) -> Iterator[list[tuple[str | None, list[bytes]]]]:
    """Items in blocks of about block_words words. A longer item is cut into parts that share window - 1 words, so that each
    of its windows lies in one of them."""
    block, size = [], 0
    for key, text in benchmark.select(F.col(id_col).cast("string"), F.col(text_col).cast("string")).toLocalIterator():
        words = item_words(text)
        for first in range(0, max(1, len(words) - window + 1), block_words) if words else ():
            part = words[first : first + block_words + window - 1]
            block.append((key, part))
            size += len(part)
            if size >= block_words:
                yield block
                block, size = [], 0
    if block:
        yield block


def decontaminate(
    docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_id: str = "item_id", item_text: str = "text",
    window: int = WINDOW, coverage: float = 0.05, span_limit: int = 50, clean: bool = True, block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """One row per row of docs: doc (a struct of its other columns), text, n_words, n_hit, n_removed, item_ids, spans,
    contaminated, clean_text.

    A window is `window` consecutive words of an item, or all words of a shorter one. Words inside an occurrence are hit.
    contaminated: at least one word is hit, and `coverage` of all words or more. spans: byte offsets in the UTF-8 text.
    clean_text (null unless clean): the text without the spans of more than span_limit words, and without any span if it
    is contaminated; n_removed: the words of those spans. Null and empty texts have no words and are never contaminated;
    items without words are skipped, and one without an id hits but is not listed; items that share an id count as one.
    Very long texts and items are matched whole. Repeated rows and ties are judged alike, each by itself. Columns of docs
    lie in the struct, so their names cannot clash. Without items nothing is hit; no rows give no rows.
    """
    small_batches(docs.sparkSession)
    sc = docs.sparkSession.sparkContext
    others = [F.col(c) for c in docs.columns if c not in (text_col, FILE, AT)]
    doc, text = F.struct(*others) if others else F.struct(F.lit(1).alias("none")), F.col(text_col).cast("string").cast("binary")
    names = ["doc", "text", "words", "item_ids"]
    span_type, item_type = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])), pa.list_(pa.string())

    def match(texts: list, sam: SuffixAutomaton, spans: list, items: list) -> tuple[list[list[bytes]], list, list]:
        """Words, spans and items of each row, with what other blocks found."""
        words = [item_words(t) for t in texts]
        for i, w in enumerate(words):
            hit, found = sam.match(w)
            if hit or spans[i]:
                spans[i] = [{"start": s, "end": e} for s, e in merged([*((x["start"], x["end"]) for x in spans[i] or ()), *hit])]
                items[i] = sorted({*(items[i] or ()), *found} - {None})
        return words, spans, items

    def hits(key: str, block):
        """What one block finds, of the rows with hits only."""

        def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sam = automaton_of(key, block, window)
            for b in pieces(batches):
                _, spans, items = match(b.column(2).to_pylist(), sam, [None] * b.num_rows, [None] * b.num_rows)
                own = pa.array([i for i, s in enumerate(spans) if s], pa.int64())
                yield pa.RecordBatch.from_arrays([b.column(0).take(own), b.column(1).take(own), pa.array(spans, span_type).take(own), pa.array(items, item_type).take(own)], [FILE, AT, *names[2:]])

        return step

    def last(key: str, block):
        def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sam = automaton_of(key, block, window)
            for b in pieces(batches):
                words, spans, items = match(b.column(1).to_pylist(), sam, b.column(2).to_pylist(), b.column(3).to_pylist())
                rows = {"n_words": [], "n_hit": [], "n_removed": [], "spans": [], "contaminated": [], "clean_text": []}
                for text, n, hit in zip(b.column(1), map(len, words), spans, strict=True):
                    hit = [(x["start"], x["end"]) for x in hit or ()]
                    n_hit = sum(e - s for s, e in hit)
                    bad = n_hit > 0 and n_hit >= coverage * n - 1e-9
                    text = text.as_py() if hit or clean else None
                    at = [m.span() for m in ALNUM_RUN.finditer(text.translate(LOWER_AZ))] if hit else []
                    cut = [(at[s][0], at[e - 1][1]) for s, e in hit]
                    rows["n_words"].append(n)
                    rows["n_hit"].append(n_hit)
                    rows["n_removed"].append(sum(e - s for s, e in hit if bad or e - s > span_limit))
                    rows["spans"].append([{"start": s, "end": e} for s, e in cut])
                    rows["contaminated"].append(bad)
                    rows["clean_text"].append(without(text, [x for x, (s, e) in zip(cut, hit, strict=True) if bad or e - s > span_limit]) if clean and text is not None else None)
                yield pa.RecordBatch.from_arrays(
                    [
                        b.column(0), b.column(1), pa.array(rows["n_words"], pa.int64()), pa.array(rows["n_hit"], pa.int64()), pa.array(rows["n_removed"], pa.int64()), pa.array([x or [] for x in items], item_type),
                        pa.array(rows["spans"], span_type), pa.array(rows["contaminated"], pa.bool_()), pa.array(rows["clean_text"], pa.string()),
                    ],
                    ["doc", "text", "n_words", "n_hit", "n_removed", "item_ids", "spans", "contaminated", "clean_text"],
                )

        return step

    # One Python worker a task at a time. If there are several blocks, each takes a pass of its own that writes hits only.
    blocks = blocks_of(benchmark, item_id, item_text, block_words, window)
    held, more = next(blocks, []), next(blocks, None)
    if more is None:
        cur = docs.select(doc.alias("doc"), text.alias("text"), F.lit(None).cast(SPANS).alias("words"), F.lit(None).cast(ITEMS).alias("item_ids"))
    else:
        rows, found = addressed(docs, {"doc": doc, "text": text}, "texts"), []
        kind = T.StructType([rows.schema[FILE], rows.schema[AT], T.StructField("words", SPANS), T.StructField("item_ids", ITEMS)])
        with scratch():
            for block in chain([held, more], blocks):
                sent = sc.broadcast(block)
                found.append(materialize(rows.select(FILE, AT, "text").mapInArrow(hits(uuid.uuid4().hex, sent), kind), "hits"))
                sent.destroy()
            every = reduce(DataFrame.unionByName, found).groupBy(FILE, AT).agg(F.flatten(F.collect_list("words")).alias("words"), F.flatten(F.collect_list("item_ids")).alias("item_ids"))
            every = materialize(every, "hits", stays=True)  # a row's own spans and items, as many as its text has room for
        cur, held = rows.join(if_small(every, 256, "words", 32), [FILE, AT], "left").select(*names), []
    out = T.StructType([cur.schema["doc"], T.StructField("text", T.BinaryType()), *(T.StructField(k, T.LongType()) for k in ("n_words", "n_hit", "n_removed")), T.StructField("item_ids", ITEMS), T.StructField("spans", SPANS), T.StructField("contaminated", T.BooleanType()), T.StructField("clean_text", T.StringType())])
    return cur.mapInArrow(last(uuid.uuid4().hex, sc.broadcast(held)), out).withColumn("text", F.col("text").cast("string"))


def without(text: bytes, spans: list[tuple[int, int]]) -> str:
    kept, done = [], 0
    for s, e in spans:
        kept.append(text[done:s])
        done = e
    return (b"".join(kept) + text[done:]).decode()
