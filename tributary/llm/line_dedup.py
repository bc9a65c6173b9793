"""Line deduplication by content-defined chunks of lines, in DataFrame operations only.

A document's lines are cut into chunks where the lines themselves say so: a hash that rolls over the hashes of the last
WINDOW lines ends a chunk where DIVISOR divides it. Insertions elsewhere therefore do not shift the cuts: after WINDOW
equal lines two documents cut alike. Chunks of several lines that stand in several documents are found by hash, confirmed
by SHA-256 of their bytes, and removed everywhere but in the first document.

A passage can begin and end inside chunks. So the shortest span of whole lines with more than `min_words` words, from
every line forwards and backwards, is a piece like a chunk: a repeated run of lines above that limit is exactly the union
of such spans, whatever stands around it, and a long line is a span by itself.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tributary.llm.common import AT, FILE, WORD, addressed, if_small, materialize, scratch

WINDOW, DIVISOR, MIN_LINES, MIN_WORDS = 4, 4, 2, 50
_HIGH = 1 << 32  # a piece is one long: first line * _HIGH + last line


def line_facts(lines: Column) -> Column:
    """array of (h, x, words): a 32-bit hash for the cuts, a 64-bit one for the pieces. Null for null."""
    h = lambda x: F.conv(F.substring(F.md5(x.cast("binary")), 1, 8), 16, 10).cast("long")
    return F.transform(lines, lambda x: F.struct(h(x).alias("h"), F.xxhash64(x).alias("x"), F.regexp_count(x, F.lit(WORD)).alias("words")))


def chunk_ends(facts: Column, window: int = WINDOW, divisor: int = DIVISOR) -> Column:
    """array of the numbers of the lines that end a chunk, from line_facts."""

    def end(x: Column, i: Column) -> Column:
        rolling = x["h"]
        for k in range(1, window):
            rolling = rolling + F.coalesce(F.get(facts, i - k)["h"], F.lit(0)) * 31**k
        return F.when((i == F.size(facts) - 1) | (rolling % divisor == 0), i).otherwise(-1)

    return F.filter(F.transform(facts, end), lambda i: i >= 0)


def part(lines: Column | str, a: Column, b: Column) -> Column:
    """Lines a to b."""
    return F.slice(lines, a + 1, b - a + 1)


def coded(a: Column, b: Column) -> Column:
    return a.cast("long") * F.lit(_HIGH) + b.cast("long")


def chunks(facts: Column, ends: Column, min_lines: int) -> Column:
    """array of the chunks with min_lines lines with words or more, coded."""
    every = F.transform(ends, lambda b, k: F.struct(F.when(k == 0, 0).otherwise(F.get(ends, k - 1) + 1).alias("a"), b.alias("b")))
    many = F.filter(every, lambda c: (c["b"] - c["a"] + 1 >= min_lines) & (F.size(F.filter(part(facts, c["a"], c["b"]), lambda x: x["words"] > 0)) >= min_lines))
    return F.transform(many, lambda c: coded(c["a"], c["b"]))


def spans(worded: Column, min_words: int) -> Column:
    """array of the spans from and to every line, coded; worded: (at, words) of the lines that have words.

    Every line has a word, so no span has over min_words + 1 of them.
    """
    most = min_words + 1

    def reached(near: Column) -> Column:
        """The line where more than min_words words are reached, or null."""
        none = F.struct(F.lit(0).alias("words"), F.lit(-1).alias("at"))
        step = lambda s, x: F.when(s["words"] > min_words, s).otherwise(F.struct((s["words"] + x["words"]).alias("words"), x["at"].alias("at")))
        return F.aggregate(near, none, step, lambda s: F.when(s["words"] > min_words, s["at"]))

    def reach(own: Column, near, none: int = -1) -> Column:
        """near: n -> the n nearest lines; most spans are short."""
        return F.when(own["words"] > min_words, own["at"]).otherwise(F.coalesce(reached(near(4)), reached(near(most)), F.lit(none)))

    ahead = F.transform(worded, lambda x, i: coded(x["at"], reach(x, lambda n: F.slice(worded, i + 1, F.lit(n)))))
    back = F.transform(worded, lambda x, i: coded(reach(x, lambda n: F.reverse(F.slice(worded, F.greatest(i + 2 - n, F.lit(1)), F.least(i + 1, F.lit(n))))), x["at"]))
    # An unreached end is -1: such a code is negative or ends in _HIGH - 1.
    return F.filter(F.concat(ahead, back), lambda s: (s >= 0) & (F.pmod(s, F.lit(_HIGH)) != _HIGH - 1))


def first_line(code: Column) -> Column:
    return F.shiftright(code, 32).cast("int")


def last_line(code: Column) -> Column:
    return (code % _HIGH).cast("int")


def line_dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS, min_lines: int = MIN_LINES, window: int = WINDOW, divisor: int = DIVISOR
) -> DataFrame:
    """One row per row of docs: doc (a struct of its other columns), text, n_lines, lines_removed, words_removed.

    Pieces are chunks with min_lines lines with words or more, and the shortest spans of whole lines with more than min_words words. A
    piece that stands in several rows stays in the first of them, by least id (null last), wherever it stands there, and
    its lines go from all others. So every run of whole lines with more than min_words words that an earlier row has goes,
    and of shorter ones the chunks of several lines. Empty lines go inside a piece only. Null texts stay null with no
    lines; an empty text is one empty line; a text may become empty. Repeated rows count as separate documents: the first
    in storage order stays. Very long texts are one row each, and a line may have any length. Columns of docs lie in the
    struct, so names cannot clash. No rows give no rows.
    """
    others = [F.col(c) for c in docs.columns if c not in (text_col, FILE, AT)]
    columns = {
        "doc": F.struct(*others) if others else F.struct(F.lit(1).alias("none")),
        "id": F.col(id_col) if id_col in docs.columns else F.lit(None).cast("string"),
        "text": F.col(text_col).cast("string"),
    }
    rows = addressed(docs, columns, "lines")
    lines = F.split("text", "\n", -1)
    with scratch():
        told = rows.select("id", FILE, AT, line_facts(lines).alias("facts"))
        worded = F.filter(F.transform("facts", lambda x, i: F.struct(i.alias("at"), x["words"].alias("words"))), lambda x: x["words"] > 0)
        told = told.select("id", FILE, AT, "facts", chunk_ends(F.col("facts"), window, divisor).alias("ends"), worded.alias("worded"))
        codes = F.array_distinct(F.concat(chunks(F.col("facts"), F.col("ends"), min_lines), spans(F.col("worded"), min_words)))
        told = told.select("id", FILE, AT, codes.alias("codes"), F.transform("facts", lambda x: x["x"]).alias("xs"))
        hashes = F.transform("codes", lambda c: F.struct(c.alias("code"), F.xxhash64(part("xs", first_line(c), last_line(c))).alias("h")))
        pieces = materialize(told.select("id", FILE, AT, F.explode(hashes).alias("p")).select("id", FILE, AT, "p.*"), "pieces")
        place = F.struct(FILE, AT)
        # Written before they are joined: a hash that stands in very many rows can then be split among tasks.
        shared = materialize(pieces.groupBy("h").agg(F.min(place).alias("low"), F.max(place).alias("high")).where("low != high").select("h"), "shared")
        wanted = materialize(pieces.join(shared, "h").groupBy(FILE, AT).agg(F.first("id").alias("id"), F.collect_list("code").alias("codes")), "wanted")
        # Only pieces whose hash another document has are digested.
        texts = rows.select(FILE, AT, lines.alias("lines")).join(if_small(wanted, 96, "codes", 8), [FILE, AT])
        digests = F.transform("codes", lambda c: F.struct(c.alias("code"), F.unhex(F.sha2(F.array_join(part("lines", first_line(c), last_line(c)), "\n").cast("binary"), 256)).alias("digest")))
        texts = materialize(texts.select("id", FILE, AT, F.explode(digests).alias("d")).select("id", FILE, AT, "d.*"), "digests")
        first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", FILE, AT))
        firsts = materialize(texts.groupBy("digest").agg(first.alias("first")).select("digest", F.col(f"first.{FILE}").alias("own_file"), F.col(f"first.{AT}").alias("own_at")), "firsts")
        copies = texts.join(firsts, "digest").where((F.col(FILE) != F.col("own_file")) | (F.col(AT) != F.col("own_at")))
        numbers = F.array_distinct(F.flatten(F.collect_list(F.sequence(first_line(F.col("code")), last_line(F.col("code"))))))
        gone = materialize(copies.groupBy(FILE, AT).agg(numbers.alias("gone")), "gone", stays=True)
    out = rows.withColumn("lines", lines).join(if_small(gone, 64, "gone", 8), [FILE, AT], "left")
    kept = F.transform(F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.col("gone")), lambda i: F.get("lines", i))
    text = F.when(F.col("gone").isNull(), F.col("text")).otherwise(F.array_join(kept, "\n"))
    words = F.aggregate("gone", F.lit(0).cast("long"), lambda n, i: n + F.regexp_count(F.get("lines", i), F.lit(WORD)))
    count = lambda c: F.coalesce(F.when(F.col(c).isNotNull(), F.size(c)), F.lit(0)).cast("long")
    return out.select("doc", text.alias("text"), count("lines").alias("n_lines"), count("gone").alias("lines_removed"), F.coalesce(words, F.lit(0)).cast("long").alias("words_removed"))
