"""The registered queries of the corpus operators, and their DuckDB SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from pyspark.sql import functions as F

from tributary.llm.chat_format import chat_examples, read_back
from tributary.llm.common import crc_mod, file_rows, lower_az, table
from tributary.llm.decontaminate import decontaminate
from tributary.llm.exact_dedup import exact_dedup
from tributary.llm.filter_audit import filter_audit
from tributary.llm.lang_id import identify, train_model
from tributary.llm.license_scan import license_scan
from tributary.llm.line_dedup import line_dedup
from tributary.llm.lm_score import lm_score
from tributary.llm.merkle import merkle_manifest
from tributary.llm.mix_sources import mix_sources
from tributary.llm.near_dedup import near_dedup
from tributary.llm.token_counts import token_counts
from tributary.llm.url_filter import filter_urls, rules_frame

ALNUM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


#: The rules of the query: verdict, host, path.
URL_RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/")]


def op1_lang_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = crc_mod("doc_id", 3) == 1
    model = train_model(docs.where(~held_out), F.col("doc_id"), "lang", "text")
    return identify(docs.select("doc_id", "text"), model).select(F.col("doc.doc_id").alias("doc_id"), (crc_mod("doc.doc_id", 3) == 1).alias("held_out"), "lang_pred", "score", "second", "ambiguous")


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_urls(table(spark, sf_dir, "pages"), rules_frame(spark, URL_RULES))


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    items = F.array_sort("item_ids")
    return decontaminate(docs, table(spark, sf_dir, "benchmark"), clean=False).select(
        F.col("doc.doc_id").alias("doc_id"), "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"), F.sha2(F.array_join(items, ","), 256).alias("items_sha256"), "contaminated", "n_removed"
    )


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = license_scan(table(spark, sf_dir, "documents"))
    sure = F.filter("notices", lambda x: x["confirmed"])
    return found.select(
        "doc_id", "n_paragraphs", F.size("notices").cast("long").alias("n_predicted"), F.size(sure).cast("long").alias("n_confirmed"),
        F.array_join(F.array_sort(F.array_distinct(F.transform(sure, lambda x: x["family"]))), ",").alias("families"), F.array_max(F.transform(sure, lambda x: x["probability"])).alias("probability"),
    )


def op5_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_score(table(spark, sf_dir, "documents"))


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"))


def op7_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup(file_rows(table(spark, sf_dir, "documents")), size=2)


def op8_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(file_rows(table(spark, sf_dir, "documents"))).drop("source")


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = line_dedup(file_rows(table(spark, sf_dir, "documents").select("doc_id", "text")))
    return done.select(F.col("doc.doc_id").alias("doc_id"), "n_lines", "lines_removed", "words_removed", F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("text_sha256"))


def op10_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    both = "</s>[INST] ok [/INST]"  # another template's control strings
    extra = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(both).alias("text"))
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    whole = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read_back(chat_examples(rows)).select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(whole.cast("binary"), 256).alias("turns_sha256"), F.length("loss_text").cast("long").alias("loss_chars"), F.sha2(F.col("loss_text").cast("binary"), 256).alias("loss_sha256"), "formatted_chars"
    )


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    return merkle_manifest(table(spark, sf_dir, "documents"), ["doc_id", "source", "lang", "n_chars", "text"], changed={"text": lower_az(F.col("text"))}, when=tampered)


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op13_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_lang_id": op1_lang_id,
    "op2_url_filter": op2_url_filter,
    "op3_decontaminate": op3_decontaminate,
    "op4_license_scan": op4_license_scan,
    "op5_lm_score": op5_lm_score,
    "op6_exact_dedup": op6_exact_dedup,
    "op7_near_dedup": op7_near_dedup,
    "op8_mix_sources": op8_mix_sources,
    "op9_line_dedup": op9_line_dedup,
    "op10_chat_format": op10_chat_format,
    "op11_merkle_manifest": op11_merkle_manifest,
    "op12_filter_audit": op12_filter_audit,
    "op13_token_counts": op13_token_counts,
}

WORDS = r"[^\x20\x09-\x0D]+"
ESCAPED = "replace(replace({0}, chr(92), chr(92) || chr(92)), '<|', '<' || chr(92) || '|')"
RULES_SQL = ", ".join(str(r) for r in URL_RULES)



def merkle_levels(name: str, levels: int) -> str:
    """CTEs that lead {name}0 (group g, place i, digest d, nodes n of the group) and {name}p0 (rows on their way: g, i, n, node,
    proof, id) up by so many levels."""
    inside = "array_to_string(ds[1:i % 16], '') || {0} || array_to_string(ds[i % 16 + 2:16], '')"
    steps = [
        f"""{name}r{k} AS (SELECT g, i // 16 AS b, n, list(d ORDER BY i) AS ds FROM {name}{k} GROUP BY g, i // 16, n),
        {name}{k + 1} AS (SELECT g, b AS i, CASE WHEN n > 1 THEN sha256(array_to_string(ds, '')) ELSE ds[1] END AS d, (n + 15) // 16 AS n FROM {name}r{k}),
        {name}p{k + 1} AS (SELECT id, p.g, i // 16 AS i, (p.n + 15) // 16 AS n, CASE WHEN p.n > 1 THEN sha256({inside.format("node")}) ELSE node END AS node,
                           CASE WHEN p.n > 1 THEN proof || {inside.format("''")} ELSE proof END AS proof FROM {name}p{k} AS p JOIN {name}r{k} AS r ON p.g = r.g AND i // 16 = b)"""
        for k in range(levels)
    ]
    return ",\n        ".join(steps)


MERKLE_FIELD = "coalesce(CAST(strlen(CAST({0} AS VARCHAR)) AS VARCHAR) || ':' || CAST({0} AS VARCHAR), '-')"
MERKLE_LEAF = " || ".join(MERKLE_FIELD.format(c) for c in ("doc_id", "source", "lang", "n_chars"))

ORACLE_SQL: dict[str, str] = {
    "op2_url_filter": f"""
        WITH u AS (SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) END AS rest FROM pages),
        hp AS (SELECT page_id, translate(regexp_extract(coalesce(rest, ''), '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                      regexp_extract(coalesce(rest, ''), '^[^/?#]*([^?#]*)', 1) AS path FROM u),
        r AS (SELECT * FROM (VALUES {RULES_SQL}) AS t(verdict, rh, rp)),
        k AS (SELECT DISTINCT host, path FROM hp),
        best AS (SELECT host, path, max_by(rh || rp, length(rh || rp)) AS rule, max_by(verdict, length(rh || rp)) AS verdict
                 FROM k JOIN r ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp) GROUP BY host, path)
        SELECT page_id, hp.host, hp.path, rule, coalesce(verdict, 'allow') AS verdict FROM hp LEFT JOIN best ON hp.host = best.host AND hp.path = best.path""",
    "op8_mix_sources": f"""
        WITH d AS (SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '{WORDS}')) AS BIGINT) AS size, md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS key FROM documents),
        s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
        r AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) AS place FROM s),
        c AS (SELECT *, 3 * source_size AS cap, [5, 2, 1][(place - 1) % 3 + 1] AS w FROM r),
        f AS (SELECT *, sum(source_size) OVER () - sum(cap) OVER o + cap AS left_words, sum(w) OVER () - sum(w) OVER o + w AS left_weight
              FROM c WINDOW o AS (ORDER BY cap / w, place ROWS UNBOUNDED PRECEDING)),
        g AS (SELECT *, CAST(left_words AS DOUBLE) * w >= CAST(cap AS DOUBLE) * left_weight AS capped FROM f),
        t AS (SELECT source, source_size, CASE WHEN capped THEN CAST(cap AS DOUBLE) ELSE
                CAST(w AS DOUBLE) * CAST(sum(source_size) OVER () - coalesce(sum(cap) FILTER (capped) OVER (), 0) AS DOUBLE)
                / CAST(sum(w) OVER () - coalesce(sum(w) FILTER (capped) OVER (), 0) AS DOUBLE) END AS target FROM g),
        b AS (SELECT *, CAST(floor(target + 0.5) AS BIGINT) AS budget FROM t),
        e AS (SELECT *, CASE WHEN source_size > 0 THEN budget // source_size ELSE 0 END AS epochs FROM b),
        x AS (SELECT doc_id, size, source_size, target, epochs, budget - epochs * source_size AS rest,
                     sum(size) OVER (PARTITION BY d.source ORDER BY key, size ROWS UNBOUNDED PRECEDING) - size AS before
              FROM d JOIN e ON d.source IS NOT DISTINCT FROM e.source)
        SELECT doc_id, size, source_size, target, CAST(epochs * size + greatest(0, least(size, rest - before)) AS BIGINT) AS taken FROM x""",
    "op9_line_dedup": f"""
        WITH l AS (SELECT doc_id, i, ls[i] AS line FROM (SELECT doc_id, ls, unnest(range(1, len(ls) + 1)) AS i FROM (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents WHERE text IS NOT NULL))),
        f AS (SELECT *, len(regexp_extract_all(line, '{WORDS}')) AS words, CAST('0x' || substr(md5(line), 1, 8) AS BIGINT) AS h FROM l),
        e AS (SELECT *, sum(words) OVER (PARTITION BY doc_id ORDER BY i) AS through,
                     (h + 31 * coalesce(lag(h) OVER o, 0) + 961 * coalesce(lag(h, 2) OVER o, 0) + 29791 * coalesce(lag(h, 3) OVER o, 0)) % 4 = 0 AS ends FROM f WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
        k AS (SELECT *, coalesce(sum(CAST(ends AS INT)) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS k FROM e),
        w AS (SELECT doc_id, i, through, through - words AS before FROM e WHERE words > 0),
        pieces AS (SELECT doc_id, min(i) AS a, max(i) AS b FROM k GROUP BY doc_id, k HAVING count(*) FILTER (words > 0) > 1
                   UNION SELECT w.doc_id, w.i, z.i FROM w ASOF JOIN w AS z ON w.doc_id = z.doc_id AND w.before + 50 < z.through
                   UNION SELECT z.doc_id, w.i, z.i FROM w AS z ASOF JOIN w ON w.doc_id = z.doc_id AND z.through - 50 > w.before),
        t AS (SELECT p.*, array_to_string(ls[a:b], chr(10)) AS piece FROM pieces AS p JOIN (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents WHERE text IS NOT NULL) USING (doc_id)),
        c AS (SELECT *, min(doc_id) OVER (PARTITION BY piece) AS first FROM t),
        gone AS (SELECT DISTINCT doc_id, unnest(range(a, b + 1)) AS i FROM c WHERE doc_id <> first),
        n AS (SELECT doc_id, count(*) AS n_lines, count(gone.i) AS lines_removed, CAST(coalesce(sum(words) FILTER (gone.i IS NOT NULL), 0) AS BIGINT) AS words_removed,
                     coalesce(string_agg(line, chr(10) ORDER BY f.i) FILTER (gone.i IS NULL), '') AS text FROM f LEFT JOIN gone USING (doc_id, i) GROUP BY doc_id)
        SELECT documents.doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(lines_removed, 0) AS lines_removed, coalesce(words_removed, 0) AS words_removed, sha256(coalesce(n.text, '')) AS text_sha256
        FROM documents LEFT JOIN n USING (doc_id)""",
    "op10_chat_format": f"""
        WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
                   UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')),
        f AS (SELECT *, length({ESCAPED.format("role")}) + length({ESCAPED.format("text")}) + 23 AS size FROM c),
        n AS (SELECT *, sum(size) OVER o AS through, row_number() OVER o AS i, count(*) OVER (PARTITION BY conv_id) AS n
              FROM f WINDOW o AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text ROWS UNBOUNDED PRECEDING))
        SELECT conv_id, max(n) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY i)) AS turns_sha256,
               CAST(length(coalesce(string_agg(text, '' ORDER BY i) FILTER (role = 'assistant'), '')) AS BIGINT) AS loss_chars,
               sha256(coalesce(string_agg(text, '' ORDER BY i) FILTER (role = 'assistant'), '')) AS loss_sha256,
               CAST(sum(through) FILTER (role = 'assistant' OR i = n) AS BIGINT) AS formatted_chars
        FROM n GROUP BY conv_id""",
    "op3_decontaminate": f"""
        WITH items AS (SELECT item_id, w, least(len(w), 13) AS k FROM (SELECT item_id, regexp_extract_all({LOWERED}, '{ALNUM}') AS w FROM benchmark) WHERE len(w) > 0),
        wins AS (SELECT DISTINCT item_id, k, array_to_string(w[i:i + k - 1], ' ') AS g FROM (SELECT *, unnest(range(1, len(w) - k + 2)) AS i FROM items)),
        d AS (SELECT doc_id, regexp_extract_all({LOWERED}, '{ALNUM}') AS w FROM documents),
        dw AS (SELECT doc_id, k, i, array_to_string(w[i:i + k - 1], ' ') AS g
               FROM (SELECT d.*, k, unnest(range(1, len(w) - k + 2)) AS i FROM d, (SELECT DISTINCT k FROM wins) AS ks)),
        occ AS (SELECT doc_id, dw.k, i, item_id FROM dw JOIN wins ON dw.k = wins.k AND dw.g = wins.g),
        pos AS (SELECT DISTINCT doc_id, unnest(range(i, i + k)) AS p FROM occ),
        span AS (SELECT doc_id, count(*) AS n FROM (SELECT doc_id, p - row_number() OVER (PARTITION BY doc_id ORDER BY p) AS run FROM pos) GROUP BY doc_id, run),
        hit AS (SELECT doc_id, CAST(sum(n) AS BIGINT) AS n_hit, CAST(coalesce(sum(n) FILTER (n > 50), 0) AS BIGINT) AS long_words FROM span GROUP BY doc_id),
        its AS (SELECT doc_id, count(*) AS n_items, string_agg(x, ',' ORDER BY x) AS ids FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS x FROM occ WHERE item_id IS NOT NULL) GROUP BY doc_id)
        SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
               coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(d.w) AS contaminated, CASE WHEN 20 * coalesce(n_hit, 0) >= len(d.w) THEN coalesce(n_hit, 0) ELSE coalesce(long_words, 0) END AS n_removed
        FROM d LEFT JOIN hit ON hit.doc_id = d.doc_id LEFT JOIN its ON its.doc_id = d.doc_id""",
    "op6_exact_dedup": f"""
        WITH d AS (SELECT doc_id, sha256({LOWERED}) AS text_sha256 FROM documents)
        SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size, doc_id = max(doc_id) OVER g AS kept, text_sha256
        FROM d WINDOW g AS (PARTITION BY text_sha256)""",
    "op12_filter_audit": f"""
        WITH d AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '{WORDS}') AS w FROM documents),
        l AS (SELECT doc_id, bool_or(coalesce(quality = 1, false)) AS good, bool_or(coalesce(toxic = 1, false)) AS toxic FROM labels GROUP BY doc_id),
        f AS (SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
                     CASE WHEN len(w) < 100 THEN 'A' ELSE '' END || CASE WHEN 100 * len(list_distinct(w)) < 80 * len(w) THEN 'B' ELSE '' END
                     || CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 10 * length(t) THEN 'C' ELSE '' END || CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END
                     || CASE WHEN d.doc_id > min(d.doc_id) OVER (PARTITION BY t) THEN 'E' ELSE '' END AS fails FROM d LEFT JOIN l ON d.doc_id = l.doc_id),
        m AS (SELECT part, fails, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic FROM f GROUP BY part, fails),
        x AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
        o AS (SELECT a.x || b.x || c.x || d.x || e.x AS o FROM x AS a, x AS b, x AS c, x AS d, x AS e WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
        r AS (SELECT m.*, o, coalesce((SELECT min(instr(o, x)) FROM x WHERE contains(fails, x)), 9) AS gone FROM m, o),
        s AS (SELECT part, o AS filter_order, CAST(step AS INT) AS step, substr(o, step, 1) AS letter, coalesce(sum(n) FILTER (gone > step), 0) AS kept, coalesce(sum(n) FILTER (gone = step), 0) AS removed,
                     coalesce(sum(n) FILTER (gone < step AND contains(fails, substr(o, step, 1))), 0) AS redundant, coalesce(sum(n) FILTER (fails = substr(o, step, 1)), 0) AS unique_fails,
                     coalesce(sum(good) FILTER (gone = step), 0) AS good_lost, coalesce(sum(toxic) FILTER (gone = step), 0) AS toxic_lost
              FROM r, (SELECT unnest(range(1, 6)) AS step) GROUP BY part, o, step)
        SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
               CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, letter) AS BIGINT) AS shapley FROM s""",
    # Up to 16^5 rows of a source and 16^3 sources.
    "op11_merkle_manifest": f"""
        WITH d AS (SELECT row_number() OVER () AS id, doc_id, coalesce('=' || source, '-') AS g, sha256({MERKLE_LEAF} || {MERKLE_FIELD.format("text")}) AS d, sha256({MERKLE_LEAF} || {MERKLE_FIELD.format(LOWERED.replace("coalesce(text, '')", "text"))}) AS lowered,
                          xor(4294967295, list_reduce(flatten(list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: [CAST(ascii(x) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1])),
                              lambda c, b: CASE WHEN b < 0 THEN xor(c >> 1, 3988292384 * (c & 1)) ELSE xor(c, b) END, 4294967295)) AS crc FROM documents),
        t0 AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, d) - 1 AS i, count(*) OVER (PARTITION BY g) AS n FROM d),
        tp0 AS (SELECT id, g, i, n, CASE WHEN crc % 5 = 0 THEN lowered ELSE d END AS node, '' AS proof FROM t0),
        {merkle_levels("t", 5)},
        s0 AS (SELECT '' AS g, row_number() OVER (ORDER BY g) - 1 AS i, d, count(*) OVER () AS n, g AS name FROM t5),
        sp0 AS (SELECT id, s0.g, s0.i, s0.n, node, proof FROM tp5 JOIN s0 ON tp5.g = name),
        {merkle_levels("s", 3)}
        SELECT d.doc_id, d.d AS leaf, t5.d AS subroot, s3.d AS root, sha256(proof) AS proof_sha256, node AS folded_root, node = s3.d AS verified
        FROM sp3 JOIN d ON sp3.id = d.id JOIN t5 ON t5.g = d.g JOIN s3 ON s3.g = sp3.g""",
}
