"""URL filters by hashed expressions.

A URL is expanded into its host suffixes and path prefixes, but only in the shapes (labels of the host, length of the path)
that some rule has. Expressions meet the rules in an equi-join on the first four bytes of their SHA-256; full digests
confirm, of the same labels and path length, so that host and path cannot run into each other; the longest rule wins.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tributary.llm.common import UPPER, if_small, materialize, scratch


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty for null or without `://`."""
    url = F.coalesce(url.cast("string"), F.lit(""))
    host = F.translate(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), UPPER, UPPER.lower())
    return host, F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def short(digest: str) -> Column:
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")


def filter_urls(pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url", default: str = "allow") -> DataFrame:
    """One row per row of pages: id_col, host, path, rule, verdict.

    rules(verdict, host, path): a rule fits its host and all its subdomains if the URL's path starts with the rule's; the
    longest host and path together wins, of equally long ones the longer host, then block. rule is host and path of the
    winner, else null with the default verdict; ties beyond that go by verdict and rule. Null urls and ones without `://` have empty host and path. Rules with
    nulls are left out; repeated rules count once; without rules all get the default. Null ids and repeated rows are
    kept; urls of any length are read whole. Other columns are not read; no pages give no rows.
    """
    host, path = host_and_path(F.col(url_col))
    urls = pages.select(F.col(id_col).alias("id"), host.alias("host"), path.alias("path"))
    rules = rules.where("verdict is not null and host is not null and path is not null").select("verdict", F.translate("host", UPPER, UPPER.lower()).alias("rule_host"), F.col("path").alias("rule_path")).distinct()
    rules = rules.withColumn("n", F.size(F.split("rule_host", r"\."))).withColumn("k", F.length("rule_path"))
    keyed = rules.withColumn("digest", F.sha2(F.concat("rule_host", "rule_path").cast("binary"), 256)).withColumn("short", short("digest"))
    shapes = [tuple(r) for r in rules.select("n", "k").distinct().collect()]  # of rules, not of pages
    if not shapes:
        return urls.select(F.col("id").alias(id_col), "host", "path", F.lit(None).cast("string").alias("rule"), F.lit(default).alias("verdict"))
    # Before the hash prefixes are joined, equal URLs count once. The shapes are one array, however many rules there are.
    labels = F.size(F.split("host", r"\."))
    fits = F.filter(F.array(*(F.struct(F.lit(n).alias("n"), F.lit(k).alias("k")) for n, k in shapes)), lambda s: (s["n"] <= labels) & (s["k"] <= F.length("path")))
    parts = F.slice(F.split("host", r"\."), labels - F.col("s.n") + 1, F.col("s.n"))
    with scratch():
        expanded = urls.select("host", "path").distinct().select("host", "path", F.explode(fits).alias("s"))
        expanded = expanded.select("host", "path", "s.n", "s.k", F.sha2(F.concat(F.array_join(parts, "."), F.substr("path", F.lit(1), F.col("s.k"))).cast("binary"), 256).alias("url_digest")).withColumn("short", short("url_digest"))
        hits = expanded.join(if_small(keyed, 512), ["short", "n", "k"]).where(F.col("url_digest") == F.col("digest"))
        rank = F.struct(F.length("rule_host") + F.length("rule_path"), F.length("rule_host"), F.col("verdict") == "block", "verdict", "rule_host", "rule_path")
        best = hits.groupBy("host", "path").agg(F.max_by(F.struct(F.concat("rule_host", "rule_path").alias("rule"), "verdict"), rank).alias("best"))
        # Only URLs that some rule fits. Written before the join: a URL on very many pages can then be split among tasks.
        best = if_small(materialize(best, "verdicts", stays=True), 512)
    out = urls.join(best, ["host", "path"], "left")
    return out.select(F.col("id").alias(id_col), "host", "path", F.col("best.rule").alias("rule"), F.coalesce("best.verdict", F.lit(default)).alias("verdict"))


def rules_frame(spark, rules: list[tuple[str, str, str]]) -> DataFrame:
    """rules: (verdict, host, path)."""
    rows = [spark.range(1).select(F.lit(v).alias("verdict"), F.lit(h).alias("host"), F.lit(p).alias("path")) for v, h, p in rules]
    return reduce(DataFrame.unionByName, rows)
