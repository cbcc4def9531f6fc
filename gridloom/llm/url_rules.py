"""URL filters: host-suffix and path-prefix expressions joined to rules on short hash prefixes.

A URL's host gives one expression for each of its suffixes with as many labels as some rule's
host has, and its path one for each prefix whose length some rule has. Rules are buckets of
those whose digests share their first 32 bits; expressions meet them in an equi-join on these
alone, the full SHA-256 digest then confirms a rule of the bucket, and the longest rule wins
(of equals the one with the longer host, then the smaller text).

DataFrame functions only. The rules are a DataFrame; Catalyst broadcasts them only
below its size threshold and else shuffles both sides on the short prefix, where a hot
host is met by AQE's skew join. Only the distinct label counts and path lengths of rules,
bounded by the longest of them, pass the driver; a URL has at most one expression for each
pair of these, however long it is. URLs are numbered in a written table, which is read for
the expressions and for the result alike.

Defined results: null URLs, and those without ``://``, have empty host and path and
match no rule; repeated rows each give a row; no rules leave the default verdict;
other columns are ignored whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.llm.common import cut

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def some(options: list[Column]) -> Column:
    """An array of the options that aren't null."""
    return F.filter(F.array(*options or [F.lit(None).cast("string")]), lambda x: x.isNotNull())


def host_suffixes(host: Column, counts: list[int]) -> Column:
    """The suffixes with as many labels as are asked for."""
    labels = F.split(host, r"\.")
    return some([F.when(F.size(labels) >= n, F.array_join(F.slice(labels, F.size(labels) - n + 1, n), ".")) for n in counts])


def path_prefixes(path: Column, lengths: list[int]) -> Column:
    return some([F.when(F.length(path) >= n, F.substring(path, 1, n)) for n in lengths])


def digest(host: Column, path: Column) -> Column:
    """SHA-256 over the host, a line feed, which no host holds, and the path."""
    return F.sha2(F.concat(host, F.lit("\n"), path), 256)


def short(full: Column) -> Column:
    return F.conv(F.substring(full, 1, 8), 16, 10).cast("long")


def judge_urls(pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url", default: str = "allow") -> DataFrame:
    """Per row: id, ``host``, ``path``, ``rule`` (host and path of the winner, or null) and ``verdict``.

    ``rules`` has ``host``, ``path`` and ``verdict``.
    """
    given = rules.dropna(subset=["host", "path"]).select("host", "path", "verdict").distinct()
    distinct = lambda x: sorted(r[0] for r in given.select(x).distinct().collect())
    counts, lengths = distinct(F.size(F.split("host", r"\."))), distinct(F.length("path"))
    full = digest(F.col("host"), F.col("path"))
    rule = F.struct(full.alias("digest"), F.concat("host", "path").alias("rule"), F.length("host").alias("host_length"), "verdict")
    buckets = given.groupBy(short(full).alias("bucket")).agg(F.collect_list(rule).alias("rules"))
    # Written, so that a row keeps its number in both places where it is read.
    parsed = cut(
        pages.select(F.col(id_col).alias("id"), host_of(F.col(url_col)).alias("host"), path_of(F.col(url_col)).alias("path"))
        .withColumn("row", F.monotonically_increasing_id())
    )
    expressions = F.flatten(
        F.transform(host_suffixes(F.col("host"), counts), lambda h: F.transform(path_prefixes(F.col("path"), lengths), lambda p: digest(h, p)))
    )
    met = (
        parsed.filter(F.col("host") != "")
        .select("row", F.explode(expressions).alias("digest"))
        .withColumn("prefix", short(F.col("digest")))
        .join(buckets, F.col("prefix") == F.col("bucket"))
        .select("row", F.explode(F.filter("rules", lambda r: r["digest"] == F.col("digest"))).alias("r"))
        .groupBy("row")
        .agg(
            F.min_by(
                F.struct("r.rule", "r.verdict"),
                F.struct(-F.length("r.rule"), -F.col("r.host_length"), F.col("r.rule"), F.col("r.verdict")),
            ).alias("won")
        )
    )
    return parsed.join(met, "row", "left").select(
        F.col("id").alias(id_col),
        "host",
        "path",
        F.col("won.rule").alias("rule"),
        F.coalesce("won.verdict", F.lit(default)).alias("verdict"),
    )
