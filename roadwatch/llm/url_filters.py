"""URL filters by host-suffix and path-prefix expressions.

A url is expanded into every (host suffix, path prefix) that a rule could have
named. Expressions and rules meet in an equi-join on four bytes of their
digest; the full digests are compared after it, and of the rules that remain
the longest decides. Urls are folded to distinct ones before they are expanded.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..sources.stored import stored
from .common import free_name, named, small_table

def _small(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def host_of(url: Column) -> Column:
    rest = F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1)
    return F.coalesce(_small(F.regexp_extract(rest, r"(?s)^[^/?#]*", 0)), F.lit(""))


def path_of(url: Column) -> Column:
    rest = F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1)
    return F.coalesce(F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1), F.lit(""))


def _digest(host: Column, path: Column) -> Column:
    return F.sha2(F.concat_ws("\n", host, path), 256)


def _short(digest: Column) -> Column:
    return F.substring(digest, 1, 8)


def _suffixes(host: Column, labels: list[int]) -> Column:
    """The host's last labels, for each number of labels that rules have."""
    has = F.regexp_count(host, F.lit(r"\.")) + 1
    return F.filter(F.array(*[F.when(has >= n, F.substring_index(host, ".", -n)) for n in labels]),
                    lambda suffix: suffix.isNotNull())


def rules_table(spark, rules: list[tuple[str, str, str]]) -> DataFrame:
    """(verdict, host, path) rows as a table."""
    return small_table(spark, rules, "verdict string, host string, path string")


def judge(pages: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow") -> DataFrame:
    """Add host, path, rule and verdict to every row of ``pages``.

    A rule fits its host and all subdomains, if the path starts with the rule's.
    The longest rule (host and path together, then host) wins, of equal ones
    ``block``; without any the verdict is ``default`` and the rule null. A null
    url, or one without ``://``, has an empty host and path, which no rule fits;
    rules without a host are ignored. Repeated rows are judged each. Existing columns of
    the result's names are replaced.
    """
    chosen = (rules.select(
        F.lower("verdict").alias("verdict"), _small(F.col("host")).alias("host"),
        F.coalesce("path", F.lit("")).alias("path"))
        .where("host <> ''")
        .groupBy("host", "path").agg(F.max("verdict").alias("verdict")))
    # Lengths of paths and numbers of labels: distinct small numbers, bounded by the longest rule.
    lengths = sorted(r[0] for r in chosen.select(F.length("path")).distinct().collect())
    labels = sorted(r[0] for r in chosen.select(F.regexp_count("host", F.lit(r"\.")) + 1).distinct().collect())
    keyed = chosen.select(
        "host", "path", "verdict", _digest(F.col("host"), F.col("path")).alias("rule_digest"))
    # Stored, so that their size decides whether they are sent to every executor.
    keyed = stored(keyed.withColumn("short", _short(F.col("rule_digest"))), "url-rules")

    link = free_name(pages, "__url")
    urls = pages.select(named(url).alias("u")).where("u IS NOT NULL").distinct()
    parts = urls.select("u", host_of(F.col("u")).alias("h"), path_of(F.col("u")).alias("p"))
    fitting = F.filter(F.array(*[F.lit(n) for n in lengths]).cast("array<int>"),
                       lambda n: n <= F.length("p"))
    expanded = (parts.select("u", "p", F.explode(_suffixes(F.col("h"), labels)).alias("suffix"))
                .select("u", "suffix", F.explode(F.transform(
                    fitting, lambda n: F.substring(F.col("p"), F.lit(1), n))).alias("prefix"))
                .select("u", _digest(F.col("suffix"), F.col("prefix")).alias("digest"))
                .withColumn("short", _short(F.col("digest"))))
    hits = (expanded.join(keyed, "short").where("digest = rule_digest")
            .groupBy("u").agg(F.max(F.struct(
                F.length(F.concat("host", "path")).alias("long"), F.length("host").alias("host_long"),
                "verdict", F.concat("host", "path").alias("rule"))).alias("best"))
            .select(F.col("u").alias(link), F.col("best.rule").alias("rule"),
                    F.col("best.verdict").alias("verdict")))
    # Distinct urls that a rule fits: their size on disk decides how they meet the rows.
    hits = stored(hits, "url-hits")
    own = ["host", "path", "rule", "verdict"]
    kept = [named(c) for c in pages.columns if c.lower() not in own]

    def result(rows: DataFrame, rule: Column, verdict: Column) -> DataFrame:
        return rows.select(*kept, host_of(named(url)).alias("host"), path_of(named(url)).alias("path"),
                           rule.alias("rule"), F.coalesce(verdict, F.lit(default)).alias("verdict"))
    found = hits.select(F.struct(F.col(link).alias("u"), "rule", "verdict").alias(link))
    judged = pages.where(named(url).isNotNull()).join(found, named(url) == F.col(link)["u"], "left")
    # Rows without a url meet no rule and take no part in the join.
    none = F.lit(None).cast("string")
    return result(judged, F.col(link)["rule"], F.col(link)["verdict"]).unionByName(
        result(pages.where(named(url).isNull()), none, none))
