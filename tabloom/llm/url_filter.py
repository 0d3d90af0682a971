"""URL rules by host-suffix and path-prefix expressions.

A rule is (host, path, action); it fits its host and every subdomain where the url's path starts with
the rule's. Each distinct url is expanded into pairs of a host suffix and a path prefix that ends in a slash.
The pairs meet the rules in an equi-join on the first four bytes of a SHA-256 digest, the whole digest
is compared next, then the rest of the rule's path, and the longest rule wins. A suffix with more labels or a prefix with more
slashes than any rule has can't fit, so expansion stops there without losing a match.

Defined cases: a null url or one without ``://`` has an empty host and path, so no rule fits and the default verdict
holds; rules with a null host, or the empty one, fit nothing; a null rule path is empty; repeated rules count
once (block wins where both actions are given); empty tables give empty results; urls are judged once however often
they occur; columns of the input are kept apart from the working columns by taking them back by the url alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The rules of the registered query as (host, path, action).
RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]

DIGEST_HEAD = 8  # hex digits, four bytes

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def rules_table(spark: SparkSession, rules=RULES) -> DataFrame:
    return spark.createDataFrame(rules, "host string, path string, action string")


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end; A-Z lower-cased."""
    return F.translate(F.regexp_extract(_after_scheme(url), "^[^/?#]*", 0), UPPER, LOWER)


def url_path(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end."""
    return F.regexp_extract(_after_scheme(url), "^[^/?#]*([^?#]*)", 1)


def _after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))


def _prepared(rules: DataFrame) -> DataFrame:
    path = F.coalesce("path", F.lit(""))
    plain = (
        rules.where("host is not null and host != ''")
        .select(F.translate("host", UPPER, LOWER).alias("r_host"), path.alias("r_path"), "action")
        .groupBy("r_host", "r_path")
        .agg(F.max(F.when(F.col("action") == "block", "block").otherwise("allow")).alias("action"))
    )
    folder = F.regexp_extract("r_path", "^(.*/)?", 0)
    return plain.withColumn("full", F.sha2(F.concat("r_host", F.lit("\n"), folder), 256)).withColumn(
        "short", F.substring("full", 1, DIGEST_HEAD)
    )


def filter_urls(pages: DataFrame, rules: DataFrame, url_col: str = "url", default: str = "allow") -> DataFrame:
    """All rows and columns of ``pages`` plus a struct ``judged`` (host, path, rule, verdict)."""
    prepared = _prepared(rules)
    # two numbers: how deep expressions need to go
    deepest = prepared.select(
        F.max(F.size(F.split("r_host", "\\."))).alias("labels"), F.max(F.size(F.split("r_path", "/"))).alias("parts")
    ).first()
    labels, parts = deepest.labels or 0, deepest.parts or 0
    urls = pages.select(F.col(url_col).alias("u")).where("u is not null").distinct()
    split = urls.select("u", url_host(F.col("u")).alias("host"), url_path(F.col("u")).alias("path"))
    names, pieces = F.split("host", "\\."), F.split("path", "/")
    suffixes = F.when(
        F.col("host") != "",
        F.transform(
            F.sequence(F.lit(1), F.least(F.size(names), F.lit(labels))),
            lambda n: F.array_join(F.slice(names, F.size(names) - n + 1, n), "."),
        ),
    ).otherwise(F.array().cast("array<string>"))
    # "" stands for rules without a slash in their path; a url's last piece has no slash after it
    depth = F.least(F.size(pieces) - 1, F.lit(parts))
    prefixes = F.concat(
        F.array(F.lit("")),
        F.when(
            depth > 0,
            F.transform(F.sequence(F.lit(1), depth), lambda n: F.concat(F.array_join(F.slice(pieces, F.lit(1), n), "/"), F.lit("/"))),
        ).otherwise(F.array().cast("array<string>")),
    )
    asked = (
        split.where(F.lit(labels > 0))
        .select("u", "path", F.explode(suffixes).alias("suffix"), prefixes.alias("prefixes"))
        .select("u", "path", "suffix", F.explode("prefixes").alias("prefix"))
        .select("u", "path", F.sha2(F.concat("suffix", F.lit("\n"), "prefix"), 256).alias("asked"))
        .withColumn("short", F.substring("asked", 1, DIGEST_HEAD))
    )
    hits = asked.join(prepared, "short").where((F.col("asked") == F.col("full")) & F.expr("startswith(path, r_path)"))
    rank = F.struct(F.length(F.concat("r_host", "r_path")).alias("n"), F.length("r_host").alias("h"), "r_host", "r_path", "action")
    best = hits.groupBy("u").agg(F.max(rank).alias("best"))
    mine = pages.select(F.struct(*[F.col(f"`{c}`") for c in pages.columns]).alias("row"), F.col(url_col).alias("u"))
    url = F.coalesce(F.col("u"), F.lit(""))
    judged = F.struct(
        url_host(url).alias("host"),
        url_path(url).alias("path"),
        F.concat("best.r_host", "best.r_path").alias("rule"),
        F.coalesce("best.action", F.lit(default)).alias("verdict"),
    )
    return mine.join(best, "u", "left").select("row", judged.alias("judged"))
