"""URL filters: host-suffix and path-prefix expressions joined on short hash prefixes.

Each url is expanded into every host suffix at a label border times every path prefix whose
length some rule has.  An expression's SHA-256 is cut to four bytes for the equi-join; the full
digest then confirms a match, and of the confirmed rules the longest wins.  All of it is
DataFrame operations; only distinct (host, path) pairs are expanded, so a host with a third of
all pages costs no more than its different paths.

Nulls: a null url, or one without ``://``, has an empty host and path, matches no rule and gets
the default verdict.  Repeated rows each get a row.  A rule with a null or empty host never fits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bytes of the digest that the equi-join uses.
SHORT = 4
DEFAULT = "allow"


def lower_ascii(c: Column) -> Column:
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def host_of(url: Column) -> Column:
    return F.coalesce(lower_ascii(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def digest(host: Column, path: Column) -> Column:
    """Of host and path with a byte between them that neither can hold."""
    return F.unhex(F.sha2(F.concat(host, F.lit("\n"), path).cast("binary"), 256))


def expressions(urls: DataFrame, lengths: list[int]) -> DataFrame:
    """(host, path) -> one row per expression: its digest and the digest's short prefix."""
    labels = F.split("host", r"\.", -1)
    suffixes = F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."),
    )
    prefixes = F.array_distinct(F.array(*[F.substring("path", 1, n) for n in lengths] or [F.lit("")]))
    return (
        urls.where("host <> ''")
        .select("host", "path", F.explode(suffixes).alias("suffix"), prefixes.alias("prefixes"))
        .select("host", "path", "suffix", F.explode("prefixes").alias("prefix"))
        .select("host", "path", digest(F.col("suffix"), F.col("prefix")).alias("full"))
        .withColumn("short", F.substring("full", 1, SHORT))
    )


def judge(pages: DataFrame, rules: DataFrame, url: str = "url", default: str = DEFAULT) -> DataFrame:
    """All columns of ``pages`` in ``page``, with host, path, rule and verdict.

    ``rules`` has the columns host, path and verdict.  A rule fits its host and all subdomains
    where the path starts with the rule's path.  The longest rule (host and path together) wins,
    then the longer path, then block before allow.
    """
    rules = rules.where("host <> ''").select(
        lower_ascii(F.col("host")).alias("rule_host"), F.coalesce("path", F.lit("")).alias("rule_path"), "verdict"
    )
    # Different path lengths of the rules: a handful, whatever the number of rules.
    lengths = sorted(r[0] for r in rules.select(F.char_length("rule_path")).distinct().collect())
    keyed = rules.select(
        digest(F.col("rule_host"), F.col("rule_path")).alias("rule_full"),
        F.concat("rule_host", "rule_path").alias("rule"),
        F.char_length("rule_path").alias("n_path"),
        "verdict",
    ).withColumn("short", F.substring("rule_full", 1, SHORT))
    packed = pages.select(
        F.struct(*[F.col(f"`{c}`") for c in pages.columns]).alias("page"),
        host_of(F.col(f"`{url}`")).alias("host"),
        path_of(F.col(f"`{url}`")).alias("path"),
    )
    best = (
        expressions(packed.select("host", "path").distinct(), lengths)
        .join(keyed, "short")
        .where("full = rule_full")
        .groupBy("host", "path")
        .agg(F.max(F.struct(F.char_length("rule"), "n_path", F.col("verdict") == "block", "rule", "verdict")).alias("best"))
        .select("host", "path", "best.rule", "best.verdict")
    )
    return packed.join(best, ["host", "path"], "left").select(
        "page", "host", "path", "rule", F.coalesce("verdict", F.lit(default)).alias("verdict")
    )
