"""Allow and block rules for URLs, found by hashes of host suffixes and path prefixes.

A rule is a host and a path (``example.com``, ``/en/``). It fits its host and all
subdomains, if the URL's path starts with the rule's. Every distinct host and path
is expanded into the expressions a fitting rule could have: each suffix of the
host at a label, with each prefix of the path of a length that occurs among the
rules. Expressions meet rules in an equi-join on the first four bytes of their
SHA-256; the full digests then confirm, and the longest rule wins (of equally
long ones the longer host; of the same rule given twice, block).

The host lies between the first ``://`` and the next ``/``, ``?``, ``#`` or the end, with
A-Z lower-cased; the path goes on to the next ``?``, ``#`` or the end. A null URL or one
without ``://`` has empty host and path. Rules with a null part fit nothing. URLs that
no rule fits get the default verdict, by default allow. Repeated and null
page_ids keep their rows; an empty table of pages or of rules is fine.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from cabrank.llm.common import saved

PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Rules are broadcast up to this number, which is counted before; above, the join shuffles.
BROADCAST_RULES = 100_000
HASH_PREFIX = 8


def host_and_path(url: Column) -> list[Column]:
    url = F.coalesce(url, F.lit(""))
    host = F.translate(F.regexp_extract(url, PARTS, 1), UPPER, LOWER)
    return [host.alias("host"), F.regexp_extract(url, PARTS, 2).alias("path")]


def _hashed(df: DataFrame) -> DataFrame:
    """Adds the digest of host and path, which a NUL byte keeps apart, and its prefix."""
    digest = F.sha2(F.concat("suffix", F.lit("\0"), "prefix"), 256)
    return df.withColumn("digest", digest).withColumn("short", F.substring("digest", 1, HASH_PREFIX))


def expressions(places: DataFrame, lengths: list[int]) -> DataFrame:
    """Every host suffix with every path prefix of the given lengths, for distinct hosts and paths."""
    labels = F.split("host", r"\.")
    suffixes = F.transform(
        F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), ".")
    )
    prefixes = F.filter(
        F.array(*[F.when(F.length("path") >= n, F.substring("path", 1, n)) for n in lengths]), lambda p: p.isNotNull()
    )
    return _hashed(
        places.select("host", "path", F.explode(suffixes).alias("suffix"), prefixes.alias("prefixes")).select(
            "host", "path", "suffix", F.explode("prefixes").alias("prefix")
        )
    )


def judge(pages: DataFrame, rules: DataFrame, default: str = "allow") -> DataFrame:
    """One row per page: page_id, host, path, rule (host and path in one, or null), verdict.

    ``rules`` has host, path and verdict. Hot hosts and URLs cost nothing extra:
    only distinct places are expanded, and copies of a URL are counted before the shuffle.
    """
    rules = saved(
        rules.where("host IS NOT NULL AND path IS NOT NULL AND verdict IS NOT NULL")
        .groupBy(F.translate("host", UPPER, LOWER).alias("suffix"), F.col("path").alias("prefix"))
        .agg(F.max("verdict").alias("verdict"))
    )
    # A path has one length, so this list is as short as the longest path, however many rules there are.
    found = rules.agg(F.collect_set(F.length("prefix")), F.count("*")).first()
    lengths, n = sorted(found[0]), found[1]
    placed = pages.select("page_id", *host_and_path(F.col("url")))
    if not n:
        return placed.select("*", F.lit(None).cast("string").alias("rule"), F.lit(default).alias("verdict"))
    known = _hashed(rules).select("short", "digest", F.col("suffix").alias("rule_host"), F.col("prefix").alias("rule_path"), "verdict")
    expanded = expressions(placed.select("host", "path").distinct(), lengths).select("host", "path", "short", "digest")
    hits = expanded.join(F.broadcast(known) if n <= BROADCAST_RULES else known, "short").where(
        expanded["digest"] == known["digest"]
    )
    best = hits.groupBy("host", "path").agg(
        F.max(
            F.struct(
                (F.length("rule_host") + F.length("rule_path")).alias("long"),
                F.length("rule_host").alias("host_long"),
                F.concat("rule_host", "rule_path").alias("rule"),
                "verdict",
            )
        ).alias("best")
    )
    return placed.join(best, ["host", "path"], "left").select(
        "page_id", "host", "path", F.col("best.rule").alias("rule"), F.coalesce("best.verdict", F.lit(default)).alias("verdict")
    )
