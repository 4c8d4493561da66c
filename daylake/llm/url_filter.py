"""URL filters (10): host-suffix and path-prefix expressions, joined by short
hash prefix, confirmed by full digest, longest rule first.

A rule is ``(host, path, action)``. It fits a URL whose host is the rule's
host or a subdomain of it and whose path starts with the rule's path. Every
distinct URL is expanded into the expressions ``host suffix + path prefix``
that some rule could equal (suffixes by the label counts and prefixes by the
path lengths that occur among the rules, so the expansion is bounded by the
rules and not by the URL), each expression is hashed, and an equi-join on the
first four bytes of the SHA-256, as a number and nothing else, fetches the
rules; the whole digest confirms what came together. (Written as a prefix test,
not as an equality, which Spark would make a join key too.)

Defined results: a NULL URL or one without ``://`` has an empty host and path
and no rule. A URL whose path is empty fits no rule with a path. An empty
rules table gives the default verdict everywhere. Repeated rows and NULL ids
are judged like any other row; other columns pass through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daylake.llm.common import stage

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
PREFIX_HEX = 8  # four bytes of the digest
DEFAULT_VERDICT = "allow"


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host and path of a URL column; both empty without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + F.lit(3))).otherwise(F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"(?s)^[^/?#]*", 0), UPPER, LOWER)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*(/[^?#]*)", 1)
    return host, path


def _digests(rules: DataFrame) -> DataFrame:
    """Rules with their expression, labels, path length and digest; one row
    per expression: of an expression that is both blocked and allowed, the
    block counts."""
    host = F.translate(F.col("host"), UPPER, LOWER)
    return (rules.where("host is not null and path is not null and action is not null")
            .select(host.alias("r_host"), F.col("path").alias("r_path"), "action")
            .groupBy("r_host", "r_path").agg(F.max("action").alias("r_action"))  # allow < block
            .withColumn("labels", F.size(F.split("r_host", r"\.")))
            .withColumn("p_len", F.length("r_path"))
            .withColumn("digest", F.sha2(F.concat("r_host", F.lit("\n"), "r_path"), 256)))


def _short(digest: str) -> Column:
    return F.conv(F.substring(digest, 1, PREFIX_HEX), 16, 10).cast("long")


def fetched(tried: DataFrame, table: DataFrame) -> DataFrame:
    """Expressions with the rules they equal: joined by ``short`` alone, then
    confirmed by the whole digest (both have 64 characters)."""
    return tried.join(table, "short").where(F.startswith("h", "digest"))


def url_verdicts(pages: DataFrame, rules: DataFrame, url: str = "url",
                 default: str = DEFAULT_VERDICT) -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule`` (NULL: none) and ``verdict``.

    ``rules``: columns ``host, path, action`` (``block`` or ``allow``). The
    longest rule that fits wins: by length of host and path together, then by
    host length. The rules are one side of an equi-join; Spark broadcasts
    them when their size is below its threshold and shuffles both otherwise.
    """
    clash = [c for c in pages.columns if c in ("host", "path", "rule", "verdict") and c != url]
    kept = pages.drop(*clash)
    table = _digests(rules)
    # the distinct (labels, path length) shapes: as few as the rules vary
    shapes = table.select("labels", "p_len").distinct().groupBy().agg(
        F.collect_set("labels").alias("labels"), F.collect_set("p_len").alias("lens")).first()
    labels, lens = sorted(shapes["labels"]), sorted(shapes["lens"])
    host, path = url_parts(F.col("__url"))
    # dealt anew, by a hash (by the URL itself they are already dealt, into few tasks):
    # the distinct URLs are small beside what they expand into
    tasks = int(pages.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    urls = (kept.select(F.col(url).alias("__url")).where("__url is not null").distinct()
            .repartition(tasks, F.xxhash64("__url")).select("__url", host.alias("u_host"), path.alias("u_path")))
    if labels:
        n = F.size(F.split("u_host", r"\."))
        suffixes = F.array(*[F.when(n >= k, F.substring_index("u_host", ".", -k)) for k in labels])
        prefixes = F.array(*[F.when(F.length("u_path") >= k, F.substring("u_path", 1, k)) for k in lens])
        tried = (urls.where("u_host <> ''")
                 .withColumn("s", F.explode(F.array_compact(suffixes)))
                 .withColumn("p", F.explode(F.array_compact(prefixes)))
                 .select("__url", F.sha2(F.concat("s", F.lit("\n"), "p"), 256).alias("h")))
    else:
        tried = urls.where(F.lit(False)).select("__url", F.lit("").alias("h"))
    hits = fetched(tried.withColumn("short", _short("h")), table.withColumn("short", _short("digest")))
    rank = F.struct((F.length("r_host") + F.length("r_path")).alias("n"), F.length("r_host").alias("hl"),
                    F.concat("r_host", "r_path").alias("rule"), F.col("r_action").alias("action"))
    # staged, so that both sides of the join are dealt anew and a URL that many
    # rows hold can be split
    best = stage(hits.groupBy("__url").agg(F.max(rank).alias("best")).select(
        F.col("__url").alias("j_url"), F.col("best.rule").alias("rule"), F.col("best.action").alias("verdict")),
        "url-verdicts")
    p_host, p_path = url_parts(F.col(url))
    joined = kept.join(best, F.col(url) == F.col("j_url"), "left")
    return joined.select(
        *[F.col(c) for c in kept.columns],
        F.coalesce(p_host, F.lit("")).alias("host"), F.coalesce(p_path, F.lit("")).alias("path"),
        "rule", F.coalesce("verdict", F.lit(default)).alias("verdict"))


__all__ = ["url_verdicts", "url_parts", "DEFAULT_VERDICT"]
