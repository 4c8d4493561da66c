"""Mixing sources to target weights (5): Poisson replication.

The rate of a source is its target share of the output over its share of the
rows. A document's number of copies is the inverse of the Poisson
distribution with that rate at a uniform number taken from a seeded hash of
the document's id and text, so a retried task or another partitioning gives
the same copies: it is looked up in the source's table, made once a source. Each
document is exploded by its count and the copies are spread and sorted by a
second hash: a global shuffle.

Rates over ``CHUNK`` are the sum of several independent draws (a Poisson sum
is Poisson), so the distribution's table stays short at any rate.

Defined results: a NULL source is a source of its own; a source without a
target weight (or weight 0) gets no copies. Rows that repeat id and text draw
alike, each for itself. NULL ids and texts hash as such. Columns named
``copy`` or ``mix_key`` are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daylake.llm.common import stage

CHUNK = 16.0
SEED = 7
TAIL = 64  # P(X > 16 + 64) under rate 16 is below 1e-25


def uniform(seed: int, *parts: Column) -> Column:
    """A number in [0, 1) with 52 bits from the MD5 of seed and parts."""
    text = F.concat_ws("|", F.lit(str(seed)), *[F.coalesce(p.cast("string"), F.lit("\\N")) for p in parts])
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def poisson_table(rate: Column) -> Column:
    """P(X <= k) for k = 0, 1, ... as an array, for rates up to ``CHUNK``."""
    first = F.exp(-rate)
    start = F.struct(first.alias("p"), first.alias("cdf"), F.array(first).alias("table"))
    steps = F.aggregate(
        F.sequence(F.lit(1), F.lit(int(CHUNK) + TAIL - 1)), start,
        lambda acc, i: F.struct((acc["p"] * rate / i).alias("p"), (acc["cdf"] + acc["p"] * rate / i).alias("cdf"),
                                F.array_append(acc["table"], acc["cdf"] + acc["p"] * rate / i).alias("table")))
    return steps["table"]


def found(table: Column, u: Column) -> Column:
    """Smallest k with P(X <= k) > u, from a distribution's table."""
    return F.size(F.filter(table, lambda cdf: cdf <= u))


def poisson_inverse(rate: Column, u: Column) -> Column:
    """Smallest k with P(X <= k) > u, for rates up to ``CHUNK``."""
    return found(poisson_table(rate), u)


def rates(docs: DataFrame, weights: DataFrame | None = None, source: str = "source",
          temperature: float = 0.5) -> DataFrame:
    """``source, rate``: mean copies per document of each source.

    ``weights`` has ``source, weight``; without it the target share of a
    source is its row count to the power ``temperature``. The output has as
    many rows as the input, in the mean.
    """
    counts = docs.groupBy(F.col(source).alias("source")).agg(F.count("*").alias("n"))
    if weights is None:
        weighed = counts.withColumn("weight", F.pow("n", F.lit(temperature)))
    else:
        w = weights.select(F.col("source").alias("__s"), F.col("weight").cast("double").alias("weight"))
        weighed = counts.join(w, F.col("source").eqNullSafe(F.col("__s")), "left").drop("__s")
    weighed = stage(weighed, "mix-sources")  # read for the sums and for the rates
    row = weighed.agg(F.sum("n").alias("n"), F.sum("weight").alias("weight")).first()
    share = F.col("weight") / F.lit(float(row["weight"] or 1))
    return (weighed.where("weight > 0")
            .select("source", (share * F.lit(float(row["n"] or 0)) / F.col("n")).alias("rate")))


def copies(docs: DataFrame, source_rates: DataFrame, doc_id: str = "doc_id", text: str = "text",
           source: str = "source", seed: int = SEED) -> DataFrame:
    """``docs`` with one row per copy, numbered by ``copy`` from 1, and
    ``mix_key``, whose order is the global shuffle."""
    draws = F.ceil(F.col("rate") / F.lit(CHUNK)).cast("int")
    # each source's table is worked out once, not once a document
    by = (source_rates.select("source", "rate", draws.alias("__draws")).where("__draws > 0")
          .select(F.col("source").alias("__s"), "__draws", poisson_table(F.col("rate") / F.col("__draws")).alias("__table")))
    by = stage(by, "mix-tables")
    rated = docs.drop("copy", "mix_key").join(by, F.col(source).eqNullSafe(F.col("__s")))
    fixed = F.md5(F.coalesce(F.col(text), F.lit("\\N")).cast("binary"))
    # the text's hash and each draw's number are bound to lambda variables: worked
    # out once, not once for every entry of the table they are compared with
    draw = F.flatten(F.transform(F.array(fixed), lambda t: F.transform(
        F.sequence(F.lit(1), F.col("__draws")), lambda d: uniform(seed, F.col(doc_id), t, d))))
    count = F.aggregate(F.transform(draw, lambda u: found(F.col("__table"), u)), F.lit(0), lambda a, k: a + k)
    out = (rated.withColumn("__text", fixed).withColumn("__n", count).where("__n > 0")
           .withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("__n"))))
           .withColumn("mix_key", uniform(seed + 1, F.col(doc_id), F.col("__text"), F.col("copy"))))
    return out.select(*docs.drop("copy", "mix_key").columns, "copy", "mix_key")


def mix(docs: DataFrame, weights: DataFrame | None = None, doc_id: str = "doc_id", text: str = "text",
        source: str = "source", seed: int = SEED, temperature: float = 0.5) -> DataFrame:
    """Copies to target weights, in shuffled order: spread by the hash over
    the partitions and sorted by it inside each."""
    out = copies(docs, rates(docs, weights, source, temperature), doc_id, text, source, seed)
    return out.repartition("mix_key").sortWithinPartitions("mix_key", doc_id, "copy")


__all__ = ["uniform", "poisson_inverse", "rates", "copies", "mix", "SEED", "CHUNK"]
