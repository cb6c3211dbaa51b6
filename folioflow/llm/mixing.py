"""Mix sources to target weights by Poisson replication. DataFrame functions only.

A source whose texts make up ``size`` bytes and shall make up ``target`` is repeated at the rate
target / size. Each document draws its number of copies from a Poisson distribution with that mean,
by inverting the distribution at a number hashed from a seed and the document, so the draw needs no
state, does not hang on partitions, and is the same on every run.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from folioflow.llm.common import session, whole
from folioflow.session import cut_lineage

# A rate is drawn as the sum of independent Poisson parts of at most this mean: exp(-mean) stays
# far from the smallest double, and no more than _TERMS terms of a part's distribution matter.
PART = 16.0
_TERMS = 128


def uniform(*values: Column) -> Column:
    """A number in [0, 1) from the MD5 of the joined values: 52 bits."""
    digits = F.substring(F.md5(F.concat_ws(":", *(v.cast("string") for v in values))), 1, 13)
    return F.conv(digits, 16, 10).cast("double") / F.lit(float(1 << 52))


def poisson(u: Column, mean: Column) -> Column:
    """The least k whose distribution function is above ``u``; ``mean`` at most ``PART``."""
    start = F.struct(
        F.exp(-mean).alias("mass"), F.exp(-mean).alias("upto"), F.lit(0).alias("k"),
    )

    def step(s: Column, n: Column) -> Column:
        mass = s["mass"] * mean / n
        return F.when(s["upto"] > u, s).otherwise(F.struct(
            mass.alias("mass"), (s["upto"] + mass).alias("upto"), (s["k"] + 1).alias("k")))

    return F.aggregate(F.sequence(F.lit(1), F.lit(_TERMS)), start, step, lambda s: s["k"])


def copies(rate: Column, seed: int, *identity: Column) -> Column:
    """How often a document is repeated at ``rate``, a Poisson number for each identity."""
    parts = F.greatest(F.lit(1), F.ceil(rate / F.lit(PART)).cast("int"))
    mean = rate / parts
    return F.aggregate(
        F.sequence(F.lit(1), parts), F.lit(0),
        lambda total, n: total + poisson(uniform(F.lit(seed), n, *identity), mean),
    )


def rates(docs: DataFrame, weights: DataFrame | None = None, temperature: float = 0.5, epochs: float = 1.0,
          source_col: str = "source", text_col: str = "text") -> DataFrame:
    """``source, bytes, weight, rate`` per source.

    ``weights`` (source, weight) are the wanted shares of the bytes, in any unit; a source that it
    does not list, or lists as null or below zero, has weight 0 and goes. Without it the weight is
    the source's bytes to the power ``temperature``. The whole is ``epochs`` times the bytes of all
    documents. A null source is a source of its own; a source without bytes has rate ``epochs``.
    """
    sizes = docs.groupBy(F.col(source_col).alias("source")).agg(
        F.sum(F.octet_length(F.coalesce(F.col(text_col), F.lit("")))).alias("bytes"))
    if weights is None:
        known = sizes.withColumn("weight", F.pow(F.col("bytes").cast("double"), F.lit(float(temperature))))
    else:
        wanted = weights.groupBy(F.col("source").alias("wanted")).agg(F.sum("weight").cast("double").alias("weight"))
        known = sizes.join(wanted, F.col("source").eqNullSafe(F.col("wanted")), "left").drop("wanted")
        known = known.withColumn("weight", F.greatest(F.lit(0.0), F.coalesce("weight", F.lit(0.0))))
    known = cut_lineage(known)
    total = known.agg(F.sum("bytes").alias("bytes"), F.sum(F.when(F.col("bytes") > 0, F.col("weight"))).alias("weights")).first()
    target = F.lit(float(epochs) * (total["bytes"] or 0)) * F.col("weight") / F.lit(total["weights"] or 1.0)
    rate = F.when(F.col("bytes") > 0, target / F.col("bytes")).otherwise(F.lit(float(epochs)))
    return known.select("source", "bytes", "weight", rate.alias("rate"))


def mix(docs: DataFrame, weights: DataFrame | None = None, temperature: float = 0.5, epochs: float = 1.0,
        seed: int = 0, source_col: str = "source", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``row`` (a struct of all input columns), ``copy`` from 1 and ``place``, shuffled globally.

    A document's identity is its id and the MD5 of its text: rows that repeat both draw the same
    number, rows that only share a null id do not. ``place`` is the hash that gives the global
    order; the result's partitions follow it and are sorted by it.
    """
    session(docs.sparkSession)
    identity = [F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.md5(F.coalesce(F.col(text_col), F.lit("")))]
    table = cut_lineage(rates(docs, weights, temperature, epochs, source_col, text_col).select(
        F.col("source").alias("rate_source"), "rate"))
    packed = docs.select(
        whole(docs).alias("row"), F.col(source_col).alias("own_source"), F.concat_ws(":", *identity).alias("identity"))
    rated = packed.join(table, F.col("own_source").eqNullSafe(F.col("rate_source")))
    drawn = rated.select("row", "identity", copies(F.col("rate"), seed, F.col("identity")).alias("n")).filter("n > 0")
    repeated = drawn.select("row", "identity", F.explode(F.sequence(F.lit(1), F.col("n"))).alias("copy"))
    placed = repeated.select("row", "copy", F.xxhash64(F.lit(seed), "identity", "copy").alias("place"))
    return placed.repartitionByRange("place", F.rand(seed)).sortWithinPartitions("place")
