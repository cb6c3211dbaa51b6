import math

import pytest
from pyspark.sql import functions as F

from folioflow.llm import mixing


def test_poisson_inverts_the_distribution(spark):
    for mean in (0.01, 1.0, 7.5, 16.0):
        us = [i / 997 for i in range(997)]
        df = spark.createDataFrame([(u,) for u in us], "u double")
        got = {r.u: r.k for r in df.select("u", mixing.poisson(F.col("u"), F.lit(mean)).alias("k")).collect()}
        for u in us:
            k, upto = 0, math.exp(-mean)
            while upto <= u:
                k += 1
                upto += math.exp(k * math.log(mean) - mean - math.lgamma(k + 1))
            assert got[u] == k


def test_large_rates_have_their_mean(spark):
    df = spark.range(2000).select(mixing.copies(F.lit(900.0), 1, F.col("id")).alias("n"))
    mean, spread = df.agg(F.avg("n"), F.stddev("n")).first()
    assert abs(mean - 900) < 3 and abs(spread - 30) < 2


def test_sources_reach_their_weights(spark):
    docs = spark.range(6000).select(
        F.col("id").alias("doc_id"), F.lit("x" * 50).alias("text"),
        F.when(F.col("id") < 4000, "hot").when(F.col("id") < 5000, "small").otherwise("gone").alias("source"))
    weights = spark.createDataFrame([("hot", 1.0), ("small", 3.0), ("absent", 9.0)], "source string, weight double")
    mixed = mixing.mix(docs, weights, seed=3)
    found = {r.source: r.n for r in mixed.groupBy("row.source").agg(F.count("*").alias("n")).collect()}
    assert set(found) == {"hot", "small"}
    assert abs(found["hot"] - 1500) < 160 and abs(found["small"] - 4500) < 280
    repeats = mixed.groupBy("row.doc_id").agg(F.count("*").alias("n"), F.max("copy").alias("last"), F.min("copy").alias("first"))
    assert repeats.filter("n <> last OR first <> 1").count() == 0
    again = mixing.mix(docs, weights, seed=3)
    assert sorted(map(tuple, again.select("row.doc_id", "copy").collect())) == sorted(
        map(tuple, mixed.select("row.doc_id", "copy").collect()))


def test_odd_rows(odd_docs, no_docs):
    mixed = mixing.mix(odd_docs, epochs=3.0, seed=1)
    assert set(mixed.columns) == {"row", "copy", "place"}
    null_source = mixing.rates(odd_docs).filter("source IS NULL").first()
    assert null_source.rate == 1.0  # only an empty text
    assert mixing.mix(no_docs).count() == 0


def test_no_python_in_the_plan(documents):
    plan = mixing.mix(documents)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "NestedLoop" not in plan
