import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from folioflow.llm import quality


def test_features_are_those_of_the_words():
    a, b = quality.features(b"one two three"), quality.features(b"one two three four")
    assert len(a) == len(set(a.tolist())) and list(a) == sorted(a)
    assert len(set(a.tolist()) - set(b.tolist())) == 0
    assert len(quality.features(b"")) == 0 and len(quality.features(b" \n\t ")) == 0


def test_long_texts_are_read_whole(monkeypatch):
    text = " ".join(f"w{i}" for i in range(500)).encode()
    whole = quality.features(text)
    monkeypatch.setattr(quality, "_STEP", 64)
    assert quality.features(text).tolist() == whole.tolist()


def test_dual_coordinate_descent_reaches_the_optimum():
    """Against the primal objective at random planes around the result."""
    rng = np.random.default_rng(0)
    x = rng.normal(size=(60, 5))
    y = np.where(x @ np.array([1, -2, 0.5, 0, 1]) + 0.3 * rng.normal(size=60) > 0, 1.0, -1.0)
    rows = [np.arange(5)] * 60
    w = quality.dual_coordinate_descent(rows, list(x), y, np.full(60, 1.0), 5, epochs=500, tolerance=1e-8)

    def primal(v):
        return 0.5 * v @ v + np.maximum(0, 1 - y * (x @ v[:5] + v[5])).sum()

    assert all(primal(w) <= primal(w + rng.normal(size=6) * s) + 1e-6 for s in (1e-3, 1e-2, 0.1) for _ in range(50))


def test_held_out_accuracy(spark):
    """Learned from two thirds of the labelled documents, tested on the last third."""
    sf = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    model = quality.fit(quality.labels_of(docs, labels))
    scored = quality.score(docs, model, "doc_id", "text", quality.held_out(F.col("doc_id")).alias("held_out"))
    rows = scored.join(labels, "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1 for r in rows)
    tested = [(r.score >= 0.5) == (r.quality == 1) for r in rows if r.held_out]
    assert np.mean(tested) >= 0.97


def test_scores_hang_on_the_text_alone(spark, odd_docs, no_docs):
    labelled = spark.createDataFrame(
        [(i, f"good words in a line {i}", 1) for i in range(30)] + [(100 + i, "BAD!! STUFF!! ###", 0) for i in range(10)]
        + [(200, None, 0), (201, "no label", None)], "doc_id bigint, text string, label int")
    model = quality.fit(labelled)
    rows = quality.score(odd_docs, model).collect()
    assert len(rows) == odd_docs.count() and all(0 <= r.score <= 1 for r in rows)
    assert len({r.score for r in rows if r.doc_id == 7}) == 1
    assert len({r.score for r in rows if r.doc_id in (2, 3)}) == 1
    assert quality.score(no_docs, model).count() == 0


def test_one_class_or_no_labels(spark, documents):
    one = spark.createDataFrame([(1, "a", 1)], "doc_id bigint, text string, label int")
    for labelled, expected in ((one, True), (one.limit(0), True), (one.withColumn("label", F.lit(0)), False)):
        score = quality.score(documents.limit(3), quality.fit(labelled)).first().score
        assert (score >= 0.5) == expected


def test_sample_is_bounded(spark, documents):
    labels = documents.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("quality"))
    taken = quality.labels_of(documents, labels.unionByName(labels), sample_rows=5)
    assert {r.label: r["count"] for r in taken.groupBy("label").count().collect()} == {0: 5, 1: 5}
    assert taken.filter(quality.held_out(F.col("doc_id"))).count() == 0


def test_labels_of_absent_ids_take_no_place(spark, documents):
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    absent = spark.range(10**6, 10**6 + 20000).select(F.col("id").alias("doc_id"), (F.col("id") % 2).cast("int").alias("quality"))
    own = labels.select("doc_id", F.col("quality").cast("int").alias("quality"))
    taken = {n: sorted((r.doc_id, r.label) for r in quality.labels_of(documents, df, sample_rows=8).collect())
             for n, df in (("own", own), ("all", own.unionByName(absent)))}
    assert taken["own"] == taken["all"] and len({label for _, label in taken["all"]}) == 2


def test_long_texts_are_bounded(spark, monkeypatch):
    monkeypatch.setattr(quality, "SAMPLE_PLACES", 2000)
    rows = [(i, " ".join(f"w{i * j % 997}" for j in range(200)), i % 2) for i in range(60)]
    model = quality.fit(spark.createDataFrame(rows, "doc_id bigint, text string, label int"))
    assert len(model.ratio)
