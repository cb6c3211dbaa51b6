"""One document of each SimHash component, against a plain version over all pairs."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from folioflow.llm import bloom, simhash
from tests.llm.test_simhash import plain_components, plain_fingerprint


def plain_kept(rows):
    """Ids that stay: of each component the least id, nulls last, ties by text."""
    fps = [plain_fingerprint(r.text, 3) for r in rows]
    # Components under numbers of their own, so that rows without an id count as well.
    parts = plain_components([(n, fp) for n, fp in enumerate(fps)], 2)
    kept = {}
    for part, r in zip(parts, rows):
        key = (r.doc_id is None, r.doc_id or 0)
        kept[part] = min(key, kept.get(part, key))
    return sorted((None if none else i for none, i in kept.values()), key=repr)


@pytest.fixture(scope="module")
def copies(spark):
    """A long base with 60 near copies, its original last; pairs, exact copies, texts of their own."""
    rng = random.Random(11)
    vocabulary = [f"w{i}" for i in range(3000)]
    rows = []

    def add(words):
        rows.append((len(rows) + 1, " ".join(words)))

    base = rng.choices(vocabulary, k=3000)
    for _ in range(60):
        near = list(base)
        near[rng.randrange(len(near))] = f"new{rng.randrange(10**6)}"
        add(near)
    add(base)
    for _ in range(10):
        own = rng.choices(vocabulary, k=50)
        add(own)
        add(own)
    for _ in range(40):
        add(rng.choices(vocabulary, k=rng.randint(1, 300)))
    return spark.createDataFrame(rows, "doc_id bigint, text string")


def ids(df):
    return sorted((r.doc_id for r in df.collect()), key=repr)


def test_copies(copies):
    expected = plain_kept(copies.collect())
    assert ids(simhash.one_of_each(copies)) == expected
    assert len(expected) < copies.count() - 40


def test_documents(documents):
    kept = simhash.one_of_each(documents)
    assert kept.columns == documents.columns
    assert ids(kept) == plain_kept(documents.collect())
    assert kept.exceptAll(documents).count() == 0


def test_odd_rows(odd_docs, no_docs):
    kept = simhash.one_of_each(odd_docs)
    assert kept.columns == odd_docs.columns
    assert ids(kept) == plain_kept(odd_docs.collect())
    assert simhash.one_of_each(no_docs).count() == 0


def test_odd_column_names(documents):
    odd = documents.withColumn("a.b", F.lit(1)).withColumn("a b`c", F.lit("x")).withColumn("row", F.lit(2))
    odd = odd.withColumnRenamed("a b`c", "fp")
    assert sorted(simhash.one_of_each(odd).columns) == sorted(odd.columns)


def test_full_filters_change_nothing(copies, monkeypatch):
    expected = ids(simhash.one_of_each(copies))
    monkeypatch.setattr(bloom, "build", lambda hashes: np.full(1024, 2**64 - 1, np.uint64))
    assert ids(simhash.one_of_each(copies)) == expected


def test_filter_holds_all_it_was_built_from(spark):
    df = spark.range(5000).select(F.xxhash64("id").alias("h"))
    hashes = np.array([r.h for r in df.collect()])
    filter_ = bloom.build(df)
    assert bloom.holds(filter_, hashes).all()
    other = np.array([r.h for r in spark.range(10**6, 10**6 + 5000).select(F.xxhash64("id").alias("h")).collect()])
    assert bloom.holds(filter_, other).mean() < 0.05
