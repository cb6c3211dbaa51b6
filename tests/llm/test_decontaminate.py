import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from folioflow.llm import decontaminate as dc


def words_of(text):
    return re.findall(r"[^\W_]+", (text or "").lower())


def plain(docs, items, width=5, similarity=0.8):
    """Every window of every item's length, by the similarity of weighted shingles alone."""
    found = {}
    for doc_id, text in docs:
        words = words_of(text)
        for item_id, item_text in items:
            item = words_of(item_text)
            if not item or not words:
                continue
            n = min(len(item), len(words))
            w = min(width, len(item), n)
            grams = lambda ws: Counter(tuple(ws[i:i + w]) for i in range(len(ws) - w + 1))
            want = grams(item)
            best = 0
            for start in range(len(words) - n + 1):
                have = grams(words[start:start + n])
                best = max(best, sum((want & have).values()) / sum((want | have).values()))
            if best >= similarity:
                found[doc_id, item_id] = best
    return found


def test_planted_passages(spark):
    item = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen twenty"
    long = " ".join(f"long{i}" for i in range(59))
    near = long.replace("long30", "other")
    noise = " ".join(f"n{i}" for i in range(300))
    docs = [
        (1, f"{noise} {item} {noise}"), (2, f"{noise}\n{item.upper().replace(' ', ', ')}!\n{noise}"), (3, item), (4, noise),
        (5, f"{noise} {near}"), (6, " ".join(item.split()[:10]) + " " + noise), (7, None), (8, ""), (9, "one two"),
        (10, f"tiny thing {noise}"), (11, " ".join(reversed(item.split()))), (12, f"{item} {noise} {long}"), (12, f"{item} {noise} {long}"),
        (13, " ".join(item.split()[1:] + ["x"])),
    ]
    items = [(1, item), (2, long), (3, "tiny thing"), (4, None), (5, "")]
    found = dc.matches(spark.createDataFrame(docs, "doc_id bigint, text string"),
                       spark.createDataFrame(items, "item_id bigint, text string")).collect()
    got = {(r.doc_id, r.item_id): r.similarity for r in found}
    assert got == pytest.approx(plain(docs, items))
    assert {(5, 2), (13, 1), (10, 3), (12, 1), (12, 2)} <= set(got) and len(found) == len(got) + 2
    at = next(r for r in found if r.doc_id == 1)
    assert (at.start_word, at.n_words, at.similarity) == (300, 20, 1.0)


def test_given_tables(spark, documents):
    benchmark = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    got = {(r.doc_id, r.item_id): r.similarity for r in dc.matches(documents, benchmark).collect()}
    assert got == pytest.approx(plain([(r.doc_id, r.text) for r in documents.collect()], [(r.item_id, r.text) for r in benchmark.collect()]))
    kept = dc.clean(documents, benchmark)
    assert kept.columns == documents.columns
    assert {r.doc_id for r in kept.collect()} == {r.doc_id for r in documents.collect()} - {d for d, _ in got}


def test_odd_rows(spark, odd_docs, no_docs):
    benchmark = spark.createDataFrame([(1, "own text 3 shared line other 0")], "item_id bigint, text string")
    kept = dc.clean(odd_docs, benchmark)
    assert kept.count() == odd_docs.count() - 1 and kept.columns == odd_docs.columns
    assert dc.clean(no_docs, benchmark).count() == 0
    assert dc.clean(odd_docs, benchmark.limit(0)).count() == odd_docs.count()
    assert dc.matches(no_docs, benchmark.limit(0)).count() == 0


def test_no_python_in_the_plan(spark, documents):
    benchmark = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    plan = dc.matches(documents, benchmark)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "NestedLoop" not in plan


def test_clean_keeps_rows_of_any_columns(spark, documents, monkeypatch):
    """Extra columns with odd names stay; a filter that lets nothing pass changes no result."""
    benchmark = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    odd = documents.withColumn("a.b", documents.doc_id % 3).withColumnRenamed("lang", "near")
    odd = odd.unionByName(odd.limit(1).selectExpr("doc_id", "CAST(NULL AS STRING) AS text", "near", "source", "n_chars", "`a.b`"))
    leaked = {r.doc_id for r in dc.matches(odd, benchmark).collect()}
    kept = dc.clean(odd, benchmark)
    assert kept.columns == odd.columns and leaked
    expected = sorted(repr(r) for r in odd.collect() if r.text is None or r.doc_id not in leaked)
    assert sorted(repr(r) for r in kept.collect()) == expected
    monkeypatch.setattr(dc, "_in_filter", lambda h, held, bits: h.isNotNull())
    assert sorted(repr(r) for r in dc.clean(odd, benchmark).collect()) == expected
