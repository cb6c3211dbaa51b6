"""Phrases against a plain count, filters against their entries."""

import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from folioflow.llm import collocations
from folioflow.llm.collocations import Packing


def plain(rows, min_count, top=2000, contained=80):
    counts, totals = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for n in range(1, 5):
                for i in range(len(words) - n + 1):
                    counts[lang, tuple(words[i:i + n])] += 1
    candidates = {k: a for k, a in counts.items() if len(k[1]) > 1 and a >= min_count}
    out = {}
    for (lang, w), a in candidates.items():
        if any(x == lang and len(v) > len(w) and 100 * f >= contained * a and any(v[i:i + len(w)] == w for i in range(len(v)))
               for (x, v), f in candidates.items()):
            continue
        score, _, l, r = min((2000000 * a // (counts[lang, w[:k]] + counts[lang, w[k:]]), k, counts[lang, w[:k]], counts[lang, w[k:]])
                             for k in range(1, len(w)))
        out.setdefault(lang, []).append((-score, -a, " ".join(w).encode(), a, l, r, score))
    return sorted((lang, rank, x[2].decode(), *x[3:6], totals[lang], x[6])
                  for lang, found in out.items() for rank, x in enumerate(sorted(found)[:top], 1))


def got(df, **kw):
    return sorted(tuple(r) for r in collocations.mine(df, **kw).collect())


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(8)
    words = ["New", "york", "city", "the", "of", "état", "a", "x\x01", "x", "ß", "it's", "\x1c"]
    out = []
    for i in range(300):
        text = "".join(rng.choice(words) + rng.choice([" ", " ", " ", "\t ", ". ", "\n", ",", "\x0b"]) for _ in range(rng.randint(0, 40)))
        out.append((rng.choice(["en", "de", None, "und"]), text + " in New York City hall" * (i % 3)))
    return out + [("en", None), ("en", ""), (None, " . ,"), ("fr", "one word of its own"), *[("es", "uno dos tres")] * 7]


@pytest.mark.parametrize("min_count, top", [(3, 2000), (12, 5), (7, 1)])
def test_phrases(spark, rows, min_count, top):
    df = spark.createDataFrame(rows, "lang string, text string").repartition(4)
    expected = plain(rows, min_count, top)
    assert expected and got(df, min_count=min_count, top=top) == expected


def test_small_filters_and_chunks(spark, rows, monkeypatch):
    """Many chunks and segments: the same phrases."""
    monkeypatch.setattr(collocations, "CHUNK_WORDS", 50)
    monkeypatch.setattr(collocations, "FILTER_ENTRIES", 64)
    monkeypatch.setattr(collocations, "SEGMENT_ENTRIES", 16)
    df = spark.createDataFrame(rows, "lang string, text string").repartition(3)
    assert got(df, min_count=3) == plain(rows, 3)


def test_odd_rows(odd_docs, no_docs):
    odd = odd_docs.withColumn("a.b", F.lit(1)).withColumn("word", F.lit("x")).withColumn("n", F.lit(1))
    assert got(odd, min_count=2) == plain([(r.lang, r.text) for r in odd_docs.collect()], 2)
    assert got(no_docs) == []


@pytest.mark.parametrize("bits", [1, 5, 17, 21, 32])
@pytest.mark.parametrize("n", [2, 3, 4])
def test_filter_round_trip(n, bits):
    rng = np.random.default_rng(n * 100 + bits)
    packing = Packing(n, bits)
    words = [rng.integers(0, 1 << bits, 3000, np.uint64) for _ in range(n)]
    assert all((x == y).all() for x, y in zip(words, packing.words(*packing.permuted(words))))
    a, b, counts = collocations.merge([(*packing.permuted(words), rng.integers(1, 600, 3000))], packing)
    for s in {0, 1, min(3, packing.widths[0])}:
        number = a >> np.uint64(packing.widths[0] - s) if s else np.zeros(len(a), np.uint64)
        for segment in np.unique(number):
            at = number == segment
            raw = collocations.encode_segment(a[at], b[at], counts[at], packing, s)
            for x, y in zip(collocations.decode_segment(raw, int(segment), packing, s), (a[at], b[at], counts[at])):
                assert (x == y).all()
