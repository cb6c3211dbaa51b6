"""The join against all pairs: clusters around one text, chains, copies of copies, unlike texts."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from folioflow.llm import group_join


def plain_set(text, words=3):
    found = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {" ".join(found[i:i + words]) for i in range(max(1, len(found) - words + 1))} if found else set()


def plain(rows, percent=90):
    sets = [plain_set(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[find(i)] = min(doc_id, least.get(find(i), doc_id))
    return sorted(((d, len(s), least.get(find(i))) for i, ((d, _), s) in enumerate(zip(rows, sets))), key=repr)


def got(df, **kw):
    return sorted((tuple(r) for r in group_join.similar(df, **kw).drop("digest").collect()), key=repr)


def edited(rng, words, n):
    words = list(words)
    for at in rng.sample(range(len(words)), n):
        words[at] = f"new{rng.randrange(10**6)}"
    return words


def cluster(seed, keep_base):
    """A base with copies of 0 to 4 edits, some edited again, chains, cut-off copies, a shared passage."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    passage = rng.choices(vocabulary, k=40)
    texts = []
    for _ in range(3):
        base = rng.choices(vocabulary, k=rng.choice([60, 150])) + passage
        copies = [edited(rng, base, rng.randint(1, 4)) for _ in range(40)]
        texts += copies + [edited(rng, rng.choice(copies), 1) for _ in range(20)] + [base] * keep_base
        chain = base
        for _ in range(8):
            chain = chain[2:] + [f"tail{rng.randrange(10**6)}"]
            texts.append(chain)
        texts.append(base[:len(base) - 6])
    texts += [rng.choices(vocabulary, k=rng.randint(1, 90)) + passage for _ in range(60)]
    texts += [[w] for w in vocabulary[:5]] + [vocabulary[:2], vocabulary[:2], vocabulary[:3]]
    rng.shuffle(texts)
    return [(i, " ".join(t)) for i, t in enumerate(texts)]


@pytest.mark.parametrize("seed, keep_base, percent", [(1, 1, 90), (2, 0, 90), (3, 2, 80)])
def test_clusters(spark, seed, keep_base, percent):
    rows = cluster(seed, keep_base)
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    expected = plain(rows, percent)
    assert got(df, percent=percent) == expected
    assert 40 < len({r[2] for r in expected}) < len(rows) - 40


def test_every_class_in_a_group_of_its_own(spark, monkeypatch):
    """Without groups all links are found by visits."""
    monkeypatch.setattr(group_join, "_grouped", lambda sets: sets.select("node", F.col("node").alias("grp")))
    rows = cluster(5, 1)
    assert got(spark.createDataFrame(rows, "doc_id bigint, text string")) == plain(rows)


def test_one_group_of_all(spark, monkeypatch):
    monkeypatch.setattr(group_join, "_grouped", lambda sets: sets.select("node", F.lit(1).cast("bigint").alias("grp")))
    rows = cluster(6, 0)
    assert got(spark.createDataFrame(rows, "doc_id bigint, text string")) == plain(rows)


def test_coarse_sketch(spark, monkeypatch):
    """A sketch that tells nothing apart changes no result."""
    monkeypatch.setattr(group_join, "_sketch", lambda texts, words, bits: (np.zeros(bits // 8, np.uint8), np.zeros(group_join.SLOTS, np.uint8)))
    rows = cluster(7, 1)
    assert got(spark.createDataFrame(rows, "doc_id bigint, text string")) == plain(rows)


def test_unlike_texts_stay_out_whatever_the_sketch(spark, monkeypatch):
    """Texts of shared passages without near copies do not go on, also where the filter is as full as on a large input."""
    monkeypatch.setattr(group_join, "_sketch", lambda texts, words, bits: (np.zeros(bits // 8, np.uint8), np.zeros(group_join.SLOTS, np.uint8)))
    taken, grouped = [], group_join._grouped
    monkeypatch.setattr(group_join, "_grouped", lambda sets: taken.append(sets.count()) or grouped(sets))
    rng = random.Random(8)
    passages = [rng.choices([f"w{i}" for i in range(3000)], k=30) for _ in range(40)]
    unlike = [sum(rng.sample(passages, 2), []) + [f"own{n}x{i}" for i in range(50)] for n in range(300)]
    near = [edited(rng, unlike[0], 1) for _ in range(5)]
    rows = [(i, " ".join(t)) for i, t in enumerate(unlike + near)]
    assert got(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)) == plain(rows)
    assert taken == [6]


def test_shared_tokens_are_counted_over_batches_and_segments(spark, monkeypatch):
    """Every even token that another set of the input holds counts, wherever that is; equal sets of a batch are one."""
    monkeypatch.setattr(group_join, "SEGMENT_TOKENS", 1)
    rows = cluster(9, 2)
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    found, classes = group_join._classes(df, 3, 90)
    assert sorted((r.doc_id, r.n) for r in found.collect()) == [(i, len(plain_set(t))) for i, t in rows]
    near = {bytes(r.digest): r.near for r in classes.collect()}
    sets = [group_join.tokens(t.encode(), 3) for _, t in rows]
    held = {}
    for s in {group_join.set_digest(s): s for s in sets}.values():
        for t in s.tolist():
            held[t] = held.get(t, 0) + 1
    once = [sum(group_join.set_digest(s) == group_join.set_digest(o) for o in sets) == 1 for s in sets]
    for s, alone in zip(sets, once):
        even = [t for t in s.tolist() if t % 2 == 0]
        missed = sum(held[t] == 1 for t in even)
        if alone:
            assert near[group_join.set_digest(s)] == (missed <= len(s) - -(-90 * len(s) // 100))
        else:
            # Copies in two batches hold each other's tokens.
            assert near[group_join.set_digest(s)] or missed > len(s) - -(-90 * len(s) // 100)


def test_odd_rows(odd_docs, no_docs):
    odd = odd_docs.withColumn("a.b", F.lit(1)).withColumn("node", F.lit("x")).withColumn("grp", F.lit(1))
    assert got(odd) == plain([(r.doc_id, r.text) for r in odd_docs.collect()])
    assert got(no_docs) == []


def test_documents(documents):
    assert got(documents) == plain([(r.doc_id, r.text) for r in documents.collect()])
