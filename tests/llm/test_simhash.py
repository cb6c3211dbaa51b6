"""Fingerprints and components against a plain version over all pairs."""

import re

import pytest
import xxhash

from folioflow.llm import simhash


def plain_fingerprint(text, words):
    tokens = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not tokens:
        return 0
    shingles = [" ".join(tokens[i:i + words]) for i in range(max(1, len(tokens) - words + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(rows, radius):
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if bin(rows[i][1] ^ rows[j][1]).count("1") <= radius:
                root[find(i)] = find(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[find(i)] = min(doc_id, least.get(find(i), doc_id))
    return [least.get(find(i)) for i in range(len(rows))]


def check(df, radius=2):
    rows = [(r.doc_id, plain_fingerprint(r.text, 3)) for r in df.collect()]
    expected = sorted(map(repr, ((d, f, c) for (d, f), c in zip(rows, plain_components(rows, radius)))))
    got = sorted(repr((r.doc_id, r.fp % (1 << 64), r.component_id))
                 for r in simhash.near_duplicates(df, radius=radius).collect())
    assert got == expected


def test_documents(documents):
    check(documents)


def test_odd_rows(odd_docs):
    check(odd_docs)


def test_empty_table(no_docs):
    assert simhash.near_duplicates(no_docs).count() == 0


def test_chain_of_links(spark):
    """Neighbours within the radius, ends far apart: one component under the least id."""
    fps = [0]
    for i in range(0, 40, 2):
        fps.append(fps[-1] ^ (3 << i))
    df = spark.createDataFrame([(f,) for f in fps], "fp bigint")
    from folioflow.llm.graph import components

    found = components(simhash.links(df)).collect()
    assert {r.root for r in found} == {0} and len(found) == len(fps) - 1


def test_radius_four_links_all_within_it(spark):
    import random

    random.seed(3)
    base = [random.getrandbits(63) for _ in range(20)]
    fps = base + [b ^ (1 << i) ^ (1 << i + 9) ^ (1 << i + 20) ^ (1 << i + 31) for i, b in enumerate(base)]
    found = simhash.links(spark.createDataFrame([(f,) for f in fps], "fp bigint"), 4).collect()
    assert {frozenset(r) for r in found} == {frozenset(p) for p in zip(base, fps[20:])}


def test_odd_radius_is_refused(documents):
    with pytest.raises(ValueError):
        simhash.near_duplicates(documents, radius=3)
