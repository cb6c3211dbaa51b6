"""Passages at the given similarity at the ends of texts, and very long items, against all windows."""

import random

import pytest

from folioflow.llm import decontaminate as dc
from tests.llm.test_decontaminate import plain


def test_passages_cut_off_at_the_ends(spark):
    """The words at a passage's end are left out or replaced, down to a similarity of 0.8."""
    rng = random.Random(2)
    words = lambda n: [f"w{rng.randrange(10**7)}" for _ in range(n)]
    docs, items = [], []
    for n in (13, 22, 31, 49, 94):
        for k in range(3):
            item = words(n)
            items.append((len(items), " ".join(item)))
            lost = (n - 4) // 9
            for text in (item[lost:] + words(120), words(120) + item[:-lost], item[:n - (n - 4) // 5]):
                docs.append((len(docs), " ".join(text)))
    near = plain(docs, items)
    assert len(near) == len(docs)
    found = dc.matches(spark.createDataFrame(docs, "doc_id bigint, text string"),
                       spark.createDataFrame(items, "item_id bigint, text string")).collect()
    assert {(r.doc_id, r.item_id): r.similarity for r in found} == pytest.approx(near)


def test_repeated_shingles_count_as_often_as_in_the_item(spark):
    rng = random.Random(4)
    docs = [(i, " ".join(rng.choices("ab", k=rng.randint(20, 60)))) for i in range(12)]
    items = [(i, " ".join(rng.choices("ab", k=rng.choice((3, 9, 14))))) for i in range(12)]
    found = dc.matches(spark.createDataFrame(docs, "doc_id bigint, text string"),
                       spark.createDataFrame(items, "item_id bigint, text string")).collect()
    near = plain(docs, items)
    assert near and {(r.doc_id, r.item_id): r.similarity for r in found} == pytest.approx(near)


def test_items_of_more_than_65535_words(spark):
    words = [f"w{i}" for i in range(70_000)]
    text = " ".join(["other"] * 9 + words[9:])
    found = dc.matches(spark.createDataFrame([(1, text), (2, text[:900])], "doc_id bigint, text string"),
                       spark.createDataFrame([(1, " ".join(words))], "item_id bigint, text string")).collect()
    assert [(r.doc_id, r.start_word, r.n_words) for r in found] == [(1, 0, 70_000)]
    # 69,996 shingles each, of which the first 9 differ.
    assert found[0].similarity == pytest.approx(69_987 / (2 * 69_996 - 69_987))
