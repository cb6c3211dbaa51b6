from collections import Counter

import numpy as np
import pytest

from folioflow.llm import line_dedup


def key(line):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(" \t\n\r\x0b\x0c"))


def plain(rows, min_documents):
    seen = Counter(k for _, t in rows for k in {key(x) for x in (t or "").split("\n")} if k)
    out = []
    for doc_id, text in rows:
        lines = (text or "").split("\n")
        stay = [x for x in lines if seen[key(x)] < min_documents]
        out.append((doc_id, "\n".join(stay), len(lines), len(lines) - len(stay)))
    return sorted(map(repr, out))


@pytest.mark.parametrize("min_documents", [2, 10])
def test_against_plain(odd_docs, documents, min_documents):
    for df in (odd_docs, documents):
        rows = [(r.doc_id, r.text) for r in df.collect()]
        got = sorted(repr(tuple(r)) for r in line_dedup.drop_shared_lines(df, min_documents).collect())
        assert got == plain(rows, min_documents)


def test_full_filters_change_nothing(odd_docs, monkeypatch):
    """With filters far too small everything is suspected; the exact count decides."""
    monkeypatch.setattr(line_dedup, "MIN_BITS", 1 << 17)
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()]
    monkeypatch.setattr(line_dedup, "_has", lambda f, h: np.ones(len(h), bool))
    got = sorted(repr(tuple(r)) for r in line_dedup.drop_shared_lines(odd_docs, 10, max_bits=1 << 17).collect())
    assert got == plain(rows, 10)


def test_first_occurrence_stays(odd_docs):
    kept = {r.doc_id: r.text for r in line_dedup.drop_shared_lines(odd_docs, 10, keep="first").collect()}
    assert kept[1] == "One line\nshared line \nlast"
    assert kept[100] == "own text 0\nOther 0"


def test_long_keys_only(odd_docs):
    kept = {r.doc_id: r.text for r in line_dedup.drop_shared_lines(odd_docs, 10, min_chars=12).collect()}
    assert kept[1] == "One line\nshared line \nlast"


def test_empty_table(no_docs):
    assert line_dedup.drop_shared_lines(no_docs).count() == 0


def test_filter_follows_the_lines():
    assert line_dedup.filter_bits(10, 1 << 28) == line_dedup.MIN_BITS
    assert line_dedup.filter_bits(1_000_000, 1 << 28) == 1 << 23
    assert line_dedup.filter_bits(10**9, 1 << 28) == 1 << 28
