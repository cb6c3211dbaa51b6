from collections import Counter

import numpy as np
import pytest

from folioflow.llm import hilbert


@pytest.mark.parametrize("dims, bits", [(2, 4), (3, 3), (4, 2)])
def test_curve_visits_every_cell_stepwise(dims, bits):
    cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims, indexing="ij"), -1).reshape(-1, dims)
    index = hilbert.hilbert_index(cells, bits)
    assert sorted(index) == list(range(len(cells)))
    path = cells[np.argsort(index)]
    assert (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()


@pytest.mark.parametrize("law", hilbert.LAWS)
def test_every_row_has_a_place(odd_docs, documents, law):
    for df in (odd_docs, documents):
        rows = hilbert.shard(df, ["source", "lang", "n_chars"], shards=8, law=law).collect()
        assert sorted(repr(r.row.doc_id) for r in rows) == sorted(repr(r.doc_id) for r in df.collect())
        slots = {}
        for r in rows:
            assert r.size == len((r.row.text or "").encode()) + 1
            slots.setdefault(r.shard, []).append(r.slot)
        assert all(sorted(s) == list(range(len(s))) for s in slots.values())
        counts, sizes = Counter(r.shard for r in rows), Counter()
        for r in rows:
            sizes[r.shard] += r.size
        if law == "rows":
            assert max(counts.values()) - min(counts[s] for s in range(8)) <= 1
        else:
            whole, largest = sum(sizes.values()), max(r.size for r in rows)
            assert all(abs(sizes[s] - whole / 8) <= largest for s in range(8))


def test_shards_are_runs_of_the_curve(documents):
    dims = ["source", "n_chars"]
    rows = hilbert.shard(documents, dims, shards=4).collect()
    index = {r.doc_id: r.curve for r in hilbert.with_curve_index(documents, dims, 6, "curve").collect()}
    ordered = [index[r.row.doc_id] for r in sorted(rows, key=lambda r: (r.shard, r.slot))]
    assert ordered == sorted(ordered)


def test_manifest_and_files(spark, documents, tmp_path):
    dims = ["source", "n_chars"]
    sharded = hilbert.shard(documents, dims, shards=4)
    listed = {r.shard: r for r in hilbert.manifest(sharded, dims).collect()}
    hilbert.write_shards(sharded, str(tmp_path / "shards"))
    back = spark.read.parquet(str(tmp_path / "shards"))
    assert back.count() == documents.count() == sum(r.rows for r in listed.values())
    for r in back.groupBy("__shard").agg({"n_chars": "max"}).collect():
        assert listed[r["__shard"]].max_n_chars == r["max(n_chars)"]


def test_empty_table(no_docs):
    assert hilbert.shard(no_docs, ["source", "n_chars"]).count() == 0
    assert hilbert.shard(no_docs, ["source", "n_chars"], law="bytes").count() == 0
