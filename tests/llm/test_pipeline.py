"""Every stage on the smallest tables, against what it says of itself."""

import gc

import pytest

import corpus_pipeline
from folioflow.llm import common, quality, queries, token_blocks
from folioflow.session import cut_lineage

SF = "/root/testdata/sf0.001"


def test_stages_in_a_row(spark, documents):
    docs = documents
    sizes = [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, SF))
        assert docs.columns == documents.columns and docs.dtypes == documents.dtypes, name
        sizes.append(docs.count())
    assert sizes[0] >= sizes[1] >= sizes[2] >= sizes[3] > 0
    tokens = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert sorted(r.doc_id for r in tokens.collect()) == sorted(r.doc_id for r in docs.collect())
    assert corpus_pipeline.run(spark, SF).exceptAll(tokens).count() == 0


def test_stages_take_odd_and_no_rows(spark, odd_docs):
    columns = corpus_pipeline.COLUMNS
    for docs in (odd_docs.select(*columns), odd_docs.select(*columns).limit(0)):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            docs = cut_lineage(stage(spark, docs, SF))
            assert docs.columns == columns
        corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()


def test_a_worker_keeps_the_words_of_one_operator(odd_docs):
    """Stages run in the same Python workers: what one has kept is gone when the next works."""
    text = " ".join(f"word{n}" for n in range(5000)).encode()

    def held(kind):
        gc.collect()
        return sum(len(o) for o in gc.get_objects() if type(o) is kind)

    quality.features(text)
    assert held(quality._Words) >= 5000
    token_blocks._encoder(queries.tokenizer_path()).encode(text)
    assert held(quality._Words) == 0 and held(token_blocks._Recent) >= 5000
    quality.features(text)
    assert held(token_blocks._Recent) == 0

    class Rows:
        schema = odd_docs.select("doc_id", "text").schema

        def mapInArrow(self, run, schema):
            return list(run(iter([])))

    # Near-dedup keeps no words of its own.
    common.map_texts(Rows(), lambda texts: {}, "fp bigint")
    assert held(quality._Words) == 0
