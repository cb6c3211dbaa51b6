import random
import zlib

import numpy as np
import pytest

from folioflow.llm import token_blocks as tb
from folioflow.llm.queries import tokenizer_path


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer_path())


@pytest.mark.parametrize("high", [1, 2, 50_000, 2**31, 2**32])
@pytest.mark.parametrize("n", [0, 1, 127, 128, 129, 5000])
def test_blocks_round_trip(high, n):
    rng = np.random.default_rng(n)
    ids = rng.integers(0, high, n, dtype=np.uint64).astype(np.uint32)
    ids[rng.random(n) < 0.03] = high - 1
    starts, data = tb.encode_blocks(ids)
    assert len(starts) == -(-n // 128) + 1 and starts[-1] == len(data)
    assert (tb.decode_blocks(starts[:-1], data)[:n] == ids).all()


def test_outliers_go_to_the_exception_list():
    ids = np.full(128, 7, np.uint32)
    ids[5] = 4_000_000_000
    _, data = tb.encode_blocks(ids)
    assert data[4] == 0 and data[5] == 1 and len(data) == 6 + 5


def test_single_documents_of_a_segment():
    rng = np.random.default_rng(0)
    lengths = [1, 0, 300, 128, 5, 1000]
    ids = rng.integers(0, 49_408, sum(lengths)).astype(np.uint32)
    segment = tb.Segment(tb.encode_segment([5, None, 7, 8, 9, 10], lengths, ids))
    at = 0
    assert segment.doc_ids == [5, None, 7, 8, 9, 10]
    for n, length in enumerate(lengths):
        assert (segment.document(n) == ids[at:at + length]).all()
        at += length


def test_chunks_give_the_tokenizers_ids(tokenizer, documents):
    encoder = tb.ChunkEncoder(tokenizer_path())
    random.seed(4)
    letters = "aAbzZéÉßñÀ'’.,!?<|>0 1\n\t ́İﬁ字😀\x1c\x85-_#*$%&|st re ve"
    texts = ["".join(random.choice(letters) for _ in range(random.randint(0, 40))) for _ in range(3000)]
    texts += ["it's don't we'll", "<|endoftext|>", "a<|startoftext|>b", "é ́e"]
    texts += [r.text for r in documents.collect()]
    for text in texts:
        got = np.frombuffer(encoder.encode(text.encode()), "<u4").tolist()
        assert got == tokenizer.encode(text, add_special_tokens=False).ids, text


def plain(df, tokenizer):
    rows = sorted(((r.doc_id is not None, r.doc_id or 0, r.text or "") for r in df.collect()))
    out, at = [], 0
    for has, doc_id, text in rows:
        ids = tokenizer.encode(text, add_special_tokens=False).ids + [1]
        out.append((doc_id if has else None, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    return sorted(map(repr, out))


def test_files_hold_every_document(odd_docs, no_docs, documents, tokenizer, spark, tmp_path):
    for n, df in enumerate((documents, odd_docs, no_docs)):
        tb.write(df, str(tmp_path / str(n)), tokenizer_path())
        got = tb.read(spark.read.parquet(str(tmp_path / str(n)))).collect()
        assert sorted(repr(tuple(r)) for r in got) == plain(df, tokenizer)


def test_words_are_encoded_once(tokenizer):
    """Some 200,000 words that come again are not handed to the tokenizer a second time."""
    encoder = tb.ChunkEncoder(tokenizer.path if hasattr(tokenizer, "path") else tokenizer_path())
    text = " ".join("".join(chr(97 + n // 26 ** k % 26) for k in range(4)) for n in range(200_000)).encode()
    first = encoder.encode(text)
    asked = []
    for store in (encoder.chunks, encoder.pieces):
        store.work = asked.append
    assert encoder.encode(text) == first and not asked
