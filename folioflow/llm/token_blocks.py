"""Token ids at rest as patched frame-of-reference blocks.

Ids are cut into blocks of 128. A block stores its least id, a bit width under which at least 90 %
of its differences to that id fit, all differences packed at that width, and the few that do not
fit in an exception list. An index of block starts in front of the blocks lets a reader decode any
document without the others.

A segment is one self-contained piece of bytes, little-endian:

    "PFB1"  u32 documents  u32 blocks  u64 ids
    i64 document id each, u8 "has an id" each, u32 ids per document each
    u32 start of each block, counted from the first block, and the end of the last
    blocks: u32 least id, u8 width, u8 exceptions, 16 * width bytes,
            u8 place of each exception, u32 difference of each exception

Segments are rows of Parquet files written by Spark's committer, in ascending document order:
``part, seq`` give the order, ``n_docs, n_tokens, first_id, last_id`` prune without opening one.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from folioflow.llm.common import let_go, narrow, stored
from folioflow.session import cut_lineage

BLOCK = 128
# The difference at this place of a sorted block must fit: 90 % of the block.
_FITS = 115
_MAGIC = b"PFB1"
_HEAD = 6
SEGMENT_IDS = 1 << 18
_WIDTHS = np.array([1 << b for b in range(32)], np.int64)


def _pack(delta: np.ndarray, width: int) -> np.ndarray:
    """Blocks' low ``width`` bits, value after value from the lowest bit up, as bytes."""
    values = np.ascontiguousarray(delta.T).astype(np.uint64) & np.uint64((1 << width) - 1)
    words = np.zeros((2 * width, values.shape[1]), np.uint64)
    for n in range(BLOCK):
        word, shift = divmod(n * width, 64)
        words[word] |= values[n] << np.uint64(shift)
        if shift + width > 64:
            words[word + 1] |= values[n] >> np.uint64(64 - shift)
    return np.ascontiguousarray(words.T).astype("<u8", copy=False).view(np.uint8)


def _unpack(packed: np.ndarray, width: int) -> np.ndarray:
    words = np.ascontiguousarray(np.ascontiguousarray(packed).view("<u8").T)
    out = np.empty((BLOCK, packed.shape[0]), np.uint64)
    for n in range(BLOCK):
        word, shift = divmod(n * width, 64)
        out[n] = words[word] >> np.uint64(shift)
        if shift + width > 64:
            out[n] |= words[word + 1] << np.uint64(64 - shift)
    return (out & np.uint64((1 << width) - 1)).T.astype(np.uint32)


def encode_blocks(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Block starts (with the end) and the blocks' bytes."""
    blocks = -(-len(ids) // BLOCK)
    if not blocks:
        return np.zeros(1, np.uint32), np.empty(0, np.uint8)
    padded = np.full(blocks * BLOCK, ids[-1], np.uint32)
    padded[:len(ids)] = ids
    padded = padded.reshape(blocks, BLOCK)
    base = padded.min(axis=1)
    delta = padded - base[:, None]
    fits = np.partition(delta, _FITS, axis=1)[:, _FITS]
    width = np.searchsorted(_WIDTHS, fits.astype(np.int64), side="right").astype(np.uint8)
    over = (delta.astype(np.uint64) >> width[:, None].astype(np.uint64)) != 0
    exceptions = over.sum(axis=1)
    sizes = _HEAD + 16 * width.astype(np.int64) + 5 * exceptions
    starts = np.concatenate(([0], np.cumsum(sizes)))
    out = np.empty(starts[-1], np.uint8)
    head = np.empty((blocks, _HEAD), np.uint8)
    head[:, :4] = base.astype("<u4").view(np.uint8).reshape(-1, 4)
    head[:, 4], head[:, 5] = width, exceptions
    out[starts[:-1, None] + np.arange(_HEAD)] = head
    for w in np.unique(width):
        rows = np.flatnonzero(width == w)
        if w:
            out[starts[rows, None] + _HEAD + np.arange(16 * int(w))] = _pack(delta[rows], int(w))
    row, place = np.nonzero(over)
    if len(row):
        nth = np.arange(len(row)) - np.concatenate(([0], np.cumsum(exceptions)))[row]
        lists = starts[row] + _HEAD + 16 * width[row].astype(np.int64)
        out[lists + nth] = place
        values = delta[row, place].astype("<u4").view(np.uint8).reshape(-1, 4)
        out[(lists + exceptions[row] + 4 * nth)[:, None] + np.arange(4)] = values
    return starts.astype(np.uint32), out


def decode_blocks(starts: np.ndarray, data: np.ndarray) -> np.ndarray:
    """All ids of the blocks that start at ``starts``, the last block's padding included."""
    starts = starts.astype(np.int64)
    if not len(starts):
        return np.empty(0, np.uint32)
    head = data[starts[:, None] + np.arange(_HEAD)]
    base = np.ascontiguousarray(head[:, :4]).view("<u4")[:, 0]
    width, exceptions = head[:, 4], head[:, 5].astype(np.int64)
    delta = np.zeros((len(starts), BLOCK), np.uint32)
    for w in np.unique(width):
        rows = np.flatnonzero(width == w)
        if w:
            delta[rows] = _unpack(data[starts[rows, None] + _HEAD + np.arange(16 * int(w))], int(w))
    row = np.repeat(np.arange(len(starts)), exceptions)
    if len(row):
        nth = np.arange(len(row)) - np.concatenate(([0], np.cumsum(exceptions)))[row]
        lists = starts[row] + _HEAD + 16 * width[row].astype(np.int64)
        values = data[(lists + exceptions[row] + 4 * nth)[:, None] + np.arange(4)]
        delta[row, data[lists + nth]] = np.ascontiguousarray(values).view("<u4")[:, 0]
    return (delta + base[:, None]).ravel()


def encode_segment(doc_ids: list, lengths: list[int], ids: np.ndarray) -> bytes:
    starts, blocks = encode_blocks(ids)
    head = np.array([len(doc_ids), len(starts) - 1], "<u4").tobytes() + np.array([len(ids)], "<u8").tobytes()
    known = np.array([0 if d is None else d for d in doc_ids], "<i8").tobytes()
    has = np.array([d is not None for d in doc_ids], np.uint8).tobytes()
    return b"".join((_MAGIC, head, known, has, np.array(lengths, "<u4").tobytes(),
                     starts.astype("<u4").tobytes(), blocks.tobytes()))


class Segment:
    """A reader over one segment's bytes."""

    def __init__(self, raw: bytes):
        if raw[:4] != _MAGIC:
            raise ValueError("not a segment")
        docs, blocks = np.frombuffer(raw, "<u4", 2, 4).tolist()
        self.n_ids = int(np.frombuffer(raw, "<u8", 1, 12)[0])
        at = 20
        known = np.frombuffer(raw, "<i8", docs, at)
        has = np.frombuffer(raw, np.uint8, docs, at + 8 * docs)
        self.doc_ids = [d if h else None for d, h in zip(known.tolist(), has.tolist())]
        self.lengths = np.frombuffer(raw, "<u4", docs, at + 9 * docs).astype(np.int64)
        self.ends = np.cumsum(self.lengths)
        at += 13 * docs
        self.starts = np.frombuffer(raw, "<u4", blocks + 1, at)
        self.data = np.frombuffer(raw, np.uint8, offset=at + 4 * (blocks + 1))

    def all_ids(self) -> np.ndarray:
        return decode_blocks(self.starts[:-1], self.data)[:self.n_ids]

    def document(self, n: int) -> np.ndarray:
        """The ids of the n-th document, from its own blocks only."""
        first, last = int(self.ends[n] - self.lengths[n]), int(self.ends[n])
        if first == last:
            return np.empty(0, np.uint32)
        low = first // BLOCK
        ids = decode_blocks(self.starts[low:-(-last // BLOCK)], self.data)
        return ids[first - low * BLOCK:last - low * BLOCK]


# A chunk between white space of only these letters and this punctuation is two pieces to the
# tokenizer: the letters in lower case and the punctuation. ASCII and Latin-1 letters are already
# composed; the apostrophe is left out because it may start a contraction.
_LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
_PLAIN = re.compile(f"([{_LETTERS}]+)([!-&(-/:-@\\[-`{{-~]*)")
# Just under what a dict of 2 ** 19 places takes: with more its table is twice as large.
_CACHED = 340_000


class _Recent(dict):
    """Worked out on a miss and kept: two generations, of which the older goes when the newer is full.
    A worker's two stores stay below some 200 MB."""

    def __init__(self, work):
        super().__init__()
        self.work, self.older = work, {}

    def __missing__(self, key):
        value = self.older.get(key)
        if value is None:
            value = self.work(key)
        if len(self) >= _CACHED:
            self.older = dict(self)
            self.clear()
        self[key] = value
        return value


class ChunkEncoder:
    """The tokenizer's ids of a text, chunk by chunk.

    For a tokenizer that drops white space and never looks across it, a text's ids are those of
    its chunks between ASCII white space, one after the other. Texts repeat their words, so chunks
    and their pieces are encoded once and kept, up to a bound. A plain piece goes to the
    tokenizer's model directly, spelled as its pre-tokenizer spells it; any other chunk goes
    through the whole tokenizer.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        spell = self.tokenizer.pre_tokenizer.pre_tokenize_str
        self.spelling = {c: spell(chr(c))[0][0] for c in (*range(0x21, 0x7F), *range(0xC0, 0x100))}
        self.ascii_as_is = all(self.spelling[c] == chr(c) for c in range(0x21, 0x7F))
        size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.id_bytes = [i.to_bytes(4, "little") for i in range(size)]
        self.chunks, self.pieces = _Recent(self._chunk), _Recent(self._piece)

    def _piece(self, piece: str) -> bytes:
        if not piece:
            return b""
        spelt = piece if self.ascii_as_is and piece.isascii() else piece.translate(self.spelling)
        known = self.id_bytes
        return b"".join([known[t.id] if t.id < len(known) else t.id.to_bytes(4, "little") for t in self.model.tokenize(spelt)])

    def _chunk(self, chunk: bytes) -> bytes:
        text = chunk.decode()
        plain = _PLAIN.fullmatch(text)
        if plain:
            return self.pieces[plain[1].lower()] + self.pieces[plain[2]]
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def encode(self, text: bytes) -> bytes:
        """Little-endian unsigned 32-bit ids."""
        return b"".join(map(self.chunks.__getitem__, text.split()))


def _encoder(path: str) -> ChunkEncoder:
    return stored(("chunk encoder", path), lambda: ChunkEncoder(path))


SEGMENTS = "part int, seq int, n_docs int, n_tokens bigint, first_id bigint, last_id bigint, segment binary"


def encode(docs: DataFrame, tokenizer: str, end_id: int = 1, id_col: str = "doc_id",
           text_col: str = "text") -> DataFrame:
    """Segments of all documents in ascending id order, nulls first and ties by text.

    ``tokenizer`` is the path of a tokenizer file every executor can open, of a tokenizer that
    drops white space; ``end_id`` is appended to each document. Null and empty texts are the end
    id alone. A segment holds whole documents, about ``SEGMENT_IDS`` ids.
    """
    docs = narrow(docs, id_col, text_col).withColumn("doc_id", F.col("doc_id").cast("bigint"))
    # The last key parts rows that share an id and a text.
    spread = docs.withColumn("last", F.monotonically_increasing_id()).repartitionByRange(
        "doc_id", F.xxhash64("text"), "last")
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part, seq = _encoder(tokenizer), TaskContext.get().partitionId(), 0
        ids, lengths, pieces, held = [], [], [], 0

        def row():
            values = np.frombuffer(b"".join(pieces), "<u4")
            known = [i for i in ids if i is not None] or [None]
            columns = [part, seq, len(ids), len(values), known[0], known[-1], encode_segment(ids, lengths, values)]
            kinds = [pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
            return pa.RecordBatch.from_arrays(
                [pa.array([c], k) for c, k in zip(columns, kinds)],
                names=["part", "seq", "n_docs", "n_tokens", "first_id", "last_id", "segment"],
            )

        for batch in batches:
            texts = batch.column(1).cast(pa.binary())
            for doc_id, text in zip(batch.column(0).to_pylist(), texts.to_pylist()):
                piece = encoder.encode(text) + end
                ids.append(doc_id)
                lengths.append(len(piece) // 4)
                pieces.append(piece)
                held += lengths[-1]
                if held >= SEGMENT_IDS:
                    yield row()
                    ids, lengths, pieces, held, seq = [], [], [], 0, seq + 1
        if ids:
            yield row()

    sorted_ = spread.sortWithinPartitions("doc_id", F.xxhash64("text"), "last").select("doc_id", "text")
    return sorted_.mapInArrow(run, SEGMENTS)


def write(docs: DataFrame, path: str, tokenizer: str, end_id: int = 1, id_col: str = "doc_id",
          text_col: str = "text") -> None:
    encode(docs, tokenizer, end_id, id_col, text_col).write.parquet(path)


def read(segments: DataFrame) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document, decoded from its segment's blocks.

    ``start`` counts the ids of all documents before it. The order of the parts is worked out from
    one row per part.
    """
    whole = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    inside = Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    places = segments.select("part", "seq", "n_tokens")
    parts = places.groupBy("part").agg(F.sum("n_tokens").alias("n")).select(
        "part", F.coalesce(F.sum("n").over(whole), F.lit(0)).alias("part_start"))
    starts = cut_lineage(
        places.withColumn("inside", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0))).join(parts, "part")
        .select("part", "seq", (F.col("part_start") + F.col("inside")).alias("segment_start"))
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        for batch in batches:
            for at, raw in zip(batch.column(0).to_pylist(), batch.column(1)):
                segment = Segment(raw.as_py())
                ids = segment.all_ids().astype("<u4").tobytes()
                ends = segment.ends * 4
                first = ends - segment.lengths * 4
                yield pa.RecordBatch.from_arrays(
                    [pa.array(segment.doc_ids, pa.int64()), pa.array(at + first // 4, pa.int64()),
                     pa.array(segment.lengths, pa.int64()),
                     pa.array([zlib.crc32(ids[a:b]) for a, b in zip(first.tolist(), ends.tolist())], pa.int64())],
                    names=["doc_id", "start", "n_tokens", "ids_crc32"],
                )

    joined = segments.join(starts, ["part", "seq"]).select("segment_start", "segment")
    return joined.mapInArrow(run, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")
