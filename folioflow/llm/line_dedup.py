"""Lines that many documents share, found with two Bloom filters.

The first pass keeps, per task, a filter of line keys seen once and one of keys seen again. Over
tasks they merge by ``twice = or(twice_i) | pairwise and(once_i, once_j)``, so no repeated key is
ever missed. Only lines whose key is in the merged second filter, suspected repeats, are shuffled,
as exact keys: a filter's false alarm is counted and let go. The filters' size follows the number
of lines up to ``max_bits``; beyond that more lines are suspected and the result is the same.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, functions as F

from folioflow.llm.common import map_texts, narrow
from folioflow.session import cut_lineage

BITS_PER_LINE = 8
MIN_BITS = 1 << 20
SEGMENT_BYTES = 1 << 14


def line_keys(text: bytes) -> list[bytes]:
    """A key per line: ASCII white space stripped at both ends, A-Z lower-cased."""
    return [line.strip() for line in text.lower().split(b"\n")]


def _positions(hashes: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    mask = np.uint64(bits - 1)
    return hashes & mask, (hashes >> np.uint64(32)) & mask


def _put(filter_: np.ndarray, hashes: np.ndarray) -> None:
    for at in _positions(hashes, filter_.size * 8):
        np.bitwise_or.at(filter_, at >> np.uint64(3), (1 << (at & np.uint64(7))).astype(np.uint8))


def _has(filter_: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    found = np.ones(len(hashes), bool)
    for at in _positions(hashes, filter_.size * 8):
        found &= ((filter_[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1).astype(bool)
    return found


def _hashes(keys: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, keys), np.uint64, len(keys))


def filter_bits(lines: int, max_bits: int) -> int:
    wanted = max(MIN_BITS, lines * BITS_PER_LINE)
    return min(max_bits, 1 << (wanted - 1).bit_length())


def _build(texts: DataFrame, bits: int, min_chars: int) -> DataFrame:
    """A pair of compressed segments per task and stretch of the filters."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        once, twice = np.zeros(bits // 8, np.uint8), np.zeros(bits // 8, np.uint8)
        empty = True
        for batch in batches:
            keys = [k for t in batch.column(0).cast(pa.binary()).to_pylist() for k in _document_keys(t, min_chars)]
            if not keys:
                continue
            empty = False
            found, counts = np.unique(_hashes(keys), return_counts=True)
            _put(twice, found[(counts > 1) | _has(once, found)])
            _put(once, found)
        if empty:
            return
        pack = zstandard.ZstdCompressor(level=1).compress
        for at in range(0, bits // 8, SEGMENT_BYTES):
            pair = [f[at:at + SEGMENT_BYTES].tobytes() for f in (once, twice)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([at // SEGMENT_BYTES], pa.int32()), *(pa.array([pack(p)]) for p in pair)],
                names=["segment", "once", "twice"],
            )

    return texts.mapInArrow(run, "segment int, once binary, twice binary")


def _merge(parts: DataFrame) -> DataFrame:
    """One row per segment. Rows stream through; a task holds one pair of segments at a time."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress
        current, once, twice = None, None, None

        def row():
            return pa.RecordBatch.from_arrays(
                [pa.array([current], pa.int32()), pa.array([twice.tobytes()])], names=["segment", "twice"],
            )

        for batch in batches:
            for segment, a, b in zip(*(c.to_pylist() for c in batch.columns)):
                a, b = (np.frombuffer(unpack(x), np.uint8) for x in (a, b))
                if segment != current:
                    if current is not None:
                        yield row()
                    current, once, twice = segment, a.copy(), b.copy()
                else:
                    twice |= b | (once & a)
                    once |= a
        if current is not None:
            yield row()

    return parts.repartition("segment").sortWithinPartitions("segment").mapInArrow(run, "segment int, twice binary")


def _document_keys(text: bytes, min_chars: int) -> set[bytes]:
    keys = set(line_keys(text))
    if min_chars <= 1:
        keys.discard(b"")
        return keys
    return {k for k in keys if k and len(k.decode("utf-8", "replace")) >= min_chars}


def suspected(docs: DataFrame, bits: int, min_chars: int) -> DataFrame:
    """``doc_id, content, key`` for each distinct key of a document that the second filter holds.

    The filter comes to the driver and goes to the executors: ``bits`` / 8 bytes, by parameter.
    """
    spark = docs.sparkSession
    merged = np.zeros(bits // 8, np.uint8)
    for segment, twice in _merge(_build(docs.select("text"), bits, min_chars)).toLocalIterator():
        merged[segment * SEGMENT_BYTES:(segment + 1) * SEGMENT_BYTES] = np.frombuffer(twice, np.uint8)
    held = spark.sparkContext.broadcast(merged)

    def run(texts: list[bytes]) -> dict:
        found = []
        for text in texts:
            keys = list(_document_keys(text, min_chars))
            hit = _has(held.value, _hashes(keys)) if keys else ()
            found.append([k.decode("utf-8", "replace") for k, h in zip(keys, hit) if h])
        return {"keys": pa.array(found, pa.list_(pa.string()))}

    rows = map_texts(docs.select("doc_id", F.sha2("text", 256).alias("content"), "text"), run,
                     "keys array<string>", as_bytes=True)
    return rows.select("doc_id", "content", F.explode("keys").alias("key"))


def drop_shared_lines(docs: DataFrame, min_documents: int = 10, min_chars: int = 1, keep: str = "none",
                      max_bits: int = 1 << 28, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, text, n_lines, n_dropped``: every row without the lines that many documents hold.

    A key of at least ``min_chars`` code points that is found in at least ``min_documents`` rows
    loses its lines: all of them, or with ``keep="first"`` all but the first one in the row with
    the smallest id (in each such row if the id is repeated; with only null ids, none is kept).
    Other lines stay as they are, joined by a line feed. Null and empty texts are one empty line.
    """
    if keep not in ("none", "first"):
        raise ValueError("keep is 'none' or 'first'")
    docs = narrow(docs, id_col, text_col)
    lines = docs.agg(F.sum(F.length("text") - F.length(F.replace("text", F.lit("\n"))) + 1)).first()[0] or 0
    found = cut_lineage(suspected(docs, filter_bits(lines, max_bits), min_chars))
    repeated = found.groupBy("key").agg(
        F.count(F.lit(1)).alias("rows"), F.min("doc_id").alias("first_id"),
    ).filter(F.col("rows") >= min_documents).drop("rows")
    # Equal texts lose equal lines, so what is dropped hangs on the text and not on the id.
    dropped = (
        found.select("content", "key").distinct().join(repeated, "key")
        .groupBy("content").agg(F.collect_list(F.struct("key", "first_id")).alias("repeated"))
    )
    joined = docs.withColumn("content", F.sha2("text", 256)).join(dropped, "content", "left")
    first = keep == "first"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0)
            texts = batch.column(1).cast(pa.binary()).to_pylist()
            kept, n_lines, n_dropped = [], [], []
            for doc_id, text, rows in zip(ids.to_pylist(), texts, batch.column(2).to_pylist()):
                gone = {r["key"].encode(): r["first_id"] for r in rows or ()}
                lines, stay, once = text.split(b"\n"), [], set()
                for line, key in zip(lines, line_keys(text) if gone else lines):
                    if not gone or key not in gone:
                        stay.append(line)
                    elif first and key not in once and doc_id is not None and gone[key] == doc_id:
                        once.add(key)
                        stay.append(line)
                kept.append(b"\n".join(stay))
                n_lines.append(len(lines))
                n_dropped.append(len(lines) - len(stay))
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(kept, pa.binary()).cast(pa.string()), pa.array(n_lines, pa.int64()),
                 pa.array(n_dropped, pa.int64())],
                names=["doc_id", "text", "n_lines", "n_dropped"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return joined.select("doc_id", "text", "repeated").mapInArrow(
        run, f"doc_id {kind}, text string, n_lines bigint, n_dropped bigint")
