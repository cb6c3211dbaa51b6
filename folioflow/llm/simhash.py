"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Two fingerprints that differ in at most r bits have a common neighbour within r/2 bits of both.
So every distinct fingerprint emits all variants within r/2 bits (65 at r = 2) and the variants
are shuffled; whoever meets in a variant is within r bits. A variant is met by at most as many
distinct fingerprints as there are masks, so no group grows with the data, and linking each
fingerprint to the one before it in its variant loses no connection.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from folioflow.llm import bloom
from folioflow.llm.common import map_texts, narrow, session, whole
from folioflow.llm.graph import components
from folioflow.session import cut_lineage

BITS = 64
# Fixed value: the seed of the shingle hash.
SEED = 42
_SLICE = 1 << 16


def shingle_hashes(text: bytes, words: int) -> np.ndarray:
    """XXH64 of every word shingle, repeats included; A-Z is lower-cased, words end at ASCII space."""
    tokens = text.lower().split()
    if not tokens:
        return np.empty(0, np.uint64)
    line = b" ".join(tokens)
    ends = np.cumsum(np.fromiter(map(len, tokens), np.int64, len(tokens)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = max(1, len(tokens) - words + 1)
    last = ends[words - 1:] if len(tokens) >= words else ends[-1:]
    digest = xxhash.xxh64_intdigest
    return np.fromiter(
        (digest(line[i:j], SEED) for i, j in zip(starts[:n].tolist(), last.tolist())), np.uint64, n,
    )


def majority(hashes: np.ndarray) -> int:
    """The bits set in more than half of the hashes, as a signed 64-bit number."""
    if not len(hashes):
        return 0
    counts = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), _SLICE):
        part = hashes[at:at + _SLICE].astype("<u8", copy=False)
        bits = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.uint32)
    return int(np.packbits(counts * 2 > len(hashes), bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, words: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, fp``. Fewer words than a shingle make one shingle; none give fingerprint zero."""
    def run(texts: list[bytes]) -> dict:
        return {"fp": np.fromiter((majority(shingle_hashes(t, words)) for t in texts), np.int64, len(texts))}

    return map_texts(narrow(docs, id_col, text_col), run, "fp bigint", as_bytes=True)


def _ball(fp: Column, radius: int) -> Column:
    """All variants of ``fp`` within ``radius`` flipped bits, itself included."""
    masks = [0]
    for n in range(1, radius + 1):
        masks += [sum(1 << b for b in bits) for bits in combinations(range(BITS), n)]
    signed = [m - (1 << BITS) if m >> (BITS - 1) else m for m in masks]
    return F.transform(F.lit(signed).cast("array<bigint>"), lambda m: fp.bitwiseXOR(m))


def links(fps: DataFrame, radius: int = 2) -> DataFrame:
    """Pairs ``a, b`` of distinct fingerprints within ``radius`` bits that connect all that are linked.

    Not every linked pair is a row: in each variant a fingerprint is linked to the next smaller one.
    """
    if radius < 2 or radius % 2:
        raise ValueError("the radius must be even: half of it is emitted on either side")
    variants = fps.select("fp").distinct().select("fp", F.explode(_ball(F.col("fp"), radius // 2)).alias("variant"))
    before = F.lag("fp").over(Window.partitionBy("variant").orderBy("fp"))
    met = variants.select("fp", before.alias("before")).filter("before IS NOT NULL")
    close = F.bit_count(F.col("fp").bitwiseXOR(F.col("before"))) <= radius
    return met.filter(close).select(F.col("before").alias("a"), F.col("fp").alias("b")).distinct()


def near_duplicates(docs: DataFrame, words: int = 3, radius: int = 2, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """``doc_id, fp, component_id``: one row per input row.

    Rows are linked when their fingerprints differ in at most ``radius`` bits; the component id is
    the smallest id that can be reached over links. Rows with a null id are linked like others and
    never name a component; a component of only such rows has a null id. Empty texts have
    fingerprint zero and are linked like any other. Repeated rows stay.
    """
    fps = cut_lineage(fingerprints(docs, words, id_col, text_col))
    roots = components(links(fps, radius)).select(F.col("node").alias("fp"), "root")
    least = fps.groupBy("fp").agg(F.min("doc_id").alias("least"))
    rooted = least.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    named = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    labels = cut_lineage(rooted.select("fp", "root").join(named, "root").select("fp", "component_id"))
    return fps.join(labels, "fp", "left").select("doc_id", "fp", "component_id")


def one_of_each(docs: DataFrame, words: int = 3, radius: int = 2, id_col: str = "doc_id",
                text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay when each component of near-duplicates keeps one, with all columns.

    Components are those of ``near_duplicates``. The row with the smallest id stays; rows with a null
    id come last, ties go to the smaller digest of the text and then of the row. Equal texts, all null
    and empty ones among them, are in one component.

    Ids, digests and fingerprints move; texts only of rows that are not alone in their component.
    """
    spark = session(docs.sparkSession)
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(whole(docs).alias("row"), F.col(id_col).alias("id"), text.alias("text"), F.sha2(text, 256).alias("content"))

    def run(texts: list[bytes]) -> dict:
        return {"fp": np.fromiter((majority(shingle_hashes(t, words)) for t in texts), np.int64, len(texts))}

    found = map_texts(rows.select("id", "content", "text"), run, "fp bigint", as_bytes=True)
    unlike = cut_lineage(found.groupBy("content").agg(
        F.min(F.struct(F.col("id").isNull().alias("none"), "id")).alias("first"),
        F.any_value("fp").alias("fp"), (F.count(F.lit(1)) > 1).alias("repeated")))
    roots = components(links(unlike, radius)).select(F.col("node").alias("fp"), "root")
    rooted = unlike.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    kept = rooted.groupBy("root").agg(
        F.min(F.struct("first", "content")).alias("kept"), (F.count(F.lit(1)) > 1).alias("many"))
    touched = cut_lineage(
        rooted.join(kept, "root").filter("repeated OR many")
        .select("content", (F.col("content") != F.col("kept.content")).alias("gone")))

    filter_ = bloom.build(touched.select(F.xxhash64("content").alias("h")))
    test = bloom.member(filter_, F.xxhash64("content"), spark.sparkContext)
    stays = rows.drop("text").withColumn("concerned", test)
    first = Window.partitionBy("content").orderBy(F.col("id").asc_nulls_last(), F.xxhash64("row"))
    left = stays.filter("concerned").join(touched, "content", "left").filter("gone IS NULL OR NOT gone")
    left = left.withColumn("nth", F.row_number().over(first)).filter("nth = 1")
    return stays.filter("NOT concerned").select("row.*").unionByName(left.select("row.*"))
