"""N-gram Jaccard join with a token-group matrix.

Texts are sets of word shingles; equal sets are one class. A set with a partner of similarity t misses
at most (1 - t) n of its tokens in it, so all but that many of its tokens with an even hash must be
held by others too. Which ones are is found by segments of the hashes, in lists of some four bytes a
token, and only sets that hold so many go on; nothing in this is bounded by a size, so it is as sharp
for a large input as for a small one.

Tokens of these are ordered so that rare tokens come first, by a filter of tokens seen again, whose
size follows their texts up to a bound, and a sketch of document frequencies: two sets of similarity t
share one of their first (1 - t) n + 1 tokens, and only classes that share one with another go on.

Similar classes are put into groups by common least hashes. A group keeps the union of its members'
tokens, its row in the token-group matrix, and a reference: the tokens of more than half of its
members. A query set meets a group if one of its rare tokens is one of the members'; the matrix
bounds how much of the query any member can hold, first by a quarter of the tokens, and only groups
that can hold t n tokens are opened. Into an opened group the query goes like a member: as its difference from the reference.

For sets A and B with differences a and b from a reference of c tokens, and the weight w of a
difference being what it removes plus t times what it adds, A and B have similarity t if and only if
(1 + t) |a & b| >= w(a) + w(b) - (1 - t) c. So a light difference is linked to the lightest one
without being compared with any other, and other pairs must share parts of their differences: copies
of one text, each with edits of its own, do not meet in the tokens that all of them have in common.
A difference first asks the lightest one that shares each of its tokens; what that has joined is not
compared again.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, Window, functions as F

from folioflow.llm import bloom, line_dedup
from folioflow.llm.common import map_texts, session
from folioflow.llm.graph import components
from folioflow.session import cut_lineage

# Bits of the filter of tokens seen again, by the length of the input up to the bound, and counters
# of the sketch of frequencies.
MAX_BITS = 1 << 28
SLOTS = 1 << 22
_STRETCH = 1 << 14
# Tokens with an even hash that a segment has about, of the whole input.
SEGMENT_TOKENS = 1 << 21
# Where similar classes meet: BANDS keys of BAND_ROWS least hashes.
BANDS, BAND_ROWS = 8, 3
_SEEDS = np.random.default_rng(13).integers(0, 1 << 63, (2, BANDS * BAND_ROWS), np.uint64)


class _WordHashes(dict):
    """XXH64 of words, kept for those met lately."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= 1 << 18:
            self.clear()
        self[word] = found = xxhash.xxh64_intdigest(word)
        return found


_WORDS = _WordHashes()


def tokens(text: bytes, words: int) -> np.ndarray:
    """The distinct shingles of a text, as ascending 64-bit hashes of their words' hashes."""
    found = text.lower().split()
    each = np.fromiter(map(_WORDS.__getitem__, found), np.uint64, len(found))
    n = max(1, len(each) - words + 1) if len(each) else 0
    whole = np.full(n, len(each[:words]), np.uint64)
    for k in range(min(words, len(each))):
        whole = (whole ^ each[k:k + n]) * np.uint64(0x9E3779B97F4A7C15)
        whole ^= whole >> np.uint64(29)
    return np.unique(whole)


def set_digest(found: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(found.tobytes())


def _counted(texts: DataFrame, words: int, bits: int) -> DataFrame:
    """Per task: segments of the filters of tokens seen once and seen again, under numbers from 0, and
    stretches of the counters, under numbers below 0."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        once, again = np.zeros(bits // 8, np.uint8), np.zeros(bits // 8, np.uint8)
        counts = np.zeros(SLOTS, np.uint32)
        for batch in batches:
            sets = [tokens(t, words) for t in batch.column(0).cast(pa.binary()).to_pylist()]
            found, held = np.unique(np.concatenate(sets), return_counts=True)
            line_dedup._put(again, found[(held > 1) | line_dedup._has(once, found)])
            line_dedup._put(once, found)
            np.add.at(counts, (found & np.uint64(SLOTS - 1)).astype(np.int64), held.astype(np.uint32))
        pack = zstandard.ZstdCompressor(level=1).compress
        size = line_dedup.SEGMENT_BYTES
        for at in range(0, bits // 8, size):
            if once[at:at + size].any():
                yield _part(at // size, pack(once[at:at + size].tobytes()), pack(again[at:at + size].tobytes()))
        for at in range(0, SLOTS, _STRETCH):
            if counts[at:at + _STRETCH].any():
                yield _part(-1 - at // _STRETCH, pack(counts[at:at + _STRETCH].tobytes()), b"")

    return texts.select("text").mapInArrow(run, "segment int, once binary, twice binary")


def _part(segment: int, once: bytes, twice: bytes) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([segment], pa.int32()), pa.array([once], pa.binary()), pa.array([twice], pa.binary())], names=["segment", "once", "twice"])


def _added(parts: DataFrame) -> DataFrame:
    """Sums of the counters as bit lengths, enough to order tokens by: one row per stretch."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress
        current, total = None, None

        def row() -> pa.RecordBatch:
            return _part(current, np.frexp(total.astype(float))[1].astype(np.uint8).tobytes(), b"")

        for batch in batches:
            for at, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                part = np.frombuffer(unpack(raw), np.uint32).astype(np.int64)
                if at != current:
                    if current is not None:
                        yield row()
                    current, total = at, part
                else:
                    total = total + part
        if current is not None:
            yield row()

    return parts.repartition("segment").sortWithinPartitions("segment").mapInArrow(run, "segment int, once binary, twice binary")


def _sketch(texts: DataFrame, words: int, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The filter of tokens that several documents hold, and how many hold those of each slot.
    ``bits`` / 8 and ``SLOTS`` bytes come to the driver."""
    parts = cut_lineage(_counted(texts, words, bits))
    again, levels = np.zeros(bits // 8, np.uint8), np.zeros(SLOTS, np.uint8)
    for segment, raw in line_dedup._merge(parts.filter("segment >= 0")).toLocalIterator():
        again[segment * line_dedup.SEGMENT_BYTES:][:len(raw)] = np.frombuffer(raw, np.uint8)
    for segment, raw, _ in _added(parts.filter("segment < 0")).toLocalIterator():
        levels[(-1 - segment) * _STRETCH:][:len(raw)] = np.frombuffer(raw, np.uint8)
    return again, levels


def rare_first(found: np.ndarray, sketch: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Tokens seen once, then others by how often, then by hash: one order for all texts."""
    again, levels = sketch
    level = line_dedup._has(again, found).astype(np.uint64) << np.uint64(5) | levels[(found & np.uint64(SLOTS - 1)).astype(np.int64)]
    # What the shift drops is kept by the stable sort: ``found`` ascends.
    return found[np.argsort(level << np.uint64(58) | found >> np.uint64(6), kind="stable")]


def band_keys(found: np.ndarray) -> np.ndarray:
    """``BANDS`` keys that sets of similarity s share with probability s ** BAND_ROWS each."""
    least = np.full(BANDS * BAND_ROWS, np.iinfo(np.uint64).max, np.uint64)
    factor, offset = _SEEDS[0][:, None] | np.uint64(1), _SEEDS[1][:, None]
    for at in range(0, len(found), 1024):
        least = np.minimum(least, (found[None, at:at + 1024] * factor + offset).min(axis=1))
    rows = least.reshape(BANDS, BAND_ROWS)
    return np.array([xxhash.xxh64_intdigest(r.tobytes(), n) for n, r in enumerate(rows)], np.uint64).view(np.int64)


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    """A list column of 64-bit numbers, hashes under their signed values."""
    lengths = np.fromiter(map(len, arrays), np.int64, len(arrays))
    flat = np.concatenate(arrays) if arrays else np.empty(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(lengths))), pa.int32()), pa.array(flat.view(np.int64)))


def _rows(column: pa.Array) -> list[np.ndarray]:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat, stops = column.values.to_numpy(zero_copy_only=False), column.offsets.to_numpy()
    return [flat[a:b] for a, b in zip(stops.tolist(), stops[1:].tolist())]


def _packed(numbers: np.ndarray) -> bytes:
    """32-bit numbers, their bytes laid out by place: high bytes of small ones cost nothing."""
    planes = np.ascontiguousarray(numbers, np.uint32).view(np.uint8).reshape(-1, 4).T
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def _unpacked(raw: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view(np.uint32).ravel()


def _listed(sets: list[np.ndarray], places: list[int], segments: int) -> list[dict]:
    """Even tokens of a batch by segment: 32 further bits of each, ascending, as steps, then whose they are."""
    flat, held_by = np.concatenate(sets), np.repeat(np.array(places, np.uint32), [len(s) for s in sets])
    even = flat & np.uint64(1) == 0
    keys = (flat[even] >> np.uint64(1) & np.uint64(segments - 1)) << np.uint64(32) | flat[even] >> np.uint64(32)
    order = np.argsort(keys)
    keys, held_by = keys[order], held_by[even][order]
    stops = np.searchsorted(keys, np.arange(segments + 1, dtype=np.uint64) << np.uint64(32))
    low = (keys & np.uint64(0xFFFFFFFF)).astype(np.uint32)
    return [{"segment": n, "packed": _packed(np.concatenate((np.diff(low[i:j], prepend=np.uint32(0)), held_by[i:j])))}
            for n, (i, j) in enumerate(zip(stops.tolist(), stops[1:].tolist())) if i < j]


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[tuple]]]:
    """Rows that follow each other with one value in the first column, without it."""
    current, held = None, []
    for batch in batches:
        for key, *rest in zip(*(c.to_pylist() for c in batch.columns)):
            if key != current and held:
                yield current, held
                held = []
            current = key
            held.append(tuple(rest))
    if held:
        yield current, held


def _summed(counts: dict[int, np.ndarray], key: int, more: np.ndarray) -> None:
    held = counts.get(key)
    if held is None or len(held) < len(more):
        held, more = more.astype(np.uint32), held
        counts[key] = held
    if more is not None:
        held[:len(more)] += more.astype(np.uint32)


def _shared(rows: DataFrame) -> DataFrame:
    """``batch, place, live``: how many of a set's even tokens other sets hold too, where any.

    A task takes whole segments, one at a time, and keeps a number for each row of the input.
    """
    lists = rows.filter("parts IS NOT NULL").select("batch", F.explode("parts").alias("part")).select(
        "part.segment", "batch", "part.packed")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[int, np.ndarray] = {}
        for _, held in _runs(batches):
            parts = [_unpacked(raw).reshape(2, -1) for _, raw in held]
            low = np.concatenate([np.cumsum(steps, dtype=np.uint64) for steps, _ in parts])
            # Sorted together with where they come from.
            both = np.sort(low << np.uint64(32) | np.arange(len(low), dtype=np.uint64))
            same = both[1:] >> np.uint64(32) == both[:-1] >> np.uint64(32)
            live = np.zeros(len(low), bool)
            live[(both[1:][same] & np.uint64(0xFFFFFFFF)).astype(np.int64)] = True
            live[(both[:-1][same] & np.uint64(0xFFFFFFFF)).astype(np.int64)] = True
            at = 0
            for (batch, _), (_, held_by) in zip(held, parts):
                _summed(counts, batch, np.bincount(held_by[live[at:at + len(held_by)]]))
                at += len(held_by)
        for batch, live in counts.items():
            yield pa.RecordBatch.from_arrays([pa.array([batch], pa.int64()), pa.array([_packed(live)], pa.binary())], names=["batch", "live"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, held in _runs(batches):
            counts: dict[int, np.ndarray] = {}
            for raw, in held:
                _summed(counts, batch, _unpacked(raw))
            places = np.flatnonzero(counts[batch])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(places), batch), pa.int64()), pa.array(places, pa.int32()), pa.array(counts[batch][places], pa.int32())],
                names=["batch", "place", "live"])

    counted = lists.repartition("segment").sortWithinPartitions("segment").mapInArrow(count, "batch bigint, live binary")
    return counted.repartition("batch").sortWithinPartitions("batch").mapInArrow(add, "batch bigint, place int, live int")


def _classes(docs: DataFrame, words: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """``doc_id, content, digest, n`` per row: the set's digest and size; and ``digest, n, content, least, near``
    per class: whether it may have a partner."""
    length = docs.agg(F.sum(F.length("text"))).first()[0] or 0
    # About six bytes for each word.
    segments = max(8, 1 << (length // (12 * SEGMENT_TOKENS)).bit_length())

    def run(texts: list[bytes]) -> dict:
        sets = [tokens(t, words) for t in texts]
        digests = [set_digest(s) for s in sets]
        # Equal sets of a batch are listed once.
        first: dict[bytes, int] = {}
        places = [first.setdefault(d, i) for i, d in enumerate(digests)]
        parts = _listed([sets[i] for i in first.values()], list(first.values()), segments)
        # Any partner holds at least t n of the n tokens, so it misses at most the others.
        need = [int(np.count_nonzero(s & np.uint64(1) == 0)) - len(s) - (-percent * len(s) // 100) for s in sets]
        listed = pa.array([parts] + [None] * (len(sets) - 1), pa.list_(pa.struct([("segment", pa.int32()), ("packed", pa.binary())])))
        return {"digest": pa.array(digests, pa.binary()), "n": pa.array([len(s) for s in sets], pa.int64()), "need": pa.array(need, pa.int64()),
                "batch": pa.array([uuid.uuid4().int >> 65] * len(sets), pa.int64()), "place": pa.array(places, pa.int32()), "parts": listed}

    rows = cut_lineage(map_texts(
        docs.select("doc_id", F.sha2("text", 256).alias("content"), "text"), run,
        "digest binary, n bigint, need bigint, batch bigint, place int, parts array<struct<segment:int,packed:binary>>", as_bytes=True))
    live = rows.select("doc_id", "content", "digest", "n", "need", "batch", "place").join(_shared(rows), ["batch", "place"], "left")
    classes = live.groupBy("digest").agg(
        F.any_value("n").alias("n"), F.min("content").alias("content"), F.min("doc_id").alias("least"),
        F.max((F.col("n") > 0) & (F.coalesce("live", F.lit(0)) >= F.col("need"))).alias("near"))
    return rows.select("doc_id", "content", "digest", "n"), cut_lineage(classes)


def _texts(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """``digest, text``: one text of each class in ``wanted`` (digest, content)."""
    filter_ = bloom.build(wanted.select(F.xxhash64("content").alias("h")))
    near = docs.select("text", F.sha2("text", 256).alias("content")).filter(
        bloom.member(filter_, F.xxhash64("content"), docs.sparkSession.sparkContext))
    # One text each before any moves: copies of one text may be a third of all rows.
    return cut_lineage(near.dropDuplicates(["content"]).join(wanted, "content").select("digest", "text"))


def _rarest(texts: DataFrame, words: int, percent: int) -> DataFrame:
    """``digest, rare``: the tokens of which a partner holds one, the rarest that there are."""
    length = texts.agg(F.sum(F.length("text"))).first()[0] or 0
    # About a byte for each word.
    held = texts.sparkSession.sparkContext.broadcast(_sketch(texts, words, line_dedup.filter_bits(length // 6, MAX_BITS)))

    def run(found: list[bytes]) -> dict:
        sets = [tokens(t, words) for t in found]
        return {"rare": _lists([rare_first(s, held.value)[:len(s) - -(-percent * len(s) // 100) + 1] for s in sets])}

    return cut_lineage(map_texts(texts, run, "rare array<bigint>", as_bytes=True))


def _live(classes: DataFrame) -> DataFrame:
    """``token, digest``: rare tokens that more than one class holds."""
    emitted = classes.select("digest", F.explode("rare").alias("token"))
    shared = emitted.groupBy("token").agg(F.count(F.lit(1)).alias("held")).filter("held > 1").select("token")
    return emitted.join(shared, "token")


def _sets(texts: DataFrame, words: int) -> DataFrame:
    """``digest, n, tokens, keys, node`` of the classes that have a text."""
    def run(found: list[bytes]) -> dict:
        sets = [tokens(t, words) for t in found]
        return {"n": pa.array([len(s) for s in sets], pa.int64()), "tokens": _lists([np.sort(s.view(np.int64)) for s in sets]),
                "keys": _lists([band_keys(s) for s in sets])}

    numbered = map_texts(texts, run, "n bigint, tokens array<bigint>, keys array<bigint>", as_bytes=True)
    return cut_lineage(numbered.withColumn("node", F.monotonically_increasing_id()))


def _grouped(sets: DataFrame) -> DataFrame:
    """``node, grp``: each class goes to the largest of its buckets, so that copies come together."""
    keys = sets.select("node", F.explode("keys").alias("key"))
    sizes = keys.groupBy("key").agg(F.count(F.lit(1)).alias("size"))
    return cut_lineage(keys.join(sizes, "key").groupBy("node").agg(F.max(F.struct("size", "key")).alias("best")).select(
        "node", F.col("best.key").alias("grp")))


def _matrix(sets: DataFrame, groups: DataFrame, tokens_: Column) -> DataFrame:
    """``grp, token, held``: the tokens of each group's members and how many of them hold each."""
    return sets.join(groups, "node").select("grp", F.explode(tokens_).alias("token")).groupBy("grp", "token").agg(
        F.count(F.lit(1)).alias("held"))


def _visits(sets: DataFrame, groups: DataFrame, rare: DataFrame, percent: int) -> DataFrame:
    """``node, grp`` of other groups that may hold a partner, by a quarter of the tokens.

    A set misses at most (1 - t) n of its tokens in any partner, so it misses no more of any share of
    them in the union of the partner's group. What meets in a rare token by chance misses most of a
    quarter of them, and goes no further than that.
    """
    rare_groups = rare.join(groups, "node")
    doors = rare_groups.select("token", "grp").distinct()
    met = rare_groups.select("node", "token", F.col("grp").alias("own")).join(doors, "token").filter("grp <> own")
    # Sets of too unlike sizes need no look at the matrix.
    sizes = groups.join(sets.select("node", "n"), "node").groupBy("grp").agg(F.min("n").alias("low"), F.max("n").alias("high"))
    met = met.select("node", "grp").distinct().join(sizes, "grp").join(sets.select("node", "n"), "node")
    met = cut_lineage(met.filter((F.col("n") * percent <= F.col("high") * 100) & (F.col("low") * percent <= F.col("n") * 100)).select("node", "grp", "n"))
    quarter = F.filter("tokens", lambda token: token.bitwiseAND(3) == 0)
    union = _matrix(sets, groups.join(met.select("grp").distinct(), "grp", "left_semi"), quarter).select("grp", "token")
    asked = cut_lineage(sets.join(met.select("node").distinct(), "node", "left_semi").select("node", quarter.alias("asked")))
    hits = met.select("node", "grp").join(asked, "node").select("node", "grp", F.explode("asked").alias("token")).join(
        union, ["grp", "token"]).groupBy("node", "grp").agg(F.count(F.lit(1)).alias("hits"))
    counted = met.join(asked.select("node", F.size("asked").alias("asked")), "node").join(hits, ["node", "grp"], "left")
    missed = F.col("asked") - F.coalesce("hits", F.lit(0))
    return cut_lineage(counted.filter(missed * 100 <= F.col("n") * (100 - percent)).select("node", "grp"))


def _opened(sets: DataFrame, groups: DataFrame, rare: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """``node, grp`` of every group that a class belongs to or has to visit, and the matrix of these
    groups. A class that is alone in its group and has no visitors needs neither."""
    met = _visits(sets, groups, rare, percent)
    several = groups.groupBy("grp").agg(F.count(F.lit(1)).alias("members")).filter("members > 1").select("grp")
    groups = cut_lineage(groups.join(several.unionByName(met.select("grp")).distinct(), "grp", "left_semi"))
    matrix = cut_lineage(_matrix(sets, groups, F.col("tokens")))
    # How much of the query the group's union holds: any member holds no more.
    held = (
        met.join(sets.select("node", "n", F.explode("tokens").alias("token")), "node").join(matrix, ["grp", "token"])
        .groupBy("node", "grp").agg(F.count(F.lit(1)).alias("overlap"), F.any_value("n").alias("n"))
    )
    qualified = held.filter(F.col("overlap") * 100 >= F.col("n") * percent).select("node", "grp")
    return cut_lineage(groups.select("node", "grp").unionByName(qualified)), matrix


def _differences(opened: DataFrame, sets: DataFrame, matrix: DataFrame, groups: DataFrame, percent: int) -> DataFrame:
    """``node, grp, weight, common, diff``: a set as its difference from the group's reference.

    Numbers are whole: ``weight`` is 100 times what is removed plus ``percent`` times what is added,
    ``common`` is 100 - ``percent`` times the reference's size.
    """
    sizes = groups.groupBy("grp").agg(F.count(F.lit(1)).alias("members"))
    # A reference has at most twice the tokens of its members' mean.
    middle = matrix.join(sizes, "grp").filter(F.col("held") * 2 > F.col("members")).groupBy("grp").agg(
        F.collect_list("token").alias("reference"))
    joined = opened.join(sets.select("node", "tokens"), "node").join(middle, "grp", "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, references, diffs, weights, common = _rows(batch.column(2)), batch.column(3), [], [], []
            for own, reference in zip(found, references):
                base = reference.values.to_numpy() if reference.is_valid else np.empty(0, np.int64)
                added, removed = np.setdiff1d(own, base, assume_unique=True), np.setdiff1d(base, own, assume_unique=True)
                diffs.append(np.sort(np.concatenate((added, removed))))
                weights.append(100 * len(removed) + percent * len(added))
                common.append((100 - percent) * len(base))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(weights, pa.int64()), pa.array(common, pa.int64()), _lists(diffs)],
                names=["node", "grp", "weight", "common", "diff"])

    return cut_lineage(joined.select("node", "grp", "tokens", "reference").mapInArrow(
        run, "node bigint, grp bigint, weight bigint, common bigint, diff array<bigint>"))


def _links(apart: DataFrame, percent: int) -> DataFrame:
    """Pairs ``a, b`` of similar classes that connect all that are linked within a group."""
    lightest = apart.groupBy("grp").agg(
        F.min(F.struct("weight", "node")).alias("least"), F.any_value("common").alias("common"), F.count(F.lit(1)).alias("rows"))
    lightest = cut_lineage(lightest.filter("rows > 1").select(
        "grp", F.col("least.weight").alias("least"), F.col("least.node").alias("lightest")))
    weighed = apart.join(lightest, "grp")
    near = F.col("weight") + F.col("least") <= F.col("common")
    light = weighed.filter(near & (F.col("node") != F.col("lightest"))).select(
        F.col("lightest").alias("a"), F.col("node").alias("b"))

    # Tokens that differences share, frequent ones first; a token is among the last ``s`` or it is rare
    # enough that a partner with ``s`` common tokens is met in it or before.
    parts = weighed.select("grp", "node", "weight", "least", "common", near.alias("light"), F.explode("diff").alias("token"))
    often = parts.groupBy("grp", "token").agg(F.count(F.lit(1)).alias("held")).filter("held > 1")
    order = Window.partitionBy("grp", "node").orderBy(F.col("held").desc(), "token")
    ranked = parts.join(often, ["grp", "token"]).withColumn("place", F.row_number().over(order))

    def needed(partner: Column) -> Column:
        """How many tokens a pair must share at least, times 100 + percent."""
        return F.greatest(F.lit(1), F.col("weight") + partner - F.col("common"))

    ranked = cut_lineage(ranked.select(
        "grp", "token", "node", "weight", "common", "light", "place",
        (F.col("place") * (100 + percent) >= needed(F.col("least"))).alias("asks"),
        (F.col("place") * (100 + percent) >= needed(F.col("weight"))).alias("answers")))
    diffs = apart.select("grp", "node", "diff")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            shared = [len(np.intersect1d(x, y, assume_unique=True)) for x, y in zip(_rows(batch.column(5)), _rows(batch.column(6)))]
            need = sum(batch.column(i).to_numpy() for i in (2, 3)) - batch.column(4).to_numpy()
            held = pa.array((100 + percent) * np.array(shared, np.int64) >= need)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(held)

    def linked(asking: DataFrame, answering: DataFrame, apart_by: str) -> DataFrame:
        """The heavier one asks. Two light ones hang together already. A pair meets in the rarest token
        that both hold if in any, and holds no more than the tokens up to it."""
        pairs = asking.join(answering, ["grp", "token"]).filter(
            f"(wa < wb OR wa = wb AND a < b) AND wa + wb > common AND NOT (la AND lb) AND {apart_by}"
            f" AND least(pa, pb) * {100 + percent} >= wa + wb - common").select("grp", "a", "b", "wa", "wb", "common").distinct()
        both = (
            pairs.join(diffs.select("grp", F.col("node").alias("a"), F.col("diff").alias("left")), ["grp", "a"])
            .join(diffs.select("grp", F.col("node").alias("b"), F.col("diff").alias("right")), ["grp", "b"])
        )
        return cut_lineage(both.select("a", "b", "wa", "wb", "common", "left", "right").mapInArrow(run, "a bigint, b bigint"))

    def sides(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
        ask = rows.filter("asks").select("grp", "token", F.col("node").alias("b"), "common", F.col("weight").alias("wb"),
                                         F.col("light").alias("lb"), F.col("place").alias("pb"), F.col("root").alias("rb"))
        answer = rows.filter("answers").select("grp", "token", F.col("node").alias("a"), F.col("weight").alias("wa"),
                                               F.col("light").alias("la"), F.col("place").alias("pa"), F.col("root").alias("ra"))
        return ask, answer

    # First each asks the lightest one that answers to a token; that joins most of what is to be joined.
    # Then only those that are not joined yet are compared with each other.
    asking, answering = sides(ranked.withColumn("root", F.col("node")))
    first = answering.groupBy("grp", "token").agg(F.min(F.struct("wa", "a", "la", "pa")).alias("one")).select("grp", "token", "one.*")
    near_links = cut_lineage(light.unionByName(linked(asking, first, "a <> b")))
    roots = components(near_links)
    asking, answering = sides(ranked.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node")))
    return near_links.unionByName(linked(asking, answering, "ra <> rb"))


def similar(docs: DataFrame, words: int = 3, percent: int = 90, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_shingles, digest, component_id``: one row per input row.

    A document's set are its distinct shingles of ``words`` words (A-Z lower-cased, words end at
    ASCII white space; with fewer words the whole sequence is one). Rows are linked if 100 times
    their common shingles are at least ``percent`` times those of either; the component id is the
    smallest id over links. Null and empty texts, and texts without words, have no set and are linked
    to nothing: each is its own component, under its own id. Equal sets are linked. Rows with a null
    id are linked like others and never name a component. Repeated rows stay. Shingles are told apart
    by 64-bit hashes.
    """
    if not 50 <= percent <= 100:
        raise ValueError("percent is 50 to 100")
    session(docs.sparkSession)
    docs = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows, classes = _classes(docs, words, percent)
    texts = _texts(docs, classes.filter("near").select("digest", "content"))
    rare = cut_lineage(_live(_rarest(texts, words, percent)))
    sets = _sets(texts.join(rare.select("digest").distinct(), "digest", "left_semi"), words)
    rare = cut_lineage(rare.join(sets.select("digest", "node"), "digest").select("node", "token"))
    groups = _grouped(sets)
    opened, matrix = _opened(sets, groups, rare, percent)
    roots = components(_links(_differences(opened, sets, matrix, groups, percent), percent))
    rooted = sets.select("digest", "node").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    named = classes.select("digest", "n", "least").join(rooted.select("digest", "root"), "digest", "left")
    components_ = named.filter("root IS NOT NULL").groupBy("root").agg(F.min("least").alias("component_id"))
    labels = cut_lineage(named.join(components_, "root", "left").select(
        "digest", F.when(F.col("root").isNull(), F.col("least")).otherwise(F.col("component_id")).alias("component_id")))
    return rows.select("doc_id", "n", "digest").join(labels, "digest").select(
        "doc_id", F.col("n").alias("n_shingles"), "digest",
        F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))
