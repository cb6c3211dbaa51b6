"""Phrases whose words occur together more often than apart, counted in counting quotient filters.

Texts become chunks of word numbers, each with its own small dictionary, and the dictionaries' words
are counted and numbered by a join: no vocabulary is held in one place. Only words, and for longer
phrases only word pairs, that are frequent enough themselves are counted further, since a phrase is
no more frequent than its parts; pairs are tested with a Bloom filter, whose false alarms are counted
and let go.

An n-gram of numbered words is a fixed number of bits. An invertible permutation spreads them evenly;
the top bits are the quotient, all others are the remainder, so nothing is lost. A task keeps its
n-grams as a filter sorted by quotient and remainder: a bit per quotient that occurs, a bit per entry
that ends a quotient's run, remainders in whole bytes, counters of one byte with exceptions. Filters
are cut into segments by the quotient's top bits, shuffled by segment, and merged.
"""

from __future__ import annotations

import re
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F

from folioflow.llm import bloom
from folioflow.llm.common import session
from folioflow.session import cut_lineage

# Words per chunk, entries of a task's filter, and entries aimed at per merged segment.
CHUNK_WORDS = 1 << 19
FILTER_ENTRIES = 1 << 20
SEGMENT_ENTRIES = 1 << 17

# Bytes that end a piece become a line feed, a tab becomes a blank.
_BREAKS = bytes.maketrans(b".,;:!?\x0b\x0c\r\t", b"\n" * 9 + b" ")
_TOKEN = re.compile(rb"[^ \n]+|\n")


def chunks(docs: DataFrame, lang_col: str = "lang", text_col: str = "text") -> DataFrame:
    """``chunk, lang, words, counts, places``: stretches of whole documents of one language. ``places``
    holds a 32-bit number per word, its place in ``words`` from 1, and 0 between pieces."""
    session(docs.sparkSession)
    rows = docs.select(F.coalesce(F.col(lang_col), F.lit("und")).alias("lang"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq = TaskContext.get().partitionId(), 0
        held: dict[str, list[bytes]] = {}

        def out(lang: str) -> pa.RecordBatch:
            nonlocal seq
            coded = pa.array(held.pop(lang), pa.binary()).dictionary_encode()
            words, places = coded.dictionary, coded.indices.to_numpy().astype(np.int64)
            names = np.array([w.as_py() != b"\n" for w in words], bool)
            # Breaks get number 0, words are numbered from 1 in the order of the dictionary.
            numbers = np.where(names, np.cumsum(names), 0)
            places = numbers[places]
            counts = np.bincount(places, minlength=int(names.sum()) + 1)[1:]
            seq += 1
            return pa.RecordBatch.from_arrays([
                pa.array([part << 32 | seq], pa.int64()), pa.array([lang]),
                pa.array([words.filter(pa.array(names)).cast(pa.string()).to_pylist()], pa.list_(pa.string())),
                pa.array([counts.tolist()], pa.list_(pa.int64())), pa.array([places.astype("<u4").tobytes()], pa.binary()),
            ], names=["chunk", "lang", "words", "counts", "places"])

        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist()):
                tokens = held.setdefault(lang, [])
                tokens += _TOKEN.findall(text.lower().translate(_BREAKS))
                tokens.append(b"\n")
                if len(tokens) >= CHUNK_WORDS:
                    yield out(lang)
            # Of many languages none may be long, all together are.
            while sum(map(len, held.values())) >= 2 * CHUNK_WORDS:
                yield out(max(held, key=lambda lang: len(held[lang])))
        for lang in list(held):
            yield out(lang)

    return rows.mapInArrow(run, "chunk bigint, lang string, words array<string>, counts array<bigint>, places binary")


def _numbered(words: DataFrame) -> DataFrame:
    """``words`` with ``id``, numbers from 1 without gaps: positions within parts, parts added up."""
    laid = cut_lineage(words.withColumn("part", F.spark_partition_id()).withColumn(
        "at", F.monotonically_increasing_id() % F.lit(1 << 33)))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = laid.groupBy("part").agg(F.count(F.lit(1)).alias("rows")).select(
        "part", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("before"))
    return cut_lineage(laid.join(F.broadcast(parts), "part").withColumn(
        "id", F.col("before") + F.col("at") + 1).drop("part", "at", "before"))


def _coded(stretches: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """``lang, ids``: every chunk's words under their numbers, 0 for breaks and words not numbered."""
    said = stretches.select("chunk", "lang", F.posexplode("words").alias("place", "word"))
    found = said.join(vocabulary.select("lang", "word", "id"), ["lang", "word"])
    own = found.groupBy("chunk").agg(F.collect_list("place").alias("at"), F.collect_list("id").alias("ids"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lang, n, places, at, ids in zip(*batch.columns):
                numbers = np.zeros(n.as_py() + 1, "<u4")
                if at.is_valid:
                    numbers[at.values.to_numpy() + 1] = ids.values.to_numpy()
                coded = numbers[np.frombuffer(places.as_buffer(), "<u4")]
                yield pa.RecordBatch.from_arrays([pa.array([lang.as_py()]), pa.array([coded.tobytes()], pa.binary())], names=["lang", "ids"])

    joined = stretches.select("chunk", "lang", F.size("words").alias("n"), "places").join(own, "chunk", "left")
    return cut_lineage(joined.select("lang", "n", "places", "at", "ids").mapInArrow(run, "lang string, ids binary"))


def _mixed(x: np.ndarray, seed: int) -> np.ndarray:
    x = (x ^ np.uint64(seed)) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xC2B2AE3D27D4EB4F)
    return x ^ (x >> np.uint64(32))


class Packing:
    """n-grams of word numbers below ``2 ** bits`` as two halves, permuted and back."""

    def __init__(self, n: int, bits: int):
        if bits > 32:
            raise ValueError("more than 2 ** 32 words")
        self.n, self.bits = n, bits
        self.left = (n + 1) // 2
        self.widths = (self.left * bits, (n - self.left) * bits)
        self.masks = tuple(np.uint64((1 << w) - 1) for w in self.widths)

    def _pack(self, words: list[np.ndarray]) -> np.ndarray:
        half = np.zeros(len(words[0]), np.uint64)
        for w in words:
            half = half << np.uint64(self.bits) | w
        return half

    def permuted(self, words: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        a, b = self._pack(words[:self.left]), self._pack(words[self.left:])
        for seed in (1, 3):
            a = a ^ (_mixed(b, seed) & self.masks[0])
            b = b ^ (_mixed(a, seed + 1) & self.masks[1])
        return a, b

    def words(self, a: np.ndarray, b: np.ndarray) -> list[np.ndarray]:
        for seed in (3, 1):
            b = b ^ (_mixed(a, seed + 1) & self.masks[1])
            a = a ^ (_mixed(b, seed) & self.masks[0])
        mask = np.uint64((1 << self.bits) - 1)
        out = []
        for half, count in ((a, self.left), (b, self.n - self.left)):
            out += [half >> np.uint64(self.bits * (count - 1 - i)) & mask for i in range(count)]
        return out


def merge(runs: list[tuple[np.ndarray, np.ndarray, np.ndarray]], packing: Packing) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct entries of several runs ``(a, b, counts)``, with the sums of their counts."""
    a, b, counts = (np.concatenate(c) for c in zip(*runs))
    low = packing.widths[1]
    if sum(packing.widths) <= 64:
        order = np.argsort(a << np.uint64(low) | b, kind="stable")
    else:
        order = np.lexsort((b, a))
    a, b, counts = a[order], b[order], counts[order]
    first = np.flatnonzero(np.concatenate(([True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])))[:len(a)])
    return a[first], b[first], np.add.reduceat(counts, first) if len(first) else counts


_HEADER = struct.Struct("<BII")


def _planes(values: np.ndarray, bits: int) -> bytes:
    """The low ``bits`` bits of each value, in whole bytes."""
    return values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :(bits + 7) // 8].tobytes()


def _values(raw: memoryview, count: int, bits: int) -> np.ndarray:
    width = (bits + 7) // 8
    out = np.zeros((count, 8), np.uint8)
    out[:, :width] = np.frombuffer(raw[:count * width], np.uint8).reshape(count, width)
    return out.reshape(-1).view("<u8").astype(np.uint64)


def encode_segment(a: np.ndarray, b: np.ndarray, counts: np.ndarray, packing: Packing, segment_bits: int) -> bytes:
    """Sorted distinct entries of one segment as a counting quotient filter."""
    width = packing.widths[0]
    inner = min(width - segment_bits, max(0, (len(a) - 1).bit_length()))
    rest = width - segment_bits - inner
    quotients = (a >> np.uint64(rest) & np.uint64((1 << inner) - 1)).astype(np.int64)
    occupied = np.zeros(1 << inner, bool)
    occupied[quotients] = True
    ends = np.concatenate((quotients[1:] != quotients[:-1], [True]))
    large = np.flatnonzero(counts >= 255)
    return b"".join((
        _HEADER.pack(inner, len(a), len(large)), np.packbits(occupied).tobytes(), np.packbits(ends).tobytes(),
        _planes(a & np.uint64((1 << rest) - 1), rest), _planes(b, packing.widths[1]),
        np.minimum(counts, 255).astype(np.uint8).tobytes(), counts[large].astype("<i8").tobytes()))


def decode_segment(raw: bytes, segment: int, packing: Packing, segment_bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    view = memoryview(raw)
    inner, n, n_large = _HEADER.unpack_from(view)
    rest = packing.widths[0] - segment_bits - inner
    sizes = [((1 << inner) + 7) // 8, (n + 7) // 8, n * ((rest + 7) // 8), n * ((packing.widths[1] + 7) // 8), n, n_large * 8]
    stops = np.cumsum([_HEADER.size, *sizes]).tolist()
    occupied, ends, low, b, counts, large = (view[x:y] for x, y in zip(stops, stops[1:]))
    quotients = np.flatnonzero(np.unpackbits(np.frombuffer(occupied, np.uint8), count=1 << inner))
    last = np.unpackbits(np.frombuffer(ends, np.uint8), count=n).astype(np.int64)
    run = np.cumsum(last) - last
    # The segment's number may take as many bits as a half has: shifts of 64 stay out.
    head = (np.uint64(segment) << np.uint64(inner) | quotients[run].astype(np.uint64))
    a = (head << np.uint64(rest) if rest < 64 else np.zeros(n, np.uint64)) | _values(low, n, rest)
    counts = np.frombuffer(counts, np.uint8).astype(np.int64)
    counts[counts == 255] = np.frombuffer(large, "<i8")
    return a, _values(b, n, packing.widths[1]), counts


def _pair_hash(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    return _mixed(first << np.uint64(32) | second, 11).view(np.int64)


def _counted(coded: DataFrame, orders: list[int], bits: int, total: int, min_count: int, pairs=None) -> DataFrame:
    """``lang, w, f, h`` of the n-grams of ``orders`` found ``min_count`` times and more. ``w`` are the
    words' numbers, ``h`` a hash of them. ``pairs``: a broadcast Bloom filter of word pairs, all of
    which an n-gram must hold."""
    packings = {n: Packing(n, bits) for n in orders}
    segment_bits = {n: min(p.widths[0], max(0, (total // SEGMENT_ENTRIES).bit_length())) for n, p in packings.items()}

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs: dict[tuple[str, int], list] = {}
        held = 0

        def out() -> Iterator[pa.RecordBatch]:
            for (lang, n), parts in runs.items():
                a, b, counts = merge(parts, packings[n])
                s, width = segment_bits[n], packings[n].widths[0]
                number = (a >> np.uint64(width - s)).astype(np.int64) if s else np.zeros(len(a), np.int64)
                edges = [0, *(np.flatnonzero(number[1:] != number[:-1]) + 1).tolist(), len(a)]
                found = [(int(number[i]), encode_segment(a[i:j], b[i:j], counts[i:j], packings[n], s))
                         for i, j in zip(edges, edges[1:]) if i < j]
                for at in range(0, len(found), 1000):
                    part = found[at:at + 1000]
                    yield pa.RecordBatch.from_arrays([
                        pa.array([lang] * len(part)), pa.array([n] * len(part), pa.int32()),
                        pa.array([p[0] for p in part], pa.int64()), pa.array([p[1] for p in part], pa.binary())],
                        names=["lang", "n", "segment", "filter"])
            runs.clear()

        for batch in batches:
            for lang, raw in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = np.frombuffer(raw.as_buffer(), "<u4").astype(np.uint64)
                both = (ids[:-1] > 0) & (ids[1:] > 0)
                if pairs is not None:
                    at = np.flatnonzero(both)
                    both[at] = bloom.holds(pairs.value, _pair_hash(ids[at], ids[at + 1]))
                for n in orders:
                    whole = both[:len(both) - n + 2].copy()
                    for k in range(1, n - 1):
                        whole &= both[k:len(both) - n + 2 + k]
                    at = np.flatnonzero(whole)
                    if not len(at):
                        continue
                    a, b = packings[n].permuted([ids[at + k] for k in range(n)])
                    run = merge([(a, b, np.ones(len(a), np.int64))], packings[n])
                    runs.setdefault((lang, n), []).append(run)
                    held += len(run[0])
                if held >= FILTER_ENTRIES:
                    yield from out()
                    held = 0
        yield from out()

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, runs, held = None, [], 0

        def out() -> Iterator[pa.RecordBatch]:
            lang, n, _ = current
            a, b, counts = merge(runs, packings[n])
            often = counts >= min_count
            words = packings[n].words(a[often], b[often])
            if not len(words[0]):
                return
            h = words[0]
            for w in words[1:-1]:
                h = _mixed(h, 7) ^ w
            yield pa.RecordBatch.from_arrays([
                pa.array([lang] * len(h)), pa.array(list(np.stack(words, 1).astype(np.int64)), pa.list_(pa.int64())),
                pa.array(counts[often], pa.int64()), pa.array(_pair_hash(h, words[-1]), pa.int64())], names=["lang", "w", "f", "h"])

        for batch in batches:
            for lang, n, segment, raw in zip(*(c.to_pylist() for c in batch.columns)):
                if (lang, n, segment) != current:
                    if runs:
                        yield from out()
                    current, runs, held = (lang, n, segment), [], 0
                runs.append(decode_segment(raw, segment, packings[n], segment_bits[n]))
                held += len(runs[-1][0])
                if held >= 2 * FILTER_ENTRIES:
                    runs = [merge(runs, packings[n])]
                    held = len(runs[0][0]) // 2
        if runs:
            yield from out()

    filters = coded.mapInArrow(cut, "lang string, n int, segment bigint, filter binary")
    dealt = filters.repartition("lang", "n", "segment").sortWithinPartitions("lang", "n", "segment")
    return cut_lineage(dealt.mapInArrow(join, "lang string, w array<bigint>, f bigint, h bigint"))


def _exact(c: Column) -> Column:
    return c.cast("decimal(20,0)")


def mine(docs: DataFrame, min_count: int = 30, max_words: int = 4, top: int = 2000, contained: int = 80,
         lang_col: str = "lang", text_col: str = "text") -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: each language's ``top`` phrases by score.

    Words are lower-cased (A-Z) runs without blank or tab within pieces that end at ``.,;:!?`` or at
    a line's end. A phrase of 2 to ``max_words`` words found ``a`` times, at least ``min_count``, is
    scored ``2000000 a div (l + r)`` by the cut into two parts found ``l`` and ``r`` times that scores
    least, the first such cut. Phrases within a longer one that is found at least ``contained``
    percent as often are dropped. ``n`` counts the language's words. Ranks go by score, then ``a``,
    then the phrase's bytes. A null language is ``und``; null and empty texts have no words; repeated
    rows count each; languages without phrases, and an empty table, give no rows.
    """
    if not 2 <= max_words <= 4:
        raise ValueError("phrases have 2 to 4 words")
    spark = docs.sparkSession
    stretches = cut_lineage(chunks(docs, lang_col, text_col))
    each = F.explode(F.arrays_zip("words", "counts")).alias("x")
    counted = stretches.select("lang", each).groupBy("lang", F.col("x.words").alias("word")).agg(F.sum("x.counts").alias("n"))
    counted = cut_lineage(counted.withColumn("often", F.col("n") >= min_count))
    totals = counted.groupBy("lang").agg(F.sum("n").alias("n"))
    vocabulary = _numbered(counted.filter("often").select("lang", "word", "n"))
    size = vocabulary.agg(F.count(F.lit(1)), F.sum("n")).first()
    bits, total = max(1, size[0].bit_length()), size[1] or 0
    coded = _coded(stretches, vocabulary)
    grams = _counted(coded, [2], bits, total, min_count)
    if max_words > 2:
        frequent = spark.sparkContext.broadcast(bloom.build(grams.select("h")))
        grams = cut_lineage(grams.unionByName(_counted(coded, list(range(3, max_words + 1)), bits, total, min_count, frequent)))
    grams = grams.select("lang", "w", "f")

    known = grams.select("w", "f").unionByName(vocabulary.select(F.array("id").alias("w"), F.col("n").alias("f")))
    cuts = grams.select("lang", "w", F.col("f").alias("a"), F.explode(F.sequence(F.lit(1), F.size("w") - 1)).alias("k"))
    cuts = cuts.withColumn("first", F.slice("w", F.lit(1), F.col("k"))).withColumn("rest", F.slice("w", F.col("k") + 1, F.size("w") - F.col("k")))
    sided = (
        cuts.join(known.select(F.col("w").alias("first"), F.col("f").alias("l")), "first")
        .join(known.select(F.col("w").alias("rest"), F.col("f").alias("r")), "rest"))
    score = F.expr("(CAST(2000000 AS DECIMAL(7,0)) * CAST(a AS DECIMAL(20,0))) div CAST(CAST(l AS DECIMAL(20,0)) + r AS DECIMAL(21,0))")
    scored = sided.groupBy("lang", "w", "a").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut"))

    spans = F.explode(F.expr(
        "flatten(transform(sequence(2, size(w) - 1), m -> transform(sequence(1, size(w) - m + 1), i -> slice(w, i, m))))"))
    within = grams.filter(F.size("w") > 2).select(spans.alias("w"), "f").groupBy("w").agg(F.max("f").alias("longer"))
    free = scored.join(within, "w", "left").filter(
        F.col("longer").isNull() | (_exact(F.col("longer")) * 100 < _exact(F.col("a")) * contained))
    best = Window.partitionBy("lang").orderBy(F.col("cut.score").desc(), F.col("a").desc())
    # Ties at the end stay until the words are known.
    near = cut_lineage(free.withColumn("place", F.rank().over(best)).filter(F.col("place") <= top)
                       .select("lang", "w", "a", "cut.score", "cut.l", "cut.r"))
    named = near.select("w", F.posexplode("w").alias("i", "id")).join(vocabulary.select("id", "word"), "id").groupBy("w").agg(
        F.sort_array(F.collect_list(F.struct("i", "word"))).alias("words"))
    phrased = near.join(named, "w").withColumn("phrase", F.array_join(F.transform("words", lambda x: x["word"]), " "))
    order = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), "phrase")
    ranked = phrased.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return ranked.join(totals, "lang").select(
        "lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", F.col("score").cast("bigint").alias("score"))
