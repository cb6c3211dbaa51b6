"""Quality rules: counts of a text's words, symbols and repeats, and a perplexity band per language.

The language model is an interpolated modified Kneser-Ney model over characters, of order four. A
character is one of 64 symbols, so a four-gram is an exact 24-bit key: counts are whole numbers
over all documents, there are no collisions, and no model exceeds 2 ** 24 entries an order. Tasks
count their own n-grams, Spark sums them and works out discounts, context weights and probabilities
with joins; the result is kept per order as an array of sorted keys and one of values beside it.

Four of the symbols stand for many characters: other letters, capitals, digits and the rest. Which
one a character is, is the second factor of its probability: a Kneser-Ney model of order three over
whole code points, given the symbol and the two code points before. Its n-grams are exact 63-bit
keys and grow with the input, so its table stays in Spark: tasks hold the most common n-grams, the
others are looked up by a join. So each character counts as what it is, whatever its script.

A document is rejected if its bits per character are far from the usual of its language: below or
above the median by more than so many times the spread between the quartiles.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from folioflow.llm.common import map_texts, narrow
from folioflow.session import cut_lineage

ORDER = 4
_BITS = 6
# Characters with a symbol of their own. Before them come the start of a text, other
# letters in lower case, capitals, digits, and everything else.
LISTED = "abcdefghijklmnopqrstuvwxyz \n.,;:!?'\"-()|#$%&*/äöüßéèêçñíó"
_OTHER_LOWER, _CAPITAL, _DIGIT, _ELSE, _FIRST_LISTED = 1, 2, 3, 4, 5
SYMBOLS = _FIRST_LISTED + len(LISTED)
_SLICE = 1 << 21
MEMBER_ORDER = 3
_POINT_BITS = 21
# Of a text's n-grams over code points, those among so many most common are known to every task.
_COMMON = 1 << 20


@lru_cache(maxsize=1)
def _table() -> np.ndarray:
    table = np.empty(0x110000, np.uint8)
    for code in range(0x110000):
        c = chr(code)
        table[code] = _CAPITAL if c.isupper() else _DIGIT if c.isdigit() else _OTHER_LOWER if c.isalpha() else _ELSE
    for n, c in enumerate(LISTED):
        table[ord(c)] = _FIRST_LISTED + n
    for c in "\t\r\x0b\x0c":
        table[ord(c)] = table[ord(" ")]
    return table


def keys_of(text: str) -> np.ndarray:
    """A 24-bit key per character: its symbol after those of the three before it."""
    if not text:
        return np.empty(0, np.int32)
    symbols = _table()[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)].astype(np.int32)
    padded = np.concatenate((np.zeros(ORDER - 1, np.int32), symbols))
    key = padded[:len(symbols)]
    for n in range(1, ORDER):
        key = (key << _BITS) | padded[n:n + len(symbols)]
    return key


def members_of(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Of each character that shares its symbol: the symbol, and a 63-bit key, its code point after
    the two before it (0 before the text)."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    symbols = _table()[points]
    at = np.flatnonzero(symbols < _FIRST_LISTED)
    padded = np.concatenate((np.zeros(MEMBER_ORDER - 1, np.int64), points))
    key = padded[at]
    for n in range(1, MEMBER_ORDER):
        key = (key << _POINT_BITS) | padded[at + n]
    return symbols[at].astype(np.int32), key


def count_members(texts: DataFrame) -> DataFrame:
    """``symbol, key, c`` over all texts, for characters that share their symbol."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def summed():
            keys, first, counts = np.unique(np.concatenate([k for _, k in held]), return_index=True, return_counts=True)
            symbols = np.concatenate([s for s, _ in held])[first]
            for at in range(0, len(keys), 100_000):
                part = slice(at, at + 100_000)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(symbols[part]), pa.array(keys[part]), pa.array(counts[part].astype(np.int64))], names=["symbol", "key", "c"])

        for batch in batches:
            for text in batch.column(0).to_pylist():
                held.append(members_of(text))
                size += len(held[-1][1])
                if size > _SLICE:
                    yield from summed()
                    held, size = [], 0
        if held:
            yield from summed()

    return texts.mapInArrow(run, "symbol int, key bigint, c bigint").groupBy("symbol", "key").agg(F.sum("c").alias("c"))


def fit_members(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``key, c, bits`` of every n-gram over code points of a table's texts: how often it is there, and
    minus log2 of its last character's probability among those of its symbol, after the two before."""
    counts = {MEMBER_ORDER: cut_lineage(count_members(narrow(docs, text_col, text_col).select("text")))}
    for order in range(MEMBER_ORDER - 1, 0, -1):
        suffix = F.col("key").bitwiseAND(F.lit((1 << (_POINT_BITS * order)) - 1)).alias("key")
        counts[order] = cut_lineage(counts[order + 1].groupBy("symbol", suffix).agg(F.count(F.lit(1)).alias("c")))
    sizes = np.bincount(_table(), minlength=_FIRST_LISTED)[:_FIRST_LISTED]
    uniform = 1 / F.get(F.array(*(F.lit(float(n)) for n in sizes)), F.col("symbol"))
    lower = None
    for order in range(1, MEMBER_ORDER + 1):
        seen = counts[order]
        d1, d2, d3 = discounts(*seen.agg(*(F.count(F.when(F.col("c") == k, 1)) for k in range(1, 5))).first())
        discount = F.when(F.col("c") == 1, d1).when(F.col("c") == 2, d2).otherwise(d3)
        parted = seen.withColumn("context", F.shiftright("key", _POINT_BITS)).withColumn("d", discount)
        contexts = parted.groupBy("symbol", "context").agg(F.sum("c").alias("total"), F.sum("d").alias("held"))
        own = parted.join(contexts, ["symbol", "context"]).select(
            "symbol", "key", "c", ((F.col("c") - F.col("d")) / F.col("total")).alias("own"), (F.col("held") / F.col("total")).alias("g"))
        below = uniform
        if lower is not None:
            suffix = F.col("key").bitwiseAND(F.lit((1 << (_POINT_BITS * (order - 1))) - 1))
            own = own.withColumn("suffix", suffix).join(lower.select(F.col("key").alias("suffix"), F.col("p").alias("below")), "suffix")
            below = F.col("below")
        lower = cut_lineage(own.select("key", "c", (F.col("own") + F.col("g") * below).alias("p")))
    return lower.select("key", "c", (-F.log2("p")).alias("bits"))


def count_ngrams(texts: DataFrame) -> DataFrame:
    """``key, c`` over all texts. Each task sends a key once, with its count."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros(1 << (_BITS * ORDER), np.uint32)
        for batch in batches:
            held, size = [], 0
            for text in batch.column(0).to_pylist():
                held.append(keys_of(text))
                size += len(held[-1])
                if size > _SLICE:
                    _add(totals, held)
                    held, size = [], 0
            _add(totals, held)
        found = np.flatnonzero(totals)
        for at in range(0, len(found), 100_000):
            part = found[at:at + 100_000]
            yield pa.RecordBatch.from_arrays(
                [pa.array(part.astype(np.int32)), pa.array(totals[part].astype(np.int64))], names=["key", "c"])

    return texts.mapInArrow(run, "key int, c bigint").groupBy("key").agg(F.sum("c").alias("c"))


def _add(totals: np.ndarray, held: list[np.ndarray]) -> None:
    if held:
        found, counts = np.unique(np.concatenate(held), return_counts=True)
        totals[found] += counts.astype(np.uint32)


def discounts(n1: float, n2: float, n3: float, n4: float) -> tuple[float, float, float]:
    """The three discounts from the numbers of n-grams seen once to four times. Where a number is
    missing, as in small corpora, the discount is that of one count: n1 / (n1 + 2 n2)."""
    y = n1 / (n1 + 2 * n2) if n1 else 0.5
    plain = [1 - 2 * y * n2 / n1 if n1 else y, 2 - 3 * y * n3 / n2 if n2 else y, 3 - 4 * y * n4 / n3 if n3 else y]
    return tuple(min(max(d, 0.05), float(k)) for k, d in enumerate(plain, 1))


@dataclass(frozen=True)
class Model:
    """Per order from 1 up: sorted keys with log2 probabilities, sorted contexts with log2 weights."""

    keys: tuple
    probabilities: tuple
    contexts: tuple
    weights: tuple

    def bits(self, keys: np.ndarray) -> np.ndarray:
        """Minus log2 of each character's probability after its context."""
        out = np.zeros(len(keys))
        rest = np.arange(len(keys))
        for order in range(ORDER, 0, -1):
            grams = keys[rest] & ((1 << (_BITS * order)) - 1)
            at = _find(self.keys[order - 1], grams)
            hit = at >= 0
            out[rest[hit]] -= self.probabilities[order - 1][at[hit]]
            rest, grams = rest[~hit], grams[~hit]
            if not len(rest):
                return out
            back = _find(self.contexts[order - 1], grams >> _BITS)
            known = back >= 0
            out[rest[known]] -= self.weights[order - 1][back[known]]
        out[rest] += np.log2(SYMBOLS)
        return out


def _find(sorted_: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Places in a sorted array, -1 where it is not there."""
    if not len(sorted_):
        return np.full(len(wanted), -1)
    at = np.minimum(np.searchsorted(sorted_, wanted), len(sorted_) - 1)
    return np.where(sorted_[at] == wanted, at, -1)


def _order_table(order: int, counts: DataFrame, lower: DataFrame | None) -> tuple[DataFrame, DataFrame]:
    """``key, p`` and ``context, g`` of one order from its counts and the order below."""
    n = counts.agg(*(F.count(F.when(F.col("c") == k, 1)).alias(f"n{k}") for k in range(1, 5))).first()
    d1, d2, d3 = discounts(*n)
    discount = F.when(F.col("c") == 1, d1).when(F.col("c") == 2, d2).otherwise(d3)
    parted = counts.withColumn("context", F.shiftright("key", _BITS)).withColumn("d", discount)
    contexts = cut_lineage(parted.groupBy("context").agg(F.sum("c").alias("total"), F.sum("d").alias("held")).select(
        "context", "total", (F.col("held") / F.col("total")).alias("g")))
    own = parted.join(contexts, "context").select(
        "key", ((F.col("c") - F.col("d")) / F.col("total")).alias("own"), "g")
    if lower is None:
        table = own.select("key", (F.col("own") + F.col("g") / SYMBOLS).alias("p"))
    else:
        below = lower.select(F.col("key").alias("suffix"), F.col("p").alias("below"))
        suffix = F.col("key").bitwiseAND(F.lit((1 << (_BITS * (order - 1))) - 1))
        table = own.join(below, suffix == F.col("suffix")).select(
            "key", (F.col("own") + F.col("g") * F.col("below")).alias("p"))
    return cut_lineage(table), contexts.select("context", "g")


def fit(docs: DataFrame, text_col: str = "text") -> Model:
    """The model of all texts of a table. What comes to the driver is at most 2 ** 24 keys an order."""
    counts = {ORDER: cut_lineage(count_ngrams(narrow(docs, text_col, text_col).select("text")))}
    for order in range(ORDER - 1, 0, -1):
        suffix = F.col("key").bitwiseAND(F.lit((1 << (_BITS * order)) - 1)).alias("key")
        counts[order] = cut_lineage(counts[order + 1].groupBy(suffix).agg(F.count(F.lit(1)).alias("c")))
    parts, lower = [], None
    for order in range(1, ORDER + 1):
        table, contexts = _order_table(order, counts[order], lower)
        lower = table
        found, back = table.orderBy("key").toArrow(), contexts.orderBy("context").toArrow()
        parts.append((
            found.column("key").to_numpy().astype(np.int32), np.log2(found.column("p").to_numpy()).astype(np.float32),
            back.column("context").to_numpy().astype(np.int32), np.log2(back.column("g").to_numpy()).astype(np.float32)))
    return Model(*(tuple(p[n] for p in parts) for n in range(4)))


def _repeated_words(words: list[bytes]) -> int:
    """Words in three-word windows that occur twice or more."""
    if len(words) < 4:
        return 0
    numbers: dict[bytes, int] = {}
    ids = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, len(words))
    size = len(numbers)
    pair = ids[:-1] * size + ids[1:]
    if size > 2_000_000:
        pair = np.unique(pair, return_inverse=True)[1]
    _, inverse, counts = np.unique(pair[:-1] * size + ids[2:], return_inverse=True, return_counts=True)
    again = counts[inverse] > 1
    covered = np.zeros(len(words), bool)
    for n in range(3):
        covered[n:n + len(again)] |= again
    return int(covered.sum())


def rule_counts(text: str) -> tuple[int, int, int, int, int]:
    """Words, characters in words, symbols, lines that repeat an earlier one, repeated words."""
    data = text.encode("utf-8", "surrogatepass")
    words = data.split()
    blank = len(data) - sum(map(len, words))
    symbols = len(data) - len(data.translate(None, b"#*$%&|<>"))
    seen, repeats = set(), 0
    for line in data.split(b"\n"):
        if line in seen:
            repeats += 1
        elif line.strip():
            seen.add(line)
    return len(words), len(text) - blank, symbols, repeats, _repeated_words(words)


COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def measure(docs: DataFrame, model: Model, members: DataFrame, id_col: str = "doc_id", text_col: str = "text",
            *others: Column) -> DataFrame:
    """``doc_id``, the other columns asked for, the five counts, and ``bits`` per character (null
    for an empty text): one row per document. ``model`` and ``members`` are those of these texts."""
    common = members.orderBy(F.desc("c"), "key").limit(_COMMON).select("key", "bits").orderBy("key").toArrow()
    sent = docs.sparkSession.sparkContext.broadcast(
        (model, common.column("key").to_numpy(), common.column("bits").to_numpy().astype(np.float32)))
    rest = pa.list_(pa.struct([("key", pa.int64()), ("n", pa.int64())]))

    def run(texts: list[str]) -> dict:
        model, known, known_bits = sent.value
        counts = np.array([rule_counts(t) for t in texts], np.int64).reshape(-1, len(COUNTS))
        bits, rare = [], []
        for text in texts:
            own, times = np.unique(members_of(text)[1], return_counts=True)
            at = _find(known, own)
            hit = at >= 0
            keys = keys_of(text)
            bits.append(float(model.bits(keys).sum() + (times[hit] * known_bits[at[hit]]).sum()) if len(keys) else None)
            rare.append([{"key": k, "n": n} for k, n in zip(own[~hit].tolist(), times[~hit].tolist())])
        return {**{n: counts[:, i] for i, n in enumerate(COUNTS)}, "n_points": [len(t) for t in texts],
                "bits": pa.array(bits, pa.float64()), "rare": pa.array(rare, rest)}

    rows = narrow(docs, id_col, text_col, *others).withColumn("row", F.monotonically_increasing_id())
    schema = ", ".join(f"{n} bigint" for n in COUNTS) + ", n_points bigint, bits double, rare array<struct<key: bigint, n: bigint>>"
    found = cut_lineage(map_texts(rows.select(*(c for c in rows.columns if c != "text"), "text"), run, schema))
    looked_up = found.select("row", F.inline("rare")).join(members.select("key", F.col("bits").alias("each")), "key").groupBy(
        "row").agg(F.sum(F.col("n") * F.col("each")).alias("more"))
    per_character = (F.col("bits") + F.coalesce("more", F.lit(0.0))) / F.col("n_points")
    return found.join(looked_up, "row", "left").withColumn("bits", F.when(F.col("n_points") > 0, per_character)).drop(
        "row", "rare", "more", "n_points")


def judge(docs: DataFrame, min_words: int = 50, max_repeat_percent: int = 50, below: float = 6.0,
          above: float = 4.0, least_spread: float = 0.05, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``doc_id, lang``, the five counts, ``bits, base_failed, lower, upper, kept`` for every row.

    ``base_failed``: fewer than ``min_words`` words, or more than ``max_repeat_percent`` percent of
    them repeated. The band of a language is worked out over its rows that pass the base rules; its
    spread is at least ``least_spread`` bits. A null language is one of its own; a language of which
    no row passes has no band, and none of its rows is kept.
    """
    model = fit(docs, text_col)
    failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat_percent * F.col("n_words"))
    measured = cut_lineage(
        measure(docs, model, fit_members(docs, text_col), id_col, text_col, F.col(lang_col).alias("lang")).withColumn("base_failed", failed))
    quarters = measured.filter(~F.col("base_failed")).groupBy(F.col("lang").alias("band_lang")).agg(
        F.percentile_approx("bits", [0.25, 0.5, 0.75], 10_000).alias("q"))
    spread = F.greatest(F.lit(least_spread), F.col("q")[2] - F.col("q")[0])
    bands = cut_lineage(quarters.select(
        "band_lang", (F.col("q")[1] - spread * below).alias("lower"), (F.col("q")[1] + spread * above).alias("upper")))
    joined = measured.join(bands, F.col("lang").eqNullSafe(F.col("band_lang")), "left").drop("band_lang")
    inside = F.coalesce(F.col("bits").between(F.col("lower"), F.col("upper")), F.lit(False))
    return joined.withColumn("kept", ~F.col("base_failed") & inside)
