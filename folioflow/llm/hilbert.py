"""Shards along a Hilbert curve over several metadata dimensions.

Each dimension is cut into cells at its own quantiles, the cells' Hilbert index orders the rows,
and shards are runs of that order. Rows near each other on the curve are near in every dimension,
so each shard, and each file in it, covers a small range of all of them: a reader prunes files by
the least and largest value per dimension, which ``manifest`` lists per shard and Parquet keeps
per row group.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import StringType

from folioflow.llm.common import session, whole
from folioflow.session import cut_lineage

LAWS = ("rows", "bytes")
# Bytes of a text dimension that take part in its order; they make an exact double.
_PREFIX = 6


def hilbert_index(cells: np.ndarray, bits: int) -> np.ndarray:
    """Index on the curve of each row of ``cells``, coordinates below ``2 ** bits``.

    The transposed form: undo the excess rotations from the top bit down, take the Gray code over
    the dimensions, then interleave the bits.
    """
    x = [cells[:, i].astype(np.int64) for i in range(cells.shape[1])]
    dims = len(x)
    q = 1 << (bits - 1)
    while q > 1:
        p = q - 1
        for i in range(dims):
            set_ = (x[i] & q) != 0
            swap = np.where(set_, 0, (x[0] ^ x[i]) & p)
            x[0] = np.where(set_, x[0] ^ p, x[0] ^ swap)
            if i:
                x[i] = x[i] ^ swap
        q >>= 1
    for i in range(1, dims):
        x[i] = x[i] ^ x[i - 1]
    flip = np.zeros_like(x[0])
    q = 1 << (bits - 1)
    while q > 1:
        flip = np.where((x[-1] & q) != 0, flip ^ (q - 1), flip)
        q >>= 1
    index = np.zeros_like(flip)
    for b in range(bits - 1, -1, -1):
        for i in range(dims):
            index = (index << 1) | (((x[i] ^ flip) >> b) & 1)
    return index


def _image(docs: DataFrame, name: str) -> Column:
    """A double in the order of the column; texts by their first bytes."""
    if isinstance(docs.schema[name].dataType, StringType):
        head = F.hex(F.substring(F.encode(F.col(name), "UTF-8"), 1, _PREFIX))
        return F.conv(F.rpad(head, 2 * _PREFIX, "0"), 16, 10).cast("double")
    return F.col(name).cast("double")


def with_curve_index(docs: DataFrame, dimensions: list[str], bits: int, name: str) -> DataFrame:
    """``docs`` and the index of each row; nulls are in a dimension's first cell."""
    images = [_image(docs, d) for d in dimensions]
    shares = [i / (1 << bits) for i in range(1, 1 << bits)]
    # At most 2 ** bits - 1 numbers per dimension come to the driver.
    found = docs.agg(*(F.percentile_approx(c, shares, 10_000).alias(f"q{i}") for i, c in enumerate(images))).first()
    edges = [np.unique(np.array(q or [], float)) for q in found]

    @F.pandas_udf("bigint")
    def index(*values: pd.Series) -> pd.Series:
        cells = [
            np.where(v.isna(), 0, np.searchsorted(e, v.fillna(-np.inf).to_numpy(float), side="right"))
            for v, e in zip(values, edges)
        ]
        return pd.Series(hilbert_index(np.stack(cells, axis=1), bits))

    return docs.withColumn(name, index(*images))


def shard(docs: DataFrame, dimensions: list[str], shards: int = 8, law: str = "rows", bits: int = 6,
          id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``row`` (a struct of all input columns), ``size``, ``shard`` and ``slot`` for every row.

    The rows are sorted along the curve, ties by id and text, and written once in that order to the
    shared folder. ``law`` "rows" cuts runs whose row counts are at most one apart; "bytes" cuts
    runs of near equal size, off by less than one document. ``size`` is the UTF-8 length of the
    text (null: none) plus 1; slots count from 0 within a shard. Rows with null ids come first
    among ties; equal rows all stay. With fewer rows than shards some shards are empty.
    """
    if law not in LAWS:
        raise ValueError(f"law is one of {LAWS}")
    session(docs.sparkSession)
    size = (F.octet_length(F.coalesce(F.col(text_col), F.lit(""))) + 1).cast("bigint")
    packed = docs.select(
        whole(docs).alias("row"), size.alias("size"), F.col(id_col).alias("id"),
        F.xxhash64(text_col).alias("tie"), *(F.col(d).alias(f"d{i}") for i, d in enumerate(dimensions)),
    )
    keyed = with_curve_index(packed, [f"d{i}" for i in range(len(dimensions))], bits, "curve")
    order = ["curve", "id", "tie"]
    # The last key parts rows that are alike in all others.
    spread = keyed.withColumn("last", F.monotonically_increasing_id()).repartitionByRange(*order, "last")
    ordered = spread.sortWithinPartitions(*order, "last").select(
        "row", "size", F.spark_partition_id().alias("part"),
        (F.monotonically_increasing_id() % F.lit(1 << 33)).alias("pos"),
    )
    laid = cut_lineage(ordered)
    # One row per task of the sort: all that is ever looked at together.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = cut_lineage(
        laid.groupBy("part").agg(F.count(F.lit(1)).alias("rows"), F.sum("size").alias("bytes"))
        .select("part", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("rows_before"),
                F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("bytes_before"))
    )
    total = laid.agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("bytes")).first()
    ranked = laid.join(parts, "part").withColumn("rank", F.col("rows_before") + F.col("pos"))
    if law == "rows":
        n = total["n"]
        number = F.expr(f"(rank * {shards}L) div {max(1, n)}L")
        first = F.expr(f"(shard * {n}L + {shards - 1}L) div {shards}L")
        return ranked.withColumn("shard", number.cast("int")).select(
            "row", "size", "shard", (F.col("rank") - first).alias("slot"))
    upto = Window.partitionBy("part").orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    places = laid.select("part", "pos", "size").withColumn("upto", F.sum("size").over(upto))
    middle = F.expr("2 * (bytes_before + upto) - size")
    cut = cut_lineage(places.join(parts, "part").select(
        "part", "pos", (F.col("rows_before") + F.col("pos")).alias("rank"),
        F.least(F.lit(shards - 1), F.floor(middle * shards / F.lit(2 * (total["bytes"] or 1)))).cast("int").alias("shard"),
    ))
    firsts = cut.groupBy("shard").agg(F.min("rank").alias("first"))
    slots = cut.join(firsts, "shard").select("part", "pos", "shard", (F.col("rank") - F.col("first")).alias("slot"))
    return laid.join(slots, ["part", "pos"]).select("row", "size", "shard", "slot")


def manifest(sharded: DataFrame, dimensions: list[str]) -> DataFrame:
    """Per shard: rows, bytes, and the least and largest value of every dimension."""
    ranges = [f(F.col(f"row.{d}")).alias(f"{n}_{d}") for d in dimensions for n, f in (("min", F.min), ("max", F.max))]
    return sharded.groupBy("shard").agg(F.count(F.lit(1)).alias("rows"), F.sum("size").alias("bytes"), *ranges)


def write_shards(sharded: DataFrame, path: str) -> None:
    """The input's columns as Parquet, one folder per shard, each file a stretch of the curve."""
    sharded.select("row.*", F.col("shard").alias("__shard"), F.col("slot").alias("__slot")).repartitionByRange(
        "__shard", "__slot").sortWithinPartitions("__slot").drop("__slot").write.partitionBy("__shard").parquet(path)
