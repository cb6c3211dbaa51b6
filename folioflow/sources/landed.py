"""Landed capture files: JSON lines, plain or gzipped, with what cannot be read set aside.

A line that is no JSON, a line whose keys are of another kind, one without a payload and one whose
payload is no JSON each become a row with a reason. Nothing that landed is lost without a trace.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from folioflow.functions import variants as vr

_CORRUPT = "_corrupt"


def read_captures(spark: SparkSession, path: str, key_columns: str) -> DataFrame:
    """``<keys>, payload, source, reason`` for every line under ``path``; ``reason`` is null where it
    can be read. ``source`` is the file's name. A broken line is the payload of its row.

    A gzipped file is read by one task, so its rows are spread evenly before anything else is done.
    """
    lines = spark.read.schema(f"{key_columns}, payload string, {_CORRUPT} string").option(
        "columnNameOfCorruptRecord", _CORRUPT).json(path).select("*", F.col("_metadata.file_name").alias("source"))
    zipped = F.col("source").endswith(".gz")
    rows = lines.filter(~zipped).unionByName(lines.filter(zipped).hint("rebalance"))
    # Named here, all keys are read whatever a query selects: one that is not read cannot be of another kind.
    fields = [F.col(f"`{c}`").cast("string") for c in lines.columns if c not in (_CORRUPT, "source")]
    reason = (
        F.when(F.col(_CORRUPT).isNotNull() & F.coalesce(*fields).isNull(), "line is no JSON")
        .when(F.col(_CORRUPT).isNotNull(), "key of another kind").otherwise(unreadable_reason(F.col("payload")))
    )
    return rows.withColumn("reason", reason).withColumn("payload", F.coalesce("payload", _CORRUPT)).drop(_CORRUPT)


def unreadable_reason(payload: Column) -> Column:
    """Why a payload cannot be read; null if it can."""
    return F.when(payload.isNull(), "no payload").when(
        ~F.coalesce(vr.is_readable(payload), F.lit(False)), "payload is no JSON")


def split(captures: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Captures that can be read, and rows for the ``quarantine`` table."""
    good = captures.filter(F.col("reason").isNull()).drop("reason", "source")
    return good, captures.filter(F.col("reason").isNotNull()).select("source", "reason", "payload")


def set_aside(captures: dict[str, DataFrame]) -> DataFrame:
    """Rows for the ``quarantine`` table from captures by name, each with a ``payload`` column."""
    found = None
    for name, rows in captures.items():
        reason = unreadable_reason(F.col("payload"))
        bad = rows.select(F.lit(name).alias("source"), reason.alias("reason"), "payload").filter("reason IS NOT NULL")
        found = bad if found is None else found.unionByName(bad)
    return found
