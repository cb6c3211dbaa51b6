"""What the operators of this subpackage share.

Conventions, unless an operator's docstring says otherwise: a null text is an empty text; every
row counts as a document of its own, also when its id is null or repeated; only the named columns
are read, so other columns may have any name; an empty table gives an empty result with the same
columns.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from folioflow.session import configure

# Rows per Arrow batch: a few MB of text, so that a worker's memory does not hang on row counts.
BATCH_ROWS = 1000


def session(spark: SparkSession) -> SparkSession:
    """The caller's session with this library's settings and small Arrow batches."""
    configure(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return spark


def narrow(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *others: str) -> DataFrame:
    """``doc_id``, ``text`` without nulls, and the columns asked for."""
    session(docs.sparkSession)
    return docs.select(
        F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"), *others,
    )


def whole(docs: DataFrame) -> Column:
    """All columns of a row as one struct, whatever their names."""
    return F.struct(*(F.col("`" + c.replace("`", "``") + "`") for c in docs.columns))


_STORED: dict = {}


def stored(name: tuple, make: Callable[[], object]):
    """What ``make`` gives, kept in a Python worker from task to task until another name is asked for.

    A worker serves all operators of an application in turn, so it keeps the store of one at a time.
    """
    if name not in _STORED:
        let_go()
        _STORED[name] = make()
    return _STORED[name]


def let_go(but: tuple | None = None) -> None:
    """Forget what is kept under any other name, and hand unused Arrow memory back."""
    others = [name for name in _STORED if name != but]
    for name in others:
        del _STORED[name]
    if others:
        pa.default_memory_pool().release_unused()


def map_texts(docs: DataFrame, fn: Callable[[list], dict], schema: str, text_col: str = "text",
              as_bytes: bool = False, keeps: tuple | None = None) -> DataFrame:
    """Replace the text by columns worked out from it; all other columns stay in front.

    ``fn`` gets the texts of one batch (UTF-8 bytes with ``as_bytes``) and returns a list or array
    for every column of ``schema``. ``keeps`` names the store it asks ``stored`` for; others are let go.
    """
    kept = [f for f in docs.schema.fields if f.name != text_col]
    names = [f.name for f in kept]
    parts = [f"`{f.name}` {f.dataType.simpleString()}" for f in kept]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go(keeps)
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index(text_col))
            found = fn((texts.cast(pa.binary()) if as_bytes else texts).to_pylist())
            columns = [batch.column(batch.schema.get_field_index(n)) for n in names]
            yield pa.RecordBatch.from_arrays(
                [*columns, *(v if isinstance(v, pa.Array) else pa.array(v) for v in found.values())],
                names=[*names, *found],
            )

    return docs.mapInArrow(run, ", ".join([*parts, schema]))
