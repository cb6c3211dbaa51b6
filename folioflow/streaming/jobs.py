"""The polling loops as Structured Streaming.

Each job hands its micro-batches to the same DataFrame plans the batch runs use. A job is a writer
of the store under a name of its own, kept with its checkpoint: a repeated epoch gives the same
files, and a job with a fresh checkpoint is a new writer that replaces nothing. State that belongs to a user, the high-water mark, is a table joined per batch rather than keyed
operator state: a user with a third of the posts is then an ordinary skewed join, which
adaptive execution splits, and not one state task.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from folioflow.config import FlowConfig
from folioflow.plans import classify, timeline
from folioflow.session import cut_lineage
from folioflow.sources import payloads
from folioflow.sources.store import TableStore


def landed_stream(spark: SparkSession, path: str, schema, max_files: int | None = None,
                  max_bytes: str | None = None, **options: str) -> DataFrame:
    """Parquet files under ``path`` as they land, at most so many files or bytes per micro-batch: a
    backlog is worked off in batches of a bounded size."""
    reader = spark.readStream.schema(schema).options(**options)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if max_bytes is not None:
        reader = reader.option("maxBytesPerTrigger", max_bytes)
    return reader.parquet(path)


def _writer(store: TableStore, job: str, checkpoint: str) -> TableStore:
    path = f"{checkpoint.rstrip('/')}/writer"
    try:
        name = store.spark.read.schema("name string").parquet(path).first()[0]
    except AnalysisException:
        name = f"{job}-{uuid.uuid4().hex}"
        store.spark.createDataFrame([(name,)], "name string").coalesce(1).write.parquet(path)
    return store.writing_as(name)


def _start(stream: DataFrame, store: TableStore, job: str, work, checkpoint: str, drain: bool, poll: str) -> StreamingQuery:
    """``work(store, rows, batch)`` for each micro-batch. ``drain`` works off all that is there and
    stops; otherwise it polls."""
    own = _writer(store, job, checkpoint)

    def each_batch(rows: DataFrame, epoch: int) -> None:
        number = own.begin(epoch + 1)
        work(own, rows, number)
        own.finish(epoch + 1)

    writer = stream.writeStream.foreachBatch(each_batch).option("checkpointLocation", checkpoint)
    trigger = {"availableNow": True} if drain else {"processingTime": poll}
    return writer.trigger(**trigger).start()


def label_stream(statuses: DataFrame, store: TableStore, cfg: FlowConfig, scorer: classify.Scorer,
                 checkpoint: str, drain: bool = True, poll: str = "2 seconds") -> StreamingQuery:
    """New raw statuses to labelled comments and status codes."""
    def work(store: TableStore, batch: DataFrame, number: int) -> None:
        # Scored once: two tables are written from it.
        scored = cut_lineage(classify.score_posts(classify.queue(batch), scorer, cfg))
        store.insert("value_comments", classify.value_comments(scored), number, ["comment_id"])
        store.write("status_log", classify.status_rows(scored), number)

    return _start(statuses, store, "labels", work, checkpoint, drain, poll)


def post_stream(posts: DataFrame, store: TableStore, checkpoint: str, order: list,
                drain: bool = True, poll: str = "2 seconds") -> StreamingQuery:
    """Posts newer than their user's mark, each once; then the marks move forward.

    ``posts`` has the columns of ``raw_statuses``. Late posts, at or before the mark, are
    dropped; posts without a readable time always pass and are deduplicated by key.
    """
    def work(store: TableStore, batch: DataFrame, number: int) -> None:
        marks = store.current("timeline_marks", number)
        batch.persist()  # two tables are written from it; a lost block is read again
        store.insert("raw_statuses", timeline.newer_than_mark(batch, marks), number, order)
        newest = timeline.newest_seen(batch)
        store.insert("timeline_marks", timeline.advance_marks(marks, newest), number, ["last_created_at"])
        batch.unpersist()

    return _start(posts, store, "posts", work, checkpoint, drain, poll)


def timeline_stream(pages: DataFrame, articles: DataFrame, store: TableStore, cfg: FlowConfig,
                    checkpoint: str, drain: bool = True, poll: str = "2 seconds") -> StreamingQuery:
    """Landed timeline pages through the whole incremental ingest."""
    def work(store: TableStore, batch: DataFrame, number: int) -> None:
        rows = cut_lineage(payloads.post_rows(batch))
        out = timeline.ingest(rows, store.current("timeline_marks", number), articles, cfg)
        store.insert("raw_statuses", out["raw_statuses"], number, ["visited_id", "page", "pos"])
        store.insert("timeline_marks", out["timeline_marks"], number, ["last_created_at"])

    return _start(pages, store, "timelines", work, checkpoint, drain, poll)


def insert_stream(rows: DataFrame, store: TableStore, table: str, checkpoint: str, order: list,
                  drain: bool = True, poll: str = "2 seconds") -> StreamingQuery:
    """Insert-or-ignore across micro-batches: the first batch that brings a key keeps it."""
    def work(store: TableStore, batch: DataFrame, number: int) -> None:
        store.insert(table, batch, number, order)

    return _start(rows, store, "insert", work, checkpoint, drain, poll)
