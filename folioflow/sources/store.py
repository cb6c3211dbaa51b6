"""The tables at rest: plain Parquet, one folder per batch and writer.

A batch writes ``<root>/<table>/batch_id=<n>/writer=<w>`` and reads only batches that were finished
when it began, so running it again gives the same files: a batch lost halfway is simply repeated.
Nothing that is being read is ever overwritten. Tables whose rows get replaced are change logs; their
current rows are the last ones per key.

Batch numbers come from a log in the store: a writer begins each of its epochs once and gets the
same number when it repeats it, so nobody writes over another writer's batch. The log keeps which
batches an epoch does not read, and the order in which batches were finished. Two writers that work
at the same time may bring the same key; the one that finished first is the row, whatever its number,
so a row that was read once stays. A batch that is not finished is read by nobody. Batches written
under numbers without a log entry count as finished in their order.
"""

from __future__ import annotations

import re
import threading
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from folioflow.functions import scalars as sc
from folioflow.operators.dedup import first_per_key, first_per_key_nulls_distinct, last_per_key
from folioflow.operators.upsert import insert_or_ignore, with_latest
from folioflow.schemas import KEYS, LAST_WINS, NULLS_DISTINCT, REQUIRED, TABLES, columns

_TASK_TABLES = {"high_quality_users", "target_users"}
_PLACE = ["place"]


@dataclass
class Batches:
    """The batch log as read once: numbers by (writer, epoch), in the order they were finished, and
    what the epochs that began do not read."""

    taken: set[int] = field(default_factory=set)
    begun: dict[tuple[str, int], int] = field(default_factory=dict)
    finished: dict[int, int] = field(default_factory=dict)
    unread: dict[int, set[int]] = field(default_factory=dict)

    def open(self) -> set[int]:
        return self.taken - self.finished.keys()

    def late(self) -> dict[int, tuple[int, int]]:
        """Batches finished after one of a higher number: that number, and their turn. Only writers that
        work at the same time have any."""
        out, highest = {}, 0
        for turn, number in sorted((turn, number) for number, turn in self.finished.items()):
            if number < highest:
                out[number] = (highest, turn)
            highest = max(highest, number)
        return out


class TableStore:
    def __init__(self, spark: SparkSession, root: str, writer: str = "run"):
        self.spark, self.root, self.writer = spark, root.rstrip("/"), re.sub(r"[^\w.-]", "_", writer)
        self._counts: dict[tuple[str, int], int] = {}
        self._lock = threading.Lock()

    def writing_as(self, writer: str) -> TableStore:
        """The same tables for another writer; what both write is counted together."""
        other = TableStore(self.spark, self.root, writer)
        other._counts, other._lock = self._counts, self._lock
        return other

    def written(self) -> dict[str, int]:
        """Rows put down per table through this store, counted while they were written. A batch that is
        repeated counts once."""
        with self._lock:
            counts = dict(self._counts)
        return {table: sum(n for (t, _), n in counts.items() if t == table) for table, _ in sorted(counts)}

    # --- batches ---

    def _log(self):
        """The folder of the batch log in the store's own file system. Its entries are empty files."""
        jvm = self.spark.sparkContext._jvm
        folder = jvm.org.apache.hadoop.fs.Path(f"{self.root}/batch_log")
        files = folder.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        files.mkdirs(folder)
        return files, folder, lambda name: jvm.org.apache.hadoop.fs.Path(folder, name)

    def batches(self) -> Batches:
        files, folder, _ = self._log()
        found = Batches()
        for status in files.listStatus(folder):
            number, *entry = status.getPath().getName().split("~")
            if not number.isdigit():
                continue
            found.taken.add(int(number))
            match entry:
                case [writer, epoch, "begun"]:
                    found.begun[writer, int(epoch)] = int(number)
                case [turn, "finished"]:
                    # An epoch that was repeated by two processes at once has its first turn.
                    found.finished[int(number)] = min(int(turn), found.finished.get(int(number), int(turn)))
                case [other, "unread"]:
                    found.unread.setdefault(int(number), set()).add(int(other))
        return found

    def begin(self, epoch: int) -> int:
        """The batch of an epoch of this writer: its old number, or the one after all others."""
        files, _, path = self._log()
        known = self.batches()
        if (self.writer, epoch) in known.begun:
            return known.begun[self.writer, epoch]
        number = max(known.taken, default=0) + 1
        # Only one writer can make a number's file.
        while not files.createNewFile(path(f"{number}")):
            number += 1
        # Numbers taken since the log was read are not finished as far as this epoch is concerned.
        for other in known.open() | set(range(max(known.taken, default=0) + 1, number)):
            files.createNewFile(path(f"{number}~{other}~unread"))
        files.createNewFile(path(f"{number}~{self.writer}~{epoch}~begun"))
        return number

    def finish(self, epoch: int) -> None:
        """From now on the epoch's rows are read by those who begin."""
        files, _, path = self._log()
        known = self.batches()
        number = known.begun[self.writer, epoch]
        if number in known.finished:
            return
        turn = max(known.finished.values(), default=0) + 1
        while not files.createNewFile(path(f"turn-{turn}")):
            turn += 1
        files.createNewFile(path(f"{number}~{turn}~finished"))

    def finished(self) -> int:
        """The last epoch this writer has finished; 0 before the first."""
        known = self.batches()
        return max((e for (w, e), number in known.begun.items() if w == self.writer and number in known.finished), default=0)

    # --- tables ---

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def create_tables(self, *tables: str) -> None:
        """Empty tables (all unless named) where there are none yet: batch 0."""
        for table in tables or TABLES:
            if table != "system_meta":
                self.spark.createDataFrame([], TABLES[table]).coalesce(1).write.mode("ignore").parquet(
                    f"{self.path(table)}/batch_id=0/writer=none"
                )

    def log(self, table: str, before: int | None = None) -> DataFrame:
        """All rows of finished batches with their batch; the partition filter prunes folders. With
        ``before``, what that batch reads."""
        return self._rows(table, before).drop("writer", "place")

    def _rows(self, table: str, before: int | None = None) -> DataFrame:
        rows = self.spark.read.schema(f"{TABLES[table]}, batch_id bigint, writer string").parquet(self.path(table))
        known = self.batches()
        hidden = known.open() if before is None else known.unread.get(before, set())
        if before is not None:
            rows = rows.filter(F.col("batch_id") < before)
        if hidden:
            rows = rows.filter(~F.col("batch_id").isin(sorted(hidden)))
        number, turn = F.col("batch_id"), F.lit(0)
        for batch, (after, own_turn) in known.late().items():
            number = F.when(F.col("batch_id") == batch, after).otherwise(number)
            turn = F.when(F.col("batch_id") == batch, own_turn).otherwise(turn)
        return rows.withColumn("place", F.struct(number.cast("bigint").alias("number"), turn.alias("turn"), "writer"))

    def current(self, table: str, before: int | None = None) -> DataFrame:
        if table == "system_meta":
            return self.meta(before)
        rows = self._rows(table, before)
        if table in LAST_WINS:
            rows = last_per_key(rows, KEYS[table], _PLACE)
        elif table in KEYS and table not in NULLS_DISTINCT:
            rows = first_per_key(rows, KEYS[table], _PLACE)
        elif table in NULLS_DISTINCT:
            rows = first_per_key_nulls_distinct(rows, KEYS[table], _PLACE)
        rows = rows.drop("batch_id", "writer", "place")
        if table in _TASK_TABLES:
            done = self._rows("task_log", before).filter(F.col("table_name") == table)
            rows = with_latest(rows, done, ["user_id"], "last_updated", _PLACE)
        elif table == "raw_statuses":
            rows = with_latest(rows, self._rows("status_log", before), ["status_id"], "is_analyzed", _PLACE)
        return rows

    def meta(self, before: int | None = None) -> DataFrame:
        """The key/value view over the typed state tables."""
        scanned = self.current("scan_state", before).select(
            sc.scanned_key(F.col("user_id")).alias("key"),
            F.col("scanned_on").cast("string").alias("value"),
        )
        marks = self.current("timeline_marks", before).select(
            sc.mark_key(F.col("user_id")).alias("key"),
            sc.time_text(F.col("last_created_at")).alias("value"),
        )
        return scanned.unionByName(marks)

    def ids(self, table: str, before: int | None = None) -> DataFrame:
        """Key columns only: one narrow scan."""
        return self.log(table, before).select(*KEYS[table]).distinct()

    def write(self, table: str, df: DataFrame, batch_id: int) -> None:
        """Put rows down as they are."""
        if batch_id < 1:
            raise ValueError("batch 0 is the empty table")
        typed = [F.col(name).cast(kind) for name, kind in columns(table).items()]
        seen = Observation()
        df.select(*typed).observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").parquet(
            f"{self.path(table)}/batch_id={batch_id}/writer={self.writer}"
        )
        with self._lock:
            self._counts[table, batch_id] = seen.get["rows"]

    def insert(self, table: str, df: DataFrame, batch_id: int, order: list) -> None:
        """Insert or ignore for first-wins tables, last one of the batch for the others."""
        keys = KEYS[table]
        if table in LAST_WINS:
            fresh = last_per_key(df.dropna(subset=keys), keys, order)
        else:
            fresh = insert_or_ignore(
                self.log(table, batch_id), df, keys, order,
                required=REQUIRED.get(table), nulls_distinct=table in NULLS_DISTINCT,
            )
        self.write(table, fresh, batch_id)

    def compact(self, table: str, target: str) -> None:
        """Current rows as one fresh batch under another root, sorted by key for row-group skipping."""
        rows = self.current(table)
        out = f"{target.rstrip('/')}/{table}/batch_id=1/writer=compact"
        rows.repartition(*KEYS[table]).sortWithinPartitions(*KEYS[table]).write.mode(
            "errorifexists"
        ).parquet(out)
