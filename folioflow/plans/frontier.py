"""Step 1: grow the user set along follow lists."""

from __future__ import annotations

import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from folioflow.config import FlowConfig
from folioflow.functions import scalars as sc
from folioflow.operators.dedup import first_per_key
from folioflow.operators.ordered import number_rows, quota_cutoff
from folioflow.operators.upsert import insert_or_ignore, unseen
from folioflow.plans.tasks import as_pending, take
from folioflow.schemas import columns
from folioflow.session import cut_lineage

PROFILE = list(columns("users"))
# The best-first expansion looks for its first open users among so many at a time, a block of links is
# that of so many users; it gives back at most so many users at once, and looks at so many links at once.
FIRST_USERS, MOST_USERS, MOST_LINKS = 1 << 16, 1 << 19, 3_000_000


def is_high_quality(cfg: FlowConfig) -> Column:
    return F.coalesce(
        (F.col("followers_count") > cfg.min_followers) & (F.col("comments_count") > cfg.min_statuses),
        F.lit(False),
    )


def high_quality(profiles: DataFrame, cfg: FlowConfig) -> DataFrame:
    return as_pending(profiles.filter(is_high_quality(cfg)))


def new_users(candidates: DataFrame, existing: DataFrame, order: list) -> DataFrame:
    """Candidates not known yet, each once, as first seen."""
    return insert_or_ignore(existing, candidates, ["user_id"], order)


def scanned_ids(meta: DataFrame) -> DataFrame:
    """User ids out of the scanned markers; markers without a number are ignored."""
    user = sc.key_user(F.col("key"), sc.SCANNED_PREFIX)
    return meta.select(user.alias("user_id")).filter(F.col("user_id").isNotNull()).distinct()


def next_sources(high_quality_users: DataFrame, scanned: DataFrame, k: int = 1) -> DataFrame:
    """The ``k`` unscanned users with most followers. An anti join: nulls cannot empty it."""
    open_users = high_quality_users.join(scanned.select("user_id"), "user_id", "left_anti")
    return take(open_users, [F.desc_nulls_last("followers_count"), "user_id"], k)


def read_sources(
    rows: DataFrame, existing: DataFrame, cfg: FlowConfig, pages: DataFrame | None = None,
    reevaluate: bool = False,
) -> dict[str, DataFrame]:
    """What reading the sources' follow pages gives.

    ``rows`` are follow rows with ``rank``, the order of the sources. Per source, whole pages are
    read until ``cfg.batch_size`` new high-quality users were found or ``cfg.page_cap`` pages
    were read. Each source is read against the users known before the batch; with one source
    per round that is the sequential rule. ``pages(src, page)`` are the readable pages, where some
    of them may hold no user. ``reevaluate`` also promotes known users that have
    come to pass the threshold.
    """
    arrival = ["rank", "page", "pos"]
    capped = rows if cfg.page_cap is None else rows.filter(F.col("page") < cfg.page_cap)
    fresh = first_per_key(unseen(capped, existing, ["user_id"]), ["src", "user_id"], ["page", "pos"])
    cutoff = None
    if cfg.batch_size is not None:
        cutoff = quota_cutoff(fresh, ["src"], "page", is_high_quality(cfg), cfg.batch_size)

    def read_part(df):
        if cutoff is None:
            return df
        return df.join(cutoff, "src", "left").filter(
            F.col("cutoff").isNull() | (F.col("page") <= F.col("cutoff"))
        )

    users = first_per_key(read_part(fresh), ["user_id"], arrival).select(*PROFILE)
    promoted = users
    if reevaluate:
        promoted = first_per_key(read_part(capped), ["user_id"], arrival).select(*PROFILE)
    # Finished: neither stopped by the quota nor by the page cap.
    ends = (rows if pages is None else pages).groupBy("src").agg(F.max("page").alias("last_page"))
    if cutoff is not None:
        ends = ends.join(cutoff, "src", "left_anti")
    if cfg.page_cap is not None:
        ends = ends.filter(F.col("last_page") < cfg.page_cap - 1)
    scanned = ends.select(F.col("src").alias("user_id"))
    return {"users": users, "high_quality_users": high_quality(promoted, cfg), "scanned": scanned}


def reach(edges: DataFrame, start: DataFrame, hops: int, cut_every: int = 1) -> DataFrame:
    """Users within ``hops`` follow steps, with the first step that reaches them.

    ``edges(src, dst)``, ``start(user_id)``. Each hop is one join of the newest users with the
    edges and one anti join; only users that are new go on. A hop's new ids are put down every
    ``cut_every`` hops: later hops read them instead of walking all earlier ones again.
    """
    links = edges.select("src", F.col("dst").alias("user_id"))
    known = start.select("user_id").distinct().withColumn("hop", F.lit(0))
    newest = known
    for hop in range(1, hops + 1):
        found = (
            newest.select(F.col("user_id").alias("src")).join(links, "src")
            .select("user_id").distinct()
            .join(known.select("user_id"), "user_id", "left_anti")
            .withColumn("hop", F.lit(hop))
        )
        if hop % cut_every == 0 and hop < hops:
            found = cut_lineage(found)
        known = known.unionByName(found)
        newest = found
    return known


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``block, src, dst`` rows to one row for each block in a batch, its numbers as 32-bit ones."""
    for batch in batches:
        block, src, dst = (c.to_numpy() for c in batch.columns)
        stops = [0, *(np.flatnonzero(np.diff(block)) + 1).tolist(), len(block)]
        spans = [(i, j) for i, j in zip(stops, stops[1:]) if i < j]
        yield pa.RecordBatch.from_arrays(
            [pa.array([block[i] for i, _ in spans], pa.int32()),
             *(pa.array([c[i:j].astype(np.uint32).tobytes() for i, j in spans], pa.binary()) for c in (src, dst))],
            names=["block", "src", "dst"])


def _laid(batches: Iterator[pa.RecordBatch], n: int, width: int, file) -> tuple[np.ndarray, np.ndarray]:
    """The users to start from, and where each user's links begin in ``file``, to which they are written.

    Rows come by block. One block is held at a time; block -1 are the users to start from."""
    first, starts, current, held = np.zeros(n + 1, np.int64), np.empty(0, np.int64), None, []

    def put() -> None:
        nonlocal starts
        src, dst = (np.frombuffer(b"".join(parts), np.uint32) for parts in zip(*held))
        if current < 0:
            starts = np.unique(dst).astype(np.int64)
            return
        low = current * width
        first[low + 1:low + width + 1] += np.bincount(src - low, minlength=width)[:n - low]
        file.write(dst[np.argsort(src, kind="stable")].tobytes())

    for batch in batches:
        for block, src, dst in zip(*(c.to_pylist() for c in batch.columns)):
            if block != current and held:
                put()
                held = []
            current = block
            held.append((src, dst))
    if held:
        put()
    file.flush()
    return starts, np.cumsum(first)


def _played(starts: np.ndarray, first: np.ndarray, links: np.ndarray, k: int | None, room: int | None,
            last_round: int | None, width: int, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray | None]:
    """For each user the round in which they became known, -1 if never, and the one in which they were
    scanned, 0 if never; and, if the last round found more users than there is room for, for those the
    source that has them, -1 for others.

    Users are numbered by rank, so a round's users are the first open ones; ``links[first[u]:first[u + 1]]``
    are those that ``u`` follows. ``width`` users are counted together, ``most`` links looked at at once.
    """
    n = len(first) - 1
    found, scanned, is_open = np.full(n, -1, np.int32), np.zeros(n, np.int32), np.zeros(n, bool)
    counts = np.zeros(n // width + 1, np.int64)

    def open_(users: np.ndarray) -> None:
        is_open[users] = True
        np.add.at(counts, users // width, 1)

    found[starts] = 0
    open_(starts)
    number = 0
    while (last_round is None or number < last_round) and (room is None or room > 0):
        before = np.cumsum(counts)
        if not before[-1]:
            break
        low = int(np.searchsorted(before, 0, side="right")) * width
        high = (int(np.searchsorted(before, k)) + 1) * width if k else n
        chosen = low + np.flatnonzero(is_open[low:high])[:k or None]
        number += 1
        is_open[chosen] = False
        np.subtract.at(counts, chosen // width, 1)
        scanned[chosen] = number
        held = first[chosen + 1] - first[chosen]
        ends = np.cumsum(held)
        begins, new, sources = first[chosen] - (ends - held), [], []
        for at in range(0, int(ends[-1]), most):
            place = np.arange(at, min(at + most, int(ends[-1])))
            nth = np.searchsorted(ends, place, side="right")
            users = links[begins[nth] + place].astype(np.int64)
            fresh = found[users] < 0
            # A user's first link comes from their best source: links are in the order of the sources.
            met, at_first = np.unique(users[fresh], return_index=True)
            found[met] = number
            new.append(met)
            if room is not None:
                sources.append(chosen[nth[fresh][at_first]])
        met = np.concatenate(new) if new else np.empty(0, np.int64)
        if room is not None and len(met) > room:
            source = np.full(n, -1, np.int64)
            source[met] = np.concatenate(sources)
            return found, scanned, source
        open_(met)
        room = None if room is None else room - len(met)
    return found, scanned, None


def best_first(edges: DataFrame, profiles: DataFrame, start: DataFrame, k: int, user_cap: int | None = None,
               max_rounds: int | None = None) -> DataFrame:
    """``user_id, followers_count, found_round, scanned_round``: expansion from the best users on.

    ``edges(src, dst)``, ``profiles(user_id, followers_count)``, ``start(user_id)``. Each round reads
    the ``k`` unscanned known users with most followers (nulls last, ties by id) and takes the users
    they follow who have a profile. With ``user_cap`` no more than that many become known, in the
    order of the sources' rank and then their own id. It ends when no known user is unscanned, the
    cap is reached, or after ``max_rounds``. A user not scanned by then has a null ``scanned_round``.

    A round hangs on the one before, and there are as many as users by ``k``, so rounds are not jobs.
    Users are numbered by rank and links become pairs of numbers, in blocks by source; all that is
    joins, in many tasks. One task then plays the rounds, each link looked at once: four bytes for it lie
    in a file of the task's own, some twenty bytes for a user in memory, of the links one block or
    ``MOST_LINKS``. Nothing but the number of users comes to the driver, with ``user_cap`` that of known ones.
    """
    order = [F.desc_nulls_last("followers_count"), "user_id"]
    people = cut_lineage(profiles.select(
        F.col("user_id").cast("bigint").alias("user_id"), F.col("followers_count").cast("bigint").alias("followers_count"),
    ).filter("user_id IS NOT NULL").dropDuplicates(["user_id"]))
    placed = cut_lineage(number_rows(people, [], order, "place").withColumn("place", F.col("place") - 1))
    n, width, most, rows = placed.count(), FIRST_USERS, MOST_LINKS, MOST_USERS
    follows = edges.select(F.col("src").cast("bigint").alias("src"), F.col("dst").cast("bigint").alias("dst"))
    links = follows.join(placed.select(F.col("user_id").alias("dst"), F.col("place").alias("to")), "dst").join(
        placed.select(F.col("user_id").alias("src"), F.col("place").alias("from")), "src").select(
        F.floor(F.col("from") / width).cast("int").alias("block"), F.col("from").alias("src"), F.col("to").alias("dst"))
    starts = placed.join(start.select("user_id"), "user_id", "left_semi").select(
        F.lit(-1).alias("block"), F.lit(0).alias("src"), F.col("place").alias("dst"))
    # Links of one source may be a third of all, so a block is dealt to several tasks.
    blocks = cut_lineage(links.unionByName(starts).repartition("block", F.pmod("dst", F.lit(16))).sortWithinPartitions("block").mapInArrow(
        _packed, "block int, src binary, dst binary"))

    def play(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with tempfile.TemporaryFile() as file:
            begin, first = _laid(batches, n, width, file)
            held = np.memmap(file, np.uint32, "r") if first[-1] else np.empty(0, np.uint32)
            found, scanned, source = _played(begin, first, held, k, None if user_cap is None else user_cap - len(begin), max_rounds, width, most)
        known = np.flatnonzero(found >= 0)
        for at in range(0, len(known), rows):
            users = known[at:at + rows]
            whose = np.full(len(users), -1) if source is None else source[users]
            yield pa.RecordBatch.from_arrays(
                [pa.array(users, pa.int32()), pa.array(found[users]), pa.array(scanned[users], mask=scanned[users] == 0),
                 pa.array(whose, pa.int64(), mask=whose < 0)], names=["place", "found_round", "scanned_round", "source"])

    played = cut_lineage(blocks.coalesce(1).sortWithinPartitions("block").mapInArrow(
        play, "place int, found_round int, scanned_round int, source bigint"))
    known = placed.join(played, "place").select("user_id", "followers_count", "found_round", "scanned_round", "source")
    if user_cap is not None:
        room = user_cap - played.filter("source IS NULL").count()
        # Without room nobody is cut off: no round was played.
        last = known.filter("source IS NOT NULL")
        known = known.filter("source IS NULL").unionByName(take(last, ["source", "user_id"], room) if room > 0 else last)
    return known.drop("source")
