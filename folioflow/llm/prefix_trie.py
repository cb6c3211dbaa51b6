"""The trie of conversation prefixes, from vertical bitmaps.

Conversations are sorted by their turns' digests, so that a node's members lie in a row, and the
order is cut into blocks. A block indexes each (position, turn) to the bitset of its conversations;
walking depth first, a parent's bitset and a posting give a child, the popcount its members, and
what remains of the bitset its ends. A block's nodes are partial: members, ends and sums add up over
blocks. What may count once only (a node's words, its place among its parent's children, its being a
leaf) is counted by the block that holds the node's first conversation, or for leaves the last one
that ends there: a block knows how far its first conversation agrees with the one before it.

With W(v) the words of a node's last text, a subtree saves the sum of (members - 1) W(v): the words
that its members say from there on, which adds up over conversations, less the sum of W(v) over
distinct nodes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from folioflow.llm.common import session
from folioflow.session import cut_lineage

# Bytes of a turn's and a node's digest.
WIDTH = 16
# Conversations per block, the bits of a bitset, and turns after which a block ends early.
BLOCK = 4096
BLOCK_TURNS = 1 << 17
ROOT = b"\0" * WIDTH
_WORD = r"[^\x20\x09-\x0D]+"


def turns(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
          text_col: str = "text") -> DataFrame:
    """``conv_id, turns``: a conversation's turns in order, each as the digest of role and text and
    the text's words. Null turn numbers come first, ties go by digest; a null role or text is empty.
    Rows without a conversation id belong to none and are passed over."""
    session(rows.sparkSession)
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in (role_col, text_col))
    key = F.substring(F.sha2(F.concat_ws(":", F.length(role).cast("string"), role, text), 256), 1, 2 * WIDTH)
    said = rows.filter(F.col(conv_col).isNotNull()).select(
        F.col(conv_col).cast("bigint").alias("conv_id"), F.col(turn_col).alias("at"), key.alias("key"),
        F.regexp_count(text, F.lit(_WORD)).alias("words"))
    return said.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("at", "key", "words"))).alias("turns"))


def with_shared_heads(convs: DataFrame, every: int = 20) -> DataFrame:
    """Conversation c begins with the first h turns of conversation c - c % ``every``, h the CRC-32
    of its number mod 4, and goes on with its own turns after its first h."""
    h = (F.crc32(F.encode(F.col("conv_id").cast("string"), "UTF-8")) % 4).cast("int")
    base = F.col("conv_id") - F.col("conv_id") % every
    heads = convs.filter(F.col("conv_id") % every == 0).select(
        F.col("conv_id").alias("base"), F.slice("turns", 1, 3).alias("head"))
    joined = convs.withColumn("base", base).withColumn("h", h).join(heads, "base", "left")
    none = F.array().cast(convs.schema["turns"].dataType)
    head = F.when((F.col("h") > 0) & F.col("head").isNotNull(), F.slice("head", 1, F.col("h"))).otherwise(none)
    own = F.slice("turns", F.col("h") + 1, F.greatest(F.lit(0), F.size("turns") - F.col("h")))
    return joined.select("conv_id", F.concat(head, own).alias("turns"))


def common_turns(a: bytes | None, b: bytes | None) -> int:
    """How many turns two paths share at their start; -1 if one of them is missing."""
    if a is None or b is None:
        return -1
    low, high = 0, min(len(a), len(b)) // WIDTH
    while low < high:
        mid = (low + high + 1) // 2
        low, high = (mid, high) if a[:mid * WIDTH] == b[:mid * WIDTH] else (low, mid - 1)
    return low


def child_digest(parent: bytes, turn: bytes) -> bytes:
    return hashlib.sha256(parent + turn).digest()[:WIDTH]


def block_nodes(ids: list[int], paths: list[bytes], words: list, agreed: int, goes_on: int) -> Iterator[tuple]:
    """The partial nodes of one block, its conversations sorted by path and id.

    ``agreed`` is how many turns the first conversation shares with the one before the block, -1 if
    there is none; ``goes_on`` the same between the last and the one after. Yields node, parent,
    depth, members, least id, words of the last text, words said below, words owned below, owned
    children, leaves, end ids, children.
    """
    postings: dict[tuple[int, bytes], int] = {}
    ends: dict[int, int] = {}
    cut = [[path[i:i + WIDTH] for i in range(0, len(path), WIDTH)] for path in paths]
    for n, path in enumerate(cut):
        for at, turn in enumerate(path):
            postings[at, turn] = postings.get((at, turn), 0) | 1 << n
        ends[len(path)] = ends.get(len(path), 0) | 1 << n
    last = len(ids) - 1

    def numbers(bits: int) -> Iterator[int]:
        while bits:
            low = bits & -bits
            yield low.bit_length() - 1
            bits ^= low

    # A frame: node, parent, depth, bitset, what is left of it, first member, then sums.
    def opened(node: bytes, parent: bytes | None, depth: int, bits: int) -> list:
        first = (bits & -bits).bit_length() - 1
        own = words[first][depth - 1] if depth else 0
        done = bits & ends.get(depth, 0)
        mine = not (first == 0 and depth <= agreed)
        done_ids = [ids[n] for n in numbers(done)]
        return [node, parent, depth, bits, bits & ~done, own, own * bits.bit_count(), own if mine else 0, 0, 0, done_ids, [], mine,
                min((ids[n] for n in numbers(bits)))]

    stack = [opened(ROOT, None, 0, (1 << len(ids)) - 1)]
    while stack:
        top = stack[-1]
        depth, left = top[2], top[4]
        if left:
            first = (left & -left).bit_length() - 1
            turn = cut[first][depth]
            # All of ``left`` have a turn at this position, so the parent's ends are not met again.
            bits = left & postings[depth, turn]
            top[4] = left & ~bits
            node = child_digest(top[0], turn)
            top[11].append(node)
            stack.append(opened(node, top[0], depth + 1, bits))
            continue
        stack.pop()
        node, parent, depth, bits, _, own, said, owned, children, leaves, done_ids, below, mine, least = top
        if not below and not (bits >> last & 1 and goes_on >= depth):
            leaves += 1
        yield node, parent, depth, bits.bit_count(), least, own, said, owned, children, leaves, done_ids, below
        if stack:
            up = stack[-1]
            up[6] += said
            up[7] += owned
            up[8] += mine
            up[9] += leaves


_PARTIAL = pa.schema([
    ("node", pa.binary()), ("parent", pa.binary()), ("depth", pa.int64()), ("members", pa.int64()),
    ("least", pa.int64()), ("own", pa.int64()), ("said", pa.int64()), ("owned", pa.int64()),
    ("children", pa.int64()), ("leaves", pa.int64()), ("ends", pa.list_(pa.int64())), ("below", pa.list_(pa.binary())),
])
_PARTIAL_DDL = ("node binary, parent binary, depth bigint, members bigint, least bigint, own bigint, said bigint, "
                "owned bigint, children bigint, leaves bigint, ends array<bigint>, below array<binary>")


def partial_nodes(sorted_: DataFrame, block: int = BLOCK) -> DataFrame:
    """Blocks' nodes from ``shard, conv_id, path, words, agreed, goes_on``, shards whole in a task
    and in order. A task holds one block, and one conversation of the next."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        shard, agreed, goes_on, size = None, -1, -1, 0

        def out(following: int) -> Iterator[pa.RecordBatch]:
            ids, paths, words = zip(*held)
            found = list(block_nodes(ids, paths, words, agreed, following))
            for at in range(0, len(found), 5000):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, f.type) for c, f in zip(zip(*found[at:at + 5000]), _PARTIAL)], schema=_PARTIAL)

        for batch in batches:
            for at, conv, path, said, before, after in zip(*(c.to_pylist() for c in batch.columns)):
                if at != shard:
                    if held:
                        yield from out(goes_on)
                    held, shard, agreed, goes_on, size = [], at, before, after, 0
                elif len(held) == block or size >= BLOCK_TURNS:
                    shared = common_turns(held[-1][1], path)
                    yield from out(shared)
                    held, agreed, size = [], shared, 0
                held.append((conv, path, said))
                size += len(said)
        if held:
            yield from out(goes_on)

    return sorted_.select("shard", "conv_id", "path", "words", "agreed", "goes_on").mapInArrow(run, _PARTIAL_DDL)


def _agreement(a: Column, b: Column) -> Column:
    @F.udf("int", useArrow=True)
    def shared(x, y):
        return common_turns(x, y)

    return shared(a, b)


def merged(partial: DataFrame) -> DataFrame:
    """One row per node: sums over its blocks, and the SHA-256 of its end ids. A node's partial rows
    stream by in the order of their ends, so a hot node costs a task time but no memory."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["node", "depth", "members", "least", "own", "said", "owned", "children", "leaves", "ends_sha256"]
        node, sums, digest, done = None, None, None, []

        def rows():
            found = [[r[i] for r in done] for i in range(len(names))]
            kinds = [pa.binary(), *[pa.int64()] * 8, pa.string()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(found, kinds)], names=names)

        def close():
            done.append((node, *sums, digest.hexdigest()))

        for batch in batches:
            for key, depth, members, least, own, said, owned, children, leaves, ends in zip(*(c.to_pylist() for c in batch.columns)):
                if key != node:
                    if node is not None:
                        close()
                    node, sums, digest, any_end = key, [depth, 0, least, own, 0, 0, 0, 0], hashlib.sha256(), False
                for i, value in ((1, members), (4, said), (5, owned), (6, children), (7, leaves)):
                    sums[i] += value
                sums[2] = min(sums[2], least)
                if ends:
                    digest.update((b"," if any_end else b"") + ",".join(map(str, ends)).encode())
                    any_end = True
            if len(done) >= 5000:
                yield rows()
                done.clear()
        if node is not None:
            close()
        if done:
            yield rows()

    columns = ["node", "depth", "members", "least", "own", "said", "owned", "children", "leaves", "ends"]
    ordered = partial.select(*columns, F.get("ends", F.lit(0)).alias("first_end")).repartition("node").sortWithinPartitions(
        "node", "first_end")
    return ordered.select(*columns).mapInArrow(
        run, "node binary, depth bigint, members bigint, least bigint, own bigint, said bigint, owned bigint, "
             "children bigint, leaves bigint, ends_sha256 string")


def trie(convs: DataFrame, block: int = BLOCK) -> DataFrame:
    """``node, conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256``.

    ``convs`` has ``conv_id, turns`` as ``turns`` gives them, an id once. A node is a distinct
    sequence of first turns; the root, the empty one, is there if any conversation is, and counts
    turnless conversations among its ends. No conversations give no nodes. Extra columns are not read.
    """
    session(convs.sparkSession)
    keys = F.transform("turns", lambda t: t["key"])
    laid = cut_lineage(convs.select(
        "conv_id", F.unhex(F.array_join(keys, "")).alias("path"), F.transform("turns", lambda t: t["words"]).alias("words")))
    # Equal paths are parted by their ids, so that a hot conversation spans many shards.
    spread = cut_lineage(laid.repartitionByRange("path", "conv_id").withColumn("shard", F.spark_partition_id()))
    ranges = spread.groupBy("shard").agg(F.min("path").alias("first"), F.max("path").alias("last"))
    # One row per shard: all that is looked at together.
    order = Window.orderBy("shard")
    edges = cut_lineage(ranges.select(
        "shard", _agreement(F.lag("last").over(order), F.col("first")).alias("agreed"),
        _agreement(F.col("last"), F.lead("first").over(order)).alias("goes_on")))
    sorted_ = spread.join(F.broadcast(edges), "shard").repartition("shard").sortWithinPartitions("shard", "path", "conv_id")
    partial = cut_lineage(partial_nodes(sorted_, block))
    nodes = cut_lineage(merged(partial))
    # A parent goes to its children once per block, so that many children are not many rows of one key.
    above = partial.filter(F.size("below") > 0).select("node", "below").join(nodes.select("node", "least"), "node")
    parents = above.select(F.explode("below").alias("node"), F.col("least").alias("parent_conv_id")).groupBy("node").agg(
        F.any_value("parent_conv_id").alias("parent_conv_id"))
    return nodes.join(parents, "node", "left").select(
        "node", F.col("least").alias("conv_id"), "depth", "parent_conv_id", F.col("members").alias("n_convs"),
        F.col("children").alias("n_children"), F.col("leaves").alias("n_leaves"),
        (F.col("said") - F.col("owned")).alias("saved_tokens"), "ends_sha256")
