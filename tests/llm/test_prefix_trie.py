"""The trie against a plain one built from lists, over blocks of every size."""

import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from folioflow.llm import prefix_trie

SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def rebuilt(rows):
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append((turn, role or "", text or ""))
    for c in own:
        own[c].sort(key=lambda t: (t[0] is not None, t[0] or 0, hashlib.sha256(f"{len(t[1])}:{t[1]}:{t[2]}".encode()).digest()[:16]))
        own[c] = [t[1:] for t in own[c]]
    found = {}
    for c in own:
        h, base = zlib.crc32(str(c).encode()) % 4, c - (abs(c) % 20) * (1 if c >= 0 else -1)
        found[c] = own.get(base, [])[:h] + own[c][h:]
    return found


def plain(convs):
    members = {}
    for c, path in convs.items():
        for d in range(len(path) + 1):
            members.setdefault(tuple(path[:d]), []).append(c)
    out = []
    for node, ids in members.items():
        below = [n for n in members if n[:len(node)] == node]
        ends = ",".join(str(c) for c in sorted(ids) if tuple(convs[c]) == node)
        out.append((
            min(ids), len(node), min(members[node[:-1]]) if node else None, len(ids),
            sum(len(n) == len(node) + 1 for n in below),
            sum(not any(len(m) == len(n) + 1 and m[:len(n)] == n for m in below) for n in below),
            sum((len(members[n]) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", n[-1][1])) for n in below if n),
            hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def got(convs, **kw):
    return sorted((tuple(r) for r in prefix_trie.trie(convs, **kw).drop("node").collect()), key=repr)


@pytest.fixture(scope="module")
def rows():
    """Few texts, so that prefixes are shared; a hot first turn, equal conversations, ends inside others."""
    rng = random.Random(4)
    out = []
    for c in range(150):
        for t in range(rng.randint(1, 5)):
            text = "hot start" if t == 0 and c % 3 else rng.choice(["yes", "no  way", "", None, "tell\tme more\x0bplease", "ü é"])
            out.append((c, t, rng.choice(["user", "user", None]), text))
    out += [(c, t, "user", "the same") for c in range(300, 360) for t in range(4)]
    out += [(-7, None, "user", "null first"), (-7, 0, "user", "then"), (-20, 1, None, None), (None, 0, "user", "nobody")]
    out += [(500, 1, "user", "b"), (500, 1, "user", "a"), (500, 1, "user", "a"), (500, None, "user", "z")]
    rng.shuffle(out)
    return out


@pytest.mark.parametrize("block", [1, 3, prefix_trie.BLOCK])
def test_trie_of_rebuilt_conversations(spark, rows, block):
    convs = prefix_trie.with_shared_heads(prefix_trie.turns(spark.createDataFrame(rows, SCHEMA)))
    assert got(convs, block=block) == plain(rebuilt(rows))


def test_many_shards(spark, rows):
    convs = prefix_trie.with_shared_heads(prefix_trie.turns(spark.createDataFrame(rows, SCHEMA).repartition(5)))
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert got(convs) == plain(rebuilt(rows))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_deep_conversation_and_extra_columns(spark):
    deep = [(1, t, "user", f"word {t % 7}") for t in range(1500)]
    df = spark.createDataFrame([(*r, "x", 1) for r in deep], SCHEMA + ", node string, `a.b` int")
    found = prefix_trie.trie(prefix_trie.turns(df))
    assert found.count() == 1501
    assert found.filter("depth = 0").first().n_leaves == 1


def test_empty_table(spark):
    assert got(prefix_trie.turns(spark.createDataFrame([], SCHEMA))) == []


def test_turnless_conversation(spark):
    """Conversation 1 keeps none of its turns and its base is absent: it ends at the root."""
    h = zlib.crc32(b"1") % 4
    assert h
    rows = [(1, t, "user", "x") for t in range(h)]
    convs = prefix_trie.with_shared_heads(prefix_trie.turns(spark.createDataFrame(rows, SCHEMA)))
    assert got(convs) == [(1, 0, None, 1, 0, 1, 0, hashlib.sha256(b"1").hexdigest())]
