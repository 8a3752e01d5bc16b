"""The prefix trie against a plain one: odd rows, deep conversations, several bands and chunks."""

import hashlib
import random
import zlib
from collections import defaultdict

from pyspark.sql import functions as F

from tickloom.llm import prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string, depth string, k1 int"


def ordered(rows):
    """Turns of each conversation, nulls first, ties by digest."""
    turns = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest()
            turns[conv].append(((turn is not None, turn or 0), digest, (role, text)))
    return {c: [x[2] for x in sorted(t, key=lambda x: x[:2])] for c, t in turns.items()}


def rebuilt(turns):
    out = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 9
        out[c] = turns.get(c - c % 5, [])[:h] + own[h:]
    return out


def plain_trie(convs):
    members = defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        own = (len(members[node]) - 1) * len(node[-1][1].encode()) if node else 0
        leaves[node] = sum(leaves[x] for x in children[node]) or 1
        saved[node] = own + sum(saved[x] for x in children[node])
    out = []
    for node, ids in members.items():
        ends = ",".join(str(c) for c in sorted(ids) if len(convs[c]) == len(node))
        up = min(members[node[:-1]]) if node else None
        out.append((min(ids), len(node), up, len(ids), len(children[node]), leaves[node], saved[node], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def query(spark, rows):
    frame = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA).repartition(3)
    turns = prefix_trie.turns_in_order(frame)
    n_head = F.crc32(F.col("conv").cast("string").cast("binary")) % 9
    found = prefix_trie.prefix_trie(*prefix_trie.with_heads_of(turns, F.col("conv") - F.col("conv") % 5, n_head, most=8))
    return sorted((tuple(r) for r in found.collect()), key=str)


def some_rows():
    pick = random.Random(8)
    rows = []
    for c in [*range(60), 1 << 40, (1 << 40) + 1]:
        for t in range(pick.choice([1, 2, 3, 9, 20])):
            rows.append((c, t, pick.choice(["user", "assistant", None]), pick.choice(["a", "b", "é", "", None])))
    rows += [(7, None, "user", "first"), (7, 0, "user", "tie"), (7, 0, "user", "tie"), (7, 0, "other", "tie")]
    rows += [(None, 0, "user", "nobody"), (None, None, None, None), (11, 5, "user", "y" * 100_000)]
    return rows


def test_equals_the_plain_trie(spark):
    rows = some_rows()
    assert query(spark, rows) == plain_trie(rebuilt(ordered(rows)))


def test_many_bands_and_chunks(spark, monkeypatch):
    """Bands of two depths, four levels of them, and conversations in chunks of four turns."""
    monkeypatch.setattr(prefix_trie, "BAND", 2)
    monkeypatch.setattr(prefix_trie, "CHUNK", 4)
    monkeypatch.setattr(prefix_trie, "ENDS", 3)
    rows = [(c, t, "user", "same" if t < 12 - c else f"{c} {t}") for c in range(10) for t in range(21)]
    convs = {c: [("user", x[3]) for x in rows if x[0] == c] for c in range(10)}
    turns = prefix_trie.turns_in_order(spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)).withColumnRenamed("at", "depth")
    turns = turns.withColumn("depth", F.col("depth") % 21 + 1)
    lengths = spark.createDataFrame([(c, 21) for c in range(10)], "conv long, length long")
    found = prefix_trie.prefix_trie(turns, lengths)
    assert sorted((tuple(r) for r in found.collect()), key=str) == plain_trie(convs)


def test_empty_table(spark):
    assert query(spark, [(None, 1, "user", "x")]) == []


def test_ends_are_in_numeric_order(spark):
    """Over several chunks of ids."""
    rows = [(c, 0, "user", "same") for c in range(2500, 0, -1)] + [(c, t, "user", f"turn {t}") for c in range(5000, 5100) for t in range(3)]
    assert query(spark, rows) == plain_trie(rebuilt(ordered(rows)))
