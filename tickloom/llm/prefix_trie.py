"""Prefix trie of conversations, with subtree totals by a depth-band rollup.

A conversation is a sequence of turns; a node of the trie stands for one distinct sequence
of first turns, and its members are the conversations that start with it.

1. Every turn gets a hash of its depth and content in 2 x 64 bits. A prefix is known by
   the XOR of the hashes of its turns, so a conversation of any length is scanned in
   chunks of `CHUNK` turns whose totals are carried on.
2. Members are counted per prefix with partial aggregation.
3. Subtree totals: a node explodes to its strict ancestors within its band of `BAND`
   depths, `BAND` rows at most. That completes the totals of a band, but for what lies
   below its bottom nodes, which are the roots of the next bands. Band roots form a trie of
   1/`BAND` of the depth, whose totals are found in the same way; they are then sent up once
   more within the band. Rounds grow with the logarithm of the depth.
4. The ids that end at a node are joined by chunks of `ENDS` consecutive conversations;
   SHA-256, which is sequential, then runs over the chunks of a node in order.

No group of members is gathered: a first turn that a third of all conversations share is
a key of partial aggregates and of joins that adaptive execution can split.

- Rows with a null conversation id belong to no conversation and are left out. Null role and
  text count as empty, null turns come first; turns of one number are ordered by the SHA-256
  of role and text, and repeated rows are turns like others.
- Other columns are not read. An empty table gives no nodes, not even a root.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tickloom.operators.positions import add_positions
from tickloom.operators.sizing import attach
from tickloom.session import stage

BAND = 8
CHUNK = 1024
ENDS = 1024
KEY, PARENT = ["k1", "k2"], ["p1", "p2"]


def turns_in_order(conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One row per turn: `conv`, `at` (place among all turns, from 0, by conversation and
    turn), `content` (SHA-256 of role and text) and `n_bytes` of the text."""
    role, text = (F.coalesce(F.col(f"`{x}`").cast("string"), F.lit("")) for x in (role, text))
    content = F.unhex(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256))
    rows = conversations.select(
        F.col(f"`{conv}`").cast("long").alias("conv"), F.col(f"`{turn}`").alias("turn"),
        content.alias("content"), F.octet_length(text).cast("long").alias("n_bytes"),
    )
    rows = rows.where("conv IS NOT NULL")
    return add_positions(rows, ["conv", "turn", "content"], "at", start=0).drop("turn")


def with_heads_of(turns: DataFrame, head_of: Column, n_head: Column, most: int) -> tuple[DataFrame, DataFrame]:
    """Conversations whose first `n_head` turns (`most` at most) are replaced by those of
    conversation `head_of`, as far as it has them; both are columns over `conv`. Gives the turns
    (`conv`, `depth`, `content`, `n_bytes`) and the conversations (`conv`, `length`)."""
    turns = stage(turns, "turns")
    own = turns.groupBy("conv").agg(F.min("at").alias("first_at"), F.count(F.lit(1)).alias("n"))
    own = stage(own.withColumns({"source": head_of, "wanted": n_head.cast("long")}), "conversations")
    sizes = own.select(F.col("conv").alias("source"), F.col("n").alias("n_source"))
    rebuilt = own.join(sizes, "source", "left").select(
        "conv", "source", "first_at", "wanted", F.least("wanted", F.coalesce("n_source", F.lit(0))).alias("n_head"), "n"
    )
    rebuilt = stage(rebuilt.withColumn("length", F.col("n_head") + F.greatest(F.col("n") - F.col("wanted"), F.lit(0))), "rebuilt")
    placed = turns.join(rebuilt.select("conv", "first_at", "wanted", F.col("n_head").alias("shift")), "conv")
    placed = placed.withColumn("place", F.col("at") - F.col("first_at"))
    kept = placed.where("place >= wanted").select("conv", (F.col("shift") + F.col("place") - F.col("wanted") + 1).alias("depth"), "content", "n_bytes")
    starts = own.select("conv", "first_at")
    heads = turns.join(starts, "conv").where(F.col("at") - F.col("first_at") < most)
    heads = heads.select(F.col("conv").alias("source"), (F.col("at") - F.col("first_at") + 1).alias("depth"), "content", "n_bytes")
    given = rebuilt.where("n_head > 0").select("source", "conv", "n_head").join(heads, "source").where("depth <= n_head")
    return kept.unionByName(given.select("conv", "depth", "content", "n_bytes")), rebuilt.select("conv", "length")


def prefixes(turns: DataFrame) -> DataFrame:
    """Turns (`conv`, `depth` from 1, `content`, `n_bytes`) with the keys `k1`, `k2` of the prefix that
    ends with each, and `p1`, `p2` of the prefix before it."""
    rows = turns.withColumns({
        "x1": F.xxhash64(F.lit(1), "depth", "content"), "x2": F.xxhash64(F.lit(2), "depth", "content"),
        "chunk": F.floor((F.col("depth") - 1) / CHUNK),
    })
    rows = stage(rows.drop("content"), "prefix-turns")
    # Only conversations of more than one chunk have something to carry on.
    long = rows.where("chunk > 0").select("conv").distinct()
    totals = attach(rows, long, ["conv"], "left_semi").groupBy("conv", "chunk").agg(F.bit_xor("x1").alias("x1"), F.bit_xor("x2").alias("x2"))
    earlier = Window.partitionBy("conv").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    carried = totals.select("conv", "chunk", *[F.bit_xor(f"x{i}").over(earlier).alias(f"c{i}") for i in (1, 2)]).where("chunk > 0")
    within = Window.partitionBy("conv", "chunk").orderBy("depth").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.withColumns({f"k{i}": F.bit_xor(f"x{i}").over(within) for i in (1, 2)})
    rows = attach(rows, carried, ["conv", "chunk"])
    whole = {f"k{i}": F.col(f"k{i}").bitwiseXOR(F.coalesce(f"c{i}", F.lit(0))) for i in (1, 2)}
    rows = rows.withColumns(whole).withColumns({f"p{i}": F.col(f"k{i}").bitwiseXOR(F.col(f"x{i}")) for i in (1, 2)})
    return rows.select("conv", "depth", "n_bytes", *KEY, *PARENT)


def banded(rows: DataFrame) -> DataFrame:
    """Adds `path`: the keys of a row's strict ancestors in its band, from the band's root on.
    Depths 1 to `BAND` are a band, and so on; a band of a conversation is at most `BAND` rows."""
    band = F.floor((F.col("depth") - 1) / BAND)
    up = Window.partitionBy("conv", band).orderBy("depth").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return rows.withColumn("path", F.collect_list(F.struct(*PARENT)).over(up))


def summed_up(nodes: DataFrame, path: Column) -> DataFrame:
    """Sums `n_leaves` and `saved` of nodes at every key of their `path`."""
    spread = nodes.select(F.explode(path).alias("a"), "n_leaves", "saved")
    return totalled(spread.select(F.col("a.p1").alias("k1"), F.col("a.p2").alias("k2"), "n_leaves", "saved"))


def totalled(parts: DataFrame) -> DataFrame:
    return parts.groupBy(*KEY).agg(F.sum("n_leaves").alias("n_leaves"), F.sum("saved").alias("saved"))


def below(nodes: DataFrame, rows: DataFrame) -> DataFrame:
    """Per key the sums of `n_leaves` and `saved` over all nodes strictly below it. `nodes` has one
    row per key with `depth` and `path`; `rows` has the prefixes of every conversation."""
    inside = stage(summed_up(nodes, F.col("path")), "band-totals")
    if (nodes.agg(F.max("depth")).first()[0] or 0) <= BAND:
        return inside
    # The trie of the band roots: each has as its value what its band holds below it.
    is_root = F.col("depth") % BAND == 0
    fewer = rows.where(is_root & (F.col("depth") > 0)).withColumns({f"p{i}": F.col("path")[0][f"p{i}"] for i in (1, 2)})
    fewer = stage(banded(fewer.withColumn("depth", F.floor(F.col("depth") / BAND))), "band-roots")
    paths = fewer.groupBy(*KEY).agg(F.first("path").alias("up"))
    roots = nodes.where(is_root).select(*KEY, "depth", F.col("path").alias("own_path")).join(inside, KEY, "left")
    roots = roots.na.fill(0, ["n_leaves", "saved"]).join(paths, KEY, "left")
    roots = stage(roots.select(*KEY, F.floor(F.col("depth") / BAND).alias("depth"), "own_path", F.coalesce("up", F.array().cast("array<struct<p1:bigint,p2:bigint>>")).alias("path"), "n_leaves", "saved"), "roots")
    further = below(roots.drop("own_path"), fewer)
    whole = totalled(roots.select(*KEY, "n_leaves", "saved").unionByName(further))
    # What a bottom node has below it goes up its band, but for the band's root, which has it.
    bottoms = roots.where("depth > 0").select(*KEY, "own_path").join(whole, KEY)
    sent = summed_up(bottoms, F.slice("own_path", 2, BAND))
    return stage(totalled(inside.unionByName(sent).unionByName(further)), "subtree-totals")


def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of the comma-joined `ids` of each key; the rows of a key come in order."""
    key, state = None, None
    for batch in batches:
        done = []
        for k1, k2, ids in zip(*(batch.column(x).to_pylist() for x in ("k1", "k2", "ids"))):
            if (k1, k2) == key:
                state.update(b",")
            else:
                if key is not None:
                    done.append((*key, state.hexdigest()))
                key, state = (k1, k2), hashlib.sha256()
            state.update(ids.encode())
        yield digest_rows(done)
    if key is not None:
        yield digest_rows([(*key, state.hexdigest())])


def digest_rows(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [(), (), ()]
    kinds = (pa.int64(), pa.int64(), pa.string())
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["k1", "k2", "ends"])


def ends_of(rows: DataFrame, convs: DataFrame) -> DataFrame:
    """The digest of the ids that end at each key: of the last prefix of every conversation."""
    ranked = add_positions(convs, ["conv"], "rank", start=0)
    empty = ranked.where("length = 0").select("conv", "rank", *(F.lit(0).cast("long").alias(k) for k in KEY))
    last = ranked.where("length > 0").withColumnRenamed("length", "depth").join(rows, ["conv", "depth"]).select("conv", "rank", *KEY)
    chunks = last.unionByName(empty).groupBy(*KEY, F.floor(F.col("rank") / ENDS).alias("chunk")).agg(F.sort_array(F.collect_list("conv")).alias("ids"))
    chunks = chunks.select(*KEY, "chunk", F.array_join(F.col("ids").cast("array<string>"), ",").alias("ids"))
    # Chunks of a node are few: one per ENDS conversations of the whole table at most.
    return chunks.repartition(*KEY).sortWithinPartitions(*KEY, "chunk").drop("chunk").mapInArrow(digests, "k1 long, k2 long, ends string")


def prefix_trie(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """One row per node. `turns` has `conv`, `depth` (from 1 without gaps), `content` and `n_bytes`; `convs`
    has every `conv` once, also those without turns, with its `length`.

    Gives `conv_id` (smallest member), `depth`, `parent_conv_id` (null at the root), `n_convs`,
    `n_children`, `n_leaves` and `saved_tokens` of the subtree, and `ends_sha256`.
    """
    rows = stage(banded(prefixes(turns)), "prefixes")
    convs = stage(convs, "lengths")
    found = rows.groupBy(*KEY, *PARENT, "depth").agg(
        F.min("conv").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), F.max("n_bytes").alias("n_bytes"), F.first("path").alias("path"),
    )
    zero = F.lit(0).cast("long")
    top = convs.agg(F.min("conv").alias("conv_id"), F.count(F.lit(1)).alias("n_convs")).where("n_convs > 0").select(
        *(zero.alias(k) for k in KEY), *(F.lit(None).cast("long").alias(k) for k in PARENT), zero.alias("depth"),
        "conv_id", "n_convs", zero.alias("n_bytes"), F.array().cast("array<struct<p1:bigint,p2:bigint>>").alias("path"),
    )
    nodes = stage(found.unionByName(top), "nodes")
    children = nodes.where("depth > 0").groupBy(*(F.col(p).alias(k) for p, k in zip(PARENT, KEY))).agg(F.count(F.lit(1)).alias("n_children"))
    nodes = nodes.join(children, KEY, "left").na.fill(0, ["n_children"]).withColumns({
        "n_leaves": (F.col("n_children") == 0).cast("long"), "saved": (F.col("n_convs") - 1) * F.col("n_bytes"),
    })
    nodes = stage(nodes, "counted-nodes")
    under = below(nodes, rows).select(*KEY, F.col("n_leaves").alias("more_leaves"), F.col("saved").alias("more_saved"))
    parents = nodes.select(F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("conv_id").alias("parent_conv_id"))
    out = nodes.drop("path").join(under, KEY, "left").join(ends_of(rows, convs), KEY, "left").join(parents, PARENT, "left")
    return out.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children",
        (F.col("n_leaves") + F.coalesce("more_leaves", F.lit(0))).alias("n_leaves"),
        (F.col("saved") + F.coalesce("more_saved", F.lit(0))).alias("saved_tokens"),
        F.coalesce("ends", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256"),
    )
