"""Phrase collocations: counts of frequent phrases by tries of Apriori-safe candidates.

Texts are lower-cased (A-Z) and cut into pieces at `[.,;:!?\\x0A-\\x0D]`; words are
`[^\\x20\\x09]+` of a piece; a phrase lies within a piece. Everything is counted per language.

1. Words are counted exactly. A phrase cannot be frequent unless its words are, so the corpus is
   written once as numbers of frequent words, where rare words and ends of pieces are breaks.
2. Level by level, for phrases of k words: where both phrases of k - 1 words are frequent, the
   occurrence falls into one of `2**bits` slots by its hash. A phrase whose slot counts less than
   `min_count` cannot be frequent; the others are the candidates, a superset of the frequent ones.
3. In a corpus of `SHARD_WORDS` words or more, one pass deals the occurrences of candidates to shards by a hash of the phrase, those of a task gathered
   first. A shard's candidates become a double-array trie, which all of its occurrences walk together, and
   accepting states are counted by bincount. In a smaller one tries of all candidates are broadcast, and its
   positions walk them. The tries of the frequent ones, `EDGE_SHARD` to a trie, are
   broadcast, `TRIES_AT_ONCE` in a pass, and give every position its state for the next level, where only
   stretches of text that are in such states are kept.
4. Scores, cuts and the rule on longer candidates are joins over the phrases found.

What is broadcast is bounded: `WORD_SHARD` keys of words or `TRIES_AT_ONCE * EDGE_SHARD` edges at a time, and
`2**MOST_BITS` bits of slots. Further words and further frequent phrases take further passes over the
numbered corpus; candidates do not. Large corpora fill the slots, which weakens the filter but
never drops a phrase: then more candidates are counted.

Words are known by 64-bit hashes while counting; the table of all words (told apart by a second hash
within a batch) is checked for two that share one, and if there are any, everything is hashed anew.

- Null text counts as empty, null language as `und` (and goes with it). Ids are not read, so
  repeated rows count each time. Other columns are not read. An empty table gives no rows.
- A text of any length is one row here; its words are hashed `RANGE` bytes at a time.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from contextlib import contextmanager
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tickloom.llm.double_array import Trie, build
from tickloom.llm.textual import LOWER, ODD, flat, mix, slices, span_hashes
from tickloom.operators.positions import add_positions
from tickloom.operators.sizing import attach
from tickloom.session import stage

WORD_SHARD = 4_000_000
EDGE_SHARD = 1_000_000
TRIES_AT_ONCE = 4
SHARD_WORDS = 2_000_000  # words of the corpus for each shard of candidates
MOST_BITS = 26
RANGE = 1 << 19
SLICE = 1 << 20
TEXTS_AT_ONCE = 1_000  # rows of a batch of texts; Spark's own number makes large batches of long texts
BLOCK = 1 << 16
PIECE = 1 << 12  # words of a row of the numbered corpus; Parquet holds a hundred rows or more at once
GATHERED = 1 << 18  # words that are worked on at once
HELD = 1_000_000  # distinct phrases that a task gathers before it hands them on
NO_LANGUAGE = "und"
SCORE_STEP = 100
SHARES = 64
PROOF = 1_000_000  # salt of the hash that proves a key, apart from the salts of keys

BREAK = np.isin(np.arange(256), [*b".,;:!?", *range(0x0A, 0x0E)])
GAP = BREAK | np.isin(np.arange(256), [0x20, 0x09])


def blobs(arrays: list[np.ndarray]) -> pa.Array:
    return pa.array([x.tobytes() for x in arrays], pa.binary())


def words_of(texts: pa.Array, langs: pa.Array, *salts: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[np.ndarray], np.ndarray, np.ndarray]:
    """The lower-cased bytes; start, end, keys (one per salt) and text of every word; and whether it goes on
    the piece of the word before."""
    data, offsets = flat(texts)
    data = LOWER[data]
    gap = np.concatenate(([True], GAP[data], [True]))
    new_text = np.zeros(len(data) + 1, bool)
    new_text[offsets] = True
    starts = np.flatnonzero(~gap[1:-1] & (gap[:-2] | new_text[:-1]))
    ends = np.flatnonzero(~gap[1:-1] & (gap[2:] | new_text[1:])) + 1
    owner = np.repeat(np.arange(len(texts)), np.diff(np.searchsorted(starts, offsets)))
    piece = np.searchsorted(np.flatnonzero(BREAK[data]), starts)
    joined = np.zeros(len(starts), bool)
    joined[1:] = (piece[1:] == piece[:-1]) & (owner[1:] == owner[:-1])
    names = langs.dictionary_encode()
    marks = [int.from_bytes(hashlib.blake2b(x.encode(), digest_size=8).digest(), "big") for x in names.dictionary.to_pylist()]
    lang = np.array(marks or [0], np.uint64)[names.indices.to_numpy()][owner]
    keys = [mix(hashes(data, starts, ends, salt) * ODD + lang).view(np.int64) for salt in salts]
    return data, starts, ends, keys, owner, joined


def hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, salt: int) -> np.ndarray:
    """A hash of each word, `RANGE` bytes at a time; another salt gives every byte another value in it."""
    values = np.random.default_rng(salt).permutation(256).astype(np.uint8)
    out, at = np.zeros(len(starts), np.uint64), 0
    while at < len(starts):
        stop = max(at + 1, int(np.searchsorted(ends, starts[at] + RANGE, "right")))
        lo, hi = starts[at], ends[stop - 1]
        out[at:stop] = span_hashes(values[data[lo:hi]], starts[at:stop] - lo, ends[at:stop] - lo)
        at = stop
    return out


def spelled(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """The words themselves."""
    to = np.concatenate(([0], np.cumsum(ends - starts)))
    picked = data[np.repeat(starts - to[:-1], ends - starts) + np.arange(to[-1])]
    return pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(to.astype(np.int64)), pa.py_buffer(picked)).cast(pa.string())


def count_words(batches: Iterator[pa.RecordBatch], salt: int) -> Iterator[pa.RecordBatch]:
    """Of each slice the distinct words of each language, with their number."""
    for batch in slices(batches, 1, SLICE):
        # A second hash tells words of one key apart here; the whole table is checked for them later.
        data, starts, ends, (keys, proof), owner, _ = words_of(batch.column(1), batch.column(0), salt, salt + PROOF)
        order = np.argsort(keys)
        keys, proof = keys[order], proof[order]
        new = np.flatnonzero(np.concatenate(([True], (keys[1:] != keys[:-1]) | (proof[1:] != proof[:-1])))[: len(keys)])
        first, n = order[new], np.diff(new, append=len(keys))
        langs = batch.column(0).take(pa.array(owner[first]))
        yield pa.RecordBatch.from_arrays([langs, spelled(data, starts[first], ends[first]), pa.array(keys[new]), pa.array(n)], ["lang", "word", "key", "n"])


def look_up(keys: np.ndarray, known: np.ndarray, first: int, ids: np.ndarray) -> np.ndarray:
    """`ids`, with `first` plus its place for every key in the sorted array `known`."""
    if not len(known):
        return ids
    at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
    return np.where(known[at] == keys, (first + at).astype(np.int32), ids)


def with_breaks(ids: np.ndarray, joined: np.ndarray) -> np.ndarray:
    """Word numbers with -1 between words of different pieces and at the end; runs of -1 become one."""
    ids = np.append(np.insert(ids, np.flatnonzero(~joined), np.int32(-1)), np.int32(-1))
    return ids[(ids >= 0) | (np.concatenate(([0], ids[:-1])) >= 0)]


def pieces(ids: np.ndarray, states: np.ndarray | None, k: int, after: np.ndarray | None = None) -> pa.RecordBatch:
    """Rows of about `PIECE` words; `states` are those of phrases of `k` words (None: words), `after` the next ones as far as
    they are known. A cut lies where no phrase of a word more than `k` goes across."""
    marks, dead = (ids if states is None else states) >= 0, np.ones(len(ids), bool)
    for i in range(max(1, k - 1)):
        dead[i:] &= ~marks[: len(ids) - i]
    places, ends = np.flatnonzero(dead) + 1, [0]
    while ends[-1] < len(ids):
        at = int(np.searchsorted(places, ends[-1] + PIECE))
        ends.append(int(places[at]) if at < len(places) else len(ids))
    spans = list(zip(ends[:-1], ends[1:]))
    cut = [pa.nulls(len(spans), pa.binary()) if x is None else blobs([x[a:b] for a, b in spans]) for x in (ids, states, after)]
    return pa.RecordBatch.from_arrays(cut, ["ids", "states", "next"])


def numbered(batches: Iterator[pa.RecordBatch], salt: int, shared, first: int) -> Iterator[pa.RecordBatch]:
    """The words of each slice by number, where `shared` holds all their keys."""
    for batch in slices(batches, 1, SLICE):
        _, _, _, (keys,), _, joined = words_of(batch.column(1), batch.column(0), salt)
        yield pieces(with_breaks(look_up(keys, shared.value, first, np.full(len(keys), -1, np.int32)), joined), None, 1)


def keyed(batches: Iterator[pa.RecordBatch], salt: int) -> Iterator[pa.RecordBatch]:
    """The keys of each small slice, to be numbered by several shards."""
    for batch in slices(batches, 1, SLICE // 16):
        _, _, _, (keys,), _, joined = words_of(batch.column(1), batch.column(0), salt)
        yield pa.RecordBatch.from_arrays([blobs([keys]), blobs([joined]), blobs([np.full(len(keys), -1, np.int32)])], ["keys", "joined", "ids"])


def numbered_further(batches: Iterator[pa.RecordBatch], shared, first: int, last: bool) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for keys, joined, ids in zip(*(x.to_pylist() for x in batch.columns)):
            found = look_up(np.frombuffer(keys, np.int64), shared.value, first, np.frombuffer(ids, np.int32))
            if last:
                yield pieces(with_breaks(found, np.frombuffer(joined, bool)), None, 1)
            else:
                yield pa.RecordBatch.from_arrays([pa.array([keys], pa.binary()), pa.array([joined], pa.binary()), blobs([found])], ["keys", "joined", "ids"])


def edges_of(ids: np.ndarray, states: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions whose phrase of `k` words may be frequent, as both of `k` - 1 words within it are, and the
    phrase as an edge from the state of the first of them."""
    at = np.flatnonzero((states[:-1] >= 0) & (states[1:] >= 0))
    return at, states[at].astype(np.int64) << 32 | ids[at + k - 1]


def texts_in(batches: Iterator[pa.RecordBatch]) -> Iterator[list[np.ndarray | None]]:
    """The blobs of rows as arrays, those of about `GATHERED` words together: rows end where no phrase goes on. Null blobs
    give None."""
    held, size = [], 0

    def together():
        return [None if x[0] is None else np.concatenate(x) for x in zip(*held)]

    for batch in batches:
        for i in range(batch.num_rows):
            held.append([np.frombuffer(x.as_buffer(), np.int32) if x.is_valid else None for x in (c[i] for c in batch.columns)])
            size += len(held[-1][0])
            if size >= GATHERED:
                yield together()
                held, size = [], 0
    if held:
        yield together()


def stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Word numbers and states; on the first level a word is its own state."""
    for ids, states in texts_in(batches):
        yield ids, ids if states is None else states


def slot_of(edges: np.ndarray, bits: int) -> np.ndarray:
    return (mix(edges.view(np.uint64) * ODD) >> np.uint64(64 - bits)).astype(np.int64)


def count_slots(batches: Iterator[pa.RecordBatch], k: int, bits: int, most: int) -> Iterator[pa.RecordBatch]:
    """How often each slot is met in this task, up to `most`, in blocks: as bytes, or as places and bytes of
    slots that are met at all, whichever is shorter."""
    table = None
    for ids, states in stretches(batches):
        _, edges = edges_of(ids, states, k)
        table = np.zeros(1 << bits, np.uint8) if table is None else table
        slots, n = np.unique(slot_of(edges, bits), return_counts=True)
        table[slots] = np.minimum(table[slots] + n, most)
    if table is None:
        return
    for i in range(0, len(table), BLOCK):
        block = table[i : i + BLOCK]
        met = np.flatnonzero(block).astype(np.uint16)
        if len(met):
            packed = met.tobytes() + block[met].tobytes() if 3 * len(met) < len(block) else block.tobytes()
            yield pa.RecordBatch.from_arrays([pa.array([i // BLOCK], pa.int32()), pa.array([3 * len(met) < len(block)]), pa.array([packed], pa.binary())], ["block", "sparse", "counts"])


def merge_slots(batches: Iterator[pa.RecordBatch], width: int, most: int) -> Iterator[pa.RecordBatch]:
    """Sums the blocks of all tasks, which come sorted, and gives a bit for each slot that reaches `most`."""
    now, total = None, None

    def bits():
        return pa.RecordBatch.from_arrays([pa.array([now], pa.int32()), blobs([np.packbits(total >= most, bitorder="little")])], ["block", "bits"])

    for batch in batches:
        for block, sparse, counts in zip(*(x.to_pylist() for x in batch.columns)):
            if block != now:
                if now is not None:
                    yield bits()
                now, total = block, np.zeros(width, np.int32)
            if sparse:
                n = len(counts) // 3
                total[np.frombuffer(counts, np.uint16, n)] += np.frombuffer(counts, np.uint8, n, 2 * n)
            else:
                total += np.frombuffer(counts, np.uint8)
            np.minimum(total, most, out=total)
    if now is not None:
        yield bits()


def distinct_edges(batches: Iterator[pa.RecordBatch], k: int, bits: int, full) -> Iterator[pa.RecordBatch]:
    """The phrases of this task whose slots are full."""
    held, fresh, size = np.zeros(0, np.int64), [], 0
    for ids, states in stretches(batches):
        edges = np.unique(edges_of(ids, states, k)[1])
        slots = slot_of(edges, bits)
        fresh.append(edges[full.value[slots >> 3] >> (slots & 7).astype(np.uint8) & 1 > 0])
        size += len(fresh[-1])
        if size > HELD:
            held, fresh, size = np.unique(np.concatenate([held, *fresh])), [], 0
            if len(held) > HELD:
                yield pa.RecordBatch.from_arrays([pa.array(held)], ["edge"])
                held = held[:0]
    yield pa.RecordBatch.from_arrays([pa.array(np.unique(np.concatenate([held, *fresh])))], ["edge"])


def count_edges(batches: Iterator[pa.RecordBatch], k: int, shared, first: int, size: int) -> Iterator[pa.RecordBatch]:
    """Walks the trie of one shard from all positions and counts where they arrive."""
    counts = np.zeros(size, np.int64)
    for ids, states in stretches(batches):
        _, edges = edges_of(ids, states, k)
        found = shared.value.find(edges >> 32, edges & 0xFFFFFFFF)
        counts += np.bincount(found[found >= 0], minlength=size)
    met = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array(first + met), pa.array(counts[met])], ["place", "n"])


def bytes_apart(values: np.ndarray) -> bytes:
    """The first bytes of all values, then the second ones and so on, which pack better."""
    return np.ascontiguousarray(values.view(np.uint8).reshape(len(values), -1).T).tobytes()


def bytes_together(data: bytes, kind) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(size, -1).T).reshape(-1).view(kind)


def gathered(edges: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct edges, and the sums of their counts."""
    edges, counts = np.concatenate(edges), np.concatenate(counts)
    order = np.argsort(edges, kind="stable")
    edges, total = edges[order], np.concatenate(([0], np.cumsum(counts[order])))
    first = np.flatnonzero(np.concatenate(([True], edges[1:] != edges[:-1]))[: len(edges)])
    return edges[first], np.diff(total[np.append(first, len(edges))])


def dealt_edges(batches: Iterator[pa.RecordBatch], k: int, bits: int, full, shards: int) -> Iterator[pa.RecordBatch]:
    """The phrases of this task whose slots are full, with their numbers, by shard."""
    none = np.zeros(0, np.int64)
    edges, counts, size, held = [none], [none], 0, 0

    def dealt():
        shard = (mix(edges[0].view(np.uint64)) % np.uint64(shards)).astype(np.int64)
        order = np.argsort(shard, kind="stable")
        cuts = np.searchsorted(shard[order], np.arange(shards + 1))
        for some in np.array_split(np.flatnonzero(np.diff(cuts)), -(-len(edges[0]) // GATHERED)) if len(edges[0]) else ():
            spans = [order[cuts[x] : cuts[x + 1]] for x in some]
            packed = [pa.array([bytes_apart(x[at]) for at in spans], pa.binary()) for x in (edges[0], counts[0])]
            yield pa.RecordBatch.from_arrays([pa.array(some), *packed], ["shard", "edges", "counts"])

    for ids, states in stretches(batches):
        found, n = np.unique(edges_of(ids, states, k)[1], return_counts=True)
        slots = slot_of(found, bits)
        there = full.value[slots >> 3] >> (slots & 7).astype(np.uint8) & 1 > 0
        edges.append(found[there])
        counts.append(n[there])
        size += len(edges[-1])
        if size > held + HELD:
            edges, counts = ([x] for x in gathered(edges, counts))
            size = held = len(edges[0])
            if held > HELD:
                yield from dealt()
                edges, counts, size, held = [none], [none], 0, 0
    edges, counts = ([x] for x in gathered(edges, counts))
    yield from dealt()


def count_dealt(batches: Iterator[pa.RecordBatch], min_count: int) -> Iterator[pa.RecordBatch]:
    """Builds the trie of the candidates of each shard, which come together, walks it from all of their occurrences
    and counts where they arrive."""
    now, edges, counts = None, [], []

    def frequent():
        found = np.concatenate(edges)
        candidates = np.unique(found)
        trie = build(candidates)
        places = trie.find(found >> 32, found & 0xFFFFFFFF)
        n = np.bincount(places, np.concatenate(counts), len(candidates)).astype(np.int64)  # exact up to 2**53
        often = np.flatnonzero(n >= min_count)
        return pa.RecordBatch.from_arrays([pa.array(candidates[often]), pa.array(n[often])], ["edge", "n"])

    for batch in batches:
        for i in range(batch.num_rows):
            shard = batch.column(0)[i].as_py()
            if shard != now:
                if now is not None:
                    yield frequent()
                now, edges, counts = shard, [], []
            edges.append(bytes_together(batch.column(1)[i].as_py(), np.int64))
            counts.append(bytes_together(batch.column(2)[i].as_py(), np.int64))
    if now is not None:
        yield frequent()


def advance(batches: Iterator[pa.RecordBatch], k: int, shared, first: int, last: bool) -> Iterator[pa.RecordBatch]:
    """The state of every position that the tries of some frequent phrases accept. After the `last` shard
    the old states go, and so do the words that no phrase in a state holds; a word without a state is left
    after each stretch."""
    for ids, states, after in texts_in(batches):
        states = ids if states is None else states
        at, edges = edges_of(ids, states, k)
        found = shared.value.find(edges >> 32, edges & 0xFFFFFFFF)
        after = np.full(len(ids), -1, np.int32) if after is None else after.copy()
        after[at[found >= 0]] = first + found[found >= 0]
        if last:
            held = np.zeros(len(ids) + k, bool)
            for i in range(k):
                held[i : i + len(ids)] |= after >= 0
            held = held[: len(ids)]
            yield pieces(ids[held], after[held], k)
        else:
            yield pieces(ids, states, k - 1, after)


def bit_table(blocks: DataFrame, bits: int) -> np.ndarray:
    """Blocks of bits (`block`, `bits`) as one array for `bits` bits."""
    table = np.zeros(-(-bits // BLOCK) * (BLOCK // 8), np.uint8)
    for block, packed in blocks.toLocalIterator():
        table[block * (BLOCK // 8) :][: len(packed)] = np.frombuffer(packed, np.uint8)
    return table


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Jobs within pass `TEXTS_AT_ONCE` rows at a time to Python, unless the session asks for fewer."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    if not 0 < int(before) <= TEXTS_AT_ONCE:
        spark.conf.set(key, str(TEXTS_AT_ONCE))
    try:
        yield
    finally:
        spark.conf.set(key, before)


class Shared:
    """Broadcast values that are given back when no pass needs them any longer."""

    def __init__(self, spark):
        self.context, self.held = spark.sparkContext, []

    def __call__(self, value):
        self.held.append(self.context.broadcast(value))
        return self.held[-1]

    def release(self):
        for x in self.held:
            x.unpersist()
        self.held = []


def sorted_shards(rows: DataFrame, column: str, number: str, size: int, shard: int) -> Iterator[tuple[int, np.ndarray]]:
    """The sorted values of `column`, `shard` at a time, each with the number of its first."""
    for first in range(0, size, shard):
        part = rows.where(F.col(number).between(first, first + shard - 1)).select(number, column).toArrow()
        values = np.empty(part.num_rows, np.int64)
        values[part.column(0).to_numpy() - first] = part.column(1).to_numpy()
        yield first, values


def frequent_words(rows: DataFrame, min_count: int) -> tuple[DataFrame, DataFrame, int]:
    """Frequent words (`id`, `lang`, `word`, `key`, `n`), the number of words per language, and the salt of the keys."""
    salt = 0
    while True:
        counted = rows.mapInArrow(lambda batches: count_words(batches, salt), "lang string, word string, key long, n long")
        with small_batches(rows.sparkSession):
            words = stage(counted.groupBy("lang", "word", "key").agg(F.sum("n").alias("n")), "words")
        if words.groupBy("key").agg(F.count(F.lit(1)).alias("words")).where("words > 1").isEmpty():
            break
        salt += 1
    frequent = add_positions(words.where(F.col("n") >= min_count), ["key"], "id", start=0)
    return stage(frequent, "frequent-words"), words.groupBy("lang").agg(F.sum("n").alias("n")), salt


def word_numbers(rows: DataFrame, words: DataFrame, n_words: int, salt: int) -> DataFrame:
    """The corpus as numbers of frequent words: blobs `ids`, with `states` and `next` still null."""
    share, numbers = Shared(rows.sparkSession), "ids binary, states binary, next binary"
    if n_words <= WORD_SHARD:
        known = share(next(sorted_shards(words, "key", "id", n_words, WORD_SHARD), (0, np.zeros(0, np.int64)))[1])
        with small_batches(rows.sparkSession):
            out = stage(rows.mapInArrow(lambda batches: numbered(batches, salt, known, 0), numbers), "word-numbers")
        share.release()
        return out
    with small_batches(rows.sparkSession):
        out = stage(rows.mapInArrow(lambda batches: keyed(batches, salt), "keys binary, joined binary, ids binary"), "word-keys")
    for first, keys in sorted_shards(words, "key", "id", n_words, WORD_SHARD):
        known, last = share(keys), first + WORD_SHARD >= n_words
        kind = numbers if last else "keys binary, joined binary, ids binary"
        step = lambda batches, known=known, first=first, last=last: numbered_further(batches, known, first, last)
        out = stage(out.mapInArrow(step, kind), "word-numbers")
        share.release()
    return out


def counted_by_tries(corpus: DataFrame, k: int, bits: int, full, min_count: int) -> DataFrame:
    """Frequent phrases (`edge`, `n`): every trie of candidates is broadcast and takes a pass."""
    share = Shared(corpus.sparkSession)
    edges = corpus.mapInArrow(lambda batches: distinct_edges(batches, k, bits, full), "edge long").distinct()
    candidates = stage(add_positions(edges, ["edge"], "place", start=0), "candidates")
    counts = [candidates.select("place", F.lit(0).cast("long").alias("n")).limit(0)]
    for first, part in sorted_shards(candidates, "edge", "place", candidates.count(), EDGE_SHARD):
        trie, size = share(build(part)), len(part)
        step = lambda batches, trie=trie, first=first, size=size: count_edges(batches, k, trie, first, size)
        counts.append(stage(corpus.mapInArrow(step, "place long, n long"), "counts"))
        share.release()
    summed = reduce(DataFrame.unionByName, counts).groupBy("place").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)
    return summed.join(candidates, "place").drop("place")


def counted_by_shards(corpus: DataFrame, k: int, bits: int, full, min_count: int, shards: int) -> DataFrame:
    """The same, where occurrences go to the shard of their candidate in one pass."""
    dealt = corpus.mapInArrow(lambda batches: dealt_edges(batches, k, bits, full, shards), "shard long, edges binary, counts binary")
    dealt = dealt.repartition("shard").sortWithinPartitions("shard")
    return stage(dealt.mapInArrow(lambda batches: count_dealt(batches, min_count), "edge long, n long"), "counts")


def next_level(corpus: DataFrame, k: int, bits: int, min_count: int, shards: int) -> tuple[DataFrame, int]:
    """Frequent phrases of `k` words (`gram`, `edge`, `n`) of a corpus with the states of `k` - 1 words, and how many they are."""
    share = Shared(corpus.sparkSession)
    most = min(min_count, 255)
    corpus = corpus.select("ids", "states")
    blocks = corpus.mapInArrow(lambda batches: count_slots(batches, k, bits, most), "block int, sparse boolean, counts binary")
    width = min(BLOCK, 1 << bits)
    merged = blocks.repartition("block").sortWithinPartitions("block").mapInArrow(lambda batches: merge_slots(batches, width, most), "block int, bits binary")
    full = share(bit_table(stage(merged, "slots"), 1 << bits))
    counted = counted_by_shards(corpus, k, bits, full, min_count, shards) if shards > 1 else counted_by_tries(corpus, k, bits, full, min_count)
    grams = stage(add_positions(counted, ["edge"], "gram", start=0), "grams")
    share.release()
    return grams, grams.count()


class Tries:
    """Tries of consecutive shards as one; each is given with the number of its first edge."""

    def __init__(self, tries: list[tuple[int, Trie]]):
        self.tries = tries

    def find(self, parents: np.ndarray, labels: np.ndarray) -> np.ndarray:
        out = np.full(len(parents), -1, np.int64)
        for first, trie in self.tries:
            found = trie.find(parents, labels)
            out[found >= 0] = first - self.tries[0][0] + found[found >= 0]
        return out


def in_states(corpus: DataFrame, k: int, grams: DataFrame, n: int) -> DataFrame:
    """The corpus with the states of phrases of `k` words, a pass for every `TRIES_AT_ONCE` shards of their tries."""
    share, tries = Shared(corpus.sparkSession), []
    for first, part in sorted_shards(grams, "edge", "gram", n, EDGE_SHARD):
        tries, last = [*tries, (first, build(part))], first + EDGE_SHARD >= n
        if last or len(tries) == TRIES_AT_ONCE:
            trie, first = share(Tries(tries)), tries[0][0]
            step = lambda batches, trie=trie, first=first, last=last: advance(batches, k, trie, first, last)
            corpus = stage(corpus.mapInArrow(step, "ids binary, states binary, next binary"), "states")
            share.release()
            tries = []
    return corpus


def phrases(rows: DataFrame, min_count: int, max_words: int, bits: int | None = None) -> tuple[DataFrame, DataFrame]:
    """All phrases of 1 to `max_words` words that occur `min_count` times or more in a language, of `rows`
    (`lang`, `text`): `words` (numbers), `lang`, `text`, `a`; and the number of words per language."""
    found, sizes, salt = frequent_words(rows, min_count)
    n_words = found.count()
    total = sizes.agg(F.sum("n")).first()[0] or 0
    bits = bits or min(MOST_BITS, max(16, total.bit_length() - 3))
    shards = -(-total // SHARD_WORDS) or 1
    corpus = word_numbers(rows, found, n_words, salt)
    level = found.select(F.col("id").alias("gram"), F.array("id").alias("words"), "lang", F.col("word").alias("text"), F.col("n").alias("a"))
    levels = [level]
    for k in range(2, max_words + 1):
        grams, n = next_level(corpus, k, bits, min_count, shards)
        before = level.select(F.col("gram").alias("before"), F.col("words").alias("start"), "lang", F.col("text").alias("head"))
        last = found.select(F.col("id").alias("last"), "word")
        spelled_out = grams.select("gram", F.col("n").alias("a"), F.shiftright("edge", 32).alias("before"), F.col("edge").bitwiseAND(F.lit(0xFFFFFFFF)).alias("last"))
        level = stage(spelled_out.join(before, "before").join(last, "last").select(
            "gram", F.concat("start", F.array("last")).alias("words"), "lang", F.concat_ws(" ", "head", "word").alias("text"), "a"
        ), "phrases")
        levels.append(level)
        if not n:
            break
        if k < max_words:
            corpus = in_states(corpus, k, grams, n)
    return reduce(DataFrame.unionByName, [x.drop("gram") for x in levels]), sizes


def top_ranked(scored: DataFrame, top: int) -> DataFrame:
    """The `top` rows of every language with their `rank`. Scores are at most 10**6, so rows are counted by
    steps of `SCORE_STEP` first, and only those down to the step of the last rank go on; of these, tasks
    rank shares by a hash of the phrase before a task ranks a language."""
    step = F.floor(F.col("best.score") / SCORE_STEP)
    down = Window.partitionBy("lang").orderBy(F.desc("step")).rowsBetween(Window.unboundedPreceding, -1)
    steps = scored.groupBy("lang", step.alias("step")).agg(F.count(F.lit(1)).alias("n"))
    steps = steps.withColumn("above", F.coalesce(F.sum("n").over(down), F.lit(0))).where(F.col("above") < top)
    least = steps.groupBy("lang").agg(F.min("step").alias("least"))
    rows = attach(scored, least, ["lang"]).where(step >= F.col("least")).drop("least")
    best = [F.desc("best.score"), F.desc("a"), "text"]
    share = Window.partitionBy("lang", F.pmod(F.xxhash64("text"), F.lit(SHARES))).orderBy(*best)
    rows = rows.withColumn("rank", F.row_number().over(share)).where(F.col("rank") <= top)
    return rows.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*best)).cast("long")).where(F.col("rank") <= top)


def collocations(
    docs: DataFrame, min_count: int = 10, max_words: int = 3, top: int = 2000, inside_percent: int = 50,
    lang_col: str = "lang", text_col: str = "text", bits: int | None = None,
) -> DataFrame:
    """The `top` phrases of 2 to `max_words` words of every language: `lang`, `rank`, `phrase`, `a` (its count),
    `l` and `r` (counts of the parts of its weakest cut), `n` (words of the language) and `score`, which is
    floor(10**6 * a * a / (l * r)). Left out is a phrase within a longer one whose count is `inside_percent`
    of its own or more. Counts up to 10**15 are exact."""
    rows = docs.select(F.coalesce(F.col(f"`{lang_col}`").cast("string"), F.lit(NO_LANGUAGE)).alias("lang"), F.col(f"`{text_col}`").cast("string").alias("text"))
    known, sizes = phrases(rows, min_count, max_words, bits)
    known = known.withColumn("size", F.size("words"))
    whole = known.where("size > 1")
    cuts = whole.select("words", "lang", "text", "a", "size", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k"))
    left = known.select(F.col("words").alias("left"), F.col("a").alias("l"))
    right = known.select(F.col("words").alias("right"), F.col("a").alias("r"))
    cuts = cuts.withColumns({"left": F.slice("words", F.lit(1), F.col("k")), "right": F.slice("words", F.col("k") + 1, F.col("size") - F.col("k"))})
    cuts = cuts.join(left, "left").join(right, "right")
    exact = {x: f"CAST({x} AS DECIMAL(15,0))" for x in "alr"}
    score = F.expr(f"(CAST(1000000 AS DECIMAL(7,0)) * {exact['a']} * {exact['a']}) div ({exact['l']} * {exact['r']})")
    best = F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("best")
    scored = cuts.groupBy("words", "lang", "text", "a").agg(best)
    shorter = F.flatten(F.transform(
        F.sequence(F.lit(2), F.col("size") - 1),
        lambda n: F.transform(F.sequence(F.lit(1), F.col("size") - n + 1), lambda i: F.slice("words", i, n)),
    ))
    held = whole.where("size > 2").select(F.explode(shorter).alias("words"), F.col("a").alias("longer"))
    held = held.groupBy("words").agg(F.max("longer").alias("longer"))
    left_over = scored.join(held, "words", "left").where(F.coalesce(100 * F.col("longer") < inside_percent * F.col("a"), F.lit(True)))
    ranked = top_ranked(stage(left_over, "scored"), top)
    sizes = stage(sizes, "language-sizes")
    return ranked.join(sizes, "lang").select("lang", "rank", F.col("text").alias("phrase"), "a", F.col("best.l").alias("l"), F.col("best.r").alias("r"), "n", F.col("best.score").alias("score"))
