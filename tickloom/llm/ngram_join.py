"""Similarity self-join of documents on word n-grams, with adaptive multi-match prefixes.

A document's set holds the distinct hashes of its n-word shingles (A-Z in lower case);
with fewer words, the whole sequence is its one shingle. Two documents link when
`den * |A & B| >= num * |A | B|`. Documents with equal sets are one class; only classes
are compared.

1. In the order of their hashes, any two linked classes share at least `m` shingles of their
   first `spare + m`, for every `m`. Each class asks for `m = spare + 4` and deals that prefix,
   about two fifths of its set at 0.8 and a fifth at 0.9, to buckets as packed arrays. A bucket
   knows how many classes hold a shingle and passes on those that two or more hold. A class
   with fewer than `m` of these has no link and is done.
2. The others order what they share by rarity and take a prefix of it that must hold at
   least `k` shared shingles, for the `k` with the least estimated cost: postings to read, and
   candidates to verify, which are at most the postings divided by `k`.
3. Classes that meet at a shingle of their prefixes, directly or through others, form a
   family. A family of more than `BLOCK_CLASSES` classes or `BLOCK_SHINGLES` shingles is
   cut into blocks that meet pairwise, so each class is sent once per block of its family.
   Before that, each class of such a family is compared with one leader, the first class of the
   shingles of its prefix that most of them name. What that joins needs no further pairs among
   itself: a shingle whose classes are all joined goes, a class that is left with too few
   goes too, and the rest forms smaller families. Blocks of `LIGHT_CLASSES` of these meet with prefixes and
   sketches of `SKETCH_BITS` bits first (each shingle flips one, so that differing bits are shingles of one set
   only), and only the classes of a pair that may link meet with all their shingles.
4. In a block, pairs that share as many prefix shingles as the smaller of their `k`, and
   whose sizes allow a link, are verified. It reports the links that join what it has not
   joined yet, so their number follows that of its classes.
5. Components of the links give each document the smallest id it is linked with.

Texts are read again for the shingles of the classes that met: a table of `WANTED_BITS` bits keeps others
out of the shuffle.

Postings know shingles by 48 and classes by 64 bits of hash, where a collision costs time only;
links are verified on 64 bits of each shingle, and equal sets on 128 of the whole. Null and empty texts and texts
without a word have no shingle and link with nothing; their component is their own id.
Rows with a null id belong to classes like others; a component of null ids only has none.
Repeated rows and ids are rows like others. Columns other than id and text are not read.
An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.llm.components import components
from tickloom.llm.textual import LOWER, ODD, flat, fresh_name, gram_hashes, inside, mix, slices, span_hashes, spans
from tickloom.session import stage

CLASS = np.dtype([("h1", "<u8"), ("h2", "<u8"), ("n", "<i4")])
POSTED = np.dtype([("h1", "<u8"), ("n", "<i4")])
MORE = 4
BUCKET_SHINGLES = 2_000_000
CHUNK_SHINGLES = 1_500_000
CHUNK_CLASSES = 60_000
MOST_MATCHES = 8
BLOCK_CLASSES = 512
BLOCK_SHINGLES = 2_000_000
LIGHT_CLASSES = 2048
SKETCH_BITS = 1024
RARE = 12  # a shingle of fewer than one in so many classes is counted by its pairs
PAIRS_AT_ONCE = 1 << 21
VERIFY = 0.02
WANTED_BITS = 27
WANTED_BLOCK = 1 << 16


def shingles(texts: pa.Array, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text, sorted within it, and their offsets."""
    data, offsets = flat(texts)
    data = LOWER[data]
    starts, ends, first = spans(data, offsets)
    words = span_hashes(data, starts, ends)
    counts = np.diff(first)
    at = inside(first, k)
    hashes = [gram_hashes(words, k)[at] if len(at) else np.zeros(0, np.uint64)]
    owners = [np.repeat(np.arange(len(texts)), counts)[at]]
    for few in range(1, k):
        short = np.flatnonzero(counts == few)
        hashes.append(mix(gram_hashes(words, few)[first[:-1][short]] + np.uint64(few)) if len(short) else np.zeros(0, np.uint64))
        owners.append(short)
    hash_, owner = np.concatenate(hashes), np.concatenate(owners)
    order = np.lexsort((hash_, owner))
    hash_, owner = hash_[order], owner[order]
    new = np.ones(len(owner), bool)
    new[1:] = (hash_[1:] != hash_[:-1]) | (owner[1:] != owner[:-1])
    return hash_[new], np.concatenate(([0], np.cumsum(np.bincount(owner[new], minlength=len(texts)))))


def class_keys(hashes: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The class of each text: two sums over its set, and the size of the set."""
    out = np.zeros(len(offsets) - 1, CLASS)
    for name, salt in (("h1", 0x51ED270B), ("h2", 0xA0761D6478BD642F)):
        total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mix(hashes ^ np.uint64(salt)))))
        out[name] = total[offsets[1:]] - total[offsets[:-1]]
    out["n"] = np.diff(offsets)
    return out


def wanted_slot(key: np.ndarray, row: np.ndarray) -> np.ndarray:
    """The place of a class and a row of it in the table of those that are wanted."""
    return (mix(key + row.view(np.uint64) * ODD) >> np.uint64(64 - WANTED_BITS)).astype(np.int64)


def first_half(keys: pa.Array) -> np.ndarray:
    """The first half of class keys, as postings know it."""
    return np.frombuffer(b"".join(x[:8] for x in keys.to_pylist()), ">u8").astype(np.uint64)


def wanted_slots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        slot = wanted_slot(first_half(batch.column(0)), batch.column(1).to_numpy())
        yield pa.RecordBatch.from_arrays([pa.array(slot // WANTED_BLOCK), pa.array(slot % WANTED_BLOCK)], ["block", "slot"])


def block_bits(group: pa.Table) -> pa.Table:
    table = np.zeros(WANTED_BLOCK, bool)
    table[group.column("slot").to_numpy()] = True
    return pa.table({"block": group.column("block").slice(0, 1), "bits": pa.array([np.packbits(table, bitorder="little").tobytes()], pa.binary())})


def wanted_texts(batches: Iterator[pa.RecordBatch], k: int, table) -> Iterator[pa.RecordBatch]:
    """Class key, row and text of rows (`row`, `text`) whose place in the table is taken."""
    for batch in slices(batches, 1):
        keys = class_keys(*shingles(batch.column(1), k))
        slot = wanted_slot(keys["h1"], batch.column(0).to_numpy())
        kept = np.flatnonzero((table.value[slot >> 3] >> (slot & 7).astype(np.uint8) & 1 > 0) & (keys["n"] > 0))
        at = pa.array(kept)
        yield pa.RecordBatch.from_arrays([as_binary(keys[kept]), batch.column(0).take(at), batch.column(1).take(at)], ["key", "row", "text"])


def as_binary(keys: np.ndarray) -> pa.Array:
    packed = np.ascontiguousarray(keys[["h1", "h2"]]).astype([("h1", ">u8"), ("h2", ">u8")]).tobytes()
    return pa.array([packed[i : i + 16] for i in range(0, len(packed), 16)], pa.binary())


def classed(batches: Iterator[pa.RecordBatch], k: int, names: list[str]) -> Iterator[pa.RecordBatch]:
    last = len(names) - 2  # the text
    for batch in slices(batches, last):
        keys = class_keys(*shingles(batch.column(last), k))
        yield pa.RecordBatch.from_arrays([*batch.columns[:-1], as_binary(keys), pa.array(keys["n"].astype(np.int64))], names)


def demand(n: np.ndarray, num: int, den: int) -> tuple[np.ndarray, np.ndarray]:
    """For sets of size n, what a link can spare of it, and how many matches are asked of the
    first `spare + matches` shingles. Both grow with n."""
    needed = -(-num * n // den)
    return n - needed, np.minimum(needed, n - needed + MORE)


def pack(shingle: np.ndarray) -> bytes:
    return np.ascontiguousarray(shingle).view(np.uint8).reshape(-1, 8)[:, :6].tobytes()


def unpack(data: bytes) -> np.ndarray:
    out = np.zeros((len(data) // 6, 8), np.uint8)
    out[:, :6] = np.frombuffer(data, np.uint8).reshape(-1, 6)
    return out.view(np.uint64).ravel()


def distinct_classes(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct classes, and the place of each given one among them."""
    rest = keys["h2"] if "h2" in keys.dtype.names else keys["n"]
    order = np.lexsort((rest, keys["h1"]))
    ordered, rest = keys[order], rest[order]
    new = np.ones(len(keys), bool)
    new[1:] = (ordered["h1"][1:] != ordered["h1"][:-1]) | (rest[1:] != rest[:-1])
    place = np.empty(len(keys), np.int64)
    place[order] = np.cumsum(new) - 1
    return ordered[new], place


def dealt(batches: Iterator[pa.RecordBatch], k: int, num: int, den: int, buckets: int) -> Iterator[pa.RecordBatch]:
    """For each bucket, the prefix shingles of a chunk of classes and which class holds each."""
    keys, hashes, owners, held, classes = [], [], [], 0, 0

    def flush():
        if not held:
            return
        unique, place = distinct_classes(np.concatenate(keys))
        hash_, owner = np.concatenate(hashes), place[np.concatenate(owners)]
        order = np.lexsort((owner, hash_))
        hash_, owner = hash_[order], owner[order]
        new = np.ones(len(hash_), bool)  # copies within the chunk count once
        new[1:] = (hash_[1:] != hash_[:-1]) | (owner[1:] != owner[:-1])
        hash_, owner = hash_[new], owner[new].astype("<u2")
        bucket = ((hash_ >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)
        cuts = np.searchsorted(bucket, np.arange(buckets + 1))
        rows = []
        for b in np.flatnonzero(np.diff(cuts)):
            part = slice(cuts[b], cuts[b + 1])
            used, local = np.unique(owner[part], return_inverse=True)
            rows.append((int(b), pack(hash_[part] >> np.uint64(16)), local.astype("<u2").tobytes(), unique[used].tobytes()))
        yield pa.RecordBatch.from_arrays([pa.array(list(x)) for x in zip(*rows, strict=True)], ["bucket", "shingles", "owners", "classes"])

    for batch in slices(batches, 0):
        found, offsets = shingles(batch.column(0), k)
        if held and (held + len(found) > CHUNK_SHINGLES or classes + len(batch) > CHUNK_CLASSES):
            yield from flush()
            keys, hashes, owners, held, classes = [], [], [], 0, 0
        own = np.zeros(len(batch), POSTED)
        for x in POSTED.names:
            own[x] = class_keys(found, offsets)[x]
        spare, matches = demand(own["n"].astype(np.int64), num, den)
        owner = np.repeat(np.arange(len(own)), np.diff(offsets))
        front = np.arange(len(found)) - offsets[owner] < (spare + matches)[owner]
        keys.append(own)
        hashes.append(found[front])
        owners.append(classes + owner[front])
        held, classes = held + int(front.sum()), classes + len(own)
    yield from flush()


PARTS = [("bucket", pa.int64()), ("shingles", pa.binary()), ("owners", pa.binary()), ("classes", pa.binary()), ("counts", pa.binary())]


def shared(group: pa.Table, targets: int) -> pa.Table:
    """Of a bucket, the shingles that two or more classes hold, dealt by class."""
    parts = group.select(["shingles", "owners", "classes"]).to_pylist()
    keys = [np.frombuffer(x["classes"], POSTED) for x in parts]
    starts = np.cumsum([0, *map(len, keys)])
    hash_ = np.concatenate([unpack(x["shingles"]) for x in parts])
    unique, place = distinct_classes(np.concatenate(keys))
    owner = place[np.concatenate([np.frombuffer(x["owners"], "<u2") + s for x, s in zip(parts, starts, strict=False)])]
    del parts
    order = np.lexsort((owner, hash_))
    hash_, owner = hash_[order], owner[order]
    new = np.ones(len(hash_), bool)
    new[1:] = (hash_[1:] != hash_[:-1]) | (owner[1:] != owner[:-1])
    hash_, owner = hash_[new], owner[new]
    first = np.ones(len(hash_), bool)
    first[1:] = hash_[1:] != hash_[:-1]
    group_of = np.cumsum(first) - 1
    count = np.bincount(group_of)[group_of]
    more = count > 1
    hash_, owner, count = hash_[more], owner[more], count[more]
    target = (unique["h1"] % np.uint64(targets)).astype(np.int64)[owner]
    order = np.argsort(target, kind="stable")
    hash_, owner, count, target = hash_[order], owner[order], count[order], target[order]
    cuts = np.searchsorted(target, np.arange(targets + 1))
    rows = []
    for t in np.flatnonzero(np.diff(cuts)):
        part = slice(cuts[t], cuts[t + 1])
        used, local = np.unique(owner[part], return_inverse=True)
        rows.append((int(t), pack(hash_[part]), local.astype("<u4").tobytes(), unique[used].tobytes(), count[part].astype("<u4").tobytes()))
    return pa.table([pa.array([r[i] for r in rows], kind) for i, (_, kind) in enumerate(PARTS)], [x for x, _ in PARTS])


def best_matches(counts: np.ndarray, asked: int, n: int) -> tuple[int, int]:
    """How many matches to ask of a prefix of the shared shingles, and how long it is, when
    `asked` of all of them must match."""
    reach = np.cumsum(counts - 1.0)
    best, least = (1, len(counts) - asked + 1), np.inf
    for k in range(1, min(MOST_MATCHES, asked) + 1):
        length = len(counts) - asked + k
        cost = reach[length - 1] * (1 + VERIFY * n / k)
        if cost < least:
            best, least = (k, length), cost
    return best


WORK = "class long, matches int, prefix array<long>"


def prefixes(group: pa.Table, num: int, den: int) -> pa.Table:
    """The classes of a group that can have a link, with the rarest shingles they share."""
    parts = group.select(["shingles", "owners", "classes", "counts"]).to_pylist()
    keys = [np.frombuffer(x["classes"], POSTED) for x in parts]
    starts = np.cumsum([0, *map(len, keys)])
    hash_ = np.concatenate([unpack(x["shingles"]) for x in parts])
    count = np.concatenate([np.frombuffer(x["counts"], "<u4") for x in parts]).astype(np.int64)
    unique, place = distinct_classes(np.concatenate(keys))
    owner = place[np.concatenate([np.frombuffer(x["owners"], "<u4") + s for x, s in zip(parts, starts, strict=False)])]
    n = unique["n"].astype(np.int64)
    # A partner may be smaller, down to the size a link allows, and asks for less then.
    asked = demand(-(-num * n // den), num, den)[1]
    live = (np.bincount(owner, minlength=len(n)) >= asked)[owner]
    hash_, owner, count = hash_[live], owner[live], count[live]
    order = np.lexsort((hash_, count, owner))
    hash_, owner, count = hash_[order].astype(np.int64), owner[order], count[order]
    cuts = np.flatnonzero(np.diff(owner, prepend=-1, append=-1))
    who = owner[cuts[:-1]]
    matches, prefix = [], []
    for i, a, b in zip(who.tolist(), cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
        k, length = best_matches(count[a:b], int(asked[i]), int(n[i]))
        matches.append(k)
        prefix.append(hash_[a : a + length])
    return pa.table({"class": unique["h1"][who].astype(np.int64), "matches": pa.array(matches, pa.int32()), "prefix": pa.array(prefix, pa.list_(pa.int64()))})


def with_shingles(batches: Iterator[pa.RecordBatch], k: int, names: list[str]) -> Iterator[pa.RecordBatch]:
    """Puts the shingles in the place of the text (the last column)."""
    for batch in slices(batches, len(names) - 1):
        found, offsets = shingles(batch.column(len(names) - 1), k)
        yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(found.astype(np.int64)))], names)


def prefix_matches(flat_: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """How many prefix shingles each two classes share, as a square table."""
    size = len(lengths)
    counts = np.zeros((size, size), np.float32)
    rows = np.repeat(np.arange(size), lengths)
    codes, often = np.unique(flat_, return_inverse=True, return_counts=True)[1:]
    rows = rows[np.argsort(codes, kind="stable")]
    starts = np.cumsum(often) - often
    for c in np.unique(often[(often > 1) & (often * RARE < size)]):
        first = starts[often == c]
        for at in range(0, len(first), step := max(1, PAIRS_AT_ONCE // (c * c))):
            held = rows[first[at : at + step, None] + np.arange(c)]
            np.add.at(counts.reshape(-1), (held[:, :, None] * size + held[:, None, :]).ravel(), np.float32(1))
    common = np.flatnonzero((often > 1) & (often * RARE >= size))
    for at in range(0, len(common), 4096):
        part = common[at : at + 4096]
        n = often[part]
        table = np.zeros((size, len(part)), np.float32)
        table[rows[np.repeat(starts[part] - (np.cumsum(n) - n), n) + np.arange(n.sum())], np.repeat(np.arange(len(part)), n)] = 1
        counts += table @ table.T
    return counts


def may_link(group: pa.Table, num: int, den: int) -> np.ndarray:
    """Whether the prefixes of each two classes share enough and their sizes allow a link, as a square table with one
    place for each two: in a block those in order, else one of each side."""
    n, k, side = (group.column(x).to_numpy() for x in ("n", "matches", "side"))
    prefix = group.column("prefix").combine_chunks()
    enough = prefix_matches(prefix.flatten().to_numpy(), prefix.value_lengths().to_numpy()) >= np.minimum(k[:, None], k[None, :])
    enough &= den * np.minimum(n[:, None], n[None, :]) >= num * np.maximum(n[:, None], n[None, :])
    one_block = group.column("x")[0].as_py() == group.column("y")[0].as_py()
    return enough & (np.arange(len(n))[:, None] < np.arange(len(n))[None, :] if one_block else (side[:, None] == 0) & (side[None, :] == 1))


def with_sketches(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[pa.RecordBatch]:
    """Puts a sketch in the place of the shingles (the last column)."""
    for batch in batches:
        for start in range(0, batch.num_rows, 1024):
            part = batch.slice(start, 1024)
            lists = part.column(len(names) - 1)
            at = np.repeat(np.arange(len(lists)), lists.value_lengths().to_numpy()) * SKETCH_BITS + (lists.flatten().to_numpy() & (SKETCH_BITS - 1))
            bits = np.packbits((np.bincount(at, minlength=len(lists) * SKETCH_BITS) & 1).astype(bool).reshape(-1, SKETCH_BITS), axis=1)
            yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array([x.tobytes() for x in bits], pa.binary())], names)


def promising(group: pa.Table, num: int, den: int) -> pa.Table:
    """The classes of a block, or of two, that may link with one they are not joined with."""
    left, right = np.nonzero(may_link(group, num, den))
    joined = group.column("joined").combine_chunks().dictionary_encode().indices.to_numpy()
    n = group.column("n").to_numpy()
    sketch = np.frombuffer(b"".join(group.column("sketch").to_pylist()), np.uint64).reshape(len(n), -1)
    found = np.zeros(len(n), bool)
    for at in range(0, len(left), PAIRS_AT_ONCE // 16):
        i, j = left[at : at + PAIRS_AT_ONCE // 16], right[at : at + PAIRS_AT_ONCE // 16]
        differ = np.bitwise_count(sketch[i] ^ sketch[j]).sum(1, dtype=np.int64)
        good = ((num + den) * differ <= (den - num) * (n[i] + n[j])) & (joined[i] != joined[j])
        found[i[good]] = found[j[good]] = True
    return group.select(["root", "x", "y", "side", "key"]).filter(pa.array(found))


def verified(group: pa.Table, num: int, den: int) -> pa.Table:
    """Links within a block of a family, or between two, without those whose ends are joined
    already. Pairs are verified if sizes allow a link and their prefixes share enough."""
    n, lists = group.column("n").to_numpy().astype(np.int64), group.column("shingles").combine_chunks()
    left, right = np.nonzero(may_link(group, num, den))
    sets = [np.sort(x) for x in np.split(lists.flatten().to_numpy(), np.cumsum(lists.value_lengths().to_numpy())[:-1])]
    root = list(range(len(n)))

    def top(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    out = []
    for i, j in zip(left.tolist(), right.tolist(), strict=True):
        a, b = top(i), top(j)
        if a != b:
            x, y = sets[i], sets[j]
            same = int((y[np.minimum(np.searchsorted(y, x), len(y) - 1)] == x).sum())
            if den * same >= num * (n[i] + n[j] - same):
                root[a] = b
                out.append((i, j))
    keys = group.column("key")
    return pa.table({x: keys.take(pa.array([p[i] for p in out], pa.int64())) for i, x in enumerate("ab")})


def links(docs: DataFrame, classes: DataFrame, k: int, num: int, den: int) -> DataFrame:
    """Links between classes (binary keys `a`, `b`), enough of them to join all that are
    linked. `docs` has columns `id`, `text`; `classes` has `key`, `n`, and the id `least` of a row
    of each class."""
    total = classes.agg(F.sum("n")).first()[0] or 0
    buckets = max(1, 2 * total * (den - num) // den // BUCKET_SHINGLES)
    shape = "bucket long, shingles binary, owners binary, classes binary"
    chunks = docs.select("text").mapInArrow(lambda b: dealt(b, k, num, den, buckets), shape)
    by_class = chunks.groupBy("bucket").applyInArrow(lambda g: shared(g, buckets), f"{shape}, counts binary")
    work = stage(by_class.groupBy("bucket").applyInArrow(lambda g: prefixes(g, num, den), WORK), "prefixes")

    posted = work.select("class", F.explode("prefix").alias("place"))
    least = posted.groupBy("place").agg(F.min("class").alias("least"), F.count("*").alias("c")).where("c > 1")
    met = components(posted.join(least, "place").select(F.col("class").alias("a"), F.col("least").alias("b")))
    met = stage(met.union(met.select("root", "root")).distinct(), "families")
    work = work.join(met, work["class"] == met["node"]).drop("node")

    # One row of each class brings the text; the others hash to other places, as id is a key.
    # Rows of one class and id become one before they are dealt.
    wanted = classes.withColumn("class", class_number(F.col("key"))).join(work, "class").select("key", F.xxhash64("least").alias("row"), "root", "matches", "prefix", "n")
    wanted = stage(wanted, "wanted")
    texts = texts_of(docs, wanted.select("key", "row"), k).groupBy("key", "row").agg(F.min("text").alias("text"))
    work = wanted.join(texts, ["key", "row"]).select("root", "key", "n", "matches", "prefix", F.col("text").alias("shingles"))
    kinds = T.StructType([*work.schema[:-1]]).add("shingles", T.ArrayType(T.LongType()))
    work = stage(work.mapInArrow(lambda b: with_shingles(b, k, kinds.names), kinds), "members")

    families = stage(with_blocks(work).select("root", "blocks").where("blocks > 1").distinct(), "large-families").select("root")
    if families.isEmpty():
        return in_blocks(work, num, den)
    small, large = work.join(families, "root", "left_anti"), work.join(families, "root", "left_semi")
    led = stage(with_leaders(large, num, den), "led")
    rest = stage(not_led(large, led), "rest")
    return led.union(in_blocks(small, num, den)).union(in_light_blocks(rest, num, den))


def texts_of(docs: DataFrame, wanted: DataFrame, k: int) -> DataFrame:
    """Class key, `row` and text of the rows of `docs` that are wanted, and of some few that are not."""
    spark = docs.sparkSession
    found = wanted.mapInArrow(wanted_slots, "block long, slot long").groupBy("block").applyInArrow(block_bits, "block long, bits binary")
    table = np.zeros(max(1 << WANTED_BITS, WANTED_BLOCK) // 8, np.uint8)
    for block, bits in stage(found, "wanted-bits").toLocalIterator():
        table[block * (WANTED_BLOCK // 8) :][: len(bits)] = np.frombuffer(bits, np.uint8)
    table = spark.sparkContext.broadcast(table)
    return docs.select(F.xxhash64("id").alias("row"), "text").mapInArrow(lambda b: wanted_texts(b, k, table), "key binary, row long, text string")


def with_blocks(work: DataFrame) -> DataFrame:
    """The classes of families, and how many blocks the family is cut into."""
    sizes = work.groupBy("root").agg(F.count("*").alias("c"), F.sum(F.size("shingles")).alias("held"))
    blocks = F.ceil(F.greatest(F.col("c") / BLOCK_CLASSES, F.col("held") / BLOCK_SHINGLES)).cast("int")
    return work.join(sizes.select("root", "c", blocks.alias("blocks")), "root")


def dealt_to_blocks(work: DataFrame, blocks: str) -> DataFrame:
    """A row of each class for every two blocks of its family that it takes part in."""
    rows = work.withColumn("own", F.pmod(F.hash("key"), F.col(blocks))).withColumn("other", F.explode(F.sequence(F.lit(0), F.col(blocks) - 1)))
    places = [F.least("own", "other").alias("x"), F.greatest("own", "other").alias("y"), (F.col("own") > F.col("other")).cast("int").alias("side")]
    return rows.select("root", *places, *[x for x in work.columns if x not in ("root", "c", "blocks", "light")])


def in_blocks(work: DataFrame, num: int, den: int) -> DataFrame:
    """Links within families, whose blocks meet pairwise."""
    return dealt_to_blocks(with_blocks(work), "blocks").groupBy("root", "x", "y").applyInArrow(lambda g: verified(g, num, den), "a binary, b binary")


def in_light_blocks(work: DataFrame, num: int, den: int) -> DataFrame:
    """Links within families; only the classes that may link bring their shingles to where their blocks meet."""
    sized = with_blocks(work).withColumn("light", F.ceil(F.col("c") / LIGHT_CLASSES).cast("int"))
    light = sized.select("root", "key", "n", "matches", "prefix", "joined", "light", F.col("shingles").alias("sketch"))
    kinds = T.StructType([*light.schema[:-1]]).add("sketch", "binary")
    rows = dealt_to_blocks(light.mapInArrow(lambda b: with_sketches(b, kinds.names), kinds), "light")
    kind = f"root {work.schema['root'].dataType.simpleString()}, x int, y int, side int, key binary"
    found = stage(rows.groupBy("root", "x", "y").applyInArrow(lambda g: promising(g, num, den), kind), "promising")
    # Those of two blocks that are still many are cut into blocks once more.
    found = found.withColumn("root", F.xxhash64("root", "x", "y")).select("root", "key").distinct()
    return in_blocks(found.join(work.drop("root", "joined"), "key").select("root", "key", "n", "matches", "prefix", "shingles"), num, den)


def with_leaders(work: DataFrame, num: int, den: int) -> DataFrame:
    """Links of classes with their leaders. Classes of one leader are dealt to groups, each of which gets the leader."""
    posted = work.select("key", F.explode("prefix").alias("place"))
    least = posted.groupBy("place").agg(F.min("key").alias("leader"))
    named = posted.join(least, "place").where("leader <> key").groupBy("key", "leader").agg(F.count("*").alias("c"))
    named = named.groupBy("key").agg(F.max(F.struct("c", "leader")).alias("most")).select("key", F.col("most.leader").alias("leader"))
    named = stage(named.join(work.select("key", F.size("shingles").alias("size")), "key"), "leaders")
    sizes = named.groupBy("leader").agg(F.ceil(F.greatest(F.count("*") / BLOCK_CLASSES, F.sum("size") / BLOCK_SHINGLES)).cast("int").alias("groups"))
    sizes = stage(sizes, "led-groups")
    rest = [F.col(x) for x in ("key", "n", "matches", "prefix", "shingles")]
    y = F.col("y") + 1  # apart from 0, so that these are two sides
    own = work.join(named.join(sizes, "leader"), "key").withColumn("y", F.pmod(F.hash("key"), F.col("groups")))
    own = own.select("leader", F.lit(0).alias("x"), y.alias("y"), F.lit(1).alias("side"), *rest)
    heads = work.join(sizes, work["key"] == sizes["leader"]).withColumn("y", F.explode(F.sequence(F.lit(0), F.col("groups") - 1)))
    heads = heads.select("leader", F.lit(0).alias("x"), y.alias("y"), F.lit(0).alias("side"), *rest)
    return own.union(heads).groupBy("leader", "x", "y").applyInArrow(lambda g: verified(g, num, den), "a binary, b binary")


def not_led(work: DataFrame, led: DataFrame) -> DataFrame:
    """The classes that may still have a link with one they are not joined with, with what is left of their prefixes,
    and in families anew. Two that are not joined share the places that are left only, and as many of them as the smaller
    of their `matches`."""
    joined = components(led)
    work = work.join(joined, work["key"] == joined["node"], "left").withColumn("joined", F.coalesce(joined["root"], work["key"]))
    work = work.select(work["key"], "n", "matches", "joined", "prefix", "shingles")
    posted = work.select("key", "matches", "joined", F.explode("prefix").alias("place"))
    open_ = posted.groupBy("place").agg(F.min("matches").alias("least_matches"), F.min("joined").alias("a"), F.max("joined").alias("b")).where("a <> b")
    left = posted.join(open_.select("place", "least_matches"), "place").groupBy("key").agg(F.collect_list("place").alias("prefix"), F.min("least_matches").alias("needed"))
    left = stage(left.where(F.size("prefix") >= F.col("needed")).select("key", "prefix"), "open-places")
    posted = left.select("key", F.explode("prefix").alias("place"))
    least = posted.groupBy("place").agg(F.min("key").alias("least"), F.count("*").alias("c")).where("c > 1")
    met = components(posted.join(least, "place").select(F.col("key").alias("a"), F.col("least").alias("b")))
    met = stage(met.union(met.select("root", "root")).distinct(), "open-families")
    rest = work.drop("prefix").join(left, "key").join(met, work["key"] == met["node"])
    return rest.select("root", "key", "n", "matches", "prefix", "joined", "shingles")


def class_number(key: Column) -> Column:
    """The first half of a class key, as postings know it."""
    high, low = (F.conv(F.hex(F.substring(key, i, 4)), 16, 10).cast("long") for i in (1, 5))
    return F.call_function("shiftleft", high, F.lit(32)).bitwiseOR(low)


def classes_of(docs: DataFrame, carry: list[str], text_col: str, k: int) -> tuple[DataFrame, str, str]:
    """`docs` with the columns of `carry`, the class key and the size of the set; and the
    names of these two."""
    key, size = fresh_name(carry, "class"), fresh_name(carry, "n_shingles")
    kinds = T.StructType([docs.schema[x] for x in carry]).add(key, "binary").add(size, "long")
    rows = docs.select(*(F.col(f"`{x}`") for x in carry), F.col(f"`{text_col}`").cast("string").alias(key))
    return rows.mapInArrow(lambda b: classed(b, k, kinds.names), kinds), key, size


def ngram_join(docs: DataFrame, k: int = 5, num: int = 4, den: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of `docs`: id, `n_shingles`, `component_id` (the smallest id reachable
    by links), `class` (the key of its set) and `root` (the key of its component; null without
    shingles)."""
    rows, key, size = classes_of(docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text")), ["id"], "text", k)
    rows = stage(rows, "classes")
    least = rows.where(F.col(size) > 0).groupBy(F.col(key).alias("key"), F.col(size).alias("n")).agg(F.min("id").alias("least"))
    text = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    joined = components(links(text, least, k, num, den))
    least = least.withColumnRenamed("key", key)
    least = least.join(joined, least[key] == joined["node"], "left").select(key, "least", F.coalesce("root", key).alias("root"))
    least = stage(least, "roots")
    by_root = least.groupBy("root").agg(F.min("least").alias("component_id"))
    lookup = least.join(by_root, "root").select(key, "component_id", "root")
    out = rows.join(lookup, key, "left")
    return out.select(F.col("id").alias(id_col), size, F.when(F.col(size) > 0, F.col("component_id")).otherwise(F.col("id")).alias("component_id"), key, "root")


def one_of_each(docs: DataFrame, k: int = 5, num: int = 4, den: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of `docs` without near copies, with all columns: of each component the row
    with the smallest id, a null id last. Texts without a word all stay."""
    names = docs.columns
    found = ngram_join(docs, k, num, den, id_col, text_col).where("n_shingles > 0")
    # Components are told apart by root, as those of null ids only have no id.
    first = found.where(F.col(id_col).eqNullSafe(F.col("component_id")))
    first = first.groupBy("root", "component_id").agg(F.min("class").alias("kept"))
    rows, key, size = classes_of(docs, names, text_col, k)
    best = first.select(F.col("kept"), F.col("component_id").alias("kept_id"))
    same = (F.col(key) == F.col("kept")) & F.col(f"`{id_col}`").eqNullSafe(F.col("kept_id"))
    rows = rows.join(best, same, "left").where((F.col(size) == 0) | F.col("kept").isNotNull())
    nth = fresh_name([*names, key, size], "nth")
    order = Window.partitionBy(key, f"`{id_col}`").orderBy(F.xxhash64(*(F.col(f"`{x}`") for x in names)))
    rows = rows.withColumn(nth, F.row_number().over(order)).where((F.col(size) == 0) | (F.col(nth) == 1))
    return rows.select(*(F.col(f"`{x}`") for x in names))
