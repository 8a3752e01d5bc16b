"""Removal of repeated passages by seed and extend.

A word goes if it is covered by `window` consecutive words whose sequence also starts
earlier: in a document with a smaller id, or earlier in the same one. All is judged on the
texts as they came.

1. Seeds. Of the hashes of `gram` words, winnowing selects the smallest in every `window`
   words. Two equal windows select the same, so they share a seed; about a seventh of all
   places are seeds. Documents join on seeds; those found once are dropped.
2. Extension. From a shared seed, a match extends to both sides as far as the windows that
   selected it, with the seed at the same place in each. Such windows meet by seed and are
   compared by hash, all at once: the earliest is the original, the others repeat it. So a
   passage found in thousands of documents costs a row each, and no pairs.
3. Repeated windows that overlap or touch are merged into maximal repeats, as spans of
   words. They cover at least `window` words.

Seeds and windows travel as packed arrays dealt by hash. What a chunk of documents can
decide by itself it does, and sends one entry for seeds with equal windows. Two windows are
equal if 48 bits of the hash of their seed, the place of it, and 64 bits of the hash of the
window agree. Texts are compressed for the two joins that need them.

Ids are integers; a null id comes after all others. Rows with the same id are ordered by a
hash of their text, and rows with the same id and text are one document: they get the same
spans. Null and empty texts have no words and lose none. Columns other than id and text are
not read. An empty table gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.llm.ngram_join import pack, unpack
from tickloom.llm.textual import ODD, flat, gram_hashes, inside, mix, slices, span_hashes, spans
from tickloom.session import stage

WINDOW, GRAM = 20, 8
SEEN = np.dtype([("h1", "<u8")])
ROW = np.dtype([("h1", "<u8"), ("id", "<i8")])
BUCKET_ENTRIES = 1_000_000
CHUNK_WORDS = 1_500_000
CHUNK_ROWS = 32_000
WORD = re.compile(r"[^\x20\x09-\x0D]+")
NO_ID = (1 << 63) - 1


def row_key(row_id: Column, text: Column) -> Column:
    """16 bytes that stand for a row's id and text."""
    return F.unhex(F.md5(F.concat(F.coalesce(row_id.cast("string"), F.lit("-")), F.lit(":"), F.coalesce(text, F.lit("")))))


def selected(words: np.ndarray, first: np.ndarray, window: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The places where a window starts, the seed each selects (the rightmost of equal
    ones), and the hashes of all grams."""
    grams = gram_hashes(words, gram)
    at = inside(first, window)
    if not len(at):
        return at, at, grams
    width = window - gram + 1
    least, size = grams, 1
    while size * 2 <= width:
        least = np.minimum(least[:-size], least[size:])
        size *= 2
    rest = width - size
    least = np.minimum(least[: len(least) - rest], least[rest:]) if rest else least
    low, seed = least[at], np.zeros(len(at), np.int64)
    for ahead in range(width):
        hit = grams[at + ahead] == low
        seed[hit] = at[hit] + ahead
    return at, seed, grams


def rows_of(batch: pa.RecordBatch) -> np.ndarray:
    """Keys and ids from columns 0 and 1."""
    out = np.zeros(len(batch), ROW)
    out["h1"] = np.frombuffer(b"".join(batch.column(0).to_pylist()), "<u8").reshape(-1, 2)[:, 0]
    out["id"] = batch.column(1).fill_null(NO_ID).to_numpy(zero_copy_only=False)
    return out


def distinct_rows(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct rows in order of id, and the place of each given one among them."""
    order = np.lexsort((rows["h1"], rows["id"])) if "id" in rows.dtype.names else np.argsort(rows["h1"], kind="stable")
    ordered = rows[order]
    new = np.ones(len(rows), bool)
    new[1:] = ordered[1:] != ordered[:-1]
    place = np.empty(len(rows), np.int64)
    place[order] = np.cumsum(new) - 1
    return ordered[new], place


def packed(column: np.ndarray) -> bytes:
    return pack(column) if column.dtype == np.uint64 else column.tobytes()


def dealt(bucket: np.ndarray, buckets: int, rows: np.ndarray, owner: np.ndarray, columns: list[np.ndarray], inner: tuple[np.ndarray, np.ndarray] | None = None) -> list[tuple]:
    """Cuts arrays into one packed part per bucket, each with the rows it speaks of. Of the last
    column, `inner` gives where the values of each entry start and how many there are."""
    order = np.argsort(bucket, kind="stable")
    bucket, owner = bucket[order], owner[order]
    columns = [x[order] for x in columns[: len(columns) - (inner is not None)]] + columns[len(columns) - (inner is not None) :]
    if inner is not None:
        start, count = inner[0][order], inner[1][order]
        ends = np.cumsum(count)
        columns[-1] = columns[-1][np.repeat(start - (ends - count), count) + np.arange(ends[-1] if len(ends) else 0)]
        ends = np.concatenate(([0], ends))
    cuts = np.searchsorted(bucket, np.arange(buckets + 1))
    out = []
    for b in np.flatnonzero(np.diff(cuts)):
        part = slice(cuts[b], cuts[b + 1])
        used, local = np.unique(owner[part], return_inverse=True)
        values = [packed(x[part]) for x in (columns if inner is None else columns[:-1])]
        if inner is not None:
            values.append(columns[-1][ends[cuts[b]] : ends[cuts[b + 1]]].tobytes())
        out.append((int(b), rows[used].tobytes(), local.astype("<u4" if len(used) > 65_535 else "<u2").tobytes(), *values))
    return out


def table(parts: list[tuple], names: list[str]) -> pa.Table:
    kinds = [pa.int64()] + [pa.binary()] * (len(names) - 1)
    return pa.table([pa.array([x[i] for x in parts], kind) for i, kind in enumerate(kinds)], names)


def gathered(group: pa.Table, kind: np.dtype) -> tuple[list[dict], np.ndarray, np.ndarray]:
    """The parts of a bucket, the distinct rows they speak of, and the owner of each entry."""
    parts = group.to_pylist()
    rows = [np.frombuffer(x["rows"], kind) for x in parts]
    starts = np.cumsum([0, *map(len, rows)])
    unique, place = distinct_rows(np.concatenate(rows))
    owners = [np.frombuffer(x["owners"], "<u4" if len(r) > 65_535 else "<u2").astype(np.int64) + s for x, r, s in zip(parts, rows, starts, strict=False)]
    return parts, unique, place[np.concatenate(owners)]


def squeeze(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Compresses the texts in the last column, for a shuffle."""
    pack_ = zstandard.ZstdCompressor(level=3).compress
    for batch in batches:
        texts = pa.array([None if x is None else pack_(x.encode()) for x in batch.column(batch.num_columns - 1).to_pylist()], pa.binary())
        yield pa.RecordBatch.from_arrays([*batch.columns[:-1], texts], batch.schema.names)


def loose(batch: pa.RecordBatch, at: int) -> pa.RecordBatch:
    """Texts in place of compressed ones."""
    unpack_ = zstandard.ZstdDecompressor().decompress
    texts = pa.array([None if x is None else unpack_(x).decode() for x in batch.column(at).to_pylist()], pa.string())
    return pa.RecordBatch.from_arrays([*batch.columns[:at], texts, *batch.columns[at + 1 :]], batch.schema.names)


def small(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, len(batch), rows):
            yield batch.slice(start, rows)


def chunks(batches: Iterator[pa.RecordBatch], text_at: int) -> Iterator[list[pa.RecordBatch]]:
    """Groups of slices that bound the words and rows worked on at once."""
    held, size = [], 0
    for batch in slices(batches, text_at):
        room = batch.column(text_at).nbytes // 6
        if held and (size + room > CHUNK_WORDS or sum(map(len, held)) + len(batch) > CHUNK_ROWS):
            yield held
            held, size = [], 0
        held.append(batch)
        size += room
    if held:
        yield held


SEEDS = ["bucket", "rows", "owners", "seeds", "again"]


def seed_parts(batches: Iterator[pa.RecordBatch], window: int, gram: int, buckets: int) -> Iterator[pa.RecordBatch]:
    for held in chunks(batches, 2):
        seeds, owners, done = [], [], 0
        for batch in held:
            data, offsets = flat(batch.column(2))
            starts, ends, first = spans(data, offsets)
            _, seed, grams = selected(span_hashes(data, starts, ends), first, window, gram)
            seed = np.unique(seed)
            seeds.append(grams[seed] if len(seed) else np.zeros(0, np.uint64))
            owners.append(done + np.searchsorted(first, seed, "right") - 1)
            done += len(batch)
        rows, place = distinct_rows(np.concatenate([rows_of(x) for x in held])[["h1"]].astype(SEEN))
        hash_, owner = np.concatenate(seeds), np.concatenate(owners)
        if done > len(rows):  # of rows with the same id and text, one speaks for all
            one = np.zeros(done, bool)
            one[np.unique(place, return_index=True)[1]] = True
            hash_, owner = hash_[one[owner]], owner[one[owner]]
        owner = place[owner]
        if not len(hash_):
            continue
        order = np.lexsort((owner, hash_))
        hash_, owner = hash_[order], owner[order]
        same = np.concatenate(([False], (hash_[1:] == hash_[:-1]) & (owner[1:] == owner[:-1]), [False]))
        new = ~same[:-1]
        # A document that has the seed twice is noted apart; few have.
        hash_, owner, twice = hash_[new], owner[new], same[1:][new]
        bucket = ((hash_ >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)
        yield from table(dealt(bucket, buckets, rows, owner, [hash_ >> np.uint64(16), twice.astype(np.uint8)]), SEEDS).to_batches()


def shared_seeds(group: pa.Table, targets: int) -> pa.Table:
    """Of a bucket, the seeds found in two places or more, dealt by document."""
    parts, rows, owner = gathered(group, SEEN)
    hash_ = np.concatenate([unpack(x["seeds"]) for x in parts])
    again = np.concatenate([np.frombuffer(x["again"], np.uint8) for x in parts])
    order = np.lexsort((owner, hash_))
    hash_, owner, again = hash_[order], owner[order], again[order]
    new = np.ones(len(hash_), bool)
    new[1:] = (hash_[1:] != hash_[:-1]) | (owner[1:] != owner[:-1])
    hash_, owner, again = hash_[new], owner[new], again[new]
    which = np.cumsum(np.concatenate(([True], hash_[1:] != hash_[:-1]))) - 1
    more = (np.bincount(which)[which] > 1) | (again > 0)
    target = (rows["h1"] % np.uint64(targets)).astype(np.int64)[owner[more]]
    return table(dealt(target, targets, rows, owner[more], [hash_[more]]), ["bucket", "rows", "owners", "seeds"])


def per_document(group: pa.Table) -> pa.Table:
    """One row per document: the first half of its key and its shared seeds, sorted."""
    parts, rows, owner = gathered(group, SEEN)
    hash_ = np.concatenate([unpack(x["seeds"]) for x in parts])
    hash_ = hash_[np.lexsort((hash_, owner))]
    cuts = np.searchsorted(np.sort(owner), np.arange(len(rows) + 1))
    return pa.table({"half": halves(rows), "seeds": pa.array([pack(hash_[a:b]) for a, b in zip(cuts[:-1], cuts[1:], strict=True)], pa.binary())})


def halves(rows: np.ndarray) -> pa.Array:
    data = rows["h1"].astype("<u8").tobytes()
    return pa.array([data[i : i + 8] for i in range(0, len(data), 8)], pa.binary())


WINDOWS = ["bucket", "rows", "owners", "seeds", "places", "before", "counts", "hashes"]


def window_parts(batches: Iterator[pa.RecordBatch], window: int, gram: int, buckets: int) -> Iterator[pa.RecordBatch]:
    """For each shared seed in a text, the hashes of the windows that selected it, dealt by seed.
    Of entries equal in all windows, only the first of a chunk is compared with other chunks;
    the others are known to repeat it and go on as spans."""
    for held in chunks((loose(x, 2) for x in small(batches)), 2):
        rows, seeds, places, before, counts, hashes, owners, done = [], [], [], [], [], [], [], 0
        for batch in held:
            rows.append(rows_of(batch))
            data, offsets = flat(batch.column(2))
            starts, ends, first = spans(data, offsets)
            words = span_hashes(data, starts, ends)
            at, seed, grams = selected(words, first, window, gram)
            owner = np.searchsorted(first, at, "right") - 1
            known = [unpack(x) for x in batch.column(3).to_pylist()]
            pool = np.sort(np.concatenate(known) ^ mix(np.repeat(np.arange(len(known), dtype=np.uint64), [len(x) for x in known])))
            done += len(batch)
            if not len(seed) or not len(pool):
                continue
            probe = (grams[seed] >> np.uint64(16)) ^ mix(owner.astype(np.uint64))
            live = pool[np.minimum(np.searchsorted(pool, probe), len(pool) - 1)] == probe
            at, seed, owner = at[live], seed[live], owner[live]
            if not len(at):
                continue
            lead = np.flatnonzero(np.concatenate(([True], (seed[1:] != seed[:-1]) | (at[1:] != at[:-1] + 1))))
            seeds.append(grams[seed[lead]] >> np.uint64(16))
            places.append((seed - first[owner])[lead].astype("<u4"))
            before.append((seed - at)[lead].astype(np.uint8))
            counts.append(np.diff(np.append(lead, len(at))).astype(np.uint8))
            owners.append(owner[lead] + done - len(batch))
            hashes.append(mix(gram_hashes(words, window)[at] + ODD))
        if not seeds:
            continue
        rows, place = distinct_rows(np.concatenate(rows))
        seeds, places, before, counts, hashes = map(np.concatenate, (seeds, places, before, counts, hashes))
        owner = place[np.concatenate(owners)]
        first = np.cumsum(counts, dtype=np.int64) - counts
        whole = np.add.reduceat(mix(hashes + np.repeat(before, counts).astype(np.uint64) - (np.arange(len(hashes)) - np.repeat(first, counts)).astype(np.uint64)), first)
        order = np.lexsort((places, owner, whole, counts, before, seeds))  # rows are numbered by id
        keys = [x[order] for x in (seeds, before, counts, whole)]
        same = np.concatenate(([False], np.all([x[1:] == x[:-1] for x in keys], axis=0)))
        twin = np.concatenate(([False], (owner[order][1:] == owner[order][:-1]) & (places[order][1:] == places[order][:-1]))) & same
        lead_of = np.maximum.accumulate(np.where(same, 0, np.arange(len(order))))
        twin |= same & (owner[order] == owner[order][lead_of]) & (places[order] == places[order][lead_of])
        lead, repeat = order[~same], order[same & ~twin]
        bucket = ((seeds << np.uint64(16) >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)
        columns = [x[lead] for x in (seeds, places, before, counts)] + [hashes]
        yield from table(dealt(bucket[lead], buckets, rows, owner[lead], columns, (first[lead], counts[lead].astype(np.int64))), WINDOWS).to_batches()
        if len(repeat):
            target = (mix(rows["h1"][owner[repeat]] + places[repeat]) % np.uint64(buckets)).astype(np.int64)
            spans_ = dealt(target, buckets, rows, owner[repeat], [(places - before)[repeat].astype("<u4"), counts[repeat]])
            yield from table([(b, r, o, b"", start, b"", n, b"") for b, r, o, start, n in spans_], WINDOWS).to_batches()


def repeats(group: pa.Table, targets: int) -> pa.Table:
    """Of a bucket, the windows that are not the first of their words, as runs, dealt by document."""
    parts, rows, owner = gathered(group, ROW)
    counts = np.concatenate([np.frombuffer(x["counts"], np.uint8) for x in parts]).astype(np.int64)
    place = np.concatenate([np.frombuffer(x["places"], "<u4") for x in parts]).astype(np.int64)
    fixed = np.concatenate([np.full(len(x["counts"]), not x["hashes"]) for x in parts])
    seed = np.concatenate([np.zeros(0, np.uint64), *(unpack(x["seeds"]) for x in parts)])
    before = np.concatenate([np.zeros(0, np.uint8), *(np.frombuffer(x["before"], np.uint8) for x in parts)]).astype(np.int64)
    hash_ = np.concatenate([np.zeros(0, np.uint64), *(np.frombuffer(x["hashes"], np.uint64) for x in parts)])
    del parts
    open_ = np.flatnonzero(~fixed)
    n = counts[open_]
    step = np.arange(len(hash_)) - np.repeat(np.cumsum(n) - n, n)
    ahead = np.repeat(before, n) - step  # words from the window's start to the seed
    seed, holder = np.repeat(seed, n), np.repeat(owner[open_], n)
    start = np.repeat(place[open_], n) - ahead
    order = np.lexsort((start, holder, hash_, ahead, seed))  # rows are numbered by id
    seed, ahead, hash_, holder, start = (x[order] for x in (seed, ahead, hash_, holder, start))
    same = np.zeros(len(seed), bool)
    same[1:] = (seed[1:] == seed[:-1]) & (ahead[1:] == ahead[:-1]) & (hash_[1:] == hash_[:-1])
    lead_of = np.maximum.accumulate(np.where(same, 0, np.arange(len(seed))))
    hit = same & ~((holder == holder[lead_of]) & (start == start[lead_of]))
    closed = np.flatnonzero(fixed)
    holder, start = holder[hit], start[hit]
    order = np.lexsort((start, holder))
    holder, start = holder[order], start[order]
    new = np.flatnonzero(np.concatenate(([True], (holder[1:] != holder[:-1]) | (start[1:] > start[:-1] + 1)))[: len(start)])
    length = (start[np.append(new[1:], len(start)) - 1] - start[new] + 1) if len(new) else start
    holder = np.concatenate((holder[new], owner[closed]))
    start = np.concatenate((start[new], place[closed]))
    length = np.concatenate((length, counts[closed]))
    target = (rows["h1"] % np.uint64(targets)).astype(np.int64)[holder]
    return table(dealt(target, targets, rows, holder, [start.astype("<u4"), length.astype("<u4")]), ["bucket", "rows", "owners", "starts", "counts"])


def merged_spans(group: pa.Table, window: int) -> pa.Table:
    """One row per document: the first half of its key, its id, and its maximal repeats as word
    spans."""
    parts, rows, owner = gathered(group, ROW)
    start, count = (np.concatenate([np.frombuffer(x[c], "<u4") for x in parts]).astype(np.int64) for c in ("starts", "counts"))
    order = np.lexsort((start, owner))
    start, count, owner = start[order], count[order], owner[order]
    end = start + count - 1 + window
    # The furthest end so far in the document; documents are kept apart by a large step.
    far = np.maximum.accumulate(end + (owner << 33)) - (owner << 33)
    new = np.ones(len(start), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (start[1:] > far[:-1])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(start)) - 1
    cuts = np.searchsorted(owner[first], np.arange(len(rows) + 1)).astype(np.int32)
    lists = [pa.ListArray.from_arrays(pa.array(cuts), pa.array(x)) for x in (start[first], far[last])]
    return pa.table({"half": halves(rows), "order": pa.array(rows["id"]), "from_word": lists[0], "to_word": lists[1]})


def cleaned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds word counts and the text of the kept words to rows of id, text and spans."""
    for batch in slices((loose(x, 1) for x in small(batches)), 1):
        totals, removed, kept = [], [], []
        for text, lows, highs in zip(*(batch.column(i).to_pylist() for i in (1, 2, 3)), strict=True):
            words = WORD.findall(text or "")
            left, done = [], 0
            for low, high in zip(lows or (), highs or (), strict=True):
                left += words[done:low]
                done = high
            left += words[done:]
            totals.append(len(words))
            removed.append(len(words) - len(left))
            kept.append(" ".join(left))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(totals, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.string()), batch.column(2), batch.column(3)],
            ["id", "n_words", "n_removed", "kept_text", "from_word", "to_word"],
        )


def substring_dedup(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of `docs`: id, `n_words`, `n_removed`, `kept_text` (kept words, joined by
    a space), and the removed spans as `from_word` (inclusive), `to_word` (exclusive)."""
    kind = docs.schema[id_col].dataType.simpleString()
    text = F.col(f"`{text_col}`").cast("string")
    docs = docs.select(F.col(f"`{id_col}`").alias("id"), text.alias("text"))
    keyed = docs.select(row_key(F.col("id"), F.col("text")).alias("key"), F.col("id").cast("long").alias("order"), "id", "text")
    letters = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(1, letters // (6 * BUCKET_ENTRIES))
    half = F.substring("key", 1, 8)
    small_texts = keyed.select(half.alias("half"), "key", F.coalesce("order", F.lit(NO_ID)).alias("order"), "id", "text")
    small_texts = small_texts.mapInArrow(squeeze, f"half binary, key binary, order long, id {kind}, text binary")

    part = "bucket long, rows binary, owners binary"
    seeds = keyed.select("key", "order", "text").mapInArrow(lambda b: seed_parts(b, window, gram, buckets), f"{part}, seeds binary, again binary")
    seeds = seeds.groupBy("bucket").applyInArrow(lambda g: shared_seeds(g, buckets), f"{part}, seeds binary")
    seeds = stage(seeds.groupBy("bucket").applyInArrow(per_document, "half binary, seeds binary"), "seeds")

    both = small_texts.select("half", "key", "order", "text").join(seeds, "half").select("key", "order", "text", "seeds")
    windows = both.mapInArrow(lambda b: window_parts(b, window, gram, buckets), f"{part}, seeds binary, places binary, before binary, counts binary, hashes binary")
    found = windows.groupBy("bucket").applyInArrow(lambda g: repeats(g, buckets), f"{part}, starts binary, counts binary")
    found = found.groupBy("bucket").applyInArrow(lambda g: merged_spans(g, window), "half binary, order long, from_word array<long>, to_word array<long>")
    found = stage(found, "repeats")

    rows = small_texts.select("half", "order", "id", "text").join(found, ["half", "order"], "left").select("id", "text", "from_word", "to_word")
    out = rows.mapInArrow(cleaned, f"id {kind}, n_words long, n_removed long, kept_text string, from_word array<long>, to_word array<long>")
    return out.withColumnRenamed("id", id_col)
