"""Token counts of a byte-level BPE vocabulary, merged rank by rank on arrays.

A slice of texts is cut into pre-tokens. The distinct ones that no earlier slice of
the task has counted become one ragged array of byte symbols. Each round finds the
lowest rank among the adjacent pairs of every sequence and merges all places of that
pair in all sequences at once; a sequence without a mergeable pair leaves the array,
and the symbols it still has are its tokens.

Null and empty texts have 0 bytes and 0 tokens. Strings of added tokens in a text count
as one token each, as the tokenizers library does by default. What is a letter or a number is
taken from the library, whose Unicode tables may be older than those here. Rows are independent:
repeated rows and null ids come out as they went in, and columns other than id and text
are not read.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers.pre_tokenizers import ByteLevel

from tickloom.llm.textual import slices

#: Fixed value: the published pattern that cuts text for this family of vocabularies.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
NO_RANK = np.int32(2**31 - 1)
CACHE = 200_000
SLICE = 4 << 20  # bytes of text whose new pre-tokens are merged together


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in the vocabulary file."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(other)) for b in range(256)]


def newer_letters() -> str:
    """The characters that are letters or numbers here and not in the library, whose Unicode tables are older: it is asked
    for each whether it goes on a word or a number. Empty if the tables agree."""
    every = "".join(chr(i) for i in range(0x80, 0x110000) if not 0xD800 <= i < 0xE000)
    found = []
    for kind, before in ((r"\p{L}", "a"), (r"\p{N}", "1")):
        asked = regex.findall(kind, every)
        text = "".join(f" {before}{c}" for c in asked)
        begun = {start for _, (start, _) in ByteLevel(add_prefix_space=False, use_regex=True).pre_tokenize_str(text)}
        found += [c for i, c in enumerate(asked) if 3 * i + 2 in begun]
    return "".join(sorted(found))


def ranges(letters: str) -> str:
    """A class of characters in ranges, in which they are looked up faster than one by one."""
    points = np.array([ord(c) for c in letters])
    parts = np.split(points, np.flatnonzero(np.diff(points) > 1) + 1)
    return "".join(rf"\U{part[0]:08X}-\U{part[-1]:08X}" for part in parts)


def older_pattern(newer: str) -> str:
    """`PATTERN` with classes that leave out the newer letters and numbers."""
    out = PATTERN.replace(r"[^\s\p{L}\p{N}]", r"(?:[^\s\p{L}\p{N}]|[NEWER])")
    for kind in (r"\p{L}+", r"\p{N}+"):
        out = out.replace(f" ?{kind}", f" ?(?:(?![NEWER]){kind[:-1]})+")
    return out.replace("[NEWER]", f"[{ranges(newer)}]")


class Merges:
    """A vocabulary's merges as sorted pair keys with their ranks."""

    def __init__(self, vocabulary: dict):
        model = vocabulary["model"]
        ids = model["vocab"]
        pairs = [tuple(x.split(" ")) if isinstance(x, str) else tuple(x) for x in model["merges"]]
        keys = np.array([ids[a] << 32 | ids[b] for a, b in pairs], np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks = keys[order], order.astype(np.int32)
        self.merged = np.array([ids[a + b] for a, b in pairs], np.int64)
        self.first = np.array([ids[x] for x in byte_letters()], np.int64)
        self.added = [x["content"] for x in vocabulary.get("added_tokens", [])]

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left << 32 | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], NO_RANK)

    def count(self, tokens: list[bytes]) -> np.ndarray:
        """Symbols that survive in each of the pre-tokens, none of which is empty."""
        sizes = np.array([len(x) for x in tokens], np.int64)
        symbols = self.first[np.frombuffer(b"".join(tokens), np.uint8)]
        owners, counts = np.arange(len(tokens)), np.zeros(len(tokens), np.int64)
        last = np.cumsum(sizes) - 1
        ranks = np.full(len(symbols), NO_RANK)
        ranks[:-1] = self.rank(symbols[:-1], symbols[1:])
        ranks[last] = NO_RANK
        while len(sizes):
            starts = np.cumsum(sizes) - sizes
            least = np.minimum.reduceat(ranks, starts)
            done = least == NO_RANK
            if done.any():
                counts[owners[done]] = sizes[done]
                rest = np.repeat(~done, sizes)
                symbols, ranks = symbols[rest], ranks[rest]
                owners, sizes, least = owners[~done], sizes[~done], least[~done]
                if not len(sizes):
                    break
            hit = ranks == np.repeat(least, sizes)
            # Of overlapping places (as in "aaa") every second one merges, from the left.
            at = np.flatnonzero(hit)
            run = np.maximum.accumulate(np.where(np.diff(at, prepend=-2) > 1, np.arange(len(at)), 0))
            at = at[(np.arange(len(at)) - run) % 2 == 0]
            symbols[at] = self.merged[ranks[at]]
            ends = np.cumsum(sizes)
            keep = np.ones(len(symbols), bool)
            keep[at + 1] = False
            owner = np.searchsorted(ends, at, "right")
            sizes = sizes - np.bincount(owner, minlength=len(sizes))
            symbols, ranks = symbols[keep], ranks[keep]
            at = at - np.arange(len(at))  # places before it have lost so many symbols
            changed = np.unique(np.concatenate((at, at[at > 0] - 1)))
            changed = changed[changed < len(symbols) - 1]
            ranks[changed] = self.rank(symbols[changed], symbols[changed + 1])
            ranks[np.cumsum(sizes) - 1] = NO_RANK
        return counts


def counted(batches: Iterator[pa.RecordBatch], vocabulary: str, newer: str = "") -> Iterator[pa.RecordBatch]:
    merges = Merges(json.loads(vocabulary))
    cut = regex.compile(PATTERN)
    # The exact classes are slow, and needed only where such a letter occurs.
    exact, rare = regex.compile(older_pattern(newer)) if newer else cut, frozenset(newer)
    added = regex.compile("|".join(map(regex.escape, sorted(merges.added, key=len, reverse=True)))) if merges.added else None
    known: dict[str, int] = {}
    for batch in slices(batches, 1, SLICE):
        pieces, specials = [], []
        for text in batch.column(1).to_pylist():
            parts = added.split(text or "") if added else [text or ""]
            specials.append(len(parts) - 1)
            way = cut if not text or text.isascii() or rare.isdisjoint(text) else exact
            pieces.append(way.findall(parts[0]) if len(parts) == 1 else [x for part in parts for x in way.findall(part)])
        if len(known) > CACHE:
            known.clear()
        new = list(set().union(*pieces).difference(known))
        if new:
            known.update(zip(new, merges.count([x.encode() for x in new]).tolist(), strict=True))
        tokens = [n + sum(map(known.__getitem__, x)) for n, x in zip(specials, pieces, strict=True)]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pc.fill_null(pc.binary_length(batch.column(1)), 0).cast(pa.int64()), pa.array(tokens, pa.int64())],
            ["id", "n_bytes", "n_tokens"],
        )


def token_counts(docs: DataFrame, vocabulary_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of `docs`: its id, `n_bytes` (UTF-8) and `n_tokens`.

    The vocabulary (some MB, whatever the corpus) is read on the driver and sent along.
    """
    with open(vocabulary_path, encoding="utf-8") as file:
        vocabulary = file.read()
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    newer = newer_letters()
    out = rows.mapInArrow(lambda batches: counted(batches, vocabulary, newer), f"id {kind}, n_bytes long, n_tokens long")
    return out.withColumnRenamed("id", id_col)
