"""Encoding and decoding with a SentencePiece model by batched Viterbi.

White space becomes the letter U+2581 and one is put in front, as the model asks. Texts are cut
where no piece reaches across; the distinct words of a slice that are not known yet advance
together by length. At each end, hashes of all substrings that end there probe the sorted
keys of the pieces, scores of the best way to each start are added, and the maximum leaves a
backpointer. A word of more than `ALONE` letters takes the same steps by itself.

A unigram model allows every piece anywhere. A BPE model allows a piece only where its merges
would put it: a text's pieces are what the merges give if each two neighbours, taken by
themselves, stay apart. So for BPE a candidate counts only if it and the last piece of the
best way to its start stay apart, which the order of the merges at their edges decides. The ids
are those of the sentencepiece library. Of equally good ways, the longest last piece wins.

Characters without a piece become the pieces of their bytes, or the unknown piece if the model
has none. Null and empty texts have no pieces and decode to an empty text. Decoding gives back
every text but those that hold U+2581 itself, which come back with spaces. Rows are
independent: repeated rows and null ids come out as they went in; other columns pass through.
"""

from __future__ import annotations

import math
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from sentencepiece import sentencepiece_model_pb2

from tickloom.llm.textual import ODD, fresh_name, mix, slices

SPACE = "▁"
UNIGRAM, BPE = 1, 2
NORMAL, UNKNOWN, BYTE = 1, 2, 6
CACHE = 300_000
SLICE = 4 << 20  # bytes of text whose new words advance together
LONG = 48
BEGIN = np.uint64(44)  # of a hash, all but the first 20 bits
PAIR_BITS = 18  # of the table of verdicts on pairs
ALONE = 1_000
NEVER = np.int32(1 << 30)
#: Fixed value: what an unknown character costs below the worst piece of a unigram model.
UNKNOWN_PENALTY = 10.0


def merged(text: str, ranks: dict[str, int]) -> tuple[list[str], dict[str, tuple[str, str]]]:
    """The merges of a short text, lowest rank first and leftmost of equals: the symbols left,
    and what each symbol that came up was merged from."""
    symbols, made = list(text), {}
    while True:
        options = [(ranks[a + b], i) for i, (a, b) in enumerate(zip(symbols, symbols[1:], strict=False)) if a + b in ranks]
        if not options:
            return symbols, made
        i = min(options)[1]
        made.setdefault(symbols[i] + symbols[i + 1], (symbols[i], symbols[i + 1]))
        symbols[i : i + 2] = [symbols[i] + symbols[i + 1]]


class Pieces:
    """Tables of a model: sorted piece keys, scores, merge order and the bytes of each piece."""

    def __init__(self, data: bytes):
        model = sentencepiece_model_pb2.ModelProto.FromString(data)
        self.bpe = model.trainer_spec.model_type == BPE
        if not self.bpe and model.trainer_spec.model_type != UNIGRAM:
            raise ValueError("only unigram and BPE models are known")
        form = model.normalizer_spec
        if form.precompiled_charsmap or form.remove_extra_whitespaces or model.trainer_spec.treat_whitespace_as_suffix:
            raise ValueError("only models without a character map and with all white space kept are known")
        self.dummy = form.add_dummy_prefix
        self.n = len(model.pieces)
        kinds = [x.type for x in model.pieces]
        names = [x.piece for x in model.pieces]
        normal = [i for i, x in enumerate(kinds) if x == NORMAL]
        self.unknown = next(i for i, x in enumerate(kinds) if x == UNKNOWN)
        bytes_ = {int(names[i][1:-1], 16): i for i, x in enumerate(kinds) if x == BYTE}
        self.byte_ids = np.array([bytes_[b] for b in range(256)], np.int32) if len(bytes_) == 256 else None
        scores = np.array([x.score for x in model.pieces], np.float64)
        self.scores = np.append(scores, scores[normal].min() - UNKNOWN_PENALTY)  # last: an unknown character

        # What each piece decodes to.
        surface = [names[i].replace(SPACE, " ").encode() if kinds[i] == NORMAL else b"" for i in range(self.n)]
        for b, i in bytes_.items():
            surface[i] = bytes([b])
        surface[self.unknown] = model.trainer_spec.unk_surface.encode()
        self.sizes = np.array([len(x) for x in surface], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.surface = np.frombuffer(b"".join(surface), np.uint8)

        texts = [names[i] for i in normal]
        self.longest = max(map(len, texts))
        self.ids = dict(zip(texts, normal, strict=True))
        order = np.argsort(keys := np.array([text_hash(x) for x in texts], np.uint64))
        self.keys, self.key_ids = keys[order], np.array(normal, np.int64)[order]
        self.begun = np.zeros(1 << 20, bool)
        self.begun[(self.keys >> BEGIN).astype(np.int64)] = True
        self.verdicts: np.ndarray | None = None
        inner = any(SPACE in x.lstrip(SPACE) for x in texts)
        line = any("\n" in x for x in texts)
        self.cut = re.compile(r"(?s).+" if inner else (f"{SPACE}*[^{SPACE}]+|{SPACE}+" if line else f"{SPACE}*[^{SPACE}\n]+|{SPACE}+|\n"))
        self.bigrams = {x[i : i + 2] for x in texts for i in range(len(x) - 1)}
        if self.bpe:
            self.order_merges(texts, normal, scores)

    def order_merges(self, texts: list[str], ids: list[int], scores: np.ndarray) -> None:
        steps = {s: i for i, s in enumerate(sorted({scores[i] for i in ids}, reverse=True))}
        self.ranks = {x: steps[scores[i]] for x, i in zip(texts, ids, strict=True)}
        # Characters that are no piece by themselves are symbols still.
        symbols = dict(zip(texts, ids, strict=True))
        for x in sorted({c for t in texts for c in t} - set(symbols)):
            symbols[x] = self.n + 1 + len(symbols) - len(ids)
        size = max(symbols.values()) + 1
        self.names = {i: x for x, i in symbols.items()}
        pairs = sorted((symbols[x[:i]] << 20 | symbols[x[i:]], self.ranks[x]) for x in texts for i in range(1, len(x)) if x[:i] in symbols and x[i:] in symbols)
        self.pair_keys, self.pair_ranks = (np.array(x, np.int64) for x in zip(*pairs, strict=True))
        self.stable = np.zeros(size, bool)
        self.odd = np.zeros(size, bool)
        edges: dict[str, dict[int, list[tuple[int, int]]]] = {"left": {}, "right": {}}
        for x, i in symbols.items():
            left, made = merged(x, self.ranks)
            self.stable[i] = left == [x]
            for side, way in (("left", 0), ("right", 1)):
                chain, at = [], x
                while len(at) > 1 and left == [x]:
                    chain.append((symbols[at], self.ranks[at]))
                    self.odd[i] |= any(len(y) > 1 and self.ranks[y] >= self.ranks[at] for y in made[at])
                    at = made[at][way]
                edges[side][i] = [(symbols.get(at, -1), -1), *reversed(chain)] if left == [x] else [(i, -1)]
        deep = max(len(x) for side in edges.values() for x in side.values()) + 1
        self.edge = {}
        for side, chains in edges.items():
            symbol, rank = np.zeros((size, deep), np.int32), np.full((size, deep), NEVER)
            for i, chain in chains.items():
                symbol[i, : len(chain)] = [s for s, _ in chain]
                rank[i, : len(chain)] = [r for _, r in chain]
            self.edge[side] = symbol, rank
        self.slow: dict[tuple[int, int], bool] = {}
        self.pairs: dict[tuple[int, int], bool] = {}

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """The piece of each hash, or -1. Most substrings are no piece, which the first bits of the hash tell."""
        out = np.full(len(hashes), -1, np.int64)
        some = np.flatnonzero(self.begun[(hashes >> BEGIN).astype(np.int64)])
        probed = hashes[some]
        at = np.minimum(np.searchsorted(self.keys, probed), len(self.keys) - 1)
        out[some] = np.where(self.keys[at] == probed, self.key_ids[at], -1)
        return out

    def apart(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Whether two neighbouring pieces stay apart. Verdicts are remembered in one place per hash of a pair."""
        if self.verdicts is None:
            self.verdicts = np.full(1 << PAIR_BITS, -1, np.int64)
        pairs = left.astype(np.int64) << 21 | right
        places = ((pairs.view(np.uint64) * ODD) >> np.uint64(64 - PAIR_BITS)).astype(np.int64)
        known = self.verdicts[places]
        new = np.flatnonzero(known >> 1 != pairs)
        if len(new):
            known[new] = pairs[new] << 1 | self.followed(left[new], right[new])
            self.verdicts[places[new]] = known[new]
        return (known & 1).astype(bool)

    def followed(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Whether two neighbouring pieces stay apart: followed merge by merge, the symbols at
        their edges grow until a merge across comes first, or none is left."""
        verdict = np.ones(len(left), bool)
        live = np.flatnonzero((left != self.n) & (right != self.n))  # nothing merges with an unknown character
        strange = live[self.odd[left[live]] | self.odd[right[live]]]
        for k in strange.tolist():
            pair = int(left[k]), int(right[k])
            if pair not in self.slow:
                names = [self.names[x] for x in pair]
                self.slow[pair] = merged("".join(names), self.ranks)[0] == names
            verdict[k] = self.slow[pair]
        live = live[~(self.odd[left[live]] | self.odd[right[live]])]
        (left_symbol, left_rank), (right_symbol, right_rank) = self.edge["right"], self.edge["left"]
        i, j = np.zeros(len(live), np.int64), np.zeros(len(live), np.int64)
        while len(live):
            a, b = left[live], right[live]
            key = left_symbol[a, i].astype(np.int64) << 20 | right_symbol[b, j]
            at = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
            across = np.where(self.pair_keys[at] == key, self.pair_ranks[at], NEVER)
            grow_left, grow_right = left_rank[a, i + 1], right_rank[b, j + 1]
            joined = (across < NEVER) & (across < grow_left) & (across <= grow_right)
            verdict[live[joined]] = False
            more = ~joined & (np.minimum(grow_left, grow_right) < NEVER)
            first = grow_left <= grow_right
            i, j = (i + first)[more], (j + ~first)[more]
            live = live[more]
        return verdict

    def segment(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For words of one length (rows of code points), the length and the piece of the best
        last step to every place."""
        many, size = points.shape
        total = np.zeros((many, size + 1), np.uint64)
        up, down = point_powers(size)
        total[:, 1:] = np.cumsum(mix(points.astype(np.uint64) + np.uint64(1)) * up, axis=1)
        best = np.full((many, size + 1), -np.inf)
        best[:, 0] = 0
        back, piece = np.zeros((many, size + 1), np.int64), np.full((many, size + 1), -1)
        for end in range(1, size + 1):
            who, steps, found = [], [], []
            for step in range(1, min(self.longest, end) + 1):
                ids = self.find(mix((total[:, end] - total[:, end - step]) * down[end - step] + np.uint64(step)))
                if step == 1:
                    ids = np.where(ids < 0, self.n, ids)
                hit = np.flatnonzero(ids >= 0)
                who.append(hit)
                steps.append(np.full(len(hit), step))
                found.append(ids[hit])
            who, steps, found = np.concatenate(who), np.concatenate(steps), np.concatenate(found)
            value = best[who, end - steps] + self.scores[found]
            if self.bpe:
                first = steps == end
                before = np.where(first, self.n, piece[who, end - steps])
                fits = (found == self.n) | self.stable[np.minimum(found, len(self.stable) - 1)]
                fits &= np.where(first, True, before >= 0)
                test = np.flatnonzero(fits & ~first)
                fits[test] = self.apart(before[test], found[test])
                value = np.where(fits, value, -np.inf)
            top = np.full(many, -np.inf)
            np.maximum.at(top, who, value)
            win = (value == top[who]) & np.isfinite(value)
            best[:, end] = top
            back[who[win], end] = steps[win]  # of equals the longest, which comes last
            piece[who[win], end] = found[win]
        return back, piece

    def pair_apart(self, left: int, right: int) -> bool:
        pair = left, right
        if pair not in self.pairs:
            if len(self.pairs) > CACHE:
                self.pairs.clear()
            self.pairs[pair] = bool(self.apart(np.array([left]), np.array([right]))[0])
        return self.pairs[pair]

    def segment_alone(self, word: str) -> tuple[np.ndarray, np.ndarray]:
        """What `segment` gives, for one word, in time and memory in proportion to its length."""
        size, scores = len(word), self.scores.tolist()
        best = array("d", [-math.inf]) * (size + 1)
        best[0] = 0
        back, piece = array("i", [0]) * (size + 1), array("i", [-1]) * (size + 1)
        for end in range(1, size + 1):
            for step in range(1, min(self.longest, end) + 1):
                start = end - step
                found = self.ids.get(word[start:end], self.n if step == 1 else -1)
                if found < 0:
                    continue
                if self.bpe:
                    if found != self.n and not self.stable[found]:
                        continue
                    if start and (piece[start] < 0 or not self.pair_apart(piece[start], found)):
                        continue
                value = best[start] + scores[found]
                if value >= best[end] and value > -math.inf:  # of equals the longest, which comes last
                    best[end], back[end], piece[end] = value, step, found
        return np.array([back]), np.array([piece])

    def encode_words(self, words: list[str]) -> list[bytes]:
        """The ids of each word, as packed 32-bit integers: small to keep and quick to join."""
        sizes = np.array([len(x) for x in words])
        points = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32)
        starts = np.cumsum(sizes) - sizes
        out: list = [None] * len(words)
        for size in np.unique(sizes).tolist():
            same, some = np.flatnonzero(sizes == size), 1 if size > ALONE else 200_000 // size
            for group in np.split(same, range(some, len(same), some)):
                letters = points[starts[group][:, None] + np.arange(size)]
                back, piece = self.segment_alone(words[group[0]]) if size > ALONE else self.segment(letters)
                at = np.full(len(group), size)
                ways = []
                while (at > 0).any():
                    row = np.flatnonzero(at > 0)
                    ways.append((row, piece[row, at[row]], at[row] - 1))
                    at[row] -= back[row, at[row]]
                row, ids, place = (np.concatenate(x)[::-1] for x in zip(*ways, strict=True))
                order = np.argsort(row, kind="stable")
                row, ids, place = row[order], ids[order], place[order]
                cuts = np.searchsorted(row, np.arange(len(group) + 1))
                odd = set(row[ids == self.n].tolist())
                whole, at = ids.astype("<i4").tobytes(), (4 * cuts).tolist()
                for k, w in enumerate(group.tolist()):
                    part = slice(cuts[k], cuts[k + 1])
                    out[w] = self.spelled(ids[part], letters[k][place[part]]).astype("<i4").tobytes() if k in odd else whole[at[k] : at[k + 1]]
        return out

    def spelled(self, ids: np.ndarray, points: np.ndarray) -> np.ndarray:
        """Ids with those of bytes in the place of unknown characters."""
        out: list[int] = []
        for i, point in zip(ids.tolist(), points.tolist(), strict=True):
            if i != self.n:
                out.append(i)
            elif self.byte_ids is not None:
                out.extend(self.byte_ids[list(chr(point).encode("utf-8", "replace"))].tolist())
            elif not out or out[-1] != self.unknown:
                out.append(self.unknown)
        return np.array(out, np.int32)

    def words(self, text: str) -> list[str]:
        if not text:
            return []
        found = self.cut.findall((SPACE if self.dummy else "") + text.replace(" ", SPACE))
        if max(map(len, found)) <= LONG:
            return found
        return [part for x in found for part in (self.parts(x) if len(x) > LONG else (x,))]

    def parts(self, word: str) -> list[str]:
        """A long word, cut between letters that follow one another in no piece."""
        cuts = [0, *(i for i in range(1, len(word)) if word[i - 1 : i + 1] not in self.bigrams), len(word)]
        return [word[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]

    def decode(self, ids: np.ndarray, sizes: np.ndarray) -> list[str]:
        """The text of each run of ids."""
        length = self.sizes[ids]
        ends = np.cumsum(length)
        data = self.surface[np.repeat(self.starts[ids] - (ends - length), length) + np.arange(ends[-1] if len(ends) else 0)].tobytes()
        cuts = np.concatenate(([0], ends))[np.concatenate(([0], np.cumsum(sizes)))].tolist()
        texts = [data[a:b].decode("utf-8", "replace") for a, b in zip(cuts, cuts[1:], strict=False)]
        return [x[1:] if self.dummy and x.startswith(" ") else x for x in texts]


def point_powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    up, down = np.full(n + 1, ODD), np.full(n + 1, np.uint64(pow(int(ODD), -1, 1 << 64)))
    up[0] = down[0] = 1
    return np.multiply.accumulate(up)[:n], np.multiply.accumulate(down)


def text_hash(text: str) -> int:
    points = np.array([ord(x) for x in text], np.uint64)
    up, _ = point_powers(len(points))
    return int(mix(np.array([np.sum(mix(points + np.uint64(1)) * up, dtype=np.uint64) + np.uint64(len(points))], np.uint64))[0])


def encoding(batches: Iterator[pa.RecordBatch], pieces: Pieces, names: list[str]) -> Iterator[pa.RecordBatch]:
    known: dict[str, bytes] = {}
    last = len(names) - 1
    for batch in slices(batches, last, SLICE):
        words = [pieces.words(x or "") for x in batch.column(last).to_pylist()]
        if len(known) > CACHE:
            known.clear()
        new = list(set().union(*words).difference(known))
        if new:
            known.update(zip(new, pieces.encode_words(new), strict=True))
        runs = [b"".join(map(known.__getitem__, x)) for x in words]
        offsets = np.concatenate(([0], np.cumsum([len(x) // 4 for x in runs]))).astype(np.int32)
        ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(runs), "<i4")))
        yield pa.RecordBatch.from_arrays([*batch.columns[:-1], ids], names)


def decoding(batches: Iterator[pa.RecordBatch], pieces: Pieces, names: list[str]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, len(batch), 500):
            part = batch.slice(start, 500)
            lists = part.column(len(names) - 1).fill_null([])
            texts = pieces.decode(lists.flatten().to_numpy(), lists.value_lengths().to_numpy())
            yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(texts, pa.string())], names)


def read_pieces(model_path: str) -> Pieces:
    with open(model_path, "rb") as file:
        return Pieces(file.read())


def encode(docs: DataFrame, pieces: Pieces, carry: list[str], text_col: str = "text", ids_col: str = "pieces") -> tuple[DataFrame, str]:
    """`docs` with the columns of `carry` and an array of piece ids; and the name of that array.
    The tables (some MB, whatever the corpus) are built on the driver and sent along."""
    name = fresh_name(carry, ids_col)
    kinds = T.StructType([docs.schema[x] for x in carry]).add(name, T.ArrayType(T.IntegerType()))
    rows = docs.select(*(F.col(f"`{x}`") for x in carry), F.col(f"`{text_col}`").cast("string").alias(name))
    return rows.mapInArrow(lambda b: encoding(b, pieces, kinds.names), kinds), name


def decode(rows: DataFrame, pieces: Pieces, carry: list[str], ids_col: str = "pieces", text_col: str = "decoded") -> tuple[DataFrame, str]:
    """`rows` with the columns of `carry` and the text of the ids; and the name of that text."""
    name = fresh_name(carry, text_col)
    kinds = T.StructType([rows.schema[x] for x in carry]).add(name, "string")
    return rows.select(*(F.col(f"`{x}`") for x in carry), F.col(f"`{ids_col}`").alias(name)).mapInArrow(lambda b: decoding(b, pieces, kinds.names), kinds), name
