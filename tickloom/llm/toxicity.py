"""Toxicity by a weighted lexicon.

Text is folded: lower case, look-alike letters of other scripts and digits to the letter
they imitate, everything that is no letter to one space. `i`, `l`, `1`, `!` and `|` fold to
one letter, as each stands for the others. Patterns are whole words and word beginnings.

Fitting, on a bounded sample of labelled rows (`max_rows`, by a hash of the id):
1. Equal texts of one label count once, here and in all that follows. Texts with a pattern
   are counted by label; all patterns of at least `ODDS` times the odds in toxic ones, beyond
   chance, are candidates. (Chance alone would let in ever slighter leanings as the sample grows.)
2. Their neighbouring words are collected. A pattern's weight is the log odds of its
   distinct contexts, so that copies of one document count once. Word pairs around a
   pattern that are found in clean documents only become exception phrases.
3. A logistic curve over the matched weight, and the weight per word, gives the score.
Scoring runs one Aho-Corasick automaton over each whole text; a match within an exception
phrase does not count.

Null and empty texts match nothing and get the score of such a text. A null id is never
held out and never has a label. Labels that are null do not count; if an id has several,
the highest does. Repeated rows are scored like others. Without labels of both kinds every
score is the share of toxic labels (0 without any).
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.llm.textual import slices
from tickloom.session import stage

# Letters of other scripts and signs, and the letter each looks like.
LOOKS = {
    "а": "a", "ɑ": "a", "α": "a", "@": "a", "4": "a", "в": "b", "β": "b", "8": "b", "с": "c", "ϲ": "c", "ԁ": "d",
    "е": "e", "ε": "e", "3": "e", "€": "e", "ɡ": "g", "9": "g", "һ": "h", "н": "h", "і": "i", "ι": "i", "ı": "i", "1": "i",
    "!": "i", "|": "i", "l": "i", "ӏ": "i", "ј": "j", "к": "k", "κ": "k", "м": "m", "ո": "n", "η": "n", "о": "o", "ο": "o",
    "0": "o", "р": "p", "ρ": "p", "ԛ": "q", "г": "r", "ѕ": "s", "$": "s", "5": "s", "т": "t", "τ": "t", "7": "t", "+": "t",
    "υ": "u", "ս": "u", "ν": "v", "ѵ": "v", "ѡ": "w", "ω": "w", "х": "x", "χ": "x", "у": "y", "γ": "y", "ᴢ": "z", "2": "z",
}
FOLD = str.maketrans(
    LOOKS
    | {chr(0xFF41 + i): "i" if i == 11 else chr(97 + i) for i in range(26)}  # full-width letters
    | dict.fromkeys("​‌‍⁠﻿­")  # invisible characters
)
# A sign at a word's end is punctuation, within it a letter.
TAIL = re.compile(r"[!|+$@€]+(?=\s|$)|(?<!\S)[!|+]+")
OTHER = re.compile(r"[\W_]+")
STEMS = (4, 5, 6, 7, 8)
MAX_ROWS = 50_000
LEAST_DOCS, LEAST_CONTEXTS = 3, 5
CANDIDATE, CHANCE = 10.0, 20.0  # G-squared
ODDS = 2.0  # less than what a weight takes in the end, which counts contexts instead of texts


def fold(text: str | None) -> str:
    """Words of folded text, with one space around each."""
    return f" {OTHER.sub(' ', TAIL.sub(' ', (text or '').lower()).translate(FOLD)).strip()} "


def patterns(folded: str) -> set[str]:
    """Whole words (a space at both ends) and word beginnings (a space in front)."""
    words = set(folded.split())
    found = {f" {x} " for x in words}
    for n in STEMS:
        found.update(f" {x[:n]}" for x in words if len(x) > n)
    return found


@dataclass
class Lexicon:
    weights: dict[str, float] = field(default_factory=dict)
    exceptions: set[str] = field(default_factory=set)
    curve: tuple[float, float, float] = (-20.0, 0.0, 0.0)

    def automaton(self) -> ahocorasick.Automaton | None:
        if not self.weights:
            return None
        made = ahocorasick.Automaton()
        for x in self.weights:
            made.add_word(x, x)
        made.make_automaton()
        return made


def found(automaton, folded: str) -> list[tuple[str, str, str]]:
    """Each match with the phrases that the word before and the word after make with it;
    of matches at one word, the longest."""
    at: dict[int, str] = {}
    for end, pattern in automaton.iter(folded) if automaton else ():
        start = end + 1 - len(pattern)
        if len(pattern) > len(at.get(start, "")):
            at[start] = pattern
    out = []
    for start, pattern in at.items():
        stop = folded.index(" ", start + 1)
        before = folded[folded.rfind(" ", 0, start) + 1 : stop]
        following = folded.find(" ", stop + 1)
        out.append((pattern, before, folded[start + 1 : following if following > 0 else stop]))
    return out


def features(lexicon: Lexicon, automaton, folded: str) -> tuple[float, float]:
    total = sum(lexicon.weights[p] for p, a, b in found(automaton, folded) if a not in lexicon.exceptions and b not in lexicon.exceptions)
    return math.log1p(total), math.log1p(100 * total / max(1, folded.count(" ") - 1))


def pattern_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: tuple[Counter, Counter] = (Counter(), Counter())

    def flush():
        names = list(set(counts[0]) | set(counts[1]))
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), *(pa.array([c[x] for x in names], pa.int64()) for c in counts)], ["pattern", "clean", "toxic"])
        for c in counts:
            c.clear()

    for batch in slices(batches, 0):
        for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            counts[toxic].update(patterns(fold(text)))
        if len(counts[0]) + len(counts[1]) > 300_000:
            yield from flush()
    yield from flush()


def contexts(batches: Iterator[pa.RecordBatch], lexicon: Lexicon) -> Iterator[pa.RecordBatch]:
    automaton = lexicon.automaton()
    for batch in slices(batches, 0):
        seen = set()
        for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            seen.update((*x, toxic) for x in found(automaton, fold(text)))
        yield pa.RecordBatch.from_arrays([pa.array(list(x)) for x in zip(*seen, strict=True)] if seen else [pa.array([], pa.string())] * 3 + [pa.array([], pa.int64())], ["pattern", "before", "after", "toxic"])


def scored(batches: Iterator[pa.RecordBatch], lexicon: Lexicon) -> Iterator[pa.RecordBatch]:
    """The two features of each text (its first column), and the other columns."""
    automaton = lexicon.automaton()
    for batch in slices(batches, 0):
        both = np.array([features(lexicon, automaton, fold(x)) for x in batch.column(0).to_pylist()]).reshape(-1, 2)
        yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(both[:, 0]), pa.array(both[:, 1])], [*batch.schema.names[1:], "weight", "density"])


def surprise(toxic: Column, clean: Column, n_toxic: float, n_clean: float) -> Column:
    """G-squared of a pattern's counts against the shares of the labels."""
    share, n = n_toxic / (n_toxic + n_clean), toxic + clean
    term = lambda k, p: F.when(k > 0, k * F.log(k / (n * p))).otherwise(0.0)
    return 2 * (term(toxic, share) + term(clean, 1 - share))


def log_odds(toxic: Column, clean: Column, n_toxic: float, n_clean: float) -> Column:
    return F.log((toxic + 0.5) / (n_toxic + 1.0)) - F.log((clean + 0.5) / (n_clean + 1.0))


def logistic(x: np.ndarray, y: np.ndarray, penalty: float = 0.01) -> np.ndarray:
    """Weights of a logistic curve by Newton's method; the penalty keeps them finite."""
    x = np.column_stack((np.ones(len(x)), x))
    w = np.zeros(x.shape[1])
    ridge = penalty * np.eye(len(w))
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge, x.T @ (y - p) - ridge @ w)
        w += np.clip(step, -5, 5)
        if abs(step).max() < 1e-6:
            break
    return w


def fit(labelled: DataFrame) -> Lexicon:
    """Learns from rows of `text`, `toxic` (0 or 1); the caller bounds them, and with them and
    the thresholds what is collected here."""
    rows = stage(labelled.select("text", F.col("toxic").cast("long").alias("toxic")).distinct(), "labelled")
    sums = rows.agg(F.coalesce(F.sum("toxic"), F.lit(0)).alias("t"), F.count("*").alias("n")).first()
    toxic, clean = float(sums["t"]), float(sums["n"] - sums["t"])
    if not toxic or not clean:
        return Lexicon(curve=(20.0 if toxic else -20.0, 0.0, 0.0))
    t, c = F.col("toxic"), F.col("clean")
    counts = rows.mapInArrow(pattern_counts, "pattern string, clean long, toxic long").groupBy("pattern").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    odd = counts.withColumn("g", surprise(t, c, toxic, clean)).where((t >= LEAST_DOCS) & (F.col("g") > CANDIDATE) & (log_odds(t, c, toxic, clean) > math.log(ODDS)))
    candidates = Lexicon({x["pattern"]: 1.0 for x in odd.select("pattern").collect()})

    near = stage(rows.mapInArrow(lambda b: contexts(b, candidates), "pattern string, before string, after string, toxic long").distinct(), "contexts")
    by_label = [F.sum("toxic").alias("toxic"), F.sum(1 - F.col("toxic")).alias("clean")]
    kept = near.groupBy("pattern").agg(*by_label).withColumn("w", log_odds(t, c, toxic, clean))
    kept = kept.where((t >= LEAST_CONTEXTS) & (surprise(t, c, toxic, clean) > CHANCE) & (F.col("w") > 1))
    kept = stage(kept.select("pattern", "w"), "lexicon")
    weights = {x["pattern"]: x["w"] for x in kept.collect()}
    phrases = near.join(F.broadcast(kept.select("pattern")), "pattern", "left_semi")
    phrases = phrases.select(F.explode(F.array("before", "after")).alias("phrase"), "toxic").groupBy("phrase").agg(*by_label)
    innocent = phrases.where((c >= LEAST_CONTEXTS) & (t == 0)).collect()
    lexicon = Lexicon(weights, {x["phrase"] for x in innocent})

    points = rows.mapInArrow(lambda b: scored(b, lexicon), "toxic long, weight double, density double").toPandas()
    lexicon.curve = tuple(logistic(points[["weight", "density"]].to_numpy(), points["toxic"].to_numpy()).tolist())
    return lexicon


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def score(docs: DataFrame, lexicon: Lexicon, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of `docs`: id, `score` and `predicted`."""
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(f"`{text_col}`").cast("string").alias("text"), F.col(f"`{id_col}`").alias("id"))
    rows = rows.mapInArrow(lambda b: scored(b, lexicon), f"id {kind}, weight double, density double")
    a, b, c = lexicon.curve
    curve = 1 / (1 + F.exp(-(F.lit(a) + b * F.col("weight") + c * F.col("density"))))
    return rows.select(F.col("id").alias(id_col), curve.alias("score")).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", max_rows: int = MAX_ROWS) -> DataFrame:
    """Scores all rows of `docs` after fitting on at most `max_rows` labelled ids that are not
    held out: id, `held_out`, `score`, `predicted`."""
    key = F.col(f"`{id_col}`")
    known = labels.where(~held_out(key) & F.col(f"`{label_col}`").isNotNull() & key.isNotNull())
    known = known.groupBy(key.alias("id")).agg(F.max(f"`{label_col}`").cast("long").alias("toxic"))
    # Thinned by hash to little more than the bound first, so that no task sorts all labels.
    known = stage(known, "labels")
    share = 1.2 * max_rows / max(1, known.count())
    thin = known.where(F.pmod(F.xxhash64("id"), F.lit(1 << 20)) < share * (1 << 20))
    sample = stage(thin.orderBy(F.xxhash64("id"), "id").limit(max_rows), "sample")
    texts = docs.select(key.alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    lexicon = fit(texts.join(F.broadcast(sample), "id"))
    return score(docs, lexicon, id_col, text_col).withColumn("held_out", held_out(F.col(id_col))).select(id_col, "held_out", "score", "predicted")
