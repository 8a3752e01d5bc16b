"""Quality rules as a ledger of failure bits and measurements.

`ledger` reads every text once and evaluates every rule once: a row holds what was
measured and a bit for each rule the document fails. A policy is a set of rules under a
version name; applying one, or comparing many, only reads the bits.

- Null and empty texts have no words; they fail `few_words`.
- A line counts as repeated if it has a word and equals an earlier line of the text.
- Rows are independent: repeated rows and null ids come out as they went in.
- Columns of `docs` named in `carry` pass through unread; the ledger is one struct
  column, whose name is lengthened if `docs` has a column of that name.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.llm.textual import flat, fresh_name, gram_hashes, inside, mix, slices, span_hashes, spans

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")
SYMBOLS = np.isin(np.arange(256), list(b"#*$%&|<>"))
WINDOW = 5

#: Each rule in SQL over the measurements; a rule's place is its bit, so add new ones at the end.
RULES = (
    ("few_words", "n_words < 10"),
    ("repeated_words", "100 * n_repeat_words > 20 * n_words"),
    ("symbols", "100 * n_symbols > 10 * word_chars"),
    ("repeated_lines", "100 * n_dup_lines > 30 * n_lines"),
    ("short_words", "word_chars < 2 * n_words"),
    ("long_words", "word_chars > 15 * n_words"),
)
POLICIES = {
    "base": ("few_words", "repeated_words"),
    "v1": ("few_words", "repeated_words", "symbols", "repeated_lines", "short_words", "long_words"),
}


def repeated(keys: np.ndarray, first_too: bool) -> np.ndarray:
    """Marks keys that occur twice or more; without `first_too`, all but the first of each."""
    order = np.argsort(keys, kind="stable")
    ordered = keys[order]
    same = np.concatenate(([False], ordered[1:] == ordered[:-1]))[: len(keys)]
    if first_too:
        same[:-1] |= same[1:].copy()
    out = np.zeros(len(keys), bool)
    out[order] = same
    return out


def per_text(marks: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.concatenate(([0], np.cumsum(marks, dtype=np.int64)))
    return np.diff(total[offsets])


def measured(texts: pa.Array) -> dict[str, np.ndarray]:
    data, offsets = flat(texts)
    starts, ends, first = spans(data, offsets)
    owner = np.repeat(np.arange(len(texts), dtype=np.uint64), np.diff(first))
    # Bytes other than continuation bytes are the code points.
    points = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80, dtype=np.int64)))
    chars = points[ends] - points[starts]

    at = inside(first, WINDOW)
    again = at[repeated(mix(gram_hashes(span_hashes(data, starts, ends), WINDOW)[at] + mix(owner[at])), True)] if len(at) else at
    cover = np.zeros(len(starts) + 1, np.int64)
    np.add.at(cover, again, 1)
    np.add.at(cover, again + WINDOW, -1)

    # Lines end at \n or with their text; those without a word do not count.
    breaks = np.unique(np.concatenate((offsets[:-1], np.flatnonzero(data == 10) + 1, offsets[-1:])))
    line_from, line_to = breaks[:-1], breaks[1:].copy()
    line_to -= data[line_to - 1] == 10
    words_before = np.searchsorted(starts, breaks)
    live = np.diff(words_before) > 0
    line_from, line_to = line_from[live], line_to[live]
    line_owner = np.searchsorted(offsets, line_from, "right") - 1
    same = repeated(mix(span_hashes(data, line_from, line_to) + mix(line_owner.astype(np.uint64))), False)
    return {
        "n_words": np.diff(first),
        "word_chars": per_text(chars, first),
        "n_symbols": per_text(SYMBOLS[data], offsets),
        "n_dup_lines": np.bincount(line_owner[same], minlength=len(texts)),
        "n_repeat_words": per_text(np.cumsum(cover)[:-1] > 0, first),
        "n_lines": np.bincount(line_owner, minlength=len(texts)),
    }


def measuring(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[pa.RecordBatch]:
    last = len(names) - 1  # the text
    for batch in slices(batches, last):
        found = measured(batch.column(last))
        columns = [pa.array(found[x].astype(np.int64)) for x in MEASURES]
        yield pa.RecordBatch.from_arrays(batch.columns[:-1] + [pa.StructArray.from_arrays(columns, list(MEASURES))], names)


def ledger(docs: DataFrame, carry: list[str], text_col: str = "text") -> tuple[DataFrame, str]:
    """`docs` with the columns of `carry` and a struct of `MEASURES` and `failed` (bits),
    and the name of that struct."""
    name = fresh_name(carry, "ledger")
    kinds = T.StructType([docs.schema[x] for x in carry]).add(name, T.StructType([T.StructField(x, T.LongType()) for x in MEASURES]))
    rows = docs.select(*(F.col(f"`{x}`") for x in carry), F.col(text_col).cast("string").alias(name))
    rows = rows.mapInArrow(lambda batches: measuring(batches, kinds.names), kinds)
    return rows.withColumn(name, F.col(name).withField("failed", F.expr(rule_bits(name)))), name


def rule_bits(name: str) -> str:
    """The failure bits, as SQL over the struct of measurements."""
    prefixed = []
    for i, (_, rule) in enumerate(RULES):
        words = [f"{name}.{x}" if x in MEASURES else x for x in rule.split(" ")]
        prefixed.append(f"CASE WHEN {' '.join(words)} THEN {1 << i}L ELSE 0L END")
    return " + ".join(prefixed)


def policy_bits(policy: str) -> int:
    names = [x for x, _ in RULES]
    return sum(1 << names.index(x) for x in POLICIES[policy])


def passes(failed: Column, policy: str) -> Column:
    return failed.bitwiseAND(F.lit(policy_bits(policy))) == 0


def ablations(rows: DataFrame, failed: Column, policy: str) -> DataFrame:
    """For each rule of a policy: how many documents fail it, how many fail it alone (and
    would be kept without it), and how many the policy rejects. One pass over the bits,
    which are counted per combination first; an empty ledger gives no rows."""
    whole = policy_bits(policy)
    combos = rows.groupBy(failed.bitwiseAND(F.lit(whole)).alias("bits")).agg(F.count("*").alias("n"))
    rules = F.explode(F.array(*(F.struct(F.lit(x).alias("rule"), F.lit(1 << i).cast("long").alias("bit")) for i, (x, _) in enumerate(RULES) if whole >> i & 1)))
    hit = F.col("bits").bitwiseAND(F.col("r.bit")) != 0
    count = lambda when: F.sum(F.when(when, F.col("n")).otherwise(0))
    return combos.select("bits", "n", rules.alias("r")).groupBy(F.col("r.rule").alias("rule")).agg(
        count(hit).alias("n_failed"),
        count(F.col("bits") == F.col("r.bit")).alias("n_failed_alone"),
        count(F.col("bits") != 0).alias("n_rejected"),
    )
