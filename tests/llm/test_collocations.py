"""Collocations against plain counting, and the double-array trie against a dict."""

import random
import re
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest

from tickloom.llm import collocations
from tickloom.llm.double_array import build

SCHEMA = "doc_id long, text string, lang string, words string, rank int"


def plain(rows, min_count=10, max_words=3, top=2000, percent=50):
    f, n = defaultdict(Counter), Counter()
    for _, text, lang in rows:
        text = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
        for piece in re.split(r"[.,;:!?\n-\r]", text):
            words = re.findall(r"[^ \t]+", piece)
            n[lang or "und"] += len(words)
            for k in range(1, max_words + 1):
                for i in range(len(words) - k + 1):
                    f[lang or "und"][tuple(words[i : i + k])] += 1
    out = []
    for lang, counts in f.items():
        good = {g: a for g, a in counts.items() if len(g) > 1 and a >= min_count}
        held = defaultdict(int)
        for g, a in good.items():
            for k in range(2, len(g)):
                for i in range(len(g) - k + 1):
                    held[g[i : i + k]] = max(held[g[i : i + k]], a)
        scored = []
        for g, a in good.items():
            cuts = [(1_000_000 * a * a // (counts[g[:k]] * counts[g[k:]]), k) for k in range(1, len(g))]
            score, k = min(cuts)
            if 100 * held[g] < percent * a:
                scored.append((-score, -a, " ".join(g).encode(), counts[g[:k]], counts[g[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(scored)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n[lang], -score))
    return sorted(out)


def query(spark, rows, **more):
    frame = spark.createDataFrame([(*r, "w", 7) for r in rows], SCHEMA).repartition(3)
    found = collocations.collocations(frame, **more)
    return sorted(tuple(r) for r in found.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


def some_rows():
    pick = random.Random(4)
    names = ["New", "York", "City", "a", "of", "the", "é", "日本", "x\x01", "x", "\x0e", "#1"]
    weights = [9, 9, 6, 5, 4, 4, 2, 2, 1, 3, 1, 1]
    rows = []
    for i in range(120):
        text = "".join(x + pick.choice([" ", " ", "  ", "\t", ", ", "\n", ".\r", " ! "]) for x in pick.choices(names, weights, k=60))
        rows.append((i, text, pick.choice(["en", "de", None, "und"])))
    rows += [(1, "new york city " * 30, "en")] * 3 + [(None, None, "en"), (5, "", None), (6, " \t\n", "fr"), (7, "only here", "es")]
    rows += [(8, "very long " * 30_000, "en"), (9, "z" * 50_000 + " very long", "en")]
    return rows


def test_equals_plain_counting(spark):
    rows = some_rows()
    assert query(spark, rows) == plain(rows)


@pytest.mark.parametrize("more", [{"max_words": 4, "min_count": 3}, {"max_words": 2, "top": 3}])
def test_other_parameters(spark, more):
    rows = some_rows()[:140]
    named = {"percent" if x == "inside_percent" else x: v for x, v in more.items()}
    assert query(spark, rows, **more) == plain(rows, **named)


def test_several_shards_and_full_slots(spark, monkeypatch):
    """Words and candidates in shards of five; so few slots that every candidate passes them."""
    monkeypatch.setattr(collocations, "WORD_SHARD", 5)
    monkeypatch.setattr(collocations, "EDGE_SHARD", 5)
    rows = some_rows()[:25]
    assert query(spark, rows, bits=2, min_count=8, max_words=4) == plain(rows, min_count=8, max_words=4)


def test_candidates_of_a_large_corpus_take_one_pass(spark, monkeypatch):
    """However many shards of candidates there are, a level is counted once; several tries go in a pass."""
    for name, value in (("SHARD_WORDS", 60), ("EDGE_SHARD", 5), ("HELD", 20), ("GATHERED", 50), ("TRIES_AT_ONCE", 3)):
        monkeypatch.setattr(collocations, name, value)
    staged, stage = [], collocations.stage
    monkeypatch.setattr(collocations, "stage", lambda df, name: staged.append(name) or stage(df, name))
    rows = some_rows()[:25]
    assert query(spark, rows, bits=2, min_count=8, max_words=3) == plain(rows, min_count=8, max_words=3)
    assert staged.count("counts") == 2


def test_words_that_share_a_hash(spark, monkeypatch):
    """The first salt gives all words of a length one key, so the next one is taken."""
    usual = collocations.count_words

    def poor(batches, salt):
        for out in usual(batches, salt):
            yield out if salt else out.set_column(2, "key", pc.binary_length(out.column(1)).cast(pa.int64()))

    monkeypatch.setattr(collocations, "count_words", poor)
    rows = some_rows()[:40]
    frame = spark.createDataFrame([(x[2] or "und", x[1]) for x in rows], "lang string, text string")
    words, _, salt = collocations.frequent_words(frame, 1)
    assert salt == 1 and words.groupBy("key").count().where("count > 1").isEmpty()
    assert sorted(r.word for r in words.collect() if r.lang == "en") == sorted({w for _, t, lang in rows if lang == "en" for w in re.findall(r"[^ \t\n\r.,!]+", t.lower())})


def test_small_pieces_and_batches(monkeypatch):
    """Inside a task: words in short rows, worked on few at a time, give the counts and states of whole ones."""
    rows = some_rows()[:-2]
    batch = pa.RecordBatch.from_arrays([pa.array([x[2] or "und" for x in rows]), pa.array([x[1] for x in rows], pa.string())], ["lang", "text"])
    (counted,) = collocations.count_words(iter([batch]), 0)
    known = type("Known", (), {"value": np.sort(counted.column(2).to_numpy())})
    found = []
    for piece, gathered, bytes_ in ((1 << 12, 1 << 18, 1 << 19), (7, 50, 30)):
        for name, value in (("PIECE", piece), ("GATHERED", gathered), ("RANGE", bytes_), ("HELD", 20)):
            monkeypatch.setattr(collocations, name, value)
        both = lambda passed: [x.select(["ids", "states"]) for x in passed]
        corpus, out = list(collocations.numbered(iter([batch]), 0, known, 0)), []
        for k in (2, 3, 4):
            edges, n = np.unique(np.concatenate([collocations.edges_of(i, s, k)[1] for i, s in collocations.stretches(iter(both(corpus)))]), return_counts=True)
            full = type("Full", (), {"value": np.full(8, 255, np.uint8)})
            assert set(np.concatenate([x.column(0).to_numpy() for x in collocations.distinct_edges(iter(both(corpus)), k, 6, full)]).tolist()) == set(edges.tolist())
            edges = edges[n >= 2]
            trie = type("Shared", (), {"value": build(edges)})
            (counts,) = collocations.count_edges(iter(both(corpus)), k, trie, 0, len(edges))
            assert counts.column(1).to_pylist() == n[n >= 2].tolist()
            # In two shards, of which the second leaves the old states out.
            half, tries = len(edges) // 2, [type("Shared", (), {"value": build(x)}) for x in (edges[: len(edges) // 2], edges[len(edges) // 2 :])]
            corpus = list(collocations.advance(iter(corpus), k, tries[0], 0, False))
            corpus = list(collocations.advance(iter(corpus), k, tries[1], half, True))
            assert piece > 100 or max(len(x) for c in corpus for x in c.column(0).to_pylist()) < 4 * 2000
            out.append((edges.tolist(), n.tolist()))
        found.append(out)
    assert found[0] == found[1]


def test_empty_tables(spark):
    assert query(spark, []) == []
    assert query(spark, [(1, "", "en"), (2, None, None), (3, "one two", "en")]) == []


def test_scores_are_exact_beyond_64_bits(spark):
    a = 10**12 + 7
    row = spark.createDataFrame([(a, a + 1, a + 2)], "a long, l long, r long")
    exact = {x: f"CAST({x} AS DECIMAL(15,0))" for x in "alr"}
    got = row.selectExpr(f"(CAST(1000000 AS DECIMAL(7,0)) * {exact['a']} * {exact['a']}) div ({exact['l']} * {exact['r']})").first()[0]
    assert got == Fraction(10**6 * a * a, (a + 1) * (a + 2)).__floor__()


@pytest.mark.parametrize("n, most", [(0, 10), (1, 1), (500, 40), (20_000, 300), (50_000, 3_000_000)])
def test_trie_finds_its_edges_only(n, most):
    rng = np.random.default_rng(n)
    parents, labels = (rng.pareto(0.7, n) * 5).astype(np.int64) % max(most, 1), rng.integers(0, most, n)
    edges = np.unique(parents << 32 | labels)
    trie = build(edges)
    index = {int(e): i for i, e in enumerate(edges)}
    asked = np.concatenate((edges, rng.integers(0, most, 1000) << 32 | rng.integers(0, 2 * most, 1000)))
    assert trie.find(asked >> 32, asked & 0xFFFFFFFF).tolist() == [index.get(int(e), -1) for e in asked]
