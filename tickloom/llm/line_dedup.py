"""Removal of lines like earlier ones, by an exact set-similarity join in DataFrame operations.

A line's set holds its distinct words; lines without a word are left alone. A line goes if an
earlier line (smaller id, or same id and smaller number) has an equal set, or one with
`den * |A & B| >= num * |A | B|`, whether or not that line stays.

1. Words are counted in `SLOTS` hash slots, a table of fixed size that goes to every task.
   It orders the words of a line by rarity; any fixed order gives the same links.
2. Texts are taken apart once more, and each line leaves what is needed of its set: a key, its
   size, a sketch of 128 bits (each word flips one, so that differing bits are words of one set
   only), and its prefix, the rarest words. Equal sets are collapsed onto the first line that
   has them, pre-aggregated before the shuffle, and numbered in the order of these lines.
3. Sets meet at the words of their prefixes, `n - ceil(t n) + 1` rarest ones. Sizes, what is
   left behind the places of the word, and the sketches rule pairs out.
4. A word in more than `CROWD` prefixes splits its sets by the word they share next, which the
   prefix one longer holds. Where more than `CROWD` still meet, all are compared with the first
   of them, which settles groups of near copies at a cost of a row each. Only sets not yet
   removed are then compared, as later ones, with all. Where more than `AT_ONCE` rows, or `EACH` for each
   set, go to their words, the words are dealt to rounds by a hash, and the pairs of a round are kept
   before the next one, so the disk holds the rows of a round.
5. Each set is verified with the first of its candidates, and if that is not like it with the
   others. Lines are found in the texts by a hash, in one pass for all of these pairs, and taken
   apart again only for this; a table of bits, of fixed size, keeps other lines out of the shuffle.

A null id comes after all others; rows tied in id come in the order they are read in. Null and
empty texts have no lines. Columns other than id and text are not read. Words, sets and lines are
known by 64 bits of hash. An empty table gives no rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.session import stage

SLOTS = 1 << 18
BLOCK_BITS = 10
LINE_SLOTS = 1 << 16
CROWD = 256
AT_ONCE = 1 << 23
EACH = 4
PLACE = ("no_id", "id", "row", "no")
WORD = r"[^\x20\x09-\x0D]"


def parted(text: Column) -> Column:
    """The text cut at spaces; empty words are left in."""
    for space in "\t\n\x0b\x0c\r":
        text = F.replace(text, F.lit(space), F.lit(" "))
    return F.split(text, " ")


def word_set(line: Column) -> Column:
    """The hashes of the distinct words."""
    return F.array_remove(F.array_distinct(F.transform(parted(line), lambda w: F.xxhash64(w))), F.xxhash64(F.lit("")))


def slot(hash_: Column, slots: int) -> Column:
    return hash_.bitwiseAND(F.lit(slots - 1)).cast("int")


def byte_table(found: DataFrame, slots: int) -> bytes:
    """A byte `c` for each of the places `s`, 0 where `found` has none.

    Of fixed size whatever the corpus, so it goes to tasks as a literal: an array column
    would be copied into every row.
    """
    zero = found.sparkSession.range(slots).select(F.col("id").cast("int").alias("s"), F.lit(0).cast("long").alias("c"))
    full = zero.union(found.select("s", F.col("c").cast("long"))).groupBy("s").agg(F.sum("c").alias("c"))
    full = full.withColumn("c", F.lpad(F.hex("c"), 2, "0"))
    ordered = lambda rows: F.array_sort(F.collect_list(rows))
    blocks = full.groupBy(F.shiftright("s", BLOCK_BITS).alias("b")).agg(F.array_join(F.transform(ordered(F.struct("s", "c")), lambda x: x["c"]), "").alias("a"))
    return bytes(blocks.agg(F.unhex(F.array_join(F.transform(ordered(F.struct("b", "a")), lambda x: x["a"]), ""))).first()[0])


def frequencies(texts: DataFrame) -> bytes:
    """How common the words of each slot are, on a logarithmic scale of seven bits."""
    words = texts.select(F.explode(parted(F.col("text"))).alias("w")).where("w <> ''")
    found = words.groupBy(slot(F.xxhash64("w"), SLOTS).alias("s")).agg(F.count("*").alias("c"))
    return byte_table(found.select("s", F.least(F.floor(5 * F.log2(F.col("c") + 1)), F.lit(127)).alias("c")), SLOTS)


def spare(n: Column, num: int, den: int) -> Column:
    """How many words of a set of size n a link can do without."""
    return n - F.ceil(n * num / den).cast("int")


def sketch(words: Column, half: int) -> Column:
    """One half of 128 bits, of which each word flips one."""
    one = lambda w: F.shiftright(w if half else F.bitwise_not(w), 6).bitwiseAND(F.lit(1).cast("long"))
    flip = lambda w: F.call_function("shiftleft", one(w), w.bitwiseAND(F.lit(63)).cast("int"))
    return F.aggregate(words, F.lit(0).cast("long"), lambda a, w: a.bitwiseXOR(flip(w)))


def line_sets(docs: DataFrame, id_col: str, text_col: str, num: int, den: int) -> DataFrame:
    """A row for each line with a word, and for the first of every text (null: empty)."""
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    common = F.split(F.lit(",".join(str(c // 2) for c in frequencies(docs.select(text.alias("text"))))), ",").cast("array<int>")
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(f"`{id_col}`").alias("id"), text.alias("text"))
    lines = rows.select("row", "id", F.posexplode(F.split("text", "\n")).alias("no", "line"))
    lines = lines.where((F.col("no") == 0) | F.col("line").rlike(WORD))
    lines = lines.select("row", "id", "no", F.xxhash64("line").alias("line_hash"), word_set(F.col("line")).alias("words"))
    # A word as half its rarity, then 57 bits of its hash; in a prefix as an integer with 25 bits of it.
    ranked = F.transform("words", lambda w: F.shiftleft(common[slot(w, SLOTS)].cast("long"), 57).bitwiseOR(F.shiftrightunsigned(w, 7)))
    lines = lines.withColumn("ranked", F.sort_array(ranked))
    n = F.size("words")
    prefix = F.transform(F.slice("ranked", F.lit(1), spare(n, num, den) + 2), lambda w: F.shiftright(w, 32).cast("int"))
    key = F.when(n > 0, F.xxhash64("ranked")).otherwise(F.xxhash64("row"))
    return lines.select("row", "id", "no", "line_hash", key.alias("key"), n.alias("n"), sketch(F.col("words"), 0).alias("low"), sketch(F.col("words"), 1).alias("high"), prefix.alias("prefix"))


def needed(a: Column, b: Column, num: int, den: int) -> Column:
    """How many words sets of sizes a and b must share."""
    return F.ceil(num * (a + b) / (num + den))


def can_link(num: int, den: int) -> Column:
    """Whether sets at places `pos` of a shared prefix word may link: by size, by their sketches,
    and by what is left from these places on (unless they share a rarer word, where this is
    tested again)."""
    n_l, n_r = F.shiftright("l.at", 32), F.shiftright("r.at", 32)
    pos = lambda side: F.col(f"{side}.at").bitwiseAND(F.lit((1 << 32) - 1))
    differ = F.bit_count(F.col("l.low").bitwiseXOR(F.col("r.low"))) + F.bit_count(F.col("l.high").bitwiseXOR(F.col("r.high")))
    return (
        (F.col("l.k") == F.col("r.k"))
        & (den * n_l >= num * n_r)
        & (den * n_r >= num * n_l)
        & ((num + den) * differ <= (den - num) * (n_l + n_r))
        & ((num + den) * F.least(n_l - pos("l"), n_r - pos("r")) >= num * (n_l + n_r))
    )


def crowded_words(posted: DataFrame) -> DataFrame:
    """The words of more than `CROWD` prefixes (`word`, `c`); a word is counted if those of its slot are as many."""
    at = lambda w: slot(w, SLOTS)
    found = posted.groupBy(at(F.col("word")).alias("s")).agg(F.count("*").alias("c"))
    table = byte_table(found.where(F.col("c") > CROWD).select("s", F.lit(1).alias("c")), SLOTS)
    posted = posted.where(F.substring(F.lit(table), at(F.col("word")) + 1, F.lit(1)) == F.lit(b"\x01"))
    return posted.groupBy("word").agg(F.count("*").alias("c")).where(F.col("c") > CROWD)


class Meetings:
    """The sets at each word `k` of their prefixes, and apart those at words with a crowd (if there are any), each at two
    words; in rounds by a hash of `k`."""

    def __init__(self, sets: DataFrame, num: int, den: int):
        n, self.num, self.den = F.col("n"), num, den
        self.posted = sets.select("seq", "n", "low", "high", "prefix", F.posexplode(F.slice("prefix", F.lit(1), spare(n, num, den) + 1)).alias("pos", "word"))
        self.rest = (F.shiftleft(n.cast("long"), 32).bitwiseOR(F.col("pos").cast("long")).alias("at"), "seq", "low", "high")
        crowds = stage(crowded_words(self.posted.select("word")), "crowds")
        held, words = crowds.agg(F.sum("c"), F.count("*")).first()
        self.crowds = crowds.select("word") if words else None
        count, rows, longest = sets.agg(F.count("*"), F.sum(spare(n, num, den) + 1), F.avg(F.size("prefix"))).first()
        self.at_once = max(AT_ONCE, EACH * count)
        self.split_rows = int((held or 0) * (longest or 0))  # at most about so many
        self.rows = (rows or 0) + self.split_rows

    def rounds(self, rows: int) -> range:
        return range(max(1, -(-rows // self.at_once)))

    def of_round(self, rows: DataFrame, i: int, rounds: range) -> DataFrame:
        return rows if len(rounds) == 1 else rows.where(F.pmod(F.xxhash64("k"), F.lit(len(rounds))) == i)

    def plain(self, i: int, rounds: range) -> DataFrame:
        plain = self.of_round(self.posted.select(F.col("word").alias("k"), *self.rest), i, rounds)
        return plain if self.crowds is None else plain.join(self.crowds.toDF("k"), "k", "left_anti")

    def crowded(self, i: int, rounds: range) -> DataFrame:
        # Sets that may link by one shared word stay at that word, too.
        n = F.col("n")
        few = needed(n, F.ceil(n * self.num / self.den), self.num, self.den) <= 1
        after = F.slice("prefix", F.col("pos") + 2, F.size("prefix"))
        split = self.posted.join(self.crowds, "word", "left_semi").withColumn("next", F.explode(F.when(few, F.array_append(after, F.lit(-1))).otherwise(after)))
        return self.of_round(split.select(F.xxhash64("word", "next").alias("k"), *self.rest), i, rounds)


def union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.union, parts)


def met(left: DataFrame, right: DataFrame, on: Column) -> DataFrame:
    """Pairs of sets, the earlier one `a` and the later one `b`."""
    found = left.alias("l").join(right.alias("r"), on)
    return found.select(F.least("l.seq", "r.seq").alias("a"), F.greatest("l.seq", "r.seq").alias("b"))


def lines_of(pairs: DataFrame, sets: DataFrame, texts: DataFrame) -> DataFrame:
    """The line of each set in these pairs."""
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("seq")).distinct()
    wanted = stage(sets.select("seq", "line_hash").join(wanted, "seq", "left_semi"), "wanted")
    place, bit = (lambda h: slot(F.shiftright(h, 3), LINE_SLOTS)), (lambda h: F.call_function("shiftleft", F.lit(1), h.bitwiseAND(F.lit(7)).cast("int")))
    table = byte_table(wanted.groupBy(place(F.col("line_hash")).alias("s")).agg(F.bit_or(bit(F.col("line_hash"))).alias("c")), LINE_SLOTS)
    lines = texts.select(F.explode(F.split("text", "\n")).alias("line")).select(F.xxhash64("line").alias("line_hash"), "line")
    held = F.conv(F.hex(F.substring(F.lit(table), place(F.col("line_hash")) + 1, F.lit(1))), 16, 10).cast("int")
    lines = lines.where(held.bitwiseAND(bit(F.col("line_hash"))) != 0).groupBy("line_hash").agg(F.first("line").alias("line"))
    return stage(lines.join(wanted, "line_hash").select("seq", "line"), "pair-lines")


def verified(pairs: DataFrame, lines: DataFrame, num: int, den: int) -> DataFrame:
    """The sets `b` of the pairs that link."""
    both = pairs.select("a", "b").join(lines.toDF("a", "x"), "a").join(lines.toDF("b", "y"), "b")
    both = both.select("b", word_set(F.col("x")).alias("x"), word_set(F.col("y")).alias("y"))
    both = both.select("b", F.size(F.array_intersect("x", "y")).alias("same"), (F.size("x") + F.size("y")).alias("sum"))
    return stage(both.where(den * F.col("same") >= num * (F.col("sum") - F.col("same"))).select("b").distinct(), "like")


def line_dedup(docs: DataFrame, num: int = 4, den: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of `docs`: id, `n_lines` (with a word), `n_removed`, and the numbers of
    the removed lines (from 0, over all lines) as `removed`."""
    texts = docs.select(F.col(f"`{text_col}`").cast("string").alias("text"))
    lines = stage(line_sets(docs, id_col, text_col, num, den), "lines")
    first = F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "row", "no", "line_hash", "n", "low", "high", "prefix")).alias("first")
    sets = lines.where("n > 0").groupBy("key").agg(first).select("key", "first.*")
    # Numbers follow the order of the lines, so they say which of two sets is the earlier one.
    sets = stage(sets.orderBy(*PLACE).withColumn("seq", F.monotonically_increasing_id()), "line-sets")

    meetings, gone, candidates = Meetings(sets, num, den), None, []
    if meetings.crowds is not None:
        other = (F.col("l.seq") != F.col("r.seq")) & can_link(num, den)
        rounds, leads = meetings.rounds(meetings.split_rows), []
        for i in rounds:
            crowded = meetings.crowded(i, rounds)
            lead = crowded.groupBy("k").agg(F.min("seq").alias("seq"), F.count("*").alias("c")).where(F.col("c") > CROWD)
            lead = crowded.join(lead.select("k", "seq"), ["k", "seq"], "left_semi")
            leads.append(stage(met(crowded, lead, other).groupBy("b").agg(F.min("a").alias("a")), "led"))
        first = stage(union(leads).groupBy("b").agg(F.min("a").alias("a")), "candidates")
        gone = verified(first, lines_of(first, sets, texts), num, den)
    rounds = meetings.rounds(meetings.rows)
    for i in rounds:
        plain = meetings.plain(i, rounds)
        pairs = met(plain, plain, (F.col("l.seq") < F.col("r.seq")) & can_link(num, den))
        if gone is not None:
            crowded = meetings.crowded(i, rounds)
            pairs = pairs.union(met(crowded, crowded.join(gone.toDF("seq"), "seq", "left_anti"), other))
        candidates.append(stage(pairs.distinct(), "met" if len(rounds) > 1 else "candidates"))
    pairs = stage(union(candidates).distinct(), "candidates") if len(candidates) > 1 else candidates[0]
    best = stage(pairs.groupBy("b").agg(F.min("a").alias("a"), F.count("*").alias("c")), "first-candidates")
    of_pairs = lines_of(pairs, sets, texts)
    like = verified(best, of_pairs, num, den)
    untold = best.where("c > 1").join(like, "b", "left_anti").select("b", F.col("a").alias("tried"))
    like = like.union(verified(pairs.join(untold, "b").where(F.col("a") != F.col("tried")), of_pairs, num, den))
    like = (like if gone is None else like.union(gone)).distinct().select(F.col("b").alias("seq"), F.lit(True).alias("like"))

    fate = sets.select("seq", "key", F.col("row").alias("first_row"), F.col("no").alias("first_no")).join(like, "seq", "left").drop("seq")
    each = lines.select("row", "id", "no", "key", "n").join(fate, "key", "left")
    lost = (F.col("n") > 0) & (F.col("like").isNotNull() | (F.col("row") != F.col("first_row")) | (F.col("no") != F.col("first_no")))
    out = each.groupBy("row").agg(F.first("id").alias("id"), F.count_if(F.col("n") > 0).alias("n_lines"), F.array_sort(F.collect_list(F.when(lost, F.col("no")))).alias("removed"))
    return out.select(F.col("id").alias(id_col), "n_lines", F.size("removed").cast("long").alias("n_removed"), "removed")


def without_lines(text: Column, removed: Column) -> Column:
    """The text without the lines of these numbers."""
    lines = F.transform(F.split(text, "\n"), lambda line, i: F.struct(i.alias("no"), line.alias("line")))
    return F.array_join(F.transform(F.filter(lines, lambda x: ~F.array_contains(removed, x["no"])), lambda x: x["line"]), "\n")
