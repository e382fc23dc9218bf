"""Operator 13: spelling variants, by a trie that is a table.

Words are counted in a pass over whole texts. A trie of them is an edge table: a node is a
beginning of words, and each edge adds a letter and tells whether a word ends there and
which letters follow. States (word, position, node, edits) walk it level by level, each
level one join of all states with the edges of its depth. A state without an edit follows
its own word, so it needs no walk: it is there at every depth. With its one edit it takes
another letter's edge in place of its own letter, or any edge in addition; after that it
has to follow its own letters, and a state that ends with its word at a word's end has found
a neighbour. What an inserted letter finds is told both ways, so none is deleted.

An edit lies in a word's latter half, or in the latter half of the reversed word. So there
is a trie of words and one of reversed words, and states take their edit in the latter half
only, where nodes have few edges. An edge's following letters stop most states at once.

Words beyond ``DEEP`` letters, which would need as many levels, take fingerprints with one
letter left out instead: those of a word follow from prefix polynomials, in time linear in
its length, pairs with equal ones are compared as texts.

Defined results: a null text has no words; a null key reads as ``null`` in the hash; equal
rows count again; words of any length are taken whole; without words there are no rows.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from murmur.llm import rolling
from murmur.llm.frames import small_batches, texts_of
from murmur.session import materialize, materialize_measured

RUN = re.compile("[a-zÀ-ÿ]+")
#: One run in so many, by its hash, loses a letter.
THINNED = 97
SHORTEST, LEAST = 5, 3
#: A word's form has so many times its count at least.
TIMES = 2
#: Letters of the longest word that walks the trie; distinct words that a task counts at once.
DEEP, HELD = 32, 1 << 19
#: Letters a to z are bits 0 to 25 of an edge's following letters, the others bits 26 on.
LETTERS = 26


def words_of(text: str, key: str) -> Counter[str]:
    """The words of a text with their counts; some lose a letter, by their hash with the key."""
    out: Counter[str] = Counter()
    begun = zlib.crc32(f"{key}:".encode())
    for run, n in Counter(RUN.findall(text.encode().lower().decode())).items():
        hashed = zlib.crc32(run.encode(), begun)
        if hashed % THINNED == 0:
            at = hashed % len(run)
            run = run[:at] + run[at + 1 :]
        out[run] += n
    return out


def word_counts(docs: DataFrame, key: str = "doc_id", text: str = "text", least: int = LEAST) -> DataFrame:
    """(word, n) of the words with ``SHORTEST`` letters and ``least`` occurrences at least."""

    def rows(counts: Counter[str]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())], ["word", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[str] = Counter()
        for batch in batches:
            for t, k in zip(texts_of(batch.column("text")), batch.column("key").to_pylist()):
                for word, n in words_of(t, "null" if k is None else k).items():
                    if len(word) >= SHORTEST:
                        counts[word] += n
            if len(counts) >= HELD:
                yield rows(counts)
                counts = Counter()
        yield rows(counts)

    texts = small_batches(docs).select(F.col(key).cast("string").alias("key"), F.col(text).alias("text"))
    return texts.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least)


def letter_bit(letter: Column) -> Column:
    """The number of a letter, of which two longs hold 62 and 28; below 0 for none."""
    code = F.ascii(letter)
    return F.when(code < 192, code - 97).otherwise(code - 192 + LETTERS)


def _bit(number: Column, first: int) -> Column:
    """A long with the bit of a letter, if it is one of the 62 from ``first`` on."""
    at = number - first
    return F.when((at >= 0) & (at < 62), F.call_function("shiftleft", F.lit(1).cast("long"), at)).otherwise(F.lit(0).cast("long"))


def _follows(number: Column) -> Column:
    """Whether an edge's following letters have one."""
    of = lambda c, at: F.call_function("shiftright", F.col(c), at).bitwiseAND(F.lit(1).cast("long")) == 1
    return F.when(number < 62, of("low", number)).otherwise(of("high", number - 62))


def both_ways(words: DataFrame) -> DataFrame:
    """(back, s, m): words and their reverses with their lengths."""
    one = lambda back, s: words.select(F.lit(back).alias("back"), s.alias("s"), F.length("word").alias("m"))
    return one(False, F.col("word")).union(one(True, F.reverse("word")))


def half(back: Column, m: Column) -> Column:
    """The first place at which a word takes its edit."""
    return F.when(back, m - F.floor(m / 2)).otherwise(F.floor(m / 2)).cast("int")


def edges_of(sided: DataFrame) -> DataFrame:
    """(depth, node2, back2, place, letter, number, ends, low, high): the tries' edges below
    the first two levels, which no edit reaches. ``place`` is a hash of the node, which the
    join sorts by."""
    steps = sided.select("back", "s", "m", F.explode(F.sequence(F.lit(SHORTEST // 2), F.col("m") - 1)).alias("depth"))
    after = letter_bit(F.substring("s", F.col("depth") + 2, F.lit(1)))
    edges = steps.select(
        F.substring("s", F.lit(1), F.col("depth") + 1).alias("child"),
        "back",
        (F.col("m") == F.col("depth") + 1).alias("ends"),
        _bit(after, 0).alias("low"),
        _bit(after, 62).alias("high"),
    )
    made = edges.groupBy("child", "back").agg(F.max("ends").alias("ends"), F.bit_or("low").alias("low"), F.bit_or("high").alias("high"))
    depth = F.length("child") - 1
    node, letter = F.substring("child", F.lit(1), depth), F.substring("child", depth + 1, F.lit(1))
    return made.select(
        depth.alias("depth"), node.alias("node2"), F.col("back").alias("back2"), F.xxhash64(node, "back").alias("place"),
        letter.alias("letter"), letter_bit(letter).alias("number"), "ends", "low", "high",
    ).sortWithinPartitions("depth")


def level(sided: DataFrame, edges: DataFrame, states: DataFrame | None, depth: int) -> DataFrame:
    """(back, s, m, pos, node, found): the states behind the edges of one depth."""
    fresh = sided.filter((F.col("m") >= depth) & (half(F.col("back"), F.col("m")) <= depth)).select(
        "back", "s", "m", F.lit(depth).alias("pos"), F.substring("s", 1, depth).alias("node"), F.lit(0).alias("edits")
    )
    if states is not None:
        fresh = fresh.union(states.filter(~F.col("found")).select("back", "s", "m", "pos", "node", F.lit(1).alias("edits")))
    letter_at = lambda place: letter_bit(F.substring("s", place + 1, F.lit(1)))
    fresh = fresh.withColumns({"place": F.xxhash64("node", "back"), "own": letter_at(F.col("pos")), "next": letter_at(F.col("pos") + 1)})
    pos, m, fresh_ = F.col("pos"), F.col("m"), F.col("edits") == 0
    # Its own letter after the edit or another in its place, or one more letter before it.
    step = (pos < m) & ((F.col("number") == F.col("own")) != fresh_) & F.when(pos + 1 == m, F.col("ends")).otherwise(_follows(F.col("next")))
    more = fresh_ & F.when(pos == m, F.col("ends")).otherwise(_follows(F.col("own")))
    # Nodes are compared behind the hash, so that it alone is sorted by.
    same = F.when((F.col("node") == F.col("node2")) & (F.col("back") == F.col("back2")), step | more).otherwise(F.lit(False))
    here = edges.filter(F.col("depth") == depth).withColumnRenamed("place", "place2")
    both = fresh.join(here, (F.col("place") == F.col("place2")) & same)
    moves = [F.when(takes, F.struct(to.alias("pos"), (to == m).alias("found"))) for takes, to in ((step, pos + 1), (more, pos))]
    moved = both.select("back", "s", "m", F.concat("node", "letter").alias("node"), F.explode(F.array_compact(F.array(*moves))).alias("to"))
    return moved.select("back", "s", "m", "to.pos", "node", "to.found")


def walked(words: DataFrame, longest: int) -> DataFrame:
    """(word, near): neighbours among words of ``DEEP`` letters at most, each pair at least one way."""
    sided = materialize(both_ways(words.filter(F.length("word") <= DEEP)))
    edges = materialize(edges_of(sided))
    states, found = None, []
    for depth in range(SHORTEST // 2, max(SHORTEST // 2, min(longest, DEEP)) + 1):
        states = materialize(level(sided, edges, states, depth))
        found.append(states.filter("found"))
    every = found[0]
    for more in found[1:]:
        every = every.union(more)
    turned = lambda c: F.when(F.col("back"), F.reverse(c)).otherwise(F.col(c))
    return every.select(turned("s").alias("word"), turned("node").alias("near"))


def deep_pairs(words: DataFrame) -> DataFrame:
    """(word, near): neighbours of which one has more than ``DEEP`` letters, each pair one way."""
    long = words.filter(F.length("word") >= DEEP).select(F.xxhash64("word").alias("id"), "word")
    long = materialize(long)

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, word in zip(batch.column("id").to_pylist(), batch.column("word").to_pylist()):
                letters = np.frombuffer(word.encode("utf-32-le"), "<u4").astype(np.uint64)
                m = len(letters)
                prefix = rolling.prefixes(letters)
                # What is behind the letter left out moves one place down.
                down = rolling.powers(2)[1][1]
                left_out = prefix[:-1] + (prefix[-1] - prefix[1:]) * down
                for i in range(0, m, 1 << 16):
                    some = left_out[i : i + (1 << 16)]
                    at = np.arange(i, i + len(some))
                    yield rows(key, m, at, some)
                yield rows(key, m, np.array([-1]), prefix[-1:])

    def rows(key: int, m: int, at: np.ndarray, made: np.ndarray) -> pa.RecordBatch:
        n = len(at)
        columns = [np.full(n, key), np.full(n, m), at, rolling.mixed(made).view(np.int64)]
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["id", "m", "at", "print"])

    prints = materialize(long.select("id", "word").mapInArrow(emit, "id long, m long, at long, print long"))
    own = prints.filter("at >= 0")
    # Words that are equal but for one place differ there, so no more than the alphabet meet.
    same = own.select(F.col("id").alias("id2"), "m", "at", "print")
    replaced = own.filter(F.col("m") > DEEP).join(same, ["m", "at", "print"]).filter("id < id2")
    whole = prints.filter("at < 0").select(F.col("id").alias("id2"), (F.col("m") + 1).alias("m"), "print")
    added = own.join(whole, ["m", "print"])
    met = replaced.select("id", "id2", "at", F.lit(False).alias("whole")).union(added.select("id", "id2", "at", F.lit(True)))
    texts = lambda i, w: long.select(F.col("id").alias(i), F.col("word").alias(w))
    pairs = met.join(texts("id", "word"), "id").join(texts("id2", "near"), "id2")
    without = lambda w: F.concat(F.substring(w, F.lit(1), F.col("at").cast("int")), F.substring(w, F.col("at").cast("int") + 2, F.length(w)))
    right = (F.col("word") != F.col("near")) & (without("word") == F.when(F.col("whole"), F.col("near")).otherwise(without("near")))
    return pairs.filter(right).select("word", "near")


def near_words(words: DataFrame, longest: int) -> DataFrame:
    """(word, near): all words that differ by exactly one letter, both ways and once."""
    found = walked(words, longest)
    if longest > DEEP:
        found = found.union(deep_pairs(words))
    return found.union(found.select(F.col("near").alias("word"), F.col("word").alias("near"))).distinct()


def roots_of(forms: DataFrame) -> DataFrame:
    """(word, root) from (word, form): the last of the forms that follow each other.

    A form is more frequent than its word, so there are no rings, and every round doubles
    the steps that are taken at once.
    """
    links, left = materialize(forms.select("word", F.col("form").alias("root"))), 1
    while left:
        further = links.select(F.col("word").alias("root"), F.col("root").alias("further"))
        moved = links.join(further, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved"))
        links, seen = materialize_measured(moved, left=F.sum(F.col("moved").cast("int")))
        left, links = seen["left"] or 0, links.select("word", "root")
    return links


def spelling_variants(docs: DataFrame, key: str = "doc_id", text: str = "text", least: int = LEAST, times: int = TIMES) -> DataFrame:
    """(word, form, root, n, n_near, form_n): words, their most frequent neighbour if it has
    ``times`` their count, and where forms lead to."""
    words, seen = materialize_measured(word_counts(docs, key, text, least), longest=F.max(F.length("word")))
    near = near_words(words, seen["longest"] or 0)
    counted = near.join(words.select(F.col("word").alias("near"), F.col("n").alias("near_n")), "near")
    best = counted.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best"))
    formed = F.col("best.less") <= -F.lit(times) * F.col("n")
    told = materialize(words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(formed, F.col("best.near")).alias("form"), F.when(formed, -F.col("best.less")).alias("form_n"),
    ))
    roots = roots_of(told.filter("form IS NOT NULL"))
    return told.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
