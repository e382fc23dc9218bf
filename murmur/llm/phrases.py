"""Operator 12: collocations, from Rabin-Karp fingerprints of all runs of words.

Prefix polynomials over a text's bytes give the fingerprint of every word, and prefix
polynomials over those the fingerprint of every phrase. Only fingerprints with their counts
are shuffled. A phrase is no more frequent than its parts, so a pass over the texts takes
only phrases whose parts the pass before found frequent: single words, pairs, then three
and four words. What was found travels to the tasks as a bit filter of bounded size, which
lets some phrases too many through but loses none.

A last pass makes texts of frequent phrases only: in each run of words, every occurrence of
a fingerprint is compared with the text of the first one, which a pointer tells, so unequal
phrases part there; then counts are added up by text. So no collision of fingerprints
reaches a result.

Defined results: a null text has no words; a null language is ``und``; repeated rows count
again; texts of any length are taken in blocks that overlap by the words a phrase needs;
an empty table has no phrases.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from murmur.llm import rolling
from murmur.llm.frames import small_batches, texts_of
from murmur.session import materialize, materialize_measured

UNKNOWN = "und"
LEAST, LONGEST, TOP = 30, 4, 2000
#: Per cent of a phrase's count at which a longer phrase that holds it stands for it.
SHARE = 80
#: Bytes whose words are found at once, and words that are counted at once.
CHUNK, RUN = 1 << 20, 1 << 19
#: Of the filters: bits for each element, at most, in a block, set for an element.
PER_ELEMENT, MOST, BLOCK, PROBES = 16, 1 << 28, 1 << 15, 3
#: Parts in which the first phrases of a language are sought before they meet.
PARTS = 64
WORD, BLANK, BREAK = range(3)
_KIND = np.zeros(256, np.uint8)
_KIND[[9, 32]] = BLANK
_KIND[[10, 11, 12, 13, *b".,;:!?"]] = BREAK
_SEPARATOR = re.compile(rb"[ \t.,;:!?\n-\r]")
_AHEAD = re.compile(rb"(?:[ \t]*[^ \t.,;:!?\n-\r]+){0,%d}" % (LONGEST - 1))


@dataclass
class Filter:
    """A Bloom filter of fingerprints."""

    bits: np.ndarray  # bytes, a power of two of bits

    def has(self, fingerprints: np.ndarray) -> np.ndarray:
        out = np.ones(len(fingerprints), bool)
        for place in places(fingerprints, 8 * len(self.bits)):
            out &= self.bits[place >> 3] >> (place & 7).astype(np.uint8) & 1 == 1
        return out


def places(fingerprints: np.ndarray, size: int) -> Iterator[np.ndarray]:
    """The places of fingerprints in a filter of ``size`` bits."""
    step = (fingerprints >> np.uint64(32)) | np.uint64(1)
    for k in range(PROBES):
        yield ((fingerprints + np.uint64(k) * step) * np.uint64(rolling.BASE) >> np.uint64(64 - (size - 1).bit_length())).astype(np.int64)


def filter_of(frequent: DataFrame, count: int) -> Filter:
    """A filter of ``frequent`` (fingerprint), whose blocks are made apart; it has at most
    ``MOST`` bits however many there are."""
    size = min(MOST, max(BLOCK, 1 << (max(1, count) * PER_ELEMENT - 1).bit_length()))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = batch.column("fingerprint").to_numpy(zero_copy_only=False).view(np.uint64)
            at = np.unique(np.concatenate(list(places(own, size)))) if len(own) else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(at // BLOCK), pa.array(at % BLOCK)], ["block", "bit"])

    def fill(group: pa.Table) -> pa.Table:
        made = np.zeros(BLOCK, np.uint8)
        made[group.column("bit").to_numpy()] = 1
        return pa.table({"block": group.column("block")[:1], "bits": pa.array([np.packbits(made, bitorder="little").tobytes()], pa.binary())})

    set_ = frequent.select("fingerprint").mapInArrow(place, "block long, bit long").distinct()
    blocks = set_.groupBy("block").applyInArrow(fill, "block long, bits binary").toArrow()
    bits = np.zeros((size // BLOCK, BLOCK // 8), np.uint8)
    for block, made in zip(blocks.column("block").to_pylist(), blocks.column("bits").to_pylist()):
        bits[block] = np.frombuffer(made, np.uint8)
    return Filter(bits.ravel())


def blocks_of(data: bytes) -> Iterator[tuple[bytes, int]]:
    """(bytes, length of those that are its own) of blocks of a text: what follows is there
    for the phrases that begin in the block."""
    start = 0
    while start < len(data):
        if len(data) - start <= CHUNK:
            yield data[start:], len(data) - start
            return
        cut = _SEPARATOR.search(data, start + CHUNK)
        end = cut.start() if cut else len(data)
        yield data[start : _AHEAD.match(data, end).end()], end - start
        start = end


@dataclass
class Words:
    """The words of several texts, one after the other."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    piece: np.ndarray
    own: np.ndarray  # whether phrases that begin here are counted here
    lang: np.ndarray  # hash of the language
    name: np.ndarray  # number of the language among ``langs``
    hash: np.ndarray

    def grams(self, n: int, which: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(first words, fingerprints) of all phrases of n words, or those of ``which`` beginnings."""
        at = np.arange(len(self.start) - n + 1) if which is None else np.flatnonzero(which[: max(0, len(self.start) - n + 1)])
        at = at[self.piece[at] == self.piece[at + n - 1]]
        return at, rolling.mixed(rolling.runs(self.prefix, at, at + n) * np.uint64(2 * n + 1) ^ self.lang[at])

    @property
    def prefix(self) -> np.ndarray:
        if not hasattr(self, "_prefix"):
            self._prefix = rolling.prefixes(self.hash)
        return self._prefix


def word_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    out = np.zeros(len(start), np.uint64)
    # In stretches, so that powers stay few.
    i = 0
    while i < len(start):
        j = max(i + 1, int(np.searchsorted(end, start[i] + CHUNK)))
        first, last = int(start[i]), int(end[j - 1])
        prefix = rolling.prefixes(data[first:last].astype(np.uint64) + np.uint64(1))
        out[i:j] = rolling.mixed(rolling.runs(prefix, start[i:j] - first, end[i:j] - first))
        i = j
    return out


def words_of(texts: list[tuple[bytes, int, int]], hashes: np.ndarray) -> Words:
    """The words of (bytes, own length, number of language) blocks."""
    # A break between two blocks keeps their words apart.
    data = np.frombuffer(b"\n".join([t for t, _, _ in texts]) + b"\n", np.uint8)
    sizes = np.array([len(t) + 1 for t, _, _ in texts], np.int64)
    begin = np.cumsum(sizes) - sizes
    kind = _KIND[data]
    inside = kind == WORD
    edge = np.diff(inside.view(np.int8), prepend=np.int8(0))
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    piece = np.cumsum(kind == BREAK)[start]
    block = np.searchsorted(begin, start, "right") - 1
    own = start - begin[block] < np.array([n for _, n, _ in texts], np.int64)[block]
    name = np.array([k for _, _, k in texts], np.int64)[block]
    return Words(data, start, end, piece, own, hashes[name], name, word_hashes(data, start, end))


def runs_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[Words, list[str]]]:
    """(words, names of languages) of (text, lang) rows, in runs of bounded length."""
    held: list[tuple[bytes, int, int]] = []
    names: dict[str, int] = {}
    size = 0

    def made() -> tuple[Words, list[str]]:
        langs = list(names)
        return words_of(held, np.array([xxhash.xxh64_intdigest(x, 12) for x in langs], np.uint64)), langs

    for batch in batches:
        langs = batch.column("lang").to_pylist()
        for text, lang in zip(texts_of(batch.column("text")), langs):
            k = names.setdefault(lang, len(names))
            for data, own in blocks_of(text.encode().lower()):
                held.append((data, own, k))
                size += len(data)
                if size >= 6 * RUN:
                    yield made()
                    held, names, size = [], {}, 0
                    k = names.setdefault(lang, 0)
    if held:
        yield made()


def known_parts(words: Words, filters: list[Filter]) -> list[np.ndarray]:
    """For each length that has a filter, which words begin a phrase that it and those of
    its parts let through; one longer than the words."""
    out: list[np.ndarray] = []
    for size, known in enumerate(filters, 1):
        at, fingerprints = words.grams(size, out[-1][:-1] & out[-1][1:] if out else None)
        has = np.zeros(len(words.start) + 1, bool)
        has[at] = known.has(fingerprints)
        out.append(has)
    return out


def may_begin(words: Words, parts: list[np.ndarray], n: int) -> np.ndarray:
    """Which words begin a phrase of n words that is counted here and whose parts are known."""
    may = words.own.copy()
    size = min(n - 1, len(parts))
    for k in range(n - size + 1 if size else 0):
        may &= np.append(parts[size - 1][k:-1], np.zeros(k, bool))[: len(may)]
    return may


def counted(texts: DataFrame, sizes: list[int], filters: list[Filter], least: int) -> tuple[DataFrame, int]:
    """((fingerprint), how many) of the phrases of ``sizes`` words that may occur ``least``
    times: counts are added up by fingerprint."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for words, _ in runs_of(batches):
            parts = known_parts(words, filters)
            for n in sizes:
                at, fingerprints = words.grams(n, may_begin(words, parts, n))
                made, count = np.unique(fingerprints, return_counts=True)
                for i in range(0, len(made), 1 << 16):
                    part = slice(i, i + (1 << 16))
                    yield pa.RecordBatch.from_arrays([pa.array(made[part].view(np.int64)), pa.array(count[part])], ["fingerprint", "n"])

    rows = texts.mapInArrow(run, "fingerprint long, n long")
    found = rows.groupBy("fingerprint").agg(F.sum("n").alias("n")).filter(F.col("n") >= least).select("fingerprint")
    stored, seen = materialize_measured(found, n=F.count(F.lit(1)))
    return stored, seen["n"] or 0


def exact_numbers(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """(number of each word, a place of each number): equal numbers are equal bytes."""
    _, first, number = np.unique(words.hash, return_index=True, return_inverse=True)
    length = words.end - words.start
    same = length == length[first][number]
    # Compare the bytes of all words with those of the first of their hash, in stretches.
    for i in range(0, len(number), 1 << 17):
        part = slice(i, i + (1 << 17))
        sizes = np.where(same[part], length[part], 0)
        ends = np.cumsum(sizes)
        step = np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - sizes, sizes)
        own = words.data[np.repeat(words.start[part], sizes) + step]
        other = words.data[np.repeat(words.start[first[number[part]]], sizes) + step]
        wrong = np.repeat(np.arange(len(sizes)), sizes)[own != other]
        same[i + wrong] = False
    further: dict[bytes, int] = {}
    at = []
    for i in np.flatnonzero(~same).tolist():
        word = words.data[words.start[i] : words.end[i]].tobytes()
        if word not in further:
            further[word] = len(first) + len(at)
            at.append(i)
        number[i] = further[word]
    return number, np.append(first, np.array(at, np.int64))


def verified(numbers: np.ndarray, names: np.ndarray, at: np.ndarray, fingerprints: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(pointers to the first occurrence, counts) of unequal phrases of n words: occurrences
    of one fingerprint are compared with the first of them, words and language."""
    _, first, group, count = np.unique(fingerprints, return_index=True, return_inverse=True, return_counts=True)
    same = names[at] == names[at[first][group]]
    for k in range(n):
        same &= numbers[at + k] == numbers[at[first][group] + k]
    further: dict[tuple[int, ...], list[int]] = {}
    for i in np.flatnonzero(~same).tolist():
        count[group[i]] -= 1
        further.setdefault((int(names[at[i]]), *numbers[at[i] : at[i] + n].tolist()), []).append(int(at[i]))
    pointers = np.append(at[first], np.array([f[0] for f in further.values()], np.int64)).astype(np.int64)
    return pointers, np.append(count, np.array([len(f) for f in further.values()], np.int64)).astype(np.int64)


def phrase_counts(texts: DataFrame, filters: list[Filter], least: int) -> DataFrame:
    """(lang, phrase, f) of all phrases that occur ``least`` times, and with a null phrase
    the number of words of each language."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for words, langs in runs_of(batches):
            total = np.bincount(words.name[words.own], minlength=len(langs))
            yield rows(langs, [None] * len(langs), total)
            numbers, example = exact_numbers(words)
            raw = words.data.tobytes()
            shown: dict[int, str] = {}

            def text(number: int) -> str:
                made = shown.get(number)
                if made is None:
                    i = example[number]
                    made = shown[number] = raw[words.start[i] : words.end[i]].decode()
                return made

            for n, known in enumerate(known_parts(words, filters), 1):
                at, fingerprints = words.grams(n, words.own & known[:-1])
                pointers, counts = verified(numbers, words.name, at, fingerprints, n)
                for i in range(0, len(pointers), 1 << 16):
                    first, count = pointers[i : i + (1 << 16)], counts[i : i + (1 << 16)]
                    said = [map(text, numbers[first + k].tolist()) for k in range(n)]
                    yield rows([langs[k] for k in words.name[first].tolist()], list(map(" ".join, zip(*said))), count)

    def rows(langs: list[str], phrases: list[str | None], counts: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(phrases, pa.string()), pa.array(counts, pa.int64())], ["lang", "phrase", "f"])

    made = texts.mapInArrow(run, "lang string, phrase string, f long").groupBy("lang", "phrase").agg(F.sum("f").alias("f"))
    return materialize(made.filter(F.col("phrase").isNull() | (F.col("f") >= least)))


def _big(c: str | Column) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("decimal(20,0)")


def scored(counts: DataFrame) -> DataFrame:
    """(lang, phrase, a, l, r, score) of phrases of several words, with their lowest-scoring cut."""
    grams = counts.filter(F.col("phrase").isNotNull())
    words = F.split("phrase", " ", -1)
    several = grams.select("lang", "phrase", F.col("f").alias("a"), words.alias("words")).filter(F.size("words") > 1)
    cuts = several.select("lang", "phrase", "a", "words", F.explode(F.sequence(F.lit(1), F.size("words") - 1)).alias("k"))
    cuts = cuts.select(
        "lang", "phrase", "a", "k",
        F.array_join(F.slice("words", F.lit(1), F.col("k")), " ").alias("first"),
        F.array_join(F.slice("words", F.col("k") + 1, F.size("words") - F.col("k")), " ").alias("rest"),
    )
    part = lambda phrase, f: grams.select("lang", F.col("phrase").alias(phrase), F.col("f").alias(f))
    cuts = cuts.join(part("first", "l"), ["lang", "first"]).join(part("rest", "r"), ["lang", "rest"])
    # Decimals hold products beyond 64 bits; a score is at most 1,000,000.
    cuts = cuts.withColumn("score", F.expr("CAST(2000000 AS DECIMAL(10,0)) * CAST(a AS DECIMAL(20,0)) div (CAST(l AS DECIMAL(20,0)) + CAST(r AS DECIMAL(20,0)))"))
    lowest = cuts.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    return lowest.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")


def standing(found: DataFrame, share: int) -> DataFrame:
    """``found`` without phrases that a longer one stands for: it holds their words one after
    the other and has ``share`` per cent of their count at least."""
    words = F.split("phrase", " ", -1)
    longer = found.select("lang", "a", words.alias("words")).filter(F.size("words") > 2)
    held = F.flatten(F.transform(
        F.sequence(F.lit(2), F.size("words") - 1),
        lambda m: F.transform(F.sequence(F.lit(1), F.size("words") - m + 1), lambda i: F.array_join(F.slice("words", i, m), " ")),
    ))
    most = longer.select("lang", "a", F.explode(F.array_distinct(held)).alias("phrase")).groupBy("lang", "phrase").agg(F.max("a").alias("most"))
    joined = found.join(most, ["lang", "phrase"], "left")
    stands = F.col("most").isNull() | (F.lit(100).cast("decimal(10,0)") * _big("most") < F.lit(share).cast("decimal(10,0)") * _big("a"))
    return joined.filter(stands).drop("most")


def collocations(
    docs: DataFrame, text: str = "text", lang: str = "lang", least: int = LEAST, share: int = SHARE, top: int = TOP
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the first ``top`` phrases of each language."""
    texts = small_batches(docs).select(F.col(text).alias("text"), F.coalesce(F.col(lang).cast("string"), F.lit(UNKNOWN)).alias("lang"))
    filters: list[Filter] = []
    for sizes in ([1], [2], [3, 4]):
        found, count = counted(texts, sizes, filters, least)
        filters += [filter_of(found, count)] * len(sizes)
    counts = phrase_counts(texts, filters, least)
    kept = standing(materialize(scored(counts)), share)
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # First in parts of a language, so that no task holds all of one.
    part = F.pmod(F.xxhash64("phrase"), F.lit(PARTS))
    some = kept.withColumn("_rank", F.row_number().over(Window.partitionBy("lang", part).orderBy(*order))).filter(F.col("_rank") <= top)
    ranked = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).filter(F.col("rank") <= top)
    totals = counts.filter(F.col("phrase").isNull()).select("lang", F.col("f").alias("n"))
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
