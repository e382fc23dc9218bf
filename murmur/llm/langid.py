"""Operator 8: language identification by the nearest of several centroids per language.

A text is a vector of hashed character n-grams (letters in lower case, all else one
blank), its counts damped by a logarithm and weighted by inverse document frequency, of
length 1. Each language has a few centroids, clustered by cosine. A text takes the
language of the centroid that is nearest by cosine, and is rejected if it is farther from
it than texts of its length ever are in training, with a margin.

The classifier is fitted on a bounded sample: ``SAMPLE`` texts of a language and
``TOTAL`` of all in expectation, chosen by a hash of their key, as vectors of at most ``BINS`` numbers.
Prediction is a narrow pass over whole texts.

Defined results: a text that is null or has no letter is ``und`` with score 0 and is
rejected, and so is every text if there is nothing to learn from; rows without a key or
language are not learnt from; repeated rows are predicted each for itself.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from murmur.llm.bpe import LETTER, _classes
from murmur.llm.frames import by_size, ranges, small_batches, texts_of

BINS = 1 << 12
SIZES = (2, 3)
SAMPLE = 800
#: Texts of all languages together, in expectation.
TOTAL = 4000
CENTROIDS = 4
ROUNDS = 12
#: A text is rejected below this share of the least similarity seen at its length.
MARGIN = 0.5
UNKNOWN = "und"
SLICE = 1 << 20
_FACTORS = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D], np.uint32)


def counts_of(texts: list[str]) -> np.ndarray:
    """(texts, BINS): how often each hashed n-gram occurs."""
    out = np.zeros((len(texts), BINS), np.int64)
    pieces = [(i, t[a : a + SLICE + 2]) for i, t in enumerate(texts) for a in range(0, len(t), SLICE)]
    for run in by_size([len(p) for _, p in pieces], SLICE):
        own = pieces[run]
        lowered = [f" {p.lower()} " for _, p in own]
        points = np.frombuffer("".join(lowered).encode("utf-32-le", "surrogatepass"), "<u4")
        owner = np.repeat(np.array([i for i, _ in own], np.int64), [len(p) for p in lowered])
        letter = _classes()[points] == LETTER
        # One blank for each run of other signs; a text's first sign is always there.
        kept = letter | np.append(True, letter[:-1])
        sizes = np.array([len(p) for p in lowered], np.int64)
        kept[np.cumsum(sizes) - sizes] = True
        signs, owner = np.where(letter, points, 32)[kept].astype(np.uint32), owner[kept]
        lowest = int(owner[0]) if len(owner) else 0
        width = int(owner[-1]) - lowest + 1 if len(owner) else 0
        for n in SIZES:
            m = len(signs) - n + 1
            if m <= 0:
                continue
            hashed = np.full(m, n, np.uint32)
            for k in range(n):
                hashed = hashed * _FACTORS[1] + signs[k : k + m] * _FACTORS[k]
            hashed ^= hashed >> np.uint32(15)
            bins = (hashed * _FACTORS[2]) >> np.uint32(32 - BINS.bit_length() + 1)
            same = owner[:m] == owner[n - 1 :]
            at = (owner[:m] - lowest)[same] * BINS + bins[same]
            out[lowest : lowest + width] += np.bincount(at, minlength=width * BINS).reshape(width, BINS)
    return out


def unit(rows: np.ndarray) -> np.ndarray:
    length = np.linalg.norm(rows, axis=1, keepdims=True)
    return rows / np.where(length > 0, length, 1)


@dataclass
class Centroids:
    languages: list[str]
    owner: np.ndarray  # of each centroid, its language
    centres: np.ndarray
    weight: np.ndarray  # inverse document frequency
    least: np.ndarray  # least accepted similarity by the binary logarithm of the number of n-grams

    def vectors(self, counts: np.ndarray) -> np.ndarray:
        return unit(np.log1p(counts.astype(np.float32)) * self.weight)

    def predict(self, texts: list[str]) -> list[tuple[str, float, bool]]:
        if not self.languages:
            return [(UNKNOWN, 0.0, False)] * len(texts)
        counts = counts_of(texts)
        likeness = self.vectors(counts) @ self.centres.T
        best = likeness.argmax(1)
        grams = counts.sum(1)
        size = np.minimum(np.log2(np.maximum(grams, 1)).astype(int), len(self.least) - 1)
        out = []
        for text, b, s, n, row in zip(texts, best.tolist(), size.tolist(), grams.tolist(), likeness):
            if not n or not any(c.isalpha() for c in text):
                out.append((UNKNOWN, 0.0, False))
            else:
                score = float(min(1.0, max(0.0, row[b])))
                out.append((self.languages[self.owner[b]], score, score >= self.least[s]))
        return out


def _cluster(rows: np.ndarray, k: int, seed: int) -> np.ndarray:
    """Spherical k-means, begun far apart."""
    rng = np.random.default_rng(seed)
    centres = rows[[int(rng.integers(len(rows)))]]
    while len(centres) < min(k, len(rows)):
        # Not the farthest, which is often an odd text, but one of the farthest.
        nearest = (rows @ centres.T).max(1)
        centres = np.vstack([centres, rows[[np.argsort(nearest, kind="stable")[len(rows) // 20]]]])
    for _ in range(ROUNDS):
        to = (rows @ centres.T).argmax(1)
        sums = np.zeros_like(centres)
        np.add.at(sums, to, rows)
        full = np.bincount(to, minlength=len(centres)) > 0
        centres = unit(np.where(full[:, None], sums, centres))
    return centres


@dataclass
class Counts:
    """The counts of texts, only those above 0: row i has those of ``bounds[i]`` and on."""

    bounds: np.ndarray
    bins: np.ndarray
    counts: np.ndarray

    def __len__(self) -> int:
        return len(self.bounds) - 1

    def dense(self, rows: np.ndarray) -> np.ndarray:
        """(rows, BINS): the counts of some rows, which should be few."""
        sizes = self.bounds[rows + 1] - self.bounds[rows]
        at = ranges(self.bounds[rows], sizes)
        out = np.zeros((len(rows), BINS), np.int64)
        out[np.repeat(np.arange(len(rows)), sizes), self.bins[at]] = self.counts[at]
        return out


def fit(languages: list[str], counts: Counts) -> Centroids:
    """Centroids from the counts of labelled texts, of which one language at a time is held
    as whole vectors."""
    names = sorted(set(languages))
    if not names:
        return Centroids([], np.zeros(0, np.int64), np.zeros((0, BINS)), np.ones(BINS), np.zeros(1))
    label = np.array([names.index(x) for x in languages], np.int64)
    held = np.bincount(counts.bins, minlength=BINS)
    weight = (np.log((1 + len(counts)) / (1 + held)) + 1).astype(np.float32)
    model = Centroids(names, np.zeros(0, np.int64), np.zeros((0, BINS), np.float32), weight, np.zeros(1))

    def vectors(rows: np.ndarray) -> np.ndarray:
        out = np.zeros((len(rows), BINS), np.float32)
        for i in range(0, len(rows), 256):
            out[i : i + 256] = model.vectors(counts.dense(rows[i : i + 256]))
        return out

    centres = [_cluster(vectors(np.flatnonzero(label == i)), CENTROIDS, i) for i in range(len(names))]
    model.owner = np.repeat(np.arange(len(names)), [len(c) for c in centres])
    model.centres = np.vstack(centres).astype(np.float32)
    # What is usual at each length: whole texts, and thinned ones in place of short texts.
    rng = np.random.default_rng(0)
    seen: dict[int, list[float]] = {}
    for share in (1, 4, 16, 64, 256):
        for i in range(0, len(counts), 256):
            block = counts.dense(np.arange(i, min(i + 256, len(counts))))
            thin = block if share == 1 else rng.binomial(block, 1 / share)
            like = (model.vectors(thin) @ model.centres.T).max(1)
            for n, x in zip(thin.sum(1).tolist(), like.tolist()):
                if n:
                    seen.setdefault(int(np.log2(n)), []).append(x)
    top = max(seen, default=0)
    least = np.zeros(top + 1)
    for size in range(top + 1):
        if len(seen.get(size, [])) >= 20:
            least[size] = MARGIN * np.quantile(seen[size], 0.001)
        elif size:
            least[size] = least[size - 1]
    model.least = least
    return model


def remainder(key: str) -> Column:
    return F.pmod(F.crc32(F.col(key).cast("string")), F.lit(4))


def learn(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", sample: int = SAMPLE) -> Centroids:
    """A classifier from a bounded sample of ``docs``."""
    labelled = docs.filter(F.col(lang).isNotNull() & F.col(key).isNotNull())
    sizes = {r[lang]: r["n"] for r in labelled.groupBy(lang).agg(F.count("*").alias("n")).collect()}
    if not sizes:
        return fit([], Counts(np.zeros(1, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)))
    sample = min(sample, max(1, TOTAL // len(sizes)))
    span = 1 << 30
    share = F.create_map(*[F.lit(x) for lang_, n in sizes.items() for x in (lang_, min(span, span * sample // n))])
    chosen = labelled.filter(F.pmod(F.xxhash64(F.col(key), F.lit(8)), F.lit(span)) < share[F.col(lang)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in by_size([len(t) for t in texts_of(batch.column(text))], SLICE):
                counts = counts_of(texts_of(batch.column(text))[rows])
                i, b = np.nonzero(counts)
                bounds = np.searchsorted(i, np.arange(len(counts) + 1))
                offsets = pa.array(bounds, pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(key)[rows].cast(pa.string()), batch.column(lang)[rows],
                        pa.ListArray.from_arrays(offsets, pa.array(b, pa.int32())),
                        pa.ListArray.from_arrays(offsets, pa.array(counts[i, b].astype(np.int32))),
                    ],
                    ["key", "lang", "bins", "counts"],
                )

    found = small_batches(chosen).select(key, lang, text).mapInArrow(run, "key string, lang string, bins array<int>, counts array<int>")
    rows = found.toArrow().sort_by([("key", "ascending"), ("lang", "ascending")])
    rows = rows.filter(pc.greater(pc.list_value_length(rows.column("bins")), 0))
    names = rows.column("lang").to_pylist()
    bounds = np.append(0, np.cumsum(pc.list_value_length(rows.column("bins")).to_numpy(), dtype=np.int64))
    values = [pc.list_flatten(rows.column(c)).to_numpy() for c in ("bins", "counts")]
    del rows
    return fit(names, Counts(bounds, *values))


def identify(docs: DataFrame, model: Centroids, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, lang_pred, score, accepted) of every row, from the text alone."""
    schema = f"{key} {docs.schema[key].dataType.simpleString()}, lang_pred string, score double, accepted boolean"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = predictions(model, batch.column(text))
            added = [pa.array([x[k] for x in found], t) for k, t in enumerate((pa.string(), pa.float64(), pa.bool_()))]
            yield pa.RecordBatch.from_arrays([batch.column(key)] + added, [key, "lang_pred", "score", "accepted"])

    return small_batches(docs).select(key, text).mapInArrow(run, schema)


def predictions(model: Centroids, column: pa.Array) -> list[tuple[str, float, bool]]:
    texts = texts_of(column)
    return [x for rows in by_size([len(t) for t in texts], SLICE) for x in model.predict(texts[rows])]


def keep_accepted(docs: DataFrame, model: Centroids, text: str = "text") -> DataFrame:
    """``docs`` without those that the classifier rejects."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = pa.array([accepted for _, _, accepted in predictions(model, batch.column(text))], pa.bool_())
            yield batch.filter(kept)

    return small_batches(docs).mapInArrow(run, docs.schema)


def languages(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """(key, held_out, lang_pred, score, accepted) of every row; a quarter of the keys is
    held out from learning."""
    held = F.coalesce(remainder(key) == 2, F.lit(False))
    model = learn(docs.filter(~held), key, text, lang)
    found = identify(docs, model, key, text)
    return found.select(key, held.alias("held_out"), "lang_pred", "score", "accepted")
