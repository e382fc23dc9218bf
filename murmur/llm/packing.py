"""Operator 3: packing documents into fixed windows by minimum bin slack.

A document's ids, with an end id, are cut at multiples of the window; what is left over
is one piece below the window's length. Packing needs only how many pieces there are of
each length, a table of at most ``window`` rows whatever the corpus holds. From it the
driver draws patterns: a window takes the longest remaining length, and subset sums over
the remaining lengths, a bitset with as many copies of each as there are, say which sum
comes closest to what is still free; going back through the bitsets gives how many of
each length. A pattern is repeated as often as its scarcest length allows, so there are
about as many patterns as lengths. Pieces then take their places by their rank among
those of their length.

Defined results: null text is empty and has the end id alone; repeated rows are packed
each for itself; an empty table has no pieces. Pieces are not cut further to fill a
window, so the padding is the slack of the best subset.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window as W, functions as F

from murmur.llm.bpe import encode_column
from murmur.llm.frames import small_batches
from murmur.session import materialize

WINDOW = 2048
END_ID = 1


def best_subset(counts: dict[int, int], free: int) -> dict[int, int]:
    """How many of each length to take so that their sum comes closest to ``free``.

    Longer lengths come first, and the sums stop as soon as ``free`` itself is reached.
    """
    full = (1 << (free + 1)) - 1
    reach, steps = 1, []
    for length in sorted(counts, reverse=True):
        most, copies = min(counts[length], free // length), 1
        while most > 0 and not reach >> free & 1:
            take = min(copies, most)
            steps.append((length, take, reach))
            reach |= reach << (length * take) & full
            most, copies = most - take, 2 * copies
        if reach >> free & 1:
            break
    total, taken = reach.bit_length() - 1, {}
    for length, take, before in reversed(steps):
        if not before >> total & 1:
            total -= length * take
            taken[length] = taken.get(length, 0) + take
    return taken


def patterns(counts: dict[int, int], window: int = WINDOW) -> list[tuple[int, dict[int, int]]]:
    """(repeats, how many of each length) until no piece is left."""
    left = {length: n for length, n in counts.items() if n}
    out = []
    while left:
        longest = max(left)
        rest = left | {longest: left[longest] - 1}
        taken = best_subset({length: n for length, n in rest.items() if n}, window - longest)
        taken[longest] = taken.get(longest, 0) + 1
        repeats = min(left[length] // k for length, k in taken.items())
        out.append((repeats, taken))
        for length, k in taken.items():
            left[length] -= repeats * k
            if not left[length]:
                del left[length]
    return out


def places(drawn: list[tuple[int, dict[int, int]]]) -> np.ndarray:
    """A row for each length of each pattern: key, first rank, copies in a window, first
    sequence, offset; sorted by the key, which is length and first rank in one number."""
    used: dict[int, int] = {}
    rows, sequence = [], 0
    for repeats, taken in drawn:
        offset = 0
        for length in sorted(taken, reverse=True):
            rank, k = used.get(length, 0), taken[length]
            rows.append((length << 48 | rank, rank, k, sequence, offset))
            used[length] = rank + repeats * k
            offset += length * k
        sequence += repeats
    return np.array(sorted(rows), np.int64).reshape(-1, 5)


def cut_documents(docs: DataFrame, path: str, key: str, text: str, window: int, end_id: int, with_ids: bool) -> DataFrame:
    """(key, start, length, ids_crc32, doc_tokens, _part, _nth): pieces, counted in each
    task by length; ``with_ids`` adds ids."""
    kind = docs.schema[key].dataType.simpleString()
    schema = f"{key} {kind}, start long, length long, ids_crc32 long, doc_tokens long, _part long, _nth long" + ", ids binary" * with_ids
    names = [f.split()[0] for f in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        seen = np.zeros(window + 1, np.int64)
        for batch in batches:
            for rows, ids, bounds in encode_column(batch, text, path):
                row, start, length, crc, total, pieces = [], [], [], [], [], []
                cuts = bounds.tolist()
                for i, (a, b) in enumerate(zip(cuts, cuts[1:])):
                    raw = np.append(ids[a:b], np.uint32(end_id)).astype("<u4").tobytes()
                    n = b - a + 1
                    for s in range(0, n, window):
                        piece = raw[4 * s : 4 * (s + window)]
                        row.append(i)
                        start.append(s)
                        length.append(len(piece) // 4)
                        crc.append(zlib.crc32(piece))
                        total.append(n)
                        if with_ids:
                            pieces.append(piece)
                size = np.array(length, np.int64)
                order = np.argsort(size, kind="stable")
                first = np.searchsorted(size[order], size[order])
                nth = np.empty(len(size), np.int64)
                nth[order] = np.arange(len(size)) - first + seen[size[order]]
                seen += np.bincount(size, minlength=window + 1)
                columns = [batch.column(key)[rows].take(pa.array(row, pa.int64()))]
                columns += [pa.array(c, pa.int64()) for c in (start, length, crc, total, [part] * len(row), nth)]
                yield pa.RecordBatch.from_arrays(columns + [pa.array(pieces, pa.binary())] * with_ids, names)

    return small_batches(docs).select(key, text).mapInArrow(run, schema)


def pack(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text", window: int = WINDOW, end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """(key, start, length, ids_crc32, doc_tokens, sequence_id, offset, fill, padded_length)
    of every piece; ``with_ids`` adds its ids as little-endian 32-bit numbers.

    Texts are encoded once and do not travel; the pieces are written to the shared folder
    with their task and their count there.
    """
    cut = materialize(cut_documents(docs, path, key, text, window, end_id, with_ids))
    by_task = cut.groupBy("_part", "length").agg(F.count("*").alias("_n"))
    before = W.partitionBy("length").orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    base = by_task.select("_part", "length", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    # At most ``window`` rows, one for each length.
    counts = {r["length"]: r["n"] for r in by_task.groupBy("length").agg(F.sum("_n").alias("n")).collect()}
    drawn = patterns(counts, window)
    table = places(drawn)
    fills = np.array([sum(length * k for length, k in taken.items()) for _, taken in drawn], np.int64)
    first = np.cumsum([0] + [repeats for repeats, _ in drawn])[:-1]
    ranked = cut.join(base, ["_part", "length"]).withColumn("_rank", F.col("_base") + F.col("_nth")).drop("_part", "_nth", "_base")
    kept = [c for c in ranked.columns if c != "_rank"]
    out = ranked.select(*kept, "_rank").schema
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in out if f.name != "_rank")
    schema += ", sequence_id long, offset long, fill long, padded_length long"

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length = batch.column("length").to_numpy(zero_copy_only=False)
            rank = batch.column("_rank").to_numpy(zero_copy_only=False)
            _, start, k, sequence, offset = table[np.searchsorted(table[:, 0], length << 48 | rank, side="right") - 1].T
            nth = rank - start
            where = sequence + nth // k
            fill = fills[np.searchsorted(first, where, side="right") - 1]
            power = fill & (fill - 1) == 0
            added = [where, offset + nth % k * length, fill, np.where(power, fill, window)]
            columns = [batch.column(c) for c in kept] + [pa.array(a, pa.int64()) for a in added]
            yield pa.RecordBatch.from_arrays(columns, [*kept, "sequence_id", "offset", "fill", "padded_length"])

    return ranked.select(*kept, "_rank").mapInArrow(place, schema)
