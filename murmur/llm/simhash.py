"""Operator 9: SimHash near-duplicates by meet-in-the-middle ball hashing.

Fingerprints within ``radius`` bits of each other have a point between them that is within
half the radius of both. So every distinct fingerprint emits all its variants within half
the radius, the variants are shuffled, and those who meet at one variant are verified.

With an odd radius the two halves differ: two fingerprints an odd distance apart differ
in parity, so even ones go the smaller half and odd ones the larger. For radius 3 odd
fingerprints flip two bits only inside one half of the word: of any three differing bits
two lie in one half, and an even fingerprint flips the third. So nothing is missed.

Variants don't travel, fingerprints do: the bits of the word fall into groups, each inside
one half, and a variant's bucket is the parities of its groups. One flip changes one parity,
so all variants of a fingerprint lie in few buckets. It goes to each of these once, as a
plain row, and there the variants that belong to the bucket are made, sorted and verified.
Copies are folded before, near copies differ in parities too, and the number of groups
follows that of fingerprints, so a bucket holds about the same however many there are.
Where several meet, each is linked to the nearest one instead of to every other; links
keep all of a group connected and their number linear.

Defined results: a null text, or one without words, has fingerprint zero, linked like
any other; a text shorter than a shingle is one shingle; repeated rows and equal ids are
copies; rows without an id get the least id of their group, null if there is none.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from murmur.llm.frames import FILE, ROW, placed, small_batches, texts_of
from murmur.operators.clusters import star_forest
from murmur.session import materialize, materialize_measured

RADIUS, WORDS, SEED = 3, 3, 42
BITS = 64
#: Fingerprints of an Arrow batch, and variants that a bucket is meant to hold.
CHUNK, IN_BUCKET = 4096, 1 << 18


def fingerprint(text: str, words: int = WORDS, seed: int = SEED) -> int:
    """Majority over the XXH64 of all shingles, bit by bit, as a signed number."""
    found = text.encode().lower().split()
    if not found:
        return 0
    joined = b" ".join(found)
    end = np.cumsum(np.fromiter(map(len, found), np.int64, len(found)) + 1) - 1
    start = np.append(0, end[:-1] + 1)
    n = max(1, len(found) - words + 1)
    firsts, lasts = start[:n].tolist(), end[min(words, len(found)) - 1 :].tolist()
    counts = np.zeros(BITS, np.int64)
    for i in range(0, n, 8192):
        hashed = np.array([xxhash.xxh64_intdigest(joined[a:b], seed) for a, b in zip(firsts[i : i + 8192], lasts[i : i + 8192])], "<u8")
        counts += np.unpackbits(hashed.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    bits = np.packbits(2 * counts > n, bitorder="little")
    return int(bits.view("<i8")[0])


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = WORDS) -> DataFrame:
    """(key, fingerprint long) of every row, in a narrow pass over whole texts."""
    schema = f"{key} {docs.schema[key].dataType.simpleString()}, fingerprint long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [fingerprint(t, words) for t in texts_of(batch.column(text))]
            yield pa.RecordBatch.from_arrays([batch.column(key), pa.array(found, pa.int64())], [key, "fingerprint"])

    return small_batches(docs).select(key, text).mapInArrow(run, schema)


def flips(radius: int, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """What even and odd fingerprints of ``bits`` are combined with, nearest first."""
    if not 0 <= radius <= 3:
        raise ValueError("a radius of 0 to 3")
    one = [1 << i for i in range(bits)]
    half = bits // 2
    two = [1 << i | 1 << j for part in (range(half), range(half, bits)) for i, j in combinations(part, 2)]
    even, odd = {0: ([], []), 1: ([], one), 2: (one, one), 3: (one, one + two)}[radius]
    return np.array([0, *even], np.uint64), np.array([0, *odd], np.uint64)


def bit_groups(groups: int, bits: int = BITS) -> list[int]:
    """So many masks that share out the bits of a word, none with bits of both halves."""
    half, low = bits // 2, groups // 2
    shares = [(range(half), low), (range(half, bits), groups - low)]
    return [sum(1 << i for i in part[k::n]) for part, n in shares for k in range(n)]


def parities(words: np.ndarray, masks: list[int]) -> np.ndarray:
    """The bucket of each word: the parity of each group of its bits."""
    found = np.zeros(len(words), np.int64)
    for k, mask in enumerate(masks):
        found |= (np.bitwise_count(words & np.uint64(mask)) & 1).astype(np.int64) << k
    return found


def sent(distinct: DataFrame, masks: list[int], even: np.ndarray, odd: np.ndarray) -> DataFrame:
    """(bucket, fingerprint): each fingerprint once for every bucket that its variants fall in."""
    fp = F.col("fingerprint")
    signed = [m - (1 << BITS) if m >> (BITS - 1) else m for m in masks]
    own = reduce(
        lambda found, bit: found.bitwiseOR(bit),
        [F.shiftleft((F.bit_count(fp.bitwiseAND(F.lit(m))) % 2).cast("long"), k) for k, m in enumerate(signed)],
        F.lit(0).cast("long"),
    )
    away = lambda flip: F.lit(np.unique(parities(flip, masks)).tolist()).cast("array<long>")
    moves = F.when(F.bit_count(fp) % 2 == 1, away(odd)).otherwise(away(even))
    return distinct.select("fingerprint", F.explode(moves).alias("move")).select(
        own.bitwiseXOR(F.col("move")).alias("bucket"), "fingerprint"
    )


def ball_links(distinct: DataFrame, count: int, radius: int = RADIUS) -> DataFrame:
    """(a, b): links that connect all distinct fingerprints within ``radius`` bits."""
    even, odd = flips(radius)
    masks = bit_groups(int(count * (len(even) + len(odd)) / 2 / IN_BUCKET).bit_length())
    # Which flips lead from a fingerprint's parities to a bucket's, nearest first.
    leads = {
        (is_odd, int(move)): np.flatnonzero(to == move)
        for is_odd, to in ((0, parities(even, masks)), (1, parities(odd, masks)))
        for move in np.unique(to)
    }

    def meet(group: pa.Table) -> pa.Table:
        fp = group.column("fingerprint").to_numpy().view(np.uint64)
        move = parities(fp, masks) ^ group.column("bucket")[0].as_py()
        is_odd = (np.bitwise_count(fp) & 1).astype(np.int64)
        order = np.lexsort((move, is_odd))
        cuts = np.flatnonzero((np.diff(move[order]) != 0) | (np.diff(is_odd[order]) != 0)) + 1
        points, makers, codes = [], [], []
        for alike in np.split(order, cuts):
            code = leads[int(is_odd[alike[0]]), int(move[alike[0]])]
            flip = (odd if is_odd[alike[0]] else even)[code]
            points.append((fp[alike][:, None] ^ flip[None, :]).ravel())
            makers.append(np.repeat(fp[alike], len(code)))
            codes.append(np.tile(code.astype(np.int16), len(alike)))
        point, maker, code = map(np.concatenate, (points, makers, codes))
        order = np.argsort(point)
        equal = point[order[1:]] == point[order[:-1]]
        met = order[np.append(equal, False) | np.append(False, equal)]
        met = met[np.lexsort((code[met], point[met]))]
        first = np.flatnonzero(np.append(True, np.diff(point[met]) != 0))[: len(met)]
        nearest = np.repeat(maker[met][first], np.diff(np.append(first, len(met))))
        a, b = nearest, maker[met]
        near = (a != b) & (np.bitwise_count(a ^ b) <= radius)
        a, b = a[near].view(np.int64), b[near].view(np.int64)
        pairs = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)]), axis=1)
        return pa.table({"a": pairs[0], "b": pairs[1]})

    rows = sent(small_batches(distinct, CHUNK), masks, even, odd)
    return rows.groupBy("bucket").applyInArrow(meet, "a long, b long")


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = WORDS, radius: int = RADIUS) -> DataFrame:
    """(key, fingerprint, component_id): documents linked by fingerprints, directly or
    through others; a component is named after its smallest key."""
    rows = materialize(fingerprints(docs, key, text, words))
    # Copies are folded in each task before they travel.
    distinct, seen = materialize_measured(
        rows.groupBy("fingerprint").agg(F.min(key).alias("first")), n=F.count(F.lit(1))
    )
    roots = star_forest(ball_links(distinct, seen["n"], radius)).toDF("fingerprint", "root")
    placed = materialize(
        distinct.join(roots, "fingerprint", "left").withColumn("root", F.coalesce("root", "fingerprint"))
    )
    named = placed.groupBy("root").agg(F.min("first").alias("component_id"))
    of = placed.join(named, "root").select("fingerprint", "component_id")
    return rows.join(materialize(of), "fingerprint").select(key, "fingerprint", "component_id")


def drop_near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = WORDS, radius: int = RADIUS) -> DataFrame:
    """``docs`` with one row of each group that ``near_duplicates`` links.

    The row with the least key stays, one without a key only where all are; of equal keys
    that with the least hash of all columns, then the first by place. Rows are told by their
    place, so those that share a key, or have none, are decided each for itself.
    """
    kept = {c: F.col(f"`{c}`") for c in docs.columns}
    rows = placed(docs)
    order = F.struct(kept[key].isNull().alias("none"), kept[key].alias("key"), F.xxhash64(*kept.values()).alias("hash"), F.col(FILE), F.col(ROW))
    linked = near_duplicates(rows.select(order.alias("place"), kept[text].alias("text")), "place", "text", words, radius)
    stay = linked.filter("place = component_id").select(f"place.{FILE}", f"place.{ROW}")
    return rows.join(stay, [FILE, ROW], "left_semi").select(*kept.values())


def hex_of(fingerprint: str) -> Column:
    return F.lower(F.lpad(F.hex(F.col(fingerprint)), 16, "0"))
