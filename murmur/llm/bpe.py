"""Operator 10: byte-level BPE by a contiguous rank array, and back.

A text is cut into words by the byte-level pattern (contractions, words, numbers, other
signs, each with one blank before it, and white space). A short word is an array of parts
with the rank of each pair of neighbours beside it: the least rank is sought by scanning,
its boundary is deleted, and the ranks to its left and right are looked up again, until
no pair has a rank. Words of equal length are done together, one matrix row each, and a
word met before comes from a bounded cache. Long words take a heap instead of the scan.

Defined results: a null text is empty and has no ids; an empty text has no ids; strings
of added tokens in a text become their id, as the tokenizers library does by default.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from murmur.llm.frames import by_size, ranges, small_batches, texts_of

OTHER, LETTER, NUMBER, SPACE, MARK = range(5)
#: Between two segments, and in place of an added token; no valid text holds surrogates.
CUT, ADDED = 0xD800, 0xD801
CHUNK = 1 << 20
SHORT = 48
CACHE = 1_000_000
NONE = np.int32(np.iinfo(np.int32).max)


@lru_cache(1)
def _classes() -> np.ndarray:
    table = np.zeros(0x110000, np.uint8)
    for c in range(0x110000):
        kind = unicodedata.category(chr(c))[0]
        if kind == "L":
            table[c] = LETTER
        elif kind == "N":
            table[c] = NUMBER
    # The code points with the White_Space property.
    spaces = [*range(9, 14), 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
    table[spaces] = SPACE
    table[0xD800:0xE000] = MARK
    return table


def starts_of(points: np.ndarray) -> np.ndarray:
    """Where words start among code points; a mark is a word of its own."""
    n = len(points)
    kind = _classes()[points]
    first = np.empty(n + 1, bool)
    first[0] = first[n] = True
    first[1:n] = (kind[1:] != kind[:-1]) | (kind[1:] == MARK)
    run = np.flatnonzero(first)
    start, end = run[:-1], run[1:]
    of = kind[start]
    # The last sign of white space before something else: a blank belongs to what follows,
    # any other stands alone.
    white = (of == SPACE) & (end < n)
    white[white] &= kind[end[white]] != MARK
    last = end[white] - 1
    first[last] = True
    first[last[points[last] == 32] + 1] = False
    # An apostrophe alone, no blank before it, and letters that make a contraction.
    lone = start[(of == OTHER) & (end - start == 1)]
    lone = lone[(points[lone] == 39) & first[lone]]
    lone = lone[lone + 1 < n]
    after = points[lone + 1]
    then = points[np.minimum(lone + 2, n - 1)] * (lone + 2 < n)
    one = np.isin(after, [ord(c) for c in "stmd"])
    two = np.zeros(len(lone), bool)
    for pair in ("re", "ve", "ll"):
        two |= (after == ord(pair[0])) & (then == ord(pair[1]))
    for which, width in ((one, 2), (two, 3)):
        first[lone[which] + 1] = False
        first[lone[which] + width] = True
    return np.flatnonzero(first[:n])


@lru_cache(1)
def _powers() -> tuple[np.ndarray, ...]:
    """Powers of two odd numbers and of their inverses, modulo 2 ** 64."""
    out = []
    for base in (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93):
        for b in (base, pow(base, -1, 1 << 64)):
            p = np.full(CHUNK, b, np.uint64)
            p[0] = 1
            out.append(np.cumprod(p))
    return tuple(out)


def _hashes(points: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    found = []
    values = points.astype(np.uint64) * np.uint64(0xFF51AFD7ED558CCD) + np.uint64(1)
    p = _powers()
    for power, inverse in (p[:2], p[2:]):
        sums = np.zeros(len(points) + 1, np.uint64)
        np.cumsum(values * power[: len(points)], out=sums[1:])
        found.append((sums[end] - sums[start]) * inverse[start])
    return found[0], found[1]


class Bpe:
    """A byte-level BPE vocabulary in the tokenizers library's JSON form."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, before = spec["model"], spec["pre_tokenizer"]
        if model["type"] != "BPE" or before["type"] != "ByteLevel" or before["add_prefix_space"] or spec["normalizer"]:
            raise ValueError("a plain byte-level BPE file is needed")
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        letters = dict(zip(map(chr, shown), shown))
        letters |= {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in shown)}
        vocab = model["vocab"]
        text = {i: bytes(letters[c] for c in t) for t, i in vocab.items()}
        self.byte_id = np.zeros(256, np.int32)
        for c, b in letters.items():
            self.byte_id[b] = vocab[c]
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        keys = np.array([vocab[a] << 32 | vocab[b] for a, b in pairs], np.int64)
        order = np.argsort(keys)
        self.keys, self.ranks = keys[order], order.astype(np.int32)
        self.made = np.array([vocab[a + b] for a, b in pairs], np.int32)
        self.by_pair = {int(k): r for r, k in enumerate(keys)}
        self.added = {}
        for t in spec["added_tokens"]:
            if t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"]:
                raise ValueError("an added token that isn't matched literally")
            self.added[t["content"]] = t["id"]
            text[t["id"]] = t["content"].encode()
        longest_first = sorted(self.added, key=len, reverse=True)
        self.added_pattern = re.compile("(" + "|".join(map(re.escape, longest_first)) + ")") if self.added else None
        size = max(text) + 1
        self.token_length = np.array([len(text.get(i, b"")) for i in range(size)], np.int64)
        self.token_start = np.cumsum(self.token_length) - self.token_length
        self.token_bytes = np.frombuffer(b"".join(text.get(i, b"") for i in range(size)), np.uint8)
        self._forget()

    def _forget(self) -> None:
        self.rows: dict[int, int] = {}
        self.row_check = np.zeros(0, np.uint64)
        self.row_start = np.zeros(0, np.int64)
        self.row_length = np.zeros(0, np.int64)
        self.row_ids = np.zeros(0, np.int32)

    def _rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = a.astype(np.int64) << 32 | b
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], NONE)

    def _equal_length(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, counts) of words of one byte length, a row each."""
        parts = self.byte_id[words]
        n, width = parts.shape
        ids, counts = parts.copy(), np.full(n, width, np.int64)
        rank = np.full((n, width), NONE, np.int32)
        rank[:, :-1] = self._rank(parts[:, :-1], parts[:, 1:])
        row, end = np.arange(n), counts.copy()
        column = np.arange(width)
        while len(row):
            at = rank.argmin(1)
            base = np.arange(0, len(row) * width, width)
            best = rank.ravel()[base + at]
            going = best < NONE
            if not going.all():
                done = ~going
                ids[row[done]], counts[row[done]] = parts[done], end[done]
                row, end, parts, rank, at, best = row[going], end[going], parts[going], rank[going], at[going], best[going]
                if not len(row):
                    break
                base = base[: len(row)]
            # Delete the boundary after part ``at``: what is to its right moves up.
            left = base[:, None] + np.minimum(column + (column > at[:, None]), width - 1)
            parts, rank = parts.ravel()[left], rank.ravel()[left]
            end -= 1
            flat, ranks, here = parts.ravel(), rank.ravel(), base + at
            flat[here] = self.made[best]
            ranks[base + end - 1] = NONE
            before = here[at > 0]
            ranks[before - 1] = self._rank(flat[before - 1], flat[before])
            after = here[at + 1 < end]
            ranks[after] = self._rank(flat[after], flat[after + 1])
        return ids, counts

    def _long(self, word: bytes) -> list[int]:
        """Merges of a long word from a heap of ranked pairs over linked parts."""
        parts = [int(i) for i in self.byte_id[np.frombuffer(word, np.uint8)]]
        n = len(parts)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i, parts[i], parts[i + 1]) for i in range(n - 1) if (r := self.by_pair.get(parts[i] << 32 | parts[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            r, i, a, b = heapq.heappop(heap)
            j = after[i]
            if parts[i] != a or j >= n or parts[j] != b:
                continue
            parts[i], parts[j] = int(self.made[r]), -1
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
            for k in (before[i], i):
                if k >= 0 and after[k] < n and (r := self.by_pair.get(parts[k] << 32 | parts[after[k]])) is not None:
                    heapq.heappush(heap, (r, k, parts[k], parts[after[k]]))
        return [p for p in parts if p >= 0]

    def words(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all words one after the other, how many each has)."""
        size = np.fromiter(map(len, words), np.int64, len(words))
        order = np.argsort(size, kind="stable")
        data = np.frombuffer(b"".join([words[i] for i in order.tolist()]), np.uint8)
        counts = np.zeros(len(words), np.int64)
        widths, first = np.unique(size[order], return_index=True)
        last, read, done = np.append(first[1:], len(words)), 0, []
        for width, a, b in zip(widths.tolist(), first.tolist(), last.tolist()):
            which = order[a:b]
            block = data[read : read + (b - a) * width].reshape(b - a, width)
            read += block.size
            if width > SHORT:
                long = [self._long(row.tobytes()) for row in block]
                counts[which] = [len(ids) for ids in long]
                done.append((which, np.array([i for ids in long for i in ids], np.int32)))
            elif width:
                ids, counts[which] = self._equal_length(block)
                done.append((which, ids[np.arange(width) < counts[which][:, None]]))
        start = np.cumsum(counts) - counts
        out = np.zeros(int(counts.sum()), np.int32)
        for which, ids in done:
            out[ranges(start[which], counts[which])] = ids
        return out, counts

    def _segments(self, text: str) -> list[tuple[str, int]]:
        """(segment, code of the mark after it); a long text is cut where white space
        follows a word, which no word crosses."""
        pieces = self.added_pattern.split(text) if self.added_pattern else [text]
        out = []
        for i, piece in enumerate(pieces):
            if i % 2:
                # The mark of an added token; which one is known from its own entry.
                out[-1] = (out[-1][0], ADDED + list(self.added).index(piece))
                continue
            while len(piece) > CHUNK // 2:
                cut = re.compile(r"[^\W_][ \n]").search(piece, CHUNK // 2)
                if cut is None:
                    break
                out.append((piece[: cut.start() + 1], CUT))
                piece = piece[cut.start() + 1 :]
            out.append((piece, CUT))
        return out

    def _encode_points(self, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Of marked segments: ids, ids of each word, and the words that are marks."""
        points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
        start = starts_of(points)
        end = np.append(start[1:], len(points))
        if len(points) <= CHUNK:
            hashed, check = _hashes(points, start, end)
        else:
            hashed = check = np.zeros(len(start), np.uint64)
        mark = points[start]
        is_mark = (mark >= 0xD800) & (mark < 0xE000)
        plain = np.flatnonzero(~is_mark & (end - start <= SHORT)) if len(points) <= CHUNK else np.zeros(0, np.int64)
        single = np.ones(len(start), bool)
        single[plain] = False
        keys, rep, inverse = np.unique(hashed[plain], return_index=True, return_inverse=True)
        rep = plain[rep]
        # Two words with one hash: those that differ in the second go one by one.
        odd = check[plain] != check[rep][inverse]
        if len(self.rows) + len(keys) > CACHE:
            self._forget()
        known = self.rows.get
        at = np.array([known(k, -1) for k in keys.tolist()], np.int64)
        stale = at >= 0
        stale[stale] = self.row_check[at[stale]] != check[rep[stale]]
        fresh = np.flatnonzero(at < 0)
        if len(fresh):
            s, e = start[rep[fresh]].tolist(), end[rep[fresh]].tolist()
            ids, counts = self.words([text[a:b].encode() for a, b in zip(s, e)])
            base = len(self.row_length)
            at[fresh] = base + np.arange(len(fresh))
            self.rows.update(zip(keys[fresh].tolist(), at[fresh].tolist()))
            self.row_check = np.append(self.row_check, check[rep[fresh]])
            self.row_start = np.append(self.row_start, len(self.row_ids) + np.cumsum(counts) - counts)
            self.row_length = np.append(self.row_length, counts)
            self.row_ids = np.append(self.row_ids, ids)
        single[plain[odd | stale[inverse]]] = True
        row = at[inverse]
        length = np.zeros(len(start), np.int64)
        from_row = np.zeros(len(start), np.int64)
        length[plain], from_row[plain] = self.row_length[row], self.row_start[row]
        source = self.row_ids
        alone = np.flatnonzero(single & ~is_mark)
        added = np.flatnonzero(mark > CUT) if is_mark.any() else np.zeros(0, np.int64)
        added = added[is_mark[added]]
        if len(alone) or len(added):
            ids, counts = self.words([text[start[i] : end[i]].encode() for i in alone])
            length[alone], from_row[alone] = counts, len(source) + np.cumsum(counts) - counts
            values = np.array(list(self.added.values()) or [0], np.int32)
            length[added], from_row[added] = 1, len(source) + len(ids) + mark[added].astype(np.int64) - ADDED
            source = np.concatenate([source, ids, values])
        return source[ranges(from_row, length)], length, np.flatnonzero(is_mark), mark

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, bounds): text i has ids[bounds[i]:bounds[i + 1]], as unsigned 32 bits."""
        cut = [self._segments(t) for t in texts]
        owner = np.repeat(np.arange(len(texts)), [len(c) for c in cut])
        segments = [s for c in cut for s in c]
        ids, sizes = [], np.zeros(len(texts), np.int64)
        for run in by_size([len(s) + 1 for s, _ in segments], CHUNK):
            text = "".join(s + chr(m) for s, m in segments[run])
            got, length, marks, _ = self._encode_points(text)
            ids.append(got)
            # A segment ends with its mark, and an added token's id belongs to it.
            done = np.cumsum(length)[marks]
            np.add.at(sizes, owner[run], np.diff(done, prepend=0))
        bounds = np.zeros(len(texts) + 1, np.int64)
        np.cumsum(sizes, out=bounds[1:])
        return (np.concatenate(ids) if ids else np.zeros(0)).astype("<u4"), bounds

    def decode(self, ids: np.ndarray, bounds: np.ndarray) -> list[bytes]:
        """The decoded texts in UTF-8; what isn't valid becomes U+FFFD."""
        lengths = self.token_length[ids]
        ends = np.zeros(len(ids) + 1, np.int64)
        np.cumsum(lengths, out=ends[1:])
        out = []
        for run in by_size(np.diff(ends[bounds]).tolist(), 8 * CHUNK):
            a, b = bounds[run.start], bounds[run.stop]
            data = self.token_bytes[ranges(self.token_start[ids[a:b]], lengths[a:b])].tobytes()
            cuts = (ends[bounds[run.start : run.stop + 1]] - ends[a]).tolist()
            out += [data[x:y].decode("utf-8", "replace").encode() for x, y in zip(cuts, cuts[1:])]
        return out


@lru_cache(4)
def load(path: str) -> Bpe:
    """The vocabulary at ``path``, once in each Python worker."""
    return Bpe(path)


def public_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def encode_column(batch: pa.RecordBatch, text: str, path: str, most: int = CHUNK) -> Iterator[tuple[slice, np.ndarray, np.ndarray]]:
    """(rows, ids, bounds) for runs of a batch's rows with about ``most`` signs each."""
    texts = texts_of(batch.column(text))
    for run in by_size([len(t) for t in texts], most):
        ids, bounds = load(path).encode(texts[run])
        yield run, ids, bounds


def bpe_documents(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text", with_ids: bool = False) -> DataFrame:
    """(key, n_tokens, ids_sha256, decoded_sha256) of every row; ``with_ids`` adds ids.

    A narrow pass over whole texts: nothing is shuffled and each batch is bounded.
    """
    kind = docs.schema[key].dataType.simpleString()
    schema = f"{key} {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * with_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, ids, bounds in encode_column(batch, text, path):
                back = load(path).decode(ids, bounds)
                raw = ids.tobytes()
                cuts = bounds.tolist()
                out = [
                    batch.column(key)[rows],
                    pa.array(np.diff(bounds), pa.int64()),
                    pa.array([hashlib.sha256(raw[4 * a : 4 * b]).hexdigest() for a, b in zip(cuts, cuts[1:])], pa.string()),
                    pa.array([hashlib.sha256(t).hexdigest() for t in back], pa.string()),
                ]
                if with_ids:
                    out.append(pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(ids.astype(np.int32))))
                yield pa.RecordBatch.from_arrays(out, [f.split()[0] for f in schema.split(", ")])

    return small_batches(docs).select(key, text).mapInArrow(run, schema)
