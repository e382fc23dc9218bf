"""Operator 11: SentencePiece encoding and decoding of merge-type vocabularies.

A text's blanks become the space mark, with one more in front. Its signs are linked
symbols; every two neighbours that are a piece together are on an agenda, ordered by score,
then by place. The best pair is merged, its new neighbours are put on the agenda, and pairs
that have changed since are passed over, until the agenda is empty. A symbol that is no
piece becomes its bytes' pieces.

Where no piece holds a space mark after another sign, or a letter beside a sign that is
neither a letter nor a mark, no merge crosses such a place: a text falls into words whose
merges don't touch each other, so words met before come from a bounded cache, and the
result is that of one agenda for the whole text. Both are checked when the vocabulary is
read; without the first the whole text is one word.

``mismatches`` holds the operator against the sentencepiece library, in Arrow batches.

Defined results: a null text is empty; an empty text has no ids and decodes to nothing;
names of control and byte pieces in a text are ordinary signs; a space mark in a text is
decoded as a blank, as the library does; repeated rows and null keys are rows of their own.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush

import pyarrow as pa
from pyspark.sql import DataFrame
from sentencepiece import SentencePieceProcessor

from murmur.llm.frames import by_size, small_batches, texts_of

SPACE = "▁"
UNKNOWN = " ⁇ "
#: Signs of texts that are encoded at once; words and signs of a word that the cache holds.
CHUNK = 1 << 20
CACHE, SHORT = 500_000, 64
#: Bits of a place in a word, which Arrow limits to fewer.
BITS = 32
MASK = (1 << BITS) - 1


class Pieces:
    """A merge-type vocabulary whose normalisation only marks blanks."""

    def __init__(self, path: str):
        library = SentencePieceProcessor(model_file=path)
        if library.normalize("Ａ  b ") != f"{SPACE}Ａ{SPACE}{SPACE}b{SPACE}":
            raise ValueError("a vocabulary that changes signs or blanks before it is applied")
        score: dict[str, float] = {}
        self.ids: dict[str, int] = {}
        #: What an id shows: bytes for one byte, a string for anything else.
        self.shown: list[str | bytes] = []
        self.byte_ids, self.unknown = [0] * 256, library.unk_id()
        for i in range(library.get_piece_size()):
            piece = library.id_to_piece(i)
            if library.is_unused(i):
                raise ValueError("a vocabulary with unused pieces")
            if library.is_byte(i):
                self.byte_ids[int(piece[3:5], 16)] = i
                self.shown.append(bytes([int(piece[3:5], 16)]))
            elif library.is_control(i) or library.is_unknown(i):
                self.shown.append(UNKNOWN if library.is_unknown(i) else "")
            else:
                self.ids[piece], score[piece] = i, library.get_score(i)
                self.shown.append(piece.replace(SPACE, " "))
        #: Place of a piece's score among all, best first, above the bits of two places in a word.
        rank = {x: r for r, x in enumerate(sorted(set(score.values()), reverse=True))}
        self.order = {p: rank[x] << 2 * BITS for p, x in score.items()}
        self.with_bytes = any(isinstance(x, bytes) for x in self.shown)
        # A sign that is in no piece may be on either side.
        letters = "".join(sorted(c for c in set("".join(self.ids)) if c.isalpha()))
        letter, other = f"[{letters}]", f"[^{letters}{SPACE}]"
        within = lambda pattern: any(map(re.compile(pattern).search, self.ids))
        if within(f"[^{SPACE}]{SPACE}"):
            self.words = re.compile("(?s).+")
        elif not letters or within(f"{letter}{other}|{other}{letter}"):
            self.words = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")
        else:
            self.words = re.compile(f"{SPACE}*{letter}+|{SPACE}*{other}+|{SPACE}+")
        self.cache: dict[str, tuple[str, int, str]] = {}

    def merge(self, word: str) -> list[str]:
        """The symbols of a word once no two neighbours are a piece together.

        A symbol is told by where it starts: ``stop`` has its end, or 0 once it is part of
        another, and ``begin`` its start by its end. An entry of the agenda is one number:
        order of the pair's score, start, end.
        """
        n, order = len(word), self.order.get
        stop, begin = list(range(1, n + 1)), list(range(-1, n))
        agenda = [r | i << BITS | i + 2 for i in range(n - 1) if (r := order(word[i : i + 2])) is not None]
        heapify(agenda)
        while agenda:
            entry = heappop(agenda)
            i, end = entry >> BITS & MASK, entry & MASK
            j = stop[i]
            # Either side has been merged with another since.
            if j == 0 or j == n or stop[j] != end:
                continue
            stop[i], stop[j], begin[end] = end, 0, i
            if end < n and (r := order(word[i : stop[end]])) is not None:
                heappush(agenda, r | i << BITS | stop[end])
            if i and (r := order(word[begin[i] : end])) is not None:
                heappush(agenda, r | begin[i] << BITS | end)
        out, i = [], 0
        while i < n:
            out.append(word[i : stop[i]])
            i = stop[i]
        return out

    def ids_of(self, symbols: list[str]) -> list[int]:
        out = []
        for s in symbols:
            i = self.ids.get(s)
            if i is not None:
                out.append(i)
            elif self.with_bytes:
                out += [self.byte_ids[b] for b in s.encode()]
            elif not out or out[-1] != self.unknown:
                out.append(self.unknown)
        return out

    def encode(self, text: str) -> list[int]:
        if not text:
            return []
        return [i for w in self.words.findall(SPACE + text.replace(" ", SPACE)) for i in self.ids_of(self.merge(w))]

    def surface(self, ids: list[int]) -> str:
        """What ids show, the mark in front included; runs of bytes are read as UTF-8."""
        out, held = [], b""
        for i in ids:
            shown = self.shown[i]
            if isinstance(shown, bytes):
                held += shown
                continue
            if held:
                out.append(_utf8(held))
                held = b""
            out.append(shown)
        return "".join(out) + _utf8(held)

    def decode(self, ids: list[int]) -> str:
        """The text of ids: what they show, without the mark in front of the first piece."""
        silent = next((k for k, i in enumerate(ids) if self.shown[i] != ""), len(ids))
        shown = self.surface(ids)
        first = self.shown[ids[silent]] if silent < len(ids) else ""
        marked = isinstance(first, str) and first.startswith(" ") and ids[silent] != self.unknown
        return shown[1:] if marked else shown

    def word(self, word: str) -> tuple[str, int, str]:
        """(ids joined by commas, how many, what they show) of a word."""
        ids = self.ids_of(self.merge(word))
        made = ",".join(map(str, ids)), len(ids), self.surface(ids)
        if len(word) <= SHORT:
            if len(self.cache) >= CACHE:
                self.cache.clear()
            self.cache[word] = made
        return made

    def digest(self, text: str) -> tuple[int, str, str]:
        """(number of ids, digest of the ids, digest of the decoded text)."""
        if not text:
            return 0, _hex(""), _hex("")
        found, word = self.cache.get, self.word
        made = [found(w) or word(w) for w in self.words.findall(SPACE + text.replace(" ", SPACE))]
        joined, counts, shown = zip(*made)
        # The first word begins with the mark put in front.
        return sum(counts), _hex(",".join(joined)), _hex("".join(shown)[1:])


def _hex(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def _utf8(data: bytes) -> str:
    """``data`` as UTF-8, each byte that is in no valid sign replaced by U+FFFD."""
    out, i = [], 0
    while i < len(data):
        for n in range(1, 5):
            try:
                out.append(data[i : i + n].decode())
            except UnicodeDecodeError:
                continue
            break
        else:
            out.append("�")
            n = 1
        i += n
    return "".join(out)


@lru_cache(4)
def load(path: str) -> Pieces:
    """The vocabulary at ``path``, once in each Python worker."""
    return Pieces(path)


@lru_cache(4)
def library_of(path: str) -> SentencePieceProcessor:
    return SentencePieceProcessor(model_file=path)


def public_path(name: str = "piece_bpe_32k.model") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def piece_documents(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text", with_ids: bool = False) -> DataFrame:
    """(key, n_tokens, ids_sha256, decoded_sha256) of every row; ``with_ids`` adds ids.

    A narrow pass over whole texts: nothing is shuffled and each batch is bounded.
    """
    kind = docs.schema[key].dataType.simpleString()
    schema = f"{key} {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * with_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = load(path)
        for batch in batches:
            texts = texts_of(batch.column(text))
            for rows in by_size([len(t) for t in texts], CHUNK):
                found = [own.digest(t) for t in texts[rows]]
                kinds = (pa.int64(), pa.string(), pa.string())
                out = [batch.column(key)[rows]] + [pa.array([f[k] for f in found], t) for k, t in enumerate(kinds)]
                if with_ids:
                    out.append(pa.array([own.encode(t) for t in texts[rows]], pa.list_(pa.int32())))
                yield pa.RecordBatch.from_arrays(out, [f.split()[0] for f in schema.split(", ")])

    return small_batches(docs).select(key, text).mapInArrow(run, schema)


def mismatches(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, own, library) of the rows whose ids or decoded text the sentencepiece library
    gives otherwise: none, for a vocabulary that ``Pieces`` accepts."""
    schema = f"{key} {docs.schema[key].dataType.simpleString()}, own array<int>, library array<int>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, library = load(path), library_of(path)
        for batch in batches:
            texts = texts_of(batch.column(text))
            for rows in by_size([len(t) for t in texts], CHUNK):
                ids = [own.encode(t) for t in texts[rows]]
                told = [library.encode(t) for t in texts[rows]]
                differs = [a != b or own.decode(a) != library.decode(b) for a, b in zip(ids, told)]
                lists = [pa.array(x, pa.list_(pa.int32())) for x in (ids, told)]
                made = pa.RecordBatch.from_arrays([batch.column(key)[rows], *lists], [key, "own", "library"])
                yield made.filter(pa.array(differs, pa.bool_()))

    return small_batches(docs).select(key, text).mapInArrow(run, schema)
