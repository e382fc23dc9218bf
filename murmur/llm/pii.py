"""Operator 6: personal data by a character-level BiLSTM with CRF transitions.

Spans of four kinds. The base ones follow fixed patterns, kept as they are. A tagger,
trained in numpy from labelled spans, adds spans that the patterns miss because they are
written otherwise (numbers without a plus sign, other separators, blanks around signs).
It is trained on the driver from a bounded sample: pieces of at most ``SNIPPETS`` texts,
with base spans as found there, and spans of all kinds and look-alikes of none set in.

A span must hold a digit or an at sign, which the decoder knows: windows without either
have no span, and are not run. All others are cut into overlapping windows; each sign
takes its tag from the window where it is farthest from an edge, so spans that cross
windows come out whole, and one that the model is not sure of, or that touches a base
span, is dropped.

Defined results: null text is empty and has no spans; repeated rows are searched each for
itself; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import random
import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from murmur.llm.bilstm import Tagger
from murmur.llm.frames import small_batches, texts_of

KINDS = ("email", "ip", "card", "phone")
WINDOW, STRIDE, REACH = 64, 32, 24
SNIPPETS, SNIPPET = 400, 160
SURE = 0.8
BLOCK = 1024
#: Signs of the tagger: printable ASCII, other letters, white space, all else.
SIGNS = 98

_AT_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# A match can only begin where a run of digits does, and no digit is given back: the same
# matches as the plain patterns, in linear time.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGITS = "0123456789"
_WIDE = re.compile(r"(?![0-9])[\d\uFF20]")
_HOST = re.compile(r"(?:[A-Za-z0-9-]|\.(?=[A-Za-z0-9]))*")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost matches, sought from each at sign: what is before it must only be there,
    what follows decides."""
    out, done, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        found = _AT_DOMAIN.match(text, at + 1) if start < at else None
        if found:
            out.append((start, found.end()))
            done = found.end()
        else:
            # The next address may begin right behind this sign, not before it.
            done = max(done, at + 1) if start == at else done
        at = text.find("@", at + 1 if not found else done)
    return out


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Spans of the patterns, by kind, then start."""
    out = [("email", a, b) for a, b in emails(text)]
    if not any(d in text for d in _DIGITS):
        return out
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m[0].split(".")):
            out.append(("ip", *m.span()))
    for m in _CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 16 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", *m.span()))
    for m in _PHONE.finditer(text):
        if 8 <= sum(c in _DIGITS for c in m[0]) <= 15:
            out.append(("phone", *m.span()))
    return out


def signs_of(text: str) -> np.ndarray:
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
    out = np.where((points >= 32) & (points < 127), points - 32, 97)
    out[(points >= 0xC0) & (points < 0x250)] = 95
    out[(points >= 9) & (points <= 13)] = 96
    return out.astype(np.int16)


def _allowed() -> np.ndarray:
    """Outside, then begin and inside of each kind; inside only follows its own kind."""
    tags = 1 + 2 * len(KINDS)
    allowed = np.zeros((tags, tags))
    for k in range(len(KINDS)):
        inside = 2 + 2 * k
        allowed[:, inside] = -1e4
        allowed[[inside - 1, inside], inside] = 0
    return allowed


def _card(rng: random.Random) -> str:
    body = "".join(rng.choice(_DIGITS) for _ in range(15))
    return next(body + c for c in _DIGITS if luhn(body + c))


def _made(kind: str, rng: random.Random) -> str:
    """A span of a kind, written as the patterns expect or otherwise."""

    def word(a: int, b: int) -> str:
        return "".join(rng.choice("abcdefghilmnoprstuvy") for _ in range(rng.randint(a, b)))

    def digits(n: int) -> str:
        return str(rng.randint(1, 9)) + "".join(rng.choice(_DIGITS) for _ in range(n - 1))

    if kind == "email":
        name = word(2, 9) + rng.choice(["", f".{word(1, 8)}", f".{digits(2)}", digits(2)])
        host = rng.choice(["", f"{word(2, 6)}{rng.randint(1, 9)}."]) + word(3, 8) + "." + rng.choice(["com", "org", "net", "de", "fr", "es", "io"])
        return rng.choice(["{}@{}", "{}@{}", "{} @ {}", "{}@ {}", "{} @{}"]).format(name, host)
    if kind == "ip":
        parts = [str(rng.randint(0, 255)) for _ in range(4)]
        return rng.choice([".", ".", ".", " . ", ". "]).join(parts)
    if kind == "card":
        d = _card(rng)
        return rng.choice(["", " ", "-", ".", "/", " - "]).join([d[i : i + 4] for i in range(0, 16, 4)])
    a, b, c = digits(3), digits(3), digits(4)
    land = rng.choice(["+1 ", "+1 ", f"+{rng.randint(20, 99)} ", "+1-", "", "", "", "1-"])
    return land + rng.choice([f"({a}) {b}-{c}", f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"{a}.{b}.{c}", f"({a}){b}-{c}"])


def _look_alike(rng: random.Random) -> str:
    """Digits and signs that are no personal data."""

    def digits(a: int, b: int) -> str:
        return "".join(rng.choice(_DIGITS) for _ in range(rng.randint(a, b)))

    return rng.choice([
        lambda: digits(1, 7), lambda: digits(1, 4), lambda: f"{rng.randint(1, 20)}.{digits(1, 2)}", lambda: f"{rng.randint(1, 9)}.{digits(1, 1)}.{digits(1, 2)}",
        lambda: f"{rng.randint(1900, 2030)}-{rng.randint(10, 12)}-{rng.randint(10, 28)}", lambda: f"{rng.randint(1, 28)}/{rng.randint(1, 12)}/{rng.randint(1900, 2030)}",
        lambda: "".join(rng.choice("0123456789abcdef") for _ in range(rng.choice([16, 24, 32, 40, 64]))),
        lambda: "AKIA" + "".join(rng.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567") for _ in range(16)),
        lambda: "".join(rng.choice("ABCDEFghijklMNOPqrst0123456789+/") for _ in range(rng.randint(16, 40))),
        lambda: f"{digits(1, 3)},{digits(3, 3)}.{digits(2, 2)}", lambda: f"{rng.randint(10, 23)}:{rng.randint(10, 59)}", lambda: "@", lambda: f"@{rng.choice(['all', 'home', 'one'])}",
        lambda: f"{digits(1, 3)} - {digits(1, 3)}", lambda: f"({digits(1, 4)})", lambda: f"{digits(9, 14)}", lambda: f"v{rng.randint(1, 9)}.{rng.randint(0, 20)}", lambda: f"{digits(1, 2)}%", lambda: f"[{digits(1, 2)}]",
    ])()


def labelled(snippets: list[str], n: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """(signs, tags) of ``n`` windows: base spans as found, made ones and look-alikes set in."""
    rng = random.Random(seed)
    snippets = snippets or ["and then the rest of it was sent to them before noon, as it is. "]
    signs, tags = np.empty((n, WINDOW), np.int16), np.zeros((n, WINDOW), np.int64)
    for row in range(n):
        base = rng.choice(snippets)
        text, spans, draw = "", [], rng.random()
        if draw < 0.12:
            text, spans = base, base_spans(base)
        else:
            cut = rng.randint(0, max(0, len(base) - 80))
            base = base[cut : cut + 160]
            known = base_spans(base)
            if known:
                base = base[: min(a for _, a, _ in known)]
            at = rng.randint(0, min(len(base), 50))
            text = base[:at]
            for _ in range(rng.choice([1, 1, 2])):
                text += rng.choice([" ", " ", "\n", ": ", "", "; ", "### ", "(", "| "])
                if draw < 0.62:
                    kind = rng.choice(KINDS)
                    made = _made(kind, rng)
                    if text[-1:].isalnum():
                        text += " "
                    spans.append((kind, len(text), len(text) + len(made)))
                else:
                    made = _look_alike(rng)
                text += made + rng.choice([" ", " ", ". ", ", ", "\n", ")", "%%% ", " | "])
            text += base[at:]
        mark = np.zeros(len(text), np.int64)
        # Later kinds do not overwrite earlier ones.
        for kind, a, b in sorted(spans, key=lambda s: KINDS.index(s[0])):
            if not mark[a:b].any():
                mark[a:b] = 2 + 2 * KINDS.index(kind)
                mark[a] -= 1
        first = rng.choice(spans)[1] if spans else (len(text) // 2)
        start = max(0, min(first - rng.randint(0, WINDOW - 8), len(text) - WINDOW))
        # A window that begins inside a span begins with its inside, which the CRF allows
        # nowhere; such windows are moved back to the span's start.
        while start > 0 and mark[start] > 0 and mark[start] % 2 == 0:
            start -= 1
        piece = text[start : start + WINDOW].ljust(WINDOW)
        signs[row] = signs_of(piece)
        own = mark[start : start + WINDOW]
        tags[row, : len(own)] = own
    return signs, tags


@lru_cache(2)
def _trained(snippets: tuple[str, ...], windows: int, rounds: int, seed: int) -> Tagger:
    tagger = Tagger.fresh(SIGNS, _allowed(), seed)
    tagger.fit(*labelled(list(snippets), windows, seed), rounds, seed=seed)
    return tagger


def train(snippets: list[str], windows: int = 3500, rounds: int = 13, seed: int = 0) -> Tagger:
    """A tagger from labelled windows made of ``snippets``; the same for the same ones."""
    return _trained(tuple(sorted(snippets)), windows, rounds, seed)


def _windows(text: str) -> list[int]:
    """Starts of overlapping windows over all signs near a digit or an at sign."""
    near = [m.span() for m in re.finditer(r"[0-9@]+", text)]
    out: list[int] = []
    end = 0  # signs before this are covered with room to spare
    for a, b in near:
        low, high = max(0, a - REACH, end), b + REACH
        if high <= end:
            continue
        for start in range(max(0, low - (STRIDE // 2 if low == end and end else 0)), max(high - STRIDE // 2, low + 1), STRIDE):
            out.append(start)
        end = out[-1] + WINDOW - STRIDE // 2
    return out


def plain_digits(text: str) -> str:
    """``text`` with digits of all scripts, and wide at signs, as their ASCII ones: as long as it is."""
    if text.isascii():
        return text
    return _WIDE.sub(lambda m: "@" if m[0] == "\uFF20" else str(unicodedata.decimal(m[0])), text)


def whole(kind: str, text: str, a: int, b: int) -> tuple[int, int]:
    """A span with the rest of the name, host or number that it begins or ends in, which may
    lie beyond the windows."""
    if kind != "email":
        while a and text[a - 1] in _DIGITS:
            a -= 1
        while b < len(text) and text[b] in _DIGITS:
            b += 1
        return a, b
    while a and text[a - 1] in _LOCAL:
        a -= 1
    return a, _HOST.match(text, b).end()


def added_spans(texts: list[str], base: list[list[tuple[str, int, int]]], tagger: Tagger) -> list[list[tuple[str, int, int]]]:
    """What the tagger adds to the base spans of each text."""
    out: list[list[tuple[str, int, int]]] = [[] for _ in texts]
    texts = [plain_digits(t) for t in texts]
    jobs = [(i, s) for i, t in enumerate(texts) if "@" in t or any(d in t for d in _DIGITS) for s in _windows(t)]
    found: dict[int, list[tuple[int, int, np.ndarray, np.ndarray]]] = {}
    for at in range(0, len(jobs), BLOCK):
        block = jobs[at : at + BLOCK]
        pieces = [texts[i][s : s + WINDOW] for i, s in block]
        scores = tagger.emissions(signs_of("".join(p.ljust(WINDOW) for p in pieces)).reshape(-1, WINDOW))
        tags, sure = tagger.decode(scores), tagger.marginals(scores)
        for k, (i, s) in enumerate(block):
            n = len(pieces[k])
            certain = np.take_along_axis(sure[:, k], tags[k][:, None], 1)[:, 0]
            found.setdefault(i, []).append((s, n, tags[k][:n], certain[:n]))
    for i, windows in found.items():
        if not any(t.any() for _, _, t, _ in windows):
            continue
        text = texts[i]
        low = min(s for s, _, _, _ in windows)
        size = max(s + n for s, n, _, _ in windows) - low
        tag, certain, depth = np.zeros(size, np.int64), np.zeros(size), np.full(size, -1)
        for s, n, t, c in windows:
            # How far a sign is from the window's edges; a text's own ends are no edges.
            left = np.arange(n) if s else np.full(n, WINDOW)
            right = np.arange(n)[::-1] if s + n < len(text) else np.full(n, WINDOW)
            inner, view = np.minimum(left, right), slice(s - low, s - low + n)
            better = inner > depth[view]
            tag[view] = np.where(better, t, tag[view])
            certain[view] = np.where(better, c, certain[view])
            depth[view] = np.maximum(depth[view], inner)
        kind = (tag + 1) // 2
        taken = sorted((a, b) for _, a, b in base[i])
        edge = np.flatnonzero(np.append(True, (kind[1:] != kind[:-1]) | ((tag[1:] % 2 == 1) & (tag[1:] > 0))))
        for a, b in zip(edge.tolist(), [*edge[1:].tolist(), size]):
            if not kind[a]:
                continue
            piece = text[a + low : b + low]
            a, b = a + low + len(piece) - len(piece.lstrip()), b + low - len(piece) + len(piece.rstrip())
            if b - a < 6 or certain[a - low : b - low].min() < SURE:
                continue
            name = KINDS[kind[a - low] - 1]
            a, b = whole(name, text, a, b)
            if _plausible(name, text[a:b]) and not any(x < b and a < y for x, y in taken):
                out[i].append((name, a, b))
                taken.append((a, b))
    return out


def _plausible(kind: str, text: str) -> bool:
    """What any span of a kind must hold."""
    digits = sum(c in _DIGITS for c in text)
    if kind == "email":
        return "@" in text.strip("@") and "." in text
    if kind == "ip":
        return 4 <= digits <= 12 and text.count(".") == 3
    if kind == "card":
        return 16 <= digits <= 19 and luhn("".join(c for c in text if c in _DIGITS))
    return 8 <= digits <= 15


def spans_of(texts: list[str], tagger: Tagger | None) -> list[tuple[list, list]]:
    """(base spans, all spans) of each text, each by kind, then start."""
    base = [base_spans(t) for t in texts]
    more = added_spans(texts, base, tagger) if tagger else [[] for _ in texts]
    return [(b, sorted(b + m, key=lambda s: (KINDS.index(s[0]), s[1]))) for b, m in zip(base, more)]


def snippets_of(docs: DataFrame, key: str, text: str) -> list[str]:
    """Pieces of at most ``SNIPPETS`` texts or so, chosen by a hash of the key."""
    n = docs.count()
    if not n:
        return []
    share = F.pmod(F.xxhash64(F.col(key), F.lit(6)), F.lit(1 << 30)) < min(1 << 30, (1 << 30) * SNIPPETS // n)
    size = F.length(text)
    start = F.pmod(F.xxhash64(F.col(key), F.lit(7)), F.greatest(size - SNIPPET, F.lit(1))) + 1
    # A text's first address or number, if it has one, else any place.
    first = F.regexp_instr(F.col(text), F.lit("[0-9@]"))
    begin = F.when(first > 0, F.greatest(first - SNIPPET // 2, F.lit(1))).otherwise(start)
    chosen = docs.filter(share & F.col(text).isNotNull()).select(F.substring(text, begin.cast("int"), F.lit(SNIPPET)).alias("s"))
    return [r["s"] for r in chosen.limit(2 * SNIPPETS).collect() if len(r["s"]) >= 20]


def learn(docs: DataFrame, key: str = "doc_id", text: str = "text") -> Tagger:
    return train(snippets_of(docs, key, text))


def _joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def find_pii(docs: DataFrame, tagger: Tagger, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_email, n_ip, n_card, n_phone, base_sha256, spans): a narrow pass."""
    counts = [f"n_{k}" for k in KINDS]
    schema = f"{key} {docs.schema[key].dataType.simpleString()}, {', '.join(f'{c} long' for c in counts)}, base_sha256 string, spans string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = spans_of(texts_of(batch.column(text)), tagger)
            columns = [pa.array([sum(s[0] == k for s in b) for b, _ in found], pa.int64()) for k in KINDS]
            columns.append(pa.array([hashlib.sha256(_joined(b).encode()).hexdigest() for b, _ in found], pa.string()))
            columns.append(pa.array([_joined(a) for _, a in found], pa.string()))
            yield pa.RecordBatch.from_arrays([batch.column(key)] + columns, [key, *counts, "base_sha256", "spans"])

    return small_batches(docs).select(key, text).mapInArrow(run, schema)


def mask(text: str, spans: list[tuple[str, int, int]]) -> str:
    """``text`` with each span replaced by its kind; of overlapping ones the first."""
    out, done = [], 0
    for kind, a, b in sorted(spans, key=lambda s: (s[1], -s[2])):
        if a >= done:
            out += [text[done:a], f"[{kind.upper()}]"]
        done = max(done, b)
    return "".join(out) + text[done:]


def mask_pii(docs: DataFrame, tagger: Tagger, text: str = "text") -> DataFrame:
    """``docs`` with personal data replaced by its kind; null texts stay null."""
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(text).to_pylist()
            found = spans_of([t or "" for t in column], tagger)
            new = [t if t is None or not a else mask(t, a) for t, (_, a) in zip(column, found)]
            yield pa.RecordBatch.from_arrays([pa.array(new, pa.string()) if c == text else batch.column(c) for c in names], names)

    return small_batches(docs).mapInArrow(run, docs.schema)
