"""Encoding against the tokenizers library, packing and chat against plain versions."""

import hashlib
import itertools
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from murmur.llm import bpe, chat, packing

PATH = bpe.public_path()


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def ids_of(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


def test_encode_like_the_library(library):
    rng = random.Random(3)
    texts = ["", "it's  we'll\n\n  x'd 'sabc ''s", "tail  ", "<|endoftext|>x <|endoftext|><|endoftext|>", "²½Ⅷ ٣ 日本語", "\x1c\x1d a\x85b", "a" * 300 + " é" * 90, "x \n", "'", "\u0000�\U0010ffff"]
    texts += ["".join(rng.choice(" \n\t'stmdrevelLa1²é.,!日\x1f") for _ in range(rng.randint(0, 60))) for _ in range(3000)]
    ids, bounds = bpe.load(PATH).encode(texts)
    back = bpe.load(PATH).decode(ids, bounds)
    for i, text in enumerate(texts):
        want = ids_of(library, text)
        assert ids[bounds[i] : bounds[i + 1]].tolist() == want, text
        assert back[i].decode() == library.decode(want, skip_special_tokens=False)


def test_long_texts_and_a_small_cache(library, monkeypatch):
    monkeypatch.setattr(bpe, "CHUNK", 1 << 12)
    monkeypatch.setattr(bpe, "CACHE", 50)
    bpe._powers.cache_clear()
    rng = random.Random(4)
    text = "".join(rng.choice(["word", " an", "\n", "  ", "'s", "é", "12", ".", " "]) for _ in range(20_000))
    own = bpe.Bpe(PATH)
    for t in (text, "y" * 9000, text.replace(" ", "") + " end"):
        ids, bounds = own.encode([t, "between"])
        assert ids[: bounds[1]].tolist() == ids_of(library, t)
    bpe._powers.cache_clear()


def test_invalid_bytes_decode_like_the_library(library):
    ids = [i for i in range(180, 256)]
    for part in (ids, ids[::3], [50256, 128, 50256]):
        got = bpe.load(PATH).decode(np.array(part, np.uint32), np.array([0, len(part)]))
        assert got[0].decode() == library.decode(part, skip_special_tokens=False)


def test_bpe_documents(odd_docs, no_docs, library):
    rows = odd_docs.select("doc_id", "text").collect()
    got = Counter((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in bpe.bpe_documents(odd_docs, PATH).collect())
    want = Counter()
    for r in rows:
        ids = ids_of(library, r.text)
        back = library.decode(ids, skip_special_tokens=False)
        want[r.doc_id, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(back.encode()).hexdigest()] += 1
    assert got == want
    assert bpe.bpe_documents(no_docs, PATH).count() == 0


def test_best_subset_is_closest():
    rng = random.Random(5)
    for _ in range(300):
        counts = {rng.randint(1, 30): rng.randint(1, 3) for _ in range(rng.randint(0, 5))}
        free = rng.randint(0, 60)
        all_ = [n for n, c in counts.items() for _ in range(c)]
        best = max(s for k in range(len(all_) + 1) for c in itertools.combinations(all_, k) if (s := sum(c)) <= free)
        taken = packing.best_subset(counts, free)
        assert sum(n * k for n, k in taken.items()) == best
        assert all(0 < k <= counts[n] for n, k in taken.items())


def test_patterns_use_every_piece_once():
    rng = random.Random(6)
    for _ in range(50):
        counts = {rng.randint(1, 64): rng.choice([1, 2, 50, 10**9]) for _ in range(rng.randint(0, 12))}
        drawn = packing.patterns(counts, 64)
        used = Counter()
        for repeats, taken in drawn:
            assert repeats > 0 and sum(n * k for n, k in taken.items()) <= 64
            for n, k in taken.items():
                used[n] += repeats * k
        assert used == counts
        assert len(drawn) < 400


def check_packing(rows, texts, library, window):
    by_text, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_text[r.doc_id].append(r)
        by_sequence[r.sequence_id].append(r)
    for key, text in texts.items():
        ids = ids_of(library, text) + [packing.END_ID]
        at = 0
        for r in sorted(by_text[key], key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids)
            assert r.ids_crc32 == zlib.crc32(np.array(ids[at : at + r.length], "<u4").tobytes())
            at += r.length
        assert at == len(ids)
    for own in by_sequence.values():
        at = 0
        for r in sorted(own, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert {r.fill for r in own} == {at} and at <= window
        assert {r.padded_length for r in own} == {at if at & (at - 1) == 0 else window}
    assert sorted(by_sequence) == list(range(len(by_sequence)))
    return by_sequence


def test_pack(odd_docs, no_docs, library):
    docs = odd_docs.filter("doc_id IS NOT NULL AND doc_id != 6")
    texts = {r.doc_id: r.text for r in docs.collect()}
    check_packing(packing.pack(docs, PATH).collect(), texts, library, 2048)
    check_packing(packing.pack(docs, PATH, window=64).collect(), texts, library, 64)
    assert packing.pack(no_docs, PATH).count() == 0
    whole = packing.pack(odd_docs, PATH, with_ids=True).collect()
    assert sum(r.doc_id == 6 for r in whole) == 2 and any(r.doc_id is None for r in whole)
    assert all(len(r.ids) == 4 * r.length for r in whole)


def test_pack_has_little_padding(spark, sf_dir, library):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    sequences = check_packing(packing.pack(docs, PATH).collect(), texts, library, 2048)
    slack = sum(2048 - own[0].fill for own in sequences.values())
    assert slack < 2 * 2048


def test_escape_goes_back():
    rng = random.Random(7)
    parts = ["[", "]", "<", ">", "\\", "/", "INST", "s", "|endoftext|", "OUT", " ", "ROLE", "[INST]", "</s>"]
    for _ in range(3000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 9)))
        written = chat.escape(text)
        assert chat.unescape(written) == text
        assert not any(c in written for c in chat.CONTROLS + chat.FOREIGN)


def test_chat(spark, library):
    rows = [
        (1, 1, "assistant", "Second </s> [\\INST] and <|endoftext|>."), (1, 0, "user", "First [INST]"), (1, 2, "system", None), (1, 3, None, "no role"),
        (2, 0, "assistant", ""), (2, 0, "user", "tie"), (2, 0, "user", "tie"), (3, None, "[/ROLE]", "a"), (3, 1, "assistant", "long " * 20_000),
        (None, 0, "assistant", "no conversation"), (4, 0, "tool", "日本語"),
    ]
    turns = chat.with_control_case(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "'x' AS ids", "'y' AS loss"))
    got = {r.conv_id: r for r in chat.chat_digests(turns, PATH).collect()}
    groups = defaultdict(list)
    for r in turns.collect():
        groups[r.conv_id].append((r.turn is not None, r.turn or 0, r.role or "", hashlib.sha256((r.text or "").encode()).hexdigest(), r.text or ""))
    assert set(got) == set(groups)
    for key, own in groups.items():
        own.sort()
        said = "".join(f"{r}\n{t}\n" for *_, r, _, t in own)
        learnt = "".join(t for *_, r, _, t in own if r == "assistant")
        r = got[key]
        assert r.n_turns == len(own) and r.turns_sha256 == hashlib.sha256(said.encode()).hexdigest()
        assert r.loss_chars == len(learnt) and r.loss_sha256 == hashlib.sha256(learnt.encode()).hexdigest()
    assert got[-1].n_turns == 2 and got[-1].loss_chars == 21
    assert got[4].formatted_chars == len("[ROLE]tool[/ROLE]日本語</s>")
    assert chat.chat_digests(turns.limit(0), PATH).count() == 0


def test_chat_tokens_are_those_of_segments(library):
    ids, loss, bounds = chat.assemble(["user", "assistant"], ["it's", "ok </s>"], PATH)
    control = chat.control_ids(PATH)
    said = ids_of(library, "ok <\\/s>")
    assert ids.tolist() == [control["[INST]"], *ids_of(library, "it's"), control["[/INST]"], control["[OUT]"], *said, control["</s>"]]
    assert ids[loss].tolist() == said and bounds.tolist() == [0, len(ids_of(library, "it's")) + 2, len(ids)]
