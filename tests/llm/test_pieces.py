"""SentencePiece encoding and decoding against the sentencepiece library."""

import hashlib
import random

import pytest

from murmur.llm import pieces

PATH = pieces.public_path()
ODD = ["", " ", "  a ", "▁▁a▁", "<s> <0x41> </s>", "\x00\x00", "日本語🙂", "a" * 5000, " " * 777, "x " * 100, " 　 é", "▁", "\t\n  \r", "².²x", "﻿á"]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


@pytest.fixture(scope="module")
def library():
    return pieces.library_of(PATH)


def expected(library, text):
    ids = library.encode(text or "")
    return len(ids), sha(",".join(map(str, ids))), sha(library.decode(ids))


def test_encode_and_decode_like_the_library(library):
    rng = random.Random(1)
    own = pieces.load(PATH)
    texts = ODD + ["".join(rng.choice(" \n\t'stmdrevelLa1²é.,!日\x1f▁  thein") for _ in range(rng.randint(0, 80))) for _ in range(3000)]
    for text in texts:
        ids = own.encode(text)
        assert ids == library.encode(text), text
        assert own.decode(ids) == library.decode(ids), text
        assert own.digest(text) == expected(library, text)


def test_one_agenda_for_a_whole_text_gives_the_same(library):
    own = pieces.Pieces(PATH)
    text = "Whole text, as one word:  no cuts, 3 blanks   here.\nAnd ²½ signs…"
    marked = pieces.SPACE + text.replace(" ", pieces.SPACE)
    assert own.ids_of(own.merge(marked)) == library.encode(text)


def test_a_full_cache_is_emptied(library, monkeypatch):
    monkeypatch.setattr(pieces, "CACHE", 20)
    own = pieces.Pieces(PATH)
    text = " ".join(f"word{i} anders{i % 7}" for i in range(300))
    for _ in range(2):
        assert own.digest(text) == expected(library, text)
        assert len(own.cache) <= 20


def test_any_ids_decode_like_the_library(library):
    rng = random.Random(2)
    own = pieces.load(PATH)
    for _ in range(3000):
        ids = [rng.choice([0, 1, 2, rng.randint(3, 258), rng.randint(3, 31999), 28705, 259]) for _ in range(rng.randint(0, 8))]
        assert own.decode(ids) == library.decode(ids), ids


def test_piece_documents(spark, odd_docs, no_docs, library, sf_dir):
    for docs in (odd_docs, spark.read.parquet(f"{sf_dir}/documents.parquet")):
        found = pieces.piece_documents(docs, PATH, with_ids=True).collect()
        want = [(r.doc_id, *expected(library, r.text)) for r in docs.select("doc_id", "text").collect()]
        order = lambda r: (r[0] is None, r[0] or 0, r[2])
        assert sorted((tuple(r)[:4] for r in found), key=order) == sorted(want, key=order)
        assert all(len(r.ids) == r.n_tokens for r in found)
        assert pieces.mismatches(docs, PATH).count() == 0
    assert pieces.piece_documents(no_docs, PATH).count() == 0
