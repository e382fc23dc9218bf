"""The corpus pipeline against brute force, stage by stage on each stage's own input."""

import random
import re

import pytest
import xxhash
from tokenizers import Tokenizer

import corpus_pipeline
from murmur.llm import bpe, packing, simhash
from murmur.llm.frames import placed
from murmur.session import materialize

STAGES = dict(corpus_pipeline.STAGES)


def plain_fingerprint(text):
    """The fingerprint of 3-word shingles, bit by bit."""
    words = [w for w in re.split("[ \t-\r]+", re.sub("[A-Z]+", lambda m: m[0].lower(), text or "")) if w]
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i : i + 3]).encode(), 42) for i in range(max(1, len(words) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def survivors(docs):
    """The places of the first rows, by (no id, id), of groups linked by 3 bits or fewer."""
    order = sorted(range(len(docs)), key=lambda i: (docs[i][0] is None, docs[i][0] or 0))
    prints = [plain_fingerprint(docs[i][1]) for i in order]
    root = list(range(len(order)))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for i, a in enumerate(prints):
        for j, b in enumerate(prints[:i]):
            if (a ^ b).bit_count() <= 3:
                p, q = find(i), find(j)
                root[max(p, q)] = min(p, q)
    return sorted(order[k] for k in range(len(order)) if find(k) == k)


def test_stages_on_test_data(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    assert list(STAGES) == ["language", "near_duplicates", "personal_data", "packing"]
    columns, seen = docs.columns, [docs]
    for name, stage in corpus_pipeline.STAGES:
        seen.append(materialize(stage(spark, seen[-1], sf_dir)))
        if name != "packing":
            assert seen[-1].columns == columns
    ids = [{r.doc_id: r.text for r in d.collect()} for d in seen[:4]]
    assert set(ids[1]) == set(ids[0])  # all prose of known languages
    rows = list(ids[1].items())
    assert set(ids[2]) == {rows[i][0] for i in survivors(rows)}
    assert set(ids[3]) == set(ids[2])
    for key, text in ids[3].items():
        if text != ids[2][key]:
            plain = re.split(r"\[(?:EMAIL|IP|CARD|PHONE)\]", text)
            assert len(plain) > 1 and all(p in ids[2][key] for p in plain)
        assert "@" not in text or "@" in text.replace("@mail", "")
    library = Tokenizer.from_file(bpe.public_path())
    tokens = sum(len(library.encode(t, add_special_tokens=False).ids) + 1 for t in ids[3].values())
    pieces = seen[4].collect()
    assert sum(r.length for r in pieces) == tokens
    assert all(r.length <= packing.WINDOW for r in pieces)
    assert sorted(map(tuple, corpus_pipeline.run(spark, sf_dir).select("doc_id", "start", "length", "ids_crc32").collect())) == sorted(
        (r.doc_id, r.start, r.length, r.ids_crc32) for r in pieces
    )


@pytest.mark.parametrize("name", list(STAGES))
def test_stages_on_odd_and_empty_tables(spark, odd_docs, no_docs, sf_dir, name):
    out = STAGES[name](spark, odd_docs, sf_dir)
    rows = out.collect()
    if name != "packing":
        assert out.columns == odd_docs.columns
        assert all(r.fingerprint == "clash" for r in rows)
    ids = sorted((r.doc_id is None, r.doc_id) for r in rows)
    if name == "near_duplicates":
        # 6 is a copy of 1, and there twice; 2, 3 and 8 have no words.
        assert [i for _, i in ids] == [1, 2, 4, 5, 9, None]
    if name == "language":
        assert not {2, 3, 8} & {i for _, i in ids}
    if name == "personal_data":
        assert len(rows) == odd_docs.count()
    assert STAGES[name](spark, no_docs, sf_dir).count() == 0


def kept_of(spark, docs):
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    order = lambda r: (r[0] is None, r[0] or 0, r[1] or "")
    return sorted((tuple(r) for r in simhash.drop_near_duplicates(df).collect()), key=order)


def test_near_copies_go_and_others_stay(spark):
    rng = random.Random(11)
    vocabulary = ["".join(rng.choice("abcdefghilmnoprstuv") for _ in range(rng.randint(2, 9))) for _ in range(2000)]
    docs = []
    for base in range(60):
        words = [rng.choice(vocabulary) for _ in range(rng.choice([40, 150, 600]))]
        for _ in range(rng.choice([1, 1, 2, 8])):
            own = list(words)
            for _ in range(max(1, len(own) // rng.choice([60, 100, 200]))):
                own[rng.randrange(len(own))] = rng.choice(vocabulary)
            docs.append((len(docs), " ".join(own)))
    docs += [(len(docs), docs[5][1]), (len(docs) + 1, docs[7][1].upper() + " \n")]
    want = survivors(docs)
    assert 60 <= len(want) < len(docs) - 2
    assert kept_of(spark, docs) == [docs[i] for i in want]


def test_a_group_of_thousands_leaves_one(spark):
    """Many copies and near copies of one long text."""
    rng = random.Random(12)
    words = [f"w{rng.randrange(5000)}" for _ in range(3000)]
    docs = []
    for i in range(1200):
        own = list(words)
        own[rng.randrange(3000)] = f"x{rng.randrange(40)}"
        docs.append((i, " ".join(own)))
    assert kept_of(spark, docs) == [docs[i] for i in survivors(docs)]


def test_repeated_and_missing_ids_are_rows_of_their_own(spark):
    one, two = "the first text of these rows, which is there more than once", "another text that is there only once"
    docs = [(3, one), (5, one), (5, two), (None, one), (None, one), (7, "a third"), (None, "a third"), (None, "nobody's"), (None, "nobody's")]
    assert kept_of(spark, docs) == [(3, one), (5, two), (7, "a third"), (None, "nobody's")]
    assert kept_of(spark, [(1, None)] * 40 + [(2, "")] * 40) == [(1, None)]


def test_one_id_on_a_third_of_all_rows(spark):
    docs = [(1, f"text number {i} of this id, and no copy: {i * i} {i * 7919}") for i in range(200)]
    docs += [(i + 10, f"row {i} has {i * 104729} beside it") for i in range(400)]
    assert len(kept_of(spark, docs)) == len(survivors(docs))


def test_rows_of_files_are_read_where_they_lie(spark, tmp_path):
    docs = [(i % 7, f"text {i // 2} in a file of its own kind") for i in range(60)]
    spark.createDataFrame(docs, "doc_id long, text string").repartition(3).write.parquet(str(tmp_path / "docs"))
    files = spark.read.parquet(str(tmp_path / "docs"))
    assert "_metadata" in placed(files)._jdf.queryExecution().analyzed().toString()
    kept = simhash.drop_near_duplicates(files)
    assert kept.columns == ["doc_id", "text"]
    assert len(kept.collect()) == len(survivors(docs))
