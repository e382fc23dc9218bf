"""Collocations and spelling variants against plain versions."""

import random
import re
import zlib
from collections import Counter
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest

from murmur.llm import phrases, rolling, spelling

SCHEMA = "doc_id long, text string, lang string, phrase string, word string"


def ascii_lower(text):
    return re.sub("[A-Z]+", lambda m: m[0].lower(), text or "")


def plain_counts(docs):
    counts, totals = Counter(), Counter()
    for _, text, lang in docs:
        for piece in re.split("[.,;:!?\n-\r]", ascii_lower(text)):
            words = [w for w in re.split("[ \t]", piece) if w]
            totals[lang or "und"] += len(words)
            for n in range(1, 5):
                counts.update((lang or "und", tuple(words[i : i + n])) for i in range(len(words) - n + 1))
    return counts, totals


def plain_collocations(docs, least=30, share=80, top=2000):
    counts, totals = plain_counts(docs)
    f = {k: n for k, n in counts.items() if n >= least}
    found = {}
    for (lang, words), a in f.items():
        if len(words) > 1:
            cuts = []
            for k in range(1, len(words)):
                l, r = f[lang, words[:k]], f[lang, words[k:]]
                cuts.append((int(Fraction(2000000 * a, l + r)), k, l, r))
            found[lang, words] = (a, *min(cuts))
    out = []
    for lang in {k[0] for k in found}:
        kept = []
        for (own, words), (a, score, _, l, r) in found.items():
            if own != lang:
                continue
            inside = any(
                o == lang and len(w) > len(words) and 100 * b[0] >= share * a and any(w[i : i + len(words)] == words for i in range(len(w)))
                for (o, w), b in found.items()
            )
            if not inside:
                kept.append((-score, -a, " ".join(words).encode(), l, r))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(kept)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, l, r, totals[lang], -score))
    return sorted(out)


def found_collocations(spark, docs, **settings):
    df = spark.createDataFrame([(*d, "x", "y") for d in docs], "doc_id long, text string, lang string, rank string, n string")
    return sorted(tuple(r) for r in phrases.collocations(df.repartition(3), **settings).collect())


@pytest.mark.parametrize("seed", [1, 2])
def test_collocations_like_a_plain_count(spark, seed):
    rng = random.Random(seed)
    vocabulary = ["Ab", "ab", "é", "É", "c", "dd", "e-e", "f'", "ｇ", "h i", "j"]
    docs = []
    for i in range(150):
        words = [rng.choice(vocabulary[: rng.choice([3, 11])]) + rng.choice(["", "", "", ".", ", ", "\n"]) for _ in range(rng.randint(0, 60))]
        docs.append((i, rng.choice([" ", "  ", " \t"]).join(words), rng.choice(["en", "de", None])))
    docs += [(1, "same row again, same row again", "en")] * 20 + [(None, None, "fr"), (7, "", None)]
    want = plain_collocations(docs, 5, 80, 40)
    assert len(want) > 60
    assert found_collocations(spark, docs, least=5, top=40) == want


def test_collocations_of_odd_and_empty_tables(spark, odd_docs, no_docs):
    rows = odd_docs.select("doc_id", "text", "lang").collect()
    assert sorted(tuple(r) for r in phrases.collocations(odd_docs, least=2).collect()) == plain_collocations([tuple(r) for r in rows], 2)
    assert phrases.collocations(no_docs).collect() == []


def test_scores_beyond_64_bits(spark):
    big = 3 * 10**18
    rows = [("en", "a", big), ("en", "b", big), ("en", "a b", big - 1), ("en", "c", big), ("en", "b c", big // 5 * 4 - 1), ("en", "a b c", big // 5 * 4 - 1)]
    counts = spark.createDataFrame(rows, "lang string, phrase string, f long")
    found = phrases.scored(counts)
    got = {r.phrase: (r.a, r.l, r.r, r.score) for r in found.collect()}
    for phrase, l, r in (("a b", big, big), ("b c", big, big), ("a b c", big - 1, big)):
        a = dict((p, f) for _, p, f in rows)[phrase]
        assert got[phrase] == (a, l, r, 2000000 * a // (l + r))
    # "a b" has 80 % of its count, less a little, inside the longer phrase; "b c" has all.
    assert {r.phrase for r in phrases.standing(found, 80).collect()} == {"a b", "a b c"}


def runs(texts, langs=None):
    batch = pa.RecordBatch.from_arrays([pa.array(texts, pa.string()), pa.array(langs or ["en"] * len(texts), pa.string())], ["text", "lang"])
    return list(phrases.runs_of(iter([batch])))


def counts_of_runs(made, n):
    """Counts by text, the way tasks count them."""
    out = Counter()
    for words, langs in made:
        numbers, example = phrases.exact_numbers(words)
        at, prints = words.grams(n, words.own)
        pointers, counts = phrases.verified(numbers, words.name, at, prints, n)
        raw = words.data.tobytes()
        for p, c in zip(pointers.tolist(), counts.tolist()):
            out[langs[words.name[p]], tuple(raw[words.start[i] : words.end[i]].decode() for i in range(p, p + n))] += c
    return out


@pytest.mark.parametrize("weak", [False, True])
def test_blocks_and_equal_fingerprints(monkeypatch, weak):
    """Long texts in small blocks, and fingerprints that often collide."""
    monkeypatch.setattr(phrases, "CHUNK", 50)
    monkeypatch.setattr(phrases, "RUN", 100)
    if weak:
        monkeypatch.setattr(rolling, "mixed", lambda x: x % np.uint64(7))
    rng = random.Random(5)
    texts = ["".join(rng.choice(["a", "b", "éé", " ", " ", "\t", ".", "c" * 70]) for _ in range(400)) for _ in range(12)] + ["", "x" * 900]
    langs = [rng.choice(["en", "de"]) for _ in texts]
    want, _ = plain_counts([(0, t, l) for t, l in zip(texts, langs)])
    made = runs(texts, langs)
    assert len(made) > 3
    for n in range(1, 5):
        assert counts_of_runs(made, n) == {k: v for k, v in want.items() if len(k[1]) == n}


def test_a_fingerprint_does_not_depend_on_the_place():
    values = np.arange(1, 40, dtype=np.uint64)
    twice = np.concatenate([values, values])
    prefix = rolling.prefixes(twice)
    starts = np.arange(0, 30)
    assert (rolling.runs(prefix, starts, starts + 7) == rolling.runs(prefix, starts + 39, starts + 46)).all()
    assert len(set(rolling.runs(prefix, starts, starts + 7).tolist())) == 30


def test_filters_hold_all_that_was_put_in(spark):
    rng = np.random.default_rng(3)
    own = rng.integers(-(2**63), 2**63, 20_000)
    df = spark.createDataFrame([(int(x),) for x in own], "fingerprint long").repartition(3)
    made = phrases.filter_of(df, len(own))
    assert made.has(own.view(np.uint64)).all()
    assert made.has(rng.integers(0, 2**63, 100_000).astype(np.uint64)).mean() < 0.02
    assert not phrases.filter_of(df.limit(0), 0).has(own.view(np.uint64)).any()


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) > len(b):
        a, b = b, a
    i = next((i for i in range(len(a)) if a[i] != b[i]), len(a))
    return a[i + (len(a) == len(b)) :] == b[i + 1 :]


def plain_variants(docs, least=3):
    counts = Counter()
    for key, text in docs:
        for run in re.findall("[a-zÀ-ÿ]+", ascii_lower(text)):
            h = zlib.crc32(f"{'null' if key is None else key}:{run}".encode())
            counts[run[: h % len(run)] + run[h % len(run) + 1 :] if h % 97 == 0 else run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 5 and n >= least}
    near = {w: sorted((-m, x) for x, m in words.items() if one_edit(w, x)) for w in words}
    form = {w: near[w][0][1] if near[w] and -near[w][0][0] >= 2 * words[w] else None for w in words}

    def root(w):
        while form[w]:
            w = form[w]
        return w

    return sorted((w, form[w], root(w), n, len(near[w]), words[form[w]] if form[w] else None) for w, n in words.items())


def found_variants(spark, docs):
    df = spark.createDataFrame([(*d, "x", "y", 1) for d in docs], "doc_id long, text string, word string, root string, n long")
    return sorted((tuple(r) for r in spelling.spelling_variants(df.repartition(3)).collect()))


def changed(rng, word, letters):
    i = rng.randrange(len(word) + 1)
    return rng.choice([word[:i] + rng.choice(letters) + word[i:], word[:i] + word[i + 1 :], word[:i] + rng.choice(letters) + word[i + 1 :]])


def test_variants_like_brute_force(spark):
    """Words of few letters, so that each has many neighbours, and edits anywhere."""
    rng = random.Random(7)
    words = ["".join(rng.choice("aab×é") for _ in range(rng.randint(4, 8))) for _ in range(120)]
    for w in list(words):
        words += [changed(rng, w, "abÿ÷z") for _ in range(3)]
    docs = [(rng.choice([None, 1, 2, 3, 2**40]), rng.choice([" ", "1", "_"]).join(rng.choice(words).upper() if rng.random() < 0.3 else rng.choice(words) for _ in range(60))) for _ in range(120)]
    docs += [(5, None), (6, ""), (7, "ab cd"), (8, "ŁŁŁŁŁŁ ŁŁŁŁŁŁ ŁŁŁŁŁŁ")]
    want = plain_variants(docs)
    assert sum(r[4] for r in want) > 500 and any(r[1] != r[2] for r in want if r[1])
    assert found_variants(spark, docs) == want


def test_very_long_words(spark):
    """Around the depth of the trie and far beyond it."""
    rng = random.Random(8)
    texts = []
    for length in (30, 31, 32, 33, 34, 60, 3000):
        word = "".join(rng.choice("abcé") for _ in range(length))
        for _ in range(3):
            texts.append(changed(rng, word, "abcé"))
        texts += [word, word + "x", "y" + word, "a" * length, "a" * length + "b"]
    docs = [(i, " ".join([t] * rng.randint(3, 9))) for i, t in enumerate(texts)]
    want = plain_variants(docs)
    assert sum(r[4] for r in want if len(r[0]) > 32) > 20
    assert found_variants(spark, docs) == want


def test_long_chains_of_forms(spark):
    """Each word twice as frequent as the one before it."""
    docs = [(None, " ".join(["abcde" + "f" * i] * (3 * 2**i))) for i in range(9)]
    got = {r[0]: r for r in found_variants(spark, docs)}
    want = {r[0]: r for r in plain_variants(docs)}
    assert got == want
    assert len({r[2] for r in got.values()}) < 4


def test_variants_of_odd_and_empty_tables(spark, odd_docs, no_docs):
    rows = [(r.doc_id, r.text) for r in odd_docs.select("doc_id", "text").collect()]
    assert sorted(tuple(r) for r in spelling.spelling_variants(odd_docs).collect()) == plain_variants(rows)
    assert spelling.spelling_variants(no_docs).collect() == []
