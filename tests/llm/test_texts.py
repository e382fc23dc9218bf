"""Fingerprints, languages, personal data, secrets and shards against plain versions."""

import hashlib
import itertools
import math
import random
import re
import unicodedata
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash

from murmur.llm import langid, pii, secrets, sharding, simhash
from murmur.llm.bilstm import Tagger


def plain_fingerprint(text, words=3):
    found = re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not found:
        return 0
    shingles = [" ".join(found[i : i + words]) for i in range(max(1, len(found) - words + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(keys, prints, radius=3):
    root = list(range(len(keys)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(keys)):
        for j in range(i):
            if bin(prints[i] ^ prints[j]).count("1") <= radius:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    least = {}
    for i, k in enumerate(keys):
        if k is not None:
            least[find(i)] = min(least.get(find(i), k), k)
    return [least.get(find(i)) for i in range(len(keys))]


def test_fingerprints_and_components(odd_docs, no_docs):
    rows = odd_docs.select("doc_id", "text").collect()
    prints = [plain_fingerprint(r.text) for r in rows]
    want = sorted(zip([r.doc_id for r in rows], [f"{p:016x}" for p in prints], plain_components([r.doc_id for r in rows], prints)), key=str)
    found = simhash.near_duplicates(odd_docs).select("doc_id", simhash.hex_of("fingerprint").alias("h"), "component_id")
    assert sorted(map(tuple, found.collect()), key=str) == want
    assert simhash.near_duplicates(no_docs).count() == 0


@pytest.mark.parametrize("radius", [0, 1, 2, 3])
def test_links_connect_all_within_the_radius(spark, radius):
    rng = random.Random(radius)
    prints = {0, (1 << 64) - 1}
    for _ in range(12):
        centre = rng.getrandbits(64)
        for _ in range(rng.choice([2, 5, 30])):
            p = centre
            for b in rng.sample(range(64), rng.randint(0, 5)):
                p ^= 1 << b
            prints.add(p)
    prints = sorted(prints)
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    links = simhash.ball_links(spark.createDataFrame([(s,) for s in signed], "fingerprint long"), len(prints), radius).collect()
    root = {s: s for s in signed}

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    for r in links:
        assert bin((r.a ^ r.b) & (1 << 64) - 1).count("1") <= radius
        root[find(r.a)] = find(r.b)
    want = plain_components(list(range(len(prints))), prints, radius)
    assert len(set(want)) == len({find(s) for s in signed})


def test_links_of_a_large_group_stay_few(spark):
    """Thousands of near copies: far fewer links than pairs."""
    rng = random.Random(1)
    base = rng.getrandbits(63)
    prints = sorted({base ^ (1 << a) ^ (1 << b) for a in range(63) for b in range(63)})
    links = simhash.ball_links(spark.createDataFrame([(p,) for p in prints], "fingerprint long"), len(prints), 3)
    assert links.distinct().count() < 70 * len(prints)


@pytest.mark.parametrize("radius,groups", [(0, 0), (1, 1), (2, 5), (3, 7), (3, 20)])
def test_a_fingerprint_travels_once_to_each_bucket_of_its_variants(spark, radius, groups):
    rng = random.Random(groups)
    prints = [0, 1, (1 << 64) - 1, 1 << 63, *(rng.getrandbits(64) for _ in range(40))]
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    masks = simhash.bit_groups(groups)
    assert len(masks) == groups and sum(masks) == sum(set(masks)) < 1 << 64
    even, odd = simhash.flips(radius)
    rows = simhash.sent(spark.createDataFrame([(s,) for s in signed], "fingerprint long"), masks, even, odd).collect()
    want = set()
    for p, s in zip(prints, signed):
        for flip in (odd if bin(p).count("1") % 2 else even).tolist():
            want.add((sum(bin((p ^ flip) & m).count("1") % 2 << k for k, m in enumerate(masks)), s))
    assert sorted(map(tuple, rows)) == sorted(want)
    # With 7 groups 8 rows for an even one, 17 for an odd one, instead of 65 and 1,057 variants.
    assert len(rows) <= len(prints) * (1 + groups + groups * groups // 4)


def test_what_is_sent_for_links_is_rows_of_fingerprints(spark):
    prints = spark.createDataFrame([(i * 7919,) for i in range(500)], "fingerprint long")
    links = simhash.ball_links(prints, 500_000, 3)
    plan = links._jdf.queryExecution().optimizedPlan()
    assert "binary" not in plan.toString() and "variants" not in plan.toString() and "MapInArrow" not in plan.toString()
    assert [f.name for f in links.schema] == ["a", "b"]


@pytest.mark.parametrize("count", [1, 500, 500_000, 50_000_000])
def test_links_do_not_depend_on_the_number_of_groups(spark, count):
    rng = random.Random(3)
    centre = [rng.getrandbits(63) for _ in range(30)]
    prints = sorted({c ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) for c in centre for _ in range(4)} | {0})
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    found = {(r.a, r.b) for r in simhash.ball_links(spark.createDataFrame([(s,) for s in signed], "fingerprint long"), count, 3).collect()}
    root = {s: s for s in signed}

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    for a, b in found:
        assert a < b and bin((a ^ b) & (1 << 64) - 1).count("1") <= 3
        root[find(a)] = find(b)
    assert len({find(s) for s in signed}) == len(set(plain_components(list(range(len(prints))), prints, 3)))


def test_languages(spark, sf_dir, odd_docs, no_docs):
    docs = spark.read.parquet(f"{sf_dir.replace('0.001', '0.01')}/documents.parquet")
    found = {r.doc_id: r for r in langid.languages(docs).collect()}
    rows = docs.select("doc_id", "lang").collect()
    assert len(found) == len(rows)
    held = [r for r in rows if zlib.crc32(str(r.doc_id).encode()) % 4 == 2]
    assert {r.doc_id for r in held} == {k for k, r in found.items() if r.held_out}
    assert np.mean([found[r.doc_id].lang_pred == r.lang for r in held]) > 0.97
    assert all(0 <= r.score <= 1 for r in found.values())
    assert np.mean([r.accepted for r in found.values()]) > 0.995
    odd = langid.languages(odd_docs).collect()
    assert len(odd) == odd_docs.count()
    assert {r.lang_pred for r in odd if r.doc_id in (2, 3, 8)} == {"und"}
    assert {r.lang_pred for r in odd} <= {"und", "en", "de"}
    assert langid.languages(no_docs).count() == 0


def test_predictions_use_the_text_alone(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = langid.learn(docs)
    a = langid.identify(docs, model).select("lang_pred", "score").collect()
    b = langid.identify(docs.selectExpr("doc_id", "text", "'zz' AS lang", "'q' AS source"), model).select("lang_pred", "score").collect()
    assert a == b
    odd = model.predict(["1234 5678 !!", "qxzj kqwv xzzq vjkq " * 40, "the and of thing there is"])
    assert odd[0] == ("und", 0.0, False) and not odd[1][2]


PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain_pii(text):
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            if kind == "ip" and any(int(p) > 255 for p in m[0].split(".")):
                continue
            if kind == "card":
                doubled = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
                if not 16 <= len(digits) <= 19 or sum(d - 9 * (d > 9) for d in doubled) % 10:
                    continue
            if kind == "phone" and not 8 <= len(digits) <= 15:
                continue
            out.append((kind, *m.span()))
    return out


def test_base_spans_like_the_patterns():
    rng = random.Random(8)
    parts = ["a", "b.c", "@", "x-y", ".com", ".", "1", "12", "255", "300", "1.2.3.4", " ", "-", "+", "+1 ", "(499) ", "4713332104704538", "4713 3321 0470 4538", "é", "%", "a@b.c", "\n"]
    for _ in range(30_000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 12)))
        assert pii.base_spans(text) == plain_pii(text), text


def test_base_spans_of_long_runs_are_linear():
    for text in ("1" * 200_000, "a" * 200_000 + "@", "a@" * 50_000, "1." * 100_000, "+1 " * 50_000, "1 " * 100_000):
        pii.base_spans(text)


@pytest.fixture(scope="module")
def tagger():
    return pii.train(["the words of a text that goes on for some time, with a number or two in it " * 3])


def test_gradients():
    rng = np.random.default_rng(0)
    t = Tagger.fresh(pii.SIGNS, pii._allowed())
    signs, tags = pii.labelled([], 3, 1)
    signs, tags = signs[:, :12], tags[:, :12]
    tags[:, 0] = np.where(tags[:, 0] % 2 == 0, 0, tags[:, 0])
    for i in range(1, 12):
        bad = (tags[:, i] % 2 == 0) & (tags[:, i] > 0) & (tags[:, i - 1] != tags[:, i]) & (tags[:, i - 1] != tags[:, i] - 1)
        tags[bad, i] = 0
    for w in t.weights():
        w += rng.standard_normal(w.shape).astype(np.float32) * 0.05
    _, grads = t.gradients(signs, tags)
    for w, g in zip(t.weights(), grads):
        at = np.unravel_index(np.abs(g).argmax(), g.shape)
        kept = w[at]
        w[at] = kept + 1e-2
        up = t.gradients(signs, tags)[0]
        w[at] = kept - 1e-2
        down = t.gradients(signs, tags)[0]
        w[at] = kept
        assert (up - down) / 2e-2 == pytest.approx(g[at], rel=0.1, abs=5e-3)


def test_tagger_learns_on_held_out_windows(tagger):
    signs, tags = pii.labelled(["another text than before, which has its own words and some 12 numbers in it " * 3], 300, 77)
    found = tagger.decode(tagger.emissions(signs))
    assert (found == tags).mean() > 0.95


def test_added_spans(tagger):
    texts = [
        "Call (499) 555-6503 or 499-555-6503 soon, will you. " * 3, "Nothing here but 12 of 40 and 3.14 of it.",
        "words " * 500 + "write to jane.doe @ mail.example.org now " + "words " * 500, "", "x" * 50_000,
    ]
    found = pii.spans_of(texts, tagger)
    for text, (base, all_) in zip(texts, found):
        assert base == plain_pii(text) and set(base) <= set(all_)
        assert all(0 <= a < b <= len(text) for _, a, b in all_)
    assert len(found[0][1]) > 0 and found[1][1] == [] and found[3][1] == []
    assert pii.mask("a b@c.de f", [("email", 2, 8)]) == "a [EMAIL] f"
    assert pii.mask("0123456789", [("ip", 2, 6), ("card", 4, 8)]) == "01[IP]89"


def test_spans_beyond_the_windows_come_out_whole(tagger):
    name = "maximiliana.konstantinopolitana.vandenberghe"
    assert pii.whole("email", f"to {name} @ mail.example.org. And", len("to maximiliana.konsta"), len(f"to {name} @ mail.ex")) == (3, len(f"to {name} @ mail.example.org"))
    assert pii.whole("phone", "no 12345678 9", 5, 8) == (3, 11)
    text = f"words of some kind, write to {name} @ example.org now, " * 4
    spans = [s for s in pii.spans_of([text], tagger)[0][1] if s[0] == "email"]
    assert spans and all(text[a:].startswith(name) for _, a, _ in spans)
    assert "konstantino" not in pii.mask(text[: spans[0][2] + 1], spans[:1])


def test_digits_of_other_scripts_are_digits(tagger):
    plain = "Call (499) 555-6503 or write to jane.doe @ mail9.example.org soon, é. " * 3
    wide = "".join(chr(0xFF10 + int(c)) if c.isdigit() else "\uFF20" if c == "@" else c for c in plain)
    base = [[]]
    assert pii.plain_digits(wide) == plain and pii.plain_digits("٣²") == "3²"
    found = pii.added_spans([wide], base, tagger)
    assert found == pii.added_spans([plain], base, tagger) and found[0]


def test_a_text_in_many_windows_is_tagged_as_a_whole(tagger):
    """Padding in front moves all windows; the spans move with the text."""
    text = "Reach us: (499) 555-6503 today, or jane.doe @ mail.example.org tomorrow. "
    for gap in (0, 100, 1000):
        found = pii.spans_of(["words " * gap + text + "words " * gap], tagger)[0][1]
        assert [(k, a - 6 * gap, b - 6 * gap) for k, a, b in found] == pii.spans_of([text], tagger)[0][1]


def test_decoding_and_marginals_like_trying_all_paths(tagger):
    rng = np.random.default_rng(4)
    scores = rng.normal(size=(4, 3, 1 + 2 * len(pii.KINDS))) * 3
    tags, sure = tagger.decode(scores), tagger.marginals(scores)
    move = tagger.move + tagger.allowed
    paths = np.array(list(itertools.product(range(scores.shape[2]), repeat=4)))
    for k in range(3):
        value = tagger.allowed[0][paths[:, 0]] + sum(scores[i, k][paths[:, i]] for i in range(4))
        value = value + sum(move[paths[:, i], paths[:, i + 1]] for i in range(3))
        assert tags[k].tolist() == paths[value.argmax()].tolist()
        share = np.exp(value - value.max())
        for i in range(4):
            own = np.bincount(paths[:, i], share, scores.shape[2]) / share.sum()
            assert np.allclose(sure[i, k], own, atol=1e-6)


def test_pii_rows(odd_docs, no_docs, tagger):
    found = pii.find_pii(odd_docs, tagger).collect()
    assert len(found) == odd_docs.count()
    texts = {r.doc_id: r.text or "" for r in odd_docs.collect()}
    for r in found:
        base = plain_pii(texts[r.doc_id])
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s[0] == k for s in base) for k in pii.KINDS]
        assert r.base_sha256 == hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in base).encode()).hexdigest()
        assert {f"{k}:{a}:{b}" for k, a, b in base} <= set(r.spans.split(","))
    masked = {r.doc_id: r for r in pii.mask_pii(odd_docs, tagger).collect()}
    assert "[EMAIL]" in masked[None].text and "[PHONE]" in masked[None].text and masked[2].text is None
    assert masked[1].text == texts[1] and masked[1].score == "clash"
    assert pii.find_pii(no_docs, tagger).count() == 0
    assert pii.learn(no_docs) is not None


SECRETS = {
    "assign": (r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 12),
    "access": ("AKIA[A-Z0-9]+", 18),
    "hex": ("[0-9a-f]+", 16),
}


def plain_secrets(text):
    out = []
    for n, (kind, (pattern, least)) in enumerate(SECRETS.items()):
        for m in re.finditer(pattern, text, re.I | re.A if kind == "assign" else 0):
            if len(m[2] if kind == "assign" else m[0]) >= least:
                out.append((m.start(), n, kind, m.end()))
    return ",".join(f"{k}:{a}:{b}" for a, _, k, b in sorted(out)), len(out)


def test_secrets_like_the_patterns(spark, odd_docs, no_docs):
    rng = random.Random(9)
    parts = ["token", "Secret", "=", ": ", "'", "api_key", "APIKEY", "AKIA", "ABCDEFGH12", "0123456789abcdef", "abcdef", " ", "é", "\x01", "\x02", "日", "x.y=z", "password"]
    rows = [(i, "".join(rng.choice(parts) for _ in range(rng.randint(0, 14)))) for i in range(3000)]
    rows += [(3000, "token=abcdefghijklm " * 3000), (3001, None), (3002, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    texts = dict(rows)
    for r in secrets.find_secrets(docs).collect():
        joined, n = plain_secrets(texts[r.doc_id] or "")
        assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest(), texts[r.doc_id]
        assert r.n_assign + r.n_access + r.n_hex == n
        assert set(filter(None, joined.split(","))) <= set(r.spans.split(","))
    assert secrets.find_secrets(odd_docs).count() == odd_docs.count()
    assert secrets.find_secrets(no_docs).count() == 0


def test_random_tokens_are_found_among_natural_ones(spark):
    rng = random.Random(10)
    syllables = ["than", "er", "ing", "on", "the", "re", "ti", "sh", "ou", "ed"]
    signs = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
    rows, planted = [], 0
    for i in range(3000):
        text = " ".join("".join(rng.choice(syllables) for _ in range(8)) for _ in range(3))
        if i % 30 == 0:
            text += " " + "".join(rng.choice(signs) for _ in range(44)) + " end"
            planted += 1
        rows.append((i, text))
    found = secrets.find_secrets(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    texts = dict(rows)
    hits = {r.doc_id for r in found if r.n_random}
    assert len(hits) > 0.75 * planted and all(i % 30 == 0 for i in hits)
    for r in found:
        for span in filter(None, r.spans.split(",")):
            kind, a, b = span.split(":")
            if kind == "random":
                assert re.fullmatch("[A-Za-z0-9+/]{16,}", texts[r.doc_id][int(a) : int(b)])


def test_shards(spark, sf_dir, odd_docs, no_docs):
    docs = spark.read.parquet(f"{sf_dir.replace('0.001', '0.01')}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    found = sharding.shard_documents(docs).collect()
    assert len(found) == len(texts)
    by_shard = defaultdict(list)
    for r in found:
        raw = (texts[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(raw) + 8, zlib.crc32(raw), "bytes", None)
        by_shard[r.shard].append(r)
    assert sorted(by_shard) == list(range(24))
    loads = [sum(r.size for r in own) for own in by_shard.values()]
    assert max(loads) < 1.01 * min(loads)
    for own in by_shard.values():
        assert sorted(r.slot for r in own) == list(range(len(own)))
    odd = sharding.shard_documents(odd_docs).collect()
    assert len(odd) == odd_docs.count() and {r.size for r in odd if r.doc_id in (2, 3)} == {8}
    assert sharding.shard_documents(no_docs).count() == 0


def test_rebalance_moves_little_and_takes_a_new_shard(spark):
    slots = spark.range(512).selectExpr("CAST(id AS int) AS virtual_slot", "CAST(100 + id % 7 AS bigint) AS bytes")
    first = sharding.first_map(slots, 4)
    before = {r.virtual_slot: r.shard for r in first.collect()}
    after = sharding.rebalanced(first, 5).collect()
    loads = defaultdict(int)
    for r in after:
        loads[r.shard] += r.bytes
    assert sorted(loads) == [0, 1, 2, 3, 4] and max(loads.values()) - min(loads.values()) <= 107
    moved = sum(before[r.virtual_slot] != r.shard for r in after)
    assert moved <= 512 / 5 + 5


def plain_grams(text):
    """Bins of the hashed letter 2- and 3-grams of a text, one by one."""
    signs = []
    for c in f" {text.lower()} ":
        if unicodedata.category(c)[0] == "L":
            signs.append(ord(c))
        elif not signs or signs[-1] != 32:
            signs.append(32)
    a, b, c = 0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D
    bins = Counter()
    for n in (2, 3):
        for i in range(len(signs) - n + 1):
            h = n
            for sign, factor in zip(signs[i : i + n], (a, b, c)):
                h = (h * b + sign * factor) % 2**32
            h ^= h >> 15
            bins[(h * c % 2**32) >> 20] += 1
    return bins


def test_language_like_a_plain_classifier(spark, sf_dir):
    """Counts, weights, the nearest centroid and the rejection, without arrays."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = langid.learn(docs, sample=40)
    rng = random.Random(6)
    texts = [r.text for r in docs.orderBy("doc_id").limit(30).collect()]
    texts += [t[i : i + rng.randint(1, 60)] for t in texts for i in [rng.randrange(len(t))]]
    texts += ["", "1234 !?", "Ж日本語 λόγος", "x", "É" * 50, "a-b\n\tc  d"]
    seen = set()
    for text, (lang, score, accepted) in zip(texts, model.predict(texts)):
        bins = plain_grams(text)
        assert bins == Counter({int(b): int(n) for b, n in zip(*[x.tolist() for x in (lambda c: (np.flatnonzero(c), c[c > 0]))(langid.counts_of([text])[0])])})
        if not any(c.isalpha() for c in text):
            assert (lang, score, accepted) == ("und", 0.0, False)
            continue
        weighed = {b: math.log1p(n) * float(model.weight[b]) for b, n in bins.items()}
        length = math.sqrt(sum(w * w for w in weighed.values()))
        cosines = [sum(w * float(centre[b]) for b, w in weighed.items()) / length for centre in model.centres]
        best = max(range(len(cosines)), key=cosines.__getitem__)
        assert lang == model.languages[model.owner[best]]
        assert score == pytest.approx(min(1.0, max(0.0, cosines[best])), abs=1e-4)
        limit = model.least[min(int(math.log2(sum(bins.values()))), len(model.least) - 1)]
        assert accepted == (score >= limit)
        seen.add(accepted)
    assert seen == {True, False}


def test_language_weights_and_centroids_like_plain_ones():
    rng = np.random.default_rng(1)
    dense = rng.integers(0, 3, (12, langid.BINS)) * (rng.random((12, langid.BINS)) < 0.02)
    bounds = np.append(0, np.cumsum((dense > 0).sum(1)))
    counts = langid.Counts(bounds, np.nonzero(dense)[1], dense[dense > 0])
    assert (counts.dense(np.arange(12)) == dense).all() and (counts.dense(np.array([3, 1])) == dense[[3, 1]]).all()
    model = langid.fit(["a"] * 4 + ["b"] * 8, counts)
    for b in range(0, langid.BINS, 97):
        assert model.weight[b] == pytest.approx(math.log(13 / (1 + (dense[:, b] > 0).sum())) + 1, rel=1e-5)
    assert model.languages == ["a", "b"] and np.bincount(model.owner).tolist() == [4, 4]
    assert np.allclose(np.linalg.norm(model.centres, axis=1), 1, atol=1e-5)
    # As many centroids as texts: each is a text of its language.
    own = model.vectors(dense[:4])
    assert np.allclose(np.sort((own @ model.centres[:4].T).max(1)), 1, atol=1e-5)


def test_nothing_to_learn_from(spark):
    docs = spark.createDataFrame([(1, "12 34", "en"), (2, None, "en"), (3, "some words", None)], "doc_id long, text string, lang string")
    assert [r.lang_pred for r in langid.identify(docs, langid.learn(docs)).collect()] == ["und"] * 3
