"""Operators against brute force and hand-made cases."""

import collections
import datetime
import math
import os
import random

import pytest
from pyspark.sql import functions as F

from murmur import fixed
from murmur.functions import text as T
from murmur.operators import clusters as C, enrich as E, expand as X, joins as J, matching as M
from murmur.operators import blocks, phrases as P, rows as R, similarity as S, stats as ST, tagging as G
from murmur.session import materialize, materialize_alone, scratch, scratch_dir


def rows(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns or df.columns).collect())


def test_first_copies_with_a_hot_value(spark):
    df = spark.range(3000).select(
        F.col("id"), F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("t")
    )
    out = R.first_copies(df, "t", "id")
    assert out.columns == ["id", "t"]
    assert out.count() == 2001 and out.filter("t = 'hot'").first().id == 0


def test_dense_ids_are_dense_and_ordered(spark):
    df = spark.range(0, 100_000, 7).select((F.col("id") * 3 - 50_000).alias("k"))
    out = R.dense_ids(df, "k").orderBy("k").collect()
    assert [r.id for r in out] == list(range(len(out)))


def test_forward_fill_across_blocks(spark):
    values = [None, None, "a", None, None, None, None, None, None, None, "b", None, None, "c", None]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "line long, v string")
    for block in (1, 3, 4, 100):
        got = [r.v for r in R.forward_fill(df, "line", "v", block=block).orderBy("line").collect()]
        want, last = [], "Unknown"
        for v in values:
            last = v or last
            want.append(last)
        assert got == want


def test_spam_filter_keeps_columns(spark):
    df = spark.createDataFrame([(1, "a@b.c hi", 9.0), (2, fixed.NO_LANGUAGE, 1.0), (3, None, 2.0)], "id int, t string, spam double")
    out = R.spam_filter(df, "t")
    assert rows(out, "id", "t", "spam") == [(1, " hi", 0)]


def test_lookup_is_a_constant_and_has_a_limit(spark, monkeypatch):
    table = spark.createDataFrame([(f"w{i}", i) for i in range(300)] + [("w1", 0), (None, 5)], "w string, v int")
    of = J.lookup(table, "w", "v")
    df = spark.createDataFrame([("w1",), ("w299",), ("x",), (None,)], "w string").select("w", of(F.col("w")).alias("v"))
    assert [r.v for r in df.collect()] == [0, 299, None, None]
    assert "Join" not in df._jdf.queryExecution().toString()
    monkeypatch.setattr(J, "MAX_ENTRIES", 10)
    assert J.lookup(table, "w", "v") is None


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_words_do_not_travel(spark, monkeypatch):
    df = spark.createDataFrame([(1, "The dog runs. Good dogs run fast"), (2, "")], "id long, t string")
    tags = spark.createDataFrame([("dog", "N"), ("dogs", "N"), ("runs", "V"), ("the", "D"), ("good", "J")], "word string, tag string")
    scores = spark.createDataFrame([("good", 1.0), ("fast", 0.5)], "word string, score double")
    narrow = P.add_phrases(df, "t", "id", tags), E.sentiment_scores(df, scores, "t", "id")
    for result in narrow:
        assert "Exchange" not in plan_of(result) and "Join" not in plan_of(result)
    # A lexicon too large for a constant is joined, with the same result.
    monkeypatch.setattr(J, "MAX_ENTRIES", 1)
    joined = P.add_phrases(df, "t", "id", tags), E.sentiment_scores(df, scores, "t", "id")
    for a, b in zip(narrow, joined):
        assert "Join" in plan_of(b)
        assert sorted(a.collect()) == sorted(b.collect())


def test_copies_are_found_by_hash(spark):
    df = spark.createDataFrame([(3, "a", 1), (1, "a", 2), (2, None, 3), (4, None, 4), (5, "", 5)], "id long, t string, x int")
    first = R.first_copies(df, "t", "id")
    assert rows(first, "id", "t", "x") == [(1, "a", 2), (2, None, 3), (5, "", 5)]
    assert "SortAggregate" not in plan_of(first)


def test_listing(spark):
    df = spark.createDataFrame([(1, None, None), (2, "a", "x"), (3, None, None), (4, None, "y")], "line long, v string, o string")
    assert rows(R.fill_listing(df, "line", "v"), "line", "v") == [(2, "a"), (4, "a")]


def test_counts_while_stages_run(spark):
    df = spark.range(10).withColumn("t", (F.col("id") % 3).cast("string"))
    result, counts = R.observed_counts(df, [("even", lambda d: d.filter("id % 2 = 0")), ("first", lambda d: R.first_copies(d, "t", "id"))])
    assert [tuple(r) for r in counts.collect()] == [("read", 10), ("even", 5), ("first", 3)]
    assert rows(result, "id") == [(0,), (2,), (4,)]


def test_sides_of_alternatives_have_components(spark):
    listed = spark.createDataFrame([("s", "ung/heit", "C", "F"), ("s", "one & two", "D", "G"), ("s", "plain", "E", "H")],
                                   "store string, keyword string, component string, feature string")
    texts = [(1, "the ung here"), (2, "two of it"), (3, "nothing"), (4, "plain heit"), (5, None)]
    df = spark.createDataFrame(texts, "id long, translated string").selectExpr(
        "id", "'s' AS store", "translated", "array() AS verb_phrases", "array() AS noun_phrases")
    df = df.withColumns({c: F.col(c).cast("array<string>") for c in ("verb_phrases", "noun_phrases")})
    got = rows(G.categorize(df, listed), "id", "component", "feature")
    assert got == [(1, "C", "F"), (2, "D", "G"), (3, "Others", "Other"), (4, "C", "F"), (4, "E", "H"), (5, "Others", "Other")]


def test_senses_have_no_case(spark):
    senses = spark.createDataFrame([("New_Tab", "s1", 1), ("fresh_page", "s1", 1)], "lemma string, synset_id string, rank int")
    words = spark.createDataFrame([("new_tab",), ("NEW_TAB",), ("Fresh_Page",)], "word string")
    # A word is among its own synonyms while there are few.
    assert rows(X.synonyms(words, senses), "word", "synonym") == [(w, s) for w in ("Fresh_Page", "NEW_TAB", "new_tab") for s in ("fresh page", "new tab")]
    pairs = spark.createDataFrame([("NEW_tab", "fresh_page"), ("new_tab", "other")], "a string, b string")
    assert rows(X.same_sense(pairs, senses, "a", "b"), "a", "similar") == [("NEW_tab", 1), ("new_tab", 0)]


def test_contained_in(spark):
    words = spark.createDataFrame([("s", "og"), ("s", "at"), ("t", "og"), ("s", "zz")], "store string, w string")
    texts = spark.createDataFrame([("s", "dog og"), ("s", "cat"), ("t", "cat")], "store string, text string")
    got = rows(J.contained_in(words, "w", texts, "text", ["store"]), "store", "w", "text")
    assert got == [("s", "at", "cat"), ("s", "og", "dog og")]


def near(tokens, a, b):
    return any(t == a and b in tokens[max(i - 2, 0) : i + 2] for i, t in enumerate(tokens))


def test_pair_proximity_edges(spark):
    keywords = spark.createDataFrame([("s", "one two")], "store string, keyword string")
    texts = {
        "two x one": True, "two one": True, "one two": True, "one x two": False,
        "two x x one": False, "one": False, "two": False,
    }
    df = spark.createDataFrame([(t, "s") for t in texts], "t string, store string")
    found = {r.t for r in M.find_words(df, M.keyword_pairs(keywords), "t", ["t"]).collect()}
    assert found == {t for t, hit in texts.items() if hit}


@pytest.mark.parametrize("seed", [1, 2])
def test_find_words_brute_force(spark, seed):
    rng = random.Random(seed)
    letters = list("abcdef")
    texts = [" ".join(rng.choices(letters, k=rng.randint(0, 9))) for _ in range(60)]
    phrases = {" ".join(rng.choices(letters, k=rng.randint(1, 4))) for _ in range(40)}
    want = set()
    for i, t in enumerate(texts):
        tokens = [w for w in t.split() if w != "f"]
        for p in phrases:
            ws = p.split(" ")
            hit = ws[0] in tokens if len(ws) == 1 else all(near(tokens, a, b) for a, b in zip(ws, ws[1:]))
            if hit:
                want.add((i, p))
    df = spark.createDataFrame([(i, "s", t) for i, t in enumerate(texts)], "id int, store string, t string")
    kw = spark.createDataFrame([("s", p) for p in phrases], "store string, keyword string")
    got = set(rows(M.find_words(df, M.keyword_pairs(kw), "t", ["id"], ["f"]), "id", "keyword"))
    assert got == want


def test_keyword_forms(spark):
    kw = spark.createDataFrame(
        [("s", k) for k in ["Tabs", "tab", "pop-up", "log in/out", "a & b", "stop", "one ?"]], "store string, keyword string"
    )
    got = rows(M.keyword_pairs(kw), "keyword", "pairs", "term", "next")
    assert got == [
        ("a", 1, "a", "a"), ("a & b", 1, "a", "b"), ("b", 1, "b", "b"),
        ("log in", 1, "log in", "log in"), ("log in/out", 2, "in", "out"), ("log in/out", 2, "log", "in"),
        ("out", 1, "out", "out"), ("pop-up", 1, "pop", "up"), ("stop", 1, "stop", "stop"), ("tab", 1, "tab", "tab"),
    ]


def brute_synonyms(word, senses, n=3):
    of = lambda w: {s for l, s, _ in senses if l == w}
    first = lambda w: min(((r, s) for l, s, r in senses if l == w), default=(0, None))[1]
    all_ = {l for l, s, _ in senses if s in of(word)}
    if len(all_) <= n:
        return all_
    others = all_ - {word}
    if len(others) <= n:
        return others
    return set(sorted(x for x in others if first(x) == first(word))[:n])


@pytest.mark.parametrize("seed", range(3))
def test_synonyms_brute_force(spark, seed):
    rng = random.Random(seed)
    senses = list({(f"w{rng.randint(0, 25):02d}", f"s{min(rng.randint(0, 9), rng.randint(0, 9))}", rng.randint(0, 3)) for _ in range(60)})
    senses = list({(l, s): (l, s, r) for l, s, r in senses}.values())
    words = sorted({l for l, _, _ in senses}) + ["none"]
    got = collections.defaultdict(set)
    df = X.synonyms(
        spark.createDataFrame([(w,) for w in words], "word string"),
        spark.createDataFrame(senses, "lemma string, synset_id string, rank int"),
    )
    for r in df.collect():
        got[r.word].add(r.synonym)
    for w in words:
        assert got[w] == brute_synonyms(w, senses), w


def test_dictionary_expansion(spark):
    categories = spark.createDataFrame(
        [("s", "1", "F1", "Tabs/View", "new tab,, x", 0), ("s", None, "F2", "Tabs/View", None, 1)],
        "store string, tier string, feature string, component string, keywords string, line long",
    )
    out = X.component_keywords(categories)
    assert {r.feature for r in out.collect()} == {"F2"}
    assert {r.keyword for r in out.collect()} == {
        "Tabs", "View", "x", "new tab", "tab new", "new-tab", "tab-new", "new_tab", "tab_new", "newtab", "tabnew",
    }
    issues = spark.createDataFrame([("s", "Bug", "work, open"), ("s", "UI", "ugly")], "store string, issue string, keywords string")
    got = rows(X.issue_keywords(issues), "issue", "keyword")
    assert len(fixed.NEGATIONS) == 24 and len([g for g in got if g[0] == "Bug"]) == 49
    assert ("Bug", "bug") in got and ("Bug", "does not work") in got and ("UI", "ugly") in got


def union_find(nodes, edges):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        x, y = sorted((find(a), find(b)))
        parent[y] = x
    return {n: find(n) for n in nodes}


@pytest.mark.parametrize("shape", ["random", "path", "star", "none"])
def test_components(spark, shape):
    rng = random.Random(5)
    edges = {
        "random": [(rng.randint(0, 80), rng.randint(0, 80)) for _ in range(60)],
        "path": [(i, i + 1) for i in range(40)],
        "star": [(77, i) for i in range(60)],
        "none": [],
    }[shape]
    df = spark.createDataFrame(edges, "a long, b long")
    got = dict(rows(C.components(df), "node", "root"))
    nodes = {n for e in edges if e[0] != e[1] for n in e}
    assert got == union_find(nodes, [e for e in edges if e[0] != e[1]])


def test_a_round_of_components_has_few_tasks(spark, monkeypatch):
    """The driver keeps records of all tasks: three times the partitions a round, and what
    reads the files."""
    parts, rounds, put = 24, [], C.materialize_measured
    monkeypatch.setattr(C, "materialize_measured", lambda *a, **b: rounds.append(1) or put(*a, **b))
    edges = materialize(spark.createDataFrame([(i, i + 1) for i in range(40)], "a long, b long").coalesce(1))
    held = {"spark.sql.shuffle.partitions": str(parts), "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in held}
    tracker = spark.sparkContext.statusTracker()
    try:
        for k, v in held.items():
            spark.conf.set(k, v)
        spark.sparkContext.setJobGroup("a round of components", "")
        C.components(edges)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    stages = {s for j in tracker.getJobIdsForGroup("a round of components") for s in tracker.getJobInfo(j).stageIds}
    tasks = sum(i.numCompletedTasks for s in stages if (i := tracker.getStageInfo(s)))
    assert tasks > parts and len(rounds) > 3
    assert tasks < 5 * parts * len(rounds), (tasks, len(rounds))


def template_bags(n, seed=3):
    """``n`` near copies of one text, some unlike texts, and a second template."""
    rng = random.Random(seed)
    words = [f"t{i}" for i in range(40)]
    bags = [words[: rng.randint(37, 40)] + [f"u{rng.randrange(10**6)}"] for _ in range(n)]
    bags += [[f"v{rng.randrange(60)}" for _ in range(25)] for _ in range(30)]
    return bags + [[f"s{i}" for i in range(20)] + words[:4] + [f"x{k}"] for k in range(8)]


def test_copies_of_a_template_meet_others_once(spark):
    """Rows formed grow with the number of near copies, not with its square."""
    formed = {}
    for n in (150, 600):
        df = spark.createDataFrame([(i, "g", b) for i, b in enumerate(template_bags(n))], "id long, g string, bag array<string>")
        weighted = materialize(S.weights(df, "id", ["g"]))
        close, _, tops = S.folded(weighted, "id", ["g"], 0.3, C.components)
        met = S._meetings(S._reach(tops, "group", ["g"], 0.3 * S.LOOSER), ["g"])
        formed[n] = close.count() + met.count()
        assert close.count() <= S.BLOCKS * (n + 40)
    assert formed[600] < 6 * formed[150]


@pytest.mark.parametrize("n", [5, 120])
def test_links_connect_what_brute_force_does(spark, n):
    bags = dict(enumerate(template_bags(n, n)))
    df = spark.createDataFrame([(i, "g", b) for i, b in bags.items()], "id long, g string, bag array<string>")
    found = S.links(S.weights(df, "id", ["g"]), "id", ["g"], 0.3, C.components).collect()
    weights = brute_weights(bags)
    near = [(a, b) for b in bags for a in range(b) if round(sum(w * weights[b].get(t, 0) for t, w in weights[a].items()), 9) >= 0.3]
    assert {(min(r), max(r)) for r in found} <= set(near)
    assert union_find(bags, [tuple(r) for r in found]) == union_find(bags, near)


def brute_weights(bags):
    n = len(bags)
    df = collections.Counter(t for b in bags.values() for t in set(b))
    out = {}
    for k, bag in bags.items():
        w = {t: c * (math.log((1 + n) / (1 + df[t])) + 1) for t, c in collections.Counter(bag).items()}
        norm = math.sqrt(sum(v * v for v in w.values()))
        out[k] = {t: v / norm for t, v in w.items()}
    return out


def random_bags(seed, n=80):
    rng = random.Random(seed)
    vocabulary = [f"t{i}" for i in range(40)]
    odds = [1 / (1 + i) for i in range(40)]
    bags = {i: rng.choices(vocabulary, odds, k=rng.randint(0, 12)) for i in range(n)}
    for i in range(0, n, 9):
        bags[i] = ["t0", "t1", "t7"]  # copies
    return bags


@pytest.mark.parametrize("threshold", [0.3, 0.6, 0.95])
def test_similar_pairs_brute_force(spark, threshold):
    bags = random_bags(int(threshold * 100))
    w = brute_weights(bags)
    dot = lambda a, b: sum(v * w[b].get(t, 0) for t, v in w[a].items())
    want = {(a, b): dot(a, b) for a in bags for b in bags if a < b and round(dot(a, b), 9) >= threshold}
    df = spark.createDataFrame([("g", i, b) for i, b in bags.items()], "g string, id long, bag array<string>")
    out = S.similar_pairs(S.weights(df, "id", ["g"]), "id", ["g"], threshold)
    got = {(r.a, r.b): r.similarity for r in out.collect()}
    assert got.keys() == want.keys()
    assert all(math.isclose(got[p], want[p], abs_tol=1e-9) for p in want)


def test_similar_pairs_over_blocks(spark, monkeypatch):
    """A group of several blocks: pairs inside and between them, and forests that connect."""
    monkeypatch.setattr(blocks, "BLOCK", 20)
    monkeypatch.setattr(blocks, "SMALL", 20)
    bags = {i: b for i, b in random_bags(3).items() if b}
    w = brute_weights(bags)
    near = {(a, b) for a in bags for b in bags if a < b and round(sum(v * w[b].get(t, 0) for t, v in w[a].items()), 9) >= 0.5}
    df = spark.createDataFrame([("g", i, b) for i, b in bags.items()], "g string, id long, bag array<string>")
    weighted = S.weights(df, "id", ["g"])
    assert set(rows(S.similar_pairs(weighted, "id", ["g"], 0.5), "a", "b")) == near
    tree = S.links(weighted, "id", ["g"], 0.5).collect()
    assert {(r.a, r.b) for r in tree} <= near and len(tree) < len(near)
    assert union_find(bags, [tuple(r) for r in tree]) == union_find(bags, near)


def test_blocks_are_stored_once_and_meet_without_a_shuffle(spark, monkeypatch):
    """Many blocks of two groups, with limits so low that each is met."""
    limits = {"BLOCK": 6, "SMALL": 6, "ENTRIES": 25, "PACKED": 60, "COMMON": 5, "CHUNK": 2, "PRODUCTS": 4, "AGAIN": 3}
    for name, value in limits.items():
        monkeypatch.setattr(blocks, name, value, raising=False)
    bags = {i: b for i, b in random_bags(5).items() if b}
    want = {}
    for g in (0, 1):
        w = brute_weights({i: b for i, b in bags.items() if i % 2 == g})
        dots = {(a, b): sum(v * w[b].get(t, 0) for t, v in w[a].items()) for a in w for b in w if a < b}
        want |= {(f"g{g}", f"k{a:03}", f"k{b:03}"): s for (a, b), s in dots.items() if round(s, 9) >= 0.5}
    df = spark.createDataFrame([(f"g{i % 2}", f"k{i:03}", b) for i, b in bags.items()], "g string, id string, bag array<string>")
    out = S.similar_pairs(S.weights(df, "id", ["g"]), "id", ["g"], 0.5)
    found = out.collect()
    got = {(r.g, r.a, r.b): r.similarity for r in found}
    assert got.keys() == want.keys() and len(found) == len(got)
    assert all(math.isclose(got[p], want[p], abs_tol=1e-9) for p in want)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" in plan and "Exchange" not in plan and "Generate" not in plan


def test_clusters_brute_force(spark):
    bags = random_bags(9)
    w = brute_weights(bags)
    dot = lambda a, b: sum(v * w[b].get(t, 0) for t, v in w[a].items())
    threshold = 0.8
    edges = [(a, b) for a in bags for b in bags if a < b and bags[a] and bags[b] and round(dot(a, b), 9) >= threshold]
    roots = union_find(bags, edges)
    size = collections.Counter(roots.values())
    want = sorted((i, r) for i, r in roots.items() if size[r] >= 4)
    df = spark.createDataFrame([("g", i, b) for i, b in bags.items()], "g string, id long, bag array<string>")
    got = rows(C.cluster_texts(df, "id", ["g"], threshold), "id", "cluster")
    assert got == want and want


def test_clusters_leave_no_weights_or_blocks_behind(spark):
    """What is written for the links goes once they are there."""
    df = spark.createDataFrame([("g", i, b) for i, b in random_bags(9).items()], "g string, id long, bag array<string>")
    before = set(os.listdir(scratch_dir(spark)))
    out = C.cluster_texts(df, "id", ["g"], 0.8)
    left = [f"{scratch_dir(spark)}/{d}" for d in set(os.listdir(scratch_dir(spark))) - before]
    columns = {c for d in left for c in spark.read.parquet(d).columns}
    assert columns and not columns & {"codes", "weights", "terms", "n_texts", "_length"}
    assert out.count()


def test_materialize_alone_keeps_only_its_result(spark):
    before = set(os.listdir(scratch_dir(spark)))
    with scratch():
        given = materialize(spark.range(3))
        out = materialize_alone(lambda: materialize(given.select((F.col("id") + 1).alias("v"))).filter("v > 1"))
        assert len(set(os.listdir(scratch_dir(spark))) - before) == 2
        assert given.count() == 3 and rows(out) == [(2,), (3,)]
        with pytest.raises(ValueError):
            materialize_alone(lambda: [materialize(given), int("x")][0])
    assert set(os.listdir(scratch_dir(spark))) == before


def test_summaries(spark):
    df = spark.createDataFrame(
        [(1, 1, "alpha beta beta"), (1, 2, "alpha alpha alpha alpha"), (1, 3, "x" * 90), (2, 4, "y" * 90), (3, 5, "?!")],
        "c int, id int, t string",
    )
    got = dict(rows(S.summaries(df, "t", "id", ["c"]), "c", "summary"))
    assert got == {1: "alpha beta beta", 2: "Unknown", 3: "Unknown"}


LEXICON = [("the", "D"), ("red", "J"), ("car", "N"), ("tab", "N"), ("page", "N"), ("crashes", "V"), ("open", "V"), ("in", "I")]


def test_phrases(spark):
    df = spark.createDataFrame([(1, "I open the red tab in page. The car. red crashes car"), (2, "?? !!"), (3, None)], "id int, t string")
    lexicon = spark.createDataFrame(LEXICON, "word string, tag string")
    out = {r.id: r for r in P.add_phrases(df, "t", "id", lexicon).collect()}
    assert out[1].verb_phrases == ["open the red tab in page", "red crashes car"]
    assert out[1].noun_phrases == ["the red tab", "page", "The car", "car"]
    assert out[2].verb_phrases == [] and out[3].noun_phrases == []


def test_phrases_of_a_long_run(spark):
    """A text without sentence ends is one run of nouns, as long as the text."""
    lexicon = spark.createDataFrame([("is", "V"), ("red", "J")], "word string, tag string")
    n = 20_000
    df = spark.range(1).select("id", F.concat(F.lit("is "), F.repeat(F.lit("red "), n), F.repeat(F.lit("tab "), n)).alias("t"))
    row = P.add_phrases(df, "t", "id", lexicon, default="N").select(
        F.transform("verb_phrases", F.length).alias("v"), F.size("noun_phrases").alias("n")).first()
    assert row.v == [3 + 4 * n + 4 * n - 1] and row.n == n


def test_categorize(spark):
    components = spark.createDataFrame(
        [("s", "tab", "Tabs", "F1"), ("s", "car", "Generic", "G"), ("s", "page", "Pages", "F2"), ("s", "tab", "Panel", "F3")],
        "store string, keyword string, component string, feature string",
    )
    feedback = spark.createDataFrame(
        [
            (1, "s", "I open the tab. A car", ["open the tab"], ["the tab", "car"]),
            (2, "s", "only a car here", [], []),
            (3, "s", "nothing", ["open the tab"], []),
            (4, "unknown", "tab", [], []),
            (5, "s", "big new pages load", [], ["pages"]),
        ],
        "id int, store string, translated string, verb_phrases array<string>, noun_phrases array<string>",
    )
    out = G.categorize(feedback, components, generic="Generic")
    assert rows(out) == [
        (1, "F1", "Tabs", ["open the tab"]),
        (1, "F3", "Panel", ["open the tab"]),
        (2, "G", "Generic", ["only a car"]),
        (3, "Other", "Others", [""]),
        (4, "Other", "Others", [""]),
        (5, "F2", "Pages", ["big new pages"]),
    ]


def test_key_issues_with_unlisted_side(spark):
    issues = spark.createDataFrame(
        [("s", "slow", "Speed"), ("s", "load/hang", "Load"), ("s", "hanging", "Hang"), ("s", "slow", "Lag")],
        "store string, keyword string, issue string",
    )
    feedback = spark.createDataFrame(
        [(1, "s", "so slow, slow"), (2, "s", "it hangs"), (3, "s", "load it"), (4, "t", "slow")], "id int, store string, translated string"
    )
    # "hang" and "load" are sides of an alternative; the first listed keyword that
    # contains them lends its issue.
    assert rows(G.key_issues(feedback, issues)) == [(1, "Lag"), (1, "Speed"), (2, "Hang"), (3, "Load")]


def test_translation(spark):
    df = spark.createDataFrame([(1, "en", "hi"), (2, "fr", "oui"), (3, "de", "ja"), (4, None, "x")], "id int, lang string, original string")
    memory = df.filter("id = 2").select("lang", E.text_key(F.col("original")).alias("text_hash"), F.lit("it&#39;s yes").alias("translated"))
    got = dict(rows(E.translate(df, memory), "id", "translated"))
    assert got == {1: "hi", 2: "it's yes", 3: fixed.NO_LANGUAGE, 4: fixed.NO_LANGUAGE}
    got = dict(rows(E.translate(df, memory, lang=None), "id", "translated"))
    assert got == {1: "hi", 2: "it's yes", 3: "ja", 4: "x"}


def test_sentiment(spark):
    df = spark.createDataFrame([(1, "good good bad. bad"), (2, "none"), (3, "good.")], "id int, t string")
    lexicon = spark.createDataFrame([("good", 1.0), ("bad", -1.0)], "word string, score double")
    got = {r.id: (round(r.score, 4), round(r.magnitude, 4)) for r in E.sentiment_scores(df, lexicon, "t", "id").collect()}
    assert got == {1: (-0.3333, 0.6667), 2: (0.0, 0.0), 3: (1.0, 1.0)}


def test_terms_and_tops(spark):
    df = spark.createDataFrame([(1, "Tabs tab the at x"), (2, "tabs pages 12 1234"), (3, "")], "id int, t string")
    counts = ST.term_counts(df, "t", ["the"])
    assert rows(counts, "term", "n") == [("1234", 1), ("page", 1), ("tab", 3)]
    assert rows(ST.clean_terms(counts, []), "term") == [("page",), ("tab",)]
    assert [r.term for r in ST.top_terms(counts, 1, 2).collect()] == ["tab", "1234"]
    assert rows(ST.terms_of_each(df, "t", "id", ["the"], 2), "id", "keywords") == [(1, ["tab"]), (2, ["tab", "1234"]), (3, [])]
    assert dict(rows(ST.usual_words(df, "t"), "term", "word"))["tab"] == "Tabs"
    listed = spark.createDataFrame([("a, b",), ("a",)], "x string")
    assert rows(ST.list_counts(listed, "x"), "term", "n") == [("a", 2), ("b", 1)]


def test_similar_words_gain_their_head(spark):
    texts = [(i, "g", t) for i, t in enumerate(["quick car"] * 4 + ["fast fast car"] * 3 + ["fast quick"])]
    df = spark.createDataFrame(texts, "id long, g string, t string")
    senses = spark.createDataFrame([("quick", "s1", 1), ("fast", "s1", 1), ("car", "s2", 1)], "lemma string, synset_id string, rank int")
    got = dict(rows(C.merge_similar_words(df, "t", "id", ["g"], senses), "id", "bag"))
    assert got[0] == ["quick", "car", "fast"] and got[4] == ["fast", "fast", "car"] and got[7] == ["fast", "quick", "fast"]


@pytest.mark.parametrize("few", [0, 100_000])
def test_heads_meet_texts_without_a_sort_of_words(spark, monkeypatch, few):
    monkeypatch.setattr(C, "FEW_HEADS", few)
    rng = random.Random(5)
    words = ["ear", "are", "era", "tea", "Eat", "eats", "seat", "of", "map"]
    texts = [(i % 25, rng.choice("gh"), " ".join(rng.choices(words, k=rng.randint(0, 8)))) for i in range(30)] + [(None, "g", "ear are"), (99, None, "ear are")]
    df = spark.createDataFrame(texts, "id long, g string, t string")
    senses = spark.createDataFrame([(w.lower(), "".join(sorted(w.lower())), 1) for w in words], "lemma string, synset_id string, rank int")
    merged = C.merge_similar_words(df, "t", "id", ["g"], senses)
    plan = merged._jdf.queryExecution().executedPlan().toString()
    assert ("BroadcastHashJoin" if few else "ShuffledHashJoin") in plan

    form = T.normal_python
    want = []
    heads = {}
    for g in "gh":
        used = collections.Counter(form(w) for _, h, t in texts if h == g for w in t.split())
        surface = {m: min((-n, w) for w, n in collections.Counter(w for _, h, t in texts if h == g for w in t.split()).items() if form(w) == m)[1] for m in used}
        sets = {}
        for m, n in used.items():
            if n >= fixed.MERGE_MIN_COUNT and len(m) >= 3:
                sets.setdefault("".join(sorted(surface[m].lower())), []).append((-n, m))
        heads |= {(g, m): min(s)[1] for s in sets.values() for _, m in s if m != min(s)[1]}
    for i, g, t in texts:
        same = [x for x in texts if x[:2] == (i, g)] if i is not None and g else []
        more = sorted(heads[g, m] for _, _, u in same for m in {form(w) for w in u.split()} if (g, m) in heads)
        want.append((i, g, [form(w) for w in t.split()] + more))
    order = lambda found: sorted(found, key=str)
    assert order((r.id, r.g, r.bag) for r in merged.collect()) == order(want)


def test_letters_of_document_words_are_sorted_once_a_word(spark, tmp_path):
    from workload.queries import _document_senses

    spark.createDataFrame([("Tea eat tea",)], "text string").write.parquet(str(tmp_path / "documents.parquet"))
    senses = _document_senses(spark, str(tmp_path))
    assert rows(senses, "lemma", "synset_id", "rank") == [("eat", "aet", 1), ("tea", "aet", 1)]
    plan = X.first_senses(senses)._jdf.queryExecution().optimizedPlan().toString()
    assert "explode" not in plan and "Generate" not in plan
