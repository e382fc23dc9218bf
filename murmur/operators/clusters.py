"""Clusters of similar feedback, their keywords, and issues drawn from them."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from murmur import fixed
from murmur.functions import text as T
from murmur.operators import similarity as S
from murmur.operators.expand import first_senses
from murmur.operators.stats import MIN_WORD, most_usual, surface_counts, top_terms, word_counts
from murmur.session import discard, materialize, materialize_alone, materialize_measured

#: Most words with another head that are sent to the texts; more meet them in a shuffle.
FEW_HEADS = 100_000


def star_forest(edges: DataFrame) -> DataFrame:
    """(a, b) of every node with an edge that is not its component's least node, which is b.

    ``edges`` is (a, b). Alternates large-star and small-star steps (Kiveris et al.,
    2014), which keep at most one edge per node pair and need O(log² n) rounds. Each
    step is a partial min per node and a join back, so a node with very many
    neighbours is never gathered; AQE splits its rows in the join.

    Edges go from the greater node to the lesser, before and after each step, and no step
    makes more of them. So a step joins them as they are, and a round folds equal ones once,
    at its end. What a step makes is read twice by the next and is written between them:
    otherwise its join runs again for each reader, and the driver keeps records of all tasks.
    """

    def large(stars: DataFrame) -> DataFrame:
        both = stars.union(stars.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        return stars.join(low.withColumnRenamed("a", "b"), "b").select("a", F.col("m").alias("b"))

    def small(stars: DataFrame) -> DataFrame:
        low = stars.groupBy("a").agg(F.min("b").alias("m"))
        moved = stars.join(low, "a").select(F.explode(F.array("a", "b")).alias("a"), F.col("m").alias("b"))
        return moved.filter(F.col("a") != F.col("b")).distinct()

    def settle(rows: DataFrame) -> tuple[DataFrame, dict]:
        hashed = F.xxhash64("a", "b").cast("decimal(38,0)")
        return materialize_measured(rows, n=F.count(F.lit(1)), sum=F.sum(hashed))

    stars, after = settle(
        edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .filter(F.col("a") != F.col("b"))
        .distinct()
    )
    before = None
    while after != before:  # a round that changes nothing is the last
        last, before = stars, after
        moved = materialize(large(stars))
        stars, after = settle(small(moved))
        discard(last)
        discard(moved)
    return stars


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node with an edge; the root is its component's least node."""
    stars = star_forest(edges)
    roots = stars.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return stars.select(F.col("a").alias("node"), F.col("b").alias("root")).union(roots)


def cluster_texts(
    texts: DataFrame,
    key: str,
    by: list[str],
    threshold: float = fixed.CLUSTER_SIMILARITY,
    min_size: int = fixed.CLUSTER_SIZE,
) -> DataFrame:
    """(by, key, cluster) from (by, key, bag): texts linked by cosine similarity,
    directly or through others; clusters below ``min_size`` are dropped. A cluster is
    named after its smallest key. Keys must be unique across groups."""
    kept, members = S.fold_copies(texts, key, by)
    # Of weights and blocks nothing stays once the links are there.
    links = materialize_alone(lambda: S.links(S.weights(kept, key, by, "copies"), key, by, threshold, components))
    roots = components(links)
    whole = members.join(roots, members["first"] == roots["node"], "left").select(
        *by, key, F.coalesce("root", "first").alias("cluster")
    )
    sizes = whole.groupBy("cluster").agg(F.count("*").alias("_size"))
    return (
        whole.join(sizes.filter(F.col("_size") >= min_size), "cluster").select(*by, key, "cluster")
    )


def merge_similar_words(
    texts: DataFrame,
    text: str,
    key: str,
    by: list[str],
    senses: DataFrame,
    stop: list[str] = (),
    min_count: int = fixed.MERGE_MIN_COUNT,
) -> DataFrame:
    """(by, key, bag): normalised texts with a common word added for similar words.

    Among a group's terms with at least ``min_count`` uses, those whose usual words
    have the same first sense belong together; the most used one is the head. A text
    gains the head once for every other word of the set that it holds.
    """
    both = F.transform(
        F.array(T.words(F.col(text))), lambda ws: F.struct(ws.alias("words"), S.bag_of(ws, stop).alias("bag"))
    )
    # inline() works the words out once.
    read = materialize(texts.select(*by, key, F.inline(both).alias("words", "bag")))
    plain = read.select(*by, key, "bag")
    usual = (
        word_counts(read.select(*by, F.explode("words").alias("word")), by)
        .filter((F.length("term") >= 3) & T.is_kept(F.col("term"), T.normal_stop(list(stop))))
        .groupBy(*by, "term")
        .agg(F.sum("n").alias("n"), F.min(F.struct((-F.col("n")).alias("r"), "word")).alias("b"))
        .filter(F.col("n") >= min_count)
    )
    sense = first_senses(senses).withColumnRenamed("lemma", "word")
    meant = materialize(
        usual.select(*by, "term", "n", F.lower("b.word").alias("word")).join(sense, "word").select(*by, "term", "n", "synset_id")
    )
    head = meant.groupBy(*by, "synset_id").agg(
        F.min(F.struct((-F.col("n")).alias("n"), "term")).alias("h")
    )
    to_head, seen = materialize_measured(
        meant.join(head, [*by, "synset_id"])
        .filter(F.col("term") != F.col("h.term"))
        .select(*by, "term", F.col("h.term").alias("head")),
        n=F.count(F.lit(1)),
    )
    # A term's row is single here, so a task's share can be hashed; that spares a sort of all
    # words of all texts.
    to_head = F.broadcast(to_head) if seen["n"] <= FEW_HEADS else to_head.hint("shuffle_hash")
    held = plain.select(*by, key, F.explode(F.array_distinct("bag")).alias("term")).filter(F.length("term") >= 3)
    added = (
        held.join(to_head, [*by, "term"])
        .groupBy(*by, key)
        .agg(F.array_sort(F.collect_list("head")).alias("more"))  # at most one per distinct word of the text
    )
    return plain.join(added, [key, *by], "left").select(
        *by, key, F.when(F.col("more").isNull(), F.col("bag")).otherwise(F.concat("bag", "more")).alias("bag")
    )


def cluster_keywords(
    texts: DataFrame,
    text: str,
    by: list[str],
    stop: list[str] = (),
    listed: DataFrame | None = None,
    k: int = 1,
    few: int = 5,
) -> DataFrame:
    """(by, keyword): the ``k`` most frequent words of each cluster, in their usual
    form; one if it has fewer than ``few`` texts. ``listed`` is (store, keyword): words
    already in the dictionaries, left out where ``by`` has the store."""
    surface = materialize(surface_counts(texts, text, by))
    rows = surface.filter((F.length("word") >= MIN_WORD) & T.is_kept(F.col("term"), T.normal_stop(list(stop))))
    if listed is not None:
        known = listed.select("store", T.normal_form(F.col("keyword")).alias("term")).distinct()
        rows = rows.join(known, ["store", "term"], "left_anti")
    counts = rows.groupBy(*by, "term").agg(F.sum("n").alias("n"))
    top = top_terms(counts, 0, k, by)
    if k > 1:
        small = texts.groupBy(*by).agg(F.count("*").alias("_t")).filter(F.col("_t") < few)
        one = top_terms(counts.join(small, by, "left_semi"), 0, 1, by)
        top = top.join(small, by, "left_anti").unionByName(one)
    return top.join(most_usual(surface, by), ["term", *by]).select(
        *by, F.col("word").alias("keyword")
    )


def bottom_up_issues(
    feedback: DataFrame,
    senses: DataFrame,
    listed: DataFrame,
    stop: list[str] = (),
    text: str = "translated",
    key: str = "id",
    k: int = 1,
) -> DataFrame:
    """(key, issue): keywords of its cluster, for each clustered feedback.

    Clusters are sought per store and device, and described by their phrases.
    """
    from murmur.operators.phrases import phrase_text

    by = ["store", "device"]
    clustered = materialize_alone(
        lambda: cluster_texts(merge_similar_words(feedback, text, key, by, senses, stop), key, by)
    )
    described = phrase_text(feedback.join(clustered.select(key, "cluster"), key), key, ["store", "cluster"])
    words = cluster_keywords(described, "text", ["store", "cluster"], stop, listed, k)
    return clustered.join(words.select("cluster", "keyword"), "cluster").select(
        key, F.col("keyword").alias("issue")
    )
