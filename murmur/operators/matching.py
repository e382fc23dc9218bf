"""Finding dictionary words and phrases in texts."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from murmur.functions import text as T
from murmur.operators.joins import contained_in


def keyword_pairs(keywords: DataFrame) -> DataFrame:
    """Prepare (store, keyword) for matching.

    A phrase becomes its consecutive word pairs, a word the pair with itself; an
    alternative (``a/b``, ``a & b``) also gives each side as a word. Keywords with the
    same normal form are reported as the alphabetically last of them.
    """
    kw = F.col("keyword")
    spaced = kw.contains(" ")
    either = kw.contains("/") | kw.contains("&")
    phrase = spaced | (kw.contains("-") & ~either)
    form = lambda k, t: F.struct(k.alias("keyword"), t.alias("terms"), F.lit(False).alias("phrase"))
    whole = F.struct(
        kw.alias("keyword"),
        F.when(phrase, T.normal_forms(T.words(kw)))
        .otherwise(F.array(T.normal_form(kw)))
        .alias("terms"),
        phrase.alias("phrase"),
    )
    sides = F.transform(F.split(kw, "/| & "), lambda p: form(p, F.array(T.normal_form(p))))
    forms = F.when(either, F.concat(F.array(whole), sides)).otherwise(F.array(whole))
    last = F.element_at("f.terms", -1)
    pair = lambda a, b: F.struct(a.alias("a"), b.alias("b"))
    pairs = F.when(F.size("terms") == 1, F.array(pair(F.get("terms", F.lit(0)), F.get("terms", F.lit(0))))).otherwise(
        F.transform(
            F.sequence(F.lit(0), F.size("terms") - 2),
            lambda i: pair(F.get("terms", i), F.get("terms", i + 1)),
        )
    )
    return (
        keywords.select("store", F.explode(forms).alias("f"))
        .filter((F.size("f.terms") > 0) & (~F.col("f.phrase") | (F.size("f.terms") > 1)))
        .groupBy("store", F.col("f.terms").alias("terms"))
        .agg(F.max("f.keyword").alias("keyword"))
        .select("store", "keyword", F.posexplode(pairs).alias("pair_no", "pair"), F.size("terms").alias("size"))
        .select(
            "store",
            "keyword",
            F.greatest(F.col("size") - 1, F.lit(1)).alias("pairs"),
            "pair_no",
            F.col("pair.a").alias("term"),
            F.col("pair.b").alias("next"),
        )
    )


def with_sides(listed: DataFrame) -> DataFrame:
    """``listed`` and a row for each side of its alternatives (``a/b``, ``a & b``), with
    the same labels: what ``keyword_pairs`` can report."""
    kw = F.col("keyword")
    sides = listed.filter(kw.contains("/") | kw.contains("&")).withColumn("keyword", F.explode(F.split(kw, "/| & ")))
    return listed.unionByName(sides).distinct()


def find_words(
    texts: DataFrame, pairs: DataFrame, text: str, keys: list[str], stop: list[str] = ()
) -> DataFrame:
    """(keys, store, keyword) for each dictionary entry found in each text.

    A pair is found where its second word lies from two places before to one place
    after its first word; a phrase is found when each of its pairs is, independently.
    Texts meet the dictionary in an equality join on the first word, without a shuffle
    where Spark knows that the dictionary is small; only hits are shuffled.
    """
    near = texts.select(
        *keys, "store", F.inline(T.neighbourhoods(T.terms(F.col(text), stop)))
    )
    hits = near.join(pairs, ["store", "term"]).filter(F.expr("array_contains(near, next)"))
    return (
        hits.groupBy(*keys, "store", "keyword", "pairs")
        .agg(F.size(F.collect_set("pair_no")).alias("found"))  # at most one per word of the phrase
        .filter(F.col("found") == F.col("pairs"))
        .select(*keys, "store", "keyword")
    )


def unlisted_issue(unlisted: DataFrame, keywords: DataFrame) -> DataFrame:
    """(store, keyword, issue) for keywords that the dictionary does not list.

    A word of the keyword that occurs inside a listed keyword lends that one's
    issues. The last such word decides, then the alphabetically first listed keyword.
    """
    words = unlisted.select(
        F.col("store").alias("s"), "keyword", F.posexplode(F.split("keyword", " ")).alias("place", "word")
    ).filter(F.col("word") != "")
    listed = keywords.select(F.col("store").alias("s"), F.col("keyword").alias("listed")).distinct()
    best = (
        contained_in(words, "word", listed, "listed", ["s"])
        .groupBy("s", "keyword")
        .agg(F.min(F.struct((-F.col("place")).alias("p"), "listed")).alias("b"))
        .select("s", "keyword", F.col("b.listed").alias("listed"))
    )
    issues = keywords.select(F.col("store").alias("s"), F.col("keyword").alias("listed"), "issue")
    return (
        best.join(issues, ["s", "listed"])
        .select(F.col("s").alias("store"), "keyword", "issue")
        .distinct()
    )
