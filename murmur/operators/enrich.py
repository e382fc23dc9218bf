"""Translation and sentiment by table joins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from murmur import fixed
from murmur.functions import text as T, values as V
from murmur.operators.joins import lookup


def text_key(text: Column) -> Column:
    return F.sha2(text, 256)


def translate(
    df: DataFrame,
    memory: DataFrame,
    text: str = "original",
    lang: str | None = "lang",
    target: str = "en",
) -> DataFrame:
    """``df`` with ``translated`` from a translation memory (lang, text_hash, translated).

    Texts already in the target language pass through, apart from the join: they are
    often most of the rows and share one language. A text the memory lacks gets the
    no-language mark. Without a language column (``lang=None``) texts are looked up by
    content alone, and those the memory lacks count as being in the target language.
    """
    columns = [c for c in df.columns if c != "translated"]
    hashed = lambda rows: rows.select(*columns, text_key(F.col(text)).alias("text_hash"))
    found = V.unescape(F.col("translated"))
    if lang is None:
        known = memory.groupBy("text_hash").agg(F.min("translated").alias("translated"))
        return hashed(df).join(known, "text_hash", "left").select(
            *columns, F.coalesce(found, text).alias("translated")
        )
    native = F.coalesce(F.col(lang) == target, F.lit(False))
    same = df.filter(native).select(*columns, F.col(text).alias("translated"))
    known = memory.groupBy(F.col("lang").alias(lang), "text_hash").agg(
        F.min("translated").alias("translated")
    )
    other = hashed(df.filter(~native)).join(known, [lang, "text_hash"], "left").select(
        *columns, F.coalesce(found, F.lit(fixed.NO_LANGUAGE)).alias("translated")
    )
    return same.unionByName(other)


def scored(text: Column, score: Callable[[Column], Column]) -> Column:
    """struct(score, magnitude) of a text; ``score`` gives a word's, or null."""
    known = lambda s: F.filter(F.transform(T.words(s), lambda w: score(F.lower(w))), lambda x: x.isNotNull())
    total = lambda xs: F.aggregate(xs, F.lit(0.0), lambda s, x: s + x)
    mean = lambda xs: F.when(F.size(xs) > 0, total(xs) / F.size(xs)).otherwise(0.0)
    sentences = T.sentences(text)
    means = F.transform(F.transform(sentences, known), mean)
    n = F.greatest(F.size(sentences), F.lit(1))
    return T.bind(
        means,
        lambda ms: F.named_struct(
            F.lit("score"), F.round(total(ms) / n, 9),
            F.lit("magnitude"), F.round(total(F.transform(ms, F.abs)) / n, 9),
        ),
    )


def with_scores(df: DataFrame, lexicon: DataFrame, text: str, key: str) -> DataFrame:
    """``df`` with ``_scored``: struct(score, magnitude) from a lexicon (word, score).

    A sentence scores the mean of its words found in the lexicon, 0 without any. A
    text has the mean score and the mean absolute score of its sentences. A lexicon too
    large for a constant meets the texts' distinct words in a join instead.
    """
    scores = lookup(lexicon, "word", "score")
    if scores is not None:
        return df.withColumn("_scored", scored(F.col(text), scores))
    words = df.select(key, F.explode(F.array_distinct(F.transform(T.words(F.col(text)), F.lower))).alias("word"))
    own = (
        words.join(lexicon.groupBy("word").agg(F.min("score").alias("score")), "word")
        .groupBy(key)
        .agg(F.map_from_entries(F.collect_list(F.struct("word", "score"))).alias("_known"))  # one text's distinct words
    )
    joined = df.join(own, key, "left").withColumn("_known", F.coalesce("_known", F.create_map().cast("map<string,double>")))
    return joined.withColumn("_scored", scored(F.col(text), lambda w: F.element_at("_known", w))).drop("_known")


def sentiment_scores(df: DataFrame, lexicon: DataFrame, text: str, key: str) -> DataFrame:
    """(key, score, magnitude) of each text."""
    return with_scores(df, lexicon, text, key).select(key, "_scored.score", "_scored.magnitude")


def add_sentiment(
    df: DataFrame, lexicon: DataFrame, text: str = "translated", key: str = "id"
) -> DataFrame:
    label = V.sentiment_label(F.col("_scored.score"), F.col("_scored.magnitude"))
    return with_scores(df, lexicon, text, key).withColumn("sentiment", label).drop("_scored")
