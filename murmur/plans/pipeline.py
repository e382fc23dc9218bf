"""The whole job: read, clean, translate, score, tag, load."""

from __future__ import annotations

import datetime
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, functions as F

from murmur.operators.enrich import add_sentiment, translate
from murmur.operators.expand import component_keywords, issue_keywords
from murmur.operators.phrases import add_phrases
from murmur.operators.rows import dense_ids, first_copies, spam_filter
from murmur.operators.tagging import categorize, key_issues
from murmur.plans.incremental import load
from murmur.session import materialize, scratch
from murmur.sources import dictionaries as D
from murmur.sources.feedback import read_feedback
from murmur.sources.tables import Tables


@dataclass
class Lexicons:
    """The user's word tables.

    components: (store, keyword, component, feature); issues: (store, keyword, issue);
    memory: (lang, text_hash, translated); sentiment: (word, score); tags: (word, tag).
    """

    components: DataFrame
    issues: DataFrame
    memory: DataFrame
    sentiment: DataFrame
    tags: DataFrame
    stop: list[str] = field(default_factory=list)


def preprocess(
    df: DataFrame, memory: DataFrame, sentiment: DataFrame, order_by: str, lang: str | None = "lang"
) -> DataFrame:
    """Clean, fold copies, translate, clean again, score, number.

    Cheap reductions come before the joins. ``order_by`` gives the order of rows; it
    decides which copy stays and how rows are numbered. Scores are those of the text
    as translated, before the second cleaning, taken only for the rows that remain.
    """
    kept = first_copies(materialize(spam_filter(df, "original")), "original", order_by)
    translated = translate(kept, memory, "original", lang)
    cleaned = spam_filter(translated.withColumn("_raw", F.col("translated")), "translated")
    changed = F.when(F.col("_raw") != F.col("translated"), F.col("_raw"))
    numbered = dense_ids(cleaned.withColumn("_raw", changed), order_by)
    scored = numbered.withColumn("_raw", F.coalesce("_raw", "translated"))
    return add_sentiment(scored, sentiment, "_raw", "id").drop("_raw")


def tag(feedback: DataFrame, lexicons: Lexicons) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(feedback with phrases, categories, issues). Written once, used three times."""
    whole = materialize(add_phrases(feedback, "translated", "id", lexicons.tags, default="N"))
    categories = categorize(whole, lexicons.components, lexicons.stop)
    return whole, categories, key_issues(whole, lexicons.issues, lexicons.stop)


def run_daily(
    spark: SparkSession,
    input_folder: str,
    categories_path: str,
    issues_path: str,
    stop_words_path: str,
    memory: DataFrame,
    sentiment: DataFrame,
    tags: DataFrame,
    output_folder: str,
    today: datetime.date,
    senses: DataFrame | None = None,
    once: bool = False,
) -> int:
    """Read feedback files, process them and append the new ones; returns the first ID. With
    ``once`` a text that an earlier load with ``once`` has brought does not come again."""
    with scratch():
        lexicons = Lexicons(
            components=component_keywords(D.read_categories(spark, categories_path), senses),
            issues=issue_keywords(D.read_issues(spark, issues_path), senses),
            memory=memory,
            sentiment=sentiment,
            tags=tags,
            stop=D.stop_words(spark, stop_words_path),
        )
        rows = read_feedback(spark, input_folder)
        feedback = preprocess(rows, memory, sentiment, "line", lang=None)
        whole, categories, issues = tag(feedback, lexicons)
        return load(Tables(spark, output_folder), whole, categories, issues, today, once=once)
