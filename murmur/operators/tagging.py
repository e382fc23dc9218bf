"""Components and key issues of each feedback."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

from murmur import fixed
from murmur.functions import text as T
from murmur.operators.joins import settled
from murmur.operators.matching import find_words, keyword_pairs, unlisted_issue, with_sides


def drop_generic(
    df: DataFrame, key: str, component: str = "component", generic: str = fixed.GENERIC_COMPONENT
) -> DataFrame:
    """Drop the generic component of a feedback that has others.

    The window spans one feedback's distinct components.
    """
    n = F.count("*").over(W.partitionBy(key))
    return (
        df.withColumn("_n", n)
        .filter((F.col(component) != generic) | (F.col("_n") == 1))
        .drop("_n")
    )


def categorize(
    feedback: DataFrame,
    components: DataFrame,
    stop: list[str] = (),
    text: str = "translated",
    key: str = "id",
    generic: str = fixed.GENERIC_COMPONENT,
) -> DataFrame:
    """(key, feature, component, actions) from feedback with its phrases.

    ``components`` is (store, keyword, component, feature). Without a keyword in the
    text a feedback is "Others". Otherwise the keywords found in its phrases count,
    or those of the text if the phrases hold none. Actions are the verb phrases that
    contain the keyword, or the keyword's word contexts if no verb phrase holds one.
    """
    components = settled(components)
    pairs = settled(keyword_pairs(components.select("store", "keyword").distinct()))
    origins = F.array(
        F.struct(F.lit("text").alias("origin"), F.col(text).alias("body")),
        F.struct(F.lit("verb").alias("origin"), F.array_join("verb_phrases", ", ").alias("body")),
        F.struct(F.lit("noun").alias("origin"), F.array_join("noun_phrases", ", ").alias("body")),
    )
    bodies = feedback.select(key, "store", F.inline(origins))
    found = find_words(bodies, pairs, "body", [key, "origin"], stop)
    of = lambda o: F.collect_set(F.when(F.col("origin") == o, F.col("keyword")))
    per_text = found.groupBy(key).agg(
        of("text").alias("in_text"), of("verb").alias("in_verb"), of("noun").alias("in_noun")
    )  # sets of dictionary words, one group per feedback
    by_phrase = F.array_union("in_verb", "in_noun")
    chosen = F.when(F.size(by_phrase) > 0, by_phrase).otherwise(F.col("in_text"))
    tagged = feedback.select(key, "store", text, "verb_phrases").join(per_text, key, "left")

    # A text without keywords carries one null keyword through, and becomes "Others".
    gate = F.coalesce(F.size("in_text"), F.lit(0)) > 0
    chosen = F.when(gate, chosen).otherwise(F.array(F.lit(None).cast("string")))
    # Per text, before its keywords fan out: normalised verb phrases, or the contexts
    # of its keywords.
    by_verb = gate & (F.size("in_verb") > 0)
    normal = F.transform(
        "verb_phrases",
        lambda p: F.named_struct(
            F.lit("term"), F.array_join(T.terms(p, stop), " "), F.lit("context"), p
        ),
    )
    targets = F.transform(chosen, lambda k: T.normal_form(k))
    prepared = (
        tagged.select(
            key, "store", text, "verb_phrases", gate.alias("gate"),
            by_verb.alias("by_verb"), chosen.alias("chosen"), targets.alias("targets"),
        )
        .withColumn(
            "found",
            F.when(F.col("by_verb"), normal).when(
                F.col("gate"), T.contexts(F.col(text), F.col("targets"))
            ),
        )
        .select(key, "store", "gate", "by_verb", "found", F.explode("chosen").alias("keyword"))
    )
    wanted = T.normal_form(F.col("keyword"))
    match = lambda f: F.when(F.col("by_verb"), F.contains(f["term"], wanted)).otherwise(
        f["term"] == wanted
    )
    actions = F.transform(F.filter("found", match), lambda f: f["context"])
    hits = prepared.select(key, "store", "gate", "keyword", actions.alias("actions"))
    table = with_sides(components.select("store", "keyword", "component", "feature"))
    # Every keyword that can be found has a row there; no feedback is left without one.
    known = F.col("gate") & F.col("component").isNotNull()
    other = lambda c, name: F.when(known, F.col(c)).otherwise(F.lit(name)).alias(c)
    labelled = (
        hits.join(settled(table), ["store", "keyword"], "left")
        .select(
            key,
            other("feature", fixed.OTHER_FEATURE),
            other("component", fixed.OTHER_COMPONENT),
            F.when(known, F.col("actions")).otherwise(F.array(F.lit(""))).alias("actions"),
        )
    )
    merged = (
        labelled.groupBy(key, "component")
        .agg(
            F.max("feature").alias("feature"),
            F.array_sort(F.array_distinct(F.flatten(F.collect_list("actions")))).alias("actions"),
        )
        .select(key, "feature", "component", "actions")
    )
    return drop_generic(merged, key, generic=generic)


def key_issues(
    feedback: DataFrame,
    issues: DataFrame,
    stop: list[str] = (),
    text: str = "translated",
    key: str = "id",
) -> DataFrame:
    """Distinct (key, issue); ``issues`` is (store, keyword, issue)."""
    issues = settled(issues)
    pairs = settled(keyword_pairs(issues.select("store", "keyword").distinct()))
    # Only a side of an alternative can be reported without being listed.
    reported = pairs.select("store", "keyword").distinct()
    unlisted = reported.join(issues, ["store", "keyword"], "left_anti")
    table = issues.select("store", "keyword", "issue").unionByName(unlisted_issue(unlisted, issues))
    found = find_words(feedback.select(key, "store", text), pairs, text, [key], stop)
    return found.join(settled(table.distinct()), ["store", "keyword"]).select(key, "issue").distinct()
