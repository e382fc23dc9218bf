"""Each feedback with what was found in it."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def report(
    feedback: DataFrame,
    categories: DataFrame,
    issues: DataFrame,
    key: str = "id",
    component: str = "component",
    issue: str = "issue",
) -> DataFrame:
    """Feedback with its components and issues, ordered by ID.

    Both lists hold distinct dictionary labels, so a row stays small.
    """
    none = F.array().cast("array<string>")

    def labels(df: DataFrame, column: str, name: str) -> DataFrame:
        return df.groupBy(key).agg(F.array_sort(F.collect_set(column)).alias(name))

    return (
        feedback.join(labels(categories, component, "components"), key, "left")
        .join(labels(issues, issue, "issues"), key, "left")
        .withColumns({c: F.coalesce(c, none) for c in ("components", "issues")})
        .withColumn("n_components", F.size("components"))
        .orderBy(key)
    )


def id_range(feedback: DataFrame, key: str = "id") -> DataFrame:
    return feedback.agg(F.min(key).alias("min_id"), F.max(key).alias("max_id"))
