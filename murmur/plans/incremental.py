"""Loading a batch past the high-water mark."""

from __future__ import annotations

import datetime
import uuid

from pyspark.sql import Column, DataFrame, functions as F

from murmur import fixed
from murmur.session import materialize, scratch
from murmur.sources.tables import TEXTS, Snapshot, Tables, category_rows, issue_rows, review_rows, undated_rows


def high_water_mark(reviews: DataFrame, date: str = "review_date") -> DataFrame:
    """(max_date): the latest date loaded, or the first date of all."""
    first = F.to_date(F.lit(fixed.FIRST_DATE))
    return reviews.agg(F.coalesce(F.max(F.col(date).cast("date")), first).alias("max_date"))


def newer_than(
    feedback: DataFrame, children: list[DataFrame], mark: Column, date: str = "date", key: str = "id"
) -> tuple[DataFrame, list[DataFrame]]:
    """Feedback dated after ``mark``, and child rows whose feedback was not dropped.

    Feedback without a readable date is not newer than anything, so it is dropped with
    its children; ``undated`` has it.
    """
    day = F.col(date).cast("date")
    dropped = feedback.filter(day.isNull() | (day <= mark)).select(key)
    kept = [child.join(dropped, key, "left_anti") for child in children]
    return feedback.filter(day > mark), kept


def undated(feedback: DataFrame, date: str = "date") -> DataFrame:
    return feedback.filter(F.col(date).cast("date").isNull())


def max_id(tables: list[DataFrame], key: str = "id") -> DataFrame:
    """(max_id) over all tables, 0 if they are empty."""
    tops = [t.agg(F.max(F.col(key).cast("long")).alias("m")) for t in tables]
    result = tops[0]
    for t in tops[1:]:
        result = result.union(t)
    return result.agg(F.coalesce(F.max("m"), F.lit(0)).cast("long").alias("max_id"))


def batch_base(top: Column, today: Column) -> Column:
    """First ID of a batch: day and six zeros, or past the top of all IDs given out if
    that is higher, as it is for a second batch of a day and after very large days."""
    day = F.date_format(today, "yyyyMMdd")
    fresh = (day.cast("long") * 10**fixed.BATCH_DIGITS).cast("long")
    return F.greatest(fresh, top + 1)


def text_hash(text: Column) -> Column:
    return F.unhex(F.md5(text))


def first_times(tables: Tables, feedback: DataFrame, seen: Snapshot, hashed: Column | None = None) -> DataFrame:
    """``feedback`` without texts that were loaded before ``seen``; ``hashed`` is the text's
    hash, by default that of ``original``.

    The stored hashes are read once and not shuffled if the new ones are few, as they are
    for a load; only those that are found come back.
    """
    hashed = text_hash(F.col("original")) if hashed is None else hashed
    new = feedback.select(hashed.alias("hash")).distinct()
    known = tables.read(TEXTS, seen).join(new, "hash", "left_semi")
    return feedback.join(known.select(F.col("hash").alias("_known")), hashed == F.col("_known"), "left_anti")


def load(
    tables: Tables,
    feedback: DataFrame,
    categories: DataFrame,
    issues: DataFrame,
    today: datetime.date,
    batch: str | None = None,
    since: datetime.date | None = None,
    once: bool = False,
) -> int:
    """Append what is new to the tables; returns the batch's first ID.

    New is what is dated after ``since``, by default the latest date in the log; with
    ``once`` a text that an earlier load with ``once`` has brought is not new, whatever its
    date. Mark and top come from the log entry before, as does what counts; every table is
    written as a part of its own and then the next entry, which alone makes the batch count.
    If another load has taken that entry, all is decided anew after it. So a load that was
    cut short is repeated whole, one that was finished under the same name does nothing,
    and loads at once are as loads one after the other. Children are loaded with their
    feedback or not at all; feedback without a readable date is set aside, each text once.
    """
    tables.create()
    batch = batch or uuid.uuid4().hex
    with scratch():
        return _load(tables, feedback, categories, issues, today, batch, since, once)


def _load(tables: Tables, feedback, categories, issues, today, batch: str, since, once: bool) -> int:
    stored = False
    while True:
        seen = tables.snapshot()
        done = tables.log().filter(F.col("batch") == batch).first()
        if done is not None:
            return done["first_id"]
        if once and not stored:
            # Each table and the log's entry read it, some twice: made and hashed once.
            feedback, stored = materialize(feedback.withColumn("_hash", text_hash(F.col("original")))), True
        first_day = datetime.date.fromisoformat(fixed.FIRST_DATE)
        base = tables.spark.range(1).select(batch_base(F.lit(seen.top or 0).cast("long"), F.lit(today))).first()[0]
        start = since if since is not None else seen.mark or first_day
        part = f"{batch}-{uuid.uuid4().hex[:8]}"
        new, _ = newer_than(feedback, [], F.lit(start))
        if once:
            new = first_times(tables, new, seen, F.col("_hash"))
        loaded = new.filter(F.col("translated").isNotNull())
        mine = lambda child: child.join(loaded.select("id"), "id", "left_semi")
        aside = undated(feedback).join(
            tables.read("undated", seen).select(F.col("original_reviews").alias("original")), "original", "left_anti"
        )
        written = {
            "categorization": category_rows(mine(categories), base),
            "key_issue": issue_rows(mine(issues), base),
            "undated": undated_rows(aside, base),
            "reviews": review_rows(loaded, base),
        }
        if once:
            written[TEXTS] = loaded.select(F.col("_hash").alias("hash")).distinct()
        for name, rows in written.items():
            tables.write(name, rows, part)
        given = F.max(F.when(F.col("translated").isNotNull() | F.col("date").isNull(), F.col("id")))
        dated = F.max(F.when(F.col("translated").isNotNull(), F.col("date").cast("date")))
        facts = new.unionByName(aside).agg(given.alias("top"), dated.alias("mark")).first()
        top = None if facts["top"] is None else base + facts["top"]
        if tables.commit(seen, batch, base, top, facts["mark"], [f"{name}/{part}" for name in written]):
            return base
        for name in written:
            tables.remove(name, part)


def stream_start(tables: Tables, name: str) -> datetime.date:
    """The mark when the stream ``name`` first started, kept in the log."""
    tables.create()
    batch = f"{name}-start"
    while True:
        seen = tables.snapshot()
        known = tables.log().filter(F.col("batch") == batch).first()
        if known is not None:
            return known["mark"]
        mark = seen.mark or datetime.date.fromisoformat(fixed.FIRST_DATE)
        if tables.commit(seen, batch, mark=mark):
            return mark
