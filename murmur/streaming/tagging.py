"""The same cleaning and tagging on a stream of feedback.

Cleaning is row by row and tagging joins to static dictionaries, so both run on the
micro-batches of a stream. What was loaded before the stream first started is told by the
high-water mark of that moment; from then on the stream's checkpoint says what is new, so
late rows and further files of a day are loaded. A batch that is repeated after a failure
replaces what it wrote.
"""

from __future__ import annotations

import datetime
import hashlib

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from murmur.operators.rows import spam_filter
from murmur.plans.incremental import load, stream_start
from murmur.plans.pipeline import Lexicons, preprocess, tag
from murmur.session import scratch
from murmur.sources.tables import Tables


def clean_stream(feedback: DataFrame, text: str = "original") -> DataFrame:
    """Scrubbed rows that are not spam, as a stream."""
    return spam_filter(feedback, text)


def load_stream(
    feedback: DataFrame,
    lexicons: Lexicons,
    tables: Tables,
    checkpoint: str,
    order_by: str,
    today=datetime.date.today,
    once: bool = False,
    **trigger,
) -> StreamingQuery:
    """Tag and append each micro-batch; with ``once`` a text comes once over all of them,
    and over all loads that ask for the same."""
    name = hashlib.sha256(checkpoint.encode()).hexdigest()[:16]
    since = stream_start(tables, name)

    def batch(df: DataFrame, number: int) -> None:
        if df.isEmpty():
            return
        with scratch():
            cleaned = preprocess(df, lexicons.memory, lexicons.sentiment, order_by)
            whole, categories, issues = tag(cleaned, lexicons)
            load(tables, whole, categories, issues, today(), f"{name}-{number}", since, once)

    writer = feedback.writeStream.option("checkpointLocation", checkpoint).foreachBatch(batch)
    return writer.trigger(**(trigger or {"availableNow": True})).start()
