"""Term tables that are kept over loads, so that weights need no old text again."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from murmur.operators.similarity import term_counts, weighed
from murmur.session import scratch
from murmur.sources.tables import Tables


def term_tables(spark: SparkSession, root: str, key: str, by: list[str]) -> Tables:
    """Tables of term counts under one root, with a log like that of the feedback. ``key``
    is a long, the columns of ``by`` are strings. A text's terms are in one row."""
    groups = ", ".join(f"{c} string" for c in by)
    schemas = {
        "counts": f"{groups}, {key} long, terms array<string>, tfs array<long>",
        "df": f"{groups}, term string, n_texts long",
        "totals": f"{groups}, n long",
    }
    tables = Tables(spark, root, schemas)
    tables.create()
    if not tables.log().filter(F.exists("adds", lambda part: part.startswith("tf/"))).isEmpty():
        raise ValueError(f"{root} has a row a term; its texts must be added to new tables")
    return tables


def add_texts(tables: Tables, bags: DataFrame, key: str, by: list[str], batch: str | None = None) -> None:
    """Add the counts of (by, key, bag), texts that no batch before had. A batch that was
    finished under the same name adds nothing; one that was cut short is not counted."""
    batch = batch or uuid.uuid4().hex
    if not tables.log().filter(F.col("batch") == batch).isEmpty():
        return
    part = f"{batch}-{uuid.uuid4().hex[:8]}"
    with scratch():
        counts, df, total = term_counts(bags, key, by)
        for name, rows in (("counts", counts), ("df", df), ("totals", total)):
            tables.write(name, rows, part)
    while True:
        seen = tables.snapshot()
        if not tables.log().filter(F.col("batch") == batch).isEmpty():
            for name in tables.schemas:  # the same batch, finished by another meanwhile
                tables.remove(name, part)
            return
        if tables.commit(seen, batch, adds=[f"{name}/{part}" for name in tables.schemas]):
            return


def stored_weights(tables: Tables, key: str, by: list[str]) -> DataFrame:
    """``similarity.weights`` of all texts that were added, from merged counts alone."""
    seen = tables.snapshot()
    df = tables.read("df", seen).groupBy(*by, "term").agg(F.sum("n_texts").alias("n_texts"))
    total = tables.read("totals", seen).groupBy(*by).agg(F.sum("n").alias("n"))
    return weighed(tables.read("counts", seen), df, total, key, by)
