"""The three persisted tables: reviews, categorization, key_issue."""

from __future__ import annotations

import datetime
import json
import time
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from murmur import fixed
from murmur.functions import values as V
from murmur.session import create_new, delete_path

SCHEMAS = {
    "reviews": (
        "id string, store string, device string, source string, country string,"
        " review_date date, version double, rating string, original_reviews string,"
        " translated_reviews string, sentiment string, spam int, verb_phrases string,"
        " noun_phrases string, clear_filters string"
    ),
    "categorization": "id string, feature string, component string, the_action string",
    "key_issue": "id string, key_issue string",
    # Feedback whose date could not be read; it has no rows in the other tables.
    "undated": "id string, store string, device string, source string, country string, original_reviews string",
}


#: Hashes of texts that were loaded once, for loads that fold copies across loads.
TEXTS = "texts"
ALL = {**SCHEMAS, TEXTS: "hash binary"}

LOG_SCHEMA = (
    "number long, batch string, first_id long, top long, mark date, adds array<string>, drops array<string>, whole boolean"
)
INDEX_SCHEMA = "file string, low long, high long, others boolean"
#: Rows of a file that compaction writes, and its bytes, about: one task sorts them.
ROWS_A_FILE = 1_000_000
BYTES_A_FILE = 64 << 20
#: How the batch of a compaction's entry begins; its part and bounds follow.
COMPACTION = "compaction"


@dataclass(frozen=True)
class Snapshot:
    """What the log says up to one entry: its number, the top ID given out, the latest date,
    and the live parts of each table."""

    number: int
    top: int | None
    mark: datetime.date | None
    parts: dict[str, list[str]]


class Tables:
    """Parquet tables under one root folder, and a log of what counts.

    A load writes a part, a folder of its own, to every table, and then one entry to the
    log, numbered after the entry it has read. An entry is created only if its number is
    free, so of two loads that read the same entry one wins, and the other reads again: IDs
    and dates always follow from all loads before. A part that no entry names, because its
    load was cut short or lost, is not read. Compaction replaces parts by one in order of
    ID under a new entry; who reads an older one still finds its files until ``vacuum``.
    Each part has an index of its files' least and greatest ID, which lookups read first.
    """

    def __init__(self, spark: SparkSession, root: str, schemas: dict[str, str] = ALL):
        self.spark = spark
        self.root = root.rstrip("/")
        self.schemas = schemas

    def _fields(self, name: str) -> list[list[str]]:
        return [f.strip().split(" ") for f in self.schemas[name].split(",")]

    def path(self, name: str, part: str | None = None) -> str:
        return f"{self.root}/{name}" + (f"/part={part}" if part else "")

    def create(self) -> None:
        """Create missing tables, empty."""
        for name in self.schemas:
            self.spark.createDataFrame([], self.schemas[name]).write.mode("ignore").parquet(self.path(name, "first"))
        self._enter(0, "", None, None, None, [f"{name}/first" for name in self.schemas], [], True)

    # --- the log ---

    def log(self) -> DataFrame:
        """(number, batch, first_id, top, mark, adds, drops, whole) of every entry."""
        return self.spark.read.schema(LOG_SCHEMA).json(f"{self.root}/loads")

    def snapshot(self) -> Snapshot:
        """What counts now. Entries before the last one that names all parts aren't fetched."""
        log = self.log()
        last = log.filter("whole").agg(F.max("number")).first()[0]
        if last is None:
            raise ValueError(f"no tables under {self.root}")
        live: dict[str, None] = {}
        number, top, mark = last, None, None
        for row in sorted(log.filter(F.col("number") >= last).collect(), key=lambda r: r["number"]):
            number = row["number"]
            top = max((x for x in (top, row["top"]) if x is not None), default=None)
            mark = max((x for x in (mark, row["mark"]) if x is not None), default=None)
            if row["whole"]:
                live = {}
            for gone in row["drops"]:
                live.pop(gone, None)
            live |= dict.fromkeys(row["adds"])
        parts = {name: [x.split("/", 1)[1] for x in live if x.split("/", 1)[0] == name] for name in self.schemas}
        return Snapshot(number, top, mark, parts)

    def _enter(self, number: int, batch: str, first_id, top, mark, adds: list[str], drops: list[str], whole: bool) -> bool:
        row = {"number": number, "batch": batch, "first_id": first_id, "top": top, "mark": str(mark) if mark else None, "adds": adds, "drops": drops, "whole": whole}
        return create_new(self.spark, f"{self.root}/loads/{number:012d}.json", json.dumps(row) + "\n")

    def commit(self, seen: Snapshot, batch: str, first_id=None, top=None, mark=None, adds=(), drops=()) -> bool:
        """Enter a finished load after ``seen``; false if another one was entered since.
        ``adds`` and ``drops`` are parts as ``table/part``."""
        return self._enter(seen.number + 1, batch, first_id, top, mark, list(adds), list(drops), False)

    def enter(self, batch: str, first_id: int | None, top: int | None, mark, adds=(), drops=()) -> None:
        """Enter what does not depend on other loads, after whatever is there."""
        while not self.commit(self.snapshot(), batch, first_id, top, mark, adds, drops):
            pass

    # --- rows ---

    def select(self, name: str) -> str:
        """SQL for the rows of a table that count when it is run."""
        entries = f"json.`{self.root}/loads`"
        live = (
            f"SELECT part FROM (SELECT number, true AS adds, explode(adds) AS part FROM {entries}"
            f" WHERE number >= (SELECT max(number) FROM {entries} WHERE whole)"
            f" UNION ALL SELECT number, false, explode(drops) FROM {entries}) WHERE part LIKE '{name}/%'"
            " GROUP BY part HAVING max_by(adds, number)"
        )
        columns = ", ".join(f"CAST(t.{c} AS {t}) AS {c}" for c, t in self._fields(name))
        return f"SELECT {columns} FROM ({live}) l JOIN parquet.`{self.path(name)}` t ON l.part = concat('{name}/', t.part)"

    def register(self, database: str) -> None:
        """Make the tables known to the catalog, as views on what counts when they are read."""
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
        for name in self.schemas:
            self.spark.sql(f"CREATE OR REPLACE VIEW {database}.{name} AS {self.select(name)}")

    def read(self, name: str, seen: Snapshot | None = None) -> DataFrame:
        """The rows that count now, or counted at ``seen``."""
        parts = (seen or self.snapshot()).parts[name]
        if not parts:
            return self.spark.createDataFrame([], self.schemas[name])
        return self.spark.read.schema(self.schemas[name]).parquet(*[self.path(name, p) for p in parts])

    def read_with_numbers(self, name: str) -> DataFrame:
        return self.read(name).withColumn("id", F.col("id").cast("long"))

    def write(self, name: str, rows: DataFrame, part: str) -> None:
        """One bulk write of a part, which counts once an entry names it, and its index."""
        shaped = rows.select(*[F.col(c).cast(t).alias(c) for c, t in self._fields(name)])
        shaped.write.mode("overwrite").parquet(self.path(name, part))
        if "id" in shaped.columns:
            stored = self.spark.read.schema(self.schemas[name]).parquet(self.path(name, part))
            number = F.col("id").try_cast("long")
            files = stored.select(F.col("_metadata.file_name").alias("file"), "id").groupBy("file").agg(
                F.min(number).alias("low"), F.max(number).alias("high"), F.bool_or(number.isNull()).alias("others")
            )
            files.coalesce(1).write.mode("overwrite").parquet(self.path(f"index/{name}", part))

    def append(self, name: str, rows: DataFrame, batch: str | None = None) -> None:
        """One bulk write; an empty batch adds no data. Rows of a named batch are read once
        its part is in the log, others at once."""
        part = batch or uuid.uuid4().hex
        self.write(name, rows, part)
        if batch is None:
            self.enter(part, None, None, None, [f"{name}/{part}"])

    def clear(self, name: str) -> None:
        """Delete all rows that count now; their files stay for who reads an older entry."""
        done = False
        while not done:
            seen = self.snapshot()
            done = self.commit(seen, uuid.uuid4().hex, drops=[f"{name}/{p}" for p in seen.parts[name]])

    def find(self, name: str, id_: str) -> DataFrame:
        """The rows with an ID, from the files whose range of IDs has it."""
        files = self.files_with(name, id_)
        if not files:
            return self.spark.createDataFrame([], self.schemas[name])
        return self.spark.read.schema(self.schemas[name]).parquet(*files).filter(F.col("id") == id_)

    def files_with(self, name: str, id_: str) -> list[str]:
        """The files that may have an ID, as their index says."""
        parts = self.snapshot().parts[name]
        if not parts:
            return []
        wanted = F.lit(id_).try_cast("long")
        index = self.spark.read.schema(f"{INDEX_SCHEMA}, part string").option("basePath", self.path(f"index/{name}"))
        rows = index.parquet(*[self.path(f"index/{name}", p) for p in parts if p != "first"]) if parts != ["first"] else None
        if rows is None:
            return []
        has = F.when(wanted.isNull(), F.col("others")).otherwise(wanted.between(F.col("low"), F.col("high")))
        return [f"{self.path(name, r['part'])}/{r['file']}" for r in rows.filter(has).select("part", "file").collect()]

    # --- upkeep ---

    def stored_bytes(self, name: str, seen: Snapshot) -> int:
        """Bytes of a table's files that counted at ``seen``."""
        paths = [self.spark._jvm.org.apache.hadoop.fs.Path(self.path(name, p)) for p in seen.parts[name]]
        conf = self.spark._jsc.hadoopConfiguration()
        return sum(p.getFileSystem(conf).getContentSummary(p).getLength() for p in paths)

    def compact(self, rows_a_file: int = ROWS_A_FILE, bytes_a_file: int = BYTES_A_FILE) -> bool:
        """Merge the parts of every table into one, in order of ID, and name all that counts
        in one entry; false, and nothing changes, if a load was entered meanwhile. A table
        that a compaction with the same bounds merged, and that no load added to since, stays
        as it is."""
        seen = self.snapshot()
        part, bounds = uuid.uuid4().hex, f"{rows_a_file} rows {bytes_a_file} bytes"
        merged = self._merged(bounds)
        kept = {}
        for name in self.schemas:
            kept[name] = part
            if len(seen.parts[name]) == 1 and seen.parts[name][0] in merged.get(name, ()):
                kept[name] = seen.parts[name][0]
                continue
            rows = self.read(name, seen)
            files = max(1, -(-rows.count() // rows_a_file), -(-self.stored_bytes(name, seen) // bytes_a_file))
            # By ID, where there is one, as a number first; else by all columns but lists, of
            # which the first may have few values.
            own = F.col("id" if "id" in rows.columns else rows.columns[0])
            order = [own.try_cast("long"), own] if "id" in rows.columns else [F.col(c) for c, t in rows.dtypes if not t.startswith("array")]
            self.write(name, rows.repartitionByRange(files, *order).sortWithinPartitions(*order), part)
        adds = [f"{name}/{kept[name]}" for name in self.schemas]
        return self._enter(seen.number + 1, f"{COMPACTION} {part} {bounds}", None, seen.top, seen.mark, adds, [], True)

    def _merged(self, bounds: str) -> dict[str, set[str]]:
        """The parts of each table that the last compaction named, if it had these bounds."""
        last = self.log().filter("whole").orderBy(F.desc("number")).first()
        found: dict[str, set[str]] = {}
        if last["batch"].startswith(f"{COMPACTION} ") and last["batch"].endswith(f" {bounds}"):
            for add in last["adds"]:
                found.setdefault(add.split("/", 1)[0], set()).add(add.split("/", 1)[1])
        return found

    def vacuum(self, hours: float = 24.0) -> int:
        """Remove parts that no longer count and were written ``hours`` ago or before, which
        includes those of loads cut short; returns how many. Older readers must be done."""
        live = self.snapshot().parts
        jvm, gone = self.spark._jvm, 0
        for name in self.schemas:
            folder = jvm.org.apache.hadoop.fs.Path(self.path(name))
            fs = folder.getFileSystem(self.spark._jsc.hadoopConfiguration())
            for status in fs.listStatus(folder):
                part = status.getPath().getName().removeprefix("part=")
                old = status.getModificationTime() <= (time.time() - 3600 * hours) * 1000
                if old and part not in live[name] and part != "first":
                    self.remove(name, part)
                    gone += 1
        return gone

    def remove(self, name: str, part: str) -> None:
        """Remove the files of a part that doesn't count."""
        delete_path(self.spark, self.path(name, part))
        delete_path(self.spark, self.path(f"index/{name}", part))


def _id(base) -> Column:
    return (F.col("id") + F.lit(base)).cast("string").alias("id")


def review_rows(feedback: DataFrame, base: int) -> DataFrame:
    """Feedback as persisted; rows without translated text are left out."""
    return feedback.filter(F.col("translated").isNotNull()).select(
        _id(base),
        "store",
        "device",
        "source",
        "country",
        F.col("date").alias("review_date"),
        "version",
        "rating",
        V.stored_text(F.col("original")).alias("original_reviews"),
        V.stored_text(F.col("translated")).alias("translated_reviews"),
        "sentiment",
        F.col("spam").cast("int").alias("spam"),
        F.array_join("verb_phrases", ", ").alias("verb_phrases"),
        F.array_join("noun_phrases", ", ").alias("noun_phrases"),
        F.lit(fixed.CLEAR_FILTERS).alias("clear_filters"),
    )


def undated_rows(feedback: DataFrame, base: int) -> DataFrame:
    return feedback.select(_id(base), "store", "device", "source", "country", F.col("original").alias("original_reviews"))


def category_rows(categories: DataFrame, base: int, separator: str = ", ") -> DataFrame:
    return categories.select(
        _id(base), "feature", "component", F.array_join("actions", separator).alias("the_action")
    )


def issue_rows(issues: DataFrame, base: int) -> DataFrame:
    return issues.select(_id(base), F.col("issue").alias("key_issue"))
