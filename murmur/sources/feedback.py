"""Reading feedback files and bringing them to one schema."""

from __future__ import annotations

import csv
import io
import re
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from murmur import fixed
from murmur.functions import agent, values as V

UNKNOWN = "Unknown"


def identify_source(columns: list[str], sources: dict = fixed.SOURCE_COLUMNS) -> str:
    """The first source whose plain columns are all present, else "Unknown"."""
    present = set(columns)
    for name, mapping in sources.items():
        wanted = {c for c in mapping.values() if isinstance(c, str) and c}
        if wanted <= present:
            return name
    return UNKNOWN


def _concat(columns: list[str], separator: str) -> Column:
    parts = []
    for i, c in enumerate(columns):
        parts += [F.lit(separator)] if i else []
        parts.append(F.coalesce(F.col(f"`{c}`"), F.lit("")))
    return F.concat(*parts)


def normalize_survey(df: DataFrame, keep: list[str] = ()) -> DataFrame:
    mapping = fixed.SOURCE_COLUMNS[fixed.SURVEY]
    agent_text = F.coalesce(F.col(f"`{mapping['device']}`"), F.lit(""))
    device = agent.device(agent_text)
    return df.select(
        agent.store_of(device).alias("store"),
        device.alias("device"),
        F.lit(fixed.SURVEY).alias("source"),
        V.recode(F.coalesce(F.col(f"`{mapping['country']}`"), F.lit(""))).alias("country"),
        V.to_date(F.col(f"`{mapping['date']}`")).alias("date"),
        agent.version(agent_text).alias("version"),
        F.lit("").alias("rating"),
        _concat(mapping["original"], "").alias("original"),
        F.lit("").alias("translated"),
        *keep,
    )


def normalize_store_reviews(df: DataFrame, keep: list[str] = ()) -> DataFrame:
    """As the survey's, without ``translated``; the union fills it with null."""
    mapping = fixed.SOURCE_COLUMNS[fixed.STORE_REVIEWS]
    plain = lambda name: F.coalesce(F.col(f"`{mapping[name]}`").cast("string"), F.lit(""))
    return df.select(
        plain("store").alias("store"),
        F.lit(fixed.UNKNOWN_DEVICE).alias("device"),
        F.lit(fixed.STORE_REVIEWS).alias("source"),
        V.recode(plain("country")).alias("country"),
        V.to_date(plain("date")).alias("date"),
        plain("version").try_cast("double").alias("version"),
        plain("rating").alias("rating"),
        _concat(mapping["original"], ". ").alias("original"),
        *keep,
    )


NORMALIZERS = {
    fixed.SURVEY: normalize_survey,
    fixed.STORE_REVIEWS: normalize_store_reviews,
}


def normalize(df: DataFrame, keep: list[str] = ()) -> DataFrame:
    """``df`` in the common schema, and its columns ``keep``."""
    source = identify_source(df.columns)
    if source == UNKNOWN:
        raise ValueError(f"no known source has these columns: {df.columns}")
    return NORMALIZERS[source](df, keep)


def union(frames: list[DataFrame]) -> DataFrame:
    result = frames[0]
    for df in frames[1:]:
        result = result.unionByName(df, allowMissingColumns=True)
    return result


#: Bytes of a file that are read at once for its header, and a record's signs.
HEADER_BLOCK = 4096
_RECORD = re.compile(r'(?:[^"\r\n]|"[^"]*")*')


def in_file_order(df: DataFrame) -> DataFrame:
    """``df``, as read from files, with ``line``: path, place of the split and a number
    that rises inside it. It orders rows alike however splits are packed into tasks."""
    return df.withColumn(
        "line",
        F.struct(
            F.col("_metadata.file_path").alias("path"),
            F.col("_metadata.file_block_start").alias("start"),
            F.monotonically_increasing_id().alias("n"),
        ),
    )


def _csv(spark: SparkSession, multi_line: bool = True):
    return (
        spark.read.option("header", True).option("multiLine", multi_line)
        .option("quote", '"').option("escape", '"')
    )


def _files(spark: SparkSession, folder: str) -> dict[str, list[str]]:
    """CSV and Parquet files under ``folder``, by kind."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).listFiles(path, True)
    kinds: dict[str, list[str]] = {"csv": [], "parquet": []}
    while found.hasNext():
        file = found.next().getPath()
        kind = file.getName().lower().rpartition(".")[2]
        inside = file.toUri().getPath()[len(path.toUri().getPath()) :].split("/")
        if kind in kinds and not any(part.startswith((".", "_")) for part in inside):
            kinds[kind].append(file.toString())
    return {kind: sorted(files) for kind, files in kinds.items()}


def _header(spark: SparkSession, path: str) -> tuple[str, ...]:
    """The names in a CSV file's first record, which may hold line breaks inside quotes. No
    more of the file is read than a few blocks that hold it."""
    file = spark._jvm.org.apache.hadoop.fs.Path(path)
    stream = file.getFileSystem(spark._jsc.hadoopConfiguration()).open(file)
    data, end = b"", 0
    try:
        while True:
            block = bytes(stream.readNBytes(HEADER_BLOCK))
            data += block
            text = data.decode("utf-8", "ignore").removeprefix("\ufeff")
            end = _RECORD.match(text).end()
            if end < len(text) and text[end] != '"' or len(block) < HEADER_BLOCK:
                return tuple(next(csv.reader(io.StringIO(text[:end] if end else text, newline="")), []))
    finally:
        stream.close()


def _headers(spark: SparkSession, files: list[str]) -> dict[tuple, list[str]]:
    """CSV files by their header."""
    layouts: dict[tuple, list[str]] = {}
    with ThreadPoolExecutor(16) as pool:
        for path, header in zip(files, pool.map(lambda f: _header(spark, f), files)):
            layouts.setdefault(header, []).append(path)
    return {header: sorted(paths) for header, paths in sorted(layouts.items())}


def read_feedback(spark: SparkSession, folder: str, multi_line: bool = True) -> DataFrame:
    """All feedback under ``folder`` and its sub-folders, in one schema, with ``line``.

    CSV files are grouped by their header, wherever they lie, and each group is one scan
    by its own names. With ``multi_line`` a quoted text may span lines, and a file is one
    task; without it large files are split. Parquet files are always split; those of one
    folder have one schema.
    """
    files, frames = _files(spark, folder), []
    if files["csv"]:
        for header, paths in _headers(spark, files["csv"]).items():
            schema = T.StructType([T.StructField(c, T.StringType()) for c in header])
            rows = in_file_order(_csv(spark, multi_line).schema(schema).option("enforceSchema", False).csv(paths))
            frames.append(normalize(rows.na.fill(""), ["line"]))
    by_folder: dict[str, list[str]] = {}
    for path in files["parquet"]:
        by_folder.setdefault(path.rpartition("/")[0], []).append(path)
    frames += [normalize(in_file_order(spark.read.parquet(*paths)), ["line"]) for paths in by_folder.values()]
    if not frames:
        raise ValueError(f"no CSV or Parquet files under {folder}")
    return union(frames)
