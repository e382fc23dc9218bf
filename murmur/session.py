"""Session settings and the shared scratch folder."""

from __future__ import annotations

import atexit
import os
import re
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession

# Runtime SQL settings the plans rely on. AQE picks broadcast joins from measured
# shuffle sizes, merges small partitions and splits skewed ones; forcing the skew
# split keeps hot join keys apart even when an aggregation on the same key follows.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Rows of some ten megabytes go to Python one or two at a time.
    "spark.sql.execution.arrow.maxBytesPerBatch": "16m",
    "spark.sql.session.timeZone": "UTC",
}


def tune(spark: SparkSession) -> SparkSession:
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def get_spark(app: str = "murmur", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return tune(builder.getOrCreate())


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Where it is unset, a session whose only machine is this one gets a folder that goes
    when the program ends. Any other must name one: a machine-local folder would be
    lost with its executor.
    """
    context = spark.sparkContext
    folder = context.getConf().get("spark.checkpoint.dir") or context.getCheckpointDir()
    if folder is None:
        if not re.fullmatch(r"local(\[.*\])?", context.master):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="murmur-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        context.setCheckpointDir(folder)
    return folder.rstrip("/")


#: What the open scopes have written, the innermost last.
_scopes: list[list[tuple[SparkSession, str]]] = []


def delete_path(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def create_new(spark: SparkSession, path: str, text: str) -> bool:
    """Write ``text`` to ``path`` if nothing is there; whether it did.

    The whole file appears at once, and of several writers one succeeds: by a link in a
    local folder, elsewhere by a rename that doesn't overwrite.
    """
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    scheme = target.getFileSystem(spark._jsc.hadoopConfiguration()).getScheme()
    return _link_new(target.toUri().getPath(), text) if scheme == "file" else _rename_new(spark, target, text)


def _link_new(path: str, text: str) -> bool:
    folder = os.path.dirname(path)
    os.makedirs(folder, exist_ok=True)
    # A name that readers of the folder pass over.
    made = f"{folder}/.{uuid.uuid4().hex}"
    with open(made, "w", encoding="utf-8") as out:
        out.write(text)
    try:
        os.link(made, path)
    except FileExistsError:
        return False
    finally:
        os.remove(made)
    return True


def _rename_new(spark: SparkSession, target, text: str) -> bool:
    hadoop, conf = spark._jvm.org.apache.hadoop.fs, spark._jsc.hadoopConfiguration()
    fs = target.getFileSystem(conf)
    made = hadoop.Path(target.getParent(), f".{uuid.uuid4().hex}")
    out = fs.create(made, True)
    out.write(bytearray(text.encode()))
    out.close()
    keep = spark.sparkContext._gateway.new_array(getattr(hadoop, "Options$Rename"), 0)
    try:
        hadoop.FileContext.getFileContext(target.toUri(), conf).rename(made, target, keep)
    except Py4JJavaError as failed:
        fs.delete(made, False)
        if "FileAlreadyExists" not in failed.java_exception.getClass().getName():
            raise
        return False
    return True


@contextmanager
def scratch() -> Iterator[None]:
    """A scope that owns what is written to the shared folder inside it, and removes it
    at its end. Nothing that reads from there may be used after."""
    _scopes.append([])
    try:
        yield
    finally:
        for spark, path in _scopes.pop():
            delete_path(spark, path)


def scratch_path(spark: SparkSession, name: str = "murmur") -> str:
    """A new path in the shared folder, owned by the innermost scope."""
    path = f"{scratch_dir(spark)}/{name}-{uuid.uuid4().hex}"
    if _scopes:
        _scopes[-1].append((spark, path))
    return path


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Cuts the lineage, survives lost executors, and gives later stages pruned
    columns and real sizes.
    """
    return materialize_measured(df)[0]


def materialize_measured(df: DataFrame, **metrics: Column) -> tuple[DataFrame, dict]:
    """``materialize``, with aggregates observed while writing."""
    spark = df.sparkSession
    path = scratch_path(spark)
    seen = Observation()
    if metrics:
        df = df.observe(seen, *[m.alias(name) for name, m in metrics.items()])
    df.write.parquet(path)
    stored = spark.read.schema(df.schema).parquet(path)
    stored._scratch = path
    return stored, seen.get if metrics else {}


def materialize_alone(make: Callable[[], DataFrame]) -> DataFrame:
    """``materialize`` of what ``make`` returns; what was written to make it is removed."""
    _scopes.append([])
    try:
        df = make()
    finally:
        written = _scopes.pop()
        if _scopes:
            _scopes[-1].extend(written)
    stored = materialize(df)
    for spark, path in written:
        delete_path(spark, path)
    return stored


def discard(df: DataFrame) -> None:
    """Remove what ``materialize`` wrote for ``df``, once nothing reads it any more."""
    path = getattr(df, "_scratch", None)
    if path is not None:
        delete_path(df.sparkSession, path)


def spread(df: DataFrame) -> DataFrame:
    """``df`` in as many partitions as the setting ``spark.murmur.readPartitions`` names,
    or as it is where that is unset.

    For inputs that are one small file, which would keep heavy work on one core.
    """
    parts = df.sparkSession.conf.get("spark.murmur.readPartitions", None)
    return df.repartition(int(parts)) if parts else df
