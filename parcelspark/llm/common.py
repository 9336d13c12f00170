"""Helpers that several operators share: tables, checkpoints, words, held-out rules."""

from __future__ import annotations

import tempfile
import zlib
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: Lower-cases the bytes A-Z and no other.
LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))

#: The white space that parts words, as a pattern of Java and of Python.
SPACE = r"[\x20\x09-\x0D]+"

_CLEAN = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def scratch_folder(spark: SparkSession) -> str:
    """The shared folder of the session, spark.checkpoint.dir. Where none is set a temporary one is made on a local
    master; a cluster, whose machines do not share one, raises an error."""
    context = spark.sparkContext
    if not context.getCheckpointDir():
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder and not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        context.setCheckpointDir(folder or tempfile.mkdtemp(prefix="parcelspark-"))
    return context.getCheckpointDir()


def remove(spark: SparkSession, path: str) -> None:
    """Remove a folder of the shared file system."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def has_words(text: Column) -> Column:
    return text.rlike(r"[^\x20\x09-\x0D]")


def checkpoint(df: DataFrame) -> DataFrame:
    """Write a frame to the shared folder and go on from there; shuffle files that led to it are removed."""
    spark = df.sparkSession
    scratch_folder(spark)
    before = spark.conf.get(_CLEAN, "false")
    spark.conf.set(_CLEAN, "true")
    try:
        return df.select("*").checkpoint()  # a new query, which takes the setting up
    finally:
        spark.conf.set(_CLEAN, before)


def text_batches(df: DataFrame, rows: int = 500) -> DataFrame:
    """The frame, with its session set to hand texts to Python in batches of few rows: they may be long."""
    conf = df.sparkSession.conf
    if int(conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > rows:
        conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    return df


@contextmanager
def batches_of(spark: SparkSession, rows: int) -> Iterator[None]:
    """Within it, actions hand rows to Python in batches of at most `rows`; afterwards the session is as before."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def utf8(text: str | None) -> bytes:
    """The bytes of a text; of a null none; a lone surrogate becomes a question mark."""
    return text.encode("utf-8", "replace") if text else b""


def words(text: str | None) -> list[bytes]:
    """Words of a text as bytes: what stands between ASCII blanks, tabs and line ends."""
    return utf8(text).split()


def lower_words(text: str | None) -> list[bytes]:
    return utf8(text).translate(LOWER).split()


def word_count(text: Column) -> Column:
    """Number of words of a text column, 0 for null."""
    starts = F.regexp_count(text, F.lit(r"(?<![^\x20\x09-\x0D])[^\x20\x09-\x0D]"))
    return F.coalesce(starts, F.lit(0)).cast("long")


def remainder(doc_id: int | None, parts: int) -> int:
    """crc32 of the id as text, modulo parts; a null id counts as an empty text."""
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % parts


def remainder_column(doc_id: Column, parts: int) -> Column:
    """The same in Spark."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % parts


def unused(df: DataFrame, name: str) -> str:
    """The name, with underscores put before it until no column of the frame has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def with_fields(df: DataFrame, **kinds: str) -> StructType:
    """The schema of a frame with further fields."""
    schema = StructType(list(df.schema.fields))
    for name, kind in kinds.items():
        schema.add(name, kind)
    return schema
