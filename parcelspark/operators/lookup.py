"""Joins against key lists, dimensions and rule tables."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

# Rows of a side that may be broadcast. Keys and dimensions are narrow, so this stays within
# tens of megabytes per executor.
MAX_BROADCAST_ROWS = 500_000
# A table that Spark estimates below this before it runs is broadcast without being counted.
MAX_ESTIMATED_BYTES = 8 << 20
# Bytes of listed keys, and of key hashes, that may be broadcast; what a row and a hash take in a hash table.
MAX_KEY_BYTES, ROW_BYTES = 64 << 20, 48
MAX_HASH_BYTES, HASH_BYTES = 128 << 20, 40

HASH = "_key_hash"


def estimated_bytes(df: DataFrame) -> int | None:
    """What Spark takes the size of `df` to be from files and plan, without a job; None where it does not say."""
    try:
        return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    except AttributeError:
        return None


def bounded_broadcast(df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """`df` with a broadcast hint if it is small by Spark's estimate, or counted to be within
    `max_rows`; else `df` as it is: Spark then joins by shuffle. Counting reads no columns and
    passes one number per task."""
    estimate = estimated_bytes(df)
    if max_rows == MAX_BROADCAST_ROWS and estimate is not None and estimate <= MAX_ESTIMATED_BYTES:
        return F.broadcast(df)
    return F.broadcast(df) if df.count() <= max_rows else df


@dataclass(frozen=True)
class Keys:
    """A key list.

    `few` keys are broadcast and filter a table before it is reduced. Of more keys, 8-byte hashes
    are broadcast (`hashes`): they filter a table before it is reduced, all but a few chance
    matches, and the keys themselves filter what is left. Of still more, the table is matched by
    shuffle.
    """

    df: DataFrame
    on: str
    few: bool
    hashes: DataFrame | None = None


def key_list(keys: DataFrame, on: str, rows: int, key_bytes: int, max_rows: int = MAX_BROADCAST_ROWS, max_hash_bytes: int = MAX_HASH_BYTES) -> Keys:
    """A key list whose rows and bytes are known."""
    keys = keys.select(on)
    hashes = None
    if rows * HASH_BYTES <= max_hash_bytes:
        hashes = F.broadcast(keys.select(F.xxhash64(on).alias(HASH)))
    few = rows <= max_rows and key_bytes + rows * ROW_BYTES <= MAX_KEY_BYTES
    return Keys(F.broadcast(keys) if few else keys, on, few, hashes)


def as_keys(
    spark: SparkSession,
    keys: DataFrame | Iterable,
    on: str = "shipment_id",
    max_rows: int = MAX_BROADCAST_ROWS,
    max_hash_bytes: int = MAX_HASH_BYTES,
) -> Keys:
    """A key list out of a DataFrame, which is counted, or plain values."""
    if isinstance(keys, DataFrame):
        rows, key_bytes = keys.agg(F.count("*"), F.coalesce(F.sum(F.octet_length(F.col(on).cast("string"))), F.lit(0))).first()
    else:
        values = list(keys)
        keys = spark.createDataFrame([(k,) for k in values], f"{on} string")
        rows, key_bytes = len(values), sum(len(str(k).encode()) for k in values)
    return key_list(keys, on, rows, key_bytes, max_rows, max_hash_bytes)


def hashed(df: DataFrame, keys: Keys, on: str | None = None) -> DataFrame:
    """Rows of `df` whose key's hash is among those of the list: all listed ones, NULL too, and a
    few others. All rows if there are too many hashes to broadcast."""
    if keys.hashes is None:
        return df
    return df.join(keys.hashes, F.xxhash64(on or keys.on) == F.col(HASH), "left_semi")


def keyed(df: DataFrame, keys: Keys) -> DataFrame:
    """Rows of `df` whose key is listed. Repeated keys do not repeat rows."""
    return (df if keys.few else hashed(df, keys)).join(keys.df, keys.on, "left_semi")


def inline_table(spark: SparkSession, schema: str, rows: Sequence[tuple]) -> DataFrame:
    """Fixed rows as a table of literals: Spark knows its size when it plans."""
    fields = T.StructType.fromDDL(schema).fields
    casts = ", ".join(f"CAST({f.name} AS {f.dataType.simpleString()}) AS {f.name}" for f in fields)
    quoted = lambda v: "NULL" if v is None else repr(v)
    values = ", ".join("(" + ", ".join(quoted(v) for v in row) + ")" for row in rows)
    return spark.sql(f"SELECT {casts} FROM VALUES {values} AS t({', '.join(f.name for f in fields)})")


def lookup_rules(
    df: DataFrame, rules: DataFrame, on: Mapping[str, Column], out: Mapping[str, str], fixed: bool = False
) -> DataFrame:
    """Left join to a rule table. `on`: rule column -> key expression over `df`; `out`: rule
    column -> output name. No match gives NULL. The table is counted before it is broadcast,
    unless it is `fixed`: literals out of `inline_table`."""
    side = rules.select(
        *[F.col(c).alias(f"_on_{c}") for c in on], *[F.col(c).alias(n) for c, n in out.items()]
    )
    keyed_df = df.select("*", *[e.alias(f"_key_{c}") for c, e in on.items()])
    condition = [F.col(f"_key_{c}") == F.col(f"_on_{c}") for c in on]
    names = [f"_{p}_{c}" for p in ("key", "on") for c in on]
    side = F.broadcast(side) if fixed else bounded_broadcast(side)
    return keyed_df.join(side, condition, "left").drop(*names)


def role(dim: DataFrame, key: str, attributes: Mapping[str, str], on: str) -> DataFrame:
    """A dimension renamed for one of the roles it plays: key -> `on`, attributes renamed."""
    return dim.select(F.col(key).alias(on), *[F.col(c).alias(n) for c, n in attributes.items()])
