"""SimHash near-duplicates by covering locality-sensitive hashing.

Each text gets a fingerprint of 64 bits. Fingerprints that differ in at most `radius` bits are linked. Bit positions
are assigned to the non-zero vectors of F_2^(radius+1) in turn; for each non-zero vector v there is a table that keeps
the positions whose vector has an odd product with v. The differing positions of a linked pair span at most `radius`
dimensions, so some v is orthogonal to all of them, and the pair agrees on everything that table keeps: no linked pair
is missed, without any chance in it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelspark.llm.common import checkpoint, lower_words, text_batches, unused
from parcelspark.llm.components import connected_components

BITS = 64
SEED = 42

#: Members of a bucket that are compared in one piece of work; larger buckets are cut into blocks of this size.
BLOCK = 2048


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """Unsigned fingerprint of a text; 0 without words."""
    tokens = lower_words(text)
    if not tokens:
        return 0
    if len(tokens) < shingle:
        shingles = [b" ".join(tokens)]
    else:
        shingles = map(b" ".join, zip(*(tokens[i:] for i in range(shingle))))
    n = max(1, len(tokens) - shingle + 1)
    hashes = np.fromiter((xxhash.xxh64_intdigest(s, SEED) for s in shingles), np.uint64, n)
    ones = np.zeros(BITS, np.int64)
    for at in range(0, n, 1 << 16):
        part = hashes[at : at + (1 << 16)].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > n, bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """(doc_id, h, fp): h is a hash that tells texts of one doc_id apart, fp the fingerprint as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [fingerprint(t.as_py(), shingle) for t in batch.column(2)]
            fps = pa.array(np.array(found, np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), fps], ["doc_id", "h", "fp"])

    rows = text_batches(docs).select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("h"), "text")
    return rows.mapInArrow(run, "doc_id long, h long, fp long")


def masks(radius: int) -> list[int]:
    """The kept positions of each table, as unsigned masks: 2^(radius+1) - 1 tables."""
    vectors = (1 << (radius + 1)) - 1
    of_bit = [1 + i % vectors for i in range(BITS)]
    return [sum(1 << i for i in range(BITS) if (of_bit[i] & v).bit_count() % 2) for v in range(1, vectors + 1)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _forest(fps: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links (indices) of a spanning forest of the fingerprints within the radius of each other.

    Breadth first: whatever is near the front is linked to it and leaves the rest, so that a dense group costs
    little more than one comparison for each member.
    """
    rest = np.arange(len(fps))
    left, right = [], []
    while len(rest):
        front, rest = rest[:1], rest[1:]
        while len(front) and len(rest):
            at, front = front[0], front[1:]
            near = np.bitwise_count(fps[rest] ^ fps[at]) <= radius
            if near.any():
                new = rest[near]
                left.append(np.full(len(new), at))
                right.append(new)
                front, rest = np.concatenate([front, new]), rest[~near]
    none = np.zeros(0, np.int64)
    return (np.concatenate(left), np.concatenate(right)) if left else (none, none)


def links(prints: DataFrame, radius: int = 3) -> DataFrame:
    """(a, b): links between distinct fingerprints (column fp) that give the same components as all links within
    the radius.

    Buckets with one member end in an aggregate. A bucket above BLOCK members is cut into blocks by a hash, and each
    pair of blocks is one piece of work of bounded size; a piece returns a spanning forest of its links, never pairs.
    """
    tables = F.array(
        *(F.struct(F.lit(i).alias("t"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("key")) for i, m in enumerate(masks(radius)))
    )
    rows = prints.select("fp", F.explode(tables).alias("x")).select("fp", "x.t", "x.key")
    sizes = rows.groupBy("t", "key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    mine = F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int")
    pieces = (
        rows.join(sizes, ["t", "key"])
        .withColumn("blocks", blocks)
        .withColumn("mine", mine)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select("t", "key", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"), "fp")
        .groupBy("t", "key", "i", "j")
        .agg(F.collect_list("fp").alias("fps"))
        .where(F.size("fps") > 1)
        .select("fps")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(0)
            ends = np.diff(column.offsets.to_numpy()).cumsum()
            flat = column.flatten().to_numpy().view(np.uint64)
            lengths = np.diff(np.concatenate([[0], ends]))
            a, b = [], []
            two = ends[lengths == 2]
            x, y = flat[two - 2], flat[two - 1]
            near = np.bitwise_count(x ^ y) <= radius
            a.append(x[near])
            b.append(y[near])
            for end, n in zip(ends[lengths > 2], lengths[lengths > 2]):
                fps = flat[end - n : end]
                i, j = _forest(fps, radius)
                a.append(fps[i])
                b.append(fps[j])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(c).view(np.int64)) for c in (a, b)], ["a", "b"]
            )

    return pieces.mapInArrow(run, "a long, b long")


def _grouped(docs: DataFrame, radius: int, shingle: int) -> tuple[DataFrame, DataFrame]:
    """Rows (doc_id, h, fp), and for each fp the first row of its component: (fp, first), rows without an id last."""
    prints = checkpoint(fingerprints(docs, shingle))
    first = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "h")
    nodes = checkpoint(prints.groupBy("fp").agg(F.min(first).alias("first")))
    labels = connected_components(links(nodes.select("fp"), radius))
    # only fingerprints with a link have a label; every other one is a component of its own
    named = nodes.join(labels.withColumnRenamed("node", "fp"), "fp", "left").withColumn(
        "component", F.coalesce("component", "fp")
    )
    firsts = named.groupBy("component").agg(F.min("first").alias("first"))
    return prints, checkpoint(named.drop("first").join(firsts, "component").select("fp", "first"))


def near_duplicates(docs: DataFrame, radius: int = 3, shingle: int = 3) -> DataFrame:
    """(doc_id, fp, component_id) for each row of docs (doc_id, text).

    component_id is the smallest doc_id that can be reached over links, the row's own included. Texts without words,
    nulls among them, have fingerprint 0 and link like any other. Equal fingerprints are one node, so copies cost one
    aggregate. A row with a null doc_id keeps its row and never gives a component its id (which is null if the whole
    component has none). Repeated rows stay repeated; further columns of docs are ignored; an empty table gives an
    empty table.
    """
    prints, firsts = _grouped(docs, radius, shingle)
    return prints.join(firsts, "fp").select("doc_id", "fp", F.col("first.doc_id").alias("component_id"))


def hex_digits(fp: Column) -> Column:
    """16 lowercase hex digits of a signed long column."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def keep_one(docs: DataFrame, radius: int = 3, shingle: int = 3) -> DataFrame:
    """One row of docs for each component, with all its columns: that of the smallest doc_id.

    If this doc_id repeats with several texts in one component, the text with the smallest hash stays; if the whole
    row repeats, one of the copies. A component without any doc_id keeps one of its rows. Nulls, empty texts, extra
    columns and empty tables are as in near_duplicates.
    """
    _, firsts = _grouped(docs, radius, shingle)
    id_, h, text_hash = (unused(docs, name) for name in ("_id", "_h", "_text_hash"))
    kept = firsts.select(F.col("first.doc_id").alias(id_), F.col("first.h").alias(h)).distinct()
    rows = docs.withColumn(text_hash, F.xxhash64("text"))
    same = F.col("doc_id").cast("long").eqNullSafe(F.col(id_)) & (F.col(text_hash) == F.col(h))
    return rows.join(kept, same, "left_semi").dropDuplicates(["doc_id", text_hash]).drop(text_hash)
