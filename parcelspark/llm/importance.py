"""Importance resampling of documents towards a target distribution.

Documents and target texts are bags of hashed word n-grams. A bucket that the target uses more often than the documents
do has a positive gain; a document's weight is the mean gain of its n-grams, and Gumbel noise that depends on its id
alone turns the highest sums into a sample without replacement in proportion to the weights.

N-grams are interned batch by batch in an open-addressed table of numpy arrays: XXH64 keys find the slot, bytes are
compared before two occurrences share one, and each slot holds the bucket and the count. Gains are then gathered by
the slot of each occurrence.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from parcelspark.llm.common import LOWER, batches_of, checkpoint, utf8

BUCKETS = 10_000
SEED = 2024

#: Bytes of text that are interned at a time; a longer text is interned alone.
PIECE = 1 << 22

_IS_WORD = np.ones(256, bool)
_IS_WORD[[*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]] = False

# The primes of XXH64.
_P1, _P2, _P3, _P4, _P5 = (
    np.uint64(p)
    for p in (11400714785074694791, 14029467366897019727, 1609587929392839161, 9650029242287828579, 2870177450012600261)
)


def _rotl(x: np.ndarray, bits: int) -> np.ndarray:
    return (x << np.uint64(bits)) | (x >> np.uint64(64 - bits))


def _xxh64_of_rows(rows: np.ndarray) -> np.ndarray:
    """XXH64 (seed 0) of each row of a matrix of bytes, less than 32 bytes a row."""
    n, length = rows.shape
    h = np.full(n, _P5 + np.uint64(length), np.uint64)
    at = 0
    while at + 8 <= length:
        lane = np.ascontiguousarray(rows[:, at : at + 8]).view("<u8")[:, 0]
        h = _rotl(h ^ (_rotl(lane * _P2, 31) * _P1), 27) * _P1 + _P4
        at += 8
    if at + 4 <= length:
        lane = np.ascontiguousarray(rows[:, at : at + 4]).view("<u4")[:, 0].astype(np.uint64)
        h = _rotl(h ^ (lane * _P1), 23) * _P2 + _P3
        at += 4
    for i in range(at, length):
        h = _rotl(h ^ (rows[:, i].astype(np.uint64) * _P5), 11) * _P1
    h = (h ^ (h >> np.uint64(33))) * _P2
    h = (h ^ (h >> np.uint64(29))) * _P3
    return h ^ (h >> np.uint64(32))


def keys_of(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """XXH64 of each stretch of the bytes: stretches of one length at once, those of 32 bytes and more one by one."""
    keys = np.empty(len(starts), np.uint64)
    order = np.argsort(lengths, kind="stable")
    cuts = np.flatnonzero(np.diff(lengths[order])) + 1
    for group in np.split(order, cuts) if len(order) else ():
        length = int(lengths[group[0]])
        if length < 32:
            with np.errstate(over="ignore"):
                keys[group] = _xxh64_of_rows(data[starts[group][:, None] + np.arange(length)])
        else:
            keys[group] = [xxhash.xxh64_intdigest(data[s : s + length].tobytes()) for s in starts[group]]
    return keys


def ngrams(texts: list[bytes], longest: int = 1) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The bytes of all words parted by single blanks, start and length of each n-gram of 1 to `longest` words in
    them, the text it is from, and the number of words of each text."""
    raw = np.frombuffer(b"\0".join([*texts, b""]).translate(LOWER), np.uint8)
    word = _IS_WORD[raw]
    begins = word.copy()
    begins[1:] &= ~word[:-1]
    gap = np.zeros(len(word), bool)
    gap[1:] = word[:-1] & ~word[1:]
    kept = word | gap
    place = np.cumsum(kept) - 1
    data = np.where(gap, np.uint8(32), raw)[kept]
    starts = place[begins]
    ends = place[gap]  # a text ends in a zero byte, so each word is followed by a gap
    text_ends = np.cumsum([len(t) + 1 for t in texts]) if texts else np.zeros(0, int)
    owner = np.searchsorted(text_ends, np.flatnonzero(begins), "right")
    n_words = np.bincount(owner, minlength=len(texts))
    spans = []
    for n in range(1, longest + 1):
        if len(starts) < n:
            break
        same = owner[: len(owner) - n + 1] == owner[n - 1 :]
        spans.append((starts[: len(starts) - n + 1][same], ends[n - 1 :][same], owner[n - 1 :][same]))
    if not spans:
        none = np.zeros(0, np.int64)
        return data, none, none, none, n_words
    starts, ends, owner = (np.concatenate(x) for x in zip(*spans))
    return data, starts, ends - starts, owner, n_words


def _equal(data: np.ndarray, a: np.ndarray, b: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Whether the stretches at a and at b, of the same lengths (none is empty), hold the same bytes."""
    if not len(a):
        return np.zeros(0, bool)
    first = np.cumsum(lengths) - lengths
    inside = np.arange(int(lengths.sum())) - np.repeat(first, lengths)
    differs = data[np.repeat(a, lengths) + inside] != data[np.repeat(b, lengths) + inside]
    return np.add.reduceat(differs, first, dtype=np.int64) == 0


class Interned:
    """An open-addressed table of the distinct n-grams of a batch: `slot` of each occurrence, and by slot the `bucket`
    and the `count` (0: empty)."""

    def __init__(self, data: np.ndarray, starts: np.ndarray, lengths: np.ndarray, buckets: int, keys=keys_of):
        n = len(starts)
        size = 1 << max(4, (2 * n).bit_length())
        key = keys(data, starts, lengths)
        at = (key & np.uint64(size - 1)).astype(np.int64)
        holder = np.full(size, -1, np.int64)
        waiting = np.arange(n)
        while len(waiting):
            slots = at[waiting]
            free = holder[slots] < 0
            holder[slots[free]] = waiting[free]  # of several occurrences the last stays
            held = holder[slots]
            same = (key[held] == key[waiting]) & (lengths[held] == lengths[waiting])
            checked = np.flatnonzero(same & (held != waiting))
            mine, theirs = waiting[checked], held[checked]
            same[checked] = _equal(data, starts[mine], starts[theirs], lengths[mine])
            waiting = waiting[~same]
            at[waiting] = (at[waiting] + 1) & (size - 1)
        self.slot = at
        self.count = np.bincount(at, minlength=size)
        self.bucket = np.zeros(size, np.int64)
        memory = memoryview(data)
        for i in np.flatnonzero(holder >= 0):
            s = int(starts[holder[i]])
            self.bucket[i] = zlib.crc32(memory[s : s + int(lengths[holder[i]])]) % buckets


def _pieces(texts: list[bytes]) -> Iterator[list[bytes]]:
    piece, size = [], 0
    for text in texts:
        if piece and size + len(text) > PIECE:
            yield piece
            piece, size = [], 0
        piece.append(text)
        size += len(text)
    if piece:
        yield piece


def bucket_counts(texts: list[bytes], longest: int = 1, buckets: int = BUCKETS) -> np.ndarray:
    """N-grams of the texts by bucket."""
    total = np.zeros(buckets, np.int64)
    for piece in _pieces(texts):
        data, starts, lengths, _, _ = ngrams(piece, longest)
        table = Interned(data, starts, lengths, buckets)
        used = np.flatnonzero(table.count)
        np.add.at(total, table.bucket[used], table.count[used])
    return total


def weights(texts: list[bytes], gains: np.ndarray, longest: int = 1) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words, n-grams and floored mean gain (0 without n-grams) of each text."""
    found = []
    for piece in _pieces(texts):
        data, starts, lengths, owner, n_words = ngrams(piece, longest)
        table = Interned(data, starts, lengths, len(gains))
        by_slot = gains[table.bucket]
        n = np.bincount(owner, minlength=len(piece))
        total = np.zeros(len(piece), np.int64)
        np.add.at(total, owner, by_slot[table.slot])
        found.append((n_words, n, np.where(n > 0, total // np.maximum(n, 1), 0)))
    if not found:
        return (np.zeros(0, np.int64),) * 3
    return tuple(np.concatenate(x).astype(np.int64) for x in zip(*found))


def noise(doc_id: int | None, seed: int = SEED) -> int:
    """floor(1000 times Gumbel noise) that hangs on the id alone; a null id counts as an empty text."""
    h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def _counted(texts: DataFrame, longest: int, buckets: int) -> np.ndarray:
    """N-grams of a table's texts by bucket: a row a task and bucket, then a row a bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            total += bucket_counts([utf8(t.as_py()) for t in batch.column(0)], longest, buckets)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], ["bucket", "n"])

    found = np.zeros(buckets, np.int64)
    with batches_of(texts.sparkSession, 500):
        rows = texts.select("text").mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n")).collect()
    for bucket, n in rows:  # `buckets` rows at most
        found[bucket] = n
    return found


def gains_of(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 times the log of how much likelier a bucket is in the target), both smoothed by one a bucket."""
    n = float(len(source))
    s_all, t_all = float(source.sum()), float(target.sum())
    return np.array(
        [
            math.floor(1000 * math.log((t + 1.0) * (s_all + n) / ((s + 1.0) * (t_all + n))))
            for s, t in zip(source.tolist(), target.tolist())
        ],
        np.int64,
    )


def gains(docs: DataFrame, target: DataFrame, longest: int = 1, buckets: int = BUCKETS) -> np.ndarray:
    """The gain of each bucket, from all texts of both tables."""
    return gains_of(_counted(docs, longest, buckets), _counted(target, longest, buckets))


def scored(docs: DataFrame, gains: np.ndarray, longest: int = 1, seed: int = SEED) -> DataFrame:
    """(doc_id, n_words, n_features, weight, score) of every row, written to the shared folder."""
    shared = docs.sparkSession.sparkContext.broadcast(gains)  # one number a bucket

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_pylist()
            n_words, n, weight = weights([utf8(t.as_py()) for t in batch.column(1)], shared.value, longest)
            score = weight + np.array([noise(i, seed) for i in ids], np.int64)
            columns = [batch.column(0), *(pa.array(x) for x in (n_words, n, weight, score))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_words", "n_features", "weight", "score"])

    rows = docs.select(F.col("doc_id").cast("long"), "text")
    with batches_of(docs.sparkSession, 500):
        return checkpoint(rows.mapInArrow(run, "doc_id long, n_words long, n_features long, weight long, score long"))


def ranked(rows: DataFrame, order: list[str]) -> DataFrame:
    """The rows of a checkpointed frame with `rank`, 1, 2, 3 and so on in the order of SQL expressions; rows that are
    equal in it are told apart by where they lie.

    Rows are dealt by range and that deal is written, so that the number of rows before each part is known; no task
    holds more than a part.
    """
    spark = rows.sparkSession
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), rows.rdd.getNumPartitions())
    rows = rows.withColumn("_at", F.monotonically_increasing_id())
    keys = [*(F.expr(o.removesuffix(" desc")).desc() if o.endswith(" desc") else F.expr(o) for o in order), F.col("_at")]
    dealt = checkpoint(rows.repartitionByRange(parts, *keys).withColumn("_part", F.spark_partition_id()))
    sizes = dealt.groupBy("_part").agg(F.count("*").alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # a row a part
    sizes = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    inside = F.row_number().over(Window.partitionBy("_part").orderBy(*keys))
    out = dealt.withColumn("rank", inside.cast("long")).join(F.broadcast(sizes), "_part")
    return out.withColumn("rank", F.col("rank") + F.col("_before")).drop("_part", "_before", "_at")


def resample(
    docs: DataFrame,
    target: DataFrame,
    longest: int = 1,
    buckets: int = BUCKETS,
    percent: int = 10,
    least_words: int = 20,
    seed: int = SEED,
) -> DataFrame:
    """(doc_id, n_features, weight, score, rank) of every row of docs.

    Of the rows with `least_words` words or more, `percent` in a hundred (rounded down) with the highest scores are
    drawn and ranked; the others have a null rank. Ties go to the smaller doc_id, a null id last; rows that repeat an
    id and score are ranked in any order. Null and empty texts have no words, weight 0 and are never drawn. Without
    target texts, or without documents, all counts are smoothed by one and the result is defined. Other columns are
    not read.
    """
    rows = scored(docs, gains(docs, target, longest, buckets), longest, seed)
    enough = F.col("n_words") >= least_words
    drawn = rows.where(enough).count() * percent // 100
    order = ["score desc", "doc_id is null", "doc_id"]
    among = ranked(rows.where(enough), order).withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank")))
    others = rows.where(~enough).withColumn("rank", F.lit(None).cast("long"))
    return among.unionByName(others).select("doc_id", "n_features", "weight", "score", "rank")


#: DuckDB has no crc32: its table `tab` (with the list t) is made from the polynomial, and hexadecimal digits x are folded
#: over it.
CRC_TABLE_SQL = """steps AS (SELECT range AS i, range::BIGINT AS c FROM range(256)),
bits AS (
    SELECT i, list_reduce(list_concat([c], [x::BIGINT FOR x IN range(8)]),
        lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END) AS c FROM steps
),
tab AS (SELECT list(c ORDER BY i) AS t FROM bits)"""
CRC_SQL = """xor(list_reduce(
        list_concat([4294967295::BIGINT], [('0x' || substr(x, 2 * k + 1, 2))::BIGINT FOR k IN range(length(x) // 2)]),
        lambda c, b: xor(c // 256, t[(xor(c, b) % 256) + 1])), 4294967295)"""

ORACLE_SQL = rf"""
WITH {CRC_TABLE_SQL},
found AS (
    SELECT 'd' AS side, doc_id AS id, unnest(regexp_extract_all(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS w FROM documents
    UNION ALL
    SELECT 'b', item_id, unnest(regexp_extract_all(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) FROM benchmark
),
distinct_words AS (SELECT DISTINCT w, hex(encode(w)) AS x FROM found),
hashed AS (
    SELECT w, {CRC_SQL} % 10000 AS bucket
    FROM distinct_words, tab
),
placed AS (SELECT side, id, bucket FROM found JOIN hashed USING (w)),
counts AS (
    SELECT b.range AS bucket, count(*) FILTER (side = 'd')::DOUBLE AS s, count(*) FILTER (side = 'b')::DOUBLE AS t
    FROM range(10000) b LEFT JOIN placed ON placed.bucket = b.range GROUP BY b.range
),
gains AS (
    SELECT bucket, floor(1000 * ln((t + 1) * (sum(s) OVER () + 10000) / ((s + 1) * (sum(t) OVER () + 10000))))::BIGINT AS gain
    FROM counts
),
sums AS (
    SELECT id AS doc_id, count(*) AS n_features, floor(sum(gain)::DOUBLE / count(*))::BIGINT AS weight
    FROM placed JOIN gains USING (bucket) WHERE side = 'd' GROUP BY id
),
scores AS (
    SELECT d.doc_id, coalesce(n_features, 0)::BIGINT AS n_features, coalesce(weight, 0)::BIGINT AS weight,
        coalesce(weight, 0)::BIGINT + floor(-1000 * ln(-ln((
            ('0x' || substr(sha256('2024:' || d.doc_id), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score
    FROM documents d LEFT JOIN sums USING (doc_id)
),
placed_scores AS (
    SELECT *, CASE WHEN n_features >= 20 THEN row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id) END AS r,
        count(*) FILTER (n_features >= 20) OVER () AS n FROM scores
)
SELECT doc_id, n_features, weight, score, CASE WHEN r <= 10 * n // 100 THEN r END AS rank FROM placed_scores
"""
