"""Hard negatives for vectors, found through blocks with zone maps.

Vectors are quantised to integers and laid out in Parquet along a Hilbert curve, label by label, in blocks of a few
hundred. A block's zone map is the least and greatest value of each dimension; by interval arithmetic it bounds the
inner product of an anchor with any vector of the block from both sides. An anchor asks for the best rows of score
windows, and only blocks whose bounds meet one of its windows are read for it.

Anchors are dealt into waves and blocks lie in groups, both of bounded size; the zone maps of a group, and then its
blocks that are needed, meet one wave at a time. What a task holds does not grow with the table. The number of pairs
of groups and waves does: anchors are a set of queries against all rows.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from parcelspark.llm.common import batches_of, checkpoint, scratch_folder

#: Rows of a block, of a group of blocks (about), and anchors of a wave (about).
BLOCK, GROUP, WAVE = 256, 8192, 16_384
#: Dimensions that the curve runs through, those of the widest values, and bits of each.
CURVE_DIMS, CURVE_BITS = 15, 4
#: Blocks that are read first for an anchor to raise the lower ends of its windows.
SEEDS = 2

MIN, MAX = -(2**63), 2**63 - 1


def hilbert(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place of each row of cells (one column a dimension, values below 2^bits) on a Hilbert curve, by Skilling's
    transformation. Columns times bits must not exceed 63."""
    x = [c.astype(np.int64) for c in cells.T]
    if not x:
        return np.zeros(len(cells), np.int64)
    for bit in range(bits - 1, 0, -1):
        low = (1 << bit) - 1
        for i in range(len(x)):
            high = (x[i] >> bit) & 1 == 1
            swap = np.where(high, 0, (x[0] ^ x[i]) & low)
            x[0] = np.where(high, x[0] ^ low, x[0]) ^ swap
            if i:
                x[i] ^= swap
    for i in range(1, len(x)):
        x[i] ^= x[i - 1]
    flip = np.zeros_like(x[0])
    for bit in range(bits - 1, 0, -1):
        flip ^= np.where((x[-1] >> bit) & 1 == 1, (1 << bit) - 1, 0)
    key = np.zeros_like(x[0])
    for bit in range(bits - 1, -1, -1):
        for column in x:
            key = key << 1 | ((column ^ flip) >> bit) & 1
    return key


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of the integer rows of a and of b."""
    if not a.size or not b.size:
        return np.zeros((len(a), len(b)), np.int64)
    most = int(np.abs(a.astype(np.int64)).max()) * int(np.abs(b.astype(np.int64)).max()) * a.shape[1]
    if most < 1 << 53:
        return (a.astype(float) @ b.astype(float).T).astype(np.int64)
    if most < 1 << 63:
        return a.astype(np.int64) @ b.astype(np.int64).T
    raise OverflowError("an inner product does not fit 64 bits")


def bounds(a: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest inner product of each row of a with a vector between low and high, by interval arithmetic."""
    up, down = np.maximum(a, 0), np.minimum(a, 0)
    return products(up, low) + products(down, high), products(up, high) + products(down, low)


def _quantised(rows: DataFrame, relabel: int, labels: int) -> DataFrame:
    """(row, vec_id, label, vec) of the rows that take part, written to the shared folder; vec as 32-bit integers."""
    label = F.col("label").cast("long")
    if relabel:
        label = F.when(F.col("vec_id") % relabel == 0, (label + 1) % labels).otherwise(label)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = batch.column(2)
            kept, out = [], []
            for i in range(batch.num_rows):
                x = vectors[i].values.to_numpy(zero_copy_only=False).astype(float)  # a null component becomes NaN
                if np.isfinite(x).all():
                    whole = np.floor(256 * x)
                    if np.abs(whole).max(initial=0) >= 1 << 31:
                        raise OverflowError("a component beyond 2^23 does not fit its 32 bits")
                    kept.append(i)
                    out.append(whole.astype("<i4").tobytes())
            kept = pa.array(kept, pa.int64())
            columns = [batch.column(0).take(kept), batch.column(1).take(kept), pa.array(out, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["vec_id", "label", "vec"])

    given = rows.where("label is not null and embedding is not null").select(
        F.coalesce(F.col("vec_id").cast("long"), F.lit(MAX)).alias("vec_id"), label.alias("label"), "embedding"
    )
    found = given.mapInArrow(run, "vec_id long, label long, vec binary")
    return checkpoint(found.withColumn("row", F.monotonically_increasing_id()))


def _matrix(vectors: list[bytes], dims: int) -> np.ndarray:
    """Vectors as rows; shorter ones are filled up with zeros."""
    if all(len(v) == 4 * dims for v in vectors):
        return np.frombuffer(b"".join(vectors), "<i4").reshape(len(vectors), dims)
    return np.array([np.pad(np.frombuffer(v, "<i4"), (0, dims - len(v) // 4)) for v in vectors]).reshape(len(vectors), dims)


def _ranges(rows: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest value of each dimension: one row a task and dimension, then one a dimension."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        low, high = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for batch in batches:
            vectors = batch.column(0).to_pylist()
            dims = max([len(low), *(len(v) // 4 for v in vectors)])
            m = _matrix(vectors, dims)
            fill = dims - len(low)
            low = np.minimum(np.pad(low, (0, fill)), m.min(axis=0, initial=0))
            high = np.maximum(np.pad(high, (0, fill)), m.max(axis=0, initial=0))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(low))), pa.array(low), pa.array(high)], ["d", "lo", "hi"])

    found = rows.select("vec").mapInArrow(run, "d long, lo long, hi long")
    found = found.groupBy("d").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).orderBy("d").collect()
    return np.array([r.lo for r in found], np.int64), np.array([r.hi for r in found], np.int64)


_BLOCKS = "group int, block long, label long, lo binary, hi binary, ids binary, rows binary, vecs binary"


def _layout(rows: DataFrame, low: np.ndarray, high: np.ndarray, folder: str) -> DataFrame:
    """Blocks in Parquet: label by label along the curve. `group` numbers stretches of about GROUP rows."""
    dims = len(low)
    chosen = np.sort(np.argsort(low - high, kind="stable")[:CURVE_DIMS])

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column(2).to_pylist(), dims)[:, chosen].astype(np.int64) - low[chosen]
            cells = (x << CURVE_BITS) // (high - low + 1)[chosen]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(hilbert(cells, CURVE_BITS))], ["vec_id", "label", "vec", "row", "key"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, n, label, held = TaskContext.get().partitionId(), 0, None, []

        def block() -> pa.RecordBatch:
            m = _matrix([h[1] for h in held], dims)
            order = np.lexsort([[h[2] for h in held], [h[0] for h in held]])  # by id, so that ties come in order
            ids, row = np.array([h[0] for h in held], "<i8"), np.array([h[2] for h in held], "<i8")
            values = [m.min(axis=0), m.max(axis=0), ids[order], row[order], m[order]]
            arrays = [pa.array([group], pa.int32()), pa.array([(group << 33) + n]), pa.array([label])]
            return pa.RecordBatch.from_arrays(
                arrays + [pa.array([np.ascontiguousarray(v).tobytes()], pa.binary()) for v in values],
                [c.split()[0] for c in _BLOCKS.split(", ")],
            )

        for batch in batches:
            for vec_id, its_label, vec, row in zip(*(batch.column(i).to_pylist() for i in range(4))):
                if held and (its_label != label or len(held) == BLOCK):
                    yield block()
                    n, held = n + 1, []
                label = its_label
                held.append((vec_id, vec, row))
        if held:
            yield block()

    spark = rows.sparkSession
    groups = max(1, -(-rows.count() // GROUP))
    order = ["label", "key", "vec_id", "row"]
    placed = rows.select("vec_id", "label", "vec", "row").mapInArrow(keys, "vec_id long, label long, vec binary, row long, key long")
    placed = placed.repartitionByRange(groups, *order).sortWithinPartitions(*order).drop("key")
    placed.mapInArrow(cut, _BLOCKS).write.parquet(folder)
    return spark.read.parquet(folder)


def _anchors_in(table: pa.Table, dims: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Rows (ascending), labels, vectors and window ends (a column a window; an empty window for none) of anchors."""
    table = table.sort_by("arow")
    ends = [table.column(c).to_pylist() for c in ("lo", "hi")]
    width = max([1, *map(len, ends[0])])
    low, high = (np.array([e + [fill] * (width - len(e)) for e in part], np.int64).reshape(-1, width)
                 for part, fill in zip(ends, (MAX, MIN)))
    return (table.column("arow").to_numpy(), table.column("label").to_numpy(),
            _matrix(table.column("vec").to_pylist(), dims), low, high)


def _choose(key: tuple, zones: pa.Table, anchors: pa.Table, dims: int, same: bool, seeds: int) -> pa.Table:
    """Blocks of a group that anchors of a wave must read: a row a block with the anchors; with seeds, a row for each
    of the blocks with the greatest upper bounds of an anchor."""
    rows, labels, vectors, low, high = _anchors_in(anchors, dims)
    zones = zones.sort_by("block")
    lo, hi = (_matrix(zones.column(c).to_pylist(), dims) for c in ("lo", "hi"))
    least, most = bounds(vectors, lo, hi)
    wanted = (labels[:, None] == zones.column("label").to_numpy()[None, :]) == same
    meets = np.zeros_like(wanted)
    for w in range(low.shape[1]):
        meets |= (most >= low[:, w, None]) & (least <= high[:, w, None]) & (low[:, w] <= high[:, w])[:, None]
    wanted &= meets
    blocks = zones.column("block").to_numpy()
    group, wave = (k.as_py() for k in key)
    if seeds:
        best = np.argsort(np.where(wanted, -most, MAX), axis=1, kind="stable")[:, :seeds]
        at, which = np.nonzero(np.take_along_axis(wanted, best, axis=1))
        chosen = best[at, which]
        values = [[group] * len(at), [wave] * len(at), blocks[chosen], [[r] for r in rows[at]], most[at, chosen]]
    else:
        used = np.flatnonzero(wanted.any(axis=0))
        values = [[group] * len(used), [wave] * len(used), blocks[used], [rows[wanted[:, b]] for b in used], [MAX] * len(used)]
    kinds = [pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.int64()), pa.int64()]
    return pa.table([pa.array(v, k) for v, k in zip(values, kinds)], ["group", "wave", "block", "need", "most"])


def _read(key: tuple, blocks: pa.Table, anchors: pa.Table, dims: int, k: int) -> pa.Table:
    """The k best rows of each window of the anchors of a wave, within the needed blocks of a group."""
    rows, _, vectors, low, high = _anchors_in(anchors, dims)
    windows = low.shape[1]
    none = (len(rows), windows, k)
    score, ids, found = np.full(none, MIN), np.full(none, MAX), np.full(none, -1)
    for block in blocks.to_pylist():
        asking = np.searchsorted(rows, block["need"])
        m = np.frombuffer(block["vecs"], "<i4").reshape(len(block["rows"]) // 8, dims)
        block_ids, block_rows = np.frombuffer(block["ids"], "<i8"), np.frombuffer(block["rows"], "<i8")
        s = products(vectors[asking], m)
        s[rows[asking][:, None] == block_rows[None, :]] = MIN  # the anchor itself
        order = np.argsort(-np.maximum(s, MIN + 1), axis=1, kind="stable")
        s = np.take_along_axis(s, order, axis=1)
        for w in range(windows):
            begin = (s > high[asking, w, None]).sum(axis=1)
            at = begin[:, None] + np.arange(k)
            inside = np.minimum(at, s.shape[1] - 1)
            value = np.take_along_axis(s, inside, axis=1)
            ok = (at < s.shape[1]) & (value >= low[asking, w, None]) & (value > MIN)
            column = np.take_along_axis(order, inside, axis=1)
            new = (np.where(ok, value, MIN), np.where(ok, block_ids[column], MAX), np.where(ok, block_rows[column], -1))
            both = [np.concatenate([a[asking, w], b], axis=1) for a, b in zip((score, ids, found), new)]
            best = np.lexsort((both[2], both[1], -np.maximum(both[0], MIN + 1)), axis=-1)[:, :k]
            for a, b in zip((score, ids, found), both):
                a[asking, w] = np.take_along_axis(b, best, axis=1)
    i, w, r = np.nonzero(found >= 0)
    values = [rows[i], w, score[i, w, r], ids[i, w, r], found[i, w, r]]
    return pa.table([pa.array(v, pa.int64()) for v in values], ["arow", "win", "score", "vec_id", "row"])


class Blocks:
    """Blocks in Parquet, and searches over them."""

    def __init__(self, blocks: DataFrame, dims: int):
        self.blocks, self.dims = blocks, dims
        self.zones = blocks.select("group", "block", "label", "lo", "hi")
        self.groups = 1 + (blocks.agg(F.max("group")).first()[0] or 0)

    def _spread(self, anchors: DataFrame) -> DataFrame:
        return anchors.withColumn("group", F.explode(F.sequence(F.lit(0), F.lit(self.groups - 1))))

    def needs(self, anchors: DataFrame, waves: int, same: bool, seeds: int = 0) -> DataFrame:
        """Which anchors need which block, from zone maps alone."""
        zones = self.zones.withColumn("wave", F.explode(F.sequence(F.lit(0), F.lit(waves - 1))))
        choose = partial(_choose, dims=self.dims, same=same, seeds=seeds)
        found = zones.groupBy("group", "wave").cogroup(self._spread(anchors).groupBy("group", "wave")).applyInArrow(
            choose, "group int, wave int, block long, need array<long>, most long"
        )
        if not seeds:
            return checkpoint(found)
        best = Window.partitionBy("need").orderBy(F.desc("most"), "block")
        found = found.withColumn("_rank", F.row_number().over(best)).where(F.col("_rank") <= seeds)
        # the anchors of one wave: a list of bounded length
        return checkpoint(found.groupBy("group", "wave", "block").agg(F.flatten(F.collect_list("need")).alias("need")))

    def read(self, needs: DataFrame, anchors: DataFrame, k: int) -> DataFrame:
        """(arow, win, score, vec_id, row, rank) of the k best rows of each window within the needed blocks."""
        payload = self.blocks.select("block", "ids", "rows", "vecs")
        work = needs.select("group", "wave", "block", "need").join(payload, "block")
        used = needs.select("group", "wave").distinct()
        asking = self._spread(anchors).join(used, ["group", "wave"], "left_semi")
        found = work.groupBy("group", "wave").cogroup(asking.groupBy("group", "wave")).applyInArrow(
            partial(_read, dims=self.dims, k=k), "arow long, win long, score long, vec_id long, row long"
        )
        best = Window.partitionBy("arow", "win").orderBy(F.desc("score"), "vec_id", "row")
        return checkpoint(found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k))


def mine(
    rows: DataFrame,
    every: int = 50,
    positives: int = 5,
    negatives: int = 3,
    least: int = 50,
    most: int = 95,
    relabel: int = 7,
    labels: int = 10,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    Anchors are the rows whose vec_id is divisible by `every`; their positives the best rows of the same label but
    themselves, their negatives for each positive the best rows of other labels whose score is from `least` to `most`
    percent of the positive's. Ties go to the smaller vec_id (null: last; an anchor it is not). Where vec_id is divisible by
    `relabel` (0: nowhere), the label becomes the next of `labels`.

    Rows with a null label or vector, or a null or non-finite component, take no part. Vectors of unlike lengths are
    filled up with zeros. Rows that repeat an id are rows of their own, as anchors too. The largest 64-bit id stands
    for a null one. A component of 2^23 or more is an error, as is a score beyond 64 bits. Other columns are not read;
    an empty table gives an empty result.
    """
    spark = rows.sparkSession
    with batches_of(spark, 1000):
        taken = _quantised(rows, relabel, labels)
        low, high = _ranges(taken)
        laid = _layout(taken, low, high, f"{scratch_folder(spark)}/blocks-{uuid.uuid4().hex}")
        blocks = Blocks(laid, len(low))
        chosen = taken.where((F.col("vec_id") % every == 0) & (F.col("vec_id") != MAX))
        waves = max(1, -(-chosen.count() // WAVE))
        anchors = chosen.select(
            F.col("row").alias("arow"), F.pmod(F.xxhash64("row"), F.lit(waves)).cast("int").alias("wave"), "label", "vec"
        )

        every_score = lambda a: a.withColumns({"lo": F.array(F.lit(MIN + 1)), "hi": F.array(F.lit(MAX))})
        asked = every_score(anchors)
        first = blocks.read(blocks.needs(asked, waves, True, SEEDS), asked, positives)
        asked = _raised(asked, first, positives)
        best = blocks.read(blocks.needs(asked, waves, True), asked, positives)

        # least * p <= 100 * n <= most * p, in integers
        ends = best.select(
            "arow", "rank",
            F.expr(f"-((score * -{least} - pmod(score * -{least}, 100)) div 100)").alias("lo"),
            F.expr(f"(score * {most} - pmod(score * {most}, 100)) div 100").alias("hi"),
        )
        ends = ends.groupBy("arow").agg(F.sort_array(F.collect_list(F.struct("rank", "lo", "hi"))).alias("_w"))  # `positives` at most
        asked = anchors.join(ends, "arow").select(
            "arow", "wave", "label", "vec", F.col("_w.lo").alias("lo"), F.col("_w.hi").alias("hi")
        )
        asked = checkpoint(asked)
        first = blocks.read(blocks.needs(asked, waves, False, SEEDS), asked, negatives)
        asked = _raised(asked, first, negatives)
        worst = blocks.read(blocks.needs(asked, waves, False), asked, negatives)

    known = lambda c: F.nullif(F.col(c), F.lit(MAX))
    mates = best.select("arow", (F.col("rank") - 1).cast("long").alias("win"), known("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    names = chosen.select(F.col("row").alias("arow"), F.col("vec_id").alias("anchor_id"))
    return worst.join(mates, ["arow", "win"]).join(names, "arow").select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), known("vec_id").alias("negative_id"),
        "positive_score", F.col("score").alias("negative_score"),
    )


def _raised(asked: DataFrame, found: DataFrame, k: int) -> DataFrame:
    """Anchors with the lower end of each window raised to the k-th best score found in it, where there are k."""
    last = found.where(F.col("rank") == k).groupBy("arow").agg(F.map_from_entries(F.collect_list(F.struct("win", "score"))).alias("_k"))
    out = asked.join(last, "arow", "left").withColumn(
        "lo", F.transform("lo", lambda v, i: F.greatest(v, F.try_element_at("_k", i.cast("long"))))
    )
    return checkpoint(out.drop("_k"))


ORACLE_SQL = """
WITH v AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
        list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q
    FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
    SELECT a.vec_id AS anchor_id, c.vec_id AS other, a.label = c.label AS same, list_inner_product(a.q, c.q)::BIGINT AS score
    FROM v a JOIN v c ON a.vec_id <> c.vec_id WHERE a.vec_id % 50 = 0
), p AS (
    SELECT * FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5
)
SELECT p.anchor_id, p.other AS positive_id,
    row_number() OVER (PARTITION BY p.anchor_id, p.other ORDER BY n.score DESC, n.other)::INT AS rank,
    n.other AS negative_id, p.score AS positive_score, n.score AS negative_score
FROM p JOIN s n ON n.anchor_id = p.anchor_id AND NOT n.same AND 50 * p.score <= 100 * n.score AND 100 * n.score <= 95 * p.score
QUALIFY rank <= 3
"""
