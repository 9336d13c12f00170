"""Approximate nearest neighbours by cosine: multiprobe p-stable hashing with exact reranking.

Vectors are scaled to length one, where nearest by cosine is nearest by distance. A table's bucket is the vector of
floor((a x + b) / width) over several Gaussian directions a. A query visits its own bucket and perturbed ones, in the
order of their expected success: the squared distances from the query's place to the borders that a perturbation
crosses, summed, with the borders' distances ranked for each query. All vectors of the visited buckets are compared
exactly.
"""

from __future__ import annotations

import heapq
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from parcelspark.llm.common import checkpoint
from parcelspark.llm.repeats import _pair

#: With these, recall of the five nearest is about 0.97 for vectors of 64 dimensions that are hardly nearer to their
#: neighbours than to others. Vectors in clusters allow more FUNCTIONS and fewer PROBES.
TABLES, FUNCTIONS, BUCKET_WIDTH, PROBES = 4, 8, 2.5, 100

#: Vectors, and queries, that one piece of work compares at most, about; larger buckets are cut.
BLOCK = 4096


@cache
def _directions(dimensions: int, table: int) -> tuple[np.ndarray, np.ndarray]:
    draw = np.random.default_rng([dimensions, table])
    return draw.standard_normal((dimensions, FUNCTIONS)), draw.random(FUNCTIONS)


@cache
def probe_order(functions: int, probes: int) -> list[tuple[int, ...]]:
    """Perturbations in the order of their expected squared distance: each a tuple of ranks among the 2 x functions
    borders sorted by distance; a function is never moved both ways. The first is the empty one."""
    m = functions
    low = [(j * (j + 1)) / (4 * (m + 1) * (m + 2)) for j in range(1, m + 1)]
    high = [1 - (2 * m + 1 - j) / (m + 1) + (2 * m + 1 - j) * (2 * m + 2 - j) / (4 * (m + 1) * (m + 2)) for j in range(m + 1, 2 * m + 1)]
    cost = low + high
    found, heap = [()], [(cost[0], (0,))]
    while heap and len(found) < probes:
        total, some = heapq.heappop(heap)
        if all(2 * m - 1 - j not in some for j in some):  # the far border of a function is the mirror of its near one
            found.append(some)
        last = some[-1]
        if last + 1 < 2 * m:
            heapq.heappush(heap, (total - cost[last] + cost[last + 1], (*some[:-1], last + 1)))
            heapq.heappush(heap, (total + cost[last + 1], (*some, last + 1)))
    return found


def _named(cells: np.ndarray, table: int) -> np.ndarray:
    """One long for each bucket."""
    name = np.full(cells.shape[:-1], table * 1000 + cells.shape[-1], np.uint64)
    for i in range(cells.shape[-1]):
        name = _pair(name, cells[..., i].astype(np.int64).view(np.uint64))
    return name.view(np.int64)


def _by_dimension(column: pa.ListArray):
    """(rows, matrix) for the vectors of each length."""
    flat, offsets = column.values.to_numpy().astype(np.float64), column.offsets.to_numpy()
    lengths = np.diff(offsets)
    for d in np.unique(lengths):
        rows = np.flatnonzero(lengths == d)
        yield rows, flat[offsets[rows][:, None] + np.arange(d)]


def _hashed(vectors: DataFrame, probes: int) -> DataFrame:
    """(bucket, node, vec): the buckets of vectors (node, vec), `probes` in each table."""

    def run(batches):
        for batch in batches:
            for rows, x in _by_dimension(batch.column(1)):
                unit = x / np.linalg.norm(x, axis=1, keepdims=True)
                node, vec = batch.column(0).take(pa.array(rows)), batch.column(1).take(pa.array(rows))
                for table in range(TABLES):
                    a, b = _directions(x.shape[1], table)
                    place = unit @ a / BUCKET_WIDTH + b
                    cell = np.floor(place).astype(np.int64)
                    part = place - cell
                    # border i < FUNCTIONS is the lower one of function i, the others are the upper ones
                    near = np.argsort(np.concatenate([part, 1 - part], 1), axis=1, kind="stable")
                    for some in probe_order(FUNCTIONS, probes):
                        moved = cell.copy()
                        for rank in some:
                            border = near[:, rank]
                            moved[np.arange(len(moved)), border % FUNCTIONS] += np.where(border < FUNCTIONS, -1, 1)
                        yield pa.RecordBatch.from_arrays([pa.array(_named(moved, table)), node, vec], ["bucket", "node", "vec"])

    return vectors.mapInArrow(run, "bucket long, node long, vec array<double>")


def _best(rough: np.ndarray, keep: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of the `keep` largest of each row, and of all that rounding may hide among them: whatever is
    within 1e-9 of the last of these."""
    if rough.shape[1] <= keep:
        return np.divmod(np.arange(rough.size), rough.shape[1])
    last = -np.partition(-rough, keep - 1, axis=1)[:, keep - 1]
    return np.nonzero(rough >= last[:, None] - 1e-9)


def _compare(probes: DataFrame, index: DataFrame, keep: int) -> DataFrame:
    """(query, node, score): for each query (bucket, node, vec) the best of the vectors in its bucket, at most `keep`
    for each piece of work. A bucket with many vectors or queries is cut into blocks, and each block of vectors meets
    each block of queries."""
    blocks = F.ceil(F.count(F.lit(1)) / BLOCK).cast("int")
    many_v = index.groupBy("bucket").agg(blocks.alias("vs")).where("vs > 1")
    many_q = probes.groupBy("bucket").agg(blocks.alias("qs")).where("qs > 1")
    cuts = checkpoint(many_v.join(many_q, "bucket", "full"))

    # the two sides may come from one frame; fresh columns tell them apart
    probes = probes.toDF(*probes.columns)

    def cut(side: DataFrame, own: str, other: str) -> DataFrame:
        one = lambda c: F.coalesce(c, F.lit(1))
        mine = F.pmod(F.xxhash64("node"), one(own)).cast("int").alias(own[0])
        joined = side.join(cuts, "bucket", "left").select("bucket", "node", "vec", mine, one(other).alias("n"))
        return joined.withColumn(other[0], F.explode(F.sequence(F.lit(0), F.col("n") - 1))).drop("n")

    schema = "query long, node long, score double"

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        parts = [[], [], []]
        if len(left) and len(right):
            q_node, v_node = (t.column("node").to_numpy() for t in (left, right))
            vs = {x.shape[1]: (rows, x) for rows, x in _by_dimension(right.column("vec").combine_chunks())}
            for rows, q in _by_dimension(left.column("vec").combine_chunks()):
                if q.shape[1] not in vs:
                    continue
                at, v = vs[q.shape[1]]
                q_norm, v_norm = np.linalg.norm(q, axis=1), np.linalg.norm(v, axis=1)
                for i in range(0, len(q), 512):
                    some = q[i : i + 512]
                    rough = (some / q_norm[i : i + 512, None]) @ (v / v_norm[:, None]).T
                    row, column = _best(rough, keep)
                    # each pair's score is the same wherever it is computed
                    exact = np.concatenate([
                        np.einsum("ij,ij->i", some[row[j : j + 65536]], v[column[j : j + 65536]])
                        for j in range(0, len(row), 65536)
                    ]) / (q_norm[i + row] * v_norm[column])
                    order = np.lexsort((v_node[at][column], -exact, row))
                    row, column, exact = row[order], column[order], exact[order]
                    first = np.searchsorted(row, np.arange(len(some)))
                    ahead = np.arange(len(row)) - first[row] < keep
                    parts[0].append(q_node[rows[i + row[ahead]]])
                    parts[1].append(v_node[at][column[ahead]])
                    parts[2].append(exact[ahead])
        columns = [np.concatenate(p) if p else np.zeros(0) for p in parts]
        return pa.table({"query": columns[0].astype(np.int64), "node": columns[1].astype(np.int64), "score": columns[2].astype(np.float64)})

    keys = ["bucket", "v", "q"]
    pairs = cut(probes, "qs", "vs").groupBy(keys).cogroup(cut(index, "vs", "qs").groupBy(keys)).applyInArrow(run, schema)
    merged = pairs.groupBy("query", "node").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query").orderBy(F.col("score").desc(), "node")
    return merged.withColumn("r", F.row_number().over(order)).where(F.col("r") <= keep).drop("r")


def search(vectors: DataFrame, every: int = 50, k: int = 5, probes: int = PROBES) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found for each row of vectors (vec_id, embedding) whose id is
    divisible by `every`, by cosine in double precision, ties to the smaller id.

    Rows without an id, and vectors that are null, empty, all zero, or hold a null, NaN or infinity take no part;
    vectors of different lengths are never neighbours. Rows that repeat an id are rows of their own, as queries and as
    candidates: a query leaves out its own row only. Equal vectors are one node in the index, with their smallest ids, so that a vector that very many rows share is
    compared once. A query for which the tables give fewer than k rows is compared with all vectors, in blocks. Other
    columns are ignored; an empty table gives an empty table.
    """
    floats = F.col("embedding").cast("array<double>")
    fine = F.size("vec") > 0
    fine &= ~F.exists("vec", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) & F.exists("vec", lambda x: x != 0)
    rows = vectors.where("vec_id is not null").select(F.col("vec_id").cast("long"), floats.alias("vec")).where(fine)
    named = rows.select("vec_id", "vec", F.xxhash64("vec").alias("h"), F.hash("vec").alias("g"))
    # the checkpoint fixes where a row lies; numbers of rows rise with their ids, so that ties of nodes go to the smaller id
    named = checkpoint(named.repartitionByRange("vec_id", "h").sortWithinPartitions("vec_id", "h"))
    named = named.withColumn("row", F.monotonically_increasing_id()).withColumn("id", F.struct("vec_id", "row"))
    # the smallest ids of each distinct vector, in two steps, so that no list holds all ids of a common one
    some_ids = lambda c: F.slice(F.array_sort(c), 1, k + 1)
    parts = named.groupBy("h", "g", F.pmod(F.xxhash64("row"), F.lit(256)).alias("salt")).agg(
        F.min("vec").alias("vec"), some_ids(F.collect_list("id")).alias("ids")
    )
    nodes = parts.groupBy("h", "g").agg(F.min("vec").alias("vec"), some_ids(F.flatten(F.collect_list("ids"))).alias("ids"))
    nodes = checkpoint(nodes.select("h", "g", F.col("ids")[0]["row"].alias("node"), "vec", "ids"))
    asked = named.where(F.col("vec_id") % every == 0).select(F.col("vec_id").alias("query_id"), F.col("row").alias("query_row"), "h", "g")
    asked = checkpoint(asked.join(nodes.select("h", "g", F.col("node").alias("query")), ["h", "g"]).select("query_id", "query_row", "query"))
    distinct = asked.select(F.col("query").alias("node")).distinct()
    all_vectors = nodes.select("node", "vec")
    ask_vectors = all_vectors.join(distinct, "node", "left_semi")

    def expand(found: DataFrame, queries: DataFrame) -> DataFrame:
        ids = found.join(nodes.select("node", "ids"), "node").select("query", "score", F.explode("ids").alias("id"))
        pairs = queries.join(ids, "query").where("id.row <> query_row").withColumn("vec_id", F.col("id.vec_id"))
        order = Window.partitionBy("query_row").orderBy(F.col("score").desc(), "id")
        return pairs.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)

    columns = ["query_id", "rank", "vec_id", "score"]
    found = checkpoint(expand(_compare(_hashed(ask_vectors, probes), _hashed(all_vectors, 1), k + 1), asked).select("query_row", *columns))
    counts = found.groupBy("query_row").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= k)
    few = checkpoint(asked.join(counts, "query_row", "left_anti"))
    if few.isEmpty():
        return found.select(columns)
    one = F.lit(0).cast("long").alias("bucket")
    rest = all_vectors.join(few.select(F.col("query").alias("node")).distinct(), "node", "left_semi")
    again = expand(_compare(rest.select(one, "node", "vec"), all_vectors.select(one, "node", "vec"), k + 1), few)
    return found.join(few, "query_row", "left_anti").select(columns).union(again.select(columns))
