"""Best-fit packing of documents into training sequences of several permitted lengths.

Documents longer than the longest permitted length are cut into full pieces and a rest. Pieces are dealt to shards by
a hash, so many to a shard that hardly any room is lost at its end, and each shard is packed by one task: pieces in
falling order go to the open bin with the least room that holds them; if there is none, the bin length that costs
least for the piece and what may still come is opened. This is done for each set of permitted lengths, the set with
the least total cost is kept, and at last every bin shrinks to the shortest permitted length that holds its contents.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelspark.llm.common import checkpoint, word_count

LENGTHS = (256, 512, 1024, 2048)

#: What a sequence costs beside its length, in words.
BIN_COST = 8

#: Pieces of a shard, about.
SHARD = 20_000


def _cost_order(ladder: tuple[int, ...], size: int, coming: int, bin_cost: int) -> int:
    """The length of the ladder that costs least for a piece of this size, if `coming` words can still fill it up.

    Room that will be filled is worth what a full bin of the best length costs for it.
    """
    price = min((x + bin_cost) / x for x in ladder)
    return min((x + bin_cost - price * min(x - size, coming), x) for x in ladder if x >= size)[1]


def _fill(sizes: np.ndarray, ladder: tuple[int, ...], bin_cost: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin of each piece (sizes in falling order), and offset in it."""
    longest = ladder[-1]
    some = bytearray(longest + 1)  # 1 where an open bin has so much room
    open_bins: list[list[int]] = [[] for _ in range(longest + 1)]
    bins, offsets, capacity = np.empty(len(sizes), np.int64), np.empty(len(sizes), np.int64), []
    coming = int(sizes.sum())
    for i, size in enumerate(sizes.tolist()):
        coming -= size
        room = some.find(1, size)
        if room < 0:
            room = _cost_order(ladder, size, coming, bin_cost)
            at = len(capacity)
            capacity.append(room)
        else:
            at = open_bins[room].pop()
            if not open_bins[room]:
                some[room] = 0
        bins[i] = at
        offsets[i] = capacity[at] - room
        if room > size:
            open_bins[room - size].append(at)
            some[room - size] = 1
    return bins, offsets


def pack_shard(sizes: np.ndarray, lengths: tuple[int, ...] = LENGTHS, bin_cost: int = BIN_COST):
    """(bin, offset, bin length) of each piece; sizes lie between 1 and the longest length, in any order."""
    lengths = tuple(sorted(lengths))
    order = np.argsort(-sizes, kind="stable")
    best = None
    for n in range(len(lengths)):
        for some in combinations(lengths[:-1], n):
            bins, offsets = _fill(sizes[order], (*some, lengths[-1]), bin_cost)
            filled = np.bincount(bins, sizes[order]).astype(np.int64)
            final = np.array(lengths)[np.searchsorted(lengths, filled)]  # every bin shrinks to its contents
            cost = int(final.sum()) + bin_cost * len(final)
            if best is None or cost < best[0]:
                best = cost, bins, offsets, final
    _, bins, offsets, final = best
    back = np.argsort(order, kind="stable")
    return bins[back], offsets[back], final[bins[back]]


def pack(docs: DataFrame, lengths: tuple[int, ...] = LENGTHS, bin_cost: int = BIN_COST) -> DataFrame:
    """(doc_id, copy, piece, n_words, bin_id, bin_length, bin_offset) for docs (doc_id, text).

    Each document's words are covered by its pieces 0, 1, ... in order, each `n_words` long; all but the last are as
    long as the longest length. No two pieces of a bin overlap and none leaves it. Rows that repeat wholly are
    numbered by `copy` and packed each; a document without words (null or empty text) gives one row with n_words 0,
    bin_length 0 and no bin. Ids may be null or repeat; further columns are ignored; an empty table gives an empty
    table. bin_id is unique over all shards. Reruns agree.
    """
    longest = max(lengths)
    rows = docs.select(
        F.col("doc_id").cast("long"), word_count(F.col("text")).alias("size"), F.xxhash64("text").alias("h")
    )
    items = checkpoint(rows.groupBy("doc_id", "size", "h").agg(F.count(F.lit(1)).alias("n")))
    pieces_of = F.greatest(F.ceil(F.col("size") / longest), F.lit(1))
    total = items.agg(F.sum(F.col("n") * pieces_of)).first()[0] or 0
    shards = max(1, -(-int(total) // SHARD))
    pieces = (
        items.select("doc_id", "size", "h", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)).alias("copy"))
        .select("doc_id", "size", "h", "copy", F.explode(F.sequence(F.lit(0).cast("long"), pieces_of - 1)).alias("piece"))
        .withColumn("n_words", F.least(F.col("size") - F.col("piece") * longest, F.lit(longest)))
    )
    kept = pieces.where("n_words > 0").withColumn("shard", F.pmod(F.xxhash64("doc_id", "h", "copy", "piece"), F.lit(shards)).cast("long"))

    def run(key: tuple, table: pa.Table) -> pa.Table:
        # the order in which rows arrive must not matter
        table = table.sort_by([(c, "ascending") for c in ("n_words", "h", "doc_id", "copy", "piece")])
        bins, offsets, final = pack_shard(table.column("n_words").to_numpy(), lengths, bin_cost)
        shard = int(key[0].as_py())
        return pa.table({
            "doc_id": table.column("doc_id"), "copy": table.column("copy"), "piece": table.column("piece"),
            "n_words": table.column("n_words"), "bin_id": pa.array((shard << 32) + bins),
            "bin_length": pa.array(final.astype(np.int64)), "bin_offset": pa.array(offsets),
        })

    schema = "doc_id long, copy long, piece long, n_words long, bin_id long, bin_length long, bin_offset long"
    packed = kept.groupBy("shard").applyInArrow(run, schema)
    none = F.lit(None).cast("long")
    without = pieces.where("n_words <= 0").select(
        "doc_id", "copy", "piece", "n_words", none.alias("bin_id"), F.lit(0).cast("long").alias("bin_length"), none.alias("bin_offset")
    )
    return packed.union(without)
