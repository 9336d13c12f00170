"""Repeated byte strings by refinement of buckets, after the bucket-pointer method.

Every byte of a string that starts in two places of the corpus is found, for strings of `length` bytes. Suffixes are
put into buckets by their first bytes, and buckets are refined by the bucket identifiers of later offsets: the bucket
of p + q bytes at x is named by (bucket of p bytes at x, bucket of q bytes at x + p). The names of one step are reused
in the next, so `length` bytes take a logarithmic number of steps. Where the method numbers buckets by sorting all
suffixes in each round, an identifier here is a hash of the bucket's bytes: the same in every task, without a global
numbering, and without moving every suffix of the corpus in every round. Strings count as equal if two identifiers are:
that of their anchor, with its place, and that of all their bytes.

Only few suffixes need to be sorted. Each string of `length` bytes has an anchor, its leftmost q-gram with the smallest
identifier; equal strings have equal anchors at equal places. Neighbouring strings with one anchor form a run. A run
goes through three rounds of refinement, each a shuffle on identifiers:

  - the anchor's bucket has one member: no string of the run repeats;
  - the bucket of the whole run has several: every string of it repeats;
  - else the run is cut into shorter ones, which are refined by the bucket of the bytes that all their strings share,
    down to single strings.

Rows of a round are counted before they are shuffled, so a passage that a third of all documents hold is a hot key
for no aggregate.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelspark.llm.common import checkpoint, text_batches, unused, utf8, with_fields

LENGTH = 200
GRAM = 32

#: Runs are cut to this many strings in the second round, and to one in the third.
PIECE = 16

#: Bytes of text that a task refines at once; longer texts are cut with an overlap.
BATCH_BYTES = 1 << 18

_MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))
_SPLIT = np.uint64(29)


def _pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Name of the bucket of a followed by b."""
    x = a * _MIX[0]
    x ^= x >> _SPLIT
    x += b
    x *= _MIX[1]
    x ^= x >> _SPLIT
    return x


class Buckets:
    """Bucket identifiers of every position of a piece of text, for any width."""

    def __init__(self, data: np.ndarray):
        self.levels = [(data.astype(np.uint64) + np.uint64(1)) * _MIX[1]]

    def _level(self, k: int) -> np.ndarray:
        """Identifiers of 2^k bytes: those of half as many, refined by those half as far on."""
        while len(self.levels) <= k:
            half, last = 1 << (len(self.levels) - 1), self.levels[-1]
            self.levels.append(_pair(last[:-half], last[half:]) if len(last) > half else last[:0])
        return self.levels[k]

    def of(self, width: int) -> np.ndarray:
        """Identifiers of `width` bytes at each position where so many are left."""
        k = width.bit_length() - 1
        level, rest = self._level(k), width - (1 << k)
        return _pair(level[: len(level) - rest], level[rest:]) if rest else level

    def at(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Identifiers of the strings [start, end), each from the two powers of two that cover it and its width."""
        width = end - start
        power = np.frexp(width.astype(np.float64))[1] - 1
        out = np.zeros(len(start), np.uint64)
        for k in np.unique(power):
            some = power == k
            level = self._level(int(k))
            out[some] = _pair(level[start[some]], level[end[some] - (1 << int(k))])
        return _pair(out, width.astype(np.uint64))


def _least(x: np.ndarray, width: int) -> np.ndarray:
    """Smallest value in each window of `width` values."""
    best, have = x, 1
    while have < width:
        step = min(have, width - have)
        best = np.minimum(best[:-step], best[step:])
        have += step
    return best


class Runs:
    """Runs of strings with one anchor, over texts joined in `data` that begin at `starts` (last: the end).

    first, last: starts of a run's first and last string; anchor: its anchor's place; doc: the text it lies in;
    bucket: the anchor's bucket; whole: the bucket of all its bytes together with the anchor's place in them.
    """

    def __init__(self, data: np.ndarray, starts: np.ndarray, length: int, gram: int):
        self.buckets = Buckets(data)
        self.first = self.last = self.anchor = self.doc = np.zeros(0, np.int64)
        self.bucket = self.whole = np.zeros(0, np.uint64)
        if len(data) < length:
            return
        grams = self.buckets.of(gram)
        low = np.uint64(32)
        key = (grams >> low << low) | np.arange(len(grams), dtype=np.uint64)  # ties: the leftmost
        anchor = (_least(key, length - gram + 1) & np.uint64((1 << 32) - 1)).astype(np.int64)
        doc = np.repeat(np.arange(len(starts) - 1), np.diff(starts))[: len(anchor)]
        inside = np.arange(length, len(data) + 1) <= starts[doc + 1]
        new = np.ones(len(anchor) + 1, bool)
        new[1:-1] = (anchor[1:] != anchor[:-1]) | (doc[1:] != doc[:-1])
        new[1:-1] |= inside[1:] != inside[:-1]
        self.first = np.flatnonzero(new[:-1] & inside)
        self.last = np.flatnonzero(new[1:] & inside)
        self.anchor, self.doc = anchor[self.first], doc[self.first]
        self.bucket = grams[self.anchor]
        extent = self.buckets.at(self.first, self.last + length)
        self.whole = _pair(extent, (self.anchor - self.first).astype(np.uint64))


def _portions(texts: list[bytes], length: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Texts in portions of bounded size: (bytes, starts, index of the text, offset in it).

    A text above the size is cut into stretches that overlap by length - 1 bytes, so that each string is in one.
    """
    parts, rows, offsets, total = [], [], [], 0
    for row, text in enumerate(texts):
        for at in range(0, max(1, len(text) - length + 1), BATCH_BYTES):
            part = text[at : at + BATCH_BYTES + length - 1]
            if total and total + len(part) > BATCH_BYTES:
                yield _joined(parts, rows, offsets)
                parts, rows, offsets, total = [], [], [], 0
            parts.append(part)
            rows.append(row)
            offsets.append(at)
            total += len(part)
    if parts:
        yield _joined(parts, rows, offsets)


def _joined(parts, rows, offsets):
    starts = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int64)
    return np.frombuffer(b"".join(parts), np.uint8), starts, np.array(rows, np.int64), np.array(offsets, np.int64)


def _batch(columns: list, names: list[str]) -> pa.RecordBatch:
    arrays = [pa.array(c.view(np.int64) if isinstance(c, np.ndarray) and c.dtype == np.uint64 else c) for c in columns]
    return pa.RecordBatch.from_arrays(arrays, names)


def _keyed(docs: DataFrame) -> DataFrame:
    """Texts with the key (h, g) that stands for their contents: equal texts have equal results."""
    id_ = F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))).alias("id")
    return docs.select(F.xxhash64("text").alias("h"), F.hash("text").alias("g"), id_, "text")


def _anchor_counts(docs: DataFrame, length: int, gram: int) -> DataFrame:
    """(a, n): how many runs have their anchor in bucket a; summed within tasks first."""

    def run(batches):
        for batch in batches:
            for data, starts, _, _ in _portions([utf8(t.as_py()) for t in batch.column(0)], length):
                a, n = np.unique(Runs(data, starts, length, gram).bucket, return_counts=True)
                yield _batch([a, n], ["a", "n"])

    return docs.select("text").mapInArrow(run, "a long, n long").groupBy("a").agg(F.sum("n").alias("n"))


def _run_rows(docs: DataFrame, length: int, gram: int) -> DataFrame:
    """(a, k, n, of): runs of each text by anchor's bucket and whole bucket; of has the text's key and row."""

    def run(batches):
        for batch in batches:
            h, g, id_ = (batch.column(i).to_numpy() for i in range(3))
            for data, starts, rows, _ in _portions([utf8(t.as_py()) for t in batch.column(3)], length):
                r = Runs(data, starts, length, gram)
                row = rows[r.doc]
                _, at, n = np.unique(
                    _pair(_pair(r.bucket, r.whole), row.astype(np.uint64)), return_index=True, return_counts=True
                )
                some = row[at]
                yield _batch(
                    [r.bucket[at], r.whole[at], n, id_[some], h[some], g[some]], ["a", "k", "n", "id", "h", "g"]
                )

    return _keyed(docs).mapInArrow(run, "a long, k long, n long, id long, h long, g int")


COPIED, OPEN, WITNESS = 0, 1, 2


def _repeated(rows: DataFrame, *by: str) -> DataFrame:
    """Buckets (by their names: a) that have several of the rows (a, n)."""
    by = by or ("a",)
    return checkpoint(rows.groupBy(*by).agg(F.sum("n").alias("n")).where("n > 1").select(*by))


def _refine(rows: DataFrame, of: list[str]) -> tuple[DataFrame, DataFrame]:
    """Count the buckets k of rows (a, k, n, *of), where each a has several rows.

    Gives (a, k) of the buckets with several members; and (a, k, *of, witness) of the rows that stay open: those
    alone in their bucket, and for each bucket with several beside an open one in a, one row to stand for it.
    """
    counts = checkpoint(rows.groupBy("a", "k").agg(F.sum("n").alias("n"), F.min(F.struct(*of)).alias("of")))
    lone, several = counts.where("n = 1"), counts.where("n > 1")
    beside = checkpoint(lone.select("a").distinct())
    witness = several.join(beside, "a", "left_semi")
    columns = ["a", "k", *(f"of.{c}" for c in of)]
    still_open = lone.select(*columns, F.lit(False).alias("witness"))
    return several.select("a", "k"), still_open.union(witness.select(*columns, F.lit(True).alias("witness")))


def _open_runs(docs: DataFrame, flags: DataFrame, length: int, gram: int) -> DataFrame:
    """(h, g, start, end, before, text, witness) of the flagged runs of each text.

    Runs known to be copied come merged, without text. Of open ones the bytes come along, with the number of bytes
    before the anchor.
    """
    of_text = flags.groupBy("h", "g").agg(
        F.collect_list(F.struct("a", "k", "state", "id")).alias("flags"),
    ).select("h", "g", *(F.col(f"flags.{c}").alias(c + "s") for c in ("a", "k", "state", "id")))
    joined = _keyed(docs).join(of_text, ["h", "g"])
    names = ["h", "g", "start", "end", "before", "text", "witness"]

    def run(batches):
        for batch in batches:
            h, g = batch.column("h").to_numpy(), batch.column("g").to_numpy()
            texts = [utf8(t.as_py()) for t in batch.column("text")]
            id_ = batch.column("id").to_numpy()
            listed = batch.column("as")
            owner = np.repeat(np.arange(len(texts)), np.diff(listed.offsets.to_numpy())).astype(np.uint64)
            a, k = (batch.column(c).flatten().to_numpy().view(np.uint64) for c in ("as", "ks"))
            state, whose = (batch.column(c).flatten().to_numpy() for c in ("states", "ids"))
            # of copies of a text only one gives the bytes of its open runs; a run may be copied and a witness
            use = (state == COPIED) | (whose == id_[owner.astype(np.int64)])
            name, state = _pair(_pair(a, k), owner)[use], state[use]
            order = np.lexsort((state, name))
            name, state = name[order], state[order]
            if not len(name):
                continue
            for data, starts, rows, offsets in _portions(texts, length):
                r = Runs(data, starts, length, gram)
                mine = _pair(_pair(r.bucket, r.whole), rows[r.doc].astype(np.uint64))
                lo, hi = np.searchsorted(name, mine, "left"), np.searchsorted(name, mine, "right")
                found = hi > lo
                s1 = np.where(found, state[np.minimum(lo, len(state) - 1)], -1)
                s2 = np.where(found, state[np.minimum(np.maximum(hi - 1, 0), len(state) - 1)], -1)
                shift = offsets[r.doc] - starts[r.doc]
                start, end = r.first + shift, r.last + shift
                row = rows[r.doc]
                copied = np.flatnonzero(s1 == COPIED)
                if len(copied):
                    # neighbours in one text are merged
                    gap = np.ones(len(copied), bool)
                    gap[1:] = (row[copied][1:] != row[copied][:-1]) | (start[copied][1:] != end[copied][:-1] + 1)
                    first = np.flatnonzero(gap)
                    last = np.concatenate([first[1:], [len(copied)]]) - 1
                    some = row[copied[first]]
                    m = len(first)
                    yield _batch(
                        [h[some], g[some], start[copied[first]], end[copied[last]] + length, np.zeros(m, np.int32),
                         pa.nulls(m, pa.binary()), np.zeros(m, bool)], names,
                    )
                opened = np.flatnonzero(s2 >= OPEN)
                # a witness needs to be there once for each text
                _, once = np.unique(mine[opened], return_index=True)
                opened = opened[once]
                buffer = data.tobytes()
                some = row[opened]
                yield _batch(
                    [h[some], g[some], start[opened], end[opened] + length,
                     (r.anchor - r.first)[opened].astype(np.int32),
                     pa.array([buffer[x : y + length] for x, y in zip(r.first[opened], r.last[opened])], pa.binary()),
                     s2[opened] == WITNESS], names,
                )

    return joined.mapInArrow(
        run, "h long, g int, start long, end long, before int, text binary, witness boolean"
    )


def _cut(opened: DataFrame, length: int, gram: int, size: int) -> DataFrame:
    """(a, k, n, of) for the stretches of at most `size` strings of open runs.

    Stretches are cut at places that count from the anchor, so that equal strings fall into equal stretches. a is the
    bucket of the bytes that all strings of a full stretch share, k that of all its bytes; of says where it lies.
    """

    def run(batches):
        for batch in batches:
            texts = batch.column("text").to_pylist()
            starts = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
            buckets = Buckets(np.frombuffer(b"".join(texts), np.uint8))
            before = batch.column("before").to_numpy().astype(np.int64)
            strings = np.diff(starts) - length + 1
            low = np.maximum(0, before - strings + 1) // size  # stretches by the bytes before the anchor
            many = before // size - low + 1
            at = np.repeat(np.arange(len(texts)), many)
            stretch = low[at] + np.arange(len(at)) - np.repeat(np.cumsum(many) - many, many)
            anchor = starts[at] + before[at]
            begin = np.maximum(starts[at], anchor - stretch * size - (size - 1))
            end = np.minimum(starts[at] + strings[at] - 1, anchor - stretch * size)
            core = buckets.at(anchor - stretch * size, anchor - stretch * size - (size - 1) + length)
            gram_of = buckets.at(anchor, anchor + gram)
            a = _pair(_pair(gram_of, stretch.astype(np.uint64)), core)
            k = _pair(buckets.at(begin, end + length), (anchor - begin).astype(np.uint64))
            h, g = batch.column("h").to_numpy()[at], batch.column("g").to_numpy()[at]
            base = batch.column("start").to_numpy()[at] - starts[at]
            witness = batch.column("witness").to_numpy(zero_copy_only=False)[at]
            run_start = batch.column("start").to_numpy()[at]
            yield _batch(
                [a, k, np.ones(len(a), np.int64), h, g, run_start, begin + base, end + base, witness],
                ["a", "k", "n", "h", "g", "run", "start", "end", "old"],
            )

    kind = "a long, k long, n long, h long, g int, run long, start long, end long, old boolean"
    return opened.mapInArrow(run, kind)


def _strings(opened: DataFrame, stretches: DataFrame, length: int, gram: int) -> DataFrame:
    """(a, k, n, h, g, start, old): each string of the open stretches of open runs; a the bucket of its anchor and the
    anchor's place in it, k that of all its bytes."""
    of_run = stretches.groupBy("h", "g", "run").agg(
        F.collect_list(F.struct("start", "end", (F.col("old") | F.col("witness")).alias("old"))).alias("at")
    ).select("h", "g", F.col("run").alias("start"), *(F.col(f"at.{c}").alias(c + "s") for c in ("start", "end", "old")))
    joined = opened.select("h", "g", "start", "before", "text").join(of_run, ["h", "g", "start"])

    def run(batches):
        for batch in batches:
            texts = batch.column("text").to_pylist()
            starts = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
            buckets = Buckets(np.frombuffer(b"".join(texts), np.uint8))
            listed = batch.column("starts")
            at = np.repeat(np.arange(len(texts)), np.diff(listed.offsets.to_numpy()))
            first, last = (batch.column(c).flatten().to_numpy() for c in ("starts", "ends"))
            old = batch.column("olds").flatten().to_numpy(zero_copy_only=False)
            many = last - first + 1
            of = np.repeat(np.arange(len(at)), many)
            start = first[of] + np.arange(len(of)) - np.repeat(np.cumsum(many) - many, many)
            at, old = at[of], old[of]
            place = start - batch.column("start").to_numpy()[at] + starts[at]
            anchor = starts[at] + batch.column("before").to_numpy()[at]
            a = _pair(buckets.at(anchor, anchor + gram), (anchor - place).astype(np.uint64))
            k = buckets.at(place, place + length)
            h, g = batch.column("h").to_numpy()[at], batch.column("g").to_numpy()[at]
            yield _batch([a, k, np.ones(len(a), np.int64), h, g, start, old], ["a", "k", "n", "h", "g", "start", "old"])

    return joined.mapInArrow(run, "a long, k long, n long, h long, g int, start long, old boolean")


def repeated_spans(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """(h, g, starts, ends): for each text, by its key, stretches of bytes that are covered by repeated strings.

    Stretches may touch or overlap. Texts without any have no row.
    """
    docs = text_batches(docs)
    anchors = _repeated(_anchor_counts(docs, length, gram))
    rows = checkpoint(_run_rows(docs, length, gram).join(anchors, "a", "left_semi"))
    several, still_open = _refine(rows, ["id", "h", "g"])
    copied = rows.join(several, ["a", "k"], "left_semi").select(
        "h", "g", "a", "k", F.lit(COPIED).alias("state"), F.lit(0).cast("long").alias("id")
    ).distinct()
    state = F.when(F.col("witness"), WITNESS).otherwise(OPEN).alias("state")
    flags = copied.union(still_open.select("h", "g", "a", "k", state, "id"))
    found = checkpoint(_open_runs(docs, flags, length, gram))

    opened = found.where("text is not null")
    stretches = _cut(opened, length, gram, PIECE)
    stretches = checkpoint(stretches.join(_repeated(stretches), "a", "left_semi"))
    several, still_open = _refine(stretches, ["h", "g", "run", "start", "end", "old"])
    by_stretch = stretches.where("not old").join(several, ["a", "k"], "left_semi")

    strings = checkpoint(_strings(opened, still_open, length, gram))
    by_string = strings.where("not old").join(_repeated(strings, "a", "k"), ["a", "k"], "left_semi")

    spans = (
        found.where("text is null").select("h", "g", "start", "end")
        .union(by_stretch.select("h", "g", "start", F.col("end") + length))
        .union(by_string.select("h", "g", "start", F.col("start") + length))
        .distinct()
    )
    return spans.groupBy("h", "g").agg(F.collect_list(F.struct("start", "end")).alias("spans")).select(
        "h", "g", F.col("spans.start").alias("starts"), F.col("spans.end").alias("ends")
    )


def _merged(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal stretches of the union of stretches."""
    order = np.argsort(starts, kind="stable")
    starts, ends = starts[order], np.maximum.accumulate(ends[order])
    new = np.ones(len(starts), bool)
    new[1:] = starts[1:] > ends[:-1]
    first = np.flatnonzero(new)
    return starts[first], ends[np.concatenate([first[1:], [len(starts)]]) - 1] if len(starts) else ends


def remove_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, as_text: bool = False) -> DataFrame:
    """docs with the columns _kept (binary: the text's bytes without those covered by a repeated string of `length`
    bytes), _n_bytes, _n_removed and _n_spans (maximal removed stretches).

    A string repeats if it starts anywhere else, in the same text or another; overlaps count, all strings are judged
    on the input. Nulls and texts shorter than `length` lose nothing and give zeros; of equal texts (repeated rows
    too) all are removed wholly if long enough. Other columns stay as they are; one named like an added one is
    replaced; an empty table gives an empty table. Ids may be null or repeat. With `as_text`, _kept is a string, and
    what a cut has left of a character is dropped.
    """
    docs = docs.drop("_kept", "_n_bytes", "_n_removed", "_n_spans")
    spans = repeated_spans(docs, length, gram)
    h, g, starts_, ends_ = (unused(docs, name) for name in ("_h", "_g", "_starts", "_ends"))
    keyed = docs.withColumn(h, F.xxhash64("text")).withColumn(g, F.hash("text"))
    joined = keyed.join(
        spans.select(F.col("h").alias(h), F.col("g").alias(g), F.col("starts").alias(starts_), F.col("ends").alias(ends_)),
        [h, g], "left",
    ).drop(h, g)
    plain = docs.columns
    schema = with_fields(docs, _kept="string" if as_text else "binary", _n_bytes="long", _n_removed="long", _n_spans="long")
    names = schema.names

    def run(batches):
        for batch in batches:
            kept, totals, removed, counts = [], [], [], []
            for text, starts, ends in zip(batch.column("text"), batch.column(starts_), batch.column(ends_)):
                data = utf8(text.as_py())
                totals.append(len(data))
                if not starts.is_valid:
                    kept.append(data)
                    removed.append(0)
                    counts.append(0)
                    continue
                s, e = _merged(starts.values.to_numpy(), ends.values.to_numpy())
                kept.append(b"".join(data[x:y] for x, y in zip([0, *e.tolist()], [*s.tolist(), len(data)])))
                removed.append(int((e - s).sum()))
                counts.append(len(s))
            columns = [batch.column(c) for c in plain]
            if as_text:
                kept = pa.array([data.decode("utf-8", "ignore") for data in kept], pa.string())
            else:
                kept = pa.array(kept, pa.binary())
            columns += [kept] + [pa.array(c, pa.int64()) for c in (totals, removed, counts)]
            yield pa.RecordBatch.from_arrays(columns, names)

    return joined.mapInArrow(run, schema)


#: Every string of 200 bytes by its digest; runs of those that start twice are merged to spans.
ORACLE_SQL = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents),
strings AS (
    SELECT doc_id, i, md5(substr(x, 2 * i + 1, 400)) AS h FROM (SELECT doc_id, x, unnest(range(0, length(x) // 2 - 199)) AS i FROM d)
),
starts AS (SELECT doc_id, i FROM strings QUALIFY count(*) OVER (PARTITION BY h) > 1),
runs AS (
    SELECT doc_id, i, sum(fresh) OVER (PARTITION BY doc_id ORDER BY i) AS run
    FROM (SELECT doc_id, i, CASE WHEN i <= lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 200 THEN 0 ELSE 1 END AS fresh FROM starts)
),
spans AS (SELECT doc_id, run, min(i) AS a, max(i) + 200 AS b FROM runs GROUP BY doc_id, run),
pieces AS (
    SELECT doc_id, a, b, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS before FROM spans
),
kept AS (
    SELECT doc_id, sum(b - a) AS n_removed, count(*) AS n_spans,
        string_agg(substr(x, 2 * before + 1, 2 * (a - before)), '' ORDER BY a) AS front, max(b) AS last
    FROM pieces JOIN d USING (doc_id) GROUP BY doc_id
)
SELECT doc_id, length(x) // 2 AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0) AS n_spans,
    sha256(unhex(CASE WHEN last IS NULL THEN x ELSE front || substr(x, 2 * last + 1) END)) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""
