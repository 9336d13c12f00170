"""Log-likelihoods of whole documents: counts of the whole corpus, and a recurrent model trained side by side."""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelspark.llm.common import checkpoint, lower_words, remainder, remainder_column, text_batches
from parcelspark.llm.importance import CRC_SQL, CRC_TABLE_SQL
from parcelspark.llm.recurrent_lm import Model

#: The end of a document among the words; no word can be this.
END = b"\n"

#: Words with an id of their own in the model: 50 times the fifth root of the training tokens, as other words appear
#: ever more slowly.
def own_ids(tokens: int) -> int:
    return int(50 * tokens**0.2)

#: Ids that all other words share.
SHARED = 16

#: The most frequent words, whose counts every task holds; the counts of all others come by a join.
KNOWN_TO_ALL = 200_000

#: Distinct words that a task counts before it hands them on.
COUNTED = 200_000

#: Tokens of the documents that give all tasks a common start, about; then each trains on all of its own.
START_TOKENS = 1_500_000

#: Tokens that a task trains on, or scores, at once.
AT_ONCE = 3_000_000


def is_training(doc_id: Column) -> Column:
    return remainder_column(doc_id, 7) != 2


def shared_id(word: bytes) -> int:
    return zlib.crc32(word[-2:]) % SHARED


@dataclass(frozen=True)
class Vocabulary:
    """place: of the most frequent words, the first `own` of which are ids of their own; counts: of these words;
    tokens and words: totals; behind: log10 of (tokens + words + 1) for each shared id, and of the whole corpus."""

    place: dict[bytes, int]
    counts: np.ndarray
    own: int
    tokens: int
    words: int
    behind: list[float]

    def size(self) -> int:
        return self.own + SHARED

    def places(self, words: list[bytes]) -> np.ndarray:
        """Place of each word, -1 for one that is not among the most frequent."""
        return np.fromiter(map(self.place.get, words, repeat(-1)), np.int32, len(words))

    def id_of_place(self) -> np.ndarray:
        """The model's id of each of the most frequent words."""
        return np.array([i if i < self.own else self.own + shared_id(w) for w, i in self.place.items()], np.int32)


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, c): tokens of the training documents, ends included; summed in tasks before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter[bytes] = Counter()

        def flush() -> pa.RecordBatch:
            words, n = pa.array(list(found), pa.binary()), pa.array(list(found.values()), pa.int64())
            found.clear()
            return pa.RecordBatch.from_arrays([words, n], ["word", "n"])

        for batch in batches:
            for text in batch.column(0):
                found.update(lower_words(text.as_py()))
                found[END] += 1
            if len(found) > COUNTED:
                yield flush()
        if found:
            yield flush()

    rows = docs.where(is_training(F.col("doc_id"))).select("text").mapInArrow(run, "word binary, n long")
    return rows.groupBy("word").agg(F.sum("n").alias("c"))


def vocabulary(counts: DataFrame) -> Vocabulary:
    """Totals, and the most frequent words, KNOWN_TO_ALL at most: all from the smallest count on that so many reach.

    Counts are binned (64 bins for each doubling), so that the bound comes from a small histogram and not from a sort
    of all words. Words with an id of their own are the first of these by count, then by their bytes.
    """
    bins = F.floor(F.log2("c") * 64)
    least, so_far = None, 0
    for row in sorted(counts.groupBy(bins.alias("bin")).count().collect(), key=lambda r: -r["bin"]):
        so_far += row["count"]
        if so_far > KNOWN_TO_ALL:
            break
        least = row["bin"]
    common = counts.where(bins >= least).collect() if least is not None else []
    common.sort(key=lambda r: (-r["c"], bytes(r["word"])))
    known = {bytes(r["word"]): r["c"] for r in common}
    of = F.pmod(F.crc32(F.expr("substring(word, -2)")), F.lit(SHARED)).cast("int").alias("of")
    rows = counts.groupBy(of).agg(F.sum("c").alias("c"), F.count(F.lit(1)).alias("v")).collect()
    tokens, words = sum(r["c"] for r in rows), sum(r["v"] for r in rows)
    own = list(known)[: own_ids(tokens)]
    behind = [0.0] * (SHARED + 1)
    for r in rows:  # less the words with an id of their own, which are known here
        mine = [known[w] for w in own if shared_id(w) == r["of"]]
        behind[r["of"]] = math.log10(r["c"] - sum(mine) + r["v"] - len(mine) + 1)
    behind[SHARED] = math.log10(tokens + words + 1)
    return Vocabulary({w: i for i, w in enumerate(known)}, np.array(list(known.values()), np.int64), len(own), tokens, words, behind)


def _texts(column: pa.ListArray) -> Iterator[np.ndarray]:
    """Ids of each text of a column."""
    flat, offsets = column.values.to_numpy(), column.offsets.to_numpy()
    return (flat[x:y] for x, y in zip(offsets[:-1].tolist(), offsets[1:].tolist()))


def train(rows: DataFrame, known: Vocabulary) -> Model:
    """Train the model on all training documents of encoded rows, once, at any size of the corpus.

    Training in parallel needs a common start: documents with about START_TOKENS tokens, those of the lowest hashes,
    give it in a first round. In the second every task goes on from there with all documents of its own. After a
    round the tasks' models are averaged by tokens, in two steps, and only the one average goes to the driver.
    """
    model = Model(known.size())
    training = rows.where("not held_out")
    share = min(1.0, START_TOKENS / max(1, known.tokens))
    lowest = F.pmod(F.xxhash64("doc_id", "h"), F.lit(1 << 30)) < int(share * (1 << 30))
    # few tasks for the start, as it is small
    size = known.size()
    rounds = [(training.where(lowest).select("ids").coalesce(8), 0.1), (training.select("ids"), 0.1)]
    for sample, rate in rounds:
        start = model.pack()

        def run(batches: Iterator[pa.RecordBatch], start: bytes = start, rate: float = rate) -> Iterator[pa.RecordBatch]:
            mine = Model(size).unpack(start)
            squares, tokens, texts, held = mine.memory(), 0, [], 0
            for batch in batches:
                for ids in _texts(batch.column(0)):
                    texts.append(ids)
                    held += len(ids)
                    if held > AT_ONCE:
                        tokens += mine.train(texts, rate=rate, squares=squares)
                        texts, held = [], 0
            if texts:
                tokens += mine.train(texts, rate=rate, squares=squares)
            if tokens:
                task = TaskContext.get().partitionId()
                yield pa.RecordBatch.from_arrays(
                    [pa.array([task]), pa.array([mine.pack()], pa.binary()), pa.array([float(tokens)])],
                    ["task", "model", "weight"],
                )

        def average(table: pa.Table) -> pa.Table:
            total, weights = None, 0.0
            for data, weight in zip(table.column("model"), table.column("weight").to_pylist()):
                part = np.frombuffer(data.as_py(), "<f4").astype(np.float64) * weight
                total, weights = part if total is None else total + part, weights + weight
            return pa.table({"model": pa.array([(total / weights).astype("<f4").tobytes()], pa.binary()), "weight": [weights]})

        trained = checkpoint(sample.mapInArrow(run, "task long, model binary, weight double"))
        groups = max(1, math.isqrt(trained.count()))
        schema = "model binary, weight double"
        parts = trained.groupBy(F.pmod("task", F.lit(groups))).applyInArrow(average, schema)
        mean = parts.groupBy().applyInArrow(average, schema).collect()
        if mean:
            model.unpack(bytes(mean[0]["model"]))
    return model


def _rare(rows: DataFrame) -> DataFrame:
    """(h, g, word, n): words of each document whose counts tasks do not hold."""
    words = F.explode(F.arrays_zip("rare", "rare_n")).alias("w")
    return rows.select("h", "g", words).select("h", "g", F.col("w.rare").alias("word"), F.col("w.rare_n").alias("n"))


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("h"), F.hash("text").alias("g"), "text")


def _encoded(docs: DataFrame, known) -> DataFrame:
    """One row for each document with its ids and all that needs neither join nor model: tokens, known ones, sums of
    log10(c + 1) over common words (all, and those that share an id), the shared ids' terms, and the words that do
    need a join."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = known.value
        own, of_place = v.own, v.id_of_place()
        log = np.append(np.log10(v.counts + 1.0), 0.0)  # the last for a word that is not held
        behind = np.append(np.zeros(own), v.behind[:SHARED])
        for batch in batches:
            texts, rows, rare, rare_n, rare_at = [], [], [], [], [0]
            for text in batch.column("text"):
                words = [*lower_words(text.as_py()), END]
                places = v.places(words)
                logs = log[places]
                ids = of_place[places] if len(of_place) else np.zeros(len(words), np.int32)
                unheld = np.flatnonzero(places < 0)
                if len(unheld):
                    those = [words[i] for i in unheld.tolist()]
                    ids[unheld] = [own + shared_id(w) for w in those]
                    those = Counter(those)
                    rare += those
                    rare_n += those.values()
                rare_at.append(len(rare))
                shared = float(logs[places >= own].sum())
                rows.append((len(words), len(words) - len(unheld), float(logs.sum()), shared, float(behind[ids].sum())))
                texts.append(ids)
            columns = [batch.column(c) for c in ("doc_id", "h", "g")]
            columns.append(pa.array([remainder(d, 7) == 2 for d in columns[0].to_pylist()], pa.bool_()))
            n, k, all_logs, shared_logs, behind_logs = zip(*rows) if rows else ((),) * 5
            columns += [pa.array(n, pa.int64()), pa.array(k, pa.int64())]
            columns += [pa.array(x, pa.float64()) for x in (all_logs, shared_logs, behind_logs)]
            offsets = pa.array(np.cumsum([0, *n]), pa.int32())
            flat = np.concatenate([np.zeros(0, np.int32), *texts])
            columns.append(pa.ListArray.from_arrays(offsets, pa.array(flat, pa.int32())))
            rare_at = pa.array(rare_at, pa.int32())
            columns.append(pa.ListArray.from_arrays(rare_at, pa.array(rare, pa.binary())))
            columns.append(pa.ListArray.from_arrays(rare_at, pa.array(rare_n, pa.int64())))
            yield pa.RecordBatch.from_arrays(columns, names)

    schema = (
        "doc_id long, h long, g int, held_out boolean, n long, k long, all_logs double, shared_logs double, "
        "behind double, ids array<int>, rare array<binary>, rare_n array<long>"
    )
    names = [c.split()[0] for c in schema.split(", ")]
    return _keyed(docs).mapInArrow(run, schema)


def _scored(rows: DataFrame, known: Vocabulary, model: Model) -> DataFrame:
    """Encoded rows, but for ids and rare words, with the model's score."""
    packed, size = rows.sparkSession.sparkContext.broadcast(model.pack()), known.size()
    plain = [c for c in rows.columns if c not in ("ids", "rare", "rare_n")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = Model(size).unpack(packed.value)
        held: list[pa.RecordBatch] = []
        texts, tokens = [], 0

        def flush() -> pa.RecordBatch:
            columns = [pa.concat_arrays([b.column(c) for b in held]) for c in plain]
            return pa.RecordBatch.from_arrays([*columns, pa.array(m.score(texts))], [*plain, "score"])

        for batch in batches:
            held.append(batch.select(plain))
            texts += _texts(batch.column("ids"))
            tokens += len(batch.column("ids").values)
            if tokens > AT_ONCE:  # many texts side by side keep the long ones cheap
                yield flush()
                held, texts, tokens = [], [], 0
        if texts:
            yield flush()

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields if f.name in plain)
    return rows.select(*plain, "ids").mapInArrow(run, f"{kinds}, score double")


def score(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) for each row of docs (doc_id, text).

    held_out: crc32 of the id as text has remainder 2 by 7; only other documents are learnt from. base_score: each
    token by its smoothed share of the training tokens. score: log10 of the model's probability of the whole text;
    a word without an id of its own has the probability of its shared id times its smoothed share among the words
    behind it. Null and empty texts are one end token. Without training documents N is 0 and every base_score 0. Rows
    and repeats stay, other columns are ignored, an empty table gives an empty table.
    """
    context = text_batches(docs).sparkSession.sparkContext
    counts = checkpoint(word_counts(docs))
    known = vocabulary(counts)
    encoded = checkpoint(_encoded(docs, context.broadcast(known)))
    rows = checkpoint(_scored(encoded, known, train(encoded, known)))
    # sums over equal texts are divided by their number, as each brings its words
    copies = rows.groupBy("h", "g").agg(F.count(F.lit(1)).alias("copies"))
    rare = (
        _rare(encoded).join(counts, "word").groupBy("h", "g")
        .agg(F.sum("n").alias("more_k"), F.sum(F.col("n") * F.log10(F.col("c") + 1)).alias("more"))
        .join(copies, ["h", "g"])
        .select("h", "g", (F.col("more_k") / F.col("copies")).cast("long").alias("more_k"), (F.col("more") / F.col("copies")).alias("more"))
    )
    more, more_k = F.coalesce("more", F.lit(0.0)), F.coalesce("more_k", F.lit(0))
    return rows.join(rare, ["h", "g"], "left").select(
        "doc_id", "held_out", F.col("n").alias("n_tokens"), (F.col("k") + more_k).alias("n_known"),
        F.lit(known.tokens).cast("long").alias("train_tokens"),
        (F.col("all_logs") + more - F.col("n") * F.lit(known.behind[SHARED])).alias("base_score"),
        (F.col("score") + F.col("shared_logs") + more - F.col("behind")).alias("score"),
    )


#: The columns that come from counts, scores to three places; the model has no SQL.
BASE_SQL = rf"""
WITH {CRC_TABLE_SQL},
d AS (
    SELECT doc_id, hex(encode(doc_id::VARCHAR)) AS x, list_append(regexp_extract_all(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+'), chr(10)) AS w
    FROM documents
),
held AS (SELECT doc_id, w, {CRC_SQL} % 7 = 2 AS held_out FROM d, tab),
tokens AS (SELECT doc_id, held_out, unnest(w) AS w FROM held),
counts AS (SELECT w, count(*) FILTER (NOT held_out) AS c FROM tokens GROUP BY w),
total AS (SELECT sum(c) AS n, count(*) FILTER (c > 0) AS v FROM counts)
SELECT doc_id, held_out, count(*) AS n_tokens, count(*) FILTER (c > 0) AS n_known, any_value(n)::BIGINT AS train_tokens,
    round(sum(log10((c + 1) / (n + v + 1))), 3) AS base_score
FROM tokens JOIN counts USING (w), total GROUP BY doc_id, held_out
"""
