"""Quality rules: a gradient-boosted tree verdict over document statistics."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelspark.llm import boosting
from parcelspark.llm.common import text_batches, utf8, with_fields
from parcelspark.llm.repeats import _pair

#: Labelled documents that the trees are fitted on, at most: those whose ids hash lowest.
FIT_ROWS = 20_000

#: Scores from which on a document is kept. The trees are fitted for the share of good documents; a document is
#: rejected only if it is rather likely bad.
THRESHOLD = 0.35

SYMBOLS = b"#*$%&|<>"
BLANKS = b" \t\n\x0b\x0c\r"
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")

#: What the trees see, by name; the score may only fall with those named in FALLING.
FEATURES = (
    "log_words", "chars_per_word", "symbols_per_char", "dup_line_share", "repeat_share", "distinct_share",
    "top_word_share", "same_as_last_share", "upper_share", "digit_share", "wide_share", "words_per_line",
    "longest_word", "stop_share",
)
FALLING = ("symbols_per_char", "dup_line_share", "repeat_share", "top_word_share", "same_as_last_share", "digit_share")


def repeat_words(hashes: np.ndarray, width: int = 8) -> int:
    """Words covered by windows of `width` words that occur twice or more."""
    if len(hashes) <= width:
        return 0
    x, have = hashes.view(np.uint64), 1
    while have < width:
        step = min(have, width - have)
        x = _pair(x[:-step], x[step:])
        have += step
    order = np.argsort(x, kind="stable")
    same = x[order][1:] == x[order][:-1]
    if not same.any():
        return 0
    twice = np.zeros(len(x), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    edge = np.zeros(len(hashes) + 1, np.int64)
    edge[: len(x)] += twice
    edge[width : width + len(x)] -= twice
    return int((edge.cumsum() > 0).sum())


def statistics(text: str | None) -> tuple[list[int], list[float]]:
    """(COUNTS, FEATURES) of one text; null is an empty text."""
    data = utf8(text)
    words = data.split()
    n, chars = len(words), len(text or "")
    word_chars = chars - (len(data) - len(data.translate(None, BLANKS)))
    n_symbols = len(data) - len(data.translate(None, SYMBOLS))
    lines = [x for x in data.split(b"\n") if x.strip()]
    n_dup = len(lines) - len(set(lines))
    hashes = np.fromiter(map(hash, words), np.int64, n)
    n_repeat = repeat_words(hashes)
    counts = [n, word_chars, n_symbols, n_dup, n_repeat]
    if not n:
        return counts, [0.0] * len(FEATURES)
    ordered = np.sort(hashes)
    new = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
    times = np.diff(np.concatenate([new, [n]]))
    letters = len(data.translate(None, b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"))
    digits = len(data.translate(None, b"0123456789"))
    short = sum(1 for w in words if len(w) <= 3)
    features = [
        float(np.log1p(n)), word_chars / n, n_symbols / max(1, word_chars), n_dup / max(1, len(lines)), n_repeat / n,
        len(new) / n**0.75, int(times.max()) / n, float((hashes[1:] == hashes[:-1]).mean()) if n > 1 else 0.0,
        (len(data) - letters) / n, (len(data) - digits) / max(1, word_chars), (len(data) - chars) / max(1, chars),
        n / max(1, len(lines)), float(max(map(len, words))), short / n,
    ]
    return counts, features



def train(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS) -> boosting.Trees:
    """Trees for labels.quality, from at most `rows` labelled documents.

    Rows of labels without an id or with a quality other than 0 and 1 are left out; an id labelled both ways counts
    as 0. Of documents that repeat an id one is taken. Without labels the trees give one score to all documents.
    """
    sample = (
        labels.where("doc_id is not null and quality in (0, 1)")
        .groupBy("doc_id")
        .agg(F.min("quality").alias("quality"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(rows)
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [statistics(t.as_py())[1] for t in batch.column(2)]
            features = pa.array(found, pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), features], ["doc_id", "y", "x"])

    # `rows` ids at most, so the table is small whatever the input
    joined = docs.select(F.col("doc_id").cast("long"), "text").join(
        F.broadcast(sample.select(F.col("doc_id").cast("long"), F.col("quality").cast("double").alias("y"))), "doc_id"
    ).select("doc_id", "y", "text")
    found = (
        joined.mapInArrow(run, "doc_id long, y double, x array<double>")
        .groupBy("doc_id").agg(F.min("y").alias("y"), F.min("x").alias("x"))
        .toPandas().sort_values("doc_id")
    )
    x = np.array(found["x"].tolist(), float).reshape(-1, len(FEATURES))
    monotone = {FEATURES.index(f): -1 for f in FALLING}
    return boosting.fit(x, found["y"].to_numpy(float), monotone)


def judge(docs: DataFrame, trees: boosting.Trees, threshold: float = THRESHOLD) -> DataFrame:
    """docs with _n_words, _word_chars, _n_symbols, _n_dup_lines, _n_repeat_words, _base_failed, _score and _kept.

    A document is kept if it passes the base rules and its score reaches the threshold. Null and empty texts have
    zero counts and fail. Rows, other columns and repeats stay as they are; a column named like an added one is
    replaced; an empty table gives an empty table.
    """
    kinds = {f"_{name}": "long" for name in COUNTS}
    docs = text_batches(docs).drop(*kinds, "_base_failed", "_score", "_kept")
    plain = docs.columns
    schema = with_fields(docs, **kinds, _base_failed="boolean", _score="double", _kept="boolean")
    names = schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [statistics(t.as_py()) for t in batch.column("text")]
            counts = np.array([c for c, _ in found], np.int64).reshape(-1, len(COUNTS))
            score = trees.probability(np.array([f for _, f in found], float).reshape(-1, len(FEATURES)))
            failed = (counts[:, 0] < 20) | (100 * counts[:, 4] > 30 * counts[:, 0])
            columns = [batch.column(c) for c in plain] + [pa.array(c) for c in counts.T]
            columns += [pa.array(failed), pa.array(score), pa.array(~failed & (score >= threshold))]
            yield pa.RecordBatch.from_arrays(columns, names)

    return docs.mapInArrow(run, schema)


#: The counts and the base rules; the verdict of the trees has no SQL.
COUNTS_SQL = r"""
WITH d AS (
    SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
),
lines AS (
    SELECT doc_id, count(*) - count(DISTINCT line) AS n_dup_lines
    FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM d)
    WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id
),
grams AS (
    SELECT doc_id, i, array_to_string(w[i:i + 7], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 6)) AS i FROM d)
),
repeated AS (
    SELECT doc_id, count(DISTINCT p) AS n_repeat_words
    FROM (SELECT doc_id, unnest(range(i, i + 8)) AS p FROM grams QUALIFY count(*) OVER (PARTITION BY doc_id, g) > 1)
    GROUP BY doc_id
),
counts AS (
    SELECT doc_id, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
        len(regexp_extract_all(t, '[#*$%&|<>]')) AS n_symbols, coalesce(n_dup_lines, 0) AS n_dup_lines,
        coalesce(n_repeat_words, 0) AS n_repeat_words
    FROM d LEFT JOIN lines USING (doc_id) LEFT JOIN repeated USING (doc_id)
)
SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM counts
"""
