"""Mix sources to target weights by nested hash thresholds.

Each document has a fixed hash. A source is taken whole as often as its target allows, and of the rest the documents
whose hash lies below a threshold. The threshold comes from histograms: words are summed by source and leading hash
bits, the bucket in which the budget ends is found, and only documents of this bucket are looked at again, by the
next bits. Documents are then filtered; nothing is sorted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parcelspark.llm.common import checkpoint, unused, word_count

WEIGHTS = (5, 2, 1)
MOST_TIMES = 3
HASH_BITS = 60
STEP_BITS = 12

#: Tables with one row for each source are broadcast up to this many rows, and joined by a shuffle beyond.
MOST_BROADCAST = 50_000


def document_hash() -> Column:
    """60 bits from the id and the text, the same in every run."""
    name = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.coalesce("text", F.lit("")))
    return F.conv(F.substring(F.md5(name.cast("binary")), 1, 15), 16, 10).cast("long")


def _by_source(table: DataFrame) -> DataFrame:
    """A table of one row for each source, as the small side of a join if its counted size allows it."""
    return F.broadcast(table) if table.count() <= MOST_BROADCAST else table


def _targets(sizes: DataFrame, weights: tuple[int, ...], most: int) -> DataFrame:
    """(sid, source, source_size, weight, target): the water level at which the targets share all words.

    A source is full once level x weight is above `most` times its size; a full source gives its excess to the rest,
    which raises the level. Each round is one sum over the sources; a source once full stays full.
    """
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))  # one row for each source
    weight = F.element_at(F.array(*map(F.lit, weights)), F.pmod(F.col("sid") - 1, F.lit(len(weights))) + 1)
    sources = checkpoint(sizes.withColumn("sid", rank).withColumn("weight", weight))
    level, full = 0.0, -1
    while True:
        is_full = F.col("weight") * F.lit(level) > most * F.col("source_size")
        row = sources.agg(
            F.sum("source_size").alias("all"),
            F.sum(F.when(is_full, most * F.col("source_size")).otherwise(0)).alias("given"),
            F.sum(F.when(is_full, 0).otherwise(F.col("weight"))).alias("weights"),
            F.sum(is_full.cast("int")).alias("full"),
        ).first()
        if row["all"] is None or row["full"] == full or not row["weights"]:
            break
        full = row["full"]
        level = (row["all"] - row["given"]) / row["weights"]
    target = F.when(is_full, (most * F.col("source_size")).cast("double")).otherwise(F.col("weight") * F.lit(level))
    return sources.withColumn("target", target)


def plan(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_TIMES) -> DataFrame:
    """(source, source_size, target, times, threshold): how often a source is taken whole, and up to which hash once
    more. Documents with one hash (repeated rows) go together; of the two ends of the last step the one nearer to the
    target is taken."""
    rows = checkpoint(docs.select("source", word_count(F.col("text")).alias("size"), document_hash().alias("h")))
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = _targets(sizes, weights, most)
    times = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    state = targets.withColumn("times", F.least(times, F.lit(most)).cast("int")).withColumn(
        "budget", F.when(F.col("times") >= most, 0.0).otherwise(F.col("target") - F.col("times") * F.col("source_size"))
    )
    # prefix: hash bits found so far; below: words of the source with a smaller prefix; last: words at the prefix
    state = checkpoint(state.withColumn("prefix", F.lit(0).cast("long")).withColumn("below", F.lit(0).cast("long")))
    for shift in range(HASH_BITS - STEP_BITS, -1, -STEP_BITS):
        inside = rows.join(_by_source(state.withColumnRenamed("source", "_source")), F.col("source").eqNullSafe(F.col("_source")))
        inside = inside.where(F.shiftright("h", shift + STEP_BITS) == F.col("prefix"))
        buckets = inside.groupBy("sid", F.shiftright("h", shift).alias("bucket")).agg(F.sum("size").alias("words"))
        # at most 2^STEP_BITS rows for each source
        running = buckets.withColumn("upto", F.sum("words").over(Window.partitionBy("sid").orderBy("bucket")))
        at = running.join(state.select("sid", "budget", "below"), "sid").where(F.col("below") + F.col("upto") > F.col("budget"))
        first = at.groupBy("sid").agg(F.min(F.struct("bucket", F.col("upto") - F.col("words"), "words")).alias("at"))
        first = first.select("sid", F.col("at.bucket").alias("bucket"), F.col("at.col2").alias("more"), F.col("at.words").alias("words"))
        state = checkpoint(
            state.drop("last").join(first, "sid", "left")
            .withColumn("prefix", F.coalesce("bucket", F.shiftleft("prefix", STEP_BITS)))
            .withColumn("below", F.col("below") + F.coalesce("more", F.lit(0)))
            .withColumn("last", F.coalesce("words", F.lit(0)))
            .drop("bucket", "more", "words")
        )
    over = (F.col("below") + F.col("last") - F.col("budget")) < (F.col("budget") - F.col("below"))
    threshold = F.when(F.col("budget") <= 0, -1).when(over, F.col("prefix")).otherwise(F.col("prefix") - 1)
    return state.select("source", "source_size", "target", "times", threshold.cast("long").alias("threshold"))


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_TIMES) -> DataFrame:
    """docs (doc_id, text, source, ...) with _size, _source_size, _target and _times, the copies the mix takes.

    Sizes are words. Weights go in turn to the sources by code point, null last; targets stop at `most` times a
    source's size. No document is taken more than `most` times. Null and empty texts have size 0; whether they are
    taken follows their hash and changes no sum. Repeated rows share a hash and are taken alike. An empty table gives
    an empty table. Other columns stay as they are; one named like an added one is replaced.
    """
    docs = docs.drop("_size", "_source_size", "_target", "_times")
    of, whole, threshold = (unused(docs, name) for name in ("_of", "_whole", "_threshold"))
    steps = plan(docs, weights, most).select(
        F.col("source").alias(of), F.col("source_size").alias("_source_size"), F.col("target").alias("_target"),
        F.col("times").alias(whole), F.col("threshold").alias(threshold),
    )
    joined = docs.join(_by_source(steps), F.col("source").eqNullSafe(F.col(of)))
    more = (document_hash() <= F.col(threshold)).cast("int")
    return joined.select(
        *docs.columns, word_count(F.col("text")).alias("_size"), "_source_size", "_target",
        (F.col(whole) + more).alias("_times"),
    )


def repeat(mixed: DataFrame) -> DataFrame:
    """The rows that the mix takes, each as often as it takes it, with the columns of the documents."""
    copy = unused(mixed, "_copy")
    taken = mixed.where("_times > 0").withColumn(copy, F.explode(F.sequence(F.lit(1), F.col("_times"))))
    return taken.drop(copy, "_size", "_source_size", "_target", "_times")


ORACLE_SQL = r"""
WITH d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
         CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || coalesce(text, '')), 1, 15) AS BIGINT) AS h
  FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (SELECT *, [5, 2, 1][CAST((row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % 3 + 1 AS INT)] AS weight FROM s),
-- full sources come first when ordered by size for each unit of weight; the level if the first n are full
o AS (SELECT *, row_number() OVER (ORDER BY source_size / weight, source) AS n FROM w),
l AS (SELECT n, weight, source_size,
        CAST((SELECT sum(source_size) FROM w) - coalesce(sum(3 * source_size) OVER (ORDER BY n ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE)
        / CAST(sum(weight) OVER (ORDER BY n ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS DOUBLE) AS level
      FROM o),
best AS (SELECT arg_min(level, n) AS level FROM l WHERE level * weight <= 3 * source_size),
t AS (SELECT w.source, source_size,
        CASE WHEN weight * level > 3 * source_size THEN CAST(3 * source_size AS DOUBLE) ELSE weight * level END AS target
      FROM w, best),
k AS (SELECT *, CASE WHEN source_size > 0 THEN least(CAST(floor(target / source_size) AS BIGINT), 3) ELSE 0 END AS times FROM t),
b AS (SELECT *, CASE WHEN times >= 3 THEN 0 ELSE target - times * source_size END AS budget FROM k),
c AS (SELECT d.*, b.source_size, b.target, b.times, b.budget,
        sum(size) OVER (PARTITION BY d.source ORDER BY h RANGE UNBOUNDED PRECEDING) AS upto,
        sum(size) OVER (PARTITION BY d.source, h) AS same
      FROM d JOIN b ON d.source IS NOT DISTINCT FROM b.source)
SELECT doc_id, size, source_size, target,
  size * (times + CASE WHEN budget > 0 AND (upto <= budget OR (upto - same <= budget AND upto - budget < budget - (upto - same)))
                       THEN 1 ELSE 0 END) AS taken
FROM c
"""
