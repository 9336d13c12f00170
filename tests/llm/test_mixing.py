from collections import defaultdict

import duckdb
import pytest

from parcelspark.llm import mixing
from tests.llm.data import documents, plain, word_list

SF_DIR = "/root/testdata/sf0.01"


def targets(sizes):
    """Targets by sharing out the excess again and again."""
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + ([None] if None in sizes else [])
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    full, total = set(), sum(sizes.values())
    while True:
        rest = total - sum(3 * sizes[s] for s in full)
        weights = sum(w for s, w in weight.items() if s not in full)
        now = {s: 3 * sizes[s] if s in full else rest * weight[s] / weights for s in order}
        more = {s for s in order if s not in full and now[s] > 3 * sizes[s]}
        if not more:
            return now
        full |= more


def plain_rows(spark, texts):
    return spark.createDataFrame([(i, t, "web") for i, t in enumerate(texts)], "doc_id long, text string, source string")


def check(docs):
    found = mixing.mix(docs).collect()
    assert len(found) == docs.count()
    sizes, taken, largest = defaultdict(int), defaultdict(int), defaultdict(int)
    for r in found:
        assert r._size == len(word_list(r.text))
        assert 0 <= r._times <= 3
        sizes[r.source] += r._size
        taken[r.source] += r._size * r._times
        largest[r.source] = max(largest[r.source], r._size)
    goal = targets(sizes)
    copies = 2  # rows that repeat wholly are taken together
    for r in found:
        assert r._source_size == sizes[r.source] and r._target == pytest.approx(goal[r.source])
    for s in sizes:
        assert abs(taken[s] - goal[s]) <= copies * largest[s]
    again = sorted((str(r.doc_id), r.text or "", r._times) for r in mixing.mix(docs.repartition(3)).collect())
    assert again == sorted((str(r.doc_id), r.text or "", r._times) for r in found)


def test_awkward_documents(spark):
    check(documents(spark))


def test_sample_comes_near_its_targets(spark):
    check(plain(spark, SF_DIR))


def test_sources_beyond_the_broadcast_bound_give_the_same(spark, monkeypatch):
    docs = documents(spark)
    before = sorted(map(str, mixing.mix(docs).collect()))
    monkeypatch.setattr(mixing, "MOST_BROADCAST", 0)
    assert sorted(map(str, mixing.mix(docs).collect())) == before


def test_sample_equals_sql(spark):
    con = duckdb.connect()
    con.sql(f"create view documents as select * from '{SF_DIR}/documents.parquet'")
    expected = sorted(con.sql(f"select doc_id, size, source_size, taken from ({mixing.ORACLE_SQL})").fetchall())
    found = mixing.mix(plain(spark, SF_DIR)).selectExpr("doc_id", "_size", "_source_size", "_size * _times").collect()
    assert sorted(map(tuple, found)) == expected


def test_documents_without_words_and_empty_tables(spark):
    wordless = plain_rows(spark, ["", None, " "])
    assert [(r._size, r._target) for r in mixing.mix(wordless).collect()] == [(0, 0.0)] * 3
    none = documents(spark, [])
    assert mixing.mix(none).count() == 0 and mixing.repeat(mixing.mix(none)).columns == none.columns


def test_rows_are_repeated_as_often_as_taken(spark):
    docs = documents(spark)
    mixed = mixing.mix(docs)
    rows = mixing.repeat(mixed)
    assert rows.columns == docs.columns
    assert rows.count() == sum(r._times for r in mixed.collect())
