import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings, strategies as st

from parcelspark.llm import importance
from tests.llm.data import SF_DIR, documents, lower, plain


def grams(text, longest=1):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))
    runs = [" ".join(words[i : i + n]) for n in range(1, longest + 1) for i in range(len(words) - n + 1)]
    return words, runs


def expected(docs, target, longest=1, buckets=10_000):
    """{position: (doc_id, n_features, weight, score)} and the positions drawn, best first; one loop a rule."""
    of = lambda g: zlib.crc32(g.encode("utf-8", "replace")) % buckets
    s = Counter(of(g) for _, text in docs for g in grams(text, longest)[1])
    t = Counter(of(g) for text in target for g in grams(text, longest)[1])
    S, T = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (S + buckets) / ((s[b] + 1) * (T + buckets))))
    rows, enough = [], []
    for i, (doc_id, text) in enumerate(docs):
        words, runs = grams(text, longest)
        weight = sum(gain(of(g)) for g in runs) // len(runs) if runs else 0
        h = int(hashlib.sha256(f"2024:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        rows.append((doc_id, len(runs), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
        if len(words) >= 20:
            enough.append(i)
    enough.sort(key=lambda i: (-rows[i][3], rows[i][0] is None, rows[i][0] or 0))
    return rows, enough


@given(st.lists(st.binary(max_size=40), max_size=30), st.integers(1, 3))
@settings(max_examples=60, deadline=None)
def test_words_and_table_equal_a_loop(texts, longest):
    texts = [t.decode("utf-8", "ignore") for t in texts]
    found = importance.bucket_counts([t.encode() for t in texts], longest, 97)
    by_hand = Counter(zlib.crc32(g.encode()) % 97 for t in texts for g in grams(t, longest)[1])
    assert found.tolist() == [by_hand[b] for b in range(97)]


def test_keys_are_xxh64():
    data = np.frombuffer(bytes(range(256)) * 2, np.uint8)
    starts, lengths = np.arange(60), np.arange(1, 61)
    keys = importance.keys_of(data, starts, lengths)
    assert keys.tolist() == [xxhash.xxh64_intdigest(data[s : s + n].tobytes()) for s, n in zip(starts, lengths)]


def test_equal_keys_do_not_merge_different_words():
    texts = [b"ape bee cat ape dog bee", b"cat cow ape"]
    data, starts, lengths, _, _ = importance.ngrams(texts)
    table = importance.Interned(data, starts, lengths, 1000, keys=lambda d, s, n: np.zeros(len(s), np.uint64))
    words = [data[s : s + n].tobytes() for s, n in zip(starts, lengths)]
    assert len(set(table.slot.tolist())) == 5
    assert all(table.count[k] == words.count(w) and table.bucket[k] == zlib.crc32(w) % 1000 for k, w in zip(table.slot, words))


def test_pieces_change_nothing(monkeypatch):
    texts = [f"word{i % 7} of {'long ' * (i % 5)}".encode() for i in range(50)]
    whole = importance.bucket_counts(texts, 2)
    gains = np.arange(importance.BUCKETS) - 5000
    scores = importance.weights(texts, gains, 2)
    monkeypatch.setattr(importance, "PIECE", 20)
    assert (importance.bucket_counts(texts, 2) == whole).all()
    assert all((a == b).all() for a, b in zip(importance.weights(texts, gains, 2), scores))


@pytest.mark.parametrize("longest", [1, 2])
def test_sample_equals_brute_force(spark, longest):
    docs = plain(spark, SF_DIR)
    target = plain(spark, SF_DIR, "benchmark")
    rows, order = expected(
        [tuple(r) for r in docs.select("doc_id", "text").collect()], [r.text for r in target.collect()], longest
    )
    drawn = order[: len(order) * 10 // 100]
    assert drawn
    found = {r.doc_id: tuple(r) for r in importance.resample(docs, target, longest).collect()}
    assert found == {r[0]: (*r, drawn.index(i) + 1 if i in drawn else None) for i, r in enumerate(rows)}


def test_awkward_rows(spark):
    docs = documents(spark)
    target = spark.createDataFrame([("The quick brown fox",), (None,), ("",)], "text string")
    rows, order = expected([(r.doc_id, r.text) for r in docs.collect()], ["The quick brown fox", None, ""])
    found = importance.resample(docs, target, percent=100).collect()
    assert sorted(map(repr, ((r.doc_id, r.n_features, r.weight, r.score) for r in found))) == sorted(map(repr, rows))
    ranks = sorted((r["rank"], -r.score) for r in found if r["rank"] is not None)
    assert [r for r, _ in ranks] == list(range(1, len(order) + 1)) and ranks == sorted(ranks, key=lambda x: x[1])


def test_empty_tables(spark):
    none, some = spark.createDataFrame([], "doc_id long, text string"), spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    assert importance.resample(none, some).collect() == []
    assert importance.resample(some, none).collect()[0][:3] == (1, 2, math.floor(1000 * math.log(10_002 / (2 * 10_000))))


def test_many_rows_of_one_id_are_ranked_once_each(spark):
    docs = spark.range(3000).selectExpr("if(id % 3 = 0, 7, id) AS doc_id", "repeat('same words ', 20) AS text")
    ranks = sorted(r["rank"] for r in importance.resample(docs, docs, percent=100).collect())
    assert ranks == list(range(1, 3001))
