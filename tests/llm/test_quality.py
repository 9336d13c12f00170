import re
from collections import Counter

import numpy as np
import pytest

from parcelspark.llm import boosting, quality
from tests.llm.data import TEXTS, documents, plain, word_list

SF_DIR = "/root/testdata/sf0.1"


def counts_of(text):
    words = word_list(text)
    lines = [x for x in (text or "").split("\n") if word_list(x)]
    windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    covered = {i + j for i in range(len(words) - 7) if windows[tuple(words[i : i + 8])] > 1 for j in range(8)}
    return [len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered)]


def test_counts_equal_brute_force(spark):
    for text in TEXTS + [r.text for r in plain(spark, "/root/testdata/sf0.001").collect()]:
        assert quality.statistics(text)[0] == counts_of(text)


def test_awkward_documents_keep_rows_and_columns(spark):
    docs = documents(spark)
    trees = quality.train(docs, spark.createDataFrame([(None, 1), (0, None), (1, 1), (1, 0), (4, 7)], "doc_id long, quality int"))
    found = quality.judge(docs, trees)
    assert found.columns[: len(docs.columns)] == docs.columns
    rows = found.collect()
    assert len(rows) == docs.count()
    for r in rows:
        n, _, _, _, repeated = counts_of(r.text)
        assert [r._n_words, r._word_chars, r._n_symbols, r._n_dup_lines, r._n_repeat_words] == counts_of(r.text)
        assert r._base_failed == (n < 20 or 100 * repeated > 30 * n)
        assert r._kept == (not r._base_failed and r._score >= quality.THRESHOLD)


def test_empty_tables(spark):
    none = documents(spark, [])
    labels = spark.createDataFrame([], "doc_id long, quality int")
    trees = quality.train(none, labels)
    assert quality.judge(none, trees).count() == 0
    assert len({r._score for r in quality.judge(documents(spark), trees).collect()}) == 1


def test_held_out_documents_are_judged_right(spark):
    docs, labels = plain(spark, SF_DIR), plain(spark, SF_DIR, "labels")
    part = "crc32(cast(cast(doc_id as string) as binary)) % 3 "
    trees = quality.train(docs, labels.where(part + "<> 1"))
    rows = quality.judge(docs.where(part + "= 1"), trees).join(labels, "doc_id").where("quality is not null").collect()
    right = np.mean([(r._score >= 0.5) == (r.quality == 1) for r in rows])
    share = np.mean([r.quality == 1 for r in rows])
    assert right > max(share, 1 - share)
    good = [r for r in rows if r.quality == 1 and not r._base_failed]
    assert np.mean([r._kept for r in good]) > 0.9


def test_scores_only_fall_with_the_chosen_features():
    draw = np.random.default_rng(1)
    x = draw.random((2000, 3))
    y = (x[:, 0] + np.sin(9 * x[:, 1]) + draw.normal(0, 0.5, 2000) < 1).astype(float)
    trees = boosting.fit(x, y, {0: -1})
    for row in x[:50]:
        line = np.repeat(row[None], 60, axis=0)
        line[:, 0] = np.linspace(-0.5, 1.5, 60)
        assert (np.diff(trees.probability(line)) <= 1e-12).all()
    assert ((trees.probability(x) > 0.5) == (y == 1)).mean() > 0.75


@pytest.mark.parametrize("y", [[], [1.0] * 9])
def test_trees_without_two_classes_give_one_score(y):
    trees = boosting.fit(np.zeros((len(y), 2)), np.array(y), {})
    assert len(set(trees.probability(np.arange(10.0).reshape(5, 2)).tolist())) == 1
