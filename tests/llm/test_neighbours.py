import numpy as np

from parcelspark.llm import neighbours
from tests.llm.data import plain


def nearest(ids, vectors, query, k=5):
    x = np.array(vectors, np.float32).astype(float)
    norms = np.linalg.norm(x, axis=1)
    q = list(ids).index(query)
    score = x @ x[q] / (norms * norms[q])
    order = [i for i in np.lexsort((ids, -score)) if ids[i] != query][:k]
    return [(int(ids[i]), score[i]) for i in order]


def test_recall_on_the_sample(spark):
    table = plain(spark, "/root/testdata/sf0.1", "embeddings")
    rows = table.collect()
    ids, vectors = np.array([r.vec_id for r in rows]), [r.embedding for r in rows]
    found = {}
    for r in neighbours.search(table).collect():
        found.setdefault(r.query_id, []).append(r)
    assert sorted(found) == sorted(int(i) for i in ids if i % 50 == 0)
    score_of, hits = {}, 0
    for query, of in found.items():
        of.sort(key=lambda r: r["rank"])
        assert [r["rank"] for r in of] == [1, 2, 3, 4, 5]
        assert [(-r.score, r.vec_id) for r in of] == sorted((-r.score, r.vec_id) for r in of)
        score_of = dict(nearest(ids, vectors, query, len(ids)))
        assert all(abs(score_of[r.vec_id] - r.score) < 1e-12 for r in of)
        hits += len({r.vec_id for r in of} & {i for i, _ in nearest(ids, vectors, query)})
    assert hits / (5 * len(found)) >= 0.9


def test_awkward_vectors(spark):
    rows = [(i, [float(i % 7), float(i % 3) - 1, 1.0], 0, "x") for i in range(120)]
    rows += [(150, None, 0, "x"), (200, [], 0, "x"), (250, [0.0, 0.0, 0.0], 0, "x"), (300, [1.0, None, 2.0], 0, "x"),
             (350, [1.0, float("nan"), 2.0], 0, "x"), (400, [float("inf"), 1.0, 2.0], 0, "x"), (None, [1.0, 2.0, 3.0], 0, "x"),
             (450, [1.0, 2.0], 0, "x"), rows[3]]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>, node long, score string")
    found = {}
    for r in sorted(neighbours.search(table).collect(), key=lambda r: (r.query_id, r["rank"])):
        found.setdefault(r.query_id, []).append((r.vec_id, r.score))
    assert set(found) == {0, 50, 100}  # 450 has no candidate of its length
    fine = [*rows[:120], rows[3]]  # the row that repeats is a candidate of its own
    for query, of in found.items():
        want = nearest([r[0] for r in fine], [r[1] for r in fine], query)
        assert [i for i, _ in of] == [i for i, _ in want]  # many ties: the smaller ids
        assert np.allclose([s for _, s in of], [s for _, s in want], atol=1e-12)


def test_a_repeated_id_is_two_candidates(spark):
    """The contract: every row but the query's own."""
    rows = [(0, [1.0, 0.0, 0.0]), (7, [0.0, 1.0, 0.0]), (7, [1.0, 0.01, 0.0]), (9, [0.9, 0.1, 0.4]), (0, [1.0, 0.02, 0.0])]
    found = neighbours.search(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert len(found) == 8 and {r.query_id for r in found} == {0}
    best = sorted((r for r in found if r["rank"] == 1), key=lambda r: r.score)
    assert [r.vec_id for r in best] == [7, 7]
    assert any(r.vec_id == 0 and r.score > 0.999 for r in found)


def test_more_ties_than_are_kept_go_to_the_smaller_ids(spark):
    """Different vectors of one cosine, many more than fit: by sign patterns around an axis."""
    rows = [(100 + i, [3.0, *(1.0 if i >> b & 1 else -1.0 for b in range(6))]) for i in range(64)]
    rows = [(i, v) for i, v in rows[::-1] if i % 50] + [(50, [1.0] + [0.0] * 6)]
    found = neighbours.search(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).collect()
    of = sorted((r["rank"], r.vec_id) for r in found if r.query_id == 50)
    assert [i for _, i in of] == [101, 102, 103, 104, 105]


def test_scores_are_double_on_the_vectors_as_given(spark):
    draw = np.random.default_rng(2)
    x = draw.standard_normal((40, 9))
    table = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    for r in neighbours.search(table).collect():
        q, v = x[r.query_id], x[r.vec_id]
        assert abs(r.score - q @ v / (np.linalg.norm(q) * np.linalg.norm(v))) < 1e-15


def test_few_candidates_give_all_and_empty_tables_none(spark):
    schema = "vec_id long, embedding array<float>"
    table = spark.createDataFrame([(0, [1.0, 0.0]), (1, [-1.0, 0.1]), (2, [0.0, 1.0])], schema)
    assert [r.vec_id for r in sorted(neighbours.search(table).collect(), key=lambda r: r["rank"])] == [2, 1]
    assert neighbours.search(spark.createDataFrame([], schema)).count() == 0


def test_a_vector_that_many_rows_share(spark):
    rows = [(i, [1.0, 2.0]) for i in range(3000)] + [(5000, [2.0, 1.0])]
    found = neighbours.search(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).collect()
    of = {}
    for r in found:
        of.setdefault(r.query_id, {})[r["rank"]] = r.vec_id
    assert of[0] == {1: 1, 2: 2, 3: 3, 4: 4, 5: 5} and of[5000] == {1: 0, 2: 1, 3: 2, 4: 3, 5: 4}
    assert of[50] == {1: 0, 2: 1, 3: 2, 4: 3, 5: 4} and len(of) == 61


def test_probes_come_in_falling_likelihood():
    order = neighbours.probe_order(8, 100)
    assert order[0] == () and len(set(order)) == 100
    assert all(15 - a not in probe for probe in order for a in probe)
