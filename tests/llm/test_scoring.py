import math
import zlib
from collections import Counter

import numpy as np
import pytest

from parcelspark.llm import recurrent_lm, scoring
from tests.llm.data import documents, lower, plain, word_list

SF_DIR = "/root/testdata/sf0.01"


def held_out(doc_id):
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % 7 == 2


def check(docs):
    rows = docs.select("doc_id", "text").collect()
    tokens = [[*word_list(lower(r.text)), "\n"] for r in rows]
    counts = Counter()
    for r, words in zip(rows, tokens):
        if not held_out(r.doc_id):
            counts.update(words)
    total, kinds = sum(counts.values()), len(counts)
    expected = sorted(
        (str(r.doc_id), len(w), sum(counts[x] > 0 for x in w), round(sum(math.log10((counts[x] + 1) / (total + kinds + 1)) for x in w), 3))
        for r, w in zip(rows, tokens)
    )
    found = scoring.score(docs).collect()
    assert sorted((str(r.doc_id), r.n_tokens, r.n_known, round(r.base_score, 3)) for r in found) == [
        (*e[:3], pytest.approx(e[3], rel=1e-6, abs=2e-3)) for e in expected
    ]
    assert all(r.held_out == held_out(r.doc_id) and r.train_tokens == total and r.score <= 0 for r in found)
    return found


def test_awkward_documents_equal_brute_force(spark):
    check(documents(spark))


def test_words_that_tasks_do_not_hold_come_by_the_join(spark, monkeypatch):
    monkeypatch.setattr(scoring, "KNOWN_TO_ALL", 40)
    check(documents(spark))


def test_no_word_is_common_enough(spark, monkeypatch):
    monkeypatch.setattr(scoring, "KNOWN_TO_ALL", 0)
    check(documents(spark))


def test_the_model_beats_the_counts_on_held_out_documents(spark):
    rows = [r for r in check(plain(spark, SF_DIR)) if r.held_out]
    assert np.mean([r.score > r.base_score for r in rows]) > 0.9
    assert sum(r.score for r in rows) > sum(r.base_score for r in rows)


def test_empty_tables(spark):
    assert scoring.score(documents(spark, [])).count() == 0
    alone = spark.createDataFrame([(i, "a b") for i in range(60) if held_out(i)], "doc_id long, text string")
    assert {(r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in scoring.score(alone).collect()} == {(3, 0, 0, 0.0)}


def test_probabilities_sum_to_one():
    model = recurrent_lm.Model(50)
    texts = [np.array([3, 7, i]) for i in range(50)]
    start = model.score([np.array([3, 7])])[0]
    assert np.sum(10 ** (model.score(texts) - start)) == pytest.approx(1, abs=1e-4)


def test_the_state_is_carried_over_windows():
    model = recurrent_lm.Model(30, seed=4)
    draw = np.random.default_rng(2)
    text = draw.integers(0, 30, recurrent_lm.WINDOW * 3 + 5)
    steps = [model.score([text[:n]])[0] for n in range(1, len(text) + 1, 17)]
    assert all(a > b for a, b in zip(steps, steps[1:]))
    # beside other texts a text scores as alone
    assert model.score([text[:40], text, text[:0]])[1] == pytest.approx(model.score([text])[0], abs=1e-3)
    # what stands before a window's border changes what comes after it
    other = text.copy()
    other[recurrent_lm.WINDOW - 1] = (other[recurrent_lm.WINDOW - 1] + 1) % 30
    tail = lambda t: model.score([t])[0] - model.score([t[: recurrent_lm.WINDOW]])[0]
    assert tail(other) != pytest.approx(tail(text), abs=1e-7)


def test_a_score_equals_a_loop_over_one_state():
    """Token by token: gates, class and member softmax, state carried on; as the model is described."""
    model = recurrent_lm.Model(40, seed=3)
    p, size, h = {k: v.astype(float) for k, v in model.p.items()}, model.members, recurrent_lm.HIDDEN
    sigmoid = lambda x: 1 / (1 + np.exp(-x))
    draw = np.random.default_rng(5)
    for n in (1, 2, 63, 64, 65, 200):
        text, state, total = draw.integers(0, 40, n), np.zeros(h), 0.0
        for i in text:
            classes, members = state @ p["cw"] + p["cb"], state @ p["mw"][i // size] + p["mb"][i // size]
            total += classes[i // size] - np.log(np.exp(classes).sum()) + members[i % size] - np.log(np.exp(members).sum())
            x, past = p["e"][i] @ p["w"] + p["b"], state @ p["u"]
            z, r = sigmoid(x[:h] + past[:h]), sigmoid(x[h : 2 * h] + past[h : 2 * h])
            state = state + z * (np.tanh(x[2 * h :] + r * past[2 * h :]) - state)
        assert model.score([text])[0] == pytest.approx(total / np.log(10), rel=1e-4)


def test_large_weights_do_not_overflow():
    model = recurrent_lm.Model(20)
    text = np.arange(20)
    model.p["cb"][:] = 50 * np.arange(len(model.p["cb"]))
    model.p["mb"][:-1] += 90 * np.arange(model.members)
    assert np.isfinite(model.score([text])).all()
    model.train([text] * 5)
    assert np.isfinite(model.score([text])).all()


def test_no_token_is_left_out_of_training():
    """Every token of every text is a target and, but for the last, an input of some window, and filling is none."""
    for n in (1, 2, 31, 33, 1000, 20_001):
        model = recurrent_lm.Model(30)
        draw = np.random.default_rng(n)
        texts = [draw.integers(0, 30, n), np.array([], int), np.array([3, 4])]
        seen = np.zeros(30, int)
        window = model._window

        def watched(ids, fresh, h, squares, rate, weight):
            np.add.at(seen, ids[weight > 0], 1)
            return window(ids, fresh, h, squares, rate, weight)

        model._window = watched
        assert model.train(texts) == n + 2
        assert (seen == np.bincount(np.concatenate(texts).astype(int), minlength=30)).all()
    model = recurrent_lm.Model(30)
    before = model.pack()
    still = np.zeros((1, recurrent_lm.HIDDEN), np.float32)
    model._window(np.arange(20)[None, :], np.eye(1, 20, dtype=bool), still, model.memory(), 0.1, np.zeros((1, 20), np.float32))
    assert model.pack() == before


def test_all_training_documents_are_trained_on_at_every_size(spark, monkeypatch):
    docs = plain(spark, SF_DIR)
    rows = [len(lower(r.text).split()) + 1 for r in docs.collect() if not held_out(r.doc_id)]
    for start in (1000, 10_000_000):
        monkeypatch.setattr(scoring, "START_TOKENS", start)
        seen = []
        known = scoring.vocabulary(scoring.word_counts(docs).cache())
        taken, scoring.checkpoint = scoring.checkpoint, lambda df: (seen.append(out := taken(df)), out)[1]
        try:
            scoring.train(scoring._encoded(docs, spark.sparkContext.broadcast(known)).cache(), known)
        finally:
            scoring.checkpoint = taken
        assert seen[1].agg({"weight": "sum"}).first()[0] == pytest.approx(known.tokens)
        assert known.tokens == pytest.approx(sum(rows), rel=0.01)


def test_the_vocabulary_grows_with_the_corpus():
    assert scoring.own_ids(10**6) < scoring.own_ids(10**8) < scoring.own_ids(10**10) < 20_000


def test_training_learns_what_follows_what():
    text = np.array([0, 1, 2, 3, 4] * 400)
    model = recurrent_lm.Model(30)
    before = model.score([text[:50]])[0]
    model.train([text] * 8, epochs=3)
    assert model.score([text[:50]])[0] > before / 3


def test_an_update_follows_the_slope_of_the_loss():
    size, texts = 30, [np.array([3, 4, 3, 29, 7, 7, 0, 3] * 3), np.array([1, 2, 3, 28, 4, 4, 9, 11] * 3)]
    loss = lambda m: -m.score(texts).sum() * math.log(10) / len(texts)
    before, after = recurrent_lm.Model(size, seed=6), recurrent_lm.Model(size, seed=6)
    ones = {k: np.ones_like(q) for k, q in after.p.items()}
    still, fresh = np.zeros((2, recurrent_lm.HIDDEN), np.float32), np.eye(1, 24, dtype=bool).repeat(2, 0)
    after._window(np.array(texts), fresh, still, ones, 1.0, np.ones((2, 24), np.float32))
    draw = np.random.default_rng(1)
    for k, q in before.p.items():
        step = before.p[k] - after.p[k]  # g / sqrt(1 + g ** 2)
        slope = step / np.sqrt(1 - step**2)
        at = np.unravel_index([np.abs(slope).argmax(), *draw.integers(0, q.size, 3)], q.shape)
        for i in zip(*at):
            found = []
            for move in (0.01, -0.01):
                moved = recurrent_lm.Model(size, seed=6)
                moved.p[k][i] += np.float32(move)
                found.append(loss(moved))
            assert slope[i] == pytest.approx((found[0] - found[1]) / 0.02, rel=0.02, abs=2e-3)


def test_an_update_costs_by_ids_what_ids_have_in_common(monkeypatch):
    """Training needs no logarithms, and adds up what comes back to the ids without a place for every component."""
    model, called = recurrent_lm.Model(300), []
    for name in ("log", "bincount"):
        monkeypatch.setattr(np, name, lambda *a, f=getattr(np, name), name=name, **k: (called.append(name), f(*a, **k))[1])
    draw = np.random.default_rng(7)
    assert model.train([draw.integers(0, 300, 400) for _ in range(20)]) == 8000
    assert not called
