import zlib

import numpy as np
import pytest

from parcelspark.llm import toxicity
from tests.llm.data import LONG, documents, plain

SF_DIR = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def net(spark):
    return toxicity.train(plain(spark, SF_DIR), plain(spark, SF_DIR, "labels"))


def held_out(doc_id):
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % 3 == 1


def test_held_out_documents_are_ranked_right(spark, net):
    labels = {r.doc_id: r.toxic for r in plain(spark, SF_DIR, "labels").collect()}
    rows = [r for r in toxicity.score(plain(spark, SF_DIR), net).collect() if r.held_out and labels.get(r.doc_id) is not None]
    assert all(held_out(r.doc_id) for r in rows)
    score, y = np.array([r.score for r in rows]), np.array([labels[r.doc_id] for r in rows])
    ranks = score.argsort().argsort() + 1
    auc = (ranks[y == 1].sum() - (y == 1).sum() * ((y == 1).sum() + 1) / 2) / ((y == 1).sum() * (y == 0).sum())
    assert auc > 0.9
    assert ((score >= 0.7) == (y == 1)).mean() > max(y.mean(), 1 - y.mean())


def test_held_out_labels_do_not_matter(spark, net):
    labels = plain(spark, SF_DIR, "labels")
    flipped = labels.selectExpr(
        "doc_id", "case when crc32(cast(cast(doc_id as string) as binary)) % 3 = 1 then 1 - toxic else toxic end as toxic"
    )
    other = toxicity.train(plain(spark, SF_DIR), flipped)
    docs = plain(spark, "/root/testdata/sf0.001")
    a = {r.doc_id: r.score for r in toxicity.score(docs, net).collect()}
    assert a == pytest.approx({r.doc_id: r.score for r in toxicity.score(docs, other).collect()}, abs=1e-9)


def test_awkward_documents(spark, net):
    docs = documents(spark)
    found = toxicity.score(docs, net).collect()
    assert sorted(str(r.doc_id) for r in found) == sorted(str(r.doc_id) for r in docs.collect())
    for r in found:
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) and r.held_out == held_out(r.doc_id)


def test_a_score_is_that_of_the_worst_window_wherever_it_is(spark, net):
    rows = plain(spark, SF_DIR).join(plain(spark, SF_DIR, "labels").where("toxic = 1"), "doc_id").select("doc_id", "text")
    worst = max(toxicity.score(rows, net).collect(), key=lambda r: r.score)
    bad = rows.where(f"doc_id = {worst.doc_id}").first().text
    calm = " ".join(LONG.split()[:5000])
    # a whole window apart on both sides, so that some window holds the start of the passage whatever the stride
    docs = spark.createDataFrame([(0, calm), (1, f"{calm} {bad} {calm}"), (2, bad)], "doc_id long, text string")
    score = {r.doc_id: r.score for r in toxicity.score(docs, net).collect()}
    assert score[1] >= score[0] and score[1] > 0.5


def test_windows_cover_every_word():
    for n in list(range(200)) + [10_000]:
        starts = toxicity.windows(n)
        covered = np.zeros(max(n, 1), bool)
        for s in starts:
            covered[s : s + toxicity.WINDOW] = True
        assert covered[:n].all()


def test_empty_tables(spark):
    none, labels = documents(spark, []), spark.createDataFrame([], "doc_id long, toxic int")
    net = toxicity.train(none, labels)
    assert toxicity.score(none, net).count() == 0
    assert all(0 <= r.score <= 1 for r in toxicity.score(documents(spark), net).collect())


def test_toxic_words_are_found_when_joined_or_behind_a_stem(spark, net):
    """Nothing of a word is left out: joined by `_` or by no-break spaces, texts stay found, and many behind a stem."""
    rows = plain(spark, SF_DIR).join(plain(spark, SF_DIR, "labels").where("toxic = 1"), "doc_id").select("doc_id", "text").collect()
    scorer = toxicity.Scorer(net)
    rows = [r.text for r in rows if held_out(r.doc_id)]
    of = lambda texts: scorer.scores([toxicity.inputs_of(t) for t in texts]) >= 0.7
    found = [t for t, f in zip(rows, of(rows)) if f]
    assert len(found) > 0.8 * len(rows)
    for form, share in (("_".join, 0.95), (" ".join, 0.95), (lambda w: " ".join("superdup" + x for x in w), 0.4)):
        assert of([form(t.split()) for t in found]).mean() > share


def test_inputs_hold_every_byte_of_a_word():
    for word in (b"a", b"abcdefghijkl", b"abcdefghijklm", bytes(range(97, 123)) * 5):
        inputs = toxicity.inputs_of(word.decode())
        whole = b"^" + word + b"$"
        assert all(any(whole[i : i + 5] in x for x in inputs) for i in range(max(1, len(whole) - 4)))
    assert toxicity.inputs_of("One_two THREE f**k") == [b"^one$", b"^two$", b"^three$", b"^f**k$"]
    assert toxicity.inputs_of(None) == toxicity.inputs_of(" _ ") == []
    one, two = (toxicity.features([b"^" + b"x" * 50 + end + b"$"]) for end in (b"yes", b"not"))
    assert set(one.ids) != set(two.ids)
    hashed = toxicity.features([b"^ab$", b"^$", b"^abcdef$"])
    assert hashed.counts().tolist() == [1 + 2 + 1 + 0, 1, 1 + 6 + 5 + 4]


def test_scores_equal_a_plain_loop_over_windows(spark, net):
    """One window at a time, one step at a time, as the network is described."""
    p = {k: v.astype(float) for k, v in net.p.items()}
    sigmoid = lambda x: 1 / (1 + np.exp(-x))

    def window_score(words):
        if not words:
            words = []
        x = [p["table"][toxicity.features([w]).ids].mean(0) for w in words]
        h = toxicity.HIDDEN

        def run(direction, xs):
            state, out = np.zeros(h), []
            for v in xs:
                gates = v @ p["win"][direction] + p["bin"][direction][0]
                past = state @ p["u"][direction]
                z, r = sigmoid(gates[:h] + past[:h]), sigmoid(gates[h : 2 * h] + past[h : 2 * h])
                state = state + z * (np.tanh(gates[2 * h :] + r * past[2 * h :]) - state)
                out.append(state)
            return out

        forth, back = run(0, x), run(1, x[::-1])[::-1]
        a = np.array([f @ p["ah"][0] + b @ p["ah"][1] + v @ p["ax"] for f, b, v in zip(forth, back, x)])
        e = np.array([f @ p["vh"][0] + b @ p["vh"][1] + v @ p["vx"] for f, b, v in zip(forth, back, x)])
        weight = np.exp(a - a.max())
        return sigmoid((weight / weight.sum() * e).sum() + p["b"][0])

    texts = [r.text for r in plain(spark, SF_DIR).orderBy("doc_id").limit(12).collect()] + ["one", "a b c_d"]
    texts = [toxicity.inputs_of(t)[:400] for t in texts]
    found = toxicity.Scorer(net).scores(texts)
    for words, score in zip(texts, found):
        begins = range(0, max(1, len(words) - toxicity.WINDOW + toxicity.STRIDE), toxicity.STRIDE)
        assert score == pytest.approx(max(window_score(words[b : b + toxicity.WINDOW]) for b in begins), abs=2e-4)


def test_a_bound_on_windows_leaves_out_documents_and_cuts_none(spark, monkeypatch):
    texts = [(i, " ".join(f"w{i}x{j}" for j in range(200 + i))) for i in range(40) if not held_out(i)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, toxic int")
    seen = {}
    monkeypatch.setattr(toxicity, "train_network", lambda read, y: seen.update(texts=read, y=y))
    toxicity.train(docs, labels, most_windows=60)
    whole = [toxicity.inputs_of(t) for _, t in texts]
    assert 2 <= len(seen["texts"]) < len(whole) and all(t in whole for t in seen["texts"])
    assert sum(len(toxicity.windows(len(t))) for t in seen["texts"]) <= 120
