"""Toxicity by a bidirectional gated recurrent network with attention pooling, trained in numpy.

A word enters as the mean of learned vectors of all its character n-grams and of the word itself (both hashed); one
that is long, or made of several joined by marks, enters as several overlapping inputs. Two gated
recurrent layers read a window of words from both ends. Attention over what they and the inputs say weighs the words
of the window, and the weighted evidence is the window's score. All overlapping windows of a text are scored, and the
largest score is the text's.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from parcelspark.llm.common import LOWER, batches_of, checkpoint, remainder, remainder_column, text_batches, utf8
from parcelspark.llm.repeats import Buckets

#: Documents of each label that the network is trained on, at most: those whose ids hash lowest, as many as have
#: FIT_WINDOWS windows together. Each is used whole.
FIT_ROWS, FIT_WINDOWS = 1200, 40_000

#: Inputs of a window, and from the start of one to that of the next: half a window, so that a passage of up to half
#: a window lies in one whole wherever it stands.
WINDOW, STRIDE = 48, 24
HIDDEN, WIDTH = 8, 16
BUCKETS = 1 << 14
#: Bytes of a character n-gram, and of an input: a longer word is cut into inputs that overlap by half.
GRAMS, PIECE = (3, 4, 5), 12
EPOCHS = 10
#: How often a word's own vector is left out in training, so that its n-grams learn to speak for it.
LEFT_OUT = 0.3
THRESHOLD = 0.7

#: Words whose inputs a task keeps at most; then it starts again with none.
MEMO = 300_000


# Marks that join or end words: blanks for the network. Others, as in masked words, stay.
_JOINING = b"_-.,;:!?\"'`()[]{}/\\"
_APART = bytes.maketrans(_JOINING, b" " * len(_JOINING))
_WIDE_BLANK = re.compile(b"\xc2\xa0|\xe2\x80[\x80-\x8d\xa8\xa9\xaf]|\xe3\x80\x80|\xef\xbb\xbf")


def inputs_of(text: str | None) -> list[bytes]:
    """What the network reads of a text, in order: all of its words, lower-cased, parted at blanks and joining marks;
    words of more than PIECE bytes as pieces that overlap by half. `^` and `$` mark where a word begins and ends."""
    out = []
    for word in _WIDE_BLANK.sub(b" ", utf8(text).translate(LOWER)).translate(_APART).split():
        if len(word) <= PIECE:
            out.append(b"^" + word + b"$")
            continue
        word = b"^" + word + b"$"
        half = PIECE // 2
        out += [word[i : i + PIECE] for i in range(0, max(1, len(word) - half), half)]
    return out


class Hashed(NamedTuple):
    """Hashed inputs of words: the ids of all words in a row, and where each word's begin; its own comes first."""

    ids: np.ndarray
    starts: np.ndarray

    def counts(self) -> np.ndarray:
        return np.diff(self.starts, append=len(self.ids))

    def take(self, rows: np.ndarray) -> Hashed:
        n = self.counts()[rows]
        starts = np.cumsum(n) - n
        return Hashed(self.ids[np.repeat(self.starts[rows] - starts, n) + np.arange(int(n.sum()))], starts)

    def without(self, left_out: np.ndarray) -> Hashed:
        """The same without the own vector of some words, where they have n-grams."""
        n = self.counts()
        gone = left_out & (n > 1)
        keep = np.ones(len(self.ids), bool)
        keep[self.starts[gone]] = False
        n = n - gone
        return Hashed(self.ids[keep], np.cumsum(n) - n)


def features(words: list[bytes]) -> Hashed:
    """The word itself, and every n-gram of 3 to 5 bytes in it."""
    lengths = np.array([len(w) for w in words], np.int64)
    starts = np.cumsum(lengths) - lengths
    buckets = Buckets(np.frombuffer(b"".join(words), np.uint8))
    own = buckets.at(starts, starts + lengths)
    per = [np.maximum(lengths - g + 1, 0) for g in GRAMS]
    n = 1 + sum(per)
    begin = np.cumsum(n) - n
    out = np.zeros(int(n.sum()), np.uint64)
    out[begin] = own
    filled = begin + 1
    for g, many in zip(GRAMS, per):
        inside = np.arange(int(many.sum())) - np.repeat(np.cumsum(many) - many, many)
        first = np.repeat(starts, many) + inside
        out[np.repeat(filled, many) + inside] = buckets.at(first, first + g)
        filled = filled + many
    return Hashed((out % np.uint64(BUCKETS)).astype(np.int32), begin)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-x))


def _tanh(x: np.ndarray) -> np.ndarray:
    return 2 / (1 + np.exp(-2 * x)) - 1


class Network:
    """Parameters, and scores of windows."""

    def __init__(self, seed: int = 1):
        draw = np.random.default_rng(seed)
        normal = lambda *shape, scale: (draw.standard_normal(shape) * scale).astype(np.float32)
        self.p = {
            "table": normal(BUCKETS, WIDTH, scale=0.3),
            "win": normal(2, WIDTH, 3 * HIDDEN, scale=WIDTH**-0.5),
            "bin": np.zeros((2, 1, 3 * HIDDEN), np.float32),
            "u": normal(2, HIDDEN, 3 * HIDDEN, scale=HIDDEN**-0.5),
            "ah": normal(2, HIDDEN, scale=0.3), "ax": normal(WIDTH, scale=0.3),
            "vh": normal(2, HIDDEN, scale=0.3), "vx": normal(WIDTH, scale=0.3),
            "b": np.full(1, -1, np.float32),
        }

    def inputs(self, words: Hashed) -> np.ndarray:
        """Input vectors of words from their hashed inputs."""
        if not len(words.starts):
            return np.zeros((0, WIDTH), np.float32)
        sums = np.add.reduceat(self.p["table"][words.ids], words.starts, axis=0)
        return sums / words.counts()[:, None].astype(np.float32)

    def project(self, x: np.ndarray) -> np.ndarray:
        """What the window pass needs of each word: gates of both directions, attention, evidence."""
        gates = np.matmul(x, self.p["win"]) + self.p["bin"]
        return np.concatenate([gates[0], gates[1], (x @ self.p["ax"])[:, None], (x @ self.p["vx"])[:, None]], 1)

    def projected(self, words: Hashed) -> np.ndarray:
        """What the window pass needs of words, a few thousand at a time: their n-grams take more room than they do."""
        n = len(words.starts)
        parts = [self.project(self.inputs(words.take(np.arange(i, min(i + 8192, n))))) for i in range(0, n, 8192)]
        return np.concatenate([np.zeros((0, 6 * HIDDEN + 2), np.float32), *parts])

    def forward(self, words: np.ndarray, at: np.ndarray, mask: np.ndarray, keep: bool = False):
        """Logit of each window. words: projected words; at (windows x WINDOW): their rows; mask: where a word is."""
        n, steps, h3 = len(at), at.shape[1], 3 * HIDDEN
        h = np.zeros((2, n, HIDDEN), np.float32)
        states = np.empty((steps, 2, n, HIDDEN), np.float32)  # by step of each direction
        kept = []
        full = mask.all()
        for t in range(steps):
            left, right = at[:, t], at[:, steps - 1 - t]
            x = np.stack([words[left, :h3], words[right, h3 : 2 * h3]])
            uh = np.matmul(h, self.p["u"])
            gate = _sigmoid(x[:, :, : 2 * HIDDEN] + uh[:, :, : 2 * HIDDEN])
            z, r = gate[:, :, :HIDDEN], gate[:, :, HIDDEN:]
            c = _tanh(x[:, :, 2 * HIDDEN :] + r * uh[:, :, 2 * HIDDEN :])
            new = h + z * (c - h)
            if not full:
                new = np.where(np.stack([mask[:, t], mask[:, steps - 1 - t]])[:, :, None], new, h)
            if keep:
                kept.append((h, z, r, c, uh[:, :, 2 * HIDDEN :]))
            h = new
            states[t] = h
        a = np.einsum("tnh,h->nt", states[:, 0], self.p["ah"][0]) + np.einsum("tnh,h->nt", states[::-1, 1], self.p["ah"][1])
        v = np.einsum("tnh,h->nt", states[:, 0], self.p["vh"][0]) + np.einsum("tnh,h->nt", states[::-1, 1], self.p["vh"][1])
        a = np.where(mask, a + words[at, 2 * h3], -1e9)
        v = v + words[at, 2 * h3 + 1]
        weight = np.exp(a - a.max(1, keepdims=True))
        weight /= weight.sum(1, keepdims=True)
        logit = (weight * v).sum(1) + self.p["b"]
        return (logit, states, kept, weight, v) if keep else logit

    def gradients(self, x: np.ndarray, at: np.ndarray, mask: np.ndarray, y: np.ndarray):
        """(loss, gradients of the parameters but the table, gradient of x) for words x and labelled windows."""
        p, h3 = self.p, 3 * HIDDEN
        n, steps = at.shape
        words = self.project(x)
        logit, states, kept, weight, v = self.forward(words, at, mask, keep=True)
        d_logit = ((_sigmoid(logit) - y) / n)[:, None]
        d_v = d_logit * weight
        d_a = d_logit * weight * (v - (weight * v).sum(1, keepdims=True))
        grad = {k: np.zeros_like(q) for k, q in p.items() if k != "table"}
        grad["b"][:] = d_logit.sum()
        flat = at.ravel()
        d_words = np.zeros_like(words)
        np.add.at(d_words[:, 2 * h3], flat, d_a.ravel())
        np.add.at(d_words[:, 2 * h3 + 1], flat, d_v.ravel())
        both = (states[:, 0], states[::-1, 1])
        for i in range(2):
            grad["ah"][i] = np.einsum("nt,tnh->h", d_a, both[i])
            grad["vh"][i] = np.einsum("nt,tnh->h", d_v, both[i])
        d_h = np.zeros((2, n, HIDDEN), np.float32)
        for t in range(steps - 1, -1, -1):
            h, z, r, c, uc = kept[t]
            back = steps - 1 - t
            for i, place in enumerate((t, back)):
                d_h[i] += d_a[:, place, None] * p["ah"][i] + d_v[:, place, None] * p["vh"][i]
            on = np.stack([mask[:, t], mask[:, back]])[:, :, None]
            d_new = d_h * on
            d_c = d_new * z * (1 - c * c)
            d_z = d_new * (c - h) * z * (1 - z)
            d_r = d_c * uc * r * (1 - r)
            d_x = np.concatenate([d_z, d_r, d_c], 2)
            d_u = np.concatenate([d_z, d_r, d_c * r], 2)
            grad["u"] += np.matmul(h.transpose(0, 2, 1), d_u)
            d_h = d_h - d_new * z + np.matmul(d_u, p["u"].transpose(0, 2, 1))
            np.add.at(d_words[:, :h3], at[:, t], d_x[0])
            np.add.at(d_words[:, h3 : 2 * h3], at[:, back], d_x[1])
        g = np.stack([d_words[:, :h3], d_words[:, h3 : 2 * h3]])
        grad["win"] = np.matmul(x.T, g)
        grad["bin"] = g.sum(1, keepdims=True)
        grad["ax"], grad["vx"] = x.T @ d_words[:, 2 * h3], x.T @ d_words[:, 2 * h3 + 1]
        d_in = np.matmul(g, p["win"].transpose(0, 2, 1)).sum(0)
        d_in += np.outer(d_words[:, 2 * h3], p["ax"]) + np.outer(d_words[:, 2 * h3 + 1], p["vx"])
        loss = float(np.mean(np.logaddexp(0, logit) - y * logit))
        return loss, grad, d_in.astype(np.float32)


def windows(n: int) -> np.ndarray:
    """First words of the windows of a text of n words: every STRIDE words, the last reaching the end."""
    return np.arange(0, max(1, n - WINDOW + STRIDE), STRIDE)


class Vocabulary:
    """Rows for words as they come, with their hashed inputs."""

    def __init__(self):
        self.rows: dict[bytes, int] = {}
        self.new: list[bytes] = []

    def row(self, word: bytes) -> int:
        at = self.rows.get(word)
        if at is None:
            at = self.rows[word] = len(self.rows)
            self.new.append(word)
        return at

    def take_new(self) -> Hashed:
        """Hashed inputs of the words added since the last call."""
        new, self.new = self.new, []
        parts = [features(new[i : i + 8192]) for i in range(0, len(new), 8192)]
        before = np.cumsum([0, *(len(p.ids) for p in parts)])
        none = np.zeros(0, np.int64)
        return Hashed(
            np.concatenate([none.astype(np.int32), *(p.ids for p in parts)]),
            np.concatenate([none, *(p.starts + n for p, n in zip(parts, before))]),
        )


def train_network(texts: list[list[bytes]], labels: np.ndarray, epochs: int = EPOCHS, seed: int = 1) -> Network:
    """Train on texts, each a list of inputs. In each round a text is represented by the window, of all it has, that
    the network finds most toxic (in the first by a random one); the gradient runs back through the whole window."""
    net = Network(seed)
    if not len(labels) or labels.min() == labels.max():
        return net
    draw = np.random.default_rng(seed)
    vocabulary = Vocabulary()
    at, mask, owner = [], [], []
    for i, text in enumerate(texts):
        rows = np.array([vocabulary.row(w) for w in text] + [0] * WINDOW, np.int32)
        for begin in windows(len(text)).tolist():
            at.append(rows[begin : begin + WINDOW])
            mask.append(np.arange(begin, begin + WINDOW) < len(text))
            owner.append(i)
    at, mask, owner = np.array(at), np.array(mask), np.array(owner)
    vocabulary.row(b"^$")  # so that there is a row where no text has a word
    ids = vocabulary.take_new()
    squares = {k: np.full_like(q, 1e-6) for k, q in net.p.items()}
    for epoch in range(epochs):
        words = net.projected(ids)
        logit = draw.standard_normal(len(at)) if epoch == 0 else np.concatenate(
            [net.forward(words, at[i : i + 2048], mask[i : i + 2048]) for i in range(0, len(at), 2048)]
        )
        order = np.lexsort((logit, owner))
        last = np.flatnonzero(np.concatenate([owner[order][1:] != owner[order][:-1], [True]]))
        chosen = draw.permutation(order[last])
        for i in range(0, len(chosen), 32):
            some = chosen[i : i + 32]
            rows, place = np.unique(at[some], return_inverse=True)
            hashed = ids.take(rows)
            hashed = hashed.without(draw.random(len(rows)) < LEFT_OUT)
            x = net.inputs(hashed)
            _, grad, d_in = net.gradients(x, place.reshape(-1, WINDOW), mask[some], labels[owner[some]].astype(np.float32))
            many = hashed.counts()
            spread = np.repeat(d_in / many[:, None].astype(np.float32), many, axis=0)
            touched, slot = np.unique(hashed.ids, return_inverse=True)
            sums = np.zeros((len(touched), WIDTH), np.float32)
            np.add.at(sums, slot, spread)
            squares["table"][touched] += sums**2
            net.p["table"][touched] -= 0.1 * sums / np.sqrt(squares["table"][touched])
            for k, g in grad.items():
                squares[k] += g**2
                net.p[k] -= 0.05 * g / np.sqrt(squares[k])
    return net


def train(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS, most_windows: int = FIT_WINDOWS) -> Network:
    """A network for labels.toxic, from at most `rows` documents of each label with crc32(doc_id) mod 3 other than 1,
    and as many of them as have `most_windows` windows together (the first whatever it has). They are read whole.

    Label rows without an id or with another label than 0 and 1 are left out; an id labelled both ways counts as 1. Of
    documents that repeat an id one is taken. Without both labels the network is untrained.
    """
    known = (
        labels.where("doc_id is not null and toxic in (0, 1)").where(remainder_column(F.col("doc_id"), 3) != 1)
        .groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("toxic").cast("int").alias("y"))
    )
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    sample = known.where("y = 1").orderBy(*order).limit(rows).union(known.where("y = 0").orderBy(*order).limit(rows))

    def sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = [len(windows(len(inputs_of(t.as_py())))) for t in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(n, pa.int64())], ["doc_id", "y", "n"])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [b" ".join(inputs_of(t.as_py())) for t in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.binary())], ["doc_id", "y", "words"])

    # 2 x rows ids at most, so the tables joined are small whatever the input
    texts = docs.select(F.col("doc_id").cast("long"), "text")
    with batches_of(docs.sparkSession, 500):
        joined = texts.join(F.broadcast(sample), "doc_id").select("doc_id", "y", "text")
        sized = checkpoint(
            joined.mapInArrow(sizes, "doc_id long, y int, n long").groupBy("doc_id").agg(F.min("y").alias("y"), F.max("n").alias("n"))
        )
        so_far = F.sum("n").over(Window.partitionBy("y").orderBy(*order))
        chosen = sized.withColumn("_all", so_far).where((F.col("_all") <= most_windows) | (F.col("_all") == F.col("n")))
        joined = texts.join(F.broadcast(chosen.select("doc_id", "y")), "doc_id").select("doc_id", "y", "text")
        found = (
            joined.mapInArrow(read, "doc_id long, y int, words binary")
            .groupBy("doc_id").agg(F.min("y").alias("y"), F.min("words").alias("words"))
            .toPandas().sort_values("doc_id")
        )
    return train_network([bytes(w).split() for w in found["words"]], found["y"].to_numpy())


class Scorer:
    """Scores texts with a network; keeps the inputs of words it has seen."""

    def __init__(self, net: Network):
        self.net = net
        self._forget()

    def _forget(self) -> None:
        self.vocabulary = Vocabulary()
        self.words = np.zeros((0, 6 * HIDDEN + 2), np.float32)

    def _project(self) -> None:
        """Projected inputs for the words that are new."""
        self.words = np.concatenate([self.words, self.net.projected(self.vocabulary.take_new())])

    def scores(self, texts: list[list[bytes]]) -> np.ndarray:
        """Score of each text: that of its most toxic window; texts without words get what an empty window gets."""
        out = np.zeros(len(texts))
        begins, rows, owner, total = [], [], [], 0
        for i, words in enumerate(texts):
            row = self.vocabulary.row
            rows.append(np.fromiter(map(row, words), np.int64, len(words)))
            begins.append(windows(len(words)))
            owner.append(np.full(len(begins[-1]), i))
            total += len(words)
            if total > 400_000 or i + 1 == len(texts):
                self._flush(out, rows, begins, np.concatenate(owner))
                begins, rows, owner, total = [], [], [], 0
                if len(self.vocabulary.rows) > MEMO:
                    self._forget()
        return out

    def _flush(self, out: np.ndarray, rows: list[np.ndarray], begins: list[np.ndarray], owner: np.ndarray) -> None:
        self._project()
        words = self.words if len(self.words) else np.zeros((1, 6 * HIDDEN + 2), np.float32)
        lengths = np.array([len(r) for r in rows])
        start = np.cumsum(lengths) - lengths
        many = [len(b) for b in begins]
        first = np.concatenate(begins) + np.repeat(start, many)
        left = np.minimum(np.repeat(start + lengths, many) - first, WINDOW)
        flat = np.concatenate([*rows, np.zeros(WINDOW, np.int64)])
        order = np.argsort(-left, kind="stable")  # full windows need no mask
        for i in range(0, len(order), 1024):
            some = order[i : i + 1024]
            place = first[some, None] + np.arange(WINDOW)
            mask = np.arange(WINDOW) < left[some, None]
            logit = self.net.forward(words, np.where(mask, flat[np.minimum(place, len(flat) - 1)], 0), mask)
            np.maximum.at(out, owner[some], _sigmoid(logit.astype(np.float64)))


def score(docs: DataFrame, net: Network, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, held_out, score, predicted) for each row of docs (doc_id, text).

    held_out: crc32 of the id as text has remainder 1 by 3. Null and empty texts are scored as an empty window. Rows
    and repeats stay, other columns are ignored, an empty table gives an empty table. The network has a fixed size.
    """
    shared = docs.sparkSession.sparkContext.broadcast(net)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shared.value)
        for batch in batches:
            ids = batch.column(0).to_pylist()
            found = np.zeros(len(ids))
            for i in range(0, len(ids), 1000):
                found[i : i + 1000] = scorer.scores([inputs_of(t.as_py()) for t in batch.column(1)[i : i + 1000]])
            held_out = pa.array([remainder(d, 3) == 1 for d in ids], pa.bool_())
            predicted = pa.array((found >= threshold).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), held_out, pa.array(found), predicted], ["doc_id", "held_out", "score", "predicted"]
            )

    schema = "doc_id long, held_out boolean, score double, predicted int"
    return text_batches(docs).select(F.col("doc_id").cast("long"), "text").mapInArrow(run, schema)
