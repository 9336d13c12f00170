"""A gated recurrent language model in numpy, with class-factored output and state carried over windows.

Words are ids: the most frequent ones have their own, all others one of a few ids by their last two bytes. The model
gives the probability of an id from the state before it: that of the id's class times that of the id in its class, so
a token costs two short softmaxes. Which of the words behind a shared id it is comes from counts.
"""

from __future__ import annotations

import numpy as np

WIDTH = HIDDEN = 16

#: Steps over which the gradient runs back; streams that are trained side by side at most, and updates that a call
#: makes at least, with fewer streams if need be.
STEPS, STREAMS, UPDATES = 32, 512, 200

#: Steps of a window in scoring; the state goes on to the next window.
WINDOW = 64

#: Rows of logits that are computed at once.
ROWS = 1 << 11


def _sigmoid(x: np.ndarray) -> np.ndarray:
    """In place."""
    np.negative(x, x)
    np.exp(x, x)
    x += 1
    return np.reciprocal(x, x)


def _logits(h: np.ndarray, w: np.ndarray, b: np.ndarray) -> np.ndarray:
    """h @ w + b, less a number a row where exponentials could overflow. A state lies within -1 and 1, so that small
    weights cannot."""
    logits = h @ w
    logits += b
    if np.abs(w).sum(0).max(initial=0) + np.abs(b).max(initial=0) >= 80:
        logits -= logits.max(1)[:, None]
    return logits


def _log_shares(logits: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Logarithm of the softmax of each row at one place; the logits are used up."""
    found = logits[np.arange(len(at)), at]
    found -= np.log(np.exp(logits, logits) @ np.ones(logits.shape[1], np.float32))
    return found


def _gradient(logits: np.ndarray, at: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """In place: derivative of the weighted loss by the logits, with the right place of each row."""
    np.exp(logits, logits)
    logits *= (weight / (logits @ np.ones(logits.shape[1], np.float32)))[:, None]
    logits[np.arange(len(at)), at] -= weight
    return logits


class Model:
    """Parameters p; ids 0 .. size - 1."""

    def __init__(self, size: int, seed: int = 1):
        self.size = size
        self.members = max(1, int(np.ceil(size**0.5)))
        self.classes = -(-size // self.members)
        draw = np.random.default_rng(seed)
        normal = lambda *shape: (draw.standard_normal(shape) * shape[-2] ** -0.5).astype(np.float32)
        self.p = {
            "e": draw.standard_normal((size, WIDTH)).astype(np.float32) * np.float32(0.3),
            "w": normal(WIDTH, 3 * HIDDEN), "b": np.zeros(3 * HIDDEN, np.float32), "u": normal(HIDDEN, 3 * HIDDEN),
            "cw": normal(HIDDEN, self.classes), "cb": np.zeros(self.classes, np.float32),
            "mw": normal(self.classes, HIDDEN, self.members), "mb": np.zeros((self.classes, self.members), np.float32),
        }
        last = size - (self.classes - 1) * self.members
        self.p["mb"][-1, last:] = -30  # places without an id

    def pack(self) -> bytes:
        return b"".join(self.p[k].astype("<f4").tobytes() for k in sorted(self.p))

    def unpack(self, data: bytes) -> Model:
        flat, at = np.frombuffer(data, "<f4"), 0
        for k in sorted(self.p):
            n = self.p[k].size
            self.p[k] = flat[at : at + n].reshape(self.p[k].shape).copy()
            at += n
        return self

    def _step(self, x: np.ndarray, h: np.ndarray):
        uh = h @ self.p["u"]
        gate = _sigmoid(x[:, : 2 * HIDDEN] + uh[:, : 2 * HIDDEN])
        z, r = gate[:, :HIDDEN], gate[:, HIDDEN:]
        uc = uh[:, 2 * HIDDEN :]
        c = r * uc
        c += x[:, 2 * HIDDEN :]
        c = np.tanh(c, c)
        new = c - h
        new *= z
        new += h
        return new, z, r, c, uc

    def log_probabilities(self, h: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """Natural logarithm of the probability of each id from the state before it."""
        out = np.empty(len(ids))
        order, ids, of, ends = self._by_id(ids)
        h, member, sums = np.take(h, order, 0), ids - of * self.members, np.empty(len(ids))
        for at in range(0, len(ids), ROWS):
            some = slice(at, at + ROWS)
            sums[some] = _log_shares(_logits(h[some], self.p["cw"], self.p["cb"]), of[some])
        for c in np.flatnonzero(np.diff(ends)):
            for at in range(ends[c], ends[c + 1], ROWS):
                some = slice(at, min(at + ROWS, ends[c + 1]))
                sums[some] += _log_shares(_logits(h[some], self.p["mw"][c], self.p["mb"][c]), member[some])
        out[order] = sums
        return out

    def _by_id(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Order of places by id; ids and their classes in it; where each class begins in it."""
        order = np.argsort(ids.astype(np.int16 if self.size < 1 << 15 else np.int64), kind="stable")
        ids = ids[order]
        of = ids // self.members
        return order, ids, of, np.searchsorted(of, np.arange(self.classes + 1))

    def score(self, texts: list[np.ndarray]) -> np.ndarray:
        """log10 of the probability of each text's ids; the state starts at zero and runs through the whole text."""
        total = np.zeros(len(texts))
        lengths = np.array([len(t) for t in texts])
        order = np.argsort(-lengths, kind="stable")
        lengths = lengths[order]
        flat = np.concatenate([texts[i] for i in order]) if len(texts) else np.zeros(0, np.int64)
        start = np.cumsum(lengths) - lengths
        inputs = self.p["e"] @ self.p["w"] + self.p["b"]
        h = np.zeros((len(texts), HIDDEN), np.float32)
        for begin in range(0, int(lengths.max()) if len(lengths) else 0, WINDOW):
            states, ids, owner = [], [], []
            for t in range(begin, min(begin + WINDOW, int(lengths[0]))):
                n = int(np.searchsorted(-lengths, -t, "left"))  # texts longer than t
                now = flat[start[:n] + t]
                states.append(h[:n])
                ids.append(now)
                owner.append(n)
                h = self._step(np.take(inputs, now, 0), h[:n])[0]
            logs = self.log_probabilities(np.concatenate(states), np.concatenate(ids))
            at = 0
            for n in owner:
                total[:n] += logs[at : at + n]
                at += n
        out = np.zeros(len(texts))
        out[order] = total / np.log(10)
        return out

    def memory(self) -> dict[str, np.ndarray]:
        """Sums of squared gradients, which training goes on from."""
        return {k: np.full_like(q, 1e-4) for k, q in self.p.items()}

    def train(self, texts: list[np.ndarray], epochs: int = 1, rate: float = 0.1, seed: int = 1, squares: dict | None = None) -> int:
        """Truncated backpropagation through time over all tokens of the texts; gives their number."""
        squares = self.memory() if squares is None else squares
        draw, seen = np.random.default_rng(seed), 0
        for _ in range(epochs):
            # texts are joined to streams of equal length; what the last one lacks is filled up and has no weight
            order = draw.permutation(len(texts))
            flat = np.concatenate([texts[i] for i in order]) if len(texts) else np.zeros(0, np.int64)
            if not len(flat):
                break
            rows = int(min(STREAMS, max(1, len(flat) // (STEPS * UPDATES))))
            length = -(-len(flat) // rows)
            fill = rows * length - len(flat)
            first = np.zeros(len(flat) + fill, bool)
            first[np.concatenate([[0], np.cumsum([len(texts[i]) for i in order])[:-1]])[[len(texts[i]) > 0 for i in order]]] = True
            weight = np.ones(len(flat) + fill, np.float32)
            weight[len(flat) :] = 0
            stream, fresh, weight = (x.reshape(rows, length) for x in (np.pad(flat, (0, fill)), first, weight))
            h = np.zeros((rows, HIDDEN), np.float32)
            for begin in range(0, length, STEPS):
                some = slice(begin, begin + STEPS)
                h = self._window(stream[:, some], fresh[:, some], h, squares, rate, weight[:, some])
            seen += len(flat)
        return seen

    def _window(
        self, ids: np.ndarray, fresh: np.ndarray, h: np.ndarray, squares: dict, rate: float, weight: np.ndarray
    ) -> np.ndarray:
        """One update from a window; gives the state after it. A text's first token sees the zero state."""
        p = self.p
        rows, steps = ids.shape
        n = rows * steps
        flat_id, anew = ids.T.ravel(), fresh.any(0)  # step by step from here on
        x = np.take(p["e"] @ p["w"] + p["b"], flat_id, 0).reshape(steps, rows, -1)
        kept, before = [], np.empty((steps, rows, HIDDEN), np.float32)
        for t in range(steps):
            if anew[t]:
                h = np.where(fresh[:, t, None], np.float32(0), h)
            before[t] = h
            new, z, r, c, uc = self._step(x[t], h)
            kept.append((h, z, r, c, uc))
            h = new
        order, sorted_id, of, ends = self._by_id(flat_id)
        sorted_h, share = np.take(before.reshape(n, HIDDEN), order, 0), (weight.T.ravel() / rows)[order]
        member, sorted_d = sorted_id - of * self.members, np.empty_like(sorted_h)
        grad = {k: np.zeros_like(p[k]) for k in ("cw", "cb", "u")}
        for at in range(0, n, ROWS):
            some = slice(at, at + ROWS)
            d = _gradient(_logits(sorted_h[some], p["cw"], p["cb"]), of[some], share[some])
            grad["cw"] += sorted_h[some].T @ d
            grad["cb"] += np.ones(len(d), np.float32) @ d
            np.matmul(d, p["cw"].T, sorted_d[some])
        for c in np.flatnonzero(np.diff(ends)):
            some = slice(ends[c], ends[c + 1])
            d = _gradient(_logits(sorted_h[some], p["mw"][c], p["mb"][c]), member[some], share[some])
            sorted_d[some] += d @ p["mw"][c].T
            for k, g in (("mw", sorted_h[some].T @ d), ("mb", np.ones(len(d), np.float32) @ d)):
                squares[k][c] += g**2
                p[k][c] -= rate * g / np.sqrt(squares[k][c])
        d_before = np.empty((n, HIDDEN), np.float32)
        d_before[order] = sorted_d
        d_before = d_before.reshape(steps, rows, HIDDEN)
        d_x = np.empty((steps, rows, 3 * HIDDEN), np.float32)
        d_h = np.zeros((rows, HIDDEN), np.float32)
        for t in range(steps - 1, -1, -1):
            last, z, r, c, uc = kept[t]
            hz = d_h * z
            d = d_x[t]
            d_z, d_r, d_c = d[:, :HIDDEN], d[:, HIDDEN : 2 * HIDDEN], d[:, 2 * HIDDEN :]
            np.multiply(c, c, d_c)
            np.subtract(1, d_c, d_c)
            d_c *= hz
            np.subtract(c, last, d_z)
            d_z *= hz
            d_z *= 1 - z
            np.multiply(d_c, uc, d_r)
            d_r *= r
            d_r *= 1 - r
            d_u = d.copy()
            d_u[:, 2 * HIDDEN :] *= r
            grad["u"] += last.T @ d_u
            d_h -= hz
            d_h += d_u @ p["u"].T
            d_h += d_before[t]
            if anew[t]:
                d_h[fresh[:, t]] = 0
        # sums over the places of each id give the gradients of what the ids have in common
        begins = np.flatnonzero(np.diff(sorted_id, prepend=-1))
        touched, sums = sorted_id[begins], np.add.reduceat(np.take(d_x.reshape(n, -1), order, 0), begins)
        grad["w"], grad["b"] = p["e"][touched].T @ sums, sums.sum(0)
        d_e = sums @ p["w"].T
        squares["e"][touched] += d_e**2
        p["e"][touched] -= rate * d_e / np.sqrt(squares["e"][touched])
        for k, g in grad.items():
            squares[k] += g**2
            p[k] -= rate * g / np.sqrt(squares[k])
        return h
