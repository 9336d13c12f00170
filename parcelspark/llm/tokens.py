"""Token counts by finite-state transducers.

Two machines are compiled from a byte-level BPE vocabulary file.

The outer one reads classes of characters and says where a pre-token begins. It has eight states, so a stretch of text
is a map from entry state to exit state. Texts are cut into stretches of equal length, the maps of all stretches are
computed side by side for every entry state, and a parallel prefix scan composes them, which gives each stretch its
entry state and with it the places where pre-tokens begin.

The inner one reads the bytes of a pre-token; each transition carries by how much the number of tokens changes. A
state holds, for each end of the bytes read that could still begin a token, the last token before it and the count of
tokens up to there. Transitions are compiled when they are first used.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from parcelspark.llm.common import text_batches, utf8

#: Characters that are scanned at once; longer texts go through in portions, each entered in the state of its
#: predecessor's exit.
PORTION = 1 << 19

#: Length of the stretches whose state maps are composed.
STRETCH = 128

#: Pre-tokens whose counts a task keeps at most, and states of the inner machine; then it starts again with none.
MEMO, STATES = 500_000, 100_000

LETTER, NUMBER, OTHER, SHORT, LONG, BLANK, LAST_SPACE, LAST_BLANK, BREAK = range(9)
FRESH, IN_LETTERS, IN_NUMBERS, IN_OTHERS, IN_BLANKS, AFTER_SPACE, ONE_MORE, TWO_MORE = range(8)

#: Code of the break between texts: no character has it.
_BREAK = 0x110000


def _outer() -> tuple[np.ndarray, np.ndarray]:
    """(next state, whether a pre-token begins) by state x 9 + class."""
    following, begins = np.zeros((8, 9), np.uint8), np.zeros((8, 9), bool)
    fresh = {
        LETTER: IN_LETTERS, NUMBER: IN_NUMBERS, OTHER: IN_OTHERS, SHORT: ONE_MORE, LONG: TWO_MORE,
        BLANK: IN_BLANKS, LAST_SPACE: AFTER_SPACE, LAST_BLANK: FRESH,
    }
    for state in range(8):
        for kind, to in fresh.items():
            following[state, kind], begins[state, kind] = to, True
    stays = {
        IN_LETTERS: {LETTER: IN_LETTERS}, IN_NUMBERS: {NUMBER: IN_NUMBERS},
        IN_OTHERS: {OTHER: IN_OTHERS, SHORT: IN_OTHERS, LONG: IN_OTHERS}, IN_BLANKS: {BLANK: IN_BLANKS},
        AFTER_SPACE: {
            LETTER: IN_LETTERS, NUMBER: IN_NUMBERS, OTHER: IN_OTHERS, SHORT: IN_OTHERS, LONG: IN_OTHERS,
        },
        ONE_MORE: dict.fromkeys(range(8), FRESH), TWO_MORE: dict.fromkeys(range(8), ONE_MORE),
    }
    for state, kinds in stays.items():
        for kind, to in kinds.items():
            following[state, kind], begins[state, kind] = to, False
    following[:, BREAK], begins[:, BREAK] = FRESH, False
    return following.ravel(), begins.ravel()


@lru_cache(maxsize=2)
def character_classes(file: str) -> np.ndarray:
    """Class of every code point, before its neighbours are looked at, as the library of the file sees it.

    Versions of Unicode differ in thousands of characters, so each is shown to the library's pre-tokenizer between
    characters of known classes, and the class follows from where pre-tokens begin.
    """
    split = Tokenizer.from_str(file).pre_tokenizer.pre_tokenize_str
    table = np.full(_BREAK + 1, OTHER, np.uint8)
    points = np.array([c for c in range(_BREAK) if not 0xD800 <= c < 0xE000])
    for at in range(0, len(points), 1 << 12):
        some = points[at : at + (1 << 12)]
        found = []
        for left, right in ("a1", "!!"):
            begins = np.zeros(3 * len(some) + 1, bool)
            begins[[x for _, (x, _) in split("".join(f"{left}{chr(c)}{right}" for c in some))]] = True
            found.append(begins[:-1].reshape(-1, 3))
        (_, own, after), (_, apart, _) = (x.T for x in found)
        table[some] = np.select([~own, ~after, ~apart], [LETTER, NUMBER, OTHER], BLANK)
    table[32], table[_BREAK] = BLANK, BREAK
    return table


class PreTokens:
    """The outer machine."""

    def __init__(self, table: np.ndarray):
        self.following, self.begins = _outer()
        self.table = table

    def _symbols(self, points: np.ndarray, ahead: np.ndarray) -> np.ndarray:
        """Classes of the points; `ahead` holds up to two points that follow."""
        more = np.concatenate([points, ahead, np.full(2, _BREAK, np.uint32)])
        kinds = self.table[more]
        n = len(points)
        out = kinds[:n].copy()
        last = (out == BLANK) & (kinds[1 : n + 1] != BLANK) & (kinds[1 : n + 1] != BREAK)
        out[last] = np.where(points[last] == 32, LAST_SPACE, LAST_BLANK)
        quotes = np.flatnonzero(points == 39)
        if len(quotes):
            a, b = more[quotes + 1], more[quotes + 2]
            out[quotes[np.isin(a, [ord(c) for c in "stmd"])]] = SHORT
            for x, y in ("re", "ve", "ll"):
                out[quotes[(a == ord(x)) & (b == ord(y))]] = LONG
        return out

    def begin(self, points: np.ndarray, ahead: np.ndarray, entry: int) -> tuple[np.ndarray, int]:
        """(whether a pre-token begins at each point, exit state)."""
        n = len(points)
        rows = -(-n // STRETCH)
        symbols = np.full(rows * STRETCH, BREAK, np.uint8)
        symbols[:n] = self._symbols(points, ahead)
        steps = symbols.reshape(rows, STRETCH).T.astype(np.intp)
        maps = np.tile(np.arange(8, dtype=np.uint8), (rows, 1))
        for step in steps:
            maps = self.following[maps * np.uint8(9) + step[:, None]]
        shift = 1
        while shift < rows:  # after each round a map spans twice as many stretches
            maps[shift:] = np.take_along_axis(maps[shift:], maps[:-shift].astype(np.intp), 1)
            shift *= 2
        state = np.empty(rows, np.uint8)
        state[0] = entry
        state[1:] = maps[:-1, entry]
        flags = np.empty((STRETCH, rows), bool)
        tail = (n - 1) % STRETCH
        leaving = entry
        for i, step in enumerate(steps):
            at = state * np.uint8(9) + step
            flags[i] = self.begins[at]
            state = self.following[at]
            if i == tail:
                leaving = int(state[-1])
        return flags.T.ravel()[:n], leaving


class Bpe:
    """The inner machine. Tokens are numbered in the order in which merges make them, bytes first; the heads of tokens
    are nodes of a tree, numbered too."""

    def __init__(self, vocabulary: set[bytes], ranks: dict[tuple[bytes, bytes], int]):
        self.vocabulary, self.ranks = vocabulary, ranks
        merges = sorted(ranks, key=ranks.__getitem__)
        self.texts = list(dict.fromkeys([*(t for t in vocabulary if len(t) == 1), *(a + b for a, b in merges), *vocabulary]))
        self.number = number = {t: i for i, t in enumerate(self.texts)}
        n = len(self.texts)
        #: Of each token the two that make it, itself for a byte; of two tokens (first * n + second) what they make.
        self.left, self.right, self.made = list(range(n)), list(range(n)), {}
        for a, b in merges:
            if a in number and b in number:
                i = number[a + b]
                self.left[i], self.right[i], self.made[number[a] * n + number[b]] = number[a], number[b], i
        #: Whether each token is made by one merge at most, of tokens made before it.
        self.plain = len(self.made) == len(ranks) == len(set(self.made.values())) and all(
            i > max(self.left[i], self.right[i]) for i in self.made.values()
        )
        self.child: dict[int, int] = {}  # by node * 256 + byte
        self.token, self.inner = [-1], [True]  # token that ends at a node; whether a longer one goes on
        for t in vocabulary:
            node = 0
            for byte in t:
                self.inner[node] = True
                node = self.child.setdefault(node << 8 | byte, len(self.token))
                if node == len(self.token):
                    self.token.append(-1)
                    self.inner.append(False)
            self.token[node] = number[t]
        self.token.append(-1)  # the last stands for no node
        self.inner.append(False)
        self._start()

    def _start(self) -> None:
        self.fits: dict[int, bool] = {}
        self.states: list[tuple] = []
        self.steps: list[dict[int, tuple[int, int]]] = []
        self.index: dict[tuple, int] = {}
        self._state(((0, -1, 0),))

    def forget(self, state: int) -> int:
        """Drop what has been compiled, which is compiled again when it is needed; gives the number that the state
        has from now on."""
        key, fits = self.states[state], self.fits
        self._start()
        if len(fits) < 4 * STATES:
            self.fits = fits
        return self._state(key)

    def _state(self, key: tuple) -> int:
        """Number of a state: for each end of the bytes read that could still begin a token, longest first, its node,
        the last token before it (-1: none) and the count of tokens up to there."""
        at = self.index.setdefault(key, len(self.states))
        if at == len(self.states):
            self.states.append(key)
            self.steps.append({})
        return at

    def merge(self, data: bytes) -> list[bytes]:
        """Tokens by merging the best pair again and again; for the few short strings that the compiler asks for."""
        parts = [data[i : i + 1] for i in range(len(data))]
        while len(parts) > 1:
            rank, i = min((self.ranks.get(p, 1 << 60), i) for i, p in enumerate(zip(parts, parts[1:])))
            if rank == 1 << 60:
                break
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return parts

    def _apart(self, a: int, b: int) -> bool:
        """Whether no merge reaches over the border of two tokens, each of which its own bytes give: the merges beside
        the border are undone, latest first, and what meets there must not have been merged before."""
        made, left, right, n = self.made, self.left, self.right, len(self.texts)
        before = n
        while True:
            if made.get(a * n + b, n) < before:
                return False
            if a > b and right[a] != a or left[b] == b:
                if right[a] == a:
                    return True
                before, a = a, right[a]
            else:
                before, b = b + 1, left[b]  # of equal merges the left one comes first

    def _fit(self, a: int, b: int) -> bool:
        """Whether token b can follow token a (-1: none): the two come out when their bytes are merged."""
        key = (a + 1) * len(self.texts) + b
        found = self.fits.get(key)
        if found is None:
            if a >= 0 and self.plain:
                found = self._fit(-1, b) and self._apart(a, b)
            else:
                tokens = [self.texts[i] for i in (a, b) if i >= 0]
                found = self.merge(b"".join(tokens)) == tokens
            self.fits[key] = found
        return found

    def _ending(self, state: int, byte: int) -> tuple[int, int]:
        """Token that ends with the byte (-1: none) and the change of the count, of a state."""
        for node, last, count in self.states[state]:
            token = self.token[self.child.get(node << 8 | byte, -1)]
            if token >= 0 and self._fit(last, token):
                return token, count + 1
        return -1, 0

    def compile(self, state: int, byte: int) -> tuple[int, int]:
        """Add the transition of a state on a byte: (next state, change of the count)."""
        token, change = self._ending(state, byte)
        kept = [
            (to, last, count - change)
            for node, last, count in self.states[state]
            if self.inner[to := self.child.get(node << 8 | byte, -1)]
        ]
        made = self._state((*kept, (0, token, 0)))
        self.steps[state][byte] = made, change
        return made, change

    def run(self, data: bytes, state: int = 0) -> tuple[int, int]:
        """(state after the bytes, change of the count of tokens)."""
        total, steps = 0, self.steps
        for byte in data:
            step = steps[state].get(byte)
            if step is None:
                if len(steps) >= STATES:
                    state = self.forget(state)
                    steps = self.steps
                step = self.compile(state, byte)
            state, change = step
            total += change
        return state, total

    def count(self, data: bytes) -> int:
        """Tokens of a whole pre-token. Nothing follows its last byte, whose state is not made."""
        state, total = self.run(data[:-1])
        step = self.steps[state].get(data[-1])
        return total + (step or self._ending(state, data[-1]))[1]


def _byte_of_char() -> dict[str, int]:
    """Which byte a character of a byte-level vocabulary stands for: printable ones for themselves, the others for
    the code points from 256 on, in order."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Counter:
    """Counts the tokens of texts for one vocabulary file (the text of its JSON) and its table of classes."""

    def __init__(self, vocabulary_json: str, table: np.ndarray):
        file = json.loads(vocabulary_json)
        model = file["model"]
        if model["type"] != "BPE" or (file.get("pre_tokenizer") or {}).get("type") != "ByteLevel" or file.get("normalizer"):
            raise ValueError("only byte-level BPE without a normalizer can be compiled")
        if file["pre_tokenizer"].get("add_prefix_space") or model.get("ignore_merges"):
            raise ValueError("prefix spaces and ignored merges are not compiled")
        to_byte = _byte_of_char()
        special = [t["content"] for t in file.get("added_tokens", [])]
        raw = lambda s: bytes(to_byte[c] for c in s)
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.bpe = Bpe(
            {raw(t) for t in model["vocab"] if t not in special},
            {(raw(a), raw(b)): i for i, (a, b) in enumerate(merges)},
        )
        self.special = regex.compile("|".join(regex.escape(s) for s in sorted(special, key=len, reverse=True))) if special else None
        self.outer = PreTokens(table)
        self.memo: dict[bytes, int] = {}

    def _count(self, token: bytes) -> int:
        n = self.memo.get(token)
        if n is None:
            n = self.bpe.count(token)
            if len(self.memo) >= MEMO:
                self.memo.clear()
            self.memo[token] = n
        return n

    def _long(self, text: str) -> int:
        """Tokens of a long text, portion by portion; a pre-token may reach over any number of portions."""
        total, state, inner = 0, FRESH, 0
        for at in range(0, len(text), PORTION):
            part = text[at : at + PORTION]
            points = np.frombuffer(part.encode("utf-32-le"), np.uint32)
            ahead = np.frombuffer(text[at + PORTION : at + PORTION + 2].encode("utf-32-le"), np.uint32)
            flags, state = self.outer.begin(points, ahead, state)
            cuts = [0, *np.flatnonzero(flags).tolist(), len(part)]
            inner, more = self.bpe.run(part[: cuts[1]].encode(), inner)
            total += more
            for x, y in zip(cuts[1:-2], cuts[2:-1]):
                total += self._count(part[x:y].encode())
            if len(cuts) > 2:
                inner, more = self.bpe.run(part[cuts[-2] :].encode())
                total += more
        return total

    def counts(self, texts: list[str]) -> np.ndarray:
        """Tokens of each text."""
        out = np.zeros(len(texts), np.int64)
        owner, pieces, size = [], [], 0
        for i, text in enumerate(texts):
            parts = [text]
            if self.special and self.special.search(text):
                out[i] += len(self.special.findall(text))
                parts = self.special.split(text)
            for part in parts:
                if len(part) > PORTION:
                    out[i] += self._long(part)
                elif part:
                    owner.append(i)
                    pieces.append(part)
                    size += len(part) + 1
                    if size > PORTION:
                        np.add.at(out, owner, self._joined(pieces))
                        owner, pieces, size = [], [], 0
        if pieces:
            np.add.at(out, owner, self._joined(pieces))
        return out

    def _joined(self, pieces: list[str]) -> np.ndarray:
        """Tokens of each of several texts, scanned as one with breaks between."""
        end = np.cumsum([len(p) + 1 for p in pieces])
        points = np.full(end[-1], _BREAK, np.uint32)
        inside = np.ones(end[-1], bool)
        inside[end - 1] = False
        points[inside] = np.frombuffer("".join(pieces).encode("utf-32-le"), np.uint32)
        flags, _ = self.outer.begin(points, np.zeros(0, np.uint32), FRESH)
        width = 1 + (points > 0x7F).astype(np.int64) + (points > 0x7FF) + (points > 0xFFFF)
        width[~inside] = 0
        place = np.cumsum(width) - width
        begins = np.flatnonzero(flags)
        data = "".join(pieces).encode()
        cuts = [*place[begins].tolist(), len(data)]
        memo, count = self.memo, self._count
        found = np.fromiter(
            ((memo.get(t := data[x:y]) or count(t)) for x, y in zip(cuts, cuts[1:])), np.int64, len(begins)
        )
        return np.bincount(np.searchsorted(end, begins, "right"), found, len(pieces)).astype(np.int64)


_COUNTERS: dict[int, Counter] = {}


def count_tokens(docs: DataFrame, path: str, limit: int = 512) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) for docs (doc_id, text), by the vocabulary file at `path`.

    Counts are those of the file's own library without added special tokens; a special string inside a text counts as
    one token. Null and empty texts have no bytes and no tokens. Rows and repeats stay, other columns are ignored, an
    empty table gives an empty table. The file is read by the driver and sent to the tasks; its size is fixed.
    """
    with open(path, encoding="utf-8") as f:
        text = f.read()
    file = docs.sparkSession.sparkContext.broadcast((text, character_classes(text)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name = hash(file.value[0])
        if name not in _COUNTERS:
            _COUNTERS[name] = Counter(*file.value)
        for batch in batches:
            data = [utf8(t) for t in batch.column(1).to_pylist()]
            n = _COUNTERS[name].counts([d.decode() for d in data])
            n_bytes = np.array([len(d) for d in data], np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n_bytes), pa.array(n), pa.array(n > limit)],
                ["doc_id", "n_bytes", "n_tokens", "over_limit"],
            )

    schema = "doc_id long, n_bytes long, n_tokens long, over_limit boolean"
    return text_batches(docs).select(F.col("doc_id").cast("long"), "text").mapInArrow(run, schema)
