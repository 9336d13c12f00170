import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from parcelspark.llm import tokens
from tests.llm.data import SF_DIR, TEXTS, documents, plain

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def counter():
    text = open(PATH, encoding="utf-8").read()
    return tokens.Counter(text, tokens.character_classes(text))


def expected(library, text):
    return len(library.encode(text or "", add_special_tokens=False).ids)


def test_awkward_texts(library, counter):
    special = [t.content for t in library.get_added_tokens_decoder().values()]
    texts = [t or "" for t in TEXTS] + [
        "  leading", "trailing  ", "\n\n \n x", "don't we'll I'M they've", "a b　c d", "x" * 3000, " " * 500 + "y",
        "1234567 ½ Ⅷ ٣", "é ‍ ﻿", "\x00\x1c\x1d\x85", "".join(map(chr, range(0x250))), *special,
        *(f"before {s} after{s}{s}" for s in special), *(s[:-1] for s in special),
    ]
    assert counter.counts(texts).tolist() == [expected(library, t) for t in texts]


@settings(max_examples=300, deadline=None)
@given(st.text(st.one_of(st.characters(exclude_categories=["Cs"]), st.sampled_from(" \n\t'aZ09.!<|>end")), max_size=60))
def test_any_text(library, counter, text):
    assert counter.counts([text]).tolist() == [expected(library, text)]


def test_stretches_and_portions_do_not_show(library, counter, monkeypatch):
    monkeypatch.setattr(tokens, "PORTION", 1000)
    text = "".join(t or "" for t in TEXTS[:9]) * 20 + "word  " * 700 + " " * 3000
    assert counter.counts([text, "", text[1:]]).tolist() == [expected(library, text), 0, expected(library, text[1:])]


def test_documents_equal_the_library(spark, library):
    for docs in (documents(spark), plain(spark, SF_DIR)):
        found = tokens.count_tokens(docs, PATH, 512).collect()
        want = [(r.doc_id, len((r.text or "").encode()), expected(library, r.text)) for r in docs.select("doc_id", "text").collect()]
        assert sorted(((r.doc_id, r.n_bytes, r.n_tokens) for r in found), key=str) == sorted(want, key=str)
        assert all(r.over_limit == (r.n_tokens > 512) for r in found)


def test_an_empty_table_gives_an_empty_table(spark):
    assert tokens.count_tokens(documents(spark, []), PATH).count() == 0


def test_counts_have_the_declared_type(counter):
    assert counter.counts(["a"]).dtype == np.int64 and len(counter.counts([])) == 0


def test_what_a_long_lived_worker_holds_is_bounded(library, monkeypatch):
    """Words that never come again, and one word without an end: states are dropped, counts stay right."""
    monkeypatch.setattr(tokens, "STATES", 2000)
    monkeypatch.setattr(tokens, "MEMO", 500)
    text = open(PATH, encoding="utf-8").read()
    counter = tokens.Counter(text, tokens.character_classes(text))
    draw = np.random.default_rng(3)
    letters = np.array(list("abcdefghijklmnopqrstuvwxyz"))
    word = lambda n: "".join(draw.choice(letters, n))
    texts = [" ".join(word(int(draw.integers(3, 12))) for _ in range(3000)), word(30_000), "and the end of it"]
    monkeypatch.setattr(tokens, "PORTION", 7000)
    assert counter.counts(texts).tolist() == [expected(library, t) for t in texts]
    assert len(counter.bpe.states) <= 2001 and len(counter.bpe.index) <= 2001 and len(counter.memo) <= 500
    assert len(counter.bpe.fits) < 20_000


def made_up(pairs):
    """A machine over a, b and c whose merges join tokens made before, by their places."""
    made = [b"a", b"b", b"c"]
    ranks = {}
    for x, y in pairs:
        a, b = made[x % len(made)], made[y % len(made)]
        if a + b not in made:
            ranks[a, b] = len(ranks)
            made.append(a + b)
    return tokens.Bpe(set(made), ranks)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 40), st.integers(0, 40)), max_size=30), st.lists(st.text("abc", min_size=1, max_size=20), max_size=20))
def test_any_merges(pairs, words):
    machine = made_up(pairs)
    assert machine.plain
    for word in map(str.encode, words):
        assert machine.count(word) == machine.run(word)[1] == len(machine.merge(word))
    valid = [t for t in range(len(machine.texts)) if machine.merge(machine.texts[t]) == [machine.texts[t]]]
    for a in valid:
        for b in valid:
            both = [machine.texts[a], machine.texts[b]]
            assert machine._fit(a, b) == (machine.merge(b"".join(both)) == both)


def test_a_token_that_two_merges_make():
    ranks = {p: i for i, p in enumerate([(b"a", b"b"), (b"b", b"c"), (b"ab", b"c"), (b"a", b"bc")])}
    machine = tokens.Bpe({b"a", b"b", b"c", b"ab", b"bc", b"abc"}, ranks)
    assert not machine.plain
    for word in (b"abc", b"abcabc", b"bcabca", b"cabbc", b"aabcc"):
        assert machine.count(word) == len(machine.merge(word))


def test_pairs_of_tokens_are_not_merged_anew(library, monkeypatch):
    """Each token is merged once at most, however many words hold it, and no state is made after a word's last byte."""
    text = open(PATH, encoding="utf-8").read()
    counter = tokens.Counter(text, tokens.character_classes(text))
    asked, merge = [], counter.bpe.merge
    monkeypatch.setattr(counter.bpe, "merge", lambda data: (asked.append(data), merge(data))[1])
    draw = np.random.default_rng(5)
    parts = ["tion", "ing", "en", "ed", "re", "the", "bo", "ch", "au", "ly"]
    texts = [" ".join("".join(draw.choice(parts, draw.integers(2, 6))) for _ in range(3000))]
    assert counter.counts(texts).tolist() == [expected(library, t) for t in texts]
    assert len(asked) == len(set(asked)) and set(asked) <= counter.bpe.vocabulary
    counter.bpe._start()
    assert counter.bpe.count(b" tionq") == 2 and len(counter.bpe.states) == 1 + len(b" tion")
