import hashlib
from collections import Counter

from parcelspark.llm import repeats
from tests.llm.data import LONG, PASSAGE, SF_DIR, documents, plain


def removed_of(texts, length):
    """For each text the flags of removed bytes, by counting every string."""
    data = [(t or "").encode() for t in texts]
    counts = Counter(d[i : i + length] for d in data for i in range(len(d) - length + 1))
    out = []
    for d in data:
        flags, until = bytearray(len(d)), 0
        for i in range(len(d) - length + 1):
            if counts[d[i : i + length]] > 1:
                start = max(i, until)
                flags[start : i + length] = b"\1" * (i + length - start)
                until = i + length
        out.append(bytes(flags))
    return data, out


def check(docs, length=200, gram=32):
    rows = docs.collect()
    data, flags = removed_of([r.text for r in rows], length)
    expected = Counter()
    for r, d, f in zip(rows, data, flags):
        kept = bytes(b for b, x in zip(d, f) if not x)
        spans = sum(1 for i, x in enumerate(f) if x and not (i and f[i - 1]))
        expected[r.doc_id, len(d), sum(f), spans, hashlib.sha256(kept).hexdigest()] += 1
    result = repeats.remove_repeats(docs, length, gram)
    assert result.columns[: len(docs.columns)] == docs.columns
    found = Counter(
        (r.doc_id, r._n_bytes, r._n_removed, r._n_spans, hashlib.sha256(bytes(r._kept)).hexdigest()) for r in result.collect()
    )
    assert found == expected


def test_awkward_documents_equal_brute_force(spark):
    check(documents(spark))


def test_sample_equals_brute_force(spark):
    check(plain(spark, SF_DIR))


def test_other_lengths_and_periodic_texts(spark):
    texts = ["ab" * 400, "ba" * 300 + "c", "a" * 119, "a" * 120, "b" * 121, "xyz" * 39 + "xy", "q" * 60 + "r" * 60, None, ""]
    check(documents(spark, texts), length=120, gram=16)


def test_strings_of_exactly_the_length_and_one_less(spark):
    unique = [hashlib.sha512(bytes([i])).hexdigest() * 3 for i in range(6)]
    a, b = (PASSAGE * 2)[:200], (PASSAGE[::-1] * 2)[:199]
    check(documents(spark, [unique[0] + a + unique[1], unique[2] + a, b + unique[3], unique[4] + b + unique[5]]))


def test_texts_above_a_portion_are_whole(spark, monkeypatch):
    monkeypatch.setattr(repeats, "BATCH_BYTES", 4096)
    check(documents(spark, [LONG, "start " + LONG[1000:200_000], PASSAGE]))


def test_an_empty_table_gives_an_empty_table(spark):
    assert repeats.remove_repeats(documents(spark, [])).count() == 0


def test_a_cut_character_is_left_out(spark):
    # the repeated strings begin and end inside characters whose other byte differs
    middle = "x" * 198
    texts = ["Aé" + middle + "éB", "Cũ" + middle + "éD", "Cé" + middle + "ĩD", None]
    kept = {r.text: r._kept for r in repeats.remove_repeats(documents(spark, texts), as_text=True).collect()}
    assert [kept[t] for t in texts] == ["AB", "CD", "CĩD", ""]
