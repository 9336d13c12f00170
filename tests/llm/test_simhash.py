import itertools

import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from parcelspark.llm import components, simhash
from tests.llm.data import SF_DIR, documents, lower, plain, word_list


def by_definition(text):
    words = word_list(lower(text))
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components_of(nodes, linked):
    parent = {n: n for n in nodes}

    def root(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in linked:
        parent[root(a)] = root(b)
    return {n: root(n) for n in nodes}


def check(docs):
    rows = docs.select("doc_id", "text").collect()
    prints = {t: by_definition(t) for t in {r.text for r in rows}}
    distinct = sorted(set(prints.values()))
    root = components_of(distinct, ((a, b) for a, b in itertools.combinations(distinct, 2) if (a ^ b).bit_count() <= 3))
    first = {}
    for r in rows:
        key = root[prints[r.text]]
        first[key] = min((x for x in (first.get(key), r.doc_id) if x is not None), default=None)
    expected = sorted(((r.doc_id, "%016x" % prints[r.text], first[root[prints[r.text]]]) for r in rows), key=str)
    found = simhash.near_duplicates(docs)
    found = found.select("doc_id", simhash.hex_digits(found.fp).alias("fp"), "component_id").collect()
    assert sorted(map(tuple, found), key=str) == expected


def test_awkward_documents_equal_brute_force(spark):
    check(documents(spark))


def test_sample_equals_brute_force(spark):
    check(plain(spark, SF_DIR))


def test_an_empty_table_gives_an_empty_table(spark):
    assert simhash.near_duplicates(documents(spark, [])).count() == 0
    assert simhash.keep_one(documents(spark, [])).count() == 0


def test_one_row_of_each_component_stays_with_all_columns(spark):
    docs = documents(spark)
    of = {(r.doc_id, r.fp): r.component_id for r in simhash.near_duplicates(docs).collect()}
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns and kept.schema == docs.schema
    ids = [of[r.doc_id, simhash.fingerprint(r.text) - (1 << 64 if simhash.fingerprint(r.text) >> 63 else 0)] for r in kept.collect()]
    assert sorted(map(str, ids)) == sorted({str(c) for c in of.values()})


@given(st.integers(0, 2**64 - 1), st.sets(st.integers(0, 63), max_size=3))
def test_every_pair_within_the_radius_meets_in_some_table(fp, flips):
    other = fp
    for b in flips:
        other ^= 1 << b
    assert any(fp & m == other & m for m in simhash.masks(3))


def test_pairs_in_large_buckets_are_found_across_blocks(spark, monkeypatch):
    monkeypatch.setattr(simhash, "BLOCK", 4)
    fps = [(i % 3) << 60 | 1 << (i % 37) for i in range(200)]
    rows = spark.createDataFrame([(f - (1 << 64 if f >> 63 else 0),) for f in sorted(set(fps))], "fp long")
    unsigned = sorted(set(fps))
    root = components_of(unsigned, ((a, b) for a, b in itertools.combinations(unsigned, 2) if (a ^ b).bit_count() <= 3))
    label = {r.node: r.component for r in components.connected_components(simhash.links(rows)).collect()}
    assert len({label.get(f, f) for f in unsigned}) == len(set(root.values()))


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 25), st.integers(0, 25)), max_size=30))
def test_components_equal_brute_force(spark, pairs):
    edges = spark.createDataFrame(pairs, "a long, b long")
    root = components_of({x for p in pairs for x in p}, pairs)
    for r in components.connected_components(edges).collect():
        assert r.component == min(n for n in root if root[n] == root[r.node])


def test_a_long_chain_is_one_component(spark):
    chain = spark.range(300).selectExpr("id as a", "id + 1 as b")
    assert {r.component for r in components.connected_components(chain).collect()} == {0}


@pytest.mark.parametrize("text", [None, "", " \t"])
def test_texts_without_words_have_fingerprint_zero(text):
    assert simhash.fingerprint(text) == 0
