from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given
from hypothesis import strategies as st

from parcelspark.llm import packing
from tests.llm.data import documents, plain, word_list

SF_DIR = "/root/testdata/sf0.01"


def check(docs):
    rows = packing.pack(docs).collect()
    # round trip: the pieces of the documents are all there, in order, each word once
    words, pieces = defaultdict(list), defaultdict(list)
    for r in docs.select("doc_id", "text").collect():
        words[r.doc_id].append(len(word_list(r.text)))
    for r in rows:
        pieces[r.doc_id].append(r)
    assert pieces.keys() == words.keys()
    for doc_id, of in pieces.items():
        assert sum(r.n_words for r in of) == sum(words[doc_id])
        assert sum(r.piece == 0 for r in of) == len(words[doc_id])
        assert all(r.n_words == max(packing.LENGTHS) for r in of if any(
            o.piece > r.piece and o.copy == r.copy for o in of) and len(words[doc_id]) == 1)
    bins = defaultdict(list)
    for r in rows:
        if r.n_words == 0:
            assert r.bin_id is None and r.bin_offset is None and r.bin_length == 0
        else:
            bins[r.bin_id].append(r)
    room = used = 0
    for of in bins.values():
        assert len({r.bin_length for r in of}) == 1 and of[0].bin_length in packing.LENGTHS
        at = 0
        for r in sorted(of, key=lambda r: r.bin_offset):
            assert r.bin_offset == at
            at += r.n_words
        assert at <= of[0].bin_length
        assert of[0].bin_length == min(x for x in packing.LENGTHS if x >= at)
        room, used = room + of[0].bin_length, used + at
    return room, used


def test_awkward_documents_are_packed_whole(spark):
    check(documents(spark))


def test_sample_is_packed_whole_and_tightly(spark):
    room, used = check(plain(spark, SF_DIR))
    assert used / room > 0.97


def test_reruns_and_other_partitions_agree(spark):
    docs = documents(spark)
    one = sorted(map(str, packing.pack(docs).collect()))
    assert sorted(map(str, packing.pack(docs.repartition(7)).collect())) == one


def test_an_empty_table_gives_an_empty_table(spark):
    assert packing.pack(documents(spark, [])).count() == 0


def test_pieces_are_dealt_to_shards(spark, monkeypatch):
    monkeypatch.setattr(packing, "SHARD", 50)
    docs = plain(spark, SF_DIR)
    check(docs)
    assert packing.pack(docs).selectExpr("bin_id >> 32 as shard").where("shard is not null").distinct().count() > 10


@given(st.lists(st.integers(1, 2048), min_size=1, max_size=80))
def test_a_shard_costs_no_more_than_one_length_alone(sizes):
    sizes = np.array(sizes)
    bins, offsets, final = packing.pack_shard(sizes)
    cost = sum(x + packing.BIN_COST for _, x in {(b, f) for b, f in zip(bins, final)})
    # first fit of falling sizes into the longest length
    loads = []
    for s in sorted(sizes.tolist(), reverse=True):
        for i, load in enumerate(loads):
            if load + s <= 2048:
                loads[i] += s
                break
        else:
            loads.append(s)
    assert cost <= len(loads) * (2048 + packing.BIN_COST) or len(set(bins)) <= len(loads) * 11 / 9 + 1
    for b in set(bins.tolist()):
        inside = bins == b
        assert sizes[inside].sum() <= final[inside][0]


@pytest.mark.parametrize("sizes, bins", [([2048, 2048], 2), ([1024, 1024], 1), ([256], 1), ([700, 600, 500, 248], 1)])
def test_hand_worked(sizes, bins):
    found, _, final = packing.pack_shard(np.array(sizes))
    assert len(set(found.tolist())) == bins and sum(dict(zip(found.tolist(), final.tolist())).values()) == sum(sizes)
