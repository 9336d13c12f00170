import gzip
import hashlib
import io
import os
from collections import defaultdict

import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st

from parcelspark.llm import warc
from tests.llm.data import SF_DIR, plain

SCHEMA = "page_id long, url string, html string, payload string, record_type string"


def by_hand(rows, least=1000):
    """{(page_id, ...): count}: sorted rows of the contract, one loop over equal payloads."""
    groups, out = defaultdict(list), []
    for page_id, _, html, *_ in rows:
        groups[(html or "").encode()].append(page_id)
    for payload, ids in groups.items():
        ids.sort(key=lambda i: -1 if i is None else i, reverse=True)
        for k, page_id in enumerate(ids):
            revisit = len(payload) >= least and k > 0
            out.append((page_id, len(payload), hashlib.sha1(payload).hexdigest(), "revisit" if revisit else "response",
                        ids[0] if revisit else None))
    return sorted(out, key=repr)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_pages_there_and_back(spark, tmp_path):
    pages = plain(spark, SF_DIR, "pages")
    found = warc.archive(pages, f"{tmp_path}/a")
    assert found.columns == ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    assert rows_of(found) == by_hand([tuple(r) for r in pages.collect()])
    payloads = warc.read_archives(spark, f"{tmp_path}/a", ("response",), ("payload", "target_uri", "headers"))
    there = {(r.page_id, r.url): r.html for r in pages.collect()}
    for r in payloads.collect():
        assert r.payload.decode() == there[int(r.headers["x-page-id"]), r.target_uri]


def awkward(spark):
    big, wide = "<p>" + "x" * 1000, "é\r\n\r\nWARC/1.1\r\n" * 200
    rows = [(1, "http://a/1", big), (2, None, big), (2, "http://a/2\r\nX: 1", big), (3, "u", None), (4, "u", ""), (5, "u", "short"),
            (6, "u", "short"), (None, None, wide), (None, "v", wide), (7, "w", wide), (8, "é", "y" * 999), (9, "é", "y" * 999),
            (10, "z", "y" * 1000), (11, "z", "y" * 1000), (12, "long", "long " * 400_000)]
    rows += [rows[0], rows[2], rows[11], rows[-1]]
    return spark.createDataFrame([(*r, "clash", "clash") for r in rows], SCHEMA), rows


@pytest.mark.parametrize("hot", [0, 100])
@pytest.mark.parametrize("options", [{}, {"compression": "none"}, {"file_bytes": "3000"}])
def test_awkward_rows(spark, tmp_path, monkeypatch, hot, options):
    monkeypatch.setattr(warc, "HOT_ROWS", hot)
    pages, rows = awkward(spark)
    warc.write_archives(warc.page_records(pages), f"{tmp_path}/a", **options)
    back = warc.read_archives(spark, f"{tmp_path}/a")
    digest = lambda r: (int(r.headers["x-page-id"]) if "x-page-id" in r.headers else None, int(r.headers["x-payload-length"]),
                        r.payload_digest, r.record_type, int(r.headers["x-refers-to-page-id"]) if "x-refers-to-page-id" in r.headers else None)
    found = back.collect()
    assert [d[:4] for d in sorted(map(digest, found), key=repr)] == [d[:4] for d in by_hand(rows)]
    ids = {r.record_id for r in found if r.record_type == "response"}
    assert len(ids) == sum(r.record_type == "response" for r in found)
    for r in found:
        if r.record_type == "response":
            assert hashlib.sha1(r.payload).hexdigest() == r.payload_digest
        else:
            assert r.payload is None and r.refers_to in ids


def test_many_copies_of_the_largest_page(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "COPIES", 7)
    monkeypatch.setattr(warc, "HOT_ROWS", 20)
    rows = [(5, "u", "a" * 2000)] * 50 + [(4, "u", "a" * 2000)] * 40 + [(5, "other", "a" * 2000)] * 3 + [(i, "u", "") for i in range(60)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert rows_of(warc.archive(pages, f"{tmp_path}/a")) == by_hand(rows)


def test_empty_table(spark, tmp_path):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.archive(pages, f"{tmp_path}/a").collect() == []


RECORDS = st.lists(
    st.tuples(st.sampled_from(["response", "resource", "metadata", "revisit"]), st.binary(max_size=300), st.text(max_size=20)), max_size=8
)


def _write(records, packed):
    writer = warc.Writer(_Names(), {"path": "/nowhere", "compression": "gzip" if packed else "none"}, False)
    return [writer._record({"record_type": k, "payload": p, "target_uri": u}) for k, p, u in records]


class _Names:
    names = []


@given(RECORDS, st.sampled_from(["plain", "members", "foreign", "whole"]), st.integers(1, 40))
@settings(max_examples=150, deadline=None)
def test_any_archive_reads_back(records, form, chunk):
    parts = _write(records, form == "members")
    if form == "foreign":
        parts = [gzip.compress(p) for p in parts]  # members that state no length
    data = gzip.compress(b"".join(parts)) if form == "whole" and parts else b"".join(parts)
    before, warc.CHUNK = warc.CHUNK, chunk
    try:
        everything = list(warc.records(pa.BufferReader(data), lambda f: True, True))
        heads = list(warc.records(pa.BufferReader(data), lambda f: True, False))
        some = list(warc.records(pa.BufferReader(data), lambda f: f["warc-type"] == "metadata", True))
    finally:
        warc.CHUNK = before
    want = [(k, None if k == "revisit" else p) for k, p, _ in records]
    assert [(f["warc-type"], warc.payload_of(f, b)) for f, b in everything] == want
    assert [f["warc-type"] for f, b in heads if b is None] == [k for k, _ in want]
    assert [warc.payload_of(f, b) for f, b in some] == [p for k, p in want if k == "metadata"]


def test_unwanted_blocks_are_stepped_over():
    class Counted(io.BytesIO):
        got = 0

        def read(self, *n):
            out = super().read(*n)
            Counted.got += len(out)
            return out

    noise = hashlib.sha512(b"x").digest() * 30_000  # 1.9 MB
    for packed in (False, True):
        data = b"".join(_write([("resource", noise[i:], "u") for i in range(5)], packed))
        Counted.got = 0
        if packed:
            data += b"".join(_write([("resource", os.urandom(2 << 20), "u")] * 5, True))
        assert len(list(warc.records(pa.PythonFile(Counted(data), mode="r"), lambda f: False, False))) == 0
        assert Counted.got < len(data) / 2


def test_a_cut_archive_is_an_error():
    for packed in (False, True):
        data = b"".join(_write([("resource", b"abc" * 100, "u")], packed))
        with pytest.raises(ValueError):
            list(warc.records(pa.BufferReader(data[:-100]), lambda f: True, True))


def test_header_predicates_are_pushed(spark, tmp_path):
    pages, _ = awkward(spark)
    warc.write_archives(warc.page_records(pages), f"{tmp_path}/a")
    every = warc.read_archives(spark, f"{tmp_path}/a").collect()
    before = spark.conf.get(warc.PUSHDOWN)
    spark.conf.set(warc.PUSHDOWN, "true")
    try:
        df = warc.read_archives(spark, f"{tmp_path}/a", columns=("record_type", "target_uri", "block_bytes"))
        q = df.where("record_type = 'response' AND target_uri LIKE 'u%' AND block_bytes > 60")
        plan = q._jdf.queryExecution().executedPlan().toString()
        assert [r.target_uri for r in q.collect()] == ["u"] * sum(
            r.record_type == "response" and (r.target_uri or "").startswith("u") and r.block_bytes > 60 for r in every
        )
        assert "block_bytes" in plan.split("Filter")[1] and "record_type" not in plan.split("Filter")[1].split("\n")[0]
        for condition in ("record_type <> 'revisit'", "target_uri IS NULL", "NOT target_uri LIKE '%1%'", "target_uri IN ('u', 'w')",
                          "NOT (target_uri <=> 'u')", "payload_digest = '" + every[0].payload_digest + "'", "target_uri LIKE '%z%'"):
            frame = warc.read_archives(spark, f"{tmp_path}/a").where(condition)
            spark.conf.set(warc.PUSHDOWN, "false")
            plain_rows = rows_of(warc.read_archives(spark, f"{tmp_path}/a").where(condition).select("record_id", "target_uri"))
            spark.conf.set(warc.PUSHDOWN, "true")
            assert rows_of(frame.select("record_id", "target_uri")) == plain_rows
    finally:
        spark.conf.set(warc.PUSHDOWN, before)


def test_partitions_gather_archives(spark, tmp_path):
    pages, rows = awkward(spark)
    warc.write_archives(warc.page_records(pages), f"{tmp_path}/a", file_bytes="1")
    reader = lambda n: warc.Reader(_Names(), {"path": f"{tmp_path}/a", "partition_bytes": n})
    assert len(reader("1").partitions()) == len(rows) == len(warc.archives(f"{tmp_path}/a"))
    assert len(reader("1000000000").partitions()) == 1
    (tmp_path / "a" / "_writing-lost").mkdir()
    (tmp_path / "a" / "_writing-lost" / "x.warc").write_bytes(b"half")
    assert warc.read_archives(spark, f"{tmp_path}/a", columns=("record_id",)).count() == len(rows)
    with pytest.raises(Exception, match="no columns"):
        spark.read.format("warc").schema("nothing string").load(f"{tmp_path}/a").collect()
