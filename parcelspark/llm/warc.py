"""WARC archives as a Python data source of Spark, and records of pages with revisits in place of repeated payloads.

Reading: the archives of a folder are planned into partitions by size; a record's header fields are parsed first,
predicates on record types and fields are tested on them, and the block of a record that is not wanted, or whose
payload the schema does not ask for, is stepped over. In a gzip archive each record is a member of its own; where the
member states its length in an `sl` field, as written here, only its head is inflated before it is stepped over.

Writing: each task writes files under a name of its own attempt; only those of the tasks that count are moved to their
place when the job commits, so that a lost executor leaves no half-written archive and no record twice.

Files are opened through pyarrow's file systems (local and shared folders, hdfs, s3, gs).
"""

from __future__ import annotations

import base64
import struct
import uuid
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from urllib.parse import quote

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource, DataSourceArrowWriter, DataSourceReader, EqualNullSafe, EqualTo, Filter, In, InputPartition, IsNotNull,
    IsNull, Not, StringContains, StringEndsWith, StringStartsWith, WriterCommitMessage,
)
from pyspark.sql.types import StructType

from parcelspark.llm.common import batches_of, checkpoint

#: Columns of a read; a schema may name any of them.
SCHEMA = (
    "record_id string, record_type string, target_uri string, date string, content_type string, block_bytes long, "
    "payload_digest string, refers_to string, headers map<string,string>, payload binary"
)
#: The header field of each text column.
FIELDS = {
    "record_id": "warc-record-id", "record_type": "warc-type", "target_uri": "warc-target-uri", "date": "warc-date",
    "content_type": "content-type", "payload_digest": "warc-payload-digest", "refers_to": "warc-refers-to",
}

PUSHDOWN = "spark.sql.python.filterPushdown.enabled"
CHUNK = 1 << 18


def _files(path: str) -> tuple[pa.fs.FileSystem, str]:
    """File system and path of a location; `file:/a` is `file:///a`."""
    if path.startswith("file:/") and not path.startswith("file://"):
        path = "file://" + path.removeprefix("file:")
    return pa.fs.FileSystem.from_uri(path) if "://" in path else (pa.fs.LocalFileSystem(), path)


def archives(path: str) -> list[tuple[str, int]]:
    """(path, bytes) of the archives below a folder, or of one archive; names that begin with _ or . do not count."""
    fs, root = _files(path)
    info = fs.get_file_info(root)
    found = [info] if info.is_file else fs.get_file_info(pa.fs.FileSelector(root, recursive=True))
    hidden = lambda p: any(part[:1] in "_." for part in p[len(root) :].split("/") if part)
    return sorted((f.path, f.size) for f in found if f.is_file and not hidden(f.path))


class Bytes:
    """A file of plain records, read forward: what is stepped over is not read."""

    def __init__(self, file: pa.NativeFile):
        self.file, self.at, self.buffer, self.left = file, 0, b"", file.size()

    def more(self) -> bool:
        chunk = self.file.read(min(CHUNK, self.left)) if self.left else b""
        self.left -= len(chunk)
        self.buffer = self.buffer[self.at :] + chunk
        self.at = 0
        return bool(chunk)

    def until(self, mark: bytes) -> bytes | None:
        """Up to and with the mark; None at the end of the file."""
        seen = self.at
        while (end := self.buffer.find(mark, max(self.at, seen))) < 0:
            seen = len(self.buffer) - self.at - len(mark) + 1
            if not self.more():
                return None
        out = self.buffer[self.at : end + len(mark)]
        self.at = end + len(mark)
        return out

    def take(self, n: int) -> bytes:
        have = self.buffer[self.at : self.at + n]
        self.at += len(have)
        if len(have) == n:
            return have
        rest = self.file.read(min(n - len(have), self.left))
        self.left -= len(rest)
        if len(have) + len(rest) < n:
            raise ValueError("the archive ends within a record")
        return have + rest

    def skip(self, n: int) -> None:
        inside = min(n, len(self.buffer) - self.at)
        self.at += inside
        if n > inside:
            if n - inside > self.left:
                raise ValueError("the archive ends within a record")
            self.file.seek(n - inside, 1)
            self.left -= n - inside


class Member:
    """One gzip member of a file, inflated as it is asked for."""

    def __init__(self, source: Bytes):
        self.source, self.buffer, self.at = source, b"", 0
        self.inflate = zlib.decompressobj(31)
        self.end: int | None = None  # place in the file where a stated length ends
        self.taken = 0
        while len(source.buffer) - source.at < 24 and source.more():
            pass
        head = source.buffer[source.at : source.at + 24]
        if len(head) == 24 and head[3] & 4 and head[12:16] == b"sl\x08\x00":
            self.end = struct.unpack("<I", head[16:20])[0]

    def more(self) -> bool:
        if self.inflate.eof:
            return False
        if self.source.at == len(self.source.buffer) and not self.source.more():
            raise ValueError("the archive ends within a member")
        part = self.source.buffer[self.source.at : self.source.at + (1 << 14)]
        out = self.inflate.decompress(part)
        used = len(part) - len(self.inflate.unused_data)
        self.source.at += used
        self.taken += used
        self.buffer = self.buffer[self.at :] + out
        self.at = 0
        return True

    def until(self, mark: bytes) -> bytes | None:
        while (end := self.buffer.find(mark, self.at)) < 0:
            if not self.more():
                return None
        out = self.buffer[self.at : end + len(mark)]
        self.at = end + len(mark)
        return out

    def take(self, n: int) -> bytes:
        parts, have = [self.buffer[self.at : self.at + n]], min(n, len(self.buffer) - self.at)
        self.at += have
        while have < n:
            if not self.more():
                raise ValueError("the archive ends within a record")
            parts.append(self.buffer[self.at : self.at + n - have])
            self.at += len(parts[-1])
            have += len(parts[-1])
        return b"".join(parts)

    def skip(self, n: int) -> None:
        """Inflate and drop; nothing where `close` steps over the rest of the member."""
        while self.end is None and n:
            have = min(n, len(self.buffer) - self.at)
            self.at += have
            n -= have
            if n and not self.more():
                raise ValueError("the archive ends within a record")

    def close(self) -> None:
        """Step to the next member: by the stated length, else by inflating what is left."""
        if self.end is not None:
            self.source.skip(self.end - self.taken)
            return
        while not self.inflate.eof:
            self.buffer, self.at = b"", 0
            self.more()


def parse_header(text: bytes) -> dict[str, str]:
    """Fields by lower-case name, continuation lines joined; of a repeated field the first counts."""
    fields: dict[str, str] = {}
    name = None
    for line in text.decode("utf-8", "replace").split("\r\n")[1:]:
        if line[:1] in (" ", "\t") and name:
            fields[name] += " " + line.strip()
        elif ":" in line:
            name, value = line.split(":", 1)
            name = name.strip().lower()
            fields[name] = fields.get(name, value.strip())
    return fields


def _more_records(source: Bytes | Member) -> bool:
    """Step over line ends; False at the end."""
    while True:
        if source.at < len(source.buffer):
            if source.buffer[source.at] not in b"\r\n":
                return True
            source.at += 1
        elif not source.more():
            return False


def records(
    file: pa.NativeFile, wanted: Callable[[dict[str, str]], bool], payloads: bool
) -> Iterator[tuple[dict[str, str], bytes | None]]:
    """Header and block of each wanted record of an archive, plain or gzip; the block is None unless payloads are."""

    def one(source: Bytes | Member) -> Iterator[tuple[dict[str, str], bytes | None]]:
        head = source.until(b"\r\n\r\n")
        if head is None or not head.startswith(b"WARC/"):
            raise ValueError(f"no WARC record begins with {(head or b'')[:20]!r}")
        fields = parse_header(head)
        length = int(fields["content-length"])
        if not wanted(fields):
            source.skip(length)
        elif payloads:
            yield fields, source.take(length)
        else:
            source.skip(length)
            yield fields, None

    source = Bytes(file)
    while _more_records(source):
        if source.buffer[source.at] != 0x1F:
            yield from one(source)
            continue
        member = Member(source)
        while _more_records(member):
            yield from one(member)
            if member.end is not None:
                break
        member.close()


def payload_of(fields: dict[str, str], block: bytes) -> bytes | None:
    """What a block carries beside an HTTP head; none in a revisit."""
    if fields.get("warc-type") == "revisit":
        return None
    if fields.get("content-type", "").replace(" ", "").lower().startswith("application/http"):
        return block.partition(b"\r\n\r\n")[2]
    return block


def hex_digest(stated: str | None) -> str | None:
    """The hexadecimal digits of a labelled SHA-1 in base 32; other digests as they stand."""
    label, _, digits = (stated or "").partition(":")
    if label.lower() == "sha1" and len(digits) == 32:
        return base64.b32decode(digits.upper()).hex()
    return stated


def _column(fields: dict[str, str], name: str) -> str | None:
    value = fields.get(FIELDS[name])
    return hex_digest(value) if name == "payload_digest" else value


_TESTS: dict[type, Callable[[str, object], bool]] = {
    EqualTo: lambda v, f: v == f.value,
    In: lambda v, f: v in f.value,
    StringStartsWith: lambda v, f: v.startswith(f.value),
    StringEndsWith: lambda v, f: v.endswith(f.value),
    StringContains: lambda v, f: f.value in v,
}


def header_test(condition: Filter) -> Callable[[dict[str, str]], bool] | None:
    """The condition as a test of header fields; None if it reads anything else. A condition on a missing field that
    SQL leaves unknown keeps no record."""
    if isinstance(condition, Not):
        inner = condition.child
        test = None if isinstance(inner, Not) else header_test(inner)
        if test is None:
            return None
        if isinstance(inner, (IsNull, IsNotNull, EqualNullSafe)):
            return lambda fields: not test(fields)
        name = inner.attribute[0]
        return lambda fields: _column(fields, name) is not None and not test(fields)
    if len(getattr(condition, "attribute", ())) != 1 or condition.attribute[0] not in FIELDS:
        return None
    name = condition.attribute[0]
    if isinstance(condition, IsNull):
        return lambda fields: _column(fields, name) is None
    if isinstance(condition, IsNotNull):
        return lambda fields: _column(fields, name) is not None
    if isinstance(condition, EqualNullSafe):
        return lambda fields: _column(fields, name) == condition.value
    test = _TESTS.get(type(condition))
    if test is None:
        return None
    return lambda fields: (value := _column(fields, name)) is not None and test(value, condition)


@dataclass
class Share(InputPartition):
    """Archives that one task reads."""

    paths: list[str]

    def __init__(self, paths: list[str]):
        self.paths = paths


class Reader(DataSourceReader):
    """Options: `types` (comma-separated record types), `partition_bytes` (archives are gathered up to it, default
    128 MB; one archive is never cut), `batch_bytes` (payload of a batch handed to Spark, default 16 MB)."""

    def __init__(self, schema: StructType, options: dict[str, str]):
        self.path, self.names = options["path"], schema.names
        self.partition_bytes = int(options.get("partition_bytes", 128 << 20))
        self.batch_bytes = int(options.get("batch_bytes", 16 << 20))
        self.conditions: list[Filter] = []
        if "types" in options:
            self.conditions.append(In(("record_type",), tuple(t.strip() for t in options["types"].split(","))))

    def partitions(self) -> list[Share]:
        shares, size = [], 0
        for path, n in archives(self.path):
            if not shares or size + n > self.partition_bytes:
                shares.append([])
                size = 0
            shares[-1].append(path)
            size += n
        return [Share(paths) for paths in shares]

    def read(self, partition: Share | None) -> Iterator[pa.RecordBatch]:
        tests = [header_test(c) for c in self.conditions]
        wanted = lambda fields: all(t(fields) for t in tests)
        kinds = {"block_bytes": pa.int64(), "headers": pa.map_(pa.string(), pa.string()), "payload": pa.binary()}
        columns: dict[str, list] = {n: [] for n in self.names}
        size = 0
        batch = lambda: pa.RecordBatch.from_arrays(
            [pa.array(v, kinds.get(n, pa.string())) for n, v in columns.items()], self.names
        )
        fs, _ = _files(self.path)
        for path in partition.paths if partition else ():
            with fs.open_input_file(path) as file:
                for fields, block in records(file, wanted, "payload" in columns):
                    size += 200 + len(block or b"")
                    for name, values in columns.items():
                        if name == "payload":
                            values.append(payload_of(fields, block))
                        elif name == "headers":
                            values.append(list(fields.items()))
                        elif name == "block_bytes":
                            values.append(int(fields["content-length"]))
                        else:
                            values.append(_column(fields, name))
                    if size >= self.batch_bytes:
                        yield batch()
                        for values in columns.values():
                            values.clear()
                        size = 0
        if size:
            yield batch()


class PushingReader(Reader):
    """A reader that takes over the conditions on header fields."""

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for condition in filters:
            if header_test(condition) is None:
                yield condition
            else:
                self.conditions.append(condition)


@dataclass
class Written(WriterCommitMessage):
    paths: list[str]


def _safe(value: str) -> str:
    """A header value on one line: control characters are percent-encoded."""
    return "".join(quote(c) if ord(c) < 32 or ord(c) == 127 else c for c in value)


def header(fields: dict[str, str | None], length: int) -> bytes:
    lines = [f"{n}: {_safe(v)}" for n, v in fields.items() if v is not None]
    return "\r\n".join(["WARC/1.1", *lines, f"Content-Length: {length}", "", ""]).encode("utf-8", "replace")


def pack(record: bytes, level: int) -> bytes:
    """A gzip member that states its own length in an `sl` field; beyond 4 GB it states none."""
    squeeze = zlib.compressobj(level, zlib.DEFLATED, -15)
    body = squeeze.compress(record) + squeeze.flush()
    tail = body + struct.pack("<II", zlib.crc32(record), len(record) & 0xFFFFFFFF)
    size = 24 + len(tail)
    if size >> 32 or len(record) >> 32:
        return b"\x1f\x8b\x08\x00\0\0\0\0\0\xff" + tail
    extra = struct.pack("<2sHII", b"sl", 8, size, len(record))
    return b"\x1f\x8b\x08\x04\0\0\0\0\0\xff" + struct.pack("<H", 12) + extra + tail


class Writer(DataSourceArrowWriter):
    """Rows are records: record_id, record_type, target_uri, payload_digest (hexadecimal SHA-1), refers_to, headers
    (map), payload, all but the type may be missing or null. Responses carry their payload behind an HTTP head,
    revisits the head alone. Options: `compression` (gzip or none), `level`, `file_bytes` (a file is closed
    beyond it, default 1 GB), `date` (WARC-Date of records without a `date` column)."""

    def __init__(self, schema: StructType, options: dict[str, str], overwrite: bool):
        self.path, self.names, self.overwrite = options["path"], schema.names, overwrite
        self.packed = options.get("compression", "gzip") == "gzip"
        self.level, self.limit = int(options.get("level", 1)), int(options.get("file_bytes", 1 << 30))
        self.date = options.get("date", "1970-01-01T00:00:00Z")
        self.job = uuid.uuid4().hex

    def _record(self, row: dict) -> bytes:
        kind, payload = row["record_type"], row.get("payload")
        http = kind in ("response", "revisit")
        body = b"" if kind == "revisit" else payload or b""
        if http:
            body = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n" + body
        digest = row.get("payload_digest")
        fields = {
            "WARC-Type": kind,
            "WARC-Record-ID": row.get("record_id") or f"<urn:uuid:{uuid.uuid4()}>",
            "WARC-Date": row.get("date") or self.date,
            "WARC-Target-URI": row.get("target_uri"),
            "WARC-Payload-Digest": digest and "sha1:" + base64.b32encode(bytes.fromhex(digest)).decode(),
            "WARC-Refers-To": row.get("refers_to"),
            "WARC-Profile": "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest" if kind == "revisit" else None,
            "Content-Type": "application/http; msgtype=response" if http else "application/octet-stream",
            **dict(row.get("headers") or ()),
        }
        record = header(fields, len(body)) + body + b"\r\n\r\n"
        return pack(record, self.level) if self.packed else record

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        fs, root = _files(self.path)
        attempt, paths, file, size = uuid.uuid4().hex, [], None, 0
        try:
            for batch in iterator:
                for i in range(batch.num_rows):
                    record = self._record({n: batch.column(c)[i].as_py() for c, n in enumerate(batch.schema.names)})
                    if file is None:
                        folder = f"{root}/_writing-{self.job}"
                        fs.create_dir(folder, recursive=True)
                        paths.append(f"{folder}/{attempt}-{len(paths):05d}.warc" + (".gz" if self.packed else ""))
                        file, size = fs.open_output_stream(paths[-1], compression=None), 0
                    file.write(record)
                    size += len(record)
                    if size >= self.limit:
                        file.close()
                        file = None
        finally:
            if file is not None:
                file.close()
        return Written(paths)

    def commit(self, messages: list[Written | None]) -> None:
        fs, root = _files(self.path)
        fs.create_dir(root, recursive=True)
        if self.overwrite:
            for path, _ in archives(self.path):
                fs.delete_file(path)
        for path in (p for m in messages if m for p in m.paths):
            fs.move(path, f"{root}/{path.rsplit('/', 1)[1]}")
        self.abort(messages)

    def abort(self, messages: list[Written | None]) -> None:
        """Remove what lost attempts left."""
        fs, root = _files(self.path)
        folder = f"{root}/_writing-{self.job}"
        if fs.get_file_info(folder).type == pa.fs.FileType.Directory:
            fs.delete_dir(folder)


class WarcSource(DataSource):
    """`spark.read.format("warc").load(path)`, `df.write.format("warc").mode("append").save(path)`.

    A schema without `payload` leaves blocks unread. With the option `pushdown`, conditions of a query on header
    columns are tested before a block is read; Spark asks that `spark.sql.python.filterPushdown.enabled` is set then.
    """

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> Reader:
        unknown = set(schema.names) - {c.split()[0] for c in SCHEMA.split(", ")}
        if unknown:
            raise ValueError(f"a WARC record has no columns {sorted(unknown)}")
        pushes = self.options.get("pushdown", "false").lower() == "true"
        return (PushingReader if pushes else Reader)(schema, dict(self.options))

    def writer(self, schema: StructType, overwrite: bool) -> Writer:
        return Writer(schema, dict(self.options), overwrite)


def read_archives(
    spark: SparkSession, path: str, types: tuple[str, ...] | None = None, columns: tuple[str, ...] | None = None
) -> DataFrame:
    """Records of the given types. Blocks are read only if `payload` is among the columns. Conditions that the caller
    adds on header columns are pushed where the session allows it."""
    spark.dataSource.register(WarcSource)
    reader = spark.read.format("warc").option("pushdown", spark.conf.get(PUSHDOWN) or "false")
    if types:
        reader = reader.option("types", ",".join(types))
    if columns:
        kinds = dict(c.split(" ", 1) for c in SCHEMA.split(", "))
        reader = reader.schema(", ".join(f"{c} {kinds[c]}" for c in columns))
    return reader.load(path)


def write_archives(records: DataFrame, path: str, **options: str) -> None:
    """Write records (see `Writer`) to a new folder."""
    spark = records.sparkSession
    spark.dataSource.register(WarcSource)
    with batches_of(spark, 500):
        records.write.format("warc").mode("append").options(**options).save(path)


#: Payloads of which more copies than this, and more than one in so many of all rows, are handled apart.
HOT_ROWS, HOT_SHARE = 100, 1000
#: Copies of one row that are spread out again in one step.
COPIES = 10_000


def with_revisits(pages: DataFrame, least: int = 1000) -> DataFrame:
    """(page_id, url, payload, payload_bytes, payload_digest, record_type, refers_to) of every row of pages.

    Of rows with equal payloads of `least` bytes or more the one with the largest page_id (null: smaller than any) is
    the response; others become revisits that name its page_id and have a null payload. Of rows that repeat that page_id too, one is the
    response. A null html is an empty payload.

    Rows are numbered within a payload by a window; payloads with more than a thousandth of all rows, of which there
    are fewer than a thousand, never enter it: their largest page_id comes from a count, and its copies are counted
    before they are laid out again.
    """
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string").alias("url"), payload.alias("payload")).select(
        "*", F.length("payload").cast("long").alias("payload_bytes"), F.sha1("payload").alias("payload_digest")
    )
    large = F.col("payload_bytes") >= least
    # SHA-256 beside SHA-1: payloads made to collide in the weaker one stay apart
    rows = rows.withColumn("_same", F.when(large, F.sha2("payload", 256)))
    groups = rows.where(large).groupBy("_same").agg(F.count("*").alias("_n"), F.max("page_id").alias("_top"))
    n = pages.count()
    hot = checkpoint(groups.where((F.col("_n") > HOT_ROWS) & (F.col("_n") * HOT_SHARE > n)))
    rows = rows.join(F.broadcast(hot), "_same", "left")  # fewer than HOT_SHARE payloads

    is_hot, is_top = F.col("_n").isNotNull(), F.col("page_id").eqNullSafe(F.col("_top"))
    none = F.lit(None)
    out = ["page_id", "url", "payload", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    settled = rows.where(~large | (is_hot & ~is_top)).select(
        "page_id", "url", F.when(~large, F.col("payload")).alias("payload"), "payload_bytes", "payload_digest",
        F.when(large, "revisit").otherwise("response").alias("record_type"),
        F.when(large, F.col("_top")).alias("refers_to"),
    )
    w = Window.partitionBy("_same").orderBy(F.desc_nulls_last("page_id"))
    first = F.row_number().over(w) == 1
    few = rows.where(large & ~is_hot).withColumn("_first", first).withColumn("_of", F.first("page_id").over(w)).select(
        "page_id", "url", F.when(F.col("_first"), F.col("payload")).alias("payload"), "payload_bytes", "payload_digest",
        F.when(F.col("_first"), "response").otherwise("revisit").alias("record_type"),
        F.when(~F.col("_first"), F.col("_of")).alias("refers_to"),
    )
    found = settled.unionByName(few)
    if not hot.isEmpty():
        # one row for each address under which the top page_id of a hot payload stands, with its number of copies
        tops = rows.where(is_hot & is_top).groupBy("_same", "page_id", "url").agg(
            F.count("*").alias("_copies"), *(F.first(c).alias(c) for c in ("payload", "payload_bytes", "payload_digest"))
        )
        chosen = F.row_number().over(Window.partitionBy("_same").orderBy("url")) == 1
        tops = checkpoint(tops.withColumn("_chosen", chosen))
        response = tops.where("_chosen").withColumn("record_type", F.lit("response")).withColumn("refers_to", none.cast("long"))
        more = tops.withColumn("_copies", F.col("_copies") - F.col("_chosen").cast("long")).where("_copies > 0").drop("payload")
        steps = more.withColumn("_from", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_copies") - 1, F.lit(COPIES).cast("long"))))
        steps = steps.repartition("_same", "url", "_from")
        count = F.least(F.lit(COPIES).cast("long"), F.col("_copies") - F.col("_from"))
        copies = steps.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), count)))
        copies = copies.withColumns(
            {"payload": none.cast("binary"), "record_type": F.lit("revisit"), "refers_to": F.col("page_id")}
        )
        found = found.unionByName(response.select(out)).unionByName(copies.select(out))
    return found.select(out)


def _urn(digest: Column) -> Column:
    """An id that follows from a digest, in the form of a UUID."""
    parts = [(1, 8), (9, 4), (13, 4), (17, 4), (21, 12)]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *(F.substring(digest, a, n) for a, n in parts)), F.lit(">"))


def page_records(pages: DataFrame, least: int = 1000) -> DataFrame:
    """The records of pages as `write_archives` takes them. The response of payloads that repeat has an id that
    follows from its digest, so that revisits name it without a join; page ids and the full payload's length stand in
    fields of their own."""
    found = with_revisits(pages, least)
    is_revisit = F.col("record_type") == "revisit"
    whole = is_revisit | (F.col("payload_bytes") >= least)
    fields = F.map_filter(
        F.create_map(
            F.lit("X-Page-ID"), F.col("page_id").cast("string"),
            F.lit("X-Payload-Length"), F.col("payload_bytes").cast("string"),
            F.lit("X-Refers-To-Page-ID"), F.col("refers_to").cast("string"),
        ),
        lambda _, value: value.isNotNull(),
    )
    return found.select(
        F.when(whole & ~is_revisit, _urn(F.col("payload_digest"))).alias("record_id"),
        "record_type",
        F.col("url").alias("target_uri"),
        "payload_digest",
        F.when(is_revisit, _urn(F.col("payload_digest"))).alias("refers_to"),
        fields.alias("headers"),
        "payload",
    )


def archive(pages: DataFrame, path: str, least: int = 1000) -> DataFrame:
    """Write the pages to archives and read them back: (page_id, payload_bytes, payload_digest, record_type,
    refers_to) of each record. Length and digest of a response are those of the payload read; a revisit, which has
    none, states them. An empty table gives no record; rows that repeat give a record each; other columns of pages
    are not read."""
    write_archives(page_records(pages, least), path)
    back = read_archives(
        pages.sparkSession, path, ("response", "revisit"), ("record_type", "payload_digest", "headers", "payload")
    )
    is_response = F.col("record_type") == "response"
    field = lambda name: F.try_element_at("headers", F.lit(name)).cast("long")
    return back.select(
        field("x-page-id").alias("page_id"),
        F.when(is_response, F.length("payload")).otherwise(field("x-payload-length")).cast("long").alias("payload_bytes"),
        F.when(is_response, F.sha1("payload")).otherwise(F.col("payload_digest")).alias("payload_digest"),
        "record_type",
        field("x-refers-to-page-id").alias("refers_to"),
    )


ORACLE_SQL = """
WITH p AS (
    SELECT page_id, coalesce(html, '') AS html, octet_length(encode(coalesce(html, ''))) AS payload_bytes FROM pages
), g AS (
    SELECT *, max(page_id) OVER (PARTITION BY html) AS top FROM p
)
SELECT page_id, payload_bytes, sha1(html) AS payload_digest,
    CASE WHEN payload_bytes >= 1000 AND page_id < top THEN 'revisit' ELSE 'response' END AS record_type,
    CASE WHEN payload_bytes >= 1000 AND page_id < top THEN top END AS refers_to
FROM g
"""
