"""WARC archives: a deterministic sharded writer, and a reader.

Rows are dealt into ranges of page_id (exact ranks, so the same rows give the
same files), sorted, and written as gzip members. How many ranges there are follows
from the bytes of all payloads. A file is closed once its compressed size passes a
limit, which is less than a range has. Headers, record ids and digests are made anew
from the row. Tasks write under temporary names and report their files in a
manifest table; only files that a committed manifest lists get their final
names, so a lost or repeated task leaves nothing behind that is read.
"""

from __future__ import annotations

import hashlib
import os
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadbed.llm.common import NULL_KEY, ordered_shards, shard_of, staged
from roadbed.session import stage_root

#: a file is closed when it has more compressed bytes
ROLL_BYTES = 8 << 20
#: payload bytes of a shard, which one task sorts and streams: some files of it
SHARD_BYTES = 128 << 20
#: payloads of fewer bytes are never revisits
MIN_REVISIT_BYTES = 100
#: tasks that read an archive, at most
MAX_READ_TASKS = 20_000
#: records carry one date, that equal rows may give equal files
DATE = "1970-01-01T00:00:00Z"

_MANIFEST = "shard int, file int, temporary string, name string, records bigint, bytes bigint, sha256 string"
_RECORDS = (
    "page_id bigint, url string, payload_bytes bigint, payload_digest string, record_type string, "
    "refers_to bigint, payload binary, intact boolean"
)


def open_store(path: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a folder; a bare path is local."""
    return fs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else os.path.abspath(path))


def _record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}:{digest}')}>"


def _clean(value: str) -> str:
    """A header value: bytes that would end a line or a header are escaped."""
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", value)


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool) -> bytes:
    """One WARC record, uncompressed. A revisit has the HTTP head only."""
    digest = hashlib.sha256(payload).hexdigest()
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = head if revisit else head + payload
    fields = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", _record_id(page_id, digest)),
        ("WARC-Date", DATE),
        ("WARC-Target-URI", "urn:none" if url is None else _clean(url)),
        ("X-Has-URI", str(int(url is not None))),
        ("X-Page-Id", "" if page_id is None else str(page_id)),
        ("WARC-Payload-Digest", f"sha256:{digest}"),
        ("WARC-Block-Digest", f"sha256:{hashlib.sha256(block).hexdigest()}"),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    if revisit:
        fields[3:3] = [
            ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
            ("WARC-Refers-To", _record_id(refers_to, digest)),
            ("X-Refers-To-Page-Id", str(refers_to)),
        ]
    lines = "".join(f"{name}: {value}\r\n" for name, value in fields)
    return b"WARC/1.1\r\n" + lines.encode("utf-8", "surrogatepass") + b"\r\n" + block + b"\r\n\r\n"


def _gzip(data: bytes) -> bytes:
    """A gzip member without name or time."""
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


class _Roller:
    """Files of one task, one open at a time."""

    def __init__(self, folder: str, roll_bytes: int):
        self.store, self.root = open_store(folder)
        self.roll_bytes, self.shard, self.file, self.out = roll_bytes, None, 0, None
        self.store.create_dir(f"{self.root}/_temporary", recursive=True)

    def write(self, shard: int, member: bytes) -> Iterator[tuple]:
        if self.out and (shard != self.shard or self.bytes > self.roll_bytes):
            yield self.close()
        if shard != self.shard:
            self.shard, self.file = shard, 0
        if not self.out:
            self.temporary = f"_temporary/{self.shard:06d}-{self.file:05d}-{uuid.uuid4().hex}"
            self.out = self.store.open_output_stream(f"{self.root}/{self.temporary}")
            self.records, self.bytes, self.sha = 0, 0, hashlib.sha256()
        self.out.write(member)
        self.sha.update(member)
        self.records, self.bytes = self.records + 1, self.bytes + len(member)

    def close(self) -> tuple:
        self.out.close()
        name = f"part-{self.shard:06d}-{self.file:05d}.warc.gz"
        entry = self.shard, self.file, self.temporary, name, self.records, self.bytes, self.sha.hexdigest()
        self.file, self.out = self.file + 1, None
        return entry


def _entries(rows: list[tuple]) -> pa.RecordBatch:
    types = [pa.int32(), pa.int32(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string()]
    names = [c.split()[0] for c in _MANIFEST.split(", ")]
    columns = zip(*rows) if rows else [[] for _ in types]
    return pa.record_batch([pa.array(c, t) for c, t in zip(columns, types)], names)


def write_warc(pages: DataFrame, folder: str, roll_bytes: int = ROLL_BYTES, rows_per_shard: int | None = None) -> DataFrame:
    """Writes ``pages`` (page_id, url, html) under ``folder``; returns the manifest.

    Of records with equal payloads of at least ``MIN_REVISIT_BYTES`` those with
    the smallest page_id are responses, the others revisits of it; rows that
    repeat this id are all responses, and so are all rows of a payload that only
    rows without an id have. NULL html is an empty payload; a NULL url is kept
    apart from an empty one. ``rows_per_shard`` is worked out from ``SHARD_BYTES`` unless
    it is given. No rows give no files. The manifest is a table in
    ``folder``/manifest; a folder is written once.
    """
    spark = pages.sparkSession
    rows = pages.select(
        F.col("page_id").cast("bigint").alias("page_id"), F.col("url").alias("url"),
        F.encode(F.coalesce("html", F.lit("")), "UTF-8").alias("payload"),
    )
    rows = rows.withColumn("digest", F.sha2("payload", 256))
    rows = rows.withColumn("key", F.coalesce("page_id", F.lit(NULL_KEY))).withColumn("tie", F.xxhash64("digest", "url"))
    if rows_per_shard is None:
        size = rows.agg(F.count("*").alias("n"), F.sum(F.octet_length("payload")).alias("bytes")).first()
        shards = max(1, -(-(size["bytes"] or 0) // SHARD_BYTES))
        rows_per_shard = max(1, -(-size["n"] // shards))
    bounds = ordered_shards(rows, "key", "tie", rows_per_shard)
    rows = rows.withColumn("shard", shard_of(bounds, "key", "tie"))
    # without payloads: which rows a revisit mark must precede
    narrow = rows.filter(F.octet_length("payload") >= MIN_REVISIT_BYTES).select("digest", "page_id", "key", "tie", "shard")
    firsts = narrow.groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n")).filter("n > 1 and first is not null")
    marks = narrow.join(firsts, "digest").filter(~F.col("page_id").eqNullSafe(F.col("first")))
    marks = marks.select("shard", "key", "tie", "digest", "first").distinct()
    # a mark sorts right before its rows, so payloads are shuffled once and never joined
    whole = rows.select("shard", "key", "tie", "digest", F.lit(None).cast("bigint").alias("first"), "page_id", "url", "payload", F.lit(1).alias("kind"))
    marked = marks.select("shard", "key", "tie", "digest", "first", F.lit(None).cast("bigint").alias("page_id"), F.lit(None).cast("string").alias("url"), F.lit(None).cast("binary").alias("payload"), F.lit(0).alias("kind"))
    order = ["shard", "key", "tie", "digest", "kind", "url"]
    # one task for each shard: not hashed, so no two share one
    dealt = whole.union(marked).repartitionById(max(1, len(bounds)), F.col("shard")).sortWithinPartitions(*order)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        roller, mark = None, None
        for batch in batches:
            done = []
            for row in batch.to_pylist() if batch.num_rows <= 64 else (r for at in range(0, batch.num_rows, 64) for r in batch.slice(at, 64).to_pylist()):
                place = row["shard"], row["key"], row["tie"], row["digest"]
                if not row["kind"]:
                    mark = place, row["first"]
                    continue
                revisit = mark is not None and mark[0] == place
                member = _gzip(record(row["page_id"], row["url"], row["payload"], mark[1] if revisit else None, revisit))
                roller = roller or _Roller(folder, roll_bytes)
                done += roller.write(row["shard"], member)
            yield _entries(done)
        if roller and roller.out:
            yield _entries([roller.close()])

    # the table's own commit picks one attempt of each task
    written = staged(dealt.mapInArrow(write, _MANIFEST), "warc-manifest")

    def commit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = open_store(folder)
        store.create_dir(f"{root}/data", recursive=True)
        for batch in batches:
            for row in batch.to_pylist():
                target = f"{root}/data/{row['name']}"
                # an earlier attempt of this task may have moved it
                if store.get_file_info(target).type == fs.FileType.NotFound:
                    store.move(f"{root}/{row['temporary']}", target)
            yield batch

    manifest = written.mapInArrow(commit, _MANIFEST).drop("temporary")
    manifest.write.mode("error").parquet(f"{folder}/manifest")
    store, root = open_store(folder)
    if store.get_file_info(f"{root}/_temporary").type != fs.FileType.NotFound:
        store.delete_dir(f"{root}/_temporary")
    return spark.read.parquet(f"{folder}/manifest")


def _members(stream, size: int = 1 << 20) -> Iterator[bytes]:
    """Uncompressed gzip members of a file, one at a time."""
    data, unpack, parts = b"", None, []
    while True:
        if not data and not (data := stream.read(size)):
            return
        unpack = unpack or zlib.decompressobj(31)
        parts.append(unpack.decompress(data))
        data = unpack.unused_data if unpack.eof else b""
        if unpack.eof:
            yield b"".join(parts)
            unpack, parts = None, []


def parse_record(data: bytes, with_payload: bool = True) -> tuple:
    """(page_id, url, bytes, digest, type, refers_to, payload, intact) of a record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode("utf-8", "surrogatepass").split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(re.search(rb"Content-Length: (\d+)", http)[1])
    digest = fields["WARC-Payload-Digest"].removeprefix("sha256:")
    intact = fields["WARC-Block-Digest"] == f"sha256:{hashlib.sha256(block).hexdigest()}"
    kind = fields["WARC-Type"]
    if kind == "response":
        intact = intact and size == len(payload) and hashlib.sha256(payload).hexdigest() == digest
    number = lambda name: int(fields[name]) if fields.get(name) else None
    url = fields["WARC-Target-URI"] if fields["X-Has-URI"] == "1" else None
    kept = payload if kind == "response" and with_payload else None
    return number("X-Page-Id"), url, size, digest, kind, number("X-Refers-To-Page-Id"), kept, intact


def read_warc(spark: SparkSession, folder: str, with_payload: bool = True) -> DataFrame:
    """Records of all files the manifest of ``folder`` lists.

    Files are streamed record by record. ``intact`` tells whether all digests
    and lengths of a record hold. A revisit has no payload of its own; its size
    and digest are those of the full payload.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = open_store(folder)
        types = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary(), pa.bool_()]
        names = [c.split()[0] for c in _RECORDS.split(", ")]
        for batch in batches:
            for name in batch["name"].to_pylist():
                rows, held = [], 0
                with store.open_input_stream(f"{root}/data/{name}", compression=None) as stream:
                    for data in _members(stream):
                        rows.append(parse_record(data, with_payload))
                        held += len(data) if with_payload else 256
                        if held > 4 << 20:
                            yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)
                            rows, held = [], 0
                if rows:
                    yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

    files = spark.read.parquet(f"{folder}/manifest").select("name")
    # names are few bytes but files are not: a fixed number is not coalesced
    tasks = max(1, min(files.count(), MAX_READ_TASKS))
    return files.repartition(tasks, "name").mapInArrow(read, _RECORDS)


def new_archive(spark: SparkSession) -> str:
    """A folder of its own where all executors can write."""
    return f"{stage_root(spark)}/warc-{uuid.uuid4().hex}"
