"""WARC archives: a deterministic sharded writer with a manifest, and the reader.

Records are ordered by page_id. Runs of ids make shards of about equal payload, worked out from the data alone; each
shard is written by one task into files that roll at a compressed size. A file is written under a temporary name of its task
attempt and renamed; a repeated attempt writes the same bytes to the same name. The manifest, a table that Spark commits as a
whole, names the files that count, with their sizes and digests.
"""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from typing import BinaryIO

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rollmill.functions.session import checkpointed, ship, small_side
from rollmill.llm.order import CELL, running_cells

ROLL_BYTES = 16 << 20
SMALL_SHARD, LARGE_SHARD, SHARDS = 1 << 20, 64 << 20, 256
#: Compressed bytes of archives that a task reads, about; a task reads its files one after another.
READ_BYTES = 4 << 20
LEAST_REVISIT = 100
DATE = "1970-01-01T00:00:00Z"
LEVEL = 5

_CONTROL = re.compile(r"[\x00-\x20\x7f]")
_MANIFEST = "shard bigint, file string, records bigint, bytes bigint, sha256 string"


def record_id(page_id: int, digest: str) -> str:
    return f"<urn:uuid:{uuid.UUID(hashlib.sha256(f'{page_id}/{digest}'.encode()).hexdigest()[:32])}>"


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, date: str) -> bytes:
    """One record: headers made anew from the row, then the HTTP block; a revisit's block has no payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    revisit = refers_to is not None
    block = http if revisit else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {record_id(page_id, digest)}", f"WARC-Date: {date}"]
    if url is not None:
        head.append("WARC-Target-URI: " + _CONTROL.sub(lambda m: f"%{ord(m[0]):02X}", url))
    head += [f"WARC-Payload-Digest: sha256:{digest}", f"WARC-Block-Digest: sha256:{hashlib.sha256(block).hexdigest()}"]
    if revisit:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: {record_id(refers_to, digest)}", f"X-Refers-To-Page: {refers_to}"]
    head += [*([] if page_id is None else [f"X-Page-ID: {page_id}"]), "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


class _Files:
    """The rolling files of one shard."""

    def __init__(self, folder: str, shard: int, roll: int):
        self.store, self.folder = fs.FileSystem.from_uri(folder)
        self.shard, self.roll, self.k, self.rows, self.out = shard, roll, 0, [], None

    def write(self, member: bytes) -> None:
        if self.out is None:
            self.temporary = f"{self.folder}/.{self.shard:08d}-{self.k:04d}.{uuid.uuid4().hex}.tmp"
            self.out, self.sum, self.size, self.records = self.store.open_output_stream(self.temporary), hashlib.sha256(), 0, 0
        self.out.write(member)
        self.sum.update(member)
        self.size += len(member)
        self.records += 1
        if self.size >= self.roll:
            self.close()

    def close(self) -> None:
        if self.out is not None:
            self.out.close()
            name = f"part-{self.shard:08d}-{self.k:04d}.warc.gz"
            self.store.move(self.temporary, f"{self.folder}/{name}")
            self.rows.append((self.shard, name, self.records, self.size, self.sum.hexdigest()))
            self.k, self.out = self.k + 1, None


def planned(pages: DataFrame) -> DataFrame:
    """pages (page_id, url, html) as (page_id, url, html, digest, refers_to, shard)."""
    low = -(1 << 63)
    own = pages.select(F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"), F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))
    own = own.withColumns({"digest": F.sha2("html", 256), "size": F.octet_length("html"), "cell": F.floor(F.coalesce("page_id", F.lit(low)) / CELL)})
    slim = own.where(f"size >= {LEAST_REVISIT} and page_id is not null")
    firsts = slim.groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
    firsts = checkpointed(firsts)
    cells = checkpointed(running_cells(own.groupBy("cell").agg(F.sum("size").alias("weight"))))
    n, total = cells.agg(F.count("*"), F.sum("weight")).first()
    size = min(max(SMALL_SHARD, (total or 0) // SHARDS), LARGE_SHARD)
    # a cell heavier than a shard, as of rows without an id, is dealt to as many shards as it fills
    shards = cells.select("cell", F.floor(F.col("before") / size).alias("low"), F.greatest(F.ceil(F.col("weight") / size), F.lit(1)).alias("spread"))
    shard = F.col("low") + F.pmod(F.xxhash64("page_id", "digest", "url"), F.col("spread"))
    own = own.join(small_side(shards, n, 40), "cell").withColumn("shard", shard).join(small_side(firsts, firsts.count(), 120), "digest", "left")
    return own.select("page_id", "url", "html", "digest", F.when((F.col("size") >= LEAST_REVISIT) & (F.col("first") < F.col("page_id")), F.col("first")).alias("refers_to"), "shard")


def write_archives(pages: DataFrame, folder: str, roll: int = ROLL_BYTES, level: int = LEVEL, date: str = DATE) -> DataFrame:
    """Write pages (page_id, url, html) as archives under ``folder``, a URI of a store that all tasks reach; returns the manifest.

    The payload is the html in UTF-8, a null counting as empty. Of the rows with equal payloads of at least 100 bytes those of the smallest
    page_id are responses and the others revisit them; smaller ones, and rows without an id, are all responses. Repeated
    rows are all written. Control characters and spaces of a url are percent-encoded; a null url has no header. An
    empty table gives an empty manifest.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, done = None, []
        for batch in batches:
            names = batch.schema.names
            at, url, html, digest, refers, shard = (batch.column(names.index(k)) for k in ("page_id", "url", "html", "digest", "refers_to", "shard"))
            for k in range(batch.num_rows):
                if files is None or files.shard != shard[k].as_py():
                    if files is not None:
                        files.close()
                        done += files.rows
                    files = _Files(folder, shard[k].as_py(), roll)
                text = record(at[k].as_py(), url[k].as_py(), html[k].as_py().encode(), digest[k].as_py(), refers[k].as_py(), date)
                pack = zlib.compressobj(level, zlib.DEFLATED, 31)
                files.write(pack.compress(text) + pack.flush())
        if files is not None:
            files.close()
            done += files.rows
        columns = list(zip(*done, strict=True)) if done else [()] * 5
        kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string())
        yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, kinds, strict=True)], ["shard", "file", "records", "bytes", "sha256"])

    spark = pages.sparkSession
    ship(spark)
    store, path = fs.FileSystem.from_uri(folder)
    store.create_dir(path, recursive=True)
    rows = planned(pages).repartition("shard").sortWithinPartitions("shard", "page_id", "digest", "url")
    rows.mapInArrow(run, _MANIFEST).write.mode("overwrite").parquet(f"{folder}/manifest")
    return spark.read.schema(_MANIFEST).parquet(f"{folder}/manifest")


def members(stream: BinaryIO, size: int = 1 << 16) -> Iterator[bytes]:
    """The gzip members of a stream, one at a time."""
    unpack, out, chunk = zlib.decompressobj(31), [], stream.read(size)
    while chunk:
        out.append(unpack.decompress(chunk))
        chunk = b""
        if unpack.eof:
            yield b"".join(out)
            unpack, out, chunk = zlib.decompressobj(31), [], unpack.unused_data
        chunk = chunk or stream.read(size)
    if any(out):
        raise ValueError("a member is cut short")


def parse(member: bytes) -> tuple[dict[str, str], bytes]:
    """Headers of a record, by lower-case name, and its block."""
    head, _, rest = member.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = dict(x.split(": ", 1) for x in lines[1:])
    fields = {k.lower(): v for k, v in fields.items()}
    block = rest[: int(fields["content-length"])]
    if len(rest) != len(block) + 4 or fields["warc-block-digest"] != "sha256:" + hashlib.sha256(block).hexdigest():
        raise ValueError(f"record {fields.get('warc-record-id')} is damaged")
    return fields, block


_HTTP_LENGTH = re.compile(rb"\r\nContent-Length: (\d+)\r\n")


def read_archives(spark: SparkSession, folder: str, payloads: bool = False) -> DataFrame:
    """The records of the files that the manifest names, each file, block and payload checked against its digest.

    (page_id, url, record_type, refers_to, payload_bytes, payload_digest), with ``payloads`` also payload (null for a revisit).
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, path = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for name, known in zip(*(batch.column(k).to_pylist() for k in ("file", "sha256")), strict=True):
                rows = []
                with store.open_input_stream(f"{path}/{name}", compression=None) as stream:
                    seen = _Summed(stream)
                    for member in members(seen):
                        rows.append(row(*parse(member)))
                        if len(rows) == 512:
                            yield out(rows)
                            rows = []
                if seen.sum.hexdigest() != known:
                    raise ValueError(f"{name} is not the file of the manifest")
                if rows:
                    yield out(rows)

    def row(fields: dict[str, str], block: bytes) -> tuple:
        http, _, payload = block.partition(b"\r\n\r\n")
        size = int(_HTTP_LENGTH.search(http + b"\r\n")[1])
        digest = fields["warc-payload-digest"].removeprefix("sha256:")
        refers, page = fields.get("x-refers-to-page"), fields.get("x-page-id")
        if refers is None and (len(payload) != size or hashlib.sha256(payload).hexdigest() != digest):
            raise ValueError(f"payload of page {page} is damaged")
        return page and int(page), fields.get("warc-target-uri"), fields["warc-type"], refers and int(refers), size, digest, payload if payloads and refers is None else None

    def out(rows: list[tuple]) -> pa.RecordBatch:
        kinds = (pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.binary())
        columns = [pa.array(list(c), t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)]
        return pa.RecordBatch.from_arrays(columns, _NAMES).select(_NAMES if payloads else _NAMES[:-1])

    ship(spark)
    manifest = spark.read.schema(_MANIFEST).parquet(f"{folder}/manifest")
    schema = "page_id bigint, url string, record_type string, refers_to bigint, payload_bytes bigint, payload_digest string" + ", payload binary" * payloads
    # the manifest's rows are tiny: a number of partitions that is set keeps them from being put together in a few tasks
    size = manifest.agg(F.sum("bytes")).first()[0] or 0
    tasks = size // READ_BYTES + 1
    return manifest.select("file", "sha256").repartition(tasks, "file").mapInArrow(run, schema)


_NAMES = ["page_id", "url", "record_type", "refers_to", "payload_bytes", "payload_digest", "payload"]


class _Summed:
    def __init__(self, stream: BinaryIO):
        self.stream, self.sum = stream, hashlib.sha256()

    def read(self, size: int) -> bytes:
        data = self.stream.read(size)
        self.sum.update(data)
        return data
