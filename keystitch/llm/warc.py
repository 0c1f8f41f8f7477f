"""Sharded WARC archives: deterministic writer with revisit records, and reader.

Records are dealt into shards by ranges of their key and sorted within them. A shard is written as one or more gzip
files, one member a record; a file is closed once its compressed size reaches a limit. Shards, file names, headers,
record ids and digests follow from the rows and the parameters alone. A task writes under a temporary name of its
own attempt and reports the file; the reports of the attempts that counted become the manifest, by which the files
then get their final names. The manifest gets its name last, so a folder with one is complete, and the reader opens
only what it lists.

Of the rows whose payloads are equal and have at least `revisit_bytes` bytes, the one with the largest key is kept as
a response, the others refer to it. Defined cases: a null payload is an empty one. A row without a key is kept; it
refers to an equal row with a key if there is one, else one of such rows is the response of the others, which then
refer to no key. Of rows with the same key and payload the first by url is the response. A null url gives no header,
and control characters and spaces of a url are percent-encoded. An empty table gives an empty manifest.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keystitch.sources.tables import drop_folder, new_folder, stage

#: Payload of a shard before compression, and compressed size at which a file is closed.
SHARD_BYTES, FILE_BYTES = 64 << 20, 16 << 20
_READ_BYTES = 1 << 20
_LEVEL = 6
_RECORDS = uuid.uuid5(uuid.NAMESPACE_URL, "urn:keystitch:warc-record")
_FILES = "name string, attempt string, shard long, records long, bytes long, sha256 string"
_ROWS = (
    "record_type string, record_id string, key long, refers_to long, url string, date string, payload_bytes long, "
    "payload_digest string, intact boolean, payload binary, file string, offset long"
)


def _open(folder: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(re.sub("^file:/+", "file:///", folder))


def _sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _record(headers: list[tuple[str, str | None]], block: bytes) -> bytes:
    lines = [*headers, ("WARC-Block-Digest", f"sha1:{_sha1(block)}"), ("Content-Length", str(len(block)))]
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in lines if v is not None)
    member = zlib.compressobj(_LEVEL, zlib.DEFLATED, 31)
    return member.compress(head.encode() + b"\r\n" + block + b"\r\n\r\n") + member.flush()


def _urn(key: int | None, digest: str, copy: int = 0) -> str:
    return f"<urn:uuid:{uuid.uuid5(_RECORDS, f'{key}/{digest}/{copy}')}>"


def _page(key, url, payload: bytes, digest: str, keeper: int | None, copy: int, revisit: bool, date: str) -> bytes:
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    address = None if url is None else re.sub("[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)
    return _record(
        [
            ("WARC-Type", "revisit" if revisit else "response"),
            ("WARC-Record-ID", _urn(key, digest, copy)),
            ("WARC-Date", date),
            ("WARC-Target-URI", address),
            ("WARC-Payload-Digest", f"sha1:{digest}"),
            ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest" if revisit else None),
            ("WARC-Refers-To", _urn(keeper, digest) if revisit else None),
            ("Content-Type", "application/http;msgtype=response"),
            ("X-Row-Key", None if key is None else str(key)),
            ("X-Refers-To-Row-Key", str(keeper) if revisit and keeper is not None else None),
        ],
        http.encode() + (b"" if revisit else payload),
    )


class _Shards:
    """Writes the records of a task, given in order, and lists the files it has closed."""

    def __init__(self, folder: str, file_bytes: int, date: str):
        self.system, self.root = _open(folder)
        self.file_bytes, self.date, self.shard, self.out, self.closed = file_bytes, date, None, None, []

    def add(self, shard: int, record: bytes) -> None:
        if shard != self.shard:
            self.close()
            self.shard, self.roll = shard, 0
        if self.out is None:
            self.name = f"records-{shard:08d}-{self.roll:05d}.warc.gz"
            self.attempt = f"_temporary/{uuid.uuid4().hex}"
            self.system.create_dir(f"{self.root}/_temporary", recursive=True)
            self.out = self.system.open_output_stream(f"{self.root}/{self.attempt}", compression=None)
            self.records, self.bytes, self.hash = -1, 0, hashlib.sha256()
            info = [
                ("WARC-Type", "warcinfo"),
                ("WARC-Record-ID", _urn(None, self.name)),
                ("WARC-Date", self.date),
                ("WARC-Filename", self.name),
                ("Content-Type", "application/warc-fields"),
            ]
            self._put(_record(info, b"format: WARC File Format 1.1\r\n"))
        self._put(record)
        if self.bytes >= self.file_bytes:
            self.close()

    def _put(self, data: bytes) -> None:
        self.out.write(data)
        self.hash.update(data)
        self.bytes += len(data)
        self.records += 1

    def close(self) -> None:
        if self.out is not None:
            self.out.close()
            report = (self.name, self.attempt, self.shard, self.records, self.bytes, self.hash.hexdigest())
            self.closed.append(report)
            self.out, self.roll = None, self.roll + 1


def _table(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"string": pa.string(), "long": pa.int64(), "boolean": pa.bool_(), "binary": pa.binary()}
    fields = [f.split(" ") for f in schema.split(", ")]
    columns = list(zip(*rows, strict=True)) or [()] * len(fields)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, kinds[k]) for c, (_, k) in zip(columns, fields, strict=True)], [n for n, _ in fields]
    )


def write(
    rows: DataFrame,
    folder: str,
    *,
    key: str = "page_id",
    url: str = "url",
    payload: str = "html",
    date: str,
    revisit_bytes: int = 0,
    shard_bytes: int = SHARD_BYTES,
    file_bytes: int = FILE_BYTES,
) -> DataFrame:
    """Write one record a row below `folder`, which must be new, and return the manifest."""
    spark = rows.sparkSession
    content = F.coalesce(F.col(payload).cast("string"), F.lit("")).cast("binary")
    pages = rows.select(F.col(key).cast("long").alias("k"), F.col(url).cast("string").alias("u"), content.alias("p"))
    pages = pages.withColumn("d", F.sha1("p"))
    index = stage(pages.select("k", "d", F.octet_length("p").alias("n")), "warc-index")
    # groups of equal payloads are narrow and counted before they are shuffled; a hot one is a single row here
    long_enough = index.where(F.col("n") >= revisit_bytes)
    groups = long_enough.groupBy("d").agg(F.max("k").alias("keeper"), F.count("*").alias("rows")).where("rows > 1")
    revisits = long_enough.join(groups, "d").where(~F.col("k").eqNullSafe(F.col("keeper")))
    revisits = revisits.groupBy("k", "d").agg(F.max("keeper").alias("keeper"))
    low, high, size = index.agg(F.min("k"), F.max("k"), F.sum(F.col("n") + 512)).first()
    shards = max(1, -(-(size or 0) // shard_bytes))
    span = -(-((high or 0) - (low or 0) + 1) // shards)
    keyless = F.pmod(F.xxhash64("d"), F.lit(shards)) + shards
    shard = F.coalesce(F.floor((F.col("k") - F.lit(low or 0)) / F.lit(span)), keyless).alias("shard")
    # what a row refers to travels as a row of its own, right before it, so that payloads are shuffled once
    both = revisits.select(shard, "k", "d", F.lit(0).alias("o"), F.lit(None).cast("string").alias("u"),
                           F.lit(None).cast("binary").alias("p"), "keeper").unionByName(
        pages.select(shard, "k", "d", F.lit(1).alias("o"), "u", "p", F.lit(None).cast("long").alias("keeper")))
    order = ("shard", "k", "d", "o", "u")
    dealt = both.repartition(shards, "shard").sortWithinPartitions(*order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, at, keeper, copy, known = _Shards(folder, file_bytes, date), None, None, 0, False
        for batch in batches:
            columns = [batch.column(i) for i in range(batch.num_columns)]
            for i in range(batch.num_rows):
                s, k, d, o, u, p, to = (c[i].as_py() for c in columns)
                if (s, k, d) != at:
                    at, copy, known = (s, k, d), 0, False
                if o == 0:
                    keeper, known = to, True
                    continue
                digest = base64.b32encode(bytes.fromhex(d)).decode()
                again = copy > 0 and len(p) >= revisit_bytes
                refers = keeper if known else k
                out.add(s, _page(k, u, p, digest, refers, copy, known or again, date))
                copy += 1
        out.close()
        if out.closed:
            yield _table(out.closed, _FILES)

    written = stage(dealt.mapInArrow(run, _FILES), "warc-written")
    return _commit(spark, written, folder)


def _commit(spark: SparkSession, written: DataFrame, folder: str) -> DataFrame:
    """Give the reported files their names, then the manifest its own. Every step can be repeated."""

    def rename(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = _open(folder)
        for batch in batches:
            for name, attempt in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if system.get_file_info(f"{root}/{attempt}").type != fs.FileType.NotFound:
                    system.move(f"{root}/{attempt}", f"{root}/{name}")
            yield batch

    manifest = written.select(*_names(_FILES)).mapInArrow(rename, _FILES).drop("attempt")
    manifest.write.parquet(f"{folder}/_manifest.new")
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    system = path(folder).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    # a rename onto a folder would move it inside
    if system.exists(path(f"{folder}/_manifest")) or not system.rename(
        path(f"{folder}/_manifest.new"), path(f"{folder}/_manifest")
    ):
        raise RuntimeError(f"{folder} has a manifest already")
    drop_folder(spark, f"{folder}/_temporary")
    return spark.read.parquet(f"{folder}/_manifest")


def _names(schema: str) -> list[str]:
    return [f.split(" ")[0] for f in schema.split(", ")]


def _members(stream) -> Iterator[tuple[int, bytes]]:
    """Offset and content of each gzip member of a stream."""
    offset, rest = 0, b""
    while True:
        member, parts, size = zlib.decompressobj(31), [], 0
        while not member.eof:
            data = rest or stream.read(_READ_BYTES)
            rest = b""
            if not data:
                if size:
                    raise ValueError(f"the member at {offset} is cut off")
                return
            parts.append(member.decompress(data))
            size += len(data)
        rest = member.unused_data
        yield offset, b"".join(parts)
        offset += size - len(rest)


def _parse(name: str, offset: int, record: bytes, payloads: bool) -> tuple | None:
    head, _, rest = record.partition(b"\r\n\r\n")
    headers = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    kind = headers["WARC-Type"]
    if kind not in ("response", "revisit"):
        return None
    block = rest[: int(headers["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    digest = headers["WARC-Payload-Digest"].removeprefix("sha1:")
    intact = headers["WARC-Block-Digest"] == f"sha1:{_sha1(block)}"
    length = int(re.search(rb"Content-Length: (\d+)", http)[1])
    if kind == "response":
        intact = intact and _sha1(payload) == digest and len(payload) == length
    key, to = headers.get("X-Row-Key"), headers.get("X-Refers-To-Row-Key")
    body = payload if payloads and kind == "response" else None
    return (kind, headers["WARC-Record-ID"], key and int(key), to and int(to), headers.get("WARC-Target-URI"),
            headers["WARC-Date"], length, digest, intact, body, name, offset)


def read(spark: SparkSession, folder: str, payloads: bool = True) -> DataFrame:
    """The response and revisit records of the files that the manifest of `folder` lists."""
    names = spark.read.parquet(f"{folder}/_manifest").select("name")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = _open(folder)
        for batch in batches:
            for name in batch.column(0).to_pylist():
                rows, size = [], 0
                with system.open_input_stream(f"{root}/{name}", compression=None) as stream:
                    for offset, record in _members(stream):
                        if row := _parse(name, offset, record, payloads):
                            rows.append(row)
                            size += len(row[9] or b"") + 500
                        if size >= _READ_BYTES:
                            yield _table(rows, _ROWS)
                            rows, size = [], 0
                if rows:
                    yield _table(rows, _ROWS)

    return names.repartition(max(1, names.count())).mapInArrow(run, _ROWS)


def archive(pages: DataFrame, date: str = "2025-01-01T00:00:00Z") -> DataFrame:
    """Write all pages and read the archives back: one row a page. The archives stay in the shared folder."""
    spark = pages.sparkSession
    folder = new_folder(spark, "warc")
    write(pages, folder, date=date)
    return read(spark, folder, payloads=False).select(
        F.col("key").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to", "url", "intact"
    )
