"""WARC archives: a deterministic sharded writer and its reader.

Writing: a first pass counts (id, payload digest) with their bytes and finds for payloads
that occur more than once the record all others refer to.  Shards are ranges of (id,
digest) of about equal bytes, cut where the running sum of the counted bytes passes a
multiple of the shard's share; so they follow from the pages alone, not from samples or
partitions.  A second pass deals whole pages to their shards and sorts them, with the
answers of the first pass sorted in before their page, so pages cross the network
once.  A shard's task writes gzip members, one per record, regenerates headers and
digests from the payload, and starts a new file when the compressed size passes
``roll_bytes``.

Commit: a file is written under a temporary name of its own attempt and renamed to
``shard-N-M.warc.gz`` when complete; a repeated task writes the same bytes under the
same name.  The manifest (file, records, bytes, SHA-256) is a table written last,
and readers only open files it names, so leftovers of lost tasks are never read.
The folder may be on any store that ``pyarrow.fs`` opens by its address (``s3a:`` is ``s3:``).

Defined cases: a null payload is an empty one; null and repeated page ids are kept:
of equal payloads the record with the smallest id (null last) is the response, and
of repeated rows only the first in order; an url that is null or holds blanks or
controls is percent-escaped; an empty table gives an empty manifest and no files;
extra columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from bisect import bisect_right
from urllib.parse import quote

import pandas as pd
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillroll.llm.common import pick
from tillroll.session import materialize

ROLL_BYTES = 64 << 20
SHARD_BYTES, MOST_SHARDS = 16 << 20, 20_000  # a shard's share of payload bytes, which grows beyond so many shards
RECORD_BYTES = 600  # headers of a record
DATE = "2020-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
READ_BYTES = 1 << 20

MANIFEST = "file string, shard int, records long, bytes long, sha256 string"
RECORDS = "page_id long, record_type string, payload_bytes long, payload_digest string, refers_to long, url string"


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _id(page_id: int | None) -> str:
    return "null" if page_id is None else str(page_id)


def _urn(page_id: int | None, key: str, n: int) -> str:
    """Record id: page, beginning of the payload's SHA-256, number among repeated rows."""
    return f"<urn:x-page:{_id(page_id)}:{key[:16]}:{n}>"


def record(page_id: int | None, url: str | None, payload: bytes, key: str, n: int, refers_to: tuple | None) -> bytes:
    """One record as a gzip member; ``refers_to``: None for a response, else (id,) of the response."""
    head = [("WARC-Type", "response" if refers_to is None else "revisit"),
            ("WARC-Record-ID", _urn(page_id, key, n)), ("WARC-Date", DATE),
            ("WARC-Target-URI", quote(url or "", safe="%/:=&?~#+!$,;'@()*[]")),
            ("WARC-Payload-Digest", f"sha1:{digest(payload)}"), ("X-Page-ID", _id(page_id)),
            ("X-Payload-Length", str(len(payload)))]
    body = HTTP
    if refers_to is None:
        body += payload
    else:
        head += [("WARC-Profile", PROFILE), ("WARC-Refers-To", _urn(refers_to[0], key, 0)), ("X-Refers-To-Page-ID", _id(refers_to[0]))]
    head += [("WARC-Block-Digest", f"sha1:{digest(body)}"),
             ("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(body)))]
    text = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head) + "\r\n"
    squeeze = zlib.compressobj(6, zlib.DEFLATED, 31)  # gzip without a time stamp: the same bytes each time
    return squeeze.compress(text.encode() + body + b"\r\n\r\n") + squeeze.flush()


def open_store(address: str) -> tuple[fs.FileSystem, str]:
    """The store of an address and the path on it; addresses may be those that Spark takes."""
    scheme, colon, rest = address.partition(":")
    return fs.FileSystem.from_uri("s3:" + rest if colon and scheme in ("s3a", "s3n") else address)


class _Roll:
    """The files of one shard: temporary name first, final name when complete."""

    def __init__(self, address: str, shard: int, roll_bytes: int):
        self.store, self.folder = open_store(address)
        self.shard, self.roll_bytes, self.files, self.out = shard, roll_bytes, 0, None

    def write(self, data: bytes) -> Iterator[tuple]:
        if self.out is None:
            self.temporary = f"{self.folder}/_temporary/{uuid.uuid4().hex}"
            self.out = self.store.open_output_stream(self.temporary, compression=None)
            self.records, self.bytes, self.sha = 0, 0, hashlib.sha256()
        self.out.write(data)
        self.records, self.bytes = self.records + 1, self.bytes + len(data)
        self.sha.update(data)
        if self.bytes >= self.roll_bytes:
            yield self.close()

    def close(self) -> tuple:
        self.out.close()
        name = f"shard-{self.shard:05d}-{self.files:05d}.warc.gz"
        self.store.move(self.temporary, f"{self.folder}/{name}")
        self.out, self.files = None, self.files + 1
        return name, self.shard, self.records, self.bytes, self.sha.hexdigest()


def _bounds(counted: DataFrame, shards: int | None) -> list[tuple]:
    """The first (no id, id, digest) of each shard, in order: at most ``MOST_SHARDS`` rows come to the driver."""
    width = int(counted.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col("page_id").asc_nulls_last(), F.col("key")]
    weight = F.col("n") * (F.col("size") + RECORD_BYTES)
    total = counted.agg(F.sum(weight)).first()[0] or 0
    share = -(-total // (shards or max(1, min(MOST_SHARDS, -(-total // SHARD_BYTES))))) or 1
    ranged = materialize(counted.select("page_id", "key", weight.alias("bytes")).repartitionByRange(width, *order)
                         .withColumn("range", F.spark_partition_id()), "page_ranges")
    upto = F.coalesce(F.sum("bytes").over(Window.partitionBy("range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ends = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)  # one row per range
    offsets = ranged.groupBy("range").agg(F.sum("bytes").alias("bytes")).select("range", F.coalesce(F.sum("bytes").over(ends), F.lit(0)).alias("offset"))
    begins = (ranged.withColumn("upto", upto).join(F.broadcast(offsets), "range")
              .groupBy(F.floor((F.col("offset") + F.col("upto")) / share).alias("shard"))
              .agg(F.min(F.struct(F.col("page_id").isNull().alias("none"), F.coalesce("page_id", F.lit(0)).alias("id"), "key")).alias("first")))
    return [(bool(r["first"]["none"]), r["first"]["id"], r["first"]["key"]) for r in begins.orderBy("shard").select("first").collect()]


def write(pages: DataFrame, folder: str, shards: int | None = None, roll_bytes: int = ROLL_BYTES,
          revisit_bytes: int = 0) -> DataFrame:
    """Write a record for each page below ``folder`` and return the committed manifest.

    Payloads of at least ``revisit_bytes`` bytes that occur again become revisit records.
    ``shards``: how many at most; by default as many as the bytes ask for.
    """
    spark = pages.sparkSession
    rows = pick(pages, "page_id", "url", "html").select(
        F.col("page_id").cast("long").alias("page_id"), "url", F.coalesce("html", F.lit("")).alias("html"))
    rows = rows.withColumn("key", F.sha2("html", 256))
    order = F.struct(F.col("page_id").isNull().alias("none"), "page_id")

    counted = materialize(rows.groupBy("key", "page_id").agg(F.count("*").alias("n"), F.max(F.octet_length("html")).alias("size")), "payloads")
    bounds = _bounds(counted, shards)
    slim = counted.filter(F.col("size") >= revisit_bytes)
    groups = materialize(slim.groupBy("key").agg(F.min(order).alias("first"), F.sum("n").alias("n"))
                         .filter("n > 1").select("key", F.col("first.page_id").alias("first")), "repeated")
    answers = slim.select("key", "page_id").join(groups, "key").select(
        "page_id", "key", F.lit(0).alias("kind"), F.lit(None).cast("string").alias("url"),
        F.lit(None).cast("string").alias("html"), "first")
    everything = rows.select("page_id", "key", F.lit(1).alias("kind"), "url", "html",
                             F.lit(None).cast("long").alias("first")).unionByName(answers)
    by = [F.col("page_id").asc_nulls_last(), F.col("key"), F.col("kind"), F.col("url")]

    @F.pandas_udf("int")
    def shard_of(page_id: pd.Series, key: pd.Series) -> pd.Series:
        return pd.Series([bisect_right(bounds, (none, 0 if none else int(i), k)) - 1
                          for none, i, k in zip(page_id.isna(), page_id, key, strict=True)], dtype="int32")

    # rows of one id and payload are of one shard, so that an answer lies before its pages
    dealt = (everything.withColumn("shard", shard_of(F.col("page_id").cast("decimal(20,0)"), "key")).repartition("shard")
             .sortWithinPartitions("shard", *by).select("page_id", "key", "kind", "url", "html", "first", "shard"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        roll, at, first, n = None, None, None, 0
        done: list[tuple] = []
        for batch in batches:
            for i in range(batch.num_rows):
                page_id, key, kind, url, html, target, shard = (batch.column(c)[i].as_py() for c in range(7))
                if roll is None or shard != roll.shard:
                    if roll is not None and roll.out is not None:
                        done.append(roll.close())
                    roll = _Roll(folder, shard, roll_bytes)
                if (page_id, key) != at:
                    at, first, n = (page_id, key), None, 0
                if kind == 0:
                    first = (target,)
                    continue
                mine = first is None or (first == (page_id,) and n == 0)
                done += roll.write(record(page_id, url, html.encode(), key, n, None if mine else first))
                n += 1
        if roll is not None and roll.out is not None:
            done.append(roll.close())
        columns = zip(*done, strict=True) if done else [[]] * 5
        types = (pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.string())
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)],
                                         ["file", "shard", "records", "bytes", "sha256"])

    store, path = open_store(folder)
    store.create_dir(f"{path}/_temporary", recursive=True)
    dealt.mapInArrow(run, MANIFEST).write.parquet(f"{folder}/manifest")
    store.delete_dir(f"{path}/_temporary")  # what lost attempts have left
    return spark.read.parquet(f"{folder}/manifest")


def _members(stream, size: int = READ_BYTES) -> Iterator[bytes]:
    """The gzip members of a stream, one at a time."""
    inflate, parts = zlib.decompressobj(31), []
    data = stream.read(size)
    while data:
        parts.append(inflate.decompress(data))
        if inflate.eof:
            yield b"".join(parts)
            data, inflate, parts = inflate.unused_data, zlib.decompressobj(31), []
            data = data or stream.read(size)
        else:
            data = stream.read(size)


def parse(member: bytes) -> tuple[dict[str, str], bytes]:
    """Headers and content block of a record; raises if lengths or digests don't hold."""
    head, _, rest = member.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError(f"no WARC record: {lines[0][:40]!r}")
    fields = dict(line.split(": ", 1) for line in lines[1:])
    block = rest[:int(fields["Content-Length"])]
    if rest[len(block):] != b"\r\n\r\n" or fields["WARC-Block-Digest"] != f"sha1:{digest(block)}":
        raise ValueError(f"broken record {fields['WARC-Record-ID']}")
    return fields, block


def read(spark: SparkSession, folder: str, manifest: DataFrame | None = None) -> DataFrame:
    """The records of the files that the manifest names; see ``RECORDS``.

    Length and digest of a response come from its payload, those of a revisit from
    its headers.
    """
    manifest = spark.read.parquet(f"{folder}/manifest") if manifest is None else manifest
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, path = open_store(folder)
        for batch in batches:
            for name in batch.column(0).to_pylist():
                out: list[tuple] = []
                with store.open_input_stream(f"{path}/{name}", compression=None) as stream:
                    for member in _members(stream):
                        out.append(_row(*parse(member)))
                        if len(out) >= 1000:
                            yield _rows(out)
                            out = []
                yield _rows(out)

    return manifest.select("file").repartition(width, "file").mapInArrow(run, RECORDS)


def _number(text: str) -> int | None:
    return None if text == "null" else int(text)


def _row(fields: dict[str, str], block: bytes) -> tuple:
    page_id, kind = _number(fields["X-Page-ID"]), fields["WARC-Type"]
    if kind == "response":
        payload = block.partition(b"\r\n\r\n")[2]
        size, name, refers = len(payload), digest(payload), None
        if fields["WARC-Payload-Digest"] != f"sha1:{name}":
            raise ValueError(f"broken payload {fields['WARC-Record-ID']}")
    else:
        size, name = int(fields["X-Payload-Length"]), fields["WARC-Payload-Digest"].removeprefix("sha1:")
        refers = _number(fields["X-Refers-To-Page-ID"])
    return page_id, kind, size, name, refers, fields["WARC-Target-URI"]


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    types = (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string())
    columns = zip(*rows, strict=True) if rows else [[]] * 6
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)],
                                      ["page_id", "record_type", "payload_bytes", "payload_digest", "refers_to", "url"])
