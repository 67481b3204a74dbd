"""Sharded WARC archives, the same bytes from every run.

Records are sorted by page id and cut into range shards that depend on the ids alone; a
task writes one shard, a gzip member per record, and begins a new file when the compressed
size reaches ``ROLL_BYTES``. Headers are made anew: lengths, block and payload digests,
and record ids, which follow from page id and payload. Records with an equal payload of at
least ``REVISIT_BYTES`` refer to the one of the smallest page id; only digests are grouped
for that, and the decision reaches the writer as a row sorted just before its page. Files
get their names when they are whole, and the manifest lists what counts.
"""

from __future__ import annotations

import hashlib
import itertools
import re
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as S

from tripmill.llm import files

#: Bytes of payload per shard, about, and compressed bytes after which a file is full.
SHARD_BYTES, ROLL_BYTES = 1 << 26, 1 << 23
REVISIT_BYTES = 100
LEVEL = 5
#: Pages carry no time; records get this one.
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_NAMESPACE = uuid.UUID("5b1c8a52-6d5f-4d0e-9a37-2f4c1d8e7a10")

MANIFEST = S.StructType([S.StructField("shard", S.IntegerType()), S.StructField("file", S.StringType()),
                         S.StructField("records", S.LongType()), S.StructField("bytes", S.LongType()),
                         S.StructField("sha256", S.StringType())])
READ = S.StructType([S.StructField("page_id", S.LongType()), S.StructField("url", S.StringType()),
                     S.StructField("record_type", S.StringType()), S.StructField("refers_to", S.LongType()),
                     S.StructField("payload_bytes", S.LongType()), S.StructField("payload_digest", S.StringType()),
                     S.StructField("payload", S.BinaryType())])


def _arrow(schema: S.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


def record_id(page_id, digest: str, copy: int) -> str:
    return f"<urn:uuid:{uuid.uuid5(_NAMESPACE, f'{page_id}/{digest}/{copy}')}>"


def _record(kind: str, headers: list[tuple[str, str | None]], block: bytes) -> bytes:
    lines = [("WARC-Type", kind), *headers, ("WARC-Block-Digest", f"sha256:{hashlib.sha256(block).hexdigest()}"),
             ("Content-Length", str(len(block)))]
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in lines if v is not None) + "\r\n"
    return head.encode() + block + b"\r\n\r\n"


def _uri(url: str | None) -> str | None:
    """A header value: what would end the line, or be trimmed or read as an escape, is escaped."""
    return None if url is None else re.sub(r"[\x00-\x20%\x7f]", lambda m: f"%{ord(m[0]):02X}", url)


def page_record(page_id, url, payload: bytes, digest: str, copy: int, refers_to, date: str, refers_to_url=None) -> bytes:
    kind = "response" if refers_to is None else "revisit"
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    headers = [
        ("WARC-Record-ID", record_id(page_id, digest, copy)), ("WARC-Date", date), ("WARC-Target-URI", _uri(url)),
        ("WARC-Payload-Digest", f"sha256:{digest}"), ("Content-Type", "application/http; msgtype=response"),
        ("X-Page-Id", None if page_id is None else str(page_id)),
    ]
    if kind == "revisit":
        headers += [("WARC-Profile", PROFILE), ("WARC-Refers-To", record_id(refers_to, digest, 0)),
                    ("WARC-Refers-To-Target-URI", _uri(refers_to_url)), ("WARC-Refers-To-Date", date),
                    ("X-Refers-To-Page-Id", str(refers_to))]
        payload = b""
    return _record(kind, headers, http + payload)


def _member(data: bytes, level: int) -> bytes:
    """A gzip member without a time."""
    packer = zlib.compressobj(level, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def _sorted_records(batches, least: int, date: str) -> Iterator[bytes]:
    """Record of every page; rows come by page id, decisions before their pages. ``seen`` and
    ``firsts`` hold what a record refers to: page id and URL of the response of a payload."""
    current, firsts, seen, copies = object(), {}, {}, {}
    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("key", "first", "digest", "url")]
        payloads = batch.column("payload")
        for i, (key, first, digest, url) in enumerate(zip(*columns)):
            if key != current:
                current, firsts, seen, copies = key, {}, {}, {}
            if first is not None:
                firsts[digest] = first, url
                continue
            payload = payloads[i].as_py()
            refers_to, refers_to_url = None, None
            if key is not None and len(payload) >= least:
                # a repeated row of the smallest page id refers to that page, too
                refers_to, refers_to_url = firsts.get(digest, seen.get(digest, (None, None)))
                seen.setdefault(digest, (key, url))
            copy = copies[digest] = copies.get(digest, -1) + 1
            yield page_record(key, url, payload, digest, copy, refers_to, date, refers_to_url)


def _write(batches, folder: str, roll: int, least: int, level: int, date: str, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    batches = (b for b in batches if b.num_rows)
    first = next(batches, None)
    if first is None:
        return
    shard = first.column("shard")[0].as_py()
    records = _sorted_records(itertools.chain([first], batches), least, date)
    record = next(records, None)
    for sequence in itertools.count():
        if record is None:
            return
        name = f"pages-{shard:06d}-{sequence:05d}.warc.gz"
        digest, size, n = hashlib.sha256(), 0, 0
        with files.committed(folder, name) as out:
            block = f"software: tripmill\r\nformat: WARC File Format 1.1\r\nisPartOf: {name}\r\n".encode()
            info = [("WARC-Record-ID", record_id("info", name, 0)), ("WARC-Date", date), ("WARC-Filename", name),
                    ("Content-Type", "application/warc-fields")]
            data = _record("warcinfo", info, block)
            while data is not None:
                member = _member(data, level)
                out.write(member)
                digest.update(member)
                size, n = size + len(member), n + 1
                data = None
                if record is not None and (n == 1 or size < roll):
                    data, record = record, next(records, None)
        row = (shard, name, n - 1, size, digest.hexdigest())
        yield pa.RecordBatch.from_arrays([pa.array([v]) for v in row], names=schema.names).cast(schema)


def write(
    pages: DataFrame,
    folder: str,
    key: str = "page_id",
    url: str = "url",
    html: str = "html",
    shard_bytes: int = SHARD_BYTES,
    roll_bytes: int = ROLL_BYTES,
    revisit_bytes: int = REVISIT_BYTES,
    level: int = LEVEL,
    date: str = DATE,
) -> DataFrame:
    """Write a record per row to ``folder``; returns the manifest, a row per file.

    A null payload is empty. Payloads under ``revisit_bytes`` and those of rows without a
    page id are always responses. Where the smallest page id of a payload has several
    rows, the first of them in order of URL is the response. A null URL has no header,
    neither in its own record nor in those that refer to it. All records carry ``date``.
    An empty table writes an empty manifest. Other columns are ignored. Runs jobs.
    """
    spark = pages.sparkSession
    folder = files.qualified(spark, folder)
    payload = F.coalesce(F.col(html), F.lit("")).cast("binary")
    source = pages.select(
        F.col(key).cast("long").alias("key"), F.col(url).alias("url"), payload.alias("payload"), F.sha2(payload, 256).alias("digest")
    )
    rows, size = source.agg(F.count(F.lit(1)), F.sum(F.octet_length("payload"))).first()
    bounds = files.shard_bounds(source, "key", max(1, -(-(size or 0) // shard_bytes)), rows)

    digests = source.where((F.octet_length("payload") >= revisit_bytes) & F.col("key").isNotNull()).select("key", "digest", "url")
    firsts = digests.groupBy("digest").agg(F.min("key").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    copies = digests.join(firsts.drop("n"), "digest")
    # the URL of the response, null before any other as in the order of the records
    urls = copies.where(F.col("key") == F.col("first")).groupBy("digest").agg(F.min(F.struct("url")).alias("of"))
    decided = copies.where(F.col("key") > F.col("first")).join(urls, "digest").select("key", "digest", "first", F.col("of.url").alias("url"))

    @F.pandas_udf("int")
    def shard_of(ids):
        return ids.isna().map({True: 0, False: 1}) * np.searchsorted(bounds, ids.fillna(0).astype("int64"), side="right")

    manifest_schema = _arrow(MANIFEST)
    (
        source.unionByName(decided, allowMissingColumns=True)
        .withColumn("shard", shard_of("key"))
        .repartitionById(len(bounds) + 1, F.col("shard"))
        .sortWithinPartitions("key", F.col("first").isNull(), "url", "digest")
        .mapInArrow(lambda it: _write(it, folder, roll_bytes, revisit_bytes, level, date, manifest_schema), MANIFEST)
        .write.parquet(f"{folder}/manifest")
    )
    return manifest(spark, folder)


def manifest(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(MANIFEST).parquet(f"{folder}/manifest")


def members(file, chunk: int = 1 << 20) -> Iterator[bytes]:
    """Contents of each gzip member of an open file."""
    unpacker, parts, rest = zlib.decompressobj(31), [], b""
    while True:
        data = rest or file.read(chunk)
        rest = b""
        if not data:
            if parts:
                raise ValueError("the file ends within a record")
            return
        parts.append(unpacker.decompress(data))
        if unpacker.eof:
            rest = unpacker.unused_data
            yield b"".join(parts)
            unpacker, parts = zlib.decompressobj(31), []


def parse(record: bytes) -> tuple[dict[str, str], bytes]:
    """Headers and block of a record; an error where length or block digest don't fit."""
    head, _, rest = record.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    headers = dict(line.split(": ", 1) for line in lines)
    block = rest[: int(headers["Content-Length"])]
    if version != "WARC/1.1" or rest[len(block) :] != b"\r\n\r\n":
        raise ValueError("not a whole WARC record")
    if headers["WARC-Block-Digest"] != f"sha256:{hashlib.sha256(block).hexdigest()}":
        raise ValueError(f"the block of {headers['WARC-Record-ID']} has another digest")
    return headers, block


def _page(headers: dict[str, str], block: bytes) -> tuple:
    http, _, payload = block.partition(b"\r\n\r\n")
    kind, declared = headers["WARC-Type"], headers["WARC-Payload-Digest"].removeprefix("sha256:")
    size = int(re.search(rb"Content-Length: (\d+)", http)[1])
    if kind == "response" and (len(payload) != size or hashlib.sha256(payload).hexdigest() != declared):
        raise ValueError(f"the payload of {headers['WARC-Record-ID']} isn't what its headers say")
    page_id, refers_to, url = (headers.get(h) for h in ("X-Page-Id", "X-Refers-To-Page-Id", "WARC-Target-URI"))
    url = url and re.sub(r"%([0-9A-F]{2})", lambda m: chr(int(m[1], 16)), url)
    return (
        page_id and int(page_id), url, kind, refers_to and int(refers_to), size, declared,
        payload if kind == "response" else None,
    )


def _read(batches, folder: str, schema: pa.Schema, step: int = 1 << 22) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            found, held, n = [], 0, 0
            with files.opened(folder, row["file"]) as file:
                if file.size() != row["bytes"]:
                    raise ValueError(f"{row['file']} isn't as long as the manifest says")
                for record in members(file):
                    headers, block = parse(record)
                    if headers["WARC-Type"] == "warcinfo":
                        continue
                    found.append(_page(headers, block))
                    held, n = held + len(block), n + 1
                    if held >= step:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found), schema.types)], schema=schema)
                        found, held = [], 0
            if n != row["records"]:
                raise ValueError(f"{row['file']} has {n} records, not {row['records']}")
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found), schema.types)], schema=schema)


def read(spark: SparkSession, folder: str) -> DataFrame:
    """Rows of every page record in the files that the manifest lists, all lengths and
    digests checked. The payload of a revisit is null; its size and digest are those of
    the full payload."""
    folder = files.qualified(spark, folder)
    listed = manifest(spark, folder)
    schema = _arrow(READ)
    n = max(1, listed.count())
    return listed.repartition(n, "file").mapInArrow(lambda it: _read(it, folder, schema), READ)
