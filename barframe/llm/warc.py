"""WARC archives: a deterministic sharded writer and a reader.

Records are dealt to shards by ranges of the record key, whose bounds follow from the data alone
(bytes by key block), and sorted within a shard. A shard's task writes files of gzip members, one
record each, and rolls to the next file at ``roll_bytes`` compressed bytes. Headers, record ids and
digests are made anew from the records, with a fixed date, so equal records give equal files byte
for byte. A file is written under a temporary name of the attempt and renamed when whole; a task
that runs again writes the same bytes under the same final name. The manifest (a Parquet table of
the files with their sizes and digests) is written last: files it does not list do not count.

Of records with equal payloads of at least ``min_revisit_bytes``, the one with the smallest key is
a ``response`` and the others are ``revisit`` records that refer to it. Readers resolve a
revisit's payload size by joining on the record it refers to.

The folder has to be reachable by every task through pyarrow's file systems (a shared mount,
hdfs://, s3://, gs://).

Edge cases: a NULL payload or address is the empty one; a NULL key gets the record key ``null``,
sorts first and refers like any other (it is the smallest); repeated rows with one key and payload
share their role and record id; an empty table gives a manifest without files and no records. Only
the named columns are read.
"""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from barframe.plans.workspace import scratch_path

MIN_REVISIT_BYTES = 100
ROLL_BYTES = 32 << 20
SHARD_BYTES = 64 << 20
#: The range of keys is cut into at most so many blocks to find the shards' bounds.
KEY_BLOCKS = 1 << 16
DATE = "2000-01-01T00:00:00Z"
_NAMESPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")
_REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_MANIFEST = "file string, first_key string, last_key string, records bigint, bytes bigint, sha256 string"


def record_id(key: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(_NAMESPACE, key)}>"


def _record(kind: str, key: str | None, content_type: str, block: bytes, more: list[tuple[str, str]]) -> bytes:
    lines = [("WARC-Type", kind), ("WARC-Record-ID", record_id(f"{kind}:{key}")), ("WARC-Date", DATE), *more]
    lines += [
        ("WARC-Block-Digest", f"sha256:{hashlib.sha256(block).hexdigest()}"), ("Content-Type", content_type),
        ("Content-Length", str(len(block))),
    ]
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in lines) + "\r\n"
    return head.encode() + block + b"\r\n\r\n"


def response_record(key: str, url: str, payload: bytes, refers_to: str | None) -> bytes:
    """A response record, or a revisit record when it refers to another key."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    target = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)
    more = [("WARC-Target-URI", target), ("WARC-Payload-Digest", f"sha256:{hashlib.sha256(payload).hexdigest()}"), ("X-Record-Key", key)]
    if refers_to is None:
        return _record("response", key, "application/http;msgtype=response", http + payload, more)
    more += [
        ("WARC-Profile", _REVISIT_PROFILE), ("WARC-Refers-To", record_id(f"response:{refers_to}")),
        ("WARC-Truncated", "length"), ("X-Refers-To-Key", refers_to),
    ]
    return _record("revisit", key, "application/http;msgtype=response", http, more)


def _open_fs(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


def _uri(path: str) -> str:
    """``file:/x`` as Hadoop writes it, in the form that pyarrow reads."""
    return re.sub(r"^file:/+", "file:///", path)


def _writer(folder: str, roll_bytes: int):
    """A mapper from records sorted by shard and key to the rows of the manifest."""

    def batches(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = _open_fs(folder)
        attempt = uuid.uuid4().hex
        state: dict = {"shard": None, "number": 0, "out": None}
        done: list[tuple] = []

        def opened(shard: int) -> None:
            if state["shard"] != shard:
                state.update(shard=shard, number=0)
            name = f"part-{shard:06d}-{state['number']:05d}.warc.gz"
            state.update(
                name=name, temporary=f"{base}/.{name}.{attempt}.tmp", digest=hashlib.sha256(), bytes=0, records=0, first=None, last=None,
            )
            state["out"] = system.open_output_stream(state["temporary"])
            state["number"] += 1
            info = f"software: sharded-writer\r\nformat: WARC File Format 1.1\r\nfile: {name}\r\n".encode()
            put(_record("warcinfo", name, "application/warc-fields", info, [("WARC-Filename", name)]))

        def put(record: bytes) -> None:
            packer = zlib.compressobj(6, zlib.DEFLATED, 31)
            member = packer.compress(record) + packer.flush()
            state["out"].write(member)
            state["digest"].update(member)
            state["bytes"] += len(member)

        def closed() -> None:
            if state["out"] is not None:
                state["out"].close()
                system.move(state["temporary"], f"{base}/{state['name']}")
                done.append((state["name"], state["first"], state["last"], state["records"], state["bytes"], state["digest"].hexdigest()))
                state["out"] = None

        for batch in found:
            for i in range(batch.num_rows):
                shard, key, refers, url, payload = (batch.column(j)[i].as_py() for j in range(5))
                if state["out"] is None or state["shard"] != shard or state["bytes"] >= roll_bytes:
                    closed()
                    opened(shard)
                put(response_record(key, url, payload.encode(), refers))
                state.update(first=state["first"] or key, last=key, records=state["records"] + 1)
        closed()
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done)], names=["file", "first_key", "last_key", "records", "bytes", "sha256"])

    return batches


def write_archives(
    df: DataFrame, folder: str, key_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
    min_revisit_bytes: int = MIN_REVISIT_BYTES, roll_bytes: int = ROLL_BYTES, shard_bytes: int = SHARD_BYTES,
) -> DataFrame:
    """Write every row as a record below ``folder``; returns the manifest."""
    spark = df.sparkSession
    folder = _uri(folder)
    system, base = _open_fs(folder)
    system.create_dir(base, recursive=True)
    key = F.col(key_col)
    rows = df.select(
        key.alias("k"), F.coalesce(F.col(url_col), F.lit("")).alias("url"), F.coalesce(F.col(payload_col), F.lit("")).alias("payload")
    ).withColumn("digest", F.sha2("payload", 256)).withColumn("size", F.octet_length("payload"))

    # Digests and sizes only; of a payload's copies one row is left per task before the shuffle.
    copies = (
        rows.where(F.col("size") >= min_revisit_bytes).groupBy("digest")
        .agg(F.min(F.struct("k")).alias("first"), F.count("*").alias("n")).where(F.col("n") > 1)
        .select(F.col("digest").alias("d"), F.lit(True).alias("copied"), F.col("first.k").alias("first"))
    )
    path = scratch_path(spark, "warc-copies")
    copies.write.parquet(path)
    copies = spark.read.parquet(path)

    low, high, total = df.agg(F.min(key), F.max(key), F.sum(F.octet_length(payload_col))).first()
    numeric = isinstance(low, int)
    width = max((high - low) // KEY_BLOCKS + 1, 1) if numeric else 1
    block = F.coalesce(F.floor((key - F.lit(low)) / F.lit(width)), F.lit(-1)) if numeric else F.lit(0)
    sizes = df.select(block.cast("long").alias("block"), F.octet_length(payload_col).alias("size")).groupBy("block").agg(
        F.sum(F.coalesce("size", F.lit(0)) + 500).alias("bytes")
    )
    # At most KEY_BLOCKS + 1 rows, so one window over all of them is bounded.
    until = F.sum("bytes").over(Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1))
    shards = sizes.select("block", F.floor(F.coalesce(until, F.lit(0)) / F.lit(shard_bytes)).cast("int").alias("shard"))
    path = scratch_path(spark, "warc-shards")
    shards.write.parquet(path)
    shards = spark.read.parquet(path)

    text_key = F.coalesce(F.col("k").cast("string"), F.lit("null"))
    refers = F.when(
        F.col("copied") & (F.col("size") >= min_revisit_bytes) & ~F.col("k").eqNullSafe(F.col("first")),
        F.coalesce(F.col("first").cast("string"), F.lit("null")),
    )
    records = (
        rows.join(copies, F.col("digest") == F.col("d"), "left")
        .withColumn("block", (F.coalesce(F.floor((F.col("k") - F.lit(low)) / F.lit(width)), F.lit(-1)) if numeric else F.lit(0)).cast("long"))
        .join(shards, "block")
        .select("shard", "k", "digest", text_key.alias("key"), refers.alias("refers"), "url", "payload")
        .repartition("shard").sortWithinPartitions("shard", "k", "digest", "url")
    )
    manifest = f"{folder}/manifest"
    records.select("shard", "key", "refers", "url", "payload").mapInArrow(_writer(folder, roll_bytes), _MANIFEST).write.parquet(manifest)
    return spark.read.schema(_MANIFEST).parquet(manifest)


def parse_members(stream) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of each record of a gzipped archive, a record in memory at a time."""
    buffer, packer, plain = b"", zlib.decompressobj(31), bytearray()
    while True:
        if not buffer:
            buffer = stream.read(1 << 20)
            if not buffer:
                if plain:
                    raise ValueError("the archive ends within a record")
                return
        plain += packer.decompress(buffer)
        buffer = b""
        if packer.eof:
            buffer, packer = packer.unused_data, zlib.decompressobj(31)
            head, _, rest = bytes(plain).partition(b"\r\n\r\n")
            version, *lines = head.decode().split("\r\n")
            headers = dict(line.split(": ", 1) for line in lines)
            block = rest[: int(headers["Content-Length"])]
            if not version.startswith("WARC/") or rest[len(block) :] != b"\r\n\r\n":
                raise ValueError("not a whole WARC record")
            if hashlib.sha256(block).hexdigest() != headers["WARC-Block-Digest"].removeprefix("sha256:"):
                raise ValueError(f"block digest of {headers['WARC-Record-ID']} differs")
            yield headers, block
            plain = bytearray()


def read_archives(spark: SparkSession, folder: str, with_payload: bool = False) -> DataFrame:
    """``key, record_id, record_type, url, payload_digest, payload_bytes, refers_to`` of the records listed in the manifest.

    Payload digests of responses are computed anew and compared. ``payload_bytes`` is the full
    payload's size, for revisits too; ``with_payload`` adds the ``payload`` of responses.
    """
    folder = _uri(folder)
    files = spark.read.schema(_MANIFEST).parquet(f"{folder}/manifest")
    # Archives are large though their names are not: a task for each, up to a thousand at a time.
    names = files.select("file").repartition(max(min(files.count(), 1000), 1))

    def batches(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = _open_fs(folder)
        columns = ["key", "record_id", "record_type", "url", "payload_digest", "payload_bytes", "refers_to", *["payload"] * with_payload]
        kinds = [pa.int64() if c == "payload_bytes" else pa.string() for c in columns]

        def made(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=columns)

        for batch in found:
            for name in batch.column(0).to_pylist():
                rows, held = [], 0
                with system.open_input_stream(f"{base}/{name}", compression=None) as stream:
                    for headers, block in parse_members(stream):
                        if headers["WARC-Type"] not in ("response", "revisit"):
                            continue
                        digest = headers["WARC-Payload-Digest"].removeprefix("sha256:")
                        size = payload = None
                        if headers["WARC-Type"] == "response":
                            payload = block.partition(b"\r\n\r\n")[2]
                            size = len(payload)
                            if hashlib.sha256(payload).hexdigest() != digest:
                                raise ValueError(f"payload digest of {headers['WARC-Record-ID']} differs")
                        row = (
                            headers["X-Record-Key"], headers["WARC-Record-ID"], headers["WARC-Type"], headers["WARC-Target-URI"], digest, size,
                            headers.get("X-Refers-To-Key"), *[payload.decode() if payload is not None else None] * with_payload,
                        )
                        rows.append(row)
                        held += len(payload or b"") if with_payload else 0
                        if len(rows) >= 5000 or held > 8 << 20:
                            yield made(rows)
                            rows, held = [], 0
                if rows:
                    yield made(rows)

    schema = "key string, record_id string, record_type string, url string, payload_digest string, payload_bytes bigint, refers_to string"
    records = names.mapInArrow(batches, schema + ", payload string" * with_payload)
    path = scratch_path(spark, "warc-records")
    records.write.parquet(path)
    records = spark.read.parquet(path)
    sizes = records.where("record_type = 'response'").groupBy(F.col("payload_digest").alias("d")).agg(F.max("payload_bytes").alias("full"))
    revisited = records.where("record_type = 'revisit'")
    resolved = revisited.join(sizes, F.col("payload_digest") == F.col("d"), "left").withColumn("payload_bytes", F.col("full")).drop("d", "full")
    return records.where("record_type = 'response'").unionByName(resolved)
