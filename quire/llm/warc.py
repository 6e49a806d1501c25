"""Operator 5, deterministic sharded WARC writer.

Records ascend by page id, then digest, over shards that are ranges of both (an id, or no id, in a third of all rows is cut by digest), each record is a gzip member of its own, a file is rolled when
its compressed bytes reach a limit, and headers and digests are made anew from the payload.  Dates, record ids and shard
bounds follow from the input and parameters alone, so equal tables give equal archives.  Files are written under
temporary names and renamed; manifest.json, written last, names those that count.

Payloads are shuffled once, to their shard.  Which page a payload refers to is found on ids and digests alone and travels to the shard as a
short row that sorts before the payload's; only rows equal in id and payload stay together, in a stream that keeps none of them.  A very long
payload is held whole, once or twice.

Of records with equal payloads of at least `least` bytes the one of smallest page id is the response and the others
revisit it; shorter ones are all responses.  Null html is an empty payload; null url becomes a urn of the page.  Rows of equal
page id and payload: the first by url is the response and the others revisit it.  Rows without page id come first; they revisit the
smallest id of their payload if there is one, and are responses otherwise.  Columns besides the three are not read.
"""

from __future__ import annotations

import gzip
import hashlib
import json
import uuid
import zlib

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm.common import bound_batches, drop, new_path, open_fs, range_shards, stage, table
from quire.llm.tokenbin import put

LEAST = 100
#: Compressed bytes after which a file is rolled; payload bytes of a shard.
ROLL_BYTES, SHARD_BYTES = 32 << 20, 64 << 20
DATE = "2000-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def record_id(*what) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, json.dumps(what))}>"


def target(url: str | None, page_id: int | None) -> str:
    """A header value: control characters and spaces are percent-encoded."""
    return "".join(c if c > " " and c != "\x7f" else f"%{ord(c):02X}" for c in url) if url else f"urn:page:{page_id}"


def record(kind: str, fields: list[tuple[str, str]], block: bytes) -> bytes:
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in [("WARC-Type", kind), *fields, ("WARC-Block-Digest", f"sha256:{hashlib.sha256(block).hexdigest()}"), ("Content-Length", str(len(block)))])
    return head.encode() + b"\r\n" + block + b"\r\n\r\n"


def page_record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, nth: int, date: str = DATE) -> bytes:
    """A response, or a revisit of page refers_to; nth tells rows of equal id and payload apart."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    fields = [("WARC-Record-ID", record_id(page_id, digest, nth)), ("WARC-Date", date), ("WARC-Target-URI", target(url, page_id)), ("Content-Type", "application/http; msgtype=response"), ("WARC-Payload-Digest", f"sha256:{digest}")]
    if page_id is not None:
        fields.append(("WARC-Page-ID", str(page_id)))
    if refers_to is None:
        return record("response", fields, http + payload)
    return record("revisit", [*fields, ("WARC-Profile", PROFILE), ("WARC-Refers-To", record_id(refers_to, digest, 0)), ("WARC-Refers-To-Page-ID", str(refers_to))], http)


def member(data: bytes, level: int = 6) -> bytes:
    z = zlib.compressobj(level, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush()


def write(pages: DataFrame, root: str, key: str = "page_id", url: str = "url", html: str = "html", least: int = LEAST, roll: int = ROLL_BYTES, shard_bytes: int = SHARD_BYTES, date: str = DATE) -> dict:
    """Write archives to root and return the manifest."""
    spark = pages.sparkSession
    rows = pages.select(F.col(key).cast("long").alias("key"), F.col(url).alias("url"), F.coalesce(F.col(html).cast("binary"), F.lit(b"")).alias("payload"))
    rows = rows.withColumn("digest", F.sha2("payload", 256))
    meta, meta_at = stage(rows.select("key", F.octet_length("payload").alias("size"), "digest"), "warc-meta")
    # 60 leading bits of the digest order as the digest does, and fit a long
    keys = [F.col("key").isNotNull().cast("long"), F.coalesce("key", F.lit(0)), F.conv(F.substring("digest", 1, 15), 16, 10).cast("long")]
    ranges = range_shards(meta, keys, F.col("size") + 200, shard_bytes)
    # Both sides of the join are scans of short rows, so a payload with a third of all rows is split.
    repeated, repeated_at = stage(meta.where(F.col("size") >= least).groupBy("digest").agg(F.min("key").alias("first"), F.count("*").alias("n")).where("n > 1 AND first IS NOT NULL").select("digest", "first"), "warc-repeated")
    marks, marks_at = stage(meta.join(repeated, "digest").select("key", "digest", "first").distinct(), "warc-marks")
    every = marks.select("key", F.lit(None).cast("string").alias("url"), F.lit(None).cast("binary").alias("payload"), "digest", "first")
    every = every.unionByName(rows.withColumn("first", F.lit(None).cast("long")))
    dealt = (
        every.select(ranges.number(keys).alias("shard"), "key", "url", "payload", "digest", "first")
        .repartitionById(ranges.count, F.col("shard"))
        .sortWithinPartitions("shard", F.col("key").asc_nulls_first(), "digest", F.col("first").asc_nulls_last(), F.col("url").asc_nulls_first())
    )
    fs, folder = open_fs(root)
    fs.create_dir(folder, recursive=True)
    kept = pa.schema([("shard", pa.int32()), ("nth", pa.int32()), ("name", pa.string()), ("records", pa.int64()), ("bytes", pa.int64())])

    def save(batches):
        fs, folder = open_fs(root)
        shard, nth, out, temp, records, size, last, same, told = None, 0, None, "", 0, 0, None, 0, (None, None)

        def close():
            out.close()
            name = f"shard-{shard:05d}-{nth:05d}.warc.gz"
            fs.move(temp, f"{folder}/{name}")
            return {"shard": shard, "nth": nth, "name": name, "records": records, "bytes": size}

        for b in batches:
            done = []
            for s, k, u, payload, digest, first in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if payload is None:  # the mark of the rows that follow
                    told = ((k, digest), first)
                    continue
                first = told[1] if told[0] == (k, digest) else None
                if s != shard or size >= roll:
                    if out:
                        done.append(close())
                    nth = nth + 1 if s == shard else 0
                    shard, temp, records, size = s, f"{folder}/.{uuid.uuid4().hex}.tmp", 0, 0
                    out = fs.open_output_stream(temp)
                    info = member(record("warcinfo", [("WARC-Record-ID", record_id("info", s, nth)), ("WARC-Date", date), ("WARC-Filename", f"shard-{s:05d}-{nth:05d}.warc.gz"), ("Content-Type", "application/warc-fields")], b"format: WARC File Format 1.1\r\n"))
                    out.write(info)
                    size += len(info)
                same = same + 1 if last == (k, digest) else 0
                last = (k, digest)
                data = member(page_record(k, u, payload, digest, first if first is not None and (first != k or same) else None, same, date))
                out.write(data)
                size, records = size + len(data), records + 1
            if done:
                yield pa.RecordBatch.from_pylist(done, schema=kept)
        if out:
            yield pa.RecordBatch.from_pylist([close()], schema=kept)

    bound_batches(spark)
    files = sorted((r.asDict() for r in dealt.mapInArrow(save, "shard int, nth int, name string, records long, bytes long").collect()), key=lambda r: (r["shard"], r["nth"]))
    manifest = {"format": "WARC/1.1", "records": sum(f["records"] for f in files), "files": files}
    put(fs, f"{folder}/manifest.json", json.dumps(manifest, sort_keys=True).encode())
    drop(spark, meta_at, repeated_at, marks_at)
    return manifest


def records(stream):
    """(headers with lower-case names, block) of each record of a decompressed stream."""
    while line := stream.readline():
        if not line.startswith(b"WARC/"):
            raise ValueError(f"not a WARC record: {line[:40]!r}")
        head = {}
        while (line := stream.readline()) not in (b"\r\n", b"\n", b""):
            k, _, v = line.decode().partition(":")
            head[k.strip().lower()] = v.strip()
        size = int(head["content-length"])
        block = stream.read(size)
        if len(block) != size or stream.read(4) != b"\r\n\r\n":
            raise ValueError("a record is cut short")
        yield head, block


def read(spark: SparkSession, root: str, key: str = "page_id", payloads: bool = True) -> DataFrame:
    """(key, url, payload_bytes, payload_digest, record_type, refers_to, payload) of each page record; every digest is checked."""
    fs, folder = open_fs(root)
    with fs.open_input_file(f"{folder}/manifest.json") as f:
        files = json.loads(f.read())["files"]
    frame = spark.createDataFrame([(f["name"],) for f in files], "name string").repartition(max(1, len(files)))
    kinds = pa.schema([(key, pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64())] + [("payload", pa.binary())] * payloads)

    def fn(batches):
        fs, folder = open_fs(root)
        for name in (x for b in batches for x in b.column(0).to_pylist()):
            rows, held = [], 0
            with fs.open_input_stream(f"{folder}/{name}", compression=None) as raw, gzip.GzipFile(fileobj=raw) as stream:
                for head, block in records(stream):
                    if head["warc-type"] == "warcinfo":
                        continue
                    if hashlib.sha256(block).hexdigest() != head["warc-block-digest"].removeprefix("sha256:"):
                        raise ValueError(f"{name}: a block has another digest")
                    http, _, payload = block.partition(b"\r\n\r\n")
                    digest = head["warc-payload-digest"].removeprefix("sha256:")
                    if head["warc-type"] == "response" and hashlib.sha256(payload).hexdigest() != digest:
                        raise ValueError(f"{name}: a payload has another digest")
                    size = next(int(x.split(b":")[1]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:"))
                    ids = [int(head[x]) if x in head else None for x in ("warc-page-id", "warc-refers-to-page-id")]
                    rows.append((ids[0], head["warc-target-uri"], size, digest, head["warc-type"], ids[1], *([payload if head["warc-type"] == "response" else None] * payloads)))
                    held += len(payload) * payloads
                    if len(rows) >= 5000 or held > 8 << 20:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds.types, strict=True)], kinds.names)
                        rows, held = [], 0
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds.types, strict=True)], kinds.names)

    return frame.mapInArrow(fn, f"`{key}` long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long" + ", payload binary" * payloads)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = new_path(spark, "warc")
    write(table(spark, sf_dir, "pages"), root)
    return read(spark, root, payloads=False).drop("url")


SQL = """
    WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
    f AS (SELECT payload_digest, min(page_id) AS first FROM p WHERE payload_bytes >= 100 GROUP BY 1)
    SELECT p.page_id, p.payload_bytes::BIGINT AS payload_bytes, p.payload_digest,
    CASE WHEN f.first <> p.page_id THEN 'revisit' ELSE 'response' END AS record_type,
    CASE WHEN f.first <> p.page_id THEN f.first END AS refers_to FROM p LEFT JOIN f USING (payload_digest)
"""
