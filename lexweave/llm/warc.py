"""WARC archives: a deterministic sharded writer, and a reader.

Writing: rows are cut into shards by ranges of page_id. The range bounds come from an exact, deterministic histogram of
CELLS equal cells between the smallest and largest id (a bounded result), refined where one cell is too heavy; each
shard is sorted by (page_id, digest) and written as files of gzip members, one record each, rolled when the compressed
size reaches ROLL_BYTES. Record headers, ids and digests are made anew from the content, so a rerun gives the same
bytes. Each file is written under a temporary name that is unique to the task attempt and renamed when complete; the
manifest, which lists every file with its digest, is written last under a temporary name too, and the reader reads only
what a manifest lists. A lost executor's attempt leaves temporary names that no manifest mentions.

Of records with equal payloads of at least SHARED_BYTES, the one with the smallest page_id is a response and the others
are revisits without payload; smaller ones are all responses.

Defined cases: a null html is an empty payload; a null url is written as an empty target; null page ids come last and
carry no id header; repeated rows (same id and html) each give a record, the first a response and the rest revisits; an
empty table gives an empty manifest. Extra columns are not archived.
"""

from __future__ import annotations

import gzip
import hashlib
import io
import json
import os
import uuid
import zlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, shared_dir, steps, table

CELLS = 16384
SHARD_BYTES = 16 << 20
#: At most about so many shards; beyond that they grow.
MOST_SHARDS = 4096
ROLL_BYTES = 8 << 20
SHARED_BYTES = 100
DATE = "1970-01-01T00:00:00Z"
LAST = (1 << 63) - 1


def filesystem(uri: str):
    """A file system for the shared folder, from executors too, and the path in it."""
    from pyarrow import fs

    if "://" not in uri and not uri.startswith("file:"):
        return fs.LocalFileSystem(), uri
    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    return fs.FileSystem.from_uri(uri)


def record(page_id: int | None, url: str | None, payload: bytes | None, size: int, digest: str, refers_to: int | None, refers_url: str | None) -> bytes:
    """One record as a gzip member; the id is derived from page, digest and kind."""
    revisit = payload is None
    name = uuid.UUID(bytes=hashlib.sha256(f"{page_id}:{digest}:{refers_to}".encode()).digest()[:16])
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % size
    if not revisit:
        block += payload
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: <urn:uuid:{name}>", f"WARC-Date: {DATE}"]
    head.append("WARC-Target-URI: " + (url or "").replace("\r", "%0D").replace("\n", "%0A"))
    head.append(f"WARC-Block-Digest: sha256:{hashlib.sha256(block).hexdigest()}")
    head.append(f"WARC-Payload-Digest: sha256:{digest}")
    head.append("Content-Type: application/http; msgtype=response")
    if page_id is not None:
        head.append(f"X-Page-ID: {page_id}")
    head.append(f"X-Payload-Length: {size}")
    if revisit:
        head.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        head.append("WARC-Refers-To-Target-URI: " + (refers_url or "").replace("\r", "%0D").replace("\n", "%0A"))
        if refers_to is not None:
            head.append(f"X-Refers-To-Page-ID: {refers_to}")
    head.append(f"Content-Length: {len(block)}")
    text = "\r\n".join(head).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + block + b"\r\n\r\n"
    out = io.BytesIO()
    with gzip.GzipFile(fileobj=out, mode="wb", compresslevel=4, mtime=0) as z:
        z.write(text)
    return out.getvalue()


def parse(data: bytes):
    """Yield (headers, block) of each gzip member; block digests are verified."""
    at, view = 0, memoryview(data)
    while at < len(data):
        z, parts = zlib.decompressobj(31), []
        while not z.eof and at < len(data):  # by pieces: what is left over is copied
            parts.append(z.decompress(view[at : at + 8192]))
            at += min(8192, len(data) - at)
        at -= len(z.unused_data)
        text = b"".join(parts)
        head, _, rest = text.partition(b"\r\n\r\n")
        rows = head.decode("utf-8", "surrogatepass").split("\r\n")
        headers = dict(x.split(": ", 1) if ": " in x else (x.rstrip(":"), "") for x in rows[1:])
        block = rest[: int(headers["Content-Length"])]
        if headers["WARC-Block-Digest"] != "sha256:" + hashlib.sha256(block).hexdigest():
            raise ValueError(f"digest of {headers['WARC-Record-ID']} does not match its block")
        yield headers, block


def _shards(keyed: DataFrame) -> list[tuple[int, int]]:
    """Upper id bounds (inclusive) of the shards, at least SHARD_BYTES each; at most CELLS rows reach the driver at once."""

    total = keyed.agg(F.sum("size")).first()[0] or 0
    heavy = max(SHARD_BYTES, total // MOST_SHARDS)

    def cut(low: int, high: int, depth: int) -> list[int]:
        width = max(1, -(-(high - low + 1) // CELLS))
        cell = F.floor((F.col("_pid") - F.lit(low)) / F.lit(width)) if width > 1 else F.col("_pid") - F.lit(low)
        rows = keyed.filter(F.col("_pid").between(low, high)).groupBy(cell.cast("long").alias("c")).agg(F.sum("size").alias("b")).orderBy("c").collect()
        bounds, held = [], 0
        for r in rows:
            if r["b"] > heavy and width > 1 and depth < 4:
                if held:
                    bounds.append(low + r["c"] * width - 1)
                bounds += cut(low + r["c"] * width, min(high, low + (r["c"] + 1) * width - 1), depth + 1)
                held = 0
                continue
            held += r["b"]
            if held >= heavy:
                bounds.append(min(high, low + (r["c"] + 1) * width - 1))
                held = 0
        return bounds

    ends = keyed.filter(F.col("_pid") < LAST).agg(F.min("_pid"), F.max("_pid")).first()
    return sorted(set(cut(ends[0], ends[1], 0))) if ends[0] is not None else []


def write(spark: SparkSession, pages: DataFrame, out: str) -> str:
    """Archive (page_id, url, html) under the folder out; returns the path of the manifest."""
    scratch = Scratch(spark, "warc")
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select("page_id", "url", F.coalesce(F.col("page_id").cast("long"), F.lit(LAST)).alias("_pid"), payload.alias("payload"))
    rows = rows.withColumn("size", F.length("payload").cast("long")).withColumn("digest", F.sha2("payload", 256))
    keyed = scratch.cut(rows.select("_pid", "url", "size", "digest"))
    same = keyed.filter(F.col("size") >= SHARED_BYTES).groupBy("digest").agg(F.min(F.struct("_pid", F.coalesce("url", F.lit("")).alias("url"))).alias("first"), F.count("*").alias("n")).filter("n > 1")
    same = same.select(F.col("digest").alias("_digest"), F.col("first._pid").alias("_first"), F.col("first.url").alias("_first_url"))
    bounds = _shards(keyed)
    shard = F.size(F.filter(F.from_json(F.lit(json.dumps(bounds)), "array<bigint>"), lambda b: b < F.col("_pid")))
    # Payloads are shuffled once: what was decided about a page travels in rows of its own, sorted ahead of its payload.
    decided = keyed.join(same, keyed["digest"] == same["_digest"]).select("_pid", "digest", "_first", "_first_url").distinct()
    decided = decided.select(*[F.lit(None).cast(rows.schema[c].dataType).alias(c) for c in ("page_id", "url", "size", "payload")], "_pid", "digest", "_first", "_first_url")
    payloads = rows.select("page_id", "url", "size", "payload", "_pid", "digest", F.lit(None).cast("long").alias("_first"), F.lit(None).cast("string").alias("_first_url"))
    placed = decided.unionByName(payloads).withColumn("shard", shard)
    placed = placed.repartitionById(len(bounds) + 1, F.col("shard")).sortWithinPartitions("shard", "_pid", "digest", F.col("_first").asc_nulls_last(), "url")

    def run(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        disk, root = filesystem(out)
        attempt = TaskContext.get().taskAttemptId()
        made: list[tuple] = []
        now = None  # shard, number, stream, temporary name, digest, size, records, first id, last id

        def close():
            nonlocal now
            if now:
                now["stream"].close()
                name = f"part-{now['shard']:06d}-{now['number']:05d}.warc.gz"
                if disk.get_file_info(f"{root}/{name}").is_file:
                    disk.delete_file(f"{root}/{name}")
                disk.move(now["temp"], f"{root}/{name}")
                made.append((name, now["shard"], now["number"], now["n"], now["size"], now["digest"].hexdigest()))
                now = None

        number, shard = 0, None
        of, first, first_url, begun = None, None, None, False
        for batch in steps(batches, "payload"):
            for r in batch.to_pylist():
                if r["_first"] is not None:
                    of, first, first_url, begun = (r["_pid"], r["digest"]), r["_first"], r["_first_url"], False
                    continue
                revisit = of == (r["_pid"], r["digest"]) and (first != r["_pid"] or begun)
                begun = True
                if r["shard"] != shard:
                    close()
                    shard, number = r["shard"], 0
                if now is None:
                    temp = f"{root}/.tmp-{attempt}-{uuid.uuid4().hex}"
                    now = {"shard": shard, "number": number, "temp": temp, "stream": disk.open_output_stream(temp), "digest": hashlib.sha256(), "size": 0, "n": 0}
                    number += 1
                told = (None, first if first < LAST else None, first_url) if revisit else (r["payload"], None, None)
                data = record(r["page_id"], r["url"], told[0], r["size"], r["digest"], *told[1:])
                now["stream"].write(data)
                now["digest"].update(data)
                now["size"] += len(data)
                now["n"] += 1
                if now["size"] >= ROLL_BYTES:
                    close()
        close()
        yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in made], t) for i, t in enumerate([pa.string(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.string()])], names=["name", "shard", "number", "records", "bytes", "sha256"])

    disk, root = filesystem(out)
    disk.create_dir(root, recursive=True)
    files = placed.mapInArrow(run, "name string, shard int, number int, records long, bytes long, sha256 string").collect()  # one row a file
    listing = [r.asDict() for r in sorted(files, key=lambda r: r["name"])]
    temp, final = f"{root}/.tmp-manifest-{uuid.uuid4().hex}", f"{root}/manifest.json"
    with disk.open_output_stream(temp) as f:
        f.write("".join(json.dumps(x) + "\n" for x in listing).encode())
    if disk.get_file_info(final).is_file:
        disk.delete_file(final)
    disk.move(temp, final)
    for left in disk.get_file_info(__import__("pyarrow").fs.FileSelector(root)):
        if os.path.basename(left.path).startswith(".tmp-"):
            disk.delete_file(left.path)
    scratch.drop(keyed)
    return f"{out}/manifest.json"


def read(spark: SparkSession, manifest: str) -> DataFrame:
    """One row per record of the files that a manifest lists; payload is null for revisits. Digests are verified."""
    schema = "name string, shard int, number int, records long, bytes long, sha256 string"
    root = manifest.rpartition("/")[0]
    files = spark.read.schema(schema).json(manifest)
    found = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.gz").load(root)
    listed = files.select(F.col("name").alias("_name"), F.col("sha256").alias("_sha256"))
    found = found.withColumn("_file", F.element_at(F.split("path", "/"), -1)).join(listed, F.col("_file") == F.col("_name")).select("content", "_file", "_sha256")

    def run(batches):
        import pyarrow as pa

        fields = [("page_id", pa.int64()), ("url", pa.string()), ("payload", pa.binary()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64())]
        for batch in batches:
            for content, name, digest in zip(*(batch.column(i) for i in range(3)), strict=True):
                data = content.as_buffer().to_pybytes()
                if hashlib.sha256(data).hexdigest() != digest.as_py():
                    raise ValueError(f"{name.as_py()} differs from its manifest")
                rows, held = [], 0
                for head, block in parse(data):
                    kind = head["WARC-Type"]
                    body = block.partition(b"\r\n\r\n")[2] if kind == "response" else None
                    size, sha = int(head["X-Payload-Length"]), head["WARC-Payload-Digest"].removeprefix("sha256:")
                    if body is not None and (len(body) != size or hashlib.sha256(body).hexdigest() != sha):
                        raise ValueError(f"payload of {head['WARC-Record-ID']} does not match its header")
                    page, other = head.get("X-Page-ID"), head.get("X-Refers-To-Page-ID")
                    rows.append((page and int(page), head["WARC-Target-URI"], body, size, sha, kind, other and int(other)))
                    held += len(block)
                    if held > 4 << 20:
                        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, (_, t) in enumerate(fields)], names=[n for n, _ in fields])
                        rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, (_, t) in enumerate(fields)], names=[n for n, _ in fields])

    return found.mapInArrow(run, "page_id long, url string, payload binary, payload_bytes long, payload_digest string, record_type string, refers_to long")


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = f"{shared_dir(spark).rstrip('/')}/warc-{uuid.uuid4().hex}"
    manifest = write(spark, table(spark, sf_dir, "pages"), out)
    return read(spark, manifest).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


SQL_OP4 = """
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, '')))::BIGINT AS n, sha256(coalesce(html, '')) AS d FROM pages),
f AS (SELECT *, min(page_id) OVER (PARTITION BY d) AS first FROM p)
SELECT page_id, n AS payload_bytes, d AS payload_digest,
  CASE WHEN n >= 100 AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN n >= 100 AND page_id <> first THEN first END AS refers_to
FROM f
"""
