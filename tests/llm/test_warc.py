import gzip
import hashlib
import os
import uuid

from lexweave.llm import warc
from lexweave.llm.common import shared_dir


def expected(rows):
    first = {}
    for p, _, h in rows:
        b = (h or "").encode()
        if p is not None:
            first[b] = min(first.get(b, p), p)
    return first


def test_round_trip_and_determinism(spark, monkeypatch):
    monkeypatch.setattr(warc, "SHARD_BYTES", 3000)
    monkeypatch.setattr(warc, "ROLL_BYTES", 900)
    rows = [(i * 3, f"http://h/{i}", f"<p>page {i % 40} é\n" + "x" * (i % 40 * 9)) for i in range(150)]
    rows += [(1000, None, None), (1001, "u", ""), (1002, "u", "short"), (1003, "u", "short"), (10**15, "far", "y" * 5000), (None, "n", "z" * 300), (1002, "u", "a" * 200), (1002, "u", "a" * 200)]
    pages = spark.createDataFrame([(*r, 1) for r in rows], "page_id long, url string, html string, payload int")
    files = []
    for k in (3, 5):
        out = f"{shared_dir(spark)}/w-{uuid.uuid4().hex}"
        got = warc.read(spark, warc.write(spark, pages.repartition(k), out)).collect()
        root = out.removeprefix("file:")
        files.append({n: hashlib.sha256(open(f"{root}/{n}", "rb").read()).hexdigest() for n in os.listdir(root) if n.endswith(".warc.gz")})
        assert not [n for n in os.listdir(root) if n.startswith(".tmp")]
    assert files[0] == files[1] and len(files[0]) > 5
    assert len(got) == len(rows)
    first = expected(rows)
    by = {}
    for r in got:
        by.setdefault(r["page_id"], []).append(r)
    for p, url, h in rows:
        b = (h or "").encode()
        r = next(x for x in by[p] if x["payload_digest"] == hashlib.sha256(b).hexdigest())
        assert r["payload_bytes"] == len(b) and r["url"] == (url or "")
        if p in (1002, None):
            continue
        revisit = len(b) >= 100 and first[b] != p
        assert r["record_type"] == ("revisit" if revisit else "response") and r["refers_to"] == (first[b] if revisit else None)
        assert r["payload"] is None if revisit else bytes(r["payload"]) == b
    assert sorted(x["record_type"] for x in by[1002] if x["payload_bytes"] == 200) == ["response", "revisit"]


def test_records_are_gzip_members():
    data = warc.record(7, "http://x", b"hello", 5, "d" * 64, None, None) + warc.record(8, "http://y", None, 5, "d" * 64, 7, "http://x")
    assert gzip.decompress(data).count(b"WARC/1.1") == 2
    (a, block), (b, _) = warc.parse(data)
    assert a["WARC-Type"] == "response" and block.endswith(b"hello") and b["X-Refers-To-Page-ID"] == "7"


def test_empty(spark):
    out = f"{shared_dir(spark)}/w-{uuid.uuid4().hex}"
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.read(spark, warc.write(spark, pages, out)).count() == 0
