import random

import numpy as np
import xxhash
from pyspark.sql import functions as F

from lexweave.llm import simhash
from lexweave.llm.components import components


def plain_fingerprint(text):
    import re

    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(len(words) - 3)] or [" ".join(words)]
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def brute_components(fp):
    up = {i: i for i in fp}

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    ids = sorted(fp)
    for i in ids:
        for j in ids:
            if i < j and (fp[i] ^ fp[j]).bit_count() <= 4:
                a, b = root(i), root(j)
                up[max(a, b)] = min(a, b)
    return {i: root(i) for i in ids}


def test_fingerprint_equals_definition():
    for text in (None, "", " \t\n", "One", "a b c d", "A b C d e É É é", "x " * 20000, "word one two\x0bthree\x0cfour five six"):
        assert simhash.fingerprint(text) % (1 << 64) == plain_fingerprint(text)


def test_forest_keeps_every_component():
    rng = random.Random(5)
    for spread in (3, 8, 64):
        centres = [rng.getrandbits(64) for _ in range(12)]
        points = list({c ^ sum(1 << rng.randrange(spread if spread < 64 else 64) for _ in range(rng.randrange(7))) & (2**64 - 1) for c in centres for _ in range(120)})
        got = simhash.vantage_links(np.array(points, np.uint64))
        assert all((points[i] ^ points[j]).bit_count() <= 4 for i, j in got)
        want = brute_components(dict(enumerate(points)))
        up = {i: i for i in range(len(points))}
        for _ in range(40):
            for i, j in got:
                up[i] = up[j] = min(up[i], up[j])
        assert all((want[i] == want[j]) == (up[i] == up[j]) for i in range(len(points)) for j in range(0, len(points), 7))


def test_components(spark):
    edges = [(1, 2), (2, 3), (5, 4), (9, 8), (8, 7), (7, 6), (6, 10), (3, 11), (12, 12)] + [(100, 100 + i) for i in range(50)]
    got = {r["node"]: r["component"] for r in components(spark, spark.createDataFrame(edges, "a long, b long")).collect()}
    assert {k: got[k] for k in (1, 2, 3, 11)} == {1: 1, 2: 1, 3: 1, 11: 1}
    assert {got[k] for k in (6, 7, 8, 9, 10)} == {6} and {got[100 + i] for i in range(50)} == {100} and 12 not in got
    assert components(spark, spark.createDataFrame([], "a long, b long")).count() == 0


def corpus(rng):
    rows = []
    base = [" ".join(rng.choice("abcdefghij") * rng.randrange(1, 6) for _ in range(rng.randrange(1, 200))) for _ in range(30)]
    for i in range(200):
        words = rng.choice(base).split()
        for _ in range(rng.choice([0, 0, 1, 2, 30])):
            words[rng.randrange(len(words))] = "changed"
        rows.append((i, " ".join(words), rng.randrange(3)))
    return rows + [(300, None, 1), (301, "", 1), (302, " \n", 1), (5, rows[5][1], 7), (None, "alone in the world of words", 0), (None, rows[3][1], 0), (400, "x " * 30000, 0)]


def test_near_duplicates_against_brute_force(spark, monkeypatch):
    rows = corpus(random.Random(3))
    want_fp = {i: plain_fingerprint(t) for i, t, _ in rows if i is not None}
    want = brute_components(want_fp)
    docs = spark.createDataFrame(rows, "doc_id long, text string, component_id int").repartition(3)
    for most, aim in ((20000, 1500), (12, 4)):
        monkeypatch.setattr(simhash, "SHARD_MOST", most)
        monkeypatch.setattr(simhash, "SHARD_AIM", aim)
        got = simhash.near_duplicates(spark, docs).collect()
        assert len(got) == len(rows)
        for r in got:
            if r["doc_id"] is not None:
                assert r["fingerprint"] == f"{want_fp[r['doc_id']]:016x}" and r["component_id"] == want[r["doc_id"]]
    lone = plain_fingerprint("alone in the world of words")
    assert [r["component_id"] for r in got if r["doc_id"] is None and r["fingerprint"] == f"{lone:016x}"] == [None]
    kept = {r["doc_id"] for r in simhash.keep_one(spark, docs).collect()}
    assert kept - {None} == set(want.values())


def test_empty(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert simhash.near_duplicates(spark, docs).count() == 0
    assert simhash.near_duplicates(spark, docs.select(F.lit(1).cast("long").alias("doc_id"), F.lit("a").alias("text"))).columns == ["doc_id", "fingerprint", "component_id"]


def test_classes_without_an_id_do_not_join_others(spark, monkeypatch):
    codes = {"a": 0, "near a": 1, "b": (1 << 40) - 1, "near b": (1 << 40) - 2, "alone": 0x5555 << 44}
    monkeypatch.setattr(simhash, "add_columns", lambda df, inputs, fields, fn: df.select("*", F.coalesce(*[F.when(F.col("text") == t, F.lit(fp).cast("long")) for t, fp in codes.items()]).alias("fp")))
    docs = spark.createDataFrame([(1, "a"), (None, "near a"), (2, "b"), (None, "near b"), (None, "alone")], "doc_id long, text string")
    got = {r["fingerprint"]: r["component_id"] for r in simhash.near_duplicates(spark, docs).collect()}
    assert {t: got[f"{fp:016x}"] for t, fp in codes.items()} == {"a": 1, "near a": 1, "b": 2, "near b": 2, "alone": None}
    assert sorted(r["doc_id"] for r in simhash.keep_one(spark, docs).collect() if r["doc_id"]) == [1, 2]


def test_shards_stay_small_whatever_the_codes(spark, monkeypatch):
    """Codes that agree on their first 13 bits, and on 26 others: the blocks that agree are split on the bits that are left."""
    rng = random.Random(8)
    common = rng.getrandbits(39)
    codes = list({common << 25 | rng.getrandbits(25) for _ in range(1500)})
    codes += [c ^ 1 << rng.randrange(64) ^ 1 << rng.randrange(64) for c in codes[:100]]
    codes = list(dict.fromkeys(codes))
    signed = [(i, c - (1 << 64) if c >> 63 else c) for i, c in enumerate(codes)]
    for most, aim in ((50, 20), (300, 100), (20000, 1500)):
        monkeypatch.setattr(simhash, "SHARD_MOST", most)
        monkeypatch.setattr(simhash, "SHARD_AIM", aim)
        placed = simhash.shards(spark, spark.createDataFrame(signed, "id long, fp long"), simhash.Scratch(spark, "test"))
        members = {}
        for r in placed.collect():
            members.setdefault(r["shard"], set()).add(r["id"])
        assert max(map(len, members.values())) <= max(most, aim)
        met = {(i, j) for m in members.values() for i in m for j in m if i < j and (codes[i] ^ codes[j]).bit_count() <= 4}
        near = np.array(codes, np.uint64)
        want = {(i, int(j)) for i in range(len(codes)) for j in np.flatnonzero(np.bitwise_count(near ^ near[i]) <= 4) if i < j}
        assert met == want and want


def test_columns_of_our_names_and_repeated_rows(spark):
    text = "one two three four five six"
    rows = [(1, text, "x", 1), (1, text, "x", 1), (2, text, None, 2), (None, text, "y", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _extra string, fingerprint int")
    kept = sorted(simhash.keep_one(spark, docs).collect(), key=str)
    assert [(r["doc_id"], r["_extra"]) for r in kept] == [(1, "x"), (1, "x"), (None, "y")] and kept[0].__fields__ == docs.columns
