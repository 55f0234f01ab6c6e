"""SimHash near-duplicates with vantage-point trees.

Fingerprints. A text's A-Z are lower-cased, it is cut at ASCII white space, and each run of SHINGLE words, joined by one
space, is hashed with XXH64 (seed 42). A bit of the fingerprint is set if over half the hashes have it. A shorter text
gives one hash of all its words; a text without words has fingerprint zero.

Links. Only distinct fingerprints are compared. Fingerprints are partitioned by Hamming distance to vantage points, and by the
triangle bound |d(x, v) - d(y, v)| <= d(x, y) only shards that the bound lets meet are searched. On all 64 bits the bound prunes
nothing: distances of unrelated codes to any point spread by only 4 around 32, as much as the radius. So the bits
are cut into PARTS = RADIUS + 1 blocks: two codes within RADIUS agree on a block at least, their distance counted on
that block alone is 0, and so are the differences of their distances to every vantage point there. In each block a code's shard is the
list of its distances to some vantage points; with a bound of 0 no shard overlaps another, and close codes meet in a shard of
a block where they agree. The number of vantage points grows with the number of fingerprints; under SHARD_AIM all are one
shard. A shard of more than SHARD_MOST is split the same way on the bits outside its block, where its close pairs
still differ in RADIUS at most, and so on until it is small or fewer than PARTS bits are left. Inside a shard a
vantage-point tree over all 64 bits finds the pairs: a node's points are split at the median distance to its vantage point and
only points within RADIUS of the split are queried across it.

A shard returns a spanning forest of its links, at most one link a point, so groups of copies never become all pairs,
and no link between two components is lost. Components then run over the fingerprints themselves, and each component takes
the smallest doc_id of its fingerprints.

Defined cases: null and empty texts have fingerprint zero and are linked like any other; a null doc_id takes part with
component null unless an id is reachable; repeated rows share everything (rows with one doc_id are one document); an
empty table gives an empty result; very long texts are hashed in one pass, their shingles counted in portions. Extra columns are not
looked at, whatever their names; keep_one leaves them as they are.
"""

from __future__ import annotations

import math

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, add_columns, fresh, table
from .components import components

SHINGLE = 4
SEED = 42
RADIUS = 4
#: Blocks of bits: one more than RADIUS, so that close fingerprints agree on one.
PARTS = RADIUS + 1
#: Fingerprints that a shard aims at, and beyond which a shard is split further.
SHARD_AIM = 1500
SHARD_MOST = 5000
LEAF = 64
#: Points to which distances are counted; ten tell nearly all values of a block apart.
VANTAGE = [int(x) for x in np.random.default_rng(20240301).integers(-(1 << 63), 1 << 63, 10, dtype=np.int64)]


def fingerprint(text: str | None) -> int:
    """The fingerprint as a signed 64-bit number."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    flat = b" ".join(words)
    digest = xxhash.xxh64_intdigest
    n = len(words) - SHINGLE + 1
    if n <= 1:
        h = np.array([digest(flat, SEED)], np.uint64)
    else:
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
        starts = np.concatenate(([0], ends[: n - 1])).tolist()
        stops = (ends[SHINGLE - 1 :] - 1).tolist()
        h = np.fromiter((digest(flat[a:b], SEED) for a, b in zip(starts, stops)), np.uint64, n)
    ones = np.zeros(64, np.int64)
    for at in range(0, len(h), 8192):
        ones += np.unpackbits(h[at : at + 8192].astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
    bits = (2 * ones > len(h)).astype(np.uint8)
    return int(np.packbits(bits).view(">i8")[0])


class _Forest:
    def __init__(self, n: int):
        self.up = list(range(n))
        self.links: list[tuple[int, int]] = []

    def root(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return i

    def join(self, i: int, j: int) -> None:
        a, b = self.root(i), self.root(j)
        if a != b:
            self.up[max(a, b)] = min(a, b)
            self.links.append((i, j))


def vantage_links(points: np.ndarray, radius: int = RADIUS) -> list[tuple[int, int]]:
    """A spanning forest (index pairs) of the links of at most radius bits among uint64 points, by a vantage-point tree."""
    forest = _Forest(len(points))

    def across(a: np.ndarray, b: np.ndarray) -> None:
        """Links between two sets: split by distances to a vantage point until one side is small."""
        if not len(a) or not len(b):
            return
        if len(a) * len(b) <= LEAF * LEAF * 4 or min(len(a), len(b)) <= 8:
            for at in range(0, len(a), max(1, (1 << 20) // len(b))):
                part = a[at : at + max(1, (1 << 20) // len(b))]
                near = np.bitwise_count(points[part][:, None] ^ points[b][None, :]) <= radius
                for i, j in zip(*np.nonzero(near)):
                    forest.join(int(part[i]), int(b[j]))
            return
        v = points[a[0]]
        da, db = np.bitwise_count(points[a] ^ v).astype(np.int16), np.bitwise_count(points[b] ^ v).astype(np.int16)
        mid = int(np.median(np.concatenate((da, db))))
        parts = ((a[da <= mid], b[db <= mid + radius]), (a[da > mid], b[db > mid - radius]))
        if all(len(x) * len(y) >= 0.9 * len(a) * len(b) for x, y in parts if len(x)):
            step = max(1, (1 << 20) // len(b))
            for at in range(0, len(a), step):
                near = np.bitwise_count(points[a[at : at + step]][:, None] ^ points[b][None, :]) <= radius
                for i, j in zip(*np.nonzero(near)):
                    forest.join(int(a[at + i]), int(b[j]))
            return
        for x, y in parts:
            across(x, y)

    todo = [np.arange(len(points))]
    while todo:
        some = todo.pop()
        if len(some) <= LEAF:
            near = np.triu(np.bitwise_count(points[some][:, None] ^ points[some][None, :]) <= radius, 1)
            for i, j in zip(*np.nonzero(near)):
                forest.join(int(some[i]), int(some[j]))
            continue
        d = np.bitwise_count(points[some] ^ points[some[0]]).astype(np.int16)
        for j in np.flatnonzero(d <= radius)[1:]:
            forest.join(int(some[0]), int(some[j]))
        mid = int(np.median(d[1:]))
        inner, outer = some[d <= mid], some[d > mid]
        if not len(outer):
            mid -= 1
            inner, outer = some[d <= mid], some[d > mid]
        if len(inner) < 2:
            # All others are equally far from the vantage point; they are split without it.
            half = len(outer) // 2
            todo += [outer[:half], outer[half:]]
            across(outer[:half], outer[half:])
            continue
        todo += [inner, outer]
        di, do = d[d <= mid], d[d > mid]
        across(inner[di > mid - radius], outer[do <= mid + radius])
    return forest.links


def blocks(free: int) -> list[int]:
    """The bits of free, cut into PARTS masks of about the same number of bits; signed, as Spark has them."""
    bits = [k for k in range(64) if free >> k & 1]
    masks = [sum(1 << k for k in bits[len(bits) * p // PARTS : len(bits) * (p + 1) // PARTS]) for p in range(PARTS)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def _distances(mask: Column, points: int) -> Column:
    """A number for the list of distances to the first vantage points, counted on the bits of mask."""
    return F.xxhash64(mask, *[F.bit_count(F.col("fp").bitwiseXOR(F.lit(v)).bitwiseAND(mask)) for v in VANTAGE[:points]])


def shards(spark: SparkSession, points: DataFrame, scratch: Scratch) -> DataFrame:
    """(shard, fp, id): each close pair of distinct fingerprints meets in at least one shard."""
    count = points.count()
    placed = points.select(F.lit(0).cast("long").alias("shard"), F.lit(-1).cast("long").alias("free"), "fp", "id")
    done, most, level = None, SHARD_AIM, 0
    # A distance tells about three bits of a block, and a bit or two where others are known.
    points_used = min(len(VANTAGE), math.ceil(math.log2(max(1, count) / SHARD_AIM) / 2) + 1) if count > SHARD_AIM else 0
    while True:
        level += 1
        if level > 1:
            heavy = placed.groupBy("shard", "free").agg(F.count("*").alias("n")).filter((F.col("n") > most) & (F.bit_count("free") >= PARTS))
            heavy = scratch.cut(heavy.select(F.col("shard").alias("_shard"), "free"))
            # One row for each way to have come here: PARTS ** level at most, whatever the data.
            known = [r["free"] for r in heavy.select("free").distinct().collect()]
            heavy = heavy.drop("free")
        else:
            known = [-1] if points_used else []
            heavy = None
        if not known:
            break
        if heavy is not None:
            light = placed.join(heavy, placed["shard"] == heavy["_shard"], "left_anti")
            done = light if done is None else done.unionByName(light)
            placed = placed.join(heavy, placed["shard"] == heavy["_shard"]).drop("_shard")
        ways = [(f, m, f & ~m) for f in known for m in blocks(f % (1 << 64))]
        if level == 1:
            way = F.explode(F.array(*[F.struct(F.lit(m).cast("long").alias("mask"), F.lit(rest).cast("long").alias("left")) for _, m, rest in ways]))
            split = placed.withColumn("way", way).select("shard", "fp", "id", "way.mask", "way.left")
        else:
            ways = spark.createDataFrame(ways, "_free long, mask long, left long")
            split = placed.join(F.broadcast(ways), F.col("free") == F.col("_free"))
        shard = F.xxhash64("shard", _distances(F.col("mask"), points_used if level == 1 else len(VANTAGE)))
        placed = scratch.cut(split.select(shard.alias("shard"), F.col("left").alias("free"), "fp", "id"))
        most = SHARD_MOST
    placed = placed if done is None else done.unionByName(placed)
    return placed.select("shard", "fp", "id")


def links(spark: SparkSession, points: DataFrame) -> DataFrame:
    """(a, b): ids of a spanning forest of all links among points (id long, fp long, distinct in fp)."""
    scratch = Scratch(spark, "simhash")
    points = scratch.cut(points)

    def run(key, arrow):
        import pyarrow as pa

        fp = arrow.column("fp").to_numpy().astype(np.int64).view(np.uint64)
        ids = arrow.column("id").to_numpy()
        pairs = np.array(vantage_links(fp), np.int64).reshape(-1, 2)
        return pa.table({"a": ids[pairs[:, 0]], "b": ids[pairs[:, 1]]})

    return shards(spark, points, scratch).groupBy("shard").applyInArrow(run, "a long, b long")


def near_duplicates(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """(doc_id, fingerprint, component_id) of every row of docs; component_id is the smallest doc_id reachable over links."""
    scratch = Scratch(spark, "fingerprints")
    fps = add_columns(docs.select("doc_id", "text"), ["text"], "fp long", lambda texts: [[fingerprint(t) for t in texts]]).select("doc_id", "fp")
    fps = scratch.cut(fps)
    classes = fps.groupBy("fp").agg(F.min("doc_id").alias("least"))
    # A fingerprint is its own node, so classes without any id stay apart.
    points = scratch.cut(classes.select("fp", "least", F.col("fp").alias("id")))
    found = components(spark, links(spark, points.select("fp", "id")))
    placed = scratch.cut(points.join(found, points["id"] == found["node"], "left").select("fp", "least", F.coalesce("component", "fp").alias("_node")))
    least = placed.groupBy(F.col("_node").alias("_root")).agg(F.min("least").alias("_component"))
    of = placed.join(least, F.col("_node") == F.col("_root")).select(F.col("fp").alias("_fp"), "_component")
    hexed = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return fps.join(of, fps["fp"] == of["_fp"]).select("doc_id", hexed.alias("fingerprint"), F.col("_component").alias("component_id"))


def keep_one(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """docs without those that are not the smallest doc_id of their component; rows without an id stay."""
    (extra,) = fresh(docs, "_extra")
    gone = near_duplicates(spark, docs.select("doc_id", "text")).filter(F.col("doc_id") != F.col("component_id")).select(F.col("doc_id").alias(extra)).distinct()
    return docs.join(gone, F.col("doc_id") == F.col(extra), "left_anti")


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(spark, table(spark, sf_dir, "documents"))
