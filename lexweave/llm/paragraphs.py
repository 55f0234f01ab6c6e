"""Substring dedup by paragraph MinHash banding.

A paragraph is a line that is not blank (white space collapsed, lower-cased). Equal paragraphs are one class, whatever
their length. Classes are compared by the Jaccard similarity of their sets of SHINGLE = 5 word shingles; THRESHOLD = 0.8 or
more links two classes that collide in at least one band of their MinHash signatures. A paragraph of fewer than SHINGLE
words is one shingle as a whole, which only equal paragraphs share, so it needs no bands. Bands come from ``tune``: the
fewest of ROWS rows that find a pair at the threshold with probability RECALL or more.

Passages begin and end inside lines and run across them, so every text is also cut by content into pieces: a word position
is an anchor if the hash of its next ANCHOR words is the least among WINDOW neighbours, wherever that stands, and pieces
reach from the start and each anchor to the next one. Equal passages have equal anchors, so all their pieces but the two at the
edges are equal too; pieces are classes by equality (a band of all their shingles). Repeated pieces that follow each other are one repeat. An embedded
passage of 51 words holds LEAST words between its anchors in 99 of 100 cases, one of 60 always; up to WINDOW + ANCHOR words at
its edges may be left.

Components of the links are removal clusters: of each, the paragraph or piece that comes first in (doc_id, text hash, first
word) stays and the others go. A cluster inside one document is left alone: repeats are what documents share. A document's removals are merged to spans of words. A repeat of under LEAST words that is
not a whole text is listed (short) and stays in place: a phrase, not a passage.

Buckets never become all pairs. Buckets with the same members are one. A bucket of up to GROUP classes is searched in
one task that grows clusters from a seed and compares a member only with those not yet in a cluster, so a tight group
costs one pass; what comes out is a spanning forest. In a larger bucket each class is first compared with the bucket's
smallest; those that link to it need no comparison with each other, and the rest meets all members in tiles of GROUP by
GROUP, each a task of its own. Nothing is capped and no link between two components is lost.

Defined cases: null and empty texts have no paragraphs and never lose anything; a very long text is one row like any
other, its pieces are many short rows; rows equal in doc_id and text are one document and get the same verdict;
ties between copies go to the smaller doc_id, then text hash, then first word; null doc_ids, and ids that are no integers, come last; classes are told
apart by a 64-bit hash of the paragraph; an empty table gives an empty result; extra columns stay, also where they have the names of ours.
"""

from __future__ import annotations

import math
import re

import numpy as np
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import LAST, Scratch, add_columns, doc_key, fresh, join_counted, steps, table
from .components import components

SHINGLE = 5
THRESHOLD = 0.8
ROWS = 3
RECALL = 0.99
ANCHOR = 3
WINDOW = 16
LEAST = 20
GROUP = 500


def tune(threshold: float = THRESHOLD, rows: int = ROWS, recall: float = RECALL) -> int:
    """The fewest bands that miss a pair at the threshold with probability 1 - recall at most."""
    return math.ceil(math.log(1 - recall) / math.log(1 - threshold**rows))


BANDS = tune()
_rng = np.random.default_rng(20240229)
_A = _rng.integers(1, 1 << 63, BANDS * ROWS, dtype=np.uint64) | np.uint64(1)
_B = _rng.integers(1, 1 << 63, BANDS * ROWS, dtype=np.uint64)
_STEP = _rng.integers(1, 1 << 63, SHINGLE, dtype=np.uint64) | np.uint64(1)
_BAND = _rng.integers(1, 1 << 63, BANDS, dtype=np.uint64)


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    return h ^ (h >> np.uint64(29))


class _Hashes(dict):
    """Hashes of words, kept for the words seen lately."""

    def __missing__(self, word: str) -> int:
        if len(self) > 200000:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word.encode("utf-8", "surrogatepass"))
        return h


def tokens(texts: list[str | None], hashes: _Hashes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word hashes of all texts in a row, where each text starts (and the end), and (first, end) of all lines with words."""
    values: list[int] = []
    starts, lines = [0], []
    for text in texts:
        for line in (text or "").lower().split("\n"):
            first = len(values)
            values += map(hashes.__getitem__, line.split())
            if len(values) > first:
                lines.append((first, len(values)))
        starts.append(len(values))
    return np.array(values, np.uint64), np.array(starts, np.int64), np.array(lines, np.int64).reshape(-1, 2)


def _rolled(values: np.ndarray, size: int) -> np.ndarray:
    """A hash of size words at each position."""
    n = max(0, len(values) - size + 1)
    out = np.zeros(n, np.uint64)
    for k in range(size):
        out += values[k : k + n] * _STEP[k]
    return _mix(out)


def _over(x: np.ndarray, size: int, pick) -> np.ndarray:
    """pick (minimum or maximum) over each size neighbours from a position on, by doubling."""
    done = 1
    while done < size:
        step = min(done, size - done)
        x = pick(x[: len(x) - step], x[step:])
        done += step
    return x


def anchors(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Sorted positions: each non-empty text's start, and those least in a window inside one text."""
    firsts = np.unique(starts[:-1][np.diff(starts) > 0])
    g = _rolled(values, ANCHOR)
    if len(g) < WINDOW:
        return firsts
    least = _over(g, WINDOW, np.minimum)
    end = starts[np.searchsorted(starts, np.arange(len(least)), "right")]
    least[np.arange(len(least)) + WINDOW + ANCHOR - 1 > end] = 0
    edge = np.zeros(WINDOW - 1, np.uint64)
    at = np.flatnonzero(_over(np.concatenate((edge, least, edge)), WINDOW, np.maximum) == g)
    # A window that repeats its least hash has it several times; of such a row of anchors one in WINDOW stays.
    same = np.zeros(len(at), bool)
    same[1:] = (g[at[1:]] == g[at[:-1]]) & (np.diff(at) < WINDOW)
    row = np.cumsum(~same) - 1
    part = (at - at[~same][row]) // WINDOW if len(at) else at
    stays = ~same
    stays[1:] |= part[1:] != part[:-1]
    return np.unique(np.concatenate((firsts, at[stays])))


def pieces_of(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """(first, end) of the pieces between the anchors of all texts."""
    at = anchors(values, starts)
    return np.stack((at, np.append(at[1:], len(values))), 1) if len(at) else np.zeros((0, 2), np.int64)


def class_ids(values: np.ndarray, ranges: np.ndarray, kind: int) -> np.ndarray:
    """One number for each range of words, equal for equal words; lines and pieces (kind) do not share numbers."""
    digest, raw = xxhash.xxh3_64_intdigest, memoryview(values.view(np.uint8))
    return np.fromiter((digest(raw[8 * a : 8 * b], kind) for a, b in ranges.tolist()), np.uint64, len(ranges)).view(np.int64)


def signatures(values: np.ndarray, ranges: np.ndarray) -> np.ndarray:
    """Band hashes (x BANDS) of the ranges of words, each of SHINGLE words or more."""
    bands = np.zeros((len(ranges), BANDS), np.uint64)
    if not len(ranges):
        return bands.view(np.int64)
    rolled = _rolled(values, SHINGLE)
    cuts = np.stack((ranges[:, 0], ranges[:, 1] - SHINGLE + 1), 1).reshape(-1)
    for k, (a, b) in enumerate(zip(_A, _B)):
        hashed = np.append(_mix(rolled * a + b), np.uint64(0xFFFFFFFFFFFFFFFF))
        band = k // ROWS
        bands[:, band] = _mix(bands[:, band] * np.uint64(31) + np.minimum.reduceat(hashed, cuts)[::2])
    return _mix(bands + _BAND).view(np.int64)


def paragraph_table(docs: DataFrame) -> DataFrame:
    """(d, h, n, s, e, piece, id, bands) of every line and piece: words s to e of the text's n; bands of lines of SHINGLE words or more."""

    def run(batches):
        import pyarrow as pa

        hashes = _Hashes()
        for batch in steps(batches, "text"):
            d, h, texts = (batch.column(i) for i in range(3))
            values, starts, lines = tokens(texts.to_pylist(), hashes)
            pieces = pieces_of(values, starts)
            ranges = np.concatenate((lines, pieces))
            banded = ranges[:, 1] - ranges[:, 0] >= SHINGLE
            banded[len(lines) :] = False
            ids = np.concatenate((class_ids(values, lines, 0), class_ids(values, pieces, 1)))
            bands = signatures(values, ranges[banded])
            rows = np.searchsorted(starts, ranges[:, 0], "right") - 1
            ends = np.concatenate(([0], np.cumsum(BANDS * banded)))
            listed = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(bands.reshape(-1)))
            ints = [x.astype(np.int32) for x in (starts[rows + 1] - starts[rows], ranges[:, 0] - starts[rows], ranges[:, 1] - starts[rows])]
            kind, rows = pa.array(np.arange(len(ranges)) >= len(lines)), pa.array(rows)
            yield pa.RecordBatch.from_arrays([d.take(rows), h.take(rows), *map(pa.array, ints), kind, pa.array(ids), listed], names=["d", "h", "n", "s", "e", "piece", "id", "bands"])

    source = docs.filter(F.col("text").isNotNull()).select(doc_key().alias("d"), F.xxhash64("text").alias("h"), "text")
    return source.mapInArrow(run, "d long, h long, n int, s int, e int, piece boolean, id long, bands array<long>")


def shingles(text: str) -> np.ndarray:
    """The sorted distinct shingles of a paragraph, as 64-bit hashes."""
    w = text.split()
    return np.unique(np.fromiter((xxhash.xxh3_64_intdigest(" ".join(w[i : i + SHINGLE])) for i in range(max(1, len(w) - SHINGLE + 1))), np.uint64))


class _Sets:
    """Shingle sets of a task's classes, and the Jaccard similarity of one to many."""

    def __init__(self, texts: list[str]):
        self.sets = [shingles(t) for t in texts]
        self.sizes = np.array([len(s) for s in self.sets], np.int64)

    def similar(self, i: int, others: np.ndarray) -> np.ndarray:
        """Those of others that link to i."""
        size = self.sizes[i]
        others = others[(self.sizes[others] >= THRESHOLD * size - 1e-9) & (self.sizes[others] * THRESHOLD <= size + 1e-9)]
        if not len(others):
            return others
        flat = np.concatenate([self.sets[j] for j in others])
        own = self.sets[i]
        met = own[np.minimum(np.searchsorted(own, flat), size - 1)] == flat
        lengths = self.sizes[others]
        both = np.add.reduceat(met.astype(np.int64), np.concatenate(([0], np.cumsum(lengths)[:-1])))
        return others[both >= THRESHOLD * (size + lengths - both) - 1e-9]


def grow_links(texts: list[str]) -> list[tuple[int, int]]:
    """A spanning forest of the links among texts: clusters grow from seeds, over what is not yet in one."""
    sets, free, out = _Sets(texts), np.arange(len(texts)), []
    while len(free):
        queue, free = [int(free[0])], free[1:]
        while queue and len(free):
            i = queue.pop()
            near = sets.similar(i, free)
            if len(near):
                out += [(i, int(j)) for j in near]
                queue += near.tolist()
                free = np.setdiff1d(free, near, assume_unique=True)
    return out


def _by_group(df: DataFrame, keys: list[str], columns: list[str], search) -> DataFrame:
    """(a, b) links from search(rows) of each group of keys; groups are bounded in size and streamed in key order."""

    def run(batches):
        import pyarrow as pa

        held, key, out = [], None, []
        for batch in batches:
            for row in zip(*[batch.column(batch.schema.get_field_index(c)).to_pylist() for c in [*keys, *columns]]):
                if row[: len(keys)] != key:
                    out += search(held) if held else []
                    held, key = [], row[: len(keys)]
                held.append(row[len(keys) :])
            if len(out) > 20000:
                yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], pa.int64()) for k in (0, 1)], names=["a", "b"])
                out = []
        out += search(held) if held else []
        yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], pa.int64()) for k in (0, 1)], names=["a", "b"])

    return df.select(*keys, *columns).repartition(*keys).sortWithinPartitions(*keys).mapInArrow(run, "a long, b long")


def _search_bucket(rows):
    return [(rows[i][0], rows[j][0]) for i, j in grow_links([r[1] for r in rows])]


def _search_tile(rows):
    """rows: (id, text, is_rest). Links between the rest and all members of the tile, thinned to a spanning forest."""
    sets, up = _Sets([r[1] for r in rows]), list(range(len(rows)))

    def root(i):
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    members = np.array([k for k, r in enumerate(rows) if not r[2]], np.int64)
    out = []
    for i in (k for k, r in enumerate(rows) if r[2]):
        for j in sets.similar(i, members).tolist():
            a, b = root(i), root(j)
            if a != b and rows[i][0] != rows[j][0]:
                up[max(a, b)] = min(a, b)
                out.append((rows[i][0], rows[j][0]))
    return out


def class_links(spark: SparkSession, docs: DataFrame, every: DataFrame, scratch: Scratch) -> DataFrame:
    """(a, b): links between classes of every (see paragraph_table), enough to connect each component."""
    banded = every.select("id", F.explode("bands").alias("bucket"))
    shared = banded.groupBy("bucket").agg(F.min("id").alias("lo"), F.max("id").alias("hi")).filter("lo < hi")
    shared = scratch.cut(shared.select(F.col("bucket").alias("_bucket")))
    members = scratch.cut(banded.join(shared, F.col("bucket") == F.col("_bucket")).select("bucket", "id").distinct())
    hashed = [F.bit_xor(F.xxhash64("id", F.lit(k))).alias(x) for k, x in ((7, "x"), (8, "y"))]
    sizes = members.groupBy("bucket").agg(F.count("*").alias("n"), F.min("id").alias("lo"), F.max("id").alias("hi"), *hashed)
    sizes = sizes.groupBy("n", "lo", "hi", "x", "y").agg(F.min("bucket").alias("_bucket"))
    sizes = scratch.cut(sizes.select("_bucket", "n", "lo"))
    all_members, members = members, scratch.cut(members.join(sizes, F.col("bucket") == F.col("_bucket")).select("bucket", "id", "n", "lo"))
    scratch.drop(all_members)
    wanted = members.select(F.col("id").alias("_id")).distinct()
    # One place a class, found before the join: a frequent line is then one row. Only lines have bands.
    places = every.filter("NOT piece").groupBy("id").agg(F.min(F.struct("d", "h", "s", "e")).alias("x"))
    need = places.join(wanted, F.col("_id") == F.col("id"))
    need = scratch.cut(need.groupBy(F.col("x.d").alias("_d"), F.col("x.h").alias("_h")).agg(F.collect_list(F.struct("x.s", "x.e", "id")).alias("need")))
    found = docs.select(doc_key().alias("d"), F.xxhash64("text").alias("h"), "text").join(need, (F.col("d") == F.col("_d")) & (F.col("h") == F.col("_h"))).select("text", "need")

    def fetch(batches):
        import pyarrow as pa

        for batch in steps(batches, "text"):
            ids, out = [], []
            for text, wanted in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                words = text.lower().split()
                for x in wanted:
                    ids.append(x["id"])
                    out.append(" ".join(words[x["s"] : x["e"]]))
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(out, pa.string())], names=["id", "words"])

    texts = scratch.cut(found.mapInArrow(fetch, "id long, words string").dropDuplicates(["id"]))
    t = texts.select(F.col("id").alias("_id"), "words")
    small = members.filter(F.col("n") <= GROUP).join(t, F.col("id") == F.col("_id"))
    out = _by_group(small, ["bucket"], ["id", "words"], _search_bucket)
    large = members.filter(F.col("n") > GROUP)
    if large.isEmpty():
        return out
    # Compare each member with the bucket's smallest, a few texts at a time.
    lead = t.withColumnsRenamed({"_id": "_lead", "words": "lead_words"})
    both = large.join(t, F.col("id") == F.col("_id")).join(lead, F.col("lo") == F.col("_lead"))

    def star(batches):
        import pyarrow as pa

        for batch in batches:
            ok, known = [], {}
            for words, lead_words in zip(batch.column(4).to_pylist(), batch.column(5).to_pylist(), strict=True):
                b = known.get(lead_words)
                if b is None:
                    known = {lead_words: (b := shingles(lead_words))}
                a = shingles(words)
                met = len(np.intersect1d(a, b, assume_unique=True))
                ok.append(met >= THRESHOLD * (len(a) + len(b) - met) - 1e-9)
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(ok, pa.bool_())], names=["bucket", "id", "n", "lo", "linked"])

    starred = both.select("bucket", "id", "n", "lo", "words", "lead_words").mapInArrow(star, "bucket long, id long, n long, lo long, linked boolean")
    starred = scratch.cut(starred)
    out = out.unionByName(starred.filter("linked AND id <> lo").select(F.col("id").alias("a"), F.col("lo").alias("b")))
    rest = starred.filter("NOT linked").groupBy(F.col("bucket").alias("_bucket")).agg(F.ceil(F.count("*") / GROUP).cast("int").alias("rest_tiles"))
    tiled = starred.join(rest, F.col("bucket") == F.col("_bucket")).withColumn("tiles", F.ceil(F.col("n") / GROUP).cast("int"))
    place = lambda n: F.pmod(F.xxhash64("id"), F.col(n)).cast("int")
    every = tiled.select("bucket", "id", F.explode(F.sequence(F.lit(0), F.col("rest_tiles") - 1)).alias("i"), place("tiles").alias("j"), F.lit(False).alias("is_rest"))
    some = tiled.filter("NOT linked").select("bucket", "id", place("rest_tiles").alias("i"), F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)).alias("j"), F.lit(True).alias("is_rest"))
    tiles = every.unionByName(some).join(t, F.col("id") == F.col("_id"))
    return out.unionByName(_by_group(tiles, ["bucket", "i", "j"], ["id", "words", "is_rest"], _search_tile))


def occurrences(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """(d, h, s, e, full, component, keep) of every line and piece that has a copy in another document; keep = (d, h, s, e) of the one that stays;
    full: part of a repeat of LEAST words or more, or of a whole text."""
    scratch = Scratch(spark, "paragraphs")
    banded = scratch.cut(paragraph_table(docs))
    links = scratch.cut(class_links(spark, docs, banded, scratch))
    every = scratch.cut(banded.drop("bands"))
    scratch.drop(banded)
    found = components(spark, links)
    known = every.groupBy("id").agg(F.count("*").alias("rows")).join(found, F.col("id") == F.col("node"), "left").filter("rows > 1 OR node IS NOT NULL")
    known = scratch.cut(known.select("id", F.coalesce("component", "id").alias("component"), "rows"))
    of = join_counted(every, known, "id", "rows").select("d", "h", "n", "s", "e", "piece", "component").distinct()
    # Pieces that follow each other are one repeat; a line stands alone.
    order = Window.partitionBy("d", "h", "piece").orderBy("s")
    opens = ~F.col("piece") | (F.col("s") > F.coalesce(F.lag("e").over(order), F.lit(-1)))
    of = of.withColumn("run", F.sum(opens.cast("int")).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    words = F.sum(F.col("e") - F.col("s")).over(Window.partitionBy("d", "h", "piece", "run"))
    of = of.withColumn("full", (words >= LEAST) | (words == F.col("n"))).drop("run", "n")
    of = scratch.cut(of)
    scratch.drop(every)
    # What repeats inside one document only is its own style, not a copy.
    first = of.groupBy("component").agg(F.min(F.struct("d", "h", "s", "e")).alias("keep"), F.max(F.struct("d", "h")).alias("last"), F.count("*").alias("rows"))
    first = scratch.cut(first.filter((F.col("last.d") != F.col("keep.d")) | (F.col("last.h") != F.col("keep.h"))).drop("last"))
    return scratch.cut(join_counted(of, first, "component", "rows"))


def verdicts(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """(d, h, spans, n_removed, repeats_of, classes, short) per document with a repeat: spans of words to remove
    and their words' number, ids of documents that hold what stays, the clusters ("doc_id:first word" of what stays) that
    the document has part in, and those of phrases under LEAST words, which stay in place."""
    of = occurrences(spark, docs).withColumn("other", F.struct("d", "h", "s", "e") != F.col("keep"))
    order = Window.partitionBy("d", "h").orderBy("s", "e")
    gone = of.filter("full AND other").select("d", "h", "s", "e")
    opens = F.col("s") > F.coalesce(F.max("e").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(-1))
    gone = gone.withColumn("opens", opens.cast("int")).withColumn("span", F.sum("opens").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    gone = gone.groupBy("d", "h", "span").agg(F.min("s").alias("first"), F.max("e").alias("last"))
    gone = gone.groupBy(F.col("d").alias("_d"), F.col("h").alias("_h")).agg(F.sort_array(F.collect_list(F.struct("first", "last"))).alias("spans"), F.sum(F.col("last") - F.col("first")).alias("n_removed"))
    keeper = F.when(F.col("keep.d") != LAST, F.col("keep.d"))
    name = F.concat(F.coalesce(keeper.cast("string"), F.lit("null")), F.lit(":"), F.col("keep.s"))
    told = of.groupBy("d", "h").agg(
        F.sort_array(F.collect_set(F.when(F.col("full") & F.col("other"), keeper))).alias("repeats_of"),
        F.sort_array(F.collect_set(F.when(F.col("full"), name))).alias("classes"),
        F.sort_array(F.collect_set(F.when(~F.col("full"), name))).alias("short"),
    )
    joined = told.join(gone, (F.col("d") == F.col("_d")) & (F.col("h") == F.col("_h")), "left")
    return joined.select("d", "h", F.coalesce("spans", F.array().cast(SPANS)).alias("spans"), F.coalesce("n_removed", F.lit(0)).alias("n_removed"), "repeats_of", "classes", "short")


SPANS = "array<struct<first:int,last:int>>"
VERDICT = {"spans": SPANS, "n_removed": "bigint", "repeats_of": "array<bigint>", "classes": "array<string>", "short": "array<string>"}


def mark_repeats(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """docs with the columns of VERDICT (see verdicts); empty lists and 0 where nothing repeats."""
    names = fresh(docs, *VERDICT)
    d, h, *inner = fresh(docs, "_d", "_h", *(f"_v_{c}" for c in VERDICT))
    v = verdicts(spark, docs.select("doc_id", "text"))
    v = v.select(F.col("d").alias(d), F.col("h").alias(h), *[F.col(c).alias(x) for c, x in zip(VERDICT, inner, strict=True)])
    joined = docs.join(v, (doc_key() == F.col(d)) & (F.xxhash64("text") == F.col(h)) & F.col("text").isNotNull(), "left")
    nothing = [F.lit(0) if k == "bigint" else F.array().cast(k) for k in VERDICT.values()]
    return joined.select(*docs.columns, *[F.coalesce(F.col(x), no).cast(k).alias(n) for x, no, k, n in zip(inner, nothing, VERDICT.values(), names, strict=True)])


WORD = re.compile(r"\S+")


def without_spans(text: str, spans: list[tuple[int, int]]) -> str:
    """text without the words of sorted, disjoint spans; lines of which nothing is left go as well."""
    places, out, at = [m.span() for m in WORD.finditer(text)], [], 0
    for first, last in spans:
        a, b = places[first][0], places[last - 1][1]
        before = text[at:a]
        if first == 0 or "\n" in text[places[first - 1][1] : a]:
            # From a line's start on: what follows moves up, a line that is used up goes with its end.
            rest = re.compile(r"[^\S\n]*\n?").match(text, b)
            b = rest.end()
        else:
            before = before.rstrip(" \t")
        out.append(before)
        at = b
    return "".join([*out, text[at:]])


def remove_repeats(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """docs with the repeated paragraphs cut out of text."""
    marked = mark_repeats(spark, docs)
    spans = marked.columns[len(docs.columns)]
    (left,) = fresh(marked, "left")

    def cut(texts, found):
        return [[without_spans(t, [(x["first"], x["last"]) for x in s]) if t and s else t for t, s in zip(texts, found, strict=True)]]

    done = add_columns(marked.select(*docs.columns, spans), ["text", spans], f"`{left}` string", cut)
    return done.select(*[F.col(left).alias(c) if c == "text" else F.col(c) for c in docs.columns])


def op5_paragraph_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document: what of it repeats; a document whose paragraphs all stay has n_removed 0."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    marked = mark_repeats(spark, docs)
    spans = F.transform("spans", lambda x: F.concat_ws("-", x["first"], x["last"]))
    return marked.select("doc_id", "n_removed", spans.alias("removed"), "repeats_of", "classes", "short")
