"""Benchmark decontamination with an FM-index per training shard.

A window is WINDOW consecutive words of a benchmark item (the whole item if it is shorter). The documents of a partition
are cut into shards of about SHARD_TOKENS words. A shard's words become ids in the vocabulary of the benchmark block;
any other word is a separator that no window can cross, so runs of known words shorter than the shortest window are left
out, exactly. The rest is indexed: suffixes sorted by prefix doubling (each separator a unique, smallest symbol, so a
comparison never runs on), the Burrows-Wheeler transform in a wavelet matrix, and suffix positions sampled at each run's
start and at every SAMPLE-th token. All windows are searched backwards at once by ranks in the wavelet matrix; the
occurrences are located by stepping to a sampled position; overlapping occurrences merge into removal spans.

The benchmark is read in blocks of at most BLOCK_BYTES of text, each broadcast and searched in a narrow pass over the
documents that carries the hits found so far; nothing about the documents is shuffled or collected.

Defined cases: null, empty and wordless texts have no words and no hits; null or wordless items have no windows and never
occur; items with a null id are searched and removed but not listed; repeated items and rows are each treated alike;
with an empty benchmark nothing is hit; a very long text is a shard of its own; windows that several items share are listed
for all of them. Extra columns stay, also where they have the names of ours.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import add_columns, fresh, table

WINDOW = 10
SHARD_TOKENS = 1 << 20
SAMPLE = 16
BLOCK_BYTES = 16 << 20
#: Each byte's part in a word: A-Z as a-z; digits, a-z and all bytes of other characters as they are; else a blank.
WORD_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(WORD_BYTES).split()


class WaveletMatrix:
    """Ranks in a sequence of small integers, one bit plane per level."""

    def __init__(self, values: np.ndarray, sigma: int):
        self.bits = max(1, int(sigma - 1).bit_length())
        self.ones: list[np.ndarray] = []
        self.zeros: list[int] = []
        now = values
        for level in range(self.bits - 1, -1, -1):
            bit = (now >> level) & 1
            self.ones.append(np.concatenate(([0], np.cumsum(bit, dtype=np.int32))).astype(np.int32))
            self.zeros.append(len(bit) - int(self.ones[-1][-1]))
            now = np.concatenate((now[bit == 0], now[bit == 1]))

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Occurrences of symbol before position at, elementwise."""
        low = np.zeros(len(at), np.int64)
        high = at.astype(np.int64)
        for k, level in enumerate(range(self.bits - 1, -1, -1)):
            one = ((symbol >> level) & 1).astype(bool)
            ones = self.ones[k]
            low = np.where(one, self.zeros[k] + ones[low], low - ones[low])
            high = np.where(one, self.zeros[k] + ones[high], high - ones[high])
        return high - low

    def access(self, at: np.ndarray) -> np.ndarray:
        value = np.zeros(len(at), np.int64)
        at = at.astype(np.int64)
        for k in range(self.bits):
            ones = self.ones[k]
            bit = ones[at + 1] - ones[at]
            value = value << 1 | bit
            at = np.where(bit == 1, self.zeros[k] + ones[at], at - ones[at])
        return value


def suffix_order(seq: np.ndarray, sigma: int) -> np.ndarray:
    """Suffix array of seq, in which each 0 is a symbol of its own, ordered by position and below all others."""
    n = len(seq)
    per = max(1, 62 // max(1, int(sigma).bit_length()))
    shift = int(sigma).bit_length()
    ends = np.where(seq == 0, np.arange(n), n - 1)
    ends = np.minimum.accumulate(ends[::-1])[::-1]
    key = np.zeros(n, np.int64)
    alive = np.ones(n, bool)
    for k in range(per):
        word = np.zeros(n, np.int64)
        word[: max(0, n - k)] = seq[k:]
        word[~alive] = 0
        alive &= word > 0
        key = key << shift | word
    order = np.argsort(key, kind="stable")
    rank = np.empty(n, np.int64)
    sorted_key = key[order]
    starts = np.concatenate(([True], sorted_key[1:] != sorted_key[:-1]))
    first = np.maximum.accumulate(np.where(starts, np.arange(n), 0))
    # A suffix that meets its separator within the key is placed by position, which the stable sort has done.
    settled = (ends[order] - order) < per
    rank[order] = np.where(settled, np.arange(n), first)
    depth = per
    last = np.concatenate((starts[1:], [True]))
    open_ = ~settled & ~(starts & last)
    slots = np.flatnonzero(open_)
    while len(slots):
        at = order[slots]
        group, beyond = rank[at], rank[at + depth]
        by = np.lexsort((beyond, group))
        at, group, beyond = at[by], group[by], beyond[by]
        order[slots] = at
        new = np.concatenate(([True], (group[1:] != group[:-1]) | (beyond[1:] != beyond[:-1])))
        lead = np.maximum.accumulate(np.where(new, np.arange(len(at)), 0))
        rank[at] = slots[lead]
        single = new & np.concatenate((new[1:], [True]))
        slots = slots[~single]
        depth *= 2
    return order


class FMIndex:
    """Count and locate runs of symbols (1..sigma-1) in a sequence that ends with the separator 0."""

    def __init__(self, seq: np.ndarray, sigma: int):
        seq = seq.astype(np.int64)
        self.n = len(seq)
        sa = suffix_order(seq, sigma)
        bwt = seq[sa - 1]
        self.tree = WaveletMatrix(bwt, sigma)
        self.before = np.concatenate(([0], np.cumsum(np.bincount(seq, minlength=sigma))))
        begins = np.concatenate(([True], seq[:-1] == 0))
        kept = begins[sa] | (sa % SAMPLE == 0)
        self.kept = np.concatenate(([0], np.cumsum(kept, dtype=np.int64)))
        self.samples = sa[kept]

    def ranges(self, patterns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows of the suffix array that start with each pattern (one per row, equal lengths): [low, high)."""
        low, high = np.zeros(len(patterns), np.int64), np.full(len(patterns), self.n, np.int64)
        for k in range(patterns.shape[1] - 1, -1, -1):
            c = patterns[:, k]
            low, high = self.before[c] + self.tree.rank(c, low), self.before[c] + self.tree.rank(c, high)
        return low, np.maximum(low, high)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of rows of the suffix array, by stepping back to a sampled one."""
        at, steps = rows.astype(np.int64).copy(), np.zeros(len(rows), np.int64)
        todo = np.arange(len(rows))
        while len(todo):
            todo = todo[self.kept[at[todo] + 1] == self.kept[at[todo]]]
            if len(todo):
                c = self.tree.access(at[todo])
                at[todo] = self.before[c] + self.tree.rank(c, at[todo])
                steps[todo] += 1
        return self.samples[self.kept[at]] + steps


class Phrases:
    """The distinct windows of a benchmark block as id sequences, and the items that each belongs to."""

    def __init__(self, items: list[tuple[str | None, str | None]], window: int = WINDOW):
        self.vocabulary: dict[bytes, int] = {}
        found: dict[tuple[int, ...], set[int]] = {}
        self.names: list[str | None] = []
        for name, text in items:
            ids = [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words_of(text)]
            if not ids:
                continue
            self.names.append(name)
            size = min(window, len(ids))
            for i in range(len(ids) - size + 1):
                found.setdefault(tuple(ids[i : i + size]), set()).add(len(self.names) - 1)
        self.sigma = len(self.vocabulary) + 1
        self.shortest = min(map(len, found), default=0)
        self.groups = []
        for size in sorted({len(x) for x in found}):
            some = sorted(x for x in found if len(x) == size)
            owners = [sorted(found[x]) for x in some]
            self.groups.append((size, np.array(some, np.int64), np.concatenate(([0], np.cumsum([len(o) for o in owners]))), np.array([i for o in owners for i in o], np.int64)))


def search(docs: list[list[bytes]], phrases: Phrases) -> list[tuple[np.ndarray, list[str]]]:
    """Per document of a shard: indices of hit words, and names of the items that occur."""
    none = np.zeros(0, np.int64)
    if not phrases.groups:
        return [(none, []) for _ in docs]
    look = phrases.vocabulary.get
    ids, owner, place = [], [], []
    for k, words in enumerate(docs):
        seq = np.fromiter((look(w, 0) for w in words), np.int64, len(words))
        edge = np.flatnonzero(np.diff(np.concatenate(([0], (seq > 0).view(np.int8), [0]))))
        starts, stops = edge[::2], edge[1::2]
        long = stops - starts >= phrases.shortest
        for a, b in zip(starts[long].tolist(), stops[long].tolist()):
            ids += [seq[a:b], [0]]
            place += [np.arange(a, b), [0]]
            owner.append((k, b - a + 1))
    if not ids:
        return [(none, []) for _ in docs]
    seq, place = np.concatenate(ids).astype(np.int64), np.concatenate(place)
    owner = np.repeat([k for k, _ in owner], [n for _, n in owner])
    index = FMIndex(seq, phrases.sigma)
    cover = np.zeros(len(seq) + 1, np.int64)
    met: list[np.ndarray] = []
    for size, patterns, heads, owners in phrases.groups:
        low, high = index.ranges(patterns)
        counts = high - low
        if not counts.any():
            continue
        which = np.repeat(np.arange(len(patterns)), counts)
        rows = np.arange(len(which)) - np.repeat(np.cumsum(counts) - counts, counts) + low[which]
        at = index.locate(rows)
        np.add.at(cover, at, 1)
        np.add.at(cover, at + size, -1)
        pairs = np.unique(np.stack((owner[at], which), 1), axis=0)
        many = heads[pairs[:, 1] + 1] - heads[pairs[:, 1]]
        slot = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many) + np.repeat(heads[pairs[:, 1]], many)
        met.append(np.unique(np.stack((np.repeat(pairs[:, 0], many), owners[slot]), 1), axis=0))
    hit = np.cumsum(cover[:-1]) > 0
    out = [(none, []) for _ in docs]
    if hit.any():
        docs_hit, words_hit = owner[hit], place[hit]
        cuts = np.flatnonzero(np.diff(docs_hit)) + 1
        for k, some in zip(docs_hit[np.concatenate(([0], cuts))].tolist(), np.split(words_hit, cuts)):
            out[k] = (some, [])
        for k, item in np.unique(np.concatenate(met), axis=0).tolist():
            if phrases.names[item] is not None:
                out[k][1].append(phrases.names[item])
    return out


def blocks(benchmark: DataFrame):
    """Lists of (item_id as string, text), each of at most about BLOCK_BYTES; one list is on the driver at a time."""
    size = benchmark.agg(F.sum(F.length(F.col("text").cast("binary")).cast("long"))).first()[0] or 0
    n = max(1, -(-size // (BLOCK_BYTES // 2)))
    items = benchmark.select(F.col("item_id").cast("string"), "text")
    for k in range(n):
        part = items if n == 1 else items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k)
        yield [(r[0], r[1]) for r in part.collect()]


def find(spark: SparkSession, docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """docs with n_words, hit_words (sorted word indices) and hit_items (sorted item ids that have occurring windows)."""
    size, hits, items = fresh(docs, "n_words", "hit_words", "hit_items")
    fields = f"`{size}` long, `{hits}` array<int>, `{items}` array<string>"
    out = None
    for block in blocks(benchmark):
        shared = spark.sparkContext.broadcast(Phrases(block))

        def run(texts, *before, shared=shared):
            phrases = shared.value
            found, shard, held = [], [], 0
            sizes = []
            for text in texts:
                words = words_of(text)
                sizes.append(len(words))
                shard.append(words)
                held += len(words)
                if held >= SHARD_TOKENS:
                    found += search(shard, phrases)
                    shard, held = [], 0
            found += search(shard, phrases) if shard else []
            if before:
                found = [(np.union1d(h, np.asarray(oh, np.int64)), sorted({*i, *oi})) for (h, i), oh, oi in zip(found, *before, strict=True)]
            return [sizes, [h.astype(np.int32) for h, _ in found], [sorted(set(i)) for _, i in found]]

        if out is None:
            out = add_columns(docs, ["text"], fields, run)
        else:
            before = fresh(docs, "_before_hits", "_before_items")
            old = out.withColumnsRenamed({hits: before[0], items: before[1]}).drop(size)
            out = add_columns(old, ["text", *before], fields, run).drop(*before)
    return out


def remove_spans(text: str, hit: np.ndarray) -> str:
    """text without the stretches from the first to the last word of each run of hit words."""
    low = text.encode("utf-8", "surrogatepass")
    is_word = np.frombuffer(low.translate(WORD_BYTES), np.uint8) != 32
    edge = np.flatnonzero(np.diff(np.concatenate(([0], is_word.view(np.int8), [0]))))
    starts, stops = edge[::2], edge[1::2]
    hit = np.asarray(hit, np.int64)
    breaks = np.flatnonzero(np.diff(hit) > 1)
    firsts, lasts = hit[np.concatenate(([0], breaks + 1))], hit[np.concatenate((breaks, [len(hit) - 1]))]
    parts, at = [], 0
    for a, b in zip(starts[firsts].tolist(), stops[lasts].tolist()):
        parts.append(low[at:a])
        at = b
    parts.append(low[at:])
    return b"".join(parts).decode("utf-8", "surrogatepass")


def decontaminate(spark: SparkSession, docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """docs with the hit spans cut out of text, again until none is left; a document of which no word is left goes.

    The benchmark's blocks are broadcast together here, so that what one removal brings side by side is searched for all
    windows before the text is done.
    """
    phrases = [spark.sparkContext.broadcast(Phrases(b)) for b in blocks(benchmark)]
    clean, left = fresh(docs, "clean_text", "words_left")

    def cut(texts):
        """One shard: hits of all blocks, then removals, then the changed texts again."""
        texts, todo, hit_ever = list(texts), list(range(len(texts))), set()
        while todo:
            words = [words_of(texts[i]) for i in todo]
            hits = [search(words, p.value) for p in phrases]
            again = []
            for k, i in enumerate(todo):
                h = np.unique(np.concatenate([x[k][0] for x in hits])) if hits else ()
                if len(h):
                    texts[i] = remove_spans(texts[i], h)
                    hit_ever.add(i)
                    again.append(i)
            todo = again
        return texts, [i not in hit_ever or bool(words_of(t)) for i, t in enumerate(texts)]

    def run(texts):
        out, shard, held = [[], []], [], 0
        for text in texts:
            shard.append(text)
            held += len(text or "") // 5
            if held >= SHARD_TOKENS:
                for column, values in zip(out, cut(shard), strict=True):
                    column += values
                shard, held = [], 0
        for column, values in zip(out, cut(shard), strict=True):
            column += values
        return out

    done = add_columns(docs, ["text"], f"`{clean}` string, `{left}` boolean", run).filter(F.col(left))
    return done.select(*[F.col(clean).alias("text") if c == "text" else F.col(c) for c in docs.columns])


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = find(spark, docs, table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", F.size("hit_words").cast("long").alias("n_hit"), F.size("hit_items").cast("long").alias("n_items"),
        F.sha2(F.array_join("hit_items", ",").cast("binary"), 256).alias("items_sha256"), (F.size("hit_words") > 0).alias("contaminated"),
    )


SQL_OP8 = r"""
WITH dw AS (
  SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w FROM documents
), bw AS (
  SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), win AS (
  SELECT DISTINCT item_id::VARCHAR AS item, k, array_to_string(w[i:i + k - 1], ' ') AS s
  FROM (SELECT item_id, w, least(10, len(w)) AS k FROM bw WHERE len(w) > 0), LATERAL (SELECT unnest(range(1, len(w) - k + 2)) AS i)
), dg AS (
  SELECT doc_id, i, k, array_to_string(w[i:i + k - 1], ' ') AS s
  FROM dw CROSS JOIN (SELECT DISTINCT k FROM win) ks, LATERAL (SELECT unnest(range(1, len(w) - k + 2)) AS i)
), occ AS (
  SELECT doc_id, i, k, s FROM dg SEMI JOIN win USING (k, s)
), hits AS (
  SELECT doc_id, count(DISTINCT p)::BIGINT AS n_hit FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM occ) GROUP BY doc_id
), items AS (
  SELECT doc_id, count(*)::BIGINT AS n_items, string_agg(item, ',' ORDER BY item) AS listed
  FROM (SELECT DISTINCT doc_id, item FROM occ JOIN win USING (k, s)) GROUP BY doc_id
)
SELECT dw.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(listed, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM dw LEFT JOIN hits USING (doc_id) LEFT JOIN items USING (doc_id)
"""
