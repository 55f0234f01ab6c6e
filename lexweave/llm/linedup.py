"""Line dedup by a suffix array over line ids, in DataFrame operations only.

All documents, in the order of doc_id, make one sequence of lines; a document's end is a unique symbol. A line's id is
the 128-bit MD5 of the trimmed line; blank lines take no part and stay. Prefix doubling ranks the suffixes by their first
1, 2, 4, ... lines: the rank of 2h lines at a position comes from the ranks of h lines there and h lines on. Suffixes
whose first h lines occur once are final and drop out, so only suffixes inside some longest-common-prefix interval are
carried on: equal ranks at h lines are exactly the suffix-array intervals with a common prefix of h lines or more. Every
interval keeps its first position; a position that is not the first starts a later copy of a repeated run.

Runs. A position's source is the first position of the largest interval size where it is a later copy. Positions that follow each
other with sources that do are one run; at its head the exact longest common prefix with the source comes from the ranks
again, from large to small: where the next h/2, h/4, ... lines of both have equal ranks, the prefix grows by them. Such a
run is maximal: it ends where the lines differ, and begins where the line ahead has another source.

A later copy is deleted if its run has MIN_LINES = 2 lines or more, or is one line of MIN_CHARS characters or more; the
exact length of the longest is reported (longest_run).

Scale: a round is a map-side-combined count per pair of ranks, a range sort of the repeated pairs (the new ranks), and a
join back on the pair, whose hot keys Spark splits; the neighbour's rank comes from a window over one document. Prefixes
are made exact for the heads of runs only. Texts are shuffled once, to meet the list of lines to delete. Rounds are written
tables in the shared folder.

Defined cases: a null text stays null and an empty text empty, with no lines; rows equal in doc_id and text are one
document and get the same verdict; rows of one doc_id with different texts follow each other in the order of the
texts' hash; null doc_ids, and ids that are no integers, come last; very long texts are many short rows of lines, as all are; of equal runs the one first in this order
stays; extra columns stay, also where they have the names of ours; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import Scratch, doc_key, fresh, table, without_lines

MIN_LINES = 2
MIN_CHARS = 20
BLANK = " \t\r\x0b\x0c"


def _trim(c: Column) -> Column:
    return F.btrim(c, F.lit(BLANK))


def line_table(docs: DataFrame) -> DataFrame:
    """(d, h, i, line, id, len): document, its text's hash, index among its non-blank lines, line number, id, characters."""
    lines = F.filter(
        F.transform(F.split("text", "\n", -1), lambda s, n: F.struct(n.alias("line"), _trim(s).alias("s"))),
        lambda x: x["s"] != "",
    )
    rows = docs.filter(F.col("text").isNotNull()).select(doc_key().alias("d"), F.xxhash64("text").alias("h"), F.posexplode(lines).alias("i", "x"))
    return rows.select("d", "h", "i", F.col("x.line").alias("line"), F.unhex(F.md5(F.col("x.s").cast("binary"))).alias("id"), F.length("x.s").alias("len"))


def _ranked(groups: DataFrame, keys: list[str], scratch: Scratch) -> DataFrame:
    """groups sorted by keys, with r: a number that grows in that order. The order needs no counting, only a range sort."""
    n = groups.sparkSession.conf.get("spark.sql.shuffle.partitions")
    return scratch.cut(groups.repartitionByRange(int(n), *keys).sortWithinPartitions(*keys).withColumn("r", F.monotonically_increasing_id()))


def repeated_suffixes(spark: SparkSession, docs: DataFrame, scratch: Scratch):
    """Yield (h, table) for h = 1, 2, 4, ...: suffixes whose first h lines repeat.

    Columns: d, h, i, r and first, for h = 1 also line and len. r orders the suffixes by their first h lines; first =
    (d, h, i) is where the same h lines occur first.
    """
    lines = scratch.cut(line_table(docs))
    at = F.struct("d", "h", "i")
    groups = lines.groupBy("id").agg(F.min(at).alias("first"), F.max(at).alias("end")).filter("first <> end")
    groups = _ranked(groups.select("id", "first"), ["id"], scratch)
    g = groups.withColumnRenamed("id", "_id")
    first = lines.join(g, lines["id"] == g["_id"]).select("d", "h", "i", "line", "len", "r", "first")
    now = scratch.cut(first.dropDuplicates(["d", "h", "i"]))
    scratch.drop(lines)
    scratch.drop(groups)
    size = 1
    while not now.isEmpty():
        yield size, now
        ahead = Window.partitionBy("d", "h").orderBy("i").rangeBetween(size, size)
        pairs = now.withColumn("r2", F.max("r").over(ahead)).filter(F.col("r2").isNotNull())
        pairs = scratch.cut(pairs.select("d", "h", "i", F.col("r").alias("r1"), "r2"))
        groups = pairs.groupBy("r1", "r2").agg(F.count("*").alias("n"), F.min(at).alias("first")).filter("n > 1").select("r1", "r2", "first")
        groups = _ranked(groups, ["r1", "r2"], scratch)
        g = groups.withColumnsRenamed({"r1": "_r1", "r2": "_r2"})
        now = pairs.join(g, (pairs["r1"] == g["_r1"]) & (pairs["r2"] == g["_r2"]))
        now = scratch.cut(now.select("d", "h", "i", "r", "first"))
        scratch.drop(pairs)
        scratch.drop(groups)
        size *= 2


def runs(rounds: list[tuple[int, DataFrame]], scratch: Scratch) -> DataFrame:
    """(d, h, i, n): the heads of maximal runs that are later copies, and their exact number of lines."""
    copies = None
    for size, now in rounds:
        part = now.filter(F.col("first") != F.struct("d", "h", "i")).select("d", "h", "i", "first", F.lit(size).alias("n"))
        copies = part if copies is None else copies.unionByName(part)
    copies = copies.groupBy("d", "h", "i").agg(F.max_by("first", "n").alias("q"), F.max("n").alias("n"))
    order = Window.partitionBy("d", "h").orderBy("i")
    before, source = F.lag("i").over(order), F.lag("q").over(order)
    goes_on = (before == F.col("i") - 1) & (source["d"] == F.col("q.d")) & (source["h"] == F.col("q.h")) & (source["i"] == F.col("q.i") - 1)
    heads = copies.withColumn("goes_on", F.coalesce(goes_on, F.lit(False))).filter(~F.col("goes_on"))
    heads = scratch.cut(heads.select("d", "h", "i", F.col("q.d").alias("qd"), F.col("q.h").alias("qh"), F.col("q.i").alias("qi"), F.col("n").alias("top"), "n"))
    for k, (size, now) in enumerate(reversed(rounds[:-1])):
        own = now.select(F.col("d").alias("_d"), F.col("h").alias("_h"), F.col("i").alias("_i"), F.col("r").alias("own"))
        other = own.withColumnsRenamed({"_d": "_qd", "_h": "_qh", "_i": "_qi", "own": "other"})
        open_ = F.col("top") > size
        met = heads.join(own, open_ & (F.col("d") == F.col("_d")) & (F.col("h") == F.col("_h")) & (F.col("i") + F.col("n") == F.col("_i")), "left")
        met = met.join(other, open_ & (F.col("qd") == F.col("_qd")) & (F.col("qh") == F.col("_qh")) & (F.col("qi") + F.col("n") == F.col("_qi")), "left")
        grown = met.withColumn("n", F.col("n") + F.when(F.col("own") == F.col("other"), size).otherwise(0)).select("d", "h", "i", "qd", "qh", "qi", "top", "n")
        # A few rounds make one job: they are small, and each join depends on the one before.
        heads = scratch.cut(grown) if k % 3 == 2 else grown
    return heads.select("d", "h", "i", "n")


def later_copies(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """(d, h, line, run): lines to delete, by number, and the lines of the longest run up to there."""
    scratch = Scratch(spark, "lines")
    rounds = list(repeated_suffixes(spark, docs, scratch))
    if not rounds:
        return spark.createDataFrame([], "d long, h long, line int, run int")
    heads = runs(rounds, scratch).withColumnsRenamed({"d": "_d", "h": "_h", "i": "_i"})
    # All lines of a run are later copies of single lines too.
    copies = rounds[0][1].filter(F.col("first") != F.struct("d", "h", "i")).select("d", "h", "i", "line", "len")
    placed = copies.join(heads, (F.col("d") == F.col("_d")) & (F.col("h") == F.col("_h")) & (F.col("i") == F.col("_i")), "left")
    counts = (F.col("n") >= MIN_LINES) | (F.col("len") >= MIN_CHARS)
    so_far = Window.partitionBy("d", "h").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    placed = placed.withColumn("reach", F.max(F.when(counts, F.col("i") + F.col("n"))).over(so_far)).withColumn("run", F.max(F.when(counts, F.col("n"))).over(so_far))
    gone = scratch.cut(placed.filter(F.col("reach") > F.col("i")).select("d", "h", "line", "run"))
    for _, now in rounds:
        scratch.drop(now)
    return gone


def dedup_lines(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """docs with later copies deleted from text, and n_lines (non-blank, before), n_removed and longest_run (deleted)."""
    n, gone, longest = fresh(docs, "n_lines", "n_removed", "longest_run")
    d, h, marked, run = fresh(docs, "_d", "_h", "_gone", "_run")
    marks = later_copies(spark, docs.select("doc_id", "text")).groupBy(F.col("d").alias(d), F.col("h").alias(h))
    marks = marks.agg(F.sort_array(F.collect_list("line")).alias(marked), F.max("run").alias(run))
    joined = docs.join(marks, (doc_key() == F.col(d)) & (F.xxhash64("text") == F.col(h)) & F.col("text").isNotNull(), "left")
    lines = F.split("text", "\n", -1)
    text = F.when(F.col(marked).isNull(), F.col("text")).otherwise(without_lines("text", marked))
    filled = F.size(F.filter(lines, lambda s: _trim(s) != ""))
    return joined.select(
        *[text.alias(c) if c == "text" else docs[c] for c in docs.columns],
        F.when(F.col("text").isNull(), 0).otherwise(filled).cast("long").alias(n),
        F.when(F.col(marked).isNull(), 0).otherwise(F.size(marked)).cast("long").alias(gone),
        F.coalesce(run, F.lit(0)).alias(longest),
    )


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = dedup_lines(spark, table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_removed", "text")


SQL_OP2 = """
WITH x AS (
  SELECT doc_id, unnest(ls) AS s, unnest(range(len(ls))) AS line FROM (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents)
), nb AS (
  SELECT *, trim(s, ' ' || chr(9) || chr(13) || chr(11) || chr(12)) AS t FROM x
), one AS (
  SELECT doc_id, line, t, row_number() OVER (PARTITION BY t ORDER BY doc_id, line) AS n1, lead(t) OVER d AS t2, lead(line) OVER d AS line2
  FROM nb WHERE t <> '' WINDOW d AS (PARTITION BY doc_id ORDER BY line)
), two AS (
  SELECT *, row_number() OVER (PARTITION BY t, t2 ORDER BY doc_id, line) AS n2 FROM one
), gone AS (
  SELECT doc_id, line FROM two WHERE n1 > 1 AND length(t) >= 20
  UNION SELECT doc_id, line FROM two WHERE t2 IS NOT NULL AND n2 > 1
  UNION SELECT doc_id, line2 FROM two WHERE t2 IS NOT NULL AND n2 > 1
), per AS (
  SELECT nb.doc_id, count(*) FILTER (t <> '')::BIGINT AS n_lines, count(g.line)::BIGINT AS n_removed,
    coalesce(string_agg(s, chr(10) ORDER BY nb.line) FILTER (g.line IS NULL), '') AS text
  FROM nb LEFT JOIN gone g ON nb.doc_id = g.doc_id AND nb.line = g.line GROUP BY nb.doc_id
)
SELECT d.doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_removed, 0) AS n_removed, CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(per.text, d.text) END AS text
FROM documents d LEFT JOIN per ON d.doc_id = per.doc_id
"""
