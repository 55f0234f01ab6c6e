"""Mixing sources to target weights, in DataFrame operations only.

Tokens are summed per source; targets follow from weights by a closed form of capped proportional sharing; each
document is emitted floor(rate) times plus one more time if a hash of its id falls below the fractional part.

The hash is seeded: each source takes, of ``SEEDS`` fixed seeds, the one whose outcome lands nearest its target. Every
seed gives each document the same probability, and the choice costs one more map-side-combined sum per seed.

Defined cases: a null or empty text has size 0 (its document is emitted like any other of its source, adding no
words); a null source is a source of its own, last in order; repeated rows with one id are decided alike; an empty
table gives an empty mix; a source of size 0 has target 0 and rate 0; a very long text is a size like any other; of equally near seeds the first
counts, sources with equal caps go by name. Extra columns are kept as they are, also where they have the names of ours.

Sources are numbered and ordered in windows over one row a source: sources are a dimension that fits one task (some
millions at most), whatever the number of documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import Scratch, fresh, table, word_count

SEEDS = 16
WEIGHTS = (1, 2, 3)
MOST = 3


def uniform(doc_id: Column, seed: int | Column) -> Column:
    """A number in [0, 1) from the id and the seed; four seeds share one digest."""
    s = F.lit(seed) if isinstance(seed, int) else seed
    digest = F.md5(F.concat(F.coalesce(doc_id.cast("string"), F.lit("null")), F.lit(":"), F.floor(s / 4).cast("string")).cast("binary"))
    return F.conv(F.substr(digest, (s % 4 * 8 + 1).cast("int"), F.lit(8)), 16, 10).cast("double") / F.lit(4294967296.0)


def targets(sized: DataFrame) -> DataFrame:
    """(source, source_size, weight, target): a share of all words by weight, at most MOST times the source's size.

    Capped sources form a prefix in the order of cap / weight. The level of the others is the largest value of
    (words left) / (weights left) along that order, so no rounds of resharing are needed. One row per source enters
    the windows, never one per document.
    """
    per = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    turn = (F.row_number().over(by_name) - 1) % len(WEIGHTS)
    per = per.withColumn("weight", F.element_at(F.array(*map(F.lit, WEIGHTS)), (turn + 1).cast("int")).cast("double"))
    by_cap = Window.orderBy(F.col("source_size") / F.col("weight"), F.col("source").asc_nulls_last())
    before = by_cap.rowsBetween(Window.unboundedPreceding, -1)
    after = by_cap.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy()
    left = F.sum("source_size").over(everything) - MOST * F.coalesce(F.sum("source_size").over(before), F.lit(0))
    per = per.withColumn("level", left.cast("double") / F.sum("weight").over(after))
    target = F.least(MOST * F.col("source_size").cast("double"), F.max("level").over(everything) * F.col("weight"))
    return per.select("source", "source_size", "weight", target.alias("target"))


def copies(doc_id: Column, rate: Column, seed: Column) -> Column:
    return (F.floor(rate) + F.when(uniform(doc_id, seed) < rate - F.floor(rate), 1).otherwise(0)).cast("long")


def plan(spark: SparkSession, docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(doc_id, source, size) of every row, and per source its size, target, rate and seed; both as written tables."""
    scratch = Scratch(spark, "mix")
    sized = scratch.cut(docs.select("doc_id", "source", word_count("text").alias("size")))
    per = targets(sized).withColumn("rate", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0))
    per = scratch.cut(per)
    r = per.select(F.col("source").alias("_source"), "rate")
    tried = sized.join(r, F.col("source").eqNullSafe(F.col("_source")))
    sums = [F.sum(F.col("size") * copies(F.col("doc_id"), F.col("rate"), F.lit(s))).alias(f"taken_{s}") for s in range(SEEDS)]
    tried = tried.groupBy("source").agg(*sums)
    tried = tried.select(F.col("source").alias("_source"), F.array(*[f"taken_{s}" for s in range(SEEDS)]).alias("tried"))
    gaps = F.transform("tried", lambda x: F.abs(x.cast("double") - F.col("target")))
    seeded = per.join(tried, F.col("source").eqNullSafe(F.col("_source"))).withColumn("seed", (F.array_position(gaps, F.array_min(gaps)) - 1).cast("int"))
    return sized, scratch.cut(seeded.select("source", "source_size", "target", "rate", "seed"))


def decide(docs: DataFrame, per_source: DataFrame) -> DataFrame:
    """docs with source_size, target and copies joined on; only the row's id and source are looked at."""
    src, size, target, rate, seed, n = fresh(docs, "mix_source", "source_size", "target", "mix_rate", "mix_seed", "copies")
    p = per_source.select(*[F.col(c).alias(name) for c, name in zip(("source", "source_size", "target", "rate", "seed"), (src, size, target, rate, seed), strict=True)])
    joined = docs.join(p, docs["source"].eqNullSafe(p[src])).withColumn(n, copies(docs["doc_id"], F.col(rate), F.col(seed)))
    return joined.drop(src, rate, seed)


def mix(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """The mix itself: each row of docs as often as it is taken, with its 1-based copy_no."""
    _, per = plan(spark, docs)
    out = decide(docs, per)
    n, no = out.columns[-1], fresh(docs, "copy_no")[0]
    return out.filter(F.col(n) > 0).select(*docs.columns, F.explode(F.sequence(F.lit(1).cast("long"), F.col(n))).alias(no))


def op7_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    sized, per = plan(spark, table(spark, sf_dir, "documents"))
    out = decide(sized, per)
    return out.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


SQL_OP7 = r"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size FROM documents
), per AS (
  SELECT source, sum(size)::BIGINT AS source_size, ((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::DOUBLE AS weight
  FROM sized GROUP BY source
), lev AS (
  SELECT *, (sum(source_size) OVER () - 3 * coalesce(sum(source_size) OVER (ORDER BY source_size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
    / sum(weight) OVER (ORDER BY source_size / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM per
), tgt AS (
  SELECT source, source_size, least(3 * source_size::DOUBLE, max(level) OVER () * weight) AS target FROM lev
), rated AS (
  SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0 END AS rate FROM tgt
), tried AS (
  SELECT d.doc_id, d.source, d.size, r.source_size, r.target, s.seed,
    (floor(r.rate) + CASE WHEN ('0x' || substr(md5(coalesce(d.doc_id::VARCHAR, 'null') || ':' || (s.seed // 4)::VARCHAR), (s.seed % 4 * 8 + 1)::BIGINT, 8))::BIGINT / 4294967296.0
      < r.rate - floor(r.rate) THEN 1 ELSE 0 END)::BIGINT AS copies
  FROM sized d JOIN rated r ON d.source IS NOT DISTINCT FROM r.source CROSS JOIN (SELECT unnest(range(16)) AS seed) s
), best AS (
  SELECT source, arg_min(seed, (gap, seed)) AS seed FROM (
    SELECT source, seed, abs(sum(size * copies)::DOUBLE - any_value(target)) AS gap FROM tried GROUP BY source, seed) GROUP BY source
)
SELECT t.doc_id, t.size, t.source_size, t.target, (t.size * t.copies)::BIGINT AS taken
FROM tried t JOIN best b ON t.source IS NOT DISTINCT FROM b.source AND t.seed = b.seed
"""
