"""Typed relations: inverses, first-wins dedup and reversed-direction conflicts, as set operations.

A row-by-row rule says: a relation is skipped as a conflict if its type is not its own inverse and the same type is
already stored the other way round; otherwise it is stored unless present, and so is its inverse. The closed form groups
by type and unordered pair, so no order of execution is needed:

* forward types (with an inverse other than themselves): the direction that arrives first wins, the other is a conflict;
* self-inverse types: both directions are stored, nothing conflicts;
* other types (inverse names stated outright, and types without inverse): a row of direction d is stored unless the other
  direction was stored before it, by generation from a forward row or by an explicit row that was itself stored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _lookup(pairs: dict[str, str | None], c: Column) -> Column:
    kv = [F.lit(x) for k, v in pairs.items() if v is not None for x in (k, v)]
    return F.element_at(F.create_map(*kv), c) if kv else F.lit(None).cast("string")


def with_inverses(relations: DataFrame, inverses: dict[str, str]) -> DataFrame:
    """(source, target, type) with each row's inverse, distinct."""
    base = relations.select("source", "target", "type")
    back = base.select(F.col("target").alias("source"), F.col("source").alias("target"), _lookup(inverses, F.col("type")).alias("type")).filter(F.col("type").isNotNull())
    return base.unionByName(back).distinct()


def resolve(relations: DataFrame, inverses: dict[str, str]) -> tuple[DataFrame, DataFrame]:
    """(stored, conflicts) of relations (source, target, type, seq, resource); seq is a total order of arrival.

    stored: (source, target, type, seq, generated), one row a relation, seq and generated of what made it.
    conflicts: (source, target, type, seq, resource, prior_resource); prior is 'auto-generated' for a generated row.
    """
    columns = ["source", "target", "type", "seq", "resource"]
    rows = relations.select(*columns).withColumn("inverse", _lookup(inverses, F.col("type")))
    low, high = F.least("source", "target"), F.greatest("source", "target")
    forward_side = (F.col("source") <= F.col("target")).alias("up")
    keyed = rows.select(*columns, "inverse", low.alias("low"), high.alias("high"), forward_side)
    symmetric = keyed.filter(F.col("inverse") == F.col("type"))
    forward = keyed.filter((F.col("inverse") != F.col("type")) & F.col("inverse").isNotNull())
    other = keyed.filter(F.col("inverse").isNull())

    # Forward types: of each pair the first arrival. A self-loop is its own reverse: every later one conflicts.
    first = forward.groupBy("type", "low", "high").agg(F.min(F.struct("seq", "up", "resource", "inverse")).alias("w"))
    winners = first.select("type", "low", "high", F.col("w.seq").alias("seq"), F.col("w.up").alias("up"), F.col("w.resource").alias("won"), F.col("w.inverse").alias("inverse"))
    source = F.when(F.col("up"), F.col("low")).otherwise(F.col("high"))
    target = F.when(F.col("up"), F.col("high")).otherwise(F.col("low"))
    forward_stored = winners.select(source.alias("source"), target.alias("target"), "type", "seq", F.lit(False).alias("generated"))
    generated = winners.select(target.alias("source"), source.alias("target"), F.col("inverse").alias("type"), "seq", F.lit(True).alias("generated"))
    w = winners.select(F.col("type").alias("_t"), F.col("low").alias("_l"), F.col("high").alias("_h"), F.col("seq").alias("_s"), F.col("up").alias("_u"), "won")
    met = forward.join(w, (F.col("type") == F.col("_t")) & (F.col("low") == F.col("_l")) & (F.col("high") == F.col("_h")))
    against = (F.col("up") != F.col("_u")) | ((F.col("low") == F.col("high")) & (F.col("seq") > F.col("_s")))
    forward_conflicts = met.filter(against).select(*columns, F.coalesce(F.nullif(F.col("won"), F.lit("")), F.lit("auto-generated")).alias("prior_resource"))

    is_inverse = symmetric.select("source", "target", "type", "seq", F.lit(0).alias("made")).unionByName(
        symmetric.select(F.col("target").alias("source"), F.col("source").alias("target"), "type", "seq", F.lit(1).alias("made"))
    )
    symmetric_stored = is_inverse.groupBy("source", "target", "type").agg(F.min(F.struct("seq", "made")).alias("m"))
    symmetric_stored = symmetric_stored.select("source", "target", "type", "m.seq", (F.col("m.made") == 1).alias("generated"))

    # Other types: earliest generated (g) and explicit (x) arrival in both directions of the pair.
    g = generated.select("type", F.least("source", "target").alias("low"), F.greatest("source", "target").alias("high"), (F.col("source") <= F.col("target")).alias("up"), "seq", F.lit(True).alias("gen"), F.lit("").alias("resource"))
    x = other.select("type", "low", "high", "up", "seq", F.lit(False).alias("gen"), "resource")
    events = g.unionByName(x)

    def least(up: bool, gen: bool) -> Column:
        return F.min(F.when((F.col("up") == up) & (F.col("gen") == gen), F.struct("seq", "resource")))

    pairs = events.groupBy(F.col("type").alias("_t"), F.col("low").alias("_l"), F.col("high").alias("_h")).agg(least(True, True).alias("g1"), least(True, False).alias("x1"), least(False, True).alias("g0"), least(False, False).alias("x0"))
    seen = other.join(pairs, (F.col("type") == F.col("_t")) & (F.col("low") == F.col("_l")) & (F.col("high") == F.col("_h")))
    loop = F.col("low") == F.col("high")
    pick = lambda a, b: F.when(F.col("up"), F.col(f"{a}.seq")).otherwise(F.col(f"{b}.seq"))
    before = lambda a, b: F.coalesce(a < b, F.lit(False))
    x_own, x_rev = pick("x1", "x0"), F.when(loop, F.col("x1.seq")).otherwise(pick("x0", "x1"))
    g_own, g_rev = pick("g1", "g0"), F.when(loop, F.col("g1.seq")).otherwise(pick("g0", "g1"))
    # The other direction is there when a row arrives if it was generated before, or stated before and itself stored.
    rev_stored = ~loop & x_rev.isNotNull() & ~before(g_own, x_rev) & ~(before(x_own, x_rev) & ~before(g_rev, x_own))
    rev_by_statement = rev_stored & (x_rev < F.col("seq"))
    own_first = loop & before(x_own, F.col("seq"))
    conflict = before(g_rev, F.col("seq")) | rev_by_statement | own_first
    # What was stored first names the prior resource: a generated row has none.
    gen_first = before(g_rev, F.col("seq")) & (~rev_by_statement | before(g_rev, x_rev))
    stated = F.when(loop, F.col("x1.resource")).otherwise(F.when(F.col("up"), F.col("x0.resource")).otherwise(F.col("x1.resource")))
    prior = F.when(gen_first, "auto-generated").otherwise(F.coalesce(F.nullif(stated, F.lit("")), F.lit("auto-generated")))
    judged = seen.withColumn("_conflict", conflict).withColumn("prior_resource", prior)
    other_conflicts = judged.filter("_conflict").select(*columns, "prior_resource")
    other_stored = judged.filter(~F.col("_conflict")).select("source", "target", "type", "seq", F.lit(False).alias("generated"))
    rest = other_stored.unionByName(generated).groupBy("source", "target", "type").agg(F.min(F.struct("seq", "generated")).alias("m"))
    rest = rest.select("source", "target", "type", "m.seq", "m.generated")
    return forward_stored.unionByName(symmetric_stored).unionByName(rest), forward_conflicts.unionByName(other_conflicts)


def convert(relations: DataFrame, names: dict[str, str], pairs: dict[str, str | None], existing: DataFrame | None = None) -> DataFrame:
    """(source, target, type) of a source's relations in stored form.

    Unknown types go; inverses are added, then only forward types are kept; a symmetric pair is written once, smaller
    end first; types are renamed; relations that existing already has go.
    """
    inverse_of = {v: k for k, v in pairs.items() if v is not None and v != k}
    known = relations.select("source", "target", "type").filter(F.col("type").isin(*pairs, *inverse_of)).distinct()
    turned = F.col("type").isin(*inverse_of) if inverse_of else F.lit(False)
    forward = known.select(
        F.when(turned, F.col("target")).otherwise(F.col("source")).alias("source"), F.when(turned, F.col("source")).otherwise(F.col("target")).alias("target"),
        F.coalesce(_lookup(inverse_of, F.col("type")), F.col("type")).alias("type"),
    )
    symmetric = F.col("type").isin(*[k for k, v in pairs.items() if k == v])
    ordered = forward.select(F.when(symmetric, F.least("source", "target")).otherwise(F.col("source")).alias("source"), F.when(symmetric, F.greatest("source", "target")).otherwise(F.col("target")).alias("target"), "type")
    renamed = ordered.withColumn("type", _lookup(names, F.col("type"))).filter(F.col("type").isNotNull()).distinct()
    return renamed if existing is None else renamed.join(existing.select("source", "target", "type"), ["source", "target", "type"], "left_anti")


def category_mismatches(relations: DataFrame, concepts: DataFrame, types: tuple[str, ...]) -> DataFrame:
    """(type, n, mismatched): of relations whose ends should share a category. concepts: (id, pos)."""
    a, b = concepts.select(F.col("id").alias("source"), F.col("pos").alias("a")), concepts.select(F.col("id").alias("target"), F.col("pos").alias("b"))
    joined = relations.filter(F.col("type").isin(*types)).join(a, "source").join(b, "target")
    return joined.groupBy("type").agg(F.count("*").alias("n"), F.count_if(F.col("a") != F.col("b")).alias("mismatched"))


def display_labels(types: DataFrame, config: DataFrame, language: str = "en") -> DataFrame:
    """types (type) with the label of config (name, short, labels map) found by name or short code; English as fallback."""
    by_short = config.filter("short <> name").withColumn("key", F.col("short"))
    by = config.withColumn("key", F.col("name")).unionByName(by_short).dropDuplicates(["key"])
    joined = types.join(by, types["type"] == by["key"], "left")
    return joined.select("type", F.coalesce(F.element_at("labels", language), F.element_at("labels", "en"), F.col("type")).alias("label"))
