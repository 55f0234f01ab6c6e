"""Statistics, coverage, fingerprints and their comparison, log metrics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..model import Lexicon
from .search import star


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def totals(lex: Lexicon) -> DataFrame:
    """(metric, value): synsets, entries, senses, languages with entries, resources."""
    one = lambda name, df, agg=F.count("*"): df.agg(agg.cast("long").alias("value")).select(F.lit(name).alias("metric"), "value")
    return _union([one("synsets", lex.synsets), one("entries", lex.entries), one("senses", lex.senses), one("languages", lex.entries, F.countDistinct("language_id")), one("resources", lex.resources)])


def distribution(df: DataFrame, key: str, top: int | None = None) -> DataFrame:
    out = df.groupBy(F.col(key).cast("string").alias("key")).agg(F.count("*").alias("n"))
    return out.orderBy(F.desc("n"), F.col("key").asc_nulls_last()).limit(top) if top else out


def top_resources(lex: Lexicon, n: int = 10) -> DataFrame:
    """Resources by senses, with their language; a sort of the top rows only."""
    r = lex.resources.select("code", F.col("language").alias("language"), "synset_count", "sense_count").filter("sense_count IS NOT NULL")
    return r.orderBy(F.desc("sense_count"), "code").limit(n)


def words_per_resource(lex: Lexicon) -> DataFrame:
    """(code, words, senses, synsets): distinct entries, senses and concepts that a resource's provenance reaches."""
    p = lex.provenance.filter("table_name = 'senses'").select(F.col("resource").alias("code"), F.col("item_id").alias("id"))
    s = p.join(lex.senses.select("id", "entry_id", "synset_id"), "id")
    return s.groupBy("code").agg(F.countDistinct("entry_id").alias("words"), F.countDistinct("id").alias("senses"), F.countDistinct("synset_id").alias("synsets"))


def fingerprint(lex: Lexicon, spots: tuple[tuple[str, str], ...] = ()) -> DataFrame:
    """(metric, key, value): row counts, distributions, coverage and spot checks of (norm, language)."""
    parts = [df.agg(F.count("*").alias("value")).select(F.lit("rows").alias("metric"), F.lit(name).alias("key"), "value") for name, df in lex.tables.items()]
    dist = lambda metric, df, key: distribution(df, key).select(F.lit(metric).alias("metric"), "key", F.col("n").alias("value"))
    g = lex.languages.select(F.col("id").alias("language_id"), "code")
    parts += [dist("synsets by pos", lex.synsets, "pos"), dist("entries by language", lex.entries.join(g, "language_id"), "code"), dist("synset relations by type", lex.synset_relations, "type"), dist("sense relations by type", lex.sense_relations, "type"), dist("provenance by table", lex.provenance, "table_name")]
    one = lambda key, df, agg: df.agg(agg.cast("long").alias("value")).select(F.lit("coverage").alias("metric"), F.lit(key).alias("key"), "value")
    parts += [one("concepts with ili", lex.synsets, F.count("ili")), one("concepts with definition", lex.definitions, F.countDistinct("synset_id")), one("annotated definitions", lex.definition_annotations, F.countDistinct("definition_id")), one("annotated examples", lex.example_annotations, F.countDistinct("example_id"))]
    for norm, language in spots:
        hits = star(lex, lex.forms.filter(F.col("norm") == norm)).filter(F.col("language") == language)
        parts.append(hits.agg(F.count("*").alias("value")).select(F.lit("spot").alias("metric"), F.lit(f"{language}:{norm}").alias("key"), "value"))
    return _union(parts)


def compare(before: DataFrame, after: DataFrame, keys: tuple[str, ...] = ("metric", "key"), value: str = "value") -> DataFrame:
    """Keys whose value differs, null-safe: (keys, before, after)."""
    b, a = before.select(*keys, F.col(value).alias("before")), after.select(*[F.col(k).alias(f"_{k}") for k in keys], F.col(value).alias("after"))
    cond = None
    for k in keys:
        c = F.col(k).eqNullSafe(F.col(f"_{k}"))
        cond = c if cond is None else cond & c
    out = b.join(a, cond, "full_outer")
    return out.filter(~F.col("before").eqNullSafe(F.col("after"))).select(*[F.coalesce(k, f"_{k}").alias(k) for k in keys], "before", "after")


def case_variants(lex: Lexicon) -> DataFrame:
    """(language_id, folded, forms): entries of one language whose lemmas differ in case only."""
    from ..functions.text import ascii_lower
    from .post import lemmas

    e = lex.entries.select(F.col("id").alias("entry_id"), "language_id", "pos").join(lemmas(lex.forms), "entry_id")
    g = e.groupBy("language_id", "pos", ascii_lower(F.col("lemma")).alias("folded")).agg(F.countDistinct("lemma").alias("variants"))
    return g.filter("variants > 1")


def mismatch_histogram(rows: DataFrame, a: str, b: str) -> DataFrame:
    """(a, b, n) of the pairs that differ."""
    return rows.filter(~F.col(a).eqNullSafe(F.col(b))).groupBy(a, b).agg(F.count("*").alias("n"))


def success_rate(done: Column, of: Column) -> Column:
    """Percent, to one place; null of none."""
    return F.when(of > 0, F.round(100 * done / of, 1))


def example_table(log: DataFrame) -> DataFrame:
    """(wordnet, included, excluded) of those with any example. log: (wordnet, included, excluded)."""
    out = log.groupBy("wordnet").agg(F.sum("included").alias("included"), F.sum("excluded").alias("excluded"))
    return out.filter(F.col("included") + F.col("excluded") > 0)


def comparison_table(lex: Lexicon, other: dict[str, int]) -> DataFrame:
    """(metric, ours, theirs) for totals against another library's numbers."""
    theirs = F.element_at(F.create_map(*[x for k, v in other.items() for x in (F.lit(k), F.lit(v))]), F.col("metric")) if other else F.lit(None).cast("int")
    return totals(lex).select("metric", F.col("value").alias("ours"), theirs.cast("long").alias("theirs"))
