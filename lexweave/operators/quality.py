"""Data-quality checks. A check is a table of (code, severity, item); a report groups them with a few items each."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..model import DIRECTED_TYPES, ISA_TYPES, POS, STANDARD_CONCEPT_TYPES, STANDARD_SENSE_TYPES, Lexicon
from . import graph
from .stats import _union

CRITICAL, WARNING, INFO = "CRITICAL", "WARNING", "INFO"
MOST_ITEMS = 10


def _issues(df: DataFrame, code: str, severity: str, item) -> DataFrame:
    return df.select(F.lit(code).alias("code"), F.lit(severity).alias("severity"), (F.col(item) if isinstance(item, str) else item).cast("string").alias("item"))


def entries_without_forms(entries: DataFrame, forms: DataFrame, senses: DataFrame) -> DataFrame:
    """(id, lost_senses) of entries (id) that no form (entry_id) names."""
    bare = entries.join(forms.select(F.col("entry_id").alias("id")), "id", "left_anti")
    lost = senses.groupBy(F.col("entry_id").alias("id")).agg(F.count("*").alias("lost_senses"))
    return bare.join(lost, "id", "left").select("id", F.coalesce("lost_senses", F.lit(0)).alias("lost_senses"))


def concepts_without_gloss(concepts: DataFrame, glosses: DataFrame, senses: DataFrame) -> DataFrame:
    bare = concepts.join(glosses.select(F.col("synset_id").alias("id")), "id", "left_anti")
    lost = senses.groupBy(F.col("synset_id").alias("id")).agg(F.count("*").alias("lost_senses"))
    return bare.join(lost, "id", "left").select("id", F.coalesce("lost_senses", F.lit(0)).alias("lost_senses"))


def self_loops(relations: DataFrame) -> DataFrame:
    return relations.filter(F.col("source") == F.col("target")).select("source", "type").distinct()


def contradictions(relations: DataFrame, types: tuple[str, ...] = DIRECTED_TYPES) -> DataFrame:
    """(type, low, high), once per pair that a directed type relates both ways."""
    r = relations.filter(F.col("type").isin(*types) & (F.col("source") != F.col("target")))
    up = F.col("source") < F.col("target")
    g = r.groupBy("type", F.least("source", "target").alias("low"), F.greatest("source", "target").alias("high")).agg(F.max(up).alias("a"), F.max(~up).alias("b"))
    return g.filter("a AND b").select("type", "low", "high")


def undeclared_entries(senses: DataFrame, entries: DataFrame) -> DataFrame:
    return senses.join(entries.select(F.col("id").alias("entry_id")), "entry_id", "left_anti").select("id", "entry_id")


def unanchored_examples(examples: DataFrame, annotations: DataFrame, senses: DataFrame) -> DataFrame:
    """(id, annotations): examples without an annotation that names a known sense."""
    known = annotations.join(senses.select(F.col("id").alias("sense_id")), "sense_id", "left_semi")
    n = annotations.groupBy(F.col("example_id").alias("id")).agg(F.count("*").alias("annotations"))
    return examples.join(known.select(F.col("example_id").alias("id")), "id", "left_anti").join(n, "id", "left").select("id", F.coalesce("annotations", F.lit(0)).alias("annotations"))


def nonstandard_types(relations: DataFrame, standard: tuple[str, ...]) -> DataFrame:
    return relations.filter(~F.col("type").isin(*standard)).groupBy("type").agg(F.count("*").alias("n"))


def duplicate_ids(df: DataFrame, column: str = "id") -> DataFrame:
    return df.groupBy(F.col(column).alias("id")).agg(F.count("*").alias("n")).filter("n > 1")


def glossed_without_senses(concepts: DataFrame, glosses: DataFrame, senses: DataFrame) -> DataFrame:
    glossed = concepts.join(glosses.select(F.col("synset_id").alias("id")), "id", "left_semi")
    return glossed.join(senses.select(F.col("synset_id").alias("id")), "id", "left_anti").select("id")


def hypernym_loops(spark: SparkSession, relations: DataFrame) -> DataFrame:
    return graph.representative_cycles(spark, relations.filter(F.col("type").isin(*ISA_TYPES)))


def keyref_violations(df: DataFrame, column: str, keys: DataFrame, key: str = "id") -> DataFrame:
    """(column, n): values that reference no key."""
    bad = df.filter(F.col(column).isNotNull()).join(keys.select(F.col(key).alias(column)), column, "left_anti")
    return bad.groupBy(F.col(column).alias("value")).agg(F.count("*").alias("n"))


def enum_violations(df: DataFrame, column: str, allowed: tuple[str, ...] = POS) -> DataFrame:
    return df.filter(~F.coalesce(F.col(column).isin(*allowed), F.lit(False))).groupBy(F.col(column).alias("value")).agg(F.count("*").alias("n"))


#: Foreign keys of the model: table, column, referenced table.
KEYREFS = (
    ("entries", "language_id", "languages"), ("forms", "entry_id", "entries"), ("pronunciations", "form_id", "forms"), ("senses", "entry_id", "entries"), ("senses", "synset_id", "synsets"),
    ("definitions", "synset_id", "synsets"), ("definitions", "language_id", "languages"), ("synset_relations", "source", "synsets"), ("synset_relations", "target", "synsets"),
    ("sense_relations", "source", "senses"), ("sense_relations", "target", "senses"), ("sense_examples", "sense_id", "senses"), ("sense_examples", "example_id", "examples"),
    ("definition_annotations", "definition_id", "definitions"), ("definition_annotations", "sense_id", "senses"), ("example_annotations", "example_id", "examples"), ("example_annotations", "sense_id", "senses"),
)


def integrity(lex: Lexicon) -> DataFrame:
    """(rule, n): broken keys, references and enumerations of a lexicon."""
    parts = []
    for table, column, other in KEYREFS:
        v = keyref_violations(lex.tables[table], column, lex.tables[other])
        parts.append(v.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).select(F.lit(f"{table}.{column} -> {other}").alias("rule"), "n"))
    for table in ("synsets", "entries", "forms", "senses", "definitions", "examples"):
        parts.append(duplicate_ids(lex.tables[table]).agg(F.count("*").alias("n")).select(F.lit(f"{table}.id unique").alias("rule"), "n"))
    for table in ("synsets", "entries"):
        parts.append(enum_violations(lex.tables[table], "pos").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).select(F.lit(f"{table}.pos known").alias("rule"), "n"))
    return _union(parts)


def metric_issues(log: DataFrame) -> DataFrame:
    """Issues from a converter log of (resource, metric, key, n): every metric that a rule names and n > 0."""
    rules = {
        "pos_mismatch_concept": WARNING, "pos_mismatch_lexeme": WARNING, "skipped_existing": INFO, "category_mismatch": WARNING, "missing_ili": INFO, "unresolved_synset": WARNING, "unmatched_example": INFO,
    }
    severity = F.element_at(F.create_map(*[F.lit(x) for kv in rules.items() for x in kv]), F.col("metric"))
    hits = log.filter((F.col("n") > 0) & F.col("metric").isin(*rules))
    return hits.select(F.col("metric").alias("code"), severity.alias("severity"), F.concat_ws(" ", "resource", "key", F.col("n").cast("string")).alias("item"))


def conflict_issues(reversed_relations: DataFrame, cycles: DataFrame, resource: str | None = None) -> DataFrame:
    """Issues from the merge's logs, of one resource or all."""
    r = reversed_relations if resource is None else reversed_relations.filter(F.col("resource") == resource)
    a = _issues(r, "reversed relation", CRITICAL, F.concat_ws(" ", F.col("source").cast("string"), "type", F.col("target").cast("string"), F.concat(F.lit("against "), "prior_resource")))
    b = _issues(cycles, "cycle across resources", CRITICAL, F.array_join(F.transform("chain", lambda x: x.cast("string")), " > "))
    return a.unionByName(b)


def labels(concepts: DataFrame, senses: DataFrame, forms: DataFrame, entries: DataFrame, languages: DataFrame, local: str) -> DataFrame:
    """(id, label): id [local form/English form], each the first sense's lemma in that language."""
    f = forms.filter("rank = 0").select("entry_id", "form")
    e = entries.select(F.col("id").alias("entry_id"), "language_id").join(languages.select(F.col("id").alias("language_id"), "code"), "language_id")
    s = senses.select(F.col("id").alias("sense_id"), "entry_id", F.col("synset_id").alias("id")).join(e, "entry_id").join(f, "entry_id")
    first = lambda code, name: s.filter(F.col("code") == code).groupBy("id").agg(F.min_by("form", "sense_id").alias(name))
    out = concepts.select("id").join(first(local, "a"), "id", "left").join(first("en", "b"), "id", "left")
    shown = F.concat_ws("/", "a", *([] if local == "en" else ["b"]))
    return out.select("id", F.when(shown == "", F.col("id").cast("string")).otherwise(F.concat(F.col("id").cast("string"), F.lit(" ["), shown, F.lit("]"))).alias("label"))


def run_checks(spark: SparkSession, lex: Lexicon) -> DataFrame:
    """All checks of one resource's tables as (code, severity, item)."""
    both = lex.synset_relations.unionByName(lex.sense_relations)
    pair = F.concat_ws(" ", "type", F.col("low").cast("string"), F.col("high").cast("string"))
    return _union([
        _issues(entries_without_forms(lex.entries, lex.forms, lex.senses), "entry without forms", CRITICAL, "id"),
        _issues(concepts_without_gloss(lex.synsets, lex.definitions, lex.senses), "concept without gloss", CRITICAL, "id"),
        _issues(hypernym_loops(spark, lex.synset_relations), "hypernym loop", CRITICAL, F.array_join(F.transform("cycle", lambda x: x.cast("string")), " > ")),
        *[_issues(duplicate_ids(lex.tables[t]), f"duplicate id in {t}", CRITICAL, "id") for t in ("synsets", "entries", "senses")],
        _issues(self_loops(both), "self-loop", WARNING, "source"),
        _issues(contradictions(lex.synset_relations), "contradictory directions", WARNING, pair),
        _issues(undeclared_entries(lex.senses, lex.entries), "sense of undeclared entry", WARNING, "id"),
        _issues(unanchored_examples(lex.examples, lex.example_annotations, lex.senses), "example without known sense", WARNING, "id"),
        _issues(nonstandard_types(lex.synset_relations, STANDARD_CONCEPT_TYPES), "non-standard concept relation", INFO, "type"),
        _issues(nonstandard_types(lex.sense_relations, STANDARD_SENSE_TYPES), "non-standard sense relation", INFO, "type"),
        _issues(glossed_without_senses(lex.synsets, lex.definitions, lex.senses), "glossed concept without senses", INFO, "id"),
    ])


def report(issues: DataFrame) -> DataFrame:
    """(severity, code, total, items): at most MOST_ITEMS items each. Items are numbered within a code by a window whose
    top-k is cut on the map side, so no list of all items is built."""
    from pyspark.sql import Window

    w = Window.partitionBy("severity", "code").orderBy("item")
    top = issues.withColumn("k", F.row_number().over(w)).filter(F.col("k") <= MOST_ITEMS)
    shown = top.groupBy("severity", "code").agg(F.sort_array(F.collect_list("item")).alias("items"))
    return issues.groupBy("severity", "code").agg(F.count("*").alias("total")).join(shown, ["severity", "code"]).select("severity", "code", "total", "items")


def format_report(name: str, rows: list, markdown: bool = False) -> str:
    """Text of a collected report, most severe first."""
    out = [f"# {name}" if markdown else name]
    for severity in (CRITICAL, WARNING, INFO):
        own = sorted((r for r in rows if r["severity"] == severity), key=lambda r: r["code"])
        if not own:
            continue
        out.append(f"## {severity}" if markdown else f"[{severity}]")
        for r in own:
            out.append(f"{'- ' if markdown else '  '}{r['code']}: {r['total']}")
            out += [f"{'  - ' if markdown else '    '}{x}" for x in r["items"]]
            if r["total"] > len(r["items"]):
                out.append(f"{'  - ' if markdown else '    '}and {r['total'] - len(r['items'])} more")
    if len(out) == 1:
        out.append("no issues")
    return "\n".join(out) + "\n"
