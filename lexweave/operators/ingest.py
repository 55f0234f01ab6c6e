"""From ordered XML records to the tables of the lexicon.

Arrival order seq = (resource_ord, element_ord) decides everything: first-wins keys, ranks, ids, and which references
resolve. With resolve="arrival" a reference counts only if its target arrived before it; "global" keeps forward ones.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import with_norm
from ..model import CONCEPT_INVERSES, ISA_TYPES, SENSE_INVERSES, Lexicon
from ..scratch import Scratch
from . import graph, post
from .ids import number
from .relations import resolve

def _seq() -> Column:
    return F.struct("resource_ord", "element_ord").alias("seq")


def _of(elements: DataFrame, tag: str, **columns: str) -> DataFrame:
    return elements.filter(F.col("tag") == tag).select(_seq(), *[F.col("attrs")[v].alias(k) for k, v in columns.items()], "text", "spans", "children")


def _arrived(ref: Column, target: Column, mode: str) -> Column:
    return ref > target if mode == "arrival" else F.lit(True)


def _lookup(rows: DataFrame, key: str, ids: DataFrame, out: str, mode: str) -> DataFrame:
    """rows with out = the id of ids (key, id, seq) that rows[key] names; unresolved rows go."""
    named = ids.select(F.col("key").alias("_key"), F.col("id").alias(out), F.col("seq").alias("_seq"))
    joined = rows.join(named, F.col(key) == F.col("_key"))
    return joined.filter(_arrived(F.col("seq"), F.col("_seq"), mode)).drop("_key", "_seq")


def provenance_of(items: DataFrame, table: str) -> DataFrame:
    """Provenance rows of items (id, seq, children); children without a resource are skipped."""
    p = items.select("id", "seq", F.posexplode(F.filter("children", lambda c: (c["path"] == "Provenance") & c["attrs"]["resource"].isNotNull() & (c["attrs"]["resource"] != ""))).alias("k", "c"))
    return p.select(F.lit(table).alias("table_name"), F.col("id").alias("item_id"), F.col("c.attrs")["resource"].alias("resource"), F.col("c.attrs")["version"].alias("version"), F.col("c.attrs")["original_id"].alias("original_id"))


def _first_resource(children: str = "children") -> Column:
    first = F.get(F.filter(children, lambda c: c["path"] == "Provenance"), F.lit(0))
    return F.coalesce(first["attrs"]["resource"], F.lit(""))


def build(spark: SparkSession, elements: DataFrame, mode: str = "arrival", clean: bool = True) -> tuple[Lexicon, dict[str, DataFrame]]:
    """The lexicon of the elements, and logs: reversed (conflicts), cycles (removed is-a edges), roots."""
    scratch = Scratch(spark, "ingest")
    elements = scratch.cut(elements)
    concepts = _of(elements, "Concept", key="id", pos="ontological_category")
    twice = concepts.groupBy("key").count().filter("count > 1").select("key").first()
    if twice:
        raise ValueError(f"Duplicate concept id: {twice['key']}")
    concepts = scratch.cut(number(concepts, ["seq"]))
    synset_ids = concepts.select("key", "id", "seq")
    ili = F.when(F.startswith("key", F.lit("cili.")), F.expr("substring(key, 6)"))
    synsets = concepts.select("id", ili.alias("ili"), "pos")

    lexemes = _of(elements, "Lexeme", key="id", language="language", pos="grammatical_category")
    wordforms = lexemes.select("key", "seq", F.posexplode(F.filter("children", lambda c: (c["path"] == "Wordform") & (F.coalesce(c["attrs"]["form"], F.lit("")) != ""))).alias("k", "w"), "children")
    wordforms = wordforms.select("key", F.col("w.attrs")["form"].alias("form"), F.struct("seq", "k").alias("at"), F.col("w.ord").alias("ord"), "children")
    forms = wordforms.groupBy("key", "form").agg(F.min_by(F.struct("at", "ord", "children"), "at").alias("x")).select("key", "form", "x.at", "x.ord", "x.children")
    whole = lexemes.join(forms.select("key").distinct(), "key", "left_semi").groupBy("key").agg(F.min_by(F.struct("seq", "language", "pos"), "seq").alias("x")).select("key", "x.*")
    whole = scratch.cut(number(whole, ["seq"]))
    entry_ids = whole.select("key", "id", "seq")

    senses = _of(elements, "Sense", key="id", signifier="signifier", signified="signified")
    senses = _lookup(_lookup(senses, "signifier", entry_ids, "entry_id", mode), "signified", synset_ids, "synset_id", mode)
    senses = senses.groupBy("entry_id", "synset_id").agg(F.min_by(F.struct("seq", "key", "children"), "seq").alias("x")).select("entry_id", "synset_id", "x.*")
    senses = scratch.cut(number(senses, ["seq"]))
    sense_ids = senses.select("key", "id", "seq").groupBy("key").agg(F.max_by(F.struct("id", "seq"), "seq").alias("x")).select("key", "x.id", "x.seq")

    glosses = _lookup(_of(elements, "Gloss", definiendum="definiendum", language="language"), "definiendum", synset_ids, "synset_id", mode)
    glosses = glosses.groupBy("synset_id", "language").agg(F.min_by(F.struct("seq", "text", "spans", "children"), "seq").alias("x")).select("synset_id", "language", "x.*")
    glosses = scratch.cut(number(glosses, ["seq"]))

    # Languages in the order in which entries and glosses that are kept name them.
    named = whole.select(F.col("language").alias("code"), "seq").unionByName(glosses.select(F.col("language").alias("code"), "seq")).filter("code IS NOT NULL")
    languages = number(named.groupBy("code").agg(F.min("seq").alias("seq")), ["seq"]).select("id", "code", F.lit(None).cast("string").alias("name"))
    languages = scratch.cut(languages)
    lang = languages.select(F.col("code").alias("language"), F.col("id").alias("language_id"))
    entries = whole.join(lang, "language", "left").select("id", "language_id", "pos")

    from pyspark.sql import Window

    ranked = forms.join(entry_ids.select("key", F.col("id").alias("entry_id")), "key")
    ranked = ranked.withColumn("rank", (F.row_number().over(Window.partitionBy("entry_id").orderBy("at")) - 1).cast("int"))
    ranked = scratch.cut(number(ranked, ["at"]))
    form_table = with_norm(ranked.select("id", "entry_id", "form", "rank")).select("id", "entry_id", "form", "norm", "rank")
    prons = ranked.select("id", "ord", "at", F.posexplode("children").alias("k", "c")).filter((F.col("c.path") == "Wordform/Pronunciation") & (F.col("c.parent") == F.col("ord")) & (F.coalesce("c.text", F.lit("")) != ""))
    prons = number(prons.select(F.col("id").alias("form_id"), "at", "k", F.col("c.attrs")["variety"].alias("variety"), F.col("c.text").alias("pron")), ["at", "k"]).select("id", "form_id", "variety", "pron")

    def spans_of(items: DataFrame, name: str) -> DataFrame:
        s = items.select(F.col("id").alias(name), "seq", F.explode("spans").alias("s")).select(name, "seq", "s.start", "s.end", F.col("s.sense").alias("ref"))
        return _lookup(s, "ref", sense_ids, "sense_id", mode).select(name, "start", "end", "sense_id")

    raw = _of(elements, "Example")
    refs = _lookup(raw.select("seq", F.explode("spans").alias("s")).select("seq", F.col("s.sense").alias("ref")), "ref", sense_ids, "sense_id", mode).select("seq", "sense_id").distinct()
    examples = scratch.cut(number(raw.join(refs.select("seq").distinct(), "seq", "left_semi"), ["seq"]))
    sense_examples = refs.join(examples.select("seq", F.col("id").alias("example_id")), "seq").select("sense_id", "example_id")

    logs: dict[str, DataFrame] = {}
    relation_tables = {}
    for kind, tag, ids, inverses in (("sense", "SenseRelation", sense_ids, SENSE_INVERSES), ("synset", "ConceptRelation", synset_ids, CONCEPT_INVERSES)):
        r = _of(elements, tag, type="relation_type", a="source", b="target").withColumn("resource", _first_resource())
        r = scratch.cut(_lookup(_lookup(r, "a", ids, "source", mode), "b", ids, "target", mode).select("seq", "type", "source", "target", "resource", "children"))
        stored, conflicts, cycles = fold(spark, r, inverses, scratch, remove_cycles=kind == "synset")
        stored = scratch.cut(number(stored, ["seq", "generated"]))
        relation_tables[f"{kind}_relations"] = stored.select("id", "source", "target", "type")
        p = stored.filter("NOT generated").join(r.select("seq", "children"), "seq")
        relation_tables[f"{kind}_prov"] = provenance_of(p, f"{kind}_relations")
        named = conflicts.select(F.lit(kind).alias("kind"), "source", "target", "type", "resource", "prior_resource")
        logs["reversed"] = named if "reversed" not in logs else logs["reversed"].unionByName(named)
        if cycles is not None:
            logs["cycles"] = cycles

    prov = provenance_of(concepts, "synsets").unionByName(provenance_of(senses, "senses")).unionByName(provenance_of(glosses, "definitions")).unionByName(provenance_of(examples, "examples"))
    all_lexemes = lexemes.join(entry_ids.select("key", "id"), "key").select("id", "seq", "children")
    prov = prov.unionByName(provenance_of(all_lexemes, "entries")).unionByName(relation_tables.pop("sense_prov")).unionByName(relation_tables.pop("synset_prov"))
    types = relation_tables["sense_relations"].select("type").unionByName(relation_tables["synset_relations"].select("type")).distinct()
    logs["roots"] = elements.groupBy(F.col("resource_ord").alias("ord")).agg(F.min_by("root", "element_ord").alias("root"))
    lex = Lexicon.of(
        spark, languages=languages, synsets=synsets, entries=entries, forms=form_table, pronunciations=prons, relation_types=number(types, ["type"]).select("id", "type"),
        senses=senses.select("id", "entry_id", "synset_id", F.lit(None).cast("int").alias("sense_index")),
        definitions=glosses.join(lang, "language", "left").select("id", "synset_id", F.col("text").alias("definition"), "language_id"),
        definition_annotations=spans_of(glosses, "definition_id"), examples=examples.select("id", F.col("text").alias("example")), sense_examples=sense_examples,
        example_annotations=spans_of(examples, "example_id"), provenance=scratch.cut(prov), **relation_tables,
    )
    if clean:
        lex, _ = post.merge_case_variants(lex)
        lex = post.remove_orphans(post.cascade_delete(lex))
        lex = lex.with_(senses=post.sense_indices(lex))
    # Searches read written tables, not the whole merge again.
    lex = Lexicon({name: scratch.cut(df) for name, df in lex.tables.items()})
    return lex.with_(resources=scratch.cut(post.resource_table(spark, logs["roots"], lex))), logs


def fold(spark: SparkSession, relations: DataFrame, inverses: dict[str, str], scratch: Scratch, remove_cycles: bool):
    """Relations resolved resource by resource as far as cycles make it necessary.

    All resources are resolved at once. Only if that leaves a cycle does the order matter: removed edges are forgotten
    and may arrive again, so then each resource is resolved on what the earlier ones left.
    """
    columns = ["source", "target", "type", "seq", "resource"]
    stored, conflicts = resolve(relations.select(*columns), inverses)
    if not remove_cycles:
        return stored, conflicts, None
    isa = scratch.cut(stored.filter(F.col("type").isin(*ISA_TYPES)))
    if graph.cyclic_nodes(spark, isa).isEmpty():
        return stored, conflicts, spark.createDataFrame([], "resource_ord int, source long, target long, chain array<long>")
    kept, clashes, logged = None, None, None
    for ord_ in [r[0] for r in relations.select("seq.resource_ord").distinct().orderBy("resource_ord").collect()]:
        part = relations.filter(F.col("seq.resource_ord") == ord_).select(*columns)
        if kept is not None:
            part = part.unionByName(kept.filter("NOT generated").join(relations.select(*columns), ["source", "target", "type", "seq"]).select(*columns))
        now, clash = resolve(part, inverses)
        now = scratch.cut(now)
        edges = now.filter(F.col("type").isin(*ISA_TYPES)).withColumn("is_new", F.col("seq.resource_ord") == ord_)
        _, gone = graph.remove_new_cycles(spark, edges)
        gone = scratch.cut(gone)
        clash = clash.filter(F.col("seq.resource_ord") == ord_)
        if not gone.isEmpty():
            there = gone.select("source", "target")
            back = there.select(F.col("target").alias("source"), F.col("source").alias("target"))
            own = now.filter(F.col("type").isin(*ISA_TYPES) & (F.col("seq.resource_ord") == ord_)).join(there, ["source", "target"], "left_semi")
            inverse = now.filter(F.col("type").isin(*[inverses[t] for t in ISA_TYPES]) & (F.col("seq.resource_ord") == ord_)).join(back, ["source", "target"], "left_semi")
            now = scratch.cut(now.join(own.unionByName(inverse).select("source", "target", "type"), ["source", "target", "type"], "left_anti"))
        gone = gone.select(F.lit(ord_).alias("resource_ord"), "source", "target", "chain")
        kept, clashes = now, clash if clashes is None else clashes.unionByName(clash)
        logged = gone if logged is None else logged.unionByName(gone)
    return kept, clashes, logged
