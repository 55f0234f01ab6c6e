"""Phases after a merge, as rewrites of immutable tables: case variants, cascading deletes, orphans, sense order, resources."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import ascii_lower, extra_json, number_or_null
from ..model import CILI, IMPLICIT_RESOURCES, SCHEMAS, Lexicon


def lemmas(forms: DataFrame) -> DataFrame:
    """(entry_id, lemma): the first-ranked form of each entry, once; a form copied by a merge (negative id) comes last."""
    return forms.filter("rank = 0").groupBy("entry_id").agg(F.min_by("form", F.struct(F.col("id") < 0, "id")).alias("lemma"))


def variant_senses(lex: Lexicon) -> DataFrame:
    """(sense_id, entry_id, keep_sense, keep_entry) of senses that differ from an earlier one in the lemma's case only."""
    e = lex.entries.select(F.col("id").alias("entry_id"), "language_id", "pos")
    s = lex.senses.select(F.col("id").alias("sense_id"), "entry_id", "synset_id").join(e, "entry_id").join(lemmas(lex.forms), "entry_id")
    s = s.withColumn("folded", ascii_lower(F.col("lemma")))
    keys = ["folded", "language_id", "pos", "synset_id"]
    groups = s.groupBy(*keys).agg(F.count("*").alias("n"), F.min(F.struct("sense_id", "entry_id")).alias("keep")).filter("n > 1")
    groups = groups.select(*keys, F.col("keep.sense_id").alias("keep_sense"), F.col("keep.entry_id").alias("keep_entry"))
    return s.join(groups, keys).select("sense_id", "entry_id", "keep_sense", "keep_entry")


def remap(df: DataFrame, columns: list[str], mapping: DataFrame) -> DataFrame:
    """df with each column's ids replaced by keep where mapping (id, keep) has them."""
    for c in columns:
        m = mapping.select(F.col("id").alias("_id"), F.col("keep").alias("_keep"))
        names = df.columns
        df = df.join(m, F.col(c) == F.col("_id"), "left").withColumn(c, F.coalesce("_keep", c)).select(*names)
    return df


def merge_case_variants(lex: Lexicon) -> tuple[Lexicon, DataFrame]:
    """The lexicon with case variants of one concept merged, and the removed senses (sense_id, keep_sense).

    Forms of a losing entry are copied to the keeping one with their rank, unless it has them; provenance of a removed
    sense moves unless the keeper has the same original id; references are redirected; equal sense relations collapse.
    """
    variants = variant_senses(lex)
    lost = variants.filter("sense_id <> keep_sense")
    mapping = lost.select(F.col("sense_id").alias("id"), F.col("keep_sense").alias("keep"))
    moves = lost.filter("entry_id <> keep_entry").select(F.col("entry_id").alias("_from"), "keep_entry").distinct()
    copied = lex.forms.join(moves, F.col("entry_id") == F.col("_from"))
    copied = copied.groupBy(F.col("keep_entry").alias("entry_id"), "form").agg(F.min(F.struct("id", "norm", "rank")).alias("x"))
    copied = copied.join(lex.forms.select("entry_id", "form"), ["entry_id", "form"], "left_anti")
    # A copied form's id is negative: made from the form that it copies and its new entry, without a counter.
    new_id = -F.abs(F.xxhash64("entry_id", "x.id"))
    fresh = copied.select(new_id.alias("id"), "entry_id", "form", "x.norm", "x.rank", F.col("x.id").alias("_old"))
    prons = lex.pronunciations.join(fresh.select("_old", F.col("id").alias("_new")), F.col("form_id") == F.col("_old"))
    prons = prons.select((-F.abs(F.xxhash64("id", "_new"))).alias("id"), F.col("_new").alias("form_id"), "variety", "pron")
    p = lex.provenance.filter("table_name = 'senses'").join(mapping.withColumnRenamed("id", "_id"), F.col("item_id") == F.col("_id"), "left")
    p = p.select("table_name", F.coalesce("keep", "item_id").alias("item_id"), "resource", "version", "original_id", F.col("item_id").alias("_was"), F.col("keep").isNotNull().alias("_moved"))
    own = p.filter("NOT _moved")
    moved = p.filter("_moved").groupBy("table_name", "item_id", "original_id").agg(F.min(F.struct("_was", "resource", "version")).alias("x")).select("table_name", "item_id", "x.resource", "x.version", "original_id")
    have = own.select("item_id", F.col("original_id").alias("_original"))
    moved = moved.join(have.withColumnRenamed("item_id", "_item"), (F.col("item_id") == F.col("_item")) & F.col("original_id").eqNullSafe(F.col("_original")), "left_anti")
    columns = [c.split()[0] for c in SCHEMAS["provenance"].split(", ")]
    provenance = lex.provenance.filter("table_name <> 'senses'").select(*columns).unionByName(own.select(*columns)).unionByName(moved.select(*columns))
    relations = remap(lex.sense_relations, ["source", "target"], mapping).groupBy("source", "target", "type").agg(F.min("id").alias("id")).select("id", "source", "target", "type")
    return lex.with_(
        forms=lex.forms.unionByName(fresh.drop("_old")), pronunciations=lex.pronunciations.unionByName(prons),
        senses=lex.senses.join(mapping.select("id"), "id", "left_anti").select(*lex.senses.columns), sense_relations=relations,
        example_annotations=remap(lex.example_annotations, ["sense_id"], mapping), definition_annotations=remap(lex.definition_annotations, ["sense_id"], mapping),
        sense_examples=remap(lex.sense_examples, ["sense_id"], mapping), provenance=provenance,
    ), lost.select("sense_id", "keep_sense")


def cascade_delete(lex: Lexicon) -> Lexicon:
    """Without synsets that no definition names, and all that depends on them."""
    ids = lambda df, name: df.select(F.col("id").alias(name))
    synsets = lex.synsets.join(lex.definitions.select(F.col("synset_id").alias("id")).distinct(), "id", "left_semi")
    senses = lex.senses.join(ids(synsets, "synset_id"), "synset_id", "left_semi").select(*lex.senses.columns)
    both = lambda r, of: r.join(ids(of, "source"), "source", "left_semi").join(ids(of, "target"), "target", "left_semi").select(*r.columns)
    of_sense = lambda t: t.join(ids(senses, "sense_id"), "sense_id", "left_semi").select(*t.columns)
    sense_examples = of_sense(lex.sense_examples)
    examples = lex.examples.join(sense_examples.select(F.col("example_id").alias("id")).distinct(), "id", "left_semi")
    definitions = lex.definitions.join(ids(synsets, "synset_id"), "synset_id", "left_semi").select(*lex.definitions.columns)
    example_annotations = of_sense(lex.example_annotations).join(ids(examples, "example_id"), "example_id", "left_semi").select(*lex.example_annotations.columns)
    return lex.with_(
        synsets=synsets, senses=senses, sense_relations=both(lex.sense_relations, senses), synset_relations=both(lex.synset_relations, synsets), sense_examples=sense_examples,
        example_annotations=example_annotations, definition_annotations=of_sense(lex.definition_annotations), definitions=definitions, examples=examples,
    )


def remove_orphans(lex: Lexicon) -> Lexicon:
    """Without entries that have no sense, their forms and those forms' pronunciations."""
    entries = lex.entries.join(lex.senses.select(F.col("entry_id").alias("id")).distinct(), "id", "left_semi")
    forms = lex.forms.join(entries.select(F.col("id").alias("entry_id")), "entry_id", "left_semi").select(*lex.forms.columns)
    prons = lex.pronunciations.join(forms.select(F.col("id").alias("form_id")), "form_id", "left_semi").select(*lex.pronunciations.columns)
    return lex.with_(entries=entries, forms=forms, pronunciations=prons)


def row_counts(lex: Lexicon, names: tuple[str, ...] | None = None) -> DataFrame:
    """(table_name, n) of the tables."""
    parts = [lex.tables[n].agg(F.count("*").alias("n")).select(F.lit(n).alias("table_name"), "n") for n in names or lex.tables]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def removed_counts(before: Lexicon, after: Lexicon, names: tuple[str, ...]) -> DataFrame:
    """(table_name, removed) between two states."""
    b, a = row_counts(before, names), row_counts(after, names).withColumnRenamed("n", "m")
    return b.join(a, "table_name").select("table_name", (F.col("n") - F.col("m")).alias("removed"))


def sense_indices(lex: Lexicon) -> DataFrame:
    """senses with sense_index: 1, 2, ... in id order among senses of one language, lemma (A-Z folded) and synset category."""
    e = lex.entries.select(F.col("id").alias("entry_id"), "language_id")
    y = lex.synsets.select(F.col("id").alias("synset_id"), "pos")
    s = lex.senses.drop("sense_index").join(e, "entry_id").join(lemmas(lex.forms), "entry_id").join(y, "synset_id")
    w = Window.partitionBy("language_id", ascii_lower(F.col("lemma")), "pos").orderBy("id")
    return s.withColumn("sense_index", F.row_number().over(w)).select("id", "entry_id", "synset_id", "sense_index")


def coverage(provenance: DataFrame, senses: DataFrame) -> DataFrame:
    """(code, sense_count, synset_count, live_senses): provenance rows of senses, and what they reach now."""
    p = provenance.filter("table_name = 'senses'").select(F.col("resource").alias("code"), "item_id")
    s = senses.select(F.col("id").alias("item_id"), "synset_id")
    return p.join(s, "item_id", "left").groupBy("code").agg(F.count("*").alias("sense_count"), F.countDistinct("synset_id").alias("synset_count"), F.count("synset_id").alias("live_senses"))


def resource_table(spark: SparkSession, roots: DataFrame, lex: Lexicon, index_citation: str | None = None) -> DataFrame:
    """Resource rows from root attributes (ord, root map): the first file of an id wins, codes known only from provenance
    get implicit metadata, counts come from provenance, and the interlingual index has its own canonical row."""
    first = roots.filter(F.col("root")["id"].isNotNull()).groupBy(F.col("root")["id"].alias("code")).agg(F.min_by("root", "ord").alias("root"))
    attr = lambda k: F.col("root")[k]
    stated = first.select(
        "code", attr("version").alias("version"), attr("label").alias("label"), attr("language").alias("language"), attr("url").alias("url"), attr("citation").alias("citation"),
        attr("license").alias("licence"), attr("email").alias("email"), attr("status").alias("status"), number_or_null(attr("confidenceScore")).alias("confidence_score"), extra_json(F.col("root")).alias("extra"),
    )
    known = F.from_json(F.lit(json.dumps(IMPLICIT_RESOURCES)), "map<string,map<string,string>>")
    implied = lex.provenance.select(F.col("resource").alias("code")).distinct().join(stated.select("code"), "code", "left_anti")
    meta = lambda k: F.element_at(F.element_at(known, F.col("code")), k)
    implied = implied.select("code", *[meta(k).alias(k) for k in ("version", "label", "language", "url", "citation", "licence")])
    both = stated.unionByName(implied, allowMissingColumns=True).filter(F.col("code") != CILI["code"])
    both = both.join(coverage(lex.provenance, lex.senses).drop("live_senses"), "code", "left")
    index = lex.synsets.agg(F.count("ili").alias("synset_count")).select(*[F.lit(v).alias(k) for k, v in CILI.items()], F.lit(index_citation).cast("string").alias("citation"), "synset_count")
    columns = [c.split()[0] for c in SCHEMAS["resources"].split(", ")]
    return both.unionByName(index, allowMissingColumns=True).select(*columns)


def first_pictograms(pictures: DataFrame) -> DataFrame:
    """(ili, arasaac_id): the first id of the first lemma that has any. pictures: (ili, position, lemma, ids)."""
    return pictures.filter(F.size("ids") > 0).groupBy("ili").agg(F.min_by(F.col("ids")[0], "position").alias("arasaac_id"))


def pictogram_rows(pictures: DataFrame, synsets: DataFrame) -> DataFrame:
    """The arasaac table; running it again gives the same rows."""
    return synsets.filter(F.col("ili").isNotNull()).join(first_pictograms(pictures), "ili").select(F.col("id").alias("synset_id"), "arasaac_id")


def pictogram_build(pictograms: DataFrame, mapping: DataFrame) -> DataFrame:
    """(ili, lemma, ids) from pictograms (id, synsets array, keywords array) and a map (offset, ili); ids in order, once."""
    rows = pictograms.select("id", F.explode("synsets").alias("offset"), "keywords").join(mapping, "offset").select("id", "ili", F.explode("keywords").alias("lemma"))
    return rows.distinct().groupBy("ili", "lemma").agg(F.sort_array(F.collect_list("id")).alias("ids"))


def named_languages(languages: DataFrame, names: DataFrame) -> DataFrame:
    """languages with name from names (code, name)."""
    return languages.drop("name").join(names, "code", "left").select("id", "code", "name")
