"""The query surface: searches, translations, views of a concept or a sense, provenance.

Terms are values (literals), never part of SQL text or of a pattern.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import contains_ascii, glob, normalize_term, search_mode
from ..model import Lexicon


def star(lex: Lexicon, forms: DataFrame | None = None) -> DataFrame:
    """forms - entries - languages - senses - synsets, one row per form and sense. A filtered forms table keeps its filter
    at the scan; languages is a dimension that Spark broadcasts by its size."""
    f = (forms if forms is not None else lex.forms).select(F.col("id").alias("form_id"), "entry_id", "form", "norm", "rank")
    e = lex.entries.select(F.col("id").alias("entry_id"), "language_id")
    g = lex.languages.select(F.col("id").alias("language_id"), F.col("code").alias("language"))
    s = lex.senses.select(F.col("id").alias("sense_id"), "entry_id", "synset_id", "sense_index")
    y = lex.synsets.select(F.col("id").alias("synset_id"), "ili", "pos")
    return f.join(e, "entry_id").join(g, "language_id").join(s, "entry_id").join(y, "synset_id")


def definitions_in(lex: Lexicon, language: str) -> DataFrame:
    """(synset_id, definition) in one language."""
    g = lex.languages.filter(F.col("code") == language).select(F.col("id").alias("language_id"))
    return lex.definitions.join(g, "language_id", "left_semi").select("synset_id", "definition")


def one_per_sense(rows: DataFrame) -> DataFrame:
    """Rows of star() reduced to each sense's first form; a form copied by a merge (negative id) comes last."""
    keys = ["synset_id", "sense_id", "language", "pos", "ili", "sense_index"]
    return rows.groupBy(*keys).agg(F.min_by("form", F.struct(F.col("form_id") < 0, "form_id")).alias("form"))


COLUMNS = ["form", "language", "pos", "ili", "sense_index", "sense_id", "synset_id", "definition"]


def with_definition(lex: Lexicon, rows: DataFrame, language: str = "en") -> DataFrame:
    return rows.join(definitions_in(lex, language), "synset_id", "left").select(*COLUMNS)


def in_languages(rows: DataFrame, languages: list[str] | None) -> DataFrame:
    return rows if languages is None else rows.filter(F.col("language").isin(*languages))


def exact(lex: Lexicon, term: str, languages: list[str] | None = None, definition_language: str = "en") -> DataFrame:
    found = star(lex, lex.forms.filter(F.col("norm") == normalize_term(term)))
    return with_definition(lex, in_languages(found, languages), definition_language)


def by_glob(lex: Lexicon, pattern: str, languages: list[str] | None = None, definition_language: str = "en") -> DataFrame:
    found = star(lex, lex.forms.filter(glob(F.col("norm"), normalize_term(pattern))))
    return with_definition(lex, in_languages(found, languages), definition_language)


def glob_forms(lex: Lexicon, pattern: str, language: str | None = None) -> DataFrame:
    """Distinct (form, language) that match."""
    f = lex.forms.filter(glob(F.col("norm"), normalize_term(pattern))).join(lex.entries.select(F.col("id").alias("entry_id"), "language_id"), "entry_id")
    out = f.join(lex.languages.select(F.col("id").alias("language_id"), F.col("code").alias("language")), "language_id").select("form", "language").distinct()
    return out if language is None else out.filter(F.col("language") == language)


def by_ili(lex: Lexicon, ili: str, languages: list[str] | None = None, definition_language: str = "en") -> DataFrame:
    value = ili.removeprefix("cili.")
    hit = lex.with_(synsets=lex.synsets.filter(F.col("ili") == value))
    lemma = one_per_sense(star(hit, lex.forms.filter("rank = 0")))
    return with_definition(lex, in_languages(lemma, languages), definition_language)


def by_definition(lex: Lexicon, part: str, languages: list[str] | None = None, definition_language: str = "en") -> DataFrame:
    """Senses of any language whose concept has a definition, in any language, that contains part."""
    hits = lex.definitions.filter(contains_ascii(F.col("definition"), part)).select(F.col("synset_id").alias("id")).distinct()
    found = one_per_sense(star(lex.with_(synsets=lex.synsets.join(hits, "id", "left_semi")), lex.forms.filter("rank = 0")))
    return with_definition(lex, in_languages(found, languages), definition_language)


def search(lex: Lexicon, term: str, languages: list[str] | None = None, definition_language: str = "en") -> DataFrame:
    """What a user types: exact form, glob, interlingual id or def:text."""
    mode, value = search_mode(term)
    run = {"exact": exact, "glob": by_glob, "ili": by_ili, "def": by_definition}[mode]
    return run(lex, value, languages, definition_language)


def result_counts(rows: DataFrame) -> DataFrame:
    return rows.agg(F.count("*").alias("results"), F.countDistinct("language").alias("languages"))


def translations(lex: Lexicon, ili: str) -> DataFrame:
    """(language, forms): the distinct forms of a concept by language, sorted and joined by commas."""
    hit = lex.with_(synsets=lex.synsets.filter(F.col("ili") == ili.removeprefix("cili.")))
    return star(hit, lex.forms.filter("rank = 0")).groupBy("language").agg(F.array_join(F.sort_array(F.collect_set("form")), ",").alias("forms"))


def definitions_of(lex: Lexicon, synset_id: int) -> DataFrame:
    g = lex.languages.select(F.col("id").alias("language_id"), F.col("code").alias("language"))
    return lex.definitions.filter(F.col("synset_id") == synset_id).join(g, "language_id").select("language", "definition")


def examples_of(lex: Lexicon, sense_id: int) -> DataFrame:
    """(example_id, example, start, end): the examples of a sense with its spans in them."""
    j = lex.sense_examples.filter(F.col("sense_id") == sense_id)
    x = j.join(lex.examples.select(F.col("id").alias("example_id"), "example"), "example_id")
    return x.join(lex.example_annotations, ["example_id", "sense_id"], "left").select("example_id", "example", "start", "end")


def concept_view(lex: Lexicon) -> DataFrame:
    """(synset_id, ili, pos, forms, relations): forms as language:form and relations as type:target, sorted lists."""
    s = star(lex, lex.forms.filter("rank = 0")).groupBy("synset_id").agg(F.sort_array(F.collect_set(F.concat("language", F.lit(":"), "form"))).alias("forms"))
    r = lex.synset_relations.groupBy(F.col("source").alias("synset_id")).agg(F.sort_array(F.collect_set(F.concat("type", F.lit(":"), F.col("target").cast("string")))).alias("relations"))
    empty = F.array().cast("array<string>")
    out = lex.synsets.select(F.col("id").alias("synset_id"), "ili", "pos").join(s, "synset_id", "left").join(r, "synset_id", "left")
    return out.withColumns({"forms": F.coalesce("forms", empty), "relations": F.coalesce("relations", empty)})


def sense_view(lex: Lexicon, sense_id: int, definition_language: str = "en") -> DataFrame:
    """One sense: its forms, concept, definition and relations."""
    rows = with_definition(lex, star(lex.with_(senses=lex.senses.filter(F.col("id") == sense_id))), definition_language)
    r = lex.sense_relations.filter(F.col("source") == sense_id).select(F.array(F.col("type"), F.col("target").cast("string")).alias("r"))
    related = r.agg(F.sort_array(F.collect_list(F.array_join("r", ":"))).alias("relations"))
    head = rows.groupBy("sense_id", "synset_id", "ili", "pos", "language", "sense_index", "definition").agg(F.sort_array(F.collect_set("form")).alias("forms"))
    return head.join(related, F.lit(True))


def provenance_of(lex: Lexicon, table: str, item_id: int) -> DataFrame:
    """Sources of one row; the provenance table is partitioned by table_name."""
    p = lex.provenance.filter((F.col("table_name") == table) & (F.col("item_id") == item_id))
    return p.select("resource", "version", "original_id")


def resource_list(lex: Lexicon, by: str = "label", ascending: bool = True) -> DataFrame:
    """Resources sorted without regard to case."""
    key = F.lower(F.col(by)) if dict(lex.resources.dtypes)[by] == "string" else F.col(by)
    return lex.resources.orderBy(key.asc_nulls_last() if ascending else key.desc_nulls_last(), "code")
