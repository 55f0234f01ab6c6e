"""Conversion of a source wordnet (LMF XML) to concepts, lexemes, senses, relations and annotated examples.

Input are the records of `sources.xml.read(paths, LMF_TAGS)`; every pass is a table-to-table step in document order.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ..functions.text import pos_of, xml_id
from ..model import CONCEPT_TYPES, SAME_CATEGORY_TYPES, SENSE_TYPES, SOURCE_CONCEPT_PAIRS, SOURCE_SENSE_PAIRS
from . import relations as rel
from .ids import first_by, number

LMF_TAGS = ("LexicalEntry", "ExternalLexicalEntry", "Synset", "ExternalSynset")
def _seq() -> Column:
    return F.struct("resource_ord", "element_ord").alias("seq")


def _children(elements: DataFrame, tags: tuple[str, ...], path: str) -> DataFrame:
    rows = elements.filter(F.col("tag").isin(*tags)).select(_seq(), F.col("attrs")["id"].alias("record"), "root", F.posexplode(F.filter("children", lambda c: F.regexp_replace(c["path"], "External", "") == path)).alias("k", "c"), "children")
    return rows.select("seq", "record", "root", F.col("c.ord").alias("ord"), F.col("c.parent").alias("parent"), F.col("c.attrs").alias("attrs"), F.col("c.text").alias("text"), "children")


def concepts(elements: DataFrame, index: DataFrame, keep_index_glosses: bool = True) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(concepts, glosses, mismatches) of the synsets.

    concepts: (synset, concept_id, pos, index_pos, is_new, seq). A synset without a usable interlingual id gets a local id from a
    counter in document order. glosses: (concept_id, language, text), the first definition; those of indexed concepts
    only if keep_index_glosses. mismatches: (source_pos, index_pos, n).
    """
    s = elements.filter(F.col("tag") == "Synset").select(_seq(), F.col("attrs")["id"].alias("synset"), F.col("attrs")["ili"].alias("ili"), pos_of(F.col("attrs")["partOfSpeech"]).alias("pos"), "root", "children")
    known = index.select(F.concat(F.lit("cili."), F.col("ili")).alias("_concept"), F.col("ili").alias("_ili"), F.col("pos").alias("index_pos"))
    usable = F.coalesce(F.col("ili"), F.lit("")).rlike("^i[0-9]+$")
    s = s.withColumn("ili", F.when(usable, F.col("ili"))).join(known, F.col("ili") == F.col("_ili"), "left")
    # Counter within one lexicon, over its unmapped synsets in document order.
    new = F.col("_concept").isNull()
    w = Window.partitionBy(F.col("root")["id"], new).orderBy("seq")
    local = F.concat(F.col("root")["id"], F.lit(".i"), F.row_number().over(w).cast("string"))
    out = s.withColumn("concept_id", F.coalesce("_concept", local)).withColumn("is_new", new)
    first = F.get(F.filter("children", lambda c: c["path"] == "Definition"), F.lit(0))["text"]
    glosses = out.filter(first.isNotNull() & (F.col("is_new") | F.lit(keep_index_glosses))).select("concept_id", F.coalesce(F.col("root")["language"]).alias("language"), first.alias("text"))
    differ = out.filter(F.col("index_pos").isNotNull() & (F.col("index_pos") != F.col("pos"))).groupBy(F.col("pos").alias("source_pos"), "index_pos").agg(F.count("*").alias("n"))
    return out.select("synset", "concept_id", "pos", "index_pos", "is_new", "seq", F.col("root")["id"].alias("lexicon")), glosses, differ


@F.pandas_udf(StringType())
def _lexeme_id(head, forms):  # noqa: ANN001, ANN201
    return head.combine(forms, lambda h, fs: f"{h}." + "-".join(xml_id(f) for f in fs))


def lexemes(elements: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(lexemes, of): entries merged where language, category and set of forms agree; of: (entry, lexeme_id, seq).

    lexemes: (lexeme_id, language, pos, forms, n_sources), forms with the lemma first; the first arrival gives the order.
    """
    e = elements.filter(F.col("tag") == "LexicalEntry")
    lemma = F.get(F.filter("children", lambda c: c["path"] == "Lemma"), F.lit(0))["attrs"]
    more = F.transform(F.filter("children", lambda c: (c["path"] == "Form") & c["attrs"]["writtenForm"].isNotNull()), lambda c: c["attrs"]["writtenForm"])
    rows = e.select(_seq(), F.col("attrs")["id"].alias("entry"), F.col("root")["language"].alias("language"), pos_of(lemma["partOfSpeech"]).alias("pos"), F.array_distinct(F.concat(F.array(lemma["writtenForm"]), more)).alias("forms"))
    rows = rows.filter(F.col("forms")[0].isNotNull()).withColumn("set", F.array_sort("forms"))
    keys = ["language", "pos", "set"]
    merged = rows.groupBy(*keys).agg(F.min_by("forms", "seq").alias("forms"), F.count("*").alias("n_sources"), F.min("seq").alias("seq"))
    merged = merged.withColumn("lexeme_id", _lexeme_id(F.concat_ws(".", "language", "pos"), "forms"))
    of = rows.select("entry", "seq", *keys).join(merged.select(*keys, "lexeme_id"), keys).select("entry", "lexeme_id", "seq")
    return merged.select("lexeme_id", "language", "pos", "forms", "n_sources", "seq"), of


def senses(elements: DataFrame, of: DataFrame, concept_table: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(senses, unresolved): all senses (sense, lexeme_id, concept_id, sense_id), see kept_senses for one per lexeme and
    concept; unresolved: (sense, synset) whose synset is not there."""
    s = _children(elements, ("LexicalEntry", "ExternalLexicalEntry"), "Sense")
    s = s.select("seq", "ord", F.col("record").alias("entry"), F.col("attrs")["id"].alias("sense"), F.col("attrs")["synset"].alias("synset"))
    s = s.join(of.select("entry", "lexeme_id"), "entry")
    joined = s.join(concept_table.select("synset", "concept_id"), "synset", "left")
    unresolved = joined.filter("concept_id IS NULL").select("sense", "synset")
    found = joined.filter("concept_id IS NOT NULL")
    sense_id = F.concat_ws(".", "lexeme_id", "concept_id")
    return found.select("sense", "lexeme_id", "concept_id", sense_id.alias("sense_id"), "seq", "ord"), unresolved


def kept_senses(all_senses: DataFrame) -> DataFrame:
    """One row per lexeme and concept: the first arrival."""
    return first_by(all_senses, ["lexeme_id", "concept_id"], ["seq", "ord"])


def concept_relations(elements: DataFrame, concept_table: DataFrame, existing: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(relations, mismatches) between concepts in stored form."""
    r = _children(elements, ("Synset", "ExternalSynset"), "SynsetRelation").select(F.col("record").alias("_a"), F.col("attrs")["relType"].alias("type"), F.col("attrs")["target"].alias("_b"))
    a, b = concept_table.select(F.col("synset").alias("_a"), F.col("concept_id").alias("source")), concept_table.select(F.col("synset").alias("_b"), F.col("concept_id").alias("target"))
    raw = r.join(a, "_a").join(b, "_b").select("source", "target", "type")
    out = rel.convert(raw, {t: t for t in CONCEPT_TYPES}, SOURCE_CONCEPT_PAIRS, existing)
    # Only indexed concepts have a category here.
    mapped = concept_table.filter("index_pos IS NOT NULL").select(F.col("concept_id").alias("id"), F.col("index_pos").alias("pos")).distinct()
    return out, rel.category_mismatches(out, mapped, SAME_CATEGORY_TYPES)


def sense_relations(elements: DataFrame, sense_table: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    parent = lambda rows: F.element_at("children", F.col("parent") + 1)["attrs"]["id"]
    r = _children(elements, ("LexicalEntry", "ExternalLexicalEntry"), "Sense/SenseRelation")
    r = r.select(parent(r).alias("_a"), F.col("attrs")["relType"].alias("type"), F.col("attrs")["target"].alias("_b"))
    a, b = sense_table.select(F.col("sense").alias("_a"), F.col("sense_id").alias("source")), sense_table.select(F.col("sense").alias("_b"), F.col("sense_id").alias("target"))
    return rel.convert(r.join(a, "_a").join(b, "_b").select("source", "target", "type"), {t: t for t in SENSE_TYPES}, SOURCE_SENSE_PAIRS, existing)


# ---- examples ----


def substring_match(pairs: DataFrame) -> DataFrame:
    """pairs (example_id, text, form, ord, ...) -> the best candidate of each example whose form occurs in the text without
    regard to case: the longest, then the first. Adds start (0-based code points) and end."""
    hits = pairs.withColumn("_at", F.expr("instr(lower(text), lower(form))")).filter((F.col("_at") > 0) & (F.length("form") > 0))
    rest = [c for c in pairs.columns if c != "example_id"]
    best = hits.groupBy("example_id").agg(F.max_by(F.struct(*rest, "_at"), F.struct(F.length("form"), -F.col("ord"))).alias("x"))
    return best.select("example_id", *[f"x.{c}" for c in rest], (F.col("x._at") - 1).alias("start"), (F.col("x._at") - 1 + F.length("x.form")).alias("end"))


# Characters at which a token ends.
BOUNDARIES = " \t\n.,;:!?\"'()[]{}-–—/\\"
_EDGE = "[" + "".join(f"\\{c}" if c in "[]-\\" else c for c in BOUNDARIES) + "]"


def grow(text: Column, start: Column, end: Column) -> tuple[Column, Column]:
    """(start, end) grown to the token's boundaries."""
    edge = _EDGE
    before = F.regexp_extract(F.substring(text, F.lit(1), start), f"((?:(?!{edge})[\\s\\S])*)$", 1)
    after = F.regexp_extract(F.substring(text, end + 1, F.length(text)), f"^((?:(?!{edge})[\\s\\S])*)", 1)
    return start - F.length(before), end + F.length(after)


def gapped_match(text: str, form: str, slack: int = 2) -> tuple[int, int] | None:
    """Span of the words of a multi-word form in order within a window of n + slack tokens; whole tokens, any case."""
    tokens = [(m.start(), m.start() + len(m[0].rstrip(BOUNDARIES)), m[0].strip(BOUNDARIES).lower()) for m in re.finditer(r"\S+", text)]
    words = form.lower().split()
    for i in range(len(tokens)):
        k, last = 0, i
        for j in range(i, min(len(tokens), i + len(words) + slack)):
            if tokens[j][2] == words[k]:
                if k == 0 and j != i:
                    break
                k, last = k + 1, j
                if k == len(words):
                    return tokens[i][0], tokens[last][1]
    return None


def match_examples(spark: SparkSession, pairs: DataFrame, analyse=None) -> DataFrame:
    """(example_id, sense_id, form, start, end, strategy) of the best candidate of each example.

    1 substring; 2 gapped words; 3 an injected analyser (text, form) -> (start, end) or None. A later strategy only sees
    examples that the earlier ones left. pairs: (example_id, text, sense_id, form, ord).
    """
    first = substring_match(pairs)
    a, b = grow(F.col("text"), F.col("start"), F.col("end"))
    first = first.select("example_id", "sense_id", "form", a.cast("int").alias("start"), b.cast("int").alias("end"), F.lit("substring").alias("strategy"))
    named = dict(pairs.dtypes)["sense_id"] == "string"
    key = "string" if named else "long"
    rest = pairs.join(first.select("example_id"), "example_id", "left_anti").filter(F.lit(True) if analyse else F.col("form").contains(" "))

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            out = []
            for ex, text, sense, form, order in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                span, how = gapped_match(text or "", form or ""), "words"
                if span is None and analyse is not None:
                    span, how = analyse(text, form), "analyser"
                if span:
                    out.append((ex, sense, form, span[0], span[1], how, order))
            kinds = (pa.int64(), pa.string() if named else pa.int64(), pa.string(), pa.int32(), pa.int32(), pa.string(), pa.int32())
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], k) for i, k in enumerate(kinds)], names=["example_id", "sense_id", "form", "start", "end", "strategy", "ord"])

    found = rest.select(F.col("example_id").cast("long"), "text", F.col("sense_id").cast(key), "form", F.col("ord").cast("int")).mapInArrow(run, f"example_id long, sense_id {key}, form string, start int, end int, strategy string, ord int")
    best = found.groupBy("example_id").agg(F.min_by(F.struct("sense_id", "form", "start", "end", "strategy"), F.struct((F.col("strategy") == "analyser").alias("late"), -F.length("form"), "ord")).alias("x")).select("example_id", "x.*")
    return first.unionByName(best)


def example_log(pairs: DataFrame, matched: DataFrame) -> DataFrame:
    """(included, excluded, success_rate) over examples."""
    n = pairs.select("example_id").distinct().join(matched.select("example_id", F.lit(1).alias("ok")), "example_id", "left")
    out = n.agg(F.count("ok").alias("included"), F.count_if(F.col("ok").isNull()).alias("excluded"))
    return out.withColumn("success_rate", F.when(F.col("included") + F.col("excluded") > 0, F.round(100 * F.col("included") / (F.col("included") + F.col("excluded")), 1)))


# ---- annotated glosses ----


def without_overlaps(spans: DataFrame, key: str) -> DataFrame:
    """Spans (key, start, end, ...) that do not begin before the end of an earlier one of their text."""
    w = Window.partitionBy(key).orderBy("start", "end").rowsBetween(Window.unboundedPreceding, -1)
    return spans.withColumn("_before", F.max("end").over(w)).filter(F.col("_before").isNull() | (F.col("start") >= F.col("_before"))).drop("_before")


def overlaps(spans: DataFrame, key: str) -> DataFrame:
    """(key, start, end, next_start) of neighbouring spans that overlap."""
    w = Window.partitionBy(key).orderBy("start", "end")
    return spans.withColumn("next_start", F.lead("start").over(w)).filter(F.col("next_start") < F.col("end")).select(key, "start", "end", "next_start")


def merge_adjacent(tokens: DataFrame, key: str) -> DataFrame:
    """(key, sense, start, end, n): neighbouring tokens (key, ord, start, end, sense) of one sense as one span."""
    w = Window.partitionBy(key).orderBy("ord")
    t = tokens.withColumn("_new", (~F.col("sense").eqNullSafe(F.lag("sense").over(w)) | (F.lag("ord").over(w) != F.col("ord") - 1)).cast("int"))
    t = t.withColumn("_run", F.sum(F.coalesce("_new", F.lit(1))).over(w.rowsBetween(Window.unboundedPreceding, 0))).filter("sense IS NOT NULL")
    return t.groupBy(key, "_run", "sense").agg(F.min("start").alias("start"), F.max("end").alias("end"), F.count("*").alias("n")).drop("_run")


def transfer_annotations(glosses: DataFrame, spans: DataFrame, senses: DataFrame) -> DataFrame:
    """Spans (gloss_id, start, end, sense) of known senses (key), without overlaps, that lie within their gloss."""
    known = spans.join(senses.select(F.col("key").alias("sense")), "sense", "left_semi").join(glosses.select("gloss_id", F.length("text").alias("_n")), "gloss_id").filter("end <= _n").drop("_n")
    return without_overlaps(known, "gloss_id")


def pending_translations(glosses: DataFrame, done: DataFrame) -> DataFrame:
    """Glosses (id, language, text) that have no translation (id, language) yet."""
    return glosses.join(done.select("id", "language"), ["id", "language"], "left_anti")


def translate_pending(glosses: DataFrame, done: DataFrame, translate) -> DataFrame:
    """Translations (id, language, text, translated) of what is pending, by translate(language, list of texts) in Arrow
    batches; appending the result to done makes a rerun do only the rest."""
    pending = pending_translations(glosses, done).select(F.col("id").cast("long"), "language", "text").sortWithinPartitions("language")

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            languages, texts = batch.column(1).to_pylist(), batch.column(2).to_pylist()
            out: list[str | None] = [None] * len(texts)
            for language in sorted({x for x in languages if x}):
                at = [i for i, x in enumerate(languages) if x == language and texts[i]]
                for i, t in zip(at, translate(language, [texts[i] for i in at]), strict=True):
                    out[i] = t
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.string())], names=["id", "language", "text", "translated"])

    return pending.mapInArrow(run, "id long, language string, text string, translated string").filter("translated IS NOT NULL")



# ---- a whole source ----


def _children_of(*provenance: Column) -> Column:
    return F.array(*provenance)


def _child(path: str, order: Column | int, attrs: Column, parent: Column | int = -1, text: Column | None = None) -> Column:
    lit = lambda x: F.lit(x) if isinstance(x, int) else x
    return F.struct(F.lit(path).alias("path"), lit(order).cast("int").alias("ord"), lit(parent).cast("int").alias("parent"), attrs.alias("attrs"), (F.lit(None).cast("string") if text is None else text).alias("text"))


def _provenance(root: Column, original: Column | None = None, order: Column | int = 0) -> Column:
    pairs = [F.lit("resource"), root["id"], F.lit("version"), F.coalesce(root["version"], F.lit(""))]
    return _child("Provenance", order, F.create_map(*pairs, *([F.lit("original_id"), original] if original is not None else [])))


SPANS = "array<struct<start:int,end:int,sense:string>>"


def _record(df: DataFrame, layer: int, tag: str, attrs: dict[str, Column], children: Column, text: Column | None = None, spans: Column | None = None) -> DataFrame:
    """Records in the form of sources.xml.read: layers in the order in which a merge needs them, then document order, then
    the order of attributes; each record has a number of its own."""
    named = df.select("*", *[v.cast("string").alias(f"_by_{k}") for k, v in attrs.items()])
    df = number(named, ["seq", "sub", *(f"_by_{k}" for k in attrs)], "_no")
    attrs = {k: F.col(f"_by_{k}") for k in attrs}
    pairs = [x for k, v in attrs.items() for x in (F.lit(k), v)]
    return df.select(
        F.col("seq.resource_ord").alias("resource_ord"), (F.lit(layer << 50).cast("long") + F.col("_no")).alias("element_ord"), F.lit(tag).alias("tag"),
        F.create_map(*pairs).alias("attrs"), "root", (F.lit(None).cast("string") if text is None else text).alias("text"), (F.array().cast(SPANS) if spans is None else spans.cast(SPANS)).alias("spans"), children.alias("children"),
    )


def as_elements(spark: SparkSession, elements: DataFrame, index: DataFrame, existing: DataFrame | None = None, keep_index_glosses: bool = True, analyse=None) -> tuple[DataFrame, DataFrame]:
    """(records, log) of source wordnets: records go straight to ingest.build, without an XML file in between.

    index: (ili, pos) of the interlingual index; existing: relations that an earlier source already has. log: (metric, key, n).
    """
    roots = elements.groupBy(F.col("resource_ord").alias("_ord")).agg(F.min_by("root", "element_ord").alias("root"))
    rooted = lambda df: df.join(roots, F.col("seq.resource_ord") == F.col("_ord")) if "root" not in df.columns else df
    table, _, differ = concepts(elements, index, keep_index_glosses)
    source = elements.filter(F.col("tag") == "Synset").select(_seq(), "root", "children").join(table.withColumnRenamed("seq", "_seq"), F.col("seq") == F.col("_seq"))
    source = source.withColumn("sub", F.lit(0))
    new = source.filter("is_new")
    out = _record(new, 1, "Concept", {"id": F.col("concept_id"), "ontological_category": F.col("pos")}, _children_of(_provenance(F.col("root"), F.col("synset"))))
    first = F.get(F.filter("children", lambda c: c["path"] == "Definition"), F.lit(0))["text"]
    glossed = source.withColumn("_text", first).filter(F.col("_text").isNotNull() & (F.col("is_new") | F.lit(keep_index_glosses)))
    out = out.unionByName(_record(glossed, 2, "Gloss", {"definiendum": F.col("concept_id"), "language": F.col("root")["language"]}, _children_of(_provenance(F.col("root"))), F.col("_text")))
    lexeme_table, of = lexemes(elements)
    forms = F.transform("forms", lambda f, k: _child("Wordform", k, F.create_map(F.lit("form"), f)))
    lex = rooted(lexeme_table).withColumn("sub", F.lit(0))
    out = out.unionByName(_record(lex, 3, "Lexeme", {"id": F.col("lexeme_id"), "language": F.col("language"), "grammatical_category": F.col("pos")}, F.concat(forms, F.array(_provenance(F.col("root"), order=F.size("forms"))))))
    all_senses, unresolved = senses(elements, of, table)
    kept = rooted(kept_senses(all_senses)).withColumn("sub", F.col("ord"))
    out = out.unionByName(_record(kept, 4, "Sense", {"id": F.col("sense_id"), "signifier": F.col("lexeme_id"), "signified": F.col("concept_id")}, _children_of(_provenance(F.col("root"), F.col("sense")))))
    between, mismatches = concept_relations(elements, table, existing)
    lexical = sense_relations(elements, all_senses)
    # A relation has no place of its own in the document: it belongs to its source's resource, ordered by its ends.
    places = table.groupBy("concept_id").agg(F.min("seq").alias("seq"))
    for layer, tag, rel_table, place in ((7, "ConceptRelation", between, places), (6, "SenseRelation", lexical, kept.groupBy(F.col("sense_id").alias("concept_id")).agg(F.min("seq").alias("seq")))):
        r = rooted(rel_table.join(place, F.col("source") == F.col("concept_id"))).withColumn("sub", F.lit(0))
        out = out.unionByName(_record(r, layer, tag, {"relation_type": F.col("type"), "source": F.col("source"), "target": F.col("target")}, _children_of(_provenance(F.col("root")))))
    pairs = example_candidates(elements, all_senses, lexeme_table, table)
    matched = match_examples(spark, pairs.select("example_id", "text", "sense_id", "form", "ord"), analyse)
    texts = pairs.groupBy("example_id").agg(F.first("text").alias("text"), F.min("seq").alias("seq"), F.min("sub").alias("sub"))
    shown = rooted(matched.join(texts, "example_id"))
    spans = F.array(F.struct(F.col("start"), F.col("end"), F.col("sense_id").alias("sense")))
    example = shown.withColumn("_spans", spans).withColumn("_text", F.col("text")).drop("text", "start", "end")
    out = out.unionByName(_record(example, 5, "Example", {"id": F.col("example_id").cast("string")}, _children_of(_provenance(F.col("root"))), F.col("_text"), F.col("_spans")))
    one = lambda name, df: df.agg(F.count("*").alias("n")).select(F.lit(name).alias("metric"), F.lit("").alias("key"), "n")
    log = differ.select(F.lit("pos_mismatch_concept").alias("metric"), F.concat_ws(">", "source_pos", "index_pos").alias("key"), "n")
    log = log.unionByName(mismatches.select(F.lit("category_mismatch").alias("metric"), F.col("type").alias("key"), F.col("mismatched").alias("n")))
    log = log.unionByName(one("unresolved_synset", unresolved)).unionByName(one("missing_ili", table.filter("is_new")))
    done = example_log(pairs, matched)
    log = log.unionByName(done.select(F.lit("included_example").alias("metric"), F.lit("").alias("key"), F.col("included").alias("n"))).unionByName(done.select(F.lit("unmatched_example").alias("metric"), F.lit("").alias("key"), F.col("excluded").alias("n")))
    return out, log


def example_candidates(elements: DataFrame, all_senses: DataFrame, lexeme_table: DataFrame, concept_table: DataFrame) -> DataFrame:
    """(example_id, text, sense_id, form, ord, seq, sub): for an example of a sense its lexeme's forms, for one of a synset
    those of all its senses."""
    own = _children(elements, ("LexicalEntry", "ExternalLexicalEntry"), "Sense/Example")
    own = own.select("seq", F.col("ord").alias("sub"), "text", F.element_at("children", F.col("parent") + 1)["attrs"]["id"].alias("sense")).filter("text IS NOT NULL")
    own = own.join(all_senses.select("sense", "sense_id", "lexeme_id"), "sense").select("seq", "sub", "text", "sense_id", "lexeme_id")
    shared = _children(elements, ("Synset", "ExternalSynset"), "Example").select("seq", F.col("ord").alias("sub"), "text", F.col("record").alias("synset")).filter("text IS NOT NULL")
    members = all_senses.select("concept_id", "sense_id", "lexeme_id").distinct()
    shared = shared.join(concept_table.select("synset", "concept_id"), "synset").join(members, "concept_id").select("seq", "sub", "text", "sense_id", "lexeme_id")
    both = own.unionByName(shared)
    numbers = number(both.select(F.col("seq").alias("_seq"), F.col("sub").alias("_sub")).distinct(), ["_seq", "_sub"], "example_id")
    both = both.join(numbers, (F.col("seq") == F.col("_seq")) & (F.col("sub") == F.col("_sub")))
    return both.join(lexeme_table.select("lexeme_id", F.posexplode("forms").alias("ord", "form")), "lexeme_id").select("example_id", "text", "sense_id", "form", "ord", "seq", "sub")


def convert_files(spark: SparkSession, paths: list[str], index: DataFrame, out: str, first: str = "oewn") -> DataFrame:
    """(path, status, message) of converting each file to records in out/<name>.

    The reference wordnet goes first, and its relations are not stated again by others; a file whose output exists is
    skipped; an error stops its own file only.
    """
    import os

    from ..sources.xml import read

    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    conf, told, existing = spark.sparkContext._jsc.hadoopConfiguration(), [], None
    for path in sorted(paths, key=lambda p: (not os.path.basename(p).startswith(first), os.path.basename(p))):
        name = os.path.basename(path).split(".xml")[0]
        target = f"{out}/{name}"
        leader = name.startswith(first)
        try:
            done = hadoop(f"{target}/_SUCCESS")
            if done.getFileSystem(conf).exists(done):
                told.append((path, "skipped", ""))
            else:
                records, _ = as_elements(spark, read(spark, [path], LMF_TAGS), index, None if leader else existing, not leader)
                records.write.mode("overwrite").parquet(target)
                told.append((path, "converted", ""))
            if leader:
                a = F.col("attrs")
                existing = spark.read.parquet(target).filter("tag = 'ConceptRelation'").select(a["source"].alias("source"), a["target"].alias("target"), a["relation_type"].alias("type"))
        except Exception as error:  # noqa: BLE001
            told.append((path, "failed", str(error)[:500]))
    return spark.createDataFrame(told, "path string, status string, message string")
