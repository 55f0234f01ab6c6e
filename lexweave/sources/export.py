"""Sinks: the layered XML export, logs, tables for papers."""

from __future__ import annotations

from xml.sax.saxutils import escape, quoteattr

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import xml_id_arrow
from ..model import CONCEPT_INVERSES, Lexicon

_ESCAPES = (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("\n", "&#10;"))


def escaped(c):
    for a, b in _ESCAPES:
        c = F.replace(c, F.lit(a), F.lit(b))
    return c


def attribute(name: str, c):
    """name="value" with a leading blank; nothing for null."""
    return F.when(c.isNull(), "").otherwise(F.concat(F.lit(f' {name}="'), escaped(c.cast("string")), F.lit('"')))


def mixed(text: str, spans: str):
    """Text with its spans (array of struct(start, end, sense), sorted) as AnnotatedToken elements; code-point offsets."""
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def put(a, s):
        before = F.substring(F.col(text), a["at"] + 1, s["start"] - a["at"])
        token = F.substring(F.col(text), s["start"] + 1, s["end"] - s["start"])
        made = F.concat(a["out"], escaped(before), F.lit('<AnnotatedToken sense="'), escaped(s["sense"]), F.lit('">'), escaped(token), F.lit("</AnnotatedToken>"))
        return F.struct(s["end"].alias("at"), made.alias("out"))

    return F.aggregate(F.col(spans), start, put, lambda a: F.concat(F.lit("<AnnotatedSentence>"), a["out"], escaped(F.substring(F.col(text), a["at"] + 1, F.length(F.col(text)))), F.lit("</AnnotatedSentence>")))


def annotated(text: str, spans: list[tuple[int, int, str]]) -> str:
    """The same for one sentence in Python."""
    out, at = [], 0
    for a, b, sense in sorted(spans):
        out.append(f"{escape(text[at:a])}<AnnotatedToken sense={quoteattr(sense)}>{escape(text[a:b])}</AnnotatedToken>")
        at = b
    return f"<AnnotatedSentence>{''.join(out)}{escape(text[at:])}</AnnotatedSentence>"


def keys(lex: Lexicon) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Public ids of synsets, entries and senses: (id, key). Forms in a key are encoded, lemma first."""
    y = lex.synsets.select("id", F.coalesce(F.concat(F.lit("cili."), "ili"), F.concat(F.lit("local.i"), F.col("id").cast("string"))).alias("key"))
    coded = lex.forms.select("entry_id", "rank", "id", xml_id_arrow(F.col("form")).alias("code"))
    coded = coded.groupBy("entry_id").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("rank", "id", "code"))), lambda x: x["code"]), "-").alias("code"))
    e = lex.entries.join(lex.languages.select(F.col("id").alias("language_id"), F.col("code").alias("language")), "language_id").join(coded, F.col("id") == F.col("entry_id"))
    e = e.select("id", F.concat_ws(".", "language", "pos", "code").alias("key"))
    s = lex.senses.join(e.select(F.col("id").alias("entry_id"), F.col("key").alias("e")), "entry_id").join(y.select(F.col("id").alias("synset_id"), F.col("key").alias("y")), "synset_id")
    return y, e, s.select("id", F.concat_ws(".", "e", "y").alias("key"))


def _provenance(lex: Lexicon, table: str, with_provenance: bool) -> DataFrame:
    """(item_id, prov): the Provenance elements of each row."""
    p = lex.provenance.filter(F.col("table_name") == table)
    if not with_provenance:
        p = p.filter("false")
    one = F.concat(F.lit("<Provenance"), attribute("resource", F.col("resource")), attribute("version", F.col("version")), attribute("original_id", F.col("original_id")), F.lit("/>"))
    return p.withColumn("x", one).groupBy("item_id").agg(F.array_join(F.sort_array(F.collect_list("x")), "").alias("prov"))


def export_lines(lex: Lexicon, with_provenance: bool = True) -> DataFrame:
    """(layer, id, xml): one element a row, layers in the order of the schema. Only stored forward relations are written,
    symmetric ones once."""
    y, e, s = keys(lex)
    lang = lex.languages.select(F.col("id").alias("language_id"), F.col("code").alias("language"))

    def closed(df: DataFrame, table: str):
        p = _provenance(lex, table, with_provenance)
        return df.join(p, F.col("id") == F.col("item_id"), "left").withColumn("prov", F.coalesce("prov", F.lit("")))

    concept = closed(lex.synsets.join(y, "id"), "synsets")
    concept = concept.select(F.lit(1).alias("layer"), "id", F.concat(F.lit("<Concept"), attribute("id", F.col("key")), attribute("ontological_category", F.col("pos")), F.lit(' status="1">'), "prov", F.lit("</Concept>")).alias("xml"))
    pron = lex.pronunciations.withColumn("x", F.concat(F.lit("<Pronunciation"), attribute("variety", F.col("variety")), F.lit(">"), escaped(F.col("pron")), F.lit("</Pronunciation>")))
    pron = pron.groupBy(F.col("form_id").alias("_f")).agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("id", "x"))), lambda v: v["x"]), "").alias("prons"))
    form = lex.forms.join(pron, F.col("id") == F.col("_f"), "left").withColumn("x", F.concat(F.lit("<Wordform"), attribute("form", F.col("form")), F.lit(">"), F.coalesce("prons", F.lit("")), F.lit("</Wordform>")))
    form = form.groupBy("entry_id").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("rank", "id", "x"))), lambda v: v["x"]), "").alias("forms"))
    lexeme = closed(lex.entries.join(e, "id").join(lang, "language_id").join(form, F.col("id") == F.col("entry_id")), "entries")
    lexeme = lexeme.select(F.lit(3).alias("layer"), "id", F.concat(F.lit("<Lexeme"), attribute("id", F.col("key")), attribute("language", F.col("language")), attribute("grammatical_category", F.col("pos")), F.lit(">"), "forms", "prov", F.lit("</Lexeme>")).alias("xml"))
    named = lambda k, name: k.select(F.col("id").alias(f"_{name}"), F.col("key").alias(name))
    sense = closed(lex.senses.join(s, "id").join(named(e, "signifier"), F.col("entry_id") == F.col("_signifier")).join(named(y, "signified"), F.col("synset_id") == F.col("_signified")), "senses")
    sense = sense.select(F.lit(4).alias("layer"), "id", F.concat(F.lit("<Sense"), attribute("id", F.col("key")), attribute("signifier", F.col("signifier")), attribute("signified", F.col("signified")), F.lit(">"), "prov", F.lit("</Sense>")).alias("xml"))

    def sentences(items: DataFrame, annotations: DataFrame, key: str) -> DataFrame:
        a = annotations.join(named(s, "sense"), F.col("sense_id") == F.col("_sense")).groupBy(F.col(key).alias("_k")).agg(F.sort_array(F.collect_list(F.struct("start", "end", "sense"))).alias("spans"))
        return items.join(a, F.col("id") == F.col("_k"), "left").withColumn("spans", F.coalesce("spans", F.array().cast("array<struct<start:int,end:int,sense:string>>")))

    gloss = closed(sentences(lex.definitions.join(lang, "language_id").join(named(y, "definiendum"), F.col("synset_id") == F.col("_definiendum")), lex.definition_annotations, "definition_id"), "definitions")
    gloss = gloss.select(F.lit(2).alias("layer"), "id", F.concat(F.lit("<Gloss"), attribute("definiendum", F.col("definiendum")), attribute("language", F.col("language")), F.lit(">"), mixed("definition", "spans"), "prov", F.lit("</Gloss>")).alias("xml"))
    example = closed(sentences(lex.examples, lex.example_annotations, "example_id"), "examples")
    example = example.select(F.lit(5).alias("layer"), "id", F.concat(F.lit("<Example>"), mixed("example", "spans"), "prov", F.lit("</Example>")).alias("xml"))

    def relation(df: DataFrame, k: DataFrame, tag: str, layer: int, table: str, forward: tuple[str, ...], symmetric: tuple[str, ...]) -> DataFrame:
        kept = df.filter(F.col("type").isin(*forward) | (F.col("type").isin(*symmetric) & (F.col("source") < F.col("target"))))
        r = closed(kept.join(named(k, "a"), F.col("source") == F.col("_a")).join(named(k, "b"), F.col("target") == F.col("_b")), table)
        return r.select(F.lit(layer).alias("layer"), "id", F.concat(F.lit(f"<{tag}"), attribute("relation_type", F.col("type")), attribute("source", F.col("a")), attribute("target", F.col("b")), F.lit(">"), "prov", F.lit(f"</{tag}>")).alias("xml"))

    from ..model import SENSE_TYPES

    # Types without a stored inverse are written as they are; those that are their own inverse once a pair.
    forward = (*(k for k, v in CONCEPT_INVERSES.items() if k != v), "similar", "eq_synonym")
    concepts = relation(lex.synset_relations, y, "ConceptRelation", 7, "synset_relations", forward, ("antonym",))
    senses = relation(lex.sense_relations, s, "SenseRelation", 6, "sense_relations", ("none",), SENSE_TYPES)
    out = concept
    for part in (gloss, lexeme, sense, example, senses, concepts):
        out = out.unionByName(part)
    return out


def write_xml(lex: Lexicon, path: str, root: dict[str, str], with_provenance: bool = True) -> None:
    """The export as ordered text parts in the folder path: a header part, element parts, a footer part.

    Elements are range-sorted and written by many tasks; the parts in name order make the document.
    """
    spark = lex.synsets.sparkSession
    lines = export_lines(lex, with_provenance)
    head = "<?xml version='1.0' encoding='UTF-8'?>\n<LexicalResource" + "".join(f" {k}={quoteattr(v)}" for k, v in root.items()) + ">"
    edges = spark.createDataFrame([(0, 0, head), (99, 0, "</LexicalResource>")], "layer int, id long, xml string")
    # Negative ids (copied rows) sort first within their layer; the footer's layer is above all others.
    every = lines.unionByName(edges)
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    every.repartitionByRange(n, "layer", "id").sortWithinPartitions("layer", "id").select("xml").write.mode("overwrite").text(path)


def write_log(reversed_relations: DataFrame, cycles: DataFrame, path: str) -> None:
    """The conflict log as JSON lines in path/reversed_relations and path/cycles."""
    reversed_relations.write.mode("overwrite").json(f"{path}/reversed_relations")
    cycles.write.mode("overwrite").json(f"{path}/cycles")


def latex_table(rows: list, columns: list[str], heads: list[str] | None = None, long: bool = False) -> str:
    """A collected small table as LaTeX; numbers get thousands separators in braces, so that none is set as punctuation, missing values a dash."""
    special = str.maketrans({c: f"\\{c}" for c in "&%$#_{}"})

    def cell(v):
        if v is None:
            return "---"
        return f"{v:,}".replace(",", "{,}") if isinstance(v, int) else f"{v:,.1f}".replace(",", "{,}") if isinstance(v, float) else str(v).translate(special)

    numeric = [all(isinstance(r[c], (int, float)) or r[c] is None for r in rows) for c in columns]
    kind = "longtable" if long else "tabular"
    out = [f"\\begin{{{kind}}}{{{''.join('r' if x else 'l' for x in numeric)}}}", " & ".join(h.translate(special) for h in heads or columns) + r" \\ \hline"]
    out += [" & ".join(cell(r[c]) for c in columns) + r" \\" for r in rows]
    return "\n".join([*out, f"\\end{{{kind}}}"]) + "\n"
