"""The driver's tables as a lexicon, once for Spark and once as DuckDB views (COMMON_SQL).

Ids are computed from the rows' own keys, so that no window over a whole table is needed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import with_norm
from ..model import Lexicon


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: The dimension of languages of the documents table.
CODES = ("de", "en", "es", "fr")


def languages(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(k + 1, c, None) for k, c in enumerate(CODES)], "id long, code string, name string")


def words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(no, synset_id, form, pos, language_id): every part is a word, every third one in capitals too."""
    p = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type", "p_size")
    variants = F.when(F.col("p_partkey") % 3 == 0, F.array("p_name", F.upper("p_name"))).otherwise(F.array("p_name"))
    rows = p.select("p_partkey", "p_type", "p_size", F.posexplode(variants).alias("k", "form"))
    return rows.select((F.col("p_partkey") * 2 + F.col("k") + 1).alias("no"), (F.col("p_partkey") + 1).alias("synset_id"), "form", F.col("p_type").alias("pos"), (F.col("p_size") % 4 + 1).cast("long").alias("language_id"))


def entries_with_form(spark: SparkSession, sf_dir: str) -> DataFrame:
    return words(spark, sf_dir).groupBy("form", "pos", "language_id").agg(F.min("no").alias("id"))


def relations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(source, target, type, seq, resource) of lineitem; seq is the whole row, which has no ties."""
    li = table(spark, sf_dir, "lineitem")
    kind = F.when(F.col("l_returnflag") == "A", "hypernym").when(F.col("l_returnflag") == "N", "mero_part").otherwise("entails")
    seq = F.struct("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag", "l_linestatus", "l_shipdate", "l_quantity", "l_extendedprice")
    return li.select((F.col("l_partkey") + 1).alias("source"), (F.col("l_suppkey") + 1).alias("target"), kind.alias("type"), seq.alias("seq"), F.col("l_linestatus").alias("resource"))


def lexicon(spark: SparkSession, sf_dir: str) -> Lexicon:
    p, docs = table(spark, sf_dir, "part"), table(spark, sf_dir, "documents")
    ili = F.when(F.col("p_partkey") % 10 != 9, F.concat(F.lit("i"), F.col("p_partkey").cast("string")))
    synsets = p.select((F.col("p_partkey") + 1).alias("id"), ili.alias("ili"), F.col("p_type").alias("pos"))
    w = words(spark, sf_dir)
    e = entries_with_form(spark, sf_dir)
    senses = w.join(e.withColumnRenamed("id", "entry_id"), ["form", "pos", "language_id"]).select(F.col("no").alias("id"), "entry_id", "synset_id", F.lit(None).cast("int").alias("sense_index"))
    forms = with_norm(e.select("id", F.col("id").alias("entry_id"), "form", F.lit(0).alias("rank"))).select("id", "entry_id", "form", "norm", "rank")
    quarter = F.greatest(F.floor(F.lit(p.count()) / 4), F.lit(1))
    code = F.element_at(F.create_map(*[x for k, c in enumerate(CODES) for x in (F.lit(c), F.lit(k + 1))]), F.col("lang")).cast("long")
    raw = docs.select((F.col("doc_id") + 1).alias("id"), (F.col("doc_id") % quarter + 1).alias("synset_id"), F.col("text").alias("definition"), code.alias("language_id"))
    definitions = raw.groupBy("synset_id", "language_id").agg(F.min_by(F.struct("id", "definition"), "id").alias("x")).select("x.id", "synset_id", "x.definition", "language_id")
    acyclic = p.filter("p_partkey >= 1").select((F.col("p_partkey") + 1).alias("id"), (F.col("p_partkey") + 1).alias("source"), (F.floor(F.col("p_partkey") / 3) + 1).alias("target"), F.lit("hypernym").alias("type"))
    o = table(spark, sf_dir, "orders")
    provenance = o.select(F.lit("senses").alias("table_name"), F.col("o_custkey").alias("item_id"), F.col("o_orderpriority").alias("resource"), F.col("o_orderstatus").alias("version"), F.col("o_orderkey").cast("string").alias("original_id"))
    return Lexicon.of(spark, languages=languages(spark), synsets=synsets, entries=e.select("id", "language_id", "pos"), forms=forms, senses=senses, definitions=definitions, synset_relations=acyclic, provenance=provenance)


def elements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The driver's tables as records of one resource, in the form of sources.xml.read: parts are concepts and words,
    orders link them, documents explain them, every part is a kind of the part a third as far."""
    part, orders, docs = table(spark, sf_dir, "part"), table(spark, sf_dir, "orders"), table(spark, sf_dir, "documents")
    none = F.lit(None).cast("string")

    def child(path: str, order: int, text: Column, **attrs) -> Column:
        pairs = [x for k, v in attrs.items() for x in (F.lit(k), v)]
        return F.struct(F.lit(path).alias("path"), F.lit(order).alias("ord"), F.lit(-1).alias("parent"), F.create_map(*pairs).alias("attrs"), text.alias("text"))

    told = child("Provenance", 9, none, resource=F.lit("driver"), version=F.lit("1"))

    def record(df: DataFrame, layer: int, tag: str, number: Column, children: Column | None = None, text: Column = none, **attrs) -> DataFrame:
        pairs = [x for k, v in attrs.items() for x in (F.lit(k), v)]
        return df.select(
            F.lit(0).alias("resource_ord"), (F.lit(layer << 50).cast("long") + number).alias("element_ord"), F.lit(tag).alias("tag"), F.create_map(*pairs).alias("attrs"),
            F.create_map(F.lit("id"), F.lit("driver"), F.lit("version"), F.lit("1")).alias("root"), text.alias("text"), F.array().cast("array<struct<start:int,end:int,sense:string>>").alias("spans"),
            F.array(told).alias("children") if children is None else F.concat(children, F.array(told)).alias("children"),
        )

    key, named = F.col("p_partkey"), lambda prefix, c: F.concat(F.lit(prefix), c.cast("string"))
    language = F.element_at(F.array(*map(F.lit, CODES)), F.col("p_size") % 4 + 1)
    name, capitals = child("Wordform", 0, none, form=F.col("p_name")), child("Wordform", 1, none, form=F.upper("p_name"))
    out = record(part, 1, "Concept", key, id=named("cili.i", key), ontological_category=F.col("p_type"))
    out = out.unionByName(record(docs.filter("lang IS NOT NULL"), 2, "Gloss", F.col("doc_id"), text=F.col("text"), definiendum=named("cili.i", F.col("doc_id") % 500), language=F.col("lang")))
    out = out.unionByName(record(part, 3, "Lexeme", key, F.when(key % 3 == 0, F.array(name, capitals)).otherwise(F.array(name)), id=named("w", key), language=language, grammatical_category=F.col("p_type")))
    order = F.col("o_orderkey")
    out = out.unionByName(record(orders, 4, "Sense", order, id=named("s", order), signifier=named("w", F.col("o_custkey")), signified=named("cili.i", order % 1000)))
    kind = part.filter("p_partkey >= 1")
    return out.unionByName(record(kind, 5, "ConceptRelation", key, relation_type=F.lit("hypernym"), source=named("cili.i", key), target=named("cili.i", F.floor(key / 3))))


COMMON_SQL = """
WITH RECURSIVE languages AS (SELECT * FROM (VALUES (1::BIGINT, 'de'), (2, 'en'), (3, 'es'), (4, 'fr')) t(id, code)),
synsets AS (SELECT p_partkey + 1 AS id, CASE WHEN p_partkey % 10 <> 9 THEN 'i' || p_partkey END AS ili, p_type AS pos FROM part),
words AS (
  SELECT p_partkey * 2 + 1 AS no, p_partkey + 1 AS synset_id, p_name AS form, p_type AS pos, (p_size % 4 + 1)::BIGINT AS language_id FROM part
  UNION ALL SELECT p_partkey * 2 + 2, p_partkey + 1, upper(p_name), p_type, (p_size % 4 + 1)::BIGINT FROM part WHERE p_partkey % 3 = 0
),
entries AS (SELECT form, pos, language_id, min(no) AS id FROM words GROUP BY ALL),
forms AS (SELECT id, id AS entry_id, form, strip_accents(lower(form)) AS norm, 0 AS rank FROM entries),
senses AS (SELECT w.no AS id, e.id AS entry_id, w.synset_id FROM words w JOIN entries e USING (form, pos, language_id)),
rawdefs AS (SELECT doc_id + 1 AS id, doc_id % greatest((SELECT count(*) FROM part) // 4, 1) + 1 AS synset_id, text AS definition, l.id AS language_id FROM documents JOIN languages l ON l.code = lang),
definitions AS (SELECT * FROM rawdefs QUALIFY row_number() OVER (PARTITION BY synset_id, language_id ORDER BY id) = 1),
acyclic AS (SELECT p_partkey + 1 AS id, p_partkey + 1 AS source, p_partkey // 3 + 1 AS target FROM part WHERE p_partkey >= 1),
rels AS (
  SELECT l_partkey + 1 AS source, l_suppkey + 1 AS target, CASE l_returnflag WHEN 'A' THEN 'hypernym' WHEN 'N' THEN 'mero_part' ELSE 'entails' END AS type, l_linestatus AS resource,
    row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_returnflag, l_linestatus, l_shipdate, l_quantity, l_extendedprice) AS seq FROM lineitem
),
prov AS (SELECT 'senses' AS table_name, o_custkey AS item_id, o_orderpriority AS resource, o_orderstatus AS version, o_orderkey::VARCHAR AS original_id FROM orders),
star AS (
  SELECT f.form, f.norm, g.code AS language, y.pos, y.ili, s.id AS sense_id, s.synset_id FROM forms f JOIN entries e ON f.entry_id = e.id JOIN languages g ON e.language_id = g.id
  JOIN senses s ON s.entry_id = e.id JOIN synsets y ON s.synset_id = y.id
),
en AS (SELECT synset_id, definition FROM definitions WHERE language_id = 2)
"""
