"""Registered queries over the driver's tables, and their DuckDB counterparts."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..model import CONCEPT_INVERSES, SENSE_INVERSES
from ..operators import convert, graph, ingest, post, quality, search, stats
from ..operators import relations as rel
from ..operators.ids import first_by, number
from ..scratch import shared_dir
from . import adapter
from .adapter import COMMON_SQL, lexicon, table

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None, common: bool = True):
    def put(f):
        QUERIES[name] = f
        if sql is not None:
            ORACLES[name] = (COMMON_SQL if common else "") + sql
        return f

    return put


FOUND = ["form", "language", "pos", "ili", "sense_id", "definition"]
FOUND_SQL = " SELECT form, language, pos, ili, sense_id, definition FROM star LEFT JOIN en USING (synset_id) "


def _term(spark: SparkSession, sf_dir: str) -> str:
    """A form that occurs: the smallest one."""
    return table(spark, sf_dir, "part").agg(F.min("p_name")).first()[0]


# ---- searches ----


@query("search_exact", FOUND_SQL + "WHERE norm = (SELECT strip_accents(lower(min(p_name))) FROM part)")
def search_exact(spark, sf):
    return search.search(lexicon(spark, sf), _term(spark, sf)).select(*FOUND)


@query("search_glob", FOUND_SQL + "WHERE norm GLOB '*a*[b-m]*'")
def search_glob(spark, sf):
    return search.by_glob(lexicon(spark, sf), "*a*[b-m]*").select(*FOUND)


@query("search_glob_forms", " SELECT DISTINCT form, language FROM star WHERE norm LIKE 'b%' AND language = 'en'")
def search_glob_forms(spark, sf):
    return search.glob_forms(lexicon(spark, sf), "B*", "en")


@query("search_ili", FOUND_SQL + "WHERE ili = 'i42'")
def search_ili(spark, sf):
    return search.search(lexicon(spark, sf), "cili.i42").select(*FOUND)


DEF_SQL = " SELECT form, language, pos, ili, sense_id, en.definition FROM star LEFT JOIN en USING (synset_id) WHERE synset_id IN (SELECT synset_id FROM definitions WHERE contains(translate(definition, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), 'the and'))"


@query("search_def", DEF_SQL)
def search_def(spark, sf):
    return search.search(lexicon(spark, sf), "def:The AND").select(*FOUND)


@query("search_lang_filter", DEF_SQL + " AND language IN ('en', 'fr')")
def search_lang_filter(spark, sf):
    return search.search(lexicon(spark, sf), "def:the and", ["en", "fr"]).select(*FOUND)


@query("search_counts", " SELECT count(*)::BIGINT AS results, count(DISTINCT language)::BIGINT AS languages FROM star WHERE norm LIKE 'b%'")
def search_counts(spark, sf):
    return search.result_counts(search.by_glob(lexicon(spark, sf), "b*"))


@query("translations", " SELECT language, string_agg(DISTINCT form, ',' ORDER BY form) AS forms FROM star WHERE ili = 'i6' GROUP BY language")
def translations(spark, sf):
    return search.translations(lexicon(spark, sf), "i6")


@query("definitions_by_lang", " SELECT code AS language, definition FROM definitions d JOIN languages l ON d.language_id = l.id WHERE synset_id = 3")
def definitions_by_lang(spark, sf):
    return search.definitions_of(lexicon(spark, sf), 3)


@query("concept_view", """, f AS (SELECT synset_id, string_agg(DISTINCT language || ':' || form, ',' ORDER BY language || ':' || form) AS forms FROM star GROUP BY 1),
r AS (SELECT source, string_agg(DISTINCT 'hypernym:' || target, ',' ORDER BY 'hypernym:' || target) AS relations FROM acyclic GROUP BY 1)
SELECT y.id AS synset_id, ili, pos, coalesce(forms, '') AS forms, coalesce(relations, '') AS relations FROM synsets y LEFT JOIN f ON f.synset_id = y.id LEFT JOIN r ON r.source = y.id""")
def concept_view(spark, sf):
    return search.concept_view(lexicon(spark, sf)).withColumns({c: F.array_join(c, ",") for c in ("forms", "relations")})


@query("sense_view", " SELECT sense_id, ili, language, form AS forms FROM star WHERE sense_id = 13")
def sense_view(spark, sf):
    return search.sense_view(lexicon(spark, sf), 13).select("sense_id", "ili", "language", F.array_join("forms", ",").alias("forms"))


@query("normalized_forms", " SELECT doc_id, strip_accents(lower(text)) AS norm FROM documents")
def normalized_forms(spark, sf):
    """Decomposed search forms; these texts have no character whose decomposition keeps more than one."""
    return T.with_norm(table(spark, sf, "documents").select("doc_id", "text"), "text").select("doc_id", "norm")


@query("ascii_folding", " SELECT doc_id, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS folded, substr(text, 1, 60) AS preview FROM documents")
def ascii_folding(spark, sf):
    return table(spark, sf, "documents").select("doc_id", T.ascii_lower(F.col("text")).alias("folded"), T.preview(F.col("text")).alias("preview"))


@query("normalize_text", r""" SELECT doc_id, lower(regexp_replace(trim(regexp_replace(text, '\s+', ' ', 'g')), '[.,;:!?]+$', '')) AS norm FROM documents""")
def normalize_text(spark, sf):
    return table(spark, sf, "documents").select("doc_id", T.normalize_text(F.col("text")).alias("norm"))


@query("url_parts", r"""
SELECT page_id, regexp_replace(regexp_replace(regexp_replace(split_part(url, '/', -1), '\.(tar\.gz|tar\.xz|tgz|gz|xz|zip)$', ''), '\.xml$', ''), '-[\d.]+$', '') AS stem FROM pages""", common=False)
def url_parts(spark, sf):
    return table(spark, sf, "pages").select("page_id", T.package_stem(F.col("url")).alias("stem"))


@query("xml_id_encode", " SELECT p_partkey, replace(replace(p_name, 'x', 'x'), ' ', 'x0020') AS code FROM part", common=False)
def xml_id_encode(spark, sf):
    return table(spark, sf, "part").select("p_partkey", T.xml_id_arrow(F.col("p_name")).alias("code"))


@query("extra_json", " SELECT event_id, CASE WHEN json_extract_string(props, '$.k') IS NOT NULL THEN '{\"k\":\"' || json_extract_string(props, '$.k') || '\"}' END AS extra FROM events", common=False)
def extra_json(spark, sf):
    return table(spark, sf, "events").select("event_id", T.extra_json(F.from_json("props", "map<string,string>")).alias("extra"))


#: Addresses and names as resources state them.
STATED = (
    "https://creativecommons.org/licenses/by/4.0/", "https://creativecommons.org/licenses/by/3.0/", "https://creativecommons.org/licenses/by/2.0/", "https://creativecommons.org/licenses/by-sa/4.0/",
    "https://creativecommons.org/licenses/by-sa/3.0/", "https://creativecommons.org/licenses/by-sa/", "https://creativecommons.org/licenses/by-nc/4.0/", "https://opensource.org/licenses/Apache-2.0",
    "https://opensource.org/licenses/MIT", "http://www.cecill.info/licences", "http://opendefinition.org/licenses/odc-by/", "WordNet", "wordnet", "", "permitted use", "https://creativecommons.org/publicdomain/zero/1.0/",
)


@query("licence_labels", f"""
WITH d AS (SELECT doc_id, n_chars, {list(STATED)}[doc_id % {len(STATED) + 1} + 1] AS raw FROM documents)
SELECT doc_id, CASE WHEN raw IS NULL OR raw = '' THEN 'N/A' WHEN lower(raw) = 'wordnet' THEN 'WordNet'
  WHEN contains(raw, 'creativecommons.org/licenses/by/') THEN CASE substr(split_part(raw, '/by/', 2), 1, 1) WHEN '4' THEN 'CC BY 4.0' WHEN '3' THEN 'CC BY 3.0' ELSE 'CC BY' END
  WHEN contains(raw, 'creativecommons.org/licenses/by-sa/') THEN CASE substr(split_part(raw, '/by-sa/', 2), 1, 1) WHEN '4' THEN 'CC BY-SA 4.0' WHEN '3' THEN 'CC BY-SA 3.0' ELSE 'CC BY-SA' END
  WHEN contains(raw, 'creativecommons.org/licenses/by-nc/4') THEN 'CC BY-NC 4.0' WHEN contains(raw, 'licenses/Apache-2.0') THEN 'Apache 2.0' WHEN contains(raw, 'licenses/MIT') THEN 'MIT'
  WHEN contains(raw, 'cecill.info') THEN 'CeCILL-C' WHEN contains(raw, 'licenses/odc-by') THEN 'ODC-BY' ELSE raw END AS label, format('{{:,}}', n_chars) AS shown FROM d""", common=False)
def licence_labels(spark, sf):
    raw = F.get(F.array(*map(F.lit, STATED)), (F.col("doc_id") % (len(STATED) + 1)).cast("int"))
    return table(spark, sf, "documents").select("doc_id", T.licence_label(raw).alias("label"), T.thousands(F.col("n_chars")).alias("shown"))


# ---- merge phases ----

LEMMA = "translate(f.form, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


@query("sense_index", f""" SELECT s.id, row_number() OVER (PARTITION BY e.language_id, {LEMMA}, y.pos ORDER BY s.id)::INT AS sense_index
FROM senses s JOIN entries e ON s.entry_id = e.id JOIN forms f ON f.entry_id = e.id JOIN synsets y ON s.synset_id = y.id""")
def sense_index(spark, sf):
    return post.sense_indices(lexicon(spark, sf)).select("id", "sense_index")


@query("gloss_first_wins", " SELECT id, synset_id, language_id, definition FROM definitions")
def gloss_first_wins(spark, sf):
    return lexicon(spark, sf).definitions


@query("form_rank", " SELECT synset_id, form, (row_number() OVER (PARTITION BY synset_id ORDER BY no) - 1)::INT AS rank FROM words")
def form_rank(spark, sf):
    from pyspark.sql import Window

    w = Window.partitionBy("synset_id").orderBy("no")
    return adapter.words(spark, sf).select("synset_id", "form", (F.row_number().over(w) - 1).cast("int").alias("rank"))


@query("sense_dedup", " SELECT l_partkey AS entry, l_suppkey AS synset, min(l_orderkey) AS first FROM lineitem GROUP BY 1, 2", common=False)
def sense_dedup(spark, sf):
    li = table(spark, sf, "lineitem").select(F.col("l_partkey").alias("entry"), F.col("l_suppkey").alias("synset"), F.col("l_orderkey").alias("first"))
    return first_by(li, ["entry", "synset"], ["first"])


@query("surrogate_ids", " SELECT o_orderkey, row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS id FROM orders", common=False)
def surrogate_ids(spark, sf):
    return number(table(spark, sf, "orders").select("o_orderkey", "o_orderdate"), ["o_orderdate", "o_orderkey"]).select("o_orderkey", "id")


GROUPS = f"""v AS (SELECT s.id AS sense_id, e.id AS entry_id, {LEMMA} AS folded, e.language_id, e.pos, s.synset_id
  FROM senses s JOIN entries e ON s.entry_id = e.id JOIN forms f ON f.entry_id = e.id)"""


@query("case_variant_groups", f", {GROUPS} SELECT folded, language_id, pos, synset_id, count(*)::BIGINT AS n, min(sense_id) AS keep_sense FROM v GROUP BY 1, 2, 3, 4 HAVING count(*) > 1")
def case_variant_groups(spark, sf):
    lex = lexicon(spark, sf)
    v = post.variant_senses(lex)
    e = lex.entries.select(F.col("id").alias("entry_id"), "language_id", "pos").join(post.lemmas(lex.forms), "entry_id")
    s = v.join(e, "entry_id").join(lex.senses.select(F.col("id").alias("sense_id"), "synset_id"), "sense_id")
    return s.groupBy(T.ascii_lower(F.col("lemma")).alias("folded"), "language_id", "pos", "synset_id").agg(F.count("*").alias("n"), F.min("keep_sense").alias("keep_sense"))


@query("case_variant_remap", f", {GROUPS} SELECT sense_id, keep_sense FROM (SELECT sense_id, min(sense_id) OVER (PARTITION BY folded, language_id, pos, synset_id) AS keep_sense FROM v) WHERE sense_id <> keep_sense")
def case_variant_remap(spark, sf):
    return post.merge_case_variants(lexicon(spark, sf))[1]


@query("case_variant_forms", f""", {GROUPS}, k AS (SELECT entry_id, first_value(entry_id) OVER (PARTITION BY folded, language_id, pos, synset_id ORDER BY sense_id) AS keep FROM v),
c AS (SELECT DISTINCT k.keep AS entry_id, f.form FROM k JOIN forms f ON f.entry_id = k.entry_id WHERE k.keep <> k.entry_id)
SELECT entry_id, form FROM forms UNION SELECT entry_id, form FROM c""")
def case_variant_forms(spark, sf):
    return post.merge_case_variants(lexicon(spark, sf))[0].forms.select("entry_id", "form")


CASCADE = """y2 AS (SELECT id FROM synsets WHERE id IN (SELECT synset_id FROM definitions)), s2 AS (SELECT * FROM senses WHERE synset_id IN (SELECT id FROM y2)),
r2 AS (SELECT * FROM acyclic WHERE source IN (SELECT id FROM y2) AND target IN (SELECT id FROM y2))"""


@query("cascade_delete_counts", f""", {CASCADE} SELECT 'synsets' AS table_name, ((SELECT count(*) FROM synsets) - (SELECT count(*) FROM y2))::BIGINT AS removed
UNION ALL SELECT 'senses', (SELECT count(*) FROM senses) - (SELECT count(*) FROM s2) UNION ALL SELECT 'synset_relations', (SELECT count(*) FROM acyclic) - (SELECT count(*) FROM r2)""")
def cascade_delete_counts(spark, sf):
    lex = lexicon(spark, sf)
    return post.removed_counts(lex, post.cascade_delete(lex), ("synsets", "senses", "synset_relations"))


@query("orphan_entries", f", {CASCADE} SELECT id FROM entries WHERE id NOT IN (SELECT entry_id FROM s2)")
def orphan_entries(spark, sf):
    lex = post.cascade_delete(lexicon(spark, sf))
    return lex.entries.select("id").join(post.remove_orphans(lex).entries.select("id"), "id", "left_anti")


# ---- relations and graphs ----

INVERSE_CASE = "CASE type " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in CONCEPT_INVERSES.items()) + " END"


@query("inverse_materialise", f" SELECT source, target, type FROM rels UNION SELECT target, source, {INVERSE_CASE} FROM rels")
def inverse_materialise(spark, sf):
    return rel.with_inverses(adapter.relations(spark, sf), CONCEPT_INVERSES)


WIN = "w AS (SELECT type, least(source, target) AS l, greatest(source, target) AS h, arg_min(source <= target, seq) AS up, min(seq) AS first FROM rels GROUP BY ALL)"


@query("relation_conflicts", f", {WIN} SELECT source, target, r.type, resource, count(*)::BIGINT AS n FROM rels r JOIN w ON r.type = w.type AND least(source, target) = l AND greatest(source, target) = h WHERE (source <= target) <> up OR (l = h AND seq > first) GROUP BY ALL")
def relation_conflicts(spark, sf):
    return rel.resolve(adapter.relations(spark, sf), CONCEPT_INVERSES)[1].groupBy("source", "target", "type", "resource").agg(F.count("*").alias("n"))


@query("relation_dedup", f", {WIN}, k AS (SELECT CASE WHEN up THEN l ELSE h END AS source, CASE WHEN up THEN h ELSE l END AS target, type FROM w) SELECT source, target, type, false AS generated FROM k UNION ALL SELECT target, source, {INVERSE_CASE}, true FROM k")
def relation_dedup(spark, sf):
    return rel.resolve(adapter.relations(spark, sf), CONCEPT_INVERSES)[0].select("source", "target", "type", "generated")


def _source_relations(spark, sf) -> DataFrame:
    kind = F.when(F.col("type") == "hypernym", "hyponym").when(F.col("type") == "mero_part", "antonym").otherwise(F.col("type"))
    return adapter.relations(spark, sf).withColumn("type", kind)


@query("convert_relations", """ SELECT DISTINCT target AS source, source AS target, 'hypernym' AS type FROM rels WHERE type = 'hypernym'
UNION ALL SELECT DISTINCT least(source, target), greatest(source, target), 'antonym' FROM rels WHERE type = 'mero_part' UNION ALL SELECT DISTINCT source, target, type FROM rels WHERE type = 'entails'""")
def convert_relations(spark, sf):
    from ..model import CONCEPT_TYPES, SOURCE_CONCEPT_PAIRS

    return rel.convert(_source_relations(spark, sf), {t: t for t in CONCEPT_TYPES}, SOURCE_CONCEPT_PAIRS)


@query("category_mismatches", " SELECT r.type, count(*)::BIGINT AS n, count(*) FILTER (a.pos <> b.pos)::BIGINT AS mismatched FROM rels r JOIN synsets a ON r.source = a.id JOIN synsets b ON r.target = b.id GROUP BY 1")
def category_mismatches(spark, sf):
    from ..model import SAME_CATEGORY_TYPES

    return rel.category_mismatches(adapter.relations(spark, sf), lexicon(spark, sf).synsets.select("id", "pos"), SAME_CATEGORY_TYPES)


def _cyclic(spark, sf) -> DataFrame:
    k = F.col("n_nationkey").cast("long")
    return table(spark, sf, "nation").select(k.alias("source"), ((k * k + 3) % 25).alias("target"), (k >= 12).alias("is_new"))


REACH = "WITH RECURSIVE e AS (SELECT n_nationkey::BIGINT AS s, (n_nationkey * n_nationkey + 3)::BIGINT % 25 AS t FROM nation), r AS (SELECT s, t FROM e UNION SELECT r.s, e.t FROM r JOIN e ON r.t = e.s)"


@query("cycle_edges_removed", REACH + " SELECT e.s AS source, e.t AS target FROM e WHERE e.s >= 12 AND EXISTS (SELECT 1 FROM r WHERE r.s = e.t AND r.t = e.s)", common=False)
def cycle_edges_removed(spark, sf):
    return graph.remove_new_cycles(spark, _cyclic(spark, sf))[1].select("source", "target")


@query("residual_cycles", REACH + ", c AS (SELECT a.s AS node, min(a.t) AS component FROM r a JOIN r b ON a.s = b.t AND a.t = b.s GROUP BY 1) SELECT component, count(*)::BIGINT AS n_nodes FROM c GROUP BY 1", common=False)
def residual_cycles(spark, sf):
    return graph.residual_cycles(spark, _cyclic(spark, sf))


def _merged(spark, sf) -> DataFrame:
    """Every relation's edge once; one is new if only the resource O has it."""
    return adapter.relations(spark, sf).groupBy("source", "target").agg(F.min(F.col("resource") == "O").alias("is_new"))


# Over all relations; recursive SQL is too slow there, so a small fixture is held against plain reachability (tests).
@query("relation_cycle_edges_removed")
def relation_cycle_edges_removed(spark, sf):
    return graph.remove_new_cycles(spark, _merged(spark, sf), chains=False)[1].select("source", "target")


@query("relation_residual_cycles")
def relation_residual_cycles(spark, sf):
    return graph.residual_cycles(spark, _merged(spark, sf))


@query("representative_cycles")
def representative_cycles(spark, sf):
    return graph.representative_cycles(spark, _merged(spark, sf)).select("component", F.array_join("cycle", ">").alias("cycle"))


@query("hypernym_chain", ", c AS (SELECT 1001::BIGINT AS node, 0 AS depth UNION ALL SELECT a.target, depth + 1 FROM c JOIN acyclic a ON a.source = c.node) SELECT depth, node FROM c")
def hypernym_chain(spark, sf):
    return graph.chain(spark, lexicon(spark, sf).synset_relations, 1001)


@query("hypernym_ancestors", ", c AS (SELECT source AS node, target AS ancestor, 1 AS depth FROM acyclic UNION ALL SELECT c.node, a.target, depth + 1 FROM c JOIN acyclic a ON a.source = c.ancestor) SELECT node, ancestor, depth FROM c")
def hypernym_ancestors(spark, sf):
    return graph.ancestors(spark, lexicon(spark, sf).synset_relations)


@query("hypernym_path", ", c AS (SELECT 501::BIGINT AS node, 0 AS depth UNION ALL SELECT a.target, depth + 1 FROM c JOIN acyclic a ON a.source = c.node WHERE c.node <> 1) SELECT string_agg(node::VARCHAR, '>' ORDER BY depth) AS path FROM c")
def hypernym_path(spark, sf):
    path = graph.find_path(spark, lexicon(spark, sf).synset_relations, 501, 1)
    return spark.createDataFrame([(">".join(map(str, path)) if path else None,)], "path string")


def _pictures(spark, sf) -> DataFrame:
    p = table(spark, sf, "part").filter("p_size < 8")
    return p.select((F.col("p_partkey") + 1).alias("synset_id"), (F.col("p_partkey") + 2000).alias("arasaac_id"))


@query("pictogram_fallback", """, pic AS (SELECT p_partkey + 1 AS synset_id, p_partkey + 2000 AS picture FROM part WHERE p_size < 8),
c AS (SELECT source AS node, target AS ancestor, 1 AS depth FROM acyclic UNION ALL SELECT c.node, a.target, depth + 1 FROM c JOIN acyclic a ON a.source = c.ancestor),
near AS (SELECT node, arg_min(picture, depth) AS picture FROM c JOIN pic ON pic.synset_id = c.ancestor GROUP BY 1)
SELECT y.id AS synset_id, coalesce(p.picture, n.picture) AS arasaac_id, CASE WHEN p.picture IS NOT NULL THEN 'direct' WHEN n.picture IS NOT NULL THEN 'hypernym' END AS via
FROM synsets y LEFT JOIN pic p ON p.synset_id = y.id LEFT JOIN near n ON n.node = y.id""")
def pictogram_fallback(spark, sf):
    lex = lexicon(spark, sf)
    return graph.pictograms(spark, lex.synsets, _pictures(spark, sf), lex.synset_relations)


@query("pictogram_rows", " SELECT y.id AS synset_id, p_partkey * 10 AS arasaac_id FROM synsets y JOIN part ON ili = 'i' || p_partkey WHERE p_size > 20")
def pictogram_rows(spark, sf):
    p = table(spark, sf, "part")
    ids = F.when(F.col("p_size") > 20, F.array(F.col("p_partkey") * 10, F.col("p_partkey"))).otherwise(F.array().cast("array<bigint>"))
    pics = p.select(F.concat(F.lit("i"), F.col("p_partkey").cast("string")).alias("ili"), F.lit(0).alias("position"), F.col("p_name").alias("lemma"), ids.alias("ids"))
    return post.pictogram_rows(pics, lexicon(spark, sf).synsets)


# ---- provenance, statistics ----


@query("resource_coverage", " SELECT resource AS code, count(*)::BIGINT AS sense_count, count(DISTINCT synset_id)::BIGINT AS synset_count, count(synset_id)::BIGINT AS live_senses FROM prov LEFT JOIN senses s ON s.id = item_id GROUP BY 1")
def resource_coverage(spark, sf):
    lex = lexicon(spark, sf)
    return post.coverage(lex.provenance, lex.senses)


@query("words_per_resource", " SELECT resource AS code, count(DISTINCT entry_id)::BIGINT AS words, count(DISTINCT s.id)::BIGINT AS senses, count(DISTINCT synset_id)::BIGINT AS synsets FROM prov JOIN senses s ON s.id = item_id GROUP BY 1")
def words_per_resource(spark, sf):
    return stats.words_per_resource(lexicon(spark, sf))


@query("top_resources", " SELECT resource AS code, count(*)::BIGINT AS sense_count FROM prov GROUP BY 1 ORDER BY sense_count DESC, code LIMIT 3")
def top_resources(spark, sf):
    lex = lexicon(spark, sf)
    c = post.coverage(lex.provenance, lex.senses).withColumn("language", F.lit(None).cast("string"))
    return stats.top_resources(lex.with_(resources=c), 3).select("code", "sense_count")


@query("resource_table", """, c AS (SELECT resource AS code, count(*)::BIGINT AS sense_count, count(DISTINCT synset_id)::BIGINT AS synset_count FROM prov LEFT JOIN senses s ON s.id = item_id GROUP BY 1)
SELECT code, label, synset_count, sense_count FROM (SELECT code, CASE WHEN code = '1-URGENT' THEN 'stated' END AS label, synset_count, sense_count FROM c
UNION ALL SELECT 'cili', 'Collaborative Interlingual Index (CILI)', (SELECT count(ili) FROM synsets), NULL)""")
def resource_table(spark, sf):
    lex = lexicon(spark, sf)
    roots = spark.createDataFrame([(0, {"id": "1-URGENT", "label": "stated"}), (1, {"id": "1-URGENT", "label": "later"}), (2, {"id": "cili", "label": "x"})], "ord int, root map<string,string>")
    return post.resource_table(spark, roots, lex).select("code", "label", "synset_count", "sense_count")


@query("provenance_lookup", " SELECT resource, version, original_id FROM prov WHERE table_name = 'senses' AND item_id = 7")
def provenance_lookup(spark, sf):
    return search.provenance_of(lexicon(spark, sf), "senses", 7)


@query("provenance_dedup", " SELECT item_id, resource, min(original_id) AS original_id, count(*)::BIGINT AS n FROM prov GROUP BY 1, 2")
def provenance_dedup(spark, sf):
    return lexicon(spark, sf).provenance.groupBy("item_id", "resource").agg(F.min("original_id").alias("original_id"), F.count("*").alias("n"))


@query("stats", """ SELECT 'synsets' AS metric, count(*)::BIGINT AS value FROM synsets UNION ALL SELECT 'entries', count(*) FROM entries UNION ALL SELECT 'senses', count(*) FROM senses
UNION ALL SELECT 'languages', count(DISTINCT language_id) FROM entries UNION ALL SELECT 'resources', 0""")
def totals(spark, sf):
    return stats.totals(lexicon(spark, sf))


@query("fingerprint_dist", " SELECT pos AS key, count(*)::BIGINT AS n FROM synsets GROUP BY 1 ORDER BY n DESC, key LIMIT 20")
def fingerprint_dist(spark, sf):
    return stats.distribution(lexicon(spark, sf).synsets, "pos", 20)


@query("fingerprint", """, x AS (SELECT 'synsets by pos' AS metric, pos AS key, count(*)::BIGINT AS value FROM synsets GROUP BY ALL UNION ALL SELECT 'entries by language', code, count(*) FROM entries e JOIN languages l ON e.language_id = l.id GROUP BY ALL
UNION ALL SELECT 'synset relations by type', 'hypernym', count(*) FROM acyclic UNION ALL SELECT 'provenance by table', 'senses', count(*) FROM prov
UNION ALL SELECT 'coverage', 'concepts with ili', count(ili) FROM synsets UNION ALL SELECT 'coverage', 'concepts with definition', count(DISTINCT synset_id) FROM definitions
UNION ALL SELECT 'coverage', 'annotated definitions', 0 UNION ALL SELECT 'coverage', 'annotated examples', 0) SELECT * FROM x""")
def fingerprint(spark, sf):
    return stats.fingerprint(lexicon(spark, sf)).filter("metric <> 'rows'")


@query("fingerprint_diff", """, a AS (SELECT pos AS key, count(*) AS n FROM synsets GROUP BY 1), b AS (SELECT pos AS key, count(*) AS n FROM synsets WHERE ili IS NOT NULL GROUP BY 1)
SELECT 'pos' AS metric, coalesce(a.key, b.key) AS key, a.n::BIGINT AS before, b.n::BIGINT AS after FROM a FULL JOIN b ON a.key = b.key WHERE a.n IS DISTINCT FROM b.n""")
def fingerprint_diff(spark, sf):
    y = lexicon(spark, sf).synsets
    of = lambda df: stats.distribution(df, "pos").select(F.lit("pos").alias("metric"), "key", F.col("n").alias("value"))
    return stats.compare(of(y), of(y.filter("ili IS NOT NULL")))


@query("pos_mismatch_hist", " SELECT l_returnflag AS a, l_linestatus AS b, count(*)::BIGINT AS n FROM lineitem WHERE l_returnflag IS DISTINCT FROM l_linestatus GROUP BY 1, 2", common=False)
def pos_mismatch_hist(spark, sf):
    return stats.mismatch_histogram(table(spark, sf, "lineitem").select(F.col("l_returnflag").alias("a"), F.col("l_linestatus").alias("b")), "a", "b")


@query("case_variants", f", x AS (SELECT language_id, pos, {LEMMA} AS folded, count(DISTINCT form) AS variants FROM entries f GROUP BY ALL) SELECT language_id, pos, folded, variants::BIGINT AS variants FROM x WHERE variants > 1")
def case_variants(spark, sf):
    return stats.case_variants(lexicon(spark, sf))


@query("example_table", " SELECT o_orderpriority AS wordnet, sum(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END)::BIGINT AS included, sum(CASE WHEN o_orderstatus = 'O' THEN 1 ELSE 0 END)::BIGINT AS excluded FROM orders GROUP BY 1", common=False)
def example_table(spark, sf):
    o = table(spark, sf, "orders").select(F.col("o_orderpriority").alias("wordnet"), (F.col("o_orderstatus") == "F").cast("long").alias("included"), (F.col("o_orderstatus") == "O").cast("long").alias("excluded"))
    return stats.example_table(o)


# ---- quality ----


@query("quality_entries_without_forms", " SELECT p_partkey AS id, count(l_partkey)::BIGINT AS lost_senses FROM part LEFT JOIN lineitem ON l_partkey = p_partkey WHERE p_partkey NOT IN (SELECT s_suppkey FROM supplier) GROUP BY 1", common=False)
def quality_entries_without_forms(spark, sf):
    e = table(spark, sf, "part").select(F.col("p_partkey").alias("id"))
    f = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("entry_id"))
    return quality.entries_without_forms(e, f, table(spark, sf, "lineitem").select(F.col("l_partkey").alias("entry_id")))


@query("quality_concepts_without_gloss", " SELECT y.id, count(s.id)::BIGINT AS lost_senses FROM synsets y LEFT JOIN senses s ON s.synset_id = y.id WHERE y.id NOT IN (SELECT synset_id FROM definitions) GROUP BY 1")
def quality_concepts_without_gloss(spark, sf):
    lex = lexicon(spark, sf)
    return quality.concepts_without_gloss(lex.synsets, lex.definitions, lex.senses)


# ---- merging ----


@query("ingest_merge", """
WITH p AS (SELECT p_partkey AS k, p_name, p_type, row_number() OVER (ORDER BY p_partkey) AS id, ['de', 'en', 'es', 'fr'][p_size % 4 + 1] AS lang FROM part),
f AS (SELECT id AS entry_id, p_name AS form, 0 AS n FROM p UNION ALL SELECT id, upper(p_name), 1 FROM p WHERE k % 3 = 0 AND upper(p_name) <> p_name),
s AS (SELECT e.id AS entry_id, y.id AS synset_id, min(o_orderkey) AS k FROM orders JOIN p e ON e.k = o_custkey JOIN p y ON y.k = o_orderkey % 1000 GROUP BY ALL),
g AS (SELECT y.id AS synset_id, lang_ AS language, arg_min(text, doc_id) AS text, min(doc_id) AS k FROM (SELECT *, lang AS lang_ FROM documents) JOIN p y ON y.k = doc_id % 500 GROUP BY ALL),
r AS (SELECT a.id AS source, b.id AS target FROM p a JOIN p b ON b.k = a.k // 3 WHERE a.k >= 1),
o AS (SELECT 'synsets' AS item, id::VARCHAR AS a, 'i' || k AS b, p_type AS c, NULL AS d FROM p
UNION ALL SELECT 'entries', id::VARCHAR, lang, p_type, NULL FROM p
UNION ALL SELECT 'forms', entry_id::VARCHAR, form, n::VARCHAR, NULL FROM f
UNION ALL SELECT 'senses', (row_number() OVER (ORDER BY k))::VARCHAR, entry_id::VARCHAR, synset_id::VARCHAR, NULL FROM s
UNION ALL SELECT 'definitions', (row_number() OVER (ORDER BY k))::VARCHAR, synset_id::VARCHAR, language, md5(text) FROM g
UNION ALL SELECT 'synset_relations', source::VARCHAR, 'hypernym', target::VARCHAR, NULL FROM r UNION ALL SELECT 'synset_relations', target::VARCHAR, 'hyponym', source::VARCHAR, NULL FROM r
UNION ALL SELECT 'provenance', t, n::VARCHAR, NULL, NULL FROM (SELECT 'synsets' AS t, count(*) AS n FROM p UNION ALL SELECT 'entries', count(*) FROM p UNION ALL SELECT 'senses', count(*) FROM s
  UNION ALL SELECT 'definitions', count(*) FROM g UNION ALL SELECT 'synset_relations', count(*) FROM r))
SELECT * FROM o""", common=False)
def ingest_merge(spark, sf):
    """All tables that a merge of the driver's tables as records gives, before its cleaning phases."""
    lex, _ = ingest.build(spark, adapter.elements(spark, sf), clean=False)
    code = lex.languages.select(F.col("id").alias("language_id"), "code")
    text = lambda item, df, *columns: df.select(F.lit(item).alias("item"), *[c.cast("string").alias(n) for c, n in zip(columns, "abcd")], *[F.lit(None).cast("string").alias(n) for n in "abcd"[len(columns) :]])
    c = F.col
    parts = [
        text("synsets", lex.synsets, c("id"), c("ili"), c("pos")),
        text("entries", lex.entries.join(code, "language_id"), c("id"), c("code"), c("pos")),
        text("forms", lex.forms, c("entry_id"), c("form"), c("rank")),
        text("senses", lex.senses, c("id"), c("entry_id"), c("synset_id")),
        text("definitions", lex.definitions.join(code, "language_id"), c("id"), c("synset_id"), c("code"), F.md5(c("definition").cast("binary"))),
        text("synset_relations", lex.synset_relations, c("source"), c("type"), c("target")),
        text("provenance", lex.provenance.filter("resource = 'driver'").groupBy("table_name").count(), c("table_name"), c("count")),
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


@query("quality_self_loops", " SELECT DISTINCT source, type FROM rels WHERE source = target")
def quality_self_loops(spark, sf):
    return quality.self_loops(adapter.relations(spark, sf))


@query("quality_contradictions", " SELECT DISTINCT a.type, least(a.source, a.target) AS low, greatest(a.source, a.target) AS high FROM rels a JOIN rels b ON a.type = b.type AND a.source = b.target AND a.target = b.source WHERE a.source <> a.target")
def quality_contradictions(spark, sf):
    return quality.contradictions(adapter.relations(spark, sf))


@query("quality_undeclared_entries", " SELECT l_orderkey AS id, l_partkey AS entry_id FROM lineitem WHERE l_partkey NOT IN (SELECT s_suppkey FROM supplier)", common=False)
def quality_undeclared_entries(spark, sf):
    s = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("id"), F.col("l_partkey").alias("entry_id"))
    return quality.undeclared_entries(s, table(spark, sf, "supplier").select(F.col("s_suppkey").alias("id")))


@query("quality_examples", " SELECT o_orderkey AS id, count(l_orderkey)::BIGINT AS annotations FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem JOIN part ON l_partkey = p_partkey WHERE p_type = 'PROMO') GROUP BY 1", common=False)
def quality_examples(spark, sf):
    a = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("example_id"), F.col("l_partkey").alias("sense_id"))
    senses = table(spark, sf, "part").filter("p_type = 'PROMO'").select(F.col("p_partkey").alias("id"))
    return quality.unanchored_examples(table(spark, sf, "orders").select(F.col("o_orderkey").alias("id")), a, senses)


@query("quality_nonstandard_types", " SELECT event_type AS type, count(*)::BIGINT AS n FROM events WHERE event_type <> 'click' GROUP BY 1", common=False)
def quality_nonstandard_types(spark, sf):
    return quality.nonstandard_types(table(spark, sf, "events").select(F.col("event_type").alias("type")), ("click",))


@query("quality_duplicate_ids", " SELECT l_orderkey AS id, count(*)::BIGINT AS n FROM lineitem GROUP BY 1 HAVING count(*) > 1", common=False)
def quality_duplicate_ids(spark, sf):
    return quality.duplicate_ids(table(spark, sf, "lineitem"), "l_orderkey")


@query("quality_glossed_without_senses", " SELECT c_custkey AS id FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F') AND c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'O')", common=False)
def quality_glossed_without_senses(spark, sf):
    o = table(spark, sf, "orders").select(F.col("o_custkey").alias("synset_id"), "o_orderstatus")
    return quality.glossed_without_senses(table(spark, sf, "customer").select(F.col("c_custkey").alias("id")), o.filter("o_orderstatus = 'F'"), o.filter("o_orderstatus = 'O'"))


@query("quality_hypernym_loops")
def quality_hypernym_loops(spark, sf):
    return quality.hypernym_loops(spark, adapter.relations(spark, sf)).select("component", F.size("cycle").alias("nodes"))


@query("keyref_violations", " SELECT l_suppkey AS value, count(*)::BIGINT AS n FROM lineitem WHERE l_suppkey NOT IN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 0) GROUP BY 1", common=False)
def keyref_violations(spark, sf):
    keys = table(spark, sf, "supplier").filter("s_acctbal > 0")
    return quality.keyref_violations(table(spark, sf, "lineitem"), "l_suppkey", keys, "s_suppkey")


@query("enum_violations", " SELECT pos AS value, count(*)::BIGINT AS n FROM synsets GROUP BY 1")
def enum_violations(spark, sf):
    return quality.enum_violations(lexicon(spark, sf).synsets, "pos")


@query("integrity")
def integrity(spark, sf):
    return quality.integrity(lexicon(spark, sf))


@query("quality_report")
def quality_report(spark, sf):
    return quality.report(quality.run_checks(spark, lexicon(spark, sf))).withColumn("items", F.array_join("items", " | "))


@query("concept_labels", """, x AS (SELECT s.synset_id AS id, g.code, f.form, s.id AS sense FROM senses s JOIN entries e ON s.entry_id = e.id JOIN languages g ON e.language_id = g.id JOIN forms f ON f.entry_id = e.id),
a AS (SELECT id, arg_min(form, sense) AS a FROM x WHERE code = 'de' GROUP BY 1), b AS (SELECT id, arg_min(form, sense) AS b FROM x WHERE code = 'en' GROUP BY 1)
SELECT y.id, CASE WHEN a IS NULL AND b IS NULL THEN y.id::VARCHAR ELSE y.id || ' [' || concat_ws('/', a, b) || ']' END AS label FROM synsets y LEFT JOIN a USING (id) LEFT JOIN b USING (id)""")
def concept_labels(spark, sf):
    lex = lexicon(spark, sf)
    return quality.labels(lex.synsets, lex.senses, lex.forms, lex.entries, lex.languages, "de")


# ---- conversion and text spans ----


def _pairs(spark, sf) -> DataFrame:
    """Candidates of an example: its own words, in capitals."""
    c = table(spark, sf, "conversations").select(((F.col("conv_id") * 100) + F.col("turn")).alias("example_id"), "text")
    words = F.filter(F.transform(F.split("text", " "), lambda w: F.translate(w, T.LOWER, T.UPPER)), lambda w: F.length(w) > 2)
    return c.groupBy("example_id").agg(F.min("text").alias("text")).select("example_id", "text", F.posexplode(words).alias("ord", "form")).withColumn("sense_id", F.col("ord").cast("long"))


@query("match_examples", """
WITH c AS (SELECT conv_id * 100 + turn AS example_id, min(text) AS text FROM conversations GROUP BY 1),
w AS (SELECT example_id, text, [translate(x, 'abcdefghijklmnopqrstuvwxyz', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ') for x in string_split(text, ' ') if length(x) > 2] AS ws FROM c),
p AS (SELECT example_id, text, unnest(ws) AS form, unnest(range(len(ws))) AS ord FROM w),
h AS (SELECT *, instr(lower(text), lower(form)) AS k FROM p WHERE instr(lower(text), lower(form)) > 0)
SELECT example_id, form, (k - 1)::INT AS start, (k - 1 + length(form))::INT AS "end" FROM h QUALIFY row_number() OVER (PARTITION BY example_id ORDER BY length(form) DESC, ord) = 1""", common=False)
def match_examples(spark, sf):
    return convert.substring_match(_pairs(spark, sf)).select("example_id", "form", F.col("start").cast("int").alias("start"), F.col("end").cast("int").alias("end"))


@query("expand_boundaries")
def expand_boundaries(spark, sf):
    return convert.match_examples(spark, _pairs(spark, sf)).select("example_id", "form", "start", "end", "strategy")


def _spans(spark, sf) -> DataFrame:
    li = table(spark, sf, "lineitem")
    start = (F.col("l_partkey") % 50).cast("int")
    return li.select(F.col("l_orderkey").alias("text_id"), start.alias("start"), (start + F.col("l_linenumber") + 1).cast("int").alias("end")).distinct()


@query("overlap_spans", """
WITH s AS (SELECT DISTINCT l_orderkey AS text_id, (l_partkey % 50)::INT AS "start", (l_partkey % 50 + l_linenumber + 1)::INT AS "end" FROM lineitem),
n AS (SELECT *, lead("start") OVER (PARTITION BY text_id ORDER BY "start", "end") AS next_start FROM s) SELECT * FROM n WHERE next_start < "end\"""", common=False)
def overlap_spans(spark, sf):
    return convert.overlaps(_spans(spark, sf), "text_id")


@query("merge_adjacent", """
WITH t AS (SELECT event_id // 10 AS text_id, (event_id % 10)::INT AS ord, (event_id % 10 * 5)::INT AS "start", (event_id % 10 * 5 + 4)::INT AS "end", CASE WHEN event_type <> 'view' THEN event_type END AS sense FROM events),
f AS (SELECT *, CASE WHEN sense IS DISTINCT FROM lag(sense) OVER w OR lag(ord) OVER w IS DISTINCT FROM ord - 1 THEN 1 ELSE 0 END AS new FROM t WINDOW w AS (PARTITION BY text_id ORDER BY ord)),
r AS (SELECT *, sum(new) OVER (PARTITION BY text_id ORDER BY ord) AS run FROM f)
SELECT text_id, sense, min("start") AS "start", max("end") AS "end", count(*)::BIGINT AS n FROM r WHERE sense IS NOT NULL GROUP BY text_id, run, sense""", common=False)
def merge_adjacent(spark, sf):
    e, k = table(spark, sf, "events"), (F.col("event_id") % 10).cast("int")
    t = e.select(F.floor(F.col("event_id") / 10).alias("text_id"), k.alias("ord"), (k * 5).alias("start"), (k * 5 + 4).alias("end"), F.when(F.col("event_type") != "view", F.col("event_type")).alias("sense"))
    return convert.merge_adjacent(t, "text_id")


@query("pending_translations", " SELECT doc_id AS id, lang AS language FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)", common=False)
def pending_translations(spark, sf):
    d = table(spark, sf, "documents").select(F.col("doc_id").alias("id"), F.col("lang").alias("language"), "text")
    done = table(spark, sf, "labels").select(F.col("doc_id").alias("id")).join(d.select("id", "language"), "id")
    return convert.pending_translations(d, done).select("id", "language")


@query("incremental_ingest", " SELECT o_custkey AS item, min(o_orderkey) AS first FROM orders GROUP BY 1", common=False)
def incremental_ingest(spark, sf):
    """First arrival per key through micro-batches of a file stream; the final state equals one batch over all."""
    from ..streaming import ingest as stream

    root = f"{shared_dir(spark).rstrip('/')}/stream-{uuid.uuid4().hex}"
    rows = table(spark, sf, "orders").select(F.col("o_custkey").alias("item"), F.col("o_orderkey").alias("first"))
    n = rows.agg(F.max("first")).first()[0] or 0
    for k in range(3):  # three deliveries, in the order of the key
        rows.filter((F.col("first") > n * k / 3 if k else F.lit(True)) & (F.col("first") <= n * (k + 1) / 3)).coalesce(1).write.mode("append").parquet(f"{root}/in")
    stream.run_to_end(stream.first_wins(stream.stream_of(spark, f"{root}/in", rows.schema), ["item"], ["first"], f"{root}/state", f"{root}/log"))
    return stream.state_of(spark, f"{root}/state", rows.schema)


@query("sense_relation_symmetry", " SELECT DISTINCT s AS source, t AS target FROM (SELECT source AS s, target AS t FROM rels WHERE type = 'hypernym' UNION ALL SELECT target, source FROM rels WHERE type = 'hypernym')")
def sense_relation_symmetry(spark, sf):
    r = adapter.relations(spark, sf).filter("type = 'hypernym'").withColumn("type", F.lit("antonym"))
    return rel.resolve(r, SENSE_INVERSES)[0].select("source", "target")


@query("language_names", " SELECT id, code, CASE code WHEN 'de' THEN 'German' WHEN 'en' THEN 'English' WHEN 'es' THEN 'Spanish' WHEN 'fr' THEN 'French' END AS name FROM languages")
def language_names(spark, sf):
    from ..functions.languages import with_names

    return with_names(adapter.languages(spark))


@query("examples_spans", """ WITH c AS (SELECT conv_id * 100 + turn AS id, turn, min(text) AS t FROM conversations GROUP BY 1, 2)
SELECT id AS example_id, t AS example, (instr(t, string_split(t, ' ')[2]) - 1)::INT AS "start", (instr(t, string_split(t, ' ')[2]) - 1 + length(string_split(t, ' ')[2]))::INT AS "end" FROM c WHERE turn = 1 AND length(string_split(t, ' ')[2]) > 0""", common=False)
def examples_spans(spark, sf):
    """Examples of one sense with their spans, by the composite key of example and sense."""
    c = table(spark, sf, "conversations").groupBy((F.col("conv_id") * 100 + F.col("turn")).alias("id"), "turn").agg(F.min("text").alias("example"))
    word = F.get(F.split("example", " "), F.lit(1))
    start = F.expr("instr(example, get(split(example, ' '), 1)) - 1").cast("int")
    spans = c.filter(F.length(word) > 0).select(F.col("id").alias("example_id"), start.alias("start"), (start + F.length(word)).cast("int").alias("end"), F.col("turn").alias("sense_id"))
    lex = lexicon(spark, sf).with_(examples=c.select("id", "example"), example_annotations=spans, sense_examples=spans.select("sense_id", "example_id"))
    return search.examples_of(lex, 1)


@query("display_labels", " SELECT DISTINCT type, CASE type WHEN 'hypernym' THEN 'above' WHEN 'mero_part' THEN 'part of' ELSE type END AS label FROM rels")
def display_labels(spark, sf):
    config = spark.createDataFrame([("hypernym", "hyp", {"en": "above", "ja": "上位"}), ("partonym", "mero_part", {"en": "part of"})], "name string, short string, labels map<string,string>")
    return rel.display_labels(adapter.relations(spark, sf).select("type").distinct(), config, "de")


@query("comparison_table", """ SELECT metric, value AS ours, CASE metric WHEN 'senses' THEN 5::BIGINT END AS theirs FROM (SELECT 'synsets' AS metric, count(*)::BIGINT AS value FROM synsets UNION ALL SELECT 'entries', count(*) FROM entries UNION ALL SELECT 'senses', count(*) FROM senses
UNION ALL SELECT 'languages', count(DISTINCT language_id) FROM entries UNION ALL SELECT 'resources', 0)""")
def comparison_table(spark, sf):
    return stats.comparison_table(lexicon(spark, sf), {"senses": 5})


@query("quality_metric_issues", " SELECT 'category_mismatch' AS code, 'WARNING' AS severity, o_orderpriority || ' ' || o_orderstatus || ' ' || count(*)::VARCHAR AS item FROM orders GROUP BY o_orderpriority, o_orderstatus", common=False)
def quality_metric_issues(spark, sf):
    log = table(spark, sf, "orders").groupBy(F.col("o_orderpriority").alias("resource"), F.col("o_orderstatus").alias("key")).agg(F.count("*").alias("n"))
    return quality.metric_issues(log.withColumn("metric", F.lit("category_mismatch")))


@query("conflict_issues", f", {WIN} SELECT 'reversed relation' AS code, 'CRITICAL' AS severity, source || ' ' || r.type || ' ' || target || ' against ' || (SELECT arg_min(resource, seq) FROM rels x WHERE x.type = r.type AND least(x.source, x.target) = l AND greatest(x.source, x.target) = h) AS item FROM rels r JOIN w ON r.type = w.type AND least(source, target) = l AND greatest(source, target) = h WHERE ((source <= target) <> up OR (l = h AND seq > first)) AND resource = 'F'")
def conflict_issues(spark, sf):
    conflicts = rel.resolve(adapter.relations(spark, sf), CONCEPT_INVERSES)[1]
    return quality.conflict_issues(conflicts, spark.createDataFrame([], "chain array<long>"), "F")


@query("index_concepts", " SELECT 'cili.i' || p_partkey AS concept_id, 'NOUN' AS pos, p_name AS gloss, lpad(p_partkey::VARCHAR, 8, '0') || '-n' AS original_id FROM part WHERE p_size > 10", common=False)
def index_concepts(spark, sf):
    """Concepts of the interlingual index from a definitions table joined with a map of source ids."""
    from ..sources.files import index_concepts as concepts
    from ..sources.files import index_table

    p = table(spark, sf, "part")
    ili = F.concat(F.lit("i"), F.col("p_partkey").cast("string")).alias("ili_id")
    mapping = p.filter("p_size > 10").select(ili, T.offset_id(F.col("p_partkey"), F.lit("n")).alias("origin_id"))
    return concepts(index_table(p.select(ili, F.col("p_name").alias("definition")), mapping)).select("concept_id", "pos", "gloss", "original_id")
