from pyspark.sql import functions as F

from lexweave.operators import convert, post
from lexweave.sources import xml

LMF = """<LexicalResource><Lexicon id="tiny" language="en" version="1" label="Tiny">
 <LexicalEntry id="e1"><Lemma writtenForm="dog" partOfSpeech="n"/><Form writtenForm="dogs"/><Sense id="s1" synset="y1"><SenseRelation relType="derivation" target="s3"/><Example>Two dogs met.</Example></Sense></LexicalEntry>
 <LexicalEntry id="e2"><Lemma writtenForm="dogs" partOfSpeech="n"/><Form writtenForm="dog"/><Sense id="s2" synset="y1"/></LexicalEntry>
 <LexicalEntry id="e3"><Lemma writtenForm="doggy" partOfSpeech="s"/><Sense id="s3" synset="y2"/><Sense id="s4" synset="gone"/></LexicalEntry>
 <Synset id="y0" ili="i1" partOfSpeech="n"><Definition>a being</Definition></Synset>
 <Synset id="y1" ili="i7" partOfSpeech="n"><Definition>barks</Definition><Definition>second</Definition><SynsetRelation relType="hypernym" target="y0"/></Synset>
 <Synset id="y2" ili="in" partOfSpeech="a"><Definition>like a dog</Definition><SynsetRelation relType="hyponym" target="y1"/></Synset>
 <Synset id="y3" partOfSpeech="v"><SynsetRelation relType="agent" target="y0"/></Synset>
</Lexicon></LexicalResource>"""


def test_passes(spark, tmp_path):
    (tmp_path / "tiny.xml").write_text(LMF)
    elements = xml.read(spark, [str(tmp_path / "tiny.xml")], convert.LMF_TAGS).cache()
    index = spark.createDataFrame([("i1", "NOUN"), ("i7", "VERB")], "ili string, pos string")
    concepts, glosses, differ = convert.concepts(elements, index)
    assert {(r["synset"], r["concept_id"]) for r in concepts.collect()} == {("y0", "cili.i1"), ("y1", "cili.i7"), ("y2", "tiny.i1"), ("y3", "tiny.i2")}
    assert {(r["concept_id"], r["text"]) for r in glosses.collect()} == {("cili.i1", "a being"), ("cili.i7", "barks"), ("tiny.i1", "like a dog")}
    assert {r["concept_id"] for r in convert.concepts(elements, index, False)[1].collect()} == {"tiny.i1"}
    assert [tuple(r) for r in differ.collect()] == [("NOUN", "VERB", 1)]
    lexemes, of = convert.lexemes(elements)
    assert {(r["lexeme_id"], tuple(r["forms"]), r["n_sources"]) for r in lexemes.collect()} == {("en.NOUN.dog-dogs", ("dog", "dogs"), 2), ("en.ADJ.doggy", ("doggy",), 1)}
    senses, unresolved = convert.senses(elements, of, concepts)
    assert convert.kept_senses(senses).count() == 2 and [tuple(r) for r in unresolved.collect()] == [("s4", "gone")]
    relations, mismatches = convert.concept_relations(elements, concepts)
    assert {tuple(r) for r in relations.collect()} == {("cili.i7", "cili.i1", "hypernym"), ("cili.i7", "tiny.i1", "hypernym")}
    assert [tuple(r) for r in mismatches.collect()] == [("hypernym", 1, 1)]
    between = convert.sense_relations(elements, senses).collect()
    assert {(r["type"], frozenset((r["source"], r["target"]))) for r in between} == {("derivation", frozenset(("en.NOUN.dog-dogs.cili.i7", "en.ADJ.doggy.tiny.i1")))}


def test_example_matching(spark):
    rows = [
        (1, "The dogs barked.", 10, "dog", 0), (1, "The dogs barked.", 11, "dogs", 1), (2, "She gave it up, finally", 12, "gave up", 0), (3, "nothing here", 13, "cat", 0),
        (4, "He sprang a leak", 14, "spring", 0),
    ]
    pairs = spark.createDataFrame(rows, "example_id long, text string, sense_id long, form string, ord int")
    got = {r["example_id"]: (r["sense_id"], r["start"], r["end"], r["strategy"]) for r in convert.match_examples(spark, pairs).collect()}
    assert got == {1: (11, 4, 8, "substring"), 2: (12, 4, 14, "words")}
    found = convert.match_examples(spark, pairs, analyse=lambda text, form: (3, 9) if form == "spring" else None)
    assert {r["example_id"]: r["strategy"] for r in found.collect()} == {1: "substring", 2: "words", 4: "analyser"}
    log = convert.example_log(pairs, found).first()
    assert (log["included"], log["excluded"], log["success_rate"]) == (3, 1, 75.0)
    grown = spark.createDataFrame([("the hotdogs!", 7, 10)], "t string, a int, b int")
    a, b = convert.grow(F.col("t"), F.col("a"), F.col("b"))
    assert tuple(grown.select(a, b).first()) == (4, 11)


def test_spans(spark):
    spans = spark.createDataFrame([(1, 0, 5, "a"), (1, 3, 8, "b"), (1, 8, 9, "c"), (1, 20, 30, "a")], "gloss_id long, start int, end int, sense string")
    glosses = spark.createDataFrame([(1, "x" * 25)], "gloss_id long, text string")
    senses = spark.createDataFrame([("a",), ("b",), ("c",)], "key string")
    assert {r["start"] for r in convert.transfer_annotations(glosses, spans, senses).collect()} == {0, 8}


def test_translation_resumes(spark):
    glosses = spark.createDataFrame([(1, "fr", "un"), (2, "fr", "deux"), (3, "de", "drei")], "id long, language string, text string")
    done = spark.createDataFrame([(2, "fr")], "id long, language string")
    got = convert.translate_pending(glosses, done, lambda language, texts: [f"{language}:{t}" for t in texts])
    assert {(r["id"], r["translated"]) for r in got.collect()} == {(1, "fr:un"), (3, "de:drei")}


def test_pictogram_tables(spark):
    raw = spark.createDataFrame([(7, ["o1"], ["cat", "kitty"]), (5, ["o1", "o2"], ["cat"])], "id long, synsets array<string>, keywords array<string>")
    mapping = spark.createDataFrame([("o1", "i1"), ("o2", "i2")], "offset string, ili string")
    built = {(r["ili"], r["lemma"]): r["ids"] for r in post.pictogram_build(raw, mapping).collect()}
    assert built == {("i1", "cat"): [5, 7], ("i1", "kitty"): [7], ("i2", "cat"): [5]}
    pics = spark.createDataFrame([("i1", 0, "x", []), ("i1", 1, "y", [101, 102]), ("i9", 0, "z", [5])], "ili string, position int, lemma string, ids array<long>")
    synsets = spark.createDataFrame([(1, "i1", "NOUN"), (2, None, "NOUN")], "id long, ili string, pos string")
    assert [tuple(r) for r in post.pictogram_rows(pics, synsets).collect()] == [(1, 101)]


def test_source_to_lexicon(spark, tmp_path):
    from lexweave.operators import ingest, search

    (tmp_path / "tiny.xml").write_text(LMF)
    (tmp_path / "broken.xml").write_text("<LexicalResource><Lexicon")
    index = spark.createDataFrame([("i1", "NOUN"), ("i7", "NOUN")], "ili string, pos string")
    records, log = convert.as_elements(spark, xml.read(spark, [str(tmp_path / "tiny.xml")], convert.LMF_TAGS), index)
    cili = tmp_path / "cili.xml"
    cili.write_text('<R id="cili"><Concept id="cili.i1" ontological_category="NOUN"/><Concept id="cili.i7" ontological_category="NOUN"/></R>')
    base = xml.read(spark, [str(cili)])
    lex, logs = ingest.build(spark, base.unionByName(records.withColumn("resource_ord", F.col("resource_ord") + 1)))
    assert {(r["form"], r["definition"]) for r in search.search(lex, "dog").collect()} == {("dog", "barks")}
    assert {(r["type"]) for r in lex.synset_relations.collect()} == {"hypernym", "hyponym"} and lex.sense_relations.count() == 2
    assert [(r["example"]) for r in lex.examples.collect()] == ["Two dogs met."] and [(r["start"], r["end"]) for r in lex.example_annotations.collect()] == [(4, 8)]
    metrics = {r["metric"]: r["n"] for r in log.collect()}
    assert metrics["unresolved_synset"] == 1 and metrics["missing_ili"] == 2 and metrics["included_example"] == 1
    out = str(tmp_path / "out")
    paths = [str(tmp_path / "broken.xml"), str(tmp_path / "tiny.xml")]
    assert {r["path"].rpartition("/")[2]: r["status"] for r in convert.convert_files(spark, paths, index, out).collect()} == {"broken.xml": "failed", "tiny.xml": "converted"}
    assert {r["status"] for r in convert.convert_files(spark, paths[1:], index, out).collect()} == {"skipped"}
