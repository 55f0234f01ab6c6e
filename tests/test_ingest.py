import gzip
import lzma
import os
from xml.etree import ElementTree

import pytest

from lexweave.model import Lexicon
from lexweave.operators import ingest, post, quality, search, stats
from lexweave.sources import export, files, xml

DATA = os.path.join(os.path.dirname(__file__), "data")
PATHS = [f"{DATA}/{n}.xml" for n in ("base-en", "extra-fr")]


@pytest.fixture(scope="module")
def merged(spark):
    return ingest.build(spark, xml.read(spark, PATHS))


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_mixed_content():
    e = ElementTree.fromstring('<AnnotatedSentence>The <tok sense="s1">dög</tok> saw <i>a</i> <tok sense="s2">cat</tok>.</AnnotatedSentence>')
    assert xml.mixed_content(e) == ("The dög saw a cat.", [(4, 7, "s1"), (14, 17, "s2")])
    assert xml.mixed_content(ElementTree.fromstring("<AnnotatedSentence/>")) == ("", [])


def test_compressed_files_and_data_source(spark, tmp_path):
    data = open(PATHS[0], "rb").read()
    (tmp_path / "a.xml.gz").write_bytes(gzip.compress(data))
    (tmp_path / "b.xml.xz").write_bytes(lzma.compress(data))
    plain = xml.read(spark, [PATHS[0]]).drop("resource_ord").collect()
    both = xml.read(spark, [str(tmp_path / "b.xml.xz"), str(tmp_path / "a.xml.gz")])
    assert both.filter("resource_ord = 0").count() == len(plain) and both.filter("resource_ord = 1").drop("resource_ord").collect() == plain
    spark.dataSource.register(xml.LexicalXml)
    again = spark.read.format("lexxml").option("paths", PATHS[0]).load()
    assert sorted(map(str, again.drop("resource_ord").collect())) == sorted(map(str, plain))


def test_merge_counts(spark, merged):
    lex, logs = merged
    counts = {r["table_name"]: r["n"] for r in post.row_counts(lex).collect()}
    # i9 has no gloss and goes with its sense and entry; the capitalised variant merges into the first sense.
    assert counts["synsets"] == 5 and counts["senses"] == 6 and counts["entries"] == 6 and counts["definitions"] == 6
    assert counts["synset_relations"] == 5 and counts["sense_relations"] == 2 and counts["languages"] == 2 and counts["resources"] == 4
    assert rows(search.search(lex, "cat").select("form", "language", "ili")) == [("Cat", "en", "i3"), ("cat", "en", "i3")]
    assert search.search(lex, "cat").select("sense_id").distinct().count() == 1
    assert rows(search.search(lex, "chataigne", definition_language="fr").select("form", "definition")) == [("Châtaigne", "bête de maison")]
    assert {r["form"] for r in search.search(lex, "cat*").collect()} == {"cat", "cats", "Cat"}
    assert rows(search.search(lex, "i3").select("language")) == [("en",), ("fr",)]
    assert rows(search.search(lex, "def:CREATURE").select("form")) == [("Châtaigne",), ("animal",), ("cat",)]
    assert rows(search.search(lex, "def:creature", ["en"]).select("form")) == [("animal",), ("cat",)]
    forms = {(r["form"], r["rank"]) for r in lex.forms.collect() if r["form"].lower().startswith(("cat", "kit"))}
    assert forms == {("cat", 0), ("cats", 1), ("kitty", 2), ("Cat", 0)}
    assert rows(lex.pronunciations.select("variety", "pron")) == [("GB", "kæt")]
    assert all(r["sense_index"] == 1 for r in lex.senses.collect())
    assert rows(logs["reversed"].select("kind", "type", "resource", "prior_resource")) == [("synset", "hypernym", "extra-fr", "base-en")]
    assert rows(lex.example_annotations.select("start", "end")) == [(4, 7), (16, 21)] and rows(lex.examples.select("example")) == [("The cat saw a & thing.",)]
    assert sum(r["n"] for r in quality.integrity(lex).collect()) == 0


def test_resources(merged):
    lex, _ = merged
    got = {r["code"]: r for r in lex.resources.collect()}
    assert set(got) == {"base-en", "extra-fr", "pwn", "cili"} and got["cili"]["synset_count"] == 4
    assert got["base-en"]["extra"] == '{"note":"kept as extra"}' and got["base-en"]["confidence_score"] == 0.9 and got["pwn"]["label"] == "Princeton WordNet"
    assert (got["extra-fr"]["sense_count"], got["extra-fr"]["synset_count"]) == (1, 1)


def test_cycle_across_resources(spark):
    lex, logs = ingest.build(spark, xml.read(spark, [PATHS[0], f"{DATA}/cycle-xx.xml"]), clean=False)
    assert [r["chain"] for r in logs["cycles"].collect()] == [[3, 2, 1]]
    assert lex.synset_relations.count() == 5


def test_duplicate_concept(spark, tmp_path):
    (tmp_path / "x.xml").write_text('<R id="x"><Concept id="c" ontological_category="NOUN"/></R>')
    (tmp_path / "y.xml").write_text('<R id="y"><Concept id="c" ontological_category="NOUN"/></R>')
    with pytest.raises(ValueError, match="Duplicate concept id: c"):
        ingest.build(spark, xml.read(spark, [str(tmp_path / "x.xml"), str(tmp_path / "y.xml")]))


def test_save_load_and_export_round_trip(spark, merged, tmp_path):
    lex, _ = merged
    lex.save(str(tmp_path / "db"))
    back = Lexicon.load(spark, str(tmp_path / "db"))
    assert stats.compare(stats.fingerprint(lex, (("cat", "en"),)), stats.fingerprint(back, (("cat", "en"),))).count() == 0
    export.write_xml(back, str(tmp_path / "xml"), {"id": "all", "language": "en", "version": "1"})
    text = "".join(open(p).read() for p in sorted(map(str, (tmp_path / "xml").glob("part-*"))))
    (tmp_path / "all.xml").write_text(text)
    again, _ = ingest.build(spark, xml.read(spark, [str(tmp_path / "all.xml")]), clean=False)
    for name in ("synsets", "entries", "forms", "senses", "definitions", "examples", "example_annotations", "sense_relations"):
        assert again.tables[name].count() == back.tables[name].count(), name
    # A relation without inverse comes back as it was; generated inverses are made again.
    assert rows(again.synset_relations.groupBy("type").count()) == rows(back.synset_relations.groupBy("type").count())
    assert rows(again.examples.select("example")) == rows(back.examples.select("example"))
    assert export.annotated("a < b", [(4, 5, "s")]) == '<AnnotatedSentence>a &lt; <AnnotatedToken sense="s">b</AnnotatedToken></AnnotatedSentence>'


def test_hostile_terms_are_values(spark, merged):
    lex, _ = merged
    for term in ("' OR 1=1 --", '"; DROP TABLE forms', "x' UNION SELECT 1 --", "def:%' OR '1'='1", "a" * 10000, "def:%"):
        assert search.search(lex, term).count() == 0


def test_quality_report(spark, merged):
    lex, _ = merged
    report = quality.report(quality.run_checks(spark, lex)).collect()
    text = quality.format_report("all", report)
    assert isinstance(text, str) and text.startswith("all")
    found = {r["code"]: r["total"] for r in report}
    assert found.get("hypernym loop") is None and found.get("concept without gloss") is None
    before, _ = ingest.build(spark, xml.read(spark, [PATHS[0]]), clean=False)
    found = {r["code"]: r["total"] for r in quality.report(quality.run_checks(spark, before)).collect()}
    assert found["concept without gloss"] == 1


def test_discovery_and_order(tmp_path):
    for n in ("b-1.xml", "oewn-2024.xml.gz", "cili-1.0.xml", "a-1.xml.xz"):
        (tmp_path / n).write_text("")
    names = [os.path.basename(p) for p in files.discover(str(tmp_path))]
    assert names == ["oewn-2024.xml.gz", "a-1.xml.xz", "b-1.xml", "cili-1.0.xml"]
    assert [os.path.basename(p) for p in files.merge_order(names)] == ["cili-1.0.xml", "oewn-2024.xml.gz", "a-1.xml.xz", "b-1.xml"]


def test_gloss_alignment():
    tokens = [[("the", None), ("big", "s1"), ("dog", "s1")], [("it", None), ("runs", "s2")]]
    assert files.align_sentences("it runs; the big dog", tokens) == [(3, 7, "s2"), (13, 20, "s1")]
    assert files.align_sentences("something else", tokens) is None


def test_gloss_errors():
    assert files.gloss_errors("a dog", [(2, 5, "s")], {"s"}) == []
    assert len(files.gloss_errors("a dog", [(2, 5, None), (1, 3, "x"), (4, 4, "s")], {"s"})) == 4


def test_index_files(spark, tmp_path):
    (tmp_path / "d.tsv").write_text("ili_id\tdefinition\ni1\ta  thing\ni2\t\ni3\tunmapped\n")
    (tmp_path / "m.tsv").write_text("ili_id\torigin_id\ni1\t00001740-n\ni2\t00001930-v\n")
    index = files.index_table(files.read_tsv(spark, str(tmp_path / "d.tsv"), "ili_id string, definition string"), files.read_tsv(spark, str(tmp_path / "m.tsv"), "ili_id string, origin_id string"))
    assert [r["ili_id"] for r in files.empty_definitions(index).collect()] == ["i2"]
    one = files.index_concepts(index.filter("ili_id = 'i1'")).first()
    assert (one["concept_id"], one["pos"], one["gloss"], one["version"], one["original_id"]) == ("cili.i1", "NOUN", "a thing", "3.0", "00001740-n")
    with pytest.raises(Exception, match="empty definition"):
        files.index_concepts(index).collect()


def test_configuration_and_maps(spark, tmp_path):
    (tmp_path / "w.toml").write_text('en = ["https://x/a.xml"]\nfr = "https://x/b.xml"\n')
    assert files.sources_config(str(tmp_path / "w.toml")) == {"en": ["https://x/a.xml"], "fr": ["https://x/b.xml"]}
    (tmp_path / "p.json").write_text('{"i100": {"b": [], "a": [101, 102]}, "i200": {"c": [201]}}')
    pics = files.pictogram_map(spark, str(tmp_path / "p.json"))
    assert {(r["ili"], r["arasaac_id"]) for r in post.first_pictograms(pics).collect()} == {("i100", 101), ("i200", 201)}


def test_searches_push_down_and_stay_in_the_jvm(spark, merged, tmp_path):
    lex, _ = merged
    lex.save(str(tmp_path / "db"))
    back = Lexicon.load(spark, str(tmp_path / "db"))
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    exact = plan(search.search(back, "cat"))
    assert "EqualTo(norm,cat)" in exact and "Python" not in exact and "CartesianProduct" not in exact
    assert "StringStartsWith(norm,ca)" in plan(search.search(back, "ca*"))
    assert "EqualTo(ili,i3)" in plan(search.search(back, "i3"))
    looked = plan(search.provenance_of(back, "senses", 3))
    assert "PartitionFilters" in looked and "table_name" in looked.split("PartitionFilters")[1][:120]


def test_registered_tables_join_without_a_shuffle(spark, merged):
    lex, _ = merged
    database = "lexweave_test"
    spark.sql(f"DROP DATABASE IF EXISTS {database} CASCADE")
    lex.register(database, 4)
    back = Lexicon.registered(spark, database)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        e = back.entries.withColumnRenamed("id", "entry_id").select("entry_id", "language_id")
        joined = back.forms.join(e, "entry_id").join(back.senses.select("entry_id", "synset_id"), "entry_id")
        assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert rows(search.search(back, "cat*").select("form")) == rows(search.search(lex, "cat*").select("form"))
    spark.sql(f"DROP DATABASE {database} CASCADE")


def test_latex_and_display(spark):
    rows = [{"code": "a_b", "n": 1234567, "x": None}]
    assert export.latex_table(rows, ["code", "n", "x"]) == "\\begin{tabular}{lrr}\ncode & n & x \\\\ \\hline\na\\_b & 1{,}234{,}567 & --- \\\\\n\\end{tabular}\n"


def test_many_sentences_in_another_order_align():
    words = [f"w{k}x" for k in range(12)]
    assert files.align_sentences("; ".join(words), [[(w, f"s{w}")] for w in reversed(words)]) == [(m, m + len(w), f"s{w}") for w in words for m in ["; ".join(words).find(w)]]
    assert files.align_sentences("; ".join(words), [[(w, None)] for w in [*words[:-1], "other"]]) is None
