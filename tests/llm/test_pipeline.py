"""run() and each stage against plain models on a small corpus."""

import random

import pytest

import corpus_pipeline
from lexweave.llm import linedup

from .test_fmindex import plain as plain_hits
from .test_linedup import plain as plain_lines
from .test_simhash import brute_components, plain_fingerprint


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rng = random.Random(8)
    at = str(tmp_path_factory.mktemp("corpus"))
    vocabulary = ["".join(rng.choices("etaoinshrdlu", k=rng.randrange(2, 8))) for _ in range(300)]
    text = lambda n: "\n".join(" ".join(rng.choices(vocabulary, k=rng.randrange(4, 12))).capitalize() + "." for _ in range(n))
    items = [(k, " ".join(rng.choices(vocabulary, k=14))) for k in range(5)]
    docs, labels = [], []
    for i in range(240):
        t = text(rng.randrange(1, 12))
        good = i % 6 != 5
        if not good:
            t = " ".join(w.upper() + "!!" for w in t.split())
        if i % 20 == 7:
            t += "\nA shared line that many documents repeat."
        if i % 20 == 9:
            t += "\n" + items[i % 5][1]
        docs.append((i, t))
        labels.append((i, int(good), 0))
    near = docs[50][1].split(" ")
    near[3] = "swapped"
    docs += [(300, docs[10][1]), (301, docs[10][1]), (302, " ".join(near)), (303, ""), (304, None)]
    rows = [(i, t, "en", ["s1", "s2", None][i % 3], len(t or "")) for i, t in docs]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3).write.parquet(f"{at}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{at}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{at}/benchmark.parquet")
    return at, items


def test_stages_against_plain_models(spark, folder):
    at, items = folder
    docs = spark.read.parquet(f"{at}/documents.parquet").cache()
    columns = docs.columns
    stages = dict(corpus_pipeline.STAGES)
    assert len(stages) == 5
    kept = stages["quality classifier"](spark, docs, at).cache()
    ids = {r["doc_id"] for r in kept.collect()}
    assert kept.columns == columns and all((i in ids) == (i % 6 != 5) for i in range(240))

    lined = stages["line dedup"](spark, kept, at).cache()
    want = plain_lines([(r["doc_id"], r["text"]) for r in kept.collect()])
    emptied = {d for (d, t), left in want.items() if not left.strip() and t.strip()}
    got = {r["doc_id"]: r["text"] for r in lined.collect()}
    assert lined.columns == columns and set(got) == ids - emptied and {300, 301} <= emptied
    assert all(got[d] == left for (d, t), left in want.items() if d in got)
    assert all(r["n_chars"] == len(r["text"]) for r in lined.collect() if r["text"] is not None)

    single = stages["simhash near-dedup"](spark, lined, at).cache()
    groups = brute_components({d: plain_fingerprint(t) for d, t in got.items()})
    assert single.columns == columns and {r["doc_id"] for r in single.collect()} == set(groups.values())

    clean = stages["benchmark decontamination"](spark, single, at).cache()
    before = {r["doc_id"]: r["text"] for r in single.collect()}
    after = {r["doc_id"]: r["text"] for r in clean.collect()}
    hits = plain_hits(list(before.items()), items)
    assert clean.columns == columns and any(h[4] for h in hits.values())
    assert not any(h[4] for h in plain_hits(list(after.items()), items).values())
    assert all(after[d] == t for d, t in before.items() if not hits[d][4])

    mixed = stages["mixing sources"](spark, clean, at)
    rows = mixed.collect()
    assert {r["doc_id"] for r in rows} <= set(after) and max(r["copy_no"] for r in rows) <= 3
    assert sorted((r["doc_id"], r["copy_no"]) for r in rows) == sorted((r["doc_id"], r["copy_no"]) for r in corpus_pipeline.run(spark, at).collect())


def test_empty_tables(spark, folder):
    at, _ = folder
    docs = spark.read.parquet(f"{at}/documents.parquet").filter("false")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, at).count() == 0


def test_min_lines_is_what_the_model_assumes():
    assert linedup.MIN_LINES == 2
