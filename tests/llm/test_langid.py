import numpy as np

from lexweave.llm import langid

WORDS = {"aa": "the and of with this from that have", "bb": "der die und nicht mit einen auf wird", "cc": "que los para una con por las del"}


def corpus():
    import random

    rng = random.Random(1)
    rows = []
    for i in range(240):
        lang = sorted(WORDS)[i % 3]
        rows.append((i, " ".join(rng.choices(WORDS[lang].split(), k=rng.randrange(3, 60))), lang))
    return rows + [(1000, None, "aa"), (1001, "", "bb"), (1002, "12 34 !!", "cc"), (1003, "the and of with", None), (1004, "der und nicht " * 20000, None)]


def test_identify(spark):
    docs = spark.createDataFrame([(*r, "z") for r in corpus()], "doc_id long, text string, lang string, score string").repartition(4)
    model = langid.fit(docs)
    out = langid.identify(spark, docs, model)
    assert out.columns == ["doc_id", "text", "lang", "score", "lang_pred", "_score", "langs"]
    got = {r["doc_id"]: r for r in out.collect()}
    assert all(got[i]["lang_pred"] == lang for i, _, lang in corpus()[:240])
    assert [got[i]["lang_pred"] for i in (1000, 1001, 1002, 1003, 1004)] == ["und", "und", "und", "aa", "bb"]
    assert got[1000]["_score"] == 0 and all(0 <= r["_score"] <= 1 for r in got.values())


def test_mixture_and_single(spark):
    docs = spark.createDataFrame(corpus()[:240], "doc_id long, text string, lang string")
    langs, logp, prior = langid.fit(docs)
    both, score = langid.infer(*langid.trigrams(f"{WORDS['aa']} {WORDS['bb']} " * 6), logp, prior)
    assert {langs[k] for k in both} == {"aa", "bb"} and abs(sum(both.values()) - 1) < 1e-6 and 0.3 < score < 0.7
    one, score = langid.infer(*langid.trigrams("que los para una con por"), logp, prior)
    assert [langs[k] for k in one] == ["cc"] and score > 0.9


def test_em_finds_the_likelier_proportions():
    rng = np.random.default_rng(0)
    p = rng.dirichlet(np.ones(40), 2).T
    truth = np.array([0.3, 0.7])
    counts = rng.multinomial(20000, p @ truth).astype(float)
    share, like = langid._em(p, counts, counts.sum())
    assert abs(share[0] - 0.3) < 0.05 and like >= counts @ np.log(p @ np.array([0.5, 0.5]))


def test_nothing_to_learn_from(spark):
    docs = spark.createDataFrame([(1, "abc", None)], "doc_id long, text string, lang string")
    assert langid.identify(spark, docs, langid.fit(docs)).first()["lang_pred"] == "und"
    none = docs.filter("false")
    assert langid.identify(spark, none, langid.fit(none)).count() == 0


def test_held_out_rows_do_not_matter(spark):
    from lexweave.llm.common import held_out

    docs = spark.createDataFrame(corpus()[:240], "doc_id long, text string, lang string")
    a = langid.fit(docs)
    b = langid.fit(docs.withColumn("lang", __import__("pyspark").sql.functions.when(held_out(), "wrong").otherwise(docs["lang"])))
    assert a[0] == b[0] and np.allclose(a[1], b[1])
