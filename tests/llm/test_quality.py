import random
import zlib

import numpy as np

from lexweave.llm import quality


def corpus():
    rng = random.Random(5)
    docs, labels = [], []
    for i in range(400):
        words = ["".join(rng.choices("etaoinshr", k=rng.randrange(1, 9))) for _ in range(rng.randrange(1, 150))]
        good = i % 3 > 0
        if not good:
            words = [w.upper() + "!!" for w in words] if i % 2 else [w + rng.choice(["###", "$$$"]) for w in words]
        docs.append((i, " ".join(words).capitalize() if good else " ".join(words)))
        labels.append((i, int(good)))
    return docs + [(1000, None), (1001, ""), (1002, "word " * 30000)], labels + [(5, None), (None, 1), (9999, 0)]


def test_score(spark):
    docs, labels = corpus()
    d = spark.createDataFrame([(*r, 1) for r in docs], "doc_id long, text string, score int").repartition(3)
    lab = spark.createDataFrame(labels, "doc_id long, quality int")
    model = quality.fit(d, lab)
    got = {r["doc_id"]: r for r in quality.score(spark, d, model).collect()}
    assert len(got) == len(docs) and got[0].__fields__ == ["doc_id", "text", "score", "_score", "predicted"]
    held = [i for i in range(400) if zlib.crc32(str(i).encode()) % 4 == 2]
    assert np.mean([got[i]["predicted"] == (i % 3 > 0) for i in held]) > 0.97
    assert all(0 <= r["_score"] <= 1 and r["predicted"] == (r["_score"] >= 0.7) for r in got.values())


def test_scores_equal_the_density_formula():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(200, 13))
    y = (x[:, 0] > 0).astype(int)
    classes, want = [], []
    for c in (0, 1):
        cov = np.cov(x[y == c].T, bias=True) + np.eye(13)
        low = np.linalg.cholesky(cov)
        classes.append((x[y == c].mean(0), np.linalg.inv(low), 2 * np.log(np.diag(low)).sum()))
        diff = x - x[y == c].mean(0)
        want.append(-0.5 * (np.einsum("ij,jk,ik->i", diff, np.linalg.inv(cov), diff) + np.linalg.slogdet(cov)[1]))
    got = quality.density_scores(x, {"prior": 0.25, "classes": classes})
    assert np.allclose(got, 1 / (1 + np.exp(-(want[1] - want[0] + np.log(1 / 3)))))


def test_one_class_or_none(spark):
    d = spark.createDataFrame([(1, "a b"), (3, None)], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert [r["score"] for r in quality.score(spark, d, quality.fit(d, none)).collect()] == [0.5, 0.5]
    ones = spark.createDataFrame([(1, 1)], "doc_id long, quality int")
    assert [r["score"] for r in quality.score(spark, d, quality.fit(d, ones)).collect()] == [1.0, 1.0]
    assert quality.score(spark, d.filter("false"), quality.fit(d, ones)).count() == 0


def test_statistics_of_odd_texts():
    for t in (None, "", " ", "\n\n", "é" * 1000, "a" * 10**6, "\ud800"):
        assert len(quality.statistics(t)) == len(quality.FEATURES) and np.isfinite(quality.statistics(t)).all()
