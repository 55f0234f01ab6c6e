"""Quality classifier: regularised quadratic discriminant analysis on transformed document statistics.

A document becomes a vector of statistics that do not depend on its language, each smoothed towards a typical value so
that short texts are not extreme, then log- or logit-transformed. Each class has a mean and a covariance, shrunk
towards the pooled diagonal; its Cholesky factor is computed once and shipped. The score is the posterior of label 1
from the difference of the log-densities (Mahalanobis terms by the inverse of the factor) and the log-prior ratio.

Fitting uses at most ROWS_PER_CLASS labelled rows of each class, chosen by a hash of the id. Scoring is one narrow pass
over whole texts.

Defined cases: null and empty texts get the vector of the smoothing constants and so a score like any other; labels
null or not 0/1 are not learned from; if a class has no row, the score is the share of label 1 (0.5 with no labels at
all); a document labelled twice counts twice; repeated rows are scored alike; very long texts are statistics like any others;
equal scores are equal predictions, the cut itself is accepted; extra columns stay, also where they have the names of ours.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import add_columns, fresh, held_out, table

ROWS_PER_CLASS = 4000
SHRINK = 0.15
CUT = 0.7
FEATURES = ("words", "word_len", "word_len_spread", "upper", "digit", "mark", "stop_mark", "bars", "shout", "distinct", "repeat_next", "line_repeat", "glued")
_MARK = np.zeros(256, bool)
_MARK[[b for b in range(33, 127) if not chr(b).isalnum() and chr(b) not in ".,;:'\"-()?"]] = True
_STOP = np.zeros(256, bool)
_STOP[[ord(c) for c in ".,;:?"]] = True
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True


def _logit(hits: float, of: float, usual: float, weight: float = 8.0) -> float:
    p = (hits + usual * weight) / (of + weight)
    p = min(max(p, 1e-4), 1 - 1e-4)
    return math.log(p / (1 - p))


def statistics(text: str | None) -> list[float]:
    raw = (text or "").encode("utf-8", "surrogatepass")
    by = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    words = raw.split()
    n = len(words)
    sizes = np.fromiter(map(len, words), np.int64, n)
    mean = (sizes.sum() + 5.5 * 8) / (n + 8)
    spread = math.sqrt((((sizes - mean) ** 2).sum() + 9 * 8) / (n + 8))
    letters = int(by[_LETTER].sum())
    marked = sum(w[-1:] in b"#$%&*!|<>=~^" and not w[-1:].isalnum() for w in words)
    shout = sum(len(w) > 1 and w.isupper() for w in words)
    same = sum(a == b for a, b in zip(words, words[1:]))
    lines = raw.split(b"\n")
    again = len(lines) - len(set(lines))
    window = 200
    distinct = sum(len(set(words[i : i + window])) for i in range(0, n, window))
    return [
        math.log(n + 8.0),
        math.log(mean),
        math.log(spread),
        _logit(int(by[_UPPER].sum()), letters, 0.02, 60),
        _logit(int(by[_DIGIT].sum()), len(raw), 0.002, 100),
        _logit(int(by[_MARK].sum()), len(raw), 0.002, 100),
        _logit(int(by[_STOP].sum()), n, 0.15),
        _logit(int(by[ord("|")]), n, 0.002, 20),
        _logit(shout, n, 0.005, 20),
        _logit(distinct, n, 0.8),
        _logit(same, n, 0.01, 20),
        _logit(again, len(lines), 0.02, 5),
        _logit(marked, n, 0.005, 20),
    ]


def fit(docs: DataFrame, labels: DataFrame, rows_per_class: int = ROWS_PER_CLASS) -> dict:
    """Class means and Cholesky factors from labelled rows that are not held out; the sample is bounded."""
    usable = labels.filter(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out())
    sizes = {r["quality"]: r["n"] for r in usable.groupBy("quality").agg(F.count("*").alias("n")).collect()}
    total = sum(sizes.values())
    prior = sizes.get(1, 0) / total if total else 0.5
    if len(sizes) < 2:
        return {"prior": prior, "classes": None}
    share = F.lit(0)
    for label, n in sizes.items():
        share = F.when(F.col("quality") == label, min(1 << 20, math.ceil(rows_per_class / n * (1 << 20)))).otherwise(share)
    sample = usable.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < share).select(F.col("doc_id").alias("_id"), F.col("quality").alias("_quality"))
    picked = docs.select("doc_id", "text").join(F.broadcast(sample), F.col("doc_id") == F.col("_id")).select("_quality", "text")

    def run(texts):
        return [[statistics(t) for t in texts]]

    rows = add_columns(picked, ["text"], "x array<double>", run).select("_quality", "x").collect()
    x, y = np.array([r["x"] for r in rows]).reshape(-1, len(FEATURES)), np.array([r["_quality"] for r in rows])
    if min((y == 0).sum(), (y == 1).sum()) < 2:
        return {"prior": prior, "classes": None}
    pooled = np.mean([x[y == c].var(0) for c in (0, 1)], axis=0)
    classes = []
    for c in (0, 1):
        own = x[y == c]
        cov = (1 - SHRINK) * np.cov(own.T, bias=True) + SHRINK * np.diag(pooled) + 1e-3 * np.eye(x.shape[1])
        low = np.linalg.cholesky(cov)
        classes.append((own.mean(0), np.linalg.inv(low), 2 * float(np.log(np.diag(low)).sum())))
    return {"prior": prior, "classes": classes}


def density_scores(x: np.ndarray, model: dict) -> np.ndarray:
    if model["classes"] is None:
        return np.full(len(x), model["prior"])
    log = []
    for mean, inverse, logdet in model["classes"]:
        z = (x - mean) @ inverse.T
        log.append(-0.5 * ((z * z).sum(1) + logdet))
    odds = log[1] - log[0] + math.log(model["prior"] / (1 - model["prior"]))
    return 1 / (1 + np.exp(-np.clip(odds, -500, 500)))


def score(spark: SparkSession, docs: DataFrame, model: dict) -> DataFrame:
    """docs with score (probability of label 1) and predicted (1 from CUT upwards)."""
    shared = spark.sparkContext.broadcast(model)

    def run(texts):
        x = np.array([statistics(t) for t in texts], float).reshape(-1, len(FEATURES))
        s = density_scores(x, shared.value)
        return [s, (s >= CUT).astype(np.int32)]

    name, label = fresh(docs, "score", "predicted")
    return add_columns(docs, ["text"], f"`{name}` double, `{label}` int", run)


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = fit(docs, table(spark, sf_dir, "labels"))
    return score(spark, docs.select("doc_id", held_out().alias("held_out"), "text"), model).drop("text")
