"""Language identification as multilingual mixture inference.

Each language has a distribution over letter trigrams (lower-cased, everything but letters taken as one blank, hashed
to BUCKETS cells). A document is a mixture of languages: expectation-maximisation estimates its proportions from the
trigram likelihoods. The language set is grown from the best single language and a language is added only while the
likelihood gains more than PENALTY * ln(effective trigrams).

Learning uses at most DOCS_PER_LANG whole documents of each language, chosen by a hash of id and text; this bounds the
model's cost, not what is scored. Scoring looks at whole texts, one row at a time, without any shuffle.

Defined cases: a null text, an empty text and a text without letters give 'und' with score 0; rows with null lang are
never learned from; with nothing to learn from every row is 'und'; repeated rows are scored alike; very long texts become
counts of cells, no larger than BUCKETS; equal proportions go by the language's name, equally likely languages too; extra columns stay, also
where they have the names of ours.
"""

from __future__ import annotations

import math
from functools import cache

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import add_columns, fresh, held_out, steps, table

BUCKETS = 1 << 16
DOCS_PER_LANG = 2000
SMOOTHING = 0.05
ROUNDS = 20
#: Neighbouring trigrams overlap, so that three of them count as one observation.
OVERLAP = 3.0
PENALTY = 4.0


@cache
def _is_letter() -> np.ndarray:
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


def trigrams(text: str | None) -> tuple[np.ndarray, np.ndarray] | None:
    """Cells and counts of a text's trigrams; None if it has no letter."""
    if not text:
        return None
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = _is_letter()[points]
    if not letter.any():
        return None
    points = np.where(letter, points, 32).astype(np.uint32)
    keep = np.ones(len(points), bool)
    keep[1:] = letter[1:] | letter[:-1]
    points = points[keep]
    points = np.concatenate(([32], points[int(points[0] == 32) :], [32] * int(points[-1] != 32))).astype(np.uint32)
    mixed = points[:-2] * np.uint32(0x9E3779B1) + points[1:-1] * np.uint32(0x85EBCA77) + points[2:] * np.uint32(0xC2B2AE3D)
    mixed ^= mixed >> np.uint32(15)
    counts = np.bincount((mixed * np.uint32(0x27D4EB2F)) >> np.uint32(16), minlength=BUCKETS)
    cells = np.flatnonzero(counts)
    return cells, counts[cells].astype(np.float64)


def fit(docs: DataFrame, docs_per_lang: int = DOCS_PER_LANG) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Languages, log-probabilities (cells x languages) and log-priors from rows that are not held out.

    What reaches the driver is bounded by languages x BUCKETS counts, whatever the input's size.
    """
    known = docs.filter(F.col("lang").isNotNull() & ~held_out())
    sizes = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    langs = sorted(sizes)
    if not langs:
        return [], np.zeros((BUCKETS, 0)), np.zeros(0)
    share = F.lit(0)
    for lang in langs:
        share = F.when(F.col("lang") == lang, min(1 << 20, math.ceil(docs_per_lang / sizes[lang] * (1 << 20)))).otherwise(share)
    sample = known.filter(F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 20)) < share).select("lang", "text")

    def count(batches):
        import pyarrow as pa

        sums: dict[str, np.ndarray] = {}
        for batch in steps(batches, "text"):
            for lang, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if got := trigrams(text):
                    cells, n = got
                    sums.setdefault(lang, np.zeros(BUCKETS))[cells] += n
        for lang, n in sums.items():
            cells = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(cells)), pa.array(cells.astype(np.int32)), pa.array(n[cells])], names=["lang", "cell", "n"])

    rows = sample.mapInArrow(count, "lang string, cell int, n double").groupBy("lang", "cell").agg(F.sum("n").alias("n")).toPandas()
    seen = np.zeros((BUCKETS, len(langs)))
    seen[rows["cell"].to_numpy(np.int64), rows["lang"].map({x: i for i, x in enumerate(langs)}).to_numpy(np.int64)] = rows["n"].to_numpy()
    logp = np.log((seen + SMOOTHING) / (seen.sum(0) + SMOOTHING * BUCKETS))
    prior = np.array([sizes[x] for x in langs], float)
    return langs, logp, np.log(prior / prior.sum())


def _em(p: np.ndarray, counts: np.ndarray, total: float) -> tuple[np.ndarray, float]:
    """Proportions and log-likelihood of a mixture of the columns of p."""
    share = np.full(p.shape[1], 1 / p.shape[1])
    for _ in range(ROUNDS):
        w = p * share
        new = (counts / w.sum(1)) @ w / total
        moved = np.abs(new - share).max()
        share = new
        if moved < 1e-3:
            break
    return share, float(counts @ np.log(p @ share + 1e-300))


def infer(cells: np.ndarray, counts: np.ndarray, logp: np.ndarray, prior: np.ndarray) -> tuple[dict[int, float], float]:
    """Proportions of the chosen languages, and the score of the largest."""
    lp = logp[cells]
    top = lp.max(1)
    p = np.exp(lp - top[:, None])
    total = counts.sum()
    single = counts @ (lp - top[:, None])
    tempered = single / OVERLAP + prior
    best = int(tempered.argmax())
    price = PENALTY * math.log(total / OVERLAP + 2)
    posterior = float(1 / np.exp(tempered - tempered[best]).sum())
    chosen, like = [best], float(single[best])
    share = np.ones(1)
    # No subset of the languages is likelier than the mixture of all of them.
    if p.shape[1] > 1 and (_em(p, counts, total)[1] - like) / OVERLAP > price:
        while len(chosen) < p.shape[1]:
            tried = [(_em(p[:, [*chosen, k]], counts, total), k) for k in range(p.shape[1]) if k not in chosen]
            (new_share, new_like), k = max(tried, key=lambda x: x[0][1])
            if (new_like - like) / OVERLAP <= price:
                break
            chosen, like, share = [*chosen, k], new_like, new_share
    if len(chosen) == 1:
        return {best: 1.0}, posterior
    mix = dict(zip(chosen, share.tolist(), strict=True))
    return mix, max(mix.values())


def identify(spark: SparkSession, docs: DataFrame, model: tuple[list[str], np.ndarray, np.ndarray]) -> DataFrame:
    """docs with lang_pred, score and langs (each chosen language's proportion, largest first)."""
    shared = spark.sparkContext.broadcast(model)

    def run(texts):
        langs, logp, prior = shared.value
        out = [[], [], []]
        for text in texts:
            got = trigrams(text) if langs else None
            if got is None:
                row = ("und", 0.0, "")
            else:
                mix, score = infer(*got, logp, prior)
                ranked = sorted(mix, key=lambda k: (-mix[k], langs[k]))
                row = (langs[ranked[0]], min(1.0, max(0.0, score)), ",".join(f"{langs[k]}:{mix[k]:.3f}" for k in ranked))
            for column, value in zip(out, row, strict=True):
                column.append(value)
        return out

    pred, score, mix = fresh(docs, "lang_pred", "score", "langs")
    return add_columns(docs, ["text"], f"`{pred}` string, `{score}` double, `{mix}` string", run)


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = fit(docs.select("doc_id", "lang", "text"))
    rows = docs.select("doc_id", held_out().alias("held_out"), "text")
    return identify(spark, rows, model).drop("text")
