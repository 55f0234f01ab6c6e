import pytest

from lexweave.llm import mixing
from lexweave.llm.common import word_count


def plain_targets(sizes):
    """Rounds of resharing, as the contract words it."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: k % 3 + 1 for k, s in enumerate(names)}
    total, capped = sum(sizes.values()), {}
    while True:
        free = [s for s in names if s not in capped]
        left = total - sum(capped.values())
        share = {s: left * weight[s] / sum(weight[f] for f in free) for s in free}
        over = [s for s in free if share[s] > 3 * sizes[s]]
        if not over:
            return capped | share
        capped |= {s: 3 * sizes[s] for s in over}


@pytest.mark.parametrize("sizes", [{"a": 10, "b": 1000, "c": 50, None: 7}, {"x": 5}, {"a": 1, "b": 1, "c": 1, "d": 997, "e": 300}, {"é": 4, "z": 90, "Z": 6, "a": 400, None: 1, "q": 0}])
def test_targets_equal_rounds_of_resharing(spark, sizes):
    df = spark.createDataFrame([(s, n) for s, n in sizes.items()], "source string, size long")
    got = {r["source"]: r["target"] for r in mixing.targets(df).collect()}
    want = plain_targets(sizes)
    assert set(got) == set(want) and all(abs(got[s] - want[s]) < 1e-6 for s in want)


def test_word_count(spark):
    cases = {None: 0, "": 0, " \t\n": 0, "one": 1, " two  words\n": 2, "a\x0bb\x0cc\rd": 4, "nb sp one": 2, "x " * 5000: 5000}
    df = spark.createDataFrame([(t, n) for t, n in cases.items()], "text string, n long")
    assert all(r["w"] == r["n"] for r in df.withColumn("w", word_count("text")).collect())


def docs(spark):
    rows = [(i, "w " * (1 + i * 7 % 40), ["a", "b", "b", "b", None, "c"][i % 6], "x") for i in range(600)]
    rows += [(900, None, "a", "x"), (901, "", None, "x"), (None, "some words here", "c", "x"), rows[5], rows[5]]
    return spark.createDataFrame(rows, "doc_id long, text string, source string, copies string")


def test_mix(spark):
    d = docs(spark)
    sized, per = mixing.plan(spark, d)
    out = mixing.decide(sized, per).collect()
    assert len(out) == d.count()
    taken, target = {}, {}
    for r in out:
        taken[r["source"]] = taken.get(r["source"], 0) + r["size"] * r["copies"]
        target[r["source"]] = r["target"]
        assert r["size"] * r["copies"] <= 3 * r["size"]
    assert all(abs(taken[s] - target[s]) <= 0.02 * target[s] + 40 for s in taken), (taken, target)
    emitted = mixing.mix(spark, d)
    assert emitted.columns == ["doc_id", "text", "source", "copies", "copy_no"]
    again = mixing.mix(spark, d.repartition(5))
    key = lambda df: sorted((str(r["doc_id"]), r["copy_no"]) for r in df.collect())
    assert key(emitted) == key(again) and emitted.count() == sum(r["copies"] for r in out)


def test_empty(spark):
    assert mixing.mix(spark, docs(spark).filter("false")).count() == 0
