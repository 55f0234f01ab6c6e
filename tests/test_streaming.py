import random

from lexweave.operators.relations import resolve
from lexweave.streaming import ingest


def test_relations_by_micro_batch_equal_one_batch(spark, tmp_path):
    rng = random.Random(3)
    rows = [(rng.randrange(6), rng.randrange(6), rng.choice(["fwd", "sym", "free"]), k, f"r{k // 10}") for k in range(60)]
    schema = "source long, target long, type string, seq long, resource string"
    for part in range(6):
        spark.createDataFrame(rows[part * 10 : part * 10 + 10], schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = ingest.stream_of(spark, str(tmp_path / "in"), schema)
    inverses = {"fwd": "inv", "sym": "sym"}
    ingest.run_to_end(ingest.relations_stream(stream, inverses, str(tmp_path / "state"), str(tmp_path / "log")))
    kept = ingest.state_of(spark, str(tmp_path / "state"), schema)
    got = {(r["source"], r["target"], r["type"]) for r in resolve(kept, inverses)[0].collect()}
    want = {(r["source"], r["target"], r["type"]) for r in resolve(spark.createDataFrame(rows, schema), inverses)[0].collect()}
    assert got == want


def test_first_wins(spark, tmp_path):
    for part in ([(1, 5), (2, 6)], [(1, 1), (3, 7), (3, 8)]):
        spark.createDataFrame(part, "k long, v long").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = ingest.stream_of(spark, str(tmp_path / "in"), "k long, v long")
    ingest.run_to_end(ingest.first_wins(stream, ["k"], ["v"], str(tmp_path / "state"), str(tmp_path / "log")))
    assert {tuple(r) for r in ingest.state_of(spark, str(tmp_path / "state"), "k long, v long").collect()} == {(1, 5), (2, 6), (3, 7)}
