import random

from pyspark.sql import functions as F

from lexweave.operators import graph


def reach(edges):
    out = {}
    for a, b in edges:
        out.setdefault(a, set()).add(b)
    closure = {}
    for start in out:
        seen, todo = set(), list(out[start])
        while todo:
            n = todo.pop()
            if n not in seen:
                seen.add(n)
                todo += out.get(n, ())
        closure[start] = seen
    return closure


def test_strong_components():
    rng = random.Random(4)
    for _ in range(60):
        edges = [(rng.randrange(12), rng.randrange(12)) for _ in range(rng.randrange(1, 25))]
        of, r = graph.strong_components(edges), reach(edges)
        nodes = {x for e in edges for x in e}
        for a in nodes:
            for b in nodes:
                same = a == b or (b in r.get(a, ()) and a in r.get(b, ()))
                assert (of[a] == of[b]) == same


def test_new_cycles_go_and_old_edges_stay(spark):
    rng = random.Random(9)
    edges = sorted({(rng.randrange(15), rng.randrange(15)) for _ in range(22)})
    rows = [(a, b, k % 2 == 0) for k, (a, b) in enumerate(edges)]
    df = spark.createDataFrame(rows, "source long, target long, is_new boolean")
    kept, removed = graph.remove_new_cycles(spark, df)
    r = reach(edges)
    want = {(a, b) for a, b, n in rows if n and (a == b or a in r.get(b, ()))}
    found = removed.collect()
    assert {(x["source"], x["target"]) for x in found} == want
    assert {(x["source"], x["target"]) for x in kept.collect()} == {(a, b) for a, b, _ in rows} - want
    for x in found:
        chain = x["chain"]
        assert chain[0] == x["target"] or x["source"] == x["target"]
        assert chain[-1] == x["source"] and (len(chain) == 2 or all(e in edges for e in zip(chain, chain[1:])))


def test_colouring_equals_kernel(spark):
    rng = random.Random(2)
    for nodes, n in ((14, 20),):
        df = spark.createDataFrame([(rng.randrange(nodes), rng.randrange(nodes)) for _ in range(n)], "source long, target long")
        found = {tuple(r) for r in graph.cyclic_nodes(spark, df).collect()}
        assert found == {tuple(r) for r in graph.coloured_components(spark, df.distinct()).collect()} and found
    assert graph.coloured_components(spark, df.limit(0)).count() == 0


def test_chains_and_paths(spark):
    edges = spark.createDataFrame([(1, 3, 2), (2, 2, 1), (3, 4, 3), (4, 3, 9), (5, 7, 8), (6, 8, 7)], "id long, source long, target long")
    assert [(r["depth"], r["node"]) for r in graph.chain(spark, edges, 4).orderBy("depth").collect()] == [(0, 4), (1, 3), (2, 2), (3, 1)]
    assert [r["node"] for r in graph.chain(spark, edges, 7).orderBy("depth").collect()] == [7, 8]
    got = {(r["node"], r["ancestor"]): r["depth"] for r in graph.ancestors(spark, edges).collect()}
    assert got == {(3, 2): 1, (3, 1): 2, (2, 1): 1, (4, 3): 1, (4, 2): 2, (4, 1): 3, (7, 8): 1, (8, 7): 1}
    assert graph.find_path(spark, edges, 4, 1) == [4, 3, 2, 1] and graph.find_path(spark, edges, 1, 4) is None and graph.find_path(spark, edges, 4, 9) == [4, 3, 9]


def test_chains_have_no_longest_length(spark):
    edges = spark.createDataFrame([(k, k, k - 1) for k in range(1, 81)], "id long, source long, target long")
    assert [r["node"] for r in graph.chain(spark, edges, 80).orderBy("depth").collect()] == list(range(80, -1, -1))
    assert graph.find_path(spark, edges, 20, 15) == list(range(20, 14, -1))
    ring = spark.createDataFrame([(k, k, (k + 1) % 70) for k in range(70)] + [(100, 100, 0)], "id long, source long, target long")
    assert [r["node"] for r in graph.chain(spark, ring, 100).orderBy("depth").collect()] == [100, *range(70)]


def test_pictograms(spark):
    synsets = spark.createDataFrame([(k,) for k in range(1, 7)], "id long")
    relations = spark.createDataFrame([(1, 2, 1, "hypernym"), (2, 3, 2, "hypernym"), (3, 4, 1, "eq_synonym"), (4, 5, 1, "similar")], "id long, source long, target long, type string")
    pics = spark.createDataFrame([(1, 50)], "synset_id long, arasaac_id long")
    got = {r["synset_id"]: (r["arasaac_id"], r["via"]) for r in graph.pictograms(spark, synsets, pics, relations).collect()}
    assert got == {1: (50, "direct"), 2: (50, "hypernym"), 3: (50, "hypernym"), 4: (50, "eq_synonym"), 5: (50, "similar"), 6: (None, None)}
    assert graph.representative_cycles(spark, relations.select("source", F.col("target"))).count() == 0


def test_scratch_tables_can_be_cleared(spark):
    from lexweave import scratch

    t = scratch.Scratch(spark, "x").cut(spark.range(3))
    assert t.count() == 3 and t.columns == ["id"]
    path = t._scratch.removeprefix("file:")
    import os

    assert os.path.isdir(path)
    scratch.clear(spark)
    assert not os.path.exists(path) and scratch.Scratch.roots == []


def test_cycle_queries_cover_all_relations(spark, tmp_path):
    from lexweave.plans.queries import QUERIES

    rng = random.Random(11)
    rows = [(k, 1, rng.randrange(30), rng.randrange(20), "ANR"[k % 3], "OF"[rng.randrange(2)], "1996-01-01", 1.0, 1.0) for k in range(60)]
    rows.append((60, 1, 3, 3, "A", "O", "1996-01-01", 1.0, 1.0))
    names = "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_returnflag string, l_linestatus string, l_shipdate string, l_quantity double, l_extendedprice double"
    spark.createDataFrame(rows, names).write.parquet(f"{tmp_path}/lineitem.parquet")

    def components(edges):
        r = reach(edges)
        return {min(b for b in r[a] if a in r.get(b, ())): {n for n in r if n in r[n] and a in r[n] and n in r[a]} for a in r if a in r[a]}

    edges = {(x[2] + 1, x[3] + 1) for x in rows}
    old, r = {(x[2] + 1, x[3] + 1) for x in rows if x[5] == "F"}, reach(edges)
    want, isa = components(edges), {(x[2] + 1, x[3] + 1) for x in rows if x[4] == "A"}
    run = lambda q: QUERIES[q](spark, str(tmp_path)).collect()
    gone = [tuple(x) for x in run("relation_cycle_edges_removed")]
    assert len(gone) == len(set(gone)) and set(gone) == {(a, b) for a, b in edges - old if a in r.get(b, ())}
    assert {tuple(x) for x in run("relation_residual_cycles")} == {(c, len(n)) for c, n in want.items()}
    found = {x["component"]: [int(n) for n in x["cycle"].split(">")] for x in run("representative_cycles")}
    assert found.keys() == want.keys() and all(c[0] == c[-1] == k and all(e in edges for e in zip(c, c[1:])) for k, c in found.items())
    assert {x["component"] for x in run("quality_hypernym_loops")} == components(isa).keys() and want
