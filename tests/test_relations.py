import random

from lexweave.operators import relations as rel

INVERSES = {"fwd": "inv", "sym": "sym"}


def row_by_row(rows):
    """The rule, one row at a time: stored keys and conflicts."""
    stored, conflicts = {}, []
    for seq, (s, t, kind, res) in enumerate(rows):
        inv = INVERSES.get(kind)
        if inv != kind and (t, s, kind) in stored:
            conflicts.append((s, t, kind, seq, stored[t, s, kind] or "auto-generated"))
            continue
        stored.setdefault((s, t, kind), res)
        if inv:
            stored.setdefault((t, s, inv), "")
    return set(stored), sorted(conflicts)


def test_closed_form_equals_row_by_row(spark):
    rng = random.Random(11)
    cases, every = [], []
    for case in range(400):
        rows = [(rng.randrange(3) + 10 * case, rng.randrange(3) + 10 * case, rng.choice(["fwd", "inv", "sym", "free"]), rng.choice("pqr")) for _ in range(rng.randrange(1, 9))]
        cases.append(rows)
        every += [(s, t, k, case * 100 + i, r) for i, (s, t, k, r) in enumerate(rows)]
    df = spark.createDataFrame(every, "source long, target long, type string, seq long, resource string")
    stored, conflicts = rel.resolve(df, INVERSES)
    got = {(r["source"], r["target"], r["type"]) for r in stored.collect()}
    clash = {}
    for r in conflicts.collect():
        clash.setdefault(r["seq"] // 100, []).append((r["source"], r["target"], r["type"], r["seq"] % 100, r["prior_resource"]))
    for case, rows in enumerate(cases):
        want, bad = row_by_row(rows)
        mine = {k for k in got if k[0] // 10 == case}
        assert mine == want, rows
        assert sorted(clash.get(case, [])) == bad, rows


def test_convert(spark):
    rows = [(1, 2, "hyponym"), (2, 1, "hypernym"), (3, 4, "antonym"), (4, 3, "antonym"), (5, 6, "strange"), (7, 8, "causes"), (9, 9, "similar")]
    df = spark.createDataFrame(rows, "source long, target long, type string")
    names = {"hypernym": "hypernym", "antonym": "antonym", "causes": "causes"}
    pairs = {"hypernym": "hyponym", "antonym": "antonym", "causes": "is_caused_by", "similar": "similar"}
    have = spark.createDataFrame([(7, 8, "causes")], "source long, target long, type string")
    assert {tuple(r) for r in rel.convert(df, names, pairs, have).collect()} == {(2, 1, "hypernym"), (3, 4, "antonym")}
