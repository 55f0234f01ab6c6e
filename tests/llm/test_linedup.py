import random

from lexweave.llm import linedup


def plain(rows):
    """Sequential model: (doc_id, text) -> text without later copies."""
    order = sorted({(d, t) for d, t in rows if t is not None})
    seen1, seen2, out = set(), set(), {}
    for d, t in order:
        lines = t.split("\n")
        filled = [(k, s.strip(" \t\r\x0b\x0c")) for k, s in enumerate(lines) if s.strip(" \t\r\x0b\x0c")]
        gone = set()
        for j, (k, s) in enumerate(filled):
            if s in seen1 and len(s) >= linedup.MIN_CHARS:
                gone.add(k)
            seen1.add(s)
            if j + 1 < len(filled):
                pair = (s, filled[j + 1][1])
                if pair in seen2:
                    gone |= {k, filled[j + 1][0]}
                seen2.add(pair)
        out[d, t] = "\n".join(s for k, s in enumerate(lines) if k not in gone)
    return out


def corpus():
    rng = random.Random(2)
    pool = ["short", "tiny", "a line that is longer than the limit", "another line of more than twenty characters"] + [f"l{i}" for i in range(12)]
    rows = []
    for d in range(80):
        lines = [rng.choice(pool + ["", " \t", f"only {d} {k}"]) for k in range(rng.randrange(1, 14))]
        rows.append((d, "\n".join(lines)))
    rows += [(200 + k, rows[7][1] + "\n" + rows[9][1]) for k in range(5)]
    rows += [(300, None), (301, ""), (302, "\n\n"), (303, "x\n" * 5000), (304, "same\nsame\nsame\nsame")]
    return rows


def test_against_sequential_model(spark):
    rows = corpus()
    rows += [rows[3], rows[80]]
    docs = spark.createDataFrame([(d, t, 1) for d, t in rows], "doc_id long, text string, n_lines int").repartition(3)
    want = plain(rows)
    got = linedup.dedup_lines(spark, docs).collect()
    assert len(got) == len(rows)
    assert got[0].__fields__ == ["doc_id", "text", "n_lines", "_n_lines", "n_removed", "longest_run"]
    texts = dict(rows)
    for r in got:
        before = texts[r["doc_id"]]
        assert r["text"] == (None if before is None else want[r["doc_id"], before]), r["doc_id"]
        if before is not None:
            assert r["n_removed"] == before.count("\n") - r["text"].count("\n") or r["text"] == ""
    assert next(r for r in got if r["doc_id"] == 303)["longest_run"] == 4999


def test_suffixes_are_ordered(spark):
    rows = [(1, "b\na\nc\nb\na\nc"), (2, "a\nc\nb\na"), (3, "a\nc\nb\na")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    from lexweave.llm.common import Scratch

    flat = {d: t.split("\n") for d, t in rows}
    for size, table in linedup.repeated_suffixes(spark, docs, Scratch(spark, "t")):
        found = [(tuple(flat[r["d"]][r["i"] : r["i"] + size]), r["r"], tuple(r["first"])) for r in table.collect()]
        assert all(len(x) == size for x, _, _ in found)
        by_line = {x: r for x, r, _ in found}
        assert all(by_line[x] == r for x, r, _ in found) and len(set(by_line.values())) == len(by_line)
        if size == 1:
            order = by_line
        else:
            # The order of longer prefixes extends the order of their first lines.
            ranked = sorted(by_line, key=by_line.get)
            assert ranked == sorted(ranked, key=lambda x: [order[(s,)] for s in x])


def test_nulls_and_empty(spark):
    line = "a line of more than twenty characters"
    docs = spark.createDataFrame([(None, line), (5, line), (None, None)], "doc_id long, text string")
    got = sorted((r["doc_id"] is None, r["text"] or "-", r["n_removed"]) for r in linedup.dedup_lines(spark, docs).collect())
    assert got == [(False, line, 0), (True, "-", 0), (True, "-", 1)]
    assert linedup.dedup_lines(spark, docs.filter("false")).count() == 0


def plain_runs(rows):
    """(doc, index) -> lines of the run that a line begins or goes on in, by comparing with the source line by line."""
    flat = {d: t.split("\n") for d, t in rows}
    at = [(d, i) for d in sorted(flat) for i in range(len(flat[d]))]

    def common(p, q):
        n = 0
        while p[1] + n < len(flat[p[0]]) and q[1] + n < len(flat[q[0]]) and flat[p[0]][p[1] + n] == flat[q[0]][q[1] + n]:
            n += 1
        return n

    source = {}
    for k, p in enumerate(at):
        longest = max((common(p, q) for q in at[:k]), default=0)
        if longest:
            size = 1 << (longest.bit_length() - 1)
            source[p] = next(q for q in at[:k] if common(p, q) >= size)
    heads = {}
    for (d, i), q in source.items():
        if source.get((d, i - 1)) != (q[0], q[1] - 1):
            heads[d, i] = common((d, i), q)
    return heads


def test_runs_against_brute_force(spark):
    from lexweave.llm.common import Scratch

    rng = random.Random(12)
    base = [f"s{rng.randrange(9)}" for _ in range(40)]
    rows = []
    for d in range(25):
        lines = []
        for _ in range(rng.randrange(1, 4)):
            a = rng.randrange(len(base))
            lines += rng.choice([base[a : a + rng.randrange(1, 25)], [f"only {d} {a}"]])
        rows.append((d, "\n".join(lines)))
    rows.append((90, "x\n" * 30 + "x"))
    scratch = Scratch(spark, "t")
    rounds = list(linedup.repeated_suffixes(spark, spark.createDataFrame(rows, "doc_id long, text string"), scratch))
    got = {(r["d"], r["i"]): r["n"] for r in linedup.runs(rounds, scratch).collect()}
    assert got == plain_runs(rows) and max(got.values()) >= 20


def test_line_identity_ids_and_names(spark):
    rows = [("7", "one line with a\ttab inside it\n", 1, 2), ("x", "one line with a tab inside it", 3, 4), (None, " \tone line with a\ttab inside it\r", 5, 6), ("x", None, 7, 8)]
    docs = spark.createDataFrame(rows, "doc_id string, text string, _gone int, _d int")
    got = linedup.dedup_lines(spark, docs).collect()
    assert {(r["doc_id"], r["text"], r["_gone"], r["_d"]) for r in got} == {rows[0], rows[1], (None, "", 5, 6), rows[3]}
