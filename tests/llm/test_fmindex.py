import hashlib
import random
import re

import numpy as np

from lexweave.llm import fmindex

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def plain_words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def plain(docs, items, window=10):
    out = {}
    for i, text in docs:
        words = plain_words(text)
        hit, names = set(), set()
        for name, item in items:
            w = plain_words(item)
            if not w:
                continue
            size = min(window, len(w))
            for a in range(len(w) - size + 1):
                for p in range(len(words) - size + 1):
                    if words[p : p + size] == w[a : a + size]:
                        hit |= set(range(p, p + size))
                        names.add(str(name))
        out[i] = (len(words), len(hit), len(names), hashlib.sha256(",".join(sorted(names)).encode()).hexdigest(), bool(hit))
    return out


def corpus(seed):
    rng = random.Random(seed)
    vocab = [rng.choice("abcé0") + str(i) for i in range(25)]
    items = [(k, " ".join(rng.choices(vocab[:12], k=rng.choice([1, 3, 9, 10, 11, 30])))) for k in range(12)] + [(90, None), (91, " - "), (92, "B7 a8-C9"), (3, "zz yy xx")]
    docs = []
    for i in range(60):
        words = rng.choices(vocab, k=rng.randrange(0, 60))
        for _ in range(rng.randrange(3)):
            part = (rng.choice(items)[1] or "").split()
            a = rng.randrange(len(part) + 1)
            words[rng.randrange(len(words) + 1) : 0] = part[a : a + 14]
        docs.append((i, rng.choice([" ", ", ", "\n"]).join(words).upper() if i % 3 else " ".join(words)))
    return docs + [(100, None), (101, ""), (102, "..."), (103, items[5][1] + " " + items[5][1]), (103, items[5][1]), (104, "q " * 40000 + items[4][1])], items


def test_suffix_order_and_index_against_sorting():
    rng = np.random.default_rng(1)
    for sigma in (2, 4, 300):
        seq = np.concatenate((rng.integers(0, sigma, 400), np.tile(rng.integers(1, sigma, 30), 5), [0]))
        n = len(seq)
        value = lambda i: tuple((0, j) if seq[j] == 0 else (1, int(seq[j])) for j in range(i, n))
        assert fmindex.suffix_order(seq, sigma).tolist() == sorted(range(n), key=value)
        index = fmindex.FMIndex(seq, sigma)
        for size in (1, 2, 5):
            patterns = np.array([seq[i : i + size] for i in range(0, n - size, 3) if (seq[i : i + size] > 0).all()] + [[sigma - 1] * size])
            low, high = index.ranges(patterns)
            for p, a, b in zip(patterns, low, high):
                want = [i for i in range(n - size + 1) if (seq[i : i + size] == p).all()]
                assert sorted(index.locate(np.arange(a, b)).tolist()) == want


def test_find_against_brute_force(spark, monkeypatch):
    docs, items = corpus(4)
    want = {}
    for i, (doc, text) in enumerate(docs):
        want.setdefault(doc, set()).add(plain([(doc, text)], items)[doc])
    rows = spark.createDataFrame([(i, t, 1) for i, t in docs], "doc_id long, text string, n_words int").repartition(3)
    bench = spark.createDataFrame(items, "item_id long, text string")
    for tokens, block in ((1 << 20, 16 << 20), (200, 200)):
        monkeypatch.setattr(fmindex, "SHARD_TOKENS", tokens)
        monkeypatch.setattr(fmindex, "BLOCK_BYTES", block)
        got = fmindex.find(spark, rows, bench).collect()
        assert len(got) == len(docs)
        for r in got:
            size, hits, names = r[3], r["hit_words"], r["hit_items"]
            assert (size, len(hits), len(names), hashlib.sha256(",".join(names).encode()).hexdigest(), bool(hits)) in want[r["doc_id"]]


def test_decontaminate_leaves_no_window(spark):
    docs, items = corpus(9)
    rows = spark.createDataFrame([(i, t) for i, t in docs], "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    before = plain(docs[:60], items)
    got = {r["doc_id"]: r["text"] for r in fmindex.decontaminate(spark, rows, bench).collect()}
    assert not any(x[4] for x in plain(list(got.items()), items).values())
    assert all(got[i] == t for i, t in docs[:60] if not before[i][4])
    assert got[100] is None and got[101] == "" and 103 not in got


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    none = spark.createDataFrame([], "item_id long, text string")
    assert [len(r["hit_words"]) for r in fmindex.find(spark, docs, none).collect()] == [0, 0]
    assert fmindex.find(spark, docs.filter("false"), none).count() == 0
