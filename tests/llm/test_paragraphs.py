import random

import numpy as np
import xxhash

from lexweave.llm import paragraphs
from lexweave.llm.paragraphs import ANCHOR, LEAST, SHINGLE, WINDOW

M64 = (1 << 64) - 1


def plain_mix(h):
    h = ((h ^ (h >> 33)) * 0xFF51AFD7ED558CCD) & M64
    return h ^ (h >> 29)


def plain_pieces(text):
    """(first, end) of the pieces of a text without repeated anchors, word by word."""
    words = (text or "").lower().split()
    hashes = [xxhash.xxh3_64_intdigest(w) for w in words]
    g = [plain_mix(sum(hashes[i + k] * int(paragraphs._STEP[k]) for k in range(ANCHOR)) & M64) for i in range(len(words) - ANCHOR + 1)]
    cuts = {0, len(words)}
    for i in range(len(g) - WINDOW + 1):
        least = min(g[i : i + WINDOW])
        cuts |= {i + j for j in range(WINDOW) if g[i + j] == least}
    cuts = sorted(cuts)
    return list(zip(cuts[:-1], cuts[1:]))


def plain_lines(text):
    at, out = 0, []
    for line in (text or "").split("\n"):
        n = len(line.split())
        out += [(at, at + n)] * (n > 0)
        at += n
    return out


def plain_clusters(rows):
    """(is piece, doc, first, end) -> the one that stays, by comparing all pairs of lines and all pieces."""
    words = {}
    for d, t in rows:
        w = (t or "").lower().split()
        for piece, found in ((False, plain_lines(t)), (True, plain_pieces(t))):
            words |= {(piece, d, a, b): w[a:b] for a, b in found}
    sets = {k: {tuple(w[i : i + SHINGLE]) for i in range(max(1, len(w) - SHINGLE + 1))} for k, w in words.items()}
    keys = sorted(words)
    up = {k: k for k in keys}

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for n, a in enumerate(keys):
        for b in keys[n + 1 :]:
            near = not a[0] and not b[0] and min(len(words[a]), len(words[b])) >= SHINGLE and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]) - 1e-9
            if a[0] == b[0] and (words[a] == words[b] or near):
                x, y = root(a), root(b)
                up[max(x, y)] = min(x, y)
    members = {}
    for k in keys:
        members.setdefault(root(k), []).append(k)
    return {k: r for r, ks in members.items() if len(ks) > 1 for k in ks}


def plain_verdicts(rows):
    """doc -> (removed words, documents that hold what stays)."""
    keep, docs = plain_clusters(rows), {}
    for k, first in keep.items():
        docs.setdefault(first, set()).add(k[1])
    gone, of = {d: set() for d, _ in rows}, {d: set() for d, _ in rows}
    for d, t in rows:
        runs = [[x] for x in plain_lines(t) if (False, d, *x) in keep]
        for x in plain_pieces(t):
            if (True, d, *x) not in keep:
                continue
            if runs and (True, d, *runs[-1][-1]) in keep and runs[-1][-1][1] == x[0] and runs[-1][0] not in plain_lines(t):
                runs[-1].append(x)
            else:
                runs.append([x])
        for run in runs:
            n = run[-1][1] - run[0][0]
            for x in run if n >= LEAST or n == len((t or "").split()) else []:
                for piece in (False, True):
                    first = keep.get((piece, d, *x))
                    if first and first[1:] != (d, *x) and len(docs[first]) > 1:
                        gone[d] |= set(range(*x))
                        of[d].add(first[1])
    return gone, of


def corpus(rng, n=60):
    """Texts with passages of 51 to 90 words between other words, in and across lines, some with words replaced."""
    words = [f"w{i}" for i in range(400)]
    passages = [rng.choices(words, k=rng.randrange(51, 90)) for _ in range(12)]
    rows = []
    for d in range(n):
        w = []
        for _ in range(rng.randrange(3)):
            w += rng.choices(words, k=rng.randrange(60))
            p = list(rng.choice(passages))
            for _ in range(rng.choice([0, 0, 1, 2])):
                p[rng.randrange(len(p))] = rng.choice(words).upper()
            w += p
        w += rng.choices(words, k=rng.randrange(60))
        rows.append((d, "".join(x + rng.choice([" "] * 30 + ["\n", "  "]) for x in w)))
    return rows


def test_bands_reach_the_recall():
    assert 1 - (1 - 0.8**paragraphs.ROWS) ** paragraphs.BANDS >= paragraphs.RECALL


def test_pieces_like_the_plain_model():
    rng = random.Random(2)
    texts = [t for _, t in corpus(rng)] + ["", None, "a", "a b c\n\n d", " ".join(f"x{i}" for i in range(3000))]
    rng.shuffle(texts)
    values, starts, lines = paragraphs.tokens(texts, paragraphs._Hashes())
    got = paragraphs.pieces_of(values, starts)
    for k, t in enumerate(texts):
        own = got[(got[:, 0] >= starts[k]) & (got[:, 0] < starts[k + 1])] - starts[k]
        assert list(map(tuple, own.tolist())) == plain_pieces(t), t
        assert list(map(tuple, (lines[(lines[:, 0] >= starts[k]) & (lines[:, 0] < starts[k + 1])] - starts[k]).tolist())) == plain_lines(t)


def test_repeated_words_make_few_pieces():
    for text in ("x " * 60000, "a b " * 30000):
        values, starts, _ = paragraphs.tokens([text], paragraphs._Hashes())
        assert len(paragraphs.pieces_of(values, starts)) < 60000 / WINDOW * 3


def test_signatures_do_not_depend_on_the_batch():
    rng = random.Random(1)
    texts = [" ".join(rng.choice("abcdef") for _ in range(rng.randrange(SHINGLE, 80))) for _ in range(50)]
    values, starts, lines = paragraphs.tokens(texts, paragraphs._Hashes())
    ids, bands = paragraphs.class_ids(values, lines, 0), paragraphs.signatures(values, lines)
    for k, t in enumerate(texts):
        own, _, line = paragraphs.tokens([t], paragraphs._Hashes())
        assert ids[k] == paragraphs.class_ids(own, line, 0)[0] != paragraphs.class_ids(own, line, 1)[0]
        assert (bands[k] == paragraphs.signatures(own, line)[0]).all()


def test_against_brute_force(spark, monkeypatch):
    rows = corpus(random.Random(7))
    gone, of = plain_verdicts(rows)
    extra = [(900, None), (901, ""), rows[3]]
    docs = spark.createDataFrame([(d, t, True, 1) for d, t in rows + extra], "doc_id long, text string, spans boolean, _d int").repartition(4)
    for group in (500, 3):
        monkeypatch.setattr(paragraphs, "GROUP", group)
        got = paragraphs.mark_repeats(spark, docs).collect()
        assert len(got) == len(rows) + 3
        for r in got:
            removed = {i for x in r["_spans"] for i in range(x["first"], x["last"])}
            assert removed == gone.get(r["doc_id"], set()), (group, r["doc_id"])
            assert r["n_removed"] == len(removed) and set(r["repeats_of"]) == of.get(r["doc_id"], set())
    assert sum(map(len, gone.values())) > 1000
    left = {r["doc_id"]: r["text"] for r in paragraphs.remove_repeats(spark, docs).collect()}
    for d, t in rows:
        assert left[d].split() == [w for i, w in enumerate(t.split()) if i not in gone[d]]
    assert left[900] is None and left[901] == ""


def test_passages_inside_and_across_lines_are_caught(spark):
    rng = random.Random(5)
    words = [f"w{i}" for i in range(5000)]
    passage = rng.choices(words, k=60)
    rows = []
    for d in range(40):
        w = rng.choices(words, k=rng.randrange(150)) + (passage if d % 2 else []) + rng.choices(words, k=rng.randrange(20, 150))
        rows.append((d, " ".join(x + rng.choice([""] * 12 + ["\n"]) for x in w)))
    got = {r["doc_id"]: r for r in paragraphs.mark_repeats(spark, spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all(1 in got[d]["repeats_of"] and got[d]["n_removed"] <= 60 for d in range(3, 40, 2))
    assert all(not got[d]["classes"] for d in range(0, 40, 2)) and got[1]["n_removed"] == 0 and got[1]["classes"]


def test_grow_links_connects_like_all_pairs():
    rng = random.Random(3)
    base = [str(rng.randrange(50)) for _ in range(60)]
    texts = []
    for _ in range(80):
        w = list(base)
        for _ in range(rng.randrange(6)):
            w[rng.randrange(len(w))] = "z"
        texts.append(" ".join(w))
    links = paragraphs.grow_links(texts)
    assert len(links) < len(texts)
    up = list(range(len(texts)))
    for _ in range(90):
        for i, j in links:
            up[i] = up[j] = min(up[i], up[j])
    sets = [set(paragraphs.shingles(t).tolist()) for t in texts]
    for i in range(80):
        for j in range(i):
            if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]):
                assert up[i] == up[j]
    assert np.unique(up).size >= 1


def test_empty(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert paragraphs.mark_repeats(spark, docs).count() == 0


def test_short_paragraphs_and_odd_ids(spark):
    near = [f"w{i}" for i in range(20)]
    texts = ["One line\nof.\n\n" + " ".join(near), " one  LINE\nof.\n \nalone", "of.\nOne\n" + " ".join([*near[:-1], "x"]), "a b c d e\na b c d", "a b c d"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: (r["n_removed"], r["repeats_of"], r["short"]) for r in paragraphs.mark_repeats(spark, docs).collect()}
    assert got == {0: (0, [], ["0:0", "0:2"]), 1: (0, [], ["0:0", "0:2"]), 2: (20, [0], ["0:2"]), 3: (0, [], ["3:5"]), 4: (4, [3], [])}
    odd = spark.createDataFrame([(None, " ".join(near)), ("x7", " ".join(near) + "!"), ("7", " ".join(near)), (None, " ".join(near))], "doc_id string, text string")
    got = [(r["doc_id"], r["n_removed"], r["repeats_of"]) for r in paragraphs.mark_repeats(spark, odd).collect()]
    assert sorted(got, key=str) == sorted([(None, 20, [7]), (None, 20, [7]), ("7", 0, []), ("x7", 20, [7])], key=str)


def test_cutting_spans():
    text = "a b\nc d  e\n\nf g"
    for spans, left in (([], text), ([(0, 2)], "c d  e\n\nf g"), ([(1, 2)], "a\nc d  e\n\nf g"), ([(2, 3), (4, 5)], "a b\nd\n\nf g"), ([(5, 7)], "a b\nc d  e\n\n"), ([(0, 7)], "")):
        assert paragraphs.without_spans(text, spans) == left, spans
