"""Near duplicates against brute force."""

import random

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from geosieve.llm import neardup
from geosieve.llm.common import Scratch, documents


def word_set(text):
    words = text.encode().lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def brute(rows):
    sets = [(d, word_set(t or "")) for d, t in rows]
    root = {d: d for d, _ in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    holders = {}
    for i, (_, s) in enumerate(sets):
        for g in s:
            holders.setdefault(g, []).append(i)
    seen = set()
    for hs in holders.values():
        for k, i in enumerate(hs):
            for j in hs[:k]:
                if (i, j) not in seen:
                    seen.add((i, j))
                    a, b = sets[i][1], sets[j][1]
                    if 100 * len(a & b) >= 75 * len(a | b):
                        x, y = find(sets[i][0]), find(sets[j][0])
                        root[max(x, y)] = min(x, y)
    return {d: (len(s), find(d)) for d, s in sets}


@settings(max_examples=200, deadline=None)
@given(st.text("aAbé \t\n\x0b\x1c\xa0", max_size=60))
def test_shingles(t):
    assert len(neardup.shingle_set(t)) == len(word_set(t))


def test_similar_counts_whole_sets():
    a, b = np.arange(4, dtype=np.uint64), np.arange(3, dtype=np.uint64)
    assert neardup.similar(a, b) and not neardup.similar(a, b[:2]) and not neardup.similar(a[:0], b[:0])


def test_against_brute_force(spark):
    got = neardup.op4_minhash_dedup(spark, "/root/testdata/sf0.01").collect()
    want = brute([(r.doc_id, r.text) for r in documents(spark, "/root/testdata/sf0.01").collect()])
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_chains_copies_and_odd_rows(spark):
    random.seed(5)
    base = [f"w{i}" for i in range(120)]
    rows, words = [], base
    for i in range(40):  # a chain: each near the one before, far from the first
        rows.append((i + 100, " ".join(words)))
        k = random.randrange(len(words))
        words = words[:k] + [f"x{i}"] + words[k + 1 :]
    rows += [(i, " ".join(base).upper()) for i in range(1, 30)]
    rows += [(200, None), (201, ""), (202, " \n"), (203, "one two"), (204, "One  two"), (205, "one")]
    df = spark.createDataFrame([(*r, "x") for r in rows] + [(None, "one two", "x"), (203, "one two", "x")], "doc_id long, text string, component_id string")
    got = neardup.near_duplicates(df).collect()
    want = brute(rows)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got if r.doc_id is not None} == want
    assert [(r.component_id, r.kept) for r in got if r.doc_id is None] == [(None, True)] and len(got) == len(rows) + 2
    assert neardup.near_duplicates(df.limit(0)).count() == 0


def test_texts_that_share_an_id(spark):
    random.seed(8)
    a, b, c = ([f"{k}{i}" for i in range(100)] for k in "abc")
    near = lambda words: words[:50] + ["x"] + words[51:]
    rows = [(1, a), (1, b), (2, near(a)), (3, near(b)), (5, c), (4, c), (5, near(near(c))), (6, b[:50] + a[:50]), (7, a + ["y"]), (7, c[::-1])]
    rows = [(i, " ".join(w)) for i, w in rows] * 2
    for parts in (1, 3, 7):
        df = spark.createDataFrame(rows, "doc_id long, text string").repartition(parts)
        got = {r.doc_id: r.component_id for r in neardup.near_duplicates(df).collect()}
        assert got == {1: 1, 2: 1, 3: 1, 4: 4, 5: 4, 6: 6, 7: 1}


def test_components(spark):
    random.seed(3)
    edges = [(i, i + 1) for i in range(60)] + [(100, 200 + i) for i in range(30)] + [(7, 7)]
    random.shuffle(edges)
    got = dict(neardup.components(Scratch(spark), spark.createDataFrame(edges, "a long, b long")).collect())
    assert got == {i: 0 for i in range(1, 61)} | {200 + i: 100 for i in range(30)}


def test_prefixes_meet_and_common_passages_do_not():
    rng = random.Random(4)
    common = np.zeros(1 << neardup.COMMON_BITS, np.int64)
    for _ in range(300):
        n = rng.choice([1, 2, 4, 5, 20, 21, 100, 333])
        a = np.unique(np.array([rng.getrandbits(64) for _ in range(n)], np.uint64))
        b = np.unique(np.concatenate([a[rng.randrange(2) * n // 9 :], np.array([rng.getrandbits(64) for _ in range(rng.randrange(n // 4 + 2))], np.uint64)]))
        met = [dict(), dict()]
        for x, seen in ((a, met[0]), (b, met[1])):
            token, most = neardup.prefix(x, common)
            at, other = neardup.classes(len(x), most)
            for t, m, c in zip(token[at].tolist(), most[at].tolist(), other.tolist()):
                seen[t, c] = m
        ca, cb = neardup.size_class(len(a)), neardup.size_class(len(b))
        meets = any((t, ca) in met[1] and met[1][t, ca] >= len(a) and m >= len(b) for (t, c), m in met[0].items() if c == cb)
        assert meets or not neardup.similar(a, b)
    # A shared passage of three quarters is told by its counts, and nobody meets through it.
    passage = np.array([rng.getrandbits(64) for _ in range(146)], np.uint64)
    common[(passage >> np.uint64(64 - neardup.COMMON_BITS)).astype(int)] += 50
    token, most = neardup.prefix(np.unique(np.concatenate([passage, np.array([rng.getrandbits(64) for _ in range(44)], np.uint64)])), common)
    assert not set(token[most >= 190].tolist()) & set(passage.tolist())


def test_common_passage_in_many_documents(spark):
    """Texts of one passage and words of their own, under the threshold but in one band, with near copies of some."""
    rng = random.Random(8)
    passage = " ".join(f"p{rng.randrange(10**6)}" for _ in range(150))
    rows = []
    for i in range(120):
        own = [f"w{rng.randrange(10**7)}" for _ in range(40)]
        rows.append((i, f"{passage} {' '.join(own)}"))
        if i % 10 == 0:
            rows.append((1000 + i, f"{passage} {' '.join(own[:-1])} x"))
    got = neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    want = brute(rows)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want
    assert sum(r.kept for r in got) == 120
