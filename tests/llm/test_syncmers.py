"""Fingerprints against plain Python."""

import hashlib
import itertools
import random
import string
import struct

import regex
import xxhash
from pyspark.sql import functions as F

from geosieve.llm import syncmers
from geosieve.llm.common import documents


def test_query(spark):
    rows = syncmers.op8_syncmer_fingerprints(spark, "/root/testdata/sf0.01").collect()
    docs = sorted((r.doc_id, r.text or "") for r in documents(spark, "/root/testdata/sf0.01").collect())
    assert sorted(r.doc_id for r in rows) == [d for d, _ in docs]
    got = {r.doc_id: r for r in rows}
    for i, (d, t) in enumerate(docs):
        half = len(t) // 2
        edited = t[: len(t) - half] + docs[(i + 1) % len(docs)][1][:half]
        assert got[d].n_chars == len(t) and got[d].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
    prints = {}
    for d, t in docs:
        assert prints.setdefault(t, got[d].fingerprint) == got[d].fingerprint
    edited = sorted(r.near_edited for r in rows if r.n_chars > 300)
    following = sorted(r.near_next for r in rows if r.n_chars > 300)
    assert 0.2 < edited[len(edited) // 2] < 0.6 and following[len(following) // 2] < 0.05


def test_next_over_many_buckets(spark, monkeypatch):
    monkeypatch.setattr(syncmers, "ROWS_PER_BUCKET", 3)
    monkeypatch.setattr(syncmers, "COARSE", 4)
    rows = [(i * i, f"t{i}") for i in range(100)] + [(None, "n")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    got = {r.text: r.next_text for r in syncmers.with_next(df, "doc_id", ["text"]).collect()}
    assert got == {"n": "t0", "t99": "n"} | {f"t{i}": f"t{i + 1}" for i in range(99)}


def test_next_with_few_cuts_and_hot_ids(spark, monkeypatch):
    """Few cuts and finer buckets between them: a third of rows without an id, a third under one id, ids far apart, repeated rows."""
    monkeypatch.setattr(syncmers, "ROWS_PER_BUCKET", 4)
    monkeypatch.setattr(syncmers, "MOST_CUTS", 5)
    monkeypatch.setattr(syncmers, "COARSE", 2)
    rows = [(None, f"n{i}") for i in range(100)] + [(7, f"h{i}") for i in range(100)] + [(i**9 - 10**12, f"t{i}") for i in range(90)] + [(50, "same")] * 10
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    kept = df.withColumn("h", F.xxhash64("text")).collect()
    want = [r.text for r in sorted(kept, key=lambda r: (r.doc_id is not None, r.doc_id or 0, r.h))]
    got = sorted((r.text, r.next_text) for r in syncmers.with_next(df, "doc_id", ["text"]).collect())
    assert got == sorted(zip(want, want[1:] + want[:1]))


def test_syncmers_are_context_free(spark):
    words = [f"word{i * 7919 % 1000}" for i in range(200)]
    texts = [" ".join(words), "other start " + " ".join(words[50:150]) + " other end"]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    a, b = (r.a for r in syncmers.with_anchors(df, "text", "a", places=True).orderBy(df.text.desc()).collect())
    inner = [(x.unit, x.hash) for x in a if 50 <= x.unit <= 146]
    assert inner == [(x.unit + 48, x.hash) for x in b if 2 <= x.unit <= 98] and 30 < len(inner) < 70


def test_odd_rows(spark):
    odd = [(1, None, 5), (2, "", 5), (2, "", 5), (3, " \n", 5), (4, "one", 5), (None, "a" * 100_000, 5), (5, "b " * 50_000, None)]
    df = spark.createDataFrame(odd, "doc_id long, text string, own int")
    got = syncmers.with_fingerprint(df, "text", "own").collect()
    assert len(got) == 7 and [len(r.own) for r in got if r.doc_id in (1, 2, 3)] == [0] * 4
    one = syncmers.with_next(df.where("doc_id = 4"), "doc_id", ["text"]).collect()
    assert [r.next_text for r in one] == ["one"]
    assert sorted(str(r.next_text)[:3] for r in syncmers.with_next(df.fillna(""), "doc_id", ["text"]).collect()) == sorted(str(t or "")[:3] for _, t, _ in odd)
    assert syncmers.with_next(df.limit(0), "doc_id", ["text"]).count() == 0


def test_passage_of_a_long_text_is_found_in_place(spark):
    word = lambda kind, i: f"{kind}{i * 7919 % 100_003}"
    passage = [word("p", i) for i in range(50)]
    long = [word("a", i) for i in range(20_000)]
    long[15_000:15_000] = passage
    df = spark.createDataFrame([(" ".join(long), " ".join([word("b", i) for i in range(30)] + passage))], "a string, b string")
    df = syncmers.with_fingerprint(syncmers.with_fingerprint(df, "a", "fa"), "b", "fb")
    r = df.select("fa", "fb", syncmers.likeness(syncmers.hashes(df.fa), syncmers.hashes(df.fb)).alias("near")).first()
    places = {x.hash: x.unit for x in r.fa}
    matched = [(x.unit, places[x.hash]) for x in r.fb if x.unit >= 30]
    assert len(r.fa) > 8_000 and len(matched) > 10 and all(b - a == 14_970 for a, b in matched) and r.near > 0


def test_query_keeps_all_anchors(spark):
    rows = syncmers.op8_syncmer_fingerprints(spark, "/root/testdata/sf0.001").collect()
    texts = {r.doc_id: r.text or "" for r in documents(spark, "/root/testdata/sf0.001").collect()}
    for r in rows:
        places = [u for u, _ in read(r.fingerprint)]
        assert places == sorted(set(places)) and len(places) >= 0.3 * (len(texts[r.doc_id].split()) - 30)
    jaccard = lambda a, b: len(a & b) / len(a | b) if a | b else 1.0
    assert all(abs(r.near_edited - jaccard({x for _, x in read(r.fingerprint)}, {x for _, x in read(r.edited_fingerprint)})) < 1e-9 for r in rows)


def test_runs_without_spaces_are_context_free(spark):
    rng = random.Random(5)
    runs = ["".join(rng.choices(letters, k=400)) for letters in ("天地玄黄宇宙洪荒日月盈昃辰宿列张寒来暑往秋收冬藏", "アイウエオカキクケコサシスセソ", string.ascii_letters + string.digits + "+/", "<>/abcdef=")]
    for before, after in (("x", ""), ("天", "地"), ("xy and ", " end"), ("http", "z" * 20)):
        rows = [(i, run, before + run + after) for i, run in enumerate(runs)]
        df = spark.createDataFrame(rows, "i int, a string, b string")
        for r in syncmers.with_fingerprint(syncmers.with_fingerprint(df, "a", "fa"), "b", "fb").collect():
            there = {(x.unit, x.hash) for x in r.fb}
            shift = {"x": 1, "天": 1, "xy and ": 2, "http": 4}[before]
            assert len(r.fa) > (100 if r.i < 2 else 30) and all((x.unit + shift, x.hash) in there for x in r.fa)
    short = ["天地玄黄宇宙洪荒", "日月 天地玄黄宇宙洪荒 寒来"]  # a run of few letters reads as in a longer one
    a, b = (r.f for r in syncmers.with_fingerprint(spark.createDataFrame(enumerate(short), "i int, t string"), "t", "f").orderBy("i").collect())
    assert {(x.unit + 2, x.hash) for x in a} <= {(x.unit, x.hash) for x in b}


def test_short_texts_have_anchors(spark):
    words = "one two three four five six seven eight nine ten eleven twelve".split()
    texts = [" ".join(p) for p in itertools.islice(itertools.permutations(words, 4), 0, 4000, 37)]
    df = spark.createDataFrame([(a, b) for a, b in itertools.pairwise(texts)] + [(texts[0], ""), ("", None)], "a string, b string")
    df = syncmers.with_fingerprint(syncmers.with_fingerprint(df, "a", "fa"), "b", "fb")
    for r in df.withColumn("near", syncmers.likeness(syncmers.hashes(df.fa), syncmers.hashes(df.fb))).collect():
        assert bool(r.fa) == bool(r.a) and (r.near == 1.0) == (not r.a and not r.b)


UNPARTED = "".join(rf"\p{{Script={s}}}" for s in ("Han", "Hiragana", "Katakana", "Thai", "Lao", "Khmer", "Myanmar"))
SPACE = r"[ \t\n\x0B\f\r]"
UNITS = regex.compile(rf"(?<![^ \t\n\x0B\f\r])[^ \t\n\x0B\f\r{UNPARTED}]{{1,24}}+(?![^ \t\n\x0B\f\r])|[^ \t\n\x0B\f\r]")


def hashed(xs, seed=42):
    for x in xs:
        seed = xxhash.xxh64_intdigest(struct.pack("<q", x), seed)
    return seed - (1 << 64) if seed >> 63 else seed


def anchors(text):
    """(unit, hash) of the closed syncmers, one after the other; of words and of all single letters if there are none."""
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    units = UNITS.findall(text)
    single = [len(u) == 1 and ord(u) < 0x0800 for u in units]
    h = [signed(xxhash.xxh64_intdigest(u.encode(), 42)) & -2 | one for u, one in zip(units, single)]
    out = []
    for i in range(len(h) - 3):
        if not all(single[i : i + 4]):
            if min(h[i], h[i + 3]) <= min(h[i + 1], h[i + 2]):
                out.append((i, hashed(h[i : i + 4]) & 0xFFFFFFFF))
        elif i + 24 <= len(h) and all(single[i : i + 24]):
            g = [hashed(h[j : j + 9]) for j in range(i, i + 16)]
            if min(g[0], g[15]) <= min(g):
                out.append((i, hashed([g[0], g[8], g[15]]) & 0xFFFFFFFF))
    letters = [x for x, one in zip(h, single) if one]
    return out or sorted([(i, x & 0xFFFFFFFF) for i, (x, one) in enumerate(zip(h, single)) if not one] + [(single.index(True), hashed(letters) & 0xFFFFFFFF) for _ in range(bool(letters))])


def read(fingerprint):
    """The (unit, hash) pairs of a fingerprint as a string."""
    return [divmod(int(p), 1 << 32) for p in fingerprint.split(",") if p]


def test_unrelated_texts_of_few_letters(spark):
    """Independent texts of a small alphabet aren't alike, whatever their length, and a text cut in two stays like its parts."""
    rng = random.Random(9)
    kinds = [("ACGT", 3000), ("01", 3000), ("0123456789", 30_000), ("0123456789abcdef", 30_000), ("0123456789abcdef", 40), ("01", 30)]
    make = lambda letters, n: "".join(rng.choices(letters, k=n))
    rows = [(make(*k), make(*k)) for k in kinds] + [tuple(" ".join(make("0123456789abcdef", 32) for _ in range(900)) for _ in "ab")]
    df = spark.createDataFrame(rows, "a string, b string").withColumn("c", F.substring("a", 1, 20_000))
    for c in "abc":
        df = syncmers.with_anchors(df, c, f"f{c}")
    for r in df.select("a", "c", syncmers.likeness(df.fa, df.fb).alias("near"), syncmers.likeness(df.fa, df.fc).alias("part")).collect():
        assert r.near < 0.05, (r.a[:30], len(r.a), r.near)
        assert r.part > 0.6


def test_query_by_hand(spark):
    """All columns of the query again, without Spark."""
    jaccard = lambda a, b: len(a & b) / len(a | b) if a | b else 1.0
    docs = sorted((r.doc_id, r.text or "") for r in documents(spark, "/root/testdata/sf0.01").collect())
    rows = {r.doc_id: r for r in syncmers.op8_syncmer_fingerprints(spark, "/root/testdata/sf0.01").collect()}
    assert len(rows) == len(docs)
    for i, (d, t) in enumerate(docs):
        after, half, r = docs[(i + 1) % len(docs)][1], len(t) // 2, rows[d]
        edited = t[: len(t) - half] + after[:half]
        own, other = anchors(t), anchors(edited)
        assert read(r.fingerprint) == own and read(r.edited_fingerprint) == other
        assert (r.n_chars, r.edited_sha256) == (len(t), hashlib.sha256(edited.encode()).hexdigest())
        hashes = [{h for _, h in x} for x in (own, other, anchors(after))]
        assert abs(r.near_edited - jaccard(*hashes[:2])) < 1e-12 and abs(r.near_next - jaccard(hashes[0], hashes[2])) < 1e-12
