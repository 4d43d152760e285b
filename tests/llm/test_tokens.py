"""Token counts and packing against the library and against a round trip."""

import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from geosieve.llm import packing, tokencount
from geosieve.llm.common import documents

WORD = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
BYTE = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
TEXTS = st.one_of(
    st.text(max_size=40),
    st.lists(
        st.sampled_from(["<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "<|", "Don't", "'S", "ΣΑΣ", "İ", "é", "é", " ", "\n", "\x1c", "\x85", "　", "12", "½", "Ⅷ", "²", "_", "!!", "a", "ﬁ", "ſ", "the ", "  x", "क्षि", "🙂"]),
        max_size=12,
    ).map("".join),
)
LENGTHS = tokencount.Lengths({})
ENCODE = packing.load_encoder()


@settings(max_examples=500, deadline=None)
@given(TEXTS)
def test_library_counts(t):
    assert LENGTHS.count([t]) == [len(WORD.encode(t, add_special_tokens=False).ids)]
    assert ENCODE(t) == BYTE.encode(t, add_special_tokens=False).ids


def test_long_texts():
    for t in ("a" * 50_000, " " * 50_000, "!" * 50_000, "ab " * 30_000, "é" * 20_000):
        assert LENGTHS.count([t]) == [len(WORD.encode(t, add_special_tokens=False).ids)]
        assert ENCODE(t) == BYTE.encode(t, add_special_tokens=False).ids


def test_token_query(spark):
    texts = {r.doc_id: r.text for r in documents(spark, "/root/testdata/sf0.001").collect()}
    for r in tokencount.op5_token_counts(spark, "/root/testdata/sf0.001").collect():
        n = len(WORD.encode(texts[r.doc_id], add_special_tokens=False).ids)
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(texts[r.doc_id].encode()), n, n > 2048)


def check_packing(rows, texts):
    """Every document is whole again, every sequence gapless and within the capacity."""
    sequences, pieces = defaultdict(list), defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
        pieces[r.doc_id].append((r.piece, r.start, r.length, r.ids_crc32))
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 1024
    want = Counter()
    for d, t in texts:
        ids = np.array([*BYTE.encode(t or "", add_special_tokens=False).ids, 2], "<u4")
        first = (len(ids) - 1) % 1024 + 1
        at = [0, *range(first, len(ids), 1024), len(ids)]
        want.update((d, i, s, e - s, zlib.crc32(ids[s:e].tobytes())) for i, (s, e) in enumerate(zip(at, at[1:])))
    assert Counter((d, *p) for d, ps in pieces.items() for p in ps) == want
    return len(sequences), -(-sum(n for *_, n, _ in want.elements()) // 1024)


def test_packing_query(spark):
    texts = [(r.doc_id, r.text) for r in documents(spark, "/root/testdata/sf0.01").collect()]
    used, least = check_packing(packing.op7_best_fit_packing(spark, "/root/testdata/sf0.01").collect(), texts)
    assert used <= 1.005 * least


def test_odd_rows(spark):
    rows = [(1, None), (2, ""), (2, ""), (None, "x y"), (3, "the " * 5000), (3, "the " * 5000), *[(i, "same words here") for i in range(10, 400)]]
    df = spark.createDataFrame([(*r, 0, "x") for r in rows], "doc_id long, text string, length int, sequence_id string")
    check_packing(packing.pack(df).collect(), rows)
    assert packing.pack(df.limit(0)).count() == tokencount.count_tokens(df.limit(0)).count() == 0
    got = tokencount.count_tokens(df.withColumn("n_tokens", df.length)).select("text", "n_tokens").distinct().collect()
    assert {r.text: r.n_tokens for r in got} == {t: LENGTHS.count([t or ""])[0] for _, t in rows}


@pytest.mark.parametrize("seed", range(6))
def test_plans(seed):
    rng = np.random.default_rng(seed)
    lengths = rng.integers(1, [1025, 30, 1025, 600, 1025, 2][seed], [500, 5000, 3, 1000, 2_000, 7][seed])
    histogram = {int(k): int(v) for k, v in Counter(lengths.tolist()).items()}
    plan = packing.best_plan(histogram)
    ranges, n = plan.ranges(), sum(c[0] for o in plan.open for c in o)
    assert plan.taken == histogram
    filled = Counter()
    for i, (s, lo, base, offset) in enumerate(ranges):
        end = ranges[i + 1][1] if i + 1 < len(ranges) and ranges[i + 1][0] == s else histogram[int(s)]
        for q in range(base, base + end - lo):
            filled[q] += int(s)
    assert len(filled) == n and max(filled.values()) <= 1024
    assert n <= best_fit_decreasing(lengths)


def best_fit_decreasing(lengths):
    """How many sequences best-fit decreasing opens, one length after the other."""
    rooms = np.zeros(1025, int)
    for s in sorted(lengths.tolist(), reverse=True):
        at = s + int(np.argmax(rooms[s:] > 0))
        if rooms[at]:
            rooms[at] -= 1
            rooms[at - s] += 1
        else:
            rooms[1024 - s] += 1
    return int(rooms.sum())


@pytest.mark.parametrize("kind", ["uniform", "large", "lognormal", "over a third"])
def test_plans_need_no_more_than_best_fit(kind):
    rng = np.random.default_rng(11)
    lengths = {"uniform": rng.integers(1, 1025, 20_000), "large": rng.integers(342, 700, 20_000), "lognormal": np.clip(rng.lognormal(5.5, 1, 40_000), 1, 1024).astype(int), "over a third": rng.integers(342, 1025, 20_000)}[kind]
    histogram = {int(k): int(v) for k, v in Counter(lengths.tolist()).items()}
    assert packing.best_plan(histogram).sequences() <= best_fit_decreasing(lengths)


def test_other_files_are_refused():
    with pytest.raises(ValueError, match="another way"):
        tokencount.load_tokenizer(public_tokenizers.path("byte_bpe_50k.json"))


def test_samples_stay_bounded_when_ids_repeat(spark, monkeypatch):
    from pyspark.sql import functions as F

    from geosieve.llm.common import labelled_texts

    monkeypatch.setattr(tokencount, "FIT_ROWS", 20)
    df = spark.range(4000).select(F.lit(7).cast("long").alias("doc_id"), F.concat(F.lit("a b word"), "id").alias("text"))
    assert len(tokencount.frequent_lengths(df)) < 100
    known = df.select("doc_id", F.lit(1).alias("good"))
    got = labelled_texts(df, known, "good", F.lit(False), 20).collect()
    assert [(r.doc_id, r.label, r.text) for r in got] == [(7, 1.0, "a b word0")]
