"""The pipeline against brute force, stage by stage and whole."""

import corpus_pipeline as cp
from pyspark.sql import functions as F

from geosieve.llm import mixing, quality, secrets
from geosieve.llm.common import documents, labels

from .test_neardup import brute
from .test_tokens import check_packing

SF = "/root/testdata/sf0.01"


def redacted(text, encode):
    out, at = "", 0
    for kind, a, b in secrets.find_secrets(text, encode):
        if kind == "hex" and b - a in (32, 40, 56, 64, 96, 128):
            continue
        if a >= at:
            out += text[at:a] + "[SECRET]"
        at = max(at, b)
    return out + text[at:]


def test_stages_and_run(spark):
    docs = documents(spark, SF)
    columns, encode = docs.columns, secrets.load_encoding()
    rows = {r.doc_id: r for r in docs.collect()}

    # quality: the compiled rules' decisions, and labelled clean documents stay
    good = cp.keep_good(spark, docs, SF).cache()
    assert good.columns == columns
    stay = {r.doc_id for r in good.collect()}
    known = {r.doc_id: r.quality for r in labels(spark, SF).collect()}
    assert sum(d in stay for d, q in known.items() if q) >= 0.98 * sum(known.values())
    assert sum(d in stay for d, q in known.items() if not q) <= 0.1 * sum(1 - q for q in known.values())

    # near duplicates: the smallest id of each brute-force component
    distinct = cp.keep_distinct(spark, good, SF).cache()
    assert distinct.columns == columns
    want = {d for d, (_, c) in brute([(d, rows[d].text) for d in stay]).items() if d == c}
    assert {r.doc_id for r in distinct.collect()} == want

    # secrets: every document, its text redacted one by one
    hidden = cp.hide_secrets(spark, distinct, SF).cache()
    assert hidden.columns == columns and hidden.dtypes == docs.dtypes
    clean = {d: redacted(rows[d].text, encode) for d in want}
    assert {r.doc_id: (r.text, r.n_chars) for r in hidden.collect()} == {d: (t, len(t) if t != rows[d].text else rows[d].n_chars) for d, t in clean.items()}
    assert any("[SECRET]" in t for t in clean.values())

    # mixing: the operator's own decisions over exactly these rows
    mixed = cp.sample_mixture(spark, hidden, SF).cache()
    assert mixed.columns == columns
    sampled = {r.doc_id for r in mixing.mix_documents(hidden).where("mix_sampled").collect()}
    assert {r.doc_id for r in mixed.collect()} == sampled and 0.4 * len(want) < len(sampled) < len(want)

    # packing, and run() does all of it
    packed = cp.run(spark, SF).collect()
    used, least = check_packing(packed, [(r.doc_id, r.text) for r in mixed.collect()])
    assert used <= 1.01 * least + 1


def test_odd_rows(spark):
    odd = [(1, None, "en", "src0", 0), (2, "", None, None, None), (3, "a b c d e f", "en", "src1", 11), (4, "A b c d e f", "en", "src1", 11), (None, "token = abcdefghijkl1234", "en", "src2", 24), (5, "x" * 100_000, "en", "src0", 100_000)]
    docs = spark.createDataFrame(odd, documents(spark, SF).schema)
    for frame in (docs, docs.union(docs), docs.limit(0)):
        for _, stage in cp.STAGES[:-1]:
            assert stage(spark, frame, SF).columns == docs.columns
        assert cp.pack_sequences(spark, frame, SF).count() >= frame.count()
    assert sorted(r.doc_id or 0 for r in cp.keep_distinct(spark, docs, SF).collect()) == [0, 1, 2, 3, 5]
    again = docs.union(docs).union(spark.createDataFrame([(3, "another text than the first one", "en", "src1", 31)], docs.schema))
    assert sorted(r.doc_id or 0 for r in cp.keep_distinct(spark, again, SF).collect()) == [0, 0, 1, 2, 3, 3, 5]
    hidden = cp.hide_secrets(spark, docs, SF).where(F.col("doc_id").isNull()).first()
    assert (hidden.text, hidden.n_chars) == ("[SECRET]", 8)
    assert quality.THRESHOLD == 0.3
