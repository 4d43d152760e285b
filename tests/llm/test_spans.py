"""Secrets and personal data against the plain patterns of their contracts."""

import hashlib
import itertools
import random
import re
import string

from hypothesis import given, settings
from hypothesis import strategies as st

from geosieve.llm import pii, secrets

ASSIGN = re.compile(r"""((?ai:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
PIECES = st.lists(
    st.sampled_from(
        ["token=", "Api_Key: '", "secret", "PASSWORD", ":", " ", "=", "AKIA", "ABCDEFGHIJKLMN", "AKIAX", "0123456789abcdef", "deadbeef", "xK9", "q" * 30, ".", "@", "a.b", "%", "-", "+1", "4111 1111 1111 1111", "4111111111111111", "(555)", "1.2.3.4", "255", "256", "007", "0000999", "0000300", "1.2.3.", "\n", "é", "ſ", "１", "mail", "DE89370400440532013000", "ssn 123-45-6789"]
    ),
    max_size=14,
).map("".join)


def base_secrets(t):
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(t) if len(m[2]) >= 12]
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 18]
    out += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 16]
    return [(secrets.KINDS[k], a, b) for a, k, b in sorted(out)]


def base_pii(t):
    digits = lambda s: re.sub("[^0-9]", "", s)
    out = [("email", *m.span()) for m in EMAIL.finditer(t)]
    out += [("ip", *m.span()) for m in IP.finditer(t) if all(int(x) <= 255 for x in m[0].split("."))]
    out += [("card", *m.span()) for m in CARD.finditer(t) if 13 <= len(digits(m[0])) <= 19 and pii.luhn(digits(m[0]))]
    return out + [("phone", *m.span()) for m in PHONE.finditer(t) if 9 <= len(digits(m[0])) <= 15]


ENCODE = secrets.load_encoding()


@settings(max_examples=600, deadline=None)
@given(PIECES)
def test_base_spans_follow_the_patterns(t):
    assert [s for s in secrets.find_secrets(t, ENCODE) if s[0] != "random"] == base_secrets(t)
    assert [s[:3] for s in pii.find_pii(t) if s[0] in pii.BASE_KINDS] == base_pii(t)


def test_method_adds_and_excludes():
    found = lambda t: [s[0] for s in secrets.find_secrets(t, ENCODE)]
    assert found("key zQ8vT1xLp0RkW7mYb3Hn5cJd here") == ["random"]
    assert found("a_plain_snake_case_identifier and Uberraschungsgesellschaft and someCamelCaseIdentifier") == []
    assert found("550e8400-e29b-41d4-a716-446655440000") == []
    assert "random" not in found(hashlib.sha256(b"x").hexdigest())
    assert found("data:image/png;base64,zQ8vT1xLp0RkW7mYb3Hn5cJdzQ8vT1xLp0RkW7mYb3Hn5cJd") == []
    assert [s[0] for s in pii.find_pii("iban DE89 3704 0044 0532 0130 00")] == ["iban"]
    assert pii.find_pii("iban DE88 3704 0044 0532 0130 00") == []
    assert [s[0] for s in pii.find_pii("his ssn 123-45-6789")] == ["national_id"] and pii.find_pii("part 123-45-6789") == []


def test_long_texts_take_linear_time():
    for t in ("a" * 300_000, "1" * 300_000, "1." * 150_000, "+" * 300_000, "token=" * 50_000, "@" * 300_000, "a@" * 100_000):
        secrets.find_secrets(t, lambda s: range(len(s)))
        pii.find_pii(t)


def test_frames(spark):
    rows = [(1, None, "x"), (2, "", "x"), (3, "token = abcdefghijkl1234 é", "x"), (3, "token = abcdefghijkl1234 é", "x"), (None, "a@b.co 10.0.0.1", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, secret_spans string")
    got = {(r.doc_id, r.text): r for r in secrets.redact(secrets.scan_secrets(df)).collect()}
    assert len(got) == 4 and got[(3, "[SECRET] é")].secret_spans[0].start == 0 and got[(1, None)].secret_spans == []
    assert sorted(len(r.pii_spans) for r in pii.scan_pii(df).collect()) == [0, 0, 0, 0, 2]
    assert secrets.scan_secrets(df.limit(0)).count() == pii.scan_pii(df.limit(0)).count() == 0


def test_queries(spark):
    from geosieve.llm.common import documents

    texts = {r.doc_id: r.text for r in documents(spark, "/root/testdata/sf0.001").collect()}
    sha = lambda s: hashlib.sha256(",".join(":".join(map(str, x)) for x in s).encode()).hexdigest()
    a = secrets.op2_secret_scan(spark, "/root/testdata/sf0.001").collect()
    b = pii.op3_pii(spark, "/root/testdata/sf0.001").collect()
    assert len(a) == len(b) == len(texts)
    assert all(r.base_sha256 == sha(base_secrets(texts[r.doc_id])) for r in a)
    assert all(r.base_sha256 == sha(base_pii(texts[r.doc_id])) for r in b)


def test_letter_runs_without_words_are_found():
    rng = random.Random(3)
    found = lambda x: any(k == "random" for k, _, _ in secrets.find_secrets(f"see {x} here", ENCODE))
    for letters, n, end, least in ((string.ascii_lowercase, 32, "", 0.7), (string.ascii_uppercase, 32, "", 0.7), (string.ascii_letters, 22, "42", 0.9)):
        assert sum(found("".join(rng.choices(letters, k=n)) + end) for _ in range(500)) >= least * 500
    words = {
        "en": "between through another children government together important something",
        "de": "zwischen gesellschaft verantwortung entwicklung wissenschaft regierung geschichte",
        "fr": "toujours gouvernement connaissance ensemble aujourd developpement maintenant",
        "es": "siempre gobierno conocimiento desarrollo entonces importante mientras",
    }
    for text in words.values():
        for chosen in itertools.permutations(text.split(), 3):
            assert not any(found(j(chosen)) for j in ("_".join, "".join, lambda w: "_".join(w).upper(), lambda w: "/".join(w) + "42"))


def random_spans(text):
    """The spans that the token test adds, one run after the other with the rules written out anew."""
    out = []
    for m in re.finditer(r"[A-Za-z0-9+/_=-]+", text):
        run = m[0]
        if len(run) < 20 or text[: m.start()].endswith(";base64,"):
            continue
        if len(run) in (32, 40, 56, 64, 96, 128) and (set(run) <= set("0123456789abcdef") or set(run) <= set("0123456789ABCDEF")):
            continue
        if re.fullmatch(r"[0-9A-Fa-f]{8}-([0-9A-Fa-f]{4}-){3}[0-9A-Fa-f]{12}.*", run, re.S) and len(run) == 36:
            continue
        parts = re.split("[-_/+=]", run)
        named = all(re.fullmatch("[A-Z]?[a-z]*|[A-Z]+|[0-9]+|[A-Za-z]+[0-9]{1,4}", p) for p in parts)
        for p in parts:
            word = p.rstrip("0123456789")
            if len(word) >= 12 and word.lower() != word and word.upper() != word and len(re.findall("[A-Z]?[a-z]+|[A-Z]+", word)) * 3 > len(word):
                named = False
        letters = "".join(c for c in run if c.isalpha() and c.isascii()).lower()
        if named and (len(letters) < 12 or len(letters) / len(ENCODE(letters)) > 1.8):
            continue
        if len(run) / len(ENCODE(run)) <= 2.2:
            out.append(("random", *m.span()))
    return out


RUNS = st.lists(
    st.one_of(st.text("abcdefghijklmnopqrstuvwxyz", max_size=30), st.text(string.ascii_letters + string.digits + "+/=_-", max_size=40), st.sampled_from([" ", "_", "government", "Children", "HTTP", "data:x;base64,", "0123456789abcdef" * 2, "550e8400-e29b-41d4-a716-446655440000"])),
    max_size=8,
).map("".join)


@settings(max_examples=400, deadline=None)
@given(RUNS)
def test_added_spans_follow_the_token_test(t):
    assert [s for s in secrets.find_secrets(t, ENCODE) if s[0] == "random"] == random_spans(t)


def scored(text):
    """Added kinds and all scores by the rules written out anew: prior, +0.25 for a context word, -0.3 for a contrary one."""
    spans = [(k, *s) for k, *s in base_pii(text)]
    for m in re.finditer(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}(?![A-Za-z0-9])", text):
        iban = m[0].replace(" ", "")
        number = "".join(str("0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ".index(c)) for c in iban[4:] + iban[:4])
        if 15 <= len(iban) <= 34 and int(number) % 97 == 1:
            spans.append(("iban", *m.span()))
    spans += [("national_id", *m.span()) for m in re.finditer(r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])", text)]
    out = []
    for kind, a, b in spans:
        near = f"{text[max(0, a - 40) : a]} {text[b : b + 40]}".lower()
        good, bad = (any(w in near for w in words[kind]) for words in (pii.CONTEXT, pii.CONTRARY))
        score = round(min(1.0, max(0.0, pii.PRIOR[kind] + 0.25 * good - 0.3 * bad)), 4)
        if kind != "national_id" or score > 0.3:
            out.append((kind, a, b, score))
    return out


@settings(max_examples=600, deadline=None)
@given(PIECES)
def test_added_kinds_and_scores(t):
    assert pii.find_pii(t) == scored(t)


def test_digests_stay(spark):
    sha, key = hashlib.sha256(b"x").hexdigest(), "deadbeef" * 3
    df = spark.createDataFrame([(1, f"commit {sha} and {key}"), (2, f"secret={sha}")], "doc_id long, text string")
    got = {r.doc_id: r.text for r in secrets.redact(secrets.scan_secrets(df)).collect()}
    assert got == {1: f"commit {sha} and [SECRET]", 2: "[SECRET]"}
