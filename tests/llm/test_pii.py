"""Spans against Python's regular expressions; reliabilities and the classifier on planted votes."""

import hashlib
import random
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from cohortbench.llm import pii
from cohortbench.llm.queries import op2_pii_spans

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, d in enumerate(map(int, reversed(digits))):
        d = d * 2 - 9 * (d > 4) if i % 2 else d
        total += d
    return total % 10 == 0


def base(text):
    out = []
    for i, (kind, pattern) in enumerate(PLAIN.items()):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            ok = {"email": True, "ip": all(int(p) <= 255 for p in m[0].split(".")) if kind == "ip" else True,
                  "card": 14 <= len(digits) <= 19 and luhn(digits), "phone": 10 <= len(digits) <= 15}[kind]
            if ok:
                out.append((m.start(), i, m.end()))
    return sorted(out)


TEXTS = [
    "", None, "mail a@b.c_x@d.e.f and x@y", "a@b..c@d.e", "1.2.3.4.5.6.7.8 256.1.1.1 007.0.0.255 1.2.3",
    "4111 1111 1111 1111 and 4111-1111-1111-1111, 4111  1111", "+1 (555) 555-0100 +49.30.123456-7) +1 555",
    "\U0001F600é 4111111111111111 \U0001F600 +1 555 555 0100x a@b.com", "+1 4111 1111 1111 1111", "9" * 30_000,
    "a" * 30_000 + "@b.com", "1" + "-2" * 20_000, "a@" + "b." * 20_000 + "c", "+1" + "(" * 20_000 + "2",
    "x.y@z.com" * 300, "0.0.0.0 1.1.1.1\n2.2.2.2", "++1 555 555 0100", "12345678901234", "4222222222222222222",
]


def found(spark, texts):
    rows = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, spans string")
    model = pii.Model(-1000.0, (0.0,) * 6, (0.0,) * 6, (0.0,) * 4, (0.0,) * 5)
    got = pii.spans_of(rows, model).collect()
    return {r["__row"]["doc_id"]: [(s["start"], s["kind"], s["end"]) for s in r["spans"]] for r in got}


def test_base_spans(spark):
    got = found(spark, TEXTS)
    for i, t in enumerate(TEXTS):
        assert got[i] == base(t), (t or "")[:60]


def test_random_texts(spark):
    rng = random.Random(2)
    bits = ["a", "@", ".", "b-c", "1", "25", "256", "4111111111111111", " ", "-", "+", "(", ")", "é", "x", "\n", "0", "42"]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randint(1, 60))) for _ in range(600)]
    got = found(spark, texts)
    for i, t in enumerate(texts):
        assert got[i] == base(t), t


@given(st.text(alphabet="a@.1 -+()", max_size=40))
@settings(max_examples=300, deadline=None)
def test_rewritten_patterns_match_alike(text):
    for kind, pattern in PLAIN.items():
        mine = pii.BASE[kind].replace(r"|\G", "")
        spans, at = [], 0
        while m := re.compile(mine if kind != "email" else pattern).search(text, at):
            spans.append(m.span())
            at = m.end()
        assert spans == [m.span() for m in re.finditer(pattern, text)]


def test_wide_spans_join_if_the_votes_are_for_them(spark):
    texts = ["phone: (555) 555-0100 ok"] * 3 + ["+1 555 555 0100"] * 30 + ["order no 4111 1111 1111 1112 and so on"] * 30
    texts += ["write to jo [at] site [dot] com please"]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["__row"]["doc_id"]: pii.KINDS[r["spans"][0]["kind"]] if r["spans"] else None
           for r in pii.spans_of(rows).collect()}
    assert got[0] == "phone" and got[3] == "phone" and got[40] is None and got[63] == "email"


def test_reliabilities_find_the_bad_labeler():
    rng = random.Random(1)
    counts = {}
    for _ in range(4000):
        truth = rng.random() < 0.4
        votes = tuple((1 if (rng.random() < r) == truth else -1) for r in (0.95, 0.9, 0.9, 0.55, 0.85, 0.8))
        key = (0, votes, 1)
        counts[key] = counts.get(key, 0) + 1
    soft, prior, right = pii.reliabilities(counts)
    assert abs(prior[0] - 0.4) < 0.05 and right[0, 3] < 0.65 < 0.9 < right[0, 0]
    model = pii.train(counts)
    agree = sum(n for key, n in counts.items() if (model.features(*key) >= 0) == (soft[key] >= 0.5))
    assert agree > 0.97 * 4000
    assert pii.train({}).bias == 0


def test_redaction(spark, odd_docs, no_docs):
    texts = ["mail a@b.com now", "+1 4111 1111 1111 1111", "nothing", None, "\U0001F600 1.2.3.4, 1.2.3.5"]
    rows = spark.createDataFrame([(i, t, len(t or ""), "k") for i, t in enumerate(texts)],
                                 "doc_id long, text string, n_chars long, spans string")
    got = {r["doc_id"]: r for r in pii.redact(rows).collect()}
    assert got[0]["text"] == "mail <email> now" and got[0]["n_chars"] == 16 and got[0]["spans"] == "k"
    assert "4111" not in got[1]["text"] and got[2]["text"] == "nothing" and got[3]["text"] is None
    assert got[4]["text"] == "\U0001F600 <ip>, <ip>"
    odd = pii.redact(odd_docs)
    assert odd.columns == odd_docs.columns and odd.count() == odd_docs.count()
    assert odd.where("doc_id = 6").first()["text"].endswith("b\u00fccher.example.org mail <email>")
    assert pii.redact(no_docs).count() == 0


@pytest.mark.parametrize("sf", ["/root/testdata/sf0.001"])
def test_query(spark, sf):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = op2_pii_spans(spark, sf).collect()
    assert len(rows) == len(texts)
    for r in rows:
        want = base(texts[r["doc_id"]])
        line = ",".join(f"{pii.KINDS[k]}:{a}:{b}" for a, k, b in want)
        assert r["base_sha256"] == hashlib.sha256(line.encode()).hexdigest()
        assert [r[f"n_{k}"] for k in pii.KINDS] == [sum(k == x for _, x, _ in want) for k in range(4)]
        assert set(filter(None, line.split(","))) <= set(r["spans"].split(","))
