"""Base measures against plain Python, and the cascade's order."""

import random
import re

from cohortbench.llm import quality


def plain(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    grams = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    inside = {i + k for i, g in enumerate(grams) if grams.count(g) > 1 for k in range(5)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    return {"n_words": len(words), "word_chars": sum(map(len, words)),
            "n_symbols": sum(text.count(c) for c in "#*$%&|<>"), "n_dup_lines": dup, "n_repeat_words": len(inside)}


def texts():
    rng = random.Random(3)
    words = ["a", "bb", "ü", "\U0001F600x", "#", "c|d", " ", "e f"]
    out = ["", " ", "\n\n", "a b c d e a b c d e", "a a a a a a", "x\ny\nx\n \n \nx "]
    for _ in range(150):
        out.append("".join(rng.choice(words) + rng.choice([" ", "  ", "\n", "\t", "\v"]) for _ in range(rng.randint(1, 60))))
    return out


def test_measures():
    some = texts()
    got = quality.measures([t.encode() for t in some])
    for i, t in enumerate(some):
        assert {k: int(v[i]) for k, v in got.items()} == plain(t), t


def test_order_changes_cost_not_verdict():
    some = [t.encode() for t in texts()]
    a = quality.cascade(some, quality.ALL_RULES)
    b = quality.cascade(some, quality.ALL_RULES[::-1])
    assert [x is None for x in a] == [x is None for x in b]


def test_later_rules_see_only_what_passed():
    asked = []

    def rule(name, out):
        def rejects(some):
            asked.append((name, len(some)))
            return quality.np.array([t in out for t in some], bool)
        return quality.Rule(name, rejects)

    got = quality.cascade([b"a", b"b", b"c"], (rule("one", {b"a"}), rule("two", {b"a", b"c"}), rule("three", {b"b"})))
    assert got == ["one", "three", "two"] and asked == [("one", 3), ("two", 2), ("three", 1)]


def test_rules_are_ordered_by_rejections_per_cost():
    figures = [{"rule": "few_words", "seconds": 1.0, "rejected": 5, "tried": 9},
               {"rule": "repeated_windows", "seconds": 0.1, "rejected": 2, "tried": 9}]
    assert [r.name for r in quality.ordered(quality.BASE_RULES, figures)] == ["repeated_windows", "few_words"]


def test_whole_tables(spark, odd_docs, no_docs):
    rows = quality.judged(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    failed = {(r["__row"]["doc_id"], r["__row"]["text"]): r["failed"] for r in rows}
    assert failed[1, "one two three four five six seven eight nine ten eleven"] is None
    assert failed[2, ""] and failed[3, None] and failed[None, None] and failed[5, "x" * 50_000] and failed[7, " \t\n "]
    # Which of the rules that reject a text is named depends on the measured order.
    assert all(r["failed"] for r in rows if r["__row"]["doc_id"] in (4, 9))
    measured = quality.measured(odd_docs).where("doc_id = 4").first()
    assert measured["n_words"] == 12001 and measured["base_failed"]
    assert quality.judged(no_docs).count() == 0 and quality.measured(no_docs).count() == 0
