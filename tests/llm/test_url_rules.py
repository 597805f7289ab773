"""Listed rules case by case, mined rules against counting."""

import itertools
import random
import time
from collections import Counter

import pytest

from cohortbench.llm import url_rules
from cohortbench.llm.queries import URL_RULES

CASES = [
    ("http://a.net/x", "a.net", "/x", "net/", "block"),
    ("http://a.NET", "a.net", "", None, "allow"),
    ("https://www.example.net/en/5?x#y", "www.example.net", "/en/5", "example.net/en/", "allow"),
    ("https://example.net/en", "example.net", "/en", "net/", "block"),
    ("https://badexample.com/de/1", "badexample.com", "/de/1", None, "allow"),
    ("ftp://Example.COM/de/?q=://z", "example.com", "/de/", "example.com/de/", "block"),
    ("x://host.org/fr/a\nb#c", "host.org", "/fr/a\nb", "org/fr/", "allow"),
    ("x://ÄB.org?/fr/", "Äb.org", "", None, "allow"),
    ("no scheme", "", "", None, "allow"),
    ("", "", "", None, "allow"),
    (None, "", "", None, "allow"),
    ("://net/p", "net", "/p", "net/", "block"),
]


def test_listed_rules(spark):
    pages = spark.createDataFrame([(i, c[0], "r") for i, c in enumerate(CASES)] + [(None, None, "r")],
                                  "page_id long, url string, rule string")
    got = {r["page_id"]: r for r in url_rules.judge(pages, URL_RULES, mining=url_rules.Mining(0.9, 1.0)).collect()}
    for i, (_, host, path, rule, verdict) in enumerate(CASES):
        assert (got[i]["host"], got[i]["path"], got[i]["rule"]) == (host, path, rule), CASES[i]
        if rule:
            assert got[i]["verdict"] == verdict
    assert len(got) == len(CASES) + 1


def test_mined_rules_against_counting(spark):
    sets = [(["a", "b"], True)] * 6 + [(["a"], False)] * 6 + [(["b", "c"], True)] * 3 + [(["b"], False)] * 2
    sets += [(["c", "d"], True)] * 2 + [([], True)] + [(["d"], False)] * 4
    mining = url_rules.Mining(min_support=0.08, min_confidence=0.6, max_tokens=3)
    got = {tuple(r["tokens"]): round(r["confidence"], 9)
           for r in url_rules.mine(spark.createDataFrame(sets, "tokens array<string>, block boolean"), mining).collect()}
    rows = [(set(t), b) for t, b in sets if t]
    every, bad = Counter(), Counter()
    for tokens, block in rows:
        for n in (1, 2, 3):
            for part in itertools.combinations(sorted(tokens), n):
                every[part] += 1
                bad[part] += block
    kept = {p: bad[p] / every[p] for p in every if bad[p] / every[p] >= 0.6 and bad[p] / len(rows) >= 0.08}
    want = {p: round(c, 9) for p, c in kept.items()
            if len(p) == 1 or not any(kept.get((t,), 0) >= c for t in p)}
    assert got == want and want


def test_matches_need_all_tokens(spark):
    rules = spark.createDataFrame([(1, ["a", "b"], "a", 0.9, 0.1), (2, ["c"], "c", 0.7, 0.1)],
                                  "rule_id long, tokens array<string>, rarest string, confidence double, support double")
    sets = spark.createDataFrame([(1, ["a"]), (2, ["a", "b"]), (3, ["a", "b", "c"]), (4, ["c"]), (5, [])], "key long, tokens array<string>")
    got = {r["key"]: r["mined"] for r in url_rules.match(sets, rules).collect()}
    assert got == {2: "a b", 3: "a b", 4: "c"}


def counted(sets, mining):
    """Rules by counting every set of up to max_tokens tokens."""
    every, bad = Counter(), Counter()
    for tokens, block in sets:
        for n in range(1, mining.max_tokens + 1):
            for part in itertools.combinations(sorted(tokens), n):
                every[part] += 1
                bad[part] += block
    kept = {p: bad[p] / every[p] for p in every
            if bad[p] / every[p] >= mining.min_confidence and bad[p] / len(sets) >= mining.min_support}
    return {p: round(c, 9) for p, c in kept.items() if len(p) == 1 or not any(kept.get((t,), 0) >= c for t in p)}


@pytest.mark.parametrize("widest", [14, 2])
def test_both_miners_give_what_counting_gives(spark, widest):
    draw = random.Random(3)
    sets = [(sorted(t for t in "abcdefgh" if draw.random() < 0.6), draw.random() < 0.7) for _ in range(300)]
    sets = [(t, b or "a" in t and "d" in t) for t, b in sets if t]
    mining = url_rules.Mining(min_support=0.05, min_confidence=0.8, max_tokens=3, widest=widest)
    df = spark.createDataFrame(sets, "tokens array<string>, block boolean")
    got = {tuple(r["tokens"]): round(r["confidence"], 9) for r in url_rules.mine(df, mining).collect()}
    assert got == counted(sets, mining) and any(len(t) > 1 for t in got)


def test_tokens_of_the_same_rows_are_one_item(spark):
    rows = [["a", "b", "c"], ["a", "b"], ["c"], ["d"], ["d", "e"], ["a", "b", "e"]]
    df = spark.createDataFrame([(t,) for t in rows], "tokens array<string>").repartition(3)
    got = {r["token"]: r["item"] for r in url_rules.token_classes(df).collect()}
    assert got == {"a": "a", "b": "a", "c": "c", "d": "d", "e": "e"}


def test_long_templates_end_in_seconds(spark):
    """A tenth of the labelled URLs has 40 query keys, always the same ones, another tenth most of 40 others."""
    draw = random.Random(4)
    rows, labels = [], []
    for i in range(600):
        if i % 10 == 0:
            url = f"http://h{i}.test/x?" + "&".join(f"fix{chr(97 + k % 26)}{chr(97 + k // 26)}={i}" for k in range(40))
        elif i % 10 == 1:
            url = f"http://h{i}.test/x?" + "&".join(f"opt{chr(97 + k % 26)}{chr(97 + k // 26)}={i}" for k in range(40) if draw.random() < 0.9)
        else:
            url = f"http://h{i}.test/{'bad' if i % 3 else 'fine'}/{i}"
        rows.append((i, url))
        labels.append((i, i % 10 < 2 or i % 3 > 0))
    rows += [(1000, "http://new.test/x?fixca=1"), (1001, "http://new.test/fine/1"), (1002, "http://new.test/x?" + "y=1&" * 20_000)]
    start = time.time()
    got = {r["page_id"]: r for r in url_rules.judge(
        spark.createDataFrame(rows, "page_id long, url string"), [],
        spark.createDataFrame(labels, "page_id long, block boolean")).collect()}
    assert time.time() - start < 60
    assert len(got) == len(rows) and got[1000]["verdict"] == "block" and got[1001]["verdict"] == "allow"
    assert all(got[i]["verdict"] == ("block" if block else "allow") for i, block in labels)


def test_rules_come_from_the_labels_alone(spark):
    rows = [(i, f"http://x.net/de/{i}") for i in range(50)] + [(100 + i, f"http://y.test/de/{i}") for i in range(50)]
    labels = [(100 + i, False) for i in range(25)] + [(i, True) for i in range(3)]
    got = {r["page_id"]: r["verdict"] for r in url_rules.judge(
        spark.createDataFrame(rows, "page_id long, url string"), URL_RULES,
        spark.createDataFrame(labels, "page_id long, block boolean")).collect()}
    assert all(got[i] == "block" for i in range(50)) and all(got[100 + i] == "allow" for i in range(50))


def test_listed_pages_without_a_label_are_mined_and_labels_go_first(spark):
    """Folders on the list alone, and one whose labels say otherwise than the list."""
    rows = [(i, f"http://x{i}.net/spam/{i}") for i in range(40)] + [(100 + i, f"http://y{i}.net/good/{i}") for i in range(40)]
    rows += [(200, "http://z.test/spam/1"), (201, "http://z.test/good/1"), (None, "http://v.net/spam/2")]
    labels = [(100 + i, False) for i in range(40)]
    got = {r["page_id"]: r for r in url_rules.judge(
        spark.createDataFrame(rows, "page_id long, url string"), URL_RULES,
        spark.createDataFrame(labels, "page_id long, block boolean")).collect()}
    assert len(got) == len(rows) and got[200]["mined"] and got[200]["confidence"] == 1.0
    assert (got[200]["verdict"], got[201]["verdict"]) == ("block", "allow")
    assert all(got[i]["verdict"] == "block" for i in range(40))


@pytest.mark.parametrize("labelled", [True, False])
def test_empty_and_unlabelled(spark, labelled):
    pages = spark.createDataFrame([], "page_id long, url string")
    labels = spark.createDataFrame([], "page_id long, block boolean") if labelled else None
    assert url_rules.judge(pages, URL_RULES, labels).count() == 0


def test_labels_generalise(spark):
    rows = [(i, f"http://m.spam-farm{i}.example.org/en/{i}") for i in range(40)]
    rows += [(100 + i, f"http://blog.good{i}.example.org/en/{i}") for i in range(40)]
    labels = [(i, True) for i in range(20)] + [(100 + i, False) for i in range(20)] + [(None, True), (3, None)]
    got = {r["page_id"]: r["verdict"] for r in url_rules.judge(
        spark.createDataFrame(rows, "page_id long, url string"), URL_RULES,
        spark.createDataFrame(labels, "page_id long, block boolean")).collect()}
    assert all(got[i] == "block" for i in range(40)) and all(got[100 + i] == "allow" for i in range(40))
