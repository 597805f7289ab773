"""Fingerprints, the Gray index and components against brute force."""

import random
import re

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from cohortbench.llm import simhash
from cohortbench.llm.components import components


def plain_fingerprint(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    if not words:
        return 0
    grams = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(codes, limit=2):
    root = {c: c for c in codes}

    def find(c):
        while root[c] != c:
            c = root[c]
        return c

    for a in codes:
        for b in codes:
            if (a ^ b).bit_count() <= limit:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {c: find(c) for c in codes}


@given(st.text(alphabet="abAB ü\n\t İ", max_size=60))
@settings(max_examples=80, deadline=None)
def test_fingerprint(text):
    assert simhash.fingerprint(text.encode()) == plain_fingerprint(text)


def some_codes(n, seed):
    rng = random.Random(seed)
    out = [0, 3, 2**64 - 1, 2**63]
    while len(out) < n:
        base = rng.choice(out) if rng.random() < 0.5 else rng.getrandbits(64)
        for _ in range(rng.randint(0, 3)):
            base ^= 1 << rng.randrange(64)
        out.append(base)
    return sorted(set(out))


@pytest.mark.parametrize("n", [1, 2, 16, 17, 300])
def test_index_finds_all_within(n):
    codes = np.array(some_codes(n, n)[:n], np.uint64)
    index = simhash.GrayIndex(codes, fanout=4)
    for limit in (0, 1, 2):
        got = {(int(q), int(c)) for a, b in index.within(codes, limit) for q, c in zip(a, b, strict=True)}
        want = {(i, j) for i, x in enumerate(codes.tolist()) for j, y in enumerate(codes.tolist())
                if (x ^ y).bit_count() <= limit}
        assert got == want


def test_gray_rank_is_the_place_in_gray_order():
    order = np.arange(64, dtype=np.uint64)
    assert simhash.gray_rank(order ^ (order >> np.uint64(1))).tolist() == order.tolist()


@pytest.mark.parametrize("table_rows", [4096, 16])
def test_components_over_many_tables(spark, table_rows):
    codes = some_codes(600, 9)
    signed = [(int(np.uint64(c).view(np.int64)),) for c in codes]
    links = simhash.linked_pairs(spark.createDataFrame(signed, "fp long").repartition(5), table_rows=table_rows)
    found = {r["node"]: r["root"] for r in components(links).collect()}
    got, want = {}, brute_components(codes)
    for c, (s,) in zip(codes, signed, strict=True):
        got.setdefault(found.get(s, s), set()).add(c)
    groups = {}
    for c in codes:
        groups.setdefault(want[c], set()).add(c)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, groups.values()))


def alike_codes(n, seed):
    """Most codes begin alike, in two clusters whose differing bits all go together."""
    rng = random.Random(seed)
    centres = [0x5A5A << 48, 0x5A5A << 48 | (1 << 30) - 1]
    out = {rng.getrandbits(64) for _ in range(n // 6)}
    while len(out) < n:
        code = rng.choice(centres)
        for _ in range(rng.randint(0, 9)):
            code ^= 1 << rng.randrange(44)
        out.add(code)
    return sorted(out)


def test_full_tables_are_split(spark):
    codes = alike_codes(900, 4)
    signed = [(int(np.uint64(c).view(np.int64)),) for c in codes]
    df = spark.createDataFrame(signed, "fp long").repartition(5)
    rows = simhash.leaf_tables(df, table_rows=8)[0].collect()
    homes = [r for r in rows if not r["visits"]]
    assert sorted(r["fp"] for r in homes) == sorted(s for (s,) in signed)
    sizes = {}
    for r in homes:
        sizes[r["place"]] = sizes.get(r["place"], 0) + 1
    assert max(sizes.values()) <= simhash.FULL * 8
    # Each pair within the limit meets in one table, and what a visitor has spent is what it differs by at least.
    members = {}
    for r in rows:
        members.setdefault(r["place"], ([], []))[r["visits"]].append(r)
    met = set()
    for own, guests in members.values():
        met |= {frozenset((a["fp"], b["fp"])) for a in own for b in own + guests}
        assert all(((a["fp"] ^ b["fp"]) & (1 << 64) - 1).bit_count() >= b["spent"] for a in own for b in guests)
    want = {frozenset((a, b)) for i, (a,) in enumerate(signed) for (b,) in signed[:i]
            if ((a ^ b) & (1 << 64) - 1).bit_count() <= 2}
    assert want and want <= met
    found = {r["node"]: r["root"] for r in components(simhash.linked_pairs(df, table_rows=8)).collect()}
    got, groups, root = {}, {}, brute_components(codes)
    for c, (s,) in zip(codes, signed, strict=True):
        got.setdefault(found.get(s, s), set()).add(c)
        groups.setdefault(root[c], set()).add(c)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, groups.values()))


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(60)] + [(1000, 1000 + i) for i in range(1, 200)] + [(5, 5), (3000, 2999)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(got[i] == 0 for i in range(61)) and all(got[1000 + i] == 1000 for i in range(200))
    assert got[3000] == got[2999] == 2999
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_documents(spark, odd_docs, no_docs):
    rows = odd_docs.select("doc_id", "text").collect()
    codes = sorted({plain_fingerprint(r["text"]) for r in rows})
    root = brute_components(codes)
    least = {}
    for r in rows:
        if r["doc_id"] is not None:
            key = root[plain_fingerprint(r["text"])]
            least[key] = min(least.get(key, 10**9), r["doc_id"])
    want = sorted((str(r["doc_id"]), f"{plain_fingerprint(r['text']):016x}",
                   str(least.get(root[plain_fingerprint(r["text"])]))) for r in rows)
    got = sorted((str(r["doc_id"]), r["fingerprint"], str(r["component_id"]))
                 for r in simhash.document_components(odd_docs).collect())
    assert got == want
    kept = simhash.first_of_each(odd_docs)
    assert kept.columns == odd_docs.columns
    kept = kept.collect()
    assert len(kept) == len({root[c] for c in codes})
    assert len({root[plain_fingerprint(r["text"])] for r in kept}) == len(kept)
    assert simhash.document_components(no_docs).count() == 0 and simhash.first_of_each(no_docs).count() == 0
