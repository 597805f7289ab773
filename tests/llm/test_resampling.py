"""Importance resampling against plain Python."""

import hashlib
import math
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from cohortbench.llm.resampling import Resampling, bucket_counts, gram_pattern, normalised, resample, spans


def words_of(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", lower)


def grams_of(text, how):
    words = words_of(text)
    return [" ".join(words[i : i + n]) for n in range(1, how.longest + 1) for i in range(len(words) - n + 1)]


def brute(docs, target, how):
    corpus, wanted = Counter(), Counter()
    grams = [[zlib.crc32(g.encode()) % how.buckets for g in grams_of(t, how)] for _, t in docs]
    for g in grams:
        corpus.update(g)
    for t in target:
        wanted.update(zlib.crc32(g.encode()) % how.buckets for g in grams_of(t, how))
    s, t = sum(corpus.values()), sum(wanted.values())
    gain = {b: math.floor(1000 * math.log((wanted[b] + 1) * (s + how.buckets) / ((corpus[b] + 1) * (t + how.buckets)))) for b in corpus}
    rows = []
    for (i, text), g in zip(docs, grams, strict=True):
        weight = sum(gain[b] for b in g) // len(g) if g else 0
        h = int(hashlib.sha256(f"{how.seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append([i, len(g), weight, score, None, len(words_of(text)) >= how.min_words])
    able = sorted((r for r in rows if r[5]), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for rank, r in enumerate(able[: len(able) * how.percent // 100], 1):
        r[4] = rank
    return sorted((tuple(r[:5]) for r in rows), key=str)


def found(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_features", "weight", "score", "rank").collect()), key=str)


@pytest.mark.parametrize("how", [Resampling(min_words=3, percent=40), Resampling(buckets=97, longest=3, min_words=1, percent=100)])
def test_against_plain_python(spark, odd_docs, how):
    target = spark.createDataFrame([("Alpha beta one TWO",), (None,), ("three-four words",)], "text string")
    docs = [(r.doc_id, r.text) for r in odd_docs.collect()]
    got = resample(odd_docs.withColumn("rank", F.lit("x")).withColumn("score", F.lit("x")), target, how)
    assert found(got) == brute(docs, [r.text for r in target.collect()], how)


def test_on_the_tables(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    target = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    how = Resampling()
    want = brute([(r.doc_id, r.text) for r in docs.collect()], [r.text for r in target.collect()], how)
    got = found(resample(docs.repartition(5), target, how))
    assert got == want
    assert sum(r[4] is not None for r in got) > 10


def test_overlapped_spans():
    text = normalised("Über-long  TEXT, text.of 3 wörds\x00\x7fand\tmore!".encode())
    assert text == "Über long text text of 3 wörds and more".encode()
    words = text.split(b" ")
    for n in range(1, 5):
        assert list(spans(text, gram_pattern(n))) == [b" ".join(words[i : i + n]) for i in range(len(words) - n + 1)]
    assert list(spans(b"", gram_pattern(1))) == []


def test_counts_of_a_text_of_many_parts(monkeypatch):
    monkeypatch.setattr("cohortbench.llm.resampling.SPANS", 7)
    grams = [str(i % 13).encode() for i in range(1000)]
    where, count, n = bucket_counts(grams, 11)
    want = Counter(zlib.crc32(g) % 11 for g in grams)
    assert n == 1000 and dict(zip(where.tolist(), count.tolist(), strict=True)) == want


def test_a_third_of_the_rows_under_one_id_and_no_rows(spark):
    rows = spark.range(0, 900, 1, 6).select(
        F.when(F.col("id") % 3 > 0, F.col("id")).otherwise(7).alias("doc_id"),
        F.concat(F.lit("one two three "), F.when(F.col("id") % 3 > 0, F.col("id")).otherwise(7).cast("string")).alias("text"))
    target = spark.createDataFrame([("one",)], "text string")
    got = resample(rows, target, Resampling(min_words=4, percent=50))
    docs = [(r.doc_id, r.text) for r in rows.collect()]
    assert found(got) == brute(docs, ["one"], Resampling(min_words=4, percent=50))
    assert resample(rows.limit(0), target).collect() == []
    assert found(resample(rows, target.limit(0), Resampling(min_words=4, percent=50))) == brute(
        docs, [], Resampling(min_words=4, percent=50))
