"""Quality rules as a short-circuit cascade.

Each rule looks at whole texts and rejects or passes. On a sample of the texts, every rule's cost and
share of rejections are measured; rules then run in order of rejections per cost, each only on what
the earlier ones passed. The order changes the cost, never the verdict.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StringType, StructField, StructType

from cohortbench.llm.common import IS_SPACE, byte_slices, mixed, word_bounds, word_hashes

#: Fixed values of the base rules.
SYMBOLS = b"#*$%&|<>"
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
WINDOW = 5

UPPER = bytes(range(65, 91))
LETTERS = bytes([*range(65, 91), *range(97, 123), *range(128, 256)])
SPACES = b" \t\n\v\f\r"

#: Texts on which costs and rejections are measured.
SAMPLE_ROWS = 512


def _count(text: bytes, chars: bytes) -> int:
    return len(text) - len(text.translate(None, chars))


def _joined(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    rows = np.concatenate([[0], np.cumsum([len(t) for t in texts], dtype=np.int64)])
    return np.frombuffer(b"".join(texts), np.uint8), rows


def _per_row(marks: np.ndarray, rows: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(marks, dtype=np.int64)])
    return total[rows[1:]] - total[rows[:-1]]


def repeated_words(data: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per row: its words, and those inside five-word windows found twice or more in the row."""
    n = len(rows) - 1
    starts, ends, of = word_bounds(data, rows, ~IS_SPACE[data])
    words = np.bincount(of, minlength=n)
    m = len(starts) - WINDOW + 1
    if m <= 0:
        return words, np.zeros(n, np.int64)
    h = word_hashes(data, starts, ends)
    window = mixed(of[:m].astype(np.uint64))
    for k in range(WINDOW):
        window = mixed(window + h[k : k + m])
    whole = np.flatnonzero(of[:m] == of[WINDOW - 1 :])
    _, which, times = np.unique(window[whole], return_inverse=True, return_counts=True)
    found = whole[times[which] > 1]
    cover = np.zeros(len(starts) + 1, np.int64)
    np.add.at(cover, found, 1)
    np.add.at(cover, found + WINDOW, -1)
    inside = np.cumsum(cover[:-1]) > 0
    return words, np.bincount(of[inside], minlength=n)


def _duplicate_lines(text: bytes) -> tuple[int, int]:
    """Lines with a word, and those of them equal to an earlier line."""
    lines = [x for x in text.split(b"\n") if x.strip()]
    return len(lines), len(lines) - len(set(lines))


def measures(texts: list[bytes]) -> dict[str, np.ndarray]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of each text."""
    data, rows = _joined(texts)
    words, repeats = repeated_words(data, rows)
    points = ~IS_SPACE[data] & ((data & 0xC0) != 0x80)
    return {
        "n_words": words, "word_chars": _per_row(points, rows),
        "n_symbols": np.array([_count(t, SYMBOLS) for t in texts], np.int64),
        "n_dup_lines": np.array([_duplicate_lines(t)[1] if b"\n" in t else 0 for t in texts], np.int64),
        "n_repeat_words": repeats,
    }


# The rules. Each takes texts and marks those that it rejects.

def few_words(texts: list[bytes]) -> np.ndarray:
    return np.array([len(t) < 2 * MIN_WORDS - 1 or len(t.split(None, MIN_WORDS)) < MIN_WORDS for t in texts], bool)


def repeated_windows(texts: list[bytes]) -> np.ndarray:
    words, repeats = repeated_words(*_joined(texts))
    return 100 * repeats > MAX_REPEAT_PERCENT * words


def many_symbols(texts: list[bytes]) -> np.ndarray:
    """Over one symbol for five words."""
    return np.array([5 * _count(t, SYMBOLS) > len(t.split()) for t in texts], bool)


def shouting(texts: list[bytes]) -> np.ndarray:
    """Over half of the ASCII letters are capitals."""
    return np.array([2 * (u := _count(t, UPPER)) > u + _count(t, bytes(range(97, 123))) for t in texts], bool)


def exclaiming(texts: list[bytes]) -> np.ndarray:
    """Over one exclamation mark for five words."""
    return np.array([5 * t.count(b"!") > len(t.split()) for t in texts], bool)


def stuttering(texts: list[bytes]) -> np.ndarray:
    """Over a fifth of the words equal the word before."""
    out = np.zeros(len(texts), bool)
    for i, t in enumerate(texts):
        words = t.split()
        out[i] = 5 * sum(map(bytes.__eq__, words, words[1:])) > len(words)
    return out


def repeated_lines(texts: list[bytes]) -> np.ndarray:
    """Over a third of at least six lines equal an earlier line."""
    found = [_duplicate_lines(t) if t.count(b"\n") >= 5 else (0, 0) for t in texts]
    return np.array([n >= 6 and 3 * same > n for n, same in found], bool)


def few_letters(texts: list[bytes]) -> np.ndarray:
    """Under half of what is not white space is letters (any byte beyond ASCII counts as one)."""
    return np.array([2 * _count(t, LETTERS) < len(t) - _count(t, SPACES) for t in texts], bool)


@dataclass(frozen=True)
class Rule:
    name: str
    rejects: Callable[[list[bytes]], np.ndarray]


BASE_RULES = (Rule("few_words", few_words), Rule("repeated_windows", repeated_windows))
METHOD_RULES = (
    Rule("many_symbols", many_symbols), Rule("shouting", shouting), Rule("exclaiming", exclaiming),
    Rule("stuttering", stuttering), Rule("repeated_lines", repeated_lines), Rule("few_letters", few_letters),
)
ALL_RULES = BASE_RULES + METHOD_RULES


def cascade(texts: list[bytes], rules: tuple[Rule, ...]) -> list[str | None]:
    """Name of the first rule that rejects each text, or None; later rules don't see rejected texts."""
    verdicts: list[str | None] = [None] * len(texts)
    alive = list(range(len(texts)))
    for rule in rules:
        if not alive:
            break
        no = rule.rejects([texts[i] for i in alive])
        for i, out in zip(alive, no.tolist(), strict=True):
            if out:
                verdicts[i] = rule.name
        alive = [i for i, out in zip(alive, no.tolist(), strict=True) if not out]
    return verdicts


def _texts(column: pa.Array) -> Iterator[tuple[int, int, list[bytes]]]:
    for first, end, data, rows in byte_slices(column):
        raw = data.tobytes()
        yield first, end, [raw[rows[i] : rows[i + 1]] for i in range(end - first)]


def estimate(docs: DataFrame, rules: tuple[Rule, ...] = ALL_RULES, sample_rows: int = SAMPLE_ROWS) -> list[dict]:
    """rule, seconds, rejected, tried, measured on the rows of the sample_rows doc_ids with the least hash.

    Only ids are sorted and sent, sample_rows of them at most; the sampled texts are timed where they
    lie, and only these figures reach the driver. Without any doc_id there are no figures.
    """
    shape = "rule string, seconds double, rejected long, tried long"

    def timed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, texts in _texts(batch.column("text")):
                out = []
                for rule in rules:
                    began = time.perf_counter()
                    no = int(rule.rejects(texts).sum())
                    out.append({"rule": rule.name, "seconds": time.perf_counter() - began,
                                "rejected": no, "tried": len(texts)})
                yield pa.RecordBatch.from_pylist(out, pa.schema([
                    ("rule", pa.string()), ("seconds", pa.float64()),
                    ("rejected", pa.int64()), ("tried", pa.int64())]))

    ids = docs.select("doc_id").where("doc_id is not null").distinct()
    ids = ids.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows)
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    sample = texts.join(F.broadcast(ids), "doc_id", "left_semi").select("text")
    measured = sample.mapInArrow(timed, shape).groupBy("rule").agg(
        F.sum("seconds").alias("seconds"), F.sum("rejected").alias("rejected"), F.sum("tried").alias("tried"))
    return [r.asDict() for r in measured.collect()]


def ordered(rules: tuple[Rule, ...], figures: list[dict]) -> tuple[Rule, ...]:
    """Most rejections per second first; unmeasured rules last, as given."""
    rate = {f["rule"]: f["rejected"] / max(f["seconds"], 1e-9) for f in figures}
    return tuple(sorted(rules, key=lambda r: -rate.get(r.name, -1.0)))


def judged(docs: DataFrame, rules: tuple[Rule, ...] = ALL_RULES) -> DataFrame:
    """All columns of ``docs`` in __row, and failed: the rule that rejects the text, or null.

    An absent text is empty and so has too few words. Every row is judged, repeated ones alike. Of
    several rules that reject a text the first in the measured order is named; whether any does, does
    not depend on that order.
    """
    order = ordered(rules, estimate(docs, rules))
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row")
    packed = docs.select(row, F.col("text").cast("string").alias("__text"))
    shape = StructType([packed.schema["__row"], StructField("failed", StringType())])

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            failed = [v for _, _, texts in _texts(batch.column("__text")) for v in cascade(texts, order)]
            yield pa.RecordBatch.from_arrays([batch.column("__row"), pa.array(failed, pa.string())],
                                             names=["__row", "failed"])

    return packed.mapInArrow(judge, shape)


def measured(docs: DataFrame, rules: tuple[Rule, ...] = METHOD_RULES) -> DataFrame:
    """doc_id, the five measures, base_failed, failed: the method's rules judge what the base passes.

    ``failed`` is "base", the first rule of the cascade's order that rejects, or null for a kept row. An absent
    or empty text has no words and fails the base; long texts are measured whole. Every row keeps its row, with
    repeated and absent ids too. Rules of equal worth keep the order they are given in; the order never changes
    whether a row is kept. An empty table gives an empty result.
    """
    order = ordered(rules, estimate(docs, rules))
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    shape = StructType([docs.schema["doc_id"], *StructType.fromDDL(", ".join(f"{n} long" for n in names)).fields,
                        StructField("base_failed", BooleanType()), StructField("failed", StringType())])

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end, texts in _texts(batch.column("text")):
                found = measures(texts)
                base = (found["n_words"] < MIN_WORDS) | (
                    100 * found["n_repeat_words"] > MAX_REPEAT_PERCENT * found["n_words"])
                passed = np.flatnonzero(~base).tolist()
                failed: list[str | None] = ["base"] * len(texts)
                for i, verdict in zip(passed, cascade([texts[i] for i in passed], order), strict=True):
                    failed[i] = verdict
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(first, end - first), *[pa.array(found[n], pa.int64()) for n in names],
                     pa.array(base), pa.array(failed, pa.string())],
                    names=["doc_id", *names, "base_failed", "failed"])

    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(measure, shape)
