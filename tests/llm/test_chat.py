"""Snapshot collapse against comparing whole conversations."""

import random

from cohortbench.llm import chat

SHAPE = "conv_id long, turn long, role string, text string, run int, place string"


def table(spark, convs):
    rows = [(c, i, r, t, 1, "z") for c, turns in convs.items() for i, (r, t) in enumerate(turns)]
    random.Random(1).shuffle(rows)
    return spark.createDataFrame(rows, SHAPE)


def brute(convs):
    keep = {}
    for c in sorted(convs):
        turns = convs[c]
        if any(len(o) > len(turns) and o[: len(turns)] == turns for o in convs.values()):
            continue
        keep.setdefault(tuple(turns), []).append(c)
    return {ids[0]: (len(turns), len(ids), "".join(f"<|{r}|>\n{t}<|end|>\n" for r, t in turns))
            for turns, ids in keep.items()}


def test_against_brute_force(spark):
    rng = random.Random(5)
    convs = {}
    for c in range(120):
        if convs and rng.random() < 0.6:
            old = convs[rng.choice(list(convs))]
            turns = old[: rng.randint(1, len(old))]
        else:
            turns = [("user", "hello")]
        turns = turns + [(rng.choice(["user", "assistant"]), f"t{rng.randint(0, 3)}") for _ in range(rng.randint(0, 3))]
        convs[c] = turns
    # Longer than one task's run of turns, and one snapshot that ends inside the second run.
    convs[500] = [("user", f"long {i}") for i in range(700)]
    convs[501] = convs[500][:300]
    convs[502] = convs[500][:300] + [("user", "other")]
    got = chat.collapse(table(spark, convs)).collect()
    whole = {}
    for r in sorted(got, key=lambda r: r["part"]):
        old = whole.get(r["conv_id"], (0, 0, ""))
        whole[r["conv_id"]] = (r["n_turns"], r["copies"], old[2] + r["text"])
    assert whole == brute(convs)
    assert max(r["part"] for r in got if r["conv_id"] == 500) == 1


def test_odd_rows(spark):
    rows = [(1, 0, "user", "a <|end|>", 1, "z"), (1, 0, "user", "a <|end|>", 1, "z"), (1, None, None, None, 1, "z"),
            (None, 0, "user", "lost", 1, "z"), (2, 5, "user", None, 1, "z"), (2, -7, "user", "early", 1, "z")]
    got = {r["conv_id"]: r for r in chat.collapse(spark.createDataFrame(rows, SHAPE)).collect()}
    assert got[1]["text"] == "<||>\n<|end|>\n<|user|>\na < |end|><|end|>\n" and got[1]["n_turns"] == 2
    assert got[2]["text"] == "<|user|>\nearly<|end|>\n<|user|>\n<|end|>\n"
    assert set(got) == {1, 2}
    assert chat.collapse(spark.createDataFrame([], SHAPE)).count() == 0


def test_copies_are_dropped_before_the_shuffle(spark):
    rows = [(1, 0, "user", "again", 1, "z")] * 3000 + [(1, 1, "assistant", f"t{i}", 1, "z") for i in range(5)]
    df = spark.createDataFrame(rows, SHAPE).repartition(4)
    turns = chat.numbered_turns(df).collect()
    assert sorted(r["place"] for r in turns) == [1, 2, 3, 4, 5, 6]
    (got,) = chat.collapse(df).collect()
    assert got["n_turns"] == 6 and got["text"].count("again") == 1
