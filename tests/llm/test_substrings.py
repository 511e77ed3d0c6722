"""Repeated passages against brute force."""

import random
import re

import pytest

from tripstats.llm import substrings


def brute_force(rows, length):
    texts = [re.findall(r"[^\x20\x09-\x0D]+", text or "") for _, text in rows]
    counts = {}
    for words in texts:
        for i in range(len(words) - length + 1):
            window = tuple(words[i : i + length])
            counts[window] = counts.get(window, 0) + 1
    out = []
    for (doc_id, _), words in zip(rows, texts):
        gone = set()
        for i in range(len(words) - length + 1):
            if counts[tuple(words[i : i + length])] > 1:
                gone.update(range(i, i + length))
        kept = " ".join(w for i, w in enumerate(words) if i not in gone)
        out.append((doc_id, len(words), len(gone), kept))
    return sorted(out, key=repr)


def found(spark, rows, length):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    df = df.selectExpr("*", "1 AS at", "'x' AS anchor", "2 AS kept", "3 AS text_hash")
    return sorted((tuple(row) for row in substrings.remove_repeats(df, length).collect()), key=repr)


@pytest.mark.parametrize("seed, length", [(1, 35), (2, 7), (3, 4), (4, 1), (5, 2)])
def test_equals_brute_force(spark, seed, length):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(rng.choice([4, 30, 400]))] + ["É", "a b", "."]
    passages = [[rng.choice(vocabulary) for _ in range(rng.randrange(1, 4 * length + 2))] for _ in range(12)]
    rows = []
    for i in range(60):
        words = []
        for _ in range(rng.randrange(6)):
            passage = list(rng.choice(passages))
            if rng.random() < 0.5:
                passage[rng.randrange(len(passage))] = rng.choice(vocabulary)
            cut = rng.randrange(len(passage))
            words += rng.choice([passage, passage[cut:], passage[:cut], [rng.choice(vocabulary)]])
        rows.append((rng.choice([i, i, 3, None]), rng.choice([" ", "\n", " \t"]).join(words)))
    rows += [(100, None), (101, ""), (102, " \n "), (103, "one two"), (104, "same " * 200)]
    rows += [(105, " ".join(f"long{i % 20000}" for i in range(20_000 + length)))] + rows[:3]
    got = found(spark, rows, length)
    assert got == brute_force(rows, length)
    assert any(row[2] for row in got)


def test_many_contexts_of_one_passage(spark):
    # A passage that all rows share, and neighbours that some of them share, in a tree.
    rng = random.Random(9)
    rows = []
    for i in range(150):
        before = [f"b{i % m}" for m in (2, 3, 5, 7, 50)]
        behind = [f"c{i % m}" for m in (2, 4, 6, 10, 150)]
        core = [f"p{j}" for j in range(8)]
        text = [f"x{rng.random()}" for _ in range(3)] + before[::-1] + core + behind
        rows.append((i, " ".join(text)))
    assert found(spark, rows, 10) == brute_force(rows, 10)


def test_no_rows(spark):
    assert found(spark, [], 35) == []
