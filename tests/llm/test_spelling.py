"""Spelling variants against brute force."""

import random
import re
import zlib

import pyarrow as pa

from tripstats.llm import spelling


def near(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def brute_force(rows):
    counts = {}
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            low = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{low}".encode())
            if h % 97 == 0:
                low = low[: h % len(low)] + low[h % len(low) + 1 :]
            counts[low] = counts.get(low, 0) + 1
    counts = {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}
    out = {}
    for word, n in counts.items():
        others = [w for w in counts if near(word, w)]
        best = min(others, key=lambda w: (-counts[w], w), default=None)
        form = best if best and counts[best] >= 2 * n else None
        out[word] = (n, len(others), form, counts.get(form))
    def root(word):
        return root(out[word][2]) if out[word][2] else word
    return sorted((w, *v, root(w)) for w, v in out.items())


def found(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS word", "'x' AS n")
    got = spelling.variants(df).select("word", "n", "n_near", "form", "form_n", "root")
    return sorted(tuple(row) for row in got.collect())


def changed(rng, word):
    i = rng.randrange(len(word) + 1)
    c = rng.choice("abcé")
    return rng.choice([word[:i] + c + word[i:], word[: max(i - 1, 0)] + word[i:], word[: max(i - 1, 0)] + c + word[i:]])


def test_equals_brute_force(spark):
    rng = random.Random(5)
    bases = ["".join(rng.choice("abcdé") for _ in range(rng.randrange(4, 12))) for _ in range(60)]
    bases += ["ÿbcde", "caf×s", "aaaaa", "aaaaaa", "aaaaaaa", "ababab", "bababa", "x" * 300]
    rows = []
    for i in range(120):
        words = []
        for _ in range(rng.randrange(60)):
            word = rng.choice(bases)
            for _ in range(rng.choice([0, 0, 0, 1, 1, 2])):
                word = changed(rng, word) or "a"
            words.append(rng.choice([word, word.upper(), word.capitalize()]))
        rows.append((rng.choice([i, i, 7, None]), rng.choice([" ", "-", "1"]).join(words)))
    rows += [(1, None), (2, ""), (3, "  "), (4, "Word " * 50_000), (4, "Word Words " * 3), (5, "words wordz " * 2)] * 2
    got = found(spark, rows)
    assert got == brute_force(rows)
    assert any(row[5] != (row[3] or row[0]) for row in got)


def test_hot_halves_are_dealt_over_shards(spark):
    words = [f"common{a}{b}{c}" for a in "abcdef" for b in "abcdef" for c in "abcdef"]
    df = spark.createDataFrame([(w, i) for i, w in enumerate(words)], "word string, n long")
    got = sorted(tuple(r) for r in spelling.near_pairs(df, shard_words=16).collect())
    counts = {w: i for i, w in enumerate(words)}
    assert got == sorted((a, b, counts[b]) for a in words for b in words if near(a, b))


def test_steps_that_end_within_a_group(monkeypatch):
    monkeypatch.setattr(spelling, "STEP_LETTERS", 1)
    stream = [(5, 0, "ab", 0, 0, w, 3) for w in ("abaab", "abbab")] + [(5, 0, "ab", 0, 1, w, 3) for w in ("abaab", "abbab")]
    names = ["size", "side", "half", "shard", "kind", "word", "n"]
    batches = [pa.RecordBatch.from_pylist([dict(zip(names, row))]) for row in stream]
    got = [tuple(r.values()) for out in spelling._search(iter(batches)) for r in out.to_pylist()]
    assert got == [("abaab", "abbab", 3), ("abbab", "abaab", 3)]


def test_no_words(spark):
    assert found(spark, []) == []
