"""Near duplicates and components against brute force."""

import itertools
import random

import pytest

from tripstats.llm.components import components
from tripstats.llm.near_duplicates import Settings, near_duplicates


def words_of(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return low.split(" ") if low else []


def brute_force(rows, size, percent):
    sets = {}
    for doc_id, text in rows:
        words = [w for w in words_of(text) if w]
        s = {tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))} if words else set()
        if len(s) >= len(sets.get(doc_id, ())):
            sets[doc_id] = s
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(sorted(sets), 2):
        shared = len(sets[a] & sets[b])
        if sets[a] and sets[b] and 100 * shared >= percent * len(sets[a] | sets[b]):
            low, high = sorted((find(a), find(b)))
            root[high] = low
    return [(i, len(sets[i]), find(i), find(i) == i) for i in sorted(sets)]


def found(spark, rows, settings):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    df = df.selectExpr("*", "1 AS rep", "'x' AS component_id", "2 AS bucket")
    out = near_duplicates(df, settings).orderBy("doc_id")
    assert out.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    return [tuple(row) for row in out.collect()]


def edited(rng, words, share):
    return [rng.choice(["new", "other", f"v{rng.random()}"]) if rng.random() < share else w for w in words]


@pytest.mark.parametrize("size, percent", [(3, 85), (5, 80)])
def test_equals_brute_force(spark, size, percent):
    rng = random.Random(size)
    rows, i = [], 0
    for group in range(6):
        base = [f"w{rng.randrange(2000)}" for _ in range(rng.choice([20, 120, 300]))]
        for _ in range([1, 2, 30, 60, 5, 3][group]):
            rows.append((i * 7 % 1000, " ".join(edited(rng, base, rng.choice([0, 0.004, 0.015, 0.03])))))
            i += 1
    rows += [(2000 + n, text) for n, text in enumerate([None, "", "  ", "one", "ONE", "one two", "é É", "é é"])]
    rows += [(3000, " ".join(f"long{j}" for j in range(30_000)))] * 2
    got = found(spark, rows, Settings(size, percent))
    assert got == brute_force(rows, size, percent)
    assert len({row[2] for row in got}) < len(got)


def test_links_that_no_hub_has(spark):
    # A ring: each document is like its neighbours only, so the hub of a bucket decides little.
    words = [f"w{i}" for i in range(400)]
    rows = [(i, " ".join(words[i * 8 : i * 8 + 200])) for i in range(20)]
    assert found(spark, rows, Settings(3, 85)) == brute_force(rows, 3, 85)


def test_one_id_with_two_texts_and_no_id(spark):
    rows = [(1, "a b c d e"), (1, "f g h i j k"), (2, "f g h i j k"), (3, "a b c d e"), (None, "a b c d e")]
    assert found(spark, rows, Settings(3, 85)) == [(1, 4, 1, True), (2, 4, 1, False), (3, 3, 3, True)]


def test_no_documents(spark):
    assert found(spark, [], Settings()) == []


def test_bands_hardly_miss():
    assert Settings(3, 85).rows == 6 and Settings(5, 80).rows == 5
    assert Settings(5, 80).least_agreeing < 192 * 0.7


@pytest.mark.parametrize("seed", range(2))
def test_components(spark, seed):
    rng = random.Random(seed)
    edges = [(rng.randrange(60), rng.randrange(60)) for _ in range(40)]
    edges += [(100 + i, 101 + i) for i in range(40)] + [(200, 200 + i) for i in range(50)]
    edges += [(300, 300), (None, 1), edges[0]]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        if a is not None:
            low, high = sorted((find(a), find(b)))
            root[high] = low
    df = spark.createDataFrame(edges, "a long, b long")
    got = sorted(map(tuple, components(df).collect()))
    assert got == sorted((x, find(x)) for x in list(root))


def test_no_edges(spark):
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_long_texts_fill_blocks_sooner(spark, monkeypatch):
    from tripstats.llm import near_duplicates as module

    monkeypatch.setattr(module, "BLOCK_BYTES", 4000)
    words = [f"w{i}" for i in range(700)]
    rows = [(i, " ".join(words[i * 8 : i * 8 + 200])) for i in range(40)]
    assert found(spark, rows, Settings(3, 85)) == brute_force(rows, 3, 85)
