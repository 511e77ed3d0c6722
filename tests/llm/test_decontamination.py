"""Benchmark leaks by planted cases."""

import random

from tripstats.llm import decontamination


def leaks(spark, documents, items, **settings):
    docs = spark.createDataFrame(documents, "doc_id long, text string")
    docs = docs.selectExpr("*", "'x' AS item_id", "1 AS seed", "2 AS tokens")
    bench = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "0 AS doc_id")
    out = decontamination.leaks(docs, bench, **settings)
    assert out.columns[:2] == ["doc_id", "item_id"]
    return {(r.doc_id, r.item_id): r for r in out.collect()}


def text(rng, n):
    return [f"w{rng.randrange(5000)}" for _ in range(n)]


def test_substitutions_are_tolerated(spark):
    rng = random.Random(1)
    item = text(rng, 30)
    documents, planted = [], []
    for i in range(60):
        words = text(rng, 200)
        if i % 2:
            copy = list(item)
            for place in range(i % 5, 30, 7):  # at most one word in seven
                copy[place] = "changed"
            words[50:50] = copy
            planted.append(i)
        documents.append((i, " ".join(words)))
    found = leaks(spark, documents, [(5, " ".join(item)), (6, " ".join(text(rng, 30)))])
    assert set(found) == {(i, 5) for i in planted}
    assert all(r.n_item_tokens == 30 and r.n_matched >= 20 for r in found.values())
    assert all(50 <= r.first_token <= 60 and 70 <= r.last_token <= 79 for r in found.values())


def test_case_punctuation_and_insertions(spark):
    rng = random.Random(2)
    item = text(rng, 24)
    shouted = " ".join(w.upper() + "," for w in item)
    split = " ".join(item[:12] + ["put", "in"] + item[12:])
    half = " ".join(text(rng, 30) + item[:7] + text(rng, 30))
    found = leaks(spark, [(1, shouted), (2, split), (3, half)], [(1, " ".join(item))])
    assert set(found) == {(1, 1), (2, 1)} and found[2, 1].n_matched == 24


def test_long_passages_of_longer_items(spark):
    rng = random.Random(5)
    item, other = text(rng, 59), text(rng, 500)
    documents = [
        (1, " ".join(text(rng, 40) + item[20:49] + text(rng, 40))),
        (2, " ".join(text(rng, 40) + other[100:300] + text(rng, 40))),
        (3, " ".join(text(rng, 40) + other[:13] + text(rng, 40))),
        (4, " ".join(text(rng, 40) + other[:12] + text(rng, 40) + other[50:60])),
    ]
    found = leaks(spark, documents, [(1, " ".join(item)), (2, " ".join(other))])
    assert {key: r.n_matched for key, r in found.items()} == {(1, 1): 29, (2, 2): 200, (3, 2): 13}
    assert found[1, 1].share < 0.5 and found[2, 2].share == 0.4


def test_short_items(spark):
    items = [(1, "a b c d e"), (2, "x y"), (3, ""), (4, None), (5, "p q r s t u v")]
    documents = [(1, "z a b c d e z"), (2, "x y"), (3, "p q r s t u v"), (4, "a b c d"), (5, None), (6, "")]
    assert set(leaks(spark, documents, items)) == {(1, 1), (3, 5)}


def test_short_items_with_substitutions(spark):
    items = [f"item{n} " + " ".join(f"i{n}t{k}" for k in range(1, n)) for n in range(7, 16)]
    documents, expected = [], set()
    for number, item in enumerate(items):
        for step in range(1, len(item.split()) - 1):
            words = item.split()
            words[step] = "changed"
            if len(words) > 12:
                words[(step + 5) % len(words)] = "other"
            documents.append((len(documents), " ".join(["before"] + words + ["after"])))
            runs, tokens = [], item.split()
            equal = [a == b for a, b in zip(words, tokens)]
            for i in range(len(equal)):
                for j in range(i + 1, len(equal) + 1):
                    runs.append(sum(1 if x else -1 for x in equal[i:j]))
            if max(runs) >= 5:
                expected.add((len(documents) - 1, number))
    assert set(leaks(spark, documents, list(enumerate(items)))) == expected
    assert len(expected) > 60


def test_items_without_spaces(spark):
    items = [(1, "東京は日本の首都です。"), (2, "東京"), (3, "ภาษาไทยเขียนติดกัน")]
    documents = [(1, "質問:東京は日本の、首都です"), (2, "東京"), (3, "京都は古い都です"), (4, "x ภาษาไทยเขียนติดกัน y")]
    found = leaks(spark, documents, items)
    assert set(found) == {(1, 1), (4, 3)} and found[1, 1].share == 1.0


def test_repeated_rows_and_missing_ids(spark):
    rng = random.Random(3)
    item = " ".join(text(rng, 20))
    documents = [(1, item), (1, item), (None, item), (2, " ".join([item] * 400)), (3, "short")]
    found = leaks(spark, documents, [(7, item), (7, item), (8, item), (None, item)])
    assert set(found) == {(1, 7), (1, 8), (2, 7), (2, 8)}
    assert found[2, 7].n_matched == 20 and found[2, 7].last_token == 7999


def test_empty_tables(spark):
    assert leaks(spark, [], [(1, "a b c d e f g h i j")]) == {}
    assert leaks(spark, [(1, "a b c d e f g h i j")], []) == {}


def test_clean_keeps_rows_and_columns(spark):
    docs = spark.createDataFrame([(1, "a"), (2, "b"), (2, "b")], "doc_id long, text string")
    found = spark.createDataFrame([(1, 5), (1, 6)], "doc_id long, item_id long")
    assert [tuple(r) for r in decontamination.clean(docs, found).collect()] == [(2, "b")] * 2


def test_very_short_items_match_if_asked_for(spark):
    items = [(1, "Paris is the capital"), (2, "forty two"), (3, "x"), (4, ""), (5, "a b c d e")]
    documents = [
        (1, "They say that Paris is the capital."), (2, "Forty-two, no: forty two!"), (3, "forty one two"),
        (4, "x"), (5, "a b c d e"), (6, "Paris was the capital"), (7, "forty"),
    ]
    assert set(leaks(spark, documents, items)) == {(5, 5)}
    assert set(leaks(spark, documents, items, least_item_tokens=2)) == {(1, 1), (2, 2), (5, 5)}
    assert set(leaks(spark, documents, items, least_item_tokens=1)) == {(1, 1), (2, 2), (4, 3), (5, 5)}


def test_rows_that_share_an_id_are_compared_one_by_one(spark):
    rng = random.Random(8)
    item, other = text(rng, 20), text(rng, 20)
    long = " ".join(text(rng, 900))
    documents = [(1, long), (1, " ".join(item)), (1, " ".join(item[:15])), (2, long), (2, " ".join(other)),
                 (2, " ".join(other)), (None, " ".join(item))]
    found = leaks(spark, documents, [(1, " ".join(item)), (2, " ".join(other))])
    assert {key: r.share for key, r in found.items()} == {(1, 1): 1.0, (2, 2): 1.0}


def test_a_phrase_of_all_items_and_documents(spark):
    # The phrase alone is no leak; each document holds one item besides.
    rng = random.Random(9)
    phrase = text(rng, 7)
    items = [phrase + text(rng, 30) for _ in range(40)]
    documents = [(i, " ".join(text(rng, 50) + phrase + text(rng, 50) + items[i % 40][7:])) for i in range(120)]
    found = leaks(spark, documents, [(i, " ".join(words)) for i, words in enumerate(items)])
    assert set(found) == {(i, i % 40) for i in range(120)}
    assert all(r.n_matched == 37 for r in found.values())
