"""Fitted models: accuracy on held-out rows, repeatability, and odd rows."""

import os

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tripstats.llm import language, quality_model, toxicity
from tripstats.llm.ngrams import word_features
from tripstats.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.01"
needs_tables = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")
ODD = [(1, None), (2, ""), (3, " \n"), (4, "12 34"), (5, "word " * 60_000), (6, "x"), (6, "x")]


def odd(spark, rows=ODD):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    return df.withColumns({"score": F.lit("clash"), "severity": F.lit(1), "lang_pred": F.lit(2)})


@needs_tables
def test_quality_of_held_out_documents(spark):
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet").select("doc_id", "quality")
    rows = QUERIES["op3_quality_classifier"](spark, FOLDER).where("held_out").join(labels, "doc_id")
    right = [row.predicted == row.quality for row in rows.collect()]
    assert len(right) > 50 and np.mean(right) > 0.97


@needs_tables
def test_language_of_held_out_documents(spark):
    langs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "lang")
    rows = QUERIES["op10_language_compression"](spark, FOLDER).where("held_out").join(langs, "doc_id")
    right = [row.lang_pred == row.lang for row in rows.collect()]
    assert len(right) > 200 and np.mean(right) > 0.97


@needs_tables
def test_toxic_documents_are_found(spark):
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet").withColumnRenamed("toxic", "truth")
    rows = QUERIES["op9_toxicity"](spark, FOLDER).join(labels, "doc_id").collect()
    caught = [row.toxic for row in rows if row.truth]
    spared = [not row.toxic for row in rows if not row.truth]
    assert np.mean(caught) > 0.6 and np.mean(spared) > 0.99
    assert all(row.kept != row.toxic and 0 <= row.severity <= toxicity.GRADES for row in rows)


@needs_tables
def test_fits_repeat(spark):
    documents = spark.read.parquet(f"{FOLDER}/documents.parquet")
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    dealt = documents.repartition(3, "text")
    one, two = (toxicity.fit(df, labels, sample_documents=200) for df in (documents, dealt))
    assert np.array_equal(one.weights, two.weights) and np.array_equal(one.features, two.features)
    one, two = (language.fit(df, sample_documents=5) for df in (documents, dealt))
    assert one == two


def test_odd_rows_are_scored(spark):
    words = ("good fine words here", "bad bad bad bad ugly")
    docs = [(i, f"{words[1 - i % 2]} id{i}", i % 2) for i in range(200)]
    df = spark.createDataFrame(docs, "doc_id long, text string, label int")
    labels = df.select("doc_id", F.col("label").alias("quality"), (1 - F.col("label")).alias("toxic"))
    model = quality_model.fit(df, labels)
    scored = quality_model.score(odd(spark), model).collect()
    assert len(scored) == len(ODD) and all(0 <= row.score <= 1 for row in scored)
    assert scored[0].score == scored[1].score == scored[2].score
    graded = toxicity.grade(odd(spark), toxicity.fit(df, labels)).collect()
    assert len(graded) == len(ODD) and len({row.severity for row in graded[:3]}) == 1
    bad = toxicity.grade(df, toxicity.fit(df, labels)).where("toxic").select("label").distinct()
    assert [row.label for row in bad.collect()] == [0]
    model = language.fit(df.withColumn("lang", F.when(F.col("label") == 1, "aa").otherwise("bb")))
    predicted = language.predict(odd(spark), model).collect()
    assert [row.lang_pred for row in predicted[:4]] == ["und"] * 4
    assert all(row.lang_pred in ("aa", "bb") and 0 < row.score <= 1 for row in predicted[4:])
    assert predicted[5].rejected == predicted[6].rejected


def test_nothing_to_learn_from(spark):
    none = spark.createDataFrame([], "doc_id long, text string, lang string, quality int, toxic int")
    labels = none.select("doc_id", "quality", "toxic")
    assert {r.score for r in quality_model.score(odd(spark), quality_model.fit(none, labels)).collect()} == {0.5}
    assert not any(r.toxic for r in toxicity.grade(odd(spark), toxicity.fit(none, labels)).collect())
    assert {r.lang_pred for r in language.predict(odd(spark), language.fit(none)).collect()} == {"und"}
    assert quality_model.score(none, quality_model.fit(none, labels)).count() == 0


def test_a_language_is_rejected_when_margins_are_narrow(spark):
    rows = [(i, text, lang) for i, (text, lang) in enumerate([("alpha beta gamma", "aa"), ("delta eta theta", "bb")] * 3)]
    model = language.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    texts = spark.createDataFrame([("alpha beta gamma alpha",), ("zzz qqq",)], "text string")
    clear, unclear = language.predict(texts, model).collect()
    assert clear.lang_pred == "aa" and not clear.rejected and unclear.rejected


def test_means_are_those_of_the_features():
    texts = ["to be or not not to be", "", "a a a"]
    features = quality_model.Features(pa.array(texts))
    share = np.random.default_rng(0).normal(size=quality_model.BUCKETS)
    means = features.means(share)
    for text, mean in zip(texts, means):
        ids, weights = quality_model._document(text)
        assert abs((share[ids] * weights).sum() - mean) < 1e-9
    assert features.references.tolist() == [[1, 0, 0], [0, 0, 0], [2, 0, 0]]


def test_quality_by_hand(spark):
    """Scores from the embeddings, word by word; long texts are learned from as well."""
    rng = np.random.default_rng(2)
    good, bad = "lorem ipsum dolor sit amet elit".split(), "buy now click here free win".split()
    rows = [(i, " ".join(rng.choice(good if i % 2 else bad, rng.integers(3, 6000))), i % 2) for i in range(120)]
    df = spark.createDataFrame(rows, "doc_id long, text string, quality int")
    labels = df.select("doc_id", "quality")
    assert len(quality_model.labelled_sample(df, labels, "text", "doc_id", "quality", 200, 100)) == 120
    model = quality_model.fit(df, labels, excerpt=500)
    size = quality_model.BUCKETS - quality_model.BACK_REFERENCES

    def by_hand(text):
        words = text.split()
        if not words:
            mean = np.zeros(quality_model.DIMENSIONS)
        else:
            vectors = []
            for at, word in enumerate(words):
                ids, _ = word_features([word], quality_model.SIZES, size)
                vectors.append(model.embeddings[ids].mean(axis=0, dtype=float))
                for back in range(1, quality_model.BACK_REFERENCES + 1):
                    if at >= back and words[at - back] == word:
                        vectors[-1] = vectors[-1] + model.embeddings[size + back - 1]
                        break
            mean = np.sum(vectors, axis=0) / len(words)
        odds = mean @ model.layer + model.bias
        return float(1 / (1 + np.exp(np.clip(odds[0] - odds[1], -500, 500))))

    texts = ["", "lorem", "free free free win", "lorem ipsum buy lorem", "Ünknown words é é", " ".join(good * 50), rows[0][1]]
    got = quality_model.score(spark.createDataFrame([(t,) for t in texts], "text string"), model).collect()
    for row in got:
        assert row.score == pytest.approx(by_hand(row.text), abs=1e-5)
    scores = {r.doc_id: r.score for r in quality_model.score(df, model).collect()}
    assert all((scores[i] > 0.5) == bool(label) for i, _, label in rows)


def test_grade_chances_add_up_and_thresholds_rise(spark):
    rng = np.random.default_rng(1)
    texts = [("w%d " % rng.integers(50)) * 5 + "vile " * int(n) for n in rng.integers(0, 4, 400)]
    toxic = np.array(["vile" in text for text in texts]).astype(int)
    rows = [(i, text, int(t)) for i, (text, t) in enumerate(zip(texts, toxic))]
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    model = toxicity.fit(df, df.select("doc_id", "toxic"))
    assert (np.diff(model.thresholds) > 0).all()
    chances = toxicity._chances(np.linspace(-40, 40, 9), model.thresholds)
    assert np.allclose(chances.sum(axis=1), 1) and (chances >= 0).all()
    severity = chances @ np.arange(chances.shape[1])
    assert (np.diff(severity) >= 0).all()


def plain_features(text):
    """Counts of the features of a text, word by word."""
    import regex

    counts = {}
    words = regex.sub(r"[^\p{L}\p{N}*@$]+", " ", text.lower()).split()
    for word in words:
        parts = [word] + [word[:n] + "\N{HORIZONTAL ELLIPSIS}" for n in toxicity.PREFIXES if len(word) > n]
        for part in parts:
            feature = int(word_features([part], range(0), toxicity.BUCKETS)[0][0])
            counts[feature] = counts.get(feature, 0) + 1
    return counts, len(words)


def test_toxicity_by_hand(spark):
    rng = np.random.default_rng(7)
    plain_words = ["".join(rng.choice(list("aeioustrlm"), rng.integers(3, 9))) for _ in range(300)]
    rows = []
    for i in range(500):
        words = list(rng.choice(plain_words, rng.integers(5, 700)))
        if i % 5 == 0:
            for at in rng.integers(0, len(words), 1 + len(words) // 40):
                words[at] = rng.choice(["vile", "scumbags", "Nasty!"])
        rows.append((i, " ".join(words), int(i % 5 == 0)))
    # Copies count once, and rows without label, id or text do not count.
    rows += [(1000 + i, rows[1][1], 0) for i in range(50)] + [(None, "vile", 1), (2000, None, 1), (2001, "vile", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    model = toxicity.fit(df, df.select("doc_id", "toxic"))
    texts = {text: toxic for i, text, toxic in rows if None not in (i, text, toxic)}
    n, n_toxic = len(texts), sum(texts.values())
    held = {}
    for text, toxic in texts.items():
        for feature in plain_features(text)[0]:
            of = held.setdefault(feature, [0, 0])
            of[0] += toxic
            of[1] += 1
    telling = {
        f for f, (bad, total) in held.items()
        if bad >= 3 and bad - n_toxic * total / n >= 5 * (n_toxic * total / n * (1 - total / n)) ** 0.5
    }
    assert set(model.features.tolist()) <= telling and len(model.features) >= 3
    weight = dict(zip(model.features.tolist(), model.weights))
    got = {r.text: r for r in toxicity.grade(df.where("text is not null"), model).collect()}
    for text in list(texts)[:60] + [" ".join(t for t in texts if not texts[t])]:
        counts, words = plain_features(text)
        scale = min(1.0, 200 / max(words, 1))
        at = sum(weight[f] * np.log1p(c * scale) for f, c in counts.items() if f in weight)
        below = 1 / (1 + np.exp(-np.clip(model.thresholds - at, -50, 50)))
        chances = np.diff([0, *below, 1])
        severity = float(chances @ np.arange(len(chances)))
        if text in got:
            assert got[text].severity == pytest.approx(severity)
            assert got[text].grade == chances.argmax() and got[text].toxic == (severity >= model.limit)
        else:
            assert severity < model.limit  # a hundred thousand clean words


@needs_tables
def test_long_clean_texts_are_kept(spark):
    folder = "/root/testdata/sf0.1"
    if not os.path.isdir(folder):
        pytest.skip("no larger tables")
    documents = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{folder}/labels.parquet").select("doc_id", F.col("toxic").alias("truth"))
    held_out = F.crc32(F.col("doc_id").cast("string")) % 3 == 0
    model = toxicity.fit(documents.where(~held_out), labels.withColumnRenamed("truth", "toxic"))
    graded = toxicity.grade(documents.join(labels, "doc_id"), model)
    long = graded.where("truth = 0 and octet_length(text) > 8000").agg(F.avg((~F.col("toxic")).cast("int"))).first()[0]
    caught = graded.where(held_out & (F.col("truth") == 1)).agg(F.avg(F.col("toxic").cast("int"))).first()[0]
    clean = graded.where(held_out & (F.col("truth") == 0)).agg(F.avg((~F.col("toxic")).cast("int"))).first()[0]
    assert long >= 0.98 and caught >= 0.91 and clean >= 0.98


def test_word_features_know_ngrams():
    ids, starts = word_features(["abc", "xabc", ""], range(3, 4), 1 << 40)
    first, second, empty = (set(ids[a:b]) for a, b in zip(starts, starts[1:]))
    assert (len(first), len(second), len(empty)) == (4, 5, 1)
    assert len(first & second) == 2  # abc and bc>


def letters(rng, alphabet, n):
    return " ".join("".join(rng.choice(list(alphabet), rng.integers(2, 9))) for _ in range(n))


def test_sizes_are_those_of_plain_zstandard(spark):
    import zstandard

    rng = np.random.default_rng(3)
    alphabets = {"aa": "aeioustr", "bb": "bcdfghkl", "cc": "éèàmnopq"}
    rows = [(letters(rng, alphabets[lang], 60), lang) for lang in alphabets for _ in range(30)]
    model = language.fit(spark.createDataFrame(rows * 2, "text string, lang string"), sample_documents=20)
    assert model.languages == ("aa", "bb", "cc")
    texts = [letters(rng, "".join(rng.choice(list(alphabets.values()), 2)), n) for n in (1, 3, 50, 400, 3000) for _ in range(6)]
    got = language.predict(spark.createDataFrame([(t,) for t in texts], "text string"), model).collect()
    settings = zstandard.ZstdCompressionParameters.from_level(
        3, window_log=20, min_match=4, write_content_size=False, write_checksum=False, write_dict_id=False)
    for row in got:
        words = row.text.split(" ")
        content = " ".join(w for i, w in enumerate(words) if not i or w != words[i - 1]).encode()
        sizes = []
        for dictionary in model.dictionaries:
            raw = zstandard.ZstdCompressionDict(dictionary, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            coder = zstandard.ZstdCompressor(dict_data=raw, compression_params=settings)
            sizes.append(sum(len(coder.compress(content[i : i + 1024])) for i in range(0, len(content), 1024)))
        best, second = sorted(sizes)[:2]
        assert row.lang_pred == model.languages[sizes.index(best)]
        assert row.margin == pytest.approx(1 - best / second)
        assert row.rejected == (row.margin < language.NARROW_MARGIN)


@needs_tables
def test_long_texts_are_judged_like_short_ones(spark):
    documents = spark.read.parquet(f"{FOLDER}/documents.parquet")
    model = language.fit(documents)
    own = [r.text for r in documents.where("lang = 'en' and n_chars > 2000").orderBy("doc_id").limit(60).collect()]
    many = " ".join(own)
    whole = (many * (8_000_000 // len(many) + 1))[:8_000_000]
    rows = [(whole[:n],) for n in (590, 610, 100_000, 1_000_000, 8_000_000)]
    got = language.predict(spark.createDataFrame(rows, "text string"), model).collect()
    margins = [row.margin for row in got]
    assert all(row.lang_pred == "en" and not row.rejected for row in got)
    # No step at any length, and no margin that fades.
    assert abs(margins[0] - margins[1]) < 0.03
    assert max(margins[2:]) - min(margins[2:]) < 0.02 and min(margins) > 0.08


def test_copies_and_headers_do_not_fill_the_sample(spark):
    rng = np.random.default_rng(5)
    header = "boilerplate header " * 100
    rows = [(header + letters(rng, "aeioustr", 300), "aa") for _ in range(40)]
    rows += [(letters(rng, "aeioustr", 200), "aa")] * 500 + [(None, "aa"), (" ", "aa"), ("x", None)]
    model = language.fit(spark.createDataFrame(rows, "text string, lang string"), sample_documents=30)
    (dictionary,) = model.dictionaries
    assert len(dictionary.splitlines()) == 30 and len(set(dictionary.splitlines())) >= 25
    # An excerpt from the top would be header alone, 79 times.
    assert dictionary.count(b"boilerplate") < 30 * 79 * 0.75
    with pytest.raises(ValueError, match="more than 1"):
        language.fit(spark.createDataFrame([("x", "aa"), ("y", "bb")], "text string, lang string"), most_languages=1)
