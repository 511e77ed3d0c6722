"""Toxicity: cumulative-link ordinal regression on sparse text features.

A text's features are its hashed words and word beginnings, counted per so many words, so that long
texts are judged like short ones.  One weight a feature is shared by
all thresholds: P(grade <= k) = logistic(threshold_k - weights . features).  The result is
the expected grade.

The labels only say toxic or not, so grades come from both: 0 for clean documents, and for
toxic ones 1 to 3 by how much they hold of the features that tell toxic documents from clean ones.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripstats.llm.common import Words, chunks, spread, stored
from tripstats.llm.ngrams import word_features
from tripstats.operators.lookup import fits

BUCKETS = 1 << 20
PREFIXES = range(4, 8)
GRADES = 3
# A feature carries a weight if it is in so many toxic documents, in such a share of
# them, and by so many standard deviations more often than chance would have it.  All labelled
# documents are counted.
LEAST_DOCUMENTS = 3
LEAST_SHARE = 0.005
LEAST_DEVIATIONS = 5.0
STEPS = 400
RATE = 0.05
PENALTY = 1e-6
# Rejected from this expected grade on.
LIMIT = 0.4

# Counts are those in so many words; shorter texts count as they are.
REFERENCE_WORDS = 200

# The weights are fitted on a bounded sample of labelled documents, of which only the counts of telling
# features are gathered, whatever their length.
SAMPLE_DOCUMENTS = 12_000
# Labels up to this size are sent to every task; beyond, they are joined by a shuffle.
LABEL_BYTES = 64 << 20

OUTPUT = "severity double, grade int, toxic boolean"


@dataclass(frozen=True)
class Model:
    """``features`` in order, the weight of each, and the rising thresholds between grades."""

    features: np.ndarray
    weights: np.ndarray
    thresholds: np.ndarray
    limit: float = LIMIT


def fit(
    df: DataFrame,
    labels: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    label: str = "toxic",
    sample_documents: int = SAMPLE_DOCUMENTS,
    limit: float = LIMIT,
) -> Model:
    """Learn from the documents that have a label.

    Features are counted over all of them, by partial sums; a text with many copies counts once.  The
    sample goes by a hash of the text.  Rows without text, id or label are left out; of labels
    of one id, and of one text, the greatest counts.  Without
    toxic or without clean rows there is nothing to learn, and every text gets grade 0.
    """
    marks = labels.select(F.col(doc_id).alias("id"), F.col(label).cast("int").alias("label"))
    marks = marks.dropna().groupBy("id").agg((F.max("label") > 0).cast("int").alias("label"))
    rows = df.select(F.col(doc_id).alias("id"), F.col(text).alias("text")).dropna()
    places = _joined(rows.withColumn("place", F.xxhash64("text")).select("id", "place"), marks)
    firsts = places.groupBy("place").agg(F.min("id").alias("id"), F.max("label").alias("label"))
    chosen = stored(firsts, "labelled")
    totals = chosen.agg(F.count(F.lit(1)).alias("n"), F.sum("label").alias("toxic")).first()
    n, n_toxic = totals["n"], totals["toxic"] or 0
    if not 0 < n_toxic < n:
        return Model(np.zeros(0, np.int64), np.zeros(0), np.array([30.0]), limit)
    held = _joined(rows, chosen.select("id", "label").dropDuplicates(["id"])).mapInArrow(
        _held, "feature long, in_toxic long, in_all long"
    )
    held = held.groupBy("feature").agg(F.sum("in_toxic").alias("in_toxic"), F.sum("in_all").alias("in_all"))
    share = F.col("in_all") / n
    spread_ = F.sqrt(F.greatest(n_toxic * share * (1 - share), F.lit(1e-9)))
    telling = (F.col("in_toxic") - n_toxic * share >= LEAST_DEVIATIONS * spread_) & (
        F.col("in_toxic") >= max(LEAST_DOCUMENTS, LEAST_SHARE * n_toxic)
    )
    # A number a feature, of BUCKETS at most.
    known = np.sort(held.where(telling).select("feature").toArrow()["feature"].to_numpy().astype(np.int64))
    sample = chosen.orderBy("place").limit(sample_documents).select("id", "label").dropDuplicates(["id"])
    found = rows.join(F.broadcast(sample), "id").mapInArrow(
        _sparse(known), "id string, text_hash long, label int, features array<int>, values array<double>"
    )
    return _learn(found.toArrow(), known, limit)


def _joined(rows: DataFrame, marks: DataFrame) -> DataFrame:
    """The rows with a mark; no text is shuffled if the marks are few enough to be sent."""
    return rows.join(F.broadcast(marks) if fits(marks, LABEL_BYTES) else marks, "id")


def _held(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """In how many toxic and in how many documents of a task each feature is."""
    in_toxic, in_all = (np.zeros(BUCKETS, dtype=np.int64) for _ in range(2))
    for batch in chunks(batches, "text"):
        rows, features, _, _, _ = _counts(batch.column("text"), None)
        toxic = batch.column("label").to_numpy() > 0
        np.add.at(in_all, features, 1)
        np.add.at(in_toxic, features[toxic[rows]], 1)
    some = np.flatnonzero(in_all)
    columns = [pa.array(some), pa.array(in_toxic[some]), pa.array(in_all[some])]
    yield pa.RecordBatch.from_arrays(columns, names=["feature", "in_toxic", "in_all"])


def _sparse(known: np.ndarray):
    """The telling features of each document, by their place in ``known``, with their values."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "text"):
            rows, features, counts, scale, n = _counts(batch.column("text"), known)
            offsets = np.searchsorted(rows, np.arange(n + 1)).astype(np.int32)
            columns = [
                batch.column("id").cast(pa.string()),
                pa.array([xxhash.xxh3_64_intdigest(t) >> 1 for t in batch.column("text").to_pylist()], pa.int64()),
                batch.column("label"),
                pa.ListArray.from_arrays(offsets, pa.array(features.astype(np.int32))),
                pa.ListArray.from_arrays(offsets, pa.array(_values(counts, scale[rows]))),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "text_hash", "label", "features", "values"])

    return run


def _values(counts: np.ndarray, scale: np.ndarray) -> np.ndarray:
    return np.log1p(counts * scale)


def grade(df: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``df`` with ``severity`` (the expected grade), ``grade`` (the likeliest one) and ``toxic``
    (severity at or above the model's limit), replacing columns of these names.

    Null and empty texts have no features and get the lowest severity.
    """
    kept = df.drop(*(field.split()[0] for field in OUTPUT.split(", ")))
    schema = kept.schema.simpleString()[len("struct<") : -1]
    fields = f"{schema},{OUTPUT}" if schema else OUTPUT

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, text):
            rows, features, counts, scale, n = _counts(batch.column(text), model.features)
            values = _values(counts, scale[rows])
            at = np.bincount(rows, values * model.weights[features], minlength=n)
            chances = _chances(at, model.thresholds)
            severity = chances @ np.arange(chances.shape[1])
            columns = [
                pa.array(severity, pa.float64()),
                pa.array(chances.argmax(axis=1), pa.int32()),
                pa.array(severity >= model.limit, pa.bool_()),
            ]
            names = [*batch.schema.names, "severity", "grade", "toxic"]
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], names=names)

    return kept.mapInArrow(run, fields)


def _words(texts: pa.Array) -> Words:
    low = pc.utf8_lower(pc.fill_null(texts.cast(pa.large_string()), ""))
    return Words(pc.replace_substring_regex(low, r"[^\p{L}\p{N}*@$]+", " "))


def _counts(texts: pa.Array, known: np.ndarray | None):
    """Sparse counts (text, feature, count), the factor that takes the counts of each text to
    REFERENCE_WORDS, and the number of texts.  With ``known``, only those features, by
    their place in it."""
    words = _words(texts)
    n = len(words.starts) - 1
    scale = np.minimum(1.0, REFERENCE_WORDS / np.maximum(np.diff(words.starts), 1))
    ids, starts = _beginnings(words.vocabulary)
    owner = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
    if known is not None:
        place = np.minimum(np.searchsorted(known, ids), max(len(known) - 1, 0))
        hit = known[place] == ids if len(known) else np.zeros(len(ids), dtype=bool)
        ids, owner = place[hit], owner[hit]
    # Most words have no known feature; only the others are looked up in the texts.
    counts_of = np.bincount(owner, minlength=len(words.vocabulary))
    first = np.concatenate([[0], np.cumsum(counts_of)])
    rows = spread(words.starts)
    used = counts_of[words.ids] > 0 if len(words.ids) else np.zeros(0, dtype=bool)
    word_ids, rows = words.ids[used], rows[used]
    sizes = counts_of[word_ids]
    ends = np.cumsum(sizes)
    total = int(ends[-1]) if len(ends) else 0
    flat = np.arange(total) + np.repeat(first[word_ids] - (ends - sizes), sizes)
    keys = np.repeat(rows, sizes) * np.int64(BUCKETS) + ids[flat]
    keys, counts = np.unique(keys, return_counts=True)
    return keys // BUCKETS, keys % BUCKETS, counts, scale, n


def _beginnings(vocabulary: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Features of each word: itself and its first 4 to 7 characters."""
    owners = np.arange(len(vocabulary))
    lengths = np.array([len(word) for word in vocabulary], dtype=np.int64)
    parts, of = list(vocabulary), [owners]
    for size in PREFIXES:
        longer = owners[lengths > size]
        parts.extend(f"{vocabulary[i][:size]}\N{HORIZONTAL ELLIPSIS}" for i in longer)
        of.append(longer)
    ids, starts = word_features(parts, range(0), BUCKETS)
    of = np.concatenate(of)
    order = np.argsort(of, kind="stable")
    counts = np.bincount(of, minlength=len(vocabulary))
    return ids[starts[:-1]][order] if len(parts) else ids, np.concatenate([[0], np.cumsum(counts)])


def _learn(sample: pa.Table, known: np.ndarray, limit: float) -> Model:
    order = sample.sort_by([("id", "ascending"), ("text_hash", "ascending")]).combine_chunks()
    n = order.num_rows
    toxic = order["label"].to_numpy() > 0
    lists = [order[name].chunk(0) if n else pa.array([], pa.list_(pa.float64())) for name in ("features", "values")]
    sizes = lists[0].value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    place, values = (array.flatten().to_numpy(zero_copy_only=False) for array in lists)
    rows = np.repeat(np.arange(n), sizes)
    if not toxic.any() or toxic.all():
        return Model(np.zeros(0, np.int64), np.zeros(0), np.array([30.0]), limit)
    grades = _grades(toxic, rows, values)
    weights, thresholds = _ascend(rows, place, values, grades, n, len(known))
    used = weights != 0
    return Model(known[used], weights[used], thresholds, limit)


def _grades(toxic: np.ndarray, rows: np.ndarray, values: np.ndarray) -> np.ndarray:
    """0 for clean documents, 1 to GRADES for toxic ones by how much of telling features they hold."""
    held = np.bincount(rows, values, minlength=len(toxic))
    cuts = np.quantile(held[toxic], np.arange(1, GRADES) / GRADES)
    return np.where(toxic, 1 + np.searchsorted(cuts, held, side="left"), 0)


def _chances(at: np.ndarray, thresholds: np.ndarray) -> np.ndarray:
    """Probability of each grade."""
    below = 1.0 / (1.0 + np.exp(-np.clip(thresholds[None, :] - at[:, None], -50, 50)))
    bounds = np.hstack([np.zeros((len(at), 1)), below, np.ones((len(at), 1))])
    return np.diff(bounds, axis=1)


def _ascend(rows, place, values, grades, n, size) -> tuple[np.ndarray, np.ndarray]:
    """Fit by gradient steps with a scale for each parameter (Adam).  The thresholds are a
    first one and positive distances, so they keep their order."""
    weights = np.zeros(size)
    first, steps = np.array([1.0]), np.zeros(GRADES - 1)
    moments = [np.zeros(size + GRADES) for _ in range(2)]
    every = np.arange(n)
    for step in range(1, STEPS + 1):
        thresholds = np.concatenate([first, first + np.cumsum(np.exp(steps))])
        at = np.bincount(rows, values * weights[place], minlength=n)
        below = 1.0 / (1.0 + np.exp(-np.clip(thresholds[None, :] - at[:, None], -50, 50)))
        bounds = np.hstack([np.zeros((n, 1)), below, np.ones((n, 1))])
        slopes = bounds * (1 - bounds)
        chance = np.maximum(bounds[every, grades + 1] - bounds[every, grades], 1e-12)
        upper, lower = slopes[every, grades + 1] / chance, slopes[every, grades] / chance
        # d log P / d threshold of the upper and of the lower bound of the true grade.
        to_at = -(upper - lower)
        to_thresholds = np.bincount(grades, upper, minlength=GRADES + 1)[:GRADES]
        to_thresholds -= np.bincount(grades, lower, minlength=GRADES + 1)[1:]
        to_weights = np.bincount(place, values * to_at[rows], minlength=size) / n - PENALTY * weights
        to_first = to_thresholds.sum()
        to_steps = np.exp(steps) * np.cumsum(to_thresholds[:0:-1])[::-1]
        gradient = np.concatenate([to_weights, [to_first / n], to_steps / n])
        moments[0] = 0.9 * moments[0] + 0.1 * gradient
        moments[1] = 0.99 * moments[1] + 0.01 * gradient**2
        move = RATE * (moments[0] / (1 - 0.9**step)) / (np.sqrt(moments[1] / (1 - 0.99**step)) + 1e-9)
        weights = weights + move[:size]
        first = first + move[size]
        steps = steps + move[size + 1 :]
    return weights, np.concatenate([first, first + np.cumsum(np.exp(steps))])
