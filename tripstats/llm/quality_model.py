"""Quality classifier: supervised subword embeddings.

A word's vector is the mean of the learned vectors of the word and its character n-grams, all
hashed.  A document is the mean of its words and word pairs; a softmax layer gives the
probability of each label.  Word pairs are hashed with back references (a word equal to the
one before it is written as such), so that a repetition is one feature whatever the word.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripstats.llm.common import Words, chunks, spread
from tripstats.llm.ngrams import word_features

BUCKETS = 1 << 17
DIMENSIONS = 12
SIZES = range(2, 5)
# Features that are no words: equal to the word before, and to the second or third before.
BACK_REFERENCES = 3
EPOCHS = 6
BATCH = 32
RATE = 0.4

# The classifier is fitted on a bounded sample of labelled documents: at most so many, and of each an
# excerpt of at most so many characters, from anywhere in it.
SAMPLE_DOCUMENTS = 3000
EXCERPT_CHARACTERS = 20_000


@dataclass(frozen=True)
class Model:
    """``share[f]`` is what feature f adds to the log odds of label 1; as the layers after the
    mean are linear, the vectors fold into one number each for scoring."""

    embeddings: np.ndarray
    layer: np.ndarray
    bias: np.ndarray

    @property
    def share(self) -> np.ndarray:
        return self.embeddings @ (self.layer[:, 1] - self.layer[:, 0])

    @property
    def base(self) -> float:
        return float(self.bias[1] - self.bias[0])


def fit(
    df: DataFrame,
    labels: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    label: str = "quality",
    sample_documents: int = SAMPLE_DOCUMENTS,
    excerpt: int = EXCERPT_CHARACTERS,
) -> Model:
    """Learn from the documents that have a label, however long they are.

    The sample goes by a hash of the id, the place of an excerpt by one of the text.  Rows without text or label are left out; without any
    row the model scores every text 0.5.
    """
    sample = labelled_sample(df, labels, text, doc_id, label, sample_documents, excerpt)
    return _learn([row["text"] for row in sample], np.array([row["label"] for row in sample]))


def labelled_sample(df, labels, text, doc_id, label, most, excerpt) -> list:
    """At most ``most`` rows (id, text, label), those first by a hash of the id, with excerpts of the texts."""
    marks = labels.select(F.col(doc_id).alias("id"), F.col(label).cast("int").alias("label"))
    marks = marks.where("id is not null and label is not null").dropDuplicates(["id"])
    rows = df.select(F.col(doc_id).alias("id"), F.col(text).alias("text"))
    rows = rows.where("text is not null")
    # Ids are chosen before any text moves; a task sends no more rows than are wanted.
    ids = rows.select("id").join(marks, "id", "left_semi").distinct()
    place = F.xxhash64(F.col("id").cast("string"))
    chosen = ids.orderBy(place, "id").limit(most).join(marks, "id")
    first = F.pmod(F.xxhash64("text"), F.greatest(F.length("text") - excerpt + 1, F.lit(1))).cast("int")
    part = F.substring("text", first + 1, F.lit(excerpt)).alias("text")
    found = rows.join(F.broadcast(chosen), "id").select("id", "label", part)
    # One text an id, however many rows repeat it.
    found = found.groupBy("id", "label").agg(F.max("text").alias("text"))
    return sorted(found.collect(), key=lambda row: row["id"])


def score(df: DataFrame, model: Model, text: str = "text", column: str = "score") -> DataFrame:
    """``df`` with the probability of label 1 in ``column``, replacing a column of that name.

    Null and empty texts get the probability of a document without features.
    """
    kept = df.drop(column)
    schema = kept.schema.simpleString()[len("struct<") : -1]
    fields = f"{schema},{column} double" if schema else f"{column} double"
    share, base = model.share, model.base

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, text):
            features = Features(batch.column(text))
            odds = features.means(share) + base
            chance = 1.0 / (1.0 + np.exp(-np.clip(odds, -500, 500)))
            columns = [*batch.columns, pa.array(chance, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, column])

    return kept.mapInArrow(run, fields)


class Features:
    """The words of some texts, the features of each word, and the back references."""

    def __init__(self, texts: pa.Array):
        self.words = Words(texts)
        self.n = len(self.words.starts) - 1
        self.texts = spread(self.words.starts)
        self.ids, self.starts = word_features(
            self.words.vocabulary, SIZES, BUCKETS - BACK_REFERENCES
        )
        self.sizes = np.diff(self.starts)
        # Each word also forms a pair; only those that repeat a word are features.
        self.references = np.zeros((self.n, BACK_REFERENCES))
        ids, rows = self.words.ids, self.texts
        open_ = np.ones(len(ids), dtype=bool)
        for back in range(1, BACK_REFERENCES + 1):
            if len(ids) <= back:
                break
            same = (ids[back:] == ids[:-back]) & (rows[back:] == rows[:-back]) & open_[back:]
            open_[back:] &= ~same
            self.references[:, back - 1] = np.bincount(rows[back:][same], minlength=self.n)
        self.totals = np.maximum(np.diff(self.words.starts), 1)

    def means(self, share: np.ndarray) -> np.ndarray:
        """For each text the mean over its words of the means of their features' shares."""
        if not len(self.words.ids):
            return np.zeros(self.n)
        of_words = np.add.reduceat(share[self.ids], self.starts[:-1]) / self.sizes
        sums = np.bincount(self.texts, of_words[self.words.ids], minlength=self.n)
        sums += self.references @ share[BUCKETS - BACK_REFERENCES :]
        return sums / self.totals


def _learn(texts: list[str], labels: np.ndarray) -> Model:
    rng = np.random.default_rng(7)
    embeddings = rng.uniform(-0.5, 0.5, (BUCKETS, DIMENSIONS)) / DIMENSIONS
    layer, bias = np.zeros((DIMENSIONS, 2)), np.zeros(2)
    layer[:, 1] = 1.0 / DIMENSIONS
    if not len(texts):
        return Model(embeddings.astype(np.float32), np.zeros((DIMENSIONS, 2)), bias)
    documents = [_document(text) for text in texts]
    steps, total = 0, EPOCHS * len(documents)
    for _ in range(EPOCHS):
        order = rng.permutation(len(documents))
        for at in range(0, len(order), BATCH):
            batch = order[at : at + BATCH]
            rate = RATE * (1 - steps / total)
            steps += len(batch)
            ids = np.concatenate([documents[i][0] for i in batch])
            weights = np.concatenate([documents[i][1] for i in batch])
            starts = np.cumsum([0] + [len(documents[i][0]) for i in batch[:-1]])
            hidden = np.add.reduceat(embeddings[ids] * weights[:, None], starts)
            odds = hidden @ layer + bias
            odds -= odds.max(axis=1, keepdims=True)
            chances = np.exp(odds)
            chances /= chances.sum(axis=1, keepdims=True)
            chances[np.arange(len(batch)), labels[batch]] -= 1.0
            back = chances @ layer.T
            layer -= rate * hidden.T @ chances
            bias -= rate * chances.sum(axis=0) / len(batch)
            lengths = np.diff([*starts, len(ids)])
            steps_of = np.repeat(back, lengths, axis=0) * weights[:, None]
            # One update for each feature of the batch.
            unique, place = np.unique(ids, return_inverse=True)
            for d in range(DIMENSIONS):
                embeddings[unique, d] -= rate * len(batch) * np.bincount(
                    place, steps_of[:, d], minlength=len(unique)
                )
    return Model(embeddings.astype(np.float32), layer, bias)


def _document(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Feature ids and weights of one text; the weights are those of ``Features.means``."""
    features = Features(pa.array([text], pa.string()))
    counts = np.bincount(features.words.ids, minlength=len(features.sizes)).astype(float)
    counts /= features.totals[0]
    ids = np.concatenate([features.ids, np.arange(BUCKETS - BACK_REFERENCES, BUCKETS)])
    weights = np.concatenate(
        [np.repeat(counts / np.maximum(features.sizes, 1), features.sizes), features.references[0] / features.totals[0]]
    )
    unique, place = np.unique(ids, return_inverse=True)
    return unique, np.bincount(place, weights)
