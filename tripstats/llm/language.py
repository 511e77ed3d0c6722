"""Language identification by compression.

Each language has a dictionary of raw text.  A text is encoded with each dictionary in blocks, each of
which sees the dictionary alone, and belongs to the language whose dictionary gives the smallest encoding in all.
So a text's own words never take the place of the dictionary, however long it is.  A narrow margin rejects.
"""

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import groupby

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripstats.llm.common import chunks

UNKNOWN = "und"

# The dictionaries are fitted on a bounded sample: so many distinct texts of each language, and
# an excerpt of so many characters of each, from anywhere in it.
SAMPLE_DOCUMENTS = 120
EXCERPT_CHARACTERS = 1500
# More languages than this are refused rather than gathered.
MOST_LANGUAGES = 200

# A text is encoded in blocks of so many bytes, at one level.
BLOCK_BYTES = 1024
LEVEL, MIN_MATCH, WINDOW_LOG = 3, 4, 20
# Rejected: the best encoding is not smaller than the second by this share.
NARROW_MARGIN = 0.02

OUTPUT = "lang_pred string, score double, margin double, rejected boolean"


@dataclass(frozen=True)
class Model:
    languages: tuple[str, ...]
    dictionaries: tuple[bytes, ...]
    narrow_margin: float = NARROW_MARGIN


def fit(
    df: DataFrame,
    text: str = "text",
    lang: str = "lang",
    sample_documents: int = SAMPLE_DOCUMENTS,
    excerpt: int = EXCERPT_CHARACTERS,
    narrow_margin: float = NARROW_MARGIN,
    most_languages: int = MOST_LANGUAGES,
) -> Model:
    """Dictionaries from the rows of ``df`` whose language is known.

    The sample goes by a hash of the text, so it depends neither on partitions nor on ids, and
    a text with many copies is in it once.  An excerpt begins at a place that the same hash
    gives.  Rows without text or language are left out; with none left there are no
    languages, and every text is unknown.
    """
    rows = df.select(F.col(lang).alias("lang"), F.col(text).alias("text"))
    rows = rows.where("lang is not null and trim(text) != ''").withColumn("place", F.xxhash64("text"))
    # The rank is filtered within each task first: a language with most rows sends few.
    first = Window.partitionBy("lang").orderBy("place")
    chosen = rows.select("lang", "place").distinct().withColumn("rank", F.row_number().over(first))
    chosen = chosen.where(F.col("rank") <= sample_documents)
    start = F.pmod("place", F.greatest(F.length("text") - excerpt + 1, F.lit(1))).cast("int") + 1
    # So many rows a language, whatever the size of the corpus.
    sample = rows.join(F.broadcast(chosen), ["lang", "place"]).select(
        "lang", "place", F.substring("text", start, F.lit(excerpt)).alias("text")
    ).dropDuplicates(["lang", "place"])
    found: dict[str, list[str]] = {}
    for row in sample.orderBy("lang", "place").toLocalIterator():
        found.setdefault(row["lang"], []).append(row["text"])
        if len(found) > most_languages:
            raise ValueError(f"more than {most_languages} languages")
    languages = tuple(sorted(found))
    joined = (_plain(pa.array(found[x], pa.string())) for x in languages)
    dictionaries = tuple("\n".join(texts.to_pylist()).encode() for texts in joined)
    return Model(languages, dictionaries, narrow_margin)


def predict(df: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``df`` with lang_pred, score, margin and rejected.

    ``margin`` is the share by which the second smallest encoding is larger, ``score`` the
    weight of the best among all, if each byte of encoding halves it.  Null texts, texts
    without a letter and all texts of a model without languages are ``und`` with score 0,
    rejected.  Equal sizes go to the first language by name.  Long texts are judged like short ones:
    sizes add up block by block, and the margin stays that of the blocks.  Columns of these names are
    replaced; others pass through.
    """
    kept = df.drop(*(field.split()[0] for field in OUTPUT.split(", ")))
    schema = kept.schema.simpleString()[len("struct<") : -1]
    fields = f"{schema},{OUTPUT}" if schema else OUTPUT

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoders = _Encoders(model)
        for batch in chunks(batches, text):
            yield encoders.extend(batch, text)

    return kept.mapInArrow(encode, fields)


class _Encoders:
    def __init__(self, model: Model):
        self.model = model
        settings = zstandard.ZstdCompressionParameters.from_level(
            LEVEL, window_log=WINDOW_LOG, min_match=MIN_MATCH,
            write_content_size=False, write_checksum=False, write_dict_id=False,
        )
        self.encoders = []
        for content in model.dictionaries:
            raw = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            raw.precompute_compress(compression_params=settings)
            self.encoders.append(zstandard.ZstdCompressor(dict_data=raw, compression_params=settings))

    def extend(self, batch: pa.RecordBatch, text: str) -> pa.RecordBatch:
        sizes = np.array(
            [self.sizes(_once(plain)) for plain in _plain(batch.column(text)).to_pylist()],
            dtype=np.int64,
        ).reshape(batch.num_rows, len(self.model.languages))
        columns = _decide(sizes, self.model)
        names = batch.schema.names + ["lang_pred", "score", "margin", "rejected"]
        return pa.RecordBatch.from_arrays([*batch.columns, *columns], names=names)

    def sizes(self, plain: str) -> list[int]:
        content = plain.encode()
        blocks = [content[at : at + BLOCK_BYTES] for at in range(0, len(content), BLOCK_BYTES)]
        return [sum(len(encoder.compress(block)) for block in blocks) for encoder in self.encoders]


def _plain(texts: pa.Array) -> pa.Array:
    """Lower-case letters with single spaces; empty if there is no letter."""
    low = pc.utf8_lower(pc.fill_null(texts, ""))
    plain = pc.utf8_trim_whitespace(pc.replace_substring_regex(low, r"[^\p{L}\p{M}]+", " "))
    return pc.if_else(pc.match_substring_regex(low, r"\p{L}"), plain, "")


def _once(plain: str) -> str:
    """Runs of one word written once: repeats cost next to nothing with any dictionary, and what
    is left of the sizes would be chance."""
    return " ".join(word for word, _ in groupby(plain.split(" ")))


def _decide(sizes: np.ndarray, model: Model) -> list[pa.Array]:
    n, languages = sizes.shape
    if not languages:
        unknown = np.ones(n, dtype=bool)
        best = np.zeros(n, dtype=np.int64)
        score = margin = np.zeros(n)
    else:
        unknown = sizes.min(axis=1) == 0
        best = sizes.argmin(axis=1)
        ordered = np.sort(sizes, axis=1)
        weights = np.exp2(np.maximum(ordered[:, :1] - ordered, -60.0))
        score = np.where(unknown, 0.0, 1.0 / weights.sum(axis=1))
        second = ordered[:, 1] if languages > 1 else 2 * np.maximum(ordered[:, 0], 1)
        margin = np.where(unknown, 0.0, 1.0 - ordered[:, 0] / np.maximum(second, 1))
    names = np.array([*model.languages, UNKNOWN], dtype=object)
    chosen = names[np.where(unknown, languages, best)]
    return [
        pa.array(chosen, pa.string()),
        pa.array(score, pa.float64()),
        pa.array(margin, pa.float64()),
        pa.array(unknown | (margin < model.narrow_margin), pa.bool_()),
    ]
