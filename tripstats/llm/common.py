"""Tables, stored steps and Arrow batches shared by the operators."""

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripstats.workspace import scratch_path

# Text that one step of a Python task holds as words; a longer text is a step of its own.
CHUNK_BYTES = 1 << 20

# glibc keeps freed memory; other C libraries have no such call.
_TRIM = getattr(ctypes.CDLL(None), "malloc_trim", None)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back: later steps start from files
    that outlive any executor."""
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fold(doc_id: str, folds: int) -> Column:
    """Remainder of the checksum of an id written as text."""
    return F.crc32(F.col(doc_id).cast("string")) % folds


def chunks(
    batches: Iterator[pa.RecordBatch], text: str, most_bytes: int = CHUNK_BYTES
) -> Iterator[pa.RecordBatch]:
    """The batches cut so that each holds about ``most_bytes`` of text, or one row.

    The pieces are copies: some functions on strings misread arrays that begin inside
    the buffers of another.
    """
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0)
        ends = np.cumsum(sizes.to_numpy(zero_copy_only=False).astype(np.int64))
        start = 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            stop = int(np.searchsorted(ends, before + most_bytes, side="right"))
            stop = max(stop, start + 1)
            yield batch.take(pa.array(np.arange(start, stop)))
            start = stop
        # Workers live on; what was freed but not given back would add up in them.
        release_memory()


def release_memory() -> None:
    """Give freed memory of this process back to the system."""
    pa.default_memory_pool().release_unused()
    if _TRIM is not None:
        _TRIM(0)


class Words:
    """The words of a batch of texts: ``vocabulary`` holds each once, ``ids`` has one entry
    a word, and those of text i lie between ``starts[i]`` and ``starts[i + 1]``.  Words
    are separated by ASCII white space.  Null texts have none."""

    def __init__(self, texts: pa.Array):
        split = pc.ascii_split_whitespace(pc.fill_null(texts.cast(pa.large_string()), ""))
        lengths = pc.list_value_length(split).to_numpy(zero_copy_only=False).astype(np.int64)
        coded = split.flatten().dictionary_encode()
        ids = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        # Far faster than to_pylist.
        self.vocabulary: list[str] = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        # White space at either end of a text leaves an empty word.
        filled = np.array([word != "" for word in self.vocabulary], dtype=bool)
        kept = filled[ids] if len(ids) else np.zeros(0, dtype=bool)
        before = np.concatenate([[0], np.cumsum(kept)])
        self.starts = before[np.concatenate([[0], np.cumsum(lengths)])]
        self.ids = ids[kept]

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word of the vocabulary."""
        digest = xxhash.xxh3_64_intdigest
        return np.array([digest(word.encode()) for word in self.vocabulary], dtype=np.uint64)


def mixed(values: np.ndarray) -> np.ndarray:
    """Scrambled 64-bit values."""
    values = (values ^ (values >> np.uint64(32))) * np.uint64(0x9E3779B97F4A7C15)
    values = (values ^ (values >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return values ^ (values >> np.uint64(32))


def spread(starts: np.ndarray) -> np.ndarray:
    """For each word, the number of its text."""
    return np.repeat(np.arange(len(starts) - 1), np.diff(starts))


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Positions start, start + 1, ... of each span, one after another."""
    if not len(lengths):
        return np.zeros(0, dtype=np.int64)
    ends = np.cumsum(lengths)
    places = np.repeat(starts - (ends - lengths), lengths)
    places += np.arange(ends[-1])
    return places
