"""Token-id files: documents as range-coded blocks of ids.

A file is a run of frames.  A frame holds whole documents: a fixed head, the id and the number of
tokens of each document, the number of code words and the checksum of each block, and the code
words.  Each block of BLOCK_IDS ids is coded from an empty model, so it can be read alone.
Files hold ascending document ids, and later files hold larger ones.
"""

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tripstats.llm import range_coder
from tripstats.llm.common import chunks, release_memory, stored
from tripstats.llm.range_coder import BLOCK_IDS, MOST_IDS
from tripstats.llm.tokens import TEXT_BYTES, Cut, shared_encoder

END_ID = 0
# The head of a frame (mark, version, length of what follows, documents, ids, blocks,
# size of the vocabulary).
MARK = b"IDRC"
VERSION = 4
HEAD = struct.Struct("<4sIQQQQQ")
# The writer puts a line end behind each frame.
FRAME_END = b"\n"

# A frame is closed when it holds so many ids; its blocks are coded side by side.
FRAME_IDS = 2 << 20
# Files are sorted and read whole by one task: a file takes the ids of about so many bytes of text.
FILE_TEXT_BYTES = 64 << 20


def write_files(
    df: DataFrame,
    path: str,
    tokenizer: str,
    cut: Cut = Cut.SPACE_LEADS,
    doc_id: str = "doc_id",
    text: str = "text",
    end_id: int = END_ID,
    files: int | None = None,
) -> None:
    """Write the ids of all texts to the folder ``path``, in ascending order of ``doc_id``.

    Each document ends with ``end_id``; null and empty texts are that alone.  Rows that repeat an
    id lie side by side in an order of their texts; rows without an id are left out.  A text may be of
    any length: its ids run through as many blocks as they need.  Other
    columns are not stored.  No table rows give no frame.  There are as many files as the bytes of the
    texts ask for, or ``files``.
    """
    rows = df.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    rows = rows.where("doc_id is not null")
    if files is None:
        slots = df.sparkSession.sparkContext.defaultParallelism
        held = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
        files = max(slots, -(-held // FILE_TEXT_BYTES))
    order = ("doc_id", F.xxhash64("text"), "text")
    dealt = rows.repartitionByRange(files, "doc_id", F.xxhash64("text")).sortWithinPartitions(*order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = shared_encoder(tokenizer, cut)
        # Far smaller vocabularies are coded alike.
        most_ids = max(MOST_IDS, encoder.tokenizer.get_vocab_size(with_added_tokens=True), end_id + 1)
        doc_ids, sizes, parts, held = [], [], [], 0
        for batch in chunks(batches, "text", TEXT_BYTES):
            ids, starts = encoder.encode(batch.column("text"))
            doc_ids.extend(batch.column("doc_id").to_pylist())
            sizes.append(np.diff(starts) + 1)
            ended = np.insert(ids, starts[1:], end_id)
            parts.append(ended)
            held += len(ended)
            if held >= FRAME_IDS:
                yield _row(doc_ids, sizes, parts, most_ids)
                doc_ids, sizes, parts, held = [], [], [], 0
        if doc_ids:
            yield _row(doc_ids, sizes, parts, most_ids)

    frames = dealt.mapInArrow(run, "frame binary")
    # The text writer puts the bytes of a string down as they are, whatever they are.
    frames.select(F.col("frame").cast("string")).write.text(path)


def read_files(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """One row a document: doc_id, start (ids of all documents before it), n_tokens and
    ids_crc32, and with ``with_ids`` the ids themselves.  A damaged block stops the job."""
    fields = "file string, place long, doc_id long, local long, n_tokens long, ids_crc32 long"
    fields += ", ids array<int>" if with_ids else ""
    names = [field.split()[0] for field in fields.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, content in zip(batch.column("path").to_pylist(), batch.column("content")):
                place = local = 0
                for doc_ids, sizes, ids in read_frames(content.as_buffer()):
                    ends = np.cumsum(sizes)
                    starts = ends - sizes
                    content = ids.astype("<u4")
                    checks = [zlib.crc32(content[a:b]) for a, b in zip(starts, ends)]
                    n = len(sizes)
                    columns = [
                        pa.array([file] * n, pa.string()),
                        pa.array(place + np.arange(n)),
                        pa.array(doc_ids),
                        pa.array(local + starts),
                        pa.array(sizes),
                        pa.array(checks, pa.int64()),
                    ]
                    if with_ids:
                        offsets = np.append(starts, ends[-1]).astype(np.int32)
                        columns.append(pa.ListArray.from_arrays(offsets, ids.astype(np.int32)))
                    place, local = place + n, local + int(ends[-1])
                    yield pa.RecordBatch.from_arrays(columns, names=names)
                    release_memory()

    content = spark.read.format("binaryFile").load(path).where("length > 0")
    rows = content.select("path", "content").mapInArrow(run, fields)
    if with_ids:
        # The ids are not stored once more: the heads of the frames are read first.
        totals = _totals(spark, path)
    else:
        rows = stored(rows, "token-rows")
        totals = rows.groupBy("file").agg(F.sum("n_tokens").alias("total"))
    # One row a file.
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select("file", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base"))
    joined = rows.join(bases, "file")
    start = (F.col("local") + F.col("base")).alias("start")
    rest = ["ids"] if with_ids else []
    return joined.select("doc_id", start, "n_tokens", "ids_crc32", *rest)


def _totals(spark: SparkSession, path: str) -> DataFrame:
    """Ids of each file, from the heads of its frames."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            files = batch.column("path").to_pylist()
            totals = [_total(content.as_buffer()) for content in batch.column("content")]
            columns = [pa.array(files, pa.string()), pa.array(totals, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["file", "total"])

    content = spark.read.format("binaryFile").load(path).where("length > 0")
    return content.select("path", "content").mapInArrow(run, "file string, total long")


def read_frames(content: memoryview) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(document ids, tokens of each, all ids) of each frame of a file."""
    for n_docs, n_ids, n_blocks, most_ids, body in _frames(content):
        at = 0
        doc_ids = np.frombuffer(body, "<i8", n_docs, at)
        at += 8 * n_docs
        sizes = np.frombuffer(body, "<u4", n_docs, at).astype(np.int64)
        at += 4 * n_docs
        n_words, checks = np.frombuffer(body, "<u4", 2 * n_blocks, at).reshape(2, n_blocks)
        at += 8 * n_blocks
        words = []
        for n, check in zip(n_words.tolist(), checks.tolist()):
            code = body[at : at + 2 * n]
            if zlib.crc32(code) != check:
                raise ValueError("a block of a token file is damaged")
            words.append(np.frombuffer(code, "<u2"))
            at += 2 * n
        ids = range_coder.decode(words, _block_lengths(n_ids), most_ids)
        yield doc_ids, sizes, ids.reshape(-1)[:n_ids]


def frame_bytes(
    doc_ids: np.ndarray, sizes: np.ndarray, ids: np.ndarray, most_ids: int = MOST_IDS
) -> bytes:
    lengths = _block_lengths(len(ids))
    width = int(lengths[0]) if len(lengths) else 0
    blocks = np.zeros((len(lengths), width), dtype=np.uint32)
    blocks.reshape(-1)[: len(ids)] = ids
    codes = [words.astype("<u2").tobytes() for words in range_coder.encode(blocks, lengths, most_ids)]
    n_words = np.array([len(code) // 2 for code in codes], dtype="<u4")
    checks = np.array([zlib.crc32(code) for code in codes], dtype="<u4")
    body = b"".join(
        [
            np.asarray(doc_ids, dtype="<i8").tobytes(),
            np.asarray(sizes, dtype="<u4").tobytes(),
            n_words.tobytes(),
            checks.tobytes(),
            *codes,
        ]
    )
    head = HEAD.pack(MARK, VERSION, len(body), len(sizes), len(ids), len(lengths), most_ids)
    return head + body


def _row(doc_ids, sizes, parts, most_ids) -> pa.RecordBatch:
    frame = frame_bytes(np.array(doc_ids), np.concatenate(sizes), np.concatenate(parts), most_ids)
    return pa.RecordBatch.from_arrays([pa.array([frame], pa.binary())], names=["frame"])


def _block_lengths(n_ids: int) -> np.ndarray:
    full, rest = divmod(n_ids, BLOCK_IDS)
    return np.array([BLOCK_IDS] * full + [rest] * (rest > 0), dtype=np.int64)


def _frames(content: memoryview):
    content = memoryview(content)
    at = 0
    while at < len(content):
        mark, version, length, n_docs, n_ids, n_blocks, most_ids = HEAD.unpack_from(content, at)
        if mark != MARK or version != VERSION:
            raise ValueError("not a token file")
        at += HEAD.size
        yield n_docs, n_ids, n_blocks, most_ids, content[at : at + length]
        at += length + len(FRAME_END)


def _total(content: memoryview) -> int:
    return sum(n_ids for _, n_ids, _, _, _ in _frames(content))
