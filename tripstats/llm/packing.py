"""Best-fit packing by minimum bin slack.

Documents become pieces of at most ``capacity`` tokens.  Only the number of pieces of each
length matters for the packing, and there are no more lengths than ``capacity``: so the fills are
planned on these counts, and every piece finds its place by its rank among those of its length.

A fill takes the longest piece left and, by dynamic programming over a bitset of reachable
sums, the combination of other lengths that leaves the least slack.  It is used for as
many sequences as the counts allow, then the next fill is planned.
"""

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripstats.llm.common import chunks, stored
from tripstats.llm.tokens import TEXT_BYTES, Cut, shared_encoder

CAPACITY = 4096
END_ID = 1

PIECE_FIELDS = (
    "doc_id long, piece int, start long, length long, ids_crc32 long, part int, place long"
)


def pack(
    df: DataFrame,
    tokenizer: str,
    cut: Cut = Cut.SPACE_DROPPED,
    doc_id: str = "doc_id",
    text: str = "text",
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    keep_ids: bool = False,
) -> DataFrame:
    """One row a piece: doc_id, piece, start, length, ids_crc32, sequence_id and offset, and
    with ``keep_ids`` the ids themselves.

    A document's ids are those of its text and ``end_id``; a null text is empty, so every
    row has one piece or more.  Documents of up to ``capacity`` ids stay whole, longer ones
    are cut every ``capacity`` ids, so a text of any length is a run of pieces.  Repeated rows and ids are
    packed like others; which of equally long pieces goes where follows the order of reading.
    Other columns are not returned.
    """
    cut_up = stored(pieces(df, tokenizer, cut, doc_id, text, capacity, end_id, keep_ids), "pieces")
    counts = cut_up.groupBy("length", "part").agg(F.max("place").alias("last"))
    counts = stored(counts.select("length", "part", (F.col("last") + 1).alias("n")), "lengths")
    # At most one row a length reaches the driver.
    by_length = {
        row["length"]: row["n"] for row in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()
    }
    slots = Slots(plan(by_length, capacity), capacity)
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select(
        "length", "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base")
    )
    ranked = cut_up.join(bases, ["length", "part"])
    columns = [c for c in cut_up.columns if c not in ("part", "place")]
    ranked = ranked.select(*columns, (F.col("place") + F.col("base")).alias("rank"))
    fields = ranked.drop("rank").schema.simpleString()[len("struct<") : -1]

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths = batch.column("length").to_numpy(zero_copy_only=False)
            ranks = batch.column("rank").to_numpy(zero_copy_only=False)
            sequence, offset = slots.of(lengths, ranks)
            rest = [batch.column(name) for name in columns]
            yield pa.RecordBatch.from_arrays(
                [*rest, pa.array(sequence), pa.array(offset)],
                names=[*columns, "sequence_id", "offset"],
            )

    return ranked.mapInArrow(put, f"{fields}, sequence_id long, offset long")


def pieces(df, tokenizer, cut, doc_id, text, capacity, end_id, keep_ids) -> DataFrame:
    """The pieces of all documents; ``place`` counts those of one length in one task."""
    fields = PIECE_FIELDS + (", ids array<int>" if keep_ids else "")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = shared_encoder(tokenizer, cut)
        part = TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, dtype=np.int64)
        for batch in chunks(batches, "text", TEXT_BYTES):
            ids, starts = encoder.encode(batch.column("text"))
            yield _cut(batch, ids, starts, capacity, end_id, part, seen, keep_ids)

    rows = df.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(run, fields)


def sequences(packed: DataFrame) -> DataFrame:
    """sequence_id, doc_ids and ids of each sequence, from pieces packed with their ids.  A
    sequence is bounded by the capacity."""
    ordered = F.sort_array(F.collect_list(F.struct("offset", "doc_id", "ids")))
    return packed.groupBy("sequence_id").agg(ordered.alias("p")).select(
        "sequence_id", F.col("p.doc_id").alias("doc_ids"), F.flatten("p.ids").alias("ids")
    )


def _cut(batch, ids, starts, capacity, end_id, part, seen, keep_ids) -> pa.RecordBatch:
    doc_ids = batch.column("doc_id").to_pylist()
    rows: list[tuple] = []
    for i, doc_id in enumerate(doc_ids):
        own = np.append(ids[starts[i] : starts[i + 1]], np.uint32(end_id)).astype("<u4")
        for piece, start in enumerate(range(0, len(own), capacity)):
            content = own[start : start + capacity]
            length = len(content)
            row = (doc_id, piece, start, length, zlib.crc32(content), part, int(seen[length]))
            rows.append(row + (content.astype(np.int32),) if keep_ids else row)
            seen[length] += 1
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64()]
    names = ["doc_id", "piece", "start", "length", "ids_crc32", "part", "place"]
    if keep_ids:
        kinds.append(pa.list_(pa.int32()))
        names.append("ids")
    columns = [pa.array(column, kind) for column, kind in zip(zip(*rows), kinds)]
    return pa.RecordBatch.from_arrays(columns, names=names)


def plan(counts: dict[int, int], capacity: int) -> list[tuple[dict[int, int], int]]:
    """Fills and how often each is used: ({length: pieces of it}, sequences)."""
    left = {length: n for length, n in counts.items() if n > 0}
    order = sorted(left, reverse=True)
    fills = []
    while order:
        fill = best_fill(left, order, capacity)
        times = min(left[length] // n for length, n in fill.items())
        fills.append((fill, times))
        for length, n in fill.items():
            left[length] -= n * times
            if not left[length]:
                del left[length]
        order = [length for length in order if length in left]
    return fills


def best_fill(left: dict[int, int], order: list[int], capacity: int) -> dict[int, int]:
    """The longest length and the lengths that fill most of what it leaves."""
    longest = order[0]
    room = capacity - longest
    reachable, steps = 1, []
    mask = (1 << (room + 1)) - 1
    for length in order:
        most = left[length] - (length == longest)
        most = min(most, room // length)
        group = 1
        # Groups of 1, 2, 4, ... pieces make every number of them.
        while most > 0:
            group = min(group, most)
            more = (reachable | reachable << (group * length)) & mask
            if more != reachable:
                steps.append((reachable, length, group))
                reachable = more
            most -= group
            group *= 2
        if reachable >> room:
            break
    total = reachable.bit_length() - 1
    fill = {longest: 1}
    for before, length, group in reversed(steps):
        if not before >> total & 1:
            fill[length] = fill.get(length, 0) + group
            total -= group * length
    return fill


class Slots:
    """Sequence and offset of the piece with a given rank among those of its length."""

    def __init__(self, fills: list[tuple[dict[int, int], int]], capacity: int):
        taken: dict[int, int] = {}
        rows = []
        sequence = 0
        for fill, times in fills:
            offset = 0
            for length, n in fill.items():
                first = taken.get(length, 0)
                rows.append((length, first, n, sequence, offset))
                taken[length] = first + n * times
                offset += length * n
            sequence += times
        self.n_sequences = sequence
        table = np.array(sorted(rows), dtype=np.int64).reshape(len(rows), 5)
        self.lengths, self.firsts, self.per, self.sequences, self.offsets = table.T
        # Lengths and ranks in one number, so that one search finds the row.
        self.bits = int(max(taken.values(), default=1)).bit_length()
        self.keys = (self.lengths << self.bits) | self.firsts

    def of(self, lengths: np.ndarray, ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        row = np.searchsorted(self.keys, (lengths << self.bits) | ranks, side="right") - 1
        at = ranks - self.firsts[row]
        per = self.per[row]
        return self.sequences[row] + at // per, self.offsets[row] + at % per * lengths
