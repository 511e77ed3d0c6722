"""Hard negatives by exact inner products, scored the Four Russians' way.

Components become integers, and a row's integers are kept as bit planes: one byte for each group of eight
dimensions and each bit.  For an anchor, the sums of all 256 subsets of the components of a group
are a table; a byte of a candidate's plane picks the sum of the dimensions that have this bit.  Planes are
added from the highest down, doubling between them, which gives the full product.

Anchors and candidates are dealt into blocks, and each pair of blocks is one task's work.  A block hands on the few
best of its candidates for each anchor, so no task holds all scores of an anchor.
"""

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tripstats.llm.common import ragged, stored

SCALE = 256
# Rows of a block, at most; small tables are cut finer, for the sake of all cores.
ANCHOR_BLOCK = 4096
ROW_BLOCK = 65_536
LEAST_BLOCK = 1024
# Scored at a time: the tables and sums of so many stay in the processor's cache.
_ANCHORS, _ROWS = 64, 4096

_POSITIVES = "anchor_id long, positive_id long, positive_score long"
_NEGATIVES = _POSITIVES + ", negative_id long, negative_score long"


@dataclass(frozen=True)
class Settings:
    """Positives of an anchor, negatives of a positive, and the range of a negative's score, in hundredths of
    the positive's."""

    positives: int = 5
    negatives: int = 5
    least: int = 80
    most: int = 100


@dataclass(frozen=True)
class _Shape:
    bits: int
    groups: int


def hard_negatives(
    df: DataFrame,
    is_anchor: Column,
    settings: Settings = Settings(),
    vec_id: str = "vec_id",
    label: str = "label",
    vector: str = "embedding",
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score and negative_score, for the rows where
    ``is_anchor`` (an expression on the id, called ``vec_id``) holds.

    Rows with a null id, label or vector, and those with a null, infinite or undefined component take no
    part.  Vectors of different lengths are taken as padded with zeros.  Higher scores come first, ties by
    the smaller id.  Rows that repeat count once; of anchors with one id and different
    contents the one with the least label and vector counts, and positives with one id and score are one.  Anchors without positives, and positives
    without a negative in range, give no rows, nor does an empty table.  Products beyond 62 bits are refused.
    Other columns are not read.
    """
    rows, shape = _packed(df, vec_id, label, vector)
    anchors = rows.where(is_anchor).groupBy("vec_id").agg(
        F.min(F.struct("label", "planes")).alias("least")
    )
    anchors = stored(anchors.select("vec_id", "least.*"), "anchors")
    n_anchors, n_rows = anchors.count(), rows.count()
    slots = df.sparkSession.sparkContext.defaultParallelism
    anchor_blocks = max(1, math.ceil(n_anchors / ANCHOR_BLOCK))
    row_blocks = max(1, math.ceil(n_rows / ROW_BLOCK), min(math.ceil(n_rows / LEAST_BLOCK), 2 * slots))

    def meet(chosen: DataFrame, find, schema: str) -> DataFrame:
        row_block = F.pmod(F.xxhash64("vec_id", "planes"), F.lit(row_blocks))
        anchor_block = F.pmod(F.xxhash64("vec_id"), F.lit(anchor_blocks))
        left = rows.withColumn("row_block", row_block.cast("int")).withColumn(
            "anchor_block", F.explode(F.sequence(F.lit(0), F.lit(anchor_blocks - 1)))
        )
        right = chosen.withColumn("anchor_block", anchor_block.cast("int")).withColumn(
            "row_block", F.explode(F.sequence(F.lit(0), F.lit(row_blocks - 1)))
        )
        key = ["anchor_block", "row_block"]
        # A pair of blocks is much work for few bytes: each gets a task, whatever its size.
        left, right = (side.repartition(anchor_blocks * row_blocks, *key) for side in (left, right))
        return left.groupBy(*key).cogroup(right.groupBy(*key)).applyInArrow(
            lambda a, b: find(a, b, shape, settings), schema
        )

    best = _first(
        meet(anchors, _positives, _POSITIVES), ["anchor_id"], "positive_score", "positive_id", settings.positives
    )
    chosen = best.groupBy("anchor_id").agg(
        F.array_sort(F.collect_set(F.struct("positive_score", "positive_id"))).alias("positives")
    )
    chosen = anchors.join(chosen, anchors["vec_id"] == chosen["anchor_id"]).drop("anchor_id")
    near = _first(
        meet(stored(chosen, "positives"), _negatives, _NEGATIVES),
        ["anchor_id", "positive_id", "positive_score"], "negative_score", "negative_id", settings.negatives,
    )
    return near.select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    )


def _first(found: DataFrame, group: list[str], score: str, key: str, most: int) -> DataFrame:
    order = Window.partitionBy(*group).orderBy(F.desc(score), key)
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most)


def _packed(df: DataFrame, vec_id: str, label: str, vector: str) -> tuple[DataFrame, _Shape]:
    """Distinct usable rows as vec_id, label and planes."""
    component = F.col("vector")
    odd = F.exists(component, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = df.select(
        F.col(vec_id).cast("long").alias("vec_id"),
        F.col(label).cast("long").alias("label"),
        F.col(vector).cast("array<double>").alias("vector"),
    ).where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & component.isNotNull() & ~odd)
    rows = rows.withColumn("vector", F.transform(component, lambda x: F.floor(x * SCALE)))
    ends = rows.agg(
        F.min(F.array_min("vector")).alias("least"),
        F.max(F.array_max("vector")).alias("most"),
        F.max(F.size("vector")).alias("size"),
    ).first()
    least, most, size = ends["least"] or 0, ends["most"] or 0, ends["size"] or 0
    # One bit more for the sign.
    bits = max(most.bit_length(), (-least - 1).bit_length() if least < 0 else 0) + 1
    if 2 * bits + size.bit_length() > 62:
        raise ValueError(f"components from {least} to {most} are too large for exact products")
    shape = _Shape(bits, max(1, -(-size // 8)))
    packed = rows.mapInArrow(
        lambda batches: (_pack(batch, shape) for batch in batches), "vec_id long, label long, planes binary"
    )
    return stored(packed.distinct(), "planes"), shape


def _pack(batch: pa.RecordBatch, shape: _Shape) -> pa.RecordBatch:
    vectors = batch.column("vector")
    lengths = vectors.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    n, width = batch.num_rows, shape.groups * 8
    values = np.zeros(n * width, dtype=np.int64)
    values[ragged(np.arange(n) * width, lengths)] = vectors.flatten().to_numpy(zero_copy_only=False)
    values = values.reshape(n, width)
    planes = np.stack(
        [np.packbits((values >> bit) & 1, axis=1, bitorder="little") for bit in range(shape.bits)], axis=1
    ) if n else np.zeros((0, shape.bits, shape.groups), dtype=np.uint8)
    packed = pa.array([row.tobytes() for row in planes], pa.binary())
    return pa.RecordBatch.from_arrays(
        [batch.column("vec_id"), batch.column("label"), packed], names=["vec_id", "label", "planes"]
    )


class _Rows:
    """The rows of one block by label and id."""

    def __init__(self, table: pa.Table, shape: _Shape):
        self.ids = table.column("vec_id").to_numpy()
        self.labels = table.column("label").to_numpy()
        joined = b"".join(table.column("planes").to_pylist())
        self.planes = np.frombuffer(joined, dtype=np.uint8).reshape(-1, shape.bits, shape.groups)
        self.order = np.lexsort((self.ids, self.labels))
        self.ids, self.labels = self.ids[self.order], self.labels[self.order]
        self.planes = self.planes[self.order]

    def components(self, start: int, stop: int) -> np.ndarray:
        """The integers of some rows, from their planes."""
        planes = self.planes[start:stop]
        bits = np.unpackbits(planes, axis=2, bitorder="little").astype(np.int64)
        weights = np.int64(1) << np.arange(planes.shape[1], dtype=np.int64)
        weights[-1] = -weights[-1]
        return np.einsum("nbd,b->nd", bits, weights)


def _tables(components: np.ndarray, wide: bool) -> np.ndarray:
    """[group, subset, anchor]: the sum of each subset of the eight components of a group."""
    anchors, width = components.shape
    kind = np.int64 if wide else np.int32
    grouped = components.T.reshape(width // 8, 8, anchors).astype(kind)
    sums = np.zeros((width // 8, 256, anchors), dtype=kind)
    for bit in range(8):
        held = 1 << bit
        sums[:, held : 2 * held] = sums[:, :held] + grouped[:, bit][:, None]
    return sums


def _scores(tables: np.ndarray, planes: np.ndarray) -> np.ndarray:
    """[row, anchor]: inner products."""
    rows, bits, groups = planes.shape
    total = np.zeros((rows, tables.shape[2]), dtype=tables.dtype)
    picked = np.empty_like(total)
    for bit in range(bits - 1, -1, -1):
        total += total
        # The highest bit is the sign: it counts negative.
        add = np.subtract if bit == bits - 1 else np.add
        for group in range(groups):
            np.take(tables[group], planes[:, bit, group], axis=0, out=picked, mode="clip")
            add(total, picked, out=total)
    return total


def _wide(shape: _Shape) -> bool:
    return 2 * shape.bits + (8 * shape.groups).bit_length() > 31


def _positives(left: pa.Table, right: pa.Table, shape: _Shape, settings: Settings) -> pa.Table:
    """The best rows of this block with an anchor's label, for each anchor."""
    out = []
    if left.num_rows and right.num_rows:
        rows, anchors = _Rows(left, shape), _Rows(right, shape)
        for label in np.unique(anchors.labels):
            first, last = np.searchsorted(anchors.labels, [label, label + 1])
            begin, end = np.searchsorted(rows.labels, [label, label + 1])
            for start in range(first, last, _ANCHORS):
                stop = min(start + _ANCHORS, last)
                tables = _tables(anchors.components(start, stop), _wide(shape))
                best = _Best(settings.positives)
                for at in range(begin, end, _ROWS):
                    until = min(at + _ROWS, end)
                    scores = _scores(tables, rows.planes[at:until]).astype(np.int64)
                    other = rows.ids[at:until][:, None] != anchors.ids[start:stop]
                    best.add_least(scores, other, rows.ids[at:until])
                anchor, row_id, score = best.rows()
                out.append((anchors.ids[start:stop][anchor], row_id, score))
    return _columns(out, _POSITIVES)


def _negatives(left: pa.Table, right: pa.Table, shape: _Shape, settings: Settings) -> pa.Table:
    """The best rows of this block with another label and a score in the range of each positive."""
    out = []
    if left.num_rows and right.num_rows:
        rows, anchors = _Rows(left, shape), _Rows(right, shape)
        lists = right.column("positives").to_pylist()
        positives = [lists[i] for i in anchors.order]
        for start in range(0, len(anchors.ids), _ANCHORS):
            stop = min(start + _ANCHORS, len(anchors.ids))
            tables = _tables(anchors.components(start, stop), _wide(shape))
            owner = np.array([i for i in range(start, stop) for _ in positives[i]], dtype=np.int64) - start
            wanted = [p for i in range(start, stop) for p in positives[i]]
            score = np.array([p["positive_score"] for p in wanted], dtype=np.int64)
            ids = np.array([p["positive_id"] for p in wanted], dtype=np.int64)
            # Whole numbers within the range; below zero the range is turned round and empty.
            floor = -((-settings.least * score) // 100)
            ceiling = (settings.most * score) // 100
            lowest = np.full(stop - start, np.iinfo(np.int64).max)
            highest = np.full(stop - start, np.iinfo(np.int64).min)
            np.minimum.at(lowest, owner, floor)
            np.maximum.at(highest, owner, ceiling)
            best = _Best(settings.negatives)
            for at in range(0, len(rows.ids), _ROWS):
                until = min(at + _ROWS, len(rows.ids))
                scores = _scores(tables, rows.planes[at:until])
                near = (scores >= lowest) & (scores <= highest)
                near &= rows.labels[at:until][:, None] != anchors.labels[start:stop]
                row, anchor = np.nonzero(near)
                if not len(row):
                    continue
                # A row may be in the range of several positives of its anchor.
                first = np.searchsorted(owner, anchor)
                counts = np.searchsorted(owner, anchor, side="right") - first
                pair = ragged(first, counts)
                row, found = np.repeat(row, counts), np.repeat(scores[row, anchor].astype(np.int64), counts)
                fits = (found >= floor[pair]) & (found <= ceiling[pair])
                best.add(pair[fits], rows.ids[at:until][row[fits]], found[fits])
            pair, row_id, found = best.rows()
            out.append((anchors.ids[start:stop][owner[pair]], ids[pair], score[pair], row_id, found))
    return _columns(out, _NEGATIVES)


class _Best:
    """The first few of each list by falling score, then by id."""

    def __init__(self, most: int):
        self.most = most
        self.kept = tuple(np.zeros(0, dtype=np.int64) for _ in range(3))

    def add(self, key: np.ndarray, row_id: np.ndarray, score: np.ndarray) -> None:
        key, row_id, score = (np.concatenate(pair) for pair in zip(self.kept, (key, row_id, score)))
        order = np.lexsort((row_id, -score, key))
        key, row_id, score = key[order], row_id[order], score[order]
        rank = np.arange(len(key)) - np.searchsorted(key, key)
        first = rank < self.most
        self.kept = key[first], row_id[first], score[first]

    def add_least(self, scores: np.ndarray, taken: np.ndarray, row_ids: np.ndarray) -> None:
        """Of a whole matrix [row, key]: only what may come first is sorted."""
        lowest = np.iinfo(np.int64).min
        scores = np.where(taken, scores, lowest)
        if len(scores) > self.most:
            bound = np.partition(scores, len(scores) - self.most, axis=0)[len(scores) - self.most]
        else:
            bound = np.full(scores.shape[1], lowest)
        row, key = np.nonzero((scores >= bound) & (scores > lowest))
        self.add(key, row_ids[row], scores[row, key])

    def rows(self) -> tuple[np.ndarray, ...]:
        return self.kept


def _columns(parts: list[tuple], schema: str) -> pa.Table:
    names = [column.split()[0] for column in schema.split(", ")]
    joined = [np.concatenate(values) for values in zip(*parts)] if parts else [[]] * len(names)
    return pa.table([pa.array(values, pa.int64()) for values in joined], names=names)
