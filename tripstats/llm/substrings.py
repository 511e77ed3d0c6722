"""Repeated passages: seeds from winnowed anchors, extended both ways against a partner.

Every window of ``length`` words holds an anchor, the seed (run of ``length // 3`` words) with the
least hash in it; equal windows have equal anchors at the same place.  An anchor with the words around it that
such windows can reach is its context.  Contexts that occur twice repeat as a whole.  Different
contexts of one anchor meet one partner each (the hub): the match is extended to the left and to
the right, word by word, and what repeats is kept if it is long enough.  What a
hub could not decide goes on, with those that left it at the same place with the same
word, to a hub of their own, so no group becomes all its pairs and no repeat is lost: all members of such a group
agree in one more word than before, which ends after at most two contexts' lengths of rounds.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripstats.llm.common import Words, chunks, mixed, spread, stored

LENGTH = 35

_BASE = np.uint64(0x9E3779B97F4A7C15)
# ``place``: the anchor's word, and behind it in 16 bits each the least and greatest number of words
# that a window of this anchor begins before it.
_SEEDS = "text_hash long, place long, anchor long, context long"
_AT, _LOW, _MASK = 32, 16, 0xFFFF
_CONTEXTS = "anchor long, context long, left binary, right binary"
_STEP = """anchor long, context long, covered boolean, known boolean, path long,
  n_left int, n_right int, low int, high int, left binary, right binary"""
_CUT = "doc_id long, n_words long, n_removed long, kept string"


def remove_repeats(
    df: DataFrame, length: int = LENGTH, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row for each row of ``df``: doc_id, n_words, n_removed and kept, the words outside all repeated passages
    joined by one space.

    A passage of ``length`` words is repeated if it starts anywhere else, in the same or in another
    row; all are removed, the first as well.  Words are separated by ASCII white space and compared
    as they are.  Null texts have no words; rows that repeat are repeats of each other, whatever their
    ids; an empty table gives no rows.  Other columns are not read.
    """
    spans = repeats(df, length, text).groupBy("text_hash").agg(
        F.collect_list(F.struct("start", "stop")).alias("spans")
    )
    rows = df.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    joined = rows.withColumn("text_hash", F.xxhash64("text")).join(spans, "text_hash", "left").select(
        "doc_id", "text", F.col("spans.start").alias("starts"), F.col("spans.stop").alias("stops")
    )
    return joined.mapInArrow(_cut, _CUT)


def repeats(df: DataFrame, length: int = LENGTH, text: str = "text") -> DataFrame:
    """text_hash, start, stop: repeated passages as half-open ranges of words.  They cover exactly the repeated
    windows; passages of a text may overlap.  What repeats in a row depends on its text
    alone, so rows are named by the hash (xxhash64) of it, and equal texts share theirs."""
    if not 1 <= length <= _MASK:
        raise ValueError(f"length must be from 1 to {_MASK}, not {length}")
    texts = df.select(F.col(text).alias("text")).where("text is not null")
    texts = texts.withColumn("text_hash", F.xxhash64("text"))
    seeds = stored(texts.mapInArrow(lambda b: _seeds(b, length), _SEEDS), "seeds")
    # Most anchors occur once and go here.  Stored, so that the join can split an anchor that very many share.
    repeated = seeds.groupBy("anchor").agg(
        F.count(F.lit(1)).alias("n"), F.min("context").alias("least"), F.max("context").alias("most")
    ).where("n > 1").select("anchor", (F.col("least") < F.col("most")).alias("differs"))
    repeated = stored(repeated, "repeated-anchors")
    again = stored(seeds.join(repeated, "anchor"), "repeated-seeds")
    reach = F.col("place").bitwiseAND(F.lit((1 << _AT) - 1))
    contexts = stored(
        again.groupBy("anchor", "context", "differs").agg(
            (F.count(F.lit(1)) > 1).alias("known"),
            F.min("text_hash").alias("holder"),
            F.min(reach).alias("reach"),
        ).select(
            "anchor", "context", "differs", "known", "holder",
            F.shiftright("reach", _LOW).cast("int").alias("low"),
            F.col("reach").bitwiseAND(F.lit(_MASK)).cast("int").alias("high"),
        ),
        "contexts",
    )
    differing = contexts.where("differs")
    open_anchors = differing.where("not known").select("anchor").distinct()
    differing = stored(differing.join(open_anchors, "anchor", "left_semi"), "differing")
    found = _extended(_with_words(differing, texts, length), length)
    whole = contexts.where("known").select("anchor", "context", "low", "high")
    places = again.select("anchor", "context", "text_hash", "place").join(
        whole.unionByName(found.distinct()), ["anchor", "context"]
    )
    at = F.shiftright("place", _AT).cast("int")
    return places.select(
        "text_hash", (at - F.col("high")).alias("start"), (at - F.col("low") + length).alias("stop")
    ).distinct()


class _Hashes:
    """Hashes of any run of words of a batch, from running sums of powers."""

    def __init__(self, words: Words):
        self.words = words
        of_words = words.hashes()
        self.each = of_words[words.ids] if len(words.ids) else np.zeros(0, dtype=np.uint64)
        n = len(self.each)
        self.sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(self.each * _powers(_BASE, n), out=self.sums[1:])
        # A run's hash must not depend on where it lies.
        self.back = _powers(np.uint64(pow(int(_BASE), -1, 1 << 64)), n + 1)

    def of(self, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
        """The sum from a start on, moved to a common power."""
        return mixed((self.sums[stops] - self.sums[starts]) * self.back[starts])


def _powers(base: np.uint64, n: int) -> np.ndarray:
    factors = np.full(n, base, dtype=np.uint64)
    factors[:1] = 1
    return np.multiply.accumulate(factors)


class _Anchors:
    """Anchors of a batch: ``at`` (word of the whole batch), the text each lies in, and the
    windows in which it is least, by the number of words they begin before it (low to high)."""

    def __init__(self, hashes: _Hashes, length: int):
        size = seed_size(length)
        width = length - size + 1  # seeds in a window
        words = hashes.words
        n = max(len(hashes.each) - size + 1, 0)
        first = np.arange(n)
        grams = hashes.of(first, first + size)
        owner = spread(words.starts)[:n] if n else np.zeros(0, dtype=np.int64)
        ends = words.starts[1:][owner]  # of the text
        # A window belongs to one text; others do not count.
        whole = first + length <= ends
        least = _sliding(grams, width, np.minimum, np.uint64(2**64 - 1))
        # The greatest of the least hashes of the windows that hold a seed: its own, if it is ever the least.
        reach = _sliding(np.where(whole, least, 0)[::-1], width, np.maximum, np.uint64(0))[::-1]
        short = first + size <= ends
        at = np.flatnonzero((reach == grams) & short)
        self.at, self.grams, self.owner = at, grams[at], owner[at]
        start, end = words.starts[self.owner], words.starts[1:][self.owner]
        high = np.minimum(width - 1, at - start)
        low = np.maximum(0, at + length - end)
        for step in range(1, width):
            before, behind = at - step, at + step
            # Windows that also hold a lesser seed do not have this anchor.
            less = grams[np.maximum(before, 0)] < self.grams
            high = np.where(less & (high >= step), step - 1, high)
            less = grams[np.minimum(behind, max(n - 1, 0))] < self.grams
            reaches = width - 1 - low  # the last seed of a window, seen from the anchor
            low = np.where(less & (reaches >= step), width - step, low)
        kept = (low <= high) & (end - start >= length)
        self.at, self.grams, self.owner = self.at[kept], self.grams[kept], self.owner[kept]
        self.low, self.high = low[kept], high[kept]
        # The context: what those windows cover.
        self.first = self.at - self.high
        self.last = self.at - self.low + length
        self.inside = self.at - words.starts[self.owner]
        mark = (self.high * length + self.low).astype(np.uint64)
        self.contexts = mixed(hashes.of(self.first, self.last) + mark)


def seed_size(length: int) -> int:
    return max(1, length // 3)


def _sliding(values: np.ndarray, width: int, better, rest: np.uint64) -> np.ndarray:
    """``better`` of each value and the ``width - 1`` behind it, by doubling."""

    def ahead(array, by):
        out = np.full(len(array), rest, dtype=np.uint64)
        out[: max(len(array) - by, 0)] = array[by:]
        return out

    best, span = values, 1
    while span * 2 <= width:
        best = better(best, ahead(best, span))
        span *= 2
    return better(best, ahead(best, width - span)) if span < width else best


def _seeds(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    names = ["text_hash", "place", "anchor", "context"]
    for batch in chunks(batches, "text"):
        anchors = _Anchors(_Hashes(Words(batch.column("text"))), length)
        owner = pa.array(anchors.owner)
        place = (anchors.inside << _AT) + (anchors.low << _LOW) + anchors.high
        columns = [
            batch.column("text_hash").take(owner),
            pa.array(place),
            pa.array(anchors.grams.view(np.int64)),
            pa.array(anchors.contexts.view(np.int64)),
        ]
        yield pa.RecordBatch.from_arrays(columns, names=names)


def _with_words(contexts: DataFrame, texts: DataFrame, length: int) -> DataFrame:
    """The contexts with the hashes of their words, nearest first, from one text that holds
    each."""
    wanted = contexts.groupBy(F.col("holder").alias("text_hash")).agg(
        F.collect_set("context").alias("wanted")
    )
    read = texts.join(wanted, "text_hash").select("text", "wanted")
    # Texts that repeat hold the same contexts, and a text may hold one several times.
    read = read.mapInArrow(lambda b: _read_contexts(b, length), _CONTEXTS).groupBy(
        "anchor", "context"
    ).agg(F.min("left").alias("left"), F.min("right").alias("right"))
    reach = length - seed_size(length)
    return contexts.join(read, ["anchor", "context"]).select(
        "anchor", "context", "known",
        F.lit(0).cast("long").alias("path"),
        F.col("high").alias("n_left"), (F.lit(reach) - F.col("low")).alias("n_right"),
        "low", "high", "left", "right",
    )


def _read_contexts(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    size = seed_size(length)
    reach = length - size
    steps = np.arange(reach)
    for batch in chunks(batches, "text"):
        hashes = _Hashes(Words(batch.column("text")))
        anchors = _Anchors(hashes, length)
        wanted = batch.column("wanted")
        number = np.repeat(np.arange(batch.num_rows), wanted.value_lengths().to_numpy())
        pairs = set(zip(number.tolist(), wanted.flatten().to_pylist()))
        contexts = anchors.contexts.view(np.int64)
        chosen = [i for i, pair in enumerate(zip(anchors.owner.tolist(), contexts.tolist())) if pair in pairs]
        for start in range(0, len(chosen), 4096):
            part = np.array(chosen[start : start + 4096], dtype=np.int64)
            at = anchors.at[part][:, None]
            left, right = at - 1 - steps, at + size + steps
            padded = np.append(hashes.each, np.uint64(0))
            end = len(hashes.each)
            left = np.where(left >= anchors.first[part][:, None], left, end)
            right = np.where(right < anchors.last[part][:, None], right, end)
            columns = [
                pa.array(anchors.grams[part].view(np.int64)),
                pa.array(contexts[part]),
                pa.array([row.tobytes() for row in padded[left]], pa.binary()),
                pa.array([row.tobytes() for row in padded[right]], pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["anchor", "context", "left", "right"])


def _extended(rows: DataFrame, length: int) -> DataFrame:
    """anchor, context, low, high: windows of contexts that repeat in another context."""
    reach = length - seed_size(length)
    state, found = stored(rows, "round"), []
    for _ in range(2 * reach + 2):
        groups = state.groupBy("anchor", "path").agg(
            F.count(F.lit(1)).alias("n"),
            F.min("known").alias("all_known"),
            F.min("context").alias("hub"),
        )
        # Known contexts only serve as partners.
        groups = groups.where("n > 1 and not all_known").select("anchor", "path", "hub")
        hubs = groups.join(
            state.select(
                "anchor", "path", F.col("context").alias("hub"), F.col("known").alias("hub_known"),
                F.col("n_left").alias("hub_n_left"), F.col("n_right").alias("hub_n_right"),
                F.col("left").alias("hub_left"), F.col("right").alias("hub_right"),
            ),
            ["anchor", "path", "hub"],
        )
        met = state.join(hubs, ["anchor", "path"]).where("context <> hub")
        out = stored(met.mapInArrow(lambda b: _extend(b, reach), _STEP), "round")
        found.append(out.where("covered").select("anchor", "context", "low", "high"))
        state = out.where("not covered").drop("covered")
        if state.isEmpty():
            break
    else:
        raise RuntimeError("passages were not settled")
    covered = found[0]
    for more in found[1:]:
        covered = covered.union(more)
    return covered


def _extend(batches: Iterator[pa.RecordBatch], reach: int) -> Iterator[pa.RecordBatch]:
    """Each context against its hub: windows that both hold, and what is left, by the place and the
    word at which it leaves the hub."""
    for batch in batches:
        if not batch.num_rows:
            continue
        number = {
            name: batch.column(name).to_numpy(zero_copy_only=False)
            for name in ("anchor", "context", "hub", "path", "n_left", "n_right", "low", "high",
                         "hub_n_left", "hub_n_right", "known", "hub_known")
        }
        left, right = _matrix(batch, "left", reach), _matrix(batch, "right", reach)
        l = np.minimum(_agree(left, _matrix(batch, "hub_left", reach)),
                       np.minimum(number["n_left"], number["hub_n_left"]))
        r = np.minimum(_agree(right, _matrix(batch, "hub_right", reach)),
                       np.minimum(number["n_right"], number["hub_n_right"]))
        low, high = number["low"], number["high"]
        # A window that begins a words before the anchor ends reach - a words behind the seed.
        both = (np.maximum(reach - r, 0), l)
        repeated = both[0] <= both[1]
        every = np.arange(batch.num_rows)
        member = every[repeated & ~number["known"].astype(bool)]
        hub = every[repeated & ~number["hub_known"].astype(bool)]
        yield _step(batch, number, member, "context", True, both[0][member], both[1][member])
        yield _step(batch, number, hub, "hub", True, both[0][hub], both[1][hub])
        further = np.maximum(low, l + 1)
        some = every[further <= high]
        path = _path(number["path"][some], 1, l[some], left[some, np.minimum(l[some], reach - 1)])
        yield _step(batch, number, some, "context", False, further[some], high[some], path)
        until = np.minimum(np.minimum(high, l), reach - r - 1)
        some = every[low <= until]
        path = _path(number["path"][some], 2, r[some], right[some, np.minimum(r[some], reach - 1)])
        yield _step(batch, number, some, "context", False, low[some], until[some], path)


def _matrix(batch: pa.RecordBatch, name: str, reach: int) -> np.ndarray:
    return np.frombuffer(b"".join(batch.column(name).to_pylist()), dtype=np.uint64).reshape(-1, reach)


def _agree(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.logical_and.accumulate(a == b, axis=1).sum(axis=1)


def _path(path: np.ndarray, side: int, extent: np.ndarray, word: np.ndarray) -> np.ndarray:
    turn = np.uint64(side << 32) + extent.astype(np.uint64)
    return mixed(mixed(path.view(np.uint64) + turn) + mixed(word)).view(np.int64)


def _step(batch, number, rows, context, covered, low, high, path=None) -> pa.RecordBatch:
    taken = pa.array(rows)
    n = len(rows)
    nothing = pa.nulls(n, pa.binary())
    columns = [
        pa.array(number["anchor"][rows]),
        pa.array(number[context][rows]),
        pa.array(np.full(n, covered)),
        pa.array(number["known"][rows].astype(bool)),
        pa.array(np.zeros(n, dtype=np.int64) if path is None else path),
        pa.array(number["n_left"][rows].astype(np.int32)),
        pa.array(number["n_right"][rows].astype(np.int32)),
        pa.array(low.astype(np.int32)),
        pa.array(high.astype(np.int32)),
        nothing if covered else batch.column("left").take(taken),
        nothing if covered else batch.column("right").take(taken),
    ]
    names = ["anchor", "context", "covered", "known", "path", "n_left", "n_right", "low", "high", "left", "right"]
    return pa.RecordBatch.from_arrays(columns, names=names)


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in chunks(batches, "text"):
        words = Words(batch.column("text"))
        removed = np.zeros(len(words.ids) + 1, dtype=np.int64)
        starts, stops = batch.column("starts"), batch.column("stops")
        filled = np.diff(words.starts)
        # Rows without spans are null, and count as empty lists.
        counts = np.array([len(s) if s is not None else 0 for s in starts.to_pylist()], dtype=np.int64)
        base = np.repeat(words.starts[:-1], counts)
        np.add.at(removed, base + starts.flatten().to_numpy(zero_copy_only=False).astype(np.int64), 1)
        np.add.at(removed, base + stops.flatten().to_numpy(zero_copy_only=False).astype(np.int64), -1)
        gone = np.cumsum(removed)[:-1] > 0
        kept = []
        for start, stop in zip(words.starts[:-1], words.starts[1:]):
            ids = words.ids[start:stop][~gone[start:stop]]
            kept.append(" ".join([words.vocabulary[i] for i in ids.tolist()]))
        n_removed = np.diff(np.concatenate([[0], np.cumsum(gone)])[words.starts])
        columns = [
            batch.column("doc_id"),
            pa.array(filled.astype(np.int64)),
            pa.array(n_removed.astype(np.int64)),
            pa.array(kept, pa.string()),
        ]
        yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_words", "n_removed", "kept"])
