"""Near-duplicate documents by MinHash.

A document's set is its distinct word shingles.  Documents with equal sets are one class from the
start.  The least values of many universal hash functions over a set form its signature; bands of
the signature are the keys under which similar classes meet.

1. In each bucket the class with the smallest id is the hub, and every other member is
   paired with it.  Pairs whose signatures agree enough are confirmed on the full sets, and
   the links give components.
2. Buckets that still hold several components may hide links between members other than the
   hub.  Their members form groups, cut into blocks; pairs of blocks are searched
   exactly, through the shingles, for links between different components.

So every pair that shares a bucket is decided, but no group ever becomes all its pairs: what
leaves a task is at most one link for each member.
"""

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripstats.llm.common import Words, chunks, mixed, spread, stored
from tripstats.llm.components import components

# A pair at the threshold shares no bucket with less than this chance.
MISS_CHANCE = 1e-6
HASHES = 192
# Signatures count as agreeing down to so many standard deviations below the threshold.
DEVIATIONS = 5.0
# Members of a block, at most; two blocks of sets meet in one task.
BLOCK = 256
# And at most about so many bytes of shingle hashes.
BLOCK_BYTES = 16 << 20

_SKETCH = "doc_id long, n_shingles long, digest binary, signature binary, bands array<long>"


@dataclass(frozen=True)
class Settings:
    """Shingles of ``words`` words; links from ``percent`` on: 100 |A & B| >= percent |A | B|."""

    words: int = 5
    percent: int = 80

    @property
    def rows(self) -> int:
        """Hash values in a band: the most that keeps the chance of a miss."""
        similarity = self.percent / 100
        fits = [
            rows
            for rows in range(1, 17)
            if (1 - similarity**rows) ** (HASHES // rows) <= MISS_CHANCE
        ]
        return max(fits, default=1)

    @property
    def least_agreeing(self) -> int:
        """Equal signature values that a pair must have to be looked at."""
        similarity = self.percent / 100
        deviation = math.sqrt(similarity * (1 - similarity) / HASHES)
        return max(1, math.floor(HASHES * (similarity - DEVIATIONS * deviation)))


def near_duplicates(
    df: DataFrame, settings: Settings = Settings(), doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row a document: doc_id, n_shingles, component_id (the smallest id linked to it,
    itself included) and kept (the document is that one).

    A-Z is lower-cased; words are separated by ASCII white space.  A text with fewer words than a
    shingle is one shingle, a text without words and a null text have none and link
    with nothing.  Texts of any length are compared whole.  Of rows with one id that with the largest set counts,
    of equally large sets that with the greatest digest; rows without an id
    are left out.  Other columns are not read.
    """
    rows = df.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    rows = rows.where("doc_id is not null")
    sketches = stored(_sketches(rows, settings), "sketches")
    full = _one_per_id(sketches.where("n_shingles > 0"))
    classes = stored(full.groupBy("digest").agg(F.min("doc_id").alias("rep")), "classes")
    members = stored(
        full.select("doc_id", "digest").join(classes, "digest").select("doc_id", "rep"), "members"
    )
    reps = members.where("doc_id = rep").select("rep")
    spots = full.select("doc_id", F.posexplode("bands").alias("band", "value"))
    spots = spots.select(
        F.col("doc_id").alias("rep"), F.xxhash64("band", "value").alias("bucket")
    ).join(reps, "rep", "left_semi")
    hubs = spots.groupBy("bucket").agg(F.min("rep").alias("hub"), F.max("rep").alias("last"))
    hubs = stored(hubs.where("hub < last").select("bucket", "hub"), "hubs")
    stars = stored(spots.join(hubs, "bucket").where("rep <> hub"), "stars")
    pairs = stored(stars.select(F.col("hub").alias("a"), F.col("rep").alias("b")).distinct(), "pairs")
    likely = stored(_agreeing(pairs, full, settings), "likely")
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct()
    sets = stored(_sets(rows.join(wanted, "doc_id", "left_semi"), settings), "sets")
    links = stored(_confirmed(likely, sets, settings), "links")
    first = stored(components(links), "components")
    more = stored(_links_between(stars, first, sets, settings), "more-links")
    # These only join components of the first links.
    joined = stored(components(more), "components").toDF("component", "joined")
    joined = joined.withColumnRenamed("component", "first_component")
    # A class takes the component of its smallest id.
    grouped = members.join(first.toDF("rep", "component"), "rep", "left").select(
        "doc_id", F.coalesce("component", "rep").alias("first_component")
    )
    grouped = grouped.join(joined, "first_component", "left").select(
        "doc_id", F.coalesce("joined", "first_component").alias("component_id")
    )
    sizes = sketches.groupBy("doc_id").agg(F.max("n_shingles").alias("n_shingles"))
    least = grouped.groupBy("doc_id").agg(F.min("component_id").alias("component_id"))
    out = sizes.join(least, "doc_id", "left").withColumn(
        "component_id", F.coalesce("component_id", "doc_id")
    )
    return out.withColumn("kept", F.col("doc_id") == F.col("component_id"))


def _one_per_id(sketches: DataFrame) -> DataFrame:
    """Ids are unique as a rule; only where they are not do all sketches meet by id."""
    ends = sketches.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    if ends.isEmpty():
        return sketches
    rest = F.struct(*(c for c in sketches.columns if c != "doc_id"))
    best = sketches.groupBy("doc_id").agg(
        F.max_by(rest, F.struct("n_shingles", "digest")).alias("best")
    )
    return stored(best.select("doc_id", "best.*"), "sketches")


def _sketches(rows: DataFrame, settings: Settings) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "text"):
            yield _sketch(batch, settings)

    return rows.mapInArrow(run, _SKETCH)


def _shingles(texts: pa.Array, size: int) -> list[np.ndarray]:
    """The distinct shingle hashes of each text, in order."""
    low = pc.ascii_lower(pc.fill_null(texts.cast(pa.large_string()), ""))
    words = Words(low)
    of_words = words.hashes()
    hashes = of_words[words.ids] if len(words.ids) else np.zeros(0, dtype=np.uint64)
    n = len(hashes)
    rolling = np.full(n, 7, dtype=np.uint64)
    for step in range(size):
        following = np.zeros(n, dtype=np.uint64)
        following[: max(n - step, 0)] = hashes[step:]
        rolling = mixed(rolling + following * np.uint64(2 * step + 3))
    sets = []
    for start, stop in zip(words.starts[:-1], words.starts[1:]):
        if stop - start >= size:
            sets.append(np.unique(rolling[start : stop - size + 1]))
        elif stop > start:
            whole = xxhash.xxh3_64_intdigest(hashes[start:stop].tobytes(), seed=int(stop - start))
            sets.append(np.array([whole], dtype=np.uint64))
        else:
            sets.append(np.zeros(0, dtype=np.uint64))
    return sets


def _sketch(batch: pa.RecordBatch, settings: Settings) -> pa.RecordBatch:
    sets = _shingles(batch.column("text"), settings.words)
    sizes = np.array([len(s) for s in sets], dtype=np.int64)
    filled = np.flatnonzero(sizes)
    signatures = np.zeros((len(sets), HASHES), dtype=np.uint32)
    if len(filled):
        values = np.concatenate([sets[i] for i in filled])
        starts = np.concatenate([[0], np.cumsum(sizes[filled])[:-1]])
        signatures[filled] = _minima(values, starts)
    rows, bands = settings.rows, HASHES // settings.rows
    banded = signatures[:, : rows * bands].reshape(len(sets), bands, rows).astype(np.uint64)
    keys = np.zeros((len(sets), bands), dtype=np.uint64)
    for row in range(rows):
        keys = mixed(keys + banded[:, :, row])
    offsets = np.arange(len(sets) + 1, dtype=np.int32) * bands
    columns = [
        batch.column("doc_id"),
        pa.array(sizes),
        pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in sets], pa.binary()),
        # The lower halves are enough to compare, and half as much to store.
        pa.array([row.tobytes() for row in signatures.astype(np.uint16)], pa.binary()),
        pa.ListArray.from_arrays(offsets, keys.view(np.int64).reshape(-1)),
    ]
    names = ["doc_id", "n_shingles", "digest", "signature", "bands"]
    return pa.RecordBatch.from_arrays(columns, names=names)


def _minima(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Least value of each hash function a x + b over each set.  Sets are taken some at a time, so
    that the values stay in the processor's cache."""
    rng = np.random.default_rng(11)
    factors = rng.integers(0, 1 << 31, HASHES, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
    shifts = rng.integers(0, 1 << 32, HASHES, dtype=np.uint32)
    folded = (values >> np.uint64(32)).astype(np.uint32)
    out = np.empty((len(starts), HASHES), dtype=np.uint32)
    ends = np.append(starts[1:], len(values))
    at = 0
    while at < len(starts):
        stop = max(at + 1, int(np.searchsorted(ends, starts[at] + (1 << 15), side="right")))
        part = folded[starts[at] : ends[stop - 1]]
        inner = starts[at:stop] - starts[at]
        scratch = np.empty_like(part)
        for k in range(HASHES):
            np.multiply(part, factors[k], out=scratch)
            np.add(scratch, shifts[k], out=scratch)
            out[at:stop, k] = np.minimum.reduceat(scratch, inner)
        at = stop
    return out


def _agreeing(pairs: DataFrame, sketches: DataFrame, settings: Settings) -> DataFrame:
    """The pairs whose signatures agree."""
    known = sketches.select("doc_id", "signature")
    wide = pairs.join(known.toDF("a", "sig_a"), "a").join(known.toDF("b", "sig_b"), "b")
    least = settings.least_agreeing

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = (_matrix(batch.column(name)) for name in ("sig_a", "sig_b"))
            enough = (a == b).sum(axis=1) >= least
            kept = batch.select(["a", "b"]).filter(pa.array(enough))
            yield kept

    return wide.select("a", "b", "sig_a", "sig_b").mapInArrow(run, "a long, b long")


def _matrix(signatures: pa.Array) -> np.ndarray:
    joined = b"".join(signatures.to_pylist())
    return np.frombuffer(joined, dtype=np.uint16).reshape(len(signatures), HASHES)


def _sets(rows: DataFrame, settings: Settings) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "text"):
            sets = _shingles(batch.column("text"), settings.words)
            contents = [s.tobytes() for s in sets]
            columns = [
                batch.column("doc_id"),
                pa.array(contents, pa.binary()),
                pa.array([xxhash.xxh3_128_digest(c) for c in contents], pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "content", "digest"])

    found = rows.mapInArrow(run, "doc_id long, content binary, digest binary")
    # The same choice as among the sketches of one id.
    widest = F.max_by("content", F.struct(F.length("content"), "digest"))
    return found.groupBy("doc_id").agg(widest.alias("content"))


def _confirmed(pairs: DataFrame, sets: DataFrame, settings: Settings) -> DataFrame:
    """The pairs that link, by their full sets."""
    wide = pairs.join(sets.toDF("a", "set_a"), "a").join(sets.toDF("b", "set_b"), "b")
    percent = settings.percent

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            linked = [
                _links(np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64), percent)
                for a, b in zip(batch.column("set_a").to_pylist(), batch.column("set_b").to_pylist())
            ]
            yield batch.select(["a", "b"]).filter(pa.array(linked, pa.bool_()))

    return wide.select("a", "b", "set_a", "set_b").mapInArrow(run, "a long, b long")


def _links(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    if 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
        return False
    shared = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * shared >= percent * (len(a) + len(b) - shared)


def _links_between(
    stars: DataFrame, first: DataFrame, sets: DataFrame, settings: Settings
) -> DataFrame:
    """Pairs of components with a link between members of one bucket, enough to join them."""
    known = first.select(F.col("id").alias("rep"), "component")
    of_member = stars.join(known, "rep", "left").select(
        "bucket", "rep", "hub", F.coalesce("component", "rep").alias("component")
    )
    hubs = stars.select("bucket", F.col("hub").alias("rep"), "hub").distinct()
    of_hub = hubs.join(known, "rep", "left").select(
        "bucket", "rep", "hub", F.coalesce("component", "rep").alias("component")
    )
    spots = stored(of_member.unionByName(of_hub), "spots")
    mixed_buckets = spots.groupBy("bucket").agg(
        F.min("component").alias("low"), F.max("component").alias("high")
    )
    mixed_buckets = stored(mixed_buckets.where("low <> high").select("bucket"), "open-buckets")
    # A hub and one member have been compared already; only buckets of three or more are open.
    open_spots = stored(
        spots.join(mixed_buckets, "bucket", "left_semi").select("rep", "hub", "component"), "open"
    )
    groups = stored(
        components(open_spots.select(F.col("rep").alias("a"), F.col("hub").alias("b"))), "groups"
    )
    labels = open_spots.select("rep", "component").distinct()
    placed = groups.select(F.col("id").alias("rep"), F.col("component").alias("grp"))
    widths = sets.select(F.col("doc_id").alias("rep"), F.length("content").alias("width"))
    counted = placed.join(widths, "rep").groupBy("grp").agg(
        F.count(F.lit(1)).alias("n"), F.sum("width").alias("bytes")
    )
    counted = stored(counted.where("n > 2"), "sizes")
    # Sets of long texts fill a block sooner.
    blocks = F.greatest(F.ceil(F.col("n") / BLOCK), F.ceil(F.col("bytes") / BLOCK_BYTES)).cast("int")
    block = F.pmod(F.xxhash64("rep"), blocks).cast("int")
    placed = placed.join(counted, "grp").join(labels, "rep").select(
        "rep", "component", "grp", blocks.alias("blocks"), block.alias("block")
    )
    # Each member goes to every pair of blocks that has its own.
    meets = F.transform(
        F.sequence(F.lit(0), F.col("blocks") - 1),
        lambda other: F.struct(
            F.least("block", other).alias("low"), F.greatest("block", other).alias("high")
        ),
    )
    placed = placed.withColumn("meet", F.explode(meets)).select(
        "rep", "component", "grp", "block", "meet.low", "meet.high"
    )
    full = placed.join(sets.withColumnRenamed("doc_id", "rep"), "rep")
    percent = settings.percent

    def search(block_pair: pd.DataFrame) -> pd.DataFrame:
        return _search(block_pair, percent)  # pairs of components

    return full.groupBy("grp", "low", "high").applyInPandas(search, "a long, b long")


def _search(members: pd.DataFrame, percent: int) -> pd.DataFrame:
    """Links between different components, at most one fewer than there are components.

    A member is compared with all others through the lists of members that hold each shingle.
    """
    sets = [np.frombuffer(content, np.uint64) for content in members["content"]]
    sizes = np.array([len(s) for s in sets])
    names, component = np.unique(members["component"].to_numpy(), return_inverse=True)
    found: list[tuple[int, int]] = []
    values, place = np.unique(np.concatenate(sets), return_inverse=True)
    owners = np.repeat(np.arange(len(sets)), sizes)
    order = np.argsort(place, kind="stable")
    holders = owners[order]
    firsts = np.searchsorted(place[order], np.arange(len(values) + 1))
    ends = np.cumsum(sizes)
    for i in range(len(sets)):
        if (component == component[i]).all():
            break
        own = place[ends[i] - sizes[i] : ends[i]]
        lengths = firsts[own + 1] - firsts[own]
        stops = np.cumsum(lengths)
        flat = np.arange(stops[-1]) + np.repeat(firsts[own] - (stops - lengths), lengths)
        shared = np.bincount(holders[flat], minlength=len(sets))
        linked = 100 * shared >= percent * (sizes[i] + sizes - shared)
        for j in np.flatnonzero(linked & (component != component[i])):
            if component[j] != component[i]:
                found.append((int(names[component[i]]), int(names[component[j]])))
                component[component == component[j]] = component[i]
    return pd.DataFrame(found, columns=["a", "b"], dtype="int64")
