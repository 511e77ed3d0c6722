"""Benchmark decontamination by spaced seeds.

A mask marks the token positions that a seed reads and skips the others, so a substituted word
under a skipped position leaves the seed as it is.  Seeds of all positions of the training
documents are joined to those of the benchmark; a shared seed gives a diagonal, along which
document and item are compared token by token, mismatches allowed.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripstats.llm.common import Words, chunks, mixed, ragged, stored

# The masks; 1 is read, 0 is skipped.
MASKS = ("111111", "11101011", "1101100111", "110100110101")
# More masks for items of fewer tokens than this.  With those above they meet every overlap of such an
# item that the comparison of a diagonal accepts (all patterns of substitutions were tried).
SHORT_ITEM_TOKENS = 16
LIGHT_MASKS = ("1010011", "10111", "100100011", "11101")
# Shorter items say nothing about where a text comes from, and match nothing unless the caller says so.
LEAST_ITEM_TOKENS = 5
# A document row is sent once for each of so many parts of the items that it may hold.
ITEM_PARTS = 16
# A stretch of a diagonal counts if its matches exceed its mismatches, weighted, by so much.
LEAST_SCORE = 5.0
MISMATCH_WEIGHT = 1.0
# A document leaks an item if such stretches hold this share of the item's tokens.
LEAST_SHARE = 0.5
# Or if one stretch alone matches so many tokens, however long the item is.
LEAST_STRETCH = 13

# Bits of the filter that spares most seeds the join.
FILTER_BITS = 1 << 27

_ALL_MASKS = MASKS + LIGHT_MASKS
# Powers of an odd number, which lose no bit: one for each position of a mask.
_FACTORS = np.multiply.accumulate(np.full(64, 0xD1342543DE82EF95, dtype=np.uint64))

_NO_TOKEN = regex.compile(r"[^\p{L}\p{N}]+")
# Scripts without spaces.
_UNSPACED = regex.compile(r"([\p{Han}\p{Hiragana}\p{Katakana}\p{Thai}\p{Lao}\p{Khmer}\p{Myanmar}])")


def leaks(
    documents: DataFrame,
    benchmark: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    least_share: float = LEAST_SHARE,
    least_stretch: int = LEAST_STRETCH,
    least_item_tokens: int = LEAST_ITEM_TOKENS,
) -> DataFrame:
    """One row for each document and benchmark item that it holds, by share or by one long
    stretch: doc_id, item_id, n_item_tokens, n_matched (item tokens found in stretches of the
    document), share, first_token and last_token (of the document).

    A token is a word without case, punctuation and symbols, or a character of a script
    without spaces.  Null and empty texts have none
    and leak nothing; rows without an id are left out.  Rows that share an id are compared one by one, and that
    with the greatest share is told; of items with one id the longest text counts.  Items of fewer tokens than
    ``least_item_tokens`` match nothing; shorter ones than any mask match as a whole, without
    substitutions.  Other columns are not read.
    """
    items = _texts(benchmark, item_id, item_text)
    seeds = stored(_seeds(items, least_item_tokens), "seeds")
    lengths = [row["n"] for row in seeds.where("mask < 0").select(F.expr("-mask").alias("n")).distinct().collect()]
    light = not seeds.where(F.col("mask") >= len(MASKS)).isEmpty()
    known = _filter_words(seeds)
    hit = stored(_hits(_texts(documents, doc_id, text), sorted(lengths), known, light), "hits")
    # Equal rows are one; rows with one id and other tokens are told apart by these.
    hit = hit.withColumn("row", F.xxhash64("tokens"))
    found = hit.select("id", "row", F.explode("hits").alias("hit")).select("id", "row", "hit.*")
    diagonals = found.join(seeds.withColumnRenamed("id", "item").withColumnRenamed("place", "at"), ["mask", "seed"])
    diagonals = diagonals.select("id", "row", "item", (F.col("place") - F.col("at")).alias("diagonal"))
    pairs = stored(
        diagonals.groupBy("id", "row", "item").agg(F.collect_set("diagonal").alias("diagonals")), "pairs"
    )
    texts = hit.groupBy("id", "row").agg(F.any_value("tokens").alias("tokens"))
    matched = _compare(pairs, texts, _tokens(items))
    share = F.col("n_matched") / F.col("n_item_tokens")
    leaked = (F.col("share") >= least_share) | (F.col("longest") >= least_stretch)
    held = matched.withColumn("share", share).where(leaked)
    told = ["n_item_tokens", "n_matched", "share", "first_token", "last_token"]
    most = F.max_by(F.struct(*told), F.struct("share", "n_matched", "row")).alias("told")
    return held.groupBy(F.col("id").alias("doc_id"), F.col("item").alias("item_id")).agg(most).select(
        "doc_id", "item_id", "told.*"
    )


def clean(documents: DataFrame, found: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """The documents without any leak."""
    dirty = found.select(F.col("doc_id").alias(doc_id)).distinct()
    return documents.join(dirty, doc_id, "left_anti").select(*documents.columns)


def _texts(df: DataFrame, id_: str, text: str) -> DataFrame:
    rows = df.select(F.col(id_).cast("long").alias("id"), F.col(text).alias("text"))
    return rows.where("id is not null and text is not null")


def _one_per_id(rows: DataFrame) -> DataFrame:
    content = F.max_by("tokens", F.struct(F.length("tokens"), F.xxhash64("tokens")))
    return rows.groupBy("id").agg(content.alias("tokens"))


class _Tokens:
    """Hashes of the tokens of some texts; those of text i lie between starts[i] and [i + 1]."""

    def __init__(self, texts: pa.Array):
        words = Words(pc.utf8_lower(texts))
        pieces = [_pieces(word) for word in words.vocabulary]
        counts = np.array([len(own) for own in pieces], dtype=np.int64)
        flat = [xxhash.xxh3_64_intdigest(piece.encode()) for own in pieces for piece in own]
        of_pieces = np.array(flat, dtype=np.uint64)
        lengths = counts[words.ids] if len(words.ids) else np.zeros(0, dtype=np.int64)
        begins = np.cumsum(counts) - counts
        places = ragged(begins[words.ids], lengths) if len(words.ids) else lengths
        self.hashes = of_pieces[places]
        self.starts = np.concatenate([[0], np.cumsum(lengths)])[words.starts]

    def of(self, i: int) -> np.ndarray:
        return self.hashes[self.starts[i] : self.starts[i + 1]]


def _pieces(word: str) -> list[str]:
    """The tokens of a word between spaces: one, but for characters of scripts without spaces."""
    if word.isascii():
        own = [_NO_TOKEN.sub("", word)]
    else:
        own = [_NO_TOKEN.sub("", part) for part in _UNSPACED.split(word)]
    return [piece for piece in own if piece]


def _masked(tokens: _Tokens, mask: int, extra: str | None = None):
    """The seeds of one mask at every place where it fits into a text: (place in
    the batch, seed)."""
    pattern = extra or _ALL_MASKS[mask]
    n, width = len(tokens.hashes), len(pattern)
    ends = np.repeat(tokens.starts[1:], np.diff(tokens.starts))
    places = np.flatnonzero(np.arange(n) + width <= ends)
    # A sum of the tokens read, each by a factor of its position, scrambled at the end.
    sums = np.full(max(n - width + 1, 0), 17 + mask if mask >= 0 else 1000 - mask, dtype=np.uint64)
    for step, bit in enumerate(pattern):
        if bit == "1":
            sums += tokens.hashes[step : step + len(sums)] * _FACTORS[step]
    return places, mixed(sums[places])


def _seeds(items: DataFrame, least_tokens: int) -> DataFrame:
    """(mask, seed, id, place) of the benchmark.  An item shorter than the first mask is one
    seed as a whole, under a mask number of its own."""
    shortest = min(len(mask) for mask in MASKS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "text"):
            tokens = _Tokens(batch.column("text"))
            ids = batch.column("id").to_numpy(zero_copy_only=False)
            lengths = np.diff(tokens.starts)
            owners = np.repeat(np.arange(len(lengths)), lengths)
            short = (lengths < shortest) & (lengths >= max(1, least_tokens))
            plans = [(mask, None) for mask in range(len(_ALL_MASKS))]
            plans += [(-int(n), "1" * int(n)) for n in np.unique(lengths[short])]
            for mask, extra in plans:
                places, seeds = _masked(tokens, mask, extra)
                if mask < 0:
                    whole = lengths[owners[places]] == -mask
                    places, seeds = places[whole], seeds[whole]
                elif mask >= len(MASKS):
                    few = lengths[owners[places]] < SHORT_ITEM_TOKENS
                    places, seeds = places[few], seeds[few]
                of = owners[places]
                columns = [
                    pa.array(np.full(len(places), mask, dtype=np.int32)),
                    pa.array(seeds.view(np.int64)),
                    pa.array(ids[of]),
                    pa.array(places - tokens.starts[of]),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["mask", "seed", "id", "place"])

    return items.mapInArrow(run, "mask int, seed long, id long, place long")


def _filter_words(seeds: DataFrame) -> np.ndarray:
    """A bit for each seed value of the benchmark, in 64-bit words.  At most FILTER_BITS / 64
    rows reach the driver, whatever the size of the benchmark."""
    bit = F.expr(f"seed & {FILTER_BITS - 1}")
    words = seeds.select(F.expr(f"({FILTER_BITS - 1} & seed) >> 6").alias("word"), F.expr("shiftleft(1L, cast(seed & 63 as int))").alias("bits"))
    words = words.groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow()
    known = np.zeros(FILTER_BITS // 64, dtype=np.int64)
    known[words["word"].to_numpy()] = words["bits"].to_numpy()
    return known.view(np.uint64)


def _hits(documents: DataFrame, lengths: list[int], known: np.ndarray, light: bool) -> DataFrame:
    """Documents with a seed that may be the benchmark's: id, tokens and hits (mask, place, seed)."""
    plans = [(mask, None) for mask in range(len(_ALL_MASKS if light else MASKS))]
    plans += [(-n, "1" * n) for n in lengths]
    kind = pa.list_(pa.struct([("mask", pa.int32()), ("place", pa.int64()), ("seed", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "text"):
            tokens = _Tokens(batch.column("text"))
            owners = np.repeat(np.arange(batch.num_rows), np.diff(tokens.starts))
            parts = []
            for mask, extra in plans:
                places, seeds = _masked(tokens, mask, extra)
                low = seeds & np.uint64(FILTER_BITS - 1)
                maybe = known[low >> np.uint64(6)] >> (low & np.uint64(63)) & np.uint64(1) == 1
                places, seeds = places[maybe], seeds[maybe]
                parts.append((np.full(len(places), mask, dtype=np.int32), places, seeds))
            masks, places, seeds = (np.concatenate(column) for column in zip(*parts))
            of = owners[places]
            order = np.argsort(of, kind="stable")
            rows, counts = np.unique(of, return_counts=True)
            values = pa.StructArray.from_arrays(
                [
                    pa.array(masks[order]),
                    pa.array((places - tokens.starts[of])[order]),
                    pa.array(seeds.view(np.int64)[order]),
                ],
                fields=list(kind.value_type),
            )
            offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
            columns = [
                batch.column("id").take(pa.array(rows)),
                pa.array([tokens.of(row).tobytes() for row in rows], pa.binary()),
                pa.ListArray.from_arrays(offsets, values),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "tokens", "hits"])

    fields = "id long, tokens binary, hits array<struct<mask: int, place: long, seed: long>>"
    return documents.mapInArrow(run, fields)


def _tokens(items: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "text"):
            tokens = _Tokens(batch.column("text"))
            content = [tokens.of(i).tobytes() for i in range(batch.num_rows)]
            columns = [batch.column("id"), pa.array(content, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "tokens"])

    return stored(_one_per_id(items.mapInArrow(run, "id long, tokens binary")), "items")


def _compare(pairs: DataFrame, documents: DataFrame, items: DataFrame) -> DataFrame:
    """For each document row and item what the good stretches of all their diagonals match.

    The tokens of a document come once for all items of a part, not once for each diagonal.
    """
    part = F.pmod(F.xxhash64("item"), F.lit(ITEM_PARTS)).alias("part")
    own = F.struct("item", "item_tokens", "diagonals")
    gathered = pairs.join(items.toDF("item", "item_tokens"), "item").groupBy("id", "row", part).agg(
        F.collect_list(own).alias("pairs")
    )
    wide = gathered.join(documents, ["id", "row"]).select("id", "row", "pairs", "tokens")
    names = ["id", "row", "item", "n_item_tokens", "n_matched", "first_token", "last_token", "longest"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for i in range(batch.num_rows):
                document = np.frombuffer(batch.column("tokens")[i].as_py(), np.uint64)
                at = batch.column("id")[i].as_py(), batch.column("row")[i].as_py()
                for pair in batch.column("pairs")[i].as_py():
                    item = np.frombuffer(pair["item_tokens"], np.uint64)
                    found = _matched(document, item, pair["diagonals"])
                    if found:
                        rows.append((*at, pair["item"], len(item), *found))
            columns = [pa.array(column, pa.int64()) for column in (zip(*rows) if rows else [[]] * len(names))]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return wide.mapInArrow(run, ", ".join(f"{name} long" for name in names))


def _matched(document: np.ndarray, item: np.ndarray, diagonals: list[int]) -> tuple[int, ...] | None:
    """How many item tokens the good stretches of some diagonals match, the first and the last place of
    these in the document, and how many the longest stretch has; None if there is none."""
    held, first, last, longest = set(), [], [], 0
    for diagonal in diagonals:
        places, stretch = _good_places(document, item, diagonal)
        if len(places):
            held.update(places.tolist())
            first.append(int(places[0]) + diagonal)
            last.append(int(places[-1]) + diagonal)
            longest = max(longest, stretch)
    return (len(held), min(first), max(last), longest) if held else None


def _good_places(document: np.ndarray, item: np.ndarray, diagonal: int) -> tuple[np.ndarray, int]:
    """Item places matched within the stretches of the diagonal that score enough, and how
    many of them the longest stretch has."""
    start, stop = max(0, -diagonal), min(len(item), len(document) - diagonal)
    equal = item[start:stop] == document[start + diagonal : stop + diagonal]
    # No stretch can score more than it matches.
    if equal.sum() < min(LEAST_SCORE, len(item)):
        return np.zeros(0, dtype=np.int64), 0
    if equal.all():
        good = len(equal) >= min(LEAST_SCORE, len(item))
        return (np.arange(start, stop), len(equal)) if good else (np.zeros(0, dtype=np.int64), 0)
    places, score, best, first, last, longest = [], 0.0, 0.0, start, start, 0
    for at in range(start, stop):
        if score <= 0:
            score, best, first, last = 0.0, 0.0, at, at
        score += 1.0 if equal[at - start] else -MISMATCH_WEIGHT
        if score > best:
            best, last = score, at + 1
        ends = score <= 0 or at + 1 == stop
        if ends and best >= LEAST_SCORE:
            matched = [x for x in range(first, last) if equal[x - start]]
            places.extend(matched)
            longest = max(longest, len(matched))
    return np.array(places, dtype=np.int64), longest
