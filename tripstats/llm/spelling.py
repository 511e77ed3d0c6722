"""Spelling variants: words that one inserted, deleted or replaced character tells apart.

A bit-sliced position index holds, for each position and letter, the set of words with that letter
there, 64 words to a machine word.  A query word walks through its letters once; the words that
agree so far and those with one difference so far are two bit sets, moved on together by word-parallel
steps, where a word with a letter more or less is looked up at the position shifted by one.

Words at distance one share the first or the last half of their letters.  The vocabulary is dealt
by length and half, so a query meets few others; a half that very many words share is dealt
over several shards, and its queries go to each.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripstats.llm.common import ragged, stored

# Fixed values of the word rule.
LETTERS = "A-Za-zÀ-ÿ"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ERROR_RATE = 97
LEAST_LENGTH = 5
LEAST_COUNT = 3
FORM_FACTOR = 2

# Words of one half in one shard.
SHARD_WORDS = 4096
# Letters that one step of a Python task indexes.
STEP_LETTERS = 1 << 15
MAX_ROUNDS = 64

_FIRST, _LAST = 0, 1
_INDEX, _QUERY = 0, 1
_PAIRS = "word string, near string, near_n long"


def variants(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row a word: word, n, n_near, form, form_n and root.

    Words come from all texts; null texts have none, and a null id counts as an empty one.  Rows that repeat
    count each.  Of near words that occur equally often the first in code-point order is the
    form.  A table without words gives no rows.  Other columns are not read.
    """
    words = stored(vocabulary(df, doc_id, text), "vocabulary")
    pairs = near_pairs(words)
    best = pairs.groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"),
        F.min(F.struct((-F.col("near_n")).alias("rank"), F.col("near"))).alias("best"),
    )
    common = -F.col("best.rank") >= FORM_FACTOR * F.col("n")
    formed = stored(
        words.join(best, "word", "left").select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(common, F.col("best.near")).alias("form"),
            F.when(common, -F.col("best.rank")).alias("form_n"),
        ),
        "forms",
    )
    roots = _roots(formed.where("form is not null").select("word", F.col("form").alias("root")))
    return formed.join(roots, "word", "left").withColumn("root", F.coalesce("root", "word"))


def vocabulary(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """word, n: lower-cased runs of letters, with the misspellings that the rule plants."""
    # Shorter runs cannot become words.
    found = F.regexp_extract_all(F.col(text), F.lit(f"[{LETTERS}]{{{LEAST_LENGTH},}}"), F.lit(0))
    runs = df.select(
        F.coalesce(F.col(doc_id).cast("string"), F.lit("")).alias("id"), F.explode(found).alias("run")
    )
    runs = runs.select("id", F.translate("run", UPPER, LOWER).alias("run"))
    runs = runs.withColumn("hash", F.crc32(F.concat("id", F.lit(":"), "run").cast("binary")))
    place = (F.col("hash") % F.length("run")).cast("int")
    shorter = F.concat(
        F.substring("run", F.lit(1), place), F.substring("run", place + 2, F.length("run"))
    )
    word = F.when(F.col("hash") % ERROR_RATE == 0, shorter).otherwise(F.col("run"))
    counted = runs.select(word.alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counted.where((F.col("n") >= LEAST_COUNT) & (F.length("word") >= LEAST_LENGTH))


def near_pairs(words: DataFrame, shard_words: int = SHARD_WORDS) -> DataFrame:
    """word, near, near_n: every ordered pair of words at distance one, once.  ``words`` has each
    word (of at least 3 characters) once, and n."""
    length = F.length("word")
    index = words.select(
        "word", "n", length.alias("size"), F.lit(_INDEX).alias("kind"), _halves(length)
    )
    sizes = F.array(length - 1, length, length + 1)
    queries = words.select("word", "n", F.explode(sizes).alias("size")).select(
        "word", "n", "size", F.lit(_QUERY).alias("kind"), _halves(F.col("size"))
    )
    index = index.select("*", F.explode("halves").alias("at")).select("*", "at.*").drop("halves", "at")
    queries = queries.select("*", F.explode("halves").alias("at")).select("*", "at.*").drop("halves", "at")
    key = ["size", "side", "half"]
    held = index.groupBy(*key).agg(F.count(F.lit(1)).alias("held"))
    hot = held.where(F.col("held") > shard_words).select(
        *key, F.ceil(F.col("held") / shard_words).cast("int").alias("shards")
    )
    shards = F.coalesce("shards", F.lit(1))
    index = index.join(hot, key, "left").withColumn(
        "shard", F.pmod(F.xxhash64("word"), shards).cast("int")
    )
    queries = queries.join(hot, key, "left").withColumn(
        "shard", F.explode(F.sequence(F.lit(0), shards - 1))
    )
    columns = ["size", "side", "half", "shard", "kind", "word", "n"]
    dealt = index.select(columns).union(queries.select(columns))
    dealt = dealt.repartition("size", "side", "half", "shard").sortWithinPartitions(
        "size", "side", "half", "shard", "kind"
    )
    return dealt.mapInArrow(_search, _PAIRS)


def _halves(size: Column) -> Column:
    """Two keys for words of ``size`` characters: a word at distance one has one of them."""
    half = F.floor((size - 1) / 2).cast("int")
    word = F.col("word")
    first = F.struct(F.lit(_FIRST).alias("side"), F.substring(word, F.lit(1), half).alias("half"))
    last = F.struct(F.lit(_LAST).alias("side"), F.right(word, half).alias("half"))
    return F.array(first, last).alias("halves")


def _roots(links: DataFrame) -> DataFrame:
    """(word, root): links followed to the last, twice as far each round.  Along a link the
    count at least doubles, so there is no way back."""
    state = stored(links, "roots")
    for _ in range(MAX_ROUNDS):
        ahead = state.select(F.col("word").alias("root"), F.col("root").alias("beyond"))
        if state.join(ahead, "root", "left_semi").isEmpty():
            return state
        state = stored(
            state.join(ahead, "root", "left").select("word", F.coalesce("beyond", "root").alias("root")),
            "roots",
        )
    raise RuntimeError(f"forms did not settle in {MAX_ROUNDS} rounds")


def _search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs of a sorted stream.  The index rows of a group come before its queries; those of the
    group that a step ends in are kept for the next step."""
    open_key, open_words, open_counts = None, [], []
    for batch in batches:
        keys = list(zip(*(batch.column(c).to_pylist() for c in ("size", "side", "half", "shard"))))
        kinds = batch.column("kind").to_pylist()
        words = batch.column("word").to_pylist()
        counts = batch.column("n").to_pylist()
        at = 0
        while at < len(keys):
            step = _Step()
            if open_key is not None:
                for word, n in zip(open_words, open_counts):
                    step.add_word(open_key, word, n)
            # Only what is new counts, so that each step gets on.
            step.letters = 0
            while at < len(keys) and step.letters < STEP_LETTERS:
                key = keys[at]
                if key != open_key:
                    open_key, open_words, open_counts = key, [], []
                if kinds[at] == _INDEX:
                    step.add_word(key, words[at], counts[at])
                    open_words.append(words[at])
                    open_counts.append(counts[at])
                else:
                    step.add_query(key, words[at])
                at += 1
            yield step.pairs()


class _Step:
    """Some groups of words, and queries for them."""

    def __init__(self):
        self.letters = 0
        self.groups: dict[tuple, int] = {}
        self.words: list[str] = []
        self.counts: list[int] = []
        self.group_of_word: list[int] = []
        self.queries: list[str] = []
        self.group_of_query: list[int] = []
        self.sizes: list[int] = []
        self.sides: list[int] = []

    def _group(self, key: tuple) -> int:
        found = self.groups.get(key)
        if found is None:
            found = self.groups[key] = len(self.groups)
            self.sizes.append(key[0])
            self.sides.append(key[1])
        return found

    def add_word(self, key: tuple, word: str, n: int) -> None:
        self.group_of_word.append(self._group(key))
        self.words.append(word)
        self.counts.append(n)
        self.letters += len(word)

    def add_query(self, key: tuple, word: str) -> None:
        group = self.groups.get(key)
        # A group without words has no pairs.
        if group is not None:
            self.group_of_query.append(group)
            self.queries.append(word)
        self.letters += len(word)

    def pairs(self) -> pa.RecordBatch:
        out = [(np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64))]
        if self.queries:
            index = _Index(self)
            group = np.array(self.group_of_query)
            lengths = np.array([len(word) for word in self.queries])
            sizes = np.array(self.sizes)[group]
            for size, length in sorted(set(zip(sizes.tolist(), lengths.tolist()))):
                chosen = np.flatnonzero((sizes == size) & (lengths == length))
                out += index.near(chosen, [self.queries[i] for i in chosen], group[chosen], size, length)
        asked = np.concatenate([a for a, _ in out])
        found = np.concatenate([b for _, b in out])
        queries, words = pa.array(self.queries, pa.string()), pa.array(self.words, pa.string())
        counts = pa.array(self.counts, pa.int64())
        columns = [queries.take(pa.array(asked)), words.take(pa.array(found)), counts.take(pa.array(found))]
        return pa.RecordBatch.from_arrays(columns, names=["word", "near", "near_n"])


class _Index:
    """Bit sets over the words of a step; each group begins with a machine word of its own."""

    # Pairs of query and machine word that are walked at a time.
    ITEMS = 1 << 16

    def __init__(self, step: _Step):
        group = np.array(step.group_of_word)
        order = np.argsort(group, kind="stable")
        members = np.bincount(group, minlength=len(step.groups))
        slots = -(-members // 64)
        self.first_slot = np.cumsum(slots) - slots
        self.slots = slots
        self.side = np.array(step.sides)
        rank = np.arange(len(order)) - np.repeat(np.cumsum(members) - members, members)
        place = np.repeat(self.first_slot, members) * 64 + rank
        # The word at each bit.
        self.word_at = np.full(int(slots.sum()) * 64, -1, dtype=np.int64)
        self.word_at[place] = order
        slot, bit = place // 64, np.uint64(1) << (place % 64).astype(np.uint64)
        texts = [step.words[i] for i in order]
        lengths = np.array([len(word) for word in texts])
        codes = _codes(texts)
        self.alphabet = np.unique(codes)
        position = np.arange(len(codes)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        letter = np.searchsorted(self.alphabet, codes)
        # One letter more, which no word has anywhere.
        shape = (int(lengths.max()), len(self.alphabet) + 1, int(slots.sum()))
        self.sets = np.zeros(shape, dtype=np.uint64)
        spot = (position, letter, np.repeat(slot, lengths))
        np.bitwise_or.at(self.sets, spot, np.repeat(bit, lengths))
        self.all = np.zeros(shape[2], dtype=np.uint64)
        np.bitwise_or.at(self.all, slot, bit)

    def near(self, numbers: np.ndarray, queries: list[str], group: np.ndarray, size: int, length: int):
        """(query number, word number) arrays of the near words of queries of one length in groups
        of words of one size."""
        codes = _codes(queries).reshape(len(queries), length)
        letter = np.searchsorted(self.alphabet, codes)
        known = self.alphabet[np.minimum(letter, len(self.alphabet) - 1)] == codes
        letter[~known] = len(self.alphabet)
        asked = np.repeat(np.arange(len(queries)), self.slots[group])
        slot = ragged(self.first_slot[group], self.slots[group])
        for start in range(0, len(asked), self.ITEMS):
            part, at = asked[start : start + self.ITEMS], slot[start : start + self.ITEMS]
            hits = self._walk(letter[part].T, at, size, length)
            same_start = self._agreeing(letter[part].T, at, (size - 1) // 2)
            # Pairs with equal first halves were found by these.
            hits &= np.where(self.side[group[part]] == _LAST, ~same_start, ~np.uint64(0))
            some = np.flatnonzero(hits)
            bits = np.unpackbits(hits[some].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            row, bit = np.nonzero(bits)
            yield numbers[part[some[row]]], self.word_at[at[some[row]] * 64 + bit]

    def _agreeing(self, letter: np.ndarray, slot: np.ndarray, upto: int) -> np.ndarray:
        exact = self.all[slot]
        for i in range(upto):
            exact = exact & self.sets[i, letter[i], slot]
        return exact

    def _walk(self, letter: np.ndarray, slot: np.ndarray, size: int, length: int) -> np.ndarray:
        exact, one_off = self.all[slot], np.zeros(len(slot), dtype=np.uint64)
        nothing = np.zeros(len(slot), dtype=np.uint64)
        for i in range(length):
            here = self.sets[i, letter[i], slot] if i < size else nothing
            if size == length:  # a letter replaced
                one_off = (one_off & here) | (exact & ~here)
            elif size > length:  # the word has a letter more: its letters lie one further on
                one_off = (one_off | exact) & self.sets[i + 1, letter[i], slot]
            else:  # the word lacks this letter: its letters lie one before
                before = self.sets[i - 1, letter[i], slot] if i else nothing
                one_off = (one_off & before) | exact
            exact = exact & here
        return one_off | exact if size > length else one_off


def _codes(words: list[str]) -> np.ndarray:
    return np.frombuffer("".join(words).encode("utf-32-le"), dtype=np.uint32)
