"""Quotation linking: chat messages to reply-ordered conversations without quotes.

A line that starts with ``>`` marks is quoted; the number of marks is its level.  A passage is a
run of quoted lines of one level.  Whole passages, as tokens, are joined to the earlier messages of the
conversation that hold them, whatever their line breaks; the lines of a passage that none holds are
joined one by one.  A message answers the message that it quotes most at level 1.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, IntegerType, LongType, StructField, StructType

from tripstats.llm.common import Words, chunks, mixed, spread, stored
from tripstats.llm.decontamination import FILTER_BITS, _filter_words

MARKS = r"^((?:[ \t]*>)+)"
# Each round doubles the known part of a chain of answers.
MAX_ROUNDS = 64
# A quote that more messages of its conversation hold meets classes of messages, not each of them.
HOT_HOLDERS = 64
# Scripts without spaces: each character is a token.
_UNSPACED = r"([\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsThai}\p{IsLao}\p{IsKhmer}\p{IsMyanmar}])"


def link_quotes(
    messages: DataFrame,
    conv: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
) -> DataFrame:
    """One row a message: conv_id, turn, role, text (without quoted lines), n_quotes (quoted
    passages: runs of lines of one level), max_level, n_linked (quoted lines found in an
    earlier message), reply_to (the turn answered, or null), thread (the turn that began
    the chain of answers) and depth (answers since then).

    Sorted by (conv_id, thread, turn) the rows are the conversations in reply order.  A
    quote of nothing known, of a later or of the same message links nothing; such a message
    begins a thread.  Every earlier message that holds a passage (or line, if none holds the
    passage) gets its lines as votes; those that hold it within longer lines only if
    none holds it as whole lines.  The message with the most lines at level 1 wins, then with
    the most lines, then the latest.  Null text is empty, null ids are kept and link nothing.
    Repeated rows stay; messages that share a turn link as one, and a quote of them counts
    once.  Other columns are not returned.
    """
    rows = messages.select(
        F.col(conv).alias("conv_id"),
        F.col(turn).alias("turn"),
        F.col(role).alias("role"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    ).withColumn("lines", parse_lines("text"))
    quoted = stored(_quoted_units(rows), "quoted")
    answered = _answers(quoted, _holders(rows, quoted))
    threads = _threads(answered)
    shown = rows.select(
        "conv_id",
        "turn",
        "role",
        unquoted("lines").alias("text"),
        _passages("lines").alias("n_quotes"),
        F.coalesce(F.array_max(F.transform("lines", lambda x: x["level"])), F.lit(0)).alias(
            "max_level"
        ),
    )
    joined = shown.join(threads, ["conv_id", "turn"], "left")
    return joined.withColumns(
        {
            "n_linked": F.coalesce("n_linked", F.lit(0)).cast("long"),
            "thread": F.coalesce("thread", "turn"),
            "depth": F.coalesce("depth", F.lit(0)).cast("long"),
        }
    )


def reply_ordered(linked: DataFrame) -> DataFrame:
    """The rows in reply order within and across partitions, without one task for a long
    conversation."""
    return linked.orderBy("conv_id", "thread", "turn")


def parse_lines(text: str) -> Column:
    """Lines as (level, body): quote marks counted and cut off."""

    def parse(line):
        marks = F.regexp_extract(line, MARKS, 1)
        level = F.length(marks) - F.length(F.translate(marks, ">", ""))
        return F.struct(level.alias("level"), F.regexp_replace(line, MARKS, "").alias("body"))

    return F.transform(F.split(text, r"\r?\n"), parse)


def normalised(body: Column) -> Column:
    """A line without case, punctuation and spacing: its tokens between single spaces."""
    apart = F.regexp_replace(F.lower(body), _UNSPACED, " $1 ")
    return F.trim(F.regexp_replace(apart, r"[^\p{L}\p{N}]+", " "))


def unquoted(lines: str) -> Column:
    own = F.filter(lines, lambda line: line["level"] == 0)
    return F.trim(F.array_join(F.transform(own, lambda line: line["body"]), "\n"))


def _quoted_units(rows: DataFrame) -> DataFrame:
    """Quoted lines by passage: conv_id, turn, level, passage and line (hashes of their tokens within
    the conversation), n (lines) and keys (first windows and lengths of both)."""
    runs = F.transform(
        F.filter("lines", lambda x: x["level"] > 0),
        lambda x: F.struct(x["level"].alias("level"), normalised(x["body"]).alias("body")),
    )
    # A mark before each line: the level, or 0 between passages.
    marked = F.transform("lines", lambda x: F.when(x["level"] > 0, x["level"]).otherwise(0))
    frame = rows.where(F.exists("lines", lambda x: x["level"] > 0)).select(
        "conv_id",
        "turn",
        F.xxhash64("conv_id").alias("salt"),
        marked.alias("levels"),
        F.transform(runs, lambda x: x["body"]).alias("bodies"),
        F.array_join(F.transform(runs, lambda x: x["body"]), "\n").alias("text"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "text"):
            owners, levels, starts, passages = [], [], [], []
            bodies = [body for row in batch.column("bodies").to_pylist() for body in row]
            tokens = _Line(bodies)
            salts = batch.column("salt").to_numpy(zero_copy_only=False)
            line = 0
            for row, marks in enumerate(batch.column("levels").to_pylist()):
                before = 0
                for level in marks:
                    if level:
                        if level != before:
                            starts.append(line)
                        owners.append(row)
                        levels.append(level)
                        passages.append(len(starts) - 1)
                        line += 1
                    before = level
            owners, levels, passages = (np.array(x, dtype=np.int64) for x in (owners, levels, passages))
            first = np.array(starts, dtype=np.int64)
            last = np.append(first[1:], len(bodies))
            salted = salts.view(np.uint64)[owners]
            of_lines = tokens.spans(tokens.starts[:-1], tokens.starts[1:], salted)
            of_runs = tokens.spans(tokens.starts[first], tokens.starts[last], salted[first])
            filled = np.flatnonzero(of_lines[2] > 0)
            run_of = passages[filled]
            kept = owners[filled]
            columns = [
                batch.column("conv_id").take(pa.array(kept)),
                batch.column("turn").take(pa.array(kept)),
                pa.array(levels[filled].astype(np.int32)),
                pa.array(of_runs[0][run_of].view(np.int64)),
                pa.array(of_lines[0][filled].view(np.int64)),
                pa.array(of_runs[1][run_of].view(np.int64)),
                pa.array(of_lines[1][filled].view(np.int64)),
                pa.array(of_runs[2][run_of]),
                pa.array(of_lines[2][filled]),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    ids = [StructField(x, rows.schema[x].dataType) for x in ("conv_id", "turn")]
    names = ["conv_id", "turn", "level", "passage", "line", "passage_begin", "line_begin", "passage_tokens", "line_tokens"]
    kinds = StructType([*ids, StructField("level", IntegerType()), *[StructField(x, LongType()) for x in names[3:]]])
    return frame.mapInArrow(run, kinds).groupBy(*names).agg(F.count(F.lit(1)).alias("n"))


def _holders(rows: DataFrame, quoted: DataFrame) -> DataFrame:
    """Messages that hold a quoted passage or line: conv_id, unit, origin (turn) and whole (as
    whole lines).  Every window of tokens of a quoted length is looked up."""
    units = quoted.select(
        F.explode(
            F.array(
                F.struct(F.col("passage").alias("unit"), F.col("passage_begin").alias("begin"), F.col("passage_tokens").alias("n")),
                F.struct(F.col("line").alias("unit"), F.col("line_begin").alias("begin"), F.col("line_tokens").alias("n")),
            )
        ).alias("u")
    ).select("u.*")
    lengths = sorted(row["n"] for row in units.select("n").distinct().collect())
    seeds = units.select(F.explode(F.array("unit", "begin")).alias("seed"))
    known = _filter_words(seeds) if lengths else np.zeros(0, dtype=np.uint64)
    bodies = F.transform(F.filter("lines", lambda x: x["level"] == 0), lambda x: normalised(x["body"]))
    frame = rows.where("conv_id is not null and turn is not null").select(
        "conv_id",
        "turn",
        F.xxhash64("conv_id").alias("salt"),
        F.filter(bodies, lambda x: x != "").alias("bodies"),
        F.array_join(bodies, "\n").alias("text"),
    )

    def maybe(seeds: np.ndarray) -> np.ndarray:
        low = seeds & np.uint64(FILTER_BITS - 1)
        return known[low >> np.uint64(6)] >> (low & np.uint64(63)) & np.uint64(1) == 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "text"):
            bodies = batch.column("bodies")
            tokens = _Line(bodies.flatten())
            counts = bodies.value_lengths().to_numpy(zero_copy_only=False)
            bounds = tokens.starts[np.concatenate([[0], np.cumsum(counts)])]
            owners = spread(bounds)
            ends = bounds[1:][owners]
            salts = batch.column("salt").to_numpy(zero_copy_only=False).view(np.uint64)[owners]
            breaks = np.zeros(len(owners) + 1, dtype=bool)
            breaks[tokens.starts] = True
            for width, hashes in tokens.windows(lengths[-1]):
                fit = [n for n in lengths if width <= n < 2 * width]
                places = np.arange(len(hashes)) if fit else np.zeros(0, dtype=np.int64)
                places = places[places + width <= ends[places]]
                places = places[maybe(_begin(hashes[places], salts[places]))]
                for n in fit:
                    at = places[places + n <= ends[places]]
                    found = _span(hashes[at], hashes[at + n - width], n, salts[at])
                    hit = maybe(found)
                    at, found = at[hit], found[hit]
                    if len(at):
                        of = pa.array(owners[at])
                        columns = [
                            batch.column("conv_id").take(of),
                            batch.column("turn").take(of),
                            pa.array(found.view(np.int64)),
                            pa.array(breaks[at] & breaks[at + n]),
                        ]
                        yield pa.RecordBatch.from_arrays(columns, names=["conv_id", "origin", "unit", "whole"])

    kinds = StructType(
        [
            StructField("conv_id", rows.schema["conv_id"].dataType),
            StructField("origin", rows.schema["turn"].dataType),
            StructField("unit", LongType()),
            StructField("whole", BooleanType()),
        ]
    )
    if not lengths:
        return rows.sparkSession.createDataFrame([], kinds)
    wanted = units.select("unit").distinct()
    held = frame.mapInArrow(run, kinds).groupBy("conv_id", "unit", "origin").agg(F.max("whole").alias("whole"))
    return stored(held.join(wanted, "unit", "left_semi"), "quote-holders")


def _answers(quoted: DataFrame, held: DataFrame) -> DataFrame:
    """conv_id, turn, reply_to and n_linked of the messages that quote an earlier one."""
    first = held.groupBy("conv_id", "unit").agg(
        F.min("origin").alias("first"),
        F.min(F.when(F.col("whole"), F.col("origin"))).alias("first_whole"),
        (F.count(F.lit(1)) > HOT_HOLDERS).alias("hot"),
    )
    for kind in ("passage", "line"):
        quoted = quoted.join(
            first.select("conv_id", *[F.col(x).alias(f"{kind}_{x}") for x in ("first", "first_whole", "hot")], F.col("unit").alias(kind)),
            ["conv_id", kind],
            "left",
        )
    kind = F.when(F.col("passage_first") < F.col("turn"), "passage").when(F.col("line_first") < F.col("turn"), "line")
    used = quoted.withColumn("kind", kind).where("kind is not null")

    def chosen(name):
        suffix = f"_{name}" if name else ""
        return F.when(F.col("kind") == "passage", F.col(f"passage{suffix}")).otherwise(F.col(f"line{suffix}"))

    used = used.select(
        "conv_id",
        "turn",
        chosen("").alias("unit"),
        F.coalesce(chosen("first_whole") < F.col("turn"), F.lit(False)).alias("strict"),
        chosen("hot").alias("hot"),
        F.when(F.col("level") == 1, F.col("n")).otherwise(0).alias("direct"),
        "n",
    )
    used = used.groupBy("conv_id", "turn", "unit", "strict", "hot").agg(
        F.sum("direct").alias("direct"), F.sum("n").alias("n")
    )
    used = stored(used, "quotes-found")
    hot = used.where("hot")
    fits = "origin < turn and (whole or not strict)"
    votes = ["conv_id", "turn", "origin", "direct", "n"]
    few = stored(used.where("not hot").join(held, ["conv_id", "unit"]).where(fits).select(votes), "quote-links")
    # What else the messages found so far hold of the frequent quotes.
    met = few.select("conv_id", "turn", "origin").distinct().join(hot, ["conv_id", "turn"])
    more = met.join(held, ["conv_id", "unit", "origin"]).where(fits).select(votes)
    exact = few.unionByName(more).groupBy("conv_id", "turn", "origin").agg(
        F.sum("direct").alias("direct"), F.sum("n").alias("n")
    )
    best = exact.unionByName(_latest_of_classes(hot, held, first))
    best = best.groupBy("conv_id", "turn").agg(
        F.max(F.struct("direct", "n", "origin"))["origin"].alias("reply_to")
    )
    linked = used.groupBy("conv_id", "turn").agg(F.sum("n").alias("n_linked"))
    return best.join(linked, ["conv_id", "turn"])


def _latest_of_classes(hot: DataFrame, held: DataFrame, first: DataFrame) -> DataFrame:
    """For quotes of frequent units: messages that hold the same of these units are one class, of which
    only the latest before the quote can be the answer."""
    frequent = held.join(first.where("hot").select("conv_id", "unit"), ["conv_id", "unit"])
    members = frequent.groupBy("conv_id", "origin").agg(
        F.array_sort(F.collect_set(F.struct("unit", "whole"))).alias("units")
    )
    members = stored(members.withColumn("class", F.xxhash64("units")), "quote-classes")
    classes = members.groupBy("conv_id", "class").agg(F.first("units").alias("units"))
    classes = classes.select("conv_id", "class", F.explode("units").alias("u")).select("conv_id", "class", "u.*")
    asked = hot.join(classes, ["conv_id", "unit"]).where("whole or not strict")
    asked = asked.groupBy("conv_id", "class", "turn").agg(F.sum("direct").alias("direct"), F.sum("n").alias("n"))
    none = F.lit(None)
    members = members.select(
        "conv_id", "class", F.col("origin").alias("turn"), none.cast("long").alias("direct"), none.cast("long").alias("n"), F.lit(1).alias("own")
    )
    both = asked.withColumn("own", F.lit(0)).unionByName(members)
    # Own rows of a turn come after its quotes, so only earlier turns are seen.
    earlier = Window.partitionBy("conv_id", "class").orderBy("turn", "own").rowsBetween(Window.unboundedPreceding, 0)
    both = both.withColumn("origin", F.max(F.when(F.col("own") == 1, F.col("turn"))).over(earlier))
    return both.where("own = 0 and origin is not null").select("conv_id", "turn", "origin", "direct", "n")


class _Line:
    """Tokens of normalised lines; those of line i lie between starts[i] and starts[i + 1]."""

    def __init__(self, lines):
        words = Words(lines if isinstance(lines, pa.Array) else pa.array(lines, pa.large_string()))
        of_words = words.hashes() if words.vocabulary else np.zeros(0, dtype=np.uint64)
        self.starts = words.starts
        self.hashes = of_words[words.ids] if len(words.ids) else np.zeros(0, dtype=np.uint64)

    def windows(self, longest: int):
        """(width, hash of the window at each place) for widths 1, 2, 4, ... up to ``longest``."""
        width, hashes = 1, self.hashes
        while len(hashes) and width <= longest:
            yield width, hashes
            hashes = mixed(hashes[:-width] * np.uint64(3) + hashes[width:]) if len(hashes) > width else hashes[:0]
            width *= 2

    def spans(self, begins: np.ndarray, ends: np.ndarray, salts: np.ndarray):
        """Hash, hash of the first window, and length of each span of tokens."""
        lengths = ends - begins
        found, first = (np.zeros(len(begins), dtype=np.uint64) for _ in range(2))
        for width, hashes in self.windows(int(lengths.max(initial=0))):
            of = np.flatnonzero((lengths >= width) & (lengths < 2 * width))
            at = begins[of]
            first[of] = _begin(hashes[at], salts[of])
            found[of] = _span(hashes[at], hashes[at + lengths[of] - width], lengths[of], salts[of])
        return found, first, lengths


def _begin(window: np.ndarray, salts: np.ndarray) -> np.ndarray:
    return mixed(window ^ salts)


def _span(first: np.ndarray, last: np.ndarray, length, salts: np.ndarray) -> np.ndarray:
    """Two windows that begin and end a span, and its length, make its hash."""
    return mixed(mixed(first ^ salts) + last * np.uint64(5) + np.asarray(length).astype(np.uint64))


def _passages(lines: str) -> Column:
    """Runs of quoted lines of one level."""
    levels = F.transform(lines, lambda x: x["level"])
    before = F.concat(F.array(F.lit(0)), F.slice(levels, F.lit(1), F.size(levels) - 1))
    starts = F.zip_with(levels, before, lambda now, last: (now > 0) & (now != last))
    return F.size(F.filter(starts, lambda x: x)).cast("long")


def _threads(answered: DataFrame) -> DataFrame:
    """For each answer the first message of its chain and the number of answers between.

    Every answer points to an earlier turn, so the links are a forest.  In each round the pointer
    of a message jumps to where its target points, and chains halve.
    """
    state = stored(
        answered.select(
            "conv_id",
            "turn",
            "reply_to",
            "n_linked",
            F.col("reply_to").alias("thread"),
            F.lit(1).cast("long").alias("depth"),
        ),
        "threads",
    )
    for _ in range(MAX_ROUNDS):
        ahead = state.select(
            "conv_id",
            F.col("turn").alias("thread"),
            F.col("thread").alias("further"),
            F.col("depth").alias("more"),
        )
        jumped = state.join(ahead, ["conv_id", "thread"], "left")
        if jumped.where("further is not null").isEmpty():
            break
        state = stored(
            jumped.select(
                "conv_id",
                "turn",
                "reply_to",
                "n_linked",
                F.coalesce("further", "thread").alias("thread"),
                (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth"),
            ),
            "threads",
        )
    return state
