"""Join of a large table with a lookup table, safe against hot keys."""

from collections import defaultdict
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripstats.workspace import checkpointed

BROADCAST_BYTES = 128 * 1024 * 1024
# Where the sides are searched many times over, keys get so many salts without being counted.
SALTS = 16

# A side that Spark's own estimate, times this, puts under the limit needs no measuring.
ESTIMATE_FACTOR = 10

_ROW_OVERHEAD = 16
_FIELD_BYTES = 8


class Size(NamedTuple):
    rows: int
    bytes: int


def measure(df: DataFrame) -> Size:
    """Size of ``df`` in memory, by one distributed pass over it.

    Fixed-width fields count eight bytes each, text and binary fields what they
    hold, nested fields their JSON length.
    """
    row_bytes = F.lit(_ROW_OVERHEAD + _FIELD_BYTES * len(df.columns)).cast("long")
    for field in df.schema:
        held = None
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            held = F.octet_length(field.name)
        elif isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
            held = F.octet_length(F.to_json(F.struct(F.col(field.name))))
        if held is not None:
            row_bytes = row_bytes + F.coalesce(held, F.lit(0))
    counted = df.agg(F.count(F.lit(1)), F.coalesce(F.sum(row_bytes), F.lit(0)))
    return Size(*counted.first())


def fits(df: DataFrame, most_bytes: int) -> bool:
    """Whether ``df`` is small enough to be sent to every executor.

    The estimate of the optimizer decides where it is far below the limit; else ``df`` is
    computed once to measure it.
    """
    estimate = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    if ESTIMATE_FACTOR * estimate <= most_bytes:
        return True
    return measure(df).bytes <= most_bytes


def hot_keys(facts: DataFrame, on: list[str], tasks: int) -> DataFrame:
    """(_key, _salts): keys with more rows than a task should get if ``facts`` were dealt evenly
    over ``tasks`` tasks, and over how many tasks to spread each.  A key is named by its hash.

    Rows are counted by a sketch of frequent items: of bounded size in each task, merged like
    any partial aggregate, and no key with such a share escapes it.  Only the key columns are
    read.  At most ``tasks`` keys can be hot, so the result is small whatever the data.
    """
    key = F.xxhash64(*on)
    # Every key above a share of 1 / tasks is among the first so many; the sketch tracks more, for exactness.
    tracked = min(1_000_000, 64 * tasks)
    top = F.call_function("approx_top_k", key, F.lit(tasks), F.lit(tracked)).alias("top")
    found = facts.agg(top, F.count(F.lit(1)).alias("rows"))
    keys = found.select("rows", F.explode("top").alias("top")).select(
        F.col("top.item").alias("_key"),
        F.ceil(F.col("top.count") * tasks / F.col("rows")).cast("int").alias("_salts"),
    )
    return keys.where(F.col("_key").isNotNull() & (F.col("_salts") > 1))


def salted_join(
    facts: DataFrame,
    lookup: DataFrame,
    on: list[str],
    salt_by: list[str],
    salts: int | None = None,
    most_salts: int | None = None,
) -> DataFrame:
    """Inner shuffle join that spreads the hot keys of ``facts`` over several tasks.

    A key with the rows of n tasks gets n salts, and its lookup row n copies; other rows stay
    single.  With ``salts`` every key gets so many, and ``facts`` is not counted.  With ``most_salts``
    no key gets more than that, nothing is broadcast, and without hot keys nothing is salted.
    The salt is a hash of ``salt_by``, not a random number, so a task that runs
    again after a lost executor sends each row to the same place.
    """
    key = F.xxhash64(*on)
    if salts is not None:
        spread = F.lit(salts)
        salted_facts, salted_lookup = facts, lookup
    elif most_salts is not None:
        tasks = int(facts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        # Fewer than there are tasks, and of few different counts.
        hot = defaultdict(list)
        for row in hot_keys(facts, on, tasks).collect():
            hot[min(row["_salts"], most_salts)].append(row["_key"])
        if not hot:
            return facts.join(lookup.hint("merge"), on)
        spread = F.coalesce(*(F.when(key.isin(keys), n) for n, keys in hot.items()), F.lit(1))
        salted_facts, salted_lookup = facts, lookup
    else:
        tasks = int(facts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        # A row a hot key, fewer than there are tasks; counted once, not by either side.
        hot = F.broadcast(checkpointed(hot_keys(facts, on, tasks)))
        spread = F.coalesce("_salts", F.lit(1))
        salted_facts = facts.withColumn("_key", key).join(hot, "_key", "left").drop("_key")
        salted_lookup = lookup.withColumn("_key", key).join(hot, "_key", "left").drop("_key")
    salted_facts = salted_facts.withColumn(
        "_salt", F.pmod(F.xxhash64(*salt_by), spread).cast("int")
    ).drop("_salts")
    salted_lookup = salted_lookup.withColumn(
        "_salt", F.explode(F.sequence(F.lit(0), spread - 1))
    ).drop("_salts")
    # Spark's estimate of the copied lookup can be far too small; a broadcast of it would be
    # built in the driver's memory, so the join stays a shuffle join.
    return salted_facts.join(salted_lookup.hint("merge"), [*on, "_salt"]).drop("_salt")


def lookup_join(
    facts: DataFrame,
    lookup: DataFrame,
    on: list[str],
    salt_by: list[str] | None = None,
    broadcast_bytes: int = BROADCAST_BYTES,
    salts: int | None = None,
    most_salts: int | None = None,
) -> DataFrame:
    """Inner equi-join of ``facts`` with a (usually small) ``lookup`` table.

    A lookup table that fits into ``broadcast_bytes`` is sent to every executor and
    ``facts`` is not shuffled.  A larger one is joined by a shuffle on the keys and a
    salt, so that a key with a large share of ``facts`` does not end in one task; what
    one salt still holds of such a key, adaptive execution splits.  ``salt_by`` names the
    columns that tell the rows of one key apart; naming few keeps the scan narrow.
    """
    if fits(lookup, broadcast_bytes):
        return facts.join(F.broadcast(lookup), on)
    return salted_join(facts, lookup, on, salt_by or facts.columns, salts, most_salts)
