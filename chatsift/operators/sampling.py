"""Mixing, limits, seeded samples, train/validation splits, batch plans, resume.

Row order is explicit: the id for "source order", the md5 of ``"<seed>:<id>"``
for "shuffled".  Rows without an id are ordered by a hash of their content, so
ids may be missing, null, repeated or of any type and every limit, sample and
split still has its exact size.

A cut stages the key of every row once (one narrow column; the content is hashed
only where the id is null) and finds the n-th smallest key by counting in that
table.  Each side is then a filter on the key.  Rows that tie at the cut are cut
by further keys; what ties in all of them is cut by position.
"""

from __future__ import annotations

import warnings
from functools import reduce
from itertools import accumulate
from typing import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chatsift.operators.partitioning import hash_key, hash_prefix_long, nth_key
from chatsift.session import staged

_H, _HX, _C, _TIE, _K = "_cs_h", "_cs_hx", "_cs_content", "_cs_tie", "_cs_key"
#: Bytes of a string that one counting key covers.
_BYTES = 6


def mix(dfs: list[DataFrame]) -> DataFrame:
    """Concatenate in order, keeping duplicates; missing columns become null."""
    if not dfs:
        raise ValueError("mix() needs at least one dataset")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)


def _content(df: DataFrame) -> Column:
    """A hash of the whole row (maps cannot be hashed and are left out): 60 bits, never null."""
    hashed = [F.col(f"`{f.name}`") for f in df.schema.fields if "map<" not in f.dataType.simpleString()]
    return F.shiftrightunsigned(F.xxhash64(F.lit(1), *hashed), 4)


def _by_position(df: DataFrame, n: int) -> tuple[DataFrame, DataFrame]:
    """Any ``n`` of rows that no key tells apart, and the others; rows are numbered in a staged copy."""
    rows = staged(df.withColumn(_TIE, F.monotonically_increasing_id()), "ties")
    counts = sorted(tuple(r) for r in rows.groupBy(F.shiftright(_TIE, 33)).count().collect())  # one row per partition
    last = -1
    for part, count in counts:
        last = (part << 33) + min(count, n) - 1
        n -= count
        if n <= 0:
            break
    return rows.where(F.col(_TIE) <= last).drop(_TIE), rows.where(F.col(_TIE) > last).drop(_TIE)


def _first_n(df: DataFrame, keys: list[Column], n: int, staged_key: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """``(first, rest)``: the ``n`` rows that come first by the non-null long ``keys``, and the others.

    ``staged_key``: the first key of every row as column ``_cs_key``, where it is staged already.
    """
    if not keys:
        return _by_position(df, n)
    key, *further = keys
    cut = nth_key(staged(df.select(key.alias(_K)), "keys") if staged_key is None else staged_key, _K, n)
    if cut is None:
        return df, df.limit(0)
    if cut.below + cut.ties == n:
        return df.where(key <= cut.value), df.where(key > cut.value)
    first, rest = _first_n(df.where(key == cut.value), further, n - cut.below)
    return df.where(key < cut.value).unionByName(first), df.where(key > cut.value).unionByName(rest)


# ------------------------------------------------------------------ limits ---

def _chunk(text: Column, k: int) -> Column:
    """The k-th ``_BYTES`` bytes of a string and how many there are, as a long in the order of the bytes."""
    piece = F.substring(text.cast("binary"), 1 + _BYTES * k, _BYTES)
    return F.conv(F.concat(F.rpad(F.hex(piece), 2 * _BYTES, "0"), F.lpad(F.hex(F.length(piece)), 2, "0")), 16, 10).cast("long")


def _nth_string(keys: DataFrame, n: int) -> tuple[str, int, int]:
    """``(value, below, ties)`` of the n-th smallest string of the staged ``keys``, found a few bytes at a time."""
    below, k = 0, 0
    while True:
        chunk = _chunk(F.col(_K), k)
        cut = nth_key(staged(keys.select(chunk.alias(_K)), "string-keys"), _K, n - below)
        keys = keys.where(chunk == cut.value)
        below += cut.below
        k += 1
        if cut.value % 256 < _BYTES:  # the strings end here, so what is left is one string
            return keys.first()[0], below, cut.ties


def _long_key(c: Column, data_type: T.DataType) -> Column | None:
    """A long in the order of the column, for types that have one."""
    if isinstance(data_type, (T.IntegralType, T.BooleanType)):
        return c.cast("long") if not isinstance(data_type, T.LongType) else c
    if isinstance(data_type, T.DateType):
        return F.unix_date(c).cast("long")
    if isinstance(data_type, T.TimestampType):
        return F.unix_micros(c)
    return None


def max_samples(df: DataFrame, n: int | None, order_col: str | None = "id") -> DataFrame:
    """The first n rows by ``order_col`` (source order), null keys last; n null/<=0 -> all rows.

    Whole numbers, dates, times and strings are cut by counting, other keys by
    an exact rank over range partitions.  Rows of one key go by a hash of their
    content, and so do all rows where there is no such column.
    """
    if not n or n <= 0:
        return df
    n, content = int(n), _content(df)
    if order_col is None or order_col not in df.columns:
        return _first_n(df, [content], n)[0]
    column, data_type = F.col(f"`{order_col}`"), df.schema[order_col].dataType
    key = _long_key(column, data_type)
    if key is None and not isinstance(data_type, T.StringType):
        keyed = df.withColumns({_H: content, _HX: column.isNull()})
        return global_rank(keyed, [_HX, order_col, _H], _TIE).where(F.col(_TIE) < n).drop(_TIE, _H, _HX)
    keys = staged(df.select((column if key is None else key).alias(_K)), "keys")
    n_rows, n_known = keys.agg(F.count(F.lit(1)), F.count(_K)).first()
    if n >= n_rows:
        return df
    if n >= n_known:
        unknown = df.where(column.isNull())
        return df.where(column.isNotNull()).unionByName(_first_n(unknown, [content], n - n_known)[0] if n > n_known
                                                        else unknown.limit(0))
    if key is not None:
        return _first_n(df.where(column.isNotNull()), [key, content], n, keys)[0]
    value, below, ties = _nth_string(keys.where(F.col(_K).isNotNull()), n)
    if below + ties == n:
        return df.where(column <= value)
    return df.where(column < value).unionByName(_first_n(df.where(column == value), [content], n - below)[0])


# ------------------------------------------------------ samples and splits ---

def with_shuffle_key(df: DataFrame, id_col: str, seed: int) -> DataFrame:
    hx = _row_hash(df, seed)
    if id_col in df.columns:
        hx = F.coalesce(hash_key(seed, id_col), hx)
    return df.withColumns({_HX: hx, _C: _content(df)}).withColumn(_H, hash_prefix_long(F.col(_HX)))


def _row_hash(df: DataFrame, seed: int) -> Column:
    return F.md5(F.concat_ws(":", F.lit(str(seed)), F.lit("row"), _content(df).cast("string")))


def _shuffled(df: DataFrame, id_col: str, seed: int, size: Callable[[int], int | None]):
    """``(total, n, cut)``: rows, ``n = size(total)``, and a function that gives the first ``n`` of the seeded order
    and the others.

    The key of every row is staged once.  It is a hash of the id alone where no
    id is null, so that a scan reads no other column; rows with a null id are
    hashed whole, in a scan of their own.
    """
    by_row = _row_hash(df, seed)
    if id_col in df.columns:
        by_id = hash_key(seed, F.col(f"`{id_col}`"))
        keys = staged(df.select(hash_prefix_long(by_id).alias(_K)), "keys")
        total, known = keys.agg(F.count(F.lit(1)), F.count(_K)).first()
        full = by_id
        if known < total:
            unknown = df.where(F.col(f"`{id_col}`").isNull())
            keys = keys.where(F.col(_K).isNotNull()).unionByName(
                staged(unknown.select(hash_prefix_long(by_row).alias(_K)), "keys"))
            full = F.coalesce(by_id, by_row)
    else:
        full = by_row
        keys = staged(df.select(hash_prefix_long(full).alias(_K)), "keys")
        total = keys.count()
    n = size(total)
    later = F.conv(F.substring(full, 16, 15), 16, 10).cast("long")
    return total, n, lambda: _first_n(df, [hash_prefix_long(full), later, _content(df)], n, keys)


def seeded_sample(df: DataFrame, n: int, seed: int = 42, id_col: str = "id") -> DataFrame:
    """Exactly min(n, N) rows without replacement, chosen by the seeded hash order."""
    if n <= 0:
        return df.limit(0)
    total, _, cut = _shuffled(df, id_col, seed, lambda total: int(n))
    return df if n >= total else cut()[0]


def validation_size(total: int, ratio: float | None, size: int | None) -> int | None:
    """None when no split is asked for; ``size`` wins over ``ratio`` (floor of N*ratio)."""
    ratio = ratio or 0.0
    if not (ratio > 0 or size):
        return None
    return min(int(size), total) if size else int(total * ratio)


def train_val_split(df: DataFrame, ratio: float | None = 0.0, size: int | None = None,
                    seed: int = 42, id_col: str = "id"):
    """``(train, val)``: disjoint, exhaustive, ``val`` of the exact size.

    No split requested -> ``(df, None)``.  A zero-size side comes back empty
    with a warning (the reference's library raises there).
    """
    if validation_size(0, ratio, size) is None:
        return df, None
    total, n_val, cut = _shuffled(df, id_col, seed, lambda total: validation_size(total, ratio, size))
    if n_val <= 0:
        warnings.warn("validation split is empty")
        return df, df.limit(0)
    if n_val >= total:
        warnings.warn("training split is empty")
        return df.limit(0), df
    val, train = cut()
    return train, val


def global_rank(df: DataFrame, order_cols: list[str], rank_col: str = "rank") -> DataFrame:
    """0-based rank of every row in ``order_cols`` order, exact and distributed.

    Range-partition + sort within partitions, number rows inside each
    partition, checkpoint (reliable, so the numbering survives executor loss),
    then add per-partition offsets (one count per partition, read on the driver).
    """
    from chatsift.session import checkpoint_root

    checkpoint_root(df.sparkSession)
    spark = df.sparkSession
    parts = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions", "1")), 1)
    ordered = (
        df.repartitionByRange(parts, *order_cols)
        .sortWithinPartitions(*order_cols)
        .withColumn("_cs_mid", F.monotonically_increasing_id())
        .checkpoint()
    )
    pid = F.shiftright("_cs_mid", 33)
    counts = sorted(ordered.groupBy(pid.alias("p")).count().collect())  # one row per partition
    ends = list(accumulate(c for _, c in counts))
    offsets = spark.createDataFrame([(p, e - c) for (p, c), e in zip(counts, ends)], "_cs_part long, _cs_off long")
    local = F.col("_cs_mid").bitwiseAND(F.lit((1 << 33) - 1))
    return (ordered.join(offsets, pid == F.col("_cs_part")).withColumn(rank_col, F.col("_cs_off") + local)
            .drop("_cs_mid", "_cs_part", "_cs_off"))


def resolve_generation_sizes(per_device_batch: int, num_processes: int,
                             generation_batch_size: int | None = None,
                             steps_per_generation: int | None = None,
                             gradient_accumulation_steps: int = 1) -> tuple[int, int]:
    """``(rows per generation batch, optimizer steps it serves)``; at most one of the two may be set."""
    if None not in (generation_batch_size, steps_per_generation):
        raise ValueError("the rows of a generation batch and its steps cannot both be given")
    step_rows = per_device_batch * num_processes
    rows = generation_batch_size or step_rows * (steps_per_generation or gradient_accumulation_steps)
    steps, left = divmod(rows, step_rows)
    if left:
        raise ValueError(f"{rows} rows are not divisible into steps of {step_rows} rows")
    return rows, steps


def batch_plan(df: DataFrame, per_device_batch: int, num_processes: int,
               steps_per_generation: int | None = None, seed: int = 42, id_col: str = "id",
               generation_batch_size: int | None = None, gradient_accumulation_steps: int = 1) -> DataFrame:
    """Generation batches for a repeat sampler.

    Rows are shuffled by the seeded hash; consecutive ``B = per_device_batch *
    num_processes * steps_per_generation`` rows form a generation batch (the
    incomplete tail is dropped) and each batch is replayed
    ``steps_per_generation`` times.  Output: ``(id, generation_batch, repeat,
    slot, sample_index)``, where ``sample_index`` is the global position in
    the sampler's stream.
    """
    b, steps_per_generation = resolve_generation_sizes(
        per_device_batch, num_processes, generation_batch_size, steps_per_generation, gradient_accumulation_steps)
    if min(per_device_batch, num_processes, steps_per_generation) <= 0:
        raise ValueError("batch sizes must be positive")
    keyed = with_shuffle_key(df.select(id_col), id_col, seed)
    ranked = global_rank(keyed, [_H, _HX, id_col], "_cs_rank")
    total = ranked.count()
    full = (total // b) * b
    rows = ranked.where(F.col("_cs_rank") < full).select(
        id_col,
        F.floor(F.col("_cs_rank") / b).cast("long").alias("generation_batch"),
        (F.col("_cs_rank") % b).cast("long").alias("slot"),
    )
    rows = rows.withColumn("repeat", F.explode(F.sequence(F.lit(0), F.lit(steps_per_generation - 1))))
    return rows.select(
        id_col, "generation_batch", "repeat", "slot",
        ((F.col("generation_batch") * steps_per_generation + F.col("repeat")) * b + F.col("slot")).alias("sample_index"),
    )


def resume(df: DataFrame, done_ids: DataFrame, id_col: str = "id") -> DataFrame:
    """Rows whose id is not already done (``left_anti``; null ids are kept).

    Join keys are compared as strings, since done ids come back from JSON.
    AQE broadcasts the done set when it is small and shuffles otherwise.
    """
    done = done_ids.select(F.col("id").cast("string").alias("_cs_done"))
    return df.join(done, F.col(id_col).cast("string") == F.col("_cs_done"), "left_anti")
