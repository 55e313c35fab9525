"""Partitioning helpers: parallelism for CPU-heavy row-local work, joins that hot
keys cannot stall, exact order statistics by counting, and running sums.

Order statistics count rows in ranges of values that narrow from pass to pass; a
pass reads a staged narrow table, and neither a task nor the driver ever holds
more than the counts of its ranges.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import accumulate
from typing import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chatsift.session import staged

#: Ranges that one counting pass tells apart.
RANGES = 1 << 16
#: A range of at most so many rows is counted value by value.
FEW = 50_000
#: A key that holds over one part in so many of all rows is hot; there are fewer such keys than this.
HOT_PARTS = 2000
#: Ranges per group that one counting pass of :func:`grouped_quantile` tells apart.
GROUP_RANGES = 4096


def spread(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """Round-robin repartition of a *scan* that has too few partitions.

    A large multi-file scan already has many splits and is left alone (no
    shuffle); a single-file table (one row group, one task) is spread over the
    cluster's cores before CPU-heavy row-local operators.  Call it on scans
    only: on a plan with a shuffle, asking for the partition count makes AQE
    run that shuffle (and the output of a shuffle is spread already).
    """
    spark = df.sparkSession
    target = min_partitions or spark.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= target:
        return df
    return df.repartition(target)


def in_slices(column: pa.Array, rows: int = 64) -> Iterator:
    """The values of an Arrow column; only a few rows of it are Python objects at a time."""
    for at in range(0, len(column), rows):
        yield from column.slice(at, rows).to_pylist()


def hash_key(seed: int, id_col: str | Column) -> Column:
    """Deterministic per-row shuffle key: md5 of ``"<seed>:<id>"`` (hex string).

    The same text-level definition runs in SQL engines, so orders agree.
    """
    c = F.col(id_col) if isinstance(id_col, str) else id_col
    return F.md5(F.concat(F.lit(f"{int(seed)}:"), c.cast("string")))


def hash_prefix_long(md5_hex: Column) -> Column:
    """First 60 bits of an md5 hex digest as a non-negative long (order-preserving)."""
    return F.conv(F.substring(md5_hex, 1, 15), 16, 10).cast("long")


def skewed_left_join(rows: DataFrame, values: DataFrame, key: str, count: str, total: int | None = None) -> DataFrame:
    """``rows`` with the columns of ``values`` (one row per key; ``count`` = the key's rows in ``rows``, ``total`` their
    sum where it is known), left outer.

    Keys that hold over 1 / ``HOT_PARTS`` of all rows are fewer than ``HOT_PARTS``,
    so they are broadcast; the rows of all others are joined by a shuffle, in
    which no key can be larger than that.  Both inputs should be staged.
    """
    total = values.agg(F.sum(count)).first()[0] or 0 if total is None else total
    is_hot = F.col(count) * HOT_PARTS > total
    hot = F.broadcast(values.where(is_hot).drop(count).withColumn("_hot", F.lit(True)))
    cold = values.where(~is_hot).drop(count)
    others = rows.join(hot.select(key, "_hot"), key, "left").where("_hot is null").drop("_hot")
    return rows.join(hot.drop("_hot"), key).unionByName(others.join(cold, key, "left"))


# -------------------------------------------------------- order statistics ---

@dataclass(frozen=True)
class Cut:
    """The n-th smallest key: ``below`` rows have a smaller one and ``ties`` rows this one."""

    value: int
    below: int
    ties: int


def key_stats(df: DataFrame, num_col: str):
    """``(n, lo, hi)``: row count, min and max of the key (one pass)."""
    return df.agg(F.count(num_col).alias("n"), F.min(num_col).alias("lo"), F.max(num_col).alias("hi")).first()


def nth_key(keys: DataFrame, key: str, n: int, stats: tuple[int, int, int] | None = None) -> Cut | None:
    """The n-th smallest (1-based) value of the long ``key``, nulls left out; None where there are fewer rows.

    ``keys`` should be a staged narrow table.  One pass counts rows in ``RANGES``
    ranges between the least and the greatest key; a range of few rows or
    values is then counted value by value.  For keys that spread evenly that is
    two passes up to ``RANGES * FEW`` (3 * 10^9) rows and one more for each
    further factor of ``RANGES``, ties or not.
    """
    rows, lo, hi = stats or key_stats(keys, key)
    if not 1 <= n <= rows:
        return None
    below = 0
    while True:
        width = (hi - lo) // RANGES + 1
        inside = keys.where(F.col(key).between(lo, hi))
        whole = width == 1 or rows <= FEW
        part = F.col(key) if whole else F.expr(
            f"CAST((CAST(`{key}` AS DECIMAL(20,0)) - {lo}BD) DIV {width}BD AS LONG)")
        counts = inside.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("c")).toArrow()
        for p, c in sorted(zip(counts.column("part").to_pylist(), counts.column("c").to_pylist())):
            if below + c >= n:
                break
            below += c
        if whole:
            return Cut(p, below, c)
        lo, hi, rows = lo + p * width, min(hi, lo + (p + 1) * width - 1), c


def grouped_quantile(df: DataFrame, group_cols: list[str], value_col: str, q: float,
                     out_col: str = "quantile", ranges: int = GROUP_RANGES) -> DataFrame:
    """Exact linear-interpolated quantile per group: what ``percentile(value, q)`` gives (position ``q * (n - 1)``).

    The rows of a group are never gathered.  Each pass counts, for all groups at
    once, the rows in ``ranges`` ranges between the least and the greatest value
    still in question, by (group, range), combined before the shuffle; it goes on
    inside the range that holds the wanted rank until that range holds one value.
    So a group of any size, or any number of ties, is spread over the tasks; the
    states of groups are one row each, and hot groups get theirs by a broadcast
    of bounded size.  The value after the wanted one comes along.

    Null and NaN values are left out; a group without values, and one with a
    null in ``group_cols``, gives no row.
    """
    v = F.col(value_col).cast("double")
    known = F.lit(True)
    for c in group_cols:
        known = known & F.col(c).isNotNull()
    vals = staged(df.where(known & v.isNotNull() & ~F.isnan(v)).select(F.struct(*group_cols).alias("_g"), v.alias("_v")),
                  "quantile-values")
    pos = F.lit(float(q)) * (F.col("_n") - 1)
    finite = F.abs(F.col("_v")) < float("inf")
    state = vals.groupBy("_g").agg(
        F.count(F.lit(1)).alias("_n"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi"),
        F.min(F.when(finite, F.col("_v"))).alias("_flo"), F.max(F.when(finite, F.col("_v"))).alias("_fhi"))
    state = staged(state.select("_g", "_n", F.floor(pos).cast("long").alias("_k"), (pos - F.floor(pos)).alias("_frac"),
                                "_lo", "_hi", "_flo", "_fhi", F.lit(0).cast("long").alias("_below"), F.col("_n").alias("_c"),
                                F.lit(None).cast("double").alias("_next")), "quantile-state")
    while True:
        open_groups = state.where("_hi > _lo")
        rows = open_groups.agg(F.sum("_n")).first()[0]
        if not rows:
            break
        seen = skewed_left_join(vals, open_groups.select("_g", "_n", "_lo", "_hi", "_flo", "_fhi"), "_g", "_n", rows)
        # Halves, as the span of two doubles may exceed a double; the ends have ranges of their own, so each pass narrows.
        step = (F.col("_v") / 2 - F.col("_flo") / 2) / (F.col("_fhi") / 2 - F.col("_flo") / 2) * ranges
        part = (F.when(F.col("_v") == float("inf"), ranges + 2).when(F.col("_v") == float("-inf"), -2)
                .when(F.col("_v") == F.col("_flo"), -1).when(F.col("_v") == F.col("_fhi"), ranges + 1)
                .otherwise(F.coalesce(F.least(F.floor(step).cast("long"), F.lit(ranges)), F.lit(0))))
        counts = (seen.where(F.col("_v").between(F.col("_lo"), F.col("_hi"))).groupBy("_g", part.alias("_part"))
                  .agg(F.count(F.lit(1)).alias("_pc"), F.min("_v").alias("_plo"), F.max("_v").alias("_phi")))
        # At most ranges + 5 rows a group.
        order = Window.partitionBy("_g").orderBy("_part")
        counts = counts.withColumns({"_upto": F.sum("_pc").over(order), "_after": F.lead("_plo").over(order)})
        old = state.drop("_lo", "_hi", "_flo", "_fhi", "_c")
        found = (counts.join(old, "_g").where((F.col("_below") + F.col("_upto") > F.col("_k"))
                                              & (F.col("_below") + F.col("_upto") - F.col("_pc") <= F.col("_k")))
                 .select("_g", "_n", "_k", "_frac", F.col("_plo").alias("_lo"), F.col("_phi").alias("_hi"),
                         F.when(F.abs("_plo") < float("inf"), F.col("_plo")).alias("_flo"),
                         F.when(F.abs("_phi") < float("inf"), F.col("_phi")).alias("_fhi"),
                         (F.col("_below") + F.col("_upto") - F.col("_pc")).alias("_below"), F.col("_pc").alias("_c"),
                         F.coalesce("_after", "_next").alias("_next")))
        state = staged(found.unionByName(state.where("_hi <= _lo")), "quantile-state")
    later = F.when(F.col("_below") + F.col("_c") > F.col("_k") + 1, F.col("_lo")).otherwise(F.coalesce("_next", "_lo"))
    value = F.when(F.col("_frac") == 0, F.col("_lo")).otherwise(F.col("_lo") + F.col("_frac") * (later - F.col("_lo")))
    return state.select("_g.*", value.alias(out_col), F.col("_n").alias("_group_rows"))


# ------------------------------------------------------------ running sums ---

def running_sum(df: DataFrame, order_col: str, value_col: str, out_col: str) -> DataFrame:
    """``df`` with the sum of ``value_col`` up to and including each row in the order of ``order_col`` (nulls first).

    Two levels: rows are dealt over ranges of the order, each range is summed
    (one number per range goes through the driver), and a window inside a range
    starts from the sum of the ranges before.  No window spans all rows.
    """
    spark = df.sparkSession
    parts = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions", "1")), 1)
    dealt = staged(df.repartitionByRange(parts, order_col).withColumn("_part", F.spark_partition_id()), "ranges")
    sums = sorted(tuple(r) for r in dealt.groupBy("_part").agg(F.sum(value_col)).collect())
    ends = list(accumulate(s or 0 for _, s in sums))
    before = {p: e - (s or 0) for (p, s), e in zip(sums, ends)}
    offset = F.create_map(*[x for p, b in before.items() for x in (F.lit(p), F.lit(b))]) if before else None
    inside = F.coalesce(F.sum(value_col).over(
        Window.partitionBy("_part").orderBy(order_col).rowsBetween(Window.unboundedPreceding, Window.currentRow)), F.lit(0))
    total = inside if offset is None else inside + offset[F.col("_part")]
    return dealt.withColumn(out_col, total).drop("_part")
