"""Mixing sources to target weights by Sainte-Lague apportionment.  DataFrame functions only.

1. The sources share all words by weight; a target stops at ``MAX_PASSES`` times
   its source's size and the excess is shared again by weight.  The end of that
   sharing has a closed form: with sources sorted by cap / weight, a prefix is
   at its cap and the rest shares what is left.
2. All words make blocks of ``BLOCK_WORDS``.  Blocks go to sources one by one,
   each to the highest quotient target / (2 blocks + 1); then each source's
   blocks go to its shards the same way, by shard size.  Only the seats near
   the expected quota are listed and ranked, a number of rows in proportion to
   the number of sources or shards; no source takes more than its cap.
3. The documents of a shard, in seeded order, are one stream of words cut into
   blocks.  A quota above the number of blocks takes whole passes; the rest
   picks blocks by a seeded permutation (a j + b) mod n.  A document's words in
   the picked blocks are its share.

A source is split into shards by hashed id, so a source with a third of all
rows becomes many shards.  Null sources are one source, last in order; null
texts have no words.  Rows may repeat an id.  Reruns agree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chatsift.llm.common import BLANK_CLASS, staged, text_or_empty

BLOCK_WORDS = 16
SHARD_WORDS = 1 << 20
MAX_PASSES = 3
WEIGHTS = (5, 2, 1)
SEED = 17
#: Large primes, coprime to any number of blocks of a shard that they do not divide.
PRIMES = (2147483647, 2147483629, 2147483587, 2147483579, 2147483563)


def word_count(text: Column) -> Column:
    """Words of a text: the ends of runs of other characters than blank and TAB to CR."""
    runs = F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), BLANK_CLASS + "+", " "))
    return F.when(runs == "", 0).otherwise(F.length(runs) - F.length(F.translate(runs, " ", "")) + 1).cast("long")


def seeded_number(*parts: Column | str) -> Column:
    """60 bits of the MD5 of the parts and the seed."""
    text = F.concat_ws(":", *[F.coalesce((F.col(p) if isinstance(p, str) else p).cast("string"), F.lit("-")) for p in parts],
                       F.lit(str(SEED)))
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


def source_targets(sizes: DataFrame, weights: tuple = WEIGHTS, max_passes: int = MAX_PASSES) -> DataFrame:
    """(source, source_size, target) from rows (source, size): one row per source.

    The windows are over sources, not over rows.
    """
    by_name = Window.orderBy(F.col("source").isNull(), F.col("source").cast("binary"))
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    weight = F.element_at(F.array(*map(F.lit, weights)), F.col("_n") % len(weights) + 1).cast("long")
    per = (per.withColumn("_n", F.row_number().over(by_name) - 1)
           .withColumn("_w", weight).withColumn("_cap", F.col("source_size") * max_passes))
    by_cap = Window.orderBy(F.col("_cap") / F.col("_w"), "_n").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    per = (per.withColumn("_before_cap", F.coalesce(F.sum("_cap").over(by_cap), F.lit(0)))
           .withColumn("_before_w", F.coalesce(F.sum("_w").over(by_cap), F.lit(0)))
           .withColumn("_all", F.sum("source_size").over(everything))
           .withColumn("_all_w", F.sum("_w").over(everything))
           # In cap order, this one is not at its cap if the share left to it and those after fits.
           .withColumn("_open", (F.col("_all") - F.col("_before_cap")) * F.col("_w")
                       <= F.col("_cap") * (F.col("_all_w") - F.col("_before_w"))))
    first = F.struct("_before_cap", "_before_w")
    per = per.withColumn("_cut", F.min(F.when(F.col("_open"), first)).over(everything))
    share = (F.col("_w") * (F.col("_all") - F.col("_cut._before_cap"))).cast("double") / (
        F.col("_all_w") - F.col("_cut._before_w")).cast("double")
    at_cap = F.col("_cut").isNull() | (F.col("_before_w") < F.col("_cut._before_w"))
    return per.select("source", "source_size",
                      F.when(at_cap, F.col("_cap").cast("double")).otherwise(share).alias("target"))


def sainte_lague(df: DataFrame, group: list[str], name: str, weight: str, seats: str, cap: str, out: str) -> DataFrame:
    """``df`` with ``out``: the ``seats`` of each group given one by one to the highest weight / (2 held + 1).

    ``weight`` > 0 or the row gets none; a row holds ``cap`` seats at most; ties go by ``name``, null last.
    Listed are the seats within (rows x share + 2) of the rounded quota, beyond
    which no divisor that gives out all seats can move a row: about 3 a row.
    """
    whole = Window.partitionBy(*group)
    share = F.col(weight).cast("double") / F.sum(F.col(weight).cast("double")).over(whole)
    base = (df.withColumn("_share", F.coalesce(share, F.lit(0.0)))
            .withColumn("_near", F.floor(F.col(seats) * F.col("_share") + 0.5))
            .withColumn("_span", F.ceil(F.count(F.lit(1)).over(whole) * F.col("_share")) + 2)
            .withColumn("_low", F.least(F.col(cap), F.greatest(F.lit(0), F.col("_near") - F.col("_span"))).cast("long"))
            .withColumn("_high", F.least(F.col(cap), F.col("_near") + F.col("_span")).cast("long"))
            .withColumn("_free", F.col(seats) - F.sum("_low").over(whole)))
    listed = base.withColumn("_seat", F.explode_outer(F.when(
        (F.col("_high") > F.col("_low")) & (F.col(weight) > 0), F.sequence(F.col("_low"), F.col("_high") - 1))))
    quotient = F.col(weight).cast("double") / (2 * F.col("_seat") + 1)
    rank = F.row_number().over(whole.orderBy(quotient.desc_nulls_last(), F.col(name).isNull(), F.col(name)))
    won = listed.withColumn("_won", (F.col("_seat").isNotNull() & (rank <= F.col("_free"))).cast("long"))
    return (won.groupBy(*df.columns).agg(F.sum("_won").alias("_more"), F.first("_low").alias("_low"))
            .withColumn(out, F.col("_low") + F.col("_more")).drop("_low", "_more"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights: tuple = WEIGHTS, block_words: int = BLOCK_WORDS, shard_words: int = SHARD_WORDS) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, taken (words, repeats counted)."""
    sizes = staged(docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"),
                               word_count(F.col(text_col)).alias("size"), seeded_number(id_col).alias("order_no")),
                   "mix-sizes")
    blocks = lambda words: F.ceil(words / block_words).cast("long")
    sources = source_targets(sizes, weights).withColumns({
        "_cap": MAX_PASSES * blocks(F.col("source_size")),
        "_seats": F.floor(F.sum("source_size").over(Window.partitionBy()) / block_words + 0.5).cast("long")})
    sources = sainte_lague(sources, [], "source", "target", "_seats", "_cap", "source_quota").select(
        F.col("source").alias("s_source"), "source_size", "target", "source_quota",
        F.greatest(F.lit(1), F.ceil(F.col("source_size") / shard_words)).cast("long").alias("n_shards"))
    sources = staged(sources, "mix-sources")  # one row per source; its size decides how it is joined
    placed = (sizes.join(sources, F.col("source").eqNullSafe(F.col("s_source")))
              .withColumn("shard", F.col("order_no") % F.col("n_shards")).drop("s_source"))
    shards = (placed.groupBy("source", "shard").agg(
        F.sum("size").alias("shard_size"), F.first("source_quota").alias("source_quota"))
        .withColumn("n_blocks", blocks(F.col("shard_size"))).withColumn("_cap", MAX_PASSES * F.col("n_blocks")))
    shards = sainte_lague(shards, ["source"], "shard", "shard_size", "source_quota", "_cap", "quota").select(
        F.col("source").alias("h_source"), F.col("shard").alias("h_shard"), "n_blocks",
        F.when(F.col("n_blocks") > 0, F.expr("quota div n_blocks")).otherwise(0).alias("passes"),
        F.when(F.col("n_blocks") > 0, F.col("quota") % F.col("n_blocks")).otherwise(0).alias("picked"),
        seeded_number("source", "shard").alias("_no"))
    prime = F.element_at(F.array(*[F.lit(p).cast("long") for p in PRIMES]), (F.col("_no") % len(PRIMES) + 1).cast("int"))
    shards = staged(shards.withColumn("step", prime).withColumn("shift", F.expr("_no div 8") % F.greatest("n_blocks", F.lit(1)))
                    .drop("_no"), "mix-shards")
    # The stream of a shard: a running sum that needs no row of the shard but the last.
    stream = Window.partitionBy("source", "shard").orderBy("order_no", "doc_id", "size").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    spread = (placed.withColumn("_end", F.sum("size").over(stream))
              .join(shards, F.expr("source <=> h_source AND shard = h_shard")))
    extra = F.expr(f"""aggregate(
        CASE WHEN size > 0 AND picked > 0
             THEN sequence((_end - size) div {block_words}, (_end - 1) div {block_words}) ELSE array() END,
        0L, (acc, j) -> acc + CASE WHEN (step * j + shift) % n_blocks < picked
             THEN least(_end, (j + 1) * {block_words}) - greatest(_end - size, j * {block_words}) ELSE 0L END)""")
    return spread.select("doc_id", "source", "size", "source_size", "target",
                         (F.col("passes") * F.col("size") + extra).alias("taken"))


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                    weights: tuple = WEIGHTS) -> DataFrame:
    """``docs``, all columns, each row as often as the mix takes it.

    A document whose words the mix takes t times stays floor(t) times, and once
    more where its seeded number in 0..1 is below the rest of t.  Rows without a
    word stay once: they weigh nothing.
    """
    from chatsift.llm.common import fresh

    names = docs.columns
    key, hashed, times, copy = (fresh(names, x) for x in ("_mix_id", "_mix_hash", "_mix_times", "_mix_copy"))
    taken = mix(docs.select(F.struct(id_col, F.xxhash64(text_col).alias("h")).alias("doc_id"), text_col, source_col),
                "doc_id", text_col, source_col, weights)
    part = F.col("taken") / F.col("size")
    luck = (seeded_number(F.lit("copy"), "doc_id.h") % 1_000_000) / F.lit(1_000_000.0)
    taken = (taken.where("size > 0").withColumn(times, (F.floor(part) + (luck < part - F.floor(part)).cast("int")).cast("int"))
             # Rows of one id and text are alike: each stays as often as the first of them.
             .groupBy(F.col(f"doc_id.{id_col}").alias(key), F.col("doc_id.h").alias(hashed)).agg(F.max(times).alias(times)))
    joined = docs.join(taken, F.col(id_col).eqNullSafe(F.col(key)) & (F.xxhash64(F.col(text_col)) == F.col(hashed)), "left")
    repeat = F.when(F.coalesce(F.col(times), F.lit(1)) > 0, F.sequence(F.lit(1), F.coalesce(F.col(times), F.lit(1))))
    return joined.withColumn(copy, F.explode(repeat)).drop(key, hashed, times, copy)
