"""Reports and summaries (A1-A11): one aggregation pass each.

Global statistics never gather raw values in one task: counts, sums, min/max
and averages are partial aggregates; the median comes from the running counts of
the different values (:func:`chatsift.operators.partitioning.running_sum`).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chatsift.functions.text import join_contents, think_contents
from chatsift.operators.partitioning import running_sum
from chatsift.session import staged

# Report layout and display names.
BAR_WIDTH = 30
LANG_NAMES = {
    "fr": "French",
    "en": "English",
    "es": "Spanish",
    "de": "German",
    "zh-cn": "Chinese",
    "ja": "Japanese",
    "ar": "Arabic",
    "unknown": "Unknown",
    "no_think": "Unclosed reasoning (no </think>)",
}


def stage_funnel(df: DataFrame, stages: list[tuple[str, Column]]) -> DataFrame:
    """Per stage ``before / after / removed`` plus a TOTAL row, in one pass.

    ``stages`` is an ordered list of (name, keep-predicate).  Flags are
    cumulative (a row counts for stage i only if it passed stages < i), all
    counted by a single partial aggregate; the few result rows come from
    ``stack``.
    """
    agg = df.agg(*funnel_counts(stages)).select(
        *[F.coalesce(F.col(f"n{i}"), F.lit(0)).alias(f"n{i}") for i in range(len(stages) + 1)])
    rows = []
    for i, (name, _) in enumerate(stages):
        rows += [F.lit(i + 1), F.lit(name), F.col(f"n{i}"), F.col(f"n{i + 1}")]
    rows += [F.lit(len(stages) + 1), F.lit("TOTAL"), F.col("n0"), F.col(f"n{len(stages)}")]
    out = agg.select(F.inline(F.array(*[
        F.struct(rows[j].alias("stage_order"), rows[j + 1].alias("stage"),
                 rows[j + 2].cast("long").alias("before"), rows[j + 3].cast("long").alias("after"))
        for j in range(0, len(rows), 4)
    ])))
    return out.withColumn("removed", F.col("before") - F.col("after"))


def funnel_counts(stages: list[tuple[str, Column]]) -> list[Column]:
    """Aggregates ``n0, n1, ...``: all rows, then those that passed the stages so far (for ``agg`` or ``observe``)."""
    cum = F.lit(True)
    counts = [F.count(F.lit(1)).alias("n0")]
    for i, (_, pred) in enumerate(stages):
        cum = cum & F.coalesce(pred, F.lit(False))
        counts.append(F.sum(cum.cast("long")).alias(f"n{i + 1}"))
    return counts


def funnel_rows(spark, names: list[str], counts: list[int]) -> DataFrame:
    """The table of :func:`stage_funnel` from counted numbers: ``counts`` has one more entry than ``names``."""
    rows = [(i + 1, name, counts[i], counts[i + 1], counts[i] - counts[i + 1]) for i, name in enumerate(names)]
    rows.append((len(names) + 1, "TOTAL", counts[0], counts[-1], counts[0] - counts[-1]))
    return spark.createDataFrame(rows, "stage_order int, stage string, before long, after long, removed long")


def freq_table(df: DataFrame, col: str | Column, label: str = "label") -> DataFrame:
    """``label, count, pct, bar`` like the console tables of the reference.

    ``pct = 100 * count / total``; the bar has ``int(30 * count / total)`` pipes
    padded with dots.  The grouped rows (one per distinct label) are staged and
    their total is one number.
    """
    c = F.col(col) if isinstance(col, str) else col
    grouped = df.groupBy(c.alias(label)).agg(F.count(F.lit(1)).alias("count"))
    return _with_pct_bar(grouped)


def _with_pct_bar(grouped: DataFrame) -> DataFrame:
    grouped = staged(grouped, "labels")
    g = grouped.withColumn("_total", F.lit(grouped.agg(F.sum("count")).first()[0] or 0))
    filled = F.when(F.col("_total") > 0, F.floor(F.lit(BAR_WIDTH) * F.col("count") / F.col("_total"))).otherwise(0).cast("int")
    return g.select(
        "*",
        F.when(F.col("_total") > 0, F.round(F.lit(100.0) * F.col("count") / F.col("_total"), 6)).otherwise(0.0).alias("pct"),
        F.concat(F.lit("["), F.repeat(F.lit("|"), filled), F.repeat(F.lit("."), F.lit(BAR_WIDTH) - filled), F.lit("]")).alias("bar"),
    ).drop("_total")


def finish_reason_report(df: DataFrame, finish_col: str = "finish_reason") -> DataFrame:
    return freq_table(df, finish_col, "finish_reason")


def thinking_language_key(df: DataFrame, profiles: DataFrame, id_col: str = "id",
                          messages: str = "messages") -> DataFrame:
    """``(id, lang_key)`` of every row: ``no_think`` without closed reasoning, else the detected
    language of the reasoning text, ``unknown`` when detection fails."""
    from chatsift.operators.lang import with_language

    tc = think_contents(messages)
    base = df.select(F.col(id_col), F.when(F.size(tc) > 0, F.array_join(tc, " ")).alias("_think"))
    return with_language(base, profiles, F.col("_think"), "_lang").select(
        id_col,
        F.when(F.col("_think").isNull(), F.lit("no_think"))
        .otherwise(F.coalesce(F.col("_lang"), F.lit("unknown"))).alias("lang_key"),
    )


def display_name(key: Column) -> Column:
    names = F.create_map(*[x for k, v in LANG_NAMES.items() for x in (F.lit(k), F.lit(v))])
    return F.coalesce(names[key], key)


def thinking_language_report(df: DataFrame, profiles: DataFrame, id_col: str = "id",
                             messages: str = "messages") -> DataFrame:
    keys = thinking_language_key(df, profiles, id_col, messages)
    return freq_table(keys, display_name(F.col("lang_key")), "language")


def looping_report(df: DataFrame, messages: str = "messages", n: int = 10, k: int = 3) -> DataFrame:
    """Looping vs clean over the assistant text (two labelled rows)."""
    from chatsift.operators.ngrams import ngram_loop

    loop = ngram_loop(join_contents(messages, "assistant"), n, k)
    counts = df.agg(
        F.sum(loop.cast("long")).alias("looping"), F.count(F.lit(1)).alias("total")
    )
    rows = counts.select(F.inline(F.array(
        F.struct(F.lit("Looping").alias("label"), F.coalesce(F.col("looping"), F.lit(0)).alias("count")),
        F.struct(F.lit("Clean").alias("label"), (F.col("total") - F.coalesce(F.col("looping"), F.lit(0))).alias("count")),
    )))
    return _with_pct_bar(rows)


def completion_token_stats(df: DataFrame, col: str = "completion_tokens") -> DataFrame:
    """min / max / avg of the non-null values; no row when there are none."""
    return df.agg(
        F.count(col).alias("n"), F.min(col).alias("min_tokens"),
        F.max(col).alias("max_tokens"), F.round(F.avg(col), 6).alias("avg_tokens"),
    ).where(F.col("n") > 0)


def _value_counts(df: DataFrame, col: str) -> DataFrame:
    """``(value, c, seen)`` of the non-null values: rows of each value, and of all values up to it.

    Counting is combined before the shuffle, so the table has one row per
    different value; it is staged once.
    """
    counts = df.where(F.col(col).isNotNull()).groupBy(F.col(col).alias("value")).agg(F.count(F.lit(1)).alias("c"))
    return running_sum(counts, "value", "c", "seen")


def _upper_median(counts: DataFrame, total: int):
    return counts.where(F.col("seen") > total // 2).agg(F.min("value")).first()[0] if total else None


def upper_median(df: DataFrame, col: str):
    """``sorted(values)[n // 2]`` over non-null values, exact and distributed."""
    counts = _value_counts(df, col)
    return _upper_median(counts, counts.agg(F.sum("c")).first()[0] or 0)


def token_stats(df: DataFrame, col: str = "tokens") -> DataFrame:
    """count, average, upper median, min and max of a token-length column.

    The texts are read once: everything comes from the counts of the different lengths.
    """
    counts = _value_counts(df, col)
    median = _upper_median(counts, counts.agg(F.sum("c")).first()[0] or 0)
    n = F.sum("c")
    return counts.agg(
        F.coalesce(n, F.lit(0)).alias("samples"), F.round(F.sum(F.col("value") * F.col("c")) / n, 6).alias("avg_tokens"),
        F.min("value").alias("min_tokens"), F.max("value").alias("max_tokens"),
    ).withColumn("median_tokens", F.lit(median).cast("long"))


def loop_summary(flags: DataFrame) -> DataFrame:
    """Counts and percentages of no-EOS, n-gram and any looping over the prompts."""
    n = F.count(F.lit(1))
    agg = flags.agg(
        n.alias("samples"),
        F.sum(F.col("no_eos").cast("long")).alias("no_eos"),
        F.sum(F.col("ngram_loop").cast("long")).alias("ngram_loop"),
        F.sum(F.col("looping").cast("long")).alias("looping"),
    )
    pct = lambda c: F.when(F.col("samples") > 0, F.round(F.lit(100.0) * F.col(c) / F.col("samples"), 6))
    return agg.select(
        "samples", "no_eos", "ngram_loop", "looping",
        pct("no_eos").alias("no_eos_pct"), pct("ngram_loop").alias("ngram_loop_pct"), pct("looping").alias("looping_pct"),
    )


def judge_summary(verdicts: DataFrame, verdict_col: str = "verdict") -> DataFrame:
    """accepted, rejected (errors included) and pass rate (null when nothing ran)."""
    v = F.col(verdict_col)
    agg = verdicts.agg(
        F.sum(F.when(v, 1).otherwise(0)).alias("accepted"),
        F.sum(F.when(v, 0).otherwise(1)).alias("rejected"),
    ).select(F.coalesce("accepted", F.lit(0)).alias("accepted"), F.coalesce("rejected", F.lit(0)).alias("rejected"))
    total = F.col("accepted") + F.col("rejected")
    return agg.withColumn("pass_rate", F.when(total > 0, F.round(F.lit(100.0) * F.col("accepted") / total, 6)))


def generation_summary(dataset: DataFrame, done_ids: DataFrame, replies: DataFrame) -> DataFrame:
    """Dataset size; generated = previously done + new successes; errors.

    The three inputs are tagged and unioned, then counted by one aggregate.
    """
    tagged = (
        dataset.select(F.lit("t").alias("_k"), F.lit(None).cast("string").alias("_e"))
        .unionByName(done_ids.select(F.lit("d").alias("_k"), F.lit(None).cast("string").alias("_e")))
        .unionByName(replies.select(F.lit("r").alias("_k"), F.col("error").cast("string").alias("_e")))
    )
    k, e = F.col("_k"), F.col("_e")
    return tagged.agg(
        F.sum(F.when(k == "t", 1).otherwise(0)).cast("long").alias("total_samples"),
        F.sum(F.when((k == "d") | ((k == "r") & e.isNull()), 1).otherwise(0)).cast("long").alias("generated"),
        F.sum(F.when((k == "r") & e.isNotNull(), 1).otherwise(0)).cast("long").alias("errors"),
    )


def observe_progress(df: DataFrame, name: str = "progress", verdict_col: str = "verdict",
                     text: Column | None = None):
    """Running accepted / rejected counts (and the last rejected example's
    preview) as ``observe()`` metrics, filled by whatever action runs next.

    Returns ``(df, observation)``; ``observation.get`` holds the metrics once
    the action (a write, or one streaming micro-batch) has finished.
    """
    from pyspark.sql import Observation

    from chatsift.functions.text import preview

    obs = Observation(name)
    v = F.coalesce(F.col(verdict_col), F.lit(False))
    metrics = [
        F.count(F.lit(1)).alias("processed"),
        F.sum(F.when(v, 1).otherwise(0)).alias("accepted"),
        F.sum(F.when(v, 0).otherwise(1)).alias("rejected"),
    ]
    if text is not None:
        metrics.append(F.max_by(preview(text), F.when(~v, F.monotonically_increasing_id())).alias("last_rejected"))
    return df.observe(obs, *metrics), obs
