"""Trainer statistics as aggregations over logged token tables.

Tables:

* token log ``(step, seq_id, pos, logp, teacher_logp, ref_logp, entropy, mask)``
* distribution log ``(step, seq_id, pos, student array<double>, teacher array<double>)``
* sequence log ``(step, seq_id, prompt_ids array<int>, completion_ids array<int>)``
* metric log ``(mode, step, key, value)``

"Per batch" statistics of the trainer are per ``step`` here; per-step groups
are one training batch, bounded by batch size x completion length.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chatsift.operators.partitioning import grouped_quantile, running_sum, skewed_left_join
from chatsift.session import staged
from chatsift.functions.token_arrays import (
    entropy_from_logps, eos_clip, generalized_jsd, is_truncated, log_softmax, selected_logp,
)


# ------------------------------------------------------- per-token values ---

def with_distribution_stats(dist: DataFrame, temperature: float = 1.0, alphas=(0.0, 0.5, 1.0)) -> DataFrame:
    """Add log-softmax based values to a distribution log: student/teacher
    entropy and the divergence for each alpha (summed over the vocabulary)."""
    s = log_softmax("student", temperature)
    t = log_softmax("teacher", temperature)
    out = dist.withColumns({"_s": s, "_t": t})
    cols = {
        "student_entropy": entropy_from_logps("_s"),
        "teacher_entropy": entropy_from_logps("_t"),
    }
    for a in alphas:
        cols[f"div_{str(a).replace('.', '_')}"] = generalized_jsd("_s", "_t", a)
    return out.withColumns(cols).drop("_s", "_t")


def token_log_from_distributions(dist: DataFrame, token_col: str = "token", temperature: float = 1.0,
                                 ref_temperature: float = 2.0) -> DataFrame:
    """Per-token log-probs of the emitted token under student, teacher and a
    reference (the student at ``ref_temperature``), plus the student entropy."""
    s = log_softmax("student", temperature)
    return dist.withColumn("_s", s).select(
        "step", "seq_id", "pos",
        selected_logp("_s", F.col(token_col)).alias("logp"),
        selected_logp(log_softmax("teacher", temperature), F.col(token_col)).alias("teacher_logp"),
        selected_logp(log_softmax("student", ref_temperature), F.col(token_col)).alias("ref_logp"),
        entropy_from_logps("_s").alias("entropy"),
        F.col("mask").cast("int").alias("mask"),
    )


def skip_first(mask: str | Column = "mask", pos: str | Column = "pos", n: int = 0) -> Column:
    """Loss mask with the first ``n`` completion tokens zeroed."""
    m = F.col(mask) if isinstance(mask, str) else mask
    p = F.col(pos) if isinstance(pos, str) else pos
    return F.when(p >= n, m).otherwise(F.lit(0)).cast("int") if n > 0 else m.cast("int")


def kl_approx_value(logp: str = "logp", teacher_logp: str = "teacher_logp") -> Column:
    d = F.col(teacher_logp) - F.col(logp)
    return (F.col(logp) - F.col(teacher_logp)) + F.exp(d) - 1


def kl_to_base_value(logp: str = "logp", ref_logp: str = "ref_logp") -> Column:
    d = F.col(ref_logp) - F.col(logp)
    return F.exp(d) - d - 1


# ------------------------------------------------------ per-step metrics ---

def kl_approx(tokens: DataFrame, mask: str = "mask") -> DataFrame:
    """Token mean of the k3 estimate per step; no clamp: an all-masked step is null."""
    m = F.col(mask)
    return tokens.groupBy("step").agg(
        F.round(F.sum(kl_approx_value() * m) / F.nullif(F.sum(m), F.lit(0)), 6).alias("kl_approx")
    )


def masked_mean_metrics(tokens: DataFrame, cols=("entropy",), mask: str = "mask",
                        beta: float = 0.0) -> DataFrame:
    """Masked batch mean per step (denominator at least 1); a step whose
    completions have length 1 takes the plain mean.  ``kl_to_base`` only when
    beta != 0 (it is logged, never added to the loss)."""
    m = F.col(mask)
    values = {c: F.col(c) for c in cols}
    if beta != 0.0:
        values["kl_to_base"] = kl_to_base_value()
    aggs = [F.max("pos").alias("_maxpos"), F.greatest(F.sum(m), F.lit(1)).alias("_den")]
    for name, v in values.items():
        aggs += [F.sum(v * m).alias(f"_sm_{name}"), F.avg(v).alias(f"_avg_{name}")]
    g = tokens.groupBy("step").agg(*aggs)
    out = [F.col("step")]
    for name in values:
        out.append(F.round(
            F.when(F.col("_maxpos") == 0, F.col(f"_avg_{name}")).otherwise(F.col(f"_sm_{name}") / F.col("_den")), 6
        ).alias(f"mean_{name}"))
    return g.select(*out)


def sequence_loss(per_token: DataFrame, value: str = "loss", mask: str = "mask",
                  value_mask: str | None = None) -> DataFrame:
    """Per-sequence masked mean (denominator at least 1), then the mean over the
    step's sequences (a sequence mean, not a token mean).

    ``value_mask`` (such as ``entropy_mask``) takes values out of the sum only:
    the denominator still counts all tokens of ``mask``.
    """
    m = F.col(mask)
    v = F.col(value) if value_mask is None else F.when(F.col(value_mask).cast("boolean"), F.col(value)).otherwise(0.0)
    per_seq = per_token.groupBy("step", "seq_id").agg(
        (F.sum(v * m) / F.greatest(F.sum(m), F.lit(1))).alias("_seq")
    )
    return per_seq.groupBy("step").agg(F.round(F.avg("_seq"), 6).alias("loss"))


def high_entropy_mask(tokens: DataFrame, rho: float, mask: str = "mask",
                      entropy: str = "entropy") -> DataFrame:
    """Keep tokens whose entropy is at least the step's (1 - rho) quantile
    (linear interpolation over unmasked tokens); masked tokens never pass and
    a step without unmasked tokens keeps nothing.

    The log is computed once (staged).  The quantile is exact and spreads a step
    of any size over the tasks (``grouped_quantile``); the thresholds, one row per
    step, come back by a join that a hot step cannot stall.
    """
    q = 1.0 - rho
    tokens = staged(tokens, "tokens")
    thr = grouped_quantile(tokens.where(F.col(mask) != 0), ["step"], entropy, q, out_col="threshold")
    steps = staged(tokens.groupBy("step").agg(F.count(F.lit(1)).alias("_rows"))
                   .join(thr.select("step", "threshold"), "step", "left"), "thresholds")
    out = skewed_left_join(tokens, steps, "step", "_rows")
    keep = F.coalesce((F.col(entropy) * F.col(mask) >= F.col("threshold")) & (F.col(mask) != 0), F.lit(False))
    return out.withColumn("entropy_mask", keep)


def completion_length_stats(seqs: DataFrame, eos_id: int, pad_id: int,
                            ids: str = "completion_ids") -> DataFrame:
    """Per step: mean/min/max completion length, clipped ratio, and the same
    length stats over terminated sequences only (0 when none terminated)."""
    ln = F.size(ids).cast("double")
    trunc = is_truncated(ids, eos_id, pad_id)
    term = F.when(~trunc, ln)
    g = seqs.groupBy("step").agg(
        F.avg(ln).alias("mean_length"), F.min(ln).alias("min_length"), F.max(ln).alias("max_length"),
        F.avg(trunc.cast("double")).alias("clipped_ratio"),
        F.avg(term).alias("mean_terminated_length"),
        F.min(term).alias("min_terminated_length"),
        F.max(term).alias("max_terminated_length"),
    )
    cols = [c for c in g.columns if c != "step"]
    return g.select("step", *[F.round(F.coalesce(F.col(c), F.lit(0.0)), 6).alias(c) for c in cols])


def tokens_seen(seqs: DataFrame, prompt: str = "prompt_ids", completion: str = "completion_ids") -> DataFrame:
    """Running total of prompt + completion tokens after each step.

    Summed over the per-step aggregate (one row per step) in two levels, see ``running_sum``.
    """
    per_step = seqs.groupBy("step").agg(
        F.sum(F.size(prompt) + F.size(completion)).cast("long").alias("step_tokens")
    )
    return running_sum(per_step, "step", "step_tokens", "num_tokens")


def metric_rollup(metrics: DataFrame, logging_steps: int = 1) -> DataFrame:
    """Mean per metric key per logging interval; eval metrics get an ``eval_`` prefix."""
    interval = F.floor(F.col("step") / F.lit(logging_steps)).cast("long")
    name = F.when(F.col("mode") == "eval", F.concat(F.lit("eval_"), F.col("key"))).otherwise(F.col("key"))
    return metrics.groupBy(F.col("mode"), interval.alias("interval"), name.alias("metric")).agg(
        F.round(F.avg("value"), 6).alias("value")
    )


def recent_completions(log: DataFrame, n: int, order=("step", "seq_id")) -> DataFrame:
    """The last n logged (step, prompt, completion) rows: a top-k report."""
    return log.orderBy(*[F.col(c).desc() for c in order]).limit(int(n))


def mask_truncated(seqs: DataFrame, eos_id: int, pad_id: int, ids: str = "completion_ids") -> DataFrame:
    """A completion mask of ones, zeroed for truncated completions."""
    trunc = is_truncated(ids, eos_id, pad_id)
    return seqs.withColumn(
        "completion_mask",
        F.when(trunc, F.array_repeat(F.lit(0), F.size(ids))).otherwise(F.array_repeat(F.lit(1), F.size(ids))),
    )


def clip_at_eos(seqs: DataFrame, eos_id: int, ids: str = "completion_ids") -> DataFrame:
    return seqs.withColumn(ids, eos_clip(ids, eos_id))
