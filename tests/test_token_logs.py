"""Token-log statistics against brute-force Python on a small table."""

import math
import random

import pytest
from pyspark.sql import functions as F

from chatsift.operators import token_logs as tl
from chatsift.operators.partitioning import grouped_quantile


def _tokens(spark, seed=3):
    rng = random.Random(seed)
    rows = []
    for step in range(3):
        for seq in range(4):
            length = 1 if step == 2 else rng.randint(2, 6)
            for pos in range(length):
                lp, tlp, rlp = (-rng.random() * 3 for _ in range(3))
                rows.append((step, step * 10 + seq, pos, lp, tlp, rlp, rng.random() * 2,
                             0 if (pos > 3 and rng.random() < 0.5) else 1))
    schema = "step long, seq_id long, pos int, logp double, teacher_logp double, ref_logp double, entropy double, mask int"
    return rows, spark.createDataFrame(rows, schema)


def test_kl_approx_token_mean(spark):
    rows, df = _tokens(spark)
    got = {r.step: r.kl_approx for r in tl.kl_approx(df).collect()}
    for step in range(3):
        rs = [r for r in rows if r[0] == step]
        num = sum(((r[3] - r[4]) + math.exp(r[4] - r[3]) - 1) * r[7] for r in rs)
        den = sum(r[7] for r in rs)
        assert got[step] == pytest.approx(round(num / den, 6), abs=1e-6)


def test_masked_mean_length_one(spark):
    rows, df = _tokens(spark)
    got = {r.step: r for r in tl.masked_mean_metrics(df, ("entropy",), beta=0.1).collect()}
    rs = [r for r in rows if r[0] == 2]           # every completion has length 1
    assert got[2].mean_entropy == pytest.approx(sum(r[6] for r in rs) / len(rs), abs=1e-6)
    rs0 = [r for r in rows if r[0] == 0]
    den = max(sum(r[7] for r in rs0), 1)
    assert got[0].mean_entropy == pytest.approx(sum(r[6] * r[7] for r in rs0) / den, abs=1e-6)
    kl = [(math.exp(r[5] - r[3]) - (r[5] - r[3]) - 1) * r[7] for r in rs0]
    assert got[0].mean_kl_to_base == pytest.approx(sum(kl) / den, abs=1e-6)


def test_sequence_loss_is_mean_of_sequence_means(spark):
    rows, df = _tokens(spark)
    per = df.select("step", "seq_id", F.col("entropy").alias("loss"), "mask")
    got = {r.step: r.loss for r in tl.sequence_loss(per).collect()}
    for step in range(3):
        seqs = {}
        for r in rows:
            if r[0] == step:
                seqs.setdefault(r[1], []).append(r)
        means = [sum(x[6] * x[7] for x in s) / max(sum(x[7] for x in s), 1) for s in seqs.values()]
        assert got[step] == pytest.approx(sum(means) / len(means), abs=1e-6)


def _torch_like_quantile(values, q):
    v = sorted(values)
    pos = q * (len(v) - 1)
    lo = math.floor(pos)
    hi = min(lo + 1, len(v) - 1)
    return v[lo] + (pos - lo) * (v[hi] - v[lo])


@pytest.mark.parametrize("q", [0.0, 0.2, 0.5, 0.8, 1.0])
def test_grouped_quantile_exact(spark, q):
    rng = random.Random(11)
    rows = [(g, float(rng.choice([rng.random(), 0.5, 0.25]))) for g in range(4) for _ in range(rng.randint(1, 400))]
    rows += [(9, rng.random()) for _ in range(2500)]          # a group larger than ``accuracy``
    df = spark.createDataFrame(rows, "g long, v double")
    got = {r.g: r.quantile for r in grouped_quantile(df, ["g"], "v", q, ranges=16).collect()}
    for g in list(range(4)) + [9]:
        assert got[g] == pytest.approx(_torch_like_quantile([v for gg, v in rows if gg == g], q), abs=1e-12)
    spark_pct = {r.g: r.p for r in df.groupBy("g").agg(F.percentile("v", q).alias("p")).collect()}
    assert all(got[g] == pytest.approx(spark_pct[g]) for g in got)


def test_high_entropy_mask_ties_and_empty(spark):
    rows, df = _tokens(spark)
    df = df.withColumn("mask", F.when(F.col("step") == 1, 0).otherwise(F.col("mask")))
    out = tl.high_entropy_mask(df, 0.2).collect()
    assert not any(r.entropy_mask for r in out if r.step == 1)          # no unmasked tokens -> all false
    s0 = [r for r in out if r.step == 0]
    thr = _torch_like_quantile([r.entropy for r in s0 if r.mask], 0.8)
    assert all(r.entropy_mask == (r.mask == 1 and r.entropy >= thr) for r in s0)


def test_length_stats_all_truncated(spark):
    df = spark.createDataFrame([(0, 1, [5, 6]), (0, 2, [7])], "step long, seq_id long, completion_ids array<int>")
    r = tl.completion_length_stats(df, eos_id=1, pad_id=0).first()
    assert r.clipped_ratio == 1.0 and r.mean_terminated_length == 0.0 and r.max_terminated_length == 0.0
    assert r.mean_length == 1.5


def test_tokens_seen_running_total(spark):
    df = spark.createDataFrame([(0, [1, 2], [3]), (0, [1], []), (1, [1, 1, 1], [2, 2])],
                               "step long, prompt_ids array<int>, completion_ids array<int>")
    got = [(r.step, r.num_tokens) for r in tl.tokens_seen(df).orderBy("step").collect()]
    assert got == [(0, 4), (1, 9)]
