"""Cuts, quantiles, running sums and row-local language detection against brute force."""

import datetime
import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from chatsift.operators import lang
from chatsift.operators import partitioning as part
from chatsift.operators import sampling as smp
from chatsift.session import read_table

from conftest import SF_SMALL


# -------------------------------------------------------------------- cuts ---

@pytest.mark.parametrize("few, ranges", [(50_000, 1 << 16), (3, 4)])
def test_nth_key_equals_sorting(spark, monkeypatch, few, ranges):
    monkeypatch.setattr(part, "FEW", few)
    monkeypatch.setattr(part, "RANGES", ranges)
    rng = random.Random(1)
    values = [rng.choice([5, 5, 5, -2**63, 2**63 - 1, rng.randint(-10**6, 10**6), rng.randint(0, 20)]) for _ in range(400)]
    keys = spark.createDataFrame([(v,) for v in values] + [(None,)], "k long").coalesce(1).cache()
    values.sort()
    for n in (1, 2, 57, 200, 399, 400):
        cut = part.nth_key(keys, "k", n)
        v = values[n - 1]
        assert (cut.value, cut.below, cut.ties) == (v, sum(x < v for x in values), values.count(v))
    assert part.nth_key(keys, "k", 401) is None and part.nth_key(keys, "k", 0) is None


def test_first_rows_by_strings_dates_times_and_numbers(spark):
    rng = random.Random(2)
    rows = []
    for i in range(300):
        s = rng.choice(["conversation-%05d" % rng.randint(0, 40), "conversation-", "", "a", "a\0", "é%d" % rng.randint(0, 5), None])
        day = datetime.date(2020, 1, 1) + datetime.timedelta(days=rng.randint(-900, 900))
        rows.append((s, None if i % 9 == 0 else day, datetime.datetime(2021, 1, 1) + datetime.timedelta(seconds=rng.randint(0, 99)),
                     rng.choice([None, 0.5, -1.5, float(i)]), i % 4 == 0, f"row {i // 2}"))
    df = spark.createDataFrame(rows, "s string, d date, t timestamp, x double, b boolean, text string").coalesce(2).cache()
    order = {"s": lambda v: v.encode(), "d": lambda v: v, "t": lambda v: v, "x": lambda v: v, "b": lambda v: v}
    for place, (c, key) in enumerate(order.items()):
        ordered = sorted((r[place] for r in rows), key=lambda v: (v is None, key(v) if v is not None else 0))
        for n in (1, 100, 260, 299):
            got = [r[c] for r in smp.max_samples(df, n, c).collect()]
            assert Counter(got) == Counter(ordered[:n]), (c, n)


def test_a_key_that_most_rows_share_is_cut_by_content_then_by_position(spark):
    rows = [(1, f"t{i % 5}") for i in range(90)] + [(2, "x")] * 10 + [(None, "n")] * 20
    df = spark.createDataFrame(rows, "id long, text string").repartition(6).cache()
    for n in (1, 17, 45, 89, 95, 105):
        first = smp.seeded_sample(df, n)
        assert first.count() == n
        train, val = smp.train_val_split(df, size=n)
        assert Counter(map(tuple, train.collect())) + Counter(map(tuple, val.collect())) == Counter(rows)
        again = Counter(map(tuple, smp.train_val_split(df.repartition(3), size=n)[1].collect()))
        assert again == Counter(map(tuple, val.collect()))


def test_counting_passes_read_the_id_only(spark, monkeypatch, tmp_path):
    spark.range(1000).select("id", F.lit("wide").alias("text"), F.lit("more").alias("more")).write.parquet(f"{tmp_path}/d")
    plans = []
    real = smp.staged

    def spy(df, name):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return real(df, name)
    monkeypatch.setattr(smp, "staged", spy)
    df = spark.read.parquet(f"{tmp_path}/d")
    for cut in (lambda: smp.train_val_split(df, 0.1), lambda: smp.seeded_sample(df, 10), lambda: smp.max_samples(df, 10)):
        plans.clear()
        cut()
        assert len(plans) == 1 and "ReadSchema: struct<id:bigint>" in plans[0]


# --------------------------------------------------------- quantiles, sums ---

def _quantile(values, q):
    v = sorted(values)
    pos = q * (len(v) - 1)
    lo = math.floor(pos)
    hi = min(lo + 1, len(v) - 1)
    return v[lo] if pos == lo else v[lo] + (pos - lo) * (v[hi] - v[lo])


@pytest.mark.parametrize("ranges", [2, 4096])
def test_quantiles_of_hot_groups_ties_and_extreme_values(spark, ranges):
    rng = random.Random(3)
    groups = {"hot": [rng.choice([0.0, 1.0, rng.gauss(0, 5)]) for _ in range(3000)], "one": [4.5], "same": [2.0] * 50,
              "ends": [-1.7e308, 1.7e308, 0.0, 5e-324, 0.0, 1.0], "inf": [1.0, 2.0, float("inf"), float("inf"), -3.0],
              "minus": [float("-inf")] * 3 + [0.0]}
    rows = [(g, v) for g, vs in groups.items() for v in vs] + [("hot", None), ("hot", float("nan")), (None, 1.0), ("none", None)]
    df = spark.createDataFrame(rows, "g string, v double")
    for q in (0.0, 0.3, 0.5, 1.0):
        got = {r.g: r.quantile for r in part.grouped_quantile(df, ["g"], "v", q, ranges=ranges).collect()}
        assert set(got) == set(groups)
        for g, vs in groups.items():
            assert got[g] == pytest.approx(_quantile(vs, q), rel=1e-12, nan_ok=True), (g, q)


def test_running_sum_equals_accumulating(spark):
    rng = random.Random(4)
    rows = [(i, rng.randint(-50, 50) if i % 7 else None) for i in rng.sample(range(10_000), 700)]
    df = spark.createDataFrame(rows, "k long, v long").repartition(5)
    got = {r.k: r.total for r in part.running_sum(df, "k", "v", "total").collect()}
    total = 0
    for k, v in sorted(rows):
        total += v or 0
        assert got[k] == total
    empty = part.running_sum(df.where("false"), "k", "v", "total")
    assert empty.columns == ["k", "v", "total"] and empty.count() == 0


def test_skewed_join_keeps_every_row(spark, monkeypatch):
    monkeypatch.setattr(part, "HOT_PARTS", 5)
    rows = spark.range(1000).select(F.when(F.col("id") < 600, 1).when(F.col("id") < 990, F.col("id")).alias("k"), "id")
    counts = rows.where("k is not null").groupBy("k").agg(F.count(F.lit(1)).alias("n")).where("k <> 700").withColumn("v", F.col("k") * 2)
    got = sorted(((r.id, r.k, r.v) for r in part.skewed_left_join(rows, counts, "k", "n").collect()), key=repr)
    want = [(i, 1 if i < 600 else i if i < 990 else None) for i in range(1000)]
    assert got == sorted(((i, k, None if k in (None, 700) else 2 * k) for i, k in want), key=repr)


# ---------------------------------------------------------------- language ---

def _brute_language(profile, text):
    letters = "".join(c if c.isalpha() else " " for c in (text or "").lower()).split()
    if not letters:
        return None
    line = " " + " ".join(letters) + " "
    unseen, weight = profile
    scores = {}
    for code, u in unseen.items():
        grams = [line[i:i + 3] for i in range(len(line) - 2)]
        scores[code] = sum(u + weight.get((code, g), 0) for g in grams)
    return max(scores, key=lambda c: (scores[c], c))


def test_language_of_rows_with_repeated_and_null_ids(spark):
    docs = read_table(spark, SF_SMALL, "documents")
    prof = lang.train_lang_profiles(docs).cache()
    whole = lambda x: math.floor(x * lang.UNIT + 0.5) if x >= 0 else -math.floor(-x * lang.UNIT + 0.5)
    rows = prof.collect()
    profile = ({r.lang: whole(r.unseen_logp) for r in rows}, {(r.lang, r.gram): whole(r.logp - r.unseen_logp) for r in rows})
    texts = [r.text for r in docs.select("text").limit(40).collect()]
    texts += ["the house is red and the garden is green", "la maison est rouge et le jardin est vert", "", None, "123", "\U0001f600 x",
              "\U00010400\U00010400 zz"]
    data = [(i % 3 if i % 4 else None, t) for i, t in enumerate(texts)]
    df = spark.createDataFrame(data, "id long, text string")
    want = Counter((i, _brute_language(profile, t)) for i, t in data)
    for entries in (lang.MAX_ENTRIES, 0):  # arrays in the task, and the joined form
        got = lang.detect_lang(df, prof, max_entries=entries)
        assert Counter(map(tuple, got.collect())) == want


def test_scores_do_not_depend_on_the_pieces(spark, monkeypatch):
    docs = read_table(spark, SF_SMALL, "documents")
    arrays = lang.ProfileArrays.load(lang.train_lang_profiles(docs))
    texts = [r[0] for r in docs.select(lang.lang_text("text")).limit(30).collect() if r[0]] + [" a ", " ab "]
    whole = arrays.scores(texts)
    for chunk in (1, 7, 500):
        monkeypatch.setattr(lang, "CHUNK", chunk)
        assert (arrays.scores(texts) == whole).all()
