"""The driver contract: entry, queries and oracle SQL agree (sf0.001 subset)."""

import math

import duckdb
import pytest

import __spark_entry__ as se

from conftest import SF_SMALL

KEYS = ["funnel", "curate_kept", "detect_lang", "split_val", "seeded_sample", "batch_plan", "token_stats",
        "think_language", "judge_filter", "entropy_mask", "prepare_dpo_train", "release_roundtrip",
        "teacher_prompts", "clip_pad", "metric_rollup"]
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def _norm(v):
    if isinstance(v, float):
        return round(v, 6) if not math.isnan(v) else "nan"
    return v


def _canon(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


def test_keys_match():
    assert set(se.oracle_sql()) <= set(se.queries())
    assert not set(se.queries()) - set(se.oracle_sql()) - {k for k in se.queries() if k.startswith("op") or k == "pipeline"}
    assert len(se.queries()) >= 80


def test_entry_schema(spark):
    df = se.entry(spark)
    assert df.columns == ["stage_order", "stage", "before", "after", "removed"]
    rows = df.collect()
    assert rows[-1].stage == "TOTAL" and rows[-1].before >= rows[-1].after


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, duck, key):
    df = se.queries()[key](spark, SF_SMALL)
    srows, scols = [tuple(r) for r in df.collect()], df.columns
    res = duck.execute(se.oracle_sql()[key])
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    assert sorted(scols) == sorted(dcols)
    assert _canon(srows, scols) == _canon(drows, dcols)
