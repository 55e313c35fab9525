"""Steps whose memory or shuffle must not grow with the rows of a batch, a task or a table."""

import tracemalloc

import numpy as np
import pandas as pd
import pytest

from brute import has_ngram_loop_py
from chatsift.operators import ngrams


def peak_mb(call) -> float:
    tracemalloc.start()
    try:
        call()
        return tracemalloc.get_traced_memory()[1] / 1e6
    finally:
        tracemalloc.stop()


def test_loops_of_a_batch_are_counted_within_bounded_memory():
    texts = [" ".join(f"w{i * j % 997}" for i in range(300)) for j in range(1, 11)]
    texts[3] = "a b c d e f g h i j " * 7
    small, large = (pd.Series(texts * m, dtype=object) for m in (100, 500))
    assert peak_mb(lambda: ngrams.looping(large, 10, 5)) < 1.5 * peak_mb(lambda: ngrams.looping(small, 10, 5)) + 2
    assert ngrams.looping(large, 10, 5).sum() == 500 * sum(has_ngram_loop_py(t, 10, 5) for t in texts) > 0


@pytest.mark.parametrize("chunk", [1, 20, 1 << 19])
def test_loops_do_not_depend_on_the_cuts(monkeypatch, chunk):
    monkeypatch.setattr(ngrams, "CHUNK", chunk)
    draw = np.random.default_rng(5)
    texts = [None, "", " \x1c  ", "x" * 99, *(
        "".join(draw.choice(["a", "b", "a ", " b", "\n", "\x1e", "é "], size)) for size in (1, 5, 40, 41, 90, 300) for _ in range(8))]
    for n, k in ((1, 1), (2, 2), (3, 2), (4, 1)):
        assert ngrams.looping(texts, n, k).tolist() == [has_ngram_loop_py(t, n, k) for t in texts]


def rows_exploded(df) -> int:
    """Rows that the explodes of an executed plan made."""
    def walk(node) -> int:
        name = node.nodeName()
        inner = [node.executedPlan()] if name == "AdaptiveSparkPlan" else [node.plan()] if "QueryStage" in name else []
        children = node.children()
        own = node.metrics().get("numOutputRows").get().value() if name == "Generate" else 0
        return own + sum(walk(x) for x in [*inner, *(children.apply(i) for i in range(children.size()))])

    df.collect()
    return walk(df._jdf.queryExecution().executedPlan())


def test_ngrams_of_texts_that_cannot_loop_are_not_exploded(spark):
    plain, loop = " ".join(f"w{i}" for i in range(500)), "a b c d e f g h i j " * 7
    docs = spark.createDataFrame([(i, loop if i == 7 else plain) for i in range(40)], "id long, t string")
    out = ngrams.ngram_loop_exploded(docs, "id", "t", 10, 5)
    assert rows_exploded(out) < 200  # a row each, and the n-grams of one
    assert [r.id for r in out.collect()] == [7]


@pytest.mark.parametrize("sent", [0, 100])
def test_exploded_ngrams_of_one_id_are_counted_together(spark, monkeypatch, sent):
    monkeypatch.setattr(ngrams, "MAX_IDS", sent)
    two, plain = "a b c d " * 2, "x y z u v w"
    rows = [(None, two), (None, two), (1, two), (1, plain), (2, two), (2, two), (2, None), (3, plain), (3, plain), (4, "a b c d " * 4),
            (5, two), (6, None), (7, "  "), (8, plain), (None, "a b"), (9, None), (9, None)]
    docs = spark.createDataFrame(rows, "id long, t string")
    for k in (0, 1, 2, 3):
        want = {i for i in {r[0] for r in rows} if has_ngram_loop_py(" ".join(f"{t} #{j}" for j, (x, t) in enumerate(rows) if x == i and t), 4, k)}
        if k == 0:  # n-grams across the rows of an id are none
            want = {i for i, t in rows if has_ngram_loop_py(t, 4, 0)}
        got = [r.id for r in ngrams.ngram_loop_exploded(docs, "id", "t", 4, k).collect()]
        assert len(got) == len(set(got)) and set(got) == want, k


def test_requests_written_twice_lie_in_as_many_files(spark, tmp_path):
    from chatsift.streaming.jobs import _write_twice

    rows = [(i if i % 5 else None, f"p{i % 3}", None if i % 7 == 0 else "d", i % 2) for i in range(60)] + [(1, "p1", "d", 1)] * 9
    requests = spark.createDataFrame(rows, "id long, prompt string, demonstration string, quality int")
    for name, want in (("some", sorted(rows, key=repr)), ("none", [])):
        files = _write_twice(requests.limit(len(want)), str(tmp_path / name))
        for part in ("a", "b"):
            back = spark.read.parquet(str(tmp_path / name / part))
            assert len(back.inputFiles()) == files and (files > 1 or not want)
            assert sorted((tuple(r) for r in back.collect()), key=repr) == want


def test_languages_of_a_batch_are_counted_and_scored_within_bounded_memory():
    import pyarrow as pa

    from chatsift.operators import lang

    def batch(rows):
        texts = pa.array([" " + "abcdefghij klmnop " * 60] * rows)
        return pa.RecordBatch.from_arrays([pa.array(["en"] * rows), texts], names=["lang", "text"])

    small, large = batch(2_000), batch(16_000)  # 2 and 17 MB of text
    counted = []
    count = lambda b: counted.append([x.to_pydict() for x in lang._count_trigrams(iter([b]))])
    few, many = peak_mb(lambda: count(small)), peak_mb(lambda: count(large))
    assert many < 1.2 * few + 2
    assert sum(counted[1][0]["n"]) == 16_000 * len(" " + "abcdefghij klmnop " * 60) - 2 * 16_000 == 8 * sum(counted[0][0]["n"])


@pytest.mark.parametrize("chunk,held,sent", [(1 << 19, 1 << 20, 1 << 16), (40, 30, 7), (1, 1, 1)])
def test_trigram_counts_do_not_depend_on_the_cuts(monkeypatch, chunk, held, sent):
    from collections import Counter

    import pyarrow as pa

    from chatsift.operators import lang

    for name, value in (("CHUNK", chunk), ("HELD", held), ("SENT", sent)):
        monkeypatch.setattr(lang, name, value)
    draw = np.random.default_rng(3)
    texts = ["".join(draw.choice(["x", "é", "\U0001F600", " "], size)) for size in (3, 4, 5, 41, 42, 43, 200) for _ in range(9)]
    langs = [(None, "a", "b")[i % 3] for i in range(len(texts))]
    want = Counter((c, t[i:i + 3]) for c, t in zip(langs, texts) for i in range(len(t) - 2))
    got = Counter()
    rows = pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(texts)], names=["lang", "text"])
    for b in lang._count_trigrams(iter([rows.slice(0, 20), rows.slice(20)])):
        for c, g, n in zip(*(b.column(x).to_pylist() for x in ("lang", "gram", "n"))):
            got[c, g] += n
    assert got == want
