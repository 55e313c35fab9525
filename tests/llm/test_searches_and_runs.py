"""Hard negatives, periodic runs and SimHash classes against brute force, odd rows and empty tables included."""

import hashlib
import math
import random
import sys
import zlib
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, __file__.rsplit("/tests/", 1)[0])

from chatsift.llm import hard_negatives, periodic_runs, simhash  # noqa: E402
from chatsift.llm.components import connected_components  # noqa: E402
from chatsift.llm.queries import QUERIES, repeat_words  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def spark():
    from chatsift.session import local_session

    s = local_session("*", 8)
    s.sparkContext.setLogLevel("ERROR")
    return s


# ---------------------------------------------------------- hard negatives ---

def _brute_negatives(rows, k_pos=5, k_neg=10):
    """rows: (id, label, integer vector) that take part; (anchor, positive, rank, negative, two scores) sorted."""
    out = []
    dot = lambda a, b: sum(x * y for x, y in zip(a, b))
    for own, label, vec in rows:
        if own % 100:
            continue
        scored = sorted((-dot(vec, v), i, lab) for i, lab, v in rows if i != own)
        for minus, positive, _ in [s for s in scored if s[2] == label][:k_pos]:
            p = -minus
            fit = [(i, -m) for m, i, lab in scored if lab != label and 30 * p <= -100 * m <= 90 * p]
            out += [(own, positive, r, i, p, s) for r, (i, s) in enumerate(fit[:k_neg], 1)]
    return sorted(out)


def _mined(spark, rows, strip, block, schema="vec_id long, label int, embedding array<double>"):
    df = spark.createDataFrame(rows, schema)
    vectors = hard_negatives.integer_vectors(df, "vec_id", F.col("label"), hard_negatives.floor_components("embedding"),
                                             F.col("vec_id") % 100 == 0)
    return sorted(map(tuple, hard_negatives.mine_hard_negatives(vectors, strip=strip, block=block).collect()))


@pytest.mark.parametrize("strip, block, scale", [(1 << 22, 16_384, 1.0), (700, 3, 1.0), (700, 3, 1e5)])
def test_hard_negatives_equal_brute_force(spark, monkeypatch, strip, block, scale):
    monkeypatch.setattr(hard_negatives, "BUCKET", 64)
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(12, 6)) * scale
    rows = []
    for i in range(1500):  # clusters, very different lengths, a vector that a third of the rows hold
        v = centres[0] if i % 3 == 0 else (centres[rng.integers(12)] + rng.normal(size=6) * scale / 10) * rng.choice([0.01, 1, 5])
        rows.append((i, int(rng.integers(3)), [float(x) for x in v]))
    rows += [(100, 1, [0.0] * 6), (2000, 2, [0.0] * 6), (2001, 0, [scale, scale]), (2100, 0, [-scale])]
    whole = [(i, lab, [math.floor(256 * x) for x in v] + [0] * (6 - len(v))) for i, lab, v in rows]
    # BUCKET is read by the workers from their own module: results must not depend on it.
    assert _mined(spark, rows, strip, block) == _brute_negatives(whole)


def test_buckets_prune_without_losing_rows():
    rng = np.random.default_rng(2)
    vecs = np.floor(256 * (rng.normal(size=(40, 8))[rng.integers(40, size=900)] + rng.normal(size=(900, 8)) / 20)).astype(np.int64)
    norms = np.sqrt((vecs.astype(float) ** 2).sum(axis=1))
    order = np.argsort(-norms)
    pruned = 0
    for at in range(0, 900, 128):
        some = order[at:at + 128]
        bucket = hard_negatives.Bucket(some, some % 3, vecs[some], norms[some])
        for a in range(0, 900, 45):
            scores = vecs[some] @ vecs[a]
            unit = vecs[a] / norms[a]
            focus = np.argsort(-np.abs(unit))[:hard_negatives.FOCUS]
            for least in (int(scores.max()), int(np.median(scores)), int(norms[a] ** 2), 1, -5):
                rows = bucket.feasible(unit, norms[a], float(least), focus)
                want = set(np.flatnonzero(scores >= least))
                if rows is not None:
                    assert want <= set(rows.tolist())
                    pruned += len(rows) < len(some) / 4
    assert pruned > 100


def test_hard_negatives_of_odd_rows(spark):
    rows = [(None, 1, [1.0]), (0, None, [1.0]), (0, 1, None), (0, 1, [float("nan")]), (0, 1, [None]), (0, 1, [float("inf")])]
    assert _mined(spark, rows, 10, 10) == []
    assert _mined(spark, [], 10, 10) == []
    # ties go to the smaller id, rows of one id are no partners, only the negative's score may lie on the bounds
    rows += [(100, 1, [1.0]), (100, 1, [1.0]), (5, 1, [1.0]), (4, 1, [1.0]), (9, 2, [0.9]), (8, 2, [0.9]), (7, 2, [0.3]), (6, 2, [0.91])]
    whole = [(i, lab, [math.floor(256 * v[0])]) for i, lab, v in rows[6:]]
    got = _mined(spark, rows, 10, 10)
    assert got == _brute_negatives(whole) and {r[3] for r in got} == {8, 9}


# ----------------------------------------------------------- periodic runs ---

def _brute_runs(words, min_length=6, min_exponent=4):
    n = len(words)
    out = []
    for q in range(1, n // min_exponent + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j - i + q
            if j > i and length >= max(min_length, min_exponent * q):
                if not any(words[i:i + length - r] == words[i + r:i + length] for r in range(1, q)):
                    out.append((i, length, q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def _repetitive(rng):
    n = rng.randint(0, 70)
    words = [b"%d" % rng.randrange(rng.choice([1, 2, 3, 9])) for _ in range(n)]
    if n and rng.random() < 0.7:
        a = rng.randrange(n)
        q = rng.randint(1, max(1, (n - a) // 4))
        words[a:] = [words[a + i % q] for i in range(n - a)]
        for _ in range(rng.randint(0, 2)):
            words.insert(rng.randrange(len(words) + 1), b"x")
    return words


def test_runs_equal_brute_force():
    rng = random.Random(3)
    for _ in range(2500):
        words = _repetitive(rng)
        assert periodic_runs.find_runs(words) == _brute_runs(words), words
        assert periodic_runs.find_runs(words, 2, 2) == _brute_runs(words, 2, 2), words


def test_stretches_hold_every_run():
    rng = random.Random(4)
    for _ in range(300):
        words = [b"%d" % rng.randrange(200) for _ in range(rng.randint(0, 400))]
        for _ in range(rng.randint(0, 3)):
            at, q = rng.randrange(len(words) + 1), rng.randint(1, 40)
            part = [b"%d" % rng.randrange(200) for _ in range(q)]
            words[at:at] = (part * 9)[:rng.randint(1, 9 * q)]
        number = {w: i for i, w in enumerate(dict.fromkeys(words))}
        spans = periodic_runs.candidate_spans(np.array([number[w] for w in words], dtype=np.int64))
        for start, length, _ in _brute_runs(words):
            assert any(a <= start and start + length <= b for a, b in spans)
        assert sum(b - a for a, b in spans) < len(words) or not spans or len(words) < 400 or spans == [(0, len(words))]


def test_a_long_text_of_one_word_and_a_long_period():
    assert periodic_runs.find_runs([b"a"] * 30_000) == [(0, 30_000, 1)]
    period = [b"%d" % i for i in range(2_000)]
    assert periodic_runs.find_runs([b"x"] + period * 5 + period[:7] + [b"y"]) == [(1, 10_007, 2_000)]


def _digest_row(doc_id, text):
    words = (text or "").encode().split()
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    n = len(words)
    if n and h % 10 == 0:
        a = (h // 10) % n
        p = 1 + (n - a) // (3 + (h // 10) % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = _brute_runs(words)
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    sha = lambda s: hashlib.sha256(s).hexdigest()
    return (doc_id, len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None,
            sha("".join(f"{s},{length},{q}\n" for s, length, q in runs).encode()),
            sha(b" ".join(w for i, w in enumerate(words) if i not in gone)))


def test_run_query_equals_brute_force(spark):
    got = sorted(map(tuple, QUERIES["op12_periodic_runs"](spark, SMALL).collect()))
    docs = spark.read.parquet(SMALL + "/documents.parquet").select("doc_id", "text").collect()
    assert got == sorted(_digest_row(d, t) for d, t in docs if len((t or "").split()) < 5000)
    assert sum(r[1] > 0 for r in got) > 5


def test_runs_of_odd_rows(spark):
    rows = [(1, None, 1), (2, "", 2), (None, "a b " * 5, None), (3, "a\x0b" * 40_000, 3), (4, "x é é é é é é", 4), (4, "x é é é é é é", 4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, runs int")
    got = [tuple(r) for r in periodic_runs.run_digests(periodic_runs.periodic_runs(docs)).collect()]
    want = []
    for doc_id, text, _ in rows:
        full = _digest_row(None, text) if doc_id != 3 else None
        want.append((doc_id, 1, 0, 40_000, 1, 40_000_000, hashlib.sha256(b"0,40000,1\n").hexdigest(), hashlib.sha256(b"a").hexdigest())
                    if full is None else (doc_id, *full[1:]))
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert periodic_runs.periodic_runs(docs.where("false")).count() == 0
    assert repeat_words(None, [b"a"]) == [b"a"] and repeat_words(5, []) == []


# ----------------------------------------------------------------- simhash ---

def _brute_print(text):
    import xxhash

    words = (text or "").translate(simhash._UPPER).encode().split()
    shingles = [b" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def _brute_classes(prints):
    """Least index of the class of each fingerprint."""
    root = list(range(len(prints)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    every = np.array(prints, dtype=np.uint64)
    for i in range(len(prints)):
        for j in np.flatnonzero(np.bitwise_count(every ^ every[i]) <= 2):
            a, b = find(i), find(int(j))
            root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(prints))]


def test_simhash_classes_equal_brute_force(spark):
    got = {r[0]: (r[1], r[2]) for r in QUERIES["op13_simhash"](spark, SMALL).collect()}
    docs = sorted(tuple(r) for r in spark.read.parquet(SMALL + "/documents.parquet").select("doc_id", "text").collect())
    prints = [_brute_print(t) for _, t in docs]
    least = _brute_classes(prints)
    assert got == {d: (f"{p:016x}", docs[k][0]) for (d, _), p, k in zip(docs, prints, least)}


@pytest.mark.parametrize("hot", [3, 64, 1024])
def test_links_of_dense_balls_equal_brute_force(spark, hot):
    """Many fingerprints that share segments, some of them more than one task's worth under ``hot``."""
    rng = np.random.default_rng(hot)
    found = set()
    for base in rng.integers(0, 2 ** 63, 3):
        for _ in range(500):
            v = int(base)
            for p in rng.integers(0, 64, rng.integers(0, 6)):
                v ^= 1 << int(p)
            found.add(v)
    prints = np.sort(np.array(sorted(found), dtype=np.uint64).view(np.int64))
    links = simhash.close_links(spark.createDataFrame([(int(p),) for p in prints], "fp long"), hot)
    nodes = {r["node"]: r["root"] for r in connected_components(links).collect()}
    least = _brute_classes(prints.view(np.uint64).tolist())
    assert [nodes.get(int(p), int(p)) for p in prints] == [int(prints[k]) for k in least]


def test_close_pairs_by_lookup_and_by_comparison():
    rng = np.random.default_rng(1)
    free = np.uint64(0b1011_0000_0111_0101)
    for m, bits in ((40, 64), (3000, 16)):
        values = rng.integers(0, 2 ** 63, m, dtype=np.uint64) if bits == 64 else rng.integers(0, 2 ** 16, m, dtype=np.uint64) & free
        values = np.unique(np.concatenate([values, values[:m // 2] ^ np.uint64(5)]))
        i, j = simhash._close_pairs(values)
        a, b = np.nonzero(np.bitwise_count(values[:, None] ^ values[None, :]) <= 2)
        assert set(zip(i.tolist(), j.tolist())) == {(x, y) for x, y in zip(a.tolist(), b.tolist()) if x < y}


def test_simhash_of_odd_rows(spark):
    rows = [(7, None, 1), (3, "", 1), (None, " \n", 1), (5, "One two", 2), (6, "one  TWO", 2), (None, "only null ids here", 3),
            (9, "long " * 50_000, 4), (9, "long " * 50_000, 4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fp int")
    got = sorted((tuple(r) for r in simhash.simhash_components(docs).collect()), key=repr)
    zero = "0" * 16
    two, null, long = (f"{_brute_print(t):016x}" for t in ("one two", "only null ids here", "long long long"))
    assert got == sorted([(7, zero, 3), (3, zero, 3), (None, zero, 3), (5, two, 5), (6, two, 5), (None, null, None),
                          (9, long, 9), (9, long, 9)], key=repr)
    assert simhash.simhash_components(docs.where("false")).count() == 0
