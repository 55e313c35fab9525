"""Quality classifier: a factorisation machine over hashed words and structure statistics.

score(x) = sigmoid(b + w.x + 1/2 sum_f [(sum_i V_if x_i)^2 - sum_i V_if^2 x_i^2])

The bracket is the sum-of-squares identity: all pairwise interactions in time
linear in the features of a row.  Features are hashed words (log-damped counts,
scaled to unit length) and statistics of the text's structure, with its length
as the only metadata; ids, source, language and labels are never features.

Training takes a bounded sample of the labelled rows (``max_labels``, the
smallest hashes of their ids, and ``max_features`` in all), gathers their features, not their texts, and
runs Adagrad on the driver; model size is set by ``BUCKETS`` and ``RANK`` alone.
Scoring is one pass over all rows; the model travels as one broadcast of fixed
size.  Null and empty texts get the score of a text without words.
"""

from __future__ import annotations

import zlib
from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chatsift.llm.common import arrow_map, batches, split_words, staged, trim_memory

BUCKETS = 1 << 14
RANK = 8
MAX_LABELS = 8_000
#: Features of all training rows together: 128 MB as they reach the driver.
MAX_FEATURES = 1 << 24
EPOCHS = 12
STATS = 16
WIDTH = BUCKETS + STATS
MEMO_WORDS = 200_000
_BULLETS = ("-", "*", "•")


def structure(text: str, words: list[bytes]) -> np.ndarray:
    """Statistics of one whole text, each about 0 to 1."""
    n, chars = len(words), len(text)
    lines = [x for x in text.split("\n") if x.strip()]
    distinct = len(set(words))
    letters = sum(map(len, words))
    symbols = sum(text.count(c) for c in "#*$%&|<>{}[]=~^_\\@+")
    upper = sum(map(bytes.isupper, words))
    digits = sum(text.count(c) for c in "0123456789")
    marks = text.count("!") + text.count("?")
    stops = text.count(".")
    return np.array([
        min(1.0, np.log1p(n) / 10), min(1.0, letters / max(1, n) / 20), distinct / max(1, n),
        min(1.0, symbols / max(1, n)), upper / max(1, n), min(1.0, 10 * digits / max(1, chars)),
        min(1.0, marks / max(1, n)), min(1.0, 5 * stops / max(1, n)), len(set(lines)) / max(1, len(lines)),
        min(1.0, 20 * len(lines) / max(1, n)), min(1.0, text.count(",") * 5 / max(1, n)),
        sum(x.lstrip().startswith(_BULLETS) for x in lines) / max(1, len(lines)),
        sum(x.rstrip().endswith((".", "!", "?")) for x in lines) / max(1, len(lines)),
        min(1.0, max(map(len, words), default=0) / 50), float(n == 0), float(n < 20)], np.float64)


class Features:
    """Sparse feature rows; hashed words are remembered, as few words make most of a text."""

    def __init__(self) -> None:
        self.memo: dict[bytes, int] = {}

    def rows(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row starts, feature numbers, values) of a batch of whole texts."""
        memo = self.memo
        if len(memo) > MEMO_WORDS:
            memo.clear()
        starts, index, value = [0], [], []
        for text in texts:
            text = text or ""
            words = split_words(text)
            stats = structure(text, words)
            for w in words:
                if w not in memo:
                    memo[w] = zlib.crc32(w) % BUCKETS
            if words:
                ids, counts = np.unique(np.fromiter((memo[w] for w in words), np.int64, len(words)), return_counts=True)
                weight = np.log1p(counts)
                weight /= np.sqrt((weight * weight).sum())
                index.append(ids)
                value.append(weight)
            index.append(np.arange(BUCKETS, WIDTH))
            value.append(stats)
            starts.append(starts[-1] + (len(ids) if words else 0) + STATS)
        return np.array(starts), np.concatenate(index), np.concatenate(value)


class FactorisationMachine:
    """Weights of the machine; a few MB at most, by ``WIDTH`` and ``RANK``."""

    def __init__(self, seed: int = 0):
        rng = np.random.default_rng(seed)
        self.bias, self.linear = 0.0, np.zeros(WIDTH)
        self.pairs = rng.normal(0, 0.01, (WIDTH, RANK))

    def margin(self, starts: np.ndarray, index: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = starts[:-1]
        vx = self.pairs[index] * value[:, None]
        total = np.add.reduceat(vx, at)
        squares = np.add.reduceat((vx * vx).sum(1), at)
        return (self.bias + np.add.reduceat(self.linear[index] * value, at)
                + 0.5 * ((total * total).sum(1) - squares)), total

    def score(self, starts, index, value) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margin(starts, index, value)[0], -30, 30)))

    def fit(self, rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, seed: int = 0, epochs: int = EPOCHS,
            rate: float = 0.1, decay: float = 1e-5, batch: int = 64) -> "FactorisationMachine":
        """Adagrad on the log loss; both classes weigh the same."""
        positives = labels.sum()
        if not len(labels):
            return self
        weight = np.where(labels == 1, 0.5 / max(1, positives), 0.5 / max(1, len(labels) - positives)) * len(labels)
        if positives in (0, len(labels)):
            self.bias = 3.0 if positives else -3.0
            return self
        rng = np.random.default_rng(seed)
        g_linear, g_pairs, g_bias = np.full(WIDTH, 1e-6), np.full((WIDTH, RANK), 1e-6), 1e-6
        for _ in range(epochs):
            order = rng.permutation(len(rows))
            for lo in range(0, len(order), batch):
                take = order[lo:lo + batch]
                starts = np.concatenate(([0], np.cumsum([len(rows[i][0]) for i in take])))
                index = np.concatenate([rows[i][0] for i in take])
                value = np.concatenate([rows[i][1] for i in take])
                margin, total = self.margin(starts, index, value)
                error = (1 / (1 + np.exp(-np.clip(margin, -30, 30))) - labels[take]) * weight[take] / len(take)
                each = np.repeat(np.arange(len(take)), np.diff(starts))
                step = error[each] * value
                # d score / d V_if = x_i (sum_j V_jf x_j - V_if x_i)
                step_pairs = step[:, None] * (total[each] - self.pairs[index] * value[:, None])
                touched, where = np.unique(index, return_inverse=True)
                d_linear = np.bincount(where, step, len(touched)) + decay * self.linear[touched]
                d_pairs = np.stack([np.bincount(where, step_pairs[:, f], len(touched)) for f in range(RANK)], 1)
                d_pairs += decay * self.pairs[touched]
                g_linear[touched] += d_linear ** 2
                g_pairs[touched] += d_pairs ** 2
                g_bias += error.sum() ** 2
                self.linear[touched] -= rate * d_linear / np.sqrt(g_linear[touched])
                self.pairs[touched] -= 0.3 * rate * d_pairs / np.sqrt(g_pairs[touched])
                self.bias -= rate * error.sum() / np.sqrt(g_bias)
        return self


def _featurise(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    features = Features()
    for batch in batches(rows, 256, "text", 1 << 20):
        starts, index, value = features.rows(batch.column("text").to_pylist())
        offsets = pa.array(starts, pa.int32())
        yield pa.RecordBatch.from_arrays([
            batch.column("doc_id"), batch.column("label"),
            pa.ListArray.from_arrays(offsets, pa.array(index.astype(np.int32))),
            pa.ListArray.from_arrays(offsets, pa.array(value.astype(np.float32)))],
            names=["doc_id", "label", "index", "value"])


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "quality", max_labels: int = MAX_LABELS, seed: int = 0,
          max_features: int = MAX_FEATURES) -> FactorisationMachine:
    """The machine for rows of ``labels`` (id, 0/1 label); at most ``max_labels`` of them, by the hash of their ids.

    Repeated labels of an id count once (the smallest), and so do repeated documents
    (the text with the smallest hash); rows without an id or a label are left out.
    In the order of those hashes, rows are taken while their features number
    ``max_features`` at most: this bounds the driver's memory however long texts are.
    """
    chosen = (labels.select(F.col(id_col).cast("long").alias("l_id"), F.col(label_col).cast("int").alias("label"))
              .dropna().groupBy("l_id").agg(F.min("label").alias("label"))
              .orderBy(F.xxhash64("l_id"), "l_id").limit(max_labels))
    # At most max_labels rows of 12 bytes: a proven bound for the broadcast.
    found = (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
             .join(F.broadcast(chosen), F.col("doc_id") == F.col("l_id")))
    # Repeated rows of an id collapse inside the scan's tasks before the shuffle.
    texts = found.groupBy("doc_id", "label").agg(F.min_by("text", F.xxhash64("text")).alias("text")).select("doc_id", "text", "label")
    rows = staged(arrow_map(texts, _featurise, "doc_id long, label int, index array<int>, value array<float>"), "labelled")
    order = F.struct(F.xxhash64("doc_id").alias("h"), "doc_id")
    sizes = sorted(rows.select(order.alias("o"), F.size("index").alias("n")).collect())  # max_labels rows of three numbers
    within = int((np.cumsum([r["n"] for r in sizes]) <= max_features).sum())
    if within < len(sizes):
        h, i = sizes[max(within - 1, 0)]["o"]
        rows = rows.where(order <= F.struct(F.lit(h).cast("long").alias("h"), F.lit(i).cast("long").alias("doc_id")))
    table = rows.toArrow().sort_by("doc_id")
    index, value = (table.column(c).combine_chunks() for c in ("index", "value"))
    starts = index.offsets.to_numpy()
    flat_index, flat_value = index.values.to_numpy(), value.values.to_numpy()
    examples = [(flat_index[a:b].astype(np.int64), flat_value[a:b].astype(np.float64)) for a, b in zip(starts, starts[1:])]
    machine = FactorisationMachine(seed).fit(examples, table.column("label").to_numpy().astype(np.float64), seed)
    del table, index, value, starts, flat_index, flat_value, examples
    trim_memory()  # the driver has later stages to run
    return machine


def score(docs: DataFrame, model: FactorisationMachine, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and score (0 to 1) of every row."""
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return arrow_map(src, _scorer(docs, model, ["doc_id"]), "doc_id long, score double")


def keep_good(docs: DataFrame, model: FactorisationMachine, text_col: str = "text", least: float = 0.5) -> DataFrame:
    """The rows of ``docs``, all columns, whose score is ``least`` or more."""
    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features, machine = Features(), shared.value
        for batch in batches(rows, 256, text_col, 1 << 20):
            yield batch.filter(pa.array(machine.score(*features.rows(batch.column(text_col).to_pylist())) >= least))

    shared = docs.sparkSession.sparkContext.broadcast(model)
    return arrow_map(docs, run, docs.schema)


def _scorer(docs: DataFrame, model: FactorisationMachine, keep: list[str]):
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features, machine = Features(), shared.value
        for batch in batches(rows, 256, "text", 1 << 20):
            scores = machine.score(*features.rows(batch.column("text").to_pylist()))
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in keep] + [pa.array(scores)],
                                             names=[*keep, "score"])
    return run
