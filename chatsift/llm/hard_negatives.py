"""Hard negatives by maximum inner product search with length buckets and coordinate pruning (after LEMP).

Rows carry integer vectors.  A search asks, for each anchor, for the best ``k``
rows under score windows [low, high]; the score is the integer inner product,
ties go to the smaller id.

* Rows are dealt over strips by a hash, so every strip holds all lengths.  One
  task takes a block of anchors and streams a strip past it, longest rows first,
  in length buckets of ``BUCKET`` rows.
* A bucket keeps, for each coordinate, its unit vectors sorted by that coordinate.
* An anchor needs at least the score t = its k-th best so far (the low end of
  its window before that).  In a bucket of greatest length l the cosine must reach
  t / (|anchor| l): over 1, the bucket is skipped.  Otherwise each of the anchor's
  ``FOCUS`` largest coordinates has a feasible range of values, two binary searches
  in its list; the shortest range is intersected with the others.
* What remains is verified by its exact integer score.  Bounds are widened by
  more than the rounding of doubles, so nothing is lost.  Vectors without
  direction (high dimension, random) leave wide ranges; then all is verified.

The results of the strips are merged by a window over at most k rows a strip.

Nulls and edge cases: rows with a null id, label or vector, or with a null or
non-finite component take no part; shorter vectors count as padded with zeros;
rows that share an id are rows of their own but never each other's positives or
negatives; scores must fit in a long; further columns are ignored; an empty
table, or none with an anchor, gives an empty table.
"""

from __future__ import annotations

from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chatsift.llm.common import arrow_map, staged

#: Rows of a length bucket.
BUCKET = 2048
#: Coordinates of an anchor whose ranges are intersected.
FOCUS = 4
#: Anchors that one task holds, for vectors of up to 128 components; longer vectors hold as many fewer.
ANCHORS = 16_384
#: Rows of a strip at most; fewer where the cluster has idle cores.
STRIP = 1 << 22
_EXACT = 2.0 ** 53
_EPS = 1e-9
_LOWEST, _HIGHEST = -(1 << 63), (1 << 63) - 1


def integer_vectors(rows: DataFrame, id_col: str, label: Column, vector: Column, is_anchor: Column) -> DataFrame:
    """(id, label, vec array<long>, norm, anchor, key) of the rows that take part, staged.

    ``vector`` is an array of integers or of nulls; ``key`` tells rows of one id apart.
    """
    out = rows.select(F.col(id_col).cast("long").alias("id"), label.cast("long").alias("label"),
                      vector.cast("array<long>").alias("vec"), F.coalesce(is_anchor, F.lit(False)).alias("anchor"))
    out = out.where(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("vec").isNotNull()
                    & ~F.exists("vec", lambda x: x.isNull()))
    length = F.sqrt(F.aggregate("vec", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))
    return staged(out.withColumns({"norm": length, "key": F.monotonically_increasing_id()}), "vectors")


def floor_components(col: str, factor: int = 256) -> Column:
    """Each component x as floor(factor * x); a non-finite component becomes null."""
    def whole(x):
        d = x.cast("double")
        finite = ~F.isnan(d) & (F.abs(d) < float("inf"))
        return F.when(finite, F.floor(F.lit(factor) * d))
    return F.transform(col, whole)


# ------------------------------------------------------------------ buckets ---

def _matrix(col: pa.Array, dim: int) -> np.ndarray:
    """Rows of one Arrow list column as a matrix, padded with zeros."""
    values = col.flatten().to_numpy(zero_copy_only=False)
    sizes = np.diff(col.offsets.to_numpy())
    if (sizes == dim).all():
        return values.reshape(len(sizes), dim)
    out = np.zeros((len(sizes), dim), dtype=np.int64)
    out[np.repeat(np.arange(len(sizes)), sizes), np.arange(len(values)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = values
    return out


class Bucket:
    """Rows of like length with their sorted coordinate lists."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, vecs: np.ndarray, norms: np.ndarray):
        self.ids, self.labels, self.norms = ids, labels, norms
        self.exact, self.real = vecs, vecs.astype(np.float64)
        self.longest = float(norms.max())
        self.unit = self.real / np.where(norms > 0, norms, 1.0)[:, None]
        self._order: dict[int, np.ndarray] = {}
        self._sorted: dict[int, np.ndarray] = {}

    def column(self, f: int) -> tuple[np.ndarray, np.ndarray]:
        """(values ascending, their rows) of coordinate f; a list is sorted when first asked for."""
        if f not in self._order:
            self._order[f] = np.argsort(self.unit[:, f], kind="stable")
            self._sorted[f] = self.unit[self._order[f], f]
        return self._sorted[f], self._order[f]

    def feasible(self, unit: np.ndarray, norm: float, least: float, focus: np.ndarray) -> np.ndarray | None:
        """Rows that may reach the score ``least`` with an anchor; None means all."""
        if least <= 0 or norm == 0:
            return None if norm > 0 or least <= 0 else np.empty(0, dtype=np.int64)
        t = least / (norm * self.longest) * (1 - _EPS) if self.longest > 0 else 2.0
        if t > 1:
            return np.empty(0, dtype=np.int64)
        ranges = []
        for f in focus:
            x = unit[f]
            half = np.sqrt(max(0.0, 1 - x * x) * (1 - t * t)) + _EPS
            low = x * t - half if x >= -t else -1 - _EPS
            high = x * t + half if x <= t else 1 + _EPS
            values, _ = self.column(int(f))
            a, b = np.searchsorted(values, low, "left"), np.searchsorted(values, high, "right")
            if b - a < len(values):
                ranges.append((b - a, int(f), a, b, low, high))
        if not ranges:
            return None
        ranges.sort()
        _, f, a, b, _, _ = ranges[0]
        rows = self.column(f)[1][a:b]
        for _, f, _, _, low, high in ranges[1:]:
            values = self.unit[rows, f]
            rows = rows[(values >= low) & (values <= high)]
        return rows

    def scores(self, vec: np.ndarray, norm: float, rows: np.ndarray | None) -> np.ndarray:
        if norm * self.longest < _EXACT:  # every partial sum of doubles is exact
            return ((self.real if rows is None else self.real[rows]) @ vec.astype(np.float64)).astype(np.int64)
        return (self.exact if rows is None else self.exact[rows]) @ vec


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the first k by falling score, then id."""
    if len(scores) > 4 * k:
        cut = np.partition(scores, len(scores) - k)[len(scores) - k]
        some = np.flatnonzero(scores >= cut)
        return some[np.lexsort((ids[some], -scores[some]))[:k]]
    return np.lexsort((ids, -scores))[:k]


class _Anchor:
    """One anchor with its windows and the best rows of each so far."""

    def __init__(self, key, own, label, vec, norm, windows, same, k):
        self.key, self.id, self.label, self.vec, self.norm, self.same, self.k = key, own, label, vec, norm, same, k
        self.windows = windows
        self.unit = vec / norm if norm > 0 else vec.astype(np.float64)
        self.focus = np.argsort(-np.abs(self.unit), kind="stable")[:FOCUS]
        self.scores = [np.empty(0, dtype=np.int64) for _ in windows]
        self.ids = [np.empty(0, dtype=np.int64) for _ in windows]

    def _least(self, w: int) -> int:
        return max(self.windows[w][0], int(self.scores[w][-1])) if len(self.scores[w]) == self.k else self.windows[w][0]

    def visit(self, bucket: Bucket) -> None:
        least = [self._least(w) for w in range(len(self.windows))]
        low = min(least)
        rows = bucket.feasible(self.unit, self.norm, float(low), self.focus)
        if rows is not None and not len(rows):
            return
        scores = bucket.scores(self.vec, self.norm, rows)
        rows = np.arange(len(scores)) if rows is None else rows
        labels = bucket.labels[rows]
        ok = ((labels == self.label) if self.same else (labels != self.label)) & (bucket.ids[rows] != self.id) & (scores >= low)
        rows, scores = rows[ok], scores[ok]
        for w, (_, high) in enumerate(self.windows):
            inside = (scores >= least[w]) & (scores <= high)
            if inside.any():
                s = np.concatenate([self.scores[w], scores[inside]])
                i = np.concatenate([self.ids[w], bucket.ids[rows[inside]]])
                best = _best(s, i, self.k)
                self.scores[w], self.ids[w] = s[best], i[best]


def _search(dim: int, k: int, same: bool):
    """Streams (cell, kind, ...) rows: the anchors of a cell first, then its rows by falling length."""
    def buckets(cell):
        """Length buckets across batches of one cell."""
        held = []
        count = 0
        for part in cell:
            held.append(part)
            count += part.num_rows
            while count >= BUCKET:
                table = pa.Table.from_batches(held).combine_chunks()
                yield table.slice(0, BUCKET)
                held, count = table.slice(BUCKET).to_batches(), count - BUCKET
        if count:
            yield pa.Table.from_batches(held)

    def opened(table):
        table = table.combine_chunks()
        vec = table.column("vec").chunk(0)
        return [table.column(c).to_numpy() for c in ("id", "label")] + [_matrix(vec, dim), table.column("norm").to_numpy()]

    def finish(anchors):
        out = [(a.key, w, int(i), int(s)) for a in anchors for w in range(len(a.windows)) for i, s in zip(a.ids[w], a.scores[w])]
        key, window, other, score = zip(*out) if out else ((), (), (), ())
        return pa.RecordBatch.from_arrays([pa.array(key, pa.int64()), pa.array(window, pa.int32()), pa.array(other, pa.int64()),
                                           pa.array(score, pa.int64())], names=["key", "window", "other", "score"])

    def run(batches: Iterator[pa.RecordBatch]):
        current, anchors, pending = None, [], []

        def drain(everything: bool):
            nonlocal pending
            total = sum(p.num_rows for p in pending)
            if not total or (not everything and total < BUCKET):
                return
            left = []
            for table in buckets(pending):
                if table.num_rows < BUCKET and not everything:
                    left = table.to_batches()
                    continue
                if anchors:
                    bucket = Bucket(*opened(table))
                    for a in anchors:
                        a.visit(bucket)
            pending = left

        for batch in batches:
            cells = batch.column("cell").to_numpy()
            kinds = batch.column("kind").to_numpy()
            edges = np.flatnonzero((cells[1:] != cells[:-1]) | (kinds[1:] != kinds[:-1])) + 1
            for a, b in zip([0, *edges], [*edges, len(cells)]):
                if a == b:
                    continue
                part = batch.slice(a, b - a)
                if cells[a] != current:
                    drain(True)
                    if anchors:
                        yield finish(anchors)
                    current, anchors = cells[a], []
                if kinds[a] == 0:
                    vecs = _matrix(part.column("vec"), dim)
                    windows = part.column("windows").to_pylist()
                    cols = [part.column(c).to_pylist() for c in ("key", "id", "label", "norm")]
                    anchors.extend(_Anchor(key, own, label, vec.copy(), norm, [(w["low"], w["high"]) for w in ws], same, k)
                                   for key, own, label, norm, vec, ws in zip(*cols, vecs, windows))
                else:
                    pending.append(part)
                    drain(False)
        drain(True)
        if anchors:
            yield finish(anchors)

    return run


def search(rows: DataFrame, anchors: DataFrame, k: int, same: bool, dim: int, n_rows: int, n_anchors: int,
           strip: int = STRIP, block: int = ANCHORS) -> DataFrame:
    """(key, window, other, score, rank) of each anchor: the first ``k`` rows in each of its windows.

    ``anchors`` are rows with ``windows`` array<struct<low: long, high: long>>;
    rows must have the anchor's label (``same``) or another one.  ``strip`` and
    ``block`` shape the tasks only.
    """
    block = max(1, min(block, block * 128 // max(dim, 1)))
    groups = -(-n_anchors // block)
    idle = -(-2 * rows.sparkSession.sparkContext.defaultParallelism // groups)
    strips = max(-(-n_rows // strip), min(idle, -(-n_rows // BUCKET)), 1)
    cols = ["id", "label", "vec", "norm", "key"]
    mark = lambda df, kind: df.withColumn("kind", F.lit(kind))
    # An anchor meets every strip, a row every group of anchors.
    asked = mark(anchors.select(*cols, "windows", F.pmod(F.xxhash64("key"), F.lit(groups)).cast("int").alias("g"),
                                F.explode(F.sequence(F.lit(0), F.lit(strips - 1))).alias("s")), 0)
    held = mark(rows.select(*cols, F.lit(None).cast("array<struct<low: long, high: long>>").alias("windows"),
                            F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("g"),
                            F.pmod(F.xxhash64("key"), F.lit(strips)).cast("int").alias("s")), 1)
    cells = asked.unionByName(held).withColumn("cell", F.col("g").cast("long") * strips + F.col("s")).drop("g", "s")
    dealt = cells.repartition(min(groups * strips, 100_000), "cell").sortWithinPartitions("cell", "kind", F.desc("norm"), "id", "key")
    found = arrow_map(dealt, _search(dim, k, same), "key long, window int, other long, score long")
    order = Window.partitionBy("key", "window").orderBy(F.desc("score"), "other")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def mine_hard_negatives(vectors: DataFrame, n_positives: int = 5, n_negatives: int = 10, low_percent: int = 30,
                        high_percent: int = 90, strip: int = STRIP, block: int = ANCHORS) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    ``vectors`` as :func:`integer_vectors` gives them.  The positives of an
    anchor are its best rows of its own label; for each, the negatives are the
    best rows of other labels that score within ``low_percent`` to ``high_percent``
    of the positive's score (both inclusive).
    """
    size = vectors.agg(F.count(F.lit(1)), F.sum(F.col("anchor").cast("long")), F.max(F.size("vec"))).first()
    n_rows, n_anchors, dim = (int(x or 0) for x in size)
    spark = vectors.sparkSession
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    if not n_anchors:
        return spark.createDataFrame([], schema)
    anchors = vectors.where("anchor")
    open_window = F.array(F.struct(F.lit(_LOWEST).alias("low"), F.lit(_HIGHEST).alias("high")))
    positives = staged(search(vectors, anchors.withColumn("windows", open_window), n_positives, True, dim, n_rows, n_anchors,
                              strip, block), "positives")
    exact = "cast(floor({0} * cast(score as decimal(38,0)) / 100) as long)"  # of integers: no rounding before the floor
    asked = (positives.withColumns({"low": -F.expr(exact.format(-low_percent)), "high": F.expr(exact.format(high_percent))})
             .where("low <= high").groupBy("key")
             .agg(F.array_sort(F.collect_list(F.struct("rank", "other", "score", "low", "high"))).alias("p")))  # at most n_positives
    asked = staged(anchors.join(asked, "key"), "asked")
    windows = F.transform("p", lambda p: F.struct(p["low"].alias("low"), p["high"].alias("high")))
    found = search(vectors, asked.withColumn("windows", windows), n_negatives, False, dim, n_rows, n_anchors, strip, block)
    named = found.join(asked.select("key", F.col("id").alias("anchor_id"), "p"), "key")
    positive = F.element_at("p", F.col("window") + 1)
    return named.select("anchor_id", positive["other"].alias("positive_id"), F.col("rank").cast("int").alias("rank"),
                        F.col("other").alias("negative_id"), positive["score"].alias("positive_score"),
                        F.col("score").alias("negative_score"))
