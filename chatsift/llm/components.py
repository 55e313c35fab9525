"""Connected components: tasks contract the edges they hold, joins shorten the paths between tasks.

Edges stay in tables; every round is written to the shared checkpoint folder.
A task replaces the edges it reads, ``CHUNK`` at a time, by stars with the same
components, so that a node is the larger end of one edge a chunk at most.  Dealt
by their larger ends, edges then meet without any crowded key.  A node with very
many smaller ends to it is a key of a join only, which AQE splits.
"""

from __future__ import annotations

from typing import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chatsift.llm.common import arrow_map, staged

CHUNK = 1 << 19  # edges that a task holds
TASK_ROWS = 1 << 16  # a round on fewer edges than this for each partition of a shuffle takes fewer tasks


def stars(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The nodes that are not the least of their component, that least node, and whether the node is one of ``a``."""
    ids, at = np.unique(np.concatenate((a, b)), return_inverse=True)
    x, y = at[:len(a)], at[len(a):]
    is_a = np.zeros(len(ids), bool)
    is_a[x] = True
    top = np.arange(len(ids))
    while len(x):
        np.minimum.at(top, np.maximum(x, y), np.minimum(x, y))
        while not np.array_equal(top, up := top[top]):
            top = up
        x, y = top[x], top[y]
        open_ = x != y
        x, y = x[open_], y[open_]
    below = np.flatnonzero(top != np.arange(len(ids)))
    return ids[below], ids[top[below]], is_a[below]


def _contracted(sorted_by_a: bool):
    """Stars of the edges of each chunk.  Sorted by ``a``, all edges of one ``a`` are in one chunk."""
    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a = b = np.zeros(0, np.int64)
        held, n = [], 0

        def taken():
            return (np.concatenate([a, *(x for x, _ in held)]), np.concatenate([b, *(y for _, y in held)]))

        def sent(a, b):
            return pa.RecordBatch.from_arrays([pa.array(x) for x in stars(a, b)], names=["a", "b", "own"])

        for batch in rows:
            held.append((batch.column("a").to_numpy(), batch.column("b").to_numpy()))
            n += batch.num_rows
            if n < CHUNK:
                continue
            a, b = taken()
            cut = int(np.searchsorted(a, a[-1])) if sorted_by_a else len(a)
            if cut:
                yield sent(a[:cut], b[:cut])
            a, b, held, n = a[cut:], b[cut:], [], 0
        a, b = taken()
        yield sent(a, b)
    return run


_STARS = "a long, b long, own boolean"


def _lifted(edges: DataFrame) -> DataFrame:
    """Edges (a, b) that lead to what ``b`` has been linked with by the task that has all edges of ``b``, if any."""
    up = edges.where("own").select(F.col("a").alias("b"), F.col("b").alias("up"))  # one row a node
    return edges.join(up, "b", "left").select("a", F.coalesce("up", "b").alias("b"), F.col("up").isNotNull().alias("moved"))


def connected_components(edges: DataFrame, links: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]] | None = None) -> DataFrame:
    """(node, root) of every node of the edges (a long, b long); root is the least node of the component.

    With ``links``, an Arrow function that makes the edges (without nulls) of the rows of ``edges``: one Python worker
    makes and contracts them.
    """
    first = _contracted(False)
    edges = staged(arrow_map(edges, lambda rows: first(links(rows)), _STARS) if links
                   else arrow_map(edges.where("a <> b").select("a", "b"), first, _STARS), "edges")
    tasks = max(edges.sparkSession.sparkContext.defaultParallelism, -(-edges.count() // TASK_ROWS))

    def met(df):
        """``own``: the row of a node from the task that had all edges to smaller nodes; others link such nodes."""
        dealt = df.select("a", "b").repartition("a").coalesce(tasks).sortWithinPartitions("a")
        return staged(arrow_map(dealt, _contracted(True), _STARS), "edges")

    edges = met(edges)
    while edges.where("NOT own").head(1):
        edges = met(_lifted(edges))
    moved = True
    while moved:  # a forest: one edge up from each node
        edges = staged(_lifted(edges).withColumn("own", F.lit(True)).coalesce(tasks), "edges")
        moved = bool(edges.where("moved").head(1))
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        edges.select(F.col("b").alias("node")).distinct().coalesce(tasks).withColumn("root", F.col("node")))
