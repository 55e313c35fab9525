"""Periodic runs of words, by a suffix automaton with link-cut access.

The suffix links of the automaton of a stretch of words form a tree; the path
from a prefix's state to the root holds all its suffixes.  Words are appended one
after the other: an access (link-cut tree on splay trees) walks the path of the
new prefix in segments that were last coloured by the same earlier prefix j, and
recolours it with i.  A segment of suffixes of lengths lo+1 .. hi says that those
suffixes ended at j last, so with d = i - j:

* lo < d <= hi: the last d words repeat the d words before them, and no shorter
  distance does (a square with a primitive root);
* the period d then reaches back over hi + d words and no further.

The squares of one run thus share (start, d); the last i that yields them is the
run's end.  All maximal runs of exponent two or more come out this way, with
their smallest period; those of ``MIN_LENGTH`` words and ``MIN_EXPONENT`` periods
are kept.

Most words cannot lie in such a run, and those are cut away before: within a run
of period q every 4 words come again at most q words away, over at least
``MIN_EXPONENT`` q - 3 places in a row.  Only stretches where that holds at some
scale (a power of two) reach the automaton, and no run crosses their ends.

Work is row-local: no shuffle; a task holds one text and the automaton of one
stretch.  Nulls and edge cases: a null or empty text has no words and no runs;
null ids, repeated rows and ties of ids pass through row by row; further columns
of the input are ignored.  An empty table gives an empty table.
"""

from __future__ import annotations

from fractions import Fraction
from typing import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chatsift.llm.common import arrow_map, batches, split_words

MIN_LENGTH = 6
MIN_EXPONENT = 4
_GRAM = 4
_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
_SCHEMA = ("id long, n_words long, runs array<struct<start: long, length: long, period: long>>, "
           "best struct<start: long, length: long, period: long>, collapsed string")


# --------------------------------------------------------------- automaton ---

def suffix_links(words: list[int]) -> tuple[list[int], list[int], list[int]]:
    """(longest length, suffix link) of every state and the state of every prefix; the start is state 0."""
    length, link, step = [0], [-1], [{}]
    last = 0
    prefix = []
    for word in words:
        new = len(length)
        length.append(length[last] + 1)
        link.append(0)
        step.append({})
        p = last
        while p >= 0 and word not in step[p]:
            step[p][word] = new
            p = link[p]
        if p >= 0:
            q = step[p][word]
            if length[q] == length[p] + 1:
                link[new] = q
            else:
                copy = len(length)
                length.append(length[p] + 1)
                link.append(link[q])
                step.append(step[q].copy())
                while p >= 0 and step[p].get(word) == q:
                    step[p][word] = copy
                    p = link[p]
                link[q] = link[new] = copy
        last = new
        prefix.append(new)
    return length, link, prefix


class LastOccurrences:
    """The tree of suffix links as a link-cut tree; a preferred path is coloured with the prefix that accessed it last.

    The start state stands for "no node".  The colour of a path is kept at the
    root of its splay tree.
    """

    def __init__(self, link: list[int]):
        n = len(link)
        self.up = [max(p, 0) for p in link]  # parent in the splay tree, or at its root the next path's node
        self.left = [0] * n
        self.right = [0] * n
        self.colour = [-1] * n

    def _rotate(self, x: int) -> None:
        up, left, right = self.up, self.left, self.right
        y = up[x]
        z = up[y]
        if left[y] == x:
            b = left[y] = right[x]
            right[x] = y
        else:
            b = right[y] = left[x]
            left[x] = y
        if b:
            up[b] = y
        up[y] = x
        up[x] = z
        if z:
            if left[z] == y:
                left[z] = x
            elif right[z] == y:
                right[z] = x

    def splay(self, x: int) -> None:
        """x to the root of its splay tree, with the colour of the path."""
        up, left, right = self.up, self.left, self.right
        colour = None
        while True:
            y = up[x]
            if not y or (left[y] != x and right[y] != x):
                break
            z = up[y]
            if z and (left[z] == y or right[z] == y):
                colour = self.colour[z]
                self._rotate(y if (left[z] == y) == (left[y] == x) else x)
            else:
                colour = self.colour[y]
            self._rotate(x)
        if colour is not None:
            self.colour[x] = colour

    def access(self, node: int, now: int) -> list[tuple[int, int]]:
        """(deepest node, colour before) of every segment of the path from node to the start, deepest first; recolours."""
        segments = []
        below, at = 0, node
        while at:
            self.splay(at)
            cut = self.right[at]
            if cut:
                self.colour[cut] = self.colour[at]
            segments.append((at, self.colour[at]))
            self.right[at] = below
            below, at = at, self.up[at]
        self.splay(node)
        self.colour[node] = now
        return segments


def runs_of(words: list[int]) -> list[tuple[int, int, int]]:
    """(start, length, period) of every maximal run of exponent two or more."""
    length, link, prefix = suffix_links(words)
    paths = LastOccurrences(link)
    last: dict[tuple[int, int], int] = {}
    for i, state in enumerate(prefix):
        segments = paths.access(state, i)
        for k, (node, before) in enumerate(segments):
            d = i - before
            hi = length[node]
            if before >= 0 and d <= hi and (k + 1 == len(segments) or length[segments[k + 1][0]] < d):
                last[i - d - hi + 1, d] = i
    return sorted((start, end - start + 1, d) for (start, d), end in last.items())


# ---------------------------------------------------------------- stretches ---

def _true_spans(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edges = np.flatnonzero(np.diff(flags.astype(np.int8), prepend=0, append=0))
    return edges[::2], edges[1::2]


def candidate_spans(ids: np.ndarray, min_length: int = MIN_LENGTH, min_exponent: int = MIN_EXPONENT) -> list[tuple[int, int]]:
    """Disjoint spans [from, to) of words that hold every run that is asked for."""
    n = len(ids)
    if n < max(min_length, min_exponent):
        return []
    if min(min_length, min_exponent) < _GRAM:  # runs may be shorter than the words compared
        return [(0, n)]
    mix = np.uint64(0x9E3779B97F4A7C15)
    h = ids.astype(np.uint64) + np.uint64(1)
    places = n - _GRAM + 1
    gram = np.zeros(places, dtype=np.uint64)  # equal grams have equal numbers; chance equals only widen the spans
    for k in range(_GRAM):
        gram = (gram ^ (gram >> np.uint64(29))) * mix + h[k:k + places]
    order = np.argsort(gram, kind="stable")
    same = gram[order[1:]] == gram[order[:-1]]
    if not same.any():
        return []
    gap = np.where(same, order[1:] - order[:-1], n)
    near = np.full(places, n, dtype=np.int64)  # words to the nearest equal gram
    near[order[1:]] = gap
    near[order[:-1]] = np.minimum(near[order[:-1]], gap)
    cover = np.zeros(n + 1, dtype=np.int64)
    scale = 1
    while min_exponent * (scale // 2 + 1) <= n:  # periods scale/2 < q <= scale
        least = max(min_length, min_exponent * (scale // 2 + 1)) - _GRAM + 1
        starts, stops = _true_spans(near <= scale)
        long = stops - starts >= least
        cover[starts[long]] += 1
        cover[stops[long] + _GRAM - 1] -= 1
        scale *= 2
    starts, stops = _true_spans(np.cumsum(cover[:-1]) > 0)
    return list(zip(starts.tolist(), stops.tolist()))


def find_runs(words: list[bytes], min_length: int = MIN_LENGTH, min_exponent: int = MIN_EXPONENT) -> list[tuple[int, int, int]]:
    """(start, length, period) by start, then period, of the maximal runs of at least ``min_length`` words and
    ``min_exponent`` smallest periods."""
    number = {w: i for i, w in enumerate(dict.fromkeys(words))}
    ids = np.fromiter(map(number.__getitem__, words), dtype=np.int64, count=len(words))
    found = []
    for start, stop in candidate_spans(ids, min_length, min_exponent):
        for at, length, period in runs_of(ids[start:stop].tolist()):
            if length >= max(min_length, min_exponent * period):
                found.append((start + at, length, period))
    return sorted(found, key=lambda r: (r[0], r[2]))


def collapse(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words that no run contains after its first period."""
    if not runs:
        return words
    cover = np.zeros(len(words) + 1, dtype=np.int64)
    for start, length, period in runs:
        cover[start + period] += 1
        cover[start + length] -= 1
    return [words[i] for i in np.flatnonzero(np.cumsum(cover[:-1]) == 0)]


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = MIN_LENGTH,
                  min_exponent: int = MIN_EXPONENT, prepare: Callable[[int | None, list[bytes]], list[bytes]] | None = None) -> DataFrame:
    """(id, n_words, runs, best, collapsed) of every row.

    ``runs`` come by start, then period; ``best`` is the one of the greatest
    length / period (ties: smallest start, then period), null without runs;
    ``collapsed`` is the words that stay, joined by one space.  ``prepare``
    may change the words of a row first.  See the module for the edge cases.
    """
    def run(rows):
        for part in batches(rows, 4096, "text"):
            out: dict[str, list] = {"n_words": [], "runs": [], "best": [], "collapsed": []}
            for doc_id, text in zip(part.column("id").to_pylist(), part.column("text").to_pylist()):
                words = split_words(text or "")
                if prepare is not None:
                    words = prepare(doc_id, words)
                runs = find_runs(words, min_length, min_exponent)
                best = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=None)
                named = [dict(zip(("start", "length", "period"), r)) for r in (*runs, *([best] if best else []))]
                out["n_words"].append(len(words))
                out["runs"].append(named[:len(runs)])
                out["best"].append(named[-1] if best else None)
                out["collapsed"].append(b" ".join(collapse(words, runs)).decode("utf-8", "surrogatepass"))
            yield pa.RecordBatch.from_arrays(
                [part.column("id"), pa.array(out["n_words"], pa.int64()), pa.array(out["runs"], pa.list_(_RUN)),
                 pa.array(out["best"], _RUN), pa.array(out["collapsed"], pa.string())],
                names=["id", "n_words", "runs", "best", "collapsed"])

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return arrow_map(rows, run, _SCHEMA).withColumnRenamed("id", id_col)


def run_digests(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts, the best run and digests of the runs and of the collapsed text, one row per row."""
    listed = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])), "\n")
    return found.select(
        id_col, F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.when(F.size("runs") > 0, F.concat(listed, F.lit("\n"))).otherwise(""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"))
