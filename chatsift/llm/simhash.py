"""Near-duplicate classes by SimHash, found through one-wildcard segment variants.

A fingerprint has 64 bits: a bit is 1 where over half of the XXH64 hashes of the
text's word shingles (repeats included) set it.  Two fingerprints link at
``MAX_BITS`` = 2 differing bits or fewer.

Cut into two segments of 32 bits, such a pair has a segment that differs in one
bit at most.  Either it is equal (found by the segment itself), or one bit
differs: then both segments are the same with that bit deleted, so each
fingerprint is filed under the 32 variants of its first segment with one bit
wildcarded.  A pair whose second segment differs in one bit while the first is
equal is found by the first segment, so the second needs no variants.  Rows that
meet under one key (equality, by a shuffle) are verified by counting bits.

* Equal fingerprints are one entry of the index, with the least id.
* A segment that more than ``HOT`` different fingerprints share is not filed
  whole: the other segment is cut again into halves of 16 bits, by the same
  argument.  A key then fixes 47 bits or more, so no key holds over 2^17
  entries, whatever the data.
* From one key only a spanning forest of its links goes on; connected components
  follow in tables.

Nulls and edge cases: null and empty texts have the fingerprint 0 and link like
any other; rows with a null id take part, but a component is named by its least
non-null id (null where there is none); repeated rows are rows; further columns
of the input are ignored.  An empty table gives an empty table.
"""

from __future__ import annotations

from itertools import accumulate
from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chatsift.llm.common import arrow_map, batches, skewed_left_join, split_words, staged
from chatsift.llm.components import connected_components

SHINGLE = 3
SEED = 42
MAX_BITS = 2
#: Different fingerprints that may share one segment before the other segment is cut again.
HOT = 1024
#: Shingles whose hashes are held at a time.
CHUNK = 1 << 16
_SEG = np.uint64(0xFFFFFFFF)
_KIND = np.uint64(58)


# ------------------------------------------------------------ fingerprints ---

def shingle_hashes(words: list[bytes], size: int = SHINGLE) -> Iterator[np.ndarray]:
    """XXH64 of every space-joined shingle in order, in chunks; of the whole sequence where it is shorter."""
    from xxhash import xxh64_intdigest

    n = len(words)
    if n == 0:
        return
    line = b" ".join(words)
    if n < size:
        yield np.array([xxh64_intdigest(line, SEED)], dtype=np.uint64)
        return
    starts = [0, *accumulate(len(w) + 1 for w in words)]
    last = n - size + 1
    for at in range(0, last, CHUNK):
        stop = min(last, at + CHUNK)
        spans = zip(starts[at:stop], starts[at + size:stop + size])
        yield np.fromiter((xxh64_intdigest(line[a:b - 1], SEED) for a, b in spans), dtype=np.uint64, count=stop - at)


def fingerprint(text: str | None, size: int = SHINGLE) -> int:
    """SimHash of one text as an unsigned 64-bit number."""
    counts = np.zeros(64, dtype=np.int64)
    n = 0
    for hashes in shingle_hashes(split_words(_lower(text)), size):
        rows = hashes.astype("<u8").view(np.uint8).reshape(-1, 8)
        n += len(rows)
        if len(rows) < 256:
            counts += np.unpackbits(rows, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        else:  # how often each byte value stands at each of the eight places, times its bits
            for k in range(8):
                counts[8 * k:8 * k + 8] += np.bincount(rows[:, k], minlength=256) @ _BITS
    return int(np.packbits(counts * 2 > n, bitorder="little").view("<u8")[0]) if n else 0


_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)
_UPPER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}


def _lower(text: str | None) -> str:
    return (text or "").translate(_UPPER)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE) -> DataFrame:
    """(id, fp long): the fingerprint of every row, as the signed long of the same bits."""
    def run(rows):
        for batch in rows:
            for part in batches(iter([batch]), 4096, "text"):
                fps = np.fromiter((fingerprint(t, size) for t in part.column("text").to_pylist()), dtype=np.uint64,
                                  count=part.num_rows)
                yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(fps.view(np.int64))], names=["id", "fp"])

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return arrow_map(rows, run, "id long, fp long")


# ------------------------------------------------------------------- index ---

def _keys(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every fingerprint under the keys of its segments; see the module for which."""
    bit = np.uint64(1) << np.arange(32, dtype=np.uint64)

    def pack(kind, *fields):
        out = np.uint64(kind) << _KIND
        for values, shift in fields:
            out = out | (values.astype(np.uint64) << np.uint64(shift))
        return out

    def halves(kind, seg, other):
        """A hot segment with the halves of the other one: each half itself, and the upper with one bit wildcarded."""
        up, low = other >> np.uint64(16), other & np.uint64(0xFFFF)
        yield pack(kind, (seg, 16), (up, 0)), np.arange(len(seg))
        yield pack(kind + 1, (seg, 16), (low, 0)), np.arange(len(seg))
        for k in range(16):
            yield pack(kind + 2, (seg, 16), (up & ~bit[k], 0), (np.full(len(seg), k), 48)), np.arange(len(seg))

    for batch in rows:
        fp = batch.column("fp").to_numpy().view(np.uint64)
        hot_a = batch.column("hot_a").to_numpy(zero_copy_only=False).astype(bool)
        hot_b = batch.column("hot_b").to_numpy(zero_copy_only=False).astype(bool)
        near = batch.column("near").to_numpy().astype(np.uint64)
        a, b = fp >> np.uint64(32), fp & _SEG
        fine = np.where(hot_a, _SEG, near)  # bits whose variants are cut finer
        found = []
        cold = np.flatnonzero(~hot_a)
        found.append((pack(0, (a[cold], 0)), cold))
        cold = np.flatnonzero(~hot_b)
        found.append((pack(1, (b[cold], 0)), cold))
        for k in range(32):
            whole = (fine & bit[k]) == 0
            at = np.flatnonzero(whole)
            found.append((pack(2, (a[at] & ~bit[k], 0), (np.full(len(at), k), 32)), at))
            at = np.flatnonzero(~whole)
            if len(at):
                place = np.full(len(at), k)
                seg = a[at] & ~bit[k]
                found.append((pack(9, (place, 48), (seg, 16), (b[at] >> np.uint64(16), 0)), at))
                found.append((pack(10, (place, 48), (seg, 16), (b[at] & np.uint64(0xFFFF), 0)), at))
        for hot, kind, seg, other in ((hot_a, 3, a, b), (hot_b, 6, b, a)):
            at = np.flatnonzero(hot)
            if len(at):
                found.extend((keys, at[i]) for keys, i in halves(kind, seg[at], other[at]))
        keys = np.concatenate([k for k, _ in found])
        fps = np.concatenate([fp[i] for _, i in found])
        for at in range(0, len(keys), 1 << 17):
            yield pa.RecordBatch.from_arrays([pa.array(keys[at:at + (1 << 17)].view(np.int64)),
                                              pa.array(fps[at:at + (1 << 17)].view(np.int64))], names=["key", "fp"])


def _close_pairs(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places (i, j) of all pairs within ``MAX_BITS`` bits; ``fps`` ascends without repeats.

    Either by comparing all pairs, or by looking up every fingerprint with one or
    two of the bits changed in which the entries differ at all, whichever is less.
    """
    m = len(fps)
    free = np.bitwise_or.reduce(fps ^ fps[0])
    bits = np.uint64(1) << np.flatnonzero(np.unpackbits(np.array([free], dtype="<u8").view(np.uint8), bitorder="little")).astype(np.uint64)
    masks = np.concatenate([bits] + [bits[:k] | bits[k] for k in range(1, len(bits))]) if len(bits) else bits
    left, right = [], []
    if m // 2 <= 4 * len(masks):
        for at in range(0, m, 256):
            i, j = np.nonzero(np.bitwise_count(fps[at:at + 256, None] ^ fps[None, :]) <= MAX_BITS)
            i = i + at
            left.append(i[i < j])
            right.append(j[i < j])
    else:
        for mask in masks:
            other = fps ^ mask
            j = np.minimum(np.searchsorted(fps, other), m - 1)
            i = np.flatnonzero((fps[j] == other) & (fps < other))
            left.append(i)
            right.append(j[i])
    return np.concatenate(left), np.concatenate(right)


def _forest(m: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """For each of m places the least place it reaches by the links."""
    root = np.arange(m)
    while len(i):
        before = root.copy()
        low = np.minimum(root[i], root[j])
        np.minimum.at(root, root[i], low)
        np.minimum.at(root, root[j], low)
        np.minimum.at(root, i, low)
        np.minimum.at(root, j, low)
        root = root[root]
        if np.array_equal(root, before):
            break
    return root


def _links(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Verified links of every key, as a spanning forest; rows come ordered by (key, fp)."""
    def of(keys, fps):
        starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        sizes = np.diff(np.append(starts, len(keys)))
        two = starts[sizes == 2]
        x, y = fps[two], fps[two + 1]
        near = np.bitwise_count(x ^ y) <= MAX_BITS
        out = [(x[near], y[near])]
        for at, size in zip(starts[sizes > 2], sizes[sizes > 2]):
            group = np.sort(fps[at:at + size])
            i, j = _close_pairs(group)
            root = _forest(size, i, j)
            moved = np.flatnonzero(root != np.arange(size))
            out.append((group[moved], group[root[moved]]))
        a, b = (np.concatenate(side).view(np.int64) for side in zip(*out))
        return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    keys = np.empty(0, dtype=np.int64)
    fps = np.empty(0, dtype=np.uint64)
    for batch in rows:
        keys = np.concatenate([keys, batch.column("key").to_numpy()])
        fps = np.concatenate([fps, batch.column("fp").to_numpy().view(np.uint64)])
        if not len(keys) or keys[0] == keys[-1]:
            continue
        cut = int(np.searchsorted(keys, keys[-1]))
        yield of(keys[:cut], fps[:cut])
        keys, fps = keys[cut:].copy(), fps[cut:].copy()
    if len(keys):
        yield of(keys, fps)


def close_links(fps: DataFrame, hot: int = HOT) -> DataFrame:
    """Links (a, b) that connect just what ``MAX_BITS`` differing bits connect; ``fps`` has one row for each ``fp``.

    Links of one key are thinned to a spanning forest of the key.
    """
    rows = fps.select("fp", F.shiftrightunsigned("fp", 32).alias("a"), F.col("fp").bitwiseAND(0xFFFFFFFF).alias("b"))
    many_a, many_b = (rows.groupBy(s).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > hot).select(s) for s in "ab")
    many_a = staged(many_a, "hot-segments")
    # First segments one bit from a hot one, with the bits that lead there (at most 32 each).
    beside = (many_a.select("a", F.explode(F.sequence(F.lit(0), F.lit(31))).alias("k"))
              .select(F.col("a").bitwiseXOR(F.expr("shiftleft(1L, k)")).alias("a"), F.expr("shiftleft(1L, k)").alias("bit"))
              .groupBy("a").agg(F.sum("bit").alias("near")))
    marked = (rows.join(many_a.withColumn("hot_a", F.lit(True)), "a", "left").join(beside, "a", "left")
              .join(many_b.withColumn("hot_b", F.lit(True)), "b", "left")
              .select("fp", *(F.coalesce(c, F.lit(False)).alias(c) for c in ("hot_a", "hot_b")), F.coalesce("near", F.lit(0)).alias("near")))
    keyed = arrow_map(marked, _keys, "key long, fp long")
    return arrow_map(keyed.repartition("key").sortWithinPartitions("key", "fp"), _links, "a long, b long")


# ----------------------------------------------------------------- classes ---

def simhash_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE,
                       hot: int = HOT) -> DataFrame:
    """(id, fingerprint, component_id) of every row: 16 hex digits, and the least id reachable by links.

    See the module for nulls, empty texts, repeated rows and further columns.
    """
    prints = staged(fingerprints(docs, id_col, text_col, size), "fingerprints")
    classes = staged(prints.groupBy("fp").agg(F.min("id").alias("least"), F.count(F.lit(1)).alias("n")), "classes")
    nodes = connected_components(close_links(classes.select("fp"), hot))
    linked = classes.join(nodes.withColumnRenamed("node", "fp"), "fp").select("fp", "least", "n", "root")
    least = linked.groupBy("root").agg(F.min("least").alias("component"), F.count(F.lit(1)).alias("rows"))
    named = skewed_left_join(linked.select("fp", "n", "root"), staged(least, "components"), "root", "rows")
    alone = classes.join(nodes.select(F.col("node").alias("fp")), "fp", "left_anti")
    names = named.select("fp", "n", "component").unionByName(alone.select("fp", "n", F.col("least").alias("component")))
    out = skewed_left_join(prints, staged(names, "names"), "fp", "n")
    return out.select(F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                      F.col("component").alias("component_id"))
