"""Exact dedup by an exchange of Golomb-coded fingerprints.

1. Every scan task sorts the distinct 64-bit fingerprints of its rows, cuts
   them by owner (equal ranges of the hash space) and writes each piece
   Golomb-Rice coded, about 1.5 bits above the entropy of the gaps.
2. The owner of a range decodes the pieces of all tasks and answers each with a
   bitmap: which of its fingerprints another task holds too.
3. Rows whose fingerprint is marked, or repeated inside their own task, are
   suspects.  Only their texts travel on, and are grouped by their bytes.

A task sends each fingerprint once, so a group of copies that holds a third of
all rows costs an owner one entry a task.  The byte check is an aggregate with
the normalised text as its key: copies collapse before the shuffle.

Null and empty texts count as empty and equal.  Rows may repeat a ``doc_id``
or have none; of rows equal in length and id, the first by scan position stays.
"""

from __future__ import annotations

import hashlib
from typing import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chatsift.llm.common import BLANK_BYTES, arrow_map, batches, staged

BLOCK_ROWS = 1 << 16  # rows of a piece; a batch may carry it a little further
_BLOCK = ("chunk long, owner int, n int, rice int, payload binary, local binary, ranks binary, "
          "doc_ids array<long>, chars array<long>, shas array<string>, rows array<long>")
_MARKED = "doc_id long, fp long, chars long, text_sha256 string, row_key long, suspect boolean"


def rice_bits(values: np.ndarray) -> int:
    """The Rice parameter for sorted ``values``: the bits of their mean gap."""
    span = int(values[-1]) - int(values[0]) if len(values) > 1 else 0
    return max(0, min(63, (span // max(1, len(values))).bit_length() - 1))


def golomb_encode(values: np.ndarray, rice: int) -> bytes:
    """Sorted uint64 ``values`` as an 8-byte first value and Rice-coded gaps."""
    if not len(values):
        return b""
    gaps = np.diff(values)
    quotient = (gaps >> np.uint64(rice)).astype(np.int64)
    ends = np.cumsum(quotient + 1 + rice)
    bits = np.zeros(int(ends[-1]) if len(ends) else 0, np.uint8)
    stop = ends - rice - 1
    bits[stop] = 1
    for b in range(rice):
        bits[stop + 1 + b] = (gaps >> np.uint64(rice - 1 - b)) & np.uint64(1)
    return int(values[0]).to_bytes(8, "little") + np.packbits(bits).tobytes()


def golomb_decode(data: bytes, n: int, rice: int) -> np.ndarray:
    """The inverse of :func:`golomb_encode`."""
    out = np.zeros(n, np.uint64)
    if not n:
        return out
    bits = np.unpackbits(np.frombuffer(data, np.uint8, offset=8))
    ones = np.where(bits == 1, np.arange(len(bits)), len(bits))
    following = np.minimum.accumulate(ones[::-1])[::-1].tolist()
    at, stops = 0, np.empty(n - 1, np.int64)
    for i in range(n - 1):
        stops[i] = following[at]
        at = following[at] + 1 + rice
    starts = np.concatenate(([0], stops + 1 + rice))[: n - 1].astype(np.int64)
    gaps = (stops - starts).astype(np.uint64) << np.uint64(rice)
    for b in range(rice):
        gaps |= bits[stops + 1 + b].astype(np.uint64) << np.uint64(rice - 1 - b)
    out[0] = int.from_bytes(data[:8], "little")
    out[1:] = out[0] + np.cumsum(gaps)
    return out


def normalise(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass").translate(None, BLANK_BYTES)


def _blocks(owners: int):
    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq = TaskContext.get().partitionId(), 0
        ids, fps, chars, shas = [], [], [], []

        def flush():
            nonlocal seq
            chunk = (part << 20) | seq
            seq += 1
            fp = np.array(fps, np.uint64)
            order = np.argsort(fp, kind="stable")
            distinct, ranks, counts = np.unique(fp, return_inverse=True, return_counts=True)
            owner = ((distinct >> np.uint64(32)) * np.uint64(owners)) >> np.uint64(32)
            edges = np.searchsorted(owner, np.arange(owners + 1, dtype=np.uint64))
            cut = np.searchsorted(ranks[order], edges)
            out = []
            for o in range(owners):
                lo, hi = int(edges[o]), int(edges[o + 1])
                if lo == hi:
                    continue
                rice = rice_bits(distinct[lo:hi])
                mine = order[cut[o]:cut[o + 1]]
                out.append((chunk, o, hi - lo, rice, golomb_encode(distinct[lo:hi], rice),
                            np.packbits(counts[lo:hi] > 1).tobytes(),
                            (ranks[mine] - lo).astype(np.int32).tobytes(),
                            [ids[i] for i in mine], [chars[i] for i in mine], [shas[i] for i in mine],
                            ((chunk << 20) + mine).tolist()))
            ids.clear(), fps.clear(), chars.clear(), shas.clear()
            return pa.RecordBatch.from_pylist([dict(zip(_BLOCK_ARROW.names, r)) for r in out], schema=_BLOCK_ARROW)

        for batch in batches(rows, BLOCK_ROWS):
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                norm = normalise(text)
                ids.append(doc_id)
                fps.append(xxhash.xxh3_64_intdigest(norm))
                chars.append(len(text or ""))
                shas.append(hashlib.sha256(norm).hexdigest())
            if len(ids) >= BLOCK_ROWS:
                yield flush()
        if ids:
            yield flush()
    return run


_BLOCK_ARROW = pa.schema([
    ("chunk", pa.int64()), ("owner", pa.int32()), ("n", pa.int32()), ("rice", pa.int32()), ("payload", pa.binary()),
    ("local", pa.binary()), ("ranks", pa.binary()), ("doc_ids", pa.list_(pa.int64())),
    ("chars", pa.list_(pa.int64())), ("shas", pa.list_(pa.string())), ("rows", pa.list_(pa.int64()))])


def _answer(table: pa.Table) -> pa.Table:
    """One owner: for each piece, the bitmap of fingerprints that some other piece holds too."""
    pieces = [golomb_decode(p, n, r) for p, n, r in zip(*(table.column(c).to_pylist() for c in ("payload", "n", "rice")))]
    distinct, counts = np.unique(np.concatenate(pieces), return_counts=True)
    shared = distinct[counts > 1]
    maps = [np.packbits(np.isin(p, shared, assume_unique=True)).tobytes() for p in pieces]
    return pa.table({"chunk": table.column("chunk"), "owner": table.column("owner"),
                     "bitmap": pa.array(maps, pa.binary())})


def _mark(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in rows:
        for r in batch.to_pylist():
            n = r["n"]
            hit = np.unpackbits(np.frombuffer(r["bitmap"], np.uint8), count=n) | np.unpackbits(
                np.frombuffer(r["local"], np.uint8), count=n)
            ranks = np.frombuffer(r["ranks"], np.int32)
            fps = golomb_decode(r["payload"], n, r["rice"]).view(np.int64)
            yield pa.RecordBatch.from_arrays([
                pa.array(r["doc_ids"], pa.int64()), pa.array(fps[ranks]), pa.array(r["chars"], pa.int64()),
                pa.array(r["shas"], pa.string()),
                pa.array(r["rows"], pa.int64()),
                pa.array(hit[ranks].astype(bool))],
                names=["doc_id", "fp", "chars", "text_sha256", "row_key", "suspect"])


def _bytes(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches(rows, 4096, "text"):
        norms = [normalise(t) for t in batch.column(1).to_pylist()]
        fps = np.array([xxhash.xxh3_64_intdigest(n) for n in norms], np.uint64).view(np.int64)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps), pa.array(norms, pa.binary())],
                                         names=["doc_id", "fp", "norm"])


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                owners: int | None = None) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when their bytes without blanks and controls TAB to CR are.
    The row with the most code points, then the smallest id, stays.
    """
    spark = docs.sparkSession
    owners = owners or max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    blocks = staged(arrow_map(src, _blocks(owners), _BLOCK), "exact-blocks")
    answers = (blocks.select("chunk", "owner", "n", "rice", "payload").groupBy("owner")
               .applyInArrow(_answer, "chunk long, owner int, bitmap binary"))
    marked = staged(arrow_map(blocks.join(answers, ["chunk", "owner"]), _mark, _MARKED), "exact-marked")

    suspects = marked.where("suspect").select(F.col("doc_id").alias("s_id"), F.col("fp").alias("s_fp")).distinct()
    texts = arrow_map(src, _bytes, "doc_id long, fp long, norm binary")
    classes = (texts.join(suspects, F.expr("doc_id <=> s_id AND fp = s_fp"), "left_semi")
               .groupBy("fp", "norm").agg(F.count(F.lit(1)).alias("n"))
               .where("n > 1").select(F.sha2("norm", 256).alias("text_sha256")))
    # Largest first: most code points, smallest id (a missing id last), first row.
    order = F.struct("chars", (-F.coalesce("doc_id", F.lit(2**63 - 1))).alias("i"), (-F.col("row_key")).alias("r"))
    best = (marked.where("suspect").groupBy("text_sha256")
            .agg(F.max(order).alias("best"), F.count(F.lit(1)).alias("size"))
            .join(classes, "text_sha256", "left_semi")
            .select("text_sha256", F.col("size").alias("g_size"), (-F.col("best.r")).alias("g_row"),
                    F.expr("nullif(-best.i, 9223372036854775807)").alias("g_id")))
    out = marked.join(best, "text_sha256", "left")
    return out.select(
        "doc_id", F.when(F.col("g_size").isNull(), F.col("doc_id")).otherwise(F.col("g_id")).alias("keep_id"),
        F.coalesce("g_size", F.lit(1).cast("long")).alias("group_size"),
        F.coalesce(F.col("g_row") == F.col("row_key"), F.lit(True)).alias("kept"), "text_sha256")
