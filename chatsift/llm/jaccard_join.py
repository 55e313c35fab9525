"""N-gram Jaccard join: size-banded tiles, bitmap signatures, exact intersections.

Sets are the distinct ``SHINGLE``-word shingles of a text, as sorted arrays of
64-bit hashes.  Equal sets are one set from the start (hash of the array and its
size); a group of exact copies is never compared.

1. Candidates: two sets of Jaccard similarity t or more share a shingle among
   the first n - ceil(t n) + 1 of each in any common order.  The order puts the
   shingles that tasks find frequent last, the rest by hash.  Sets that share a
   prefix shingle form a tile; tiles with the same members are one.
2. In a tile, sorted by size, each set meets those within the size band that t
   allows.  Signatures (parities of hashed shingles) bound the overlap from
   above: every differing bit is a shingle of only one set.  A tile emits a
   spanning forest of the pairs that pass, never the pairs.  Tiles of over
   ``TILE_ROWS`` sets are cut into overlapping bands of size first; a band that is
   still too large for a task's memory passes as a whole.
3. Components of the forests are clusters: no link leaves one.  The short
   signatures of tiles are full for very long sets, so clusters of several blocks
   that hold such sets are cut once more by bands of size with wide signatures, of
   a bit or two for each shingle.  Each set of a
   cluster is sent once, with its array, to a block of about ``BLOCK`` sets and
   ``BLOCK_BYTES`` of arrays, where links are tested exactly, skipping sets already
   connected.
4. Clusters of several blocks are blocked by bands of size, so that linked sets
   lie in one band or in two that are next to each other.  Samples of the larger
   components of each block are joined first; then the sets outside the largest
   component form blocks of zones of bands, which a task holds indexed by shingle
   while all sets of the cluster in those bands pass by.  So each pair of sets of
   different components that sizes allow has been tested.

Texts without words have the empty set and no link.  Null ids are allowed; the
component of a row is the least id in it.
"""

from __future__ import annotations

from typing import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chatsift.llm.common import arrow_map, batches, fresh, staged
from chatsift.llm.components import connected_components, stars

SHINGLE = 4
PERCENT = 85
#: Frequent shingles that the order of the prefix knows; any number is right.
FREQUENT = 100_000
BLOCK = 1024
BLOCK_BYTES = 4 << 20
OUT_BYTES = 16 << 20  # arrays of a block of sets outside the main component
ZONE = 8  # bands of size that one such block spans
TILE_ROWS = 20_000
MEMO = 100_000  # ids or edges that a task remembers, so as not to send them again
HELD = 1_000_000  # shingles that a task holds to find frequent ones
SMALL_TILE = 64
FILTER_BITS = 1 << 23
_SHORT, _LONG = 8, 32  # words of 64 bits in a signature, for sets up to and over LONG_SET
LONG_SET = 1024
WIDE_SET = 2048  # sets over this have a wide signature as well
_WIDEST = 1 << 12  # words of the largest one
SIG_BYTES = 32 << 20  # signatures that a task holds for one tile

_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
_IS_BLANK = np.zeros(256, bool)
_IS_BLANK[list(b" \t\n\x0b\x0c\r")] = True
_BYTE_VALUES = np.random.default_rng(1).integers(1, 1 << 62, 256, np.uint64)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_UNBASE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def shingle_sets(texts: list[str | None], size: int = SHINGLE) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each whole text, A-Z lowered."""
    parts = [(t or "").encode("utf-8", "surrogatepass").translate(_LOWER) for t in texts]
    flat = np.frombuffer(b"\n".join(parts) + b"\n", np.uint8)
    blank = _IS_BLANK[flat]
    edge = np.diff(blank.astype(np.int8), prepend=np.int8(1))
    starts, ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    # The hash of a word is a difference of prefix sums, brought back to power 0.
    powers = np.full(len(flat), _BASE)
    powers[0] = 1
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(_BYTE_VALUES[flat] * np.cumprod(powers), dtype=np.uint64)))
    powers[1:] = _UNBASE
    words = _mix((sums[ends] - sums[starts]) * np.cumprod(powers)[starts])
    bounds = np.searchsorted(starts, np.cumsum([len(p) + 1 for p in parts]))
    codes = np.zeros(max(0, len(words) - size + 1), np.uint64)
    for k in range(size):
        codes = codes * np.uint64(0xD1342543DE82EF95) + words[k:k + len(codes)]
    codes = _mix(codes)
    out, lo = [], 0
    for hi in bounds.tolist():
        if hi - lo >= size:
            out.append(np.unique(codes[lo:hi - size + 1]))
        elif hi > lo:
            code = np.uint64(hi - lo)
            for w in words[lo:hi]:
                code = np.uint64((int(code) * 0xA0761D6478BD642F + int(w)) & 0xFFFFFFFFFFFFFFFF)
            out.append(_mix(np.array([code])))
        else:
            out.append(np.zeros(0, np.uint64))
        lo = hi
    return out


def set_id(shingles: np.ndarray) -> int:
    """A signed 64-bit name of a set."""
    h = xxhash.xxh3_64_intdigest(shingles.tobytes(), len(shingles))
    return h - (1 << 64) if h >> 63 else h


def signature(shingles: np.ndarray, words: int | None = None) -> np.ndarray:
    """Parity bitmap: bit h is set where an odd number of shingles hash to it."""
    words = words or (_SHORT if len(shingles) <= LONG_SET else _LONG)
    bits = np.bincount((shingles >> np.uint64(40)).astype(np.int64) % (64 * words), minlength=64 * words) & 1
    return np.packbits(bits.astype(np.uint8), bitorder="little").view(np.uint64)


def wide_signature(shingles: np.ndarray) -> bytes | None:
    """For sets over ``WIDE_SET``: one to two bits for each shingle, as far as ``_WIDEST`` words allow."""
    if len(shingles) <= WIDE_SET:
        return None
    return signature(shingles, min(_WIDEST, 1 << (len(shingles) - 1).bit_length() - 6)).tobytes()


def _folded(sigs: np.ndarray, words: int) -> np.ndarray:
    """Signatures (rows) as ones of fewer words: parities add."""
    return np.bitwise_xor.reduce(sigs.reshape(len(sigs), -1, words), axis=1)


def may_link(n: int, others: np.ndarray, differing: np.ndarray, percent: int) -> np.ndarray:
    """Whether sizes and the number of differing signature bits allow the similarity."""
    most = np.minimum((n + others - differing) // 2, np.minimum(n, others))
    return 100 * most >= percent * (n + others - most)


# ------------------------------------------------------------------- scans ---

def _describe(size: int):
    """Row per text: its set's id, size and signature.  Row per shingle found often by the task: its count."""
    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        held, n_held = [], 0

        def frequent():
            values, counts = np.unique(np.concatenate(held), return_counts=True)
            often = counts >= 3
            return pa.RecordBatch.from_arrays([
                pa.nulls(int(often.sum()), pa.int64()), pa.nulls(int(often.sum()), pa.int64()),
                pa.nulls(int(often.sum()), pa.int32()),
                pa.array(values[often].view(np.int64)), pa.nulls(int(often.sum()), pa.binary()),
                pa.nulls(int(often.sum()), pa.binary()), pa.array(counts[often].astype(np.int64))], names=names)

        names = ["doc_id", "text_hash", "n", "set_id", "sig", "wide", "found"]
        for batch in batches(rows, 1024, "text", 1 << 18):
            sets = shingle_sets(batch.column("text").to_pylist(), size)
            ids = [set_id(s) for s in sets]
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), batch.column("text_hash"), pa.array([len(s) for s in sets], pa.int32()), pa.array(ids, pa.int64()),
                pa.array([signature(s).tobytes() for s in sets], pa.binary()),
                pa.array([wide_signature(s) for s in sets], pa.binary()), pa.nulls(len(ids), pa.int64())], names=names)
            if len(seen) > MEMO:
                seen.clear()
            for i, s in zip(ids, sets):
                if i not in seen:
                    seen.add(i)
                    held.append(s)
                    n_held += len(s)
            if n_held > HELD:  # bounds the task
                yield frequent()
                held, n_held = [], 0
        if held:
            yield frequent()
    return run


def _prefixes(size: int, percent: int, frequent):
    """Row per prefix shingle of each set, once a task."""
    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        late, order = frequent.value  # sorted shingles, their ranks
        seen: set[int] = set()
        for batch in batches(rows, 1024, "text", 1 << 18):
            shingles, owners = [], []
            if len(seen) > MEMO:
                seen.clear()
            for s in shingle_sets(batch.column("text").to_pylist(), size):
                i = set_id(s)
                if not len(s) or i in seen:
                    continue
                seen.add(i)
                length = len(s) - (percent * len(s) + 99) // 100 + 1
                if len(late):
                    at = np.minimum(np.searchsorted(late, s), len(late) - 1)
                    s = s[np.argsort(np.where(late[at] == s, order[at], -1), kind="stable")]
                shingles.append(s[:length])
                owners.append(np.full(length, i, np.int64))
            if shingles:
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.concatenate(shingles).view(np.int64)), pa.array(np.concatenate(owners))],
                    names=["shingle", "set_id"])
    return run


def _arrays(size: int, wanted):
    """Row per set that may be wanted: its array."""
    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = wanted.value
        seen: set[int] = set()
        for batch in batches(rows, 1024, "text", 1 << 18):
            ids, data = [], []
            if len(seen) > MEMO:
                seen.clear()
            for s in shingle_sets(batch.column("text").to_pylist(), size):
                i = set_id(s)
                if len(s) and i not in seen:
                    seen.add(i)
                    bit = i % FILTER_BITS
                    if bits[bit >> 3] >> (bit & 7) & 1:
                        ids.append(i)
                        data.append(s.tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(data, pa.binary())],
                                             names=["set_id", "shingles"])
    return run


# ------------------------------------------------------------------- tiles ---

def _shared(tile_rows: int):
    """From (shingle, set_id) in this order: the tiles of two sets or more, named by their members; ``large`` marks
    those that went out as they came."""
    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["tile", "set_id", "large"]
        rest: pa.Table | None = None

        def tiles(shingle, ids):
            """Of whole tiles; the rows of a set that several tasks sent count once."""
            fresh = np.concatenate(([True], (shingle[1:] != shingle[:-1]) | (ids[1:] != ids[:-1])))
            shingle, ids = shingle[fresh], ids[fresh]
            at = np.flatnonzero(np.concatenate(([True], shingle[1:] != shingle[:-1])))
            count = np.diff(np.append(at, len(shingle)))
            # The sum of mixed ids names a small tile: its order does not matter.  A large one keeps its shingle.
            named = np.add.reduceat(_mix(ids.view(np.uint64)), at) * np.uint64(2) + count.astype(np.uint64)
            named = np.where(count <= SMALL_TILE, _mix(named), shingle[at].view(np.uint64))
            keep = np.repeat(count > 1, count)
            return pa.RecordBatch.from_arrays([pa.array(np.repeat(named, count)[keep].view(np.int64)), pa.array(ids[keep]),
                                               pa.array(np.zeros(int(keep.sum()), bool))], names=names)

        lead: tuple[int, int] | None = None  # of a tile longer than one batch: its shingle and last set
        for batch in rows:
            shingle, ids = batch.column("shingle").to_numpy(), batch.column("set_id").to_numpy()
            if rest is not None:
                shingle, ids = np.concatenate((rest[0], shingle)), np.concatenate((rest[1], ids))
                rest = None
            if not len(shingle):
                continue
            whole = np.flatnonzero(shingle != shingle[-1])
            cut = int(whole[-1]) + 1 if len(whole) else 0
            if cut:
                if lead is not None and shingle[0] == lead[0]:
                    first = int(np.flatnonzero(shingle != lead[0])[0])
                    yield _more(lead, ids[:first], names)
                    shingle, ids, cut = shingle[first:], ids[first:], cut - first
                lead = None
                if cut:
                    yield tiles(shingle[:cut], ids[:cut])
            shingle, ids = shingle[cut:], ids[cut:]
            if lead is not None and shingle[0] == lead[0]:
                yield _more(lead, ids, names)
                lead = (lead[0], int(ids[-1]))
            elif len(np.unique(ids)) > tile_rows:  # goes out as it comes
                distinct = ids[np.concatenate(([True], ids[1:] != ids[:-1]))]
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(distinct), shingle[0])), pa.array(distinct),
                                                  pa.array(np.ones(len(distinct), bool))], names=names)
                lead = (int(shingle[0]), int(ids[-1]))
            else:
                rest = (shingle, ids)
        if rest is not None:
            yield tiles(*rest)
    return run


def _more(lead, ids, names):
    distinct = ids[np.concatenate(([True], ids[1:] != ids[:-1]))] if len(ids) else ids
    if len(distinct) and distinct[0] == lead[1]:
        distinct = distinct[1:]
    return pa.RecordBatch.from_arrays([pa.array(np.full(len(distinct), lead[0], np.int64)), pa.array(distinct),
                                       pa.array(np.ones(len(distinct), bool))], names=names)


class _Signatures:
    """Signatures of several lengths; two are compared at the shorter one's, to which the longer one folds."""

    def __init__(self, raw: list[bytes]):
        self.words = np.array([len(r) // 8 for r in raw])
        self.place = np.zeros(len(raw), np.int64)
        self.rows: dict[int, np.ndarray] = {}  # by length
        self.fold: dict[tuple[int, int], np.ndarray] = {}
        for w in np.unique(self.words).tolist():
            at = np.flatnonzero(self.words == w)
            self.place[at] = np.arange(len(at))
            self.rows[w] = np.frombuffer(b"".join(raw[j] for j in at.tolist()), np.uint64).reshape(len(at), w)

    def differing(self, i: int, others: np.ndarray) -> np.ndarray:
        out = np.zeros(len(others), np.int64)
        mine, w = self.rows[int(self.words[i])][self.place[i]], int(self.words[i])
        for v, rows in self.rows.items():
            at = np.flatnonzero(self.words[others] == v)
            if not len(at):
                continue
            if v > w:
                if (v, w) not in self.fold:
                    self.fold[v, w] = _folded(rows, w)
                rows = self.fold[v, w]
            short = mine if v >= w else _folded(mine[None], v)[0]
            out[at] = np.bitwise_count(rows[self.place[others[at]]] ^ short).sum(1, dtype=np.int64)
        return out


def _forest(n: np.ndarray, percent: int, test) -> list[tuple[int, int]]:
    """A spanning forest of the graph of ``test(i, others) -> mask`` over sets of sizes ``n``, ascending.

    Each set is expanded once, against the sets of its size band that are not reached yet.
    """
    edges, left = [], np.arange(len(n))
    while len(left):
        queue, left = [int(left[0])], left[1:]
        while queue and len(left):
            i = queue.pop()
            sizes = n[left]
            lo = int(np.searchsorted(sizes, -(-percent * int(n[i]) // 100)))
            hi = int(np.searchsorted(sizes, 100 * int(n[i]) // percent, "right"))
            if lo == hi:
                continue
            hit = test(i, left[lo:hi])
            if hit.any():
                found = left[lo:hi][hit]
                edges.extend((i, int(j)) for j in found)
                queue.extend(found.tolist())
                left = np.concatenate((left[:lo], left[lo:hi][~hit], left[hi:]))
    return edges


def _tile_forests(percent: int, tile_rows: int):
    """From (tile, n, set_id, sig) in this order: edges between sets that may link."""
    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["a", "b"]
        done: set[tuple[int, int]] = set()  # edges this task has sent
        tile, held, chained, n_bytes = None, [], False, 0

        def edges(found):
            fresh = []
            if len(done) > MEMO:
                done.clear()
            for a, b in found:
                pair = (a, b) if a < b else (b, a)
                if pair not in done:
                    done.add(pair)
                    fresh.append(pair)
            a, b = zip(*fresh) if fresh else ((), ())
            return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=names)

        def solved():
            if len(held) == 2 and len(held[0][2]) == len(held[1][2]):  # most tiles
                (n0, a, x), (n1, b, y) = held
                most = min((n0 + n1 - (int.from_bytes(x) ^ int.from_bytes(y)).bit_count()) // 2, n0, n1)
                return [(a, b)] if 100 * most >= percent * (n0 + n1 - most) else []
            ids, n = [h[1] for h in held], np.array([h[0] for h in held], np.int64)
            sigs = _Signatures([h[2] for h in held])
            return [(ids[i], ids[j]) for i, j in _forest(
                n, percent, lambda i, others: may_link(int(n[i]), n[others], sigs.differing(i, others), percent))]

        out = []
        for batch in batches(rows, 2048):
            for t, n, i, sig in zip(*(batch.column(c).to_pylist() for c in ("tile", "n", "set_id", "sig"))):
                if t != tile:
                    if len(held) > 1 and not chained:
                        out.extend(solved())
                    tile, held, chained, n_bytes = t, [], False, 0
                if chained:
                    out.append((held[-1][1], i))
                    held = [(n, i, sig)]
                    continue
                held.append((n, i, sig))
                n_bytes += len(sig)
                if len(held) > tile_rows or n_bytes > SIG_BYTES:  # passes as a whole; the exact test comes later
                    out.extend((x[1], y[1]) for x, y in zip(held, held[1:]))
                    held, chained = held[-1:], True
            yield edges(out)
            out = []
        if len(held) > 1 and not chained:
            out.extend(solved())
        yield edges(out)
    return run


# ------------------------------------------------------------------ blocks ---

class _Sets:
    """The arrays of a block, renumbered densely for counting intersections."""

    def __init__(self, raw: list[bytes]):
        sets = [np.frombuffer(r, np.uint64) for r in raw]
        self.n = np.array([len(s) for s in sets], np.int64)
        self.at = np.concatenate(([0], np.cumsum(self.n)))
        values, self.flat = np.unique(np.concatenate(sets), return_inverse=True)
        self.mark = np.zeros(len(values), bool)

    def links(self, i: int, others: np.ndarray, percent: int) -> np.ndarray:
        """Exact: 100 x intersection >= percent x union."""
        small, large = np.minimum(self.n[i], self.n[others]), np.maximum(self.n[i], self.n[others])
        out = 100 * small >= percent * large
        near = others[out]
        if len(near):
            mine = self.flat[self.at[i]:self.at[i + 1]]
            self.mark[mine] = True
            lengths = self.n[near]
            first = np.concatenate(([0], np.cumsum(lengths)[:-1]))
            where = np.repeat(self.at[near] - first, lengths) + np.arange(int(lengths.sum()))
            both = np.add.reduceat(self.mark[self.flat[where]].astype(np.int64), first)
            self.mark[mine] = False
            out[out] = 100 * both >= percent * (self.n[i] + lengths - both)
        return out


def _in_groups(rows: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[tuple, list[dict]]]:
    """Consecutive rows with the same keys; the caller bounds the groups."""
    key, held = None, []
    for batch in batches(rows, 256):
        for r in batch.to_pylist():
            k = tuple(r[c] for c in keys)
            if k != key:
                if held:
                    yield key, held
                key, held = k, []
            held.append(r)
    if held:
        yield key, held


def _block_links(percent: int, keys: list[str]):
    """The components of the exact links of each block, as links of nodes with the least one; ``several`` is the block's."""
    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, held in _in_groups(rows, keys):
            names = np.array([r["name"] for r in held], np.int64)
            sets = _Sets([r["shingles"] for r in held])
            found = _forest(sets.n, percent, lambda i, others: sets.links(i, others, percent))
            if found:
                i, j = np.array(found).T
                a, b, _ = stars(names[i], names[j])
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array(np.full(len(a), held[0]["several"]))],
                                                 names=["a", "b", "several"])
    return run


_LINKS = "a long, b long, several boolean"


def _edge_batch(found: list[tuple[int, int]]) -> pa.RecordBatch:
    a, b = zip(*found) if found else ((), ())
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


class _Index:
    """The arrays of some sets, by shingle: which sets hold it."""

    def __init__(self, raw: list[bytes]):
        sets = [np.frombuffer(r, np.uint64) for r in raw]
        self.n = np.array([len(x) for x in sets], np.int64)
        flat = np.concatenate(sets)
        by = np.argsort(flat, kind="stable")
        self.owner = np.repeat(np.arange(len(sets), dtype=np.int32), self.n)[by]
        self.values, self.at = np.unique(flat[by], return_index=True)
        self.at = np.append(self.at, len(flat))

    def linked(self, shingles: np.ndarray, percent: int) -> np.ndarray:
        """The sets that link with this one, exactly: 100 x intersection >= percent x union."""
        place = np.minimum(np.searchsorted(self.values, shingles), len(self.values) - 1)
        place = place[self.values[place] == shingles]
        first, counts = self.at[place], self.at[place + 1] - self.at[place]
        where = np.repeat(first - np.cumsum(counts) + counts, counts) + np.arange(int(counts.sum()))
        both = np.bincount(self.owner[where], minlength=len(self.n))
        return np.flatnonzero((both > 0) & (100 * both >= percent * (len(shingles) + self.n - both)))


_PAIR = ["cluster", "zone", "out_block"]


def _outside_links(percent: int):
    """Streams the sets of a cluster past a block of sets outside its main component, which come first: links of
    the roots of components that a pair of sets links, but for what follows from other links."""
    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, index, top, found = None, [], None, {}, []

        def root(x):
            while x in top:
                x = top[x]
            return x

        for batch in batches(rows, 256):
            for r in batch.to_pylist():
                k = tuple(r[c] for c in _PAIR)
                if k != key:
                    key, held, index, top = k, [], None, {}
                if r["outer"]:
                    held.append(r)
                    continue
                if not held:  # a block that no set fell into
                    continue
                if index is None:
                    index = _Index([h["shingles"] for h in held])
                    held = [h["root"] for h in held]
                for j in index.linked(np.frombuffer(r["shingles"], np.uint64), percent).tolist():
                    x, y = root(r["root"]), root(held[j])
                    if x != y:
                        top[max(x, y)] = min(x, y)
                        found.append((x, y))
            yield _edge_batch(found)
            found = []
    return run


def _blocked(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Rows of a key together in one partition, in order."""
    return df.repartition(*keys).sortWithinPartitions(*keys, *order)


def _filter_bits(df: DataFrame, column: str):
    """A bit for each value's hash, as a broadcast of FILTER_BITS bits whatever the number of values."""
    spark = df.sparkSession
    bit = F.pmod(F.col(column), F.lit(FILTER_BITS))
    words = (df.select(F.floor(bit / 32).cast("int").alias("w"), F.expr(f"shiftleft(1L, cast(pmod(pmod({column}, {FILTER_BITS}), 32) as int))").alias("m"))
             .groupBy("w").agg(F.bit_or("m").alias("m"))).toArrow()  # FILTER_BITS / 32 rows at most
    out = np.zeros(FILTER_BITS // 32, np.uint32)
    out[words.column("w").to_numpy()] = words.column("m").to_numpy().astype(np.uint32)
    return spark.sparkContext.broadcast(out.tobytes())


def _band(n, percent: int):
    """Sizes that ``percent`` allows to link lie in one band or in two that follow each other."""
    return F.floor(F.log(n.cast("double")) / float(np.log(100 / percent) * (1 + 1e-9) if percent < 100 else 1.0)).cast("int")


def set_components(docs: DataFrame, sets: DataFrame, size: int, percent: int, block: int, tile_rows: int = TILE_ROWS) -> DataFrame:
    """(node, root) of the sets that link with another set, but for roots.  ``docs``: text; ``sets``: set_id, n, sig, distinct."""
    spark = docs.sparkSession
    often = (sets.where("found IS NOT NULL").groupBy("set_id").agg(F.sum("found").alias("c"))
             .orderBy(F.desc("c"), "set_id").limit(FREQUENT)).toArrow()  # FREQUENT rows of 16 bytes at most
    values, counts = often.column("set_id").to_numpy().view(np.uint64), often.column("c").to_numpy()
    by = np.argsort(values)
    frequent = spark.sparkContext.broadcast((values[by], counts[by]))
    kinds = sets.where("found IS NULL AND n > 0").groupBy("set_id").agg(F.first("n").alias("n"), F.first("sig").alias("sig"))

    postings = arrow_map(docs.select("text"), _prefixes(size, percent, frequent), "shingle long, set_id long")
    shared = arrow_map(_blocked(postings, ["shingle"], ["set_id"]), _shared(tile_rows), "tile long, set_id long, large boolean").distinct()
    # A large tile as overlapping bands of size: each set in its own band and in the next one.
    band = _band(F.col("n"), percent)
    parts = F.when(F.col("large"), F.array(F.xxhash64("tile", band), F.xxhash64("tile", band + 1))).otherwise(F.array("tile"))
    tiles = shared.join(kinds, "set_id").select(F.explode(parts).alias("tile"), "n", "set_id", "sig")
    def linked(tiles):
        rows = _blocked(tiles, ["tile"], ["n", "set_id"]).select("tile", "n", "set_id", "sig")
        return connected_components(rows, _tile_forests(percent, tile_rows)).withColumnRenamed("root", "cluster")

    clusters = staged(linked(tiles), "clusters")

    blocks = F.greatest(F.ceil(F.count(F.lit(1)) / block), F.ceil(F.sum("n") * 8 / BLOCK_BYTES)).cast("int")

    def with_sizes(names):
        return names.join(kinds.select(F.col("set_id").alias("node"), "n"), "node").withColumn("band", band)

    sized = with_sizes(clusters)
    coarse = staged(sized.groupBy("cluster").agg(blocks.alias("in_all"), F.max("n").alias("longest"))
                    .where((F.col("in_all") > 1) & (F.col("longest") > WIDE_SET)).select("cluster"), "coarse")
    if coarse.head(1):
        wide = sets.where("found IS NULL AND n > 0").groupBy("set_id").agg(F.first(F.coalesce("wide", "sig")).alias("sig"))
        meets = F.explode(F.array(F.xxhash64("cluster", band), F.xxhash64("cluster", band + 1))).alias("tile")
        tiles = (sized.join(coarse, "cluster").select(meets, "n", F.col("node").alias("set_id")).join(wide, "set_id"))
        clusters = staged(clusters.join(coarse, "cluster", "left_anti").select("node", "cluster").unionByName(linked(tiles)), "clusters")
        sized = with_sizes(clusters)
    per_cluster = sized.groupBy("cluster").agg(blocks.alias("in_all"))
    per_band = sized.groupBy("cluster", "band").agg(blocks.alias("in_band"))
    one = F.col("in_all") == 1
    member = (sized.join(per_cluster, "cluster").join(per_band, ["cluster", "band"])
              .withColumns({"band": F.when(one, 0).otherwise(F.col("band")), "blocks": F.when(one, 1).otherwise(F.col("in_band"))})
              .withColumn("block", F.pmod(F.xxhash64("node"), "blocks").cast("int"))
              .select("cluster", "node", "band", "block", "blocks", (~one).alias("several")))
    arrays = arrow_map(docs.select("text"), _arrays(size, _filter_bits(clusters, "node")), "set_id long, shingles binary")
    member = member.join(arrays, F.col("node") == F.col("set_id"))
    member = staged(member.dropDuplicates(["node"])
                    .select("cluster", "band", "block", "blocks", "several", "set_id", F.length("shingles").alias("n"), "shingles"), "blocks")
    # Each set is in one block, so the components of a block's links are known to its task.
    keys = ["cluster", "band", "block"]
    links = staged(arrow_map(_blocked(member.withColumn("name", F.col("set_id")), keys, ["n", "set_id"]),
                             _block_links(percent, keys), _LINKS), "links")
    roots = links.select(F.col("a").alias("node"), F.col("b").alias("root"), "several")
    split = member.where("several").drop("several")
    if not split.select(F.lit(1)).head(1):
        return roots.drop("several")
    return roots.where("NOT several").drop("several").unionByName(
        _across_blocks(split, roots.where("several").drop("several"), percent, block))


def _across_blocks(member: DataFrame, roots: DataFrame, percent: int, block: int) -> DataFrame:
    """(node, root) over the blocks of each cluster; ``member`` holds the clusters of several blocks, ``roots`` the
    components within blocks.  From here on only roots are linked: a component is one node."""
    def rooted(sets, on, components):
        r = components.select(F.col("node").alias("r_node"), F.col("root").alias("r_root"))
        return sets.join(r, F.col(on) == F.col("r_node"), "left").withColumn(
            "root", F.coalesce("r_root", on)).drop("r_node", "r_root")

    # Up to 8 sets of each block's component of 32 sets or more, a quarter of a block at most; in two of three rounds
    # the samples of a band meet, in the third those of a band and the next one.
    keys = ["cluster", "band", "block"]
    now = staged(rooted(member.drop("shingles"), "set_id", roots), "members")  # the arrays travel once, at the end
    sizes = now.groupBy(*keys, "root").agg(F.count(F.lit(1)).alias("held")).where("held >= 32")
    pick = Window.partitionBy(*keys, "root").orderBy(F.xxhash64("set_id"), "set_id")
    chosen = (now.select(*keys, "root", "set_id").join(sizes, [*keys, "root"])
              .withColumn("k", F.row_number().over(pick)).where("k <= 8")
              .select("set_id", F.col("root").alias("name"), F.pmod("k", F.lit(4)).alias("part")))
    wide = F.col("part") >= 2
    sample = (member.drop("block").join(chosen, "set_id")
              .withColumn("block", F.col("part") * 1_000_000 + F.pmod(F.xxhash64("set_id", F.lit(5)), F.greatest(
                  F.lit(1), F.ceil(F.col("blocks") * 128 / block))))
              .withColumn("band", F.when(wide, F.floor((F.col("band") + F.col("part") - 2) / 2).cast("int")).otherwise(F.col("band"))))
    met = connected_components(_blocked(sample.withColumn("several", F.lit(True)), keys, ["n", "set_id"]), _block_links(percent, keys))
    now = staged(rooted(now, "root", met), "rooted")
    count = now.groupBy("cluster", "root").agg(F.count(F.lit(1)).alias("held"))
    main = count.groupBy("cluster").agg(F.max(F.struct("held", "root")).alias("m")).select("cluster", F.col("m.root").alias("main"))
    now = now.join(main, "cluster")
    outside = now.where("root <> main")
    # Sets outside by zones of bands and blocks within them; all sets of the bands that a zone can link with pass by.
    zone = lambda band: F.floor(band / ZONE).cast("int")
    out_blocks = (outside.groupBy("cluster", zone(F.col("band")).alias("zone"))
                  .agg(F.ceil(F.sum("n") / OUT_BYTES).cast("int").alias("out_blocks")))
    columns = [*_PAIR, "set_id", "root", "outer"]
    band = F.col("band")
    inner = (now.withColumn("zone", F.explode(F.array_distinct(F.array(zone(band - 1), zone(band), zone(band + 1)))))
             .join(out_blocks, ["cluster", "zone"]).withColumn("out_block", F.explode(F.sequence(F.lit(0), F.col("out_blocks") - 1)))
             .withColumn("outer", F.lit(False)).select(columns))
    outer = (outside.withColumn("zone", zone(band)).join(out_blocks, ["cluster", "zone"])
             .withColumn("out_block", F.pmod(F.xxhash64("set_id", F.lit(3)), "out_blocks").cast("int"))
             .withColumn("outer", F.lit(True)).select(columns))
    # One row per set that takes part, with the places it goes to; only then its array, and a row per place.
    places = (inner.unionByName(outer).groupBy("set_id")
              .agg(F.first("root").alias("root"), F.first("cluster").alias("cluster"),
                   F.collect_list(F.struct("zone", "out_block", "outer")).alias("places")))  # bounded by the blocks of three zones
    pairs = (member.select("set_id", "shingles").join(places, "set_id")
             .select("cluster", "set_id", "root", "shingles", F.explode("places").alias("at"))
             .select("cluster", "at.zone", "at.out_block", "set_id", "root", "at.outer", "shingles")
             .repartition(*_PAIR).sortWithinPartitions(*_PAIR, F.desc("outer"), "set_id"))
    last = connected_components(pairs, _outside_links(percent))
    return rooted(now.select(F.col("set_id").alias("node"), "root"), "root", last)


_DESCRIBED = "doc_id long, text_hash long, n int, set_id long, sig binary, wide binary, found long"


def _source(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"),
                       F.xxhash64(text_col).alias("text_hash"))


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE,
                       percent: int = PERCENT, block: int = BLOCK, tile_rows: int = TILE_ROWS) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id."""
    src = _source(docs, id_col, text_col)
    sets = staged(arrow_map(src, _describe(size), _DESCRIBED), "sets")
    roots = set_components(src, sets, size, percent, block, tile_rows)
    rows = sets.where("found IS NULL").select("doc_id", "set_id", F.col("n").cast("long").alias("n_shingles"))
    rows = (rows.join(roots, F.col("set_id") == F.col("node"), "left")
            .withColumn("class", F.coalesce("root", "set_id")).select("doc_id", "n_shingles", "class"))
    least = rows.where("n_shingles > 0").groupBy(F.col("class").alias("l_class")).agg(F.min("doc_id").alias("least"))
    return (rows.join(least, (F.col("class") == F.col("l_class")) & (F.col("n_shingles") > 0), "left")
            .select("doc_id", "n_shingles", F.coalesce("least", "doc_id").alias("component_id")))


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 5,
                percent: int = 80) -> DataFrame:
    """``docs``, all columns, one row of each component: the one with the least id (a missing id last), then text.

    Rows without words stay: they link with nothing.
    """
    names = docs.columns
    d_id, d_hash, d_times = (fresh(names, x) for x in ("_keep_id", "_keep_hash", "_keep_times"))
    src = _source(docs, id_col, text_col)
    sets = staged(arrow_map(src, _describe(size), _DESCRIBED), "sets")
    roots = set_components(src, sets, size, percent, BLOCK)
    rows = (sets.where("found IS NULL AND n > 0").select("doc_id", "text_hash", "set_id")
            .join(roots, F.col("set_id") == F.col("node"), "left").withColumn("class", F.coalesce("root", "set_id")))
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")
    first = rows.groupBy("class").agg(F.min(order).alias("w"))
    times = rows.groupBy("doc_id", "text_hash").agg(F.count(F.lit(1)).alias("times"))
    kept = (first.select(F.col("w.doc_id").alias(d_id), F.col("w.text_hash").alias(d_hash))
            .join(times, F.expr(f"{d_id} <=> doc_id AND {d_hash} = text_hash")).select(d_id, d_hash, F.col("times").alias(d_times)))
    empty = (sets.where("found IS NULL AND n = 0").select(F.col("doc_id").alias(d_id), F.col("text_hash").alias(d_hash))
             .distinct().withColumn(d_times, F.lit(1).cast("long")))
    kept = staged(kept.unionByName(empty), "kept")
    out = docs.join(kept, F.col(id_col).cast("long").eqNullSafe(F.col(d_id)) & (F.xxhash64(F.col(text_col)) == F.col(d_hash)))
    if kept.where(F.col(d_times) > 1).head(1):  # rows that repeat an id with its text
        out = out.where(F.col(d_times) == 1).unionByName(out.where(F.col(d_times) > 1).dropDuplicates([d_id, d_hash]))
    return out.select(*names)
