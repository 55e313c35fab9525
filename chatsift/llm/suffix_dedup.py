"""Suffix-array dedup: every byte covered by a 200-byte string that starts elsewhere too.

Sorting every suffix of a corpus is not needed: a string of ``LENGTH`` bytes is
found through its anchor, the leftmost least hash among the ``GRAM``-byte
strings inside it.  Equal strings have equal anchors at equal places, so only
suffixes that start at anchors are sorted, about one position in seventy.

1. Scan: the anchors of each distinct text; Spark finds the hashes that occur
   at two places or more and packs them in a filter of fixed size.
2. Scan: for such anchors, the bytes around them that their strings span.
   Strings that repeat at a short period inside a text are settled there, and
   only the first of them travels.
3. Groups of equal anchors are ordered by deep-shallow sorting, once by what
   follows the anchor, once by what precedes it, reversed: a multikey pass over
   the first bytes splits most groups; groups that share these go into blind
   tries, whose branching bits give order and common prefix lengths at once.
   Two members have the same string, ``o`` bytes before the anchor, exactly if
   they agree on ``o`` bytes before it and ``LENGTH - o`` from it on, which the
   common prefix lengths tell for all members at once.
4. A group beyond ``GROUP_ROWS`` leaves the task unsorted, string by string, and
   Spark counts those by hash of the string.

Texts are compared as UTF-8; null is empty.  Of equal texts one is searched:
a text found twice is repeated from end to end.
"""

from __future__ import annotations

import hashlib
from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chatsift.llm.common import arrow_map, batches, staged, text_or_empty

LENGTH = 200
GRAM = 64
SHALLOW = 16
GROUP_ROWS = 100_000
BATCH_ROWS = 16_384
FILTER_BITS = 1 << 24
_VALUES = np.random.default_rng(2).integers(1, 1 << 63, 256, np.uint64)


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _rolling(flat: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all strings of ``size`` bytes, a power of two, by doubling."""
    h, length, factor = _VALUES[flat], 1, 0x9E3779B97F4A7C15
    while length < size:
        h = h[:-length] * np.uint64(factor) + h[length:]
        factor = factor * factor & 0xFFFFFFFFFFFFFFFF
        length *= 2
    return _mix(h)


def _sliding(values: np.ndarray, width: int, least) -> np.ndarray:
    """``least`` (np.minimum or np.maximum) over every window of ``width`` values."""
    reach = 1
    while reach * 2 <= width:
        values = least(values[:-reach], values[reach:])
        reach *= 2
    rest = width - reach
    return least(values[:len(values) - rest], values[rest:]) if rest else values


def anchors(flat: np.ndarray, bounds: np.ndarray, length: int = LENGTH, gram: int = GRAM):
    """(text number, anchor position, hash, first and last string start) of the texts ``flat[bounds[i]:bounds[i + 1]]``.

    Every string of ``length`` bytes inside a text belongs to exactly one anchor.
    """
    width = length - gram + 1
    none = np.zeros(0, np.int64)
    if len(flat) < length:
        return none, none, none.astype(np.uint64), none, none
    h = _rolling(flat, gram)
    least = _sliding(h, width, np.minimum)
    pad = np.zeros(width - 1, np.uint64)
    at = np.flatnonzero(h == _sliding(np.concatenate((pad, least, pad)), width, np.maximum))
    hashes = h[at]
    text = np.searchsorted(bounds, at, "right") - 1
    first = np.maximum(at - width + 1, bounds[text])
    last = np.minimum(at, bounds[text + 1] - length)
    # An earlier anchor not above, or a later one below, takes the strings that hold it.
    todo = np.arange(len(at))
    for d in range(1, width):
        todo = todo[(todo >= d)]
        todo = todo[at[todo] - at[todo - d] < width]
        if not len(todo):
            break
        hit = hashes[todo - d] <= hashes[todo]
        first[todo[hit]] = np.maximum(first[todo[hit]], at[todo[hit] - d] + 1)
        todo = todo[~hit]
    todo = np.arange(len(at))
    for d in range(1, width):
        todo = todo[todo + d < len(at)]
        todo = todo[at[todo + d] - at[todo] < width]
        if not len(todo):
            break
        hit = hashes[todo + d] < hashes[todo]
        last[todo[hit]] = np.minimum(last[todo[hit]], at[todo[hit] + d] - width)
        todo = todo[~hit]
    keep = first <= last
    return text[keep], at[keep], hashes[keep], first[keep], last[keep]


def _periodic(flat, text, at, hashes, first, last, length):
    """Anchors all of whose strings repeat those of the anchor before, at the distance of the two."""
    same = np.flatnonzero((hashes[1:] == hashes[:-1]) & (text[1:] == text[:-1])) + 1
    if not len(same):
        return np.zeros(len(at), bool)
    gap = at[same] - at[same - 1]
    # The strings before must exist and belong to that anchor, at the same distances from it.
    same, gap = (x[(gap < length) & (first[same] - gap >= first[same - 1]) & (last[same] - gap <= last[same - 1])]
                 for x in (same, gap))
    out = np.zeros(len(at), bool)
    for lo in range(0, len(same), 4096):
        s, g = same[lo:lo + 4096], gap[lo:lo + 4096]
        span = last[s] + length - first[s]
        step = np.arange(int(span.max()))
        inside = step < span[:, None]
        where = np.where(inside, first[s][:, None] + step, 0)
        out[s] = ((flat[where] == flat[where - np.where(inside, g[:, None], 0)]) | ~inside).all(1)
    return out


def _text_batches(rows: Iterator[pa.RecordBatch]):
    """Distinct texts of a task (as far as remembered), about 1 MB at a time: ids, bytes, bounds."""
    seen: set[int] = set()
    for batch in batches(rows, 512, "text", 1 << 19):
        ids, parts = [], []
        if len(seen) > 500_000:
            seen.clear()
        for tid, text in zip(batch.column("tid").to_pylist(), batch.column("text").to_pylist()):
            if tid not in seen:
                seen.add(tid)
                ids.append(tid)
                parts.append(text.encode("utf-8", "surrogatepass"))
        if ids:
            yield (np.array(ids, np.int64), np.frombuffer(b"".join(parts), np.uint8),
                   np.concatenate(([0], np.cumsum([len(p) for p in parts]))))


def _anchor_rows(length: int, gram: int):
    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, flat, bounds in _text_batches(rows):
            text, at, hashes, first, last = anchors(flat, bounds, length, gram)
            keep = ~_periodic(flat, text, at, hashes, first, last, length)
            place = _mix(ids[text[keep]].view(np.uint64) + (at[keep] - bounds[text[keep]]).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
            yield pa.RecordBatch.from_arrays([pa.array(hashes[keep].view(np.int64)), pa.array(place.view(np.int64))],
                                             names=["h", "place"])
    return run


_CONTEXT = "kind int, h long, tid long, pos long, lo int, hi int, before binary, behind binary"
_CONTEXT_ARROW = pa.schema([("kind", pa.int32()), ("h", pa.int64()), ("tid", pa.int64()), ("pos", pa.int64()),
                            ("lo", pa.int32()), ("hi", pa.int32()), ("before", pa.binary()), ("behind", pa.binary())])


def _context_rows(length: int, gram: int, wanted):
    """Kind 0: an anchor, offsets lo..hi of its strings, the bytes before it and from it on.  Kind 1: a repeated span."""
    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.frombuffer(wanted.value, np.uint8)
        for ids, flat, bounds in _text_batches(rows):
            text, at, hashes, first, last = anchors(flat, bounds, length, gram)
            period = _periodic(flat, text, at, hashes, first, last, length)
            spans = np.flatnonzero(period)
            if len(spans):
                start = bounds[text[spans]]
                gap = at[spans] - at[spans - 1]
                lo, hi = first[spans] - gap - start, last[spans] + length - start
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.ones(len(spans), np.int32)), pa.array(_mix(ids[text[spans]].view(np.uint64)).view(np.int64)),
                    pa.array(ids[text[spans]]), pa.array(lo), pa.array(np.zeros(len(spans), np.int32)),
                    pa.array((hi - lo).astype(np.int32)), pa.nulls(len(spans), pa.binary()),
                    pa.nulls(len(spans), pa.binary())], schema=_CONTEXT_ARROW)
            bit = (hashes % np.uint64(FILTER_BITS)).astype(np.int64)
            keep = np.flatnonzero(~period & ((bits[bit >> 3] >> (bit & 7)) & 1).astype(bool))
            raw = flat.tobytes()
            a, f, l = at[keep], first[keep], last[keep]
            yield pa.RecordBatch.from_arrays([
                pa.array(np.zeros(len(keep), np.int32)), pa.array(hashes[keep].view(np.int64)), pa.array(ids[text[keep]]),
                pa.array(a - bounds[text[keep]]), pa.array((a - l).astype(np.int32)), pa.array((a - f).astype(np.int32)),
                pa.array([raw[x:y] for x, y in zip(f.tolist(), a.tolist())], pa.binary()),
                pa.array([raw[y:z] for y, z in zip(a.tolist(), (l + length).tolist())], pa.binary())],
                schema=_CONTEXT_ARROW)
    return run


# ------------------------------------------------------- deep-shallow sorting ---

class BlindTrie:
    """Strings of one width as a Patricia trie that holds branching bits only.

    A string is led down by its bits at the branches alone ("blind"); one
    comparison with the string found there gives the bit where they part.
    """

    def __init__(self, width: int):
        self.bits = 8 * width
        self.root = None  # a leaf [value, members] or a branch (bit, zero, one) as a list

    def add(self, value: int, member: int) -> None:
        if self.root is None:
            self.root = [value, [member]]
            return
        top = self.bits - 1
        node = self.root
        while len(node) == 3:
            node = node[1 + (value >> (top - node[0]) & 1)]
        parting = value ^ node[0]
        if not parting:
            node[1].append(member)
            return
        bit = self.bits - parting.bit_length()
        above, side, node = None, 0, self.root
        while len(node) == 3 and node[0] < bit:
            above, side = node, 1 + (value >> (top - node[0]) & 1)
            node = node[side]
        leaf = [value, [member]]
        one = value >> (top - bit) & 1
        branch = [bit, node, leaf] if one else [bit, leaf, node]
        if above is None:
            self.root = branch
        else:
            above[side] = branch

    def order(self) -> tuple[list[int], list[int]]:
        """Members in order of their strings, and the bytes each shares with the one before (-1 for the first)."""
        members, shared, todo, common = [], [], [self.root], -1
        while todo:
            node = todo.pop()
            if isinstance(node, int):
                common = node
            elif len(node) == 3:
                todo += [node[2], node[0] // 8, node[1]]
            else:
                members += node[1]
                shared += [common] + [self.bits // 8] * (len(node[1]) - 1)
        return members, shared


def deep_shallow(rows: np.ndarray, group: np.ndarray, skip: int, shallow: int = SHALLOW) -> tuple[np.ndarray, np.ndarray]:
    """Rows (k x width bytes) in order within each group; (order, bytes shared with the row before, -1 at a group's start).

    All rows of a group agree on their first ``skip`` bytes.  ``group`` is ascending.
    """
    k, width = rows.shape
    depth = min(width, skip + shallow)
    # Multikey pass: 8-byte keys from ``skip`` on, groups refined key by key.
    keys = np.zeros((k, -(-(depth - skip) // 8) * 8), np.uint8)
    keys[:, :depth - skip] = rows[:, skip:depth]
    words = keys.view(">u8").astype(np.uint64)
    order = np.lexsort([words[:, w] for w in range(words.shape[1])[::-1]] + [group])
    ranked = words[order]
    new_group = np.concatenate(([True], group[order][1:] != group[order][:-1]))
    differs = np.zeros(k, bool)
    shared = np.full(k, depth, np.int64)
    for w in range(words.shape[1] - 1, -1, -1):
        other = np.concatenate(([True], ranked[1:, w] != ranked[:-1, w]))
        parting = np.zeros(k, np.uint64)
        parting[1:] = ranked[1:, w] ^ ranked[:-1, w]
        same_bytes = np.zeros(k, np.int64)
        for b in range(8):
            same_bytes += (parting >> np.uint64(8 * (7 - b)) == 0)
        shared = np.where(other, skip + 8 * w + same_bytes, shared)
        differs |= other
    shared = np.minimum(shared, depth)
    shared[new_group] = -1
    if depth == width:
        return order, shared
    # Deep: rows that the shallow keys leave together go through a blind trie.
    starts = np.flatnonzero(differs | new_group)
    ends = np.append(starts[1:], k)
    for lo, hi in zip(starts.tolist(), ends.tolist()):
        if hi - lo < 2:
            continue
        trie = BlindTrie(width - depth)
        for i in order[lo:hi].tolist():
            trie.add(int.from_bytes(rows[i, depth:].tobytes()), i)
        members, common = trie.order()
        order[lo:hi] = members
        shared[lo + 1:hi] = np.array(common[1:], np.int64) + depth
    return order, shared


def repeated_offsets(group, lo, hi, before: list[bytes], behind: list[bytes], length: int = LENGTH, gram: int = GRAM) -> np.ndarray:
    """For members of groups of equal anchors (``group`` ascending): k x offsets, whether the string there has a twin."""
    k, widest = len(group), length - gram + 1
    left = np.zeros((k, max(1, widest - 1)), np.uint8)
    right = np.zeros((k, length), np.uint8)
    for i, (b, a) in enumerate(zip(before, behind)):
        left[i, :len(b)] = np.frombuffer(b, np.uint8)[::-1]
        right[i, :len(a)] = np.frombuffer(a, np.uint8)
    # Anchors are equal by hash so far: make them equal by bytes.
    start = np.concatenate(([True], group[1:] != group[:-1]))
    head = np.maximum.accumulate(np.where(start, np.arange(k), 0))
    if (right[:, :gram] != right[head, :gram]).any():
        _, kinds = np.unique(np.concatenate((group.astype(">u8").view(np.uint8).reshape(k, 8), right[:, :gram]), 1), axis=0, return_inverse=True)
        by = np.argsort(kinds.ravel(), kind="stable")
        out = np.zeros((k, widest), bool)
        out[by] = repeated_offsets(kinds.ravel()[by].astype(np.uint64), lo[by], hi[by], [before[i] for i in by], [behind[i] for i in by], length, gram)
        return out
    r_order, r_shared = deep_shallow(right, group, gram)
    l_order, l_shared = deep_shallow(left, group, 0)
    out = np.zeros((k, widest), bool)
    r_class, l_class = np.empty(k, np.int64), np.empty(k, np.int64)
    for o in range(widest):
        mine = np.flatnonzero((lo <= o) & (o <= hi))
        if len(mine) < 2:
            continue
        r_class[r_order] = np.cumsum(r_shared < length - o)
        l_class[l_order] = np.cumsum(l_shared < o)
        key = r_class[mine] * np.int64(k + 1) + l_class[mine]
        by = np.argsort(key)
        ranked = key[by]
        twin = np.zeros(len(mine), bool)
        equal = ranked[1:] == ranked[:-1]
        twin[1:] |= equal
        twin[:-1] |= equal
        out[mine[by], o] = twin
    return out


_FOUND = "kind int, tid long, start long, stop long, pos long, lo int, hi int, before binary, behind binary"
_FOUND_ARROW = pa.schema([("kind", pa.int32()), ("tid", pa.int64()), ("start", pa.int64()), ("stop", pa.int64()),
                          ("pos", pa.int64()), ("lo", pa.int32()), ("hi", pa.int32()), ("before", pa.binary()),
                          ("behind", pa.binary())])


def _found_spans(tid, start, stop) -> pa.RecordBatch:
    n = len(tid)
    return pa.RecordBatch.from_arrays([
        pa.array(np.zeros(n, np.int32)), pa.array(np.asarray(tid, np.int64)), pa.array(np.asarray(start, np.int64)),
        pa.array(np.asarray(stop, np.int64)), pa.nulls(n, pa.int64()), pa.nulls(n, pa.int32()), pa.nulls(n, pa.int32()),
        pa.nulls(n, pa.binary()), pa.nulls(n, pa.binary())], schema=_FOUND_ARROW)


def _group_spans(length: int, gram: int, group_rows: int):
    """From contexts sorted by (h, tid, pos): repeated spans (kind 0) and the members of oversize groups (kind 1)."""
    def solve(held: pa.Table) -> pa.RecordBatch:
        h, tid, pos = (held.column(c).to_numpy() for c in ("h", "tid", "pos"))
        fresh = np.concatenate(([True], (h[1:] != h[:-1]) | (tid[1:] != tid[:-1]) | (pos[1:] != pos[:-1])))
        start = np.concatenate(([True], (h[1:] != h[:-1])))
        count = np.add.reduceat(fresh.astype(np.int64), np.flatnonzero(start))
        keep = np.flatnonzero(fresh & (count[np.cumsum(start) - 1] > 1))
        if not len(keep):
            return _found_spans([], [], [])
        held = held.take(pa.array(keep))
        lo, hi = held.column("lo").to_numpy(), held.column("hi").to_numpy()
        tid, pos = tid[keep], pos[keep]
        twin = repeated_offsets(np.cumsum(start)[keep].astype(np.uint64), lo, hi, held.column("before").to_pylist(),
                                held.column("behind").to_pylist(), length, gram)
        edge = np.diff(np.pad(twin, ((0, 0), (1, 1))).astype(np.int8), axis=1)
        row, o1 = np.nonzero(edge == 1)
        _, o2 = np.nonzero(edge == -1)  # one past the last offset of the run
        return _found_spans(tid[row], pos[row] - (o2 - 1), pos[row] - o1 + length)

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        n_held, passing = 0, None  # passing: the hash of an oversize group under way

        def out_of(table: pa.Table) -> pa.RecordBatch:
            n = table.num_rows
            get = lambda c: table.column(c).combine_chunks()
            return pa.RecordBatch.from_arrays([
                pa.array(np.ones(n, np.int32)), get("tid"), pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64()), get("pos"),
                get("lo"), get("hi"), get("before"), get("behind")], schema=_FOUND_ARROW)

        for batch in batches(rows, BATCH_ROWS):
            kind = batch.column("kind").to_numpy()
            if kind.any():
                spans = batch.filter(pa.array(kind == 1))
                start = spans.column("pos").to_numpy()
                yield _found_spans(spans.column("tid").to_numpy(), start, start + spans.column("hi").to_numpy())
                batch = batch.filter(pa.array(kind == 0))
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch])
            h = table.column("h").to_numpy()
            if passing is not None:
                n_pass = int(np.searchsorted(h != passing, True)) if (h != passing).any() else len(h)
                if h[0] == passing:
                    yield out_of(table.slice(0, n_pass))
                    table, h = table.slice(n_pass), h[n_pass:]
                if not len(h):
                    continue
                passing = None
            held.append(table)
            n_held += len(h)
            if n_held < BATCH_ROWS:
                continue
            joined = pa.concat_tables(held)
            h = joined.column("h").to_numpy()
            tail = int((h == h[-1]).sum())  # sorted: the group that may go on
            if len(h) > tail:
                yield solve(joined.slice(0, len(h) - tail).combine_chunks())
            rest = joined.slice(len(h) - tail)
            if tail > group_rows:
                passing = h[-1]
                yield out_of(rest)
                held, n_held = [], 0
            else:
                held, n_held = [rest], tail
        if n_held:
            yield solve(pa.concat_tables(held).combine_chunks())
    return run


def _strings(length: int):
    """From members of oversize groups: the two hashes of each of their strings."""
    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(rows, 1024):
            keys, tids, starts = [], [], []
            for tid, pos, lo, hi, before, behind in zip(*(batch.column(c).to_pylist() for c in (
                    "tid", "pos", "lo", "hi", "before", "behind"))):
                text = before + behind
                for o in range(lo, hi + 1):
                    at = len(before) - o
                    keys.append(hashlib.md5(text[at:at + length]).digest())
                    tids.append(tid)
                    starts.append(pos - o)
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(tids, pa.int64()),
                                              pa.array(starts, pa.int64())], names=["string", "tid", "start"])
    return run


def _cut_texts(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows with their spans: what goes and what stays."""
    for batch in batches(rows, 512, "text", 1 << 20):
        out = []
        for doc_id, text, spans, times, length in zip(*(batch.column(c).to_pylist() for c in (
                "doc_id", "text", "spans", "times", "length"))):
            raw = text.encode("utf-8", "surrogatepass")
            if times > 1 and len(raw) >= length:
                spans = [{"start": 0, "stop": len(raw)}]
            merged: list[list[int]] = []
            for s in sorted((x["start"], x["stop"]) for x in spans or ()):
                if merged and s[0] <= merged[-1][1]:
                    merged[-1][1] = max(merged[-1][1], s[1])
                else:
                    merged.append(list(s))
            at, kept = 0, []
            for lo, hi in merged:
                kept.append(raw[at:lo])
                at = hi
            kept.append(raw[at:])
            out.append((doc_id, len(raw), sum(hi - lo for lo, hi in merged), len(merged),
                        hashlib.sha256(b"".join(kept)).hexdigest(), b"".join(kept)))
        columns = list(zip(*out)) or [[] for _ in range(6)]
        types = [pa.int64()] * 4 + [pa.string(), pa.binary()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)],
                                         names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])


def repeated_spans(texts: DataFrame, length: int = LENGTH, gram: int = GRAM, group_rows: int = GROUP_ROWS) -> DataFrame:
    """(tid, spans) of the distinct texts (tid, text) that hold a repeated string of ``length`` bytes."""
    if length < gram or gram & (gram - 1):
        raise ValueError("the anchor's length is a power of two and at most the string's")
    spark = texts.sparkSession
    long = texts.where(F.octet_length("text") >= length)
    twice = (arrow_map(long, _anchor_rows(length, gram), "h long, place long").groupBy("h")
             .agg(F.min("place").alias("a"), F.max("place").alias("b")).where("a <> b"))
    words = (twice.groupBy(F.floor(F.pmod("h", F.lit(FILTER_BITS)) / 32).cast("int").alias("w"))
             .agg(F.bit_or(F.expr("shiftleft(1L, cast(pmod(h, 32) as int))")).alias("m"))).toArrow()  # FILTER_BITS / 32 rows at most
    bits = np.zeros(FILTER_BITS // 32, np.uint32)
    bits[words.column("w").to_numpy()] = words.column("m").to_numpy().astype(np.uint32)
    wanted = spark.sparkContext.broadcast(bits.tobytes())
    contexts = (arrow_map(long, _context_rows(length, gram, wanted), _CONTEXT)
                .repartition("h").sortWithinPartitions("h", "tid", "pos"))
    found = staged(arrow_map(contexts, _group_spans(length, gram, group_rows), _FOUND), "spans")
    spans = found.where("kind = 0").select("tid", "start", "stop")
    if found.where("kind = 1").head(1):
        strings = staged(arrow_map(found.where("kind = 1"), _strings(length), "string binary, tid long, start long").distinct(), "strings")
        many = strings.groupBy("string").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("string")
        spans = spans.unionByName(strings.join(many, "string", "left_semi")
                                  .select("tid", "start", (F.col("start") + length).alias("stop")))
    # The spans of one text: no more than its anchors and strings.
    return spans.groupBy("tid").agg(F.collect_list(F.struct("start", "stop")).alias("spans"))


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH,
                   gram: int = GRAM, group_rows: int = GROUP_ROWS) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept (the remaining bytes).

    A text is named by a 64-bit hash.
    """
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text"))
    src = src.withColumn("tid", F.xxhash64("text"))
    spans = repeated_spans(src.select("tid", "text"), length, gram, group_rows).withColumnRenamed("tid", "s_tid")
    times = src.groupBy("tid").agg(F.count(F.lit(1)).alias("times")).where("times > 1").withColumnRenamed("tid", "t_tid")
    marks = spans.join(times, F.col("s_tid") == F.col("t_tid"), "full_outer").select(
        F.coalesce("s_tid", "t_tid").alias("m_tid"), F.when(F.col("times").isNull(), F.col("spans")).alias("spans"), "times")
    joined = src.join(marks, F.col("tid") == F.col("m_tid"), "left")
    return arrow_map(joined.select("doc_id", "text", "spans", F.coalesce("times", F.lit(1)).alias("times"),
                                   F.lit(length).alias("length")), _cut_texts,
                     "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")
