"""Packing by vector bin packing with the dot-product heuristic.

Every example is a vector: tokens, segments (1) and loss-bearing tokens.  An
open sequence takes the example whose vector has the largest dot product with
what the sequence has left in each dimension (both as shares of the limits), so
long examples go where tokens are left and short ones where segments are left.
Where the best example does not fit whole, it is cut at the sequence's room.

Each scan task packs its own rows from a bounded pool and emits sequences as
they fill; nothing is shuffled.  The last sequences of a task are cut at powers
of two, which need no padding.  Sequence ids are the task's number and a count
in it.

Null texts are empty and have the closing id alone.  Rows may repeat an id.
"""

from __future__ import annotations

import json
import zlib
from dataclasses import dataclass
from functools import lru_cache
from typing import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chatsift.llm.common import arrow_map, batches, kept

POOL_ITEMS = 512
POOL_TOKENS = 1 << 20
MEMO_WORDS = 300_000
KEEPS = "word tokens"
PUNCTUATION = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
_PIECE = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, "
          "loss_tokens long")
_PIECE_ARROW = pa.schema([(c.split()[0], pa.int64()) for c in _PIECE.split(", ")])


@dataclass(frozen=True)
class Limits:
    """What one sequence may hold.  ``segments`` should be a power of two: single-token rows then pad nothing."""

    tokens: int = 4096
    segments: int = 256
    loss: int = 4096


class _Item:
    __slots__ = ("doc_id", "ids", "loss", "start")

    def __init__(self, doc_id, ids: np.ndarray, loss: np.ndarray | None):
        self.doc_id, self.ids, self.loss, self.start = doc_id, ids, loss, 0


class Packer:
    """Packs items into sequences; ``out`` gathers piece rows."""

    def __init__(self, limits: Limits, task: int):
        self.limits, self.task, self.count = limits, task, 0
        self.pool: list[_Item] = []
        self.tokens = 0
        self.out: list[tuple] = []

    def add(self, item: _Item) -> None:
        self.pool.append(item)
        self.tokens += len(item.ids)
        if len(self.pool) >= POOL_ITEMS or self.tokens >= POOL_TOKENS:
            self.drain(False)

    def _left(self, pool: list[_Item]) -> tuple[np.ndarray, np.ndarray]:
        n = np.array([len(x.ids) - x.start for x in pool], np.int64)
        loss = np.array([len(x.ids) - x.start if x.loss is None else int(x.loss[x.start:].sum()) for x in pool], np.int64)
        return n, loss

    def drain(self, final: bool) -> None:
        """Closes full sequences while the pool can fill one; at the end, everything."""
        lim, pool = self.limits, self.pool
        n, loss = self._left(pool)
        while len(pool) and n.sum() > 0 and (final or n.sum() >= lim.tokens):
            if not final and len(pool) > lim.segments and np.sort(n)[::-1][: lim.segments].sum() < lim.tokens:
                # Too many short rows for a full sequence: wait for longer ones unless the pool is large.
                if len(pool) < 4 * POOL_ITEMS:
                    break
            room = np.array([lim.tokens, lim.segments, lim.loss], np.int64)
            caps = room.astype(np.float64)
            alive = n > 0
            pieces: list[tuple[int, int]] = []
            while room.min() > 0 and alive.any():
                share = room / caps
                score = (np.minimum(n, room[0]) / caps[0]) * share[0] + share[1] / caps[1] + (
                    np.minimum(loss, room[2]) / caps[2]) * share[2]
                best = int(np.where(alive, score, -1.0).argmax())
                take = int(min(n[best], room[0]))
                item = pool[best]
                taken_loss = take if item.loss is None else int(item.loss[item.start:item.start + take].sum())
                if taken_loss > room[2]:  # cut where the loss limit is met
                    take = int(np.searchsorted(np.cumsum(item.loss[item.start:item.start + take]), room[2], "right")
                               if item.loss is not None else room[2])
                    taken_loss = int(room[2])
                    if take == 0:
                        alive[best] = False
                        continue
                pieces.append((best, take))
                room -= (take, 1, taken_loss)
                n[best] -= take
                loss[best] -= taken_loss
                item.start += take
                alive[best] = False  # one piece of a row a sequence
            self._close(pool, pieces)
            keep = n > 0
            if not keep.all():
                pool[:] = [x for x, k in zip(pool, keep) if k]
                n, loss = n[keep], loss[keep]
        self.tokens = int(n.sum()) if len(pool) else 0

    def _close(self, pool: list[_Item], pieces: list[tuple[int, int]]) -> None:
        """Writes one sequence, or, where it is not full, sequences of power-of-two lengths."""
        total, done = sum(t for _, t in pieces), 0
        parts = [(pool[i], pool[i].start - t, t) for i, t in pieces]
        sizes = [total] if total == self.limits.tokens else [1 << b for b in range(total.bit_length())[::-1] if total >> b & 1]
        at = 0
        for size in sizes:
            room = size
            while room:
                item, start, length = parts[at]
                take = min(room, length)
                ids = item.ids[start:start + take]
                bearing = take if item.loss is None else int(item.loss[start:start + take].sum())
                self.out.append((item.doc_id, start, take, zlib.crc32(ids.tobytes()), len(item.ids),
                                 self.task << 40 | self.count, size - room, bearing))
                room -= take
                if take == length:
                    at += 1
                else:
                    parts[at] = (item, start + take, length - take)
            self.count += 1
            done += size

    def rows(self) -> pa.RecordBatch:
        columns = list(zip(*self.out)) or [[] for _ in _PIECE_ARROW]
        self.out = []
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], schema=_PIECE_ARROW)


@lru_cache(maxsize=1)
def _byte_of_char() -> dict[str, int]:
    """Byte-level vocabularies write printable Latin-1 as it is and the other bytes, in order, from U+0100 on."""
    plain = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xFF and b != 0xAD]
    other = sorted(set(range(256)).difference(plain))
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(other)}


def _token_bytes(token: str) -> bytes:
    """A token's bytes, with NUL for the end-of-word mark."""
    body = token.removesuffix("</w>")
    return bytes(map(_byte_of_char().__getitem__, body)) + b"\0" * (body != token)


class WordTokens:
    """Ids of whole texts from ids of their blank-separated words, which repeat.

    Right for a tokenizer that drops white space and splits at it before all
    else, as the normaliser and splitter of ``word_bpe_49k`` do.  Texts with a NUL
    or one of the four characters on which Python and the tokenizer disagree
    about white space are encoded whole.

    A run of letters, a run of punctuation and a digit are a piece each.  So the
    pieces of words of letters with punctuation behind, and of numbers, are known
    beforehand; they are encoded many at a time by ``tiktoken`` with the same
    vocabulary, which merges by the same ranks several times faster.  There a NUL
    behind each piece plays the end-of-word mark.  Every token encodes to itself
    alone, so both merge alike (tested); all other words go through the tokenizer.
    """

    ODD = "\x00\x1c\x1d\x1e\x1f"
    GROUP = 4000

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.memo, self.older = {}, {}  # two generations: frequent words outlive the turn
        with open(path, encoding="utf-8") as f:
            vocabulary = json.load(f)["model"]["vocab"]
        ranks = {_token_bytes(token): i for token, i in vocabulary.items()}
        self.merger = tiktoken.Encoding("words", pat_str=r"[^\x00]+\x00", mergeable_ranks=ranks, special_tokens={})
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True

    @staticmethod
    def _pieces(word: str) -> tuple[str, ...]:
        """Pieces of a word where they are certain, else none: other letters may fall apart when normalised."""
        if not word.isascii() and max(word) >= "\u0130":
            return ()
        letters = word.rstrip(PUNCTUATION)
        if letters.isalpha() or not letters:
            return tuple(p for p in (letters.lower(), word[len(letters):]) if p)
        return tuple(word) if word.isascii() and word.isdigit() else ()

    def _learn(self, words: list[str]) -> None:
        plain, mixed = [], []
        for w in words:
            (plain if w.isalpha() and (w.isascii() or max(w) < "\u0130") else mixed).append(w)
        for lo in range(0, len(plain), self.GROUP):  # one piece a word
            group = plain[lo:lo + self.GROUP]
            self._keep(group, "\0".join(group).lower() + "\0", slice(None))
        known = [(w, p) for w in mixed if (p := self._pieces(w))]
        for lo in range(0, len(known), self.GROUP):
            group, pieces = zip(*known[lo:lo + self.GROUP])
            self._keep(group, "".join([c + "\0" for p in pieces for c in p]), np.cumsum([len(p) for p in pieces]) - 1)
        rest = [w for w in mixed if w not in self.memo]
        for w, e in zip(rest, self.tokenizer.encode_batch(rest, add_special_tokens=False)):
            self.memo[w] = np.array(e.ids, "<u4").tobytes()

    def _keep(self, group: Sequence[str], marked: str, last) -> None:
        """Remembers the words of a group; ``last`` picks the last piece of each among all pieces."""
        ids = np.array(self.merger.encode_ordinary(marked), "<u4")
        stops = (4 * (np.flatnonzero(self.ends[ids])[last] + 1)).tolist()
        raw = ids.tobytes()
        self.memo.update(zip(group, [raw[a:b] for a, b in zip([0] + stops, stops)]))

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        if len(self.memo) > MEMO_WORDS:
            self.memo, self.older = {}, self.memo
        memo, older, out = self.memo, self.older, []
        odd = {i for i, t in enumerate(texts) if any(c in t for c in self.ODD)}
        words = [[] if i in odd else (t.lower() if t.isascii() else t).split() for i, t in enumerate(texts)]
        fresh = set().union(*words).difference(memo)
        if older:
            memo.update({w: older[w] for w in fresh if w in older})
            fresh.difference_update(memo)
        self._learn(list(fresh))
        for i, ws in enumerate(words):
            if i in odd:
                out.append(np.array(self.tokenizer.encode(texts[i], add_special_tokens=False).ids, "<u4"))
            else:
                out.append(np.frombuffer(b"".join([memo[w] for w in ws]), "<u4"))
        return out


def pack_texts(docs: DataFrame, tokenizer_path: str | Callable[[], str], limits: Limits = Limits(), end_id: int = 2,
               id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Whole texts as ids, closed by ``end_id``, packed: one row per piece.  All ids bear loss.

    ``tokenizer_path`` is a path that every worker can read, or a function that
    gives it on the worker.
    """
    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path = tokenizer_path() if callable(tokenizer_path) else tokenizer_path
        tables = kept(KEEPS, dict)  # tables and remembered words serve all packing tasks of a worker
        tokens = tables[path] if path in tables else tables.setdefault(path, WordTokens(path))
        packer = Packer(limits, TaskContext.get().partitionId())
        for batch in batches(rows, 256, "text", 1 << 20):
            texts = [t or "" for t in batch.column("text").to_pylist()]
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), tokens.encode(texts)):
                packer.add(_Item(doc_id, np.append(ids, np.uint32(end_id)).astype("<u4"), None))
            yield packer.rows()
        packer.drain(True)
        yield packer.rows()

    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return arrow_map(src, run, _PIECE, KEEPS)


def pack_examples(examples: DataFrame, limits: Limits = Limits(), id_col: str = "doc_id", ids_col: str = "ids",
                  loss_col: str = "loss_mask") -> DataFrame:
    """Tokenised examples (array<int> ids, array<int> 0/1 loss mask of the same length, null: all) packed."""
    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = Packer(limits, TaskContext.get().partitionId())
        for batch in batches(rows, 256):
            for doc_id, ids, mask in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "ids", "mask"))):
                if ids:
                    packer.add(_Item(doc_id, np.array(ids, "<u4"), None if mask is None else np.array(mask, np.int64)))
            yield packer.rows()
        packer.drain(True)
        yield packer.rows()

    src = examples.select(F.col(id_col).cast("long").alias("doc_id"), F.col(ids_col).cast("array<int>").alias("ids"),
                          F.col(loss_col).cast("array<int>").alias("mask"))
    return arrow_map(src, run, _PIECE)
