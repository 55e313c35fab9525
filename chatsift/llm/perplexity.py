"""Quality rules by n-gram perplexity: a modified Kneser-Ney model and bands per language.

Units are the UTF-8 bytes of a text's words joined by one blank, so an n-gram of
the default order 5 is a 40-bit number and the model covers any script.

* Counting: every task counts the n-grams of its rows by sorting and sends
  (language, n-gram, count); Spark sums them over all documents.
* Estimation is joins and aggregates of those counts: continuation counts for
  the lower orders, three discounts an order from counts of counts, back-off
  weights, interpolated probabilities.
* The model is a table of 64-bit hashes of (order, language, n-gram) with log
  probability and log back-off, sorted by hash.  Up to ``MAX_BROADCAST`` entries,
  measured before, it travels as two sorted arrays to every worker; beyond it,
  distinct n-grams of each row are joined with it instead.
* Bands: a row's log perplexity is compared with those of its language and
  length class (median and spread over the different texts, so copies count
  once); outside ``median -/+ width x spread`` it is rejected.  Classes of few
  texts take median and spread from their language, languages of few texts from
  all texts, and no spread falls below what is usual for texts of that length.

Null texts have no words, a null language is a language of its own.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chatsift.llm.common import arrow_map, batches, split_words, staged

ORDER = 5
MAX_BROADCAST = 4_000_000  # entries of 16 bytes: 64 MB a worker
WINDOW = 8
BAND_LOW, BAND_HIGH = 3.5, 1.75  # best F1 against labels that may be learned from, see README
BIN = 1e-3  # width of the histogram's bins of log perplexity
LOG_BIN = 0.01  # the same for the logarithm of distances times the root of the length
MIN_TEXTS = 20  # different texts that a class or language needs for a median of its own
FLOOR = 1.0  # least spread, as a multiple of what is usual for the length
_MASK = [(1 << (8 * k)) - 1 for k in range(9)]


# ---------------------------------------------------------------- base rules ---

def repeated_words(ids: np.ndarray, window: int = WINDOW) -> int:
    """Words inside windows of ``window`` words that the text holds twice or more."""
    n = len(ids) - window + 1
    if n < 2:
        return 0
    code = np.zeros(n, np.uint64)
    mixed = (ids.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    mixed ^= mixed >> np.uint64(29)
    for k in range(window):
        code = code * np.uint64(0xD1342543DE82EF95) + mixed[k:k + n]
    order = np.argsort(code, kind="stable")
    ranked = code[order]
    near = np.flatnonzero(ranked[1:] == ranked[:-1])
    if not len(near):
        return 0
    maybe = np.unique(np.concatenate((order[near], order[near + 1])))
    views = np.lib.stride_tricks.sliding_window_view(ids, window)[maybe]  # exact, on what hashes alike
    _, where, counts = np.unique(views, axis=0, return_inverse=True, return_counts=True)
    starts = maybe[counts[where.ravel()] > 1]
    edge = np.zeros(len(ids) + 1, np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + window, -1)
    return int((np.cumsum(edge)[:-1] > 0).sum())


def base_rules(text: str, words: list[bytes], ids: np.ndarray) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of a whole text."""
    seen, dups = set(), 0
    for line in text.split("\n"):
        if line in seen:
            dups += 1
        elif split_words(line):
            seen.add(line)
    blanks = sum(text.count(c) for c in " \t\n\x0b\x0c\r")
    return (len(words), len(text) - blanks, sum(text.count(c) for c in "#*$%&|<>"), dups, repeated_words(ids))


# --------------------------------------------------------------------- n-grams ---

def _units(words: list[bytes], order: int) -> bytes:
    """Bytes of a text for n-grams: blanks before it so that the first byte has a context."""
    return b" " * (order - 1) + b" ".join(words)


def _grams(joined: np.ndarray, order: int) -> np.ndarray:
    """n-gram numbers ending at each byte from ``order`` - 1 on."""
    n = len(joined) - order + 1
    code = np.zeros(max(0, n), np.uint64)
    for k in range(order):
        code = (code << np.uint64(8)) | joined[k:k + len(code)].astype(np.uint64)
    return code


def language_key(lang: str | None) -> int:
    return xxhash.xxh3_64_intdigest("\0" if lang is None else "l" + lang)


def entry_hash(gram: np.ndarray, order: int, lang: int) -> np.ndarray:
    """64-bit hash of (order, language, n-gram): a bijection of the number for each order and language."""
    h = gram ^ np.uint64((lang + order * 0x9E3779B97F4A7C15) & 0xFFFFFFFFFFFFFFFF)
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _counter(order: int):
    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str | None, tuple[np.ndarray, np.ndarray]] = {}

        def merged(lang, grams, counts):
            if lang in held:
                grams = np.concatenate((held[lang][0], grams))
                counts = np.concatenate((held[lang][1], counts))
                by = np.argsort(grams, kind="stable")
                grams, counts = grams[by], counts[by]
                first = np.concatenate(([True], grams[1:] != grams[:-1]))
                grams, counts = grams[first], np.add.reduceat(counts, np.flatnonzero(first))
            held[lang] = grams, counts

        def flush(langs):
            for lang in langs:
                grams, counts = held.pop(lang)
                yield pa.RecordBatch.from_arrays([
                    pa.array([lang] * len(grams), pa.string()), pa.array(grams.astype(np.int64)), pa.array(counts)],
                    names=["lang", "gram", "n"])

        for batch in batches(rows, 2048, "text", 4 << 20):
            texts: dict[str | None, list[bytes]] = {}
            for text, lang in zip(batch.column("text").to_pylist(), batch.column("lang").to_pylist()):
                words = split_words(text or "")
                if words:
                    texts.setdefault(lang, []).append(_units(words, order))
            for lang, units in texts.items():
                joined = np.frombuffer(b"".join(units), np.uint8)
                ends = np.cumsum([len(u) for u in units])
                grams = _grams(joined, order)
                inside = np.ones(len(grams), bool)
                for k in range(1, order):  # n-grams across two texts
                    at = ends[:-1] - k
                    inside[at[(at >= 0) & (at < len(grams))]] = False
                merged(lang, *np.unique(grams[inside], return_counts=True))
            if sum(len(g) for g, _ in held.values()) > 4_000_000:  # bounds the task; sums meet in the shuffle
                yield from flush(list(held))
        yield from flush(list(held))
    return run


def count_grams(docs: DataFrame, order: int = ORDER) -> DataFrame:
    """(lang, gram, n) of the highest order over all rows of ``docs`` (text, lang)."""
    counted = arrow_map(docs.select("text", "lang"), _counter(order), "lang string, gram long, n long")
    return counted.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def estimate(counts: DataFrame, order: int = ORDER) -> list[DataFrame]:
    """Tables (lang, gram, p, backoff) for orders 0 to ``order``: interpolated probability, weight of the n-gram as a context.

    All orders are counted, discounted and weighed together (``k`` is the order);
    only the probabilities, which need those one order below, go order by order.
    """
    # In how many ways an n-gram of a lower order is preceded: the different n-grams one byte longer that end in it.
    ends = F.explode(F.array(*[F.struct(F.lit(k).alias("k"), F.col("gram").bitwiseAND(_MASK[k + 1]).alias("wide"))
                               for k in range(1, order)])) if order > 1 else None
    every = counts.select("lang", F.lit(order).alias("k"), "gram", "n")
    if ends is not None:
        wide = counts.select("lang", ends.alias("e")).select("lang", "e.k", "e.wide").distinct()
        every = every.unionByName(wide.groupBy("lang", "k", F.col("wide").bitwiseAND(F.expr("shiftleft(1L, 8 * k) - 1")).alias("gram"))
                                  .agg(F.count(F.lit(1)).alias("n")))
    every = staged(every, "kn-counts")
    of_counts = every.groupBy("lang", "k").agg(*[F.sum((F.col("n") == c).cast("double")).alias(f"n{c}") for c in (1, 2, 3, 4)])
    y = F.when(F.col("n1") + 2 * F.col("n2") > 0, F.col("n1") / (F.col("n1") + 2 * F.col("n2"))).otherwise(0.5)
    # Where counts of counts are missing (tiny tables), fixed discounts stand in.
    discount = [F.when((F.col(f"n{c}") > 0) & (F.col(f"n{c + 1}") > 0),
                       F.greatest(F.lit(0.05), F.least(F.lit(c - 0.05), c - (c + 1) * y * F.col(f"n{c + 1}") / F.col(f"n{c}"))))
                .otherwise(d).alias(f"d{c}") for c, d in ((1, 0.5), (2, 0.75), (3, 0.9))]
    discounts = staged(of_counts.select(F.col("lang").alias("d_lang"), F.col("k").alias("d_k"), *discount), "kn-discounts")
    cut = every.join(discounts, F.col("lang").eqNullSafe(F.col("d_lang")) & (F.col("k") == F.col("d_k"))).select(
        "lang", "k", "gram", "n", F.shiftright("gram", 8).alias("ctx"),
        F.when(F.col("n") == 1, F.col("d1")).when(F.col("n") == 2, F.col("d2")).otherwise(F.col("d3")).alias("cut"))
    contexts = staged(cut.groupBy(F.col("lang").alias("c_lang"), F.col("k").alias("c_k"), F.col("ctx").alias("c_ctx"))
                      .agg(F.sum("n").alias("total"), (F.sum("cut") / F.sum("n")).alias("weight")), "kn-contexts")
    terms = staged(cut.join(contexts, F.col("lang").eqNullSafe(F.col("c_lang")) & (F.col("k") == F.col("c_k")) & (F.col("ctx") == F.col("c_ctx")))
                   .select("lang", "k", "gram", ((F.col("n") - F.col("cut")) / F.col("total")).alias("own"), "weight"), "kn-terms")
    probabilities, lower = [], None
    for k in range(1, order + 1):
        table = terms.where(F.col("k") == k)
        if lower is None:
            below_p = F.lit(1 / 256)
        else:
            below = lower.select(F.col("lang").alias("b_lang"), F.col("gram").alias("b_gram"), F.col("p").alias("b_p"))
            table = table.join(below, F.col("lang").eqNullSafe(F.col("b_lang"))
                               & (F.col("gram").bitwiseAND(_MASK[k - 1]) == F.col("b_gram")))
            below_p = F.col("b_p")
        lower = staged(table.select("lang", "k", "gram", (F.col("own") + F.col("weight") * below_p).alias("p")), f"kn-order{k}")
        probabilities.append(lower)
    held = probabilities[0]
    for p in probabilities[1:]:
        held = held.unionByName(p)
    # The weight of a context belongs to its own entry, one order below.  A context may open texts only and so be no
    # n-gram that anything precedes: it has a weight and no probability.
    as_context = contexts.select(F.col("c_lang").alias("w_lang"), (F.col("c_k") - 1).alias("w_k"), F.col("c_ctx").alias("w_gram"),
                                 F.col("weight").alias("backoff"))
    entries = held.join(as_context, F.col("lang").eqNullSafe(F.col("w_lang")) & (F.col("k") == F.col("w_k"))
                        & (F.col("gram") == F.col("w_gram")), "full_outer")
    entries = staged(entries.select(
        F.when(F.col("k").isNull(), F.col("w_lang")).otherwise(F.col("lang")).alias("lang"), F.coalesce("k", "w_k").alias("k"),
        F.coalesce("gram", "w_gram").alias("gram"), "p", F.coalesce("backoff", F.lit(1.0)).alias("backoff")), "kn-entries")
    return [entries.where(F.col("k") == k).drop("k") for k in range(order + 1)]


def _hashed(k: int):
    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            langs = batch.column("lang").dictionary_encode()
            keys = np.array([language_key(x) for x in langs.dictionary.to_pylist()] + [language_key(None)], np.uint64)
            where = langs.indices.fill_null(len(keys) - 1).to_numpy(zero_copy_only=False)
            gram = batch.column("gram").to_numpy().astype(np.uint64)
            h = gram ^ (keys[where] + np.uint64(k * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF))
            h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
            h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
            h ^= h >> np.uint64(31)
            yield pa.RecordBatch.from_arrays([
                pa.array(h.view(np.int64)), pa.array(np.log(batch.column("p").to_numpy(zero_copy_only=False)).astype(np.float32)),
                pa.array(np.log(batch.column("backoff").to_numpy()).astype(np.float32))], names=["hash", "logp", "logb"])
    return run


@dataclass
class Model:
    """Sorted hashes with log probabilities and log back-off weights."""

    order: int
    hashes: np.ndarray
    logp: np.ndarray
    logb: np.ndarray

    def _find(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.searchsorted(self.hashes, h)
        at[at == len(self.hashes)] = 0
        return at, (self.hashes[at] == h) if len(self.hashes) else np.zeros(len(h), bool)

    def log_probs(self, grams: np.ndarray, lang: int) -> np.ndarray:
        """Natural log probability of the last byte of each n-gram given the others."""
        out = np.zeros(len(grams))
        todo, k = np.arange(len(grams)), self.order
        while k and len(todo):
            at, hit = self._find(entry_hash(grams[todo] & np.uint64(_MASK[k]), k, lang))
            hit &= ~np.isnan(self.logp[at]) if len(self.logp) else False
            out[todo[hit]] += self.logp[at[hit]]
            todo = todo[~hit]
            if len(todo):
                at, known = self._find(entry_hash((grams[todo] >> np.uint64(8)) & np.uint64(_MASK[k - 1]), k - 1, lang))
                out[todo[known]] += self.logb[at[known]]
            k -= 1
        out[todo] += np.log(1 / 256)
        return out


def model_table(tables: list[DataFrame]) -> DataFrame:
    """All orders as one table (hash, logp, logb)."""
    out = None
    for k, t in enumerate(tables):
        part = arrow_map(t, _hashed(k), "hash long, logp float, logb float")
        out = part if out is None else out.unionByName(part)
    return out


def _collected(table: DataFrame, order: int) -> Model:
    data = table.toArrow()
    h = data.column("hash").to_numpy().view(np.uint64)
    by = np.argsort(h)
    return Model(order, h[by], data.column("logp").to_numpy()[by], data.column("logb").to_numpy()[by])


# --------------------------------------------------------------------- scoring ---

_STATS = ("doc_id long, lang string, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
          "n_repeat_words long")


def _text_hashes(all_words: list[list[bytes]]) -> pa.Array:
    """One number for all texts of the same words."""
    return pa.array(np.array([xxhash.xxh3_64_intdigest(b" ".join(w)) for w in all_words], np.uint64).view(np.int64))


def _stat_arrays(batch: pa.RecordBatch, word_ids: dict) -> tuple[list, list[list[bytes]]]:
    rows, all_words = [], []
    if len(word_ids) > 400_000:
        word_ids.clear()
    for text in batch.column("text").to_pylist():
        text = text or ""
        words = split_words(text)
        ids = np.fromiter((word_ids.setdefault(w, len(word_ids)) for w in words), np.int64, len(words))
        rows.append(base_rules(text, words, ids))
        all_words.append(words)
    return rows, all_words


def _scorer(shared, order: int):
    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, word_ids = shared.value, {}
        for batch in batches(rows, 512, "text", 1 << 20):
            stats, all_words = _stat_arrays(batch, word_ids)
            langs = batch.column("lang").to_pylist()
            logs = np.zeros(len(langs))
            sizes = np.zeros(len(langs), np.int64)
            for lang in set(langs):
                mine = [i for i, x in enumerate(langs) if x == lang and all_words[i]]
                if not mine:
                    continue
                grams = [_grams(np.frombuffer(_units(all_words[i], order), np.uint8), order) for i in mine]
                at = np.concatenate(([0], np.cumsum([len(g) for g in grams])))
                flat = np.concatenate(grams)
                distinct, where = np.unique(flat, return_inverse=True)
                logs[mine] = np.add.reduceat(model.log_probs(distinct, language_key(lang))[where], at[:-1])
                sizes[mine] = np.diff(at)
            columns = [pa.array(c, pa.int64()) for c in zip(*stats)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("lang"), *columns,
                 _text_hashes(all_words), pa.array(sizes), pa.array(-logs / np.maximum(sizes, 1))],
                names=[c.split()[0] for c in _STATS.split(", ")] + ["text_hash", "n_bytes", "log_ppl"])
    return run


def _statistics(order: int):
    """The statistics alone, with the key of the row."""
    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        word_ids: dict = {}
        for batch in batches(rows, 512, "text", 1 << 20):
            stats, all_words = _stat_arrays(batch, word_ids)
            sizes = [len(_units(w, order)) - order + 1 if w else 0 for w in all_words]
            yield pa.RecordBatch.from_arrays(
                [batch.column("row_key"), batch.column("doc_id"), batch.column("lang"),
                 *[pa.array(c, pa.int64()) for c in zip(*stats)], _text_hashes(all_words), pa.array(sizes, pa.int64())],
                names=["row_key"] + [c.split()[0] for c in _STATS.split(", ")] + ["text_hash", "n_bytes"])
    return run


def _exploder(order: int):
    """Each distinct n-gram of a row with its count."""
    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(rows, 64, "text", 1 << 18):
            for key, text, lang in zip(*(batch.column(c).to_pylist() for c in ("row_key", "text", "lang"))):
                grams, counts = np.unique(_grams(np.frombuffer(_units(split_words(text or ""), order), np.uint8), order),
                                          return_counts=True)
                yield pa.RecordBatch.from_arrays([
                    pa.array([key] * len(grams), pa.int64()), pa.array([lang] * len(grams), pa.string()),
                    pa.array(grams.astype(np.int64)), pa.array(counts)], names=["row_key", "lang", "gram", "n"])
    return run


def score_by_join(docs: DataFrame, tables: list[DataFrame], order: int = ORDER) -> DataFrame:
    """(row_key, log_ppl) of rows (row_key, text, lang): n-grams joined with the model, order by order.

    Right for a model of any size: each (language, n-gram) that some row holds
    is looked up once, from the highest order down.
    """
    held = staged(arrow_map(docs.select("row_key", "text", "lang"), _exploder(order),
                            "row_key long, lang string, gram long, n long"), "kn-grams")
    look = held.select("lang", "gram").distinct().withColumns({
        "logp": F.lit(0.0), "open": F.lit(True)})
    for k in range(order, 0, -1):
        t = tables[k].select(F.col("lang").alias("t_lang"), F.col("gram").alias("t_gram"), F.col("p").alias("t_p"))
        look = look.join(t, F.col("lang").eqNullSafe(F.col("t_lang"))
                         & (F.col("gram").bitwiseAND(_MASK[k]) == F.col("t_gram")), "left")
        hit = F.col("open") & F.col("t_p").isNotNull()
        look = look.withColumns({"logp": F.when(hit, F.col("logp") + F.log("t_p").cast("float").cast("double")).otherwise(F.col("logp")),
                                 "open": F.col("open") & ~hit}).drop("t_lang", "t_gram", "t_p")
        if k > 0:
            b = tables[k - 1].select(F.col("lang").alias("t_lang"), F.col("gram").alias("t_gram"), F.col("backoff").alias("t_b"))
            look = look.join(b, F.col("lang").eqNullSafe(F.col("t_lang"))
                             & (F.shiftright("gram", 8).bitwiseAND(_MASK[k - 1]) == F.col("t_gram")), "left")
            look = look.withColumn("logp", F.when(F.col("open") & F.col("t_b").isNotNull(),
                                                  F.col("logp") + F.log("t_b").cast("float").cast("double")).otherwise(F.col("logp"))
                                   ).drop("t_lang", "t_gram", "t_b")
    look = look.select(F.col("lang").alias("l_lang"), F.col("gram").alias("l_gram"),
                       F.when(F.col("open"), F.col("logp") + float(np.log(1 / 256))).otherwise(F.col("logp")).alias("logp"))
    return (held.join(look, F.col("lang").eqNullSafe(F.col("l_lang")) & (F.col("gram") == F.col("l_gram")))
            .groupBy("row_key").agg((-F.sum(F.col("logp") * F.col("n")) / F.sum("n")).alias("log_ppl")))


def perplexity_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                     order: int = ORDER, low: float = BAND_LOW, high: float = BAND_HIGH,
                     max_broadcast: int = MAX_BROADCAST) -> DataFrame:
    """One row per document: base statistics, log_ppl, the band of its language and length, base_failed, kept."""
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"),
                      F.col(lang_col).cast("string").alias("lang"))
    counts = staged(count_grams(src, order), "kn-grams")
    tables = estimate(counts, order)
    table = staged(model_table(tables), "kn-model")
    schema = _STATS + ", text_hash long, n_bytes long, log_ppl double"
    if table.count() <= max_broadcast:
        shared = docs.sparkSession.sparkContext.broadcast(_collected(table, order))
        scored = arrow_map(src, _scorer(shared, order), schema)
    else:
        # Written once, so that the number of a row is the same for both readers.
        keyed = staged(src.withColumn("row_key", F.monotonically_increasing_id()), "kn-rows")
        logs = score_by_join(keyed, tables, order).withColumnRenamed("row_key", "j_key")
        stats = arrow_map(keyed, _statistics(order), "row_key long, " + _STATS + ", text_hash long, n_bytes long")
        scored = (stats.join(logs, F.col("row_key") == F.col("j_key"), "left").drop("row_key", "j_key")
                  .withColumn("log_ppl", F.coalesce("log_ppl", F.lit(0.0))))
    scored = staged(scored, "kn-scored")
    return _verdict(scored, low, high)


def _median(value, width: float):
    """From a histogram of fixed bins: what is held and sent does not grow with the rows."""
    return (F.percentile(F.floor(value / width), F.lit(0.5)) + 0.5) * width


def _bands(texts: DataFrame) -> DataFrame:
    """(m_lang, m_class, middle, spread) of every class of ``texts`` (lang, size_class, n_bytes, log_ppl), one row a text.

    A class of fewer than ``MIN_TEXTS`` texts takes those of its language, a
    language of fewer those of all texts; where all texts are fewer both are null.
    """
    none = F.lit(None)
    pools = F.explode(F.array(*[F.struct(
        F.lit(k).alias("level"), (F.col("lang") if k < 2 else none.cast("string")).alias("p_lang"),
        (F.col("size_class") if k < 1 else none.cast("int")).alias("p_class")) for k in range(3)]))
    pooled = texts.select(pools.alias("pool"), "log_ppl").select("pool.*", "log_ppl")
    keys = ["level", "p_lang", "p_class"]
    middles = staged(pooled.groupBy(keys).agg(_median(F.col("log_ppl"), BIN).alias("middle"), F.count(F.lit(1)).alias("n")), "kn-middle")
    same = ((F.col("level") == F.col("o_level")) & F.col("p_lang").eqNullSafe(F.col("o_lang"))
            & F.col("p_class").eqNullSafe(F.col("o_class")))
    away = (pooled.join(middles.toDF("o_level", "o_lang", "o_class", "middle", "n"), same)
            .groupBy(keys).agg(_median(F.abs(F.col("log_ppl") - F.col("middle")), BIN).alias("away"))
            .toDF("o_level", "o_lang", "o_class", "away"))
    found = staged(middles.join(away, same).select(*keys, "middle", "away", "n"), "kn-spread")
    own = found.where("level = 0").drop("level").toDF("m_lang", "m_class", "middle0", "away0", "n0")
    of_lang = found.where("level = 1").drop("level", "p_class").toDF("l_lang", "middle1", "away1", "n1")
    of_all = found.where("level = 2").select("middle", "away", "n").toDF("middle2", "away2", "n2")
    classes = own.join(of_lang, F.col("m_lang").eqNullSafe(F.col("l_lang"))).crossJoin(of_all)
    classes = staged(classes.select("m_lang", "m_class", *[
        F.when(F.col("n0") >= MIN_TEXTS, F.col(x + "0")).when(F.col("n1") >= MIN_TEXTS, F.col(x + "1"))
        .when(F.col("n2") >= MIN_TEXTS, F.col(x + "2")).alias(x) for x in ("middle", "away")]), "kn-classes")
    # Means of n bytes lie apart by about 1 / sqrt(n): one figure over all texts says what is usual for each length.
    far = F.abs(F.col("log_ppl") - F.col("middle")) * F.sqrt("n_bytes")
    usual = (texts.join(classes, _of_class()).agg(F.exp(_median(F.log(F.greatest(far, F.lit(1e-6))), LOG_BIN)).alias("usual")))
    least = FLOOR * F.col("usual") / F.sqrt(F.pow(F.lit(2.0), F.col("m_class") + 0.5))
    return classes.crossJoin(usual).select("m_lang", "m_class", "middle", F.when(
        F.col("middle").isNotNull(), F.greatest("away", least)).alias("spread"))


def _of_class():
    return F.col("lang").eqNullSafe(F.col("m_lang")) & (F.col("size_class") == F.col("m_class"))


def _verdict(scored: DataFrame, low: float, high: float) -> DataFrame:
    """Bands: median -/+ width x spread of log_ppl, per language and class of length (doubling byte counts).

    The spread is 1.4826 x the median distance from the median.  Without any
    band (see :func:`_bands`) the base rules alone decide.
    """
    rows = scored.withColumn("size_class", F.floor(F.log2(F.greatest("n_bytes", F.lit(1)))).cast("int"))
    texts = staged(rows.where("n_words > 0").groupBy("lang", "size_class", "text_hash")
                   .agg(F.min("n_bytes").alias("n_bytes"), F.min("log_ppl").alias("log_ppl")), "kn-texts")
    bands = staged(_bands(texts), "kn-bands")
    out = (rows.join(bands, _of_class(), "left").drop("m_lang", "m_class")
           .withColumn("band_low", F.col("middle") - low * 1.4826 * F.col("spread"))
           .withColumn("band_high", F.col("middle") + high * 1.4826 * F.col("spread"))
           .withColumn("base_failed", (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))))
    inside = F.coalesce(F.col("log_ppl").between(F.col("band_low"), F.col("band_high")), F.lit(True))
    return out.select("doc_id", "lang", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                      "base_failed", (~F.col("base_failed") & inside).alias("kept"), "log_ppl", "band_low", "band_high")
