"""Language identification as Spark jobs: a character-trigram Naive Bayes.

Training (:func:`train_lang_profiles`) is one ``groupBy(lang, gram)`` over
labelled text; every counted trigram is kept.

Scoring, per text and language, with add-one smoothing over the vocabulary V:
``log((c(lang, g) + 1) / (total(lang) + V))`` for each trigram g, and
``log(1 / (total(lang) + V))`` for an unseen one.  The model's numbers are whole
millionths, so a score is a sum of integers: it does not depend on the order in
which grams are added, and ties are exact (the larger language code wins).  A
text with no trigram gets null: the detector "fails".

A text is scored inside its own row (:func:`with_language`): its trigrams are
looked up in one sorted array of gram numbers with a weight column per language,
so nothing is exploded, shuffled or joined by id.  Rows may have null or repeated
ids.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chatsift.operators.partitioning import in_slices
from chatsift.session import ship_package, staged

#: (language, trigram) entries of a profile that are sent to every task (at most 28 bytes each, 112 MB);
#: a larger profile stays a table, with the same results.
MAX_ENTRIES = 4_000_000
#: Scores are sums of whole parts of this size.
UNIT = 1_000_000
#: Different trigrams that a task of the training holds before it sends its counts.
HELD = 1_000_000
#: Trigrams in a batch of such counts.
SENT = 1 << 16
#: Characters scored or counted at a time.
CHUNK = 1 << 19


def lang_text(text) -> Column:
    """Lower-case, letters only, single spaces, padded with one space per side."""
    c = F.col(text) if isinstance(text, str) else text
    letters = F.trim(F.regexp_replace(F.lower(c), r"[^\p{L}]+", " "))
    return F.when(F.length(letters) > 0, F.concat(F.lit(" "), letters, F.lit(" ")))


def trigrams(text) -> Column:
    """Overlapping character trigrams of :func:`lang_text` (one regex pass)."""
    return F.regexp_extract_all(lang_text(text), F.lit("(?=(.{3}))"), 1)


def _count_trigrams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``(lang, gram, n)`` of rows ``(lang, text)`` of :func:`lang_text`, added up within a task."""
    held: dict[str | None, tuple[np.ndarray, np.ndarray]] = {}

    def add(lang, grams, counts):
        if lang in held:
            grams, counts = np.concatenate([held[lang][0], grams]), np.concatenate([held[lang][1], counts])
            grams, where = np.unique(grams, return_inverse=True)
            counts = np.bincount(where, weights=counts, minlength=len(grams)).astype(np.int64)
        held[lang] = grams, counts

    def send():
        while held:
            lang, (grams, counts) = held.popitem()
            for at in range(0, len(grams), SENT):
                some = grams[at:at + SENT]
                points = np.stack([some >> np.uint64(21 * k) & np.uint64((1 << 21) - 1) for k in range(3)], axis=1).astype("<u4")
                text = points.tobytes().decode("utf-32-le", "surrogatepass")
                yield pa.RecordBatch.from_arrays([
                    pa.array([lang] * len(some), pa.string()), pa.array([text[i:i + 3] for i in range(0, len(text), 3)], pa.string()),
                    pa.array(counts[at:at + SENT])], names=["lang", "gram", "n"])

    waiting: dict[str | None, list[str]] = {}  # about CHUNK characters in all
    size = 0

    def count():
        for lang, texts in waiting.items():
            sizes = np.array([len(t) for t in texts], dtype=np.int64)
            found = ProfileArrays.gram_numbers(_points(texts))
            inside = np.ones(len(found), dtype=bool)
            for k in (1, 2):  # trigrams across two texts
                inside[(np.cumsum(sizes)[:-1] - k)] = False
            add(lang, *np.unique(found[inside], return_counts=True))
        waiting.clear()

    for batch in batches:
        for lang, text in zip(in_slices(batch.column("lang")), in_slices(batch.column("text"))):
            for at in range(0, max(len(text) - 2, 1), CHUNK):  # a long text in pieces that share two characters
                piece = text[at:at + CHUNK + 2]
                if size and size + len(piece) > CHUNK:
                    count()
                    size = 0
                    if sum(len(g) for g, _ in held.values()) > HELD:
                        yield from send()
                waiting.setdefault(lang, []).append(piece)
                size += len(piece)
    count()
    yield from send()


def train_lang_profiles(df: DataFrame, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``(lang, gram, cnt, logp, unseen_logp)`` of every counted gram.

    A task counts the trigrams of its rows and sends each different one once per
    ``HELD`` kept; Spark adds them up.  The counts are staged: they are small and
    read twice (per-language totals, then the profile).
    """
    ship_package(df.sparkSession)
    texts = df.select(F.col(lang_col).cast("string").alias("lang"), lang_text(text_col).alias("text")).where("text IS NOT NULL")
    counted = texts.mapInArrow(_count_trigrams, "lang string, gram string, n long")
    kept = staged(counted.groupBy("lang", "gram").agg(F.sum("n").alias("cnt")), "lang-counts")
    stats = kept.groupBy("lang").agg(F.sum("cnt").alias("total")).collect()  # one row per language
    vocab = kept.select("gram").distinct().count()
    total = F.create_map(*[x for r in stats for x in (F.lit(r["lang"]), F.lit(int(r["total"])))])
    denom = (total[F.col("lang")] + F.lit(vocab)).cast("double")
    return kept.select(
        "lang", "gram", "cnt",
        F.log((F.col("cnt") + 1) / denom).alias("logp"),
        F.log(F.lit(1.0) / denom).alias("unseen_logp"),
    )


# ----------------------------------------------------------------- scoring ---

def _whole(c: Column) -> Column:
    return F.round(c * UNIT).cast("long")


def _weights(profiles: DataFrame) -> DataFrame:
    """``(lang, gram, w)``: what a trigram adds to a language's score beyond an unseen one."""
    return profiles.select("lang", "gram", _whole(F.col("logp") - F.col("unseen_logp")).alias("w"))


def _languages(profiles: DataFrame) -> list[tuple[str, int]]:
    """``(language, whole score of an unseen trigram)`` by code; one row per language."""
    rows = profiles.groupBy("lang").agg(_whole(F.max("unseen_logp")).alias("u")).orderBy("lang").collect()
    return [(r["lang"], int(r["u"])) for r in rows]


@dataclass
class ProfileArrays:
    """A profile as arrays: trigrams as ascending numbers and a weight row for each, one column per language."""

    langs: list[str]
    unseen: np.ndarray
    grams: np.ndarray
    weights: np.ndarray

    @staticmethod
    def gram_numbers(points: np.ndarray) -> np.ndarray:
        """Three code points of 21 bits each, for every place but the last two."""
        p = points.astype(np.uint64)
        return p[:-2] | p[1:-1] << np.uint64(21) | p[2:] << np.uint64(42)

    @classmethod
    def load(cls, profiles: DataFrame) -> ProfileArrays:
        langs = _languages(profiles)
        place = {lang: i for i, (lang, _) in enumerate(langs)}
        table = _weights(profiles).toArrow()
        numbers = cls.gram_numbers(_points(table.column("gram").to_pylist()))[::3]
        grams, row = np.unique(numbers, return_inverse=True)
        weights = np.zeros((len(grams), len(langs)), dtype=np.int32)
        column = np.array([place[x] for x in table.column("lang").to_pylist()], dtype=np.int64)
        weights[row, column] = table.column("w").to_numpy()
        return cls([lang for lang, _ in langs], np.array([u for _, u in langs], dtype=np.int64), grams, weights)

    def scores(self, texts: list[str]) -> np.ndarray:
        """Score of each text (of :func:`lang_text`) in each language."""
        out = np.zeros((len(texts), len(self.langs)), dtype=np.int64)
        sizes = np.array([len(t) for t in texts], dtype=np.int64)
        at = 0
        while at < len(texts):
            if sizes[at] > CHUNK:  # in pieces that share two characters
                for k in range(0, int(sizes[at]) - 2, CHUNK):
                    out[at] += self._piece([texts[at][k:k + CHUNK + 2]])[0]
                at += 1
                continue
            stop = at + max(1, int(np.searchsorted(np.cumsum(sizes[at:]), CHUNK, "right")))
            out[at:stop] = self._piece(texts[at:stop])
            at = stop
        return out

    def _piece(self, texts: list[str]) -> np.ndarray:
        sizes = np.array([len(t) for t in texts], dtype=np.int64)
        ends = np.cumsum(sizes)
        counts = np.maximum(sizes - 2, 0)
        out = counts[:, None] * self.unseen[None, :]
        if ends[-1] < 3 or not len(self.grams):
            return out
        found = self.gram_numbers(_points(texts))  # grams across two texts are passed over below
        row = np.minimum(np.searchsorted(self.grams, found), len(self.grams) - 1)
        known = self.grams[row] == found
        first = ends - sizes
        for k in range(len(self.langs)):
            total = np.concatenate([[0], np.cumsum(np.where(known, self.weights[row, k], 0))])
            out[:, k] += total[np.minimum(first + counts, len(found))] - total[np.minimum(first, len(found))]
        return out

    def each(self, texts: Iterable[str | None]) -> list[str | None]:
        """:meth:`best` of about ``CHUNK`` characters at a time."""
        out: list[str | None] = []
        some: list[str | None] = []
        size = 0
        for text in texts:
            if some and size + len(text or "") > CHUNK:
                out += self.best(some)
                some, size = [], 0
            some.append(text)
            size += len(text or "")
        return out + self.best(some)

    def best(self, texts: list[str | None]) -> list[str | None]:
        """The best language of each text, the larger code on a tie; null for null."""
        some = [i for i, t in enumerate(texts) if t is not None]
        out: list[str | None] = [None] * len(texts)
        if some and self.langs:
            scores = self.scores([texts[i] for i in some])
            best = len(self.langs) - 1 - np.argmax(scores[:, ::-1], axis=1)
            for i, k in zip(some, best):
                out[i] = self.langs[k]
        return out


def _points(texts: list[str]) -> np.ndarray:
    return np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), dtype="<u4")


def language_column(profiles: DataFrame, text: Column) -> Column:
    """The detected language of ``text`` as a column; the profile (bounded by ``MAX_ENTRIES``) goes to every task once."""
    spark = profiles.sparkSession
    ship_package(spark)
    sent = spark.sparkContext.broadcast(ProfileArrays.load(profiles))

    @F.arrow_udf("string")
    def best(texts: pa.Array) -> pa.Array:
        return pa.array(sent.value.each(in_slices(texts)), pa.string())

    return best(lang_text(text))


def with_language(df: DataFrame, profiles: DataFrame, text: Column, out_col: str = "detected_lang",
                  max_entries: int = MAX_ENTRIES) -> DataFrame:
    """``df`` with the detected language of ``text`` of every row.

    A profile of more than ``max_entries`` entries (counted here) is not sent to
    the tasks: rows are staged with a row number, their trigrams joined with the
    profile, and the sums joined back by that number.
    """
    if profiles.count() <= max_entries:
        return df.withColumn(out_col, language_column(profiles, text))
    langs = _languages(profiles)
    wide = _weights(profiles).groupBy("gram").agg(
        *[F.sum(F.when(F.col("lang") == lang, F.col("w"))).alias(f"_d{i}") for i, (lang, _) in enumerate(langs)])
    rows = staged(df.withColumns({"_lang_row": F.monotonically_increasing_id(), "_lang_text": lang_text(text)}), "lang-rows")
    grams = rows.select("_lang_row", F.explode(F.regexp_extract_all("_lang_text", F.lit("(?=(.{3}))"), 1)).alias("gram"))
    sums = grams.join(wide, "gram", "left").groupBy("_lang_row").agg(
        F.count(F.lit(1)).alias("_n"), *[F.sum(f"_d{i}").alias(f"_s{i}") for i in range(len(langs))])
    scores = [F.struct((F.col("_n") * u + F.coalesce(F.col(f"_s{i}"), F.lit(0))).alias("s"), F.lit(lang).alias("l"))
              for i, (lang, u) in enumerate(langs)]
    best = F.greatest(*scores) if len(scores) > 1 else scores[0]
    named = sums.select("_lang_row", best["l"].alias(out_col))
    return rows.join(named, "_lang_row", "left").drop("_lang_row", "_lang_text")


def detect_lang(df: DataFrame, profiles: DataFrame, id_col: str = "id", text_col: str = "text",
                out_col: str = "detected_lang", max_entries: int = MAX_ENTRIES) -> DataFrame:
    """``(id, detected_lang)`` of every input row (null when no trigram); ids may be null or repeat."""
    rows = df.select(F.col(id_col), F.col(text_col).alias("_text"))
    return with_language(rows, profiles, F.col("_text"), out_col, max_entries).drop("_text")
