"""Line dedup by a log-template tree of fixed depth.  DataFrame functions only.

A line's words lead it down the tree: first the number of words, then the first
``DEPTH`` words, with every word that holds a digit replaced by ``<*>``.  Behind
those, a word is part of a template where at least two different masked lines of
the leaf have it at that place and it is at least one in ``FEW_VALUES`` of what
the leaf's lines have there behind the same word; other places are variable and
become ``<*>``.  A share of what follows does not depend on how many lines a leaf
holds, so a field stays variable when its values recur, and a leaf of many
templates keeps them apart.  Lines are shuffled as hashes; only those of
leaves with different lines are shuffled as text.  A template with too few fixed words, in all or
behind the leading ones, says too little: there the masked line itself is the
template, or the line as it is where masking left too little.

A template found in ``min_docs`` documents or more recurs.  The document with
the smallest id (a missing id last) keeps its lines of it, all others lose
theirs.  A line of ``LONG_WORDS`` words or more recurs from two documents on
where it is the same but for digits.  A line of ``SHORT_WORDS`` words or more, but
fewer than ``min_words``, says too little to be generalised: it is taken exactly
as it is, and recurs from ``SHORT_DOCS`` documents on that are also at least one in
``SHORT_PART`` of all rows.  Shorter lines, blank ones included, always stay.

Only different masked lines of shared leaves are taken apart into words, after an
aggregate that collapses repeats on the map side; they are dealt by leaf, but for
the largest leaves, whose words are counted in two steps.  Counts of
documents go by (template, document) first, so a line found in a third of all
documents is spread over all tasks.

Lines end at ``\\n``.  Rows with the same id and text are one document.  Null
texts stay null and empty ones empty.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chatsift.llm.common import BLANK_CLASS, HOT_PARTS, WORD, fresh, staged

DEPTH = 3
MIN_WORDS = 5
MIN_DOCS = 3
#: Lines of so many words recur from two documents on.
LONG_WORDS = 20
#: Shorter lines than MIN_WORDS: words they need, documents they need, and the part of all rows these must be.
SHORT_WORDS = 2
SHORT_DOCS = 10
SHORT_PART = 200
#: A place with more values than this, evenly used behind one word, is variable.
FEW_VALUES = 3
#: Share of fixed words that a generalised template needs, in all and behind the leading words, in tenths.
FIXED_TENTHS = 6
#: A leaf of so many different lines is never too large for a task.
HOT_LEAF = 10_000
#: Bits of the filter of shared leaves; a fuller filter lets more lines through, never fewer.
FILTER_BITS = 1 << 22
_WITH_DIGIT = r"[^\x20\x09-\x0D]*[0-9]" + WORD.replace("+", "*")


def _masked(line: Column) -> Column:
    """The words of a line joined by one blank, words with a digit as ``<*>``.  Most lines need neither regex."""
    marked = F.when(line.rlike("[0-9]"), F.regexp_replace(line, _WITH_DIGIT, "<*>")).otherwise(line)
    wide = line.startswith(" ") | line.endswith(" ") | line.contains("  ")
    for control in "\t\x0b\x0c\r":
        wide = wide | line.contains(control)
    return F.when(wide, F.trim(F.regexp_replace(marked, BLANK_CLASS + "+", " "))).otherwise(marked)


def _n_words(masked: Column) -> Column:
    return F.length(masked) - F.length(F.replace(masked, F.lit(" "), F.lit(""))) + 1


def _fixed_share_ok(words: Column) -> Column:
    fixed = F.size(F.filter(words, lambda w: w != "<*>"))
    return fixed * 10 >= F.size(words) * FIXED_TENTHS


def _leaf(masked: Column) -> Column:
    """The leaf of the tree: number of words, then the first words."""
    return F.xxhash64(_n_words(masked), F.substring_index(masked, " ", DEPTH))


def _own_template(line: Column, masked: Column) -> Column:
    """What stands for a line that is not generalised: masked, or as it is where masking left too little."""
    short = masked.contains("<*>") & ~_fixed_share_ok(F.split(masked, " "))
    return F.when(short, F.concat(F.lit("l "), line)).otherwise(F.concat(F.lit("m "), masked))


def _line_rows(docs: DataFrame, id_col: str, text_col: str, min_words: int) -> DataFrame:
    """(id, text_hash, place, line, masked) of every line of ``min_words`` words or more."""
    both = F.transform(F.split(F.col(text_col), "\n"), lambda x: F.struct(x.alias("line"), _masked(x).alias("masked")))
    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("text_hash"),
                       F.posexplode(both).alias("place", "l"))
    rows = rows.select("id", "text_hash", "place", "l.line", "l.masked")
    return rows.where((F.col("masked") != "") & (_n_words(F.col("masked")) >= min_words))


def _filter_of(numbers: DataFrame, name: str) -> DataFrame:
    """One row, one array of FILTER_BITS / 64 numbers: a bit for each of ``numbers``, however many they are."""
    words = (numbers.groupBy(F.floor(F.pmod(name, F.lit(FILTER_BITS)) / 64).alias("w"))
             .agg(F.bit_or(F.expr(f"shiftleft(1L, cast(pmod({name}, 64) as int))")).alias("m")))
    every = numbers.sparkSession.range(FILTER_BITS // 64).withColumnRenamed("id", "i")
    dense = every.join(words, F.col("i") == F.col("w"), "left").select("i", F.coalesce("m", F.lit(0)).cast("long").alias("m"))
    return dense.agg(F.transform(F.sort_array(F.collect_list(F.struct("i", "m"))), lambda x: x["m"]).alias("bits"))


def _may_be_in(bits: DataFrame, number: Column) -> Column:
    """False where ``number`` is certainly not among those of the filter; a full filter says true to all."""
    word = F.get(bits.scalar(), F.floor(F.pmod(number, F.lit(FILTER_BITS)) / 64).cast("int"))
    return F.call_function("shiftright", word, F.pmod(number, F.lit(64)).cast("int")).bitwiseAND(F.lit(1)) == 1


def _words_behind(lines: DataFrame) -> DataFrame:
    """(leaf, kind, place, before, word) of the words behind the leading ones; words are hashes."""
    words = F.split("masked", " ")
    pairs = F.zip_with(F.slice(words, DEPTH, F.greatest(F.size(words) - DEPTH, F.lit(0))), F.slice(words, DEPTH + 1, 1 << 30),
                       lambda a, b: F.struct(F.xxhash64(a).alias("before"), F.xxhash64(b).alias("word")))
    return (lines.select("leaf", F.xxhash64("masked").alias("kind"), F.posexplode(pairs).alias("place", "p"))
            .select("leaf", "kind", "place", "p.before", "p.word"))


def _places(fixed: DataFrame) -> DataFrame:
    return fixed.groupBy("leaf", "kind").agg(F.collect_set("place").alias("places"))  # of one line


def _fixed_in_leaves(lines: DataFrame) -> DataFrame:
    """The fixed places of lines in leaves of which each fits a task: lines are dealt by leaf, nothing else is shuffled."""
    def count_by(*keys):
        return F.count(F.lit(1)).over(Window.partitionBy("leaf", "place", *keys))

    counted = (_words_behind(lines.repartition("leaf")).withColumn("n", count_by("before", "word"))
               .withColumn("total", count_by("before")).withColumn("held", count_by("word")))
    return _places(counted.where((F.col("n") * FEW_VALUES >= F.col("total")) & (F.col("held") > 1)))


def _fixed_by_counts(lines: DataFrame) -> DataFrame:
    """The fixed places of lines in leaves of any size: words are counted in the scan's tasks first."""
    inside, here = _words_behind(lines), ["leaf", "place", "before", "word"]
    counted = staged(inside.groupBy(*here).agg(F.count(F.lit(1)).alias("n")), "line-words")
    held = counted.groupBy("leaf", "place", "word").agg(F.sum("n").alias("held")).where("held > 1").drop("held")
    follow = counted.groupBy("leaf", "place", "before").agg(F.sum("n").alias("total"))
    fixed = (counted.join(follow, ["leaf", "place", "before"]).where(F.col("n") * FEW_VALUES >= F.col("total"))
             .join(held, ["leaf", "place", "word"], "left_semi").select(*here))
    return _places(inside.join(fixed, here, "left_semi"))


def general_templates(lines: DataFrame) -> DataFrame:
    """(leaf, masked, general) of the different masked lines (leaf, masked) whose general template says enough.

    Leaves with over 1 / ``HOT_PARTS`` of the lines (and over ``HOT_LEAF``) are fewer than
    ``HOT_PARTS``, so they are broadcast; their words are counted in two steps.
    """
    total = lines.count()
    hot = F.broadcast(lines.groupBy("leaf").agg(F.count(F.lit(1)).alias("n"))
                      .where((F.col("n") > HOT_LEAF) & (F.col("n") * HOT_PARTS > total)).select("leaf"))
    places = (_fixed_in_leaves(lines.join(hot, "leaf", "left_anti"))
              .unionByName(_fixed_by_counts(lines.join(hot, "leaf", "left_semi"))).toDF("f_leaf", "f_kind", "places"))
    words = F.split("masked", " ")
    known = F.coalesce("places", F.array().cast("array<int>"))
    general = F.transform(words, lambda w, i: F.when((i < DEPTH) | F.array_contains(known, i - DEPTH), w).otherwise("<*>"))
    return (lines.join(places, (F.col("leaf") == F.col("f_leaf")) & (F.xxhash64("masked") == F.col("f_kind")), "left")
            .select("leaf", "masked", general.alias("words"))
            .where(_fixed_share_ok(F.col("words")) & _fixed_share_ok(F.slice("words", DEPTH + 1, 1 << 30)))
            .select("leaf", "masked", F.concat_ws(" ", "words").alias("general")))


def _name(template: Column) -> list[Column]:
    """128 bits for a template: texts of lines travel no further."""
    return [F.xxhash64(template).alias("t1"), F.xxhash64(F.lit(7), template).alias("t2")]


def recurring_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_docs: int = MIN_DOCS,
                    min_words: int = MIN_WORDS) -> DataFrame:
    """The lines to drop: (id, text_hash, place) of every line of a recurring template but the first document's."""
    masked, n_words = F.col("masked"), _n_words(F.col("masked"))
    wordy, long_line = n_words >= min_words, n_words >= LONG_WORDS
    short_docs = max(SHORT_DOCS, -(-docs.count() // SHORT_PART))
    rows = _line_rows(docs, id_col, text_col, min(SHORT_WORDS, min_words))
    own = F.when(wordy, _own_template(F.col("line"), masked)).otherwise(F.concat(F.lit("s "), F.col("line")))
    need = F.when(~wordy, F.lit(short_docs)).when(long_line, F.least(F.lit(2), F.lit(min_docs))).otherwise(F.lit(min_docs))
    lines = staged(rows.select("id", "text_hash", "place", F.when(wordy, _leaf(masked)).alias("leaf"),
                               F.xxhash64("masked").alias("kind"), *_name(own), need.cast("long").alias("need"),
                               long_line.alias("long_line"), F.when(wordy, masked).alias("masked")), "lines")
    shared = staged(lines.where("leaf is not null").groupBy("leaf").agg(F.min("kind").alias("a"), F.max("kind").alias("b"))
                    .where("a <> b").select("leaf"), "leaves")
    # Only lines that may be in shared leaves are shuffled; the filter is a single value, the joins are exact.
    bits = staged(_filter_of(shared, "leaf"), "leaf-filter")
    may_be = F.coalesce(_may_be_in(bits, F.col("leaf")), F.lit(False))
    near = lines.where(may_be).select("leaf", "masked")
    near = staged(near.join(shared, "leaf", "left_semi").distinct(), "near-lines")
    general = (general_templates(near)
               .select(F.col("leaf").alias("g_leaf"), F.xxhash64("masked").alias("g_kind"),
                       *_name(F.concat(F.lit("m "), F.col("general")))).toDF("g_leaf", "g_kind", "g1", "g2"))
    # A long line counts by its general template and, from two documents on, by its own as well.
    by_own = F.struct("t1", "t2", "need")
    by_general = F.struct(F.col("g1").alias("t1"), F.col("g2").alias("t2"), F.lit(min_docs).cast("long").alias("need"))
    names = (F.when(F.col("g1").isNull(), F.array(by_own)).when(F.col("long_line"), F.array(by_own, by_general))
             .otherwise(F.array(by_general)))
    lines = lines.drop("masked")
    named = (lines.where(may_be).join(general, F.expr("leaf = g_leaf AND kind = g_kind"), "left")
             .select("id", "text_hash", "place", F.explode(names).alias("t")).select("id", "text_hash", "place", "t.*"))
    named = named.unionByName(lines.where(~may_be).select(*named.columns))
    named = staged(named, "templates")
    often = (named.groupBy("t1", "t2").agg(F.count(F.lit(1)).alias("n"), F.min("need").alias("least"))
             .where("n >= least").select("t1", "t2", "least"))
    named = staged(named.drop("need").join(often, ["t1", "t2"]), "repeated")
    order = F.struct(F.col("id").isNull().alias("none"), "id", "text_hash")
    per_doc = named.groupBy("t1", "t2", "id", "text_hash").agg(F.min("least").alias("least"))
    recurring = (per_doc.groupBy("t1", "t2").agg(F.count(F.lit(1)).alias("n"), F.min("least").alias("least"),
                                                 F.min(order).alias("first")).where("n >= least").drop("least"))
    return (named.join(recurring, ["t1", "t2"])
            .where(~(F.col("id").eqNullSafe(F.col("first.id")) & (F.col("text_hash") == F.col("first.text_hash"))))
            .select("id", "text_hash", "place"))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_docs: int = MIN_DOCS,
                min_words: int = MIN_WORDS, counts: bool = False) -> DataFrame:
    """``docs`` with the recurring lines taken out of the text; other columns as they are.

    With ``counts``, ``n_lines`` and ``n_dropped`` are added (and replace columns of these names).
    """
    dropped = staged(recurring_lines(docs, id_col, text_col, min_docs, min_words)
                     .groupBy("id", "text_hash").agg(F.collect_set("place").alias("places")), "dropped")  # of one document
    names = docs.columns
    d_id, d_hash, d_places, d_key = (fresh(names, x) for x in ("_drop_id", "_drop_hash", "_drop_places", "_drop_key"))
    # Only rows that may lose a line are shuffled; the filter is one value, the join is exact.
    bits = staged(_filter_of(dropped, "text_hash"), "text-filter")
    keyed = docs.withColumn(d_key, F.xxhash64(text_col))
    same = F.col(id_col).eqNullSafe(F.col(d_id)) & (F.col(d_key) == F.col(d_hash))
    joined = (keyed.where(_may_be_in(bits, F.col(d_key))).join(dropped.toDF(d_id, d_hash, d_places), same, "left")
              .drop(d_id, d_hash))
    joined = joined.unionByName(keyed.where(~_may_be_in(bits, F.col(d_key))).withColumn(d_places, F.lit(None).cast("array<int>")))
    lines = F.split(F.col(text_col), "\n")
    kept = F.array_join(F.filter(lines, lambda line, i: ~F.array_contains(F.col(d_places), i)), "\n")
    if counts:
        joined = joined.withColumns({
            "n_lines": F.coalesce(F.size(lines), F.lit(0)).cast("long"),
            "n_dropped": F.coalesce(F.size(d_places), F.lit(0)).cast("long")})
    out = joined.withColumn(text_col, F.when(F.col(d_places).isNull(), F.col(text_col)).otherwise(kept))
    return out.drop(d_places, d_key)
