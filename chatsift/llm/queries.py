"""One query per operator over its whole table, and the SQL oracle where SQL can express it."""

from __future__ import annotations

import zlib
from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chatsift.llm import (chat_format, exact_dedup, hard_negatives, html_text, jaccard_join, line_dedup, mixing, packing,
                          periodic_runs, perplexity, quality_fm, simhash, suffix_dedup)
from chatsift.session import read_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}
_W = r"[^\x20\x09-\x0D]+"
_B = r"[\x20\x09-\x0D]"


def _query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return add


def tokenizer_file() -> str:
    """Found on the worker: the package with the vocabularies is installed there."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@_query("op1_line_dedup", rf"""
WITH lines AS (
  SELECT doc_id, i AS place, l AS line,
         trim(regexp_replace(regexp_replace(l, '[^\x20\x09-\x0D]*[0-9][^\x20\x09-\x0D]*', '<*>', 'g'), '{_B}+', ' ', 'g')) AS masked
  FROM (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents), unnest(ls) WITH ORDINALITY AS u(l, i)),
worded AS (SELECT *, string_split(masked, ' ') AS ws FROM lines WHERE masked <> '' AND len(string_split(masked, ' ')) >= 2),
wordy AS (SELECT * FROM worded WHERE len(ws) >= 5),
kinds AS (SELECT DISTINCT masked, len(ws)::VARCHAR || ' ' || array_to_string(ws[1:3], ' ') AS leaf, ws FROM wordy),
inside AS (SELECT leaf, masked, len(ws) AS n, k AS place, CASE WHEN k > 1 THEN ws[k - 1] ELSE '' END AS before, ws[k] AS word FROM kinds, unnest(range(1, len(ws) + 1)) AS u(k)
  WHERE leaf IN (SELECT leaf FROM kinds GROUP BY leaf HAVING count(*) > 1)),
counted AS (SELECT leaf, place, before, word, count(*) AS c FROM inside GROUP BY ALL),
held AS (SELECT * FROM counted QUALIFY sum(c) OVER (PARTITION BY leaf, place, word) > 1
  AND c * 3 >= sum(c) OVER (PARTITION BY leaf, place, before)),
general AS (SELECT masked, n, string_agg(coalesce(h.word, '<*>'), ' ' ORDER BY i.place) AS general,
    count(*) FILTER (WHERE h.word IS NOT NULL AND h.word <> '<*>') AS fixed,
    count(*) FILTER (WHERE h.word IS NOT NULL AND h.word <> '<*>' AND i.place > 3) AS fixed_behind
  FROM inside i LEFT JOIN held h USING (leaf, place, before, word) GROUP BY masked, n
  HAVING fixed * 10 >= n * 6 AND fixed_behind * 10 >= (n - 3) * 6),
owned AS (SELECT doc_id, place, masked, len(ws) AS n, CASE WHEN len(ws) < 5 THEN 's ' || line
    WHEN len(list_filter(ws, lambda w: w <> '<*>')) * 10 >= len(ws) * 6 THEN 'm ' || masked ELSE 'l ' || line END AS own,
    CASE WHEN len(ws) < 5 THEN (SELECT greatest(10, ceil(count(*) / 200.0)) FROM documents) WHEN len(ws) >= 20 THEN 2 ELSE 3 END AS need
  FROM worded),
named AS (SELECT doc_id, place, own AS template, need FROM owned o LEFT JOIN general g USING (masked) WHERE g.general IS NULL OR o.n >= 20
  UNION ALL SELECT doc_id, place, 'm ' || g.general, 3 FROM owned JOIN general g USING (masked)),
recurring AS (SELECT template, min(doc_id) AS first FROM named GROUP BY template HAVING count(DISTINCT doc_id) >= min(need)),
dropped AS (SELECT DISTINCT n.doc_id, n.place FROM named n JOIN recurring r USING (template) WHERE n.doc_id <> r.first)
SELECT d.doc_id, coalesce(len(string_split(d.text, chr(10))), 0)::BIGINT AS n_lines, count(x.place)::BIGINT AS n_dropped,
  CASE WHEN d.text IS NULL THEN NULL ELSE coalesce((SELECT string_agg(l.line, chr(10) ORDER BY l.place) FROM lines l
    WHERE l.doc_id = d.doc_id AND (l.doc_id, l.place) NOT IN (SELECT doc_id, place FROM dropped)), '') END AS text
FROM documents d LEFT JOIN dropped x USING (doc_id) GROUP BY d.doc_id, d.text""")
def op1(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.dedup_lines(docs, counts=True).select("doc_id", "n_lines", "n_dropped", "text")


_CONTROLS = ["<<SYS>>", "<</SYS>>", "[INST]", "[/INST]", "<s>", "</s>", "[ROLE]", "[/ROLE]", "[/TURN]"]
_ESCAPED = " + ".join(["(len({0}) - len(replace({0}, chr(92), '')))"]
                      + [f"(len({{0}}) - len(replace({{0}}, '{c}', ''))) // {len(c)}" for c in _CONTROLS])


@_query("op2_chat_format", f"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
t AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS k,
  lag(role) OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS before FROM turns)
SELECT conv_id, count(*)::BIGINT AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY k)) AS turns_sha256,
  coalesce(sum(len(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY k) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  sum(len(text) + {_ESCAPED.format("text")} + CASE role WHEN 'system' THEN 15 WHEN 'user' THEN 13 WHEN 'assistant' THEN 7
    ELSE 20 + len(role) + {_ESCAPED.format("role")} END)::BIGINT AS formatted_chars,
  count(*) FILTER (WHERE CASE WHEN k = 1 THEN role NOT IN ('system', 'user')
    ELSE coalesce(before || ' ' || role, '') NOT IN ('system user', 'user assistant', 'assistant user') END)::BIGINT AS n_invalid_turns
FROM t GROUP BY conv_id""")
def op2(spark, sf_dir):
    turns = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    text = "</s>[INST] ok [/INST]"
    probe = spark.createDataFrame([(-7, 0, "user", text), (-7, 1, "assistant", text)],
                                  "conv_id long, turn long, role string, text string")
    return chat_format.read_chats(chat_format.format_chats(turns.unionByName(probe)))


@_query("op3_mixing", rf"""
WITH sizes AS (
  SELECT doc_id, source, CASE WHEN text IS NULL THEN 0 ELSE len(regexp_extract_all(text, '{_W}')) END::BIGINT AS size,
    ('0x' || md5(coalesce(doc_id::VARCHAR, '-') || ':{mixing.SEED}')[1:15])::BIGINT AS order_no FROM documents),
per AS (SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source IS NULL, source) - 1 AS n FROM sizes GROUP BY source),
weighed AS (SELECT *, [5, 2, 1][(n % 3 + 1)::INT]::BIGINT AS w, source_size * 3 AS cap FROM per),
before AS (SELECT *, coalesce(sum(cap) OVER o, 0)::BIGINT AS b_cap, coalesce(sum(w) OVER o, 0)::BIGINT AS b_w,
    (sum(source_size) OVER ())::BIGINT AS total, (sum(w) OVER ())::BIGINT AS total_w FROM weighed
  WINDOW o AS (ORDER BY cap::DOUBLE / w, n ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
cut AS (SELECT min(b_cap) AS c_cap, min(b_w) AS c_w FROM before WHERE (total - b_cap) * w <= cap * (total_w - b_w)),
targets AS (SELECT source, source_size, CASE WHEN b_w < c_w THEN cap::DOUBLE
    ELSE (w * (total - c_cap))::DOUBLE / (total_w - c_w)::DOUBLE END AS target FROM before, cut),
seats AS (SELECT *, 3 * ceil(source_size / 16.0)::BIGINT AS cap, floor((sum(source_size) OVER ())::DOUBLE / 16 + 0.5)::BIGINT AS seats,
    count(*) OVER () AS n, target / nullif(sum(target) OVER (), 0) AS share FROM targets),
ranked AS (SELECT *, row_number() OVER (ORDER BY target / (2 * k + 1) DESC, source IS NULL, source) AS rank
  FROM seats, unnest(range(0, cap::BIGINT)) AS u(k) WHERE target > 0),
quotas AS (SELECT s.source, s.source_size, s.target, greatest(1, ceil(s.source_size / {mixing.SHARD_WORDS}.0))::BIGINT AS n_shards,
    count(r.k) FILTER (WHERE r.rank <= s.seats) AS quota
  FROM seats s LEFT JOIN ranked r ON s.source IS NOT DISTINCT FROM r.source GROUP BY ALL),
placed AS (SELECT z.*, q.source_size, q.target, q.quota, z.order_no % q.n_shards AS shard
  FROM sizes z JOIN quotas q ON z.source IS NOT DISTINCT FROM q.source),
shards AS (SELECT source, shard, sum(size)::BIGINT AS words, any_value(quota) AS quota, ceil(sum(size) / 16.0)::BIGINT AS n_blocks,
    ('0x' || md5(coalesce(source, '-') || ':' || shard::VARCHAR || ':{mixing.SEED}')[1:15])::BIGINT AS no FROM placed GROUP BY source, shard),
shard_ranked AS (SELECT source, shard, row_number() OVER (PARTITION BY source ORDER BY words::DOUBLE / (2 * k + 1) DESC, shard) AS rank, quota
  FROM shards, unnest(range(0, 3 * n_blocks)) AS u(k)),
won AS (SELECT source, shard, count(*) AS won FROM shard_ranked WHERE rank <= quota GROUP BY source, shard),
drawn AS (SELECT s.source, s.shard, n_blocks, coalesce(won, 0) // greatest(n_blocks, 1) AS passes, coalesce(won, 0) % greatest(n_blocks, 1) AS picked,
    [{", ".join(map(str, mixing.PRIMES))}][(no % {len(mixing.PRIMES)} + 1)::INT]::BIGINT AS step, (no // 8) % greatest(n_blocks, 1) AS shift
  FROM shards s LEFT JOIN won w ON s.source IS NOT DISTINCT FROM w.source AND s.shard = w.shard),
stream AS (SELECT *, sum(size) OVER (PARTITION BY source, shard ORDER BY order_no, doc_id, size ROWS UNBOUNDED PRECEDING)::BIGINT AS stop FROM placed)
SELECT doc_id, m.source, size, source_size, target,
  (passes * size + CASE WHEN size > 0 AND picked > 0 THEN list_sum(list_transform(range((stop - size) // 16, (stop - 1) // 16 + 1),
    lambda j: CASE WHEN (step * j + shift) % n_blocks < picked THEN least(stop, (j + 1) * 16) - greatest(stop - size, j * 16) ELSE 0 END))
    ELSE 0 END)::BIGINT AS taken
FROM stream m JOIN drawn d ON m.source IS NOT DISTINCT FROM d.source AND m.shard = d.shard""")
def op3(spark, sf_dir):
    return mixing.mix(read_table(spark, sf_dir, "documents"))


@_query("op4_perplexity_rules")
def op4(spark, sf_dir):
    return perplexity.perplexity_rules(read_table(spark, sf_dir, "documents"))


@_query("op5_packing")
def op5(spark, sf_dir):
    return packing.pack_texts(read_table(spark, sf_dir, "documents"), tokenizer_file)


@_query("op6_html_text")
def op6(spark, sf_dir):
    return html_text.extract_text(read_table(spark, sf_dir, "pages"))


@_query("op7_jaccard_join", rf"""
WITH RECURSIVE w AS (SELECT doc_id, CASE WHEN text IS NULL THEN [] ELSE regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_W}') END AS ws FROM documents),
s AS MATERIALIZED (SELECT DISTINCT doc_id, array_to_string(ws[k:k + 3], ' ') AS g
  FROM w, unnest(range(1, greatest(len(ws) - 3, 1) + 1)) AS u(k) WHERE len(ws) > 0),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
l AS MATERIALIZED (SELECT a.doc_id AS x, b.doc_id AS y FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id
  JOIN n na ON na.doc_id = a.doc_id JOIN n nb ON nb.doc_id = b.doc_id
  GROUP BY a.doc_id, b.doc_id, na.n, nb.n HAVING 100 * count(*) >= 85 * (na.n + nb.n - count(*))),
reach(x, y) AS (SELECT x, y FROM l UNION SELECT r.x, l.y FROM reach r JOIN l ON r.y = l.x)
SELECT w.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, least(w.doc_id, coalesce(min(r.y), w.doc_id)) AS component_id
FROM w LEFT JOIN n USING (doc_id) LEFT JOIN reach r ON r.x = w.doc_id GROUP BY w.doc_id, n.n""")
def op7(spark, sf_dir):
    return jaccard_join.jaccard_components(read_table(spark, sf_dir, "documents"))


@_query("op8_suffix_dedup")
def op8(spark, sf_dir):
    return suffix_dedup.remove_repeats(read_table(spark, sf_dir, "documents")).drop("kept")


@_query("op9_exact_dedup", rf"""
WITH t AS (SELECT doc_id, len(coalesce(text, '')) AS chars, regexp_replace(coalesce(text, ''), '{_B}', '', 'g') AS norm FROM documents),
r AS (SELECT *, first_value(doc_id) OVER (PARTITION BY norm ORDER BY chars DESC, doc_id) AS keep_id, count(*) OVER (PARTITION BY norm) AS group_size FROM t)
SELECT doc_id, keep_id, group_size::BIGINT AS group_size, doc_id = keep_id AS kept, sha256(norm) AS text_sha256 FROM r""")
def op9(spark, sf_dir):
    return exact_dedup.exact_dedup(read_table(spark, sf_dir, "documents"))


def training_labels(labels: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Labels that may be learned from: crc32 of the id's text mod 3 is not 1."""
    return labels.where(_remainder(id_col) != 1)


def _remainder(id_col: str):
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % 3


@_query("op10_quality_fm")
def op10(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents")
    model = quality_fm.train(docs, training_labels(read_table(spark, sf_dir, "labels")))
    scored = quality_fm.score(docs, model)
    return scored.select("doc_id", F.coalesce(_remainder("doc_id") == 1, F.lit(False)).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))


@_query("op11_hard_negatives", """
WITH e AS MATERIALIZED (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND vec_id IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x::DOUBLE))) = 0),
s AS MATERIALIZED (SELECT a.vec_id AS anchor_id, b.vec_id AS other, a.label = b.label AS same,
    list_dot_product(a.v::DOUBLE[], b.v::DOUBLE[])::BIGINT AS score
  FROM e a JOIN e b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
p AS (SELECT anchor_id, other AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5)
SELECT anchor_id, positive_id, row_number() OVER o AS rank, s.other AS negative_id, positive_score, s.score AS negative_score
FROM p JOIN s USING (anchor_id) WHERE NOT s.same AND 30 * positive_score <= 100 * s.score AND 100 * s.score <= 90 * positive_score
WINDOW o AS (PARTITION BY anchor_id, positive_id ORDER BY s.score DESC, s.other) QUALIFY rank <= 10""")
def op11(spark, sf_dir):
    rows = read_table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = hard_negatives.integer_vectors(rows, "vec_id", label, hard_negatives.floor_components("embedding"),
                                             F.col("vec_id") % 100 == 0)
    return hard_negatives.mine_hard_negatives(vectors)


def repeat_words(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """The words of one row in ten, by the crc32 of its id, from a word on repeated at a fixed distance."""
    n = len(words)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if not n or h % 10:
        return words
    g = h // 10
    a, p = g % n, 1 + (n - g % n) // (3 + g % 8)
    return words[:a] + [words[a + i % p] for i in range(n - a)]


@_query("op12_periodic_runs")
def op12(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents")
    return periodic_runs.run_digests(periodic_runs.periodic_runs(docs, prepare=repeat_words))


@_query("op13_simhash")
def op13(spark, sf_dir):
    return simhash.simhash_components(read_table(spark, sf_dir, "documents"))


@_query("pipeline")
def pipeline(spark, sf_dir):
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)
