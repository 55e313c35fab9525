"""DuckDB SQL equivalents of the registered queries (the correctness oracle).

Each statement reads the driver's views (``documents``, ``conversations``, ...)
and recomputes the same result independently of the Spark code path.
"""

from __future__ import annotations

from chatsift.plans import catalog as cat
from chatsift.plans import tables as tb
from chatsift.operators import shape as shp

ORACLE: dict[str, str] = {}


def _lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


# The chat fixture: turns with the injected variants, by conv_id % 10.
TURNS = """turns AS (
  SELECT conv_id AS id, turn, role,
    CASE WHEN conv_id % 10 = 0 AND turn = 0 THEN '  '
         WHEN conv_id % 10 BETWEEN 1 AND 6 AND role = 'assistant' THEN '<think>' || text || '</think>' || text
         WHEN conv_id % 10 = 7 AND role = 'assistant' THEN '<think>' || text
         WHEN conv_id % 10 = 8 AND role = 'assistant'
              THEN '<think>' || text || '</think>' || text || repeat(' a b c d e f g h i j', 8)
         ELSE text END AS content
  FROM conversations)"""

PLAIN_TURNS = """turns AS (SELECT conv_id AS id, turn, role, text AS content FROM conversations)"""

TAGGED = """tagged AS (SELECT *, regexp_extract_all(content, '</?think>') AS tags FROM turns)"""

VALID = """(len(tags) > 0
   AND list_sum(list_transform(tags, lambda t: CASE WHEN t = '<think>' THEN 1 ELSE -1 END)) = 0
   AND list_min(list_transform(range(1, len(tags) + 1),
         lambda i: list_sum(list_transform(tags[1:i], lambda t: CASE WHEN t = '<think>' THEN 1 ELSE -1 END)))) >= 0)"""

CONV_FLAGS = f"""conv AS (
  SELECT id,
    bool_and(regexp_matches(coalesce(content, ''), '[^\\s\\x0b\\x1c-\\x1f]')) AS ok_empty,
    bool_and(CASE WHEN role = 'assistant' THEN coalesce({VALID}, false) ELSE true END) AS ok_think,
    coalesce(string_agg(content, ' ' ORDER BY turn) FILTER (WHERE role = 'assistant'), '') AS atext,
    string_agg(content, ' ' ORDER BY turn) AS alltext
  FROM tagged GROUP BY id)"""


def loops_cte(name: str, src: str, id_col: str, text_col: str, n: int, k: int) -> str:
    """``name(id)``: rows of ``src`` whose text has an n-gram occurring more than k times."""
    return f"""{name}_w AS (
  SELECT {id_col} AS id, list_filter(regexp_split_to_array({text_col}, '[\\s\\x0b\\x1c-\\x1f]+'), lambda w: w <> '') AS w
  FROM {src}),
{name}_g AS (
  SELECT id, unnest(list_transform(range(1, len(w) - {n} + 2), lambda i: array_to_string(w[i:i + {n - 1}], ' '))) AS g
  FROM {name}_w WHERE len(w) >= {n}),
{name} AS (SELECT DISTINCT id FROM {name}_g GROUP BY id, g HAVING count(*) > {k})"""


def norm_lang(col: str) -> str:
    inner = f"trim(regexp_replace(lower({col}), '[^\\p{{L}}]+', ' ', 'g'))"
    return f"CASE WHEN length({inner}) > 0 THEN ' ' || {inner} || ' ' END"


def trigram_list(t: str) -> str:
    return f"list_transform(range(1, length({t}) - 1), lambda i: substring({t}, i, 3))"


PROFILES = f"""ld AS (SELECT lang, {norm_lang('text')} AS t FROM documents),
lg AS (SELECT lang, unnest({trigram_list('t')}) AS gram FROM ld WHERE t IS NOT NULL),
lc AS (SELECT lang, gram, count(*) AS cnt FROM lg GROUP BY lang, gram),
lk AS (SELECT lang, gram, cnt FROM lc),
lt AS (SELECT lang, sum(cnt) AS total FROM lk GROUP BY lang),
lv AS (SELECT count(DISTINCT gram) AS v FROM lk),
prof AS (SELECT lk.lang, lk.gram, lk.cnt,
           ln((lk.cnt + 1) / CAST(lt.total + lv.v AS DOUBLE)) AS logp,
           ln(1.0 / CAST(lt.total + lv.v AS DOUBLE)) AS unseen
         FROM lk JOIN lt USING (lang) CROSS JOIN lv)"""


def detect_ctes(src: str, id_col: str, text_col: str, out: str = "det") -> str:
    """``out(id, detected_lang)`` for every row of ``src`` (needs PROFILES): scores are sums of whole millionths."""
    return f"""{out}_t AS MATERIALIZED (SELECT row_number() OVER () AS rid, {id_col} AS id, {norm_lang(text_col)} AS t FROM {src}),
{out}_g AS (SELECT rid, unnest({trigram_list('t')}) AS gram FROM {out}_t WHERE t IS NOT NULL),
{out}_n AS (SELECT rid, length(t) - 2 AS n FROM {out}_t WHERE t IS NOT NULL),
{out}_l AS (SELECT DISTINCT lang, CAST(round(unseen * 1e6) AS BIGINT) AS unseen FROM prof),
{out}_p AS (SELECT lang, gram, CAST(round((logp - unseen) * 1e6) AS BIGINT) AS w FROM prof),
{out}_m AS (SELECT g.rid, p.lang, sum(p.w) AS d FROM {out}_g g JOIN {out}_p p USING (gram) GROUP BY g.rid, p.lang),
{out}_s AS (SELECT n.rid, l.lang, n.n * l.unseen + coalesce(m.d, 0) AS s
            FROM {out}_n n CROSS JOIN {out}_l l LEFT JOIN {out}_m m ON m.rid = n.rid AND m.lang = l.lang),
{out}_b AS (SELECT rid, lang FROM (
        SELECT *, row_number() OVER (PARTITION BY rid ORDER BY s DESC, lang DESC) AS r FROM {out}_s) WHERE r = 1),
{out} AS (SELECT t.id, b.lang AS detected_lang FROM {out}_t t LEFT JOIN {out}_b b USING (rid))"""


def md5_turns(pairs: list[tuple[str, str]]) -> str:
    """md5 of ``role:content`` pairs joined by ``|`` (roles are SQL literals/expressions)."""
    parts = " || '|' || ".join(f"{r} || ':' || {c}" for r, c in pairs)
    return f"md5({parts})"


TURN_PAIRS = f"""pairs AS (
  SELECT u.conv_id * {tb.TURN_IDS} + u.turn AS id, u.text AS prompt, a.text AS completion, u.conv_id
  FROM conversations u JOIN conversations a ON a.conv_id = u.conv_id AND a.turn = u.turn + 1
  WHERE u.role = 'user' AND a.role = 'assistant' AND u.text IS NOT NULL AND a.text IS NOT NULL)"""

PREFS = f"""prefs AS (
  SELECT u.conv_id * {tb.TURN_IDS} + u.turn AS conv_id, u.text AS prompt, a.text AS chosen, b.text AS rejected
  FROM conversations u LEFT JOIN conversations a ON a.conv_id = u.conv_id AND a.turn = u.turn + 1
  LEFT JOIN conversations b ON b.conv_id = u.conv_id AND b.turn = u.turn + 3
  WHERE u.role = 'user')"""

INSTR = """instr AS (
  SELECT CASE WHEN item_id % 3 = 0 THEN 'Tu es un assistant.' ELSE '' END AS system,
         text AS instruction,
         CASE WHEN item_id % 2 = 0 THEN 'Contexte ' || CAST(item_id AS VARCHAR) ELSE '' END AS input,
         CASE WHEN item_id % 5 = 0 THEN '' ELSE 'Réponse : ' || text END AS output,
         CASE WHEN item_id % 5 = 0 AND item_id % 10 <> 0 THEN 'r' || CAST(item_id AS VARCHAR) END AS response
  FROM benchmark),
instr_msgs AS (
  SELECT system, (CASE WHEN input <> '' THEN instruction || chr(10) || input ELSE instruction END) AS u,
         (CASE WHEN output <> '' THEN output ELSE response END) AS a
  FROM instr)"""

INSTR_SUMMARY = """SELECT CAST(CASE WHEN coalesce(system, '') <> '' THEN 3 ELSE 2 END AS INTEGER) AS n_messages,
       CASE WHEN coalesce(system, '') <> '' THEN 'system,user,assistant' ELSE 'user,assistant' END AS roles,
       md5(CASE WHEN coalesce(system, '') <> '' THEN system || chr(1) ELSE '' END
           || coalesce(u, '<null>') || chr(1) || coalesce(a, '<null>')) AS content_md5
FROM instr_msgs"""

SEQS = f"""seqs AS (
  SELECT doc_id // {tb.SEQ_STEP} AS step, doc_id AS seq_id,
         list_slice(ids, 1, {tb.PROMPT_WORDS}) AS prompt_ids,
         list_slice(ids, {tb.PROMPT_WORDS + 1}, greatest(len(ids), 1)) AS completion_ids
  FROM (SELECT doc_id, list_transform(list_filter(regexp_split_to_array(text, '[\\s\\x0b\\x1c-\\x1f]+'), lambda w: w <> ''),
                                      lambda w: CAST(length(w) AS INTEGER)) AS ids FROM documents))"""

TRUNC = f"(CASE WHEN len(completion_ids) = 0 THEN true ELSE completion_ids[-1] NOT IN ({tb.EOS_ID}, {tb.PAD_ID}) END)"

DIST = f"""dist AS (
  SELECT e.vec_id // {tb.VEC_PER_SEQ * tb.SEQ_PER_STEP} AS step, e.vec_id // {tb.VEC_PER_SEQ} AS seq_id,
         CAST(e.vec_id % {tb.VEC_PER_SEQ} AS INTEGER) AS pos, CAST(e.label AS INTEGER) AS token,
         CAST(CASE WHEN e.label = 0 AND e.vec_id % {tb.VEC_PER_SEQ} >= 12 THEN 0 ELSE 1 END AS INTEGER) AS mask,
         list_transform(e.embedding, lambda v: CAST(v AS DOUBLE)) AS student,
         list_transform(n.embedding, lambda v: CAST(v AS DOUBLE)) AS teacher
  FROM embeddings e JOIN (SELECT embedding, CASE WHEN vec_id = (SELECT min(vec_id) FROM embeddings)
    THEN (SELECT max(vec_id) FROM embeddings) ELSE vec_id - 1 END AS vec_id FROM embeddings) n ON n.vec_id = e.vec_id)"""


def lse(x: str, temp: float = 1.0) -> str:
    return (f"(list_max({x}) / {temp} + ln(list_sum(list_transform({x}, "
            f"lambda v: exp(v / {temp} - list_max({x}) / {temp})))))")


LOGP = f"""lp AS (
  SELECT *, list_transform(student, lambda v: v - {lse('student')}) AS ls,
            list_transform(teacher, lambda v: v - {lse('teacher')}) AS lt,
            list_transform(student, lambda v: v / 2.0 - {lse('student', 2.0)}) AS lr
  FROM dist)"""

TOKENS = """toks AS (
  SELECT step, seq_id, pos, mask,
         ls[token + 1] AS logp, lt[token + 1] AS teacher_logp, lr[token + 1] AS ref_logp,
         -list_sum(list_transform(ls, lambda x: exp(x) * x)) AS entropy
  FROM lp)"""


def kl_sql(p: str, q: str) -> str:
    return f"list_sum(list_transform(range(1, len({p}) + 1), lambda i: exp({p}[i]) * ({p}[i] - {q}[i])))"


def jsd_sql(s: str, t: str, a: float) -> str:
    lm = f"ln({1.0 - a} * exp({s}[i]) + {a} * exp({t}[i]))"
    return (f"list_sum(list_transform(range(1, len({s}) + 1), lambda i: "
            f"{a} * exp({t}[i]) * ({t}[i] - {lm}) + {1.0 - a} * exp({s}[i]) * ({s}[i] - {lm})))")


def skip(mask: str = "mask", pos: str = "pos") -> str:
    return f"(CASE WHEN {pos} >= {cat.SKIP_TOKENS} THEN {mask} ELSE 0 END)"


def q(name: str, sql: str) -> None:
    ORACLE[name] = sql.strip()


# ------------------------------------------------------------- sources ---

q("read_split", "SELECT doc_id, lang, source, n_chars FROM documents")

q("conversation_messages", f"""
WITH {PLAIN_TURNS}
SELECT id, CAST(count(*) AS INTEGER) AS n_messages, string_agg(role, ',' ORDER BY turn) AS roles,
       md5(string_agg(coalesce(content, '<null>'), chr(1) ORDER BY turn)) AS content_md5
FROM turns GROUP BY id""")

q("done_ids", f"""
SELECT DISTINCT CASE WHEN conv_id % 7 = 3 THEN 'c' || CAST(conv_id * {tb.TURN_IDS} + turn AS VARCHAR) ELSE CAST(conv_id * {tb.TURN_IDS} + turn AS VARCHAR) END AS id
FROM conversations WHERE conv_id % 7 NOT IN (0, 1, 2)""")

GENS = f"""gens AS (
  SELECT c.id, CAST(c.n AS INTEGER) AS n_messages,
         CASE WHEN c.id % 3 = 0 THEN 'length' ELSE 'stop' END AS finish_reason,
         CASE WHEN c.id % 4 = 0 THEN NULL
              ELSE CAST(len(list_filter(regexp_split_to_array(c.atext, '[\\s\\x0b\\x1c-\\x1f]+'), lambda w: w <> '')) AS BIGINT)
         END AS completion_tokens
  FROM (SELECT id, count(*) AS n,
               coalesce(string_agg(content, ' ' ORDER BY turn) FILTER (WHERE role = 'assistant'), '') AS atext
        FROM turns GROUP BY id) c)"""

q("jsonl_strict", f"""
WITH {TURNS}, {GENS}
SELECT id, finish_reason, completion_tokens, n_messages FROM gens""")

# --------------------------------------------------------- projections ---

q("column_map", "SELECT doc_id AS id, text AS content, lang, source, n_chars FROM documents")

q("prune_columns", "SELECT text AS prompt FROM benchmark")

q("instruction_to_messages", f"WITH {INSTR} {INSTR_SUMMARY}")

q("sft_format", f"""
WITH {PLAIN_TURNS}, {INSTR}
SELECT id, CAST(count(*) AS INTEGER) AS n_messages, string_agg(role, ',' ORDER BY turn) AS roles,
       md5(string_agg(coalesce(content, '<null>'), chr(1) ORDER BY turn)) AS content_md5
FROM turns GROUP BY id
UNION ALL
SELECT NULL AS id, * FROM ({INSTR_SUMMARY})""")

q("preference_pairs", f"""
WITH {PREFS}
SELECT conv_id,
       {md5_turns([("'user'", "coalesce(prompt, 'None')")])} AS prompt_md5,
       {md5_turns([("'assistant'", "coalesce(chosen, 'None')")])} AS chosen_md5,
       {md5_turns([("'assistant'", "coalesce(rejected, 'None')")])} AS rejected_md5
FROM prefs""")

q("to_chat", f"""
WITH rows AS (
  SELECT conv_id,
         coalesce(string_agg(text, chr(10) ORDER BY turn) FILTER (WHERE role = 'assistant'), '') AS chosen,
         arg_max(text, turn) AS rej,
         CASE WHEN count(*) > 3 THEN count(*) END AS score
  FROM conversations GROUP BY conv_id)
SELECT conv_id,
       {md5_turns([("'user'", "''")])} AS prompt_md5,
       {md5_turns([("'assistant'", "chosen")])} AS chosen_md5,
       {md5_turns([("'assistant'", "coalesce(rej, 'None')")])} AS rejected_md5,
       {md5_turns([("'user'", "coalesce(CAST(score AS VARCHAR), 'None')")])} AS score_md5
FROM rows""")

TEACHER_TEXT = ("p.prompt || chr(10) || 'This is an example for a response to the question:' || chr(10) || "
                "p.completion || chr(10) || 'Now answer with a response of your own, including the thinking process:'")

q("teacher_prompts", f"""
WITH {TURN_PAIRS},
p AS (SELECT id, CASE WHEN id % 5 = 0 THEN prompt || ' {{completion}}' ELSE prompt END AS prompt, completion FROM pairs)
SELECT id,
       {md5_turns([("'user'", "p.prompt")])} AS prompt_md5,
       {md5_turns([("'system'", _lit(cat.TEACHER_SYSTEM)), ("'user'", TEACHER_TEXT)])} AS teacher_md5
FROM p""")

GEN_USER = ("prompt || chr(10) || chr(10) || 'This is an example for a response to the question:' || chr(10) || "
            "completion || chr(10) || chr(10) || 'Now answer with a response of your own, including the thinking process.'")

q("generation_requests", f"""
WITH {TURN_PAIRS}
SELECT id, {md5_turns([("'user'", GEN_USER), ("'assistant'", _lit(shp.ASSISTANT_PREFILL))])} AS request_md5
FROM pairs""")

q("assemble_generations", f"""
WITH {TURN_PAIRS}
SELECT p.id,
       {md5_turns([("'user'", "p.prompt"), ("'assistant'", _lit(shp.ASSISTANT_PREFILL) + " || CASE l.quality WHEN 1 THEN 'True' ELSE 'False' END")])} AS messages_md5,
       'stop' AS finish_reason, CAST(1 AS BIGINT) AS completion_tokens
FROM pairs p JOIN labels l ON l.doc_id = p.conv_id WHERE l.quality IN (0, 1)""")

JUDGE_TEXT = "string_agg(upper(role) || ':' || chr(10) || content, chr(10) || chr(10) ORDER BY turn)"

q("judge_text", f"WITH {TURNS} SELECT id, md5({JUDGE_TEXT}) AS judge_text_md5 FROM turns GROUP BY id")

q("judge_requests", f"""
WITH {TURNS}
SELECT id, 2 AS n_messages,
       {md5_turns([("'system'", _lit(shp.PIPELINE_JUDGE_PROMPT)), ("'user'", JUDGE_TEXT)])} AS request_md5
FROM turns GROUP BY id""")

q("chat_render", f"""
WITH {TURNS}
SELECT id, md5(string_agg('<|im_start|>' || role || chr(10) || content || '<|im_end|>' || chr(10), '' ORDER BY turn)
               || '<|im_start|>assistant' || chr(10)) AS render_md5
FROM turns GROUP BY id""")

q("assistant_text", f"""
WITH {TURNS},
a AS (SELECT id, coalesce(string_agg(content, ' ' ORDER BY turn) FILTER (WHERE role = 'assistant'), '') AS t
      FROM turns GROUP BY id)
SELECT id, md5(t) AS assistant_md5, CAST(length(t) AS INTEGER) AS assistant_chars FROM a""")

q("rejected_preview", """
WITH p AS (SELECT doc_id, CASE WHEN length(text) > 500 THEN substring(text, 1, 500) || '...' ELSE text END AS t
           FROM documents)
SELECT doc_id, md5(t) AS preview_md5, CAST(length(t) AS INTEGER) AS preview_chars FROM p""")

q("clip_pad", f"""
WITH {SEQS},
c AS (SELECT seq_id, list_slice(completion_ids, 1, {cat.CLIP_LEN}) AS cl,
             list_slice(prompt_ids, greatest(len(prompt_ids) - {cat.CLIP_LEN} + 1, 1), len(prompt_ids)) AS pr
      FROM seqs)
SELECT seq_id,
       array_to_string(list_concat(cl, list_transform(range(greatest({cat.CLIP_LEN} - len(cl), 0)), lambda x: 0)), ',') AS completion_padded,
       CAST(len(cl) AS INTEGER) AS mask_sum,
       array_to_string(list_concat(list_transform(range(greatest({cat.CLIP_LEN} - len(pr), 0)), lambda x: 0), pr), ',') AS prompt_padded
FROM c""")

# ------------------------------------------------------------- filters ---

q("filter_empty", f"WITH {TURNS}, {TAGGED}, {CONV_FLAGS} SELECT id FROM conv WHERE ok_empty")

q("think_tags", f"""
WITH {TURNS}, {TAGGED}
SELECT id, CAST(turn AS INTEGER) AS turn, coalesce({VALID}, false) AS valid FROM tagged WHERE role = 'assistant'""")

q("filter_think", f"WITH {TURNS}, {TAGGED}, {CONV_FLAGS} SELECT id FROM conv WHERE ok_think")

for key, (n, k) in {"ngram_loop_docs": (10, 5), "ngram_loop_docs_10_3": (10, 3), "ngram_loop_docs_20_5": (20, 5)}.items():
    q(key, f"""
WITH {loops_cte('loops', 'documents', 'doc_id', 'text', n, k)}
SELECT d.doc_id, l.id IS NOT NULL AS loop FROM documents d LEFT JOIN loops l ON l.id = d.doc_id""")

q("ngram_loop_exploded", f"WITH {loops_cte('loops', 'documents', 'doc_id', 'text', 10, 5)} SELECT id AS doc_id FROM loops")

q("filter_ngram", f"""
WITH {TURNS}, {TAGGED}, {CONV_FLAGS}, {loops_cte('loops', 'conv', 'id', 'atext', 10, 5)}
SELECT id FROM conv WHERE id NOT IN (SELECT id FROM loops)""")

REPLIES = """replies AS (
  SELECT doc_id,
         CASE WHEN quality = 1 THEN (CASE WHEN doc_id % 2 = 0 THEN 'True' ELSE 'not true, False' END)
              ELSE (CASE WHEN doc_id % 3 = 0 THEN ' FALSE.' WHEN doc_id % 3 = 1 THEN 'yes' ELSE 'false' END) END AS reply
  FROM labels)"""

VERDICT = "(CASE WHEN lower(reply) LIKE '%true%' THEN true WHEN lower(reply) LIKE '%false%' THEN false END)"

q("parse_verdict", f"WITH {REPLIES} SELECT doc_id, reply, {VERDICT} AS verdict FROM replies")

q("judge_filter", f"""
WITH {TURNS}
SELECT t.id, CAST(count(*) AS INTEGER) AS n_messages
FROM turns t JOIN labels l ON l.doc_id = t.id AND l.quality = 1 GROUP BY t.id""")


def render2(p: str, a: str) -> str:
    return (f"'<|im_start|>user' || chr(10) || {p} || '<|im_end|>' || chr(10) || "
            f"'<|im_start|>assistant' || chr(10) || {a} || '<|im_end|>' || chr(10)")


PRETOK = "'(\\p{L}+|\\p{N}+|[^\\p{L}\\p{N}\\s])'"


def tokcount(x: str) -> str:
    return f"len(regexp_extract_all({x}, {PRETOK}, 1))"


q("filter_overlength", f"""
WITH {PREFS}
SELECT conv_id FROM prefs
WHERE greatest({tokcount(render2("coalesce(prompt, 'None')", "coalesce(chosen, 'None')"))},
               {tokcount(render2("coalesce(prompt, 'None')", "coalesce(rejected, 'None')"))}) <= {cat.OVERLENGTH_MAX}""")

STUDENT_RENDER = "'<|im_start|>user' || chr(10) || prompt || '<|im_end|>' || chr(10) || '<|im_start|>assistant' || chr(10)"
TEACHER_RENDER = ("'<|im_start|>system' || chr(10) || " + _lit(cat.TEACHER_SYSTEM) + " || '<|im_end|>' || chr(10) || "
                  "'<|im_start|>user' || chr(10) || " + TEACHER_TEXT.replace("p.", "") +
                  " || '<|im_end|>' || chr(10) || '<|im_start|>assistant' || chr(10)")

q("filter_long_prompts", f"""
WITH {TURN_PAIRS}
SELECT id FROM pairs
WHERE {tokcount(STUDENT_RENDER)} <= {cat.PROMPT_MAX} AND {tokcount(TEACHER_RENDER)} <= {cat.PROMPT_MAX}""")

LOOP_ROWS = f"""samp AS (
  SELECT item_id AS id, text FROM benchmark
  ORDER BY md5('{cat.SEED}:' || CAST(item_id AS VARCHAR)), item_id LIMIT {cat.LOOP_SAMPLE_N}),
gen AS (SELECT s.id, 'Question: ' || s.text || chr(10) AS prompt, d.text AS generated,
               CASE WHEN d.n_chars > 5000 THEN 'length' ELSE 'stop' END AS finish_reason
        FROM samp s JOIN documents d ON d.doc_id = s.id),
{loops_cte('gl', 'gen', 'id', 'generated', 10, 3)},
flags AS (SELECT id, prompt, finish_reason = 'length' AS no_eos, id IN (SELECT id FROM gl) AS ngram_loop FROM gen)"""

q("loop_flags", f"""
WITH {LOOP_ROWS}
SELECT id, md5(prompt) AS prompt_md5, no_eos, ngram_loop, no_eos OR ngram_loop AS looping FROM flags""")

q("loop_report", f"""
WITH {LOOP_ROWS},
a AS (SELECT count(*) AS samples, CAST(sum(CAST(no_eos AS BIGINT)) AS BIGINT) AS no_eos,
             CAST(sum(CAST(ngram_loop AS BIGINT)) AS BIGINT) AS ngram_loop,
             CAST(sum(CAST(no_eos OR ngram_loop AS BIGINT)) AS BIGINT) AS looping FROM flags)
SELECT samples, no_eos, ngram_loop, looping,
       CASE WHEN samples > 0 THEN round(100.0::DOUBLE * no_eos / samples, 6) END AS no_eos_pct,
       CASE WHEN samples > 0 THEN round(100.0::DOUBLE * ngram_loop / samples, 6) END AS ngram_loop_pct,
       CASE WHEN samples > 0 THEN round(100.0::DOUBLE * looping / samples, 6) END AS looping_pct
FROM a""")

q("truncated_flag", f"""
WITH {SEQS}
SELECT seq_id, {TRUNC} AS truncated, CAST(CASE WHEN {TRUNC} THEN 0 ELSE len(completion_ids) END AS INTEGER) AS mask_sum
FROM seqs""")

# ----------------------------------------------- joins, sets, sampling ---

DONE = f"""done AS (
  SELECT DISTINCT CASE WHEN conv_id % 7 = 3 THEN 'c' || CAST(conv_id * {tb.TURN_IDS} + turn AS VARCHAR) ELSE CAST(conv_id * {tb.TURN_IDS} + turn AS VARCHAR) END AS id
  FROM conversations WHERE conv_id % 7 NOT IN (0, 1, 2))"""

q("resume_anti", f"""
WITH {TURN_PAIRS}, {DONE}
SELECT id FROM pairs WHERE CAST(id AS VARCHAR) NOT IN (SELECT id FROM done)""")
q("resume_limit", ORACLE["resume_anti"] + " ORDER BY id LIMIT 25")

q("mix", """
SELECT doc_id, lang, NULL::BIGINT AS n_chars FROM documents WHERE source IN ('src0', 'src1', 'src2', 'src3', 'src4')
UNION ALL
SELECT doc_id, NULL::VARCHAR AS lang, n_chars FROM documents WHERE source NOT IN ('src0', 'src1', 'src2', 'src3', 'src4')""")

q("max_samples", f"SELECT doc_id, lang FROM documents ORDER BY doc_id LIMIT {cat.MAX_SAMPLES}")

HKEY = f"md5('{cat.SEED}:' || CAST(doc_id AS VARCHAR)), doc_id"

q("seeded_sample", f"SELECT doc_id, source FROM documents ORDER BY {HKEY} LIMIT {cat.SAMPLE_N}")

RANKED = f"""ranked AS (
  SELECT doc_id, lang, row_number() OVER (ORDER BY {HKEY}) AS rn,
         CAST(floor(count(*) OVER () * {cat.SPLIT_RATIO}::DOUBLE) AS BIGINT) AS n_val
  FROM documents)"""

q("split_val", f"WITH {RANKED} SELECT doc_id, lang FROM ranked WHERE rn <= n_val")
q("split_train", f"WITH {RANKED} SELECT doc_id, lang FROM ranked WHERE rn > n_val")

_B = cat.BATCH[0] * cat.BATCH[1] * cat.BATCH[2]
_S = cat.BATCH[2]
q("batch_plan", f"""
WITH r AS (SELECT doc_id, row_number() OVER (ORDER BY {HKEY}) - 1 AS rk, count(*) OVER () AS total FROM documents),
b AS (SELECT doc_id, CAST(rk // {_B} AS BIGINT) AS generation_batch, CAST(rk % {_B} AS BIGINT) AS slot, unnest(range({_S})) AS rep
      FROM r WHERE rk < (total // {_B}) * {_B})
SELECT doc_id, generation_batch, CAST(rep AS INTEGER) AS repeat, slot,
       (generation_batch * {_S} + rep) * {_B} + slot AS sample_index
FROM b""")

# -------------------------------------------------------------- reports ---


def funnel_sql(stage_exprs: list[tuple[str, str]], ctes: str) -> str:
    """``stage_exprs``: (name, cumulative flag column) in order."""
    parts = []
    prev = "count(*)"
    for i, (name, flag) in enumerate(stage_exprs):
        after = f"count(*) FILTER (WHERE {flag})"
        parts.append(f"SELECT {i + 1} AS stage_order, {_lit(name)} AS stage, {prev} AS before, {after} AS after FROM flags")
        prev = after
    last = stage_exprs[-1][1]
    parts.append(f"SELECT {len(stage_exprs) + 1}, 'TOTAL', count(*), count(*) FILTER (WHERE {last}) FROM flags")
    body = "\nUNION ALL ".join(parts)
    return f"WITH {ctes}\nSELECT stage_order, stage, before, after, before - after AS removed FROM ({body})"


FUNNEL_BASE = f"{TURNS}, {TAGGED}, {CONV_FLAGS}, {loops_cte('loops', 'conv', 'id', 'atext', 10, 5)}"

q("funnel", funnel_sql(
    [("Empty content", "f1"), ("Think tags", "f2"), ("N-gram repetition", "f3")],
    FUNNEL_BASE + """,
flags AS (SELECT id, ok_empty AS f1, ok_empty AND ok_think AS f2,
                 ok_empty AND ok_think AND id NOT IN (SELECT id FROM loops) AS f3 FROM conv)"""))

q("funnel_lang", funnel_sql(
    [("Empty content", "f1"), ("Think tags", "f2"), ("Language (fr)", "f3"), ("N-gram repetition", "f4")],
    FUNNEL_BASE + f""", {PROFILES}, {detect_ctes('conv', 'id', 'alltext', 'det')},
flags AS (SELECT c.id, ok_empty AS f1, ok_empty AND ok_think AS f2,
                 ok_empty AND ok_think AND coalesce(d.detected_lang = 'fr', false) AS f3,
                 ok_empty AND ok_think AND coalesce(d.detected_lang = 'fr', false) AND c.id NOT IN (SELECT id FROM loops) AS f4
          FROM conv c LEFT JOIN det d USING (id))"""))

# Ids play no part in the stages: the funnel of rows with null ids is the same.
q("funnel_lang_null_id", ORACLE["funnel_lang"])

q("curate_kept", f"""
WITH {FUNNEL_BASE}, n AS (SELECT id, count(*) AS n FROM turns GROUP BY id)
SELECT c.id, CAST(n.n AS INTEGER) AS n_messages FROM conv c JOIN n USING (id)
WHERE ok_empty AND ok_think AND c.id NOT IN (SELECT id FROM loops)""")


def freq_sql(label_expr: str, label: str, src: str, ctes: str = "") -> str:
    w = f"WITH {ctes}, " if ctes else "WITH "
    return f"""{w}g AS (SELECT {label_expr} AS {label}, count(*) AS "count" FROM {src} GROUP BY 1),
t AS (SELECT *, sum("count") OVER () AS total FROM g),
f AS (SELECT *, CAST(CASE WHEN total > 0 THEN floor(30 * "count" / total) ELSE 0 END AS INTEGER) AS filled FROM t)
SELECT {label}, "count", CASE WHEN total > 0 THEN round(100.0::DOUBLE * "count" / total, 6) ELSE 0.0 END AS pct,
       '[' || repeat('|', filled) || repeat('.', 30 - filled) || ']' AS bar
FROM f"""


q("freq_table", freq_sql("source", "label", "documents"))
q("finish_reasons", freq_sql("event_type", "finish_reason", "events"))

THINK_CONTENT = """CASE WHEN strpos(content, '</think>') = 0 THEN NULL
     ELSE substring(content,
                    CASE WHEN strpos(content, '<think>') > 0 THEN strpos(content, '<think>') + 7 ELSE 1 END,
                    greatest(strpos(content, '</think>') - 1
                             - CASE WHEN strpos(content, '<think>') > 0 THEN strpos(content, '<think>') - 1 + 7 ELSE 0 END, 0))
END"""

LANG_NAMES_SQL = "CASE lang_key " + " ".join(
    f"WHEN {_lit(k)} THEN {_lit(v)}" for k, v in __import__("chatsift.operators.reports", fromlist=["LANG_NAMES"]).LANG_NAMES.items()
) + " ELSE lang_key END"

q("think_language", freq_sql(
    LANG_NAMES_SQL, "language", "keys",
    f"""{TURNS}, {PROFILES},
tc AS (SELECT id, string_agg({THINK_CONTENT}, ' ' ORDER BY turn) FILTER (WHERE role = 'assistant' AND strpos(content, '</think>') > 0) AS think
       FROM turns GROUP BY id),
{detect_ctes('tc', 'id', 'think', 'det')},
keys AS (SELECT tc.id, CASE WHEN tc.think IS NULL THEN 'no_think' ELSE coalesce(det.detected_lang, 'unknown') END AS lang_key
         FROM tc JOIN det USING (id))"""))

q("looping_report", f"""
WITH {TURNS},
a AS (SELECT id, coalesce(string_agg(content, ' ' ORDER BY turn) FILTER (WHERE role = 'assistant'), '') AS atext
      FROM turns GROUP BY id),
{loops_cte('loops', 'a', 'id', 'atext', 10, 3)},
c AS (SELECT count(*) AS total, count(*) FILTER (WHERE id IN (SELECT id FROM loops)) AS looping FROM a),
g AS (SELECT 'Looping' AS label, looping AS "count", total FROM c
      UNION ALL SELECT 'Clean', total - looping, total FROM c),
f AS (SELECT *, CAST(CASE WHEN total > 0 THEN floor(30 * "count" / total) ELSE 0 END AS INTEGER) AS filled FROM g)
SELECT label, "count", CASE WHEN total > 0 THEN round(100.0::DOUBLE * "count" / total, 6) ELSE 0.0 END AS pct,
       '[' || repeat('|', filled) || repeat('.', 30 - filled) || ']' AS bar
FROM f""")

q("completion_tokens", f"""
WITH {TURNS}, {GENS}
SELECT count(completion_tokens) AS n, min(completion_tokens) AS min_tokens, max(completion_tokens) AS max_tokens,
       round(avg(completion_tokens), 6) AS avg_tokens
FROM gens HAVING count(completion_tokens) > 0""")

q("token_count", f"SELECT doc_id, CAST({tokcount('text')} AS INTEGER) AS tokens FROM documents")

q("token_stats", f"""
WITH t AS (SELECT CAST({tokcount('text')} AS INTEGER) AS tokens FROM documents)
SELECT count(tokens) AS samples, round(avg(tokens), 6) AS avg_tokens, min(tokens) AS min_tokens, max(tokens) AS max_tokens,
       CAST(quantile_disc(tokens, 0.5 ORDER BY tokens DESC) AS BIGINT) AS median_tokens
FROM t""")

CHAT_IDS = "cid AS (SELECT DISTINCT conv_id AS id FROM conversations)"

q("judge_summary", f"""
WITH {CHAT_IDS},
v AS (SELECT coalesce(l.quality = 1, false) AS verdict FROM cid LEFT JOIN labels l ON l.doc_id = cid.id),
a AS (SELECT CAST(sum(CASE WHEN verdict THEN 1 ELSE 0 END) AS BIGINT) AS accepted,
             CAST(sum(CASE WHEN verdict THEN 0 ELSE 1 END) AS BIGINT) AS rejected FROM v)
SELECT accepted, rejected,
       CASE WHEN accepted + rejected > 0 THEN round(100.0::DOUBLE * accepted / (accepted + rejected), 6) END AS pass_rate
FROM a""")

q("map_model_stub", f"""
WITH {CHAT_IDS}
SELECT cid.id, CASE l.quality WHEN 1 THEN 'True' WHEN 0 THEN 'False' END AS reply,
       l.quality IS NULL OR l.quality NOT IN (0, 1) AS has_error
FROM cid LEFT JOIN labels l ON l.doc_id = cid.id""")

q("generation_summary", f"""
WITH {TURN_PAIRS}, {DONE},
todo AS (SELECT p.id, p.conv_id FROM pairs p WHERE CAST(p.id AS VARCHAR) NOT IN (SELECT id FROM done)),
r AS (SELECT t.id, l.quality IN (0, 1) AS ok FROM todo t LEFT JOIN labels l ON l.doc_id = t.conv_id)
SELECT (SELECT count(*) FROM pairs) AS total_samples,
       (SELECT count(*) FROM done) + (SELECT count(*) FROM r WHERE ok) AS generated,
       (SELECT count(*) FROM r WHERE ok IS NOT TRUE) AS errors""")

# ---------------------------------------------------------- text / lang ---

q("think_content", f"""
WITH {TURNS}
SELECT id, CAST(turn AS INTEGER) AS turn, md5({THINK_CONTENT}) AS think_md5, CAST(length({THINK_CONTENT}) AS INTEGER) AS think_chars
FROM turns WHERE role = 'assistant'""")

q("lang_profiles", f"WITH {PROFILES} SELECT lang, gram, cnt, round(logp, 6) AS logp FROM prof")

q("detect_lang", f"WITH {PROFILES}, {detect_ctes('documents', 'doc_id', 'text', 'det')} SELECT id AS doc_id, detected_lang FROM det")

q("detect_lang_repeated_ids", f"""
WITH {PROFILES}, src AS (SELECT CASE WHEN doc_id % 7 <> 0 THEN doc_id % 50 END AS id, text FROM documents),
{detect_ctes('src', 'id', 'text', 'det')} SELECT id, detected_lang FROM det""")

q("filter_language", f"""
WITH {TURNS}, a AS (SELECT id, string_agg(content, ' ' ORDER BY turn) AS t FROM turns GROUP BY id),
{PROFILES}, {detect_ctes('a', 'id', 't', 'det')}
SELECT id FROM det WHERE detected_lang = 'fr'""")

# ------------------------------------------------------------ token logs ---

q("log_softmax", f"""
WITH e AS (SELECT vec_id, label, list_transform(embedding, lambda v: CAST(v AS DOUBLE)) AS x FROM embeddings),
l AS (SELECT vec_id, label, list_transform(x, lambda v: v - {lse('x')}) AS lp FROM e)
SELECT vec_id, round(lp[label + 1], 6) AS label_logp, round(list_sum(list_transform(lp, lambda v: exp(v))), 6) AS prob_sum,
       round(list_max(lp), 6) AS max_logp
FROM l""")

q("entropy", f"""
WITH e AS (SELECT vec_id, list_transform(embedding, lambda v: CAST(v AS DOUBLE)) AS x FROM embeddings),
l AS (SELECT vec_id, list_transform(x, lambda v: v / 2.0 - {lse('x', 2.0)}) AS lp FROM e)
SELECT vec_id, round(-list_sum(list_transform(lp, lambda v: exp(v) * v)), 6) AS entropy FROM l""")

q("divergence", f"""
WITH {DIST}, {LOGP}
SELECT step, seq_id, pos, round({kl_sql('lt', 'ls')}, 6) AS div_0_0, round({jsd_sql('ls', 'lt', 0.5)}, 6) AS div_0_5,
       round({kl_sql('ls', 'lt')}, 6) AS div_1_0
FROM lp""")

q("kl_approx", f"""
WITH {DIST}, {LOGP}, {TOKENS}
SELECT step, round(sum(((logp - teacher_logp) + exp(teacher_logp - logp) - 1) * {skip()}) / nullif(sum({skip()}), 0), 6) AS kl_approx
FROM toks GROUP BY step""")

q("masked_entropy", f"""
WITH {DIST}, {LOGP}, {TOKENS},
g AS (SELECT step, max(pos) AS mp, greatest(sum(mask), 1) AS den,
             sum(entropy * mask) AS se, avg(entropy) AS ae,
             sum((exp(ref_logp - logp) - (ref_logp - logp) - 1) * mask) AS sk,
             avg(exp(ref_logp - logp) - (ref_logp - logp) - 1) AS ak
      FROM toks GROUP BY step)
SELECT step, round(CASE WHEN mp = 0 THEN ae ELSE se / den END, 6) AS mean_entropy,
       round(CASE WHEN mp = 0 THEN ak ELSE sk / den END, 6) AS mean_kl_to_base
FROM g""")

q("sequence_loss", f"""
WITH {DIST}, {LOGP},
s AS (SELECT step, seq_id, sum({kl_sql('ls', 'lt')} * {skip()}) / greatest(sum({skip()}), 1) AS sl FROM lp GROUP BY step, seq_id)
SELECT step, round(avg(sl), 6) AS loss FROM s GROUP BY step""")

q("sequence_loss_masked", f"""
WITH {DIST}, {LOGP},
t AS (SELECT step, seq_id, {skip()} AS m, {kl_sql('ls', 'lt')} AS v, -list_sum(list_transform(ls, lambda x: exp(x) * x)) AS entropy FROM lp),
thr AS (SELECT step, quantile_cont(entropy, {1.0 - cat.ENTROPY_RHO}) AS threshold FROM t WHERE m <> 0 GROUP BY step),
s AS (SELECT t.step, seq_id, sum(CASE WHEN entropy >= threshold AND m <> 0 THEN v * m ELSE 0 END) / greatest(sum(m), 1) AS sl
      FROM t LEFT JOIN thr USING (step) GROUP BY t.step, seq_id)
SELECT step, round(avg(sl), 6) AS loss FROM s GROUP BY step""")

q("skip_mask", f"WITH {DIST} SELECT step, seq_id, pos, CAST({skip()} AS INTEGER) AS loss_mask FROM dist")

q("entropy_mask", f"""
WITH {DIST}, {LOGP}, {TOKENS},
thr AS (SELECT step, quantile_cont(entropy, {1.0 - cat.ENTROPY_RHO}) AS threshold FROM toks WHERE mask <> 0 GROUP BY step)
SELECT t.step, t.seq_id, t.pos, coalesce(t.entropy * t.mask >= thr.threshold AND t.mask <> 0, false) AS entropy_mask
FROM toks t LEFT JOIN thr USING (step)""")

q("eos_clip", f"""
WITH {SEQS},
c AS (SELECT seq_id, CASE WHEN coalesce(list_position(completion_ids, {tb.EOS_ID}), 0) > 0
                          THEN list_slice(completion_ids, 1, list_position(completion_ids, {tb.EOS_ID}))
                          ELSE completion_ids END AS ids FROM seqs)
SELECT seq_id, CAST(len(ids) AS INTEGER) AS n_tokens, md5(array_to_string(ids, ',')) AS ids_md5 FROM c""")

q("length_stats", f"""
WITH {SEQS},
x AS (SELECT step, CAST(len(completion_ids) AS DOUBLE) AS ln, {TRUNC} AS tr FROM seqs)
SELECT step, round(avg(ln), 6) AS mean_length, round(min(ln), 6) AS min_length, round(max(ln), 6) AS max_length,
       round(avg(CAST(tr AS DOUBLE)), 6) AS clipped_ratio,
       round(coalesce(avg(ln) FILTER (WHERE NOT tr), 0.0), 6) AS mean_terminated_length,
       round(coalesce(min(ln) FILTER (WHERE NOT tr), 0.0), 6) AS min_terminated_length,
       round(coalesce(max(ln) FILTER (WHERE NOT tr), 0.0), 6) AS max_terminated_length
FROM x GROUP BY step""")

q("tokens_seen", f"""
WITH {SEQS},
p AS (SELECT step, CAST(sum(len(prompt_ids) + len(completion_ids)) AS BIGINT) AS step_tokens FROM seqs GROUP BY step)
SELECT step, step_tokens, CAST(sum(step_tokens) OVER (ORDER BY step ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS num_tokens
FROM p""")

q("metric_rollup", f"""
WITH m AS (SELECT CASE WHEN event_type = 'error' THEN 'eval' ELSE 'train' END AS mode, event_id AS step, event_type AS key, value FROM events)
SELECT mode, CAST(floor(step / {cat.LOG_STEPS}) AS BIGINT) AS interval,
       CASE WHEN mode = 'eval' THEN 'eval_' || key ELSE key END AS metric, round(avg(value), 6) AS value
FROM m GROUP BY 1, 2, 3""")

q("recent_completions", f"""
WITH {SEQS}
SELECT step, seq_id, array_to_string(prompt_ids, ',') AS prompt, CAST(len(completion_ids) AS INTEGER) AS completion_tokens
FROM seqs ORDER BY step DESC, seq_id DESC LIMIT {cat.RECENT_N}""")


# ------------------------------------------------------ sinks (round trips) ---

q("split_roundtrip", ORACLE["judge_filter"])

q("release_roundtrip", f"""
WITH {FUNNEL_BASE}, n AS (SELECT id, count(*) AS n FROM turns GROUP BY id)
SELECT c.id, CAST(n.n AS INTEGER) AS n_messages, CAST(n.n AS INTEGER) AS n_json_messages FROM conv c JOIN n USING (id)
WHERE ok_empty AND ok_think AND c.id NOT IN (SELECT id FROM loops)""")

q("json_report", ORACLE["loop_flags"])

q("progress_metrics", f"""
WITH {CHAT_IDS},
v AS (SELECT coalesce(l.quality = 1, false) AS verdict FROM cid LEFT JOIN labels l ON l.doc_id = cid.id)
SELECT count(*) AS processed, CAST(sum(CASE WHEN verdict THEN 1 ELSE 0 END) AS BIGINT) AS accepted,
       CAST(sum(CASE WHEN verdict THEN 0 ELSE 1 END) AS BIGINT) AS rejected
FROM v""")


# ------------------------------------------------------- prepare jobs (E4-E6) ---


def ranked_by_hash(src: str, id_col: str = "id") -> str:
    return (f"SELECT *, row_number() OVER (ORDER BY md5('{cat.SEED}:' || CAST({id_col} AS VARCHAR)), {id_col}) AS rn, "
            f"count(*) OVER () AS total FROM {src}")


q("prepare_sft_val", f"""
WITH {PLAIN_TURNS},
r AS ({ranked_by_hash("(SELECT DISTINCT id FROM turns)")})
SELECT t.id, CAST(count(*) AS INTEGER) AS n_messages, string_agg(role, ',' ORDER BY turn) AS roles,
       md5(string_agg(coalesce(content, '<null>'), chr(1) ORDER BY turn)) AS content_md5
FROM turns t JOIN r USING (id)
WHERE r.rn <= CAST(floor(r.total * 0.1::DOUBLE) AS BIGINT)
GROUP BY t.id""")

q("prepare_dpo_train", f"""
WITH {PREFS},
r AS ({ranked_by_hash("(SELECT conv_id AS id, prompt, chosen, rejected FROM prefs)")})
SELECT id FROM r
WHERE rn > CAST(floor(total * 0.1::DOUBLE) AS BIGINT)
  AND greatest({tokcount(render2("coalesce(prompt, 'None')", "coalesce(chosen, 'None')"))},
               {tokcount(render2("coalesce(prompt, 'None')", "coalesce(rejected, 'None')"))}) <= {cat.OVERLENGTH_MAX}""")

q("prepare_distill_train", f"""
WITH {TURN_PAIRS},
r AS ({ranked_by_hash("pairs")})
SELECT id, {md5_turns([("'system'", _lit(cat.TEACHER_SYSTEM)), ("'user'", TEACHER_TEXT.replace("p.", ""))])} AS teacher_md5
FROM r
WHERE rn > 5 AND {tokcount(STUDENT_RENDER)} <= {cat.PROMPT_MAX} AND {tokcount(TEACHER_RENDER)} <= {cat.PROMPT_MAX}""")


# ---------------------------------------------------------------- streams ---

#: Requests that the stub model answers.
PAIRS_ANSWERED = f"""
WITH {TURN_PAIRS}
SELECT p.id, 'stop' AS finish_reason FROM pairs p JOIN labels l ON l.doc_id = p.conv_id WHERE l.quality IN (0, 1)"""

q("curate_stream", ORACLE["curate_kept"])
q("generate_stream", PAIRS_ANSWERED)
q("generate_stream_restart", PAIRS_ANSWERED)

# ------------------------------------------------------------------- jobs ---

# Half of the conversations have no id; the judge's labels hang on conv_id.
q("curate_job", f"""
WITH {FUNNEL_BASE}, {PROFILES}, {detect_ctes('conv', 'id', 'alltext', 'det')},
f0 AS (SELECT c.id, ok_empty AS f1, ok_empty AND ok_think AS f2,
              ok_empty AND ok_think AND d.detected_lang = '{cat.JOB_LANG}' AS f3,
              c.id NOT IN (SELECT id FROM loops) AS ok_ngram,
              (SELECT count(*) FROM turns t WHERE t.id = c.id) >= {cat.JOB_MIN_TURNS} AS ok_turns,
              length(c.atext) <= {cat.JOB_MAX_CHARS} AS ok_chars,
              coalesce((SELECT any_value(quality) FROM labels l WHERE l.doc_id = c.id) = 1, false) AS ok_judge
       FROM conv c LEFT JOIN det d USING (id)),
flags AS (SELECT id, f1, f2, coalesce(f3, false) AS f3, coalesce(f3, false) AND ok_ngram AS f4,
                 coalesce(f3, false) AND ok_ngram AND ok_turns AS f5,
                 coalesce(f3, false) AND ok_ngram AND ok_turns AND ok_chars AS f6,
                 coalesce(f3, false) AND ok_ngram AND ok_turns AND ok_chars AND ok_judge AS f7 FROM f0),
s(stage_order, stage, before, after) AS (
  SELECT 1, 'Empty content', count(*), count(*) FILTER (WHERE f1) FROM flags
  UNION ALL SELECT 2, 'Think tags', count(*) FILTER (WHERE f1), count(*) FILTER (WHERE f2) FROM flags
  UNION ALL SELECT 3, 'Language ({cat.JOB_LANG})', count(*) FILTER (WHERE f2), count(*) FILTER (WHERE f3) FROM flags
  UNION ALL SELECT 4, 'N-gram repetition', count(*) FILTER (WHERE f3), count(*) FILTER (WHERE f4) FROM flags
  UNION ALL SELECT 5, 'Turns', count(*) FILTER (WHERE f4), count(*) FILTER (WHERE f5) FROM flags
  UNION ALL SELECT 6, 'Answer length', count(*) FILTER (WHERE f5), count(*) FILTER (WHERE f6) FROM flags
  UNION ALL SELECT 7, 'LLM judge', count(*) FILTER (WHERE f6), count(*) FILTER (WHERE f7) FROM flags
  UNION ALL SELECT 8, 'TOTAL', count(*), count(*) FILTER (WHERE f7) FROM flags
  UNION ALL SELECT 9, 'released as parquet', count(*) FILTER (WHERE f7), count(*) FILTER (WHERE f7 AND id % 2 = 0) FROM flags
  UNION ALL SELECT 10, 'released as JSON lines', count(*) FILTER (WHERE f7), count(*) FILTER (WHERE f7 AND id % 2 = 0) FROM flags)
SELECT stage_order, stage, before, after, before - after AS removed FROM s""")

q("judge_job", ORACLE["judge_filter"])
q("generate_job", ORACLE["generation_summary"])
q("pick_split", "SELECT doc_id, lang FROM documents WHERE doc_id % 2 = 0")
q("user_stages", funnel_sql(
    [("Empty content", "f1"), ("Think tags", "f2"), ("N-gram repetition", "f3"), ("Turns", "f4"), ("Answer length", "f5")],
    FUNNEL_BASE + f""",
n AS (SELECT id, count(*) AS n FROM turns GROUP BY id),
f0 AS (SELECT conv.*, n.n, ok_empty AND ok_think AND id NOT IN (SELECT id FROM loops) AS f3 FROM conv JOIN n USING (id)),
flags AS (SELECT id, ok_empty AS f1, ok_empty AND ok_think AS f2, f3, f3 AND n >= {cat.JOB_MIN_TURNS} AS f4,
                 f3 AND n >= {cat.JOB_MIN_TURNS} AND length(atext) <= {cat.JOB_MAX_CHARS} AS f5 FROM f0)"""))

q("report_generations_job", f"""
WITH fr AS ({ORACLE['finish_reasons'].replace("events", "gens").replace("event_type", "finish_reason").replace("WITH g AS", f"WITH {TURNS}, {GENS}, g AS", 1)}),
tl AS ({ORACLE['think_language']}), lo AS ({ORACLE['looping_report']}), ct AS ({ORACLE['completion_tokens']})
SELECT 'finish_reason' AS section, finish_reason AS label, "count"::DOUBLE AS value, pct, bar FROM fr
UNION ALL SELECT 'thinking_language', language, "count", pct, bar FROM tl
UNION ALL SELECT 'looping', label, "count", pct, bar FROM lo
UNION ALL SELECT 'completion_tokens', 'min', min_tokens, NULL, NULL FROM ct
UNION ALL SELECT 'completion_tokens', 'max', max_tokens, NULL, NULL FROM ct
UNION ALL SELECT 'completion_tokens', 'avg', avg_tokens, NULL, NULL FROM ct
UNION ALL SELECT 'completion_tokens', 'n', n, NULL, NULL FROM ct""")

q("report_tokens_job", f"""
WITH {TURNS}, c AS (SELECT id, string_agg(content, ' ' ORDER BY turn) AS t FROM turns GROUP BY id),
t AS (SELECT CAST({tokcount('t')} AS INTEGER) AS tokens FROM c)
SELECT count(tokens) AS samples, round(avg(tokens), 6) AS avg_tokens, min(tokens) AS min_tokens, max(tokens) AS max_tokens,
       CAST(quantile_disc(tokens, 0.5 ORDER BY tokens DESC) AS BIGINT) AS median_tokens
FROM t""")

q("report_loops_job", f"""
WITH samp AS (
  SELECT item_id AS id, text FROM benchmark
  ORDER BY md5('{cat.SEED}:' || CAST(item_id AS VARCHAR)), item_id LIMIT {cat.LOOP_SAMPLE_N}),
gen AS (SELECT id, 'Question: ' || text || chr(10) AS prompt FROM samp),
said AS (SELECT id, prompt, CASE WHEN id % 2 = 0 THEN repeat(prompt || ' ', 5) ELSE prompt END AS generated,
                id % 5 = 0 AS no_eos FROM gen),
{loops_cte('gl', 'said', 'id', 'generated', 10, 3)}
SELECT id, md5(prompt) AS prompt_md5, md5(generated) AS generated_md5, no_eos, id IN (SELECT id FROM gl) AS ngram_loop,
       no_eos OR id IN (SELECT id FROM gl) AS looping FROM said""")


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)
