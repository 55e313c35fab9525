"""Registered queries: one per operator of the survey inventory.

Each entry is ``fn(spark, sf_dir) -> DataFrame`` over the whole driver tables.
Nested results are reported as scalars (counts, md5 of a rendering) so they
can be compared with the SQL oracle in :mod:`chatsift.plans.oracle`.
"""

from __future__ import annotations

from typing import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chatsift.functions import text as tx
from chatsift.functions import token_arrays as ta
from chatsift.operators import filters as flt
from chatsift.operators import reports as rep
from chatsift.operators import sampling as smp
from chatsift.operators import shape as shp
from chatsift.operators import token_logs as tl
from chatsift.operators.lang import detect_lang, train_lang_profiles
from chatsift.operators.ngrams import ngram_loop, ngram_loop_exploded
from chatsift.operators.partitioning import spread
from chatsift.operators.model_calls import LabelStubClient
from chatsift.operators.stages import Stage
from chatsift.plans import jobs
from chatsift.plans import tables as tb
from chatsift.plans.jobs import curate
from chatsift.session import read_table, staged, work_path
from chatsift.sinks.writers import append_jsonl, release_manifest, write_json_report, write_split
from chatsift.sources.datasets import load_split, pick_split, read_done_ids, read_jsonl_strict
from chatsift.streaming.jobs import STREAM_QUERIES

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Fixed query parameters (shared with the SQL oracle).
SEED = 42
SPLIT_RATIO = 0.13
MAX_SAMPLES = 250
SAMPLE_N = 100
LOOP_SAMPLE_N = 20
OVERLENGTH_MAX = 300
PROMPT_MAX = 200
CLIP_LEN = 16
ENTROPY_RHO = 0.2
SKIP_TOKENS = 3
KL_BETA = 0.1
LOG_STEPS = 100
RECENT_N = 10
BATCH = (2, 2, 4)          # per-device batch, processes, steps per generation
TEACHER_SYSTEM = "Tu es un professeur."
JOB_LANG = "fr"
JOB_MIN_TURNS = 4
JOB_MAX_CHARS = 6000


def query(name: str):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn
    return deco


def _md5_turns(messages: Column, fmt=lambda m: F.concat(m["role"], F.lit(":"), m["content"])) -> Column:
    return F.md5(F.array_join(F.transform(messages, fmt), "|"))


def _chat_summary(df: DataFrame, id_col: str | None = "id", messages: str = "messages") -> DataFrame:
    m = F.col(messages)
    cols = [] if id_col is None else [F.col(id_col)]
    return df.select(
        *cols,
        F.size(m).alias("n_messages"),
        F.array_join(F.transform(m, lambda x: x["role"]), ",").alias("roles"),
        F.md5(F.array_join(F.transform(m, lambda x: F.coalesce(x["content"], F.lit("<null>"))), "\u0001")).alias("content_md5"),
    )


_PROFILE_CACHE: dict = {}


def profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language profiles trained on ``documents`` (checkpointed, reused per session)."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _PROFILE_CACHE:
        _PROFILE_CACHE[key] = train_lang_profiles(spread(read_table(spark, sf_dir, "documents")), "text", "lang")
    return _PROFILE_CACHE[key]


# ------------------------------------------------------------- sources ---

@query("read_split")
def q_read_split(spark, sf_dir):
    return load_split(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars")


@query("conversation_messages")
def q_conversation_messages(spark, sf_dir):
    return _chat_summary(tb.chat(spark, sf_dir, variants=False))


@query("done_ids")
def q_done_ids(spark, sf_dir):
    return read_done_ids(spark, tb.write_done_file(spark, sf_dir))


GEN_SCHEMA = "id long, messages array<struct<role:string,content:string>>, finish_reason string, completion_tokens long"


def generation_records(spark, sf_dir) -> DataFrame:
    """Generation records (id, messages, finish_reason, completion_tokens?) from the chat fixture."""
    c = tb.chat(spark, sf_dir)
    n_words = F.size(tx.words(tx.join_contents("messages", "assistant")))
    return c.select(
        "id", "messages",
        F.when(F.col("id") % 3 == 0, "length").otherwise("stop").alias("finish_reason"),
        F.when(F.col("id") % 4 == 0, F.lit(None)).otherwise(n_words).cast("long").alias("completion_tokens"),
    )


def written_generations(spark, sf_dir) -> DataFrame:
    path = work_path(spark, "generations-jsonl")
    append_jsonl(generation_records(spark, sf_dir), path)
    return read_jsonl_strict(spark, path, GEN_SCHEMA)


@query("jsonl_strict")
def q_jsonl_strict(spark, sf_dir):
    g = written_generations(spark, sf_dir)
    return g.select("id", "finish_reason", "completion_tokens", F.size("messages").alias("n_messages"))


# --------------------------------------------------------- projections ---

@query("column_map")
def q_column_map(spark, sf_dir):
    d = read_table(spark, sf_dir, "documents")
    return shp.apply_column_map(d, {"content": "text", "id": "doc_id", "lang": "source"})


@query("prune_columns")
def q_prune_columns(spark, sf_dir):
    b = read_table(spark, sf_dir, "benchmark")
    b = shp.apply_prompt_completion_map(b, {"prompt": "text", "completion": "demonstration"})
    return shp.keep_columns(b)


@query("instruction_to_messages")
def q_instruction_to_messages(spark, sf_dir):
    return _chat_summary(shp.instruction_to_messages(tb.instruction_rows(spark, sf_dir)), None)


@query("sft_format")
def q_sft_format(spark, sf_dir):
    conv = tb.chat(spark, sf_dir, variants=False).withColumnRenamed("messages", "conversations")
    a = shp.to_sft_format(conv, {"conversations": "messages"})
    b = shp.to_sft_format(tb.instruction_rows(spark, sf_dir))
    return _chat_summary(smp.mix([a, b]))


@query("preference_pairs")
def q_preference_pairs(spark, sf_dir):
    p = shp.normalize_preferences(tb.preference_rows(spark, sf_dir))
    return p.select("conv_id", *[_md5_turns(F.col(c)).alias(f"{c}_md5") for c in ("prompt", "chosen", "rejected")])


@query("to_chat")
def q_to_chat(spark, sf_dir):
    t = read_table(spark, sf_dir, "conversations")
    rows = t.groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.when(F.col("role") == "assistant", F.struct("turn", "text")))).alias("_a"),
        F.max_by(F.struct(F.col("role"), F.col("text").alias("content")), "turn").alias("rejected"),
        F.when(F.count(F.lit(1)) > 3, F.count(F.lit(1))).alias("score"),
    ).select("conv_id", F.transform("_a", lambda s: s["text"]).alias("chosen"), "rejected", "score")
    out = rows.select(
        "conv_id",
        shp.to_chat(rows, "prompt", "user").alias("prompt"),
        shp.to_chat(rows, "chosen", "assistant").alias("chosen"),
        shp.to_chat(rows, "rejected", "assistant").alias("rejected"),
        shp.to_chat(rows, "score", "user").alias("score"),
    )
    return out.select("conv_id", *[_md5_turns(F.col(c)).alias(f"{c}_md5") for c in ("prompt", "chosen", "rejected", "score")])


@query("teacher_prompts")
def q_teacher_prompts(spark, sf_dir):
    pairs = tb.turn_pairs(spark, sf_dir)
    pairs = pairs.withColumn(
        "prompt", F.when(F.col("id") % 5 == 0, F.concat("prompt", F.lit(" {completion}"))).otherwise(F.col("prompt"))
    )
    out = shp.build_teacher_prompts(pairs, None, None, TEACHER_SYSTEM)
    return out.select("id", _md5_turns(F.col("prompt")).alias("prompt_md5"),
                      _md5_turns(F.col("teacher_prompt")).alias("teacher_md5"))


@query("generation_requests")
def q_generation_requests(spark, sf_dir):
    pairs = tb.turn_pairs(spark, sf_dir).withColumnRenamed("completion", "demonstration")
    req = shp.generation_requests(pairs)
    return req.select("id", _md5_turns(F.col("messages")).alias("request_md5"))


@query("assemble_generations")
def q_assemble_generations(spark, sf_dir):
    pairs = tb.turn_pairs(spark, sf_dir).withColumnRenamed("completion", "demonstration")
    req = shp.generation_requests(pairs)
    gens = shp.assemble_generations(None, tb.stub_replies(tb.turn_requests(req, spark, sf_dir), keep=("prompt",)))
    return gens.select(F.col("id").cast("long").alias("id"), _md5_turns(F.col("messages")).alias("messages_md5"),
                       "finish_reason", "completion_tokens")


@query("judge_text")
def q_judge_text(spark, sf_dir):
    return tb.chat(spark, sf_dir).select("id", F.md5(tx.render_judge_text("messages")).alias("judge_text_md5"))


@query("judge_requests")
def q_judge_requests(spark, sf_dir):
    r = shp.judge_requests(tb.chat(spark, sf_dir), preset="pipeline")
    return r.select("id", F.size("request").alias("n_messages"), _md5_turns(F.col("request")).alias("request_md5"))


@query("chat_render")
def q_chat_render(spark, sf_dir):
    return tb.chat(spark, sf_dir).select("id", F.md5(tx.render_chat("messages", True)).alias("render_md5"))


@query("assistant_text")
def q_assistant_text(spark, sf_dir):
    a = tx.join_contents("messages", "assistant")
    return tb.chat(spark, sf_dir).select("id", F.md5(a).alias("assistant_md5"), F.length(a).alias("assistant_chars"))


@query("rejected_preview")
def q_rejected_preview(spark, sf_dir):
    p = tx.preview("text")
    return read_table(spark, sf_dir, "documents").select("doc_id", F.md5(p).alias("preview_md5"), F.length(p).alias("preview_chars"))


@query("clip_pad")
def q_clip_pad(spark, sf_dir):
    s = tb.sequence_log(spark, sf_dir)
    # Prompts keep their end and are padded on the left, completions keep their start and are padded on the right.
    clipped = ta.clip_right("completion_ids", CLIP_LEN)
    padded = ta.pad_to(clipped, CLIP_LEN, tb.PAD_ID, "right")
    mask = ta.pad_mask(clipped, CLIP_LEN, "right")
    left = ta.pad_to(ta.clip_left("prompt_ids", CLIP_LEN), CLIP_LEN, tb.PAD_ID, "left")
    return s.select(
        "seq_id",
        F.array_join(padded, ",").alias("completion_padded"),
        F.aggregate(mask, F.lit(0), lambda a, x: a + x).alias("mask_sum"),
        F.array_join(left, ",").alias("prompt_padded"),
    )


# ------------------------------------------------------------- filters ---

@query("filter_empty")
def q_filter_empty(spark, sf_dir):
    return flt.filter_empty_content(tb.chat(spark, sf_dir)).select("id")


def assistant_turns(spark, sf_dir) -> DataFrame:
    c = tb.chat(spark, sf_dir)
    return c.select("id", F.posexplode("messages").alias("turn", "m")).where(F.col("m.role") == "assistant")


@query("think_tags")
def q_think_tags(spark, sf_dir):
    return assistant_turns(spark, sf_dir).select("id", "turn", tx.has_valid_think_tags(F.col("m.content")).alias("valid"))


@query("filter_think")
def q_filter_think(spark, sf_dir):
    return flt.filter_think_tags(tb.chat(spark, sf_dir)).select("id")


def _loop_docs(spark, sf_dir, n, k):
    d = spread(read_table(spark, sf_dir, "documents"))
    return d.select("doc_id", ngram_loop("text", n, k).alias("loop"))


@query("ngram_loop_docs")
def q_ngram_loop_docs(spark, sf_dir):
    return _loop_docs(spark, sf_dir, 10, 5)


@query("ngram_loop_docs_10_3")
def q_ngram_loop_docs_10_3(spark, sf_dir):
    return _loop_docs(spark, sf_dir, 10, 3)


@query("ngram_loop_docs_20_5")
def q_ngram_loop_docs_20_5(spark, sf_dir):
    return _loop_docs(spark, sf_dir, 20, 5)


@query("ngram_loop_exploded")
def q_ngram_loop_exploded(spark, sf_dir):
    d = read_table(spark, sf_dir, "documents")
    return ngram_loop_exploded(d, "doc_id", "text", 10, 5)


@query("filter_ngram")
def q_filter_ngram(spark, sf_dir):
    return flt.filter_ngram_repetition(tb.chat(spark, sf_dir), 10, 5).select("id")


def derived_replies(spark, sf_dir) -> DataFrame:
    lab = read_table(spark, sf_dir, "labels")
    i = F.col("doc_id")
    reply = (
        F.when(F.col("quality") == 1, F.when(i % 2 == 0, "True").otherwise("not true, False"))
        .otherwise(F.when(i % 3 == 0, " FALSE.").when(i % 3 == 1, "yes").otherwise("false"))
    )
    return lab.select(F.col("doc_id"), reply.alias("reply"))


@query("parse_verdict")
def q_parse_verdict(spark, sf_dir):
    return derived_replies(spark, sf_dir).select("doc_id", "reply", tx.parse_verdict("reply").alias("verdict"))


def chat_replies(spark, sf_dir) -> DataFrame:
    return tb.stub_replies(tb.label_requests(tb.chat(spark, sf_dir).select("id"), spark, sf_dir))


@query("judge_filter")
def q_judge_filter(spark, sf_dir):
    c = tb.chat(spark, sf_dir).withColumn("id", F.col("id").cast("string"))
    kept = shp.judge_output(flt.filter_by_verdict(c, chat_replies(spark, sf_dir)))
    return kept.select(F.col("id").cast("long").alias("id"), F.size("messages").alias("n_messages"))


@query("filter_overlength")
def q_filter_overlength(spark, sf_dir):
    p = shp.normalize_preferences(tb.preference_rows(spark, sf_dir))
    return flt.filter_overlength(p, OVERLENGTH_MAX, tx.token_count).select("conv_id")


def teacher_rows(spark, sf_dir) -> DataFrame:
    return shp.build_teacher_prompts(tb.turn_pairs(spark, sf_dir), None, None, TEACHER_SYSTEM)


@query("filter_long_prompts")
def q_filter_long_prompts(spark, sf_dir):
    return flt.filter_long_prompts(teacher_rows(spark, sf_dir), PROMPT_MAX, tx.token_count).select("id")


def loop_check_rows(spark, sf_dir) -> DataFrame:
    """E9 on the benchmark: seeded sample of questions; the "generation" of a
    question is the document with the same id (finish ``length`` past 5,000 chars)."""
    b = read_table(spark, sf_dir, "benchmark").withColumnRenamed("item_id", "id")
    sample = smp.seeded_sample(b, LOOP_SAMPLE_N, SEED, "id")
    docs = read_table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("id"), F.col("text").alias("generated"),
        F.when(F.col("n_chars") > 5000, "length").otherwise("stop").alias("finish_reason"))
    gens = sample.select("id", tx.question_prompt("text").alias("prompt")).join(docs, "id")
    return flt.loop_flags(gens, "generated", "finish_reason", 10, 3)


@query("loop_flags")
def q_loop_flags(spark, sf_dir):
    return loop_check_rows(spark, sf_dir).select("id", F.md5("prompt").alias("prompt_md5"), "no_eos", "ngram_loop", "looping")


@query("loop_report")
def q_loop_report(spark, sf_dir):
    return rep.loop_summary(loop_check_rows(spark, sf_dir))


@query("truncated_flag")
def q_truncated_flag(spark, sf_dir):
    s = tl.mask_truncated(tb.sequence_log(spark, sf_dir), tb.EOS_ID, tb.PAD_ID)
    return s.select("seq_id", flt.truncated_flag("completion_ids", tb.EOS_ID, tb.PAD_ID).alias("truncated"),
                    F.aggregate("completion_mask", F.lit(0), lambda a, x: a + x).alias("mask_sum"))


# ----------------------------------------------- joins, sets, sampling ---

@query("resume_anti")
def q_resume_anti(spark, sf_dir):
    pairs = tb.turn_pairs(spark, sf_dir).withColumnRenamed("completion", "demonstration")
    done = read_done_ids(spark, tb.write_done_file(spark, sf_dir))
    return smp.resume(pairs, done, "id").select("id")


@query("resume_limit")
def q_resume_limit(spark, sf_dir):
    """L2s: a limit over what remains."""
    pairs = tb.turn_pairs(spark, sf_dir).withColumnRenamed("completion", "demonstration")
    done = staged(read_done_ids(spark, tb.write_done_file(spark, sf_dir)), "done")
    return smp.max_samples(smp.resume(pairs, done, "id"), 25, "id").select("id")


@query("mix")
def q_mix(spark, sf_dir):
    d = read_table(spark, sf_dir, "documents")
    low = F.col("source").isin([f"src{i}" for i in range(5)])
    a = d.where(low).select("doc_id", "lang")
    b = d.where(~low).select("doc_id", "n_chars")
    return smp.mix([a, b])


@query("max_samples")
def q_max_samples(spark, sf_dir):
    return smp.max_samples(read_table(spark, sf_dir, "documents").select("doc_id", "lang"), MAX_SAMPLES, "doc_id")


@query("seeded_sample")
def q_seeded_sample(spark, sf_dir):
    return smp.seeded_sample(read_table(spark, sf_dir, "documents").select("doc_id", "source"), SAMPLE_N, SEED, "doc_id")


def _split(spark, sf_dir):
    d = read_table(spark, sf_dir, "documents").select("doc_id", "lang")
    return smp.train_val_split(d, SPLIT_RATIO, None, SEED, "doc_id")


@query("split_train")
def q_split_train(spark, sf_dir):
    return _split(spark, sf_dir)[0]


@query("split_val")
def q_split_val(spark, sf_dir):
    return _split(spark, sf_dir)[1]


@query("batch_plan")
def q_batch_plan(spark, sf_dir):
    d = read_table(spark, sf_dir, "documents").select("doc_id")
    return smp.batch_plan(d, *BATCH, seed=SEED, id_col="doc_id")


# -------------------------------------------------------------- reports ---

@query("funnel")
def q_funnel(spark, sf_dir):
    return curate(tb.chat(spark, sf_dir)).funnel


@query("funnel_lang")
def q_funnel_lang(spark, sf_dir):
    return curate(tb.chat(spark, sf_dir), profiles(spark, sf_dir), "fr").funnel


@query("funnel_lang_null_id")
def q_funnel_lang_null_id(spark, sf_dir):
    """Half of the conversations without an id, the others with one that repeats."""
    c = tb.chat(spark, sf_dir).withColumn("id", F.when(F.col("id") % 2 == 0, F.col("id") % 9))
    return curate(c, profiles(spark, sf_dir), "fr").funnel


@query("curate_kept")
def q_curate_kept(spark, sf_dir):
    return curate(tb.chat(spark, sf_dir)).kept.select("id", F.size("messages").alias("n_messages"))


@query("freq_table")
def q_freq_table(spark, sf_dir):
    return rep.freq_table(read_table(spark, sf_dir, "documents"), "source", "label")


@query("finish_reasons")
def q_finish_reasons(spark, sf_dir):
    ev = read_table(spark, sf_dir, "events").withColumnRenamed("event_type", "finish_reason")
    return rep.finish_reason_report(ev)


@query("think_language")
def q_think_language(spark, sf_dir):
    return rep.thinking_language_report(tb.chat(spark, sf_dir), profiles(spark, sf_dir))


@query("looping_report")
def q_looping_report(spark, sf_dir):
    return rep.looping_report(tb.chat(spark, sf_dir), n=10, k=3)


@query("completion_tokens")
def q_completion_tokens(spark, sf_dir):
    return rep.completion_token_stats(written_generations(spark, sf_dir))


@query("token_count")
def q_token_count(spark, sf_dir):
    return read_table(spark, sf_dir, "documents").select("doc_id", tx.token_count("text").alias("tokens"))


@query("token_stats")
def q_token_stats(spark, sf_dir):
    d = spread(read_table(spark, sf_dir, "documents"))
    return rep.token_stats(d.select(tx.token_count("text").alias("tokens")), "tokens")


@query("judge_summary")
def q_judge_summary(spark, sf_dir):
    r = chat_replies(spark, sf_dir)
    verdicts = r.select(F.coalesce(tx.parse_verdict("reply") & F.col("error").isNull(), F.lit(False)).alias("verdict"))
    return rep.judge_summary(verdicts)


@query("map_model_stub")
def q_map_model_stub(spark, sf_dir):
    r = chat_replies(spark, sf_dir)
    return r.select(F.col("id").cast("long").alias("id"), "reply", F.col("error").isNotNull().alias("has_error"))


@query("generation_summary")
def q_generation_summary(spark, sf_dir):
    pairs = tb.turn_pairs(spark, sf_dir).withColumnRenamed("completion", "demonstration")
    done = read_done_ids(spark, tb.write_done_file(spark, sf_dir))
    todo = smp.resume(pairs, done, "id")
    replies = tb.stub_replies(tb.turn_requests(todo.select("id"), spark, sf_dir))
    return rep.generation_summary(pairs, done, replies)


# ---------------------------------------------------------- text / lang ---

@query("think_content")
def q_think_content(spark, sf_dir):
    tc = tx.think_content(F.col("m.content"))
    return assistant_turns(spark, sf_dir).select("id", "turn", F.md5(tc).alias("think_md5"), F.length(tc).alias("think_chars"))


@query("lang_profiles")
def q_lang_profiles(spark, sf_dir):
    return profiles(spark, sf_dir).select("lang", "gram", "cnt", F.round("logp", 6).alias("logp"))


@query("detect_lang")
def q_detect_lang(spark, sf_dir):
    d = spread(read_table(spark, sf_dir, "documents"))
    return detect_lang(d, profiles(spark, sf_dir), "doc_id", "text", "detected_lang")


@query("detect_lang_repeated_ids")
def q_detect_lang_repeated_ids(spark, sf_dir):
    """Ids that are null or repeat: every row is scored by itself."""
    d = spread(read_table(spark, sf_dir, "documents"))
    d = d.select(F.when(F.col("doc_id") % 7 != 0, F.col("doc_id") % 50).alias("id"), "text")
    return detect_lang(d, profiles(spark, sf_dir), "id", "text", "detected_lang")


@query("filter_language")
def q_filter_language(spark, sf_dir):
    return flt.filter_language(tb.chat(spark, sf_dir), profiles(spark, sf_dir), "fr").select("id")


# ------------------------------------------------------------ token logs ---

def _dist(spark, sf_dir):
    return tb.distribution_log(spark, sf_dir)


@query("log_softmax")
def q_log_softmax(spark, sf_dir):
    e = read_table(spark, sf_dir, "embeddings")
    lp = ta.log_softmax("embedding", 1.0)
    return e.select("vec_id", lp.alias("_lp"), "label").select(
        "vec_id",
        F.round(ta.selected_logp("_lp", F.col("label")), 6).alias("label_logp"),
        F.round(F.aggregate("_lp", F.lit(0.0), lambda a, x: a + F.exp(x)), 6).alias("prob_sum"),
        F.round(F.array_max("_lp"), 6).alias("max_logp"),
    )


@query("entropy")
def q_entropy(spark, sf_dir):
    e = read_table(spark, sf_dir, "embeddings")
    return e.select("vec_id", F.round(ta.entropy_from_logps(ta.log_softmax("embedding", 2.0)), 6).alias("entropy"))


@query("divergence")
def q_divergence(spark, sf_dir):
    s = tl.with_distribution_stats(_dist(spark, sf_dir))
    return s.select("step", "seq_id", "pos", *[F.round(c, 6).alias(c) for c in ("div_0_0", "div_0_5", "div_1_0")])


def token_log(spark, sf_dir) -> DataFrame:
    return tl.token_log_from_distributions(_dist(spark, sf_dir))


@query("kl_approx")
def q_kl_approx(spark, sf_dir):
    return tl.kl_approx(token_log(spark, sf_dir).withColumn("mask", tl.skip_first("mask", "pos", SKIP_TOKENS)))


@query("masked_entropy")
def q_masked_entropy(spark, sf_dir):
    return tl.masked_mean_metrics(token_log(spark, sf_dir), ("entropy",), beta=KL_BETA)


@query("sequence_loss")
def q_sequence_loss(spark, sf_dir):
    s = tl.with_distribution_stats(_dist(spark, sf_dir), alphas=(1.0,))
    per_token = s.select("step", "seq_id", F.col("div_1_0").alias("loss"),
                         tl.skip_first("mask", "pos", SKIP_TOKENS).alias("mask"))
    return tl.sequence_loss(per_token)


@query("sequence_loss_masked")
def q_sequence_loss_masked(spark, sf_dir):
    """Only tokens of high entropy add to the loss; the mean is over all tokens that bear loss."""
    s = tl.with_distribution_stats(_dist(spark, sf_dir), alphas=(1.0,))
    tokens = s.select("step", "seq_id", F.col("div_1_0").alias("loss"), F.col("student_entropy").alias("entropy"),
                      tl.skip_first("mask", "pos", SKIP_TOKENS).alias("mask"))
    return tl.sequence_loss(tl.high_entropy_mask(tokens, ENTROPY_RHO), value_mask="entropy_mask")


@query("skip_mask")
def q_skip_mask(spark, sf_dir):
    return _dist(spark, sf_dir).select("step", "seq_id", "pos", tl.skip_first("mask", "pos", SKIP_TOKENS).alias("loss_mask"))


@query("entropy_mask")
def q_entropy_mask(spark, sf_dir):
    t = tl.high_entropy_mask(token_log(spark, sf_dir), ENTROPY_RHO)
    return t.select("step", "seq_id", "pos", "entropy_mask")


@query("eos_clip")
def q_eos_clip(spark, sf_dir):
    s = tl.clip_at_eos(tb.sequence_log(spark, sf_dir), tb.EOS_ID)
    return s.select("seq_id", F.size("completion_ids").alias("n_tokens"),
                    F.md5(F.array_join("completion_ids", ",")).alias("ids_md5"))


@query("length_stats")
def q_length_stats(spark, sf_dir):
    return tl.completion_length_stats(tb.sequence_log(spark, sf_dir), tb.EOS_ID, tb.PAD_ID)


@query("tokens_seen")
def q_tokens_seen(spark, sf_dir):
    return tl.tokens_seen(tb.sequence_log(spark, sf_dir))


@query("metric_rollup")
def q_metric_rollup(spark, sf_dir):
    return tl.metric_rollup(tb.metric_log(spark, sf_dir), LOG_STEPS)


@query("recent_completions")
def q_recent_completions(spark, sf_dir):
    s = tb.sequence_log(spark, sf_dir)
    return tl.recent_completions(s, RECENT_N).select(
        "step", "seq_id", F.array_join("prompt_ids", ",").alias("prompt"), F.size("completion_ids").alias("completion_tokens"))


# ------------------------------------------------------ sinks (round trips) ---

@query("split_roundtrip")
def q_split_roundtrip(spark, sf_dir):
    """K1: the judged conversations written as a ``train`` split and read back."""
    from chatsift.sinks.writers import write_split
    from chatsift.sources.datasets import load_split

    c = tb.chat(spark, sf_dir).withColumn("id", F.col("id").cast("string"))
    kept = shp.judge_output(flt.filter_by_verdict(c, chat_replies(spark, sf_dir)))
    root = work_path(spark, "judged")
    write_split(kept, root, "train")
    back = load_split(spark, root, "train")
    return back.select(F.col("id").cast("long").alias("id"), F.size("messages").alias("n_messages"))


@query("release_roundtrip")
def q_release_roundtrip(spark, sf_dir):
    """K4: the curated set released as parquet + JSON lines; both copies read back."""
    from chatsift.sinks.writers import publish

    out = publish(curate(tb.chat(spark, sf_dir)).kept, work_path(spark, "release"), "curated")
    pq = spark.read.parquet(out["parquet"]).select("id", F.size("messages").alias("n_messages"))
    js = spark.read.schema(GEN_SCHEMA).json(out["jsonl"]).select("id", F.size("messages").alias("n_json_messages"))
    return pq.join(js, "id")


@query("json_report")
def q_json_report(spark, sf_dir):
    """K3: the loop-check flags written as one JSON array (indent 2) and read back."""
    from chatsift.sinks.writers import write_json_report

    flags = loop_check_rows(spark, sf_dir).select("id", "prompt", "generated", "finish_reason",
                                                    "no_eos", "ngram_loop", "looping")
    path = write_json_report(flags, work_path(spark, "loop-report") + "/loop_sanity_results.json")
    back = spark.read.option("multiLine", "true").schema(
        "id long, prompt string, generated string, finish_reason string, no_eos boolean, ngram_loop boolean, looping boolean"
    ).json(path)
    return back.select("id", F.md5("prompt").alias("prompt_md5"), "no_eos", "ngram_loop", "looping")


@query("progress_metrics")
def q_progress_metrics(spark, sf_dir):
    """Running judge counts as ``observe()`` metrics, filled by the write of the kept rows."""
    c = tb.chat(spark, sf_dir).withColumn("id", F.col("id").cast("string"))
    verdicts = chat_replies(spark, sf_dir).select(
        "id", F.coalesce(tx.parse_verdict("reply") & F.col("error").isNull(), F.lit(False)).alias("verdict"))
    tracked, obs = rep.observe_progress(c.join(verdicts, "id", "left"), "judge",
                                        text=tx.render_judge_text("messages"))
    tracked.write.format("noop").mode("overwrite").save()
    m = obs.get
    return spark.createDataFrame(
        [(int(m["processed"]), int(m["accepted"]), int(m["rejected"]))],
        "processed long, accepted long, rejected long")


# ------------------------------------------------------- prepare jobs (E4-E6) ---

@query("prepare_sft_val")
def q_prepare_sft_val(spark, sf_dir):
    """The chat table saved as a dataset, prepared from a config (1% style ratio split)."""
    from chatsift.plans.jobs import prepare_sft
    from chatsift.sinks.writers import write_split

    root = work_path(spark, "sft-src")
    write_split(tb.chat(spark, sf_dir, variants=False), root, "train")
    cfg = {"datasets": [{"name": root, "column_map": {"conversations": "messages"}}],
           "validation": {"split_ratio": 0.1, "seed": SEED}}
    _, val = prepare_sft(spark, cfg)
    return _chat_summary(val)


@query("prepare_dpo_train")
def q_prepare_dpo_train(spark, sf_dir):
    """E5: preference rows -> chat lists -> split -> overlength filter on the train side."""
    from chatsift.plans.jobs import prepare_dpo
    from chatsift.sinks.writers import write_split

    root = work_path(spark, "dpo-src")
    write_split(tb.preference_rows(spark, sf_dir).withColumnRenamed("conv_id", "id"), root, "train")
    cfg = {"datasets": [{"name": root}], "validation": {"split_ratio": 0.1, "seed": SEED}}
    train, _ = prepare_dpo(spark, cfg, max_length=OVERLENGTH_MAX)
    return train.select("id")


@query("prepare_distill_train")
def q_prepare_distill_train(spark, sf_dir):
    """(query, completion) pairs -> rename -> split by size -> teacher prompts -> prompt-length filter."""
    from chatsift.plans.jobs import prepare_distill
    from chatsift.sinks.writers import write_split

    root = work_path(spark, "sdft-src")
    write_split(tb.turn_pairs(spark, sf_dir).withColumnRenamed("prompt", "query"), root, "train")
    cfg = {"datasets": [{"name": root, "column_map": {"prompt": "query"}}],
           "validation": {"split_size": 5, "seed": SEED},
           "sdft": {"teacher_system_prompt": TEACHER_SYSTEM}}
    train, _ = prepare_distill(spark, cfg, max_prompt_length=PROMPT_MAX)
    return train.select("id", _md5_turns(F.col("teacher_prompt")).alias("teacher_md5"))


# --------------------------------------------------- jobs as a whole (E1-E3, E7-E9) ---

def example_stages() -> list[Stage]:
    """Two user stages: a Column, and a vectorised UDF over the assistant text."""
    @F.pandas_udf("boolean")
    def short(texts: pd.Series) -> pd.Series:
        return texts.str.len() <= JOB_MAX_CHARS

    return [Stage("Turns", F.size("messages") >= JOB_MIN_TURNS),
            Stage("Answer length", short, (tx.join_contents("messages", "assistant"),))]


@query("user_stages")
def q_user_stages(spark, sf_dir):
    return curate(tb.chat(spark, sf_dir), user_stages=example_stages()).funnel


@query("curate_job")
def q_curate_job(spark, sf_dir):
    """E1 with every stage: language, n-grams, user stages and the judge; half of the conversations have no id.
    The last two rows count the released copies: all rows, and those with an id."""
    chats = tb.label_requests(tb.chat(spark, sf_dir), spark, sf_dir)
    root, release = work_path(spark, "curate-src"), work_path(spark, "curate-release")
    write_split(chats.withColumn("id", F.when(F.col("id") % 2 == 0, F.col("id"))), root, "train")
    funnel = jobs.run_curate(spark, root, release, profiles(spark, sf_dir), lang=JOB_LANG, user_stages=example_stages(),
                             client_factory=LabelStubClient, extra_cols=["quality"])
    out = release_manifest(spark, release, "curated")
    copies = [(9, "released as parquet", spark.read.parquet(out["parquet"])),
              (10, "released as JSON lines", spark.read.schema(GEN_SCHEMA).json(out["jsonl"]))]
    for order, name, rows in copies:
        counted = rows.agg(F.lit(order).alias("stage_order"), F.lit(name).alias("stage"), F.count(F.lit(1)).alias("before"),
                           F.count("id").alias("after"))
        funnel = funnel.unionByName(counted.withColumn("removed", F.col("before") - F.col("after")))
    return funnel


@query("judge_job")
def q_judge_job(spark, sf_dir):
    """A saved dataset judged row by row and the accepted rows written as ``train``."""
    root, out = work_path(spark, "judge-src"), work_path(spark, "judge-out")
    write_split(tb.label_requests(tb.chat(spark, sf_dir), spark, sf_dir), root, "train")
    jobs.run_judge(spark, root, out, LabelStubClient, extra_cols=["quality"])
    return load_split(spark, out, "train").select("id", F.size("messages").alias("n_messages"))


@query("generate_job")
def q_generate_job(spark, sf_dir):
    """Generation on top of a partly written sink with broken lines; its summary."""
    root = work_path(spark, "generate-src")
    pairs = tb.turn_pairs(spark, sf_dir).withColumnRenamed("completion", "demonstration")
    write_split(tb.turn_requests(pairs, spark, sf_dir), root, "train")
    return jobs.run_generate(spark, root, tb.write_done_file(spark, sf_dir), LabelStubClient, request_cols=("id", "quality"))


@query("pick_split")
def q_pick_split(spark, sf_dir):
    """S3: no ``train`` among the saved splits, so the first one."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "lang")
    root = work_path(spark, "splits")
    write_split(docs.where("doc_id % 2 = 1"), root, "second")
    write_split(docs.where("doc_id % 2 = 0"), root, "first")
    return load_split(spark, root, pick_split(spark, root))


@query("report_generations_job")
def q_report_generations_job(spark, sf_dir):
    """All sections of the generation report."""
    return jobs.report_generations(written_generations(spark, sf_dir), profiles(spark, sf_dir)).table()


@query("report_tokens_job")
def q_report_tokens_job(spark, sf_dir):
    """Token lengths of whole conversations."""
    return jobs.report_tokens(tb.chat(spark, sf_dir))


@query("report_loops_job")
def q_report_loops_job(spark, sf_dir):
    """Sampled questions answered by a model that repeats some of them; its flags from the JSON report."""
    questions = read_table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("id"), F.col("text").alias("question"))
    flags, _ = jobs.report_loops(questions, tb.RepeatingClient, LOOP_SAMPLE_N, SEED)
    path = write_json_report(flags, work_path(spark, "loop-job") + "/loops.json")
    back = spark.read.option("multiLine", "true").schema(flags.schema).json(path)
    return back.select("id", F.md5("prompt").alias("prompt_md5"), F.md5("generated").alias("generated_md5"),
                       "no_eos", "ngram_loop", "looping")


# ---------------------------------------------------------------- streams ---

QUERIES.update(STREAM_QUERIES)


def queries() -> dict[str, Query]:
    return dict(QUERIES)
