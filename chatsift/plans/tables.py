"""Tables derived with Spark from the driver's parquet tables, in the shapes the
operators consume (chat, pairs, preferences, sequences, token logs, replies).

Every builder reads whole tables; none invents rows.  The same derivations
are written in SQL in :mod:`chatsift.plans.oracle`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chatsift.functions.text import words
from chatsift.operators.model_calls import LabelStubClient, map_model
from chatsift.operators.partitioning import spread
from chatsift.session import read_table, work_path
from chatsift.sources.fixtures import chat_table

# Fixed values of the derived tables.
EOS_ID = 1          # token id = word length; one-letter words play EOS
PAD_ID = 0
SEQ_STEP = 50       # sequences per logged step
VEC_PER_SEQ = 16    # embedding rows per logged sequence
SEQ_PER_STEP = 4    # logged sequences per step in the token log
PROMPT_WORDS = 12   # leading words of a document that form its prompt
TURN_IDS = 1000     # ids of turns: so many for each conversation


def chat(spark: SparkSession, sf_dir: str, variants: bool = True) -> DataFrame:
    return chat_table(spark, sf_dir, variants)


def _next_turns(spark: SparkSession, sf_dir: str, n: int) -> DataFrame:
    """Every turn with the role and text of the ``n`` turns after it, by an equi-join on (conv_id, turn)."""
    t = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    out = t
    for k in range(1, n + 1):
        later = t.select("conv_id", (F.col("turn") - k).alias("turn"), F.col("role").alias(f"role{k}"), F.col("text").alias(f"text{k}"))
        out = out.join(later, ["conv_id", "turn"], "left")
    return out


def turn_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(id, prompt, completion)``: every user turn that an assistant turn follows; id = 1000 * conv_id + turn."""
    pairs = _next_turns(spark, sf_dir, 1).where("role = 'user' AND role1 = 'assistant' AND text IS NOT NULL AND text1 IS NOT NULL")
    return pairs.select(_turn_id().alias("id"), F.col("text").alias("prompt"), F.col("text1").alias("completion"))


def _turn_id():
    return F.col("conv_id").cast("long") * TURN_IDS + F.col("turn")


def preference_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(conv_id, prompt, chosen, rejected?)`` from every user turn: the turn after it is chosen, the second
    turn after that (null at the end) rejected."""
    t = _next_turns(spark, sf_dir, 3).where("role = 'user'")
    return t.select(_turn_id().alias("conv_id"), F.col("text").alias("prompt"), F.col("text1").alias("chosen"),
                    F.col("text3").alias("rejected"))


def instruction_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Instruction-format rows from ``benchmark`` exercising every branch."""
    b = read_table(spark, sf_dir, "benchmark")
    i = F.col("item_id")
    return b.select(
        F.when(i % 3 == 0, F.lit("Tu es un assistant.")).otherwise(F.lit("")).alias("system"),
        F.col("text").alias("instruction"),
        F.when(i % 2 == 0, F.concat(F.lit("Contexte "), i.cast("string"))).otherwise(F.lit("")).alias("input"),
        F.when(i % 5 == 0, F.lit("")).otherwise(F.concat(F.lit("Réponse : "), F.col("text"))).alias("output"),
        F.when((i % 5 == 0) & (i % 10 != 0), F.concat(F.lit("r"), i.cast("string"))).alias("response"),
    )


def sequence_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(step, seq_id, prompt_ids, completion_ids, prompt, completion)`` from
    documents: token id = word length; the first words are the prompt."""
    d = spread(read_table(spark, sf_dir, "documents"))
    lens = d.select("doc_id", F.transform(words("text"), lambda w: F.length(w)).alias("_ids"))
    return lens.select(
        (F.col("doc_id") / SEQ_STEP).cast("long").alias("step"),
        F.col("doc_id").alias("seq_id"),
        F.slice("_ids", 1, PROMPT_WORDS).alias("prompt_ids"),
        F.slice("_ids", PROMPT_WORDS + 1, F.greatest(F.size("_ids"), F.lit(1))).alias("completion_ids"),
    )


def distribution_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(step, seq_id, pos, token, mask, student, teacher)`` from embeddings: the teacher of a row is the
    next row's vector (an equi-join on vec_id + 1), that of the last row the first one's."""
    e = read_table(spark, sf_dir, "embeddings")
    least, most = e.agg(F.min("vec_id"), F.max("vec_id")).first()
    before = F.when(F.col("vec_id") == least, most).otherwise(F.col("vec_id") - 1)
    nxt = e.select(before.alias("vec_id"), F.col("embedding").alias("teacher"))
    return e.join(nxt, "vec_id").select(
        (F.col("vec_id") / (VEC_PER_SEQ * SEQ_PER_STEP)).cast("long").alias("step"),
        (F.col("vec_id") / VEC_PER_SEQ).cast("long").alias("seq_id"),
        (F.col("vec_id") % VEC_PER_SEQ).cast("int").alias("pos"),
        F.col("label").cast("int").alias("token"),
        F.when((F.col("label") == 0) & (F.col("vec_id") % VEC_PER_SEQ >= 12), 0).otherwise(1).alias("mask"),
        F.transform("embedding", lambda v: v.cast("double")).alias("student"),
        F.transform("teacher", lambda v: v.cast("double")).alias("teacher"),
    )


def metric_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(mode, step, key, value)`` from events (errors are the eval metrics)."""
    ev = read_table(spark, sf_dir, "events")
    return ev.select(
        F.when(F.col("event_type") == "error", "eval").otherwise("train").alias("mode"),
        F.col("event_id").alias("step"),
        F.col("event_type").alias("key"),
        F.col("value"),
    )


def label_requests(df: DataFrame, spark: SparkSession, sf_dir: str, id_col: str = "id") -> DataFrame:
    """Attach ``labels.quality`` (joined on id = doc_id) for the stub judge."""
    return _labelled(df, F.col(id_col), spark, sf_dir)


def turn_requests(df: DataFrame, spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same for ids of turns: the label of the conversation."""
    return _labelled(df, F.floor(F.col("id") / TURN_IDS).cast("long"), spark, sf_dir)


def _labelled(df: DataFrame, doc_id, spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = read_table(spark, sf_dir, "labels").select(F.col("doc_id").alias("_doc"), "quality")
    return df.join(labels, doc_id == F.col("_doc"), "left").drop("_doc")


def stub_replies(requests: DataFrame, checkpoint: bool = True, keep: tuple[str, ...] = ()) -> DataFrame:
    """Stub model replies, checkpointed: model output must not be recomputed."""
    from chatsift.session import checkpoint_root

    replies = map_model(requests, LabelStubClient, request_cols=["id", "quality"], attempts=3, keep=keep)
    if checkpoint:
        checkpoint_root(requests.sparkSession)
        replies = replies.checkpoint()
    return replies


class RepeatingClient:
    """Deterministic stand-in model for the loop check: repeats the prompt of even ids, runs out of tokens at every fifth."""

    def __init__(self, endpoint: str = "default"):
        self.endpoint = endpoint

    def complete(self, request: dict, **_options) -> dict:
        i, prompt = int(request["id"]), request["prompt"]
        return {"reply": (prompt + " ") * 5 if i % 2 == 0 else prompt, "finish_reason": "length" if i % 5 == 0 else "stop"}


def done_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text lines of a partly written generation sink (one per turn), with
    blank, truncated, id-less and string-id lines by ``conv_id % 7``."""
    t = read_table(spark, sf_dir, "conversations")
    c = _turn_id().cast("string")
    k = F.col("conv_id") % 7
    line = (
        F.when(k == 0, F.lit(""))
        .when(k == 1, F.concat(F.lit('{"id": '), c, F.lit(', "messages": [')))
        .when(k == 2, F.concat(F.lit('{"other": '), c, F.lit("}")))
        .when(k == 3, F.concat(F.lit('{"id": "c'), c, F.lit('"}')))
        .otherwise(F.concat(F.lit('{"id": '), c, F.lit(', "turn": '), F.col("turn").cast("string"), F.lit("}")))
    )
    return t.select(line.alias("value"))


def write_done_file(spark: SparkSession, sf_dir: str) -> str:
    path = work_path(spark, "done-jsonl")
    done_lines(spark, sf_dir).write.text(path)
    return path
