"""Row filters over chat datasets (F1-F12) as ``DataFrame -> DataFrame``.

Each filter also exposes its predicate as a Column (``*_ok``) so a pipeline
can combine all stages into one pass (see ``chatsift.operators.reports.stage_funnel``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chatsift.functions.text import (
    assistant_tags_valid, has_content, join_contents, parse_verdict, render_chat,
)
from chatsift.functions.token_arrays import is_truncated
from chatsift.operators.ngrams import ngram_loop, ngram_loop_native

MESSAGES = "messages"


# ----------------------------------------------------------- predicates ---

def empty_content_ok(messages: str = MESSAGES) -> Column:
    return has_content(messages)


def think_tags_ok(messages: str = MESSAGES) -> Column:
    return assistant_tags_valid(messages)


def ngram_ok(messages: str = MESSAGES, n: int = 10, k: int = 5, gate: Column | None = None,
             method: str = "arrow") -> Column:
    """No looping n-gram in the assistant text.

    ``gate``: rows failing it send a null text to the UDF, so the Python side
    skips work for rows an earlier stage already removed.
    """
    text = join_contents(messages, "assistant")
    if gate is not None:
        text = F.when(gate, text)
    loop = ngram_loop(text, n, k) if method == "arrow" else ngram_loop_native(text, n, k)
    return ~loop


# ---------------------------------------------------------------- stages ---

def filter_empty_content(df: DataFrame, messages: str = MESSAGES) -> DataFrame:
    """Drop rows where any turn is null, empty or whitespace only."""
    return df.where(empty_content_ok(messages))


def filter_think_tags(df: DataFrame, messages: str = MESSAGES) -> DataFrame:
    """Drop rows where an assistant turn has malformed ``<think>`` tags."""
    return df.where(think_tags_ok(messages))


def filter_ngram_repetition(df: DataFrame, n: int = 10, k: int = 5, messages: str = MESSAGES,
                            method: str = "arrow") -> DataFrame:
    """Drop rows whose assistant text repeats some n-gram more than k times."""
    return df.where(ngram_ok(messages, n, k, method=method))


def conversation_text(messages: str = MESSAGES) -> Column:
    """All turns joined by a space: the text the language stage looks at."""
    return join_contents(messages, None)


def filter_language(df: DataFrame, profiles: DataFrame, lang: str = "fr", messages: str = MESSAGES) -> DataFrame:
    """Keep rows detected as ``lang``; a failed detection drops the row.  Row-local: ids play no part."""
    from chatsift.operators.lang import with_language

    return with_language(df, profiles, conversation_text(messages), "_cs_lang").where(F.col("_cs_lang") == lang).drop("_cs_lang")


def filter_by_verdict(df: DataFrame, replies: DataFrame, id_col: str = "id") -> DataFrame:
    """Keep rows whose judge reply parses as true; missing/unparsable -> rejected."""
    ok = replies.where(parse_verdict(F.col("reply")) & F.col("error").isNull()).select(
        F.col("id").cast("string").alias("_rid"))
    # Reply ids are strings (model output); compare ids as strings.
    return df.join(ok, F.col(id_col).cast("string") == F.col("_rid"), "left_semi")


def filter_overlength(df: DataFrame, max_length: int, count_tokens) -> DataFrame:
    """Preference rows whose rendered prompt+chosen and prompt+rejected both fit."""
    chosen = count_tokens(render_chat(F.concat(F.col("prompt"), F.col("chosen"))))
    rejected = count_tokens(render_chat(F.concat(F.col("prompt"), F.col("rejected"))))
    return df.where(F.greatest(chosen, rejected) <= max_length)


def filter_long_prompts(df: DataFrame, max_prompt_length: int, count_tokens) -> DataFrame:
    """Student and teacher prompts (with generation prompt) both within the limit."""
    s_len = count_tokens(render_chat(F.col("prompt"), add_generation_prompt=True))
    t_len = count_tokens(render_chat(F.col("teacher_prompt"), add_generation_prompt=True))
    return df.where((s_len <= max_prompt_length) & (t_len <= max_prompt_length))


def loop_flags(df: DataFrame, text_col: str = "generated", finish_col: str = "finish_reason",
               n: int = 10, k: int = 3) -> DataFrame:
    """``no_eos`` (finish reason is ``length``), ``ngram_loop`` and ``looping``."""
    no_eos = F.coalesce(F.col(finish_col) == "length", F.lit(False))
    return df.withColumns({
        "no_eos": no_eos,
        "ngram_loop": ngram_loop(text_col, n, k),
    }).withColumn("looping", F.col("no_eos") | F.col("ngram_loop"))


def truncated_flag(ids: str, eos_id: int, pad_id: int) -> Column:
    return is_truncated(ids, eos_id, pad_id)
