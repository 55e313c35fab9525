"""Adapters from the flat driver tables to the chat schemas the operators use.

``conversations`` holds one row per turn (conv_id, turn, role, text); the
operators work on one row per conversation with a ``messages`` array.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The deterministic variants injected into conversations so the
# filters have something to remove (rule on conv_id % 10).
LOOP_SUFFIX_UNIT = " a b c d e f g h i j"
LOOP_SUFFIX_TIMES = 8


def inject_variants(turns: DataFrame, id_col: str = "conv_id", turn_col: str = "turn",
                    role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Rewrite turn texts by ``conv_id % 10`` (row-local, no shuffle).

    0: turn 0 becomes blank; 1-6: assistant turns get valid think tags;
    7: an unclosed ``<think>``; 8: valid tags plus a looping 10-gram; 9: as is.
    """
    k = F.col(id_col) % 10
    c = F.col(text_col)
    is_asst = F.col(role_col) == "assistant"
    tagged = F.concat(F.lit("<think>"), c, F.lit("</think>"), c)
    new_text = (
        F.when((k == 0) & (F.col(turn_col) == 0), F.lit("  "))
        .when(k.between(1, 6) & is_asst, tagged)
        .when((k == 7) & is_asst, F.concat(F.lit("<think>"), c))
        .when((k == 8) & is_asst, F.concat(tagged, F.lit(LOOP_SUFFIX_UNIT * LOOP_SUFFIX_TIMES)))
        .otherwise(c)
    )
    return turns.withColumn(text_col, new_text)


def messages_from_turns(turns: DataFrame, id_col: str = "conv_id", turn_col: str = "turn",
                        role_col: str = "role", text_col: str = "text",
                        out_id: str = "id") -> DataFrame:
    """One row per conversation: ``(id, messages)`` ordered by turn number.

    One shuffle on the conversation id; each group is a single conversation,
    i.e. exactly the output row, so no group grows beyond one record.
    """
    turn = F.struct(
        F.col(turn_col).alias("t"),
        F.col(role_col).cast("string").alias("role"),
        F.col(text_col).cast("string").alias("content"),
    )
    grouped = turns.groupBy(F.col(id_col).alias(out_id)).agg(F.sort_array(F.collect_list(turn)).alias("_m"))
    return grouped.select(
        out_id,
        F.transform("_m", lambda m: F.struct(m["role"].alias("role"), m["content"].alias("content"))).alias("messages"),
    )


def chat_table(spark, sf_dir: str, variants: bool = True) -> DataFrame:
    """The ``(id, messages)`` chat fixture built from ``conversations``."""
    from chatsift.session import read_table

    turns = read_table(spark, sf_dir, "conversations")
    if variants:
        turns = inject_variants(turns)
    return messages_from_turns(turns)
