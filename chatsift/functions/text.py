"""Column -> Column text functions over strings and ``messages`` arrays.

Every function here is built from Spark SQL built-ins, so it runs inside the
JVM (no Python round trip) and composes with any ``select``/``where``.

A ``messages`` column is ``array<struct<role:string, content:string>>``.

Rule followed throughout: a lambda body references only its own variables or
plain columns.  Catalyst inlines a computed column into a lambda that uses it,
so a per-row scalar referenced from inside ``transform``/``exists`` would be
recomputed once per array element.
"""

from __future__ import annotations

from typing import Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must match the reference's behaviour.
# Python's str.isspace() is true for Unicode whitespace plus the four ASCII
# separators U+001C..U+001F; Java's (?U)\s covers the former only.
WHITESPACE_CLASS = r"\s\x1c-\x1f"
THINK_OPEN = "<think>"
THINK_CLOSE = "</think>"
PREVIEW_CHARS = 500

MESSAGE_TYPE = "array<struct<role:string,content:string>>"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ---------------------------------------------------------------- strings ---

def is_blank(text) -> Column:
    """True when text is null, empty or whitespace only (Python ``not s.strip()``)."""
    return ~F.coalesce(_col(text), F.lit("")).rlike(f"(?U)[^{WHITESPACE_CLASS}]")


def normalize_ws(text) -> Column:
    """Collapse every whitespace run to one space and trim both ends."""
    return F.regexp_replace(
        F.regexp_replace(_col(text), f"(?U)[{WHITESPACE_CLASS}]+", " "), "^ | $", ""
    )


def words(text) -> Column:
    """``str.split()``: split on Unicode whitespace, no empty pieces."""
    return F.filter(F.split(_col(text), f"(?U)[{WHITESPACE_CLASS}]+"), lambda w: w != "")


def think_tags(text) -> Column:
    """The sequence of ``<think>`` / ``</think>`` tags in order of position."""
    return F.regexp_extract_all(_col(text), F.lit("(</?think>)"), 1)


def has_valid_think_tags(text) -> Column:
    """#open == #close > 0 and the i-th open precedes the i-th close.

    That pairing rule is the ballot condition: scanning the tags left to
    right, the count of opens never falls below the count of closes.  Nesting
    passes; text without tags fails; null text fails.
    """
    tags = think_tags(text)
    step = lambda t: F.when(t == THINK_OPEN, F.lit(1)).otherwise(F.lit(-1))
    walk = F.aggregate(
        tags,
        F.struct(F.lit(0).alias("bal"), F.lit(True).alias("ok")),
        lambda acc, t: F.struct(
            (acc["bal"] + step(t)).alias("bal"),
            (acc["ok"] & (acc["bal"] + step(t) >= 0)).alias("ok"),
        ),
        lambda acc: acc["ok"] & (acc["bal"] == 0),
    )
    return F.coalesce((F.size(tags) > 0) & walk, F.lit(False))


def think_content(text) -> Column:
    """Reasoning text before the first ``</think>``; null when there is none.

    Starts after the first ``<think>`` (or at 0 when absent); a ``<think>``
    that only appears after the close gives "".
    """
    t = _col(text)
    close0 = F.instr(t, THINK_CLOSE) - 1            # 0-based, -1 when absent
    open1 = F.instr(t, THINK_OPEN)                  # 1-based, 0 when absent
    start0 = F.when(open1 > 0, open1 - 1 + len(THINK_OPEN)).otherwise(0)
    length = F.greatest(close0 - start0, F.lit(0))
    return F.when(close0 >= 0, F.substring(t, start0 + 1, length))


def preview(text, n: int = PREVIEW_CHARS) -> Column:
    """First n characters, plus ``...`` when the text is longer."""
    t = _col(text)
    return F.concat(F.substring(t, 1, n), F.when(F.length(t) > n, F.lit("...")).otherwise(F.lit("")))


def parse_verdict(reply) -> Column:
    """Judge reply -> true/false; ``true`` is checked before ``false``; else null."""
    low = F.lower(_col(reply))
    return F.when(low.contains("true"), F.lit(True)).when(low.contains("false"), F.lit(False))


def question_prompt(question) -> Column:
    return F.concat(F.lit("Question: "), _col(question), F.lit("\n"))


# --------------------------------------------------------------- messages ---

def message(role, content) -> Column:
    r = F.lit(role) if isinstance(role, str) else role
    return F.struct(r.cast("string").alias("role"), _col(content).cast("string").alias("content"))


def messages_of(*turns: Column) -> Column:
    """Build a messages array from struct columns; null turns are dropped."""
    return F.filter(F.array(*turns), lambda m: m.isNotNull())


def has_content(messages) -> Column:
    """Every turn has non-blank content; an empty conversation passes."""
    return F.forall(
        _col(messages),
        lambda m: F.coalesce(m["content"], F.lit("")).rlike(f"(?U)[^{WHITESPACE_CLASS}]"),
    )


def assistant_tags_valid(messages) -> Column:
    """Every assistant turn has valid think tags; no assistant turn passes."""
    return F.forall(
        _col(messages),
        lambda m: (m["role"] != "assistant") | has_valid_think_tags(m["content"]),
    )


def contents(messages, role: str | None = None) -> Column:
    msgs = _col(messages)
    if role is not None:
        msgs = F.filter(msgs, lambda m: m["role"] == role)
    return F.transform(msgs, lambda m: m["content"])


def join_contents(messages, role: str | None = None, sep: str = " ") -> Column:
    """Contents joined by ``sep`` (all roles, or one role). Null contents are skipped."""
    return F.array_join(contents(messages, role), sep)


def think_contents(messages) -> Column:
    """Reasoning parts of the assistant turns that close their reasoning."""
    return F.filter(
        F.transform(contents(messages, "assistant"), lambda c: think_content(c)),
        lambda c: c.isNotNull(),
    )


def render_judge_text(messages) -> Column:
    """``ROLE:\\ncontent`` for every turn, joined by a blank line; missing content reads ``None``."""
    return F.array_join(
        F.transform(_col(messages), lambda m: F.concat(F.upper(m["role"]), F.lit(":\n"), F.coalesce(m["content"], F.lit("None")))),
        "\n\n",
    )


# ChatML-style default chat template.
CHAT_START = "<|im_start|>"
CHAT_END = "<|im_end|>"


def render_chat(messages, add_generation_prompt: bool = False) -> Column:
    """Render a conversation with a ChatML-style template into one string."""
    body = F.array_join(
        F.transform(
            _col(messages),
            lambda m: F.concat(F.lit(CHAT_START), m["role"], F.lit("\n"), m["content"], F.lit(CHAT_END + "\n")),
        ),
        "",
    )
    if add_generation_prompt:
        body = F.concat(body, F.lit(CHAT_START + "assistant\n"))
    return body


def n_messages(messages) -> Column:
    return F.size(_col(messages))


# ----------------------------------------------------------------- tokens ---

# Default pre-tokenizer: runs of letters, runs of digits, or one other
# non-space symbol.  A real tokenizer can be plugged in with
# :func:`tokenizer_count_udf`.
PRETOKEN_PATTERN = r"\p{L}+|\p{N}+|[^\p{L}\p{N}\s]"


def token_count(text, special_tokens: int = 0) -> Column:
    """Number of pre-tokens in the text, plus ``special_tokens`` (null text -> null)."""
    n = F.size(F.regexp_extract_all(_col(text), F.lit(f"({PRETOKEN_PATTERN})"), 1))
    return n + F.lit(int(special_tokens)) if special_tokens else n


def tokenizer_count_udf(factory, add_special_tokens: bool = False):
    """A Column function counting tokens with a user tokenizer.

    ``factory()`` must return an object with ``encode(text) -> list``; it is
    built once per Python worker (iterator-of-batches UDF), never per row.
    """
    from chatsift.session import ship_package

    ship_package()

    @F.pandas_udf("long")
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        tok = factory()
        for s in batches:
            yield pd.Series(
                [None if t is None else len(_encode(tok, t, add_special_tokens)) for t in s],
                dtype="Int64",
            )

    return lambda text: count(_col(text))


def _encode(tok, text, add_special_tokens):
    try:
        return tok.encode(text, add_special_tokens=add_special_tokens)
    except TypeError:
        return tok.encode(text)
