"""Column -> Column functions over token-id arrays and logit arrays.

Token ids are ``array<int|long>``; logits are ``array<float|double>``.
All are Spark built-ins (higher-order functions), one pass per array.
Scalars needed inside a lambda are carried through ``aggregate``'s
accumulator or zipped in with ``array_repeat``: never referenced as a computed
column from inside a lambda (Catalyst would inline and recompute it per element).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ------------------------------------------------------------- token ids ---

def clip_left(ids, max_len: int) -> Column:
    """Keep the last ``max_len`` ids (truncation on the left)."""
    a = _col(ids)
    return F.slice(a, F.greatest(F.size(a) - max_len + 1, F.lit(1)), max_len)


def clip_right(ids, max_len: int) -> Column:
    """Keep the first ``max_len`` ids (truncation on the right)."""
    return F.slice(_col(ids), 1, max_len)


def pad_to(ids, width: int, pad_id: int, side: str) -> Column:
    """Pad an array to ``width`` with ``pad_id`` on the ``left`` or ``right``."""
    a = _col(ids)
    fill = F.array_repeat(F.lit(pad_id).cast("int"), F.greatest(F.lit(width) - F.size(a), F.lit(0)))
    return F.concat(fill, a) if side == "left" else F.concat(a, fill)


def pad_mask(ids, width: int, side: str) -> Column:
    """1 for real tokens, 0 for padding, laid out as :func:`pad_to` does."""
    a = _col(ids)
    ones = F.array_repeat(F.lit(1), F.size(a))
    zeros = F.array_repeat(F.lit(0), F.greatest(F.lit(width) - F.size(a), F.lit(0)))
    return F.concat(zeros, ones) if side == "left" else F.concat(ones, zeros)


def eos_clip(ids, eos_id: int) -> Column:
    """Tokens up to and including the first EOS; all of them when there is none."""
    a = _col(ids)
    pos = F.array_position(a, F.lit(eos_id))
    return F.when(pos > 0, F.slice(a, 1, pos.cast("int"))).otherwise(a)


def is_truncated(ids, eos_id: int, pad_id: int) -> Column:
    """The last id is neither EOS nor PAD (an empty completion counts as truncated)."""
    last = F.try_element_at(_col(ids), F.lit(-1))
    return F.coalesce(~last.isin(eos_id, pad_id), F.lit(True))


# ---------------------------------------------------------------- logits ---

def log_softmax(logits, temperature: float = 1.0) -> Column:
    """log-softmax of ``logits / temperature`` (max-shifted for stability)."""
    t = float(temperature)
    x = F.transform(_col(logits), lambda v: v.cast("double") / F.lit(t))
    acc0 = F.struct(F.lit(float("-inf")).alias("m"), F.lit(0.0).alias("s"))

    # Online log-sum-exp: one pass keeps (running max, sum of exp(v - max)).
    def merge(acc, v):
        m = F.greatest(acc["m"], v)
        return F.struct(m.alias("m"), (acc["s"] * F.exp(acc["m"] - m) + F.exp(v - m)).alias("s"))

    lse = F.aggregate(x, acc0, merge, lambda acc: acc["m"] + F.log(acc["s"]))
    return F.zip_with(x, F.array_repeat(lse, F.size(x)), lambda v, l: v - l)


def selected_logp(logps, token_index) -> Column:
    """Log-probability of the emitted token (0-based index into the vocabulary)."""
    idx = F.lit(token_index) if isinstance(token_index, int) else _col(token_index)
    return F.try_element_at(_col(logps), idx.cast("int") + 1)


def entropy_from_logps(logps) -> Column:
    """-sum p * log p for a log-probability vector."""
    return -F.aggregate(_col(logps), F.lit(0.0), lambda acc, lp: acc + F.exp(lp) * lp)


def kl_from_logps(p_logps, q_logps) -> Column:
    """KL(p || q) = sum p * (log p - log q), both given as log-probabilities."""
    return F.aggregate(
        F.zip_with(_col(p_logps), _col(q_logps), lambda lp, lq: F.exp(lp) * (lp - lq)),
        F.lit(0.0),
        lambda acc, v: acc + v,
    )


def mixture_logps(s_logps, t_logps, alpha: float) -> Column:
    """log((1 - alpha) * S + alpha * T), elementwise from log-probabilities."""
    a = float(alpha)
    return F.zip_with(
        _col(s_logps),
        _col(t_logps),
        lambda s, t: F.log(F.lit(1.0 - a) * F.exp(s) + F.lit(a) * F.exp(t)),
    )


def generalized_jsd(s_logps, t_logps, alpha: float) -> Column:
    """Divergence summed over the vocabulary for one token position.

    alpha = 0: KL(T || S) (forward); alpha = 1: KL(S || T) (reverse);
    otherwise alpha * KL(T || M) + (1 - alpha) * KL(S || M) with
    M = (1 - alpha) * S + alpha * T.
    """
    a = float(alpha)
    if a == 0.0:
        return kl_from_logps(t_logps, s_logps)
    if a == 1.0:
        return kl_from_logps(s_logps, t_logps)
    s, t = _col(s_logps), _col(t_logps)
    # Per element: a * T * (logT - logM) + (1 - a) * S * (logS - logM).
    per = F.zip_with(
        s, t,
        lambda ls, lt: F.struct(ls.alias("ls"), lt.alias("lt")),
    )

    def term(e):
        lm = F.log(F.lit(1.0 - a) * F.exp(e["ls"]) + F.lit(a) * F.exp(e["lt"]))
        return F.lit(a) * F.exp(e["lt"]) * (e["lt"] - lm) + F.lit(1.0 - a) * F.exp(e["ls"]) * (e["ls"] - lm)

    return F.aggregate(per, F.lit(0.0), lambda acc, e: acc + term(e))
