"""Model calls over a table (M1-M3) with ``mapInPandas``.

The client is injected: ``client_factory(endpoint) -> client`` with
``client.complete(request: dict, **options) -> dict`` returning ``reply`` and
optionally ``finish_reason`` / ``completion_tokens``.  One client per endpoint
per Python worker; rows of a batch are spread round-robin over endpoints and
run on a thread pool (concurrency per task = ``concurrency``; total = tasks x
threads).  A call that still fails after ``attempts`` tries yields an
``error`` value instead of failing the job.

Model replies are not deterministic: write (or checkpoint) the result before
using it twice, so a recomputed partition cannot change an answer.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import asdict, dataclass
from typing import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame

REPLY_SCHEMA = "id string, reply string, finish_reason string, completion_tokens long, error string"


@dataclass(frozen=True)
class SamplingOptions:
    """Request options handed to the client (fixed defaults of the three jobs)."""

    temperature: float
    top_p: float
    max_tokens: int | None = None


JUDGE_OPTIONS = SamplingOptions(temperature=0.15, top_p=0.1, max_tokens=10)
GENERATION_OPTIONS = SamplingOptions(temperature=0.6, top_p=0.95)
LOOP_OPTIONS = SamplingOptions(temperature=0.6, top_p=1.0, max_tokens=32768)


def _call(client, request: dict, options: dict, attempts: int, retry_empty: bool,
          accept: Callable[[str | None], bool] | None) -> dict:
    last = "no attempt"
    for _ in range(max(attempts, 1)):
        try:
            out = client.complete(request, **options)
            reply = out.get("reply")
            if retry_empty and not reply:
                last = "empty reply"
                continue
            if accept is not None and not accept(reply):
                last = f"reply not accepted: {reply!r}"
                continue
            return {
                "reply": reply,
                "finish_reason": out.get("finish_reason"),
                "completion_tokens": out.get("completion_tokens"),
                "error": None,
            }
        except Exception as exc:  # noqa: BLE001 - recorded as the row's error
            last = f"{type(exc).__name__}: {exc}"
    return {"reply": None, "finish_reason": None, "completion_tokens": None,
            "error": f"failed after {attempts} attempts: {last}"}


def map_model(df: DataFrame, client_factory: Callable, endpoints: list[str] | None = None,
              request_cols: list[str] | None = None, id_col: str = "id",
              options: SamplingOptions | None = None, concurrency: int = 8,
              attempts: int = 1, retry_empty: bool = False,
              accept: Callable[[str | None], bool] | None = None, keep: Sequence[str] = ()) -> DataFrame:
    """``(id, reply, finish_reason, completion_tokens, error)`` for every input row.

    A reply that ``accept`` turns down counts as a failed attempt.  String columns
    named in ``keep`` travel along, so a reply needs no join back by id.
    """
    from chatsift.session import ship_package

    ship_package(df.sparkSession)
    cols = request_cols or df.columns
    eps = list(endpoints or ["default"])
    opts = {k: v for k, v in asdict(options).items() if v is not None} if options else {}

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        clients = [client_factory(ep) for ep in eps]
        with ThreadPoolExecutor(max_workers=max(concurrency, 1)) as pool:
            for pdf in batches:
                records = pdf[cols].to_dict("records")
                futures = [
                    pool.submit(_call, clients[i % len(clients)], rec, opts, attempts, retry_empty, accept)
                    for i, rec in enumerate(records)
                ]
                results = [f.result() for f in futures]
                out = pd.DataFrame(results, columns=["reply", "finish_reason", "completion_tokens", "error"])
                out.insert(0, "id", pdf[id_col].astype("string").to_numpy())
                out["completion_tokens"] = out["completion_tokens"].astype("Int64")
                for c in keep:
                    out[c] = pdf[c].to_numpy()
                yield out

    schema = ", ".join([REPLY_SCHEMA] + [f"`{c}` string" for c in keep])
    return df.select(*dict.fromkeys([id_col] + list(cols) + list(keep))).mapInPandas(run, schema)


class LabelStubClient:
    """Deterministic stand-in model for tests and oracles.

    Replies from a label carried in the request: 1 -> "True", 0 -> "False",
    anything else raises (an error row).  Token count = words in the reply
    text plus the request's id parity, to exercise the nullable column.
    """

    def __init__(self, endpoint: str = "default", label_key: str = "quality"):
        self.endpoint = endpoint
        self.label_key = label_key

    def complete(self, request: dict, **_options) -> dict:
        label = request.get(self.label_key)
        if label is None or pd.isna(label):
            raise RuntimeError("no label for this request")
        reply = {1: "True", 0: "False"}.get(int(label))
        if reply is None:
            raise ValueError(f"unexpected label {label!r}")
        return {"reply": reply, "finish_reason": "stop", "completion_tokens": 1}
