"""Stages that users add to the curation job (M3): a Column, or a vectorised UDF over columns.

A stage sees only what the stages before it kept and is counted in the funnel
like any other.  ``load_stages("pkg.mod:name")`` finds them for the command line;
``register_stage`` names one for a whole session.
"""

from __future__ import annotations

import importlib
from dataclasses import dataclass
from typing import Callable, Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Stage:
    """Keeps the rows whose ``test`` is true; null drops.

    ``test`` is a boolean Column, or a function of Columns such as a
    ``pandas_udf``, called with ``inputs`` (columns or their names).  The inputs
    of rows that an earlier stage dropped are null, so a UDF has no work there.
    """

    name: str
    test: Column | Callable[..., Column]
    inputs: tuple[Column | str, ...] = ()

    def flag(self, gate: Column) -> Column:
        """Whether a row that passes ``gate`` is kept."""
        if isinstance(self.test, Column):
            kept = self.test
        else:
            columns = [F.col(c) if isinstance(c, str) else c for c in self.inputs]
            kept = self.test(*[F.when(gate, c) for c in columns])
        return F.coalesce(kept.cast("boolean"), F.lit(False))


REGISTRY: dict[str, Stage] = {}


def register_stage(stage: Stage) -> Stage:
    if stage.name in REGISTRY:
        raise ValueError(f"a stage named {stage.name!r} is registered already")
    REGISTRY[stage.name] = stage
    return stage


def load_stages(names: Iterable[str]) -> list[Stage]:
    """Stages by registered name or by ``module:attribute``: a :class:`Stage`, a list of them, or a function giving either."""
    out: list[Stage] = []
    for name in names:
        module, colon, attribute = name.partition(":")
        found = getattr(importlib.import_module(module), attribute) if colon else REGISTRY[name]
        if not isinstance(found, (Stage, list, tuple)):
            found = found()
        out += [found] if isinstance(found, Stage) else list(found)
    return out
