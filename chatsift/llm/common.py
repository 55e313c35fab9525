"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
from typing import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from chatsift.session import ship_package, work_path

#: A word is a run of anything but blank and the five ASCII controls TAB to CR.
WORD = r"[^\x20\x09-\x0D]+"
#: The separators of words as one Java/RE2 character class and as bytes.
BLANK_CLASS = r"[\x20\x09-\x0D]"
BLANK_BYTES = b" \t\n\x0b\x0c\r"


def split_words(text: str) -> list[bytes]:
    """The words of one text in order, as UTF-8 (``bytes.split`` knows exactly the six separators)."""
    return text.encode("utf-8", "surrogatepass").split()


_KEPT: dict[str, object] = {}  # what this Python worker keeps for the tasks to come


def kept(name: str, make: Callable[[], object]) -> object:
    """One object per Python worker, for all tasks of functions that ``arrow_map`` was told keep it."""
    if name not in _KEPT:
        _KEPT[name] = make()
    return _KEPT[name]


def _let_go(keeps: str | None) -> None:
    for name in [x for x in _KEPT if x != keeps]:
        del _KEPT[name]


def trim_memory() -> None:
    """Gives freed memory back to the system: allocators hold it, and an idle worker would count it beside the JVM."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim is not None:
        trim(0)


def arrow_map(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
              schema: str | StructType, keeps: str | None = None) -> DataFrame:
    """``mapInArrow`` with the package shipped to the workers.

    Workers outlive stages: what one keeps for another function (all but ``keeps``) is let go before its first row here,
    and freed memory goes back to the system at the end of each task.
    """
    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _let_go(keeps)
        try:
            yield from fn(rows)
        finally:
            trim_memory()

    ship_package(df.sparkSession)
    return df.mapInArrow(run, schema)


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written below the shared checkpoint folder and read back.

    Cuts the lineage: a lost executor costs the running stage only, and an
    expensive input is not computed again by the next job.
    """
    path = work_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def batches(rows: Iterator[pa.RecordBatch], max_rows: int, text_col: str | None = None,
            max_bytes: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of at most ``max_rows`` rows, and of about ``max_bytes`` of text where a text column is named."""
    for batch in rows:
        start = 0
        n = batch.num_rows
        sizes = None
        if text_col is not None:
            sizes = pa.compute.fill_null(pa.compute.binary_length(batch.column(text_col)), 0).to_numpy(zero_copy_only=False)
        while start < n:
            stop = min(n, start + max_rows)
            if sizes is not None:
                total = sizes[start:stop].cumsum()
                stop = start + max(1, int((total <= max_bytes).sum()))
            yield batch.slice(start, stop - start)
            start = stop


def fresh(columns: list[str], name: str) -> str:
    """A column name that none of ``columns`` has, whatever the case of the letters."""
    used = {c.lower() for c in columns}
    while name.lower() in used:
        name = "_" + name
    return name


def text_or_empty(name: str = "text"):
    return F.coalesce(F.col(name), F.lit(""))


import pyarrow.compute  # noqa: E402  (binds pa.compute, used above)


#: A key with over one part in so many of all rows is hot; there are fewer such keys than this.
HOT_PARTS = 2000


def skewed_left_join(rows: DataFrame, values: DataFrame, key: str, count: str) -> DataFrame:
    """``rows`` with the columns of ``values`` (one row for each key, ``count`` = its rows in ``rows``).

    Keys that hold over 1 / ``HOT_PARTS`` of all rows are fewer than ``HOT_PARTS``,
    so they are broadcast; the rows of all others are joined by a shuffle, in
    which no key can be larger than that.  Both inputs should be staged.
    """
    total = values.agg(F.sum(count)).first()[0] or 0
    hot = F.broadcast(values.where(F.col(count) * HOT_PARTS > total).drop(count).withColumn("_hot", F.lit(True)))
    cold = values.where(F.col(count) * HOT_PARTS <= total).drop(count)
    marked = rows.drop(count).join(hot.select(key, "_hot"), key, "left")
    return (rows.drop(count).join(hot.drop("_hot"), key)
            .unionByName(marked.where("_hot is null").drop("_hot").join(cold, key, "left")))
