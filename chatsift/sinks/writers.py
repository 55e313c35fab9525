"""Sinks: split folders, append-only JSON lines, JSON reports, releases.

All rows are written by tasks: each task commits its own files through the
output committer, so a lost executor only re-runs its tasks.
"""

from __future__ import annotations

import json
import textwrap
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chatsift.functions.text import MESSAGE_TYPE
from chatsift.session import ship_package, staged, work_path

MANIFEST = "manifest.json"


def write_split(df: DataFrame, path: str, split: str = "train", mode: str = "overwrite") -> str:
    """Write ``df`` as ``path/<split>`` parquet; an empty result keeps its schema."""
    out = f"{path.rstrip('/')}/{split}"
    df.write.mode(mode).parquet(out)
    return out


def empty_chat(spark) -> DataFrame:
    """An empty ``(id, messages)`` table, written when nothing passes a judge."""
    return spark.createDataFrame([], f"id string, messages {MESSAGE_TYPE}")


def append_jsonl(df: DataFrame, path: str) -> str:
    """Append rows as JSON lines (non-ASCII kept as is); one file per task."""
    df.write.mode("append").option("ignoreNullFields", "false").json(path)
    return path


# ------------------------------------------------------------------ files ---

def _file_system(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def _replace(spark: SparkSession, source, target) -> None:
    """Move a finished file to its place in one step, over an earlier one."""
    jvm, gateway = spark._jvm, spark.sparkContext._gateway
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.makeQualified(target).toUri(), spark._jsc.hadoopConfiguration())
    overwrite = gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    overwrite[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    context.rename(fs.makeQualified(source), fs.makeQualified(target), overwrite)


def write_json_report(df: DataFrame, path: str, indent: int = 2) -> str:
    """All rows as one JSON array file (non-ASCII kept) in the order of ``df``; ``[]`` without rows.

    Tasks render the rows and write them as text fragments.  The fragments are
    then joined through the session's Hadoop file system, stream to stream, so
    no row is held by the driver and ``path`` may be on any cluster file system.
    """
    spark = df.sparkSession
    ship_package(spark)

    def rendered(batches):
        for batch in batches:
            texts = [textwrap.indent(json.dumps(r, indent=indent, ensure_ascii=False, default=str), " " * indent)
                     for r in batch.to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], names=["text"])

    rows = staged(df.mapInArrow(rendered, "text string").withColumn("n", F.monotonically_increasing_id()), "report-rows")
    last = rows.agg(F.max("n")).first()[0]
    folder = work_path(spark, "report-text")
    fs, target = _file_system(spark, path)
    out_path = spark._jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex[:8]}.tmp")
    if last is not None:
        line = F.when(F.col("n") == last, F.col("text")).otherwise(F.concat("text", F.lit(",")))
        rows.orderBy("n").select(line.alias("value")).write.text(folder)
    out = fs.create(out_path, True)
    try:
        if last is None:
            out.write(bytearray(b"[]"))
        else:
            out.write(bytearray(b"[\n"))
            parts_fs, parts = _file_system(spark, folder)
            names = sorted(s.getPath().toString() for s in parts_fs.listStatus(parts) if s.getPath().getName().startswith("part-"))
            for name in names:
                part = parts_fs.open(spark._jvm.org.apache.hadoop.fs.Path(name))
                try:
                    spark._jvm.org.apache.hadoop.io.IOUtils.copyBytes(part, out, 1 << 20, False)
                finally:
                    part.close()
            out.write(bytearray(b"]"))
    finally:
        out.close()
    _replace(spark, out_path, target)
    return path


# --------------------------------------------------------------- releases ---

def publish(df: DataFrame, release_path: str, name: str = "data") -> dict:
    """Release a table: parquet plus a copy in JSON lines, as a new version that a manifest names.

    ``df`` is computed once: the JSON lines come from the parquet copy.  The
    manifest ``release_path/<name>/manifest.json`` is replaced when both copies
    are complete, so a reader (:func:`read_release`) sees the version before or
    this one, never a part.  Folders of earlier versions stay.
    """
    spark = df.sparkSession
    base = f"{release_path.rstrip('/')}/{name}"
    version = f"{base}/{uuid.uuid4().hex[:12]}"
    parquet_out = write_split(df, version, "train")
    jsonl_out = f"{version}/raw_jsonl"
    released = spark.read.schema(df.schema).parquet(parquet_out)
    released.write.json(jsonl_out)
    found = {"parquet": parquet_out, "jsonl": jsonl_out, "rows": released.count()}
    fs, target = _file_system(spark, f"{base}/{MANIFEST}")
    temporary = spark._jvm.org.apache.hadoop.fs.Path(f"{version}/{MANIFEST}.tmp")
    out = fs.create(temporary, True)
    try:
        out.write(bytearray(json.dumps(found, indent=2).encode("utf-8")))
    finally:
        out.close()
    _replace(spark, temporary, target)
    return found


def release_manifest(spark: SparkSession, release_path: str, name: str = "data") -> dict:
    """``{parquet, jsonl, rows}`` of the current version of a release."""
    path = f"{release_path.rstrip('/')}/{name}/{MANIFEST}"
    return json.loads("\n".join(r[0] for r in spark.read.text(path, wholetext=True).collect()))


def read_release(spark: SparkSession, release_path: str, name: str = "data") -> DataFrame:
    """The parquet copy of the current version of a release."""
    return spark.read.parquet(release_manifest(spark, release_path, name)["parquet"])
