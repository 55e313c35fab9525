"""Structured Streaming forms of the row-local jobs.

* :func:`curate_stream`: the empty/think/n-gram stages on arriving chat files.
  All three are row-local (no state), so the stream is a plain
  ``readStream -> where -> writeStream``; the n-gram stage is the Arrow UDF.
* :func:`generate_stream`: "append as completed, resume by id".  Keyed state
  remembers the ids that were taken on, so that a request with such an id in a
  later micro-batch is passed over without a look at the sink.  A micro-batch
  calls the model and appends JSON lines.

  Requests whose call failed wait in a table beside the checkpoint with the
  number of their attempts.  The next micro-batch takes them along; where there
  is none (they failed in the last one), the next start of the query tries them
  before anything else.  After ``max_attempts`` calls a request goes to a table
  of failures.

  Ids that were in the sink before the stream's first start are read once, then.
  A micro-batch that is replayed after a crash (it left a mark when it began)
  compares itself with the sink, as it may have written before the crash; that
  and the first start are the only reads of the sink.
"""

from __future__ import annotations

import logging
from typing import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from chatsift.operators import filters as flt
from chatsift.operators import sampling as smp
from chatsift.operators import shape as shp
from chatsift.operators.model_calls import GENERATION_OPTIONS, SamplingOptions, map_model
from chatsift.session import ship_package, staged
from chatsift.sources.datasets import list_dirs, path_exists, read_done_ids

LOG = logging.getLogger("chatsift.streaming")

CHAT_SCHEMA = "id long, messages array<struct<role:string,content:string>>"
REQUEST_SCHEMA = "id long, prompt string, demonstration string, quality int"
GENERATION_SCHEMA = ("id string, messages array<struct<role:string,content:string>>, "
                     "finish_reason string, completion_tokens long")
#: Requests without an id are dealt over so many keys; the state holds nothing for them.
NULL_KEYS = 256


def curate_stream(spark: SparkSession, source: str, sink: str, checkpoint: str,
                  ngram_size: int = 10, ngram_threshold: int = 5, schema: str = CHAT_SCHEMA,
                  max_files_per_trigger: int | None = None):
    """Start the row-local curation stream (parquet in, parquet out); returns the query."""
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    chats = reader.parquet(source)
    kept = (
        chats.where(flt.empty_content_ok() & flt.think_tags_ok())
        .where(flt.ngram_ok(n=ngram_size, k=ngram_threshold))
    )
    return (
        kept.writeStream.format("parquet")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(sink)
    )


# --------------------------------------------------------------- generation ---

def new_requests(requests: DataFrame) -> DataFrame:
    """Requests whose id no earlier micro-batch brought; all of those without an id.

    Requests of one id in one micro-batch all pass, as they do in the batch job.
    """
    spark = requests.sparkSession
    ship_package(spark)
    names = requests.columns

    def take(key, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if key[0] is not None and not pd.isna(key[0]):
            if state.exists:
                return
            state.update((True,))
        for frame in frames:
            yield frame[["_request"]]

    request = F.to_json(F.struct(*names), {"ignoreNullFields": "false"})  # whole numbers stay whole beside nulls
    keyed = requests.select(
        F.col("id").cast("string").alias("_key"),
        F.when(F.col("id").isNull(), F.pmod(F.xxhash64(request), F.lit(NULL_KEYS))).otherwise(F.lit(0)).alias("_salt"),
        request.alias("_request"))
    passed = keyed.groupBy("_key", "_salt").applyInPandasWithState(
        take, "_request string", "taken boolean", "append", GroupStateTimeout.NoTimeout)
    return passed.select(F.from_json("_request", requests.schema).alias("_r")).select("_r.*")


class _Folders:
    """What a generation stream keeps beside its checkpoint: marks of begun batches, waiting and failed requests."""

    def __init__(self, spark: SparkSession, checkpoint: str):
        self.spark, self.base = spark, checkpoint.rstrip("/") + "-requests"

    def begun(self, what: str) -> bool:
        """Whether this began before; leaves the mark."""
        path = f"{self.base}/begun/{what}"
        if path_exists(self.spark, path):
            return True
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(self.spark._jsc.hadoopConfiguration()).mkdirs(p)
        return False

    def waiting(self, before: int | None = None) -> str | None:
        """The latest complete table of waiting requests, of a micro-batch before ``before``."""
        names = [n for n in list_dirs(self.spark, f"{self.base}/waiting") if before is None or int(n.split("-")[0]) < before]
        return next((n for n in sorted(names, reverse=True) if path_exists(self.spark, f"{self.base}/waiting/{n}/_SUCCESS")), None)

    def next_name(self, epoch: int) -> str:
        """A table later than all of this micro-batch (a replay must not go behind a turn that a restart took)."""
        turns = [int(n.split("-")[1]) for n in list_dirs(self.spark, f"{self.base}/waiting") if int(n.split("-")[0]) == epoch]
        return f"{epoch:012d}-{max(turns, default=-1) + 1:06d}"

    def read(self, name: str, schema) -> DataFrame:
        return self.spark.read.schema(schema).parquet(f"{self.base}/waiting/{name}")


def generation_batch(batch: DataFrame, sink: str, client_factory, endpoints=None, concurrency: int = 8,
                     request_cols=("id", "messages"), options: SamplingOptions = GENERATION_OPTIONS,
                     max_attempts: int = 3) -> tuple[DataFrame, DataFrame]:
    """Calls the model for requests ``(..., _attempts)`` and appends the generations.

    Returns ``(waiting, failed)``: the requests of failed calls with one more
    attempt, those that may be tried again and those that may not.
    """
    spark = batch.sparkSession
    columns = [c for c in batch.columns if c != "_attempts"]
    rows = staged(batch.withColumn("_row", F.monotonically_increasing_id()), "requests")
    extra = tuple(c for c in request_cols if c not in ("id", "prompt", "messages"))
    requests = shp.generation_requests(rows, keep=("_row", *extra))
    replies = map_model(requests, client_factory, endpoints, request_cols=list(request_cols), id_col="_row",
                        options=options, concurrency=concurrency)
    # Written records and failures must see the same replies.
    replies = staged(replies.withColumn("_row", F.col("id").cast("long")).drop("id"), "replies")
    answered = replies.join(rows.select("_row", F.col("id").cast("string").alias("id"), "prompt"), "_row")
    shp.assemble_generations(None, answered).write.mode("append").json(sink)
    done = replies.agg(F.count(F.lit(1)), F.count("error")).first()
    LOG.info("[Progress] processed=%s generated=%s errors=%s", done[0], done[0] - done[1], done[1])
    again = (rows.join(replies.where(F.col("error").isNotNull()).select("_row", "error"), "_row")
             .withColumn("_attempts", F.col("_attempts") + 1))
    may = F.col("_attempts") < max_attempts
    return again.where(may).select(*columns, "_attempts"), again.where(~may).select(*columns, "_attempts", "error")


def generate_stream(spark: SparkSession, source: str, sink: str, checkpoint: str, client_factory,
                    endpoints=None, concurrency: int = 8, schema: str = REQUEST_SCHEMA,
                    max_files_per_trigger: int | None = None, request_cols=("id", "messages"),
                    options: SamplingOptions = GENERATION_OPTIONS, max_attempts: int = 3):
    """Start the generation stream over request files; returns the query.

    ``request_cols`` go to the client.  A failed call is tried again with the
    next micro-batch or at the next start, ``max_attempts`` times in all.
    """
    folders = _Folders(spark, checkpoint)
    known = f"{folders.base}/known"
    if not path_exists(spark, known):  # the first start
        read_done_ids(spark, sink).write.parquet(known)
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    requests = reader.parquet(source)
    row_schema = spark.createDataFrame([], requests.schema).withColumn("_attempts", F.lit(0)).schema

    def call(rows: DataFrame, name: str) -> None:
        waiting, failed = generation_batch(rows, sink, client_factory, endpoints, concurrency, request_cols, options, max_attempts)
        failed.write.mode("overwrite").parquet(f"{folders.base}/failed/{name}")
        waiting.write.mode("overwrite").parquet(f"{folders.base}/waiting/{name}")

    def run(batch: DataFrame, epoch: int) -> None:
        rows = batch.withColumn("_attempts", F.lit(0))
        earlier = folders.waiting(epoch)
        if earlier is not None:
            rows = rows.unionByName(folders.read(earlier, row_schema))
        if folders.begun(f"{epoch}"):  # a replay
            rows = smp.resume(rows, read_done_ids(batch.sparkSession, sink), "id")
        call(rows, folders.next_name(epoch))

    last = folders.waiting()
    if last is not None:
        rows = folders.read(last, row_schema)
        if not rows.isEmpty():
            call(smp.resume(rows, read_done_ids(spark, sink), "id") if folders.begun(f"{last}-again") else rows,
                 folders.next_name(int(last.split("-")[0])))
    fresh = smp.resume(new_requests(requests), spark.read.schema("id string").parquet(known), "id")
    return (
        fresh.writeStream
        .foreachBatch(run)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


# ----------------------------------------------------- registered queries ---

def _q_curate_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    from chatsift.plans import tables as tb
    from chatsift.session import work_path

    src, out, ck = work_path(spark, "stream-src"), work_path(spark, "stream-out"), work_path(spark, "stream-ck")
    tb.chat(spark, sf_dir).repartition(4).write.parquet(src)
    q = curate_stream(spark, src, out, ck, max_files_per_trigger=1)
    q.awaitTermination()
    return spark.read.schema(CHAT_SCHEMA).parquet(out).select("id", F.size("messages").alias("n_messages"))


def _requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    from chatsift.plans import tables as tb

    pairs = tb.turn_pairs(spark, sf_dir).withColumnRenamed("completion", "demonstration")
    return tb.turn_requests(pairs, spark, sf_dir).select("id", "prompt", "demonstration", F.col("quality").cast("int"))


def _generated(spark: SparkSession, path: str) -> DataFrame:
    gens = spark.read.schema(GENERATION_SCHEMA).json(path)
    return gens.select(F.col("id").cast("long").alias("id"), "finish_reason")


def _q_generate_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    from chatsift.operators.model_calls import LabelStubClient
    from chatsift.session import work_path

    src, out, ck = work_path(spark, "gen-src"), work_path(spark, "gen-out"), work_path(spark, "gen-ck")
    _requests(spark, sf_dir).repartition(4).write.parquet(src)
    q = generate_stream(spark, src, out, ck, LabelStubClient, max_files_per_trigger=2,
                        request_cols=("id", "messages", "quality"))
    q.awaitTermination()
    return _generated(spark, out)


class DownAtFirst:
    """Answers like the label stub; while the endpoint is named ``down``, every third request fails."""

    def __init__(self, endpoint: str = "default"):
        from chatsift.operators.model_calls import LabelStubClient

        self.down, self.stub = endpoint == "down", LabelStubClient(endpoint)

    def complete(self, request: dict, **options) -> dict:
        if self.down and int(request["id"]) % 3 == 0:
            raise RuntimeError("no answer")
        return self.stub.complete(request, **options)


def _write_twice(requests: DataFrame, path: str) -> int:
    """Writes the requests as folders ``a`` and ``b`` of as many files; the number of files of one.

    Rows are dealt by their values, so both folders have the same files and a micro-batch of that many is one folder.
    """
    spark = requests.sparkSession
    rows = staged(requests, "requests")
    dealt = rows.repartition(spark.sparkContext.defaultParallelism, *rows.columns)
    for part in ("a", "b"):
        dealt.write.parquet(f"{path}/{part}")
    files = [len(spark.read.schema(rows.schema).parquet(f"{path}/{part}").inputFiles()) for part in ("a", "b")]
    if files[0] != files[1]:
        raise RuntimeError(f"{files[0]} and {files[1]} files of the same requests")
    return max(files[0], 1)


def _q_generate_stream_restart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two folders, a micro-batch each, bring the same requests; a third of the calls fail throughout the first run,
    its last micro-batch included, and are made again by a restart that finds no new file."""
    from chatsift.session import work_path

    src, out, ck = work_path(spark, "gen-src"), work_path(spark, "gen-out"), work_path(spark, "gen-ck")
    files = _write_twice(_requests(spark, sf_dir), src)
    for endpoint in ("down", "up"):
        generate_stream(spark, f"{src}/*", out, ck, DownAtFirst, [endpoint], max_files_per_trigger=files,
                        request_cols=("id", "messages", "quality"), max_attempts=9).awaitTermination()
    return _generated(spark, out)


STREAM_QUERIES = {
    "curate_stream": _q_curate_stream,
    "generate_stream": _q_generate_stream,
    "generate_stream_restart": _q_generate_stream_restart,
}
