import sys
import tempfile

from pyspark import cloudpickle

from pyspark.sql import functions as F

from chatsift.operators.model_calls import LabelStubClient, map_model


cloudpickle.register_pickle_by_value(sys.modules[__name__])


class Flaky:
    calls = 0

    def __init__(self, endpoint):
        self.endpoint = endpoint

    def complete(self, request, **opts):
        if request["id"] % 2:
            raise RuntimeError("boom")
        return {"reply": f"{self.endpoint}:{request['id']}", "finish_reason": "stop"}


def test_map_model_errors_and_round_robin(spark):
    df = spark.range(6)
    out = {r.id: r for r in map_model(df, Flaky, ["a", "b"], attempts=3).collect()}
    assert out["1"].error and out["1"].reply is None
    assert out["0"].error is None and out["0"].reply.endswith(":0")
    assert {out[k].reply.split(":")[0] for k in ("0", "2", "4")} <= {"a", "b"}


def test_stub_client_from_labels(spark):
    df = spark.createDataFrame([(1, 1), (2, 0), (3, None)], "id long, quality int")
    out = {r.id: r for r in map_model(df, LabelStubClient, request_cols=["id", "quality"]).collect()}
    assert out["1"].reply == "True" and out["2"].reply == "False" and out["3"].error


def test_generate_stream_resumes(spark):
    from chatsift.streaming.jobs import generate_stream

    root = tempfile.mkdtemp(prefix="cs-gen-")
    src, sink, ck = f"{root}/src", f"{root}/sink", f"{root}/ck"
    reqs = spark.range(20).select("id", F.lit("p").alias("prompt"), F.lit("d").alias("demonstration"),
                                  (F.col("id") % 2).cast("int").alias("quality"))
    reqs.where("id < 10").write.parquet(f"{src}/part1")
    q = generate_stream(spark, f"{src}/*", sink, ck, LabelStubClient, request_cols=("id", "messages", "quality"))
    q.awaitTermination()
    first = spark.read.json(sink).count()
    # second run: new files plus a replay of old ids under a fresh checkpoint
    reqs.write.parquet(f"{src}/part2")
    q = generate_stream(spark, f"{src}/*", sink, ck + "2", LabelStubClient, request_cols=("id", "messages", "quality"))
    q.awaitTermination()
    ids = [r.id for r in spark.read.json(sink).collect()]
    assert first == 10 and len(ids) == 20 and len(set(ids)) == 20


def test_generate_stream_sends_messages_and_tries_failed_rows_again(spark):
    from chatsift.streaming.jobs import generate_stream

    root = tempfile.mkdtemp(prefix="cs-gen-")
    src, sink, ck, up = f"{root}/src", f"{root}/sink", f"{root}/ck", f"{root}/up"

    class Echo:
        def __init__(self, endpoint="default"):
            pass

        def complete(self, request, **_options):
            import os

            if request["id"] == 3 and not os.path.exists(up):
                raise RuntimeError("down")
            return {"reply": request["messages"][0]["content"][:2]}

    reqs = spark.range(6).select("id", F.format_string("p%d and more", "id").alias("prompt"),
                                 F.lit("d").alias("demonstration"), F.lit(1).alias("quality"))
    reqs.where("id < 4").union(reqs.where("id = 2")).write.parquet(f"{src}/part1")
    generate_stream(spark, f"{src}/*", sink, ck, Echo).awaitTermination()
    assert sorted(int(r.id) for r in spark.read.json(sink).collect()) == [0, 1, 2, 2]
    open(up, "w").close()
    reqs.where("id >= 4").write.parquet(f"{src}/part2")
    generate_stream(spark, f"{src}/*", sink, ck, Echo).awaitTermination()
    rows = spark.read.json(sink).collect()
    assert sorted(int(r.id) for r in rows) == [0, 1, 2, 2, 3, 4, 5]
    assert all(r.messages[1].content.endswith(f"p{r.id}") for r in rows)


class DownWhile:
    """Fails for id 3 while a file exists; counts its calls in files."""

    def __init__(self, endpoint="default"):
        self.root = endpoint

    def complete(self, request, **_options):
        import os
        import uuid

        open(f"{self.root}/call-{int(request['id'])}-{uuid.uuid4().hex}", "w").close()
        if int(request["id"]) == 3 and os.path.exists(f"{self.root}/down"):
            raise RuntimeError("down")
        return {"reply": "ok"}


def _calls(root, i):
    import os

    return sum(name.startswith(f"call-{i}-") for name in os.listdir(root))


def test_failed_requests_of_the_last_batch_are_made_again_by_a_restart(spark):
    from chatsift.streaming.jobs import generate_stream

    root = tempfile.mkdtemp(prefix="cs-gen-")
    src, sink, ck = f"{root}/src", f"{root}/sink", f"{root}/ck"
    open(f"{root}/down", "w").close()
    reqs = spark.range(6).select("id", F.lit("p").alias("prompt"), F.lit("d").alias("demonstration"), F.lit(1).alias("quality"))
    null = reqs.where("id = 0").withColumn("id", F.lit(None).cast("long"))
    reqs.write.parquet(f"{src}/part1")
    run = lambda: generate_stream(spark, f"{src}/*", sink, ck, DownWhile, [root], max_attempts=4).awaitTermination()
    run()
    assert sorted(int(r.id) for r in spark.read.json(sink).collect()) == [0, 1, 2, 4, 5]
    run()  # no new file, still down
    assert _calls(root, 3) == 2 and _calls(root, 1) == 1
    import os

    os.rename(f"{root}/down", f"{root}/up")
    run()  # no new file
    assert sorted(int(r.id) for r in spark.read.json(sink).collect()) == [0, 1, 2, 3, 4, 5]
    reqs.write.parquet(f"{src}/part2")  # ids that came before, and a request that is new
    reqs.where("id = 0").withColumn("id", F.lit(9).cast("long")).write.parquet(f"{src}/part3")
    run()
    run()
    assert sorted(int(r.id) for r in spark.read.json(sink).collect()) == [0, 1, 2, 3, 4, 5, 9] and _calls(root, 3) == 3
    assert null.count() == 1


def test_requests_that_always_fail_end_in_the_table_of_failures(spark):
    from chatsift.streaming.jobs import generate_stream

    root = tempfile.mkdtemp(prefix="cs-gen-")
    src, sink, ck = f"{root}/src", f"{root}/sink", f"{root}/ck"
    open(f"{root}/down", "w").close()
    reqs = spark.range(4).select("id", F.lit("p").alias("prompt"), F.lit("d").alias("demonstration"), F.lit(1).alias("quality"))
    reqs.write.parquet(f"{src}/part1")
    for _ in range(4):
        generate_stream(spark, f"{src}/*", sink, ck, DownWhile, [root], max_attempts=2).awaitTermination()
    assert _calls(root, 3) == 2
    failed = spark.read.parquet(f"{ck}-requests/failed/*").collect()
    assert [(r.id, r._attempts) for r in failed] == [(3, 2)] and "down" in failed[0].error


def test_requests_without_an_id_all_pass(spark):
    from chatsift.streaming.jobs import new_requests, REQUEST_SCHEMA

    root = tempfile.mkdtemp(prefix="cs-new-")
    rows = [(None, "a", "d", None), (None, "a", "d", 1), (2 ** 60 + 1, "b", "d", None), (7, None, "d", 0)]
    for part in ("a", "b"):
        spark.createDataFrame(rows, REQUEST_SCHEMA).coalesce(1).write.parquet(f"{root}/src/{part}")
    stream = spark.readStream.schema(REQUEST_SCHEMA).option("maxFilesPerTrigger", 1).parquet(f"{root}/src/*")
    q = (new_requests(stream).writeStream.format("parquet").option("checkpointLocation", f"{root}/ck")
         .trigger(availableNow=True).start(f"{root}/out"))
    q.awaitTermination()
    got = sorted((tuple(r) for r in spark.read.parquet(f"{root}/out").collect()), key=repr)
    assert got == sorted(rows[:2] * 2 + rows[2:], key=repr)


def test_unparsable_verdicts_are_asked_for_again(spark):
    from chatsift.plans.jobs import states_verdict

    class Third:
        def __init__(self, endpoint="default"):
            self.calls = 0

        def complete(self, request, **_options):
            self.calls += 1
            return {"reply": "TRUE" if self.calls == 3 else "yes"}

    row = map_model(spark.range(1), Third, request_cols=["id"], attempts=3, accept=states_verdict).first()
    assert row.reply == "TRUE" and row.error is None
    row = map_model(spark.range(1), Third, request_cols=["id"], attempts=2, accept=states_verdict).first()
    assert row.reply is None and "not accepted" in row.error


def test_curate_stream_equals_batch(spark):
    from chatsift.plans.jobs import curate
    from chatsift.sources.fixtures import chat_table
    from chatsift.streaming.jobs import CHAT_SCHEMA, curate_stream

    root = tempfile.mkdtemp(prefix="cs-cur-")
    chats = chat_table(spark, "/root/testdata/sf0.001")
    chats.repartition(3).write.parquet(f"{root}/src")
    curate_stream(spark, f"{root}/src", f"{root}/out", f"{root}/ck", max_files_per_trigger=1).awaitTermination()
    got = {r.id for r in spark.read.schema(CHAT_SCHEMA).parquet(f"{root}/out").collect()}
    want = {r.id for r in curate(chats).kept.collect()}
    assert got == want
