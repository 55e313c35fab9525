"""End-to-end jobs on small temp datasets derived from the driver tables."""

import sys
import tempfile

from pyspark import cloudpickle
from pyspark.sql import functions as F

from chatsift.operators.model_calls import LabelStubClient
from chatsift.plans import jobs
from chatsift.plans import tables as tb
from chatsift.session import read_table
from chatsift.sinks.writers import write_split

from conftest import SF_SMALL

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _chat_with_quality(spark):
    chat = tb.chat(spark, SF_SMALL)
    return tb.label_requests(chat, spark, SF_SMALL).withColumn("id", F.col("id").cast("string"))


def test_run_judge(spark):
    root = tempfile.mkdtemp(prefix="cs-judge-")
    write_split(_chat_with_quality(spark), f"{root}/in", "train")
    summary, obs = jobs.run_judge(spark, f"{root}/in", f"{root}/out", LabelStubClient, extra_cols=["quality"])
    s = summary.first()
    kept = spark.read.parquet(f"{root}/out/train")
    assert kept.columns == ["id", "messages"]
    assert kept.count() == s.accepted and s.accepted + s.rejected == _chat_with_quality(spark).count()
    assert obs.get["processed"] == s.accepted + s.rejected and obs.get["accepted"] == s.accepted


def test_run_generate_resumes(spark):
    root = tempfile.mkdtemp(prefix="cs-gen-")
    pairs = tb.turn_pairs(spark, SF_SMALL).withColumnRenamed("completion", "demonstration")
    data = tb.turn_requests(pairs, spark, SF_SMALL)
    write_split(data, f"{root}/ds", "train")
    s1 = jobs.run_generate(spark, f"{root}/ds", f"{root}/gen.jsonl", LabelStubClient, max_samples=10,
                           request_cols=("id", "quality")).first()
    s2 = jobs.run_generate(spark, f"{root}/ds", f"{root}/gen.jsonl", LabelStubClient,
                           request_cols=("id", "quality"), release_path=f"{root}/rel").first()
    ids = [r.id for r in spark.read.json(f"{root}/gen.jsonl").collect()]
    assert len(ids) == len(set(ids))
    assert s2.total_samples == data.count() and s2.generated == len(ids)
    assert s1.generated <= 10


def test_prepare_jobs(spark):
    root = tempfile.mkdtemp(prefix="cs-prep-")
    docs = read_table(spark, SF_SMALL, "documents")
    write_split(docs.select(F.col("doc_id").alias("id"), "text"), f"{root}/text", "train")
    write_split(tb.chat(spark, SF_SMALL, False), f"{root}/chat", "train")
    cfg = {"datasets": [{"name": f"{root}/text", "max_samples": 50}, {"name": f"{root}/chat"}],
           "validation": {"split_ratio": 0.1, "seed": 42}}
    train, val = jobs.prepare_sft(spark, cfg)
    n = 50 + tb.chat(spark, SF_SMALL, False).count()
    assert train.count() + val.count() == n and val.count() == int(n * 0.1)
    prefs = tb.preference_rows(spark, SF_SMALL).withColumnRenamed("conv_id", "id")
    write_split(prefs, f"{root}/prefs", "train")
    t, v = jobs.prepare_dpo(spark, {"datasets": [{"name": f"{root}/prefs"}]}, max_length=400)
    assert v is None and 0 < t.count() <= prefs.count()
    pairs = tb.turn_pairs(spark, SF_SMALL).withColumnRenamed("prompt", "query")
    write_split(pairs, f"{root}/pairs", "train")
    dcfg = {"datasets": [{"name": f"{root}/pairs", "column_map": {"prompt": "query"}}],
            "validation": {"split_size": 5}}
    t, v = jobs.prepare_distill(spark, dcfg, max_prompt_length=10_000)
    assert v.count() == 5 and set(t.columns) == {"id", "prompt", "teacher_prompt"}


def test_report_jobs(spark):
    from chatsift.operators.lang import train_lang_profiles
    from chatsift.plans.catalog import generation_records

    prof = train_lang_profiles(read_table(spark, SF_SMALL, "documents"))
    r = jobs.report_generations(generation_records(spark, SF_SMALL), prof)
    assert r.finish_reasons.count() == 2 and r.looping.count() == 2
    assert sum(x["count"] for x in r.thinking_language.collect()) == tb.chat(spark, SF_SMALL).count()
    t = jobs.report_tokens(tb.chat(spark, SF_SMALL)).first()
    assert t.min_tokens <= t.median_tokens <= t.max_tokens


def test_cli_prepare_and_curate(spark, tmp_path):
    from chatsift.plans import cli

    root = str(tmp_path)
    write_split(tb.chat(spark, SF_SMALL), f"{root}/chat", "train")
    cfg = tmp_path / "sft.yaml"
    cfg.write_text(f"datasets:\n  - name: {root}/chat\n    column_map:\n      conversations: messages\n"
                   "validation:\n  split_ratio: 0.1\n  seed: 42\n")
    cli.main(["prepare-sft", "--config", str(cfg), "--out", f"{root}/sft"])
    n = tb.chat(spark, SF_SMALL).count()
    assert spark.read.parquet(f"{root}/sft/train").count() + spark.read.parquet(f"{root}/sft/validation").count() == n
    cli.main(["curate", "--dataset", f"{root}/chat", "--release", f"{root}/rel"])
    from chatsift.sinks.writers import read_release

    plain = read_release(spark, f"{root}/rel", "curated").count()
    assert 0 < plain <= n
    # a judge that turns every second conversation down, a user stage, sampling options
    cli.main(["curate", "--dataset", f"{root}/chat", "--release", f"{root}/rel", "--client", f"{__name__}:EvenJudge",
              "--stage", f"{__name__}:two_stages", "--temperature", "0.3", "--max-tokens", "7"])
    kept = read_release(spark, f"{root}/rel", "curated")
    assert 0 < kept.count() < plain and kept.where("id % 2 = 1 or size(messages) < 3").count() == 0


class EvenJudge:
    def __init__(self, endpoint):
        self.endpoint = endpoint

    def complete(self, request, temperature, top_p, max_tokens):
        assert (temperature, top_p, max_tokens) == (0.3, 0.1, 7)
        return {"reply": "True" if int(request["id"]) % 2 == 0 else "False"}


def two_stages():
    from chatsift.operators.stages import Stage

    return [Stage("three turns", F.size("messages") >= 3), Stage("known", lambda m: m.isNotNull(), ("messages",))]


def test_curation_runs_every_stage_once_and_keeps_null_ids(spark, tmp_path):
    from chatsift.operators.lang import train_lang_profiles
    from chatsift.operators.stages import Stage
    from chatsift.sinks.writers import read_release, release_manifest

    seen = spark.sparkContext.accumulator(0)

    @F.udf("boolean")
    def counted(turns):
        seen.add(turns is not None)
        return True

    chats = tb.chat(spark, SF_SMALL).withColumn("id", F.when(F.col("id") % 2 == 0, F.col("id") % 3))
    write_split(chats, f"{tmp_path}/chat", "train")
    prof = train_lang_profiles(read_table(spark, SF_SMALL, "documents"))
    want = jobs.curate(chats, prof, "en", user_stages=[]).kept
    funnel = jobs.run_curate(spark, f"{tmp_path}/chat", f"{tmp_path}/rel", prof, lang="en",
                             user_stages=[Stage("counted", counted, (F.size("messages"),))])
    kept = read_release(spark, f"{tmp_path}/rel", "curated")
    assert sorted(map(repr, kept.collect())) == sorted(map(repr, want.collect())) and kept.where("id is null").count() > 0
    assert seen.value == kept.count()  # once for each row that came so far
    last = funnel.orderBy("stage_order").collect()[-1]
    assert (last.stage, last.before, last.after) == ("TOTAL", chats.count(), kept.count())
    assert spark.read.json(release_manifest(spark, f"{tmp_path}/rel", "curated")["jsonl"]).count() == kept.count()


class EchoModel:
    """Replies with a looping text for even ids and stops early for odd ids."""

    def __init__(self, endpoint):
        self.endpoint = endpoint

    def complete(self, request, **opts):
        if int(request["id"]) % 2 == 0:
            return {"reply": " ".join(["x y z"] * 20), "finish_reason": "stop"}
        return {"reply": "fine", "finish_reason": "length"}


def test_cli_report_loops_and_generations(spark, tmp_path):
    import json

    from chatsift.plans import cli
    from chatsift.plans.catalog import generation_records
    from chatsift.sinks.writers import append_jsonl

    root = str(tmp_path)
    qs = read_table(spark, SF_SMALL, "benchmark").select(F.col("item_id").alias("id"), F.col("text").alias("question"))
    write_split(qs, f"{root}/q", "train")
    cli.main(["report-loops", "--dataset", f"{root}/q", "--client", f"{__name__}:EchoModel",
              "--num-samples", "10", "--output", f"{root}/loops.json"])
    rows = json.load(open(f"{root}/loops.json", encoding="utf-8"))
    assert len(rows) == 10 and all(r["looping"] for r in rows)
    assert all(r["ngram_loop"] == (r["id"] % 2 == 0) for r in rows)
    prof = f"{root}/prof"
    cli.main(["train-lang", "--dataset", _docs(spark, root), "--out", prof])
    append_jsonl(generation_records(spark, SF_SMALL).withColumn("id", F.col("id").cast("string")), f"{root}/gen")
    cli.main(["report-generations", "--path", f"{root}/gen", "--lang-profiles", prof])


def _docs(spark, root):
    write_split(read_table(spark, SF_SMALL, "documents"), f"{root}/docs", "train")
    return f"{root}/docs"
