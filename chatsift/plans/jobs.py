"""End-to-end jobs (E1-E9) composed from the operators.

Each job builds one lazy plan; actions happen only where a job needs a
number on the driver (sizes for a split, a median) or writes its output.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chatsift.functions.text import join_contents, parse_verdict, question_prompt, token_count
from chatsift.operators import filters as flt
from chatsift.operators import reports as rep
from chatsift.operators import sampling as smp
from chatsift.operators import shape as shp
from chatsift.operators.lang import with_language
from chatsift.operators.model_calls import GENERATION_OPTIONS, JUDGE_OPTIONS, LOOP_OPTIONS, SamplingOptions, map_model
from chatsift.operators.stages import Stage
from chatsift.session import staged
from chatsift.sources.datasets import load_split, pick_split, read_dataset, require_columns


# ------------------------------------------------------------- E1 curate ---

@dataclass
class CurateResult:
    kept: DataFrame
    funnel: DataFrame
    flagged: DataFrame
    stages: list = field(default_factory=list)

    def observed(self):
        """``(kept, observation)``: the kept rows, whose write also counts the stages (``n0``, ``n1``, ...)."""
        from pyspark.sql import Observation

        obs = Observation()
        rows = self.flagged.observe(obs, *rep.funnel_counts(self.stages))
        return _passed(rows, self.stages), obs


def _passed(flagged: DataFrame, stages: list) -> DataFrame:
    keep = F.lit(True)
    for _, flag in stages:
        keep = keep & flag
    return flagged.where(keep).drop(*[c for c in flagged.columns if c.startswith("_cs_")])


def curate(df: DataFrame, profiles: DataFrame | None = None, lang: str = "fr",
           ngram_size: int = 10, ngram_threshold: int = 5, replies: DataFrame | None = None,
           id_col: str = "id", messages: str = "messages", method: str = "arrow",
           user_stages: Sequence[Stage] = ()) -> CurateResult:
    """Empty content -> think tags -> [language] -> n-gram -> user stages -> [judge verdict].

    All stages become flags of one plan: ``funnel`` counts them in a single
    aggregate and ``kept`` is the same plan filtered.  Expensive stages only
    see rows that passed the cheaper ones (their input is nulled otherwise).
    No stage but a verdict looks at ids, so they may be null or repeat.
    """
    base = df.withColumns({"_cs_empty": flt.empty_content_ok(messages), "_cs_think": flt.think_tags_ok(messages)})
    stages: list[tuple[str, Column]] = [("Empty content", F.col("_cs_empty")), ("Think tags", F.col("_cs_think"))]
    gate = F.col("_cs_empty") & F.col("_cs_think")
    if profiles is not None:
        base = with_language(base, profiles, F.when(gate, flt.conversation_text(messages)), "_cs_lang")
        base = base.withColumn("_cs_lang_ok", F.coalesce(F.col("_cs_lang") == lang, F.lit(False)))
        gate = gate & F.col("_cs_lang_ok")
        stages.append((f"Language ({lang})", F.col("_cs_lang_ok")))
    base = base.withColumn("_cs_ngram", flt.ngram_ok(messages, ngram_size, ngram_threshold, gate=gate, method=method))
    gate = gate & F.col("_cs_ngram")
    stages.append(("N-gram repetition", F.col("_cs_ngram")))
    for i, stage in enumerate(user_stages):
        base = base.withColumn(f"_cs_user{i}", stage.flag(gate))
        gate = gate & F.col(f"_cs_user{i}")
        stages.append((stage.name, F.col(f"_cs_user{i}")))
    if replies is not None:
        # Reply ids are strings (model output); compare ids as strings.
        ok = replies.select(F.col("id").cast("string").alias("_cs_rid"),
                            (parse_verdict(F.col("reply")) & F.col("error").isNull()).alias("_cs_verdict"))
        base = (base.join(ok, F.col(id_col).cast("string") == F.col("_cs_rid"), "left")
                .withColumn("_cs_judge", F.coalesce(F.col("_cs_verdict"), F.lit(False))))
        stages.append(("LLM judge", F.col("_cs_judge")))
    return CurateResult(_passed(base, stages), rep.stage_funnel(base, stages), base, stages)


# -------------------------------------------------------------- E2 judge ---

def states_verdict(reply: str | None) -> bool:
    """Whether ``parse_verdict`` finds a verdict in the reply."""
    return any(word in (reply or "").lower() for word in ("true", "false"))


def judge(df: DataFrame, client_factory, endpoints=None, preset: str = "dataset", concurrency: int = 8,
          attempts: int = 3, extra_cols: list[str] | None = None, options: SamplingOptions = JUDGE_OPTIONS):
    """Asks the judge about every conversation once: ``(judged, verdicts)``.

    ``judged`` is ``df`` with its ``verdict``; an error or a reply without a
    verdict is a rejection.  Rows are staged with a number of their own, which
    the replies (staged as well: they are not deterministic) come back by, so ids
    may be null or repeat.
    """
    rows = staged(df.withColumn("_row", F.monotonically_increasing_id()), "judge-rows")
    extra = list(extra_cols or [])
    requests = shp.judge_requests(rows, preset=preset, keep=("_row", *extra))
    replies = map_model(requests, client_factory, endpoints, request_cols=["id", "request", *extra], id_col="_row",
                        options=options, concurrency=concurrency, attempts=attempts, retry_empty=True,
                        accept=states_verdict if preset == "pipeline" else None)
    verdicts = staged(judge_verdicts(replies).withColumn("_row", F.col("id").cast("long")).drop("id"), "verdicts")
    return rows.join(verdicts, "_row").drop("_row"), verdicts.drop("_row")


def judge_verdicts(replies: DataFrame) -> DataFrame:
    return replies.select("id", F.coalesce(parse_verdict(F.col("reply")) & F.col("error").isNull(), F.lit(False)).alias("verdict"))


# ---------------------------------------------------- E4/E5/E6 prepare ---

def _load_each(spark: SparkSession, config: dict, per_dataset):
    dfs = []
    for dcfg in config.get("datasets") or []:
        df = read_dataset(spark, dcfg["name"], dcfg.get("split", "train"), dcfg.get("subset"))
        order = dcfg.get("order_by", "id")
        df = smp.max_samples(df, dcfg.get("max_samples"), order)
        dfs.append(per_dataset(df, dcfg))
    return smp.mix(dfs)


def _split(df: DataFrame, config: dict, id_col: str):
    val_cfg = config.get("validation") or {}
    return smp.train_val_split(df, val_cfg.get("split_ratio", 0.0), val_cfg.get("split_size"),
                               val_cfg.get("seed", 42), id_col=id_col)


def prepare_sft(spark: SparkSession, config: dict, id_col: str = "id"):
    combined = _load_each(spark, config, lambda df, d: shp.to_sft_format(df, d.get("column_map")))
    return _split(combined, config, id_col)


def prepare_dpo(spark: SparkSession, config: dict, max_length: int | None = None, id_col: str = "id"):
    combined = _load_each(spark, config, lambda df, d: shp.normalize_preferences(df, d.get("column_map")))
    train, val = _split(combined, config, id_col)
    if max_length:
        train = flt.filter_overlength(train, max_length, token_count)
        val = None if val is None else flt.filter_overlength(val, max_length, token_count)
    return train, val


def prepare_distill(spark: SparkSession, config: dict, max_prompt_length: int | None = None, id_col: str = "id"):
    def per(df, d):
        df = shp.apply_prompt_completion_map(df, d.get("column_map"))
        return shp.keep_columns(df, ("prompt", "completion", id_col))

    combined = _load_each(spark, config, per)
    train, val = _split(combined, config, id_col)
    sd = config.get("sdft") or {}
    build = lambda x: shp.build_teacher_prompts(
        x, sd.get("teacher_template"), sd.get("student_system_prompt"), sd.get("teacher_system_prompt"))
    train = build(train)
    val = None if val is None else build(val)
    if max_prompt_length:
        train = flt.filter_long_prompts(train, max_prompt_length, token_count)
        val = None if val is None else flt.filter_long_prompts(val, max_prompt_length, token_count)
    return train, val


# ------------------------------------------------------ E7/E8/E9 reports ---

@dataclass
class GenerationReport:
    finish_reasons: DataFrame
    thinking_language: DataFrame
    looping: DataFrame
    completion_tokens: DataFrame

    def table(self) -> DataFrame:
        """All sections as ``(section, label, value, pct, bar)``."""
        counted = [(self.finish_reasons, "finish_reason", "finish_reason"), (self.thinking_language, "thinking_language", "language"),
                   (self.looping, "looping", "label")]
        parts = [df.select(F.lit(section).alias("section"), F.col(label).alias("label"), F.col("count").cast("double").alias("value"),
                           "pct", "bar") for df, section, label in counted]
        stats = [F.struct(F.lit(name).alias("label"), F.col(c).cast("double").alias("value"))
                 for name, c in (("n", "n"), ("min", "min_tokens"), ("max", "max_tokens"), ("avg", "avg_tokens"))]
        tokens = self.completion_tokens.select(F.inline(F.array(*stats)))
        parts.append(tokens.select(F.lit("completion_tokens").alias("section"), "label", "value",
                                   F.lit(None).cast("double").alias("pct"), F.lit(None).cast("string").alias("bar")))
        return smp.mix(parts)


def report_generations(gens: DataFrame, profiles: DataFrame) -> GenerationReport:
    return GenerationReport(
        finish_reasons=rep.finish_reason_report(gens),
        thinking_language=rep.thinking_language_report(gens, profiles),
        looping=rep.looping_report(gens),
        completion_tokens=rep.completion_token_stats(gens),
    )


def report_tokens(df: DataFrame, messages: str = "messages", count=token_count) -> DataFrame:
    lengths = df.select(count(join_contents(messages, None)).alias("tokens"))
    return rep.token_stats(lengths, "tokens")


def report_loops(questions: DataFrame, client_factory, n_samples: int = 100, seed: int = 42,
                 id_col: str = "id", question_col: str = "question", ngram_size: int = 10,
                 ngram_threshold: int = 3, endpoints=None, concurrency: int = 8,
                 options: SamplingOptions = LOOP_OPTIONS):
    """Sample questions, generate, flag looping, summarise: ``(flags, summary)``."""
    sample = smp.seeded_sample(questions, n_samples, seed, id_col)
    prompts = sample.select(F.col(id_col).alias("id"), question_prompt(question_col).alias("prompt"))
    # The flags and the summary must see the same replies; the prompt travels along, so ids may be null or repeat.
    replies = staged(map_model(prompts, client_factory, endpoints, request_cols=["id", "prompt"], options=options,
                               concurrency=concurrency, keep=("prompt",)), "loop-replies")
    gens = replies.select(F.col("id").cast(questions.schema[id_col].dataType).alias("id"), "prompt",
                          F.col("reply").alias("generated"), "finish_reason")
    flags = flt.loop_flags(gens, "generated", "finish_reason", ngram_size, ngram_threshold)
    return flags, rep.loop_summary(flags)


def generate_requests(df: DataFrame, done_ids: DataFrame, max_samples: int | None = None,
                      keep: tuple[str, ...] = ()) -> DataFrame:
    """E3 front half: check columns, drop done ids, limit, build requests."""
    require_columns(df, ("id", "prompt", "demonstration"))
    remaining = smp.resume(df, done_ids, "id")
    remaining = smp.max_samples(remaining, max_samples, "id")
    return shp.generation_requests(remaining, keep=keep)


# ---------------------------------------------------- runnable job entries ---

def run_curate(spark: SparkSession, dataset: str, release_path: str, profiles: DataFrame | None = None,
               split: str = "train", ngram_size: int = 10, ngram_threshold: int = 5, lang: str = "fr",
               user_stages: Sequence[Stage] = (), client_factory=None, endpoints=None, concurrency: int = 8,
               options: SamplingOptions = JUDGE_OPTIONS, extra_cols: list[str] | None = None) -> DataFrame:
    """Load -> stages -> [judge] -> publish; returns the funnel.

    Each stage runs once: the write of the kept rows counts the stages as it goes
    (``observe``).  With a client the judge sees what all other stages kept.
    """
    from chatsift.sinks.writers import publish

    res = curate(read_dataset(spark, dataset, split), profiles, lang, ngram_size, ngram_threshold, user_stages=user_stages)
    kept, obs = res.observed()
    names = [name for name, _ in res.stages]
    if client_factory is not None:
        judged, verdicts = judge(kept, client_factory, endpoints, "pipeline", concurrency, extra_cols=extra_cols, options=options)
        kept = judged.where("verdict").drop("verdict")
    publish(kept, release_path, "curated")
    counts = [int(obs.get[f"n{i}"] or 0) for i in range(len(names) + 1)]
    if client_factory is not None:
        names.append("LLM judge")
        counts.append(verdicts.where("verdict").count())
    return rep.funnel_rows(spark, names, counts)


def run_judge(spark: SparkSession, input_path: str, output_path: str, client_factory, endpoints=None,
              preset: str = "dataset", concurrency: int = 8, extra_cols=None, options: SamplingOptions = JUDGE_OPTIONS):
    """Pick split -> judge requests -> model -> keep verdict true -> write ``train``.

    Returns ``(summary, progress observation)``; the write of the kept rows fills the observation.
    """
    from chatsift.sinks.writers import write_split

    df = load_split(spark, input_path, pick_split(spark, input_path))
    judged, verdicts = judge(df, client_factory, endpoints, preset, concurrency, extra_cols=extra_cols, options=options)
    tracked, obs = rep.observe_progress(judged, "judge")
    write_split(shp.judge_output(tracked.where("verdict")), output_path, "train")
    return rep.judge_summary(verdicts), obs


def run_generate(spark: SparkSession, dataset: str, output_path: str, client_factory,
                 endpoints=None, max_samples: int | None = None, concurrency: int = 8,
                 release_path: str | None = None, request_cols=("id", "messages"),
                 options: SamplingOptions = GENERATION_OPTIONS):
    """Resume by id -> requests -> model -> append JSON lines -> summary [-> publish]."""
    from chatsift.sinks.writers import append_jsonl, publish
    from chatsift.sources.datasets import read_done_ids

    df = read_dataset(spark, dataset, "train")
    done = staged(read_done_ids(spark, output_path), "done")
    extra = tuple(c for c in request_cols if c not in ("id", "prompt", "messages"))
    req = generate_requests(df, done, max_samples, keep=extra)
    replies = staged(map_model(req, client_factory, endpoints, request_cols=list(request_cols),
                               options=options, concurrency=concurrency, keep=("prompt",)), "replies")
    append_jsonl(shp.assemble_generations(None, replies), output_path)
    if release_path:
        publish(spark.read.json(output_path), release_path, "generations")
    return rep.generation_summary(df, done, replies)
