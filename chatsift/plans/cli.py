"""Command line for the jobs, driven by the same YAML configs as the training
scripts (``datasets`` / ``validation`` / ``sdft`` sections).

    python -m chatsift.plans.cli prepare-sft --config sft.yaml --out /data/sft
    python -m chatsift.plans.cli curate --dataset /data/chat --release /data/rel
    python -m chatsift.plans.cli judge --input /data/chat --output /data/judged --client pkg.mod:factory
    python -m chatsift.plans.cli generate --dataset /data/prompts --output /data/gen.jsonl --client pkg.mod:factory
    python -m chatsift.plans.cli report-tokens --dataset /data/chat
    python -m chatsift.plans.cli report-generations --path /data/gen.jsonl --lang-profiles /data/profiles
    python -m chatsift.plans.cli report-loops --dataset /data/questions --client pkg.mod:factory

The model client is injected as ``module:callable`` (``callable(endpoint)``
returns an object with ``complete(request, **options) -> dict``).
"""

from __future__ import annotations

import argparse
import importlib
import json

from chatsift.operators.model_calls import GENERATION_OPTIONS, JUDGE_OPTIONS, LOOP_OPTIONS, SamplingOptions
from chatsift.operators.shape import JUDGE_PROMPTS
from chatsift.operators.stages import load_stages
from chatsift.plans import jobs
from chatsift.sinks.writers import write_split
from chatsift.sources.datasets import load_config, read_dataset


def _client(path: str):
    mod, _, name = path.partition(":")
    return getattr(importlib.import_module(mod), name)


def _show(df) -> None:
    for row in df.toLocalIterator():
        print(json.dumps(row.asDict(recursive=True), ensure_ascii=False, default=str))


def _write_splits(train, val, out: str) -> None:
    write_split(train, out, "train")
    if val is not None:
        write_split(val, out, "validation")


def _sampling(parser, default) -> None:
    """Options that go to the model with every request."""
    parser.add_argument("--temperature", type=float, default=default.temperature)
    parser.add_argument("--top-p", type=float, default=default.top_p)
    parser.add_argument("--max-tokens", type=int, default=default.max_tokens)
    parser.add_argument("--base-urls", default="default")
    parser.add_argument("--concurrency", type=int, default=8)


def _options(args) -> SamplingOptions:
    return SamplingOptions(args.temperature, args.top_p, args.max_tokens)


def main(argv=None) -> None:
    p = argparse.ArgumentParser(prog="chatsift")
    sub = p.add_subparsers(dest="cmd", required=True)
    for name in ("prepare-sft", "prepare-dpo", "prepare-distill"):
        s = sub.add_parser(name)
        s.add_argument("--config", required=True)
        s.add_argument("--out", required=True)
        s.add_argument("--max-length", type=int, default=None)
    s = sub.add_parser("curate")
    s.add_argument("--dataset", required=True)
    s.add_argument("--release", required=True)
    s.add_argument("--ngram-size", type=int, default=10)
    s.add_argument("--ngram-threshold", type=int, default=5)
    s.add_argument("--lang-profiles", default=None, help="parquet folder of trained profiles (enables the language stage)")
    s.add_argument("--lang", default="fr")
    s.add_argument("--stage", action="append", default=[], help="module:attribute or registered name of a user stage")
    s.add_argument("--client", default=None, help="module:callable of the judge (enables the judge stage)")
    _sampling(s, JUDGE_OPTIONS)
    s = sub.add_parser("judge")
    s.add_argument("--input", required=True)
    s.add_argument("--output", required=True)
    s.add_argument("--client", required=True)
    s.add_argument("--preset", default="dataset", choices=sorted(JUDGE_PROMPTS))
    _sampling(s, JUDGE_OPTIONS)
    s = sub.add_parser("generate")
    s.add_argument("--dataset", required=True)
    s.add_argument("--output", required=True)
    s.add_argument("--client", required=True)
    s.add_argument("--max-samples", type=int, default=None)
    _sampling(s, GENERATION_OPTIONS)
    s.add_argument("--release", default=None)
    s = sub.add_parser("train-lang")
    s.add_argument("--dataset", required=True)
    s.add_argument("--out", required=True)
    s = sub.add_parser("report-tokens")
    s.add_argument("--dataset", required=True)
    s = sub.add_parser("report-generations")
    s.add_argument("--path", required=True, help="generation JSON lines")
    s.add_argument("--lang-profiles", required=True)
    s = sub.add_parser("report-loops")
    s.add_argument("--dataset", required=True, help="questions: id, question")
    s.add_argument("--client", required=True)
    _sampling(s, LOOP_OPTIONS)
    s.add_argument("--num-samples", type=int, default=100)
    s.add_argument("--seed", type=int, default=42)
    s.add_argument("--ngram-size", type=int, default=10)
    s.add_argument("--ngram-threshold", type=int, default=3)
    s.add_argument("--output", default=None, help="JSON report path")
    args = p.parse_args(argv)

    from pyspark.sql import SparkSession

    # spark-submit, the environment or spark-defaults.conf name the master; local[*] where none does
    spark = SparkSession.builder.appName("chatsift").getOrCreate()
    if args.cmd == "prepare-sft":
        _write_splits(*jobs.prepare_sft(spark, load_config(args.config)), args.out)
    elif args.cmd == "prepare-dpo":
        _write_splits(*jobs.prepare_dpo(spark, load_config(args.config), args.max_length), args.out)
    elif args.cmd == "prepare-distill":
        _write_splits(*jobs.prepare_distill(spark, load_config(args.config), args.max_length), args.out)
    elif args.cmd == "curate":
        prof = spark.read.parquet(args.lang_profiles) if args.lang_profiles else None
        _show(jobs.run_curate(spark, args.dataset, args.release, prof,
                              ngram_size=args.ngram_size, ngram_threshold=args.ngram_threshold, lang=args.lang,
                              user_stages=load_stages(args.stage), client_factory=args.client and _client(args.client),
                              endpoints=args.base_urls.split(","), concurrency=args.concurrency, options=_options(args)))
    elif args.cmd == "judge":
        summary, _ = jobs.run_judge(spark, args.input, args.output, _client(args.client),
                                    args.base_urls.split(","), args.preset, args.concurrency, options=_options(args))
        _show(summary)
    elif args.cmd == "generate":
        _show(jobs.run_generate(spark, args.dataset, args.output, _client(args.client), args.base_urls.split(","),
                                args.max_samples, args.concurrency, args.release, options=_options(args)))
    elif args.cmd == "train-lang":
        from chatsift.operators.lang import train_lang_profiles

        train_lang_profiles(read_dataset(spark, args.dataset)).write.mode("overwrite").parquet(args.out)
    elif args.cmd == "report-tokens":
        _show(jobs.report_tokens(read_dataset(spark, args.dataset)))
    elif args.cmd == "report-generations":
        from chatsift.sources.datasets import read_jsonl_strict
        from chatsift.streaming.jobs import GENERATION_SCHEMA

        rep = jobs.report_generations(read_jsonl_strict(spark, args.path, GENERATION_SCHEMA),
                                      spark.read.parquet(args.lang_profiles))
        for part in (rep.finish_reasons, rep.thinking_language, rep.looping, rep.completion_tokens):
            _show(part)
    elif args.cmd == "report-loops":
        from chatsift.sinks.writers import write_json_report

        flags, summary = jobs.report_loops(read_dataset(spark, args.dataset), _client(args.client),
                                           args.num_samples, args.seed, ngram_size=args.ngram_size,
                                           ngram_threshold=args.ngram_threshold,
                                           endpoints=args.base_urls.split(","), concurrency=args.concurrency,
                                           options=_options(args))
        if args.output:
            write_json_report(flags, args.output)
        _show(summary)


if __name__ == "__main__":
    main()
