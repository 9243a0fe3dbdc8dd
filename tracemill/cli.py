"""Command line: python -m tracemill.cli run|prompt."""

from __future__ import annotations

import argparse
import sys

from tracemill.operators import prompts
from tracemill.operators.process import MODES, resolve_mode
from tracemill.operators.redact import LEVELS


_YES, _HIDDEN, _LEVELS = {"action": "store_true"}, {"help": argparse.SUPPRESS}, {"choices": ("lite", "full")}
#: Names (the first is the attribute) and how each is read; the hidden ones are old names.
_OPTIONS: dict[str, dict] = {
    "input-dir": {},
    "input-file": {},
    "output-dir": {"default": "./curated"},
    "mode process-mode": {"choices": MODES},
    "level": _LEVELS,
    "seqs": {"type": int},
    "qaqc": _YES,
    "qaqc-mirrors": {"default": 1, "type": int},
    "model": {},
    "anonymize-level": {"default": "strict", "choices": LEVELS},
    "max-similarity": {"default": 0.92, "type": float},
    "push-to-hub": _YES,
    "repo-id": {"default": ""},
    "public": _YES,
    "compress-mode": {"choices": ("rules", "llm", "noop")} | _HIDDEN,
    "caveman-level": _LEVELS | _HIDDEN,
    "llm-concurrency": {"type": int} | _HIDDEN,
}


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="tracemill", description="Curate reasoning traces on Spark.")
    commands = top.add_subparsers(dest="command", required=True)
    run = commands.add_parser("run", help="curate JSONL traces")
    for names, settings in _OPTIONS.items():
        run.add_argument(*[f"--{name}" for name in names.split()], **settings)
    show = commands.add_parser("prompt", help="print a system prompt")
    show.add_argument("name", choices=("lite", "full", "invert", "validate"))
    return top


def _refuse(why: str) -> int:
    print(f"error: {why}", file=sys.stderr)
    return 2


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    if args.command == "prompt":
        print({"invert": prompts.invert_prompt, "validate": prompts.validate_prompt}.get(args.name, lambda: prompts.compress_prompt(args.name))())
        return 0
    if not (args.input_dir or args.input_file):
        return _refuse("one of --input-file and --input-dir is needed")
    if args.push_to_hub and not args.repo_id:
        return _refuse("uploading takes a --repo-id")
    from pyspark.sql import SparkSession

    from tracemill.operators.chat import ChatConfig, HttpBackend
    from tracemill.plans import pipeline

    config = ChatConfig(**({"model": args.model} if args.model else {}))
    options = pipeline.Options(resolve_mode(args.mode, args.compress_mode), args.level or args.caveman_level or "lite", args.anonymize_level, args.max_similarity, args.qaqc, max(1, args.qaqc_mirrors), args.seqs or args.llm_concurrency or 1, config.retries, lambda: HttpBackend(config))
    spark = SparkSession.builder.appName("tracemill").getOrCreate()
    stats = pipeline.run(spark, args.output_dir, input_dir=args.input_dir, input_file=args.input_file, options=options)
    print("\n".join(stats.lines(args.qaqc)))
    print(stats.line())
    if args.push_to_hub:
        pipeline.push_to_hub(args.output_dir, args.repo_id, not args.public)
    return 0


if __name__ == "__main__":
    sys.exit(main())
