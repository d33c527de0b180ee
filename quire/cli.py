"""Command line: parse, index, audit."""

from __future__ import annotations

import argparse
import json

from quire.config import IndexConfig, ParseConfig, load_yaml, resolve


def _parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="quire")
    commands = top.add_subparsers(dest="command", required=True)
    parse = commands.add_parser("parse", help="turn a folder into documents, manifest and state")
    for name in ("source-dir", "output-jsonl", "output-manifest", "state-dir", "log-dir", "log-level", "excluded", "converters"):
        parse.add_argument(f"--{name}")
    for name in ("preview-characters", "min-characters", "max-files", "chunk-size", "chunk-overlap"):
        parse.add_argument(f"--{name}", type=int)
    parse.add_argument("--no-skip-unchanged", dest="skip_unchanged", action="store_false", default=None)
    index = commands.add_parser("index", help="bring the vector table up to date")
    for name in ("input-jsonl", "state-dir", "vector-dir", "embedding-model", "embedding-endpoint", "embedding-provider", "api-key", "distance", "log-dir", "log-level"):
        index.add_argument(f"--{name}")
    for name in ("vector-size", "batch-size"):
        index.add_argument(f"--{name}", type=int)
    for name in ("recreate", "delete-missing-docs"):
        index.add_argument(f"--{name}", action="store_true", default=None)
    audit = commands.add_parser("audit", help="write frames and labels of a repeatable sample")
    source = audit.add_mutually_exclusive_group(required=True)
    source.add_argument("--input-jsonl", help="parsed documents")
    source.add_argument("--elements", help="a parquet table of elements")
    audit.add_argument("--count", type=int, required=True)
    audit.add_argument("--output-dir", required=True)
    audit.add_argument("--seed", type=int, default=0)
    for command in (parse, index):
        command.add_argument("--config")
    return top


def _audit(spark, args: argparse.Namespace) -> dict[str, int]:
    from quire.operators import audit

    from quire.plans import run

    elements = run.audit_elements(spark, args.input_jsonl) if args.input_jsonl else spark.read.parquet(args.elements)
    indexed = audit.numbered(elements)
    framed = audit.frames(indexed)
    documents = framed.select("doc_id").distinct()
    there = documents.count()
    if not 0 < args.count <= there:
        raise SystemExit(f"--count must be from 1 to {there}, the documents with boxes")
    sample = audit.seeded_sample(documents, args.count, args.seed)
    labelled = audit.with_rect(audit.labels(framed, audit.chain(indexed))).join(sample, "doc_id")
    labelled.write.mode("overwrite").parquet(f"{args.output_dir}/frames")
    audit.legend_boxes(audit.legend(framed)).join(sample.select("doc_id"), "doc_id", "left_semi").write.mode("overwrite").parquet(f"{args.output_dir}/legend")
    return {"documents": args.count}


def main(argv: list[str] | None = None) -> int:
    """Run one command; its counters go to standard output as one line of JSON."""
    args = _parser().parse_args(argv)
    from pyspark.sql import SparkSession

    from quire.logs import configure
    from quire.plans import run
    from quire.session import ensure_workers_import

    settings = load_yaml(args.config) if getattr(args, "config", None) else {}
    overrides = {k: v for k, v in vars(args).items() if v is not None}
    if getattr(args, "log_dir", None):
        configure(args.log_dir, args.log_level or "INFO")
    spark = SparkSession.builder.appName(f"quire-{args.command}").config("spark.cleaner.referenceTracking.cleanCheckpoints", "true").getOrCreate()
    ensure_workers_import(spark)
    if args.command == "parse":
        counters = run.parse_folder(spark, resolve(ParseConfig, settings.get("parse"), overrides))
    elif args.command == "index":
        counters = run.index_documents(spark, resolve(IndexConfig, settings.get("index"), overrides))
    else:
        counters = _audit(spark, args)
    print(json.dumps(counters))
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
