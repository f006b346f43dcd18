"""Command line: ``python -m textmill build|compare|outliers ...`` (or through spark-submit)."""

from __future__ import annotations

import argparse
import dataclasses
import importlib

from pyspark.sql import SparkSession

from textmill.operators.tokens import PythonAnalyser, ScriptRunAnalyser
from textmill.plans.corpus import build_corpus
from textmill.operators.outliers import largest_gaps, percentile_gaps
from textmill.sources.documents import DocumentSource
from textmill.plans.report import compare_files
from textmill.sources.frequencies import count_bad_lines, read_frequencies
from textmill.sources.vocabulary import read_vocabulary, read_vocabulary_table
from textmill.storage import staging


def flag(value: str) -> bool:
    return str(value).lower() == "true"


def _pair(value: str) -> tuple[str, str]:
    name, sep, rest = value.partition("=")
    if not sep:
        raise argparse.ArgumentTypeError(f"expected NAME=VALUE, got {value!r}")
    return name, rest


def _analyser(spec: str):
    """``script-runs`` or ``module:factory`` for a Python analyser."""
    if spec == "script-runs":
        return ScriptRunAnalyser()
    module, _, name = spec.partition(":")
    return PythonAnalyser(getattr(importlib.import_module(module), name))


def parse(argv=None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="textmill")
    commands = parser.add_subparsers(dest="command", required=True)
    build = commands.add_parser("build", help="build the corpus and compare its splits")
    build.add_argument("--source", type=_pair, action="append", default=[], metavar="NAME=PATH")
    build.add_argument("--smoke", type=_pair, action="append", default=[], metavar="NAME=PATH")
    build.add_argument("--include", type=_pair, action="append", default=[], metavar="NAME=true|false")
    build.add_argument("--text-col", default="text")
    build.add_argument("--vocab", required=True, help="word list (text) or table (.parquet)")
    build.add_argument("--analyser", default="script-runs")
    build.add_argument("--max-docs", type=int, default=0)
    build.add_argument("--val-ratio", type=float, default=0.1)
    build.add_argument("--output", default="output")
    build.add_argument("--corpus-files", type=int, help="number of sentence files (default: by size)")
    build.add_argument("--max-types", type=int, help="rows per split of the written frequency table (default: all)")
    compare = commands.add_parser("compare", help="compare the splits of written frequency tables")
    compare.add_argument("--frequencies", required=True, help="folder with split=... folders, as build writes it")
    compare.add_argument("--vocab", required=True, help="word list (text) or table (.parquet)")
    compare.add_argument("--vocab-size", type=int, help="lines of the vocabulary (default: counted)")
    compare.add_argument("--output", default="output")
    compare.add_argument("--drop-hash-rows", action="store_true", help="skip lines that begin with #")
    outliers = commands.add_parser("outliers", help="list the widest frequency gaps of a frequency table")
    outliers.add_argument("--frequencies", required=True)
    outliers.add_argument("--drop-hash-rows", action="store_true", help="skip lines that begin with #")
    return parser.parse_args(argv)


def document_sources(args: argparse.Namespace) -> list[DocumentSource]:
    smoke, include = dict(args.smoke), dict(args.include)
    sources = [
        DocumentSource(name, path, args.text_col, smoke_path=smoke.get(name)) for name, path in args.source
    ]
    return [dataclasses.replace(s, enabled=flag(include.get(s.name, "true"))) for s in sources]


def main(argv=None) -> None:
    args = parse(argv)
    spark = SparkSession.builder.appName("textmill").getOrCreate()
    if args.command == "outliers":
        form = {"min_fields": 6, "drop_hash_rows": args.drop_hash_rows}
        largest_gaps(percentile_gaps(read_frequencies(spark, args.frequencies, **form))).show(truncate=False)
        print(f"lines skipped: {count_bad_lines(spark, args.frequencies, **form)}")
        return
    read = read_vocabulary_table if args.vocab.endswith(".parquet") else read_vocabulary
    vocab = read(spark, args.vocab)
    if args.command == "compare":
        compare_files(spark, args.frequencies, vocab, args.output, args.vocab_size, args.drop_hash_rows)
        return
    with staging(spark):
        build_corpus(
            spark,
            document_sources(args),
            vocab,
            _analyser(args.analyser),
            args.output,
            args.val_ratio,
            args.max_docs,
            corpus_files=args.corpus_files,
            max_types=args.max_types,
        )


if __name__ == "__main__":
    main()
