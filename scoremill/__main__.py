"""Command line: probe, profile, compare, scorecard and score.

    python -m scoremill compare --data loans.csv --fallback sample.csv --out outputs
    python -m scoremill scorecard --data loans.csv --out outputs
    python -m scoremill score --data new_loans.csv --card outputs/artifacts/scorecard --out scored
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession

from scoremill.operators.cleaning import clean
from scoremill.operators.split import ROW_KEY
from scoremill.operators.target import add_target
from scoremill.plans.comparison import compare_models
from scoremill.plans.outputs import write_comparison, write_profile, write_scorecard
from scoremill.plans.scorecard import ScorecardModel, fit_scorecard
from scoremill.sources.loans import (
    plain_names, probe, read_loans_csv, read_loans_parquet, require_columns, resolve_source)
from scoremill.sources.session import tuned
from scoremill.sources.sinks import write_csv
from scoremill.sources.staging import stage, workspace
from scoremill.spec import ScorecardSpec


def read(spark: SparkSession, path: str, args: argparse.Namespace) -> DataFrame:
    if args.format == "parquet":
        return plain_names(read_loans_parquet(spark, path))
    return plain_names(read_loans_csv(spark, path, multi_line=args.multi_line, refused_limit=args.refused_limit, quarantine=args.quarantine))


def arguments(argv: list[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="scoremill")
    commands = parser.add_subparsers(dest="command", required=True)
    for name in ("probe", "profile", "compare", "scorecard", "score"):
        sub = commands.add_parser(name)
        sub.add_argument("--data", required=True)
        sub.add_argument("--fallback")
        sub.add_argument("--format", choices=("csv", "parquet"), default="csv")
        sub.add_argument("--multi-line", action="store_true")
        sub.add_argument("--refused-limit", type=int, default=0, help="malformed rows that may be left out")
        sub.add_argument("--quarantine", help="folder for the malformed rows, with file and line")
        if name != "probe":
            sub.add_argument("--out", required=True)
        if name in ("compare", "scorecard"):
            sub.add_argument("--key", help="a column that identifies a row; by default all columns do")
            sub.add_argument("--seed", type=int, default=42)
        if name == "compare":
            sub.add_argument("--trees", type=int, default=500)
            sub.add_argument("--depth", type=int, default=6)
        if name == "scorecard":
            sub.add_argument("--policy", choices=("all_rows", "four_status"), default="all_rows")
            sub.add_argument("--points", choices=("reference", "additive"), default="reference")
            sub.add_argument("--fit-on", choices=("train", "all"), default="train")
        if name == "score":
            sub.add_argument("--card", required=True)
    return parser.parse_args(argv)


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> None:
    args = arguments(argv)
    spark = tuned(spark or SparkSession.builder.appName("scoremill").getOrCreate())
    with workspace(spark):
        run(args, spark)


def run(args: argparse.Namespace, spark: SparkSession) -> None:
    places = [("raw", args.data)] + ([("fallback", args.fallback)] if args.fallback else [])
    mode, path = resolve_source(spark, *places)
    loans = read(spark, path, args)
    if args.command == "probe":
        probe(loans).show()
    elif args.command == "profile":
        require_columns(loans, ("loan_status",))
        cleaned = stage(clean(add_target(loans)), "cleaned")
        write_profile(cleaned, args.out, raw=loans)
    elif args.command == "compare":
        write_comparison(compare_models(loans, args.key, mode, args.trees, args.depth, seed=args.seed),
                         args.out)
    elif args.command == "scorecard":
        spec = ScorecardSpec(key=args.key or ROW_KEY, policy=args.policy, seed=args.seed, fit_on=args.fit_on)
        write_scorecard(fit_scorecard(loans, spec), args.out, args.points)
    else:
        write_csv(ScorecardModel.load(spark, args.card).score_file(loans), args.out)


if __name__ == "__main__":
    main()
