"""The four jobs from the command line, for spark-submit or ``python -m tidemark``.

    bootstrap --csv PATH... --lake ROOT
    features  --lake ROOT --matrices ROOT
    train     --matrices ROOT --registry ROOT
    infer     --matrices ROOT --registry ROOT --results ROOT
    lookup    --results ROOT --user ID
"""

from __future__ import annotations

import argparse
import json

from pyspark.sql import SparkSession

from tidemark.config import TOP_K, FeatureConfig, IngestConfig, TrainConfig
from tidemark.functions.recommendations import to_json
from tidemark.plans import run_bootstrap, run_features, run_inference, run_training
from tidemark.sources.log import read_csv_files
from tidemark.sources.results import ResultTable


def _arguments(argv: list[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="tidemark", description="Feature store jobs on Spark")
    jobs = parser.add_subparsers(dest="job", required=True)

    def job(name: str, *roots: str) -> argparse.ArgumentParser:
        sub = jobs.add_parser(name)
        for root in roots:
            sub.add_argument(f"--{root}", required=True)
        return sub

    ingest, features, train = IngestConfig(), FeatureConfig(), TrainConfig()
    sub = job("bootstrap", "lake")
    sub.add_argument("--csv", required=True, nargs="+")
    sub.add_argument("--min-interactions", type=int, default=ingest.min_interactions)
    sub.add_argument("--ts-min", type=int, default=ingest.ts_min)
    sub.add_argument("--ts-max", type=int, default=ingest.ts_max)
    sub.add_argument("--timezone", default=ingest.timezone)
    sub = job("features", "lake", "matrices")
    sub.add_argument("--neg-ratio", type=int, default=features.neg_ratio)
    sub.add_argument("--top-popular", type=int, default=features.top_popular)
    sub.add_argument("--epsilon", type=float, default=features.epsilon)
    sub = job("train", "matrices", "registry")
    sub.add_argument("--max-rounds", type=int, default=train.max_rounds)
    sub.add_argument("--seed", type=int, default=train.seed)
    sub = job("infer", "matrices", "registry", "results")
    sub.add_argument("--top-k", type=int, default=TOP_K)
    sub = job("lookup", "results")
    sub.add_argument("--user", type=int, required=True)
    return parser.parse_args(argv)


def run(spark: SparkSession, argv: list[str] | None = None) -> dict:
    args = _arguments(argv)
    if args.job == "bootstrap":
        cfg = IngestConfig(
            ts_min=args.ts_min,
            ts_max=args.ts_max,
            timezone=args.timezone,
            min_interactions=args.min_interactions,
        )
        return run_bootstrap(read_csv_files(spark, args.csv), args.lake, cfg)
    if args.job == "features":
        cfg = FeatureConfig(
            epsilon=args.epsilon, neg_ratio=args.neg_ratio, top_popular=args.top_popular
        )
        return run_features(spark, args.lake, args.matrices, cfg)
    if args.job == "train":
        cfg = TrainConfig(max_rounds=args.max_rounds, seed=args.seed)
        return run_training(spark, args.matrices, args.registry, cfg)
    if args.job == "infer":
        return run_inference(spark, args.matrices, args.registry, args.results, args.top_k)
    found = ResultTable(spark, args.results).find(args.user).select(to_json()).first()
    if found is None:
        raise SystemExit(f"user {args.user} not found")
    return {"user_id": args.user, "recommended_items": json.loads(found[0])}


def main() -> None:
    spark = SparkSession.builder.appName("tidemark").getOrCreate()
    print(json.dumps(run(spark)))
    spark.stop()


if __name__ == "__main__":
    main()
