"""Command line: ``python -m clickseg <command> [options]`` (or via ``spark-submit``).

Commands: ``convert`` (CSV / CSV.GZ -> partitioned Parquet), ``clean``,
``train``, ``score``, ``logs`` and ``all`` (convert, clean, train).  Option
names follow the reference's driver; every path may be local, ``hdfs://`` or
``s3a://`` (S3A settings come from S3_* environment variables when
S3_ENDPOINT is set).  The pseudonym salt is read from the environment variable
named by ``--salt-env`` and is never written anywhere.
"""

from __future__ import annotations

import argparse
import json
import os
import sys

from pyspark.sql import SparkSession


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="clickseg", description="clickstream segmentation jobs")
    p.add_argument("command", choices=["convert", "clean", "train", "score", "logs", "all"])
    p.add_argument("--raw_tmp", help="folder of compressed .csv.gz inputs (read as is)")
    p.add_argument("--input_csv", help="folder of monthly CSV inputs")
    p.add_argument("--input_parquet", help="Parquet inputs: output of convert, input of clean")
    p.add_argument("--output_s3", help="cleaned data set (partitioned by source_file)")
    p.add_argument("--input_s3_model", help="training input (defaults to --output_s3)")
    p.add_argument("--output_s3_model", help="folder of saved models")
    p.add_argument("--output_s3_img", help="folder for chart data (k search, profiles, predictions)")
    p.add_argument("--output_data", help="folder for quality reports")
    p.add_argument("--profiles", help="score: Parquet table of feature rows to score")
    p.add_argument("--scores", help="score: output folder")
    p.add_argument("--stream", action="store_true",
                   help="score: keep scoring profile files as they arrive")
    p.add_argument("--checkpoint", help="score --stream: checkpoint folder (shared storage)")
    p.add_argument("--logs", help="logs: folder of log files")
    p.add_argument("--log_metrics", help="logs: output folder (one folder per day)")
    p.add_argument("--salt-env", default="PSEUDONYM_SALT",
                   help="environment variable holding the pseudonym salt")
    p.add_argument("--max-k", type=int, default=10, help="largest k of the search")
    p.add_argument("--fit-partitions", type=int,
                   help="partitions of the feature table for the fits (default: by the number of buyers)")
    p.add_argument("--feature-state",
                   help="train: folder of the feature state; only cleaned months that it lacks are read")
    p.add_argument("--exact-quartiles", action="store_true",
                   help="exact per-file quartiles instead of sketches")
    return p


def _session() -> SparkSession:
    # The CSV time pattern quotes its zone, so times are read in the session's: UTC.
    builder = SparkSession.builder.appName("clickseg").config("spark.sql.session.timeZone", "UTC")
    if os.environ.get("S3_ENDPOINT"):
        from clickseg.sources.s3a import with_s3a
        builder = with_s3a(builder)
    return builder.getOrCreate()


def _need(args, *names):
    missing = [n for n in names if not getattr(args, n)]
    if missing:
        raise SystemExit(f"missing option(s): {', '.join('--' + n for n in missing)}")


def run(argv: list[str] | None = None, spark: SparkSession | None = None) -> dict:
    from clickseg.plans import jobs
    from clickseg.sources import files as IO

    args = _parser().parse_args(argv)
    spark = spark or _session()
    out: dict = {}
    cmd = args.command
    if cmd in ("convert", "all"):
        _need(args, "input_parquet")
        sources = [d for d in (args.input_csv, args.raw_tmp) if d]
        if not sources:
            raise SystemExit("convert needs --input_csv and/or --raw_tmp")
        out["converted"] = [p for d in sources
                            for p in IO.csv_to_parquet(spark, d, args.input_parquet)]
    if cmd in ("clean", "all"):
        _need(args, "input_parquet", "output_s3")
        salt = os.environ.get(args.salt_env)
        if not salt:
            raise SystemExit(f"set the pseudonym salt in ${args.salt_env}")
        out["row_counts"] = jobs.clean_job(spark, args.input_parquet, args.output_s3, salt,
                                           report_dir=args.output_data,
                                           exact=args.exact_quartiles)
    if cmd in ("train", "all"):
        _need(args, "output_s3_model", "output_s3_img")
        source = args.input_s3_model or args.output_s3
        if not source:
            raise SystemExit("train needs --input_s3_model (or --output_s3)")
        out["model"] = jobs.train_job(spark, source, args.output_s3_model, args.output_s3_img,
                                      max_k=args.max_k, partitions=args.fit_partitions,
                                      state_dir=args.feature_state)
    if cmd == "score" and args.stream:
        _need(args, "output_s3_model", "profiles", "scores", "checkpoint")
        query = jobs.start_score_stream(spark, args.output_s3_model, args.profiles, args.scores,
                                        args.checkpoint)
        out["scores"] = args.scores
        query.awaitTermination()
    elif cmd == "score":
        _need(args, "output_s3_model", "profiles", "scores")
        scored = jobs.score_job(spark, args.output_s3_model, spark.read.parquet(args.profiles))
        scored.write.mode("overwrite").parquet(args.scores)
        out["scores"] = args.scores
    if cmd == "logs":
        _need(args, "logs", "log_metrics")
        jobs.log_metrics_job(spark, args.logs, args.log_metrics)
        out["log_metrics"] = args.log_metrics
    return out


def main() -> None:
    print(json.dumps(run(sys.argv[1:]), default=str))


if __name__ == "__main__":
    main()
