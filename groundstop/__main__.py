"""Command line for the pipeline stages (run under ``spark-submit`` on a cluster).

    python -m groundstop ingest  --legacy PATH --modern PATH --table DB.T [--by-year] [--quarantine DB.Q]
    python -m groundstop analyse --table DB.T --out PATH
    python -m groundstop sample  --table DB.T --out PATH [--fraction 0.03]
    python -m groundstop train   --sample PATH --model PATH [--max-iter 100 --max-depth 6]
    python -m groundstop prototype --table DB.T --out DB.P --airports A,B --slices 1997-,1995-1997
    python -m groundstop simulate  --table DB.T --out DB.S
    python -m groundstop score   --model PATH --requests PATH --out PATH
    python -m groundstop monitor --scored DB.T --labels DB.T --out DB.M --deployment NAME [--block 100]
    python -m groundstop score-and-monitor --simulation DB.S --model PATH --log DB.L --labels DB.T --out DB.M --deployment NAME [--n 10000] [--batch NAME]
    python -m groundstop increment --log DB.L --labels DB.T --state DB.X [--block 100]

The session comes from ``SparkSession.builder.getOrCreate()``: master,
resources and ``spark.checkpoint.dir`` are the cluster's.  Results are
written with Spark (parquet folders); nothing is collected.
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from groundstop import incremental, jobs


def _parser() -> argparse.ArgumentParser:
    ap = argparse.ArgumentParser(prog="groundstop")
    sub = ap.add_subparsers(dest="stage", required=True)

    p = sub.add_parser("ingest", help="two raw CSV layouts -> unified flights table (if absent)")
    p.add_argument("--legacy", required=True)
    p.add_argument("--modern", required=True)
    p.add_argument("--table", required=True)
    p.add_argument("--by-year", action="store_true", help="partition the table by flight year")
    p.add_argument("--quarantine", help="table for lines that do not fit the layout (without it they fail the job)")

    p = sub.add_parser("analyse", help="rates, top-k lists, unused columns -> parquet folders")
    p.add_argument("--table", required=True)
    p.add_argument("--out", required=True)
    p.add_argument("--top", type=int, default=10)

    p = sub.add_parser("sample", help="balanced training sample -> header CSV folder")
    p.add_argument("--table", required=True)
    p.add_argument("--out", required=True)
    p.add_argument("--fraction", type=float, default=0.03)

    p = sub.add_parser("train", help="fit and save the model; report on the test part -> stdout")
    p.add_argument("--sample", required=True)
    p.add_argument("--model", required=True)
    p.add_argument("--max-iter", type=int, default=100)
    p.add_argument("--max-depth", type=int, default=6)

    p = sub.add_parser("score", help="request texts (parquet with a 'feature' column) -> predictions")
    p.add_argument("--model", required=True)
    p.add_argument("--requests", required=True)
    p.add_argument("--out", required=True)

    p = sub.add_parser("prototype", help="airport and year slices of raw legacy rows -> ORC table")
    p.add_argument("--table", required=True)
    p.add_argument("--out", required=True)
    p.add_argument("--airports", required=True, help="comma-separated codes")
    p.add_argument("--slices", required=True, help="comma-separated from-to years, to excluded or empty")

    p = sub.add_parser("simulate", help="flights table -> all-text simulation table")
    p.add_argument("--table", required=True)
    p.add_argument("--out", required=True)

    p = sub.add_parser("monitor", help="scored log and late labels -> published metrics table")
    p.add_argument("--scored", required=True)
    p.add_argument("--labels", required=True)
    p.add_argument("--out", required=True)
    p.add_argument("--deployment", required=True)
    p.add_argument("--block", type=int, default=100)

    p = sub.add_parser("score-and-monitor", help="sample, score, log, attach labels, publish the metrics table")
    p.add_argument("--simulation", required=True)
    p.add_argument("--model", required=True)
    p.add_argument("--log", required=True, help="prediction log (in batches)")
    p.add_argument("--labels", required=True)
    p.add_argument("--out", required=True)
    p.add_argument("--deployment", required=True)
    p.add_argument("--n", type=int, default=10_000)
    p.add_argument("--buckets", type=int, default=16)
    p.add_argument("--batch", help="name of the batch; one that is in the log is not scored or logged again")

    p = sub.add_parser("increment", help="blocks of accuracy of what arrived since the last run")
    p.add_argument("--log", required=True)
    p.add_argument("--labels", required=True, help="label table (in batches)")
    p.add_argument("--state", required=True)
    p.add_argument("--block", type=int, default=100)
    return ap


def _slices(text: str) -> list[tuple[int, int | None]]:
    """``"1997-,1995-1997"`` -> [(1997, None), (1995, 1997)]."""
    pairs = [part.split("-") for part in text.split(",")]
    return [(int(low), int(high) if high else None) for low, high in pairs]


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    a = _parser().parse_args(argv)
    spark = spark or SparkSession.builder.appName(f"groundstop-{a.stage}").getOrCreate()
    if a.stage == "ingest":
        written = jobs.ingest_job(spark, a.legacy, a.modern, a.table, partition_by_year=a.by_year, quarantine=a.quarantine)
        print(f"{a.table}: {'written' if written else 'exists, left unchanged'}")
    elif a.stage == "analyse":
        for name, df in jobs.analysis_job(spark.table(a.table), a.top).items():
            df.write.mode("overwrite").parquet(f"{a.out.rstrip('/')}/{name}")
    elif a.stage == "sample":
        jobs.sample_job(spark.table(a.table), a.out, a.fraction)
    elif a.stage == "train":
        report = jobs.train_job(spark, a.sample, a.model, max_iter=a.max_iter, max_depth=a.max_depth)
        report.show(truncate=False)  # five rows
    elif a.stage == "score":
        jobs.score_job(spark, a.model, spark.read.parquet(a.requests)).write.mode("overwrite").parquet(a.out)
    elif a.stage == "prototype":
        jobs.prototype_job(spark.table(a.table), a.out, a.airports.split(","), _slices(a.slices))
    elif a.stage == "simulate":
        jobs.simulation_job(spark.table(a.table), a.out)
    elif a.stage == "monitor":
        jobs.monitor_job(spark.table(a.scored), spark.table(a.labels), a.out, a.deployment, a.block)
    elif a.stage == "score-and-monitor":
        jobs.score_and_monitor_job(
            spark, spark.table(a.simulation), a.model, a.log, spark.table(a.labels).select("uuid", "final_label"), a.out, a.deployment,
            n=a.n, buckets=a.buckets, batch=a.batch)
    elif a.stage == "increment":
        done = incremental.monitor_increment(spark, a.log, a.labels, a.state, a.block)
        print(f"{a.state}: run {done['run']}, {done['blocks']} blocks")
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
