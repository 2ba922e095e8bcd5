"""Command-line jobs (submit with ``spark-submit -m``-style or ``python -m fleetscope.cli``).

* ``clean``   raw headerless CSV folder -> cleaned header CSV, one output per
              input file (S1, P2, S5), plus the date-partitioned parquet table.
* ``analyze`` the ``csv`` folder of ``clean``, any folder of header CSVs, or a
              parquet table (S2, S3, U1) -> per-driver summary and
              everything derived from it (A3, A5, A6, A11, A12, M1-M7), each
              written as a parquet table under the output folder.
* ``ingest``  streaming form of ``clean`` (T7): new raw files are cleaned into
              a parquet table; run it again to pick up files that arrived since.

The session is taken from the environment (``spark-submit`` settings);
``--local N`` starts a local session instead.
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession

from fleetscope.operators import iforest, ml, stats, trips
from fleetscope.session import ensure_checkpoint_dir, local_session
from fleetscope.sources import files
from fleetscope.sources.sinks import materialize


def _session(args) -> SparkSession:
    if args.local:
        return local_session(args.local)
    spark = SparkSession.builder.appName("fleetscope").getOrCreate()
    ensure_checkpoint_dir(spark)
    return spark


def _read_input(spark: SparkSession, path: str, fmt: str) -> DataFrame:
    if fmt == "parquet":
        return spark.read.parquet(path)
    clean = files.read_clean_cells(spark, path)
    if clean.isEmpty():
        raise SystemExit(f"no .csv output below {path}")
    return files.typed_records(files.aligned_cells(clean))


def clean(spark: SparkSession, raw: str, out: str) -> None:
    # the records are stored once; outputs, table and rejects read them there
    cells = files.clean_cells(files.read_cells(spark, raw))
    files.write_cells(cells, f"{out}/csv")
    files.write_telemetry_table(files.typed_records(cells), f"{out}/table")
    files.rejected_cells(cells).write.mode("overwrite").parquet(f"{out}/rejects")


def analyze(spark: SparkSession, src: str, out: str, fmt: str = "csv", seed: int = 0) -> None:
    telemetry = _read_input(spark, src, fmt)
    summary = materialize(trips.driver_summary(telemetry), "driver-summary")
    summary.write.mode("overwrite").parquet(f"{out}/driver_summary")
    results = {
        "summary_stats": stats.summary_stats(summary),
        "correlation_matrix": stats.correlation_matrix(summary),
        "boxplot_accelerations": stats.boxplot_stats(summary),
        "boxplot_outliers": stats.boxplot_outliers(summary),
        "overspeed_bars": stats.bar_values(summary),
        "driver_clusters": ml.driver_clusters(summary, seed=seed),
        "regression_coefficients": ml.regression_coefficients(summary, seed=seed),
        "regression_score": ml.regression_score(summary, seed=seed),
        "driver_anomalies": iforest.driver_anomalies(summary, seed=seed),
    }
    for name, df in results.items():
        df.write.mode("overwrite").parquet(f"{out}/{name}")
    files.write_matrix_text(results["correlation_matrix"], f"{out}/correlation_matrix_txt")


def ingest(spark: SparkSession, raw: str, table: str, checkpoint: str) -> None:
    from fleetscope.streaming.board import ingest_raw

    ingest_raw(spark, raw, table, checkpoint)


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(prog="fleetscope")
    p.add_argument("--local", type=int, default=0, help="run on local[N] instead of the cluster")
    sub = p.add_subparsers(dest="cmd", required=True)
    c = sub.add_parser("clean")
    c.add_argument("raw")
    c.add_argument("out")
    a = sub.add_parser("analyze")
    a.add_argument("src")
    a.add_argument("out")
    a.add_argument("--format", choices=["csv", "parquet"], default="csv")
    a.add_argument("--seed", type=int, default=0)
    i = sub.add_parser("ingest")
    i.add_argument("raw")
    i.add_argument("table")
    i.add_argument("checkpoint")
    args = p.parse_args(argv)
    spark = _session(args)
    if args.cmd == "clean":
        clean(spark, args.raw, args.out)
    elif args.cmd == "analyze":
        analyze(spark, args.src, args.out, args.format, args.seed)
    else:
        ingest(spark, args.raw, args.table, args.checkpoint)


if __name__ == "__main__":
    main()
