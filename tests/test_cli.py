"""The command-line jobs run end to end on a small raw folder."""

import csv
import os
import re

import pytest

from fleetscope import cli
from fleetscope.sources import files as FL
from fleetscope.sources.telemetry import load_telemetry
from tests.conftest import SF_SMALL


def test_clean_then_analyze(spark, tmp_dir):
    raw = load_telemetry(spark, SF_SMALL, clean=False)
    FL.write_raw_csv(raw, f"{tmp_dir}/raw")
    cli.clean(spark, f"{tmp_dir}/raw", f"{tmp_dir}/clean")
    table = spark.read.parquet(f"{tmp_dir}/clean/table")
    assert table.count() == raw.count()
    assert table.filter(table.carPlateNumber.rlike("[^a-zA-Z0-9]")).count() == 0
    cli.analyze(spark, f"{tmp_dir}/clean/table", f"{tmp_dir}/out", fmt="parquet")
    for name in ["driver_summary", "summary_stats", "correlation_matrix", "driver_clusters",
                 "regression_coefficients", "driver_anomalies", "correlation_matrix_txt"]:
        assert os.path.isdir(f"{tmp_dir}/out/{name}"), name
    assert spark.read.parquet(f"{tmp_dir}/out/correlation_matrix").count() == 121
    assert spark.read.parquet(f"{tmp_dir}/out/driver_summary").count() == 15


def test_outputs_of_clean_are_what_analyze_reads(spark, tmp_dir):
    raw = load_telemetry(spark, SF_SMALL, clean=False)
    FL.write_raw_csv(raw.repartition(3), f"{tmp_dir}/raw")
    open(f"{tmp_dir}/raw/empty.csv", "w").close()
    cli.clean(spark, f"{tmp_dir}/raw", f"{tmp_dir}/clean")
    assert cli._read_input(spark, f"{tmp_dir}/clean/csv", "csv").count() == raw.count()
    outputs = sorted(os.listdir(f"{tmp_dir}/clean/csv"))
    assert len([n for n in outputs if n.startswith("output=output_")]) == len([n for n in os.listdir(f"{tmp_dir}/raw") if n[0] not in "._" and n != "empty.csv"])
    for name in outputs:
        if not name.startswith("output="):
            continue
        shards = sorted(os.listdir(f"{tmp_dir}/clean/csv/{name}"))
        text = "".join(open(f"{tmp_dir}/clean/csv/{name}/{s}/{f}", encoding="utf-8").read()
                       for s in shards for f in sorted(os.listdir(f"{tmp_dir}/clean/csv/{name}/{s}")) if f.startswith("part-"))
        got = list(csv.reader(text.splitlines(keepends=True)))
        source = open(f"{tmp_dir}/raw/{name.removeprefix('output=output_').removesuffix('.csv')}", encoding="utf-8")
        assert got[0] == FL.FIELD_NAMES
        assert got[1:] == [[re.sub("[^a-zA-Z0-9]", "", c) if i == 1 else c for i, c in enumerate(r)] for r in csv.reader(source)]
    os.makedirs(f"{tmp_dir}/none")
    with pytest.raises(SystemExit):
        cli._read_input(spark, f"{tmp_dir}/none", "csv")


def test_ingest_job_is_restartable(spark, tmp_dir):
    from pyspark.sql import functions as F

    raw = load_telemetry(spark, SF_SMALL, clean=False)
    FL.write_raw_csv(raw.filter(F.col("event_id") < 300), f"{tmp_dir}/raw/a")
    cli.ingest(spark, f"{tmp_dir}/raw/*", f"{tmp_dir}/table", f"{tmp_dir}/ckpt")
    FL.write_raw_csv(raw.filter(F.col("event_id") >= 300), f"{tmp_dir}/raw/b")
    cli.ingest(spark, f"{tmp_dir}/raw/*", f"{tmp_dir}/table", f"{tmp_dir}/ckpt")
    cli.ingest(spark, f"{tmp_dir}/raw/*", f"{tmp_dir}/table", f"{tmp_dir}/ckpt")
    assert spark.read.parquet(f"{tmp_dir}/table").count() == raw.count()


def test_main_parses_commands(spark, tmp_dir, monkeypatch):
    calls = []
    monkeypatch.setattr(cli, "_session", lambda args: spark)
    monkeypatch.setattr(cli, "clean", lambda s, raw, out: calls.append(("clean", raw, out)))
    cli.main(["clean", "in", "out"])
    assert calls == [("clean", "in", "out")]
