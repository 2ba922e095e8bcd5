"""Materialising intermediate tables under the shared checkpoint folder."""

from __future__ import annotations

from pyspark.sql import DataFrame

from fleetscope.session import scratch_path


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as parquet under the shared checkpoint folder and read it back.

    Cuts lineage (a lost executor re-reads the table instead of recomputing
    the plan) and pins one result for several consumers.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)
