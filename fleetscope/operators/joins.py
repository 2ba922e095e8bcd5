"""Joining a derived lookup table back onto the facts."""

from __future__ import annotations

from pyspark.sql import DataFrame


def join_lookup(facts: DataFrame, lookup: DataFrame, on: str | list[str], how: str = "inner") -> DataFrame:
    """Join ``lookup`` (materialised, so its size on disk is known) onto ``facts``.

    No hint and no row count: Spark broadcasts the lookup only where its size is
    below ``spark.sql.autoBroadcastJoinThreshold``, and else shuffles both sides,
    splitting hot keys (AQE skew join)."""
    return facts.join(lookup, on=on, how=how)
