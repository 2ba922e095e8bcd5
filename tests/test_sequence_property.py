"""Property test: the bucketed predecessor equals a pandas
``groupby().shift()`` over random keys, times, ties, nulls and bucket widths."""

import numpy as np
import pandas as pd
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from fleetscope.operators.sequence import PREV_TS, with_previous_time

rows_strategy = st.lists(
    st.tuples(st.sampled_from(["a", "b", "hot", None]),
              st.one_of(st.none(), st.integers(0, 40))),
    min_size=1, max_size=60)


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(rows=rows_strategy, n=st.integers(1, 50))
def test_predecessor_property(spark, rows, n):
    pdf = pd.DataFrame({"k": [r[0] for r in rows],
                        "secs": [r[1] for r in rows],
                        "id": np.arange(len(rows), dtype="int64")})
    df = spark.createDataFrame(
        [(k, None if s is None else f"2017-01-01 08:00:{s:02d}", i)
         for i, (k, s) in enumerate(rows)],
        "k string, t string, id long").selectExpr("k", "to_timestamp_ntz(t) AS t", "id")
    got = with_previous_time(df, "k", "t", "id", n).select("id", "_ts", PREV_TS).toPandas()
    got = got.set_index("id").sort_index()
    # Reference: nulls first in time, then id; the key's previous row.
    ref = pdf.assign(key=pdf["k"].fillna("\0null"),
                     ts=pdf["secs"].map(lambda s: None if pd.isna(s) else 1483257600 + int(s)))
    ref = ref.assign(nullfirst=ref["ts"].notna()).sort_values(["key", "nullfirst", "ts", "id"])
    ref["prev"] = ref.groupby("key")["ts"].shift(1)
    ref = ref.set_index("id").sort_index()
    for i in ref.index:
        want = ref.at[i, "prev"]
        have = got.at[i, PREV_TS]
        if pd.isna(want):
            assert pd.isna(have), (i, want, have)
        else:
            assert int(have) == int(want), (i, want, have)
