import math

import pandas as pd


def norm(v):
    if v is None or v is pd.NA or v is pd.NaT:
        return None
    if isinstance(v, bool):
        return v
    if isinstance(v, (int, float)) or hasattr(v, "dtype"):
        try:
            f = float(v)
        except (TypeError, ValueError):
            return str(v)
        return None if math.isnan(f) else round(f, 6) + 0.0
    return str(v)


def canon(pdf: pd.DataFrame):
    cols = sorted(pdf.columns)
    rows = [tuple(norm(x) for x in r) for r in pdf[cols].astype(object).itertuples(index=False)]
    return cols, sorted(rows, key=repr)


def rows(df):
    return [r.asDict(recursive=True) for r in df.collect()]
