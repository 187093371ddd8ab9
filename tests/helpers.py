import datetime

import numpy as np
import pandas as pd

from tickloom.operators.panel import Panel

SMALL = Panel(block_rows=16, scan_rows=16)


def make_bars(sizes, seed=7, constant=()):
    """Bars with gaps in the dates; ``sizes`` maps a ticker to its number of rows."""
    rng = np.random.default_rng(seed)
    frames = []
    for ticker, n in sizes.items():
        days = np.cumsum(rng.integers(1, 5, n))
        close = np.full(n, 50.0) if ticker in constant else 100 + np.cumsum(rng.normal(0, 1, n))
        spread = 0.0 if ticker in constant else 1.0
        frames.append(pd.DataFrame({
            "ticker": ticker, "date": [datetime.date(2000, 1, 1) + datetime.timedelta(int(d)) for d in days],
            "open": close + spread * rng.normal(0, 0.2, n), "high": close + spread * rng.uniform(0.3, 2, n),
            "low": close - spread * rng.uniform(0.3, 2, n), "close": close, "volume": rng.integers(0, 1000, n)}))
    return pd.concat(frames, ignore_index=True) if frames else pd.DataFrame()


BAR_SCHEMA = "ticker string, date date, open double, high double, low double, close double, volume bigint"


def to_spark(spark, pdf, schema=BAR_SCHEMA):
    rows = [tuple(None if pd.isna(v) else (v.item() if hasattr(v, "item") else v) for v in r)
            for r in pdf.itertuples(index=False, name=None)]
    return spark.createDataFrame(rows, schema)


def collected(df, *columns):
    """pandas rows in (ticker, date) order."""
    out = df.select("ticker", "date", *columns).toPandas()
    return out.sort_values(["ticker", "date"]).reset_index(drop=True)


def close_to(actual, expected, rtol=1e-9, atol=1e-9):
    np.testing.assert_allclose(np.asarray(actual, dtype=float), np.asarray(expected, dtype=float), rtol=rtol, atol=atol,
                               equal_nan=True)
