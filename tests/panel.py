"""Small price panels with every awkward case, and plain pandas versions of the indicators."""

import numpy as np
import pandas as pd

BARS = "company STRING, dt DATE, open DOUBLE, high DOUBLE, low DOUBLE, close DOUBLE, volume DOUBLE"


def make_panel(sizes, seed=7):
    """Companies of the given sizes with gaps between days, zero volumes, flat stretches."""
    rng = np.random.default_rng(seed)
    frames = []
    for name, n in sizes.items():
        days = pd.Timestamp("2015-01-01") + pd.to_timedelta(np.cumsum(rng.integers(1, 5, n)), unit="D")
        close = np.round(100 * np.exp(np.cumsum(rng.normal(0, 0.02, n))), 2)
        if n > 150:
            close[60:95] = close[60]
        open_ = np.round(close * (1 + rng.normal(0, 0.01, n)), 2)
        open_[::7] = close[::7]
        high = np.maximum(open_, close) + np.round(rng.random(n), 2)
        low = np.minimum(open_, close) - np.round(rng.random(n), 2)
        volume = rng.integers(1, 1000, n).astype(float)
        if n > 40:
            volume[20:23] = 0.0
        frames.append(pd.DataFrame({
            "company": name, "dt": days.date, "open": open_, "high": high, "low": low,
            "close": close, "volume": volume}))
    return pd.concat(frames, ignore_index=True)


def to_spark(spark, panel, schema=BARS, shuffle=True):
    rows = panel.sample(frac=1, random_state=3) if shuffle else panel
    clean = rows.astype(object).where(rows.notna(), None)
    return spark.createDataFrame(clean.to_dict("records"), schema)


def expected_features(panel):
    """The technical features of one company's ordered rows."""
    d = panel.reset_index(drop=True).copy()
    close, high, low, volume = d.close, d.high, d.low, d.volume
    prior = close.shift(1)
    out = pd.DataFrame({"company": d.company, "dt": d.dt})
    for n in (10, 20, 50):
        out[f"MA_{n}"] = close.rolling(n).mean()
    for n in (12, 26):
        out[f"EMA_{n}"] = close.ewm(span=n, adjust=False).mean()
    out["MACD"] = out.EMA_12 - out.EMA_26
    out["MACD_Signal"] = out.MACD.ewm(span=9, adjust=False).mean()
    out["MACD_Hist"] = out.MACD - out.MACD_Signal
    delta = close.diff()
    gains, losses = delta.clip(lower=0).rolling(14).mean(), (-delta.clip(upper=0)).rolling(14).mean()
    out["RSI"] = 100 - 100 / (1 + gains / (losses + 1e-9))
    out["BB_Mid"], out["BB_Std"] = out.MA_20, close.rolling(20).std()
    out["BB_Upper"], out["BB_Lower"] = out.BB_Mid + 2 * out.BB_Std, out.BB_Mid - 2 * out.BB_Std
    for n in (1, 3, 5, 10):
        out[f"Return_{n}"] = close / close.shift(n) - 1
        out[f"Momentum_{n}"] = close.diff(n)
    for n in (10, 20):
        out[f"Vol_{n}"] = out.Return_1.rolling(n).std()
    tr = pd.concat([high - low, (high - prior).abs(), (low - prior).abs()], axis=1).max(axis=1)
    out["ATR_14"] = tr.where(prior.notna()).rolling(14).mean()
    out["Price_vs_MA50"] = (close - out.MA_50) / (out.MA_50 + 1e-9)
    out["MA_spread"] = (out.MA_10 - out.MA_20) / (out.MA_20 + 1e-9)
    out["Volume_MA10"] = volume.rolling(10).mean()
    out["Volume_Ratio"] = volume / (out.Volume_MA10 + 1e-9)
    out["Volume_Change"] = volume / volume.shift(1) - 1
    floor, ceiling = low.rolling(14).min(), high.rolling(14).max()
    out["Stoch_K"] = 100 * (close - floor) / (ceiling - floor + 1e-9)
    out["Stoch_D"] = out.Stoch_K.rolling(3).mean()
    out["Candle_Dir"] = np.sign(close - d.open)
    return out


def expected_panel(panel):
    return pd.concat([expected_features(rows.sort_values("dt")) for _, rows in panel.groupby("company")])


def assert_same(actual, expected, columns, tolerance=1e-8):
    """Compare by (company, dt), including where values are missing or infinite."""
    keys = ["company", "dt"]
    a = actual.sort_values(keys).reset_index(drop=True)
    b = expected.sort_values(keys).reset_index(drop=True)
    assert a[keys].astype(str).equals(b[keys].astype(str))
    for name in columns:
        np.testing.assert_allclose(
            a[name].astype(float), b[name].astype(float), rtol=tolerance, atol=tolerance, err_msg=name)
