"""Holt-Winters' start state, the fold and the parameter search beside numpy."""

import datetime as dt

import numpy as np
import pytest

from tillwise.operators import forecast as FC

SHORT = [10, 12, 14, 11, 12, 15, 16, 12, 14, 16, 18, 14]


def frame(spark, *series):
    rows = [(f"k{k}", "s", dt.date(2000 + i // 12, i % 12 + 1, 1), None if v is None else float(v)) for k, y in enumerate(series) for i, v in enumerate(y)]
    return spark.createDataFrame(rows, "key string, series string, period date, units double").orderBy("units")


def start(y, m):
    y, half, n = np.asarray(y, float), m // 2, len(y)
    if n < 10 + 2 * half:
        level = y[:m].mean()
        return level, (y[m:2 * m].mean() - level) / m, y[:m] - level
    cycles = max(min(5, n // m), -(-(10 + 2 * half) // m))
    part = y[:m * cycles]
    weights = np.ones(m) if m % 2 else np.r_[0.5, np.ones(m - 1), 0.5]
    average = np.convolve(part, weights / m, "valid")
    rest = part[half:half + len(average)] - average
    season = np.array([rest[[(i + half) % m == j for i in range(len(rest))]].mean() for j in range(m)])
    slope, level = np.polyfit(np.arange(1, 11), average[:10], 1)
    return level, slope, season - season.mean()


def smooth(y, alpha, beta, gamma, m):
    """Fitted values, end state; parameters may be arrays of many points."""
    level, trend, season = start(y, m)
    season, fits = [s + 0 * alpha for s in season], []
    for t, v in enumerate(y):
        fits.append(level + trend + season[t % m])
        new = alpha * (v - season[t % m]) + (1 - alpha) * (level + trend)
        season[t % m], trend, level = gamma * (v - level - trend) + (1 - gamma) * season[t % m], beta * (new - level) + (1 - beta) * trend, new
    return np.array(fits), level, trend, season


def ahead(y, alpha, beta, gamma, m, h):
    _, level, trend, season = smooth(y, alpha, beta, gamma, m)
    return [level + k * trend + season[(len(y) + k - 1) % m] for k in range(1, h + 1)]


def wave(n, m, slope, size, noise, seed):
    r = np.random.default_rng(seed)
    t = np.arange(n)
    return np.round(200 + slope * t + size * np.sin(2 * np.pi * t / m) + r.normal(0, noise, n), 3)


def test_start_state_by_hand(spark):
    """A line 3 + 2 t and the season 1, -1, 2, -2: the averages are the line at t = 2, 3, ..., so level 5 at x = 0 and slope 2."""
    y = [3 + 2 * t + (1, -1, 2, -2)[t % 4] for t in range(16)]
    got = FC._with_start(FC._gathered(frame(spark, y)), 4).first().start
    assert np.allclose([got.level, got.trend, *got.season], [5, 2, 1, -1, 2, -2])


def test_short_start_by_hand(spark):
    got = FC._with_start(FC._gathered(frame(spark, SHORT)), 4).first().start
    assert np.allclose([got.level, got.trend, *got.season], [11.75, 0.5, -1.75, 0.25, 2.25, -0.75])


@pytest.mark.parametrize("m", [3, 4, 12])
def test_fold(spark, m):
    """Lengths around two seasons, the least length of the long start, five seasons and beyond."""
    lengths = [n for n in (2 * m, 2 * m + 1, 10 + 2 * (m // 2) - 1, 10 + 2 * (m // 2), 5 * m, 7 * m + 1) if n >= 2 * m]
    series = [wave(n, m, 1.5, 30, 5, n) for n in lengths]
    got, fits = {}, {}
    for r in FC.holt_winters(frame(spark, *series), m=m, h=m + 2).orderBy("key", "step").collect():
        got.setdefault(r.key, []).append(r.forecast)
    for r in FC.fitted_values(frame(spark, *series), m=m).orderBy("key", "period").collect():
        fits.setdefault(r.key, []).append(r.fitted)
    for k, y in enumerate(series):
        assert np.allclose(got[f"k{k}"], ahead(y, 0.2, 0.2, 0.2, m, m + 2))
        assert np.allclose(fits[f"k{k}"], smooth(y, 0.2, 0.2, 0.2, m)[0])


def test_short_and_null_series(spark):
    df = frame(spark, [1, 2, 3], [1, 2, 3, 4, 5, 6, 7, None])
    assert [(r.key, r.step, r.forecast, r.status) for r in FC.holt_winters(df).collect() if r.key == "k0"] == [("k0", None, None, "too_short")]
    assert [r.forecast for r in FC.holt_winters(df).collect() if r.key == "k1"] == [None] * 4
    assert {r.fitted for r in FC.fitted_values(df).collect() if r.key == "k0"} == {None}
    assert FC.holt_winters(df.filter("false")).count() == 0 and FC.holt_winters_tuned(df.filter("false")).count() == 0
    assert {r.key for r in FC.tuned(df, 4).select("key").collect()} == {"k1"}


def test_tuned_against_fine_grid(spark):
    """No point of a 0.01 grid inside the bounds has a smaller error; the reported error is that of the reported parameters."""
    m = 12
    series = [wave(48, m, 0.8, 40, 6, 1), np.cumsum(np.random.default_rng(2).normal(0, 10, 60)).round(3) + 300, wave(75, m, 3, 80, 2, 3)]
    a, b, g = (x.ravel() / 100 for x in np.mgrid[0:101, 0:101, 0:101])
    inside = (b <= a + 1e-9) & (g <= 1 - a + 1e-9)
    a, b, g = a[inside], b[inside], g[inside]
    for r in FC.tuned(frame(spark, *series), m).collect():
        y = series[int(r.key[1:])]
        own = ((y - smooth(y, r.alpha, r.beta, r.gamma, m)[0]) ** 2).sum()
        grid = ((y[:, None] - smooth(y, a, b, g, m)[0]) ** 2).sum(axis=0)
        assert 0 <= r.beta <= r.alpha <= 1 and 0 <= r.gamma <= 1 - r.alpha + 1e-12
        assert np.isclose(own, r.sse) and r.sse <= grid.min() * (1 + 1e-9)


def test_tuned_metrics(spark):
    y = wave(60, 12, 1, 30, 8, 9)
    p = FC.tuned(frame(spark, y)).first()
    got = FC.tuned_metrics(frame(spark, y)).first()
    err = np.abs(y - smooth(y, p.alpha, p.beta, p.gamma, 12)[0])
    assert np.allclose([got.mae, got.mse, got.wmape, got.mase], [err.mean(), (err ** 2).mean(), err.sum() / y.sum() * 100, err.mean() / np.abs(np.diff(y)).mean()], atol=1e-5)
