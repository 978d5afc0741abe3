"""The models as expressions against the same models in numpy."""

import random

import numpy as np
import pytest

from tallyforge.operators import modelling


@pytest.fixture
def series(spark):
    rng = random.Random(6)
    rows = []
    for ticker, n in (("A", 24), ("B", 13), ("C", 9), ("D", 5), ("E", 2), ("F", 1), ("Z", 20)):
        for k in range(n):
            y = 0.0 if ticker == "Z" else 100.0 + 3 * k + 10 * (k % 4 == 3) + rng.random()
            day = "28" if ticker == "B" else {3: "31", 6: "30", 9: "30", 12: "31"}[3 * (k % 4) + 3]
            rows.append((ticker, f"{2018 + k // 4}-{3 * (k % 4) + 3:02d}-{day}", f"Q{k % 4 + 1}", y))
    rows.append(("A", "2017-12-31", "Q4", None))
    return spark.createDataFrame(rows, "ticker string, period_end string, fiscal_period string, y double").repartition(3)


def near(rows, keys):
    return {tuple(r[k] for k in keys): {c: -1.0 if v is None or v != v else v for c, v in r.asDict().items() if c not in keys} for r in rows}


def test_forecasts_and_folds_equal_the_models_in_numpy(series):
    for f, keys in ((modelling.forecast, ("ticker", "model", "period_end")), (modelling.cross_validate, ("ticker", "model", "cut"))):
        own, other = (near(x.collect(), keys) for x in (f(series), f(series, modelling.MODELS)))
        assert own.keys() == other.keys() and len(own) > 8
        for k, v in own.items():
            assert v == pytest.approx(other[k], rel=1e-9, abs=1e-6), k


def test_recursive_forecast_equals_a_ridge_in_numpy(series):
    got = {(r.ticker, r.step): r.yhat for r in modelling.recursive_forecast(series).collect()}
    own = {}
    for r in sorted((r for r in series.collect() if r.y is not None), key=lambda r: (r.ticker, r.period_end)):
        own.setdefault(r.ticker, []).append(r.y)
    expected = {}
    for t, y in own.items():
        if len(y) < 8 or t == "Z":
            continue
        y = np.array(y)
        x = np.stack([y[3:-1], y[:-4], np.ones(len(y) - 4)], axis=1)
        b, out = np.linalg.solve(x.T @ x + 1e-6 * np.trace(x.T @ x) / 3 * np.eye(3), x.T @ y[4:]), list(y)
        for k in range(4):
            out.append(max(float(np.dot([out[-1], out[-4], 1.0], b)), 0.5 * out[-1]))
            expected[t, k + 1] = out[-1]
    assert {k: v for k, v in got.items() if k[0] != "Z"} == pytest.approx(expected, rel=1e-6) and {k[0] for k in expected} == {"A", "B", "C"}
