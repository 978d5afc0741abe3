"""Forecasting: folds, features, dependency-free models, regularised regression, bootstrap.

The two model libraries of the original workflow are not installed here; two models with the same
output columns, as window expressions, stand in for them: `seasonal` (last year's quarter times recent yearly growth) and
`trend` (damped linear trend). Any callable from a pandas series to values can be passed instead."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import growth
from .timeseries import filled, period_return, series_averages

HORIZON = 4
COLUMNS = "ticker string, model string, period_end string, yhat double, yhat_lower_80 double, yhat_upper_80 double, yhat_lower_95 double, yhat_upper_95 double"


def folds(series: DataFrame, horizon: int = HORIZON, least: int = 8, n: int = 3) -> DataFrame:
    """Expanding-window cuts of each ticker's series: (ticker, cut), the number of rows to train on.
    From max(least, two thirds) to the length less the horizon, evenly spaced, one if they are equal."""
    rows = series.groupBy("ticker").agg(F.count("*").alias("n_"))
    low, high = F.greatest(F.lit(least), F.floor(F.col("n_") * 2 / 3)).cast("int"), (F.col("n_") - horizon).cast("int")
    rows = rows.withColumn("low_", low).withColumn("high_", high).where("high_ >= low_")
    spaced = F.array(*(F.floor(F.col("low_") + (F.col("high_") - F.col("low_")) * k / (n - 1)).cast("int") for k in range(n)))
    return rows.select("ticker", F.explode(F.array_distinct(spaced)).alias("cut"))


def features(series: DataFrame, aligned: DataFrame | None = None) -> DataFrame:
    """series: ticker, period_end, fiscal_period, y. Lags, lagged yearly growth, season and trend, and
    with `aligned` (from `macro_features`) the four macro columns, filled forward and then backward
    within the ticker; rows without all of them are dropped. Growth is lagged by one quarter, so no
    row knows its target."""
    w = Window.partitionBy("ticker").orderBy("period_end")
    rows = series.withColumns({
        "lag1": F.lag("y", 1).over(w), "lag4": F.lag("y", 4).over(w), "growth4": growth(F.lag("y", 1).over(w), F.lag("y", 5).over(w)),
        "trend": (F.row_number().over(w) - 1).cast("double"), **{f"is_{q.lower()}": (F.col("fiscal_period") == q).cast("double") for q in ("Q2", "Q3", "Q4")},
    })
    if aligned is None:
        return rows.na.drop(subset=["y", *FEATURES])
    rows = filled(rows.join(aligned, ["ticker", "period_end"], "left"), ["ticker"], "period_end", list(MACROS))
    return rows.na.drop(subset=["y", *FEATURES, *MACROS])


def macro_features(series: DataFrame, macro: DataFrame, prices: DataFrame, funds: DataFrame, months: int = 3) -> DataFrame:
    """ticker, period_end and MACROS for each quarter of series (ticker, period_end).

    macro: series_id, date, value; its three series are averaged over the `months` up to the quarter's end.
    prices: symbol, date, close; funds: ticker, symbol, the fund whose return over the same months is etf_return.
    Series are the same for all tickers, so they are averaged once for each date, not for each ticker."""
    end = F.col("period_end").cast("date")
    own = series.select("ticker", "period_end", F.add_months(end, -months).alias("start"), end.alias("end")).distinct()
    means = series_averages(own.select("start", "end").distinct(), macro, MACROS[:3])
    asked = own.join(funds.select("ticker", "symbol"), "ticker")
    returns = period_return(asked.select("symbol", "start", "end").distinct(), prices, ["symbol"]).select("symbol", "start", "end", F.col("return").alias(MACROS[3]))
    returns = asked.join(returns, ["symbol", "start", "end"]).select("ticker", "period_end", MACROS[3])
    return own.join(means, ["start", "end"], "left").join(returns, ["ticker", "period_end"], "left").select("ticker", "period_end", *MACROS)


FEATURES = ["lag1", "lag4", "growth4", "trend", "is_q2", "is_q3", "is_q4"]
# Names of the macro features.
MACROS = ("VIXCLS", "INDPRO", "T10Y2Y", "etf_return")


def seasonal(y: np.ndarray, horizon: int) -> np.ndarray:
    """Last year's quarter times the latest yearly growth, held flat."""
    rate = y[-4:].sum() / y[-8:-4].sum() if len(y) >= 8 and y[-8:-4].sum() > 0 else 1.0
    out = list(y)
    for _ in range(horizon):
        out.append(out[-4] * rate if len(out) >= 4 else out[-1])
    return np.array(out[-horizon:])


def trend(y: np.ndarray, horizon: int, damping: float = 0.9) -> np.ndarray:
    slope = np.polyfit(np.arange(len(y)), y, 1)[0] if len(y) > 1 else 0.0
    return y[-1] + slope * np.cumsum(damping ** np.arange(1, horizon + 1))


MODELS: dict[str, Callable[[np.ndarray, int], np.ndarray]] = {"seasonal": seasonal, "trend": trend}


def _predictions(series: DataFrame, horizon: int, damping: float = 0.9) -> DataFrame:
    """What both models predict after each row of a ticker: ticker, model, period_end, k (rows so far), n (rows in
    all), made (array of the next values) and ahead (what came). Windows carry sums, slope and the last four values."""
    by = Window.partitionBy("ticker").orderBy("period_end")
    so_far = by.rowsBetween(Window.unboundedPreceding, 0)
    own = series.where(F.col("y").isNotNull()).select("ticker", "period_end", F.col("y").cast("double").alias("y")).withColumn("k", F.row_number().over(by))
    year, before = F.sum("y").over(by.rowsBetween(-3, 0)), F.sum("y").over(by.rowsBetween(-7, -4))
    own = own.withColumns({
        "n": F.count("*").over(Window.partitionBy("ticker")), "slope": F.coalesce(F.regr_slope("y", "k").over(so_far), F.lit(0.0)),
        "rate": F.when((F.col("k") >= 8) & (before > 0), year / F.nullif(before, F.lit(0.0))).otherwise(1.0),
        "tail": F.array_compact(F.array(*(F.lag("y", i).over(by) for i in (3, 2, 1)), F.col("y"))), "ahead": F.array(*(F.lead("y", i).over(by) for i in range(1, horizon + 1))),
    })
    steps = F.sequence(F.lit(1), F.lit(horizon))
    grown = F.aggregate(steps, F.col("tail"), lambda s, _: F.array_append(s, F.when(F.size(s) >= 4, F.try_element_at(s, F.lit(-4)) * F.col("rate")).otherwise(F.element_at(s, -1))))
    seasonal_ = F.slice(grown, F.size("tail") + 1, F.lit(horizon))
    trend_ = F.transform(steps, lambda i: F.col("y") + F.col("slope") * damping * (1 - F.pow(F.lit(damping), i)) / (1 - damping))
    models = F.array(F.struct(F.lit("seasonal").alias("model"), seasonal_.alias("made")), F.struct(F.lit("trend").alias("model"), trend_.alias("made")))
    return own.select("ticker", "period_end", "k", "n", "ahead", F.inline(models))


def forecast(series: DataFrame, models: dict[str, Callable] | None = None, horizon: int = HORIZON) -> DataFrame:
    """series: ticker, period_end, y. The next fiscal quarter ends of each ticker with 80 and 95 per
    cent intervals from the spread of the last eight one-step errors. The two models run as expressions; only
    models that are given run as Python, a ticker at a time."""
    if models is None:
        rows = _predictions(series, horizon)
        error = F.when((F.col("k") >= F.greatest(F.lit(4), F.col("n") - 8)) & (F.col("k") < F.col("n")), F.col("ahead")[0] - F.col("made")[0])
        at = F.max_by(F.struct("period_end", "made"), "k")
        rows = rows.groupBy("ticker", "model").agg(F.coalesce(F.stddev_pop(error), F.lit(0.0)).alias("spread"), at.alias("at"))
        end = F.col("at.period_end").cast("date")
        first = F.add_months(end, F.when(F.last_day(end) == end, 3).otherwise(2))
        rows = rows.select("ticker", "model", "spread", first.alias("first"), F.posexplode("at.made").alias("k", "yhat"))
        wide = F.col("spread") * F.sqrt(F.col("k") + 1.0)
        bounds = [(F.col("yhat") + sign * z * wide).alias(f"yhat_{side}_{level}") for level, z in ((80, 1.2816), (95, 1.96)) for side, sign in (("lower", -1), ("upper", 1))]
        return rows.select("ticker", "model", F.last_day(F.add_months("first", F.col("k") * 3)).cast("string").alias("period_end"), "yhat", *bounds)

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("period_end")
        y, out = pdf["y"].to_numpy(dtype=float), []
        dates = pd.date_range(pd.Timestamp(pdf["period_end"].iloc[-1]) + pd.offsets.MonthEnd(3), periods=horizon, freq=pd.offsets.MonthEnd(3))
        for name, model in models.items():
            error = [y[k] - model(y[:k], 1)[0] for k in range(max(4, len(y) - 8), len(y))]
            spread = np.std(error) if error else 0.0
            for k, (d, v) in enumerate(zip(dates, model(y, horizon), strict=True), 1):
                a, b = 1.2816 * spread * np.sqrt(k), 1.96 * spread * np.sqrt(k)
                out.append((pdf["ticker"].iloc[0], name, str(d.date()), float(v), float(v - a), float(v + a), float(v - b), float(v + b)))
        return pd.DataFrame(out, columns=[c.split()[0] for c in COLUMNS.split(", ")])

    return series.where(F.col("y").isNotNull()).groupBy("ticker").applyInPandas(run, COLUMNS)


def cross_validate(series: DataFrame, models: dict[str, Callable] | None = None, horizon: int = HORIZON) -> DataFrame:
    """ticker, model, cut, mae, mape over expanding windows; as expressions unless models are given."""
    if models is None:
        cuts = folds(series.where(F.col("y").isNotNull()), horizon).select("ticker", F.col("cut").alias("k"))
        rows = _predictions(series, horizon).join(cuts, ["ticker", "k"])
        rows = rows.select("ticker", "model", F.col("k").alias("cut"), F.inline(F.arrays_zip("ahead", "made")))
        gap = F.abs(F.col("ahead") - F.col("made"))
        return rows.groupBy("ticker", "model", "cut").agg(F.avg(gap).alias("mae"), F.avg(F.when(F.col("ahead") > 0, gap / F.nullif("ahead", F.lit(0.0)))).alias("mape"))

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        y, n, out = pdf.sort_values("period_end")["y"].to_numpy(dtype=float), len(pdf), []
        low, high = max(8, 2 * n // 3), n - horizon
        for c in sorted({int(low + (high - low) * k / 2) for k in range(3)}) if high >= low else []:
            for name, model in models.items():
                e = np.abs(y[c : c + horizon] - model(y[:c], horizon))
                positive = np.where(y[c : c + horizon] > 0, y[c : c + horizon], np.nan)
                out.append((pdf["ticker"].iloc[0], name, c, float(e.mean()), float(np.nanmean(e / positive)) if (~np.isnan(positive)).any() else None))
        return pd.DataFrame(out, columns=["ticker", "model", "cut", "mae", "mape"])

    return series.where(F.col("y").isNotNull()).groupBy("ticker").applyInPandas(run, "ticker string, model string, cut int, mae double, mape double")


def cv_summary(errors: DataFrame) -> DataFrame:
    return errors.groupBy("model").agg(*(f(c).alias(f"{c}_{n}") for c in ("mae", "mape") for n, f in (("mean", F.avg), ("std", F.stddev_samp))))


def lasso(x: np.ndarray, y: np.ndarray, alpha: float, rounds: int = 200) -> tuple[np.ndarray, float]:
    """Coordinate descent on standardised columns for (1/2n)|y - xb|^2 + alpha|b|_1."""
    n, b, mean = len(y), np.zeros(x.shape[1]), y.mean()
    r, norm = y - mean, (x**2).sum(axis=0) / n
    for _ in range(rounds):
        old = b.copy()
        for j in np.flatnonzero(norm > 1e-12):
            rho = x[:, j] @ r / n + norm[j] * b[j]
            new = np.sign(rho) * max(abs(rho) - alpha, 0.0) / norm[j]
            r += x[:, j] * (b[j] - new)
            b[j] = new
        if np.abs(b - old).max() < 1e-8 * max(1.0, np.abs(b).max()):
            break
    return b, mean


def regularised(rows: DataFrame, alphas: int = 20, seed: int = 42, resamples: int = 200, names: list[str] | None = None) -> DataFrame:
    """Lasso of y on the features, its penalty chosen by up to 3 time-ordered folds, and percentile
    intervals of the coefficients from seeded resamples: ticker, feature, coefficient, low, high."""
    names = names or FEATURES

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("period_end")
        x, y = pdf[names].to_numpy(dtype=float), pdf["y"].to_numpy(dtype=float)
        if len(y) < 6:
            return pd.DataFrame(columns=["ticker", "feature", "coefficient", "low", "high"])
        scale = x.std(axis=0)
        x = (x - x.mean(axis=0)) / np.where(scale > 0, scale, 1)
        top = max(np.abs(x.T @ (y - y.mean())).max() / len(y), 1e-9)
        grid = top * np.logspace(0, -3, alphas)
        k = min(3, len(y) - 1)
        size = len(y) // (k + 1)
        cuts = [len(y) - size * (k - i) for i in range(k)]
        loss = [sum(((y[c : c + size] - x[c : c + size] @ lasso(x[:c], y[:c], a)[0] - y[:c].mean()) ** 2).sum() for c in cuts) for a in grid]
        alpha = grid[int(np.argmin(loss))]
        b, _ = lasso(x, y, alpha)
        random = np.random.default_rng(seed)
        draws = np.array([lasso(x[i], y[i], alpha, 30)[0] for i in (random.integers(0, len(y), len(y)) for _ in range(resamples))])
        low, high = np.percentile(draws, [2.5, 97.5], axis=0)
        return pd.DataFrame({"ticker": pdf["ticker"].iloc[0], "feature": names, "coefficient": b, "low": low, "high": high})

    return rows.groupBy("ticker").applyInPandas(run, "ticker string, feature string, coefficient double, low double, high double")


def by_weight(coefficients: DataFrame) -> DataFrame:
    """Coefficients that are not 0, the greatest by absolute value first within a ticker."""
    return coefficients.where("coefficient != 0").orderBy("ticker", F.abs("coefficient").desc(), "feature")


def _minor(m: list[list[Column]], i: int, j: int) -> Column:
    (a, b), (c, d) = ([x for k, x in enumerate(row) if k != j] for n, row in enumerate(m) if n != i)
    return a * d - b * c


def _solved(m: list[list[Column]], t: list[Column]) -> list[Column]:
    """The solution of a system of three equations, by cofactors."""
    cofactor = [[_minor(m, i, j) * (-1) ** (i + j) for j in range(3)] for i in range(3)]
    whole = m[0][0] * cofactor[0][0] + m[0][1] * cofactor[0][1] + m[0][2] * cofactor[0][2]
    return [(t[0] * cofactor[0][j] + t[1] * cofactor[1][j] + t[2] * cofactor[2][j]) / F.nullif(whole, F.lit(0.0)) for j in range(3)]


def recursive_forecast(rows: DataFrame, horizon: int = HORIZON, floor: float = 0.5, least: int = 8) -> DataFrame:
    """Forecasts that feed on their own predictions, from a ridge of y on its lags 1 and 4; no value
    falls below half of the one before: ticker, step, yhat. Tickers of under `least` values have none.

    The fit needs sums of products only, which are aggregated a ticker; the forecast is a fold over the steps
    whose state is the last four values."""
    by = Window.partitionBy("ticker").orderBy("period_end")
    own = rows.where(F.col("y").isNotNull()).select("ticker", "period_end", F.col("y").cast("double").alias("y"), F.lag("y", 1).over(by).cast("double").alias("a"), F.lag("y", 4).over(by).cast("double").alias("b"))
    full = F.col("b").isNotNull()

    def total(x: Column) -> Column:
        return F.coalesce(F.sum(F.when(full, x)), F.lit(0.0))

    a, b, y, one = F.col("a"), F.col("b"), F.col("y"), F.lit(1.0)
    x = [a, b, one]
    sums = {f"m{i}{j}": total(x[i] * x[j]) for i in range(3) for j in range(i, 3)} | {f"t{i}": total(x[i] * y) for i in range(3)}
    last = F.slice(F.transform(F.array_sort(F.collect_list(F.struct("period_end", "y"))), lambda r: r["y"]), -4, 4)
    fit = own.groupBy("ticker").agg(F.count("*").alias("n"), last.alias("last"), *(v.alias(k) for k, v in sums.items())).where(F.col("n") >= least)
    penalty = 1e-6 * (F.col("m00") + F.col("m11") + F.col("m22")) / 3
    m = [[F.col(f"m{min(i, j)}{max(i, j)}") + (penalty if i == j else 0.0) for j in range(3)] for i in range(3)]
    beta = _solved(m, [F.col(f"t{i}") for i in range(3)])
    fit = fit.select("ticker", "last", F.array(*beta).alias("beta"))

    def step(s: Column, _: Column) -> Column:
        c = F.col("beta")
        ahead = c[0] * F.element_at(s, -1) + c[1] * F.element_at(s, -4) + c[2]
        return F.array_append(s, F.greatest(ahead, floor * F.element_at(s, -1)))

    made = F.slice(F.aggregate(F.sequence(F.lit(1), F.lit(horizon)), F.col("last"), step), 5, horizon)
    return fit.select("ticker", F.posexplode(made).alias("k", "yhat")).select("ticker", (F.col("k") + 1).alias("step"), "yhat")


def percentiles(rows: DataFrame, by: list[str], column: str, at: tuple[float, ...] = (0.025, 0.1, 0.9, 0.975)) -> DataFrame:
    """Interpolated percentiles p025 and so on of a column."""
    return rows.groupBy(*by).agg(*(F.percentile(column, F.lit(p)).alias("p" + f"{p:.3f}"[2:]) for p in at))


def check_forecasts(rows: DataFrame) -> None:
    """Raise unless all columns are there and every prediction is positive."""
    missing = {c.split()[0] for c in COLUMNS.split(", ")} - set(rows.columns)
    if missing:
        raise ValueError(f"forecast columns missing: {sorted(missing)}")
    if rows.where(~(F.col("yhat") > 0) | F.col("yhat").isNull()).limit(1).count():
        raise ValueError("forecasts must be positive")
