"""Demand forecasts: ARIMA(1,1,1) and additive Holt-Winters, fitted per series.

Sales fold to one row per series and day first, so a group is as long as the
calendar. Many series fit in parallel. ARIMA parameters maximise the exact Gaussian
likelihood of the daily changes, whose filter for one autoregressive and one moving-average
term is a scalar recursion. Holt-Winters parameters minimise the squared one-step errors
jointly with the start values: for given smoothing weights errors are linear in these, so
they come from least squares and only the weights are searched. Fits can be kept
as a table and forecast from later.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemart.operators.features import filled_days
from lakemart.session import shuffle_width

ALL = "ALL"
PERIOD = 12
Z95 = 1.959963984540054
FIT_COLUMNS = ("series string, model string, n int, p1 double, p2 double, p3 double, mse double, rmse double, aic double, "
               "bic double, status string, last_date date, sigma2 double, state array<double>")
FORECAST_COLUMNS = "series string, model string, step int, date date, forecast double, lower double, upper double, status string"


def daily_by_series(sales: DataFrame, series: str, value: str = "TotalRevenue") -> DataFrame:
    """(series, Date, value) per day with gaps as zero, for every series and for all together.

    One scan: each day's total counts for its series and for the grand total.
    """
    days = sales.groupBy(F.col(series).cast("string").alias("name"), F.col("InvoiceDate").alias("Date")).agg(
        F.sum(value).alias("value")
    )
    both = days.select(F.explode(F.array("name", F.lit(ALL))).alias("series"), "Date", "value")
    totals = both.groupBy("series", "Date").agg(F.sum("value").cast("double").alias("value"))
    return filled_days(totals, ["value"], ["series"])


def arima_filter(y: np.ndarray, phi, theta):
    """One-step errors of the daily changes for arrays of (phi, theta), from the first change on.

    Returns the log likelihood with the variance at its best, that variance, the sum of squared errors, and the
    last error over its relative variance, which is what the next change answers to.
    """
    phi, theta = np.asarray(phi, dtype=float), np.asarray(theta, dtype=float)
    # variances are in units of the noise's: of a change unseen, then given all before it
    variance = (1 + 2 * phi * theta + theta ** 2) / (1 - phi ** 2)
    expected = np.zeros_like(phi)
    sse, weighted, logs = np.zeros_like(phi), np.zeros_like(phi), np.zeros_like(phi)
    scaled = np.zeros_like(phi)
    changes = np.diff(y)
    for now in changes:
        error = now - expected
        scaled = error / variance
        sse, weighted, logs = sse + error * error, weighted + error * scaled, logs + np.log(variance)
        expected = phi * now + theta * scaled
        variance = 1 + theta ** 2 - theta ** 2 / variance
    n = max(len(changes), 1)
    sigma2 = np.maximum(weighted / n, 1e-300)
    return -0.5 * (n * (np.log(2 * np.pi * sigma2) + 1) + logs), sigma2, sse, scaled


def fit_arima(y: np.ndarray) -> dict:
    """Exact maximum likelihood: the best point of a grid over the stationary, invertible square, narrowed."""
    centre, step = (0.0, 0.0), 0.1
    grid = np.arange(-0.9, 0.91, 0.1)
    for _ in range(6):
        phi, theta = np.meshgrid(centre[0] + grid, centre[1] + grid, indexing="ij")
        keep = (np.abs(phi) < 0.9999) & (np.abs(theta) < 0.9999)
        phi, theta = phi[keep], theta[keep]
        likelihood, sigma2, sse, last = arima_filter(y, phi, theta)
        best = int(np.argmax(likelihood))
        centre, step = (phi[best], theta[best]), step / 4
        grid = np.arange(-5, 6) * step
    ll, k, n = float(likelihood[best]), 3, max(len(y) - 1, 1)
    mse = (float(y[0]) ** 2 + float(sse[best])) / len(y)     # the first day has no forecast and counts as one of zero
    change = float(y[-1] - y[-2]) if len(y) > 1 else 0.0
    return {"p": (float(centre[0]), float(centre[1]), None), "sigma2": float(sigma2[best]), "mse": mse,
            "aic": 2 * k - 2 * ll, "bic": k * float(np.log(n)) - 2 * ll, "state": [float(y[-1]), change, float(last[best])]}


def arima_forecast(fit: dict, steps: int) -> tuple[np.ndarray, np.ndarray]:
    """Point forecasts and their standard errors from the psi weights."""
    phi, theta = fit["p"][:2]
    level, change, answered = fit["state"]
    points = []
    for _ in range(steps):
        change = phi * change + theta * answered
        answered = 0.0
        level += change
        points.append(level)
    j = np.arange(steps)
    psi = 1.0 + (phi + theta) * np.where(abs(1 - phi) > 1e-12, (1 - phi ** j) / (1 - phi), j)
    return np.array(points), np.sqrt(fit["sigma2"] * np.cumsum(psi ** 2))


def smoothing_sse(y: np.ndarray, alpha, beta, gamma, period: int = PERIOD) -> np.ndarray:
    """Squared errors of additive smoothing for arrays of weights, started from the means of the first periods."""
    size = np.shape(alpha)
    first, second = y[:period], y[period:2 * period]
    level = np.full(size, first.mean())
    trend = np.full(size, (second.mean() - first.mean()) / period if len(second) == period else 0.0)
    season = [np.full(size, v - first.mean()) for v in first]
    sse = np.zeros(size)
    for t, now in enumerate(y):
        e = now - (level + trend + season[t % period])
        sse = sse + e * e
        level, trend = level + trend + alpha * e, trend + alpha * beta * e
        season[t % period] = season[t % period] + gamma * (1 - alpha) * e
    return sse


def smoothing_fit(y: np.ndarray, alpha, beta, gamma, period: int = PERIOD):
    """For arrays of weights: least squared errors over all start values, and the state after the last day.

    A run over ``y`` from zero and runs over zeros from each unit start go side by side; errors add up linearly.
    """
    count, starts = len(alpha), period + 2
    a, ab, g = alpha[:, None], (alpha * beta)[:, None], (gamma * (1 - alpha))[:, None]
    level, trend = np.zeros((count, starts + 1)), np.zeros((count, starts + 1))
    season = np.zeros((period, count, starts + 1))
    level[:, 0] = trend[:, 1] = 1.0
    season[np.arange(period), :, 2 + np.arange(period)] = 1.0
    errors = np.empty((len(y), count, starts + 1))
    for t, now in enumerate(y):
        e = errors[t]
        np.negative(level + trend + season[t % period], out=e)
        e[:, starts] += now
        level = level + trend + a * e
        trend = trend + ab * e
        season[t % period] += g * e
    unit, run = errors[:, :, :starts], errors[:, :, starts]
    normal = np.einsum("tki,tkj->kij", unit, unit, optimize=True)
    moment = np.einsum("tki,tk->ki", unit, run, optimize=True)
    # level and seasons may shift against each other: the least such start is taken
    start = -np.einsum("kij,kj->ki", np.linalg.pinv(normal, rcond=1e-12, hermitian=True), moment)
    left = run + np.einsum("tki,ki->tk", unit, start, optimize=True)
    weights = np.concatenate([start, np.ones((count, 1))], axis=1)
    state = np.concatenate([(level * weights).sum(axis=1)[:, None], (trend * weights).sum(axis=1)[:, None],
                            (season * weights).sum(axis=2).T], axis=1)
    return (left ** 2).sum(axis=0), state


def _narrowed(objective, centre: tuple, half: float, count: int, rounds: int, shrink: float) -> tuple:
    """Weights of the least value on a grid around the best so far, again and again."""
    for _ in range(rounds):
        axes = [np.unique(np.clip(np.append(np.linspace(c - half, c + half, count), c), 0.0001, 0.9999)) for c in centre]
        a, b, g = [m.ravel() for m in np.meshgrid(*axes, indexing="ij")]
        best = int(np.argmin(objective(a, b, g)))
        centre, half = (a[best], b[best], g[best]), half / shrink
    return centre


def fit_holt_winters(y: np.ndarray, period: int = PERIOD) -> dict:
    """Weights and start values of the least squared error: a grid from plain start values, then with fitted ones."""
    scale = float(np.abs(y).max()) or 1.0
    z = y / scale
    centre = _narrowed(lambda *w: smoothing_sse(z, *w, period), (0.5, 0.5, 0.5), 0.48, 7, 4, 3.0)
    centre = _narrowed(lambda *w: smoothing_fit(z, *w, period)[0], centre, 0.16, 3, 8, 2.0)
    sse, state = smoothing_fit(z, *[np.array([c]) for c in centre], period)
    n, k = len(y), period + 4                  # start values of level, trend and seasons, with the weights but one
    total = float(sse[0]) * scale * scale
    base = n * float(np.log(max(total / n, 1e-300)))
    state = (state[0] * scale).tolist()
    seasons = state[2:]
    # seasons in the order of the coming days
    return {"p": tuple(float(c) for c in centre), "sigma2": total / n, "mse": total / n, "aic": base + 2 * k,
            "bic": base + k * float(np.log(n)), "state": [*state[:2], *[seasons[(n + i) % period] for i in range(period)]]}


def holt_winters_forecast(fit: dict, steps: int) -> tuple[np.ndarray, np.ndarray]:
    level, trend, *seasons = fit["state"]
    period = len(seasons)
    h = np.arange(1, steps + 1)
    season = np.array([seasons[i % period] for i in range(steps)])
    alpha, beta, gamma = fit["p"]
    j = np.arange(1, steps)
    c = alpha * (1 + j * beta) + gamma * (1 - alpha) * (j % period == 0)
    spread = np.concatenate([[1.0], 1.0 + np.cumsum(c ** 2)])
    return level + h * trend + season, np.sqrt(fit["sigma2"] * spread)


# days a model needs: a difference and its predecessor, or two whole periods
LEAST_DAYS = {"ARIMA": 3, "HoltWinters": 2 * PERIOD}
FITTED, TOO_SHORT = "fitted", "too short"
MODELS = {"ARIMA": (fit_arima, arima_forecast), "HoltWinters": (fit_holt_winters, holt_winters_forecast)}


def _grouped(series: DataFrame):
    """Groups spread over all shuffle partitions: fitting costs far more than its few bytes suggest."""
    return series.repartition(shuffle_width(series.sparkSession), "series").groupBy("series")


def _names(columns: str) -> list[str]:
    return [c.split()[0] for c in columns.split(", ")]


def fit_models(series: DataFrame, models: tuple[str, ...] = ("ARIMA", "HoltWinters")) -> DataFrame:
    """Parameters, error measures and end state per series and model; a series too short for a model says so in its
    status. The result can be written and forecast from later.
    """

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("Date")
        y = pdf["value"].to_numpy(dtype=float)
        name, last, rows = pdf["series"].iloc[0], pdf["Date"].iloc[-1], []
        for model in models:
            if len(y) < LEAST_DAYS[model]:
                rows.append((name, model, len(y), *[None] * 7, TOO_SHORT, last, None, None))
                continue
            got = MODELS[model][0](y)
            rows.append((name, model, len(y), *got["p"], got["mse"], got["mse"] ** 0.5, got["aic"], got["bic"], FITTED,
                         last, got["sigma2"], got["state"]))
        return pd.DataFrame(rows, columns=_names(FIT_COLUMNS))

    return _grouped(series).applyInPandas(fit, FIT_COLUMNS)


def forecast_from(fits: DataFrame, steps: int = 30, start: str | None = None) -> DataFrame:
    """Daily forecasts with 95 % limits from kept fits, from ``start`` or the day after the last one.

    A fit of a series too short gives one row without step and values.
    """
    columns = _names(FORECAST_COLUMNS)

    def predict(batches):
        for batch in batches:
            parts = []
            for row in batch.itertuples(index=False):
                if row.status != FITTED:
                    parts.append(pd.DataFrame([{"series": row.series, "model": row.model, "status": row.status}], columns=columns))
                    continue
                points, error = MODELS[row.model][1](
                    {"p": (row.p1, row.p2, row.p3), "sigma2": row.sigma2, "state": list(row.state)}, steps)
                first = pd.Timestamp(start) if start else pd.Timestamp(row.last_date) + pd.Timedelta(days=1)
                parts.append(pd.DataFrame({
                    "series": row.series, "model": row.model, "step": np.arange(1, steps + 1),
                    "date": pd.date_range(first, periods=steps).date, "forecast": points,
                    "lower": points - Z95 * error, "upper": points + Z95 * error, "status": FITTED,
                }))
            if parts:
                made = pd.concat(parts)[columns].astype(object)
                yield made.where(made.notna(), None)

    return fits.mapInPandas(predict, FORECAST_COLUMNS)


def forecast(series: DataFrame, steps: int = 30, start: str | None = None,
             models: tuple[str, ...] = ("ARIMA", "HoltWinters")) -> DataFrame:
    """Fit and forecast in one go."""
    return forecast_from(fit_models(series, models), steps, start)
