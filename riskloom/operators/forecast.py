"""Per-company forecasts through a model table.

Whatever the backend, a fitted model is one row: `base + slope * step + season[step mod 7]`,
a residual spread and whether the interval widens. Fitting runs per company calendar;
predicting is a plain projection of that table, and saving a model is writing it."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from riskloom.config import INTERVAL_Z, SEASON_DAYS
from riskloom.operators.joins import align_backtest
from riskloom.operators.layout import spread
from riskloom.operators.preparation import split_by_holdout

MODEL_SCHEMA = (
    "company_id string, model_type string, last_date date, last_value double, n_rows bigint, "
    "residual_std double, base double, slope double, season array<double>, widens boolean"
)
BACKENDS = {"prophet": "trend_seasonal", "auto": "trend_seasonal",
            "trend_seasonal": "trend_seasonal", "ets": "ets", "holt_winters": "ets",
            "seasonal_naive": "seasonal_naive"}
HINGES = 25
HINGE_RANGE = 0.8
HINGE_SCALE = 0.05
FOURIER_ORDER = 3
TINY = 1e-9


def resolve_backend(model_type: str) -> str:
    backend = BACKENDS.get(model_type.lower())
    if backend is None:
        raise ValueError("model_type must be one of: prophet, ets, seasonal_naive, auto")
    return backend


def fit_seasonal_naive(train: DataFrame, value: str = "revenue") -> DataFrame:
    """Model table of the weekly repeat; fewer than seven rows repeat the last value."""
    ascending = Window.partitionBy("company_id").orderBy("date")
    recency = F.row_number().over(Window.partitionBy("company_id").orderBy(F.col("date").desc()))
    y = F.col(value).cast("double")
    rows = train.select(
        "company_id", "date", y.alias("y"),
        (y - F.lag(y, SEASON_DAYS).over(ascending)).alias("residual"), recency.alias("recency"),
    )
    tail = F.when(F.col("recency") <= SEASON_DAYS, F.struct((-F.col("recency")).alias("r"), "y"))
    fitted = rows.groupBy("company_id").agg(
        F.max("date").alias("last_date"), F.max_by("y", "date").alias("last_value"),
        F.count(F.lit(1)).alias("n_rows"), F.stddev_pop("residual").alias("s1"),
        F.stddev_pop("y").alias("s0"), F.sort_array(F.collect_list(tail)).alias("tail"),
    )
    full = F.col("n_rows") >= SEASON_DAYS
    flat = F.array_repeat(F.lit(0.0), SEASON_DAYS)
    return fitted.select(
        "company_id", F.lit("seasonal_naive").alias("model_type"), "last_date", "last_value",
        "n_rows",
        F.when(F.col("n_rows") > SEASON_DAYS, F.col("s1")).otherwise(F.col("s0")).alias("residual_std"),
        F.when(full, F.lit(0.0)).otherwise(F.col("last_value")).alias("base"),
        F.lit(0.0).alias("slope"),
        F.when(full, F.transform("tail", lambda t: t["y"])).otherwise(flat).alias("season"),
        F.lit(True).alias("widens"),
    )


def fit_naive(train: DataFrame, value: str = "revenue") -> DataFrame:
    """Model table of the last value carried forward."""
    return train.groupBy("company_id").agg(
        F.max("date").alias("last_date"),
        F.max_by(F.col(value).cast("double"), "date").alias("last_value"),
        F.count(F.lit(1)).alias("n_rows"),
    ).select(
        "company_id", F.lit("naive").alias("model_type"), "last_date", "last_value", "n_rows",
        F.lit(0.0).alias("residual_std"), F.col("last_value").alias("base"),
        F.lit(0.0).alias("slope"), F.array_repeat(F.lit(0.0), SEASON_DAYS).alias("season"),
        F.lit(True).alias("widens"),
    )


def _smooth(y: np.ndarray, alpha, beta, gamma, season0, level0, trend0):
    """Additive smoothing for many parameter sets at once; returns errors and end states."""
    level = np.full_like(alpha, level0)
    trend = np.full_like(alpha, trend0)
    season = None if season0 is None else np.repeat(season0[:, None], len(alpha), axis=1)
    squares = np.zeros_like(alpha)
    for t, value in enumerate(y):
        s = 0.0 if season is None else season[t % SEASON_DAYS]
        error = value - (level + trend + s)
        squares += error * error
        step = level + trend
        level = step + alpha * error
        trend = trend + alpha * beta * error
        if season is not None:
            season[t % SEASON_DAYS] = s + gamma * (1 - alpha) * error
    return squares, level, trend, season


def fit_smoothing(y: np.ndarray) -> dict | None:
    """Holt-Winters with weekly season from two full weeks on; shrinking grid search."""
    n = len(y)
    if n < 3:
        return None
    weekly = n >= 2 * SEASON_DAYS
    if weekly:
        first, second = y[:SEASON_DAYS], y[SEASON_DAYS:2 * SEASON_DAYS]
        trend0 = float((second.mean() - first.mean()) / SEASON_DAYS)
        centre = (SEASON_DAYS - 1) / 2.0
        season0 = first - (first.mean() + trend0 * (np.arange(SEASON_DAYS) - centre))
        level0 = float(first.mean() - trend0 * (centre + 1))
    else:
        season0, trend0 = None, float((y[-1] - y[0]) / (n - 1))
        level0 = float(y[0] - trend0)
    axes = [np.linspace(0.02, 0.98, 7), np.linspace(0.0, 0.6, 5),
            np.linspace(0.0, 0.9, 6) if weekly else np.array([0.0])]
    best = None
    for _ in range(4):
        a, b, g = (m.ravel() for m in np.meshgrid(*axes, indexing="ij"))
        squares, level, trend, season = _smooth(y, a, b, g, season0, level0, trend0)
        i = int(np.argmin(np.where(np.isfinite(squares), squares, np.inf)))
        if not np.isfinite(squares[i]):
            return None
        if best is None or squares[i] < best["sse"]:
            best = {"sse": float(squares[i]), "base": float(level[i]), "slope": float(trend[i]),
                    "at": (a[i], b[i], g[i]),
                    "season": None if season is None else season[:, i].copy()}
        widths = [(ax[1] - ax[0]) * 0.75 if len(ax) > 1 else 0.0 for ax in axes]
        axes = [
            np.unique(np.clip(np.linspace(c - w, c + w, 5), 0.0, 1.0)) if w else ax
            for c, w, ax in zip(best["at"], widths, axes)
        ]
    a, b, g = (np.array([v]) for v in best["at"])
    fitted = _one_step(y, a, b, g, season0, level0, trend0)
    season = best["season"]
    coming = np.zeros(SEASON_DAYS) if season is None else np.roll(season, -(n % SEASON_DAYS))
    return {"residual_std": float(np.std(y - fitted)), "base": best["base"],
            "slope": best["slope"], "season": coming.tolist(), "widens": True}


def _one_step(y, alpha, beta, gamma, season0, level0, trend0) -> np.ndarray:
    level, trend = level0, trend0
    season = None if season0 is None else season0.copy()
    fitted = np.empty(len(y))
    a, b, g = float(alpha[0]), float(beta[0]), float(gamma[0])
    for t, value in enumerate(y):
        s = 0.0 if season is None else season[t % SEASON_DAYS]
        fitted[t] = level + trend + s
        error = value - fitted[t]
        level, trend = level + trend + a * error, trend + a * b * error
        if season is not None:
            season[t % SEASON_DAYS] = s + g * (1 - a) * error
    return fitted


def _weekly_terms(day: np.ndarray) -> np.ndarray:
    angles = 2 * np.pi * np.outer(day / SEASON_DAYS, np.arange(1, FOURIER_ORDER + 1))
    return np.hstack([np.sin(angles), np.cos(angles)])


def fit_trend(day: np.ndarray, y: np.ndarray) -> dict | None:
    """Piecewise-linear trend with shrunken hinges plus a weekly cycle, by ridge regression."""
    n = len(y)
    span = float(day[-1] - day[0]) if n else 0.0
    if n < 2 or span <= 0:
        return None
    scale = float(np.max(np.abs(y))) or 1.0
    t, target = (day - day[0]) / span, y / scale
    n_hinges = min(HINGES, int(np.floor(n * HINGE_RANGE)) - 1)
    knots = np.linspace(0, HINGE_RANGE, n_hinges + 1)[1:] if n_hinges > 0 else np.empty(0)
    hinges = np.maximum(t[:, None] - knots[None, :], 0.0)
    design = np.hstack([np.ones((n, 1)), t[:, None], hinges, _weekly_terms(day)])
    gram, moment = design.T @ design, design.T @ target
    noise = float(np.std(target)) or 1.0
    for _ in range(3):
        prior = np.concatenate([
            [1e-8, (noise / 5.0) ** 2], np.full(len(knots), (noise / HINGE_SCALE) ** 2),
            np.full(2 * FOURIER_ORDER, (noise / 10.0) ** 2),
        ]) + 1e-10
        weights = np.linalg.solve(gram + np.diag(prior), moment)
        noise = max(float(np.std(target - design @ weights)), 1e-6)
    if not np.all(np.isfinite(weights)):
        return None
    slopes, cycle = weights[1:2 + len(knots)], weights[2 + len(knots):]
    end = weights[0] + slopes[0] * t[-1] + float(np.maximum(t[-1] - knots, 0.0) @ slopes[1:])
    coming = _weekly_terms(day[-1] + np.arange(1, SEASON_DAYS + 1)) @ cycle
    return {"residual_std": float(np.std(y - design @ weights * scale)), "base": float(end * scale),
            "slope": float(slopes.sum() / span * scale), "season": (coming * scale).tolist(),
            "widens": False}


def _repeat_last_week(y: np.ndarray) -> dict:
    lagged = y[SEASON_DAYS:] - y[:-SEASON_DAYS] if len(y) > SEASON_DAYS else y
    full = len(y) >= SEASON_DAYS
    return {"residual_std": float(np.std(lagged)), "base": 0.0 if full else float(y[-1]), "slope": 0.0,
            "season": y[-SEASON_DAYS:].tolist() if full else [0.0] * SEASON_DAYS, "widens": True}


def _fit_company(chain: list[str], value: str):
    """Fit one company's calendar, taking the first backend of the chain that works."""

    def fit(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("date")
        y = pdf[value].to_numpy(dtype=float)
        day = pd.to_datetime(pdf["date"]).map(pd.Timestamp.toordinal).to_numpy(dtype=float)
        model, used = None, "seasonal_naive"
        for backend in chain:
            try:
                if backend == "trend_seasonal":
                    model = fit_trend(day, y)
                elif backend == "ets":
                    model = fit_smoothing(y)
            except (np.linalg.LinAlgError, FloatingPointError):
                model = None
            if model is not None and np.isfinite([model["base"], model["slope"], *model["season"]]).all():
                used = backend
                break
            model = None
        model = model or _repeat_last_week(y)
        return pd.DataFrame([{
            "company_id": key[0], "model_type": used, "last_date": pdf["date"].iloc[-1],
            "last_value": y[-1], "n_rows": len(y), **model,
        }])[["company_id", "model_type", "last_date", "last_value", "n_rows", "residual_std",
             "base", "slope", "season", "widens"]]

    return fit


def train_forecast(train: DataFrame, model_type: str = "prophet", value: str = "revenue") -> DataFrame:
    """Model table with the backend that was used: trend, then smoothing, then weekly repeat."""
    backend = resolve_backend(model_type)
    if backend == "seasonal_naive":
        return fit_seasonal_naive(train, value)
    chain = ["trend_seasonal", "ets"] if backend == "trend_seasonal" else ["ets"]
    rows = train.select("company_id", "date", F.col(value).cast("double").alias(value)).where(
        F.col(value).isNotNull()
    )
    return spread(rows, "company_id").groupBy("company_id").applyInPandas(_fit_company(chain, value), MODEL_SCHEMA)


def future_dates(models: DataFrame, horizon: int | Column) -> DataFrame:
    """The steps and days after each model's last training day."""
    steps = F.sequence(F.lit(1), horizon if isinstance(horizon, Column) else F.lit(horizon))
    return models.withColumn("step", F.explode(steps)).withColumn(
        "date", F.date_add("last_date", F.col("step"))
    )


def order_bounds(forecast: DataFrame) -> DataFrame:
    return forecast.withColumns({
        "lower_bound": F.least("lower_bound", "forecast"),
        "upper_bound": F.greatest("upper_bound", "forecast"),
    })


def predict(models: DataFrame, horizon: int | Column = 30) -> DataFrame:
    """`(company_id, step, date, forecast, lower_bound, upper_bound, model_type)`."""
    if isinstance(horizon, int) and horizon <= 0:
        raise ValueError("horizon_days must be positive")
    steps = future_dates(models, horizon)
    step = F.col("step")
    point = F.col("base") + F.col("slope") * step + F.get(
        "season", F.pmod(step - 1, F.lit(SEASON_DAYS))
    )
    margin = F.lit(INTERVAL_Z) * F.col("residual_std") * F.when(
        F.col("widens"), F.sqrt(step.cast("double"))
    ).otherwise(1.0)
    rows = steps.select(
        "company_id", "step", "date", point.alias("forecast"), (point - margin).alias("lower_bound"),
        (point + margin).alias("upper_bound"), "model_type",
    )
    return order_bounds(rows)


def forecast_seasonal_naive(train: DataFrame, horizon: int = 30, value: str = "revenue") -> DataFrame:
    return predict(fit_seasonal_naive(train, value), horizon)


def forecast_naive(train: DataFrame, horizon: int = 30, value: str = "revenue") -> DataFrame:
    return predict(fit_naive(train, value), horizon)


def forecast_holt_winters(train: DataFrame, horizon: int = 30, value: str = "revenue") -> DataFrame:
    return predict(train_forecast(train, "ets", value), horizon)


def forecast_trend_seasonal(train: DataFrame, horizon: int = 30, value: str = "revenue") -> DataFrame:
    return predict(train_forecast(train, "trend_seasonal", value), horizon)


def holdout_steps(split: DataFrame, value: str = "revenue") -> DataFrame:
    """Held-out rows numbered from 1 by date."""
    return split.where("is_test").select(
        "company_id", (F.col("holdout_days") - F.col("recency") + 1).alias("step"), "date",
        F.col(value).cast("double").alias("actual"),
    )


def evaluate_forecast(forecast: DataFrame, holdout: DataFrame, last_values: DataFrame) -> DataFrame:
    """Errors, coverage and the comparison with the last value carried forward.

    Zero actuals are left out of the percentage error."""
    rows = forecast.join(
        holdout.select("company_id", "step", "actual"), ["company_id", "step"]
    ).join(last_values.select("company_id", "last_value"), "company_id")
    actual = F.col("actual")
    safe = F.when(F.abs(actual) >= TINY, actual)

    def errors(guess: Column, prefix: str) -> list[Column]:
        e = actual - guess
        return [
            F.avg(F.abs(e)).alias(f"{prefix}mae"), F.sqrt(F.avg(e * e)).alias(f"{prefix}rmse"),
            (F.avg(F.abs(F.try_divide(e, safe))) * 100).alias(f"{prefix}mape"),
        ]

    inside = actual.between(F.col("lower_bound"), F.col("upper_bound"))
    return rows.groupBy("company_id", "model_type").agg(
        *errors(F.col("forecast"), ""), F.avg(inside.cast("double")).alias("coverage"),
        F.count(F.lit(1)).alias("horizon_days"), *errors(F.col("last_value"), "naive_"),
    ).withColumns({
        "mape_improvement_pp": F.col("naive_mape") - F.col("mape"),
        "beats_naive": F.coalesce(F.col("mape") < F.col("naive_mape"), F.lit(False)),
    })


def backtest_and_project(daily: DataFrame, model_type: str = "prophet", holdout_days: int = 30,
                         value: str = "revenue") -> DataFrame:
    """Forecast over the held-out rows and as many days again; only the first half has actuals."""
    return backtest_by_holdout(daily.withColumn("holdout_days", F.lit(holdout_days)), model_type, value)


def backtest_by_holdout(daily: DataFrame, model_type: str = "prophet", value: str = "revenue") -> DataFrame:
    """As `backtest_and_project`, with the company's holdout in `holdout_days`; companies too
    short for it give no rows."""
    split = split_by_holdout(
        daily.where("holdout_days > 0").select("company_id", "date", "holdout_days", value)
    ).where("skipped_reason is null")
    models = train_forecast(split.where("not is_test"), model_type, value)
    spans = split.groupBy("company_id").agg(F.first("holdout_days").alias("h"))
    predicted = predict(models.join(spans, "company_id"), F.col("h") * 2)
    aligned = align_backtest(predicted, holdout_steps(split, value))
    return aligned.select(
        "company_id", "step", "date", "actual", "forecast", "lower_bound", "upper_bound",
        "is_projection", "model_type",
    )


def compare_backends(daily: DataFrame, backends: list[str], holdout_days: int = 30,
                     value: str = "revenue") -> DataFrame:
    """Mean holdout metrics per backend over all companies."""
    split = split_by_holdout(daily.withColumn("holdout_days", F.lit(holdout_days))).where(
        "skipped_reason is null"
    )
    train, holdout = split.where("not is_test"), holdout_steps(split, value)
    last = fit_naive(train, value)
    out = None
    for backend in backends:
        models = last if backend == "naive" else train_forecast(train, backend, value)
        scored = evaluate_forecast(predict(models, holdout_days), holdout, last)
        row = scored.withColumn("backend", F.lit(backend))
        out = row if out is None else out.unionByName(row)
    return out.groupBy("backend").agg(
        F.count(F.lit(1)).alias("companies"), F.avg("mae").alias("mae"), F.avg("rmse").alias("rmse"),
        F.avg("mape").alias("mape"), F.avg("coverage").alias("coverage"),
        F.count_if("beats_naive").alias("beats_naive"),
    )


def project_saved(daily: DataFrame, models: DataFrame, holdout_days: int = 30,
                  value: str = "revenue") -> DataFrame:
    """Backtest and projection from a saved model table trained without the held-out days."""
    split = split_by_holdout(
        daily.withColumn("holdout_days", F.lit(holdout_days)).select(
            "company_id", "date", "holdout_days", value
        )
    ).where("skipped_reason is null")
    aligned = align_backtest(predict(models, holdout_days * 2), holdout_steps(split, value))
    return aligned.select(
        "company_id", "step", "date", "actual", "forecast", "lower_bound", "upper_bound",
        "is_projection", "model_type",
    )
