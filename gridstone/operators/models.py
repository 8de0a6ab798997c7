"""Forecast models over panels (series columns, period, value), their recursion over horizons, and the table of final forecasts.

Grouped models fit one series in one task, so the number of series is what scales; a series is as long as its periods. The tree model is one for all series,
on features of earlier periods only, the same in training and in scoring; it forecasts step by step and sees its own forecasts as lags, which are an array in one row for each series. Every model returns the series
columns, period, forecast (never below 0) and method (what made it: the model, or naive where a series is too short or a fit fails).
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.storage import checkpointed
from .forecast import champion, features, fitted

FEATURES = ["lag_1", "lag_2", "lag_3", "rolling_mean_3", "growth", "trend", "index"]
LEAST = 8
#: How many periods back the features look, and after how many steps a recursion's plan is cut.
LAGS, CUT = 5, 24


def autoregression(y: np.ndarray, steps: int, most: int = 3) -> np.ndarray | None:
    """Forecasts of an ARIMA (p, 1, q), p and q up to ``most`` and not both 0, fitted by regression on lags and on residuals of a long
    autoregression; the order with the least AIC. All orders are compared on the same observations, and the chosen one is fitted to all that it can use; a short
    series allows lower orders only. Coefficients whose recursion would explode are drawn in. None where nothing can be fitted."""
    d = np.diff(y)
    long = min(most + 1, len(d) // 3)
    if long < 1:
        return None
    lagged = lambda x, k, at: np.column_stack([x[at - j] for j in range(1, k + 1)]) if k else np.empty((len(at), 0))
    at = np.arange(long, len(d))
    e = np.zeros(len(d))
    x = np.column_stack([np.ones(len(at)), lagged(d, long, at)])
    e[at] = d[at] - x @ np.linalg.lstsq(x, d[at], rcond=None)[0]

    def fitted(p: int, q: int, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        x = np.column_stack([np.ones(len(rows)), lagged(d, p, rows), lagged(e, q, rows)])
        beta = np.linalg.lstsq(x, d[rows], rcond=None)[0]
        return beta, d[rows] - x @ beta

    order = chosen_order(len(d), long, most, fitted)
    if order is None:
        return None
    p, q = order
    rows = np.arange(max(p, long + q), len(d))
    beta, noise = fitted(p, q, rows)
    beta = np.concatenate([beta[:1], bounded(beta[1 : p + 1], 1), bounded(beta[p + 1 :], -1)])
    d, e = list(d), list(e)
    for r, n in zip(rows, noise, strict=True):
        e[r] = n
    out, level = [], y[-1]
    for _ in range(steps):
        step = beta[0] + sum(beta[j] * d[-j] for j in range(1, p + 1)) + sum(beta[p + j] * e[-j] for j in range(1, q + 1))
        d.append(step), e.append(0.0)
        level += step
        out.append(level)
    return np.array(out) if np.all(np.isfinite(out)) else None


def bounded(beta: np.ndarray, sign: int, to: float = 0.98) -> np.ndarray:
    """Coefficients of x(t) = sign * (beta[0] x(t-1) + ...), with all roots drawn in alike where the largest one lies beyond 1: forecasts over many steps stay bounded (on lags),
    and residuals can be told from the values (on residuals)."""
    largest = np.abs(np.roots([1.0, *(-sign * beta)])).max(initial=0.0)
    return beta if largest <= 1 + 1e-9 else beta * (to / largest) ** np.arange(1, len(beta) + 1)


def chosen_order(n: int, long: int, most: int, fitted: Callable) -> tuple[int, int] | None:
    """(p, q) of the least AIC over n differences. The highest order is lowered until the observations that all orders share are enough for one of them."""
    for bound in range(most, 0, -1):
        rows = np.arange(long + bound, n)
        orders = [(p, q) for p in range(bound + 1) for q in range(bound + 1) if 0 < p + q <= len(rows) - 3]
        if len(rows) >= bound + 3 and orders:
            noises = {o: fitted(*o, rows)[1] for o in orders}
            return min(orders, key=lambda o: (len(rows) * np.log(max(noises[o] @ noises[o] / len(rows), 1e-12)) + 2 * (sum(o) + 1), o))
    return None


def piecewise_trend(y: np.ndarray, steps: int, knots: int = 5, penalty: float = 1.0) -> np.ndarray | None:
    """A line that may bend at evenly spaced places of the first four fifths, bends shrunk towards none."""
    n = len(y)
    scale = np.abs(y).max() or 1.0
    bends = np.linspace(0, 0.8 * (n - 1), knots + 2)[1:-1]
    basis = lambda t: np.column_stack([np.ones(len(t)), t / n, np.maximum(0, t[:, None] - bends[None, :]) / n])
    x, shrink = basis(np.arange(n, dtype=float)), np.diag([0.0, 0.0] + [penalty] * knots)
    out = basis(np.arange(n, n + steps, dtype=float)) @ np.linalg.solve(x.T @ x + shrink + 1e-9 * np.eye(knots + 2), x.T @ (y / scale)) * scale
    return out if np.all(np.isfinite(out)) else None


def continued(t: np.ndarray, v: np.ndarray, ahead: list[int], name: str, fit: Callable[[np.ndarray, int], np.ndarray | None]) -> tuple[np.ndarray, str]:
    """Forecasts of one series at the periods ``ahead``, never below 0, and what made them. Gaps are interpolated first; a short series, or one that can't be fitted, keeps its last value."""
    steps, said = ahead[-1] - int(t[-1]), None
    if len(v) >= LEAST and steps > 0:
        try:
            said = fit(np.interp(np.arange(t[0], t[-1] + 1), t, v), steps)
        except np.linalg.LinAlgError:
            said = None
    values = [float(v[-1]) if said is None or p <= t[-1] else float(said[p - int(t[-1]) - 1]) for p in ahead]
    return np.maximum(0.0, values), "naive" if said is None else name


def by_series(name: str, fit: Callable[[np.ndarray, int], np.ndarray | None]):
    """A grouped model from a function of a gapless series and a number of steps."""

    def fit_predict(train: DataFrame, series: list[str], periods: list[int]) -> DataFrame:
        ahead = sorted(periods)

        def one(rows: pd.DataFrame) -> pd.DataFrame:
            rows = rows.dropna(subset=["value"]).sort_values("period")
            if not len(rows):
                return pd.DataFrame({c: [] for c in [*series, "period", "forecast", "method"]}, dtype=object)  # an empty column of numbers is no array of strings
            values, method = continued(rows["period"].to_numpy(), rows["value"].to_numpy(float), ahead, name, fit)
            return pd.DataFrame({**{c: rows[c].iloc[0] for c in series}, "period": np.array(ahead, np.int32), "forecast": values, "method": method})

        kinds = dict(train.dtypes)
        schema = ", ".join([*(f"`{c}` {kinds[c]}" for c in series), "period int", "forecast double", "method string"])
        return train.select(*series, "period", F.col("value").cast("double").alias("value")).groupBy(*series).applyInPandas(one, schema)

    return fit_predict


arima_like = by_series("arima_like", autoregression)
piecewise = by_series("piecewise_trend", piecewise_trend)


def naive(train: DataFrame, series: list[str], periods: list[int]) -> DataFrame:
    each = F.explode(F.array(*[F.lit(p) for p in periods])).alias("period")
    return fitted(train, series).select(*series, each, F.greatest(F.lit(0.0), F.col("last")).alias("forecast"), F.lit("naive").alias("method"))


def drift(train: DataFrame, series: list[str], periods: list[int]) -> DataFrame:
    each = fitted(train, series).withColumn("period", F.explode(F.array(*[F.lit(p) for p in periods])))
    line = F.when(F.col("n") >= 2, F.coalesce(F.col("intercept") + F.col("slope") * F.col("period"), F.col("last"))).otherwise(F.col("last"))
    return each.select(*series, "period", F.greatest(F.lit(0.0), line).alias("forecast"), F.lit("drift").alias("method"))


def with_index(panel: DataFrame, series: list[str]) -> DataFrame:
    """Features of each period and series, with the period itself and the series' key."""
    return features(panel, series).withColumn("index", F.col("period").cast("double")).withColumn("series_", F.concat_ws("_", *series))


def lag_state(panel: DataFrame, series: list[str], end: int) -> DataFrame:
    """A row for each series with its values at ``end`` and the periods before, the newest first, NULL where there is none."""
    at = lambda period: F.max(F.when(F.col("period") == period, F.col("value").cast("double")))
    return panel.groupBy(*series).agg(F.array(*[at(end - i) for i in range(LAGS)]).alias("lags_"))


def state_features(period: int) -> dict[str, Column]:
    """The features of ``forecast.features`` at a period, from the values before it."""
    one, two, three, five = (F.col("lags_")[i] for i in (0, 1, 2, 4))
    count = sum((F.when(x.isNull(), 0).otherwise(1) for x in (three, two, one)), F.lit(0))
    total = sum((F.coalesce(x, F.lit(0.0)) for x in (three, two, one)), F.lit(0.0))
    return {
        "lag_1": one, "lag_2": two, "lag_3": three, "rolling_mean_3": F.round(F.try_divide(total, count), 6),
        "growth": F.try_divide(one - two, two), "trend": (one - five) / 4, "index": F.lit(float(period)),
    }


class Trees:
    """One tree model for all series (Spark ML): random forest or gradient-boosted trees."""

    def __init__(self, kind: str = "forest", trees: int = 50, depth: int = 5, seed: int = 7):
        self.kind, self.trees, self.depth, self.seed = kind, trees, depth, seed
        self.model = None

    def fit(self, panel: DataFrame, series: list[str]) -> Trees:
        return self.fit_features(checkpointed(with_index(panel, series)))

    def fit_features(self, known: DataFrame) -> Trees:
        """As fit, from a written table of ``with_index``, so that several fits can share it; a fit reads it once for each level of a tree."""
        from pyspark.ml import Pipeline
        from pyspark.ml.feature import VectorAssembler
        from pyspark.ml.regression import GBTRegressor, RandomForestRegressor

        rows = known.where("value is not null").dropna(subset=FEATURES)
        if rows.limit(20).count() < 20:  # too few to learn from: forecasts are naive
            return self
        assembler = VectorAssembler(inputCols=FEATURES, outputCol="x", handleInvalid="skip")
        named = {"featuresCol": "x", "labelCol": "value", "predictionCol": "forecast", "maxDepth": self.depth, "seed": self.seed}
        model = RandomForestRegressor(numTrees=self.trees, **named) if self.kind == "forest" else GBTRegressor(maxIter=self.trees, **named)
        self.model = Pipeline(stages=[assembler, model]).fit(rows)
        return self

    def importance(self, spark) -> DataFrame:
        """feature and its share, the largest first; nothing without a model."""
        found = [] if self.model is None else sorted(zip(FEATURES, map(float, self.model.stages[-1].featureImportances.toArray()), strict=True), key=lambda x: -x[1])
        total = sum(x for _, x in found) or 1.0
        return spark.createDataFrame([(f, x / total) for f, x in found], "feature string, importance double")

    def predict(self, panel: DataFrame, series: list[str], periods: list[int], end: int | None = None) -> DataFrame:
        """Step by step from ``end`` (the panel's last period) to the last of ``periods``: each step is a projection of the row of a series, whose forecasts are the
        next step's lags. A feature that isn't known is 0. The only shuffle brings each series' last values together; the plan is cut every ``CUT`` steps."""
        from pyspark.ml.feature import VectorAssembler

        if self.model is None:
            return naive(panel, series, periods)
        end = panel.agg(F.max("period")).first()[0] if end is None else end
        # no rows are skipped here: a filter would be pushed through all steps before it, and their trees with it
        assembler, model = VectorAssembler(inputCols=FEATURES, outputCol="x", handleInvalid="keep"), self.model.stages[-1]
        state = lag_state(panel, series, end).withColumn("said_", F.array().cast("array<double>"))
        for period in range(end + 1, max(periods) + 1):
            now = state.withColumns(state_features(period)).fillna(0.0, subset=FEATURES)
            new = F.array(F.greatest(F.lit(0.0), F.col("forecast")))
            state = model.transform(assembler.transform(now)).select(*series, F.slice(F.concat(new, "lags_"), 1, LAGS).alias("lags_"), F.concat("said_", new).alias("said_"))
            if (period - end) % CUT == 0:
                state = checkpointed(state)
        out = state.select(*series, F.posexplode("said_").alias("step_", "forecast")).withColumn("period", F.col("step_") + F.lit(end + 1))
        return out.where(F.col("period").isin(*periods)).select(*series, "period", "forecast", F.lit(self.kind).alias("method"))


def trees(kind: str, **parameters):
    return lambda train, series, periods: Trees(kind, **parameters).fit(train, series).predict(train, series, periods)


MODELS = {"naive": naive, "drift": drift, "arima_like": arima_like, "piecewise_trend": piecewise, "forest": trees("forest"), "boosted": trees("boosted", trees=20)}


def evaluate(panel: DataFrame, series: list[str], cuts: list[tuple[int, list[int]]], models: dict[str, Callable] | None = None) -> tuple[DataFrame, dict[str, str]]:
    """model, series, period, actual, forecast and method over folds (the last training period, and the tested periods); and the errors of models
    that failed, which are left out. The folds are few; each is a job over all series."""
    found, failed = [], {}
    for name, model in (models or MODELS).items():
        try:
            folds = [model(panel.where(F.col("period") <= last), series, tested) for last, tested in cuts]
            said = reduce(DataFrame.unionByName, folds).join(panel.select(*series, "period", F.col("value").cast("double").alias("actual")), [*series, "period"])
            found.append(said.select(F.lit(name).alias("model"), *series, "period", "actual", "forecast", "method"))
        except Exception as e:  # one model's failure mustn't cost the others; the caller gets its text
            failed[name] = f"{type(e).__name__}: {e}"
    if not found:
        raise ValueError(f"every model failed: {failed}")
    return reduce(DataFrame.unionByName, found), failed


def comparison(said: DataFrame) -> DataFrame:
    """Each model's metrics, predictions, share of fallbacks, whether most are fallbacks, and its rank by mape."""
    from .forecast import metrics

    fell = F.avg((F.col("method") != F.col("model")).cast("double"))
    per = said.groupBy("model").agg(*[c.alias(n) for n, c in metrics(F.col("actual"), F.col("forecast")).items()], F.count(F.lit(1)).alias("n"), fell.alias("fallback_share"))
    return per.withColumn("mostly_fallback", F.col("fallback_share") > 0.5).withColumn("rank", F.row_number().over(Window.orderBy("mape", "model")))


def final_forecasts(panel: DataFrame, series: list[str], champion: DataFrame, baseline: DataFrame, most: float = 10.0) -> DataFrame:
    """Champion and baseline side by side with the latest observation, the change against it (NULL where it is 0) and whether the forecast is implausible: over
    ``most`` times the largest value observed."""
    seen = panel.groupBy(*series).agg(F.max("period").alias("latest_period"), F.max_by("value", "period").cast("double").alias("latest_observed"), F.max("value").cast("double").alias("largest"))
    both = champion.select(*series, "period", "forecast").join(baseline.select(*series, "period", F.col("forecast").alias("baseline_forecast")), [*series, "period"], "full").join(seen, series)
    change = F.when(F.col("latest_observed") != 0, (F.col("forecast") - F.col("latest_observed")) / F.col("latest_observed") * 100)
    return both.select(*series, "period", "forecast", "baseline_forecast", "latest_period", "latest_observed", change.alias("change_vs_latest_pct"), (F.col("forecast") > F.col("largest") * most).alias("is_implausible"))


def against_baseline(finals: DataFrame) -> DataFrame:
    """The forecasts with what the model adds to the baseline."""
    return finals.withColumn("model_uplift", F.col("forecast") - F.col("baseline_forecast"))


def champion_forecasts(panel: DataFrame, series: list[str], periods: list[int], compared: DataFrame, models: dict[str, Callable] | None = None) -> DataFrame:
    """Forecasts of the model that won a comparison, with its name: one row of the comparison decides which one is fitted to the whole panel."""
    name = champion(compared).first()["model"]
    return (models or MODELS)[name](panel, series, periods).withColumn("model", F.lit(name))
