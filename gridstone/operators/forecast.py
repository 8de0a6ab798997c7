"""Forecasts of panels (series, period, value): baselines, leak-free features, walk-forward folds, and a comparison of models."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def metrics(actual: Column, forecast: Column) -> dict[str, Column]:
    """mae, rmse, mape and smape as aggregates; a division by almost 0 is left out."""
    off, size = F.abs(actual - forecast), F.abs(actual) + F.abs(forecast)
    return {
        "mae": F.avg(off),
        "rmse": F.sqrt(F.avg(off * off)),
        "mape": F.avg(F.when(F.abs(actual) >= 1e-9, off / F.abs(actual) * 100)),
        "smape": F.avg(F.when(size >= 1e-9, off * 200 / size)),
    }


def fitted(train: DataFrame, series: list[str]) -> DataFrame:
    """What the baselines need of each series: its last value, endpoint slope and least-squares line."""
    t, y = F.col("period").cast("double"), F.col("value").cast("double")
    a = train.groupBy(*series).agg(
        F.max_by("value", "period").cast("double").alias("last"), F.min_by("value", "period").cast("double").alias("first"), F.max("period").alias("p1"), F.min("period").alias("p0"),
        F.count(F.lit(1)).alias("n"), F.sum(t).alias("st"), F.sum(y).alias("sy"), F.sum(t * t).alias("stt"), F.sum(t * y).alias("sty"),
    )
    slope = F.try_divide(F.col("n") * F.col("sty") - F.col("st") * F.col("sy"), F.col("n") * F.col("stt") - F.col("st") * F.col("st"))
    return a.withColumn("slope", slope).withColumn("intercept", F.try_divide(F.col("sy") - F.col("slope") * F.col("st"), F.col("n"))).withColumn("endpoint", F.try_divide(F.col("last") - F.col("first"), F.col("p1") - F.col("p0")))


def baselines(fits: DataFrame, series: list[str], period: Column) -> DataFrame:
    """naive, naive with endpoint drift, and trend forecasts at period, never below 0."""
    line = F.when(F.col("n") >= 2, F.coalesce(F.col("intercept") + F.col("slope") * period, F.col("last"))).otherwise(F.col("last"))
    drift = F.col("last") + F.coalesce("endpoint", F.lit(0.0)) * (period - F.col("p1"))
    zero = lambda c: F.greatest(F.lit(0.0), c)
    return fits.select(*series, period.alias("period"), zero(F.col("last")).alias("naive"), zero(drift).alias("naive_drift"), zero(line).alias("trend"))


def forecast(panel: DataFrame, series: list[str], horizons: list[int]) -> DataFrame:
    """Baseline forecasts ``horizons`` periods after the panel's end."""
    end = panel.agg(F.max("period").alias("end"))
    ahead = fitted(panel, series).crossJoin(F.broadcast(end)).withColumn("h", F.explode(F.array(*[F.lit(h) for h in horizons])))
    return baselines(ahead, series, F.col("end") + F.col("h"))


def features(panel: DataFrame, series: list[str]) -> DataFrame:
    """Lags, mean, growth and trend from earlier periods only, on a complete grid: a gap gives NULL, not the row before."""
    ends = panel.agg(F.min("period").alias("a"), F.max("period").alias("b"))
    grid = panel.select(*series).distinct().crossJoin(F.broadcast(ends)).select(*series, F.explode(F.sequence("a", "b")).alias("period"))
    w = Window.partitionBy(*series).orderBy("period")
    lag = lambda n: F.lag("value", n).over(w)
    full = grid.join(panel, [*series, "period"], "left").withColumn("value", F.col("value").cast("double"))
    return full.select(
        *series, "period", "value", lag(1).alias("lag_1"), lag(2).alias("lag_2"), lag(3).alias("lag_3"),
        F.round(F.avg("value").over(w.rowsBetween(-3, -1)), 6).alias("rolling_mean_3"),
        F.try_divide(lag(1) - lag(2), lag(2)).alias("growth"),
        ((lag(1) - lag(5)) / 4).alias("trend"),
    )


def folds(panel: DataFrame, least_train: int, step: int | None = None) -> DataFrame:
    """fold, train_end and test_end over the periods that occur, whatever gaps are between them: windows that begin with ``least_train`` periods and expand by
    ``step`` (a sixth of them all by default), each tested on the periods that follow it. There is a row for each period at most, so one task orders them."""
    seen = panel.select("period").distinct()
    places = seen.withColumn("i", F.row_number().over(Window.orderBy("period"))).withColumn("n", F.count(F.lit(1)).over(Window.partitionBy()))
    wide = F.greatest(F.lit(1), F.floor(F.col("n") / 6).cast("int")) if step is None else F.lit(step)
    ends = places.where((F.col("i") >= least_train) & (F.col("i") < F.col("n")) & ((F.col("i") - least_train) % wide == 0)).withColumn("j", F.least(F.col("i") + wide, F.col("n")))
    last = places.select(F.col("i").alias("j"), F.col("period").alias("test_end"))
    return ends.join(F.broadcast(last), "j").select(F.row_number().over(Window.orderBy("period")).alias("fold"), F.col("period").alias("train_end"), "test_end")


def walk_forward(panel: DataFrame, series: list[str], least_train: int, step: int) -> DataFrame:
    """model, mae, rmse, mape, smape and n of the baselines over all folds at once: one row for each fold, series and tested period."""
    cut = F.broadcast(folds(panel, least_train, step))
    train = panel.join(cut, F.col("period") <= F.col("train_end"))
    test = panel.join(cut, (F.col("period") > F.col("train_end")) & (F.col("period") <= F.col("test_end"))).select("fold", *series, F.col("period").alias("at"), F.col("value").cast("double").alias("actual"))
    keys = ["fold", *series]
    said = baselines(fitted(train, keys).join(test, keys).withColumn("period_", F.col("at")), [*keys, "actual"], F.col("period_"))
    long = said.select("actual", F.explode(F.create_map(*[x for m in ("naive", "naive_drift", "trend") for x in (F.lit(m), F.col(m))])).alias("model", "forecast"))
    return long.groupBy("model").agg(*[F.round(c, 6).alias(n) for n, c in metrics(F.col("actual"), F.col("forecast")).items()], F.count(F.lit(1)).alias("n"))


def champion(comparison: DataFrame) -> DataFrame:
    """The best model by mape if it beats the naive one, else naive."""
    naive = comparison.where("model = 'naive'").select(F.col("mape").alias("naive_mape"))
    best = comparison.where("model not like 'naive%'").agg(F.min_by("model", "mape").alias("best"), F.min("mape").alias("best_mape"))
    return best.crossJoin(naive).select(F.when(F.col("best_mape") < F.col("naive_mape"), F.col("best")).otherwise("naive").alias("model"), "best_mape", "naive_mape")


def breaks(panel: DataFrame, series: list[str], threshold: float = 0.15) -> DataFrame:
    """Periods, from a series' third row on, that deviate from the mean of up to three rows before by threshold or more. deviation_pct has a sign: a fall is negative."""
    w = Window.partitionBy(*series).orderBy("period")
    a = panel.select("*", F.avg("value").over(w.rowsBetween(-3, -1)).alias("past"), F.row_number().over(w).alias("n"))
    off = (F.col("value") - F.col("past")) / F.col("past")
    return a.where((F.col("n") >= 3) & (F.col("past") > 0) & (F.abs(off) >= threshold)).select(*series, "period", "value", F.round(off * 100, 6).alias("deviation_pct"))
