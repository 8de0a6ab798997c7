"""Walk-forward comparison of all models at once.

Every model is tested on the same folds (fold, train_end, test_end; ``forecast.folds``) and sees only what came up to a fold's train_end. The work is dealt so that the panel is
read once for each kind of model, not for each fold and model:

* baselines: rows are joined with the folds that may see them and pre-aggregated before the shuffle, so a fold and series is one short row;
* models of one series: the panel is shuffled once by series, and a task fits each fold and model of a series it has, so rows aren't copied for every fold;
* tree models: features look back only, so that a row's features are the same in every fold. They are computed and written once; a fit reads the rows up to its train_end. One fit over
  stacked folds would let an early fold learn from later periods, so each fold is fitted on its own, some at a time.

Folds without a tested period, and series that begin after train_end, give no rows; a NULL value counts as absent. A model that fails gives rows with its error in place of a forecast, and the others go on.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from multiprocessing.pool import ThreadPool

import numpy as np
import pandas as pd
from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.storage import checkpointed
from .forecast import fitted, metrics
from .models import Trees, autoregression, continued, piecewise_trend, with_index

SERIES_MODELS = {"arima_like": autoregression, "piecewise_trend": piecewise_trend}
TREES = {"forest": {"trees": 20}, "boosted": {"trees": 5}}


def said_by_baselines(panel: DataFrame, series: list[str], cuts: DataFrame) -> DataFrame:
    """naive and drift for all folds in one aggregation."""
    seen = panel.where("value is not null").join(F.broadcast(cuts), F.col("period") <= F.col("train_end"))
    each = fitted(seen, ["fold", "train_end", "test_end", *series]).withColumn("period", F.explode(F.sequence(F.col("train_end") + 1, F.col("test_end"))))
    line = F.when(F.col("n") >= 2, F.coalesce(F.col("intercept") + F.col("slope") * F.col("period"), F.col("last"))).otherwise(F.col("last"))
    both = F.explode(F.create_map(F.lit("naive"), F.col("last"), F.lit("drift"), line)).alias("model", "forecast")
    return each.select("fold", *series, "period", both).withColumn("forecast", F.greatest(F.lit(0.0), "forecast")).withColumns({"method": F.col("model"), "error": F.lit(None).cast("string")})


def said_by_series(panel: DataFrame, series: list[str], cuts: list[tuple[int, int, int]], fits: dict[str, Callable]) -> DataFrame:
    """All folds and models of a series in its task; cuts are (fold, train_end, test_end)."""
    columns = ["model", "fold", *series, "period", "forecast", "method", "error"]

    def one(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.dropna(subset=["value"]).sort_values("period")
        t, v = rows["period"].to_numpy(), rows["value"].to_numpy(float)
        found: dict[str, list] = {c: [] for c in columns}
        for fold, last, end in cuts:
            n, ahead = int(np.searchsorted(t, last, side="right")), list(range(last + 1, end + 1))
            if not n:
                continue
            for name, fit in fits.items():
                try:
                    values, method, error = *continued(t[:n], v[:n], ahead, name, fit), None
                except Exception as e:  # a model's failure is a row, and costs the other models nothing
                    values, method, error = np.full(len(ahead), np.nan), None, f"{type(e).__name__}: {e}"
                one_each = {"model": name, "fold": fold, **{c: rows[c].iloc[0] for c in series}, "method": method, "error": error}
                for c in columns:
                    found[c] += ahead if c == "period" else values.tolist() if c == "forecast" else [one_each[c]] * len(ahead)
        return pd.DataFrame(found, dtype=object)  # an empty column of numbers is no array of strings

    kinds = dict(panel.dtypes)
    schema = ", ".join(["model string", "fold int", *(f"`{c}` {kinds[c]}" for c in series), "period int", "forecast double", "method string", "error string"])
    out = panel.select(*series, "period", F.col("value").cast("double").alias("value")).groupBy(*series).applyInPandas(one, schema)
    return out.withColumn("forecast", F.when(F.col("error").isNull(), F.col("forecast")))


def said_by_trees(panel: DataFrame, series: list[str], cuts: list[tuple[int, int, int]], kinds: dict[str, dict], at_once: int = 4) -> list[DataFrame]:
    """A fit for each kind and fold over shared features, ``at_once`` of them at a time."""
    known = checkpointed(with_index(panel, series))
    spark, types = panel.sparkSession, dict(panel.dtypes)

    def one(job: tuple[str, dict, tuple[int, int, int]]) -> DataFrame:
        kind, parameters, (fold, last, end) = job
        try:
            train = panel.where((F.col("period") <= last) & F.col("value").isNotNull())
            said = Trees(kind, **parameters).fit_features(known.where(F.col("period") <= last)).predict(train, series, list(range(last + 1, end + 1)), end=last)
            return said.select(F.lit(kind).alias("model"), F.lit(fold).alias("fold"), *series, "period", "forecast", "method", F.lit(None).cast("string").alias("error"))
        except Exception as e:  # as above
            schema = ", ".join(["model string", "fold int", *(f"`{c}` {types[c]}" for c in series), "period int", "forecast double", "method string", "error string"])
            return spark.createDataFrame([(kind, fold, *[None] * len(series), None, None, None, f"{type(e).__name__}: {e}")], schema)

    jobs = [(k, p, c) for k, p in kinds.items() for c in cuts]
    if not jobs:
        return []
    with ThreadPool(min(at_once, len(jobs))) as pool:
        return pool.map(inheritable_thread_target(spark)(one), jobs)


def walk_forward_all(panel: DataFrame, series: list[str], cuts: DataFrame, fits: dict[str, Callable] | None = None, kinds: dict[str, dict] | None = None) -> DataFrame:
    """model, fold, series, period, actual, forecast, method (the model, or naive where it fell back) and error, of the baselines, the models of one series and the tree models.
    cuts has a row for each fold (fold, train_end, test_end), which is at most one for each period."""
    listed = [(int(r.fold), int(r.train_end), int(r.test_end)) for r in cuts.collect() if r.test_end > r.train_end]
    few = panel.sparkSession.createDataFrame(listed, "fold int, train_end int, test_end int")
    parts = [said_by_baselines(panel, series, few), said_by_series(panel, series, listed, SERIES_MODELS if fits is None else fits)]
    parts += said_by_trees(panel, series, listed, TREES if kinds is None else kinds)
    actual = panel.where("value is not null").select(*series, "period", F.col("value").cast("double").alias("actual"))
    said = reduce(DataFrame.unionByName, parts).join(actual, [*series, "period"], "left").where("actual is not null or error is not null")
    return said.select("model", "fold", *series, "period", "actual", "forecast", "method", "error")


def scores(said: DataFrame) -> DataFrame:
    """Each model's metrics over its forecasts (n), share of fallbacks, failures, one error text, and its rank by mape; a model without forecasts comes last."""
    made = F.col("error").isNull()
    fell = F.avg(F.when(made, (F.col("method") != F.col("model")).cast("double")))
    per = said.groupBy("model").agg(*[c.alias(n) for n, c in metrics(F.col("actual"), F.col("forecast")).items()], F.count_if(made).alias("n"), fell.alias("fallback_share"), F.count("error").alias("failures"), F.min("error").alias("error"))
    return per.withColumn("mostly_fallback", F.col("fallback_share") > 0.5).withColumn("rank", F.row_number().over(Window.orderBy(F.col("mape").asc_nulls_last(), "model")))
