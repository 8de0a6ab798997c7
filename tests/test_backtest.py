"""Recursion on the state of lags, folds of all models at once, and rolled-up distinct counts, against plain versions."""

import random

import pytest
from pyspark.sql import functions as F

from gridstone.operators import backtest, forecast, models, sketches


def panel_of(spark):
    rng = random.Random(5)
    rows = [(s, p, 20.0 + 2 * p + rng.randint(-3, 3)) for s in ("a", "b", "c") for p in range(1, 31) if (s, p) not in {("b", 12), ("b", 28), ("c", 29)}]
    rows += [("short", 29, 5.0), ("short", 30, 6.0), ("old", 3, 4.0), ("null", 30, None)]
    return spark.createDataFrame(rows, "s string, period int, value double").cache()


def plain_recursion(trees, panel, end, last):
    """One step at a time on a table of all values, with the features of training."""
    known, found = {(r.s, r.period): r.value for r in panel.collect()}, {}
    for period in range(end + 1, last + 1):
        series = sorted({s for s, _ in known})
        rows = [(s, p, known.get((s, p))) for s in series for p in range(period - 6, period + 1)]
        now = models.with_index(panel.sparkSession.createDataFrame(rows, "s string, period int, value double"), ["s"]).where(F.col("period") == period)
        for r in trees.model.transform(now.fillna(0.0, subset=models.FEATURES)).collect():
            known[r.s, period] = found[r.s, period] = max(0.0, r.forecast)
    return found


@pytest.mark.parametrize("kind", ["forest", "boosted"])
def test_recursion_on_lags_equals_step_by_step(spark, monkeypatch, kind):
    panel = panel_of(spark)
    trees = models.Trees(kind, trees=4, depth=3).fit(panel, ["s"])
    want = plain_recursion(trees, panel, 30, 34)
    assert {(r.s, r.period): r.forecast for r in trees.predict(panel, ["s"], [31, 32, 33, 34]).collect()} == pytest.approx(want)
    assert {(r.s, r.period): r.forecast for r in trees.predict(panel, ["s"], [33]).collect()} == pytest.approx({k: v for k, v in want.items() if k[1] == 33})
    monkeypatch.setattr(models, "CUT", 2)
    assert {(r.s, r.period): r.forecast for r in trees.predict(panel, ["s"], [31, 32, 33, 34]).collect()} == pytest.approx(want)
    assert trees.predict(panel, ["s"], [30]).count() == 0


def test_recursion_is_one_shuffle(spark):
    panel = panel_of(spark)
    said = models.Trees("forest", trees=4, depth=3).fit(panel, ["s"]).predict(panel, ["s"], [36], end=30)
    assert said._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1


def test_folds_of_all_models_equal_models_run_one_by_one(spark):
    panel = panel_of(spark)
    cuts = spark.createDataFrame([(1, 20, 23), (2, 26, 30), (3, 30, 30)], "fold int, train_end int, test_end int")
    kinds = {"forest": {"trees": 3, "depth": 2}}
    got = {(r.model, r.fold, r.s, r.period): (r.forecast, r.method, r.actual) for r in backtest.walk_forward_all(panel, ["s"], cuts, kinds=kinds).collect()}
    whole, want = {(r.s, r.period): r.value for r in panel.collect() if r.value is not None}, {}
    each = {"naive": models.naive, "drift": models.drift, "arima_like": models.arima_like, "piecewise_trend": models.piecewise, "forest": models.trees("forest", trees=3, depth=2)}
    for fold, last, end in ((1, 20, 23), (2, 26, 30)):
        for name, model in each.items():
            for r in model(panel.where((F.col("period") <= last) & F.col("value").isNotNull()), ["s"], list(range(last + 1, end + 1))).collect():
                if (r.s, r.period) in whole:
                    want[name, fold, r.s, r.period] = (r.forecast, r.method, whole[r.s, r.period])
    assert got.keys() == want.keys()
    for k, (f, method, actual) in want.items():
        if k[0] == "forest":  # bootstrap samples depend on the order of rows
            assert got[k][1:] == (method, actual) and 0 < got[k][0] < 150
        else:
            assert got[k] == (pytest.approx(f), method, actual), k
    nulls = models.arima_like(panel.where("s in ('null', 'a')"), ["s"], [31]).collect()
    assert [r.s for r in nulls] == ["a"]


def test_folds_do_not_see_later_periods(spark):
    panel = panel_of(spark)
    cuts = spark.createDataFrame([(1, 20, 23)], "fold int, train_end int, test_end int")
    changed = panel.withColumn("value", F.when(F.col("period") > 20, F.col("value") * 100).otherwise(F.col("value")))
    kinds = {"forest": {"trees": 3, "depth": 2}}
    one, two = ({(r.model, r.s, r.period): r.forecast for r in backtest.walk_forward_all(x, ["s"], cuts, kinds=kinds).collect()} for x in (panel, changed))
    assert one == two


def test_failed_models_are_rows(spark):
    def broken(y, steps):
        raise ZeroDivisionError("no")

    said = backtest.walk_forward_all(panel_of(spark), ["s"], spark.createDataFrame([(1, 26, 30)], "fold int, train_end int, test_end int"), {"broken": broken}, {"forest": {"trees": -1}})
    table = {r.model: r for r in backtest.scores(said).collect()}
    assert set(table) == {"naive", "drift", "broken", "forest"}
    assert table["broken"].failures and "ZeroDivisionError" in table["broken"].error and table["forest"].n == 0 and table["forest"]["rank"] == 4
    assert table["drift"]["rank"] == 1 and table["drift"].failures == 0 and table["drift"].n == table["naive"].n


def test_scores_equal_plain_ones(spark):
    rows = [("m", 1, "a", 1, 10.0, 8.0, "m", None), ("m", 1, "a", 2, 0.0, 2.0, "naive", None), ("m", 1, "b", 1, 4.0, 5.0, "naive", None), ("m", 2, None, None, None, None, None, "x")]
    r = backtest.scores(spark.createDataFrame(rows, "model string, fold int, s string, period int, actual double, forecast double, method string, error string")).first()
    assert (r.n, r.failures, r.error, r.mostly_fallback) == (3, 1, "x", True)
    assert (r.mae, r.rmse, r.mape, r.smape, r.fallback_share) == pytest.approx((5 / 3, 3**0.5, (20 + 25) / 2, (400 / 18 + 200 + 200 / 9) / 3, 2 / 3))


def test_the_champion_forecasts(spark):
    panel = panel_of(spark).where("s in ('a', 'b', 'c')")
    compared = backtest.scores(backtest.walk_forward_all(panel, ["s"], forecast.folds(panel, 20, 5), kinds={}))
    name = min((r for r in compared.collect() if r.model != "naive"), key=lambda r: r.mape).model
    got = {(r.s, r.period): (r.forecast, r.model) for r in models.champion_forecasts(panel, ["s"], [31, 33], compared).collect()}
    want = {(r.s, r.period): (r.forecast, name) for r in models.MODELS[name](panel, ["s"], [31, 33]).collect()}
    assert got == want and len(got) == 6


def test_rolled_up_distinct_counts(spark):
    rows = spark.range(60000).selectExpr("cast(id % 3 as string) as g", "cast(id % 5 as int) as y", "case when id % 100 <> 7 then id * 7919 % 20011 end as who")
    kept = sketches.sketched(rows.where("y < 3"), ["g", "y"], "who", 12)
    kept = sketches.added(kept, sketches.sketched(rows.where("y >= 3"), ["g", "y"], "who", 12), ["g", "y"])
    assert kept.count() == 15
    sets = [["g", "y"], ["g"], ["y"], []]
    got = {(r.g, r.y): r.estimate for r in sketches.rolled_up(kept, ["g", "y"], sets).collect()}
    want = {(r.g, r.y): r.n for r in rows.groupingSets(sets, "g", "y").agg(F.countDistinct("who").alias("n")).collect()}
    assert got.keys() == want.keys() and len(got) == 24
    assert max(abs(got[k] - n) / n for k, n in want.items()) < 4 * sketches.standard_error(12)
    few = spark.createDataFrame([("a", 1), ("a", 1), ("a", None), ("b", None)], "g string, who int")
    assert {r.g: r.estimate for r in sketches.rolled_up(sketches.sketched(few, ["g"], "who"), ["g"], [["g"]]).collect()} == {"a": 1, "b": 0}
