from __future__ import annotations

import datetime as dt
import math

import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from tickloom.operators import model, series

SCHEMA = "entity string, ts timestamp, id long, price double"


def series_of(spark, prices: dict[str, list[float]], step_minutes=47):
    start = dt.datetime(2026, 5, 11, 9, 5)
    rows = [
        (e, start + dt.timedelta(minutes=step_minutes * i), i, float(p))
        for e, ps in prices.items()
        for i, p in enumerate(ps)
    ]
    return spark.createDataFrame(rows, SCHEMA)


def random_prices(seed, names, n=40):
    rng = np.random.default_rng(seed)
    return {e: (1000 * (k + 1) + np.cumsum(rng.normal(0, 5, n))).tolist() for k, e in enumerate(names)}


def test_closed_form_equals_mllib(spark):
    split = series.split_by_time(series.ml_features(series_of(spark, random_prices(3, "ab")))).cache()
    fitted = {r.entity: r for r in model.fit(split).collect()}
    scores = {r.entity: r for r in model.metrics(split, model.fit(split)).collect()}
    for entity in "ab":
        rows = split.where(f"entity = '{entity}'").selectExpr(
            "double(time_idx) t", "double(hour) h", "price", "is_train"
        )
        train, test = rows.where("is_train"), rows.where("not is_train")
        fit = Pipeline(
            stages=[
                VectorAssembler(inputCols=["t", "h"], outputCol="raw"),
                StandardScaler(inputCol="raw", outputCol="x", withMean=True, withStd=True),
                LinearRegression(featuresCol="x", labelCol="price", maxIter=100, regParam=0.01),
            ]
        ).fit(train)
        ours, lr = fitted[entity], fit.stages[-1]
        assert ours.coef_time == pytest.approx(lr.coefficients[0], rel=1e-9)
        assert ours.coef_hour == pytest.approx(lr.coefficients[1], rel=1e-9)
        assert ours.intercept == pytest.approx(lr.intercept, rel=1e-12)
        for name, part in (("train", train), ("test", test)):
            predicted = fit.transform(part)
            for metric in ("r2", "rmse", "mae"):
                want = RegressionEvaluator(labelCol="price", metricName=metric).evaluate(predicted)
                assert scores[entity][f"{metric}_{name}"] == pytest.approx(want, rel=1e-8)


def test_ridge_sum_equals_normal_equations(spark):
    prices = random_prices(9, "c")
    split = series.split_by_time(series.ml_features(series_of(spark, prices)))
    got = model.fit(split, penalty="ridge_sum").first()
    pdf = split.where("is_train").orderBy("time_idx").toPandas()
    x = pdf[["time_idx", "hour"]].to_numpy(float)
    x = (x - x.mean(0)) / x.std(0)
    y = pdf.price.to_numpy()
    w = np.linalg.solve(x.T @ x + 0.01 * np.eye(2), x.T @ (y - y.mean()))
    assert (got.coef_time, got.coef_hour) == pytest.approx(tuple(w), rel=1e-9)
    assert got.intercept == pytest.approx(y.mean())


# Published models of 25 ticks as coefficient per deviation of the
# index, intercept and the five forecast prices.
PUBLISHED = [
    (-30.953356, 13536.15, [13453, 13448, 13442, 13437, 13431]),
    (0.117001, 6511.75, [6512, 6512, 6512, 6512, 6512]),
    (82.022276, 14188.4, [14409, 14423, 14437, 14452, 14466]),
    (0.736675, 16591.3, [16593, 16593, 16594, 16594, 16594]),
    (-84.067633, 18881.5, [18656, 18641, 18626, 18612, 18597]),
    (-821.193442, 44439.2, [42232, 42089, 41947, 41805, 41662]),
    (-224.989253, 38178.1, [37573, 37534, 37495, 37456, 37417]),
    (122.578409, 29049.35, [29379, 29400, 29421, 29443, 29464]),
]


def test_published_forecast(spark):
    for coef, intercept, prices in PUBLISHED:
        index = np.arange(20)
        fitted = spark.createDataFrame(
            [("x", coef, 0.0, intercept, float(index.mean()), 16.0, float(index.std()), 0.0, 25, 3)],
            "entity string, coef_time double, coef_hour double, intercept double,"
            "mean_time double, mean_hour double, scale_time double, scale_hour double,"
            "n_total long, start_hour int",
        )
        got = model.forecast(fitted, start_hour=F.lit(16)).orderBy("step").collect()
        assert [round(r.price_pred) for r in got] == prices
        assert [r.time_idx for r in got] == [25, 26, 27, 28, 29]
        assert [r.hour for r in got] == [17, 18, 19, 20, 21]


def test_hours_wrap_at_midnight(spark):
    features = series.ml_features(series_of(spark, {"a": [1, 2, 3, 4, 5, 6]}, step_minutes=170))
    split = series.split_by_time(features)
    ahead = model.forecast(model.fit(split)).orderBy("step").collect()
    assert [r.hour for r in ahead] == [0, 1, 2, 3, 4]


def test_degenerate_series(spark):
    prices = {"flat": [5.0] * 12, "five": [1, 2, 3, 4, 9], "line": list(range(10, 30))}
    df = series_of(spark, prices, step_minutes=0)  # constant hour, order by id
    features = series.ml_features(df)
    split = series.split_by_time(features)
    fitted = {r.entity: r for r in model.fit(split).collect()}
    assert (fitted["flat"].coef_time, fitted["flat"].coef_hour) == (0.0, 0.0)
    assert all(r.coef_hour == 0.0 for r in fitted.values())
    scores = {r.entity: r for r in model.metrics(split, model.fit(split)).collect()}
    assert scores["five"].r2_test is None and scores["flat"].r2_train is None
    assert scores["line"].r2_test > 0.9
    assert (scores["five"].n_train, scores["five"].n_test) == (4, 1)


def test_model_report(spark):
    prices = {**random_prices(1, "ab"), "line": [float(x) for x in range(1000, 1040)]}
    features = series.ml_features(series_of(spark, prices))
    report = model.model_report(series.split_by_time(features)).cache()
    rows = {r.entity: r for r in report.collect()}
    line = rows["line"]
    assert (line.direction, line.quality) == ("NAIK", "good")
    assert [p.step for p in line.forecast] == [1, 2, 3, 4, 5]
    assert line.text.startswith("Harga line cenderung NAIK (koef_waktu=")
    assert "Akurasi model baik" in line.text and "RMSE_test=Rp" in line.text
    best = model.leaderboard(report).first()
    r2 = {e: r.r2_test for e, r in rows.items()}
    assert (best.best, best.worst) == (max(r2, key=r2.get), min(r2, key=r2.get))
    assert best.n_up + best.n_down == 3
    for first in ((), ["line", "b"]):
        lists = model.direction_lists(report, first).first()
        order = sorted(rows, key=lambda e: (first.index(e) if e in first else len(first), e))
        for found, direction in ((lists.up, "NAIK"), (lists.down, "TURUN")):
            assert found == (", ".join(e for e in order if rows[e].direction == direction) or "-")
    none = model.direction_lists(report.where("false")).first()
    assert tuple(none) == ("-", "-")
    assert "line" in lists.up and set(f"{lists.up}, {lists.down}".split(", ")) >= set(rows)
    assert not any(math.isnan(r.rmse_test) for r in rows.values())


def test_unknown_penalty(spark):
    with pytest.raises(ValueError):
        model.fit(spark.range(1), penalty="lasso")
