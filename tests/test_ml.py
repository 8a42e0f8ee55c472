import numpy as np
import pytest
from pyspark.sql import functions as F

from lakemart.ml import churn, forecast, iforest, kmeans


def test_folds_are_even_per_class(spark):
    df = spark.range(1000).select(F.col("id").alias("CustomerKey"), (F.col("id") % 4 == 0).cast("int").alias("IsChurned"))
    got = churn.with_folds(df).groupBy("IsChurned", "fold").count().collect()
    assert {r["count"] for r in got if r["IsChurned"] == 1} == {50}
    assert {r["count"] for r in got if r["IsChurned"] == 0} == {150}


def test_report_against_hand_counts(spark):
    confusion = spark.createDataFrame([(0, 0, 50), (0, 1, 10), (1, 0, 5), (1, 1, 35)], "label int, prediction int, records bigint")
    got = {r["label"]: r for r in churn.classification_report(confusion).collect()}
    assert got[1]["precision"] == pytest.approx(35 / 45) and got[1]["recall"] == pytest.approx(35 / 40)
    assert got[0]["accuracy"] == pytest.approx(0.85) and got[0]["support"] == 60


def test_segment_names(spark):
    rows = [(1, -1, 10, 20, 2000.0), (2, 0, 10, 20, 2000.0), (3, 1, 50, 6, 600.0), (4, 2, 20, 3, 600.0),
            (5, 3, 100, 6, 600.0), (6, 4, 70, 1, 1.0)]
    df = spark.createDataFrame(rows, "CustomerKey int, Segment int, Recency int, Frequency int, Monetary double").withColumns(
        {c: F.lit(1.0) for c in ("AvgOrderSize", "RevenuePerOrder", "CustomerLifespan")})
    got = {r["Segment"]: r["Description"] for r in kmeans.segment_stats(df).collect()}
    assert got == {-1: "Noise/Outliers", 0: "Champions", 1: "Loyal Customers", 2: "Potential Loyalists", 3: "At Risk",
                   4: "Segment 4"}


def test_isolation_forest_finds_planted_points(spark):
    rng = np.random.default_rng(1)
    rows = [(i, *map(float, rng.normal(0, 1, 2))) for i in range(600)] + [(1000 + i, 12.0 + i, -12.0) for i in range(5)]
    df = spark.createDataFrame(rows, "id int, a double, b double")
    nodes = iforest.train(df, ["a", "b"], ["id"], trees=40, sample=128)
    scored = iforest.with_score(df, nodes, ["a", "b"], "score", rows_seen=128)
    worst = [r["id"] for r in scored.orderBy("score").limit(5).collect()]
    assert set(worst) == {1000, 1001, 1002, 1003, 1004}
    flagged = iforest.flag(scored, "score", "odd", 0.1)
    assert flagged.where("odd").count() == pytest.approx(60, abs=2)


def _dense_likelihood(y, phi, theta):
    """Log likelihood of the changes from their whole covariance matrix, with the variance at its best."""
    w, n = np.diff(y), len(y) - 1
    gamma = np.empty(n)
    gamma[0] = (1 + 2 * phi * theta + theta ** 2) / (1 - phi ** 2)
    gamma[1:] = (1 + phi * theta) * (phi + theta) / (1 - phi ** 2) * phi ** np.arange(n - 1)
    cover = gamma[np.abs(np.subtract.outer(np.arange(n), np.arange(n)))]
    sigma2 = w @ np.linalg.solve(cover, w) / n
    return -0.5 * (n * (np.log(2 * np.pi * sigma2) + 1) + np.linalg.slogdet(cover)[1])


@pytest.mark.parametrize("phi, theta", [(0.4, -0.3), (-0.7, 0.2), (0.95, -0.9), (0.0, 0.5)])
def test_arima_likelihood_equals_the_dense_one(phi, theta):
    y = 1e4 + 300 * np.cumsum(np.random.default_rng(2).normal(0, 1, 70))
    got = forecast.arima_filter(y, np.array([phi]), np.array([theta]))[0][0]
    assert got == pytest.approx(_dense_likelihood(y, phi, theta), abs=1e-8)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_arima_fit_is_the_likeliest_of_a_fine_search(seed):
    rng = np.random.default_rng(seed)
    noise, d = rng.normal(0, 50, 61), np.zeros(60)
    for t in range(1, 60):
        d[t] = (0.5, -0.6, 0.8)[seed - 1] * d[t - 1] + noise[t] + (0.3, 0.1, -0.4)[seed - 1] * noise[t - 1]
    y = 1000 + np.cumsum(d)
    fit = forecast.fit_arima(y)
    phi, theta = fit["p"][:2]
    ll = _dense_likelihood(y, phi, theta)
    assert fit["aic"] == pytest.approx(6 - 2 * ll, abs=1e-3)
    assert fit["bic"] == pytest.approx(3 * np.log(60 - 1) - 2 * ll, abs=1e-3)
    # no point of a search of its own is likelier, and none nearby
    axis = np.linspace(-0.98, 0.98, 50)
    others = [(p, q) for p in axis for q in axis] + [(phi + a, theta + b) for a in (-1e-3, 0, 1e-3) for b in (-1e-3, 0, 1e-3)]
    assert ll >= max(_dense_likelihood(y, p, q) for p, q in others if abs(p) < 1 and abs(q) < 1) - 1e-5


def _smoothed(y, weights, state, period):
    """Plain additive smoothing from given start values: squared errors and the state after the last day."""
    (alpha, beta, gamma), (level, trend, *season) = weights, state
    sse = 0.0
    for t, now in enumerate(y):
        s = season[t % period]
        sse += (now - level - trend - s) ** 2
        new = alpha * (now - s) + (1 - alpha) * (level + trend)
        trend = beta * (new - level) + (1 - beta) * trend
        season[t % period] = gamma * (now - new) + (1 - gamma) * s
        level = new
    return sse, [level, trend, *season]


def test_start_values_of_smoothing_are_the_best_ones():
    rng = np.random.default_rng(8)
    y, weights, period = rng.normal(100, 10, 50) + np.arange(50), (0.3, 0.1, 0.2), 4
    sse, end = forecast.smoothing_fit(y, *[np.array([w]) for w in weights], period)
    plain = forecast.smoothing_sse(y, *[np.array([w]) for w in weights], period)
    assert sse[0] < plain[0]
    # a search over start values of its own, by least squares on the plain recursion
    zero, unit = np.zeros(period + 2), np.eye(period + 2)

    base = _smoothed(y, weights, list(zero), period)[0]
    single = np.array([_smoothed(y, weights, list(u), period)[0] for u in unit])
    double = np.array([[_smoothed(y, weights, list(u + v), period)[0] for v in unit] for u in unit])
    # the squared error is a quadratic form of the start values
    form = (double - single[:, None] - single[None, :] + base) / 2
    slope = (single - base - np.diag(form)) / 2
    best = -np.linalg.pinv(form, rcond=1e-10) @ slope
    least, state = _smoothed(y, weights, list(best), period)
    assert sse[0] == pytest.approx(least, rel=1e-6)
    assert end[0][0] + end[0][2:][50 % period] == pytest.approx(state[0] + state[2:][50 % period], rel=1e-5)


def test_holt_winters_is_never_above_the_plain_start(spark):
    rng = np.random.default_rng(4)
    for scale in (1.0, 1e6):
        y = scale * (50 + 0.2 * np.arange(90) + 5 * np.sin(np.arange(90) * np.pi / 6) + rng.normal(0, 2, 90))
        fit = forecast.fit_holt_winters(y)
        axis = np.linspace(0.02, 0.98, 9)
        a, b, g = [m.ravel() for m in np.meshgrid(axis, axis, axis, indexing="ij")]
        sse = fit["mse"] * 90
        assert sse <= forecast.smoothing_sse(y, a, b, g).min()
        assert sse <= forecast.smoothing_fit(y, a, b, g)[0].min() * 1.02
        assert fit["aic"] == pytest.approx(90 * np.log(sse / 90) + 32) and fit["bic"] == pytest.approx(90 * np.log(sse / 90) + 16 * np.log(90))


def test_kept_fits_forecast_alike(spark, tmp_path):
    rows = [("a", i, float(i % 7 + i / 9)) for i in range(60)] + [("b", i, 1.0) for i in range(2)]
    df = spark.createDataFrame(rows, "series string, i int, value double").select(
        "series", F.expr("date_add(DATE '2020-01-01', i)").alias("Date"), "value")
    path = str(tmp_path / "fits")
    forecast.fit_models(df).write.parquet(path)
    kept = forecast.forecast_from(spark.read.parquet(path), 9)
    assert sorted(map(str, kept.collect())) == sorted(map(str, forecast.forecast(df, 9).collect()))
    assert kept.agg(F.min("date")).first()[0].isoformat() == "2020-03-01"


def test_arima_recovers_its_parameters():
    rng = np.random.default_rng(3)
    noise, d = rng.normal(0, 1, 3001), np.zeros(3000)
    for t in range(1, 3000):
        d[t] = 0.6 * d[t - 1] + noise[t] + 0.3 * noise[t - 1]
    phi, theta, _ = forecast.fit_arima(np.cumsum(d))["p"]
    assert phi == pytest.approx(0.6, abs=0.06) and theta == pytest.approx(0.3, abs=0.06)


def test_holt_winters_follows_trend_and_season(spark):
    t = np.arange(144)
    y = 100 + 0.5 * t + 10 * np.sin(2 * np.pi * t / 12)
    rows = [("s", str(np.datetime64("2020-01-01") + i), float(v)) for i, v in enumerate(y)]
    df = spark.createDataFrame(rows, "series string, d string, value double").select(
        "series", F.to_date("d").alias("Date"), "value")
    got = forecast.forecast(df, 24, models=("HoltWinters",)).orderBy("step").collect()
    ahead = np.arange(144, 168)
    expected = 100 + 0.5 * ahead + 10 * np.sin(2 * np.pi * ahead / 12)
    assert np.allclose([r["forecast"] for r in got], expected, atol=3)
    assert all(r["lower"] <= r["forecast"] <= r["upper"] for r in got)
    fits = forecast.fit_models(df).collect()
    assert {r["model"] for r in fits} == {"ARIMA", "HoltWinters"}


def test_short_series_keep_a_row_per_model(spark):
    rows = [("long", i, float(i % 7)) for i in range(40)] + [("twenty", i, float(i)) for i in range(20)] + [("two", i, 1.0) for i in range(2)]
    df = spark.createDataFrame(rows, "series string, i int, value double").select(
        "series", F.expr("date_add(DATE '2020-01-01', i)").alias("Date"), "value")
    fits = {(r["series"], r["model"]): r["status"] for r in forecast.fit_models(df).collect()}
    assert fits == {("long", "ARIMA"): "fitted", ("long", "HoltWinters"): "fitted", ("twenty", "ARIMA"): "fitted",
                    ("twenty", "HoltWinters"): "too short", ("two", "ARIMA"): "too short", ("two", "HoltWinters"): "too short"}
    ahead = forecast.forecast(df, 5).groupBy("series", "model", "status").count().collect()
    assert {(r["series"], r["model"]): r["count"] for r in ahead if r["status"] == "too short"} == {
        ("twenty", "HoltWinters"): 1, ("two", "ARIMA"): 1, ("two", "HoltWinters"): 1}
    assert {r["count"] for r in ahead if r["status"] == "fitted"} == {5}


def test_kmeans_trains_saves_and_loads(spark, tmp_path):
    rng = np.random.default_rng(5)
    rows = [(i, *map(float, rng.normal(10 * (i % 3), 0.1, 2))) for i in range(90)]
    df = spark.createDataFrame(rows, "CustomerKey int, a double, b double")
    model = kmeans.train(df, k=3, restarts=3, columns=["a", "b"])
    got = {r["CustomerKey"]: r["Segment"] for r in kmeans.predict(model, df).collect()}
    assert all(got[i] == got[i % 3] for i in got) and len(set(got.values())) == 3
    from pyspark.ml import PipelineModel

    model.save(str(tmp_path / "m"))
    again = kmeans.predict(PipelineModel.load(str(tmp_path / "m")), df)
    assert {r["CustomerKey"]: r["Segment"] for r in again.collect()} == got


def test_runner_keeps_results_and_whole_errors(spark, tmp_path):
    from lakemart.ml import runner

    def fails():
        raise ValueError("x" * 900)

    status = {r["analysis"]: r for r in runner.run_all(
        spark, spark.range(10), {"good": lambda: spark.range(7), "bad": fails}, least=5, results=str(tmp_path / "r")).collect()}
    assert (status["good"]["status"], status["good"]["records"]) == ("completed", 7)
    assert spark.read.parquet(str(tmp_path / "r" / "good")).count() == 7
    assert status["bad"]["status"] == "failed" and status["bad"]["message"] == "x" * 900
    skipped = runner.run_all(spark, spark.range(3), {"good": lambda: spark.range(7)}, least=5).first()
    assert skipped["status"] == "skipped"


def test_churn_trains_and_reports(spark, tmp_path):
    rows = [(i, *([float(i % 2)] * 12), i % 2) for i in range(200)]
    from lakemart.operators.features import churn_columns

    columns = churn_columns()
    df = spark.createDataFrame(rows, "CustomerKey int, " + ", ".join(f"c{i} double" for i in range(12)) + ", IsChurned int")
    df = df.select("CustomerKey", *[F.col(f"c{i}").alias(c) for i, c in enumerate(columns)], "IsChurned")
    result = churn.train(df, trees=5)
    assert result.accuracy == 1.0 and len(result.cv_scores) == 5
    got = churn.predict(result.model, df).collect()
    assert all(r["PredictedChurn"] == r["IsChurned"] for r in got) and {r["ChurnRisk"] for r in got} <= {"Low", "High", None}
    churn.save(result, spark, str(tmp_path / "churn"))
    again = churn.predict(churn.load(str(tmp_path / "churn")), df)
    assert sorted(map(str, again.collect())) == sorted(map(str, got))
    assert spark.read.parquet(str(tmp_path / "churn" / "metrics")).count() == 6 + len(columns)
    report = churn.metrics(result, spark).groupBy("metric").count().collect()
    assert {r["metric"]: r["count"] for r in report} == {"accuracy": 1, "cross_validation": 5, "importance": len(columns)}
