import math

import pytest
from pyspark.sql import functions as F

from tickloom import schema
from tickloom.functions.noise import normal, uniform
from tickloom.operators import metrics, models, quality, splits
from tickloom.operators.forecast import drift_forecast, forecast_table
from tickloom.operators.shape import serving_shape
from tickloom.plans import classification, forecasting
from tickloom.plans.preprocessing import feature_table


@pytest.fixture(scope="module")
def features(spark):
    rows = spark.range(600).select(
        F.when(F.col("id") % 2 == 0, "A").otherwise("B").alias("ticker"),
        F.date_add(F.lit("2020-01-01").cast("date"), F.floor(F.col("id") / 2).cast("int")).alias("date"),
        (50 + 20 * F.sin(F.col("id") / 9) + F.pmod(F.col("id") * 31, F.lit(7))).alias("close"),
    )
    bars = rows.select(
        "ticker", "date", *[(F.col("close") + i).alias(c) for i, c in enumerate(("Open", "High", "Low"))],
        F.col("close").alias("Close"), F.lit(100).cast("long").alias("Volume"),
    )
    return feature_table(bars).cache()


def test_regression_metrics(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, 2.0), (4.0, 3.0)], "target double, prediction double")
    row = metrics.regression_metrics(df).first()
    mean = 7 / 3
    assert row["rmse"] == pytest.approx(math.sqrt(2 / 3))
    assert row["mae"] == pytest.approx(2 / 3)
    assert row["r2"] == pytest.approx(1 - 2 / sum((y - mean) ** 2 for y in (1, 2, 4)))
    assert row["mpe"] == pytest.approx((1 + 0 + 0.25) / 3 * 100)


def test_classification_report(spark):
    pairs = [("a", "a")] * 3 + [("a", "b")] * 1 + [("b", "b")] * 2 + [("c", "a")] * 2
    df = spark.createDataFrame(pairs, "label string, prediction string")
    got = {r["class"]: r for r in metrics.classification_report(df).collect()}
    assert tuple(got["a"])[1:] == pytest.approx((0.6, 0.75, 2 * 0.6 * 0.75 / 1.35, 4))
    assert tuple(got["c"])[1:] == (0.0, 0.0, 0.0, 2)
    assert got["accuracy"]["f1"] == pytest.approx(5 / 8)
    assert got["macro avg"]["recall"] == pytest.approx((0.75 + 1 + 0) / 3)
    assert got["weighted avg"]["recall"] == pytest.approx((0.75 * 4 + 1 * 2) / 8)
    assert metrics.accuracy(df).first()[0] == pytest.approx(5 / 8)


def test_chronological_split_is_in_order(features):
    split = splits.chronological_split(features)
    ends = split.groupBy("ticker", "split").agg(F.min("date").alias("a"), F.max("date").alias("b"), F.count("*").alias("n"))
    got = {(r["ticker"], r["split"]): r for r in ends.collect()}
    for ticker in ("A", "B"):
        total = sum(got[ticker, s]["n"] for s in ("train", "val", "test"))
        assert got[ticker, "train"]["n"] == int(total * 0.8)
        assert got[ticker, "val"]["n"] == int(total * 0.1)
        assert got[ticker, "train"]["b"] < got[ticker, "val"]["a"] <= got[ticker, "val"]["b"] < got[ticker, "test"]["a"]


def test_stratified_split_by_selection_equals_ranking(spark):
    df = spark.range(5000).select(
        "id", F.when(F.col("id") % 3 < 2, "x").when(F.col("id") == 5, None).otherwise("y").alias("label")
    ).unionByName(spark.createDataFrame([(-1, "rare"), (-2, "pair"), (-3, "pair")], "id long, label string"))
    ranked = splits.stratified_split(df, "label", ["id"])
    selected = splits.stratified_split(df, "label", ["id"], small_bytes=0)
    assert sorted(map(repr, ranked.collect())) == sorted(map(repr, selected.select(*ranked.columns).collect()))
    counts = {(r["label"], r["split"]): r["count"] for r in selected.groupBy("label", "split").count().collect()}
    assert counts[("rare", "test")] == 1 and ("rare", "train") not in counts
    assert counts[("pair", "train")] == 1
    total = counts[("x", "train")] + counts[("x", "test")]
    assert counts[("x", "train")] == int(total * 0.8)


def test_standardise(features):
    z = splits.standardise(features, ["Close"], ["ticker"]).groupBy("ticker").agg(F.avg("Close_z"), F.stddev_samp("Close_z"))
    for _, mean, std in z.collect():
        assert mean == pytest.approx(0, abs=1e-9) and std == pytest.approx(1)
    train = F.col("date") < "2020-06-01"
    fitted = splits.standardise(features, ["Close"], ["ticker"], fit_on=train)
    mean, std = fitted.filter(train).filter("ticker = 'A'").agg(F.avg("Close_z"), F.stddev_pop("Close_z")).first()
    assert mean == pytest.approx(0, abs=1e-9) and std != pytest.approx(1, abs=1e-9)


def test_noise_is_repeatable_and_normal(spark):
    ids = spark.range(20000)
    draw = lambda df: df.select("id", normal(F.col("id"), 1).alias("z"), uniform(F.col("id")).alias("u"))
    first = {r["id"]: r["z"] for r in draw(ids).collect()}
    again = {r["id"]: r["z"] for r in draw(ids.repartition(7)).collect()}
    assert first == again
    row = draw(ids).agg(F.avg("z"), F.stddev("z"), F.min("u"), F.max("u")).first()
    assert row[0] == pytest.approx(0, abs=0.03) and row[1] == pytest.approx(1, abs=0.03)
    assert 0 < row[2] and row[3] <= 1


def test_drift_forecast(features):
    rows = drift_forecast(features, steps=3, sigma=0, decimals=None).filter("ticker = 'A'").orderBy("step").collect()
    tail = features.filter("ticker = 'A'").orderBy(F.desc("date")).limit(30).toPandas()
    mean, last = tail["Daily_Return"].mean(), tail["Close"].iloc[0]
    assert [r["price"] for r in rows] == pytest.approx([last * (1 + mean) ** i for i in (1, 2, 3)])
    assert [(r["forecast_date"] - tail["date"].iloc[0]).days for r in rows] == [1, 2, 3]
    assert drift_forecast(features.filter("ticker = 'none'")).count() == 0
    noisy = [r["price"] for r in drift_forecast(features, steps=14).orderBy("ticker", "step").collect()]
    assert noisy == [r["price"] for r in drift_forecast(features.repartition(3), steps=14).orderBy("ticker", "step").collect()]
    text = forecast_table(features, steps=1, sigma=0).orderBy("ticker").first()
    assert text["price"].startswith("$") and len(text["day"].split()) == 2


def test_forecasters_train_save_and_load(spark, features, tmp_path):
    rows = forecasting.training_rows(features).cache()
    assert rows.count() == features.count() - 2 * 31
    fits = {value: (model, scores) for value, model, scores in forecasting.train_per_series(
        rows, model_directory=str(tmp_path), maxIter=3)}
    assert sorted(fits) == ["A", "B"]
    model, scores = fits["A"]
    assert scores["n"] == rows.filter("ticker = 'A' AND split = 'test'").count()
    loaded = models.load_model(str(tmp_path / "gbt_A"))
    test = rows.filter("ticker = 'A' AND split = 'test'")
    assert model.transform(test).select("prediction").collect() == loaded.transform(test).select("prediction").collect()


def test_forecasting_job(spark, features, tmp_path):
    path = str(tmp_path / "features")
    features.write.parquet(path)
    scores, forecast = forecasting.run_forecasting(spark, path, maxIter=2, pooled=True, model_directory=str(tmp_path))
    assert {r["ticker"] for r in scores.collect()} == {"A", "B"}
    assert forecast.count() == 14


def test_classification_job(spark, features, tmp_path):
    done = classification.run_classification(serving_shape(features), str(tmp_path / "model"), trees=10, max_depth=6)
    counts = {r["label"]: r["n"] for r in done.grade_counts.collect()}
    assert sum(counts.values()) == features.count() and set(counts) == set(schema.GRADES)
    assert 0.5 < done.accuracy.first()[0] <= 1
    assert "macro avg" in {r["class"] for r in done.report.collect()}
    board = done.board.collect()
    assert {r["ticker"] for r in board} == {"A", "B"}
    for row in board:
        assert row["grade"] in schema.GRADES
        assert row["high_percent"] + row["medium_percent"] + row["low_percent"] == pytest.approx(100, abs=0.3)
    loaded = models.load_model(str(tmp_path / "model"))
    sample = spark.createDataFrame(
        [(50.0, 150.0, 148.0, 145.0, 2.5, 0.01, 0.5)], ", ".join(f"{c} double" for c in schema.CLASSIFIER_FEATURES)
    )
    predicted = models.predict_grades(loaded, sample)
    assert tuple(quality.prediction_contract(predicted).first()) == (0, 0)
    assert set(predicted.first()["confidence"]) == set(schema.GRADES)
