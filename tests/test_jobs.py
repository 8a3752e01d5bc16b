"""Raw files, jobs end to end, and results that do not depend on size or partitions."""

import glob
import os

import pytest
from pyspark.sql import functions as F

from tickloom import schema
from tickloom.__main__ import parse
from tickloom.operators import features, models, splits
from tickloom.operators.sizing import place
from tickloom.plans import classification, forecasting
from tickloom.plans.collection import run_collection
from tickloom.plans.preprocessing import feature_table, run_preprocessing
from tickloom.sources.readers import read_bar_files, read_bar_folders

HEADER = "Ticker,Date,Open,High,Low,Close,Volume"


def bar_file(folder, *lines, header=HEADER):
    (folder / "A_stock_data.csv").write_text("\n".join([header, *lines]))
    return str(folder)


def test_float_volumes_are_kept(spark, tmp_path):
    got = read_bar_files(spark, bar_file(tmp_path, "A,2024-01-01,1,2,0.5,1.5,100.0", "A,2024-01-02,1,2,0.5,1.5,"))
    assert [r["Volume"] for r in got.orderBy("Date").collect()] == [100, None]
    assert got.schema == schema.RAW_SCHEMA


@pytest.mark.parametrize("line", ["A,2024-01-01,1,2,0.5,1.5,100.5", "A,2024-01-01,x,2,0.5,1.5,100", "A,no date,1,2,0.5,1.5,100"])
def test_bad_fields_are_errors(spark, tmp_path, line):
    with pytest.raises(Exception, match="MALFORMED|not whole|header"):
        read_bar_files(spark, bar_file(tmp_path, line)).collect()


def test_wrong_header_is_an_error(spark, tmp_path):
    wrong = HEADER.replace("Open,High", "High,Open")
    with pytest.raises(Exception, match="MALFORMED|not whole|header"):
        read_bar_files(spark, bar_file(tmp_path, "A,2024-01-01,1,2,0.5,1.5,100", header=wrong)).collect()
    (tmp_path / "Ticker=A").mkdir()
    (tmp_path / "Ticker=A" / "part-0.csv").write_text(wrong.removeprefix("Ticker,") + "\n2024-01-01,1,2,0.5,1.5,100")
    os.remove(tmp_path / "A_stock_data.csv")
    with pytest.raises(Exception, match="MALFORMED|not whole|header"):
        read_bar_folders(spark, str(tmp_path)).collect()


def test_no_file_is_an_error_and_overwrites_nothing(spark, tmp_path):
    kept = tmp_path / "features"
    spark.range(3).write.parquet(str(kept))
    (tmp_path / "empty").mkdir()
    for layout in ("files", "folders"):
        with pytest.raises(FileNotFoundError):
            run_preprocessing(spark, str(tmp_path / "empty"), str(kept), layout=layout)
    assert spark.read.parquet(str(kept)).count() == 3


def test_jobs_leave_nothing_staged(spark, bars, tmp_path):
    from tickloom.session import scratch_root, scratch_scope, stage

    before = set(os.listdir(scratch_root(spark).removeprefix("file:")))
    with scratch_scope(spark):
        assert stage(bars(A=range(10))).count() == 10
        assert set(os.listdir(scratch_root(spark).removeprefix("file:"))) > before
    (tmp_path / "bars").mkdir()
    lines = [f"A,{2000 + i // 300}-{i // 28 % 10 + 1:02d}-{i % 28 + 1:02d},1,2,0.5,{1 + i % 5},100" for i in range(3000)]
    run_preprocessing(spark, bar_file(tmp_path / "bars", *lines), str(tmp_path / "features"))
    assert set(os.listdir(scratch_root(spark).removeprefix("file:"))) == before


def test_collected_bars_are_preprocessed(spark, bars, tmp_path):
    vendor = bars(A=range(10, 130)).drop("ticker")
    run_collection(spark, {"A": vendor, "B": vendor}, str(tmp_path / "bars"))
    got = run_preprocessing(spark, str(tmp_path / "bars"), str(tmp_path / "features"), layout="folders")
    assert {r[0]: r[1] for r in got.groupBy("Ticker").count().collect()} == {"A": 118, "B": 118}
    assert parse(["collect", "out", "A=x.csv", "B=y.csv"]).vendor == ["A=x.csv", "B=y.csv"]


def test_split_of_repeated_keys_is_exact(spark):
    df = spark.range(1000).select("id", (F.col("id") % 7).alias("key"), F.lit("x").alias("label"))
    runs = [splits.stratified_split(d, "label", ["key"], small_bytes=b) for d, b in ((df, None), (df.repartition(9), 0))]
    first, second = ({r["id"]: r["split"] for r in run.collect()} for run in runs)
    assert first == second and sum(v == "train" for v in first.values()) == 800
    same = df.select("key", "label")
    assert splits.stratified_split(same, "label", ["key"]).filter("split = 'train'").count() == 800


def wavy(spark, n=400):
    id_ = F.col("id")
    close = 50 + 20 * F.sin(id_ / 9) + F.pmod(id_ * 31, F.lit(7))
    rows = spark.range(2 * n).select(
        F.when(id_ % 2 == 0, "A").otherwise("B").alias("Ticker"), F.date_add(F.lit("2020-01-01").cast("date"), F.floor(id_ / 2).cast("int")).alias("Date"),
        *[(close + i).alias(c) for i, c in enumerate(("Open", "High", "Low"))], close.alias("Close"), F.lit(100).cast("long").alias("Volume"),
    )
    return feature_table(rows)


def test_models_do_not_depend_on_partitions(spark):
    rows = forecasting.training_rows(wavy(spark)).cache()
    found = []
    for n in (2, 7):
        own = rows.filter("ticker = 'A'").repartition(n)
        model = models.fit_forecaster(own, ["date"], maxIter=5)
        found.append([r[0] for r in model.transform(own.filter("split = 'test'")).orderBy("date").select("prediction").collect()])
    assert found[0] == found[1]
    assert place(rows, ["date"]).rdd.getNumPartitions() == place(rows.repartition(5), ["date"]).rdd.getNumPartitions()


def test_grades_of_incomplete_rows_are_null(spark):
    labelled = classification.labelled_rows(wavy(spark)).cache()
    model, _ = classification.train_classifier(labelled, trees=3, max_depth=3)
    broken = labelled.limit(5).withColumn("rsi", F.lit(None).cast("double")).unionByName(labelled.limit(5))
    got = models.predict_grades(model, broken).collect()
    assert len(got) == 10 and sum(r["predicted_label"] is None for r in got) == 5
    assert all((r["confidence"] is None) == (r["rsi"] is None) for r in got)


def test_default_forecasting_job(spark, tmp_path):
    wavy(spark, 200).write.parquet(str(tmp_path / "features"))
    scores, forecast = forecasting.run_forecasting(spark, str(tmp_path / "features"), str(tmp_path / "models"), maxIter=3)
    assert {r[0] for r in scores.collect()} == {"A", "B"} and forecast.count() == 14
    assert len(glob.glob(str(tmp_path / "models" / "gbt_*"))) == 2
    saved = models.load_model(str(tmp_path / "models" / "gbt_A"))
    rows = forecasting.training_rows(spark.read.parquet(str(tmp_path / "features"))).filter("ticker = 'A'")
    again = models.fit_forecaster(rows, ["date"], maxIter=3)
    first, second = ([r[0] for r in m.transform(rows).orderBy("date").select("prediction").collect()] for m in (saved, again))
    assert first == pytest.approx(second)


def test_lag_vectors_hold_the_lags(spark, bars):
    from pyspark.ml.functions import vector_to_array

    df = bars(A=[1, 2, None, 4, 5, float("nan"), 7, 8, 9, 10, 11])
    wide = features.lag_features(df, depth=3)
    vectors = features.lag_vectors(df, depth=3).select("date", vector_to_array("features_raw").alias("v"), "target")
    names = features.lag_columns(depth=3)
    assert [(r["date"], [r[c] for c in names], r["target"]) for r in wide.orderBy("date").collect()] == [tuple(r) for r in vectors.orderBy("date").collect()]
    assert wide.count() == 1
