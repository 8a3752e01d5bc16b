"""Registered queries: one per operator, over the whole test tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tickloom import schema
from tickloom.functions.intent import mentioned_ticker
from tickloom.operators import features as feats
from tickloom.operators import indicators as ind
from tickloom.operators import labels, latest, metrics, models, quality, shape, splits
from tickloom.operators.boosting import TreeParams, fit_many, predict_many
from tickloom.operators.forecast import drift_forecast, forecast_table
from tickloom.operators.segments import SegmentLimits, limits_for
from tickloom.operators.sizing import settle
from tickloom.plans import classification, forecasting, stock_page
from tickloom.plans.database import PREVIEW_COLUMNS, run_database_setup
from tickloom.plans.collection import run_collection
from tickloom.plans.preprocessing import feature_table, run_preprocessing
from tickloom.session import scratch_path, stage
from tickloom.sources.cache import kept_stock_data
from tickloom.sources.readers import read_bar_files, read_bar_folders, read_features
from tickloom.sources.tables import all_rows, bucketed_table, latest_prices
from tickloom.sources.writers import write_bar_files, write_bar_folders, write_features
from tickloom_checks.fixtures import bars, supplier_bars, table, unmerged_bars
from tickloom_checks.words import DATA_PIECES, MANY_PIECES, PREDICTION_PIECES, PRIORITIES, TICKER_PIECES

# Cuts every series of the test data, so that the long-series path is checked.
CUT = SegmentLimits(max_rows=200, small_bytes=0)
ONE = "1-URGENT"


def rounded(df: DataFrame, *columns: str, digits: int = 4) -> DataFrame:
    """Chosen columns in lower case, doubles rounded."""
    picked = df.select(*(columns or df.columns))
    return picked.select(
        *[
            (F.round(f.name, digits) if isinstance(f.dataType, T.DoubleType) else F.col(f.name)).alias(f.name.lower())
            for f in picked.schema
        ]
    )


def features(spark: SparkSession, sf: str) -> DataFrame:
    """The feature table, which operators on it may read more than once."""
    return settle(shape.lower_names(feature_table(settle(bars(spark, sf)))), "features")


def engineered(spark: SparkSession, sf: str, limits: SegmentLimits | None = None) -> DataFrame:
    out = feats.classifier_features(features(spark, sf), limits=limits)
    names = ("total_return", "return_7d", "return_30d", "ma7_vs_ma30", "ma30_vs_ma90", "avg_rsi")
    return rounded(out, "ticker", "date", *names)


def labelled(spark: SparkSession, sf: str) -> DataFrame:
    return settle(classification.labelled_rows(features(spark, sf)), "labelled")


def lag_matrix(spark: SparkSession, sf: str, limits: SegmentLimits | None = None) -> DataFrame:
    return rounded(feats.lag_features(bars(spark, sf), limits=limits))


def scaled_lags(spark: SparkSession, sf: str) -> DataFrame:
    """Lag vectors, scaled by all rows, back as columns: one per bar column."""
    vectors = models.assemble_lags(feats.lag_features(bars(spark, sf)))
    scaled = models.vector_scaler().fit(vectors).transform(vectors)
    values = vector_to_array("features")
    first = range(0, len(schema.LAG_COLUMNS) * schema.LAG_DEPTH, schema.LAG_DEPTH)
    names = [f"{c.lower()}_lag_1" for c in schema.LAG_COLUMNS]
    return rounded(scaled.select("ticker", "date", *[values[i].alias(n) for i, n in zip(first, names)]))


def feature_matrix(spark: SparkSession, sf: str) -> DataFrame:
    values = vector_to_array("features_raw")
    matrix = models.feature_matrix(labelled(spark, sf))
    return rounded(matrix.select("label", *[values[i].alias(c) for i, c in enumerate(schema.CLASSIFIER_FEATURES)]))


def persistence(spark: SparkSession, sf: str) -> DataFrame:
    w = Window.partitionBy("ticker").orderBy("date")
    return bars(spark, sf).withColumn("target", F.lead("close").over(w)).withColumn("prediction", F.col("close"))


def two_classes(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "labels").select(F.col("quality").alias("label"), F.col("toxic").alias("prediction"))


def csv_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "bars-csv")
    write_bar_folders(shape.rename_all(bars(spark, sf), schema.RAW_COLUMNS), path)
    return rounded(read_bar_folders(spark, path))


def parquet_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "features")
    write_features(feature_table(bars(spark, sf)), path)
    return rounded(read_features(spark, path))


def _loaded_table(spark: SparkSession, sf: str) -> tuple[str, DataFrame]:
    path = scratch_path(spark, "features")
    write_features(feature_table(bars(spark, sf)), path)
    location = scratch_path(spark, "stock_data")
    name = location.rsplit("/", 1)[-1].replace("-", "_")
    _, head = run_database_setup(spark, path, name, ONE, location)
    return name, head


def table_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(all_rows(spark, _loaded_table(spark, sf)[0]))


def table_preview(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(_loaded_table(spark, sf)[1], *PREVIEW_COLUMNS)


def vendor_frame(spark: SparkSession, sf: str) -> DataFrame:
    vendor = bars(spark, sf).select(
        F.col("date").alias("Date"), *[F.col(c.lower()).alias(f"{c}|ORDERS") for c in schema.PRICE_COLUMNS]
    )
    return rounded(shape.normalise_vendor_frame(vendor, "ORDERS"))


def gbt_forecast(spark: SparkSession, sf: str) -> DataFrame:
    rows = forecasting.training_rows(bars_as_features(spark, sf))
    return _what_must_hold(forecasting.metrics_frame(spark, forecasting.train_per_series(rows)))


def gbt_forecast_pooled(spark: SparkSession, sf: str) -> DataFrame:
    rows = forecasting.pooled_rows(bars_as_features(spark, sf))
    return _what_must_hold(forecasting.train_pooled(rows)[1])


def _what_must_hold(scores: DataFrame) -> DataFrame:
    """Test rows of each series, and what is true of any model's metrics."""
    finite = [F.col(c).isNotNull() & (F.abs(c) < float("inf")) for c in ("rmse", "mae", "r2", "mpe")]
    return scores.select(
        "ticker", "n", (F.col("rmse") >= F.col("mae")).alias("ordered"), (finite[0] & finite[1] & finite[2] & finite[3]).alias("finite")
    )


def bars_as_features(spark: SparkSession, sf: str) -> DataFrame:
    return settle(feature_table(settle(bars(spark, sf))), "features")


def _classified(spark: SparkSession, sf: str) -> tuple:
    rows = labelled(spark, sf)
    return (rows, *classification.train_classifier(rows))


def grade_classifier(spark: SparkSession, sf: str) -> DataFrame:
    predicted = _classified(spark, sf)[2]
    report = metrics.classification_report(predicted, prediction="predicted_label")
    sound = [F.col(c).between(0, 1) for c in ("precision", "recall", "f1")]
    return report.select("class", "support", (sound[0] & sound[1] & sound[2]).alias("sound"))


def grade_board(spark: SparkSession, sf: str) -> DataFrame:
    rows, model, _ = _classified(spark, sf)
    board = models.grade_board(model, rows)
    percents = {g: F.col(f"{g.lower()}_percent") for g in schema.GRADES}
    named = F.coalesce(*[F.when(F.col("grade") == g, p) for g, p in percents.items()])
    flags = board.select(
        "ticker", "composite_score", (F.abs(sum(percents.values()) - 100) <= 0.3).alias("sums_to_100"),
        (named == F.greatest(*percents.values())).alias("grade_is_likeliest"),
    )
    return models.board_text(board).select("ticker", "price", "rsi", "sharpe").join(flags, "ticker")


def trained_contract(spark: SparkSession, sf: str) -> DataFrame:
    return quality.prediction_contract(_classified(spark, sf)[2])


def prediction_contract(spark: SparkSession, sf: str) -> DataFrame:
    """Predictions with known faults: toxic rows have an unknown grade, and bad ones a sum off 1."""
    rows = table(spark, sf, "labels").select(
        F.when(F.col("toxic") == 1, "Fair").when(F.col("quality") == 1, "High").otherwise("Low").alias("predicted_label"),
        F.when(F.col("quality") == 0, F.array(F.lit(0.5), F.lit(0.4), F.lit(0.05))).otherwise(F.array(F.lit(0.5), F.lit(0.25), F.lit(0.25))).alias("probability"),
    )
    return quality.prediction_contract(rows)


def bar_files(spark: SparkSession, sf: str) -> DataFrame:
    """CSV files per ticker in a flat directory, several for a long one, read back."""
    path = scratch_path(spark, "bar-files")
    write_bar_files(shape.rename_all(bars(spark, sf), schema.RAW_COLUMNS), path, max_rows_per_file=1_000)
    return rounded(read_bar_files(spark, path))


def bar_file_manifest(spark: SparkSession, sf: str) -> DataFrame:
    """Rows per ticker by the manifest of the files, and that every file is named after its ticker."""
    path = scratch_path(spark, "bar-files")
    manifest = write_bar_files(shape.rename_all(bars(spark, sf), schema.RAW_COLUMNS), path, max_rows_per_file=1_000)
    named = F.min(F.startswith("file", "series") & F.endswith("file", F.lit("_stock_data.csv"))).alias("named")
    return manifest.groupBy(F.col("series").alias("ticker")).agg(F.sum("n_rows").alias("n_rows"), named)


def vendor_table(spark: SparkSession, sf: str) -> DataFrame:
    """The bars as a vendor's wide table: a row per date, a column per price and ticker."""
    first = [F.first(c.lower()).alias(c) for c in schema.PRICE_COLUMNS]
    wide = bars(spark, sf).groupBy(F.col("date").alias("Date")).pivot("ticker", list(PRIORITIES)).agg(*first)
    return wide.toDF("Date", *[f"{c}|{t}" for t in PRIORITIES for c in schema.PRICE_COLUMNS])


def collect_preprocess(spark: SparkSession, sf: str) -> DataFrame:
    """A vendor's wide table to CSV bars to the feature table, by the jobs."""
    raw, path = scratch_path(spark, "collected"), scratch_path(spark, "features")
    run_collection(spark, vendor_table(spark, sf), raw)
    return rounded(run_preprocessing(spark, raw, path, layout="folders"))


def _bucketed(spark: SparkSession, sf: str) -> str:
    location = scratch_path(spark, "stock_buckets")
    name = location.rsplit("/", 1)[-1].replace("-", "_")
    rows = stage(supplier_bars(spark, sf), "bars")
    limits = limits_for(rows)
    bucketed_table(rows, name, location, rows_per_bucket=10_000, derive=lambda x: shape.serving_shape(feature_table(x, limits=limits)))
    return name


def bucketed_latest(spark: SparkSession, sf: str) -> DataFrame:
    """The latest values of every supplier from the bucketed table, without a shuffle."""
    return rounded(latest_prices(spark, _bucketed(spark, sf)))


def bucketed_average(spark: SparkSession, sf: str) -> DataFrame:
    """A window per supplier over the bucketed table, without a shuffle."""
    rows = ind.moving_averages(spark.table(_bucketed(spark, sf)).drop("ma_7"), windows=[7])
    return rounded(rows, "ticker", "date", "ma_7")


def kept_stock_rows(spark: SparkSession, sf: str) -> DataFrame:
    """The latest rows of a ticker, stored by the first call and read by the second."""
    name, _ = _loaded_table(spark, sf)
    kept_stock_data(spark, ONE, 30, name)
    return rounded(kept_stock_data(spark, ONE, 30, name))


def gbt_forecast_many(spark: SparkSession, sf: str) -> DataFrame:
    """A model for every supplier in the same jobs."""
    rows = forecasting.training_rows(settle(feature_table(settle(supplier_bars(spark, sf))), "features"), arrays=True)
    return _what_must_hold(forecasting.train_many(rows)[1])


def many_model_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """Saved and loaded models of all series predict as the fitted ones, row for row."""
    p = TreeParams(trees=5)
    rows = forecasting.lag_arrays(forecasting.training_rows(bars_as_features(spark, sf)))
    models = fit_many(rows.filter(F.col("split") == "train"), params=p)
    path = scratch_path(spark, "gbt-many")
    models.write.parquet(path)
    tested = rows.filter(F.col("split") == "test")
    return _same_predictions(predict_many(models, tested, params=p), predict_many(spark.read.parquet(path), tested, params=p), ["ticker", "row_num"])


def forecaster_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """A saved and loaded forecaster of each of two series predicts as the fitted one, row for row."""
    rows = forecasting.training_rows(bars_as_features(spark, sf))
    directory = scratch_path(spark, "forecasters")
    out = []
    for value, model, _ in forecasting.train_per_series(rows, values=[ONE, "5-LOW"], model_directory=directory, maxIter=3):
        tested = rows.filter((F.col("ticker") == value) & (F.col("split") == "test")).select("ticker", "row_num", "features_raw", "target")
        loaded = models.load_model(f"{directory}/gbt_{value}")
        out.append(_same_predictions(model.transform(tested), loaded.transform(tested), ["ticker", "row_num"]))
    return latest.concatenate(out)


def classifier_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """A saved and loaded classifier gives every row the grade and confidence of the fitted one."""
    rows = labelled(spark, sf)
    model, _ = classification.train_classifier(rows, trees=10, max_depth=5)
    path = scratch_path(spark, "grades")
    models.save_model(model, path)
    graded = [models.predict_grades(m, rows).withColumn("prediction", F.to_json(F.struct("predicted_label", "confidence"))) for m in (model, models.load_model(path))]
    return _same_predictions(*graded, ["ticker", "date"])


def _same_predictions(fitted: DataFrame, loaded: DataFrame, keys: list[str]) -> DataFrame:
    """Per series the rows that both predict, and whether all predictions are equal."""
    pairs = fitted.select(*keys, F.col("prediction").alias("a")).join(loaded.select(*keys, F.col("prediction").alias("b")), keys, "full")
    return pairs.groupBy("ticker").agg(F.count(F.lit(1)).alias("n"), F.min(F.coalesce(F.col("a") == F.col("b"), F.lit(False))).alias("equal"))


def whole_page(spark: SparkSession, sf: str) -> DataFrame:
    """The page with the grades that scores give, as certain ones."""
    rows = labelled(spark, sf)
    newest = latest.latest_rows(rows, 1).withColumn("grade", F.col("label"))
    percents = {f"{g.lower()}_percent": F.when(F.col("label") == g, 100.0).otherwise(0.0) for g in schema.GRADES}
    page = stock_page.stock_page(features(spark, sf), newest.withColumns(percents), sigma=0)
    return page.withColumn("forecast", F.array_join("forecast", " "))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    intent_pieces = {"tickers": TICKER_PIECES, "prediction_words": PREDICTION_PIECES, "data_words": DATA_PIECES}
    return {
        "moving_averages": lambda s, d: rounded(
            ind.moving_averages(bars(s, d)), "ticker", "date", "ma_7", "ma_30", "ma_90"
        ),
        "previous_close": lambda s, d: rounded(
            ind.previous_close(bars(s, d)), "ticker", "date", "prev_close", "change"
        ),
        "rsi": lambda s, d: rounded(ind.rsi(bars(s, d)), "ticker", "date", "rsi"),
        "volatility": lambda s, d: rounded(ind.volatility(bars(s, d)), "ticker", "date", "volatility"),
        "returns_sharpe": lambda s, d: rounded(
            ind.returns(bars(s, d)), "ticker", "date", "daily_return", "sharpe_ratio"
        ),
        "feature_table": lambda s, d: rounded(features(s, d)),
        "feature_table_segmented": lambda s, d: rounded(feature_table(bars(s, d), limits=CUT)),
        "feature_table_suppliers": lambda s, d: rounded(feature_table(supplier_bars(s, d))),
        "lag_features": lag_matrix,
        "lag_features_segmented": lambda s, d: lag_matrix(s, d, CUT),
        "scaled_lags": scaled_lags,
        "feature_matrix": feature_matrix,
        "total_return": lambda s, d: rounded(feats.total_return(features(s, d)), "ticker", "date", "total_return"),
        "percent_change": lambda s, d: rounded(
            feats.percent_change(features(s, d)), "ticker", "date", "return_7d", "return_30d"
        ),
        "rolling_mean_full": lambda s, d: rounded(
            feats.rolling_mean_full(features(s, d)), "ticker", "date", "avg_rsi"
        ),
        "trend_ratios": lambda s, d: rounded(
            feats.trend_ratios(features(s, d)), "ticker", "date", "ma7_vs_ma30", "ma30_vs_ma90"
        ),
        "classifier_features": engineered,
        "classifier_features_segmented": lambda s, d: engineered(s, d, CUT),
        "composite_score": lambda s, d: labelled(s, d).select("ticker", "date", "composite_score"),
        "grade_labels": lambda s, d: labelled(s, d).select("ticker", "date", "composite_score", "label"),
        "grade_counts": lambda s, d: latest.value_counts(labelled(s, d), "label", schema.GRADES),
        "rsi_zones": lambda s, d: labels.add_rsi_zone(features(s, d)).select("ticker", "date", "rsi_zone"),
        "latest_prices": lambda s, d: rounded(latest.latest_values(features(s, d))),
        "latest_rows": lambda s, d: rounded(latest.latest_rows(features(s, d), 30)),
        "latest_rows_one_series": lambda s, d: rounded(latest.last_rows_of(features(s, d), ONE, 30, ascending=True)),
        "series_history": lambda s, d: rounded(latest.series_rows(features(s, d), ONE)),
        "ordered_table": lambda s, d: rounded(latest.ordered_table(features(s, d))),
        "numbered_table": lambda s, d: rounded(latest.numbered_table(features(s, d))),
        "page_rows": lambda s, d: rounded(stock_page.page_rows(features(s, d))),
        "sampled_split": lambda s, d: splits.sampled_split(labelled(s, d), ["ticker", "date"]).select("ticker", "date", "label", "split"),
        "recent_mean_return": lambda s, d: rounded(latest.recent_mean(features(s, d))),
        "distinct_series": lambda s, d: latest.distinct_series(bars(s, d)),
        "row_counts": lambda s, d: latest.row_count(bars(s, d)),
        "data_quality": lambda s, d: quality.series_quality(bars(s, d)),
        "data_quality_unmerged": lambda s, d: quality.series_quality(unmerged_bars(s, d)),
        "overall_quality": lambda s, d: quality.overall_quality(bars(s, d)),
        "missing_series": lambda s, d: quality.missing_series(bars(s, d), (ONE, "2-HIGH", "AAPL", "TSLA")),
        "enough_rows": lambda s, d: quality.enough_rows(bars(s, d)),
        "chronological_split": lambda s, d: splits.chronological_split(bars(s, d)).select(
            "ticker", "date", "row_num", F.col("split")
        ),
        "chronological_split_segmented": lambda s, d: splits.chronological_split(bars(s, d), limits=CUT).select(
            "ticker", "date", "row_num", F.col("split")
        ),
        "validation_rows": lambda s, d: splits.row_range(splits.row_numbers(bars(s, d)), 100, 200).select(
            "ticker", "date", "row_num"
        ),
        "stratified_split": lambda s, d: splits.stratified_split(labelled(s, d), "label", ["ticker", "date"]).select(
            "ticker", "date", "label", F.col("split")
        ),
        "stratified_split_selected": lambda s, d: splits.stratified_split(
            labelled(s, d), "label", ["ticker", "date"], small_bytes=0
        ).select("ticker", "date", "label", F.col("split")),
        "stratified_split_duplicate_keys": lambda s, d: splits.stratified_split(
            labelled(s, d), "label", ["ticker"], ties=["date"]
        ).select("ticker", "date", "label", F.col("split")),
        "stratified_split_duplicate_keys_selected": lambda s, d: splits.stratified_split(
            labelled(s, d), "label", ["ticker"], small_bytes=0, ties=["date"]
        ).select("ticker", "date", "label", F.col("split")),
        "zscore": lambda s, d: rounded(
            splits.standardise(features(s, d), ["close", "rsi"], ["ticker"]), "ticker", "date", "close_z", "rsi_z"
        ),
        "regression_metrics": lambda s, d: rounded(metrics.regression_metrics(persistence(s, d), by=["ticker"])),
        "accuracy": lambda s, d: rounded(metrics.accuracy(two_classes(s, d))),
        "classification_report": lambda s, d: rounded(metrics.classification_report(two_classes(s, d))),
        "drift_forecast": lambda s, d: drift_forecast(features(s, d), sigma=0, decimals=4),
        "drift_forecast_noise": lambda s, d: drift_forecast(features(s, d), steps=14),
        "forecast_table": lambda s, d: forecast_table(features(s, d), sigma=0),
        "message_intent": lambda s, d: stock_page.tag_messages(table(s, d, "conversations"), **intent_pieces).select(
            "conv_id", "turn", "intent", "ticker"
        ),
        "message_intent_default": lambda s, d: stock_page.tag_messages(table(s, d, "conversations")).select(
            "conv_id", "turn", "intent", "ticker"
        ),
        "stock_page_metrics": lambda s, d: stock_page.page_metrics(features(s, d)),
        "stock_page": whole_page,
        "stock_page_table": lambda s, d: rounded(stock_page.page_table(features(s, d))),
        "answer_table": lambda s, d: _rounded_as_is(stock_page.answer_table(features(s, d))),
        "union_series": lambda s, d: rounded(
            latest.concatenate([bars(s, d), latest.series_rows(bars(s, d), "5-LOW")])
        ),
        "vendor_frame": vendor_frame,
        "csv_roundtrip": csv_roundtrip,
        "vendor_wide": lambda s, d: rounded(shape.normalise_vendor_wide(vendor_table(s, d))),
        "bar_files": bar_files,
        "bar_file_manifest": bar_file_manifest,
        "bucketed_latest": bucketed_latest,
        "bucketed_average": bucketed_average,
        "kept_stock_rows": kept_stock_rows,
        "message_tickers_many": lambda s, d: table(s, d, "conversations").select(
            "conv_id", "turn", mentioned_ticker(F.col("text"), MANY_PIECES).alias("ticker")
        ),
        "gbt_forecast_many": gbt_forecast_many,
        "many_model_roundtrip": many_model_roundtrip,
        "forecaster_roundtrip": forecaster_roundtrip,
        "classifier_roundtrip": classifier_roundtrip,
        "collect_preprocess": collect_preprocess,
        "parquet_roundtrip": parquet_roundtrip,
        "table_roundtrip": table_roundtrip,
        "table_preview": table_preview,
        "gbt_forecast": gbt_forecast,
        "gbt_forecast_pooled": gbt_forecast_pooled,
        "grade_classifier": grade_classifier,
        "grade_board": grade_board,
        "prediction_contract": prediction_contract,
        "trained_contract": trained_contract,
    }


def _rounded_as_is(df: DataFrame) -> DataFrame:
    names = df.columns
    return rounded(df).toDF(*names)
