"""Trains and applies the grade classifier."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom import schema
from tickloom.operators.features import classifier_features
from tickloom.operators.labels import add_labels
from tickloom.operators.latest import value_counts
from tickloom.operators.metrics import accuracy, classification_report
from tickloom.operators.models import (
    FOREST_DEPTH,
    FOREST_TREES,
    grade_board,
    grade_classifier,
    predict_grades,
    save_model,
)
from tickloom.operators.segments import SegmentLimits
from tickloom.operators.sizing import place
from tickloom.operators.splits import stratified_split
from tickloom.session import stage


@dataclass(frozen=True)
class Classification:
    model: PipelineModel
    grade_counts: DataFrame
    accuracy: DataFrame
    report: DataFrame
    board: DataFrame


def labelled_rows(serving: DataFrame, limits: SegmentLimits | None = None) -> DataFrame:
    """Per-series features, composite score and grade, complete rows only."""
    return add_labels(classifier_features(serving, limits=limits))


def train_classifier(labelled: DataFrame, trees: int = FOREST_TREES, max_depth: int = FOREST_DEPTH) -> tuple[PipelineModel, DataFrame]:
    """Fits on a stratified 80 % of the rows; returns the model and the
    predictions for the rest, with their true `label`. The split is staged, as
    fitting reads the rows several times."""
    split = stage(stratified_split(labelled, "label", ["ticker", "date"]), "split")
    train = split.filter(F.col("split") == "train").na.drop(subset=schema.CLASSIFIER_FEATURES)
    model = grade_classifier(trees, max_depth).fit(place(train, ["ticker", "date"]))
    test = split.filter(F.col("split") == "test").withColumn("true_label", F.col("label"))
    return model, predict_grades(model, test).withColumnRenamed("true_label", "label")


def run_classification(
    serving: DataFrame,
    model_path: str | None = None,
    limits: SegmentLimits | None = None,
    trees: int = FOREST_TREES,
    max_depth: int = FOREST_DEPTH,
) -> Classification:
    """Labels, split, fit, report, save and grade board over the serving table."""
    labelled = stage(labelled_rows(serving, limits), "labelled")
    model, predicted = train_classifier(labelled, trees, max_depth)
    predicted = stage(predicted.select("label", "predicted_label"), "predicted")
    if model_path:
        save_model(model, model_path)
    return Classification(
        model,
        value_counts(labelled, "label", schema.GRADES),
        accuracy(predicted, prediction="predicted_label"),
        classification_report(predicted, prediction="predicted_label"),
        grade_board(model, labelled),
    )
