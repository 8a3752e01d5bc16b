"""Cut series give what whole series give, wherever the cuts fall."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tickloom.operators import segments, features, indicators, splits
from tickloom.operators.segments import CORE, SEGMENT, SegmentLimits, lay_out

WHOLE = SegmentLimits(small_bytes=1 << 50)


def cut(rows, **more):
    return SegmentLimits(max_rows=rows, small_bytes=0, **more)


@pytest.fixture(scope="module")
def uneven(spark):
    """A long series with gaps and bursts, a short one, and one without a name."""
    rng = random.Random(7)
    rows = []
    for ticker, n in (("LONG", 700), ("SHORT", 40), (None, 260)):
        day = dt.date(1990, 1, 1)
        for i in range(n):
            day += dt.timedelta(days=rng.choice([1, 1, 1, 1, 3, 200 if i % 97 == 0 else 1]))
            price = None if rng.random() < 0.02 else round(rng.uniform(10, 20), 3)
            rows.append((ticker, day, price, price, price, price, i))
    frame = spark.createDataFrame(
        rows, "ticker string, date date, open double, high double, low double, close double, volume long"
    )
    return frame.repartition(5).cache()


def rows_of(df):
    names = sorted(df.columns)
    rounded = [
        F.round(f.name, 9).alias(f.name) if f.dataType.typeName() == "double" else F.col(f.name)
        for f in df.select(*names).schema
    ]
    return sorted(map(repr, df.select(*rounded).collect()))


@pytest.mark.parametrize("limits", [cut(100), cut(190, slot_days=3), cut(260, slot_days=4096)])
def test_indicators(uneven, limits):
    assert lay_out(uneven, before=89, limits=limits).is_cut
    want = rows_of(indicators.indicators(uneven, limits=WHOLE))
    assert rows_of(indicators.indicators(uneven, limits=limits)) == want


@pytest.mark.parametrize("limits", [cut(80), cut(150, slot_days=1)])
def test_lags_and_target(uneven, limits):
    for horizon in (1, 7):
        want = rows_of(features.lag_features(uneven.na.drop(), depth=5, horizon=horizon, limits=WHOLE))
        assert rows_of(features.lag_features(uneven.na.drop(), depth=5, horizon=horizon, limits=limits)) == want


def test_classifier_features(uneven):
    table = uneven.withColumns({c: F.col("close") + i for i, c in enumerate(("rsi", "ma_7", "ma_30", "ma_90"))})
    want = rows_of(features.classifier_features(table, limits=WHOLE))
    assert rows_of(features.classifier_features(table, limits=cut(70))) == want


def test_iso_date_strings(uneven):
    text = uneven.withColumn("date", F.col("date").cast("string"))
    want = rows_of(indicators.moving_averages(text, limits=WHOLE))
    assert rows_of(indicators.moving_averages(text, limits=cut(100))) == want


def test_positions_and_split(uneven):
    want = rows_of(splits.chronological_split(uneven, limits=WHOLE))
    assert rows_of(splits.chronological_split(uneven, limits=cut(64))) == want
    want = rows_of(splits.row_numbers(uneven, limits=WHOLE))
    assert rows_of(splits.row_numbers(uneven, limits=cut(64))) == want


def test_total_return_starts_at_the_first_row(uneven):
    filled = uneven.na.fill(15.0)
    assert rows_of(features.total_return(filled, limits=cut(50))) == rows_of(
        features.total_return(filled, limits=WHOLE)
    )


def test_timestamps(spark):
    rows = spark.range(3000).select(
        F.lit("A").alias("ticker"),
        F.timestamp_seconds(F.col("id") * 37 + F.pmod(F.col("id") * 7919, F.lit(29))).alias("date"),
        (F.pmod(F.col("id") * 7907, F.lit(101)) + 1).cast("double").alias("close"),
    )
    want = rows_of(indicators.moving_averages(rows, limits=WHOLE))
    assert rows_of(indicators.moving_averages(rows, limits=cut(300))) == want


def test_segments_are_bounded_and_hold_every_row_once(uneven):
    layout = lay_out(uneven, before=20, after=3, limits=cut(100))
    assert layout.df.filter(CORE).count() == uneven.count()
    sizes = layout.df.filter("ticker = 'LONG'").groupBy(SEGMENT).count().collect()
    assert len(sizes) >= 5
    assert max(r["count"] for r in sizes) <= 100 + 50 + 20 + 3 + 2 * 50
    assert layout.df.filter("ticker = 'SHORT'").select(SEGMENT).distinct().count() == 1


def test_short_series_are_not_cut(uneven):
    assert not lay_out(uneven, before=89, limits=SegmentLimits(small_bytes=0)).is_cut


def test_same_time_rows_stay_together(spark):
    rows = spark.range(500).select(
        F.lit("A").alias("ticker"), F.lit(dt.date(2024, 1, 1)).alias("date"), F.lit(1.0).alias("close")
    )
    out = indicators.moving_averages(rows, windows=[3], limits=cut(50))
    assert out.count() == 500 and out.filter("MA_3 = 1.0").count() == 500


def test_a_series_without_times_leaves_others_their_cuts(spark):
    dated = spark.range(3000).select(F.lit("B").alias("ticker"), F.date_add(F.lit("2000-01-01").cast("date"), F.col("id").cast("int")).alias("date"), F.col("id").cast("double").alias("close"))
    bare = spark.range(1200).select(F.lit("A").alias("ticker"), F.when(F.col("id") >= 900, F.date_add(F.lit("2000-01-01").cast("date"), F.col("id").cast("int"))).alias("date"), F.col("id").cast("double").alias("close"))
    df = dated.unionByName(bare)
    limits = segments.SegmentLimits(max_rows=100, small_bytes=0)
    layout = segments.lay_out(df, before=5, limits=limits)
    sizes = {(r["ticker"], r[segments.SEGMENT]): r["count"] for r in layout.df.groupBy("ticker", segments.SEGMENT).count().collect()}
    assert max(n for (ticker, _), n in sizes.items() if ticker == "B") <= 220
    cut = layout.finish(layout.df.withColumn("sum", F.sum("close").over(layout.last_rows(6)))).filter("ticker = 'B'")
    assert all(r["sum"] == sum(range(max(0, int(r["close"]) - 5), int(r["close"]) + 1)) for r in cut.collect())
    assert cut.count() == 3000


@pytest.mark.parametrize("kind", ["none", "seconds", "some"])
def test_tied_rows_are_cut_and_equal_the_uncut_series(spark, kind):
    """All rows without a time, all within few seconds, or some on few days; with columns that decide between them."""
    day = F.date_add(F.lit("2024-01-01").cast("date"), F.floor(F.col("id") / 400).cast("int"))
    times = {
        "none": F.lit(None).cast("date"), "some": F.when(F.col("id") % 3 > 0, day),
        "seconds": F.timestamp_seconds(F.floor(F.col("id") / 600)),
    }
    rows = spark.range(1200).select(
        F.lit("A").alias("ticker"), times[kind].alias("date"), (F.pmod(F.col("id") * 7907, F.lit(1201)) + 1).cast("double").alias("close")
    ).unionByName(spark.range(30).select(F.lit("B").alias("ticker"), times[kind].alias("date"), F.col("id").cast("double").alias("close")))
    whole = SegmentLimits(small_bytes=1 << 50, ties=("close",))
    parts = cut(100, ties=("close",))
    layout = lay_out(rows.repartition(5), before=6, limits=parts)
    sizes = [r["count"] for r in layout.df.filter("ticker = 'A'").groupBy(SEGMENT).count().collect()]
    assert len(sizes) >= 4 and max(sizes) <= 400
    assert layout.df.filter(CORE).count() == rows.count()
    for run in (
        lambda limits: splits.chronological_split(rows, limits=limits),
        lambda limits: features.total_return(rows, limits=limits),
    ):
        assert rows_of(run(parts)) == rows_of(run(whole))


def test_tied_rows_are_cut_without_named_ties(spark):
    """Without columns that decide, the order is any; every row still has one place."""
    rows = spark.range(900).select(F.lit("A").alias("ticker"), F.lit(None).cast("date").alias("date"), F.col("id").cast("double").alias("close"))
    numbered = splits.chronological_split(rows, limits=cut(100))
    assert sorted(r["row_num"] for r in numbered.collect()) == list(range(1, 901))
    assert {r["split"]: r["count"] for r in numbered.groupBy("split").count().collect()} == {"train": 720, "val": 90, "test": 90}
    assert numbered.columns == ["ticker", "date", "close", "row_num", "split"]
