import math
import statistics

import pytest
from conftest import column

from tickloom import schema
from tickloom.operators import indicators as ind
from tickloom.operators.shape import lower_names
from tickloom.plans.preprocessing import feature_table


def test_moving_average_uses_partial_frames(bars):
    out = ind.moving_averages(bars(A=[10, 20, 30, 40]), windows=[3])
    assert column(out, "MA_3") == [10, 15, 20, 30]


def test_rsi_of_first_row_and_of_flat_prices(bars):
    out = ind.rsi(bars(A=[10, 11, 10, 10], B=[5] * 40))
    assert column(out, "RSI", "A")[0] == pytest.approx(99.00990099)
    assert all(v == pytest.approx(99.00990099) for v in column(out, "RSI", "B"))


def test_rsi_by_hand(bars):
    closes = [10, 12, 11, 14, 13, 13]
    changes = [0] + [b - a for a, b in zip(closes, closes[1:])]
    want = []
    for i in range(len(closes)):
        frame = changes[max(0, i - 2) : i + 1]
        gain = sum(c for c in frame if c > 0) / len(frame)
        loss = sum(-c for c in frame if c < 0) / len(frame)
        strength = 100 if loss == 0 else gain / loss
        want.append(100 - 100 / (1 + strength))
    assert column(ind.rsi(bars(A=closes), window=3), "RSI") == pytest.approx(want)


def test_volatility_is_the_sample_deviation_of_the_level(bars):
    got = column(ind.volatility(bars(A=[10, 11, 13]), window=2), "Volatility")
    assert got[0] is None
    assert got[1:] == pytest.approx([statistics.stdev([10, 11]), statistics.stdev([11, 13])])


def test_returns_and_sharpe(bars):
    out = ind.returns(bars(A=[10, 11, 10, 10]))
    assert column(out, "Daily_Return")[0] is None
    assert column(out, "Daily_Return")[1:] == pytest.approx([0.1, -1 / 11, 0])
    sharpe = column(out, "Sharpe_Ratio")
    assert sharpe[:2] == [None, None]
    moves = [0.1, -1 / 11]
    assert sharpe[2] == pytest.approx(statistics.mean(moves) / statistics.stdev(moves))


def test_flat_prices_have_zero_sharpe_and_volatility(bars):
    out = feature_table(bars(A=[7] * 40))
    assert set(column(out, "Sharpe_Ratio")) == {0.0}
    assert set(column(out, "Volatility")) == {0.0}


def test_zero_close_gives_null_return_without_error(bars):
    assert column(ind.returns(bars(A=[0, 5])), "Daily_Return") == [None, None]


def test_series_do_not_mix(bars):
    alone = column(feature_table(bars(A=[10, 12, 9, 14, 13])), "RSI", "A")
    together = column(feature_table(bars(A=[10, 12, 9, 14, 13], B=[100, 1, 50, 2, 70])), "RSI", "A")
    assert alone == together


def test_first_two_rows_of_a_series_are_dropped(bars):
    out = feature_table(bars(A=range(10, 30), B=range(50, 60)))
    assert out.filter("ticker = 'A'").count() == 18
    assert out.filter("ticker = 'B'").count() == 8


def test_missing_close_keeps_its_frame_position(bars):
    out = ind.moving_averages(bars(A=[10, None, 30, 40]), windows=[2])
    assert column(out, "MA_2") == [10, 10, 30, 35]
    kept = column(feature_table(bars(A=[10, 11, None, 13, 14, 15, 16])), "close")
    assert kept == [14, 15, 16]


def test_feature_table_columns_and_ranges(bars):
    closes = [100 + 10 * math.sin(i) for i in range(120)]
    out = feature_table(bars(A=closes))
    assert out.columns[-7:] == schema.INDICATOR_COLUMNS
    assert all(0 <= v <= 100 for v in column(lower_names(out), "rsi"))


def test_single_operators_agree_with_the_joint_one(bars):
    df = bars(A=[100 + 10 * math.sin(i) for i in range(100)], B=[50 + i % 7 for i in range(50)])
    joint = ind.indicators(df)
    singles = {"MA_90": ind.moving_averages, "RSI": ind.rsi, "Volatility": ind.volatility, "Sharpe_Ratio": ind.returns}
    for name, operator in singles.items():
        for got, want in zip(column(operator(df), name, "A"), column(joint, name, "A"), strict=True):
            assert got == want or got == pytest.approx(want)
