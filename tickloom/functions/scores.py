"""Composite investment score, grade and RSI zone as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tickloom.functions.scalar import clamp, is_missing, or_default

# Weights of the composite score, grade limits, RSI zone limits.
WEIGHTS = {"return": 0.30, "trend": 0.20, "rsi": 0.15, "volatility": 0.15, "sharpe": 0.20}
HIGH_FROM, MEDIUM_FROM = 7.0, 4.0
OVERBOUGHT, OVERSOLD = 70.0, 30.0


def return_score(total_return: Column) -> Column:
    """10 points at a total return of 10 % and above, 0 at a loss."""
    return clamp(total_return * 100, 0.0, 10.0)


def trend_score(short: Column, long: Column) -> Column:
    """8 if both moving-average ratios rise, 2 if both fall, 5 otherwise."""
    known = ~is_missing(short) & ~is_missing(long)
    return (
        F.when(known & (short > 0) & (long > 0), F.lit(8.0))
        .when(known & (short < 0) & (long < 0), F.lit(2.0))
        .otherwise(F.lit(5.0))
    )


def rsi_score(rsi: Column) -> Column:
    """Best at RSI 50, which is also the default."""
    return F.lit(10.0) - F.abs(or_default(rsi, 50.0) - 50) / 5


def volatility_score(volatility: Column) -> Column:
    """10 points for no volatility, 0 from 50 on; 10 is the default volatility."""
    return F.greatest(F.lit(10.0) - or_default(volatility, 10.0) / 5, F.lit(0.0))


def sharpe_score(sharpe: Column) -> Column:
    """Maps a Sharpe ratio of -1..1 to 0..10; 0 is the default ratio."""
    return clamp((or_default(sharpe, 0.0) + 1) * 5, 0.0, 10.0)


def composite_score(
    total_return: Column, short: Column, long: Column, rsi: Column, volatility: Column, sharpe: Column
) -> Column:
    """Weighted sum of the five scores, rounded to 2 decimals; null where the
    total return is unknown."""
    total = (
        return_score(total_return) * WEIGHTS["return"]
        + trend_score(short, long) * WEIGHTS["trend"]
        + rsi_score(rsi) * WEIGHTS["rsi"]
        + volatility_score(volatility) * WEIGHTS["volatility"]
        + sharpe_score(sharpe) * WEIGHTS["sharpe"]
    )
    return F.round(total, 2)


def grade(score: Column) -> Column:
    """High, Medium or Low from the rounded score; an unknown score is Low."""
    return F.when(score >= HIGH_FROM, F.lit("High")).when(score >= MEDIUM_FROM, F.lit("Medium")).otherwise(F.lit("Low"))


def rsi_zone(rsi: Column) -> Column:
    return (
        F.when(rsi >= OVERBOUGHT, F.lit("overbought")).when(rsi <= OVERSOLD, F.lit("oversold")).otherwise(F.lit("neutral"))
    )
