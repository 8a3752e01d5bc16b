"""Intent and ticker of a chat message, from keyword lists."""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from tickloom.schema import DEFAULT_TICKERS

# The words that mark a message.
PREDICTION_WORDS = ("predict", "forecast", "next", "future", "price")
DATA_WORDS = ("show", "data", "history", "tell me about", "info")


# Up to so many tickers each is looked for by itself, in built-in functions.
FEW_TICKERS = 64


def _contains_any(text: Column, words: Sequence[str]) -> Column:
    found = F.lit(False)
    for word in words:
        found = found | text.contains(word.lower())
    return found


def mentioned_ticker(message: Column, tickers: Sequence[str] = DEFAULT_TICKERS) -> Column:
    """The first listed ticker that the message contains, in list order.

    A long list is looked up by the pieces of the message instead: the cost
    follows the length of the message and the number of different lengths of
    tickers, not the length of the list.
    """
    text = F.lower(message)
    if len(tickers) > FEW_TICKERS:
        return _first_of(tickers)(text)
    return F.coalesce(F.lit(None).cast("string"), *[F.when(text.contains(t.lower()), F.lit(t.upper())) for t in tickers])


def _first_of(tickers: Sequence[str]):
    """A function that finds the first of the tickers in lower-case texts."""
    ranks: dict[str, int] = {}
    for rank, ticker in enumerate(tickers):
        ranks.setdefault(ticker.lower(), rank)
    lengths = sorted({len(t) for t in ranks})
    names = [t.upper() for t in tickers]

    def first(text: str | None) -> str | None:
        if text is None:
            return None
        found = [ranks[p] for n in lengths for i in range(len(text) - n + 1) if (p := text[i : i + n]) in ranks]
        return names[min(found)] if found else None

    @F.pandas_udf("string")
    def look_up(texts: pd.Series) -> pd.Series:
        return texts.map(first, na_action="ignore").astype(object)

    return look_up


def message_intent(
    message: Column,
    tickers: Sequence[str] = DEFAULT_TICKERS,
    prediction_words: Sequence[str] = PREDICTION_WORDS,
    data_words: Sequence[str] = DATA_WORDS,
) -> Column:
    """`prediction`, `data` or `chat`; a message that only names a ticker asks
    for a prediction."""
    text = F.lower(message)
    return (
        F.when(_contains_any(text, prediction_words), F.lit("prediction"))
        .when(_contains_any(text, data_words), F.lit("data"))
        .when(mentioned_ticker(message, tickers).isNotNull(), F.lit("prediction"))
        .otherwise(F.lit("chat"))
    )
