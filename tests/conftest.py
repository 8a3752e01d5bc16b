import datetime as dt

import pytest

from tickloom.session import build_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[4]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def bars(spark):
    """Makes bars from closes per series, one per day; None is a missing close."""

    def make(start=dt.date(2024, 1, 1), **series):
        rows = []
        for ticker, closes in series.items():
            for i, close in enumerate(closes):
                value = None if close is None else float(close)
                rows.append((ticker, start + dt.timedelta(days=i), value, value, value, value, 100 + i))
        schema = "ticker string, date date, open double, high double, low double, close double, volume long"
        return spark.createDataFrame(rows, schema)

    return make


def column(df, name, ticker=None):
    rows = df.filter(f"ticker = '{ticker}'") if ticker else df
    return [r[name] for r in rows.orderBy("date").collect()]
