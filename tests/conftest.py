import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from compare import session

    s = session()
    s.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("checkpoint")))
    return s


@pytest.fixture(scope="session")
def bars_of(spark):
    """A panel from {column: {ticker: values}}, one row per week."""
    import datetime

    import pandas as pd

    def make(columns, start="2020-01-06"):
        first = next(iter(columns.values()))
        rows = []
        for ticker, values in first.items():
            for i in range(len(values)):
                day = datetime.date.fromisoformat(start) + datetime.timedelta(weeks=i)
                rows.append((ticker, day, *[columns[c][ticker][i] for c in columns]))
        pdf = pd.DataFrame(rows, columns=["ticker", "trade_date", *columns])
        schema = "ticker long, trade_date date, " + ", ".join(f"{c} double" for c in columns)
        data = [(*r[:2], *[None if v is None else float(v) for v in r[2:]]) for r in rows]
        return spark.createDataFrame(data, schema), pdf

    return make
