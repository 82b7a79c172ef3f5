import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from skuflow.schema import TRANSACTION  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    from skuflow.config import local_session

    s = local_session("4", shuffle_partitions=4, app="skuflow-tests")
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture
def tx(spark):
    """Build transactions from (store, sku, type, quantity, price) rows in arrival order."""

    def make(rows, with_id=True):
        data = [
            (i if with_id else None, r[0], r[1], r[3], r[2], r[4] if len(r) > 4 else None, None)
            for i, r in enumerate(rows)
        ]
        return spark.createDataFrame(data, TRANSACTION)

    return make


def stock_map(df, key="itemID"):
    return {r[key]: r["currentStock"] for r in df.collect()}
