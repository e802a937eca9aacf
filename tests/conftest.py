from __future__ import annotations

import datetime as dt
import pathlib
import sys

import pytest

ROOT = pathlib.Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

from tillsight.session import local_session  # noqa: E402
from tillsight.sources.schema import RAW  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session("tests", partitions=4, memory="4g", **{
        "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
    })
    yield session
    session.stop()


DEFAULTS = {
    "order_id": "O-1", "order_date": dt.date(2022, 1, 1), "ship_date": dt.date(2022, 1, 4),
    "ship_mode": "Standard Class", "customer_id": "C-1", "customer_name": "Ann", "segment": "Consumer",
    "region": "North", "city": "Delhi", "category": "Books", "product_name": "Atlas", "quantity": 1,
    "unit_price": 100.0, "discount": 0.0, "sales": 100.0, "profit": 20.0, "profit_margin": 20.0,
}


@pytest.fixture(scope="session")
def orders(spark):
    """orders({...}, {...}): raw orders that differ from the defaults as given."""
    def make(*changes):
        rows = [{**DEFAULTS, "order_id": f"O-{i}", **c} for i, c in enumerate(changes, 1)]
        return spark.createDataFrame([tuple(r[f] for f in RAW.fieldNames()) for r in rows], RAW)
    return make


@pytest.fixture(scope="session")
def prepared(orders):
    from tillsight.operators.features import with_row_features

    def make(*changes):
        return with_row_features(orders(*changes))
    return make


def values(frame):
    return [tuple(r) for r in frame.collect()]
