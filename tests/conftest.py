from __future__ import annotations

import datetime as dt
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from cartlens import schemas  # noqa: E402
from cartlens.session import local_session  # noqa: E402

AS_OF = dt.datetime(2024, 2, 1, 12, 0, 0)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    return local_session(
        8,
        "tests",
        {
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("checkpoints")),
        },
    )


def moment(text: str) -> dt.datetime:
    return dt.datetime.fromisoformat(text)


@pytest.fixture(scope="session")
def make_events(spark):
    """Events from partial rows; the rest is filled with harmless values."""

    def make(*rows: dict):
        filled = []
        for number, row in enumerate(rows):
            event = {
                "event_id": f"EVT_{number:016X}",
                "event_type": "page_view",
                "user_id": "USER_0000000000B7",
                "session_id": "SES_00000000000B7C15",
                "timestamp": "2024-01-10 10:00:00",
                "properties": "{}",
                "device": "mobile",
                "country": "US",
                "traffic_source": "organic",
                "product_id": None,
                "category": None,
                "revenue": 0.0,
            } | row
            if isinstance(event["timestamp"], str):
                event["timestamp"] = moment(event["timestamp"])
            filled.append(tuple(event[name] for name in schemas.EVENTS.names))
        return spark.createDataFrame(filled, schemas.EVENTS)

    return make


def rows(df, *columns):
    return [tuple(row) for row in df.select(*columns).collect()]
