import sys
from datetime import datetime, timezone
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from lognorm.session import local_session, ship_package  # noqa: E402

T0 = datetime(2026, 9, 10, 17, 44, 21, 287394, tzinfo=timezone.utc)


@pytest.fixture(scope="session")
def spark():
    session = local_session()
    ship_package(session)
    return session


@pytest.fixture
def records(spark):
    """Payloads (bytes or text) as raw records, one second apart."""
    from datetime import timedelta

    def make(payloads, seconds=None):
        rows = [
            (i, p if isinstance(p, bytes) else p.encode(), T0 + timedelta(seconds=(seconds or range(len(payloads)))[i]), "test")
            for i, p in enumerate(payloads)
        ]
        return spark.createDataFrame(rows, "n int, raw binary, ingest_ts timestamp, source string")

    return make
