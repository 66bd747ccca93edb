from __future__ import annotations

import os
import sys
from datetime import datetime

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from meterlake.session import checkpoint_root, get_session  # noqa: E402
from meterlake.sources.schema import READINGS  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    warehouse = tmp_path_factory.mktemp("warehouse")
    s = get_session("local[4]", "meterlake-tests", shuffle_partitions=4,
                    extra={"spark.sql.warehouse.dir": str(warehouse)})
    s.sparkContext.setLogLevel("ERROR")
    checkpoint_root(s)  # uses the configured shared folder; makes one only if unset
    yield s
    s.stop()


def ts(text: str) -> datetime:
    return datetime.fromisoformat(text)


@pytest.fixture
def make_readings(spark):
    """Readings DataFrame from (timestamp text, meter, power[, voltage]) tuples."""
    def build(rows):
        full = []
        for r in rows:
            t, meter, power = r[0], r[1], r[2]
            volts = r[3] if len(r) > 3 else 230.0
            energy = None if power is None else power * 5 / 60 / 1000
            current = None if power is None or not volts else power / volts
            full.append((ts(t) if t else None, meter, power, volts, current, 50.0, energy))
        return spark.createDataFrame(full, schema=_nullable(READINGS))
    return build


def _nullable(schema):
    from pyspark.sql import types as T
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in schema.fields])
