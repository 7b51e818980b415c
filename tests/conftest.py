import json
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from eventide.session import get_session
    s = get_session("local[4]", 4, app_name="eventide-tests")
    yield s
    s.stop()


@pytest.fixture
def payloads(spark):
    """DataFrame of (seq, payload VARIANT) from JSON texts."""
    from pyspark.sql import functions as F

    def make(*texts):
        rows = [(i, t if isinstance(t, str) else json.dumps(t)) for i, t in enumerate(texts)]
        return spark.createDataFrame(rows, "seq long, p string").select(
            "seq", F.try_parse_json("p").alias("payload"))
    return make
