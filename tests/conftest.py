import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from sensorgrid.session import get_session
    os.environ.setdefault("SENSORGRID_DRIVER_MEMORY", "8g")
    s = get_session("local[4]", 4, extra={"spark.checkpoint.dir": tempfile.mkdtemp(prefix="sg-test-ckpt-")})
    yield s


def ts(s):
    import datetime as dt
    return dt.datetime.strptime(s, "%Y-%m-%d %H:%M")


@pytest.fixture
def mkdf(spark):
    def make(rows, schema):
        return spark.createDataFrame(rows, schema)
    return make
