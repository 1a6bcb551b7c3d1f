import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    import tempfile

    from slotplan.session import local_session
    wh = tempfile.mkdtemp(prefix="slotplan-wh-")
    s = local_session(4, shuffle_partitions=4, app="slotplan-tests",
                      extra={"spark.sql.warehouse.dir": wh})
    yield s
    s.stop()


def rows(df, *cols):
    cols = cols or df.columns
    return [tuple(r[c] for c in cols) for r in df.collect()]
