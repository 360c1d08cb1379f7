import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_TINY = "/root/testdata/sf0.001"
SF_SMALL = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from orderlake.session import build_session
    s = build_session("local[4]", shuffle_partitions=4, app_name="orderlake-tests")
    yield s


@pytest.fixture(scope="session")
def tiny(spark):
    from orderlake.tables import Tables
    return Tables(spark, SF_TINY)


@pytest.fixture(scope="session")
def small(spark):
    from orderlake.tables import Tables
    return Tables(spark, SF_SMALL)


def plan_text(df) -> str:
    """The formatted physical plan, as ``explain`` prints it."""
    import contextlib
    import io
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()
