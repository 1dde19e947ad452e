import os
import sys

import pytest
from hypothesis import settings

# Property tests draw the same examples on every run (set HYPOTHESIS_PROFILE=explore for
# fresh random draws while developing).
settings.register_profile("repeatable", derandomize=True, database=None)
settings.register_profile("explore")
settings.load_profile(os.environ.get("HYPOTHESIS_PROFILE", "repeatable"))

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from marquee.session import local_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    s = local_session("*", shuffle_partitions=8, app="marquee-tests")
    yield s
    s.stop()


def rows(df):
    return [r.asDict(recursive=True) for r in df.collect()]
