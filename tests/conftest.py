import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

SMOKE = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from cardlake.session import local_session
    s = local_session("*", shuffle_partitions=8, app="cardlake-tests",
                      checkpoint_dir=str(tmp_path_factory.mktemp("shared")))
    yield s
    s.stop()


@pytest.fixture
def tmp_root(spark):
    from cardlake.session import shared_path
    return shared_path(spark, "tests")
