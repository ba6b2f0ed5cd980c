import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from tidings.session import get_spark
    s = get_spark("local[4]", shuffle_partitions=4,
                  extra={"spark.checkpoint.dir": str(tmp_path_factory.mktemp("ckpt"))})
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf_small():
    if not os.path.isdir(SF_SMALL):
        pytest.skip("driver tables not present")
    return SF_SMALL
