import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from lakelens.session import get_session
    s = get_session("local[4]", app="lakelens-tests", shuffle_partitions=8,
                    extra={"spark.sql.shuffle.partitions": "8"})
    yield s


@pytest.fixture()
def tmpdir_path():
    return tempfile.mkdtemp(prefix="lakelens-test-", dir="/tmp")
