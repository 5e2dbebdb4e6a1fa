import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from lakeweave.session import get_session
    extra = {}
    # Tests set their own checkpoint folder only when the environment has none.
    from pyspark import SparkConf
    if not SparkConf().get("spark.checkpoint.dir", None):
        extra["spark.checkpoint.dir"] = tempfile.mkdtemp(prefix="lakeweave-test-")
    s = get_session("local[4]", shuffle_partitions=4, app_name="lakeweave-tests", extra=extra)
    yield s


@pytest.fixture()
def fresh(spark):
    from lakeweave.session import shared_dir
    from lakeweave.sources.tables import VersionedTable

    def make(name="t"):
        return VersionedTable(spark, shared_dir(spark, name))
    return make
