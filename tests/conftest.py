import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from strata.session import get_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    extra = {}
    # Tests name their own shared folder only where the environment gives none.
    if not os.environ.get("SPARK_CONF_DIR") and not _has_checkpoint_conf():
        extra["spark.checkpoint.dir"] = tempfile.mkdtemp(prefix="strata-test-ckpt-")
    session = get_session("strata-tests", master="local[4]", shuffle_partitions=8, extra_conf=extra)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def _has_checkpoint_conf() -> bool:
    from pyspark import SparkConf

    return SparkConf().contains("spark.checkpoint.dir")


@pytest.fixture()
def rules():
    from strata.functions.rules import load_rules

    return load_rules()
