import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from poolbook.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    conf = {}
    # Tests own their checkpoint folder only when the environment names none.
    if not os.environ.get("SPARK_CHECKPOINT_DIR"):
        conf["spark.checkpoint.dir"] = tempfile.mkdtemp(prefix="poolbook-test-ckpt-")
    s = build_session("local[4]", app_name="poolbook-tests", shuffle_partitions=4, extra_conf=conf)
    yield s


@pytest.fixture()
def scratch():
    return tempfile.mkdtemp(prefix="poolbook-test-")
