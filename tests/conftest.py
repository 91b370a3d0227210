import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from aidspark.session import get_session
    s = get_session("local[4]", app="aidspark-tests", shuffle_partitions=8)
    if not (s.conf.get("spark.checkpoint.dir", None) or s.sparkContext.getCheckpointDir()):
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="aidspark-test-ckpt-"))
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir(spark):
    from aidspark.session import scratch_dir
    return scratch_dir(spark, "test")


def write_text(path, name, text):
    os.makedirs(path, exist_ok=True)
    p = os.path.join(path, name)
    with open(p, "wb") as f:
        f.write(text if isinstance(text, bytes) else text.encode("utf-8"))
    return p
