import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from martflow.session import build_session
    s = build_session("local[*]", 8)
    # Tests own their scratch space; a cluster supplies spark.checkpoint.dir.
    if not s.conf.get("spark.checkpoint.dir", None):
        d = tempfile.mkdtemp(prefix="martflow-test-ckpt-")
        s.conf.set("spark.checkpoint.dir", d)
        s.sparkContext.setCheckpointDir(d)
    yield s


@pytest.fixture()
def scratch():
    return tempfile.mkdtemp(prefix="martflow-test-")


@pytest.fixture(autouse=True)
def few_stream_partitions(request):
    """Streams keep one state store per shuffle partition; a few rows need few."""
    if request.module.__name__.rpartition(".")[2] not in ("test_streaming", "test_apps", "test_stream_tables"):
        yield
        return
    s = request.getfixturevalue("spark")
    old = s.conf.get("spark.sql.shuffle.partitions")
    s.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    s.conf.set("spark.sql.shuffle.partitions", old)
