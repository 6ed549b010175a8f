import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from adlife.session import local_session
    s = local_session(cpus=4, shuffle_partitions=4, app="adlife-tests",
                      extra={"spark.checkpoint.dir": tempfile.mkdtemp(prefix="adlife-tests-")})
    yield s
    s.stop()


@pytest.fixture()
def workdir(spark):
    from adlife.session import table_path
    import uuid
    return table_path(spark, "pytest", uuid.uuid4().hex[:10])
