import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from folio.session import build_session, checkpoint_dir, use_checkpoint_dir  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session("local[4]", app_name="folio-tests", shuffle_partitions=8,
                            conf={"spark.driver.memory": "4g",
                                  "spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="folio-wh-", dir="/tmp")})
    session.sparkContext.setLogLevel("ERROR")
    if checkpoint_dir(session) is None:
        # Only where the session names no shared folder: a scratch one.
        use_checkpoint_dir(session, fallback=tempfile.mkdtemp(prefix="folio-ckpt-", dir="/tmp"))
    yield session
    session.stop()


@pytest.fixture()
def scratch():
    return tempfile.mkdtemp(prefix="folio-test-", dir="/tmp")
