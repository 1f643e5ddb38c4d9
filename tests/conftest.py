import sys
from pathlib import Path

import pytest

sys.path[:0] = [str(Path(__file__).resolve().parent.parent), str(Path(__file__).resolve().parent)]

from starmart.session import local_session  # noqa: E402

TRIAL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    scratch = tmp_path_factory.mktemp("spark")
    session = local_session(
        4, "4g", **{"spark.checkpoint.dir": str(scratch / "shared"), "spark.sql.warehouse.dir": str(scratch / "warehouse")}
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def trial_dir():
    if not Path(TRIAL).is_dir():
        pytest.skip("trial tables are not here")
    return TRIAL
