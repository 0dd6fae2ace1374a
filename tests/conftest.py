import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))


@pytest.fixture(scope="session")
def spark():
    from crossview.session import local_session

    s = local_session(4, 4, "4g", **{"spark.sql.streaming.metricsEnabled": "false"})
    yield s
    s.stop()
