import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
sys.path.insert(0, str(Path(__file__).resolve().parent))


@pytest.fixture(scope="session")
def spark():
    from taxaloom.session import local_session

    session = local_session(partitions=4, memory="4g")
    session.conf.set("spark.sql.adaptive.coalescePartitions.parallelismFirst", "false")
    return session
