import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from quarry.session import drop_tables, ensure_checkpoint_dir, get_session
    session = get_session("local[*]", app="quarry-tests", shuffle_partitions=8,
                          extra={"spark.driver.memory": "6g"})
    ensure_checkpoint_dir(session)
    yield session
    drop_tables(session)
    session.stop()
