import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))


@pytest.fixture(scope="session")
def spark():
    from skyscreen.session import local_session, ship

    session = local_session(4, "tests", spark__sql__shuffle__partitions="4", spark__driver__memory="4g")
    yield ship(session)
    session.stop()
