from __future__ import annotations

import pytest

from inventrace import session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    s = session.build("local[4]", 4, "tests", f"file://{tmp_path_factory.mktemp('scratch')}")
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()
