import os
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark():
    from citeforge.session import build_session

    session = build_session(
        "tests",
        f"local[{os.environ.get('TEST_CPUS', '8')}]",
        spark__sql__shuffle__partitions=8,
        spark__ui__enabled="false",
        spark__driver__memory="8g",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def small():
    """Folder of the smallest test tables; tests that need them are skipped elsewhere."""
    folder = os.environ.get("SMALL_DATA", "/root/testdata/sf0.001")
    if not Path(folder).exists():
        pytest.skip("no test tables")
    return folder
