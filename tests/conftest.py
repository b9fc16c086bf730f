import os
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))
os.environ["PYTHONPATH"] = f"{ROOT}:{os.environ.get('PYTHONPATH', '')}"
DATA = Path(os.environ.get("TESTDATA", "/root/testdata"))


@pytest.fixture(scope="session")
def spark():
    from presslake.session import local_session

    return local_session(4, "4g", 4)


@pytest.fixture(scope="session")
def small():
    folder = DATA / "sf0.001"
    if not folder.exists():
        pytest.skip("no test tables")
    return str(folder)
