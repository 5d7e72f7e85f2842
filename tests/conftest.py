import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from plumbline.session import get_spark  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    return get_spark("tests", 4, 4)
