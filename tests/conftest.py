import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
sys.path.insert(0, str(Path(__file__).resolve().parent))


@pytest.fixture(scope="session")
def spark():
    from marketloom.session import local_session

    return local_session(8, 4)


@pytest.fixture()
def wh(spark, tmp_path):
    from marketloom.warehouse import Warehouse

    return Warehouse(spark, str(tmp_path / "wh"))
