import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from checks.session import local_session  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    return local_session(4, spark__sql__shuffle__partitions="4", spark__sql__warehouse__dir=str(
        tmp_path_factory.mktemp("warehouse")))


@pytest.fixture(scope="session")
def sf():
    return SF
