import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from archiva.session import build

    s = build("local[4]", "tests", **{"spark.sql.shuffle.partitions": "4", "spark.driver.memory": "4g", "spark.checkpoint.dir": str(tmp_path_factory.mktemp("cp"))})
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf():
    return "/root/testdata/sf0.001"
