import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from spendlens.session import local_session
    folder = tmp_path_factory.mktemp("spark")
    return local_session("8", 8, **{
        "spark.checkpoint.dir": str(folder / "checkpoints"),
        "spark.sql.warehouse.dir": str(folder / "warehouse"),
    })


@pytest.fixture(scope="session")
def folder():
    return "/root/testdata/sf0.001"
