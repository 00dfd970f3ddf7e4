import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from compare import local_session  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    warehouse = str(tmp_path_factory.mktemp("warehouse"))
    scratch = str(tmp_path_factory.mktemp("scratch"))
    return local_session(4, {"spark.sql.warehouse.dir": warehouse, "spark.checkpoint.dir": scratch})


@pytest.fixture
def sf_dir():
    return SF_DIR


def rows(df, *columns):
    """Rows of a frame as a sorted list of tuples."""
    df = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in df.collect()), key=lambda r: tuple((v is None, str(v)) for v in r))
