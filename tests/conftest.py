import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from plumbline.session import local_session  # noqa: E402

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session("4", "6g")
    session.conf.set("spark.sql.shuffle.partitions", "2")
    # Tables of a few rows: compiling a plan takes longer than running it. The registered queries run compiled.
    session.conf.set("spark.sql.codegen.wholeStage", "false")
    session.conf.set("spark.sql.codegen.factoryMode", "NO_CODEGEN")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def data():
    return DATA


@pytest.fixture
def table(spark):
    """Frame of text columns from lists of cells: table(a=[...], b=[...])."""

    def make(**columns):
        names = list(columns)
        rows = list(zip(*columns.values()))
        return spark.createDataFrame(rows, ", ".join(f"`{n}` string" for n in names))

    return make
