import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tradeledger.session import build_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    root = tmp_path_factory.mktemp("shared")
    session = build_session(
        "tests",
        "local[4]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.driver.memory": "4g",
            "spark.sql.maxMetadataStringLength": "5000",
            "spark.checkpoint.dir": str(root),
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def rows(df, *names):
    """Rows as sorted tuples; NULLs sort first."""
    found = [tuple(r) for r in (df.select(*names) if names else df).collect()]
    return sorted(found, key=lambda r: tuple((v is not None, str(type(v)), v) for v in r))
