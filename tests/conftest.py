import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from retail_insights.session import build_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    # Tests name their own checkpoint folder; a cluster names a shared one.
    session = build_session(
        "local[4]",
        app_name="retail_insights_tests",
        shuffle_partitions=8,
        extra={"spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
               "spark.checkpoint.dir": str(tmp_path_factory.mktemp("checkpoints"))},
    )
    yield session
    session.stop()


def rows(df, *cols):
    """Rows of ``df`` as sorted tuples of ``cols`` (all columns by default)."""
    cols = cols or tuple(df.columns)
    return sorted((tuple(r) for r in df.select(*cols).collect()),
                  key=lambda t: tuple((v is None, v) for v in t))
