import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tickwise.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session("4", 4, str(tmp_path_factory.mktemp("shared")))
    session.sparkContext.setLogLevel("ERROR")
    return session


def rows(df, *order):
    """Collected rows as dictionaries in a fixed order."""
    return [r.asDict() for r in df.orderBy(*order).collect()]
