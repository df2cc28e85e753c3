import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tests.session import make_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    return make_session()


@pytest.fixture(scope="session")
def small_items(spark):
    """Typed transactions of the smallest data set, read many times by the tests."""
    from buyerscope.sources import retail_view as view
    from buyerscope.sources.staging import staged

    return staged(view.transactions(spark, SMALL), "items")
