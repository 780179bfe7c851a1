import pytest

from seriesmill.llm.common import ready


@pytest.fixture(autouse=True)
def prepared(spark):
    return ready(spark)
