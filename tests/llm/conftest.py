import pytest

from ledgerlens.llm.common import workers_find_package


@pytest.fixture(scope="session", autouse=True)
def package_on_workers(spark):
    workers_find_package(spark)
