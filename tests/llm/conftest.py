import pytest

from tests.llm import cases


@pytest.fixture(scope="session")
def folder(spark, tmp_path_factory):
    """The edge cases as a folder of tables."""
    return cases.write(spark, str(tmp_path_factory.mktemp("edge")))


@pytest.fixture(scope="session")
def empty_folder(spark, tmp_path_factory):
    return cases.write(spark, str(tmp_path_factory.mktemp("empty")), empty=True)
