import pytest

from kinomill.session import local_session

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    return local_session("8", shuffle_partitions=4)


@pytest.fixture(scope="session")
def small():
    return SMALL


@pytest.fixture
def rows():
    """Rows of a frame as sorted tuples, for comparison as multisets."""

    def collect(df, *columns):
        picked = df.select(*columns) if columns else df
        return sorted((tuple(r) for r in picked.collect()), key=repr)

    return collect
