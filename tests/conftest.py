import pytest

from loadlake.session import session


@pytest.fixture(scope="session")
def spark():
    return session("tests", cores=4, shuffle_partitions=4)


@pytest.fixture
def rows():
    """Collected rows as sorted tuples of the named columns."""

    def collect(df, *columns):
        return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)

    return collect
