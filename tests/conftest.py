import pytest


@pytest.fixture(scope="session")
def spark():
    from aquilith.session import build

    session = build("local[4]", "tests", spark__sql__shuffle__partitions="4", spark__ui__enabled="false", spark__ui__showConsoleProgress="false")
    session.sparkContext.setLogLevel("ERROR")
    return session
