import pytest

from remitlens.session import build_session


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "remitlens-tests",
        master="local[4]",
        **{
            "spark.sql.shuffle.partitions": "2",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "4g",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
