import pytest

from ludolake.session import build_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        app="tests",
        master="local[4]",
        settings={
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def root(tmp_path):
    """A lake of its own for each test."""
    return str(tmp_path / "lake")


def plan_of(df, mode: str = "simple") -> str:
    """The physical plan as text."""
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), mode)
