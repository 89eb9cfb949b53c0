import pytest

from lodestone.session import build_session


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", cpus=4, shuffle_partitions=2, **{"spark.sql.codegen.wholeStage": "false"})
    yield session
    session.stop()
