import pytest

from plinth.session import local_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(4, "plinth-tests")
    session.sparkContext.setLogLevel("ERROR")
    session.conf.set("spark.sql.shuffle.partitions", "4")
    session.sparkContext.setCheckpointDir(f"file://{tmp_path_factory.mktemp('checkpoints')}")
    yield session
    session.stop()
