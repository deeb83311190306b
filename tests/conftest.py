import pytest

from formsieve.session import local_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(8, shuffle_partitions=4, memory="6g")
    if session.conf.get("spark.checkpoint.dir", None) is None:
        session.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("shared")))
    return session
