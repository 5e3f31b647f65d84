import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
os.environ["PYTHONPATH"] = os.pathsep.join(
    [os.path.dirname(os.path.dirname(os.path.abspath(__file__))), os.environ.get("PYTHONPATH", "")]
)

from tests.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(
        "4", **{"spark.checkpoint.dir": str(tmp_path_factory.mktemp("checkpoints"))}
    )
    yield session
    session.stop()


@pytest.fixture()
def queue_rows(spark):
    """Builds a queue from (packet_id, size, created, expires, priority, transaction)."""
    from courier.schema import QUEUE_SCHEMA

    def build(rows):
        return spark.createDataFrame(
            [
                (packet_id, '{"key":"value"}', b"x", size, created, expires, priority, transaction)
                for packet_id, size, created, expires, priority, transaction in rows
            ],
            QUEUE_SCHEMA,
        )

    return build
