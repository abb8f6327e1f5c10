import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from faultline.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, "8g")
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture
def make(spark):
    """make(schema, rows): a small DataFrame."""
    return lambda schema, rows: spark.createDataFrame(rows, schema)


LOG_SCHEMA = "log_id bigint, timestamp timestamp_ntz, log_line string"
INCIDENT_SCHEMA = (
    "incident_id bigint, detected_at timestamp_ntz, resolved_at timestamp_ntz, log_line string, summary string, status string"
)
ACTION_SCHEMA = "action_id bigint, incident_id bigint, action_name string, executed_at timestamp_ntz, status string"
