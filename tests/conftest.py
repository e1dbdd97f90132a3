import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from plumbline.session import checkpoint_dir, local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(cpus=8, shuffle_partitions=8, memory="12g")
    checkpoint_dir(session)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def evaluate(spark):
    """Apply one column expression to literal rows and return the values."""

    def run(rows, build, columns=None):
        first = rows[0] if isinstance(rows[0], tuple) else (rows[0],)
        names = columns or [f"c{i}" for i in range(len(first))]
        data = [r if isinstance(r, tuple) else (r,) for r in rows]
        schema = ", ".join(f"{n} string" for n in names)
        return [r[0] for r in spark.createDataFrame(data, schema).coalesce(1).select(build(*names)).collect()]

    return run
