import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent))


@pytest.fixture
def docs(spark):
    """Frames with a doc_id, a text, and columns whose names the operators use inside."""

    def make(rows):
        schema = "doc_id bigint, text string, id int, node int, chunk int, score double, kept boolean"
        return spark.createDataFrame([(k, t, 1, None, 3, 0.5, None) for k, t in rows], schema)

    return make
