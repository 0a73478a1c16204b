import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from civic_indicators.session import checkpoint_dir, get_spark  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = get_spark("local[4]", app="civic_tests", shuffle_partitions=4)
    s.sparkContext.setLogLevel("ERROR")
    # Tests run on one machine: a local checkpoint folder only when the
    # session names none.
    checkpoint_dir(s, fallback=tempfile.mkdtemp(prefix="civic-ckpt-"))
    yield s
    s.stop()


def rows(df, *cols):
    """Collect a small test result as a list of tuples (in the given column order)."""
    cols = cols or tuple(df.columns)
    from civic_indicators.functions.cols import col
    return [tuple(r) for r in df.select(*[col(c) for c in cols]).collect()]
