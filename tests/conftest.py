import sys
import tempfile
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

from trafficlens.session import get_spark  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    # Tests own their scratch checkpoint folder (the cluster would name a shared one).
    ckpt = tempfile.mkdtemp(prefix="trafficlens-test-ckpt-")
    s = get_spark("local[4]", app="trafficlens-tests", shuffle_partitions=8,
                  extra={"spark.checkpoint.dir": ckpt})
    yield s
    s.stop()


def rows(df, *cols):
    """Collect ``cols`` (all when empty) as a sorted list of tuples."""
    cols = cols or tuple(df.columns)
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)
