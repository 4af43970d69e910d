import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from audience_engine.session import checkpoint_root, local_session
    s = local_session("*", shuffle_partitions=8, app="audience_engine_tests")
    checkpoint_root(s)  # the session's shared folder; a fresh local one only if unset
    yield s


@pytest.fixture
def tmp_csv(tmp_path):
    """Write rows as a headerless CSV file and return its folder."""
    def write(name, lines):
        d = tmp_path / name
        d.mkdir()
        (d / "part-0.csv").write_text("\n".join(lines) + "\n")
        return str(d)
    return write
