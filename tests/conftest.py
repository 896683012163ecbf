import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from sparkwright.session import build_session, cleanup  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = build_session(master="local[4]", shuffle_partitions=4)
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="sw-test-ckpt-"))
    yield s
    cleanup(s)


@pytest.fixture()
def tmp_text(tmp_path):
    """Write lines to a fresh text file and return its path."""
    def write(lines, name="input.txt"):
        p = tmp_path / name
        p.write_text("".join(line + "\n" for line in lines), encoding="utf-8")
        return str(p)
    return write
