import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from tidewell.session import build
    s = build("local[4]", app="tidewell-tests", shuffle_partitions=8)
    yield s
    s.stop()


@pytest.fixture
def tmpdir_str(tmp_path):
    return str(tmp_path)


def rows(df, *cols):
    """Sorted list of tuples (None sorts first) for order-free comparison."""
    cols = cols or tuple(df.columns)
    out = [tuple(r[c] for c in cols) for r in df.select(*cols).collect()]
    return sorted(out, key=lambda t: tuple((x is not None, str(x)) for x in t))


def write_lines(path, lines):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write("\n".join(lines) + "\n")
    return path
