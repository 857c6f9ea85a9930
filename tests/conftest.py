import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from ledgerline.session import get_spark
    s = get_spark("local[4]", app="ledgerline-tests", shuffle_partitions=8)
    yield s
    s.stop()


@pytest.fixture()
def tmpdir_fresh():
    return tempfile.mkdtemp(prefix="ledgerline-test-")


def write(path, text, mode="w", encoding="utf-8"):
    if "b" in mode:
        with open(path, mode) as f:
            f.write(text)
    else:
        with open(path, mode, encoding=encoding) as f:
            f.write(text)
    return path
