import os
import sys
import tempfile

import pytest

_HERE = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, os.path.dirname(_HERE))
# Python workers import test-defined functions (toy tokenizers) by module name
os.environ["PYTHONPATH"] = os.pathsep.join(
    [_HERE, os.path.dirname(_HERE)] + [p for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p])

SF0001 = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from corpusloom.session import build_session
    s = build_session(master="local[4]", shuffle_partitions=8)
    yield s
    s.stop()


@pytest.fixture()
def tmp(tmp_path):
    return str(tmp_path)


def write_lines(path, lines, newline="\n", final_newline=True):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    data = newline.join(lines) + (newline if final_newline and lines else "")
    with open(path, "wb") as f:
        f.write(data.encode("utf-8") if isinstance(data, str) else data)
