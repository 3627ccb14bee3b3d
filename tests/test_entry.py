"""The driver's module imports with no session, from either PySpark layout."""

import glob
import os
import subprocess
import sys

import pyspark
import pytest

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SCRIPT = """
import pyspark
import __spark_entry__ as e
from pyspark.sql import SparkSession
print(pyspark.__file__, len(e.queries()), len(e.oracle_sql()))
assert SparkSession.getActiveSession() is None
assert set(e.oracle_sql()) <= set(e.queries()) and len(e.oracle_sql()) >= 67
"""


def zips():
    return sorted(glob.glob(os.path.join(os.path.dirname(pyspark.__file__), "python", "lib", "*.zip")))


@pytest.mark.parametrize("layout", ["package", "zip"])
def test_entry_imports_without_a_session(layout):
    path = zips() if layout == "zip" else []
    if layout == "zip" and not path:
        pytest.skip("no zip layout beside this PySpark")
    env = {**os.environ, "PYTHONPATH": os.pathsep.join([*path, REPO])}
    out = subprocess.run([sys.executable, "-c", SCRIPT], env=env, cwd="/", capture_output=True, text=True)
    assert out.returncode == 0, out.stderr[-2000:]
    if layout == "zip":
        assert "pyspark.zip" in out.stdout


WITHOUT = """
import sys
class Gone:
    def find_spec(self, name, path=None, target=None):
        if name in {missing!r}:
            raise ModuleNotFoundError("No module named " + name, name=name)
sys.meta_path.insert(0, Gone())
import __spark_entry__ as e
assert len(e.queries()) >= 79 and not any(k.startswith("op") for k in e.queries()) and set(e.oracle_sql()) <= set(e.queries())
"""


@pytest.mark.parametrize("missing", [("fundscope.llm",), ("corpus_pipeline",), ("fundscope.llm.simhash",)])
def test_core_queries_are_there_without_the_optional_part(missing):
    env = {**os.environ, "PYTHONPATH": REPO}
    out = subprocess.run([sys.executable, "-c", WITHOUT.format(missing=missing)], env=env, cwd="/", capture_output=True, text=True)
    assert out.returncode == 0, out.stderr[-2000:]
    assert ("left out" in out.stderr) == (missing == ("fundscope.llm.simhash",))
