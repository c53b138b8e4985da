"""The registry imports and lists its queries in a process with no session,
also when pyspark comes from its zip archive (no jars beside the package)."""

import glob
import os
import subprocess
import sys

import pyspark
import pytest
from pyspark.ml.feature import StopWordsRemover

from conftest import ROOT
from tessera.stopwords import spanish_standard

HOME = os.path.dirname(pyspark.__file__)
ZIPS = [p for p in [os.path.join(HOME, "python", "lib", "pyspark.zip"), *glob.glob(os.path.join(HOME, "python", "lib", "py4j-*.zip"))] if os.path.exists(p)]


@pytest.mark.parametrize("first", [[], ZIPS], ids=["package", "zip"])
def test_import_without_a_session(first):
    code = ("import __spark_entry__ as e, pyspark; q, o = e.queries(), e.oracle_sql(); "
            "assert set(o) <= set(q) and len(q) >= 40; print(pyspark.__file__)")
    env = os.environ | {"PYTHONPATH": os.pathsep.join([*first, ROOT])}
    r = subprocess.run([sys.executable, "-c", code], env=env, cwd=ROOT, capture_output=True, text=True, timeout=120)
    assert r.returncode == 0, r.stderr[-800:]
    if first:
        assert "pyspark.zip" in r.stdout


def test_stopwords_equal_the_standard_list(spark):
    words = spanish_standard()
    assert len(words) == len(set(words))
    assert set(words) == set(StopWordsRemover.loadDefaultStopWords("spanish"))
