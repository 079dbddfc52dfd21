import os
import shutil
import subprocess
import sys
from pathlib import Path

import pytest
from comparing import same
from conftest import DATA

from siltworks import queries


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_equals_sql(spark, duck, name):
    same(queries.QUERIES[name](spark, DATA), duck, queries.ORACLES[name])


def test_every_query_has_sql():
    assert set(queries.QUERIES) == set(queries.ORACLES)


def test_entry_without_the_corpus_operators(tmp_path):
    root = Path(__file__).resolve().parent.parent
    shutil.copytree(root / "siltworks", tmp_path / "siltworks", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(root / "__spark_entry__.py", tmp_path)
    said = "import __spark_entry__ as e; assert set(e.queries()) == set(e.oracle_sql()) == set(e.reference.QUERIES)"
    subprocess.run([sys.executable, "-c", said], cwd=tmp_path, env=os.environ | {"PYTHONPATH": str(tmp_path)}, check=True)


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() == 10
