import shutil
import subprocess
import sys
from pathlib import Path

import pytest

import __spark_entry__ as entry

ROOT = Path(entry.__file__).parent


def test_every_sql_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert len(entry.queries()) > 60


@pytest.mark.parametrize("also", [(), ("corpus_pipeline.py",)])
def test_entry_works_without_the_corpus_operators(tmp_path, also):
    """With both folders gone, and with corpus_pipeline.py gone or left behind."""
    gone = shutil.ignore_patterns("llm", "__pycache__", ".git", *also)
    shutil.copytree(ROOT, tmp_path, ignore=gone, dirs_exist_ok=True)
    code = "import __spark_entry__ as e; q = e.queries(); assert 'errors_view' in q and not any(n.startswith('op') for n in q) and 'pipeline' not in q; e.oracle_sql()"
    subprocess.run([sys.executable, "-B", "-c", code], cwd=tmp_path, check=True, env={"PATH": "/usr/bin:/bin", "PYTHONPATH": str(tmp_path)})
