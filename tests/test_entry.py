"""The driver contract."""

import os
import shutil
import subprocess
import sys

import pytest

import __spark_entry__ as entry


def test_names():
    queries, oracles = entry.queries(), entry.oracle_sql()
    assert set(oracles) <= set(queries) and len([q for q in queries if q.startswith("q")]) >= 60


def test_without_the_training_data_folders(tmp_path):
    """The other queries are there, and nothing of the rest imports the deleted folder, whether the pipeline's file stays or goes."""
    here = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    shutil.copytree(here, tmp_path / "repo", ignore=shutil.ignore_patterns(".git", "llm", "__pycache__"))
    names = "import __spark_entry__ as e; print(len(e.oracle_sql()) <= len(e.queries()) >= 60, any(q.startswith('op') or q == 'pipeline' for q in e.queries()))"
    for _ in range(2):
        told = subprocess.run([sys.executable, "-c", names], cwd=tmp_path / "repo", capture_output=True, text=True, env={**os.environ, "PYTHONPATH": str(tmp_path / "repo")}, timeout=120)
        assert told.stdout.split() == ["True", "False"], told.stderr
        (tmp_path / "repo/corpus_pipeline.py").unlink(missing_ok=True)


def test_nothing_else_imports_the_training_data_folder():
    here = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    for folder, _, names in os.walk(os.path.join(here, "claimloom")):
        if os.path.basename(folder) != "llm":
            for name in names:
                if name.endswith(".py"):
                    with open(os.path.join(folder, name)) as f:
                        assert "claimloom.llm" not in f.read(), name


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="needs the driver's tables")
def test_flagship(spark):
    frame = entry.entry(spark)
    assert frame.columns == ["o_orderkey", "score", "rule_id"] and frame.count() > 0
