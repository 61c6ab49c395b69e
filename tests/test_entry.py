"""The library without its optional parts."""
import os
import shutil
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_entry_without_the_optional_parts(tmp_path):
    """A tree without the training-data operators imports, registers the rest and collects its tests."""
    tree = tmp_path / "tree"
    shutil.copytree(ROOT, tree, ignore=shutil.ignore_patterns(".git", "__pycache__", "llm", "corpus_pipeline.py", ".pytest_cache"))
    assert not (tree / "quire" / "llm").exists() and not (tree / "tests" / "llm").exists()
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    listed = subprocess.run([sys.executable, "-B", "-c", "import __spark_entry__ as e; print(*sorted(e.queries())); print(*sorted(e.oracle_sql()))"],
                            cwd=tree, env=env, capture_output=True, text=True, timeout=120)
    assert listed.returncode == 0, listed.stderr
    names, oracles = (line.split() for line in listed.stdout.splitlines()[-2:])
    assert "date_normalize" in names and "pipeline" not in names and not any(n.startswith("op") for n in names)
    assert set(oracles) <= set(names)
    found = subprocess.run([sys.executable, "-B", "-m", "pytest", "tests", "--collect-only", "-q", "-p", "no:cacheprovider"],
                           cwd=tree, env=env, capture_output=True, text=True, timeout=300)
    assert found.returncode == 0, found.stdout[-2000:]
