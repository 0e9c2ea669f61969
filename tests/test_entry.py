"""The entry point: with the pipeline part, and without its two folders."""

import os
import shutil
import subprocess
import sys
from pathlib import Path

REPO = Path(__file__).resolve().parents[1]


def imported(folder: Path) -> set[str]:
    code = "import __spark_entry__ as e; print(','.join(sorted(e.queries())))"
    env = os.environ | {"PYTHONPATH": str(folder), "PYTHONDONTWRITEBYTECODE": "1"}
    run = subprocess.run([sys.executable, "-c", code], cwd=folder, env=env, capture_output=True, text=True, check=True)
    return set(run.stdout.strip().split(","))


def test_entry_without_the_pipeline_part(tmp_path):
    """Neither a missing package nor a pipeline file left behind may take the other queries along."""
    ignore = shutil.ignore_patterns("llm", "__pycache__")
    shutil.copytree(REPO / "panelweave", tmp_path / "panelweave", ignore=ignore)
    for name in ("__spark_entry__.py", "corpus_pipeline.py"):
        if (REPO / name).exists():
            shutil.copy(REPO / name, tmp_path)
    left = imported(tmp_path)
    assert {"ever_in_window", "harmonised_counts", "bcs70_marstat"} <= left
    assert not [n for n in left if n.startswith("op") or n == "pipeline"]


def test_every_sql_has_its_query():
    sys.path.insert(0, str(REPO))
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
