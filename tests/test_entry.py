"""The entry module with and without the training-data operators."""

import pathlib
import shutil
import subprocess
import sys

TOP = pathlib.Path(__file__).resolve().parents[1]


def names(folder):
    code = "import __spark_entry__ as e; print(*sorted(e.queries())); print(*sorted(e.oracle_sql()))"
    done = subprocess.run([sys.executable, "-c", code], cwd=folder, capture_output=True, text=True, timeout=120, check=True)
    return [set(line.split()) for line in done.stdout.splitlines()]


def test_every_query_is_there():
    queries, sql = names(TOP)
    assert sql <= queries and len(queries) > 100


def test_core_works_without_the_operators(tmp_path):
    for one in ("ledgerline", "__spark_entry__.py"):
        (shutil.copytree if (TOP / one).is_dir() else shutil.copy)(TOP / one, tmp_path / one)
    shutil.rmtree(tmp_path / "ledgerline/llm", ignore_errors=True)
    queries, sql = names(tmp_path)
    assert "player_swings" in queries and not any(q.startswith("op") and q[2:3].isdigit() or q == "pipeline" for q in queries | sql)
