"""The entry module without the training-data folders."""

import pathlib
import shutil
import subprocess
import sys

import pytest

from __spark_entry__ import oracle_sql, queries

ROOT = pathlib.Path(__file__).parents[1]


@pytest.mark.parametrize("pipeline_stays", [False, True])
@pytest.mark.parametrize("caches_stay", [False, True])
def test_core_queries_without_the_folders(tmp_path, pipeline_stays, caches_stay):
    gone = {"deltarecon": {"llm"}, "tests": {"llm"}}
    for part, without in gone.items():
        shutil.copytree(ROOT / part, tmp_path / part, ignore=lambda d, names, w=without: w & set(names) | {"__pycache__"} & set(names))
    if caches_stay:
        (tmp_path / "deltarecon/llm/__pycache__").mkdir(parents=True)
    shutil.copy(ROOT / "__spark_entry__.py", tmp_path)
    if pipeline_stays and (ROOT / "corpus_pipeline.py").exists():
        shutil.copy(ROOT / "corpus_pipeline.py", tmp_path)
    code = "import __spark_entry__ as e; print(*sorted(e.queries())); print(*sorted(e.oracle_sql()))"
    said = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, timeout=120)
    assert said.returncode == 0, said.stderr
    names, with_sql = (line.split() for line in said.stdout.strip().splitlines()[-2:])
    core = sorted(n for n in queries() if not n.startswith("op") and n != "pipeline")
    assert names == core and with_sql == core
    assert set(core) <= set(oracle_sql())
