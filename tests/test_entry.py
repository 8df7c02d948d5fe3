"""The entry without the language-data folders."""

import os
import shutil
import subprocess
import sys

import pytest
from conftest import ROOT

CODE = """
import __spark_entry__ as e
from pixelweave import plans
from pixelweave.session import local_session
names = sorted(e.queries())
assert names == sorted(plans.queries()) and sorted(e.oracle_sql()) == sorted(plans.oracle_sql())
print(len(names), e.entry(local_session("entry", 2)).count())
"""


@pytest.mark.parametrize("also", [[], ["corpus_pipeline.py"]])
def test_the_rest_stands_without_these_folders(tmp_path, also):
    gone = [os.path.join(ROOT, p) for p in ("pixelweave/llm", "tests/llm", *also)]

    def skip(folder, names):
        return [n for n in names if n in (".git", "__pycache__") or os.path.join(folder, n) in gone]

    shutil.copytree(ROOT, tmp_path / "repo", ignore=skip)
    assert not (tmp_path / "repo/pixelweave/llm").exists()
    env = {**os.environ, "PYTHONPATH": ""}
    run = subprocess.run([sys.executable, "-c", CODE], cwd=tmp_path / "repo", env=env, capture_output=True, text=True)
    assert run.returncode == 0, run.stderr[-800:]
    assert int(run.stdout.split()[0]) > 60 and int(run.stdout.split()[1]) == 5
