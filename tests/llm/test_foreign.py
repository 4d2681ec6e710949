"""Every operator as the first job of a fresh session, far from the folder in which the package lies."""

import os
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
SCRIPT = """
import sys
sys.path.insert(0, {root!r})
from riskloom.session import local_session
from riskloom.llm import queries
spark = local_session(4, "foreign")
print("ROWS", queries.queries()[{name!r}](spark, "/root/testdata/sf0.001").count())
"""


@pytest.mark.parametrize("name", ["op1_secret_scan", "op3_token_files", "op6_substring_dedup", "op10_jaccard_join", "op11_spelling_variants", "op12_nearest_neighbours"])
def test_first_job_of_a_session(name, tmp_path):
    (tmp_path / "run.py").write_text(SCRIPT.format(root=ROOT, name=name))
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "run.py"], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=240)
    assert "ROWS" in done.stdout, done.stderr[-2000:]
