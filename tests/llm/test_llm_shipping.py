"""The operators on executors that can't import the package."""

import os
import subprocess
import sys

import pytest

REPO = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
CODE = """
import sys
sys.path.insert(0, {repo!r})
import __spark_entry__ as E
from feedlens.session import build_session
spark = build_session("local[4]", 4)
for name, query in E.queries().items():
    if name == "pipeline" or name.startswith("op"):
        print("ROWS", name, query(spark, {sf!r}).count(), flush=True)
spark.stop()
"""


def test_queries_run_where_workers_lack_the_package(tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", CODE.format(repo=REPO, sf="/root/testdata/sf0.001")], cwd=tmp_path, env=env,
                         capture_output=True, text=True, timeout=600)
    rows = {x.split()[1]: int(x.split()[2]) for x in out.stdout.splitlines() if x.startswith("ROWS")}
    assert len(rows) == 14, out.stderr[-3000:]
    assert all(n > 0 for name, n in rows.items() if name != "op4_secrets"), rows


@pytest.mark.parametrize("sizes, want", [([], []), ([5], [(0, 1)]), ([5, 5, 5], [(0, 2), (2, 3)]), ([100, 1, 1], [(0, 1), (1, 3)])])
def test_chunks(sizes, want):
    from feedlens.llm.common import chunks
    assert list(chunks(sizes, 10)) == want
