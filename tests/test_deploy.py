"""The package reaches the executors' Python workers however the driver was started."""

import os
import subprocess
import sys
import tempfile

from conftest import ROOT, SF_SMALL

_SCRIPT = f"""
import sys
sys.path.insert(0, {ROOT!r})
import __spark_entry__ as E
from tillbook.session import local_session
spark = local_session(cpus=2, shuffle_partitions=2)
# a keyed-state stream: its fold runs in Python workers that import tillbook by name
print("rows", E.queries()["stream_outages"](spark, {SF_SMALL!r}).count())
spark.stop()
"""


def test_python_workers_import_the_package_outside_the_repo():
    cwd = tempfile.mkdtemp(prefix="tillbook-deploy-", dir="/tmp")   # not the repo: only the shipped zip helps
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", _SCRIPT], cwd=cwd, env=env, capture_output=True, text=True,
                         timeout=600)
    assert out.returncode == 0, out.stderr[-2000:]
    assert "rows " in out.stdout
